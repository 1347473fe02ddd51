"""Removing features that repeat each other."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from mergewell.functions.naming import base_name
from mergewell.lineage import cut_lineage
from mergewell.operators.columns import (
    columns_matching, count_values, numeric_columns, string_columns)
from mergewell.operators.completeness import filled_columns, sparse_columns
from mergewell.operators.correlation import (
    both_directions, complete_numbers, pairs_with_gaps, partner_counts, pearson_pairs)

REDUNDANT_LEVEL = 0.99


def redundant_features(pairs: DataFrame, gaps: DataFrame, reduce_pairs: bool = False) -> DataFrame:
    """Correlated features that another one stands for.

    In every pair the side with fewer gaps leads (ties: the earlier column).  Features
    that only ever lead are kept; so is a feature with exactly one partner, unless
    `reduce_pairs` is set.
    """
    facing = pairs_with_gaps(pairs, gaps).select(
        F.when(F.col("na_b") >= F.col("na_a"), F.col("b")).otherwise(F.col("a")).alias("led"),
        F.when(F.col("na_b") >= F.col("na_a"), F.col("a")).otherwise(F.col("b")).alias("leader"))
    leaders = facing.select(F.col("leader").alias("feature")).distinct()
    led = facing.select(F.col("led").alias("feature")).distinct()
    keep = leaders.join(led, "feature", "left_anti")
    degree = partner_counts(pairs)
    if not reduce_pairs:
        keep = keep.unionByName(degree.filter("partners = 1").select("feature")).distinct()
    return degree.select("feature").join(keep, "feature", "left_anti")


def drop_redundant_numeric(
    df: DataFrame, key: str, label: str, level: float = REDUNDANT_LEVEL,
    reduce_pairs: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Drop numeric columns that repeat others, then columns without any value."""
    rows, filled = count_values(df)
    numeric = numeric_columns(df, (key, label))
    counts = {c: filled[c] for c in numeric}
    usable = filled_columns(rows, counts, 0.5)
    dropped: list[str] = []
    if len(usable) > 1:
        # Both tables have at most one line per (pair of) schema columns.
        pairs = pearson_pairs(df, usable, level)
        gaps = df.sparkSession.createDataFrame(
            [(c, rows - filled[c]) for c in usable], "feature string, na_count bigint")
        if not pairs.isEmpty():
            redundant = redundant_features(pairs, gaps, reduce_pairs)
            dropped = sorted(r["feature"] for r in redundant.collect())
            dropped += sparse_columns(rows, counts)
    dropped += [c for c, n in filled.items() if n == 0 and c not in dropped and c != key]
    return df.drop(*dropped), dropped


def duplicate_text_columns(gaps: dict[str, int], order: list[str]) -> list[str]:
    """Copies of a text column (same name but for a copy mark) that do not survive.

    The copy with fewest gaps stays (ties: the first column).
    """
    if not any(c.endswith("_2") for c in order):
        return []
    ranked = sorted(order, key=lambda c: (gaps[c], order.index(c)))
    taken: set[str] = set()
    dropped = []
    for column in ranked:
        if base_name(column) in taken:
            dropped.append(column)
        taken.add(base_name(column))
    return dropped


def drop_redundant_strings(df: DataFrame, key: str, label: str) -> tuple[DataFrame, list[str]]:
    texts = string_columns(df, (key, label))
    rows, filled = count_values(df, texts)
    dropped = duplicate_text_columns({c: rows - filled[c] for c in texts}, texts)
    return df.drop(*dropped), dropped


def resolve_label(df: DataFrame, label: str) -> tuple[DataFrame, str, list[str]]:
    """Choose among label, label_1 ... label_9: equal gaps keep the exact name, otherwise
    the copy with fewest gaps becomes the label."""
    copies = columns_matching(df, f"^{label}(_[1-9])?$")
    if len(copies) < 2:
        return df, label, []
    rows, filled = count_values(df, copies)
    if len(set(filled.values())) == 1:
        chosen = label if label in copies else copies[0]
    else:
        chosen = min(copies, key=lambda c: (rows - filled[c], copies.index(c)))
    dropped = [c for c in copies if c != chosen]
    return df.drop(*dropped), chosen, dropped


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached from each node.

    Every round a node takes the smallest label among itself and its neighbours and then
    that label's own label, so long chains shrink fast.  Each round ends in a reliable
    checkpoint.  Nodes are columns, their number is that of the schema.
    """
    links = edges.select(F.col("a").alias("x"), F.col("b").alias("y"))
    links = cut_lineage(links.union(links.select("y", "x")).distinct())
    labels = cut_lineage(links.groupBy(F.col("x").alias("node")).agg(
        F.least(F.min("x"), F.min("y")).alias("component")))
    while True:
        near = links.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(
            F.min("component").alias("near"))
        hop = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        lowered = (
            labels.join(near, F.col("node") == F.col("x"))
            .join(hop, "component")
            .select("node", F.least("component", "near", "far").alias("lower"), "component"))
        lowered = cut_lineage(lowered)
        changed = not lowered.filter("lower < component").isEmpty()
        labels = lowered.select("node", F.col("lower").alias("component"))
        if not changed:
            return labels


#: Pairs of columns up to which groups are found in the driver; beyond it, in Spark.
UNION_PAIRS = 1_000_000
DENSE_COLUMNS = 200  # whose correlation matrix is one small job


def group_correlated(pairs: DataFrame, columns: Iterable[str], level: float) -> DataFrame:
    """Groups of features linked by |corr| >= level: (group_id, keep, members).

    The first column of a group is kept, `members` are the others in column order;
    a feature without partner is a group of its own with no members.  The graph has the size of
    the schema: its pairs are united in the driver, or, above UNION_PAIRS, by distributed rounds.
    """
    columns = list(columns)
    edges = pairs.filter(F.abs("corr") >= level).select("a", "b")
    strong = edges.limit(UNION_PAIRS + 1).collect()
    if len(strong) > UNION_PAIRS:
        return _group_in_spark(edges, columns)
    groups = united(columns, [(r["a"], r["b"]) for r in strong])
    return pairs.sparkSession.createDataFrame(
        [(g[0], g[0], g[1:]) for g in groups], "group_id string, keep string, members array<string>")


def united(nodes: list[str], edges: list[tuple[str, str]]) -> list[list[str]]:
    """Groups of linked nodes, each in the order of nodes: union-find, the earlier node on top."""
    place = {c: i for i, c in enumerate(nodes)}
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for a, b in edges:
        low, high = sorted((root(place[a]), root(place[b])))
        parent[high] = low
    groups: dict[int, list[str]] = {}
    for i, c in enumerate(nodes):
        groups.setdefault(root(i), []).append(c)
    return list(groups.values())


def _group_in_spark(edges: DataFrame, columns: list[str]) -> DataFrame:
    order = edges.sparkSession.createDataFrame(
        [(c, i) for i, c in enumerate(columns)], "node string, place int")
    grouped = order.join(connected_components(edges), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    # One group holds at most all columns of the schema.
    members = F.transform(F.sort_array(F.collect_list(F.struct("place", "node"))), lambda m: m["node"])
    return grouped.groupBy("component").agg(members.alias("all")).select(
        F.col("all")[0].alias("group_id"), F.col("all")[0].alias("keep"),
        F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))).alias("members"))


def choose_survivors(groups: DataFrame, choose: dict[str, str] | None = None) -> DataFrame:
    """Groups with the feature that stays: the caller's choice or else the first one."""
    choices = groups.sparkSession.createDataFrame(
        list((choose or {}).items()), "group_id string, choice string")
    known = F.array_contains("members", F.col("choice")) | (F.col("choice") == F.col("keep"))
    return groups.join(F.broadcast(choices), "group_id", "left").withColumn(
        "survivor", F.when(known, F.col("choice")).otherwise(F.col("keep"))).drop("choice")


def greedy_correlation_filter(
    matrix: np.ndarray, columns: list[str], level: float, totals: np.ndarray | None = None,
) -> list[str]:
    """Columns to drop until no pair is correlated above the level.

    Takes the strongest pair and drops the side with the larger mean |corr| over the
    columns still there (ties: the later column).  `totals` are the sums of |corr| with all
    columns, where the matrix holds only those that may be dropped.
    """
    # Rounded, so that the order of sums on a cluster does not decide between equal pairs.
    strength = np.round(np.abs(np.nan_to_num(matrix, nan=0.0)), 12)
    np.fill_diagonal(strength, 0.0)
    totals = strength.sum(axis=0) if totals is None else totals.copy()
    first, second = np.nonzero(np.triu(strength > level))
    gone: set[int] = set()
    for n in np.argsort(-strength[first, second], kind="stable"):
        a, b = int(first[n]), int(second[n])
        if a in gone or b in gone:
            continue
        # Both means run over the same number of columns, so the totals decide.
        drop = a if totals[a] > totals[b] + 1e-9 else b
        gone.add(drop)
        totals -= strength[drop]
    return [columns[i] for i in sorted(gone)]


def correlated_columns(df: DataFrame, columns: list[str], level: float) -> list[str]:
    """Columns to drop until no pair has |Pearson| above the level, see greedy_correlation_filter().

    Only columns of strong pairs can be dropped: their correlations among each other and the sum
    of each one's with all columns decide.
    """
    if len(columns) <= DENSE_COLUMNS:
        return greedy_correlation_filter(_small_matrix(df, columns), columns, level)
    pairs = pearson_pairs(df, columns).withColumn("size", F.abs("corr"))
    if len(columns) ** 2 <= 2 * UNION_PAIRS:
        place = {c: i for i, c in enumerate(columns)}
        matrix = np.zeros((len(columns), len(columns)))
        for r in pairs.collect():
            matrix[place[r["a"]], place[r["b"]]] = matrix[place[r["b"]], place[r["a"]]] = r["size"]
        return greedy_correlation_filter(matrix, columns, level)
    strong = pairs.filter(F.col("size") > level)
    names = {r["a"] for r in both_directions(strong.select("a", "b")).select("a").distinct().collect()}
    if not names:
        return []
    involved = [c for c in columns if c in names]
    marked = df.sparkSession.createDataFrame([(c,) for c in involved], "name string")
    sums = {r["a"]: r["total"] for r in both_directions(pairs.select("a", "b", "size")).groupBy("a").agg(
        F.sum("size").alias("total")).join(F.broadcast(marked), F.col("a") == F.col("name")).collect()}
    among = pairs.join(F.broadcast(marked), F.col("a") == F.col("name")).drop("name").join(
        F.broadcast(marked), F.col("b") == F.col("name")).select("a", "b", "size").collect()
    place = {c: i for i, c in enumerate(involved)}
    matrix = np.zeros((len(involved), len(involved)))
    for r in among:
        matrix[place[r["a"]], place[r["b"]]] = matrix[place[r["b"]], place[r["a"]]] = r["size"]
    return greedy_correlation_filter(matrix, involved, level, np.array([sums[c] for c in involved]))


def _small_matrix(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Correlations of a few columns in one job; nan for constant ones."""
    numbers = complete_numbers(df, columns)
    if numbers.isEmpty():
        return np.full((len(columns), len(columns)), np.nan)
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(numbers).select("v")
    return Correlation.corr(vectors, "v").first()[0].toArray()


def feature_summary(
    everything: DataFrame, after_cutoff: DataFrame, correlated: DataFrame, final: DataFrame,
) -> DataFrame:
    """What happened to each feature: four labelled lists of `features` in one table."""
    def labelled(names: DataFrame, category: str) -> DataFrame:
        return names.select("features", F.lit(category).alias("category"))

    return (
        labelled(everything, "all_features")
        .unionByName(labelled(everything.subtract(after_cutoff), "dropped_to_retain_samples"))
        .unionByName(labelled(correlated.subtract(final), "dropped_in_correlation"))
        .unionByName(labelled(final, "final_feature_list")))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first whole row of each key in the given order, missing values last, without
    sorting the groups."""
    others = [c for c in df.columns if c not in keys and c not in order]
    first = [x for c in order for x in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]
    best = df.groupBy(*keys).agg(F.min(F.struct(*first, *others)).alias("__best"))
    return best.select(*keys, "__best.*").select(*df.columns)
