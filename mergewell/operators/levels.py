"""Text columns with any number of levels: a table of levels instead of a column for each.

A level is an indicator, 1 where a row has it.  Here indicators stay sparse: `places` has one
line per level, `cells` one per row and text column.  What a column of numbers would be asked
(is it constant, nearly empty, correlated with another?) is answered by counting cells, so nothing
is held in the driver and no column is made until the kept levels become one sparse vector.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from mergewell.lineage import cut_lineage
from mergewell.operators.encoding import with_ones
from mergewell.operators.keys import subject_index
from mergewell.operators.redundancy import connected_components

SLACK = 1e-12  # of a correlation that is compared with a level


@dataclass(frozen=True)
class Levels:
    """places: (place, feature, level, n); cells: (key, place); of `rows` rows in all."""

    key: str
    columns: list[str]
    rows: int
    places: DataFrame
    cells: DataFrame

    def keep(self, kept: DataFrame) -> Levels:
        """Only the levels whose place is in `kept`."""
        wanted = kept.select("place").distinct()
        return Levels(self.key, self.columns, self.rows, cut_lineage(self.places.join(wanted, "place", "left_semi")),
                      cut_lineage(self.cells.join(wanted, "place", "left_semi")))


def _pairs(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, pair): the level of every text column of every row, missing ones left out."""
    cells = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).alias("level")) for i, c in enumerate(columns)])
    return df.select(F.col(key), F.explode(cells).alias("pair")).filter("pair.level IS NOT NULL")


def find_levels(df: DataFrame, key: str, columns: list[str], skip_first: bool = False) -> Levels:
    """The levels of text columns, numbered by column and sort order; skip_first leaves out the
    first of each column, as the reference the others are compared with."""
    pairs = _pairs(df, key, columns)
    counted = cut_lineage(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    places = subject_index(counted, "pair").join(counted, "pair").select(
        (F.col("subject_index") - 1).alias("place"), "pair", "n")
    if skip_first:
        first = counted.groupBy("pair.feature").agg(F.min("pair.level").alias("first"))
        places = places.join(F.broadcast(first), F.col("pair.feature") == F.col("feature")).filter(
            "pair.level > first").drop("feature", "first")
    places = cut_lineage(places)
    cells = cut_lineage(pairs.join(places.select("pair", "place"), "pair").select(key, "place"))
    names = F.array(*[F.lit(c) for c in columns])
    named = places.select(
        "place", F.element_at(names, F.col("pair.feature") + 1).alias("feature"), F.col("pair.level").alias("level"), "n")
    return Levels(key, columns, df.count(), named, cells)


def informative(levels: Levels, near_empty: int | None = 1) -> Levels:
    """Without levels that all rows have, and without those that `near_empty` rows have at most."""
    kept = levels.places.filter(F.col("n") < levels.rows)
    return levels.keep(kept if near_empty is None else kept.filter(F.col("n") > near_empty))


def level_pairs(levels: Levels, least: float) -> DataFrame:
    """(a, b, corr): levels whose indicators have |Pearson| >= least, a before b.

    For 0/1 columns the coefficient follows from three counts, and ranks give the same one.  Rows
    name the pairs that occur together.  Levels that exclude each other reach -least only if one
    of them has a share of least / (1 + least) of all rows: two per column at most, which are
    compared with every level.
    """
    n = levels.rows
    other = levels.cells.withColumnRenamed("place", "b")
    together = levels.cells.withColumnRenamed("place", "a").join(other, levels.key).filter("a < b").groupBy(
        "a", "b").agg(F.count(F.lit(1)).alias("both"))
    sizes = levels.places.select("place", "n")
    heavy = sizes.filter(F.col("n") >= n * least / (1 + least) - 1)
    apart = sizes.select(F.col("place").alias("x")).join(
        F.broadcast(heavy.select(F.col("place").alias("y"))), F.col("x") != F.col("y")).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(0).cast("long").alias("both"))
    counted = together.unionByName(apart).groupBy("a", "b").agg(F.max("both").alias("both"))
    for side in ("a", "b"):
        counted = counted.join(sizes.select(F.col("place").alias(side), F.col("n").cast("double").alias(f"n_{side}")), side)
    corr = F.expr(f"({n}D * both - n_a * n_b) / sqrt(n_a * ({n}D - n_a) * n_b * ({n}D - n_b))")
    return counted.withColumn("corr", corr).filter(F.abs("corr") >= least - SLACK).select("a", "b", "corr")


def pairs_with_numbers(levels: Levels, numbers: DataFrame, columns: list[str], least: float) -> DataFrame:
    """(feature, place, corr): levels whose indicators have |Pearson| >= least with one of the
    columns of `numbers`, which has the key and no gaps.  Ranks give Spearman's coefficient."""
    schema = "feature string, place long, corr double"
    if not columns:
        return numbers.sparkSession.createDataFrame([], schema)
    n = levels.rows
    # One line, two numbers per column.
    whole = numbers.agg(*[f(F.col(c).cast("double")).alias(f"{name}{i}") for i, c in enumerate(columns)
                          for name, f in (("mean", F.avg), ("dev", F.stddev_pop))]).first()
    usable = [i for i in range(len(columns)) if whole[f"dev{i}"]]
    if not usable:
        return numbers.sparkSession.createDataFrame([], schema)
    centred = numbers.select(levels.key, *[
        ((F.col(columns[i]).cast("double") - whole[f"mean{i}"]) / whole[f"dev{i}"]).alias(f"z{i}") for i in usable])
    sums = levels.cells.join(centred, levels.key).groupBy("place").agg(*[F.sum(f"z{i}").alias(f"z{i}") for i in usable])
    size = F.col("n").cast("double")
    found = sums.join(levels.places.select("place", "n"), "place").withColumn("scale", F.sqrt(size * (n - size)))
    cells = F.array(*[F.struct(F.lit(columns[i]).alias("feature"), (F.col(f"z{i}") / F.col("scale")).alias("corr"))
                      for i in usable])
    return found.select("place", F.explode(cells).alias("c")).select("c.feature", "place", "c.corr").filter(
        F.abs("corr") >= least - 1e-9)


def keep_uncorrelated(
    levels: Levels, numbers: DataFrame, columns: list[str], least: float, pairs: DataFrame | None = None,
) -> tuple[Levels, list[tuple[str, str]]]:
    """One level of each group of correlated ones stays, the first; none that a column of numbers
    stands for.  Also the links between columns that levels make: (first, other) of each group.

    pairs: correlated columns (a, b) among each other.
    """
    order = {c: f"{i:09d}" for i, c in enumerate(columns)}
    level = lambda c: F.concat(F.lit("level"), F.lpad(F.col(c).cast("string"), 19, "0"))
    mixed = pairs_with_numbers(levels, numbers, columns, least)
    edges = level_pairs(levels, least).select(level("a").alias("a"), level("b").alias("b"))
    names = levels.cells.sparkSession.createDataFrame(list(order.items()), "name string, number string")
    named = mixed.join(F.broadcast(names), F.col("feature") == F.col("name")).select(
        F.col("number").alias("a"), level("place").alias("b"))
    edges = cut_lineage(edges.unionByName(named))
    if edges.isEmpty():
        return levels, []
    if pairs is not None:
        both = pairs.select("a", "b")
        for side in ("a", "b"):
            both = both.join(F.broadcast(names), F.col(side) == F.col("name")).drop(side, "name").withColumnRenamed(
                "number", side)
        edges = edges.unionByName(both.select("a", "b"))
    grouped = connected_components(edges)  # numbers of columns come before levels
    gone = grouped.filter("node LIKE 'level%' AND component < node").select(
        F.expr("CAST(substring(node, 6) AS LONG)").alias("place"))
    kept = levels.keep(levels.places.join(gone, "place", "left_anti"))
    # Columns of one group: at most one line per column.
    back = {number: c for c, number in order.items()}
    links = grouped.filter("node NOT LIKE 'level%' AND component < node").collect()
    return kept, sorted((back[r["component"]], back[r["node"]]) for r in links)


def numbered(levels: Levels) -> DataFrame:
    """(feature, level, number): kept levels of each column, from 0 without gaps."""
    placed = levels.places.join(subject_index(levels.places, "place"), "place")
    first = placed.groupBy("feature").agg(F.min("subject_index").alias("first"))  # a line per column
    return cut_lineage(placed.join(F.broadcast(first), "feature").select(
        "feature", "level", (F.col("subject_index") - F.col("first")).alias("number")))


def sizes_of(entries: DataFrame) -> dict[str, int]:
    """Number of kept levels per column."""
    return {r["feature"]: r["count"] for r in entries.groupBy("feature").count().collect()}


def as_vector(df: DataFrame, columns: list[str], entries: DataFrame, sizes: dict[str, int], out: str) -> DataFrame:
    """df with its text columns replaced by one sparse vector: that of the numbered entries of each
    column, one after the other.  A column without kept levels only disappears; without any entry
    there is no vector.

    A vector holds one number per text column, whatever its size.  Places are found by joins.
    """
    made, parts, before = df, [], 0
    for i, c in enumerate(columns):
        if not sizes.get(c, 0):
            continue
        own = entries.filter(F.col("feature") == c).select(
            F.col("level").alias("__level"), (F.col("number") + before).alias(f"__part{i}"))
        made = made.join(own, F.col(c) == F.col("__level"), "left").drop("__level")
        parts.append(f"__part{i}")
        before += sizes[c]
    made = made.drop(*columns)
    return with_ones(made, parts, before, out) if parts else made


def entry_names(columns: list[str], entries: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(index, feature, level) of the entries of the vector that as_vector makes."""
    start, before = [], 0
    for c in columns:
        start.append((c, before))
        before += sizes.get(c, 0)
    offsets = entries.sparkSession.createDataFrame(start, "feature string, start long")
    return entries.join(F.broadcast(offsets), "feature").select(
        (F.col("number") + F.col("start")).alias("index"), "feature", "level")
