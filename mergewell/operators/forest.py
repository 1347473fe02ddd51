"""Classification forests grown tree by tree from counts of cells.

A forest compares a feature with BINS - 1 points at most, so rows between the same points of all
features are one cell to it.  Each task draws how often every row of a cell is in a tree's sample, which
for all rows of a cell together is one Poisson number, and grows the tree by itself: no pass over
the rows per level.  Trees are those that Spark grows: Gini gains, `mtry` features drawn per
node, leaves with the same class joined.  A tree depends on the seed and its number only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from mergewell.jobs import ship
from mergewell.lineage import cut_lineage
from mergewell.operators.ranking import sums_below

BINS = 32
SENT_CELLS = 2_000_000  # lines of the table of cells that is sent to all tasks
COUNTED = 2_000_000  # counts of classes by node and bin that are held at the same time
TOO_SMALL = 1e-12  # gains, which are rounding

_TREE = "tree int, feature binary, cut binary, left binary, share binary"


@dataclass(frozen=True)
class Tree:
    """Arrays by node: what a node compares (-1 in leaves), up to which code rows go to `left`, the
    others to the node after it, and the share of the first class."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    share: np.ndarray


@dataclass(frozen=True)
class Forest:
    cuts: list[np.ndarray]  # per feature, increasing
    trees: list[Tree]

    def first_class(self, codes: np.ndarray) -> np.ndarray:
        """Probability of the first class of cells, given as one line of codes per feature."""
        total = np.zeros(codes.shape[1])
        every = np.arange(codes.shape[1], dtype=np.int32)
        for tree in self.trees:
            feature, cut, left = tree.feature.tolist(), tree.cut.tolist(), tree.left.tolist()
            todo = [(0, every)]
            while todo:
                node, those = todo.pop()
                if feature[node] < 0:
                    total[those] += tree.share[node]
                    continue
                low = codes[feature[node]][those] <= cut[node]
                for child, part in ((left[node], those[low]), (left[node] + 1, those[~low])):
                    if len(part):
                        todo.append((child, part))
        return total / len(self.trees)

    def with_first_class(self, df: DataFrame, out: str) -> DataFrame:
        """df, which has `features`, with the probability of the first class."""
        ship(df.sparkSession)
        sent = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def share(x: pd.Series) -> pd.Series:
            forest = sent.value
            if not len(x):
                return pd.Series([], dtype=float)
            cells, place = np.unique(encoded(np.stack(x.to_numpy()), forest.cuts), axis=0, return_inverse=True)
            return pd.Series(forest.first_class(np.ascontiguousarray(cells.T))[place.ravel()])

        return df.withColumn(out, share(vector_to_array("features")))


def encoded(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Each value of a feature (a column) replaced by how many of its cuts it exceeds."""
    return np.column_stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)]).astype(np.uint8)


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A column of arrays of the same length as lines."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


class TreeByTree:
    """Fits a Forest to (features, target); `other` does where rows have more cells than are sent."""

    def __init__(self, other, mtry: int, least: int, trees: int, depth: int, seed: int):
        self.other, self.mtry, self.least = other, mtry, least
        self.trees, self.depth, self.seed = trees, depth, seed

    def fit(self, rows: DataFrame):
        spark = rows.sparkSession
        ship(spark)
        x = rows.select(vector_to_array("features").alias("x"), F.col("target").cast("int").alias("y"))
        cuts = _cuts(x)

        def encode(batches):
            for batch in batches:
                if batch.num_rows:
                    cells = encoded(matrix(batch, "x"), cuts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c.tobytes() for c in cells], pa.binary()), batch.column("y")], names=["cell", "y"])

        counted = cut_lineage(x.mapInArrow(encode, "cell binary, y int").groupBy("cell", "y").agg(
            F.count(F.lit(1)).alias("n")))
        if not 0 < counted.count() <= SENT_CELLS:
            return self.other.fit(rows)
        table = counted.orderBy("cell", "y").toArrow()
        codes = np.frombuffer(b"".join(table.column("cell").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        sent = spark.sparkContext.broadcast((
            np.ascontiguousarray(codes.T), table.column("y").to_numpy().astype(np.int64), table.column("n").to_numpy()))
        mtry, least, depth, seed = self.mtry, self.least, self.depth, self.seed

        def grow(batches):
            for batch in batches:
                for number in batch.column("id").to_pylist():
                    tree = grown(*sent.value, mtry, least, depth, np.random.default_rng([seed, number]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (
                            tree.feature, tree.cut, tree.left, tree.share)]],
                        names=["tree", "feature", "cut", "left", "share"])

        parts = min(self.trees, 4 * spark.sparkContext.defaultParallelism)
        # As many lines as trees; their nodes are the model.
        lines = spark.range(0, self.trees, 1, parts).mapInArrow(grow, _TREE).collect()
        return _compared(cuts, [Tree(*[np.frombuffer(r[c], t) for c, t in (
            ("feature", np.int16), ("cut", np.int16), ("left", np.int32), ("share", np.float64))])
            for r in sorted(lines, key=lambda r: r["tree"])])


def _compared(cuts: list[np.ndarray], trees: list[Tree]) -> Forest:
    """The forest with the cuts that occur in its trees only, so that there are fewer cells."""
    feature, cut = (np.concatenate([getattr(t, c) for t in trees]) for c in ("feature", "cut"))
    used = [np.unique(cut[feature == i]) for i in range(len(cuts))]
    number = np.zeros((len(cuts), BINS), np.int16)
    for i, those in enumerate(used):
        number[i, those] = np.arange(len(those))
    return Forest([c[those] for c, those in zip(cuts, used)], [
        Tree(t.feature, np.where(t.feature < 0, 0, number[t.feature, t.cut]), t.left, t.share) for t in trees])


def _cuts(x: DataFrame) -> list[np.ndarray]:
    """Per feature the values up to which rows go to the left, found as Spark does it, but from all rows:
    all values but the largest if they are BINS at most; else the count of rows up to a value is held
    against multiples of their number divided by BINS, and a value is a cut if with the next one
    the count would be farther from the first multiple that has no cut yet."""
    def count(batches):
        for batch in batches:
            if batch.num_rows:
                parts = [np.unique(v, return_counts=True) for v in matrix(batch, "x").T]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(len(parts), dtype=np.int32), [len(v) for v, _ in parts])),
                     pa.array(np.concatenate([v for v, _ in parts])),
                     pa.array(np.concatenate([n for _, n in parts]).astype(np.int64))], names=["feature", "value", "n"])

    points = cut_lineage(x.mapInArrow(count, "feature int, value double, n long").groupBy("feature", "value").agg(
        F.sum("n").alias("n"), F.lit(1).cast("long").alias("one")))
    # Lines: one per feature, then those of the cuts, fewer than BINS per feature.
    whole = points.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum("one").alias("values"))
    placed = cut_lineage(sums_below(points, ["feature"], "value", ["n", "one"]).withColumnRenamed(
        "one_below", "place").join(F.broadcast(whole), "feature"))
    middle = F.col("n_below") + F.col("n") / 2
    wanted = []
    for r in placed.groupBy("feature").agg(F.first("values").alias("values"), *[
            F.min(F.when((F.col("place") > 0) & (middle > F.col("rows") * k / BINS), F.col("place"))).alias(f"p{k}")
            for k in range(1, BINS)]).collect():
        if r["values"] <= BINS:
            wanted += [(r["feature"], i) for i in range(r["values"] - 1)]
            continue
        last = 0
        for k in range(1, BINS):
            if r[f"p{k}"] is not None and max(last + 1, r[f"p{k}"]) < r["values"]:
                last = max(last + 1, r[f"p{k}"])
                wanted.append((r["feature"], last - 1))
    lines = placed.join(F.broadcast(x.sparkSession.createDataFrame(wanted, "feature int, place long")), [
        "feature", "place"]).select("feature", "value").collect()
    return [np.array(sorted(r["value"] for r in lines if r["feature"] == i)) for i in range(whole.count())]


def grown(codes, y, n, mtry: int, least: int, depth: int, rng: np.random.Generator) -> Tree:
    """One tree from cells: a line of codes per feature, their classes, and how many rows they are."""
    classes, size = int(y.max()) + 1, len(codes)
    bins = int(codes.max()) + 1
    weight = rng.poisson(n).astype(float)
    weight = weight if weight.any() else n.astype(float)
    drawn = np.flatnonzero(weight)
    x, y, weight = codes[:, drawn], y[drawn], weight[drawn]
    place, nodes, levels, above = np.zeros(len(y), np.int64), 1, [], 0
    for level in range(depth + 1):
        held = np.bincount(place * classes + y, weight, nodes * classes).reshape(nodes, classes)
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        if level < depth:
            picked = rng.random((nodes, size)).argsort(1)[:, :mtry]
            step = max(1, COUNTED // (bins * classes))
            for low in range(0, nodes, step):
                own = slice(low, low + step)
                here = slice(None) if nodes <= step else np.flatnonzero((place >= low) & (place < low + step))
                feature[own], cut[own] = _best_cuts(
                    x[:, here], y[here], weight[here], place[here] - low, held[own], picked[own], bins, least)
        open_ = feature >= 0
        above += nodes
        child = np.cumsum(open_) * 2 - 2
        levels.append((feature, cut, np.where(open_, above + child, 0), held))
        if not open_.any():
            break
        stays = open_[place]
        x, y, weight, place = x[:, stays], y[stays], weight[stays], place[stays]
        place = child[place] + (x[feature[place], np.arange(len(place))] > cut[place])
        nodes = 2 * int(open_.sum())
    return _joined(*[np.concatenate(parts) for parts in zip(*levels)], [len(f) for f, *_ in levels])


def _best_cuts(x, y, weight, place, held, picked, bins: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each node the feature, of those picked, and the code at which a cut gains most; -1 if none
    gains or a side would hold fewer than `least`."""
    nodes, classes = held.shape
    rows, lines = held.sum(1), np.arange(len(place))
    feature, cut, best = np.full(nodes, -1), np.zeros(nodes, np.int64), np.full(nodes, TOO_SMALL)
    before = (held**2).sum(1) / rows**2
    for one in picked.T:
        bin_ = place * bins + x[one[place], lines]
        low = np.bincount(bin_ * classes + y, weight, nodes * bins * classes).reshape(
            nodes, bins, classes)[:, :-1].cumsum(1)
        high = held[:, None, :] - low
        n_low, n_high = low.sum(2), high.sum(2)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = ((low**2).sum(2) / n_low + (high**2).sum(2) / n_high) / rows[:, None] - before[:, None]
        gain[(n_low < least) | (n_high < least)] = -1.0
        if not gain.shape[1]:
            break
        at = gain.argmax(1)
        gain = gain[np.arange(nodes), at]
        better = gain > best
        feature[better], cut[better], best[better] = one[better], at[better], gain[better]
    return feature, cut


def _joined(feature, cut, left, held, sizes: list[int]) -> Tree:
    """The tree in which leaves of one parent that name the same class have become one leaf."""
    named = held.argmax(1)
    ends = np.cumsum(sizes)
    for first, end in list(zip(ends - sizes, ends))[::-1]:
        node = np.arange(first, end)[feature[first:end] >= 0]
        a, b = left[node], left[node] + 1
        feature[node[(feature[a] < 0) & (feature[b] < 0) & (named[a] == named[b])]] = -1
    reached = np.zeros(len(feature), bool)
    reached[0] = True
    for first, end in zip(ends - sizes, ends):
        node = np.arange(first, end)[(feature[first:end] >= 0) & reached[first:end]]
        reached[left[node]] = reached[left[node] + 1] = True
    number = np.cumsum(reached) - 1
    left = np.where(feature >= 0, number[left], 0)
    share = held[:, 0] / held.sum(1)
    return Tree(feature[reached].astype(np.int16), cut[reached].astype(np.int16),
                left[reached].astype(np.int32), share[reached])
