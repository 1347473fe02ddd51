"""Hard negatives: score slots between the positives' upper limits, merged from below."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from mergewell.llm.rows import ship
from mergewell.llm.scratch import Scratch

POSITIVES = 5
NEGATIVES = 10
LOWER, UPPER = 30, 90  # percent of the positive's score
SCALE = 256
PASS_BYTES = 1 << 24  # of anchors that are sent to all tasks at once
PASS_ANCHORS = 8192  # at most, whatever their size
TILE_ROWS, TILE_ANCHORS = 2048, 512  # scored at once
PENDING = 1 << 19  # candidates a task holds before it keeps the best of each slot
_LEAST = np.iinfo(np.int64).min

_ROWS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.LongType()), T.StructField("v", T.BinaryType())])
_BEST = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("slot", T.IntegerType()),
    T.StructField("score", T.LongType()), T.StructField("vec_id", T.LongType())])


def whole_numbers(df: DataFrame, vec_id: str, embedding: str, label: Column) -> DataFrame:
    """(vec_id, label, v): vectors of floor(SCALE * component) as bytes, unusable rows left out."""
    ship(df.sparkSession)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     F.col(embedding).cast("array<double>").alias("v")).dropna()

    def work(batches):
        for batch in batches:
            column = batch.column(2)
            size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(all="ignore"):
                values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            bad = ~(np.abs(values) < 2.0**63)  # nan for a null component
            ends = np.cumsum(size)
            before = np.concatenate([[0], np.cumsum(bad)])
            good = before[ends] == before[ends - size]
            with np.errstate(all="ignore"):
                numbers = values.astype(np.int64)
            packed = [numbers[e - s:e].tobytes() for e, s, g in zip(ends, size, good) if g]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(good)) for i in (0, 1)] + [pa.array(packed, pa.binary())],
                names=_ROWS.names)

    return rows.mapInArrow(work, _ROWS)


def scores_of(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products of two integer matrices, as far as they are 64-bit numbers."""
    if not rows.size or not anchors.size:
        return np.zeros((len(rows), len(anchors)), np.int64)
    largest = float(np.abs(rows.astype(np.float64)).max()) * float(np.abs(anchors.astype(np.float64)).max())
    if largest * rows.shape[1] < 2.0**53:  # every partial sum is a whole number that a double holds
        return (rows.astype(np.float64) @ anchors.T.astype(np.float64)).astype(np.int64)
    return rows @ anchors.T


def first_of(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each group: higher scores, then smaller ids, ordered so."""
    order = np.lexsort((vec_id, -score, group))
    ordered = group[order]
    start = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, bool)
    begun = np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begun < k]


def _best_in_slots(rows: DataFrame, anchors: list, limits: list[list[tuple[int, int]]], k: int, same: bool) -> DataFrame:
    """(anchor, slot, score, vec_id): the first k rows of each slot of each anchor.

    anchors: (number, vec_id, label, v).  limits[i]: of anchor i, its slots as (above, up to):
    disjoint, falling.  same: whether rows of the anchor's label count, or those of others.
    A row with the anchor's own id never counts.  Tasks score rows and anchors tile by tile and
    keep the k first of each slot; the best of all tasks are found by one window.
    """
    by_length: dict = {}
    for i, a in enumerate(anchors):
        by_length.setdefault(len(a[3]), []).append(i)
    slots = max([len(x) for x in limits], default=0)
    bounds = np.full((slots, 2, len(anchors)), _LEAST, np.int64)  # (least, least] holds nothing
    for i, one in enumerate(limits):
        for s, (above, up_to) in enumerate(one):
            bounds[s, 0, i], bounds[s, 1, i] = above, up_to
    sent = rows.sparkSession.sparkContext.broadcast((
        [(n, np.array(at), np.frombuffer(b"".join(anchors[i][3] for i in at), np.int64).reshape(len(at), n // 8))
         for n, at in by_length.items()],
        np.array([a[0] for a in anchors], np.int64), np.array([a[1] for a in anchors], np.int64),
        np.array([a[2] for a in anchors], np.int64), bounds))

    def work(batches):
        groups, numbers, ids, labels, bounds = sent.value
        floor = np.full((len(bounds), len(ids)), _LEAST, np.int64)  # the k-th score so far
        kept, pending = (np.zeros(0, np.int64),) * 3, []

        def reduced():
            group, score, vec = (np.concatenate(x) for x in zip(kept, *pending))
            place = first_of(group, score, vec, k)
            group, score, vec = group[place], score[place], vec[place]
            last = np.flatnonzero(np.bincount(group, minlength=1) >= k)
            ends = np.searchsorted(group, last, "right") - 1
            floor[last % len(bounds), last // len(bounds)] = score[ends]
            pending.clear()
            return group, score, vec

        for batch in batches:
            packed = batch.column(2)
            size = pc.binary_length(packed).to_numpy(zero_copy_only=False)
            for length, at, matrix in groups:
                fit = np.flatnonzero(size == length)
                for start in range(0, len(fit), TILE_ROWS):
                    part = fit[start:start + TILE_ROWS]
                    taken = packed.take(pa.array(part)).to_pylist()
                    some = np.frombuffer(b"".join(taken), np.int64).reshape(len(part), length // 8)
                    vec = batch.column(0).to_numpy(zero_copy_only=False)[part]
                    label = batch.column(1).to_numpy(zero_copy_only=False)[part]
                    for first in range(0, len(at), TILE_ANCHORS):
                        a = at[first:first + TILE_ANCHORS]
                        score = scores_of(some, matrix[first:first + TILE_ANCHORS])
                        usable = (label[:, None] == labels[a]) == same
                        usable &= vec[:, None] != ids[a]
                        for s in range(len(bounds)):
                            inside = usable & (score > bounds[s, 0, a]) & (score <= bounds[s, 1, a])
                            inside &= score >= floor[s, a]
                            if inside.sum() > 4 * k * len(a) and len(part) > k:
                                # The k-th score of the tile; what ties with it stays.
                                tried = np.where(inside, score, _LEAST)
                                inside &= score >= np.partition(tried, len(part) - k, axis=0)[len(part) - k]
                            row, column = np.nonzero(inside)
                            if len(row):
                                pending.append((a[column] * len(bounds) + s, score[row, column], vec[row]))
                        if sum(len(x[0]) for x in pending) > PENDING:
                            kept = reduced()
        if pending:
            kept = reduced()
        if len(kept[0]):
            group, score, vec = kept
            yield pa.RecordBatch.from_arrays([
                pa.array(numbers[group // len(bounds)]), pa.array((group % len(bounds)).astype(np.int32)),
                pa.array(score), pa.array(vec)], names=_BEST.names)

    first = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return rows.mapInArrow(work, _BEST).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k)


def limits_of(scores: list[int]) -> list[tuple[int, int]]:
    """Slots (above, up to) from the falling scores of an anchor's positives: each ends at its
    positive's upper limit and reaches down to the next one's, the last to the lowest lower limit."""
    scores = [s for s in scores if s >= 0]  # a negative score has no row between its limits
    upper = [UPPER * s // 100 for s in scores]
    below = upper[1:] + [-(-LOWER * min(scores) // 100) - 1] if scores else []
    return list(zip(below, upper))


def mine(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | str = "label",
    every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by `every`.  Scores are inner products of the
    vectors' whole-numbered components; an anchor's positives are the first rows of its label.
    The negatives of a positive are the first rows of other labels that score LOWER to UPPER
    percent of it; they are found in two passes over the rows for each PASS_BYTES of anchors:

    1. the positives, whose upper limits cut an anchor's scores into disjoint slots;
    2. the first rows of each slot.  The slots of one anchor, in order, are one falling list;
       what a positive may take is its suffix from the positive's own slot on, and of that the
       first `negatives` down to the lower limit.

    Rows with a missing id, label or vector take no part, nor those with a component that is
    null, not finite or beyond a 64-bit number when scaled.  Vectors are compared with those of
    the same length.  Rows with the anchor's id are not its candidates; repeated rows are
    candidates each, repeated anchors are mined each.  Ties go by the smaller id.  Other columns
    are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    label = F.col(label) if isinstance(label, str) else label
    rows = scratch.write(whole_numbers(df, vec_id, embedding, label), "vectors")
    chosen = rows.filter(F.col("vec_id") % every == 0)
    longest = chosen.agg(F.max(F.length("v")).alias("n")).first()["n"]
    batch = max(1, min(PASS_ANCHORS, PASS_BYTES // max(longest or 1, 1)))
    numbered = scratch.write(_numbered(chosen), "anchors")
    folder = scratch.path("mined")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    spark.createDataFrame([], schema).write.parquet(folder)
    for start in range(0, numbered.count(), batch):
        inside = (F.col("number") >= start) & (F.col("number") < start + batch)
        anchors = [tuple(r) for r in numbered.filter(inside).select("number", "vec_id", "label", "v").collect()]
        found = scratch.write(_best_in_slots(
            rows, anchors, [[(_LEAST, np.iinfo(np.int64).max)]] * len(anchors), positives, True), "positives")
        scores: dict = {}
        for r in found.orderBy("anchor", "place").collect():  # a few per anchor of this pass
            scores.setdefault(r["anchor"], []).append(r["score"])
        limits = [limits_of(scores.get(a[0], [])) for a in anchors]
        hard = _best_in_slots(rows, anchors, limits, negatives, False)
        _windows(found, hard, numbered, negatives).write.mode("append").parquet(folder)
        scratch.drop(found)
    return spark.read.schema(schema).parquet(folder)


def _numbered(chosen: DataFrame) -> DataFrame:
    """chosen with number, its place from 0 in the order of ids."""
    placed = chosen.repartitionByRange("vec_id", F.xxhash64("v")).sortWithinPartitions("vec_id", F.xxhash64("v"))
    placed = Scratch(chosen.sparkSession).write(placed.withColumn("__id", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__id", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    # One line per partition.
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return placed.withColumn("__part", part).join(offsets, "__part").withColumn(
        "number", F.col("__offset") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop(
        "__id", "__part", "__offset")


def _windows(found: DataFrame, hard: DataFrame, numbered: DataFrame, negatives: int) -> DataFrame:
    """Suffixes of an anchor's slots for each of its positives."""
    listed = hard.groupBy("anchor").agg(F.sort_array(F.collect_list(
        F.struct("slot", "place", "score", "vec_id"))).alias("listed"))
    positive = found.select(
        "anchor", (F.col("place") - 1).alias("own"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    suffix = positive.join(listed, "anchor").withColumn("suffix", F.expr(
        f"slice(filter(listed, x -> x.slot >= own), 1, {negatives})"))
    rows = suffix.select("anchor", "positive_id", "positive_score", F.posexplode("suffix").alias("at", "x"))
    rows = rows.filter(F.expr(f"x.score >= ceil(CAST({LOWER} AS DECIMAL(5,0)) * positive_score / 100)"))
    return rows.join(numbered.select(F.col("number").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("negative_id"),
        "positive_score", F.col("x.score").alias("negative_score"))
