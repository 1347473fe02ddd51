"""Pairwise correlations of columns as lists of pairs."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from mergewell.lineage import cut_lineage, spread
from mergewell.operators.columns import scan

PAIRS = "a string, b string, corr double"
# Columns of a block; a task holds the products of one block with all that follow.
BLOCK = 500
STRIP = 32  # lines of a product of two blocks that are summed in one place
# Cells of one column that one task may sort.
ROWS_PER_BUCKET = 100_000
CELLS_PER_BLOCK = 1_000_000  # of the rows that travel together, 8 bytes each
# A column with up to so many values is ranked by a table of its values, which is sent to the rows;
# up to so many values of all columns (16 bytes each).
FEW_VALUES = 50_000
SENT_VALUES = 2_000_000
VALUES_SHARE = 64  # of the hashes of values one is looked at to estimate their number


def complete_numbers(df: DataFrame, columns: list[str], keep: str | None = None) -> DataFrame:
    """The columns as DOUBLE, rows with a gap removed."""
    return df.select(*([keep] if keep else []), *[F.col(c).cast("double").alias(c) for c in columns]).na.drop()


def pearson_pairs(df: DataFrame, columns: list[str], threshold: float | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns over the complete rows.

    One row per pair, `a` before `b` in column order.  Constant columns have no pairs.
    With a threshold only pairs with |corr| above it are returned.

    Tasks add up products of standardised columns block by block, strips of the blocks are summed
    by key and become pairs where they are: the driver sees two numbers per column.
    """
    spark = df.sparkSession
    if len(columns) < 2:
        return spark.createDataFrame([], PAIRS)
    numbers = complete_numbers(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = scan(numbers, {"": F.count(F.lit(1)), **{
            (c, k): f(F.col(c)) for c in columns for k, f in (
                ("mean", F.avg), ("dev", F.stddev_pop), ("low", F.min), ("high", F.max))}})
        rows = found[""]
        usable = [c for c in columns if rows and found[c, "low"] < found[c, "high"] and np.isfinite(found[c, "dev"])]
        blocks = [usable[i:i + BLOCK] for i in range(0, len(usable), BLOCK)]
        parts = [_block_row(numbers, blocks, i, found, rows, -1.0 if threshold is None else threshold)
                 for i in range(len(blocks))]
        return cut_lineage(reduce(DataFrame.unionByName, parts)) if parts else spark.createDataFrame([], PAIRS)
    finally:
        numbers.unpersist()


_STRIP = T.StructType([T.StructField("j", T.IntegerType()), T.StructField("strip", T.IntegerType()),
                       T.StructField("sums", T.BinaryType())])


def _block_row(numbers: DataFrame, blocks: list[list[str]], i: int, found: dict, rows: int, threshold: float) -> DataFrame:
    """Pairs of the columns of block i with those of the blocks from i on."""
    ahead = [c for b in blocks[i:] for c in b]
    mean = np.array([found[c, "mean"] for c in ahead])
    dev = np.array([found[c, "dev"] for c in ahead])
    own, sizes = blocks[i], [len(b) for b in blocks[i:]]
    starts = np.concatenate([[0], np.cumsum(sizes)]).tolist()

    def products(batches):
        sums = None
        for batch in batches:
            z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            z = (z - mean) / dev
            part = z[:, :len(own)].T @ z
            sums = part if sums is None else sums + part
        if sums is not None:
            for j in range(len(sizes)):
                block = sums[:, starts[j]:starts[j + 1]]
                for strip in range(0, len(own), STRIP):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([j], pa.int32()), pa.array([strip], pa.int32()),
                         pa.array([block[strip:strip + STRIP].tobytes()], pa.binary())], names=_STRIP.names)

    def summed(key, table):
        j, strip = (k.as_py() for k in key)
        total = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
        corr = np.clip(total.reshape(-1, sizes[j]) / rows, -1.0, 1.0)
        strong = np.abs(corr) > threshold
        if j == 0:  # pairs within the block
            strong &= np.arange(sizes[0])[None, :] > strip + np.arange(len(corr))[:, None]
        r, c = np.nonzero(strong)
        return pa.table({"a": pa.array([own[strip + x] for x in r], pa.string()),
                         "b": pa.array([ahead[starts[j] + x] for x in c], pa.string()),
                         "corr": pa.array(corr[r, c], pa.float64())})

    strips = numbers.select(*ahead).mapInArrow(products, _STRIP)
    return strips.groupBy("j", "strip").applyInArrow(summed, PAIRS)


def spearman_pairs(df: DataFrame, columns: list[str], threshold: float | None = None) -> DataFrame:
    """Spearman correlation of every pair: Pearson over average ranks of the complete rows."""
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], PAIRS)
    return pearson_pairs(rank_columns(df, columns), columns, threshold)


def rank_columns(df: DataFrame, columns: list[str], keep: str | None = None) -> DataFrame:
    """The complete rows with every column replaced by its average ranks; `keep` names a key
    of the rows that stays beside them.

    Rows travel in blocks of columns.  The ranks of a column with about FEW_VALUES at most follow
    from the counts of its values, and no block is moved for them.  The cells of other columns are
    cut at approximate quantiles into ordered buckets, one per ROWS_PER_BUCKET rows, which may be
    ranked in separate tasks; exact bucket counts give each bucket's offset.
    """
    numbers = complete_numbers(df, columns, keep)
    schema = numbers.schema
    # The checkpoint keeps a block's rows together and its number fixed.
    blocks = spread(cut_lineage(_blocks(numbers, keep).withColumn(
        "__block", F.monotonically_increasing_id())))
    rows, found = _value_estimates(blocks, columns)
    few, sent = [], 0
    for c in sorted(columns, key=found.get):
        sent += found[c]
        if found[c] <= FEW_VALUES and sent <= SENT_VALUES:
            few.append(c)
    many = [c for c in columns if c not in few]
    tables = df.sparkSession.sparkContext.broadcast(_value_ranks(blocks, few))

    def ranks(cells, c):
        values, ranks = tables.value[c]
        return ranks[np.searchsorted(values, np.frombuffer(cells))]

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([
                    batch.column(c).slice(i, 1).flatten() if c == keep else pa.array(ranks(batch.column(c)[i].as_py(), c))
                    for c in schema.names], names=schema.names)

    ranked = _ranked_by_sorting(blocks, many, keep, rows, schema, ranks) if many else blocks.mapInArrow(unpack, schema)
    return ranked.select(*([keep] if keep else []), *columns)


def _value_estimates(blocks: DataFrame, columns: list[str]) -> tuple[int, dict[str, int]]:
    """The number of rows, and of each column's different values nearly: those of one in
    VALUES_SHARE hashes are counted."""
    def sample(batches):
        rows = 0
        for batch in batches:
            picked = []
            for c in columns:
                values = np.frombuffer(b"".join(batch.column(c).to_pylist()))
                picked.append(np.unique(values[pd.util.hash_array(values) % VALUES_SHARE == 0]))
            rows += len(values)
            yield _lines(value=picked)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([float(rows)])], names=["feature", "value"])

    found = {r["feature"]: r for r in blocks.select(*columns).mapInArrow(
        sample, "feature int, value double").groupBy("feature").agg(
            F.count_distinct("value").alias("values"), F.sum("value").alias("sum")).collect()}
    return int(found[-1]["sum"]) if found else 0, {
        c: VALUES_SHARE * found[i]["values"] if i in found else 0 for i, c in enumerate(columns)}


def _value_ranks(blocks: DataFrame, columns: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The values of columns of few values and their ranks, which follow from the counts."""
    if not columns:
        return {}

    def count(batches):
        held = [(np.array([]), np.array([]))] * len(columns)
        for batch in batches:
            for i, c in enumerate(columns):
                for cells in batch.column(c).to_pylist():
                    values, n = np.unique(np.frombuffer(cells), return_counts=True)
                    values, place = np.unique(np.concatenate([held[i][0], values]), return_inverse=True)
                    held[i] = values, np.bincount(place, np.concatenate([held[i][1], n]))
        yield _lines(value=[values for values, _ in held], n=[n.astype(np.int64) for _, n in held])

    counts = blocks.select(*columns).mapInArrow(count, "feature int, value double, n long").groupBy(
        "feature", "value").agg(F.sum("n").alias("n")).toArrow()  # SENT_VALUES lines, as far as the estimate is right
    feature, value, n = (counts.column(c).to_numpy() for c in ("feature", "value", "n"))
    order = np.lexsort((value, feature))
    feature, value, n = feature[order], value[order], n[order]
    tables = {}
    for i, c in enumerate(columns):
        own = feature == i
        tables[c] = (value[own], np.cumsum(n[own]) - (n[own] - 1) / 2)
    return tables


def _ranked_by_sorting(blocks: DataFrame, columns: list[str], keep: str | None, rows: int,
                       schema: T.StructType, others) -> DataFrame:
    """The rows with `columns` replaced by their ranks, which come from ordered buckets, and the
    other columns by what `others` says.

    A block sends each bucket its different values and their counts, so a value that fills a
    bucket is one of them per block, and gets their ranks back in this order.
    """
    cuts = _bucket_cuts(blocks, columns, max(1, rows // ROWS_PER_BUCKET))
    offsets = _bucket_offsets(blocks, columns, cuts)

    def cut(batches):
        for batch in batches:
            for block in batch.to_pylist():
                lines = []
                for i, c in enumerate(columns):
                    values, n = np.unique(np.frombuffer(block[c]), return_counts=True)
                    n, edges = n.astype(np.int32), _edges(values, cuts[i])
                    for b in np.flatnonzero(np.diff(edges)):
                        span = slice(edges[b], edges[b + 1])
                        lines.append((i, b, block["__block"], values[span].tobytes(), n[span].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*lines), (
                        pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=_CELLS.names)

    def rank(key, table):
        feature, bucket = (k.as_py() for k in key)
        cells = table.column("cells").to_pylist()
        values, place = np.unique(np.frombuffer(b"".join(cells)), return_inverse=True)
        n = np.bincount(place, np.frombuffer(b"".join(table.column("n").to_pylist()), np.int32))
        ranks = (offsets[feature][bucket] + np.cumsum(n) - (n - 1) / 2)[place]
        ends = np.cumsum([len(x) // 8 for x in cells])
        return pa.table({"__block": table.column("__block"), "feature": table.column("feature"),
                         "bucket": table.column("bucket"),
                         "ranks": pa.array([x.tobytes() for x in np.split(ranks, ends[:-1])], pa.binary())})

    def back(left, right):
        found = {c: [] for c in columns}
        for feature, _, ranks in sorted(zip(*(right.column(c).to_pylist() for c in ("feature", "bucket", "ranks")))):
            found[columns[feature]].append(ranks)
        out = {}
        for c in schema.names:
            if c == keep:
                out[c] = left.column(c).combine_chunks().flatten()
            elif c in found:
                _, place = np.unique(np.frombuffer(left.column(c)[0].as_py()), return_inverse=True)
                out[c] = pa.array(np.frombuffer(b"".join(found[c]))[place])
            else:
                out[c] = pa.array(others(left.column(c)[0].as_py(), c))
        return pa.table(out)

    ranked = blocks.select("__block", *columns).mapInArrow(cut, _CELLS).groupBy("feature", "bucket").applyInArrow(
        rank, "__block long, feature int, bucket int, ranks binary")
    return blocks.groupBy("__block").cogroup(ranked.groupBy("__block")).applyInArrow(back, schema)


_CELLS = T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                       T.StructField("__block", T.LongType()), T.StructField("cells", T.BinaryType()),
                       T.StructField("n", T.BinaryType())])


def _blocks(numbers: DataFrame, keep: str | None) -> DataFrame:
    """A line per CELLS_PER_BLOCK cells: the rows' doubles of a column as bytes, their keys as a list."""
    size = max(1, CELLS_PER_BLOCK // len(numbers.columns))
    schema = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType) if f.name == keep else T.BinaryType())
                           for f in numbers.schema])

    def packed(parts):
        table = pa.Table.from_batches(parts).combine_chunks()
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column(c).chunk(0))
            if c == keep else pa.array([table.column(c).to_numpy().tobytes()], pa.binary())
            for c in table.column_names], names=table.column_names)

    def pack(batches):
        parts, held = [], 0
        for batch in batches:
            while batch.num_rows:
                parts.append(batch.slice(0, size - held))
                held += parts[-1].num_rows
                batch = batch.slice(parts[-1].num_rows)
                if held == size:
                    yield packed(parts)
                    parts, held = [], 0
        if parts:
            yield packed(parts)

    return numbers.mapInArrow(pack, schema)


def _lines(**parts: list[np.ndarray]) -> pa.RecordBatch:
    """One array per feature as lines that begin with the feature's number."""
    sizes = [len(x) for x in next(iter(parts.values()))]
    feature = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    return pa.RecordBatch.from_arrays([pa.array(feature), *[pa.array(np.concatenate(x)) for x in parts.values()]],
                                      names=["feature", *parts])


def _edges(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where the buckets begin and end in sorted values; they are closed on the left."""
    return np.concatenate([[0], np.searchsorted(values, cuts), [len(values)]])


def _bucket_cuts(blocks: DataFrame, columns: list[str], wanted: int) -> list[np.ndarray]:
    """Increasing cut points per column, near its quantiles: each block names every so manieth of
    its sorted values, from a place that differs by block.  `wanted` numbers per column."""
    if wanted == 1:
        return [np.array([]) for _ in columns]
    step = max(1, ROWS_PER_BUCKET // 100)

    def sample(batches):
        for batch in batches:
            for block in batch.to_pylist():
                first = np.random.default_rng(block["__block"]).integers(step)
                yield _lines(value=[np.sort(np.frombuffer(block[c]))[first::step] for c in columns])

    steps = [i / wanted for i in range(1, wanted)]
    found = blocks.select("__block", *columns).mapInArrow(sample, "feature int, value double").groupBy("feature").agg(
        F.percentile_approx("value", steps, max(1000, 10 * wanted)).alias("cuts")).collect()
    cuts = {r["feature"]: r["cuts"] for r in found}
    return [np.unique(np.array(cuts.get(i, []), float)) for i in range(len(columns))]


def _bucket_offsets(blocks: DataFrame, columns: list[str], cuts: list[np.ndarray]) -> list[np.ndarray]:
    """Per column the number of cells before each bucket; `cuts` and one number more."""
    def count(batches):
        sizes = [np.zeros(len(x) + 1, np.int64) for x in cuts]
        for batch in batches:
            for block in batch.to_pylist():
                for i, c in enumerate(columns):
                    sizes[i] += np.diff(_edges(np.sort(np.frombuffer(block[c])), cuts[i]))
        yield _lines(bucket=[np.arange(len(n), dtype=np.int32) for n in sizes], n=sizes)

    totals = [np.zeros(len(x) + 1, np.int64) for x in cuts]
    for r in blocks.select(*columns).mapInArrow(count, "feature int, bucket int, n long").groupBy(
            "feature", "bucket").agg(F.sum("n").alias("n")).collect():
        totals[r["feature"]][r["bucket"]] = r["n"]
    return [np.cumsum(n) - n for n in totals]


def pairs_with_gaps(pairs: DataFrame, gaps: DataFrame) -> DataFrame:
    """Pairs with the NA counts of both sides (`na_a`, `na_b`).

    `gaps` has one row per column of the table, which bounds the broadcast.
    """
    counts = F.broadcast(gaps.select("feature", "na_count"))
    for side in ("a", "b"):
        pairs = pairs.join(
            counts.withColumnsRenamed({"feature": side, "na_count": f"na_{side}"}), side)
    return pairs


def both_directions(pairs: DataFrame) -> DataFrame:
    others = [c for c in pairs.columns if c not in ("a", "b", "na_a", "na_b")]
    swap = {"a": "b", "b": "a", "na_a": "na_b", "na_b": "na_a"}
    turned = pairs.select(
        *[F.col(swap[c]).alias(c) for c in pairs.columns if c in swap], *others)
    return pairs.unionByName(turned)


def partner_counts(pairs: DataFrame) -> DataFrame:
    """Number of correlated partners per feature."""
    return both_directions(pairs.select("a", "b")).groupBy("a").agg(
        F.count(F.lit(1)).alias("partners")).withColumnRenamed("a", "feature")


def strong_pairs_report(df: DataFrame, columns: list[str], level: float) -> DataFrame:
    """|Pearson| of already grouped features, weak entries left out."""
    return pearson_pairs(df, columns).withColumn("corr", F.abs("corr")).filter(
        F.col("corr") >= level - 1e-6)

