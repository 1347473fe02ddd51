"""How far the sources of a language diverge: a frequent-pattern tree of term rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from mergewell.llm.rows import SLICE, ship
from mergewell.llm.scratch import Scratch

LEAST_DOCUMENTS = 10  # of its language that hold a term
TOP_TERMS = 10
SCALE = 1_000_000_000  # of the integer frequencies
HELD_TERMS = 400_000  # counters that a task holds before it passes them on
PIECE = 1 << 22  # bytes of a text that are split into words at once
SALTS = 32  # places among which the frequencies of one language are dealt out
DENSE = 1 << 22  # sums of group pairs that a task keeps in one array

#: Bytes that are no part of a term become blanks, A-Z lower case; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTED = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("term", T.StringType()), T.StructField("n", T.LongType()), T.StructField("docs", T.LongType())])


def terms_of(text: bytes):
    """Lists of the terms of a UTF-8 text, piece by piece."""
    folded = text.translate(_FOLD)
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def _counted(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, added up within each task."""
    ship(df.sparkSession)

    def work(batches):
        held: dict = {}

        def passed_on():
            for (lang, source), (n, docs) in held.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                    pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                    pa.array([docs[t] for t in n], pa.int64())], names=_COUNTED.names)
            held.clear()

        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                texts = batch.column(2).cast(pa.binary()).to_pylist()
                for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                    n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                    seen: set = set()
                    for words in terms_of(text):
                        n.update(words)
                        seen.update(words)
                    docs.update(seen)
                if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                    yield from passed_on()
        yield from passed_on()

    parts = df.mapInArrow(work, _COUNTED)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def frequency(n: str, total: str, size: str):
    """1 + floor(SCALE * (n + 2) / (total + 2 * size)), exact; 1 without terms."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))) div "
        f"CAST(greatest({total} + 2 * {size}, 1) AS DECIMAL(20,0))")


def distance(p: str, q: str):
    """floor((p - q)^2 / (p + q)) of two frequencies."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


_CORRECTED = T.StructType([
    T.StructField("g", T.LongType()), T.StructField("h", T.LongType()), T.StructField("value", T.LongType())])


def tree_corrections(group: np.ndarray, p: np.ndarray, p0: np.ndarray, size: np.ndarray, times: np.ndarray):
    """(g, h, value) summed over the tree of sorted rows.

    Line i of the padded matrices is a path of size[i] nodes (group, p), p0 being the group's
    frequency of absent terms; times[i] terms have it.  A node is shared by all neighbouring
    lines with the same path down to it, its multiplicity is the sum of theirs, and it meets
    each of its ancestors once.
    """
    lines, depth = group.shape
    place = np.arange(depth)
    real = place < size[:, None]
    shared = np.zeros((lines, depth), bool)
    shared[1:] = (group[1:] == group[:-1]) & (p[1:] == p[:-1]) & real[1:] & real[:-1]
    shared = np.logical_and.accumulate(shared, 1)
    owner = np.maximum.accumulate(np.where(shared, 0, np.arange(lines)[:, None]), 0)
    names, local = np.unique(group[real], return_inverse=True)
    index = np.zeros((lines, depth), np.int64)
    index[real] = local
    width = len(names)
    dense = np.zeros(width * width, np.int64) if width * width <= DENSE else None
    sums: dict = {}
    square = lambda a, b: (a - b) * (a - b) // (a + b)
    for d in range(1, depth):
        here = np.flatnonzero(real[:, d])
        if not len(here):
            break
        count = np.zeros(lines, np.int64)
        np.add.at(count, owner[here, d], times[here])
        node = here[~shared[here, d]]
        up, up0 = p[node, :d], p0[node, :d]
        own, own0 = p[node, d:d + 1], p0[node, d:d + 1]
        value = count[node, None] * (
            square(up, own) - square(up, own0) - square(up0, own) + square(up0, own0))
        code = index[node, :d] * width + index[node, d:d + 1]
        if dense is not None:
            np.add.at(dense, code.ravel(), value.ravel())
        else:
            keys, where = np.unique(code, return_inverse=True)
            part = np.zeros(len(keys), np.int64)
            np.add.at(part, where.ravel(), value.ravel())
            for k, v in zip(keys.tolist(), part.tolist()):
                sums[k] = sums.get(k, 0) + v
    if dense is not None:
        keys = np.flatnonzero(dense)
        found = dense[keys]
    else:
        keys, found = np.array(list(sums), np.int64), np.array(list(sums.values()), np.int64)
    return names[keys // max(width, 1)], names[keys % max(width, 1)], found


def _corrections(paths: DataFrame) -> DataFrame:
    """Corrections of all paths: rows in the order of a walk through the tree, cut among tasks."""

    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                column = part.column(0)
                size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                items = column.flatten()
                real = np.arange(size.max()) < size[:, None]
                fields = []
                for name in ("g", "p", "p0"):
                    matrix = np.zeros(real.shape, np.int64)
                    matrix[real] = items.field(name).to_numpy(zero_copy_only=False)
                    fields.append(matrix)
                g, h, value = tree_corrections(*fields, size, part.column(1).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g, pa.int64()), pa.array(h, pa.int64()), pa.array(value, pa.int64())],
                    names=_CORRECTED.names)

    ordered = paths.repartitionByRange("path").sortWithinPartitions("path")
    return ordered.mapInArrow(work, _CORRECTED)


def divergence(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) of df.

    Terms are runs of letters (A-Z in lower case) and characters beyond ASCII; a language keeps
    those in at least LEAST_DOCUMENTS of its documents.  Part `pair` compares a source with each
    other one of its language by the sum of (p - q)^2 / (p + q) over all kept terms, part `term`
    lists the TOP_TERMS terms that are more frequent in it than in its language.

    1. A task adds up its terms before anything is shuffled; one window per (lang, term) finds
       the kept ones.
    2. The row of a term is its path: the sources that hold it, in order, with their frequencies.
       Equal paths become one with a multiplicity.  Sorted paths are a walk through the tree, so
       a task builds its nodes from neighbouring rows; a node cut by the edge between two tasks
       counts in both with its share of the multiplicity, which leaves sums as they are.
    3. If all other sources lacked the term, a pair would get what the histogram of a source's
       frequencies gives against the other's frequency of absent terms; each node corrects that
       once with each of its ancestors.

    Missing lang, source and text count as ''.  Groups without kept terms have pairs of value 0.
    Repeated rows count each time, very long texts are counted piece by piece, ties go by the
    bytes of the item, columns of other names are ignored, an empty table gives no rows.  The
    result has one row per ordered pair of a language's sources, so the number of sources has to
    be one whose square can be written.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                       for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = scratch.write(_counted(rows), "counted")
    term = W.partitionBy("lang", "term")
    cells = scratch.write(
        counted.withColumns({
            "spread": F.sum("docs").over(term), "everywhere": F.sum("n").over(term),
            "first": (F.row_number().over(term.orderBy("source")) == 1).cast("long")})
        .filter(F.col("spread") >= LEAST_DOCUMENTS).drop("docs", "spread"), "cells")
    scratch.drop(counted)

    langs = cells.groupBy("lang").agg(F.sum("first").alias("v"), F.sum("n").alias("lang_n"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("held"))
    groups = scratch.write(
        rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["v", "lang_n", "group_n", "held"])
        .withColumn("p0", frequency("0", "group_n", "v"))
        .repartitionByRange("lang", "source").sortWithinPartitions("lang", "source")
        .withColumn("g", F.monotonically_increasing_id()), "groups")
    placed = scratch.write(
        cells.join(groups.select("lang", "source", "g", "v", "lang_n", "group_n", "p0"), ["lang", "source"])
        .withColumns({"p": frequency("n", "group_n", "v"), "q": frequency("everywhere", "lang_n", "v")})
        .select("lang", "source", "term", "g", "p", "p0", "q"), "placed")
    scratch.drop(cells)

    more = placed.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance("p", "q").alias("value"))
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = more.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= TOP_TERMS)

    absent = groups.select("lang", "g", "p0", F.col("p0").alias("p"), (F.col("v") - F.col("held")).alias("times"),
                           F.col("v").alias("all"))
    present = placed.groupBy("lang", "g", "p0", "p").agg(F.count(F.lit(1)).alias("times"))
    histogram = absent.unionByName(present.withColumn("all", F.lit(None).cast("long"))).withColumn(
        "salt", F.pmod(F.xxhash64("g", "p"), F.lit(SALTS)))
    others = groups.select(
        "lang", F.col("g").alias("h"), F.col("p0").alias("h0"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    # Terms that both lack are in both histograms: one of the two is taken back.
    twice = F.when(F.col("g") < F.col("h"), F.coalesce("all", F.lit(0))).otherwise(0) * distance("p0", "h0")
    single = histogram.join(others, ["lang", "salt"]).filter("g <> h").groupBy("g", "h").agg(
        F.sum(F.col("times") * distance("p", "h0") - twice).alias("value"))

    paths = placed.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("g", "p", "p0"))).alias("path"))
    paths = scratch.write(
        paths.groupBy("path").agg(F.count(F.lit(1)).alias("times")).filter(F.size("path") > 1), "paths")
    half = single.unionByName(_corrections(paths))
    swapped = half.select(F.col("h").alias("g"), F.col("g").alias("h"), "value")
    sums = half.unionByName(swapped).groupBy("g", "h").agg(F.sum("value").alias("value"))
    named = groups.select("g", "lang", "source")
    other = groups.select(F.col("g").alias("h"), F.col("source").alias("item"))
    pairs = sums.join(named, "g").join(other, "h").select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(top)
