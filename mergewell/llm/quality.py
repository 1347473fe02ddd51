"""Quality rules: text statistics, and outliers by minimum covariance determinant."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mergewell.lineage import cut_lineage
from mergewell.llm.rows import with_computed
from mergewell.llm.words import WordHashes, Windows

SYMBOLS = b"#*$%&|<>"
BLANKS = b"\t\n\x0b\x0c\r "
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5

# One axis per statistic of the vector: smallest value, largest value and grid cells between
# them.  The product of the cells bounds what one group can ever hold.
AXES = {
    "word_length": (0.0, 4.0, 32),
    "symbols": (0.0, 2.5, 20),
    "dup_lines": (0.0, 5.0, 10),
    "repeats": (0.0, 1.0, 10),
}
#: Smallest standard deviation of each axis: differences below it say nothing about quality.
RESOLUTION = np.array([0.08, 0.12, 0.35, 0.12])
ENOUGH = 5 * len(AXES)  # rows of a group that is judged by its own estimate alone
SHARE = 0.75  # rows that the minimum-determinant subset holds
CUTOFF = 20.0  # squared Mahalanobis distance; 4 normal statistics exceed it once in 2000


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the counts of STATISTICS for each whole text; zeros for a missing one."""
    fields = [T.StructField(name, T.LongType()) for name in STATISTICS]
    return with_computed(df, [text], fields, lambda: _Counter().row)


class _Counter:
    def __init__(self):
        self.hashes = WordHashes()

    def row(self, text: str | None) -> tuple[int, ...]:
        if not text:
            return (0,) * len(STATISTICS)
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()
        lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
        return (len(words),
                len(text) - (len(raw) - len(raw.translate(None, BLANKS))),
                len(raw) - len(raw.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)),
                self.repeated(words))

    def repeated(self, words: list[bytes]) -> int:
        """Words in windows of five that occur twice or more."""
        if len(words) <= WINDOW:
            return 0
        grams = Windows(self.hashes.of(words)).of(WINDOW)
        ordered = np.sort(grams)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        # Equal hashes only propose; the words themselves decide.
        places = np.flatnonzero(np.isin(grams, twice)).tolist()
        windows = [tuple(words[p:p + WINDOW]) for p in places]
        count = Counter(windows)
        covered = np.zeros(len(words) + 1, np.int64)
        hits = np.array([p for p, w in zip(places, windows) if count[w] > 1], np.int64)
        np.add.at(covered, hits, 1)
        np.add.at(covered, hits + WINDOW, -1)
        return int((np.cumsum(covered) > 0).sum())


def base_failed() -> Column:
    """Fewer than 10 words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vector() -> list[Column]:
    """Transformed statistics: logarithm of the mean word length, square roots of rates."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
            F.sqrt(F.col("n_symbols") / words),
            F.log1p(F.col("n_dup_lines").cast("double")),
            F.sqrt(F.col("n_repeat_words") / words)]


def _parameters(matrix: str) -> T.StructType:
    return T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("rows", T.LongType()), T.StructField("center", T.ArrayType(T.DoubleType())),
        T.StructField(matrix, T.ArrayType(T.DoubleType()))])


_FITTED, _BLENDED = _parameters("covariance"), _parameters("precision")


def covariance_determinant(weight: np.ndarray, sums: np.ndarray, squares: np.ndarray):
    """Center and covariance of the SHARE of rows with the smallest determinant.

    Rows come as grid cells with their exact moments: weight, sum of vectors and sum of outer
    products.  From several starts, concentration steps keep the cells nearest to the current
    estimate (the last one by a part of its weight) until the determinant stops falling.
    """
    p = sums.shape[1]
    means = sums / weight[:, None]
    floor = np.diag(RESOLUTION[:p] ** 2)
    total = weight.sum()
    wanted = max(1.0, SHARE * total)

    def estimate(part):
        share = part / weight
        n = part.sum()
        center = (share[:, None] * sums).sum(0) / n
        second = (share[:, None, None] * squares).sum(0) / n
        return center, second - np.outer(center, center) + floor

    def distances(center, covariance):
        off = means - center
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(covariance), off)

    def nearest(distance):
        order = np.argsort(distance, kind="stable")
        before = np.cumsum(weight[order]) - weight[order]
        part = np.zeros(len(weight))
        part[order] = np.clip(wanted - before, 0, weight[order])
        return part

    # Starts: around the coordinatewise median, around the heaviest cell, and all rows.
    median = np.array([_weighted_median(means[:, j], weight) for j in range(p)])
    spread = np.diag(np.array([
        max(RESOLUTION[j], 1.4826 * _weighted_median(np.abs(means[:, j] - median[j]), weight)) ** 2
        for j in range(p)]))
    starts = [distances(median, spread), distances(means[np.argmax(weight)], spread),
              distances(*estimate(weight))]
    best = None
    for distance in starts:
        determinant = np.inf
        while True:
            center, covariance = estimate(nearest(distance))
            now = np.linalg.det(covariance)
            if not now < determinant * (1 - 1e-9):
                break
            determinant, distance = now, distances(center, covariance)
        if best is None or determinant < best[0]:
            best = (determinant, center, covariance)
    _, center, covariance = best
    # One reweighting step: all rows within reach, so that a normal tail is not cut off.
    covariance = covariance * CONSISTENCY * (1 + SCARCITY / total)
    part = np.where(distances(center, covariance) <= REACH, weight, 0.0)
    if part.sum() >= wanted:
        center, covariance = estimate(part)
        covariance = covariance * (1 + len(AXES) / total)
    return center, covariance


CONSISTENCY = 1.9  # the nearest 75 % of 4 normal statistics show this much too small a covariance
#: Small groups show it smaller still.  With this, of 20 normal rows 2.5 in 1000 are beyond CUTOFF
#: (18 without), of 40 rows 0.5 (5 without); simulated.
SCARCITY = 20.0
REACH = 16.0  # squared distance of the reweighting step


def _weighted_median(values, weight):
    order = np.argsort(values, kind="stable")
    return values[order][np.searchsorted(np.cumsum(weight[order]), weight.sum() / 2)]


def _fit(batches):
    for frame in batches:
        out = []
        for lang, source, cells in zip(frame["lang"], frame["source"], frame["cells"]):
            # A fixed order of the cells, whatever order they arrived in.
            cells = sorted(cells, key=lambda c: c["cell"])
            weight = np.array([c["n"] for c in cells], float)
            moments = np.array([c["moments"] for c in cells], float)
            p = len(AXES)
            squares = np.zeros((len(cells), p, p))
            rows, columns = np.triu_indices(p)
            squares[:, rows, columns] = squares[:, columns, rows] = moments[:, p:]
            center, covariance = covariance_determinant(weight, moments[:, :p], squares)
            out.append((lang, source, int(weight.sum()), center.tolist(), covariance.ravel().tolist()))
        yield pd.DataFrame(out, columns=_FITTED.names)


def _blend(batches):
    """Estimates of groups, each moved towards its language's by what it lacks of ENOUGH rows,
    and the language's towards that of all rows in the same way."""
    p = len(AXES)
    for frame in batches:
        out = []
        for row in frame.itertuples(index=False):
            center, covariance = np.array(row.center2), np.array(row.covariance2)
            for n, c, v in ((row.rows1, row.center1, row.covariance1), (row.rows0, row.center0, row.covariance0)):
                own = min(1.0, n / ENOUGH)
                center = own * np.array(c) + (1 - own) * center
                covariance = own * np.array(v) + (1 - own) * covariance
            precision = np.linalg.inv(covariance.reshape(p, p))
            out.append((row.lang0, row.source0, row.rows0, center.tolist(), precision.ravel().tolist()))
        yield pd.DataFrame(out, columns=_BLENDED.names)


def estimates(rows: DataFrame) -> DataFrame:
    """(lang, source, rows, center, precision) for every language and source in rows.

    rows: lang, source, x (array of the transformed statistics).  All rows count: they are
    added up on a grid, so that a group of any size reaches its task as a bounded number of
    cells with exact moments.  Every group has an estimate of its own; below ENOUGH rows it
    is blended with that of its language, and this with that of all rows if the language is
    small as well.
    """
    p = len(AXES)
    cell = F.lit(0)
    for j, (low, high, n) in enumerate(AXES.values()):
        place = F.floor((F.col("x")[j] - low) / (high - low) * n)
        cell = cell * n + F.greatest(F.lit(0), F.least(F.lit(n - 1), place))
    x = [F.col("x")[j] for j in range(p)]
    products = [x[i] * x[j] for i in range(p) for j in range(i, p)]
    sums = [F.sum(v).alias(f"m{k}") for k, v in enumerate(x + products)]
    names = [f"m{k}" for k in range(len(sums))]
    cells = cut_lineage(rows.groupBy("lang", "source", cell.cast("long").alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), *sums))

    def fitted(keys):
        added = cells if len(keys) == 2 else cells.groupBy(*keys, "cell").agg(
            F.sum("n").alias("n"), *[F.sum(m).alias(m) for m in names])
        gathered = added.groupBy(*keys).agg(
            F.collect_list(F.struct("cell", "n", F.array(*names).alias("moments"))).alias("cells")
        ).filter(F.size("cells") > 0)
        for name in ("source", "lang"):
            if name not in keys:
                gathered = gathered.withColumn(name, F.lit(None).cast("string"))
        return gathered.select("lang", "source", "cells").mapInPandas(_fit, _FITTED)

    own, language, everything = [
        fitted(keys).select(*[F.col(c).alias(f"{c}{i}") for c in _FITTED.names])
        for i, keys in enumerate((["lang", "source"], ["lang"], []))]
    return (
        own.join(language, F.col("lang0").eqNullSafe(F.col("lang1"))).join(everything, F.lit(True))
        .mapInPandas(_blend, _BLENDED))


def quality_rules(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    drop_text: bool = False,
) -> DataFrame:
    """df with STATISTICS, base_failed, distance and kept.

    kept is false where a base rule fails, and where the squared Mahalanobis distance of the
    transformed statistics from the robust estimate of their language and source exceeds
    CUTOFF.  Only rows that pass the base rules enter the estimates.  A missing text has no
    words and fails; missing languages or sources form groups of their own; repeated rows get
    the same result; an empty table stays empty; a column that is named like a result is
    replaced.  Very long texts are counted whole; a row exactly at CUTOFF is kept.  With drop_text the texts are read once and left out of the result; otherwise
    they are read twice, once for the estimates and once for the decisions.
    """
    results = ["base_failed", "distance", "kept", "__lang", "__source", "__center", "__precision"]
    counted = statistics(df.drop(*results), text).withColumn("base_failed", base_failed())
    if drop_text:
        counted = once = cut_lineage(counted.drop(text))
    else:
        once = statistics(df.select(text, lang, source), text)
    good = once.filter(~base_failed()).select(
        F.col(lang).alias("lang"), F.col(source).alias("source"), F.array(*_vector()).alias("x"))
    fit = cut_lineage(estimates(good)).select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"),
        F.col("center").alias("__center"), F.col("precision").alias("__precision"))
    p = len(AXES)
    off = [x - F.col("__center")[j] for j, x in enumerate(_vector())]
    distance = sum(
        off[i] * off[j] * F.col("__precision")[i * p + j] for i in range(p) for j in range(p))
    return (
        counted.join(fit, F.col(lang).eqNullSafe(F.col("__lang"))
                     & F.col(source).eqNullSafe(F.col("__source")), "left")
        .withColumn("distance", F.when(~F.col("base_failed"), distance))
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)))
        .drop("__lang", "__source", "__center", "__precision"))
