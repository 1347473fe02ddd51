"""Order statistics without sorting what is not wanted.

A sketch brackets each wanted place, one aggregate counts what lies below the bracket, and only
rows inside it, some ten-thousandths of all, are sorted.  The sketch decides how many rows those
are, never the result: a place that its bracket misses is looked for in all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from mergewell.functions.hashing import hash_fraction

ACCURACY = 10_000  # of the sketches
MARGINS = (2 / ACCURACY, 1.0)  # of a bracket, as a share of the rows: first narrow, then all
MAX_GROUPS = 10_000  # groups (classes) whose limits are sent to all tasks


def exact_quantiles(df: DataFrame, value: str, probs: list[float]) -> list[float]:
    """Type-7 quantiles of one numeric column; missing values are left out."""
    values = df.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    for margin in MARGINS:
        around = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
        # Two numbers per wanted quantile.
        first = values.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", around, ACCURACY).alias("q")).first()
        total = first["n"]
        if not total:
            return []
        bound = dict(zip(around, first["q"]))
        wanted = {p: int(p * (total - 1)) for p in probs}
        places = sorted({min(k + d, total - 1) for k in wanted.values() for d in (0, 1)})
        brackets = _disjoint([(bound[min(1.0, max(0.0, p - margin))], bound[min(1.0, max(0.0, p + margin))])
                              for p in probs])
        at = _at(values, brackets, places)
        if len(at) == len(places):
            break
    result = []
    for p in probs:
        low = wanted[p]
        high = min(low + 1, total - 1)
        result.append(at[low] + (p * (total - 1) - low) * (at[high] - at[low]))
    return result


def _disjoint(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _at(values: DataFrame, brackets: list[tuple[float, float]], places: list[int]) -> dict[int, float]:
    """The values at the places (from 0) that lie in the brackets."""
    below = values.agg(*[F.count_if(F.col("v") < low) for low, _ in brackets]).first()
    mark = F.coalesce(*[F.when(F.col("v").between(low, high), F.lit(i)) for i, (low, high) in enumerate(brackets)])
    near = values.withColumn("i", mark).filter("i IS NOT NULL").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    start = F.element_at(F.array(*[F.lit(b).cast("long") for b in below]), F.col("i") + 1)
    up_to = F.sum("n").over(W.partitionBy("i").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = near.withColumn("end", start + up_to).withColumn("begin", F.col("end") - F.col("n"))
    hit = F.array(*[F.lit(k).cast("long") for k in places])
    held = placed.withColumn("k", F.filter(hit, lambda k: (k >= F.col("begin")) & (k < F.col("end")))).filter(
        F.size("k") > 0)
    return {k: r["v"] for r in held.select("k", "v").collect() for k in r["k"]}


def cut_rows(rows: DataFrame, group: str, key: str, orders: list[str], prop: float) -> DataFrame:
    """(group, size, cuts): of each group its number of rows and, for each hex hash column in
    `orders`, the (hash, key) of the row in place floor(prop * size); null if that is no row.

    Groups are classes or bins; more than MAX_GROUPS are refused.
    """
    fractions = [hash_fraction(F.col(o)) for o in orders]
    kind = rows.schema[key].dataType
    schema = T.StructType([T.StructField(group, rows.schema[group].dataType), T.StructField("size", T.LongType()),
                           T.StructField("__low", T.ArrayType(T.DoubleType())),
                           T.StructField("__high", T.ArrayType(T.DoubleType()))])
    spark = rows.sparkSession
    for margin in MARGINS:
        ends = [max(prop - margin, 0.0), min(prop + margin, 1.0)]
        found = rows.groupBy(group).agg(F.count(F.lit(1)).alias("size"), *[
            F.percentile_approx(f, ends, ACCURACY).alias(f"q{i}") for i, f in enumerate(fractions)]).limit(
            MAX_GROUPS + 1).collect()
        if len(found) > MAX_GROUPS:
            raise ValueError(f"more than {MAX_GROUPS} groups in {group}")
        limits = spark.createDataFrame([(r[group], r["size"], *[
            [(r[f"q{i}"][e] if 0.0 < ends[e] < 1.0 else (-1.0, 2.0)[e]) for i in range(len(orders))]
            for e in (0, 1)]) for r in found], schema)
        marked = _with_limits(rows, limits, group)
        inside = [(f >= F.col("__low")[i]) & (f <= F.col("__high")[i]) for i, f in enumerate(fractions)]
        counted = marked.groupBy(group).agg(*[
            F.count_if(f < F.col("__low")[i]).alias(f"b{i}") for i, f in enumerate(fractions)]).collect()
        below = {r[group]: [r[f"b{i}"] for i in range(len(orders))] for r in counted}
        wanted = {r[group]: math.floor(prop * r["size"]) for r in found}
        starts = spark.createDataFrame(
            [(g, i, wanted[g] - n) for g, many in below.items() for i, n in enumerate(many)],
            T.StructType([schema[0], T.StructField("__run", T.IntegerType()), T.StructField("__place", T.LongType())]))
        near = marked.select(group, key, F.explode(F.filter(F.array(*[
            F.struct(F.lit(i).alias("run"), F.col(o).alias("hash"), x.alias("inside"))
            for i, (o, x) in enumerate(zip(orders, inside))]), lambda x: x["inside"])).alias("__x"))
        near = near.select(group, key, F.col("__x.run").alias("__run"), F.col("__x.hash").alias("__hash"))
        order = W.partitionBy(group, "__run").orderBy("__hash", key)
        ranked = near.withColumn("__rank", F.row_number().over(order).cast("long"))
        here = _with_limits(ranked, starts, group, "__run").filter("__rank = __place")
        cuts = {(r[group], r["__run"]): (r["__hash"], r[key]) for r in here.collect()}  # one per group and order
        if all((g, i) in cuts for g, k in wanted.items() if k for i in range(len(orders))):
            break
    cut = T.StructType([T.StructField("hash", T.StringType()), T.StructField("key", kind)])
    return spark.createDataFrame(
        [(r[group], r["size"], [cuts.get((r[group], i)) if wanted[r[group]] else None for i in range(len(orders))])
         for r in found],
        T.StructType([schema[0], schema[1], T.StructField("cuts", T.ArrayType(cut))]))


def _with_limits(rows: DataFrame, limits: DataFrame, *by: str) -> DataFrame:
    """Rows with the columns of a table of MAX_GROUPS lines per order at most; missing groups match."""
    renamed = limits.withColumnsRenamed({c: f"__of_{c}" for c in by})
    condition = F.lit(True)
    for c in by:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return rows.join(F.broadcast(renamed), condition).drop(*[f"__of_{c}" for c in by])


def is_within(cuts: DataFrame, rows: DataFrame, group: str, key: str, orders: list[str]) -> DataFrame:
    """rows with `within`, an array of booleans: whether the row is among the first of its group in
    each order, up to the cut.  No row is moved."""
    marked = _with_limits(rows, cuts.drop("size").withColumnRenamed("cuts", "__cuts"), group)
    return marked.withColumn("within", F.array(*[
        F.coalesce(F.struct(F.col(o).alias("hash"), F.col(key).alias("key")) <= F.col("__cuts")[i], F.lit(False))
        for i, o in enumerate(orders)])).drop("__cuts")
