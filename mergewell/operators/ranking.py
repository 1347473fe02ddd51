"""Lookups, ranks and running sums that stay exact and distributed under skew.

A plain window over (group) puts a whole group into one task.  The operators here
cut large groups into ordered buckets, rank inside each bucket and add the bucket's
offset, which comes from a small table of bucket totals.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mergewell.functions.hashing import hash_fraction
from mergewell.lineage import cut_lineage

ROWS_PER_CUT = 100_000  # rows of a group that one task sorts
BROADCAST_LINES = 1_000_000  # of a table of offsets that is sent to all tasks


def small(table: DataFrame, lines: int) -> DataFrame:
    """table, to be sent to all tasks if it has few lines."""
    return F.broadcast(table) if lines <= BROADCAST_LINES else table


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which NULL keys match; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def rank_in_group(
    df: DataFrame,
    group: list[str],
    order: str,
    out: str = "rn",
    tie: tuple[str, ...] = (),
    weight: str | None = None,
) -> DataFrame:
    """row_number() within group by a hex hash column, for groups of any size; missing keys are a
    group.  With `weight` 1 plus the weights of the rows before instead.

    A group above ROWS_PER_CUT rows is cut into hash ranges of about that size, which are
    ranked apart; exact sums of the ranges before are added.
    """
    n = F.count(F.lit(1))
    position = hash_fraction(F.col(order))
    sizes = df.groupBy(*group).agg(n.alias("__n"))
    hot = cut_lineage(sizes.filter(F.col("__n") > ROWS_PER_CUT).withColumn(
        "__cuts", F.ceil(F.col("__n") / ROWS_PER_CUT)).drop("__n"))
    many = hot.agg(n.alias("groups"), F.coalesce(F.sum("__cuts"), F.lit(0)).alias("cuts")).first()
    if many["groups"]:
        place = F.coalesce(F.floor(position * F.col("__cuts")), F.lit(0)).cast("int")
        tagged = join_null_safe(df, small(hot, many["groups"]), group, "left").withColumn("__bucket", place)
        cut = tagged.filter("__cuts IS NOT NULL")
        totals = cut.groupBy(*group, "__bucket").agg((F.sum(weight) if weight else n).alias("__n"))
        before = W.partitionBy(*group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
        offsets = totals.withColumn("__offset", F.sum("__n").over(before)).drop("__n")
    else:
        tagged = df.withColumn("__bucket", F.lit(0))
    within = W.partitionBy(*group, "__bucket").orderBy(order, *tie)
    local = F.row_number().over(within) if weight is None else 1 + F.coalesce(
        F.sum(weight).over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = tagged.withColumn("__local", local)
    if many["groups"]:
        ranked = join_null_safe(ranked, small(offsets, many["cuts"]), [*group, "__bucket"], "left")
    else:
        ranked = ranked.withColumn("__offset", F.lit(0))
    return ranked.withColumn(
        out, (F.col("__local") + F.coalesce("__offset", F.lit(0))).cast("bigint")
    ).drop("__local", "__offset", "__bucket", "__cuts")


def sums_below(
    points: DataFrame, group: list[str], value: str, weights: list[str], buckets: int | None = None
) -> DataFrame:
    """For one row per (group, value): the weights of all smaller values of the group.

    Adds `<weight>_below`.  Groups are few (features or classes); their distinct values
    may be as many as the data has rows, so each group is cut at approximate
    quantiles, `buckets` of them or else one per ROWS_PER_CUT values.  Any cut points give
    the exact result, good ones give even tasks.
    """
    if buckets is None:
        most = points.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
        buckets = max(2, math.ceil((most or 0) / ROWS_PER_CUT))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = points.groupBy(*group).agg(
        F.percentile_approx(value, steps, max(1000, 10 * buckets)).alias("__cuts"))
    tagged = join_null_safe(points, F.broadcast(cuts), group, "inner").withColumn(
        "__bucket", F.size(F.filter("__cuts", lambda c: c < F.col(value)))).drop("__cuts")
    totals = tagged.groupBy(*group, "__bucket").agg(
        *[F.sum(w).alias(f"__{w}") for w in weights])
    before = W.partitionBy(*group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "__bucket", *[F.sum(f"__{w}").over(before).alias(f"__{w}") for w in weights])
    smaller = (
        W.partitionBy(*group, "__bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1))
    local = tagged.withColumns({f"{w}_below": F.sum(w).over(smaller) for w in weights})
    zero = F.lit(0)
    return join_null_safe(local, F.broadcast(offsets), [*group, "__bucket"], "inner").withColumns({
        f"{w}_below": F.coalesce(f"{w}_below", zero) + F.coalesce(f"__{w}", zero) for w in weights
    }).drop("__bucket", *[f"__{w}" for w in weights])
