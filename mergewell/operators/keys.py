"""The subject key: presence, repeats, occurrence numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mergewell.lineage import cut_lineage
from mergewell.operators import ranking
from mergewell.operators.ranking import join_null_safe, rank_in_group


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their `dupe_count`."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dupe_count"))
    return counted.filter("dupe_count > 1")


def get_dupes(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key combination occurs more than once, with `dupe_count`.

    Missing keys are equal to each other.  One count per key and one join, whose large
    partitions adaptive execution splits."""
    return join_null_safe(df, repeated_keys(df, keys), keys, "inner")


def has_repeats(df: DataFrame, key: str) -> bool:
    return not repeated_keys(df, [key]).isEmpty()


def number_repeats(df: DataFrame, key: str, content: list[str] | None = None) -> DataFrame:
    """Number the rows of a repeated subject 1, 2, ... in a column `occurrence`.

    The order is that of a hash of the row's content, so it does not depend on how
    the rows are stored.  Rows of the same content form a run, in which every partition gets its
    own stretch of numbers: however often a row is repeated, all tasks number it.
    """
    content = content or [c for c in df.columns if c != key]
    digest = F.md5(F.concat_ws("\u0001", *[
        F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in content]))
    hashed = df.withColumn("__digest", digest)
    longest = hashed.groupBy(key, "__digest").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    if (longest or 0) <= ranking.ROWS_PER_CUT:
        return rank_in_group(hashed, [key], "__digest", "occurrence").drop("__digest")
    # Which partition a row is in must not change between counting and numbering.
    parted = cut_lineage(hashed.withColumn("__part", F.spark_partition_id()))
    stretch = [key, "__digest", "__part"]
    counted = parted.groupBy(*stretch).agg(F.count(F.lit(1)).alias("__count"))
    starts = rank_in_group(counted, [key], "__digest", "__start", ("__part",), weight="__count")
    local = F.row_number().over(W.partitionBy(*stretch).orderBy("__digest"))
    numbered = join_null_safe(parted.withColumn("__local", local), starts.drop("__count"), stretch, "inner")
    return numbered.withColumn("occurrence", F.col("__start") + F.col("__local") - 1).drop(
        "__digest", "__part", "__start", "__local")


def subject_index(df: DataFrame, key: str) -> DataFrame:
    """(key, subject_index): place of each distinct key in sort order, from 1.

    Keys are range-partitioned and sorted; a key's place is its place in its partition
    plus the sizes of the partitions before, a table with one line per partition.
    """
    ordered = df.select(key).filter(F.col(key).isNotNull()).distinct().repartitionByRange(
        key).sortWithinPartitions(key)
    # monotonically_increasing_id holds the partition above bit 33, the row below.
    placed = cut_lineage(ordered.withColumn("__id", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__id", 33))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "__part").select(
        key, (place + F.col("__offset") + 1).alias("subject_index"))
