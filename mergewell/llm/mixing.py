"""Mixing sources to target weights by whole repeats plus one seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mergewell.functions.hashing import hash_fraction, seeded_hash
from mergewell.lineage import cut_lineage
from mergewell.operators.keys import subject_index

WEIGHTS = (5, 2, 1)
MOST = 3  # no source and no document is taken more often than this
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"


def size_in_words(text: Column) -> Column:
    """Number of words, 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in order of their code points, the missing one last, weigh 5, 2, 1 and so on
    again.  A source's target is its share of all words, at most MOST times its size; what
    exceeds that is shared again by weight among the others until none is above.  Every
    round is one sum over the table of sources; only sums reach the driver.
    """
    totals = cut_lineage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    index = cut_lineage(subject_index(totals, "source"))
    # From 1; the missing source follows the last one.
    place = F.coalesce(F.col("subject_index"), F.lit(index.count() + 1)) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), (place % len(WEIGHTS)).cast("int") + 1)
    table = cut_lineage(totals.join(index, "source", "left").select("source", "source_size", weight.alias("weight")))
    size, weight = F.col("source_size"), F.col("weight")
    level, capped = None, F.lit(False)
    total = table.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    taken = free = None
    while True:
        now = table.agg(
            F.coalesce(F.sum(F.when(capped, MOST * size)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~capped, weight)), F.lit(0)).alias("free")).first()
        if (now["taken"], now["free"]) == (taken, free) or not now["free"]:
            break
        taken, free = now["taken"], now["free"]
        level = (total - taken) / free  # words for each unit of weight
        capped = capped | ((MOST * size).cast("double") < weight * F.lit(level))
    share = F.least((MOST * size).cast("double"), weight * F.lit(0.0 if level is None else level))
    return table.select("source", "source_size", share.alias("target"))


def mix(
    df: DataFrame, doc_id: str = "doc_id", source: str = "source", size: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """df with size, source_size, target and copies (how often the mix holds the row).

    The rate target / source_size of its source gives every row floor(rate) copies, and one
    more with the fraction as its probability: a hash of seed and id decides, so reruns agree.
    Rows with the same id share that decision; a missing id is an id like others.  Missing
    texts have size 0 and are kept like other rows of their source; a source without words
    has target 0 and rate 1; an empty table stays empty; a column that is named like a result
    is replaced.  Very long texts are counted whole; repeated rows count each time.
    """
    results = ["size", "source_size", "target", "copies", "__source"]
    size = size_in_words(F.col("text")) if size is None else size
    table = cut_lineage(targets(df.select(F.col(source).alias("source"), size.alias("size"))))
    sized = df.withColumn("size", size).drop(*results[1:])
    table = table.withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    draw = hash_fraction(seeded_hash(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    copies = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    return (
        sized.join(table, F.col(source).eqNullSafe(F.col("__source")))
        .withColumn("copies", copies.cast("long")).drop("__source"))


def repeated(mixed: DataFrame) -> DataFrame:
    """Every row as often as its copies say."""
    times = F.expr("sequence(1L, copies)")
    return mixed.filter("copies > 0").withColumn("__copy", F.explode(times)).drop("__copy")
