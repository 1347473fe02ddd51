"""The corpus pipeline: five stages from raw documents to token ids.

All stages but the last return the columns of their input, whatever other columns it has and
however they are named.  An empty table stays empty in each.  Whole texts are worked on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from mergewell.llm import bpe, mixing, near, quality, spans
from mergewell.llm.scratch import Scratch


KNOWN = ["doc_id", "text", "lang", "source", "n_chars"]


def _known(docs: DataFrame) -> DataFrame:
    """The columns that operators look at, and all others packed away from their results."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in KNOWN]
    rest = F.struct(*others) if others else F.lit(None)
    return docs.select(*KNOWN, rest.alias("__rest"))


def _restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again, in their order."""
    return df.select(*[F.col(c) if c in KNOWN else F.col("__rest")[c].alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  Missing and empty texts go, having no words; repeated
    rows share their verdict; a document exactly at the cut-off stays."""
    return _restored(quality.quality_rules(_known(docs)).filter("kept"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: a similarity of 0.8
    or more in shingles of five words.  Missing and blank texts are like nothing and stay; of rows
    that share the smallest id all stay; ties do not occur, as ids order the group."""
    return _restored(near.drop_near_duplicates(_known(docs), width=5, percent=80), docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those with nothing left go.  Missing
    texts stay missing; a row without id is compared with none; rows that repeat an id are no
    earlier than each other and keep their passages."""
    cut = spans.dedup_spans(_known(docs))
    lost = F.col("n_removed") > 0
    kept = cut.filter(~(lost & (F.col("n_removed") == F.col("n_words"))))
    kept = kept.withColumns({
        "text": F.when(lost, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(lost, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars"))})
    return _restored(kept, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the sources ask for.  Missing texts have
    size 0 and follow their source's rate; a missing source is one; rows that repeat an id share
    the draw of the extra copy."""
    return _restored(mixing.repeated(mixing.mix(_known(docs))), docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy, with digests of ids and decoded text.  Missing texts have none;
    repeated rows get equal values; other columns are left out."""
    return bpe.encode_decode(
        docs.select("doc_id", "source", "text"), public_tokenizers.path("word_bpe_49k.json")).drop("text")


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("source mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: The quality verdict, near-duplicate groups and token ids are beyond SQL; tests compare run()
#: with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written and read again."""
    scratch = Scratch(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{number}")
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
