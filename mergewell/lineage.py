"""Cutting lineage in a way that survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only a session in one local JVM without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="mergewell-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> str:
    """Path in the shared folder under which df was written; whoever asked for it deletes it."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def spread(rows: DataFrame) -> DataFrame:
    """Give a checkpointed or plainly read frame at least as many partitions as there are cores.

    A single small file arrives as one partition; large inputs are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    enough = rows.rdd.getNumPartitions() >= cores
    return rows if enough else rows.repartition(cores)
