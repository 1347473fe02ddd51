"""Submitting independent Spark jobs together, and the code that their tasks import."""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

import mergewell

_shipped: set[str] = set()  # applications that have the package on their executors
_shipping = threading.Lock()


def in_threads(spark: SparkSession, work, items, parallelism: int) -> list:
    """Results of work(item) for all items, `parallelism` of them at the same time."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: tasks import it there."""
    context = spark.sparkContext
    with _shipping:
        if context.applicationId in _shipped:
            return
        root = os.path.dirname(os.path.abspath(mergewell.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="mergewell-"), "mergewell.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("mergewell", os.path.relpath(full, root)))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
