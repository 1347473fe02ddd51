"""Source divergence against plain Python."""

import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from mergewell.llm import divergence


def rows_of(seed, documents=240, langs=("en", "fr", None), sources=("s1", "s2", "s3", "s4", None)):
    random.seed(seed)
    common = [f"{c}{d}" for c in "abcdefg" for d in "uvwxyz"] + ["é", "Éa", "straße", "日本"]
    rows = []
    for i in range(documents):
        n = random.choice([0, 1, 5, 60, 300])
        words = random.choices(common, weights=range(1, len(common) + 1), k=n)
        words = [w.upper() if random.random() < 0.1 else w for w in words]
        text = random.choice([" ", ", ", "7", "_"]).join(words)
        rows.append((random.choice(langs), random.choices(sources, weights=[9, 4, 2, 1, 1])[0],
                     random.choice([text, text, text, text, None])))
    return rows + [("xx", "s1", "too rare"), ("xx", "s2", None), ("yy", "only", "one " * 30)] + [rows[1]] * 3


def collected(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_python(spark, seed):
    rows = rows_of(seed)
    frame = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("g", F.lit("clash"))
    assert collected(divergence.divergence(frame.repartition(7))) == plain.divergence(rows)


def test_every_batch_size_gives_the_same_sums(spark, monkeypatch):
    rows = rows_of(3, 150)
    monkeypatch.setattr(divergence, "SLICE", 3)
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    monkeypatch.setattr(divergence, "PIECE", 10)
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    assert collected(divergence.divergence(frame)) == plain.divergence(rows)


def test_tree_sums_equal_pairs_of_each_row(monkeypatch):
    random.seed(4)
    paths = []
    for _ in range(200):
        groups = sorted(random.sample(range(12), random.randint(2, 9)))
        paths.append([(g, random.randint(5, 7) * 1000, 400 + g) for g in groups])
    paths.sort()
    times = [random.randint(1, 4) for _ in paths]
    f = lambda a, b: (a - b) ** 2 // (a + b)
    want = {}
    for path, n in zip(paths, times):
        for j, (h, p, p0) in enumerate(path):
            for g, q, q0 in path[:j]:
                want[g, h] = want.get((g, h), 0) + n * (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0))
    size = np.array([len(x) for x in paths])
    matrices = [np.zeros((len(paths), size.max()), np.int64) for _ in range(3)]
    for i, path in enumerate(paths):
        for d, item in enumerate(path):
            for m, x in zip(matrices, item):
                m[i, d] = x
    for dense in (divergence.DENSE, 1):
        monkeypatch.setattr(divergence, "DENSE", dense)
        g, h, value = divergence.tree_corrections(*matrices, size, np.array(times))
        got = {(a, b): v for a, b, v in zip(g.tolist(), h.tolist(), value.tolist())}
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_very_long_text_and_empty_tables(spark):
    rows = [("en", f"s{i % 2}", "word " * 40_000 + f"x{i % 3}" if i < 4 else "word x0 x1") for i in range(24)]
    schema = "lang string, source string, text string"
    assert collected(divergence.divergence(spark.createDataFrame(rows, schema))) == plain.divergence(rows)
    assert divergence.divergence(spark.createDataFrame([], schema)).count() == 0
    assert collected(divergence.divergence(spark.createDataFrame([(None, None, None)], schema))) == []


def test_frequencies_of_huge_counts_are_exact(spark):
    n, total, v = 8 * 10**15, 9 * 10**17, 10**6
    frame = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    assert frame.select(divergence.frequency("n", "total", "v")).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * v)
