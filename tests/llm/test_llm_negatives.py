"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from mergewell.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def got(df):
    return sorted(tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def float32(rows):
    return [(i, v and [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("tile", [1, 7, 2048])
def test_equals_plain_python(spark, monkeypatch, tile):
    random.seed(tile)
    monkeypatch.setattr(negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(negatives, "PENDING", 50 * tile)
    centres = [[random.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(330):
        centre = random.choice(centres)
        rows.append((i, [c + random.gauss(0, 0.5) for c in centre], random.randrange(3)))
    rows += [(400 + i, rows[0][1], i % 2) for i in range(30)]  # ties
    rows += [(500, None, 1), (600, [1.0] * 6, None), (700, [math.nan] * 6, 1), (800, [math.inf] + [1.0] * 5, 1),
             (900, [None] + [1.0] * 5, 1), (None, [1.0] * 6, 1), (1000, [], 1), (1001, [], 2), (1100, [2.0] * 5, 1),
             (1101, [1.0] * 5, 2), (1200, [0.0] * 6, 1), (1300, [-1.0] * 6, 9), (1500, [3e38] * 6, 1)]
    rows = float32(rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x"))
    usable = [r for r in rows if r[0] != 1500]
    assert got(negatives.mine(frame.repartition(5))) == plain.hard_negatives(usable)


def test_many_passes_give_the_same_rows(spark, monkeypatch):
    random.seed(5)
    rows = float32([(i, [random.gauss(0.3, 1) for _ in range(4)], i % 3) for i in range(120)])
    frame = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(negatives, "PASS_ANCHORS", 5)
    assert got(negatives.mine(frame, every=9)) == plain.hard_negatives(rows, every=9)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 1.0], 1)] * 2 + [(1, [1.0, 1.0], 1)] * 3 + [(2, [0.5, 0.5], 2)] * 2
    found = got(negatives.mine(spark.createDataFrame(rows, SCHEMA)))
    # Two anchors, each with three equal positives, each of those with two equal negatives.
    assert len(found) == 12 and {r[:2] + r[3:] for r in found} == {(0, 1, 2, 2 * 256**2, 256**2)}
    assert negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert negatives.mine(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)).count() == 0


def test_scores_beyond_doubles_are_exact():
    random.seed(6)
    rows = np.array([[random.randrange(-2**30, 2**30) for _ in range(3)] for _ in range(20)])
    want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in rows] for a in rows]
    assert negatives.scores_of(rows, rows).tolist() == want


def test_slots_are_disjoint_and_cover_all_windows():
    slots = negatives.limits_of([100, 100, 57, 10, 0, -3])
    assert slots == [(90, 90), (51, 90), (9, 51), (0, 9), (-1, 0)]
    assert negatives.limits_of([-1]) == [] and negatives.limits_of([]) == []
