"""Ranks and lookups against pandas, with hot groups and hot values."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mergewell.operators import correlation, ranking, redundancy, selection
from mergewell.operators.keys import get_dupes, number_repeats, subject_index
from mergewell.operators.resampling import stratified_split


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, one is missing."""
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(40)}", i)
            for i in range(3000)]
    return pd.DataFrame(rows, columns=["k", "i"]), spark.createDataFrame(rows, "k string, i int")


@pytest.mark.parametrize("rows_per_cut", [7, 400, 100_000])
@pytest.mark.parametrize("partitions", [1, 17])
def test_rank_in_group(skewed, monkeypatch, rows_per_cut, partitions):
    monkeypatch.setattr(ranking, "ROWS_PER_CUT", rows_per_cut)
    pdf, df = skewed
    hashed = df.repartition(partitions).withColumn("h", F.md5(F.col("i").cast("string")))
    got = ranking.rank_in_group(hashed, ["k"], "h").toPandas().set_index("i")["rn"].sort_index()
    keys = hashed.toPandas()
    want = keys.groupby("k", dropna=False)["h"].rank(method="first").astype(int)
    assert got.tolist() == want.set_axis(keys["i"]).sort_index().tolist()


@pytest.mark.parametrize("rows_per_cut", [7, 100_000])
def test_rank_with_weights(skewed, monkeypatch, rows_per_cut):
    monkeypatch.setattr(ranking, "ROWS_PER_CUT", rows_per_cut)
    pdf, df = skewed
    hashed = df.withColumns({"h": F.md5(F.col("i").cast("string")), "w": F.col("i") % 5})
    got = ranking.rank_in_group(hashed, ["k"], "h", weight="w").toPandas().sort_values("h")
    for _, g in got.groupby("k", dropna=False):
        assert g["rn"].tolist() == (1 + g["w"].cumsum() - g["w"]).tolist()


def test_get_dupes(skewed):
    pdf, df = skewed
    got = get_dupes(df, ["k"]).toPandas()
    want = pdf[pdf.groupby("k", dropna=False)["i"].transform("size") > 1]  # missing keys are equal
    assert sorted(got["i"]) == sorted(want["i"])
    assert got.groupby("k")["dupe_count"].first().to_dict() == want.groupby("k").size().to_dict()


def test_number_repeats_counts_every_row(skewed):
    pdf, df = skewed
    got = number_repeats(df, "k").toPandas()
    assert all(sorted(g["occurrence"]) == list(range(1, len(g) + 1))
               for _, g in got.groupby("k", dropna=False))


@pytest.mark.parametrize("rows_per_cut", [50, 100_000])
def test_number_repeats_of_one_row(spark, monkeypatch, rows_per_cut):
    """Most rows are one and the same; every task numbers some of them."""
    monkeypatch.setattr(ranking, "ROWS_PER_CUT", rows_per_cut)
    rows = [("a", "same")] * 700 + [("a", f"v{i}") for i in range(90)] + [("b", "same")] * 60 + [(None, None)] * 120
    df = spark.createDataFrame(rows, "k string, v string").repartition(9)
    got = number_repeats(df, "k").toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby("k", dropna=False):
        assert sorted(g["occurrence"]) == list(range(1, len(g) + 1))
        for _, same in g.groupby("v", dropna=False):  # equal rows have neighbouring numbers
            assert same["occurrence"].max() - same["occurrence"].min() == len(same) - 1


def test_subject_index(skewed):
    pdf, df = skewed
    got = {r["k"]: r["subject_index"] for r in subject_index(df.repartition(13), "k").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(set(pdf["k"].dropna())))}


def test_sums_below(spark):
    rng = random.Random(2)
    rows = sorted({(g, rng.randrange(500) / 7) for g in "ab" for _ in range(300)})
    points = [(g, v, rng.randrange(1, 9)) for g, v in rows]
    df = spark.createDataFrame(points, "g string, v double, w bigint")
    got = {(r["g"], r["v"]): r["w_below"] for r in ranking.sums_below(df, ["g"], "v", ["w"], 7).collect()}
    assert got == {(g, v): sum(w for h, x, w in points if h == g and x < v) for g, v, _ in points}


@pytest.mark.parametrize("margins", [selection.MARGINS, (0.0, 1.0), (0.01, 1.0)])
def test_exact_quantiles(spark, monkeypatch, margins):
    monkeypatch.setattr(selection, "MARGINS", margins)
    random.seed(3)
    values = [random.gauss(0, 1) for _ in range(3000)] + [0.0] * 900 + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    assert np.allclose(selection.exact_quantiles(df, "v", probs), np.quantile([v for v in values if v is not None], probs))
    assert selection.exact_quantiles(df.limit(0), "v", probs) == []
    assert selection.exact_quantiles(df.filter("v IS NOT NULL").limit(1), "v", [0.3])[0] == values[0]


@pytest.mark.parametrize("margins", [selection.MARGINS, (0.0, 1.0), (0.02, 1.0)])
@pytest.mark.parametrize("prop", [0.0, 0.3, 0.7, 1.0])
def test_cut_rows(spark, monkeypatch, margins, prop):
    monkeypatch.setattr(selection, "MARGINS", margins)
    rows = [(i, "hot" if i % 3 else None if i % 2 else f"g{i % 4}") for i in range(900)] + [(-1, "alone")]
    df = spark.createDataFrame(rows, "i long, g string").repartition(6).withColumns({
        o: F.md5(F.concat(F.lit(o), F.col("i").cast("string"))) for o in ("o1", "o2")})
    cuts = selection.cut_rows(df, "g", "i", ["o1", "o2"], prop)
    got = selection.is_within(cuts, df, "g", "i", ["o1", "o2"]).toPandas()
    assert len(got) == len(rows)
    for _, group in got.groupby("g", dropna=False):
        for i, o in enumerate(("o1", "o2")):
            first = set(group.sort_values(o)["i"].head(int(prop * len(group))))
            assert {k for k, w in zip(group["i"], group["within"]) if w[i]} == first


def test_splits_move_no_rows(spark):
    df = spark.range(500).selectExpr("id", "CAST(id % 3 AS STRING) AS label", "repeat('x', 50) AS payload")
    plan = stratified_split(df, "id", "label")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({
        "zeros": np.where(rng.random(2000) < 0.7, 0.0, rng.random(2000)),
        "x": rng.normal(size=2000), "steps": rng.integers(0, 5, 2000).astype(float)})
    pdf["y"] = -pdf["x"] ** 3 + rng.normal(size=2000) / 10
    pdf["same"] = 1.0
    pdf.loc[:9, "x"] = np.nan
    return pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "zeros double, x double, steps double, y double, same double")


@pytest.mark.parametrize("rows_per_bucket, few_values", [(20, 0), (100_000, 0), (20, 10), (20, 50_000)])
def test_rank_columns(numbers, monkeypatch, rows_per_bucket, few_values):
    monkeypatch.setattr(correlation, "ROWS_PER_BUCKET", rows_per_bucket)
    monkeypatch.setattr(correlation, "FEW_VALUES", few_values)
    pdf, df = numbers
    columns = list(pdf.columns)
    got = correlation.rank_columns(df, columns).toPandas()
    want = pdf.dropna().rank()
    order = lambda frame: frame.sort_values(columns).to_numpy()
    assert np.allclose(order(got[columns]), order(want))


@pytest.mark.parametrize("cells, few_values", [(70, 0), (70, 10), (1_000_000, 0), (70, 50_000)])
def test_ranks_stay_with_their_keys(numbers, spark, monkeypatch, cells, few_values):
    """Many small blocks, hot values in several of them, a key that repeats and one that is missing."""
    monkeypatch.setattr(correlation, "ROWS_PER_BUCKET", 50)
    monkeypatch.setattr(correlation, "CELLS_PER_BLOCK", cells)
    monkeypatch.setattr(correlation, "FEW_VALUES", few_values)
    monkeypatch.setattr(correlation, "VALUES_SHARE", 1)
    pdf = numbers[0].assign(k=[f"k{i // 3}" for i in range(2000)])
    pdf["x"] = pdf["x"].where(pdf.index != 50, np.inf)
    pdf["zeros"] = pdf["zeros"].where(pdf.index % 2 == 0, -pdf["zeros"])  # 0.0 and -0.0 are equal
    pdf.loc[100, "k"] = None
    columns = [c for c in pdf.columns if c != "k"]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in columns) + ", k string")
    got = correlation.rank_columns(df.repartition(5), columns, "k").toPandas()
    want = pdf.dropna()
    want = want[columns].rank().assign(k=want["k"])
    order = lambda frame: frame.sort_values(["k", *columns])[["k", *columns]].reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)


def test_ranks_move_blocks(numbers, monkeypatch):
    """Neither cells nor rows are sorted or joined one by one."""
    columns = list(numbers[0].columns)
    for few_values in (0, 50_000):
        monkeypatch.setattr(correlation, "FEW_VALUES", few_values)
        plan = correlation.rank_columns(numbers[1], columns)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Window", "SortMergeJoin", "HashAggregate", "Generate"))
        assert ("hashpartitioning" in plan) == (few_values == 0)


def test_ranks_of_nothing(numbers):
    _, df = numbers
    assert correlation.rank_columns(df.limit(0), ["x", "y"]).count() == 0
    assert correlation.spearman_pairs(df.limit(0), ["x", "y"]).count() == 0


@pytest.mark.parametrize("block", [2, 1000])
def test_pearson_and_spearman(numbers, monkeypatch, block):
    monkeypatch.setattr(correlation, "BLOCK", block)
    pdf, df = numbers
    columns = list(pdf.columns)
    for pairs, method in ((correlation.pearson_pairs(df, columns), "pearson"),
                          (correlation.spearman_pairs(df, columns), "spearman")):
        got = {(r["a"], r["b"]): r["corr"] for r in pairs.collect()}
        want = pdf.dropna().corr(method)
        assert set(got) == {(a, b) for i, a in enumerate(columns[:4]) for b in columns[i + 1:4]}
        assert all(abs(v - want.loc[a, b]) < 1e-9 for (a, b), v in got.items())


def test_columns_to_drop_from_sparse_pairs(spark, monkeypatch):
    """Without the whole matrix the same columns go."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(500, 6))
    data = np.column_stack([base, base[:, :3] + rng.normal(size=(500, 3)) / 10, -base[:, 0] + rng.normal(size=500) / 8, np.ones(500)])
    names = [f"c{i}" for i in range(data.shape[1])]
    df = spark.createDataFrame(pd.DataFrame(data, columns=names))
    whole = redundancy.correlated_columns(df, names, 0.9)
    monkeypatch.setattr(redundancy, "DENSE_COLUMNS", 2)
    assert whole == redundancy.correlated_columns(df, names, 0.9)
    monkeypatch.setattr(redundancy, "UNION_PAIRS", 10)
    monkeypatch.setattr(correlation, "BLOCK", 4)
    monkeypatch.setattr(correlation, "STRIP", 3)
    assert whole == redundancy.correlated_columns(df, names, 0.9) and len(whole) == 4
    assert redundancy.correlated_columns(df, names, 0.999) == []


def test_empty_and_single_column(numbers):
    _, df = numbers
    assert correlation.pearson_pairs(df, ["x"]).count() == 0
    assert correlation.pearson_pairs(df.limit(0), ["x", "y"]).count() == 0
