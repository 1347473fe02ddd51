"""Sparse levels against pandas: the same filters as on one column per level."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mergewell.operators import encoding, levels as lv
from mergewell.operators.recipe import build_recipe, predictor_names
from mergewell.plans.combine import combine
from mergewell.plans.train import train


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(12)
    n = 400
    city = rng.choice([f"c{i:03d}" for i in range(30)], n, p=np.arange(1, 31) / np.arange(1, 31).sum())
    pdf = pd.DataFrame({"subject_id": [f"s{i:03d}" for i in range(n)], "city": city})
    pdf["code"] = pdf["city"].str.replace("c", "z")  # says the same as city
    pdf["two"] = np.where(np.arange(n) % 20 < 19, "big", "small")
    pdf.loc[pdf.index % 50 == 7, "city"] = None
    pdf["x"] = rng.normal(size=n)
    pdf["flag"] = (pdf["two"] == "small") * 2.0 + 1
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "subject_id string, city string, code string, two string, x double, flag double")
    return pdf, df.repartition(5).cache()


def indicators(pdf, columns):
    return pd.concat([(pdf[c] == v).astype(float).rename((c, v)) for c in columns for v in sorted(pdf[c].dropna().unique())], axis=1)


def named(block):
    return {r["place"]: (r["feature"], r["level"]) for r in block.places.collect()}


def test_places_counts_and_pairs(texts):
    pdf, df = texts
    columns = ["city", "code", "two"]
    block = lv.find_levels(df, "subject_id", columns)
    dense = indicators(pdf, columns)
    names = named(block)
    assert [names[i] for i in range(len(names))] == list(dense.columns)
    assert {r["place"]: r["n"] for r in block.places.collect()} == {i: int(dense.iloc[:, i].sum()) for i in names}
    corr = dense.corr().to_numpy()
    for least in (0.5, 0.9, 0.99):
        got = {(r["a"], r["b"]): r["corr"] for r in lv.level_pairs(block, least).collect()}
        want = {(i, j): corr[i, j] for i in range(len(corr)) for j in range(i + 1, len(corr)) if abs(corr[i, j]) >= least - 1e-12}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert (dense.columns.get_loc(("two", "big")), dense.columns.get_loc(("two", "small"))) in got


def test_pairs_with_numbers(texts):
    pdf, df = texts
    block = lv.find_levels(df, "subject_id", ["city", "two"])
    names = named(block)
    dense = indicators(pdf, ["city", "two"])
    got = {(r["feature"], names[r["place"]]): r["corr"] for r in lv.pairs_with_numbers(
        block, df.select("subject_id", "x", "flag", F.lit(1.0).alias("flat")), ["x", "flag", "flat"], 0.1).collect()}
    want = {(c, k): r for c in ("x", "flag") for k in dense.columns
            if abs(r := np.corrcoef(dense[k], pdf[c])[0, 1]) >= 0.1}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_first_of_correlated_levels_stays(texts):
    pdf, df = texts
    block = lv.informative(lv.find_levels(df, "subject_id", ["city", "code", "two"]), 1)
    kept, links = lv.keep_uncorrelated(block, df.select("subject_id", "x", "flag"), ["x", "flag"], 0.99)
    assert links == []
    counts = pdf["city"].value_counts()
    want = {("city", v) for v, n in counts.items() if n > 1}
    dense = indicators(pdf, ["city", "code"])
    for v, n in pdf["code"].value_counts().items():
        city = ("city", v.replace("z", "c"))
        if n > 1 and not (city in want and np.corrcoef(dense["code", v], dense[city])[0, 1] >= 0.99):
            want.add(("code", v))
    assert set(named(kept).values()) == want  # levels of `two` are what flag says


def test_levels_link_columns(spark):
    rows = [(f"s{i}", "a" if i % 4 == 0 else f"v{i % 3}", float(i % 4 == 0), 5.0 - 3 * (i % 4 == 0), float(i % 7)) for i in range(80)]
    df = spark.createDataFrame(rows, "k string, t string, p double, q double, r double")
    kept, links = lv.keep_uncorrelated(lv.find_levels(df, "k", ["t"]), df, ["p", "q", "r"], 0.99)
    assert links == [("p", "q")] and "a" not in {r["level"] for r in kept.places.collect()}


def test_vector_equals_indicators(texts):
    pdf, df = texts
    block = lv.find_levels(df, "subject_id", ["city", "two"], skip_first=True)
    entries = lv.numbered(block)
    sizes = lv.sizes_of(entries)
    made = lv.as_vector(df, ["city", "two"], entries, sizes, "v").toPandas().sort_values("subject_id")
    names = {r["index"]: (r["feature"], r["level"]) for r in lv.entry_names(["city", "two"], entries, sizes).collect()}
    dense = indicators(pdf, ["city", "two"])
    assert len(names) == len(dense.columns) - 2
    got = np.stack([v.toArray() for v in made["v"]])
    assert (got == dense[[names[i] for i in range(len(names))]].to_numpy()).all()
    assert "city" not in made and "x" in made


def test_combine_keeps_every_text(spark, texts, monkeypatch):
    pdf, df = texts
    label = df.select("subject_id", F.when(F.col("x") > 0, "up").otherwise("down").alias("label"))
    data = {"a": df.select("subject_id", "city", "code", "x").fillna("none"), "b": label}
    dense = combine(spark, data)
    assert dense.levels is None
    monkeypatch.setattr(encoding, "COLUMN_LIMIT", 10)
    monkeypatch.setattr("mergewell.plans.combine.COLUMN_LIMIT", 10)
    sparse = combine(spark, data)
    names = {(r["feature"], r["level"]) for r in sparse.levels.collect()}
    columns = [c for c in dense.ml_table.columns if c.startswith(("city_", "code_"))]
    assert {f"{f}_{v}" for f, v in names} == set(columns)
    assert sparse.ml_table.columns == ["subject_id", "x", "levels", "label"]
    first = {r["subject_id"]: r["levels"].toArray().sum() for r in sparse.ml_table.collect()}
    want = dense.ml_table.select("subject_id", sum(F.col(c) for c in columns).alias("n")).collect()
    assert first == {r["subject_id"]: r["n"] for r in want}


def test_texts_of_many_levels_stay(spark):
    """150 cities in 250 rows: neither that share nor that number drops the column."""
    rows = [(f"s{i}", f"city {i % 150}", float(i % 11), "yn"[i % 3 % 2]) for i in range(250)]
    df = spark.createDataFrame(rows, "subject_id string, city string, x double, label string")
    table = combine(spark, {"a": df}, near_empty_rows=None).ml_table
    assert sum(c.startswith("city_") for c in table.columns) == 150
    many = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS subject_id", "CONCAT('name ', id) AS name", "CAST(id % 13 AS DOUBLE) AS x",
        "IF(id % 2 = 0, 'y', 'n') AS label")
    report = combine(spark, {"a": many}, near_empty_rows=None)
    assert report.levels.count() == 3000 and report.ml_table.columns == ["subject_id", "x", "levels", "label"]


def test_too_many_levels_for_columns_are_refused(spark):
    df = spark.range(300).selectExpr("CAST(id AS STRING) AS name")
    with pytest.raises(ValueError):
        encoding.category_levels(df, ["name"])


def test_recipe_with_wide_texts(spark, texts, monkeypatch, tmp_path):
    from pyspark.ml import PipelineModel

    pdf, df = texts
    rows = df.drop("flag").fillna("none").withColumn("label", F.when(F.col("x") > 0, "up").otherwise("down"))
    roles = ["subject_id", "label"]
    narrow = build_recipe(roles, 0.999).fit(rows)
    monkeypatch.setattr(encoding, "COLUMN_LIMIT", 10)
    monkeypatch.setattr("mergewell.operators.recipe.COLUMN_LIMIT", 10)
    wide = build_recipe(roles, 0.999).fit(rows)
    assert len(predictor_names(wide)) == len(predictor_names(narrow))
    a = {r["subject_id"]: sorted(r["features"].toArray()) for r in wide.transform(rows).collect()}
    b = {r["subject_id"]: sorted(r["features"].toArray()) for r in narrow.transform(rows).collect()}
    assert a == b
    wide.write().overwrite().save(str(tmp_path / "wide"))
    unseen = rows.limit(3).withColumn("city", F.lit("never seen"))
    assert PipelineModel.load(str(tmp_path / "wide")).transform(unseen).count() == 3


def test_training_with_wide_texts(spark, texts, monkeypatch):
    pdf, df = texts
    monkeypatch.setattr(encoding, "COLUMN_LIMIT", 10)
    monkeypatch.setattr("mergewell.operators.recipe.COLUMN_LIMIT", 10)
    rows = df.select("subject_id", "city", "x").fillna("none").withColumn("label", 3 * F.col("x") + (F.col("city") > "c024").cast("double"))
    report = train(rows, kind="regression", model="lasso", folds=2, repeats=1, initial=2, tune_length=0, null_runs=2, parallelism=2)
    assert {r["metric"]: r["estimate"] for r in report.results.collect()}["rsq"] > 0.8


def test_schema_does_not_name_levels(spark):
    """The driver holds the schema: a million entries named there would take gigabytes."""
    df = spark.range(20).select(F.col("id").cast("string").alias("t"))
    entries = df.select(F.lit("t").alias("feature"), F.col("t").alias("level"), F.col("t").cast("long").alias("number"))
    vector = lv.as_vector(df, ["t"], entries.filter("number < 19"), {"t": 1_000_000}, "v")
    assert len(vector.schema.json()) < 1000
    found = [r["v"] for r in vector.collect()]
    assert {v.size for v in found} == {1_000_000} and sorted(v.indices.tolist() for v in found) == [[], *[[i] for i in range(19)]]
    assert len(encoding.sparse_one_hot(df, "t", "v").schema.json()) < 1000
