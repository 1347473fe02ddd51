"""Profile and combine on small made files."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mergewell.operators.completeness import na_cutoff
from mergewell.operators.redundancy import (
    connected_components, drop_redundant_numeric, greedy_correlation_filter, group_correlated,
    redundant_features, resolve_label)
from mergewell.plans.combine import combine
from mergewell.plans.profile import profile
from mergewell.sources.delimited import (
    list_datasets, load_ml_table, load_problems, read_all, read_clean, read_delimited, read_header)
from mergewell.sources import sinks
from mergewell.sources.sinks import append_results, write_combined, write_profile


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    (root / "deep").mkdir()
    files = {
        "good.csv": "Subject ID,Iron mg\n" + "".join(f"s{i},{i * 1.5}\n" for i in range(10)),
        "dup header.csv": "subject_id,a,a,b,B\n" + "".join(
            f"s{i},{i},{i if i else 'NA'},{i},{i + 1000}\n" for i in range(10)),
        "no_key.csv": "person,a\np,1\n",
        "repeats.tsv": "subject_id\tv\n" + "s1\t1\ns1\t2\ns2\t3\n",
        "deep/symbols.txt": "subject_id\tv\tw\ns1\t-?\tx\ns2\t**\tN/A\n",
        "dates.csv": 'subject_id,when,note\ns1,12/14/16,"a, b"\ns2,7,.\ns3,12/14/2016 10:30,c\n',
        "shared.csv": "subject_id,iron_mg\ns1,1\ns2,\ns3,2\n"}
    for name, text in files.items():
        (root / name).write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def report(spark, folder):
    return profile(spark, read_all(spark, folder))


def test_headers_and_listing(spark, folder):
    assert len(list_datasets(spark, folder)) == 7
    assert read_header(spark, f"{folder}/dup header.csv") == ["subject_id", "a", "a", "b", "B"]
    raw = read_delimited(spark, f"{folder}/dates.csv")
    assert raw.name == "dates" and raw.frame.collect()[0]["c2"] == "a, b"
    with pytest.raises(ValueError):
        read_delimited(spark, f"{folder}/x.xlsx")


def test_empty_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        list_datasets(spark, str(tmp_path))


def test_problems(report):
    marks = {r["dataset"]: [p for p in r.asDict() if r[p] == 1] for r in report.problems.collect()}
    assert marks == {
        "no_key": ["subject_id_not_found"], "repeats": ["subject_id_duplicated"],
        "symbols": ["data_are_symbols"], "dates": ["date_not_unix"],
        "dup_header": ["duplicated_data", "duplicated_column_names"]}


def test_duplicated_columns(report):
    clean = report.clean["dup_header"]
    assert clean.columns[:2] == ["subject_id", "a"] and len(clean.columns) == 4
    assert all(c.startswith("b_") and len(c) == 34 for c in clean.columns[2:])
    kinds = {(k, f) for k, d, f in report.evidence if d == "dup_header"}
    assert kinds == {("duplicated_data", "a"), ("duplicated_colnames", "b")}


def test_repeats_are_numbered(report):
    rows = report.duplicate_rows["repeats"].collect()
    assert sorted((r["subject_id"], r["occurrence"]) for r in rows) == [("s1", 1), ("s1", 2)]


def test_dates_stay_text(report):
    assert report.date_features["dates"] == ["when"]
    assert dict(report.clean["dates"].dtypes)["when"] == "string"


def test_counts_add_up(report):
    counts = {(r["dataset"], r["feature"]): (r["na_count"], r["have_data"], r["duplicated_feature"])
              for r in report.na_counts.collect()}
    assert counts["shared", "iron_mg"] == (1, 2, True)
    assert counts["good", "iron_mg"] == (0, 10, True)
    assert counts["dates", "note"] == (1, 2, False)


def test_shared_names_are_renamed(report):
    assert report.clean["good"].columns == ["subject_id", "iron_mg"]
    assert report.clean["shared"].columns == ["subject_id", "iron_mg_2"]


def test_write_and_read_back(spark, report, tmp_path):
    out = str(tmp_path / "out")
    write_profile(report, out)
    with pytest.raises(FileExistsError):
        write_profile(report, out)
    back = read_clean(spark, out)
    assert set(back) == set(report.clean)
    assert back["good"].count() == 10
    assert load_problems(spark, out).count() == report.problems.count()
    combined = combine(spark, back, label="iron_mg", problems=load_problems(spark, out))
    assert "repeats" in combined.excluded and "good" not in combined.excluded
    write_combined(combined, str(tmp_path / "combined"))
    assert load_ml_table(str(tmp_path / "combined" / "ml_table"), spark).count() == combined.ml_table.count()
    append_results(report.problems, str(tmp_path / "results"))
    append_results(report.problems, str(tmp_path / "results"))
    assert spark.read.parquet(str(tmp_path / "results")).count() == 2 * report.problems.count()


@pytest.fixture(scope="module")
def studies(spark):
    """Three datasets: complete numbers, numbers with gaps and a category, a label."""
    rng = np.random.default_rng(0)
    n = 300
    ids = [f"p{i}" for i in range(n)]
    x = rng.normal(size=n)
    food = pd.DataFrame({"subject_id": ids, "x": x, "x2": 2 * x + 1, "x3": -x, "y": rng.normal(size=n)})
    food.loc[:4, "x2"] = None
    food.loc[:9, "x3"] = None
    life = pd.DataFrame({"subject_id": ids[:280], "level": rng.choice(["high", "low", "mid"], 280),
                         "rare": [1.0] * 20 + [None] * 260, "level_2": [None] * 280})
    life["level_2"] = life["level"].where(life.index > 30)
    label = pd.DataFrame({"subject_id": ids[:290] + ["only_label"], "label": rng.choice(["a", "b"], 291)})
    frames = {"food": (food, "subject_id string, x double, x2 double, x3 double, y double"),
              "life": (life, "subject_id string, level string, rare double, level_2 string"),
              "outcome": (label, "subject_id string, label string")}
    return {k: spark.createDataFrame(f.astype(object).where(f.notna(), None), s)
            for k, (f, s) in frames.items()}


def test_combine(spark, studies):
    report = combine(spark, studies)
    merged = report.merged_data_with_nas
    assert merged.count() == 301
    assert "x2" not in merged.columns and "x3" not in merged.columns and "level_2" not in merged.columns
    table = report.ml_table.toPandas()
    assert table.notna().all().all()
    assert list(table.columns) == ["subject_id", "x", "y", "label"]
    assert len(table) == 290
    categories = {(r["features"], r["category"]) for r in report.feature_summary.collect()}
    assert ("level", "dropped_to_retain_samples") in categories
    assert ("rare", "all_features") not in categories
    assert ("x", "final_feature_list") in categories
    advice = [(r["code"], r["message"]) for r in report.advisories.collect()]
    assert [code for code, _ in advice] == ["few_samples", "class_count", "class_count"]
    assert {message for code, message in advice if code == "class_count"} == {"a", "b"}


def test_combine_does_not_depend_on_partitions(spark, studies):
    tables = [combine(spark, {k: d.repartition(n) for k, d in studies.items()}).ml_table.toPandas()
              .sort_values("subject_id").reset_index(drop=True) for n in (1, 17)]
    pd.testing.assert_frame_equal(*tables)


def test_choose_survivor(spark, studies):
    pair = studies["food"].select("subject_id", "x", "y").withColumn("z", studies["food"]["x"] * 3)
    data = {"food": pair, "outcome": studies["outcome"]}
    automatic = combine(spark, data)
    chosen = combine(spark, data, choose={"x": "z"})
    assert automatic.ml_table.columns == ["subject_id", "x", "y", "label"]
    assert chosen.ml_table.columns == ["subject_id", "y", "z", "label"]


def test_missing_label_and_repeats(spark, studies):
    with pytest.raises(ValueError):
        combine(spark, studies, label="nothing")
    twice = {"food": studies["food"].union(studies["food"]), "outcome": studies["outcome"]}
    with pytest.raises(ValueError):
        combine(spark, twice, on_repeat="error")
    assert combine(spark, {**twice, "life": studies["life"]}).excluded == ["food"]


def test_redundant_triple_and_pair(spark):
    gaps = spark.createDataFrame(
        [("a", 0), ("b", 2), ("c", 5), ("d", 0), ("e", 0)], "feature string, na_count bigint")
    pairs = spark.createDataFrame(
        [("a", "b", 1.0), ("a", "c", 1.0), ("b", "c", -1.0), ("d", "e", 1.0)],
        "a string, b string, corr double")
    def dropped(**kw):
        return {r["feature"] for r in redundant_features(pairs, gaps, **kw).collect()}
    assert dropped() == {"b", "c"}
    assert dropped(reduce_pairs=True) == {"b", "c", "e"}


def test_all_null_columns_go(spark):
    df = spark.createDataFrame([("s", 1.0, None)], "subject_id string, a double, b double")
    assert drop_redundant_numeric(df, "subject_id", "label")[0].columns == ["subject_id", "a"]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame(
        [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(30)] + [("p", "q")], "a string, b string")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert set(got.values()) == {"n00", "p"} and len(got) == 33


def test_groups(spark):
    pairs = spark.createDataFrame([("z", "m", -0.99), ("m", "k", 0.97)], "a string, b string, corr double")
    got = {r["keep"]: r["members"] for r in group_correlated(pairs, ["z", "q", "m", "k"], 0.95).collect()}
    assert got == {"z": ["m", "k"], "q": []}


def test_label_copies(spark):
    schema = "subject_id string, label string, label_2 string"
    even = spark.createDataFrame([("s", "a", "a")], schema)
    assert resolve_label(even, "label")[1:] == ("label", ["label_2"])
    fuller = spark.createDataFrame([("s", None, "a"), ("t", "b", "b")], schema)
    assert resolve_label(fuller, "label")[1:] == ("label_2", ["label"])


def test_cutoff():
    assert na_cutoff([0, 4, 8, 100]) == 3.0
    assert na_cutoff([2, 4, 8, 100], preserve_samples=True) == 2.75


def test_greedy_filter_against_brute_force():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(200, 3))
    data = np.hstack([base, base + rng.normal(size=(200, 3)) / 5, base[:, :2] + rng.normal(size=(200, 2)) / 8])
    r = np.abs(np.corrcoef(data.T))
    np.fill_diagonal(r, 0)
    left = list(range(8))
    while True:
        part = r[np.ix_(left, left)]
        if part.max() <= 0.9:
            break
        i, j = np.unravel_index(part.argmax(), part.shape)
        means = part.sum(axis=0)
        i, j = min(i, j), max(i, j)
        left.pop(i if means[i] > means[j] else j)
    names = [f"c{i}" for i in range(8)]
    dropped = greedy_correlation_filter(np.corrcoef(data.T), names, 0.9)
    assert [n for n in names if n not in dropped] == [names[i] for i in left]


def test_a_killed_writer_leaves_the_old_tables(spark, studies, tmp_path):
    out = str(tmp_path / "report")
    first = spark.createDataFrame([(1,)], "v int")
    second = spark.createDataFrame([(2,), (3,)], "v int")
    sinks.write_together({"a": (first, "parquet"), "sub/b": (first, "csv")}, out)
    assert spark.read.parquet(f"{out}/a").collect() == first.collect()
    failing = second.select(F.raise_error(F.lit("no more")).cast("int").alias("v"))
    with pytest.raises(Exception, match="no more"):  # after one table is staged
        sinks.write_together({"a": (second, "parquet"), "sub/b": (failing, "csv")}, out, "overwrite")
    assert spark.read.parquet(f"{out}/a").count() == 1 and spark.read.csv(f"{out}/sub/b", header=True).count() == 1
    with pytest.raises(FileExistsError):
        sinks.write_together({"a": (second, "parquet")}, out)
    sinks.write_together({"a": (second, "parquet"), "c": (second, "parquet")}, out, "ignore")
    assert spark.read.parquet(f"{out}/a").count() == 1 and spark.read.parquet(f"{out}/c").count() == 2


def test_a_writer_killed_after_its_commit_is_finished(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "report")
    first, second = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([(2,), (3,)], "v int")
    sinks.write_together({"a": (first, "parquet"), "b": (first, "parquet")}, out)
    move = sinks._Folder.move

    def once(self, source, target):
        if target == "b":
            raise KeyboardInterrupt
        move(self, source, target)

    monkeypatch.setattr(sinks._Folder, "move", once)
    with pytest.raises(KeyboardInterrupt):
        sinks.write_together({"a": (second, "parquet"), "b": (second, "parquet")}, out, "overwrite")
    monkeypatch.setattr(sinks._Folder, "move", move)
    assert sinks.finish_commit(spark, out) and not sinks.finish_commit(spark, out)
    assert spark.read.parquet(f"{out}/a").count() == 2 and spark.read.parquet(f"{out}/b").count() == 2


def test_groups_by_union_equal_those_of_distributed_rounds(spark, monkeypatch):
    import random

    from mergewell.operators import redundancy

    random.seed(3)
    columns = [f"c{i}" for i in range(60)]
    pairs = spark.createDataFrame(
        [(*random.sample(columns, 2), random.choice([0.2, -0.99, 0.995])) for _ in range(45)], "a string, b string, corr double")
    rows = lambda df: sorted((r["group_id"], r["keep"], tuple(r["members"])) for r in df.collect())
    united = rows(redundancy.group_correlated(pairs, columns, 0.9))
    monkeypatch.setattr(redundancy, "UNION_PAIRS", 3)
    assert united == rows(redundancy.group_correlated(pairs, columns, 0.9)) or len(united) == 60
    assert sum(len(m) + 1 for _, _, m in united) == 60


def test_bucketed_datasets_merge_without_a_shuffle(spark, tmp_path):
    from mergewell.operators.merge import merge_all, merge_bucketed

    a = spark.createDataFrame([(i, i * 2, "x") for i in range(0, 60, 2)], "k int, v int, w string")
    b = spark.createDataFrame([(i, str(i)) for i in range(0, 60, 3)] + [(None, "no key")], "k int, w string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in (("merge_a", a), ("merge_b", b)):
            sinks.write_bucketed(df, name, "k", 4, str(tmp_path / name))
        merged = merge_bucketed(spark.table("merge_a"), spark.table("merge_b"), "k")
        rows = sorted(map(tuple, merged.collect()))
        assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
        assert rows == sorted(map(tuple, merge_all([a, b], "k").collect())) and merged.columns == ["k", "v", "w", "w_2"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("merge_a", "merge_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_merge_packs_one_dataset_per_row(spark):
    from mergewell.operators.merge import merge_all

    frames = [spark.createDataFrame([("a", 1), ("b", None)], "k string, x int"), spark.createDataFrame([("b",), ("c",)], "k string"),
              spark.createDataFrame([("c", 2, "t"), (None, 3, "u")], "k string, x int, y string")]
    merged = merge_all(frames, "k")
    assert sorted(map(tuple, merged.collect())) == [("a", 1, None, None), ("b", None, None, None), ("c", None, 2, "t")]
    assert "SortAggregate" not in merged._jdf.queryExecution().executedPlan().toString()
