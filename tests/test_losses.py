"""Cells and rows that reading and merging leave out are counted."""

from mergewell.operators.merge import missing_keys
from mergewell.plans.profile import profile
from mergewell.sources.delimited import read_all


def test_surplus_cells_and_missing_subjects_are_reported(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("subject_id,a,b\ns1,1,2\ns2,1,2,3\ns3,1,2,,5\ns4,1\n,7,8\nNA,x,y\n")
    (tmp_path / "nokey.csv").write_text("person,a\np,1\nq,1,2\n")
    (tmp_path / "fine.csv").write_text('subject_id,a\ns1,"1,2"\ns2,\n')
    report = profile(spark, read_all(spark, str(tmp_path)))
    assert {tuple(r) for r in report.losses.collect()} == {
        ("wide", "cells_unlike_header", 3), ("wide", "subject_id_missing", 2), ("nokey", "cells_unlike_header", 1)}
    counts = {r["feature"]: (r["na_count"], r["have_data"]) for r in report.na_counts.filter("dataset = 'wide'").collect()}
    assert counts == {"a": (0, 4), "b": (1, 3)}
    rows = {r["subject_id"]: (r["a"], r["b"]) for r in report.clean["wide"].collect()}
    assert rows == {"s1": (1, 2), "s2": (1, 2), "s3": (1, 2), "s4": (1, None)}


def test_rows_without_a_key_are_counted_before_a_merge(spark):
    frame = spark.createDataFrame([("s1", 1), (None, 2)], "subject_id string, a int")
    assert missing_keys({"x": frame, "y": frame.limit(0)}, "subject_id") == [("x", 1)]
