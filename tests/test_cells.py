from pyspark.sql import functions as F

from mergewell.functions.cells import (
    NA_TOKENS, as_number, clean_text, is_numeric_text, is_symbol_only, is_us_date, null_tokens)
from mergewell.functions.naming import base_name, clean_name, clean_names, dataset_name
from mergewell.operators.columns import infer_types


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_na_tokens(spark):
    assert len(set(NA_TOKENS)) == 26
    assert column(spark, [*NA_TOKENS, "x", "NA  "], null_tokens) == [None] * 26 + ["x", "NA  "]


def test_numbers(spark):
    values = ["1", " 7 ", "1e3", "-.5", "1d", "NaN", "Infinity", "", "x", None]
    good = [True] * 4 + [False] * 5 + [None]
    assert column(spark, values, is_numeric_text) == good
    assert column(spark, values, as_number) == [1.0, 7.0, 1000.0, -0.5] + [None] * 6


def test_us_dates(spark):
    values = ["12/14/16", "12/14/2016 10:30", "1/2/2003", "2016-12-14", "7", "13/1/2016", "2/30/2016", None]
    assert column(spark, values, is_us_date) == [True] * 3 + [False] * 5


def test_symbols(spark):
    assert column(spark, ["-?", "**", "a-", "0", None], is_symbol_only) == [True, True, False, False, False]


def test_text_and_name_cleaning_agree(spark):
    names = ["Fasted.Salivary.Cortisol.nmol.L", "a%b", "#1 item", "myName", "2nd", "__x__", "it's"]
    expected = ["fasted_salivary_cortisol_nmol_l", "a_percent_b", "number_1_item", "my_name",
                "x2nd", "x", "its"]
    assert [clean_name(n) for n in names] == expected
    assert column(spark, names, clean_text) == expected


def test_unique_names():
    assert clean_names(["a", "A", "a_2", "b"]) == ["a", "a_2", "a_2_2", "b"]
    assert clean_names(["", "é"]) == ["x", "e"]
    assert dataset_name("/x/My Data.v2.csv") == "my_data"
    assert [base_name(n) for n in ("a_2", "a.x", "a.y", "a_12", "a")] == ["a", "a", "a", "a_12", "a"]


def test_infer_types(spark):
    df = spark.createDataFrame(
        [("1", "x", None, "nan"), ("2.5", "1", None, "3")], "n string, t string, z string, g string")
    typed = infer_types(df)
    assert [f.dataType.simpleString() for f in typed.schema] == ["double", "string", "string", "double"]
    assert [r["g"] for r in typed.collect()] == [None, 3.0]
