import datetime as dt

import pytest
from pyspark.sql import functions as F

from brightloom.functions import strings as S, values as V, vectors as X


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_single_space_split_keeps_empty_words(spark):
    got = column(spark, [("#a #b #a",), ("a  #a",), ("",), (None,)], "v string", S.split_single_space("v"))
    assert got == [["#a", "#b", "#a"], ["a", "", "#a"], [""], None]


def test_row_mean_skips_nulls_and_rounds_half_to_even(spark):
    rows = [(1.0, 2.0, None, 4.0, 5.0), (None,) * 5, (2.0, 3.0, 2.0, 3.0, None)]
    cols = list("abcde")
    schema = ", ".join(f"{c} double" for c in cols)
    assert column(spark, rows, schema, V.row_mean(cols)) == [3.0, None, 2.5]
    assert column(spark, rows, schema, V.row_mean(cols, rounded=True)) == [3.0, None, 2.0]


def test_score_bins_are_right_closed(spark):
    rows = [(x,) for x in (0.0, 0.3, 0.3000001, 0.6, 0.9, 0.91, -1.0, None)]
    assert column(spark, rows, "v double", V.bin_score("v")) == [1, 2, 3, 3, 4, 5, 1, 0]


def test_tenure(spark):
    rows = [("worked full-time for more than 5 years",), ("part-time less than a year",), ("a year",), ("years",), (None,)]
    assert column(spark, rows, "v string", S.tenure_years("v")) == [5.5, 0.5, 1.0, 0.0, None]
    assert column(spark, rows, "v string", S.employment_status("v")) == ["ex", "current", "current", "current", None]
    assert column(spark, rows, "v string", S.employment_type("v")) == ["full-time", "part-time", "unknown", "unknown", None]


def test_recommendation_lines(spark):
    rows = [("R\nO\nApproves of CEO",), ("R\nNo CEO",), ("R\nO",), ("R",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    got = df.select(*[c.alias(n) for n, c in S.recommendation_lines("v").items()]).collect()
    assert [tuple(r) for r in got] == [("R", "O", "Approves of CEO"), ("R", None, "No CEO"), ("R", "O", None),
                                       ("R", None, None), (None, None, None)]


def test_parenthesised_count(spark):
    rows = [("Helpful (12)",), ("plain",), (None,), ("",)]
    assert column(spark, rows, "v string", S.parenthesised_count("v")) == ["12", "plai", "0", ""]


def test_entity_from_path(spark):
    rows = [("C:\\data\\acme corp.txt",), ("/x/y/Beta.v1.csv",)]
    assert column(spark, rows, "v string", S.entity_from_path("v")) == ["ACME CORP", "BETA.V1"]


def test_dates(spark):
    rows = [(dt.date(2012, 1, 1),), (dt.date(2012, 12, 31),)]
    parts = V.date_parts("d")
    assert column(spark, rows, "d date", parts["dayofweek"]) == [6, 0]
    assert column(spark, rows, "d date", parts["quarter"]) == [1, 4]
    assert column(spark, rows, "d date", V.season(F.month("d"))) == ["winter", "winter"]


def test_daylight_is_closed_and_null_bounds_are_dark(spark):
    rows = [(5, 6, 18), (6, 6, 18), (18, 6, 18), (19, 6, 18), (9, None, None)]
    assert column(spark, rows, "h int, a int, b int", V.within_interval("h", "a", "b")) == [0, 1, 1, 0, 0]


def test_vectors(spark):
    rows = [([0.0, 127.5, 255.0],), ([3.0, 3.0],)]
    assert column(spark, rows, "v array<double>", X.to_unit_range("v"))[0] == [-1.0, 0.0, 1.0]
    got = column(spark, rows, "v array<double>", X.display_bytes("v"))
    assert got[0] == [49, 128, 206] and got[1] is None


def test_interaction_and_flags(spark):
    rows = [("mist", 0.3, 2.0, 1.0), ("rain", 0.1, 1.0, 2.0), (None, None, None, 1.0)]
    schema = "w string, g double, a double, b double"
    assert column(spark, rows, schema, V.interaction("w", ["clear", "mist"], "g")) == [2, 0, 0]
    assert column(spark, rows, schema, V.diff_flag("a", "b")) == ["feels_warmer", "feels_colder", "feels_colder"]
