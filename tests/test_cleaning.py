"""Cleaning operators against the same step in pandas, on small hand-made tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillframe import TableError, clean, field, run_steps
from quillframe.operators import cleaning as C, reports as R


def frame(df, key="id"):
    """The table in pandas, by key, with gaps as NaN or None."""
    return df.orderBy(key).toPandas()


def same(left, right):
    for a, b in zip(left, right, strict=True):
        if pd.isna(a) or pd.isna(b):
            assert pd.isna(a) and pd.isna(b)
        elif isinstance(a, (float, np.floating)):
            assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
        else:
            assert a == b


@pytest.mark.parametrize("columns", [["n"], ["n", "i"], [], ["unknown"]])
def test_remove_missing(gaps, columns):
    expected = frame(gaps).dropna(subset=[c for c in columns if c in gaps.columns] or None)
    assert frame(C.remove_missing(gaps, columns))["id"].tolist() == expected["id"].tolist()


@pytest.mark.parametrize("method", ["mean", "median"])
def test_fill_numbers(gaps, method):
    filled, before = frame(C.fill_missing(gaps, ["n", "i", "empty"], method)), frame(gaps)
    same(filled["n"], before["n"].fillna(getattr(before["n"], method)()))
    same(filled["i"], before["i"].fillna(getattr(before["i"], method)()))


def test_fill_of_a_column_without_values_uses_the_constant(gaps):
    assert frame(C.fill_missing(gaps, ["empty"], "mode", 3))["empty"].tolist() == [3.0] * 12


def test_mean_does_not_change_the_type_of_a_column_without_gaps(gaps):
    assert dict(C.fill_missing(gaps, ["id"], "mean").dtypes)["id"] == "bigint"


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("x", 9), ("y", 10), ("y", 9), ("x", 10), (None, None)], "s string, v long")
    filled = C.fill_missing(df, method="mode").where("s = 'x' AND v = 9").count()
    assert filled == 2


def test_fill_rejects_a_constant_of_the_wrong_type(gaps):
    with pytest.raises(TableError):
        C.fill_missing(gaps, ["n"], "constant", "abc")
    with pytest.raises(TableError):
        C.fill_missing(gaps, ["n"], "guess")


def test_duplicates_treat_gaps_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (None, "a"), (1, "a"), (1, "b")], "a long, b string")
    assert C.remove_duplicates(df).count() == len(df.toPandas().drop_duplicates()) == 4
    assert R.duplicate_rows(df).first()["duplicate_rows"] == 2


def test_digest_tells_shifted_gaps_and_texts_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a,1:b", "c"), ("a", "b,1:c"), ("~", None), (None, "~")], "a string, b string")
    assert R.duplicate_rows(df).first()["duplicate_rows"] == 0


def test_outliers_in_turn(spark):
    rows = [(i, float(i % 5), float(i)) for i in range(18)] + [(18, 100.0, 1000.0), (19, None, 10.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    expected = frame(df)
    for column in ("x", "y"):
        q1, q3 = expected[column].quantile([0.25, 0.75])
        keep = expected[column].between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) | expected[column].isna()
        expected = expected[keep]
    assert frame(C.remove_outliers(df, ["x", "y", "unknown"]))["id"].tolist() == expected["id"].tolist()
    assert C.remove_outliers(df, []).count() == 20


def test_outliers_refuse_truth_values(gaps):
    with pytest.raises(TableError):
        C.remove_outliers(gaps, ["b"])


def test_normalize(gaps, spark):
    before = frame(gaps)
    scaled = frame(C.normalize(gaps, ["n", "same", "empty", "s"]))
    same(scaled["n"], (before["n"] - before["n"].mean()) / before["n"].std())
    assert scaled["same"].tolist() == [0.0] * 12  # the gap as well
    assert scaled["empty"].isna().all()
    low, high = before["n"].min(), before["n"].max()
    same(frame(C.normalize(gaps, ["n"], "minmax"))["n"], (before["n"] - low) / (high - low))
    one = spark.createDataFrame([(1, 5.0), (2, None)], "id long, x double")
    assert frame(C.normalize(one, ["x"]))["x"].isna().all()
    assert frame(C.normalize(one, ["x"], "minmax"))["x"].tolist() == [0.0, 0.0]


def test_replace(spark):
    df = spark.createDataFrame([(1, 2.5, "On", True), (2, 2.0, "off", False), (3, None, None, None)], "id long, x double, s string, b boolean")
    assert frame(C.replace_values(df, "s", "on", "X"))["s"].tolist() == ["On", "off", None]  # case counts
    assert frame(C.replace_values(df, "x", "2.5", "9"))["x"].tolist()[:2] == [9.0, 2.0]
    assert frame(C.replace_values(df, "id", "2.9", "7.9"))["id"].tolist() == [1, 3, 7]
    assert frame(C.replace_values(df, "b", 1, 0))["b"].tolist() == [False, False, None]
    assert frame(C.replace_values(df, "s", None, "X"))["s"].tolist() == ["On", "off", None]
    limited = C.replace_values(df, "s", "off", None, (field("x") > 1) & (field("id") != 1))
    assert frame(limited)["s"].tolist() == ["On", None, None]
    with pytest.raises(TableError):
        C.replace_values(df, "unknown", 1, 2)
    with pytest.raises(TableError):
        C.replace_values(df, "x", "abc", 1)


TEXTS = ["0.5", "1.5", "2.5", "x", " 7 ", "1e3", "NaN", "inf", "yes", "N", "TRUE", "1.0", "t", "1d", "0x10", "-", "9007199254740993", None]


def test_convert_numbers_like_pandas(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    numbers = pd.to_numeric(pd.Series(TEXTS, dtype=object), errors="coerce")
    same(frame(C.convert_type(df, "t", "decimal"))["t"].astype(float), numbers)
    whole = C.convert_type(df, "t", "integer").orderBy("id").collect()
    found = [row["t"] for row in whole]
    assert found[:6] == [0, 2, 2, None, 7, 1000]
    assert found[6:8] == [None, None] and found[16] == 9007199254740993


def test_convert_truth_values(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    found = [row["t"] for row in C.convert_type(df, "t", "boolean").orderBy("id").collect()]
    assert found[8:13] == [True, False, True, None, None]
    numbers = spark.createDataFrame([(1, 1.0, 1), (2, 0.0, 0)], "id long, d double, i int")
    assert [r["d"] for r in C.convert_type(numbers, "d", "boolean").collect()] == [None, None]
    assert [r["i"] for r in C.convert_type(numbers, "i", "boolean").orderBy("id").collect()] == [True, False]


def test_convert_dates(spark):
    df = spark.createDataFrame([(1, "2024-01-02"), (2, "01/03/2024"), (3, "soon"), (4, "2024-01-02 03:04:05.678901")], "id long, t string")
    moments = [row["t"] for row in C.convert_type(df, "t", "datetime").orderBy("id").collect()]
    assert [str(m) for m in moments] == ["2024-01-02 00:00:00", "2024-01-03 00:00:00", "None", "2024-01-02 03:04:05.678901"]
    days = [str(row["t"]) for row in C.convert_type(df, "t", "date").orderBy("id").collect()]
    assert days == ["2024-01-02", "2024-01-03", "None", "2024-01-02"]
    assert R.conversion_failures(df, "t", "date").first()["failed"] == 1
    with pytest.raises(TableError):
        C.convert_type(spark.createDataFrame([(2024,)], "year int"), "year", "datetime")
    with pytest.raises(TableError):
        C.convert_type(df, "t", "colour")


def test_custom_functions_are_checked(gaps):
    with pytest.raises(TableError):
        C.custom_clean(gaps, lambda df: df.count())
    with pytest.raises(Exception, match="must return a DataFrame"):
        C.custom_clean_batches(gaps, lambda batch: 3, gaps.schema).collect()
    kept = C.custom_clean_batches(gaps.select("id", "n"), lambda batch: batch[batch["id"] > 5], "id long, n double")
    assert kept.count() == 6


def test_steps_equal_single_calls(gaps):
    steps = [("remove_duplicates", {}), ("fill_missing", {"columns": ["n"], "method": "mean"}), lambda df: df.where("id > 2"), ("normalize", {"columns": ["n"]})]
    chained = frame(run_steps(gaps, steps))
    single = C.normalize(C.fill_missing(C.remove_duplicates(gaps), ["n"], "mean").where("id > 2"), ["n"])
    same(chained["n"], frame(single)["n"])
    with pytest.raises(TableError):
        clean(gaps, "polish")


def test_filling_leaves_no_gap_and_keeps_every_row(gaps):
    for method in C.FILL_METHODS:
        filled = C.fill_missing(gaps, method=method)
        gaps_left = filled.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled.columns]).first()
        # A column without any value has no mean or median, so it stays missing.
        assert sum(gaps_left) == (12 if method in ("mean", "median") else 0) and filled.count() == 12


def test_nested_columns_are_refused(spark):
    nested = spark.createDataFrame([(1, [1, 2])], "id long, a array<int>")
    with pytest.raises(TableError):
        run_steps(nested, [("remove_duplicates", {})])


def test_scorecard_of_an_empty_result(gaps):
    rows = {r["metric"]: r["percent"] for r in R.quality_scorecard(gaps, gaps.where("id < 0").select("id")).collect()}
    assert rows["unique_rows"] == 100.0 and rows["rows_retained"] == 0.0
