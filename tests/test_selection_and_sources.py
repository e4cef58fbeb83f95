from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from quillframe import TableError, drop_columns, field, keep_rows, read_csv, rename_columns, select_columns, write_csv
from quillframe.functions.names import clean_headers, plain_name
from quillframe.operators.predicates import EVERY_ROW
from quillframe.sources import tables


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(1, 2.0, "Ready"), (2, None, "ready"), (3, 7.5, None), (None, 2.5, "Done")]
    return spark.createDataFrame(rows, "`ID` long, `Score` double, `Status` string")


def ids(df):
    return [row["ID"] for row in df.orderBy(F.col("ID").asc_nulls_last()).collect()]


@pytest.mark.parametrize(
    "condition, expected",
    [
        (field("Score") == 2, [1]),
        (field("Score") != 2, [2, 3, None]),  # a missing value differs
        (field("Score") < 2.6, [1, None]),
        (field("Score") >= "2.5", [3, None]),
        (field("ID") < 2.9, [1]),  # 2.9 acts as 2 on whole numbers
        (field("ID") == 2.9, [2]),
        (field("Status") == None, [3]),  # noqa: E711
        (field("Status") != None, [1, 2, None]),  # noqa: E711
        (field("Status") == "ready", [2]),
        (field("Status") > "Ready", [2]),
        ((field("Status") == "Ready") | (field("Score") > 2) & (field("ID") != 3), [1, None]),
        (((field("Status") == "Ready") | (field("Score") > 2)) & (field("ID") != 3), [1, None]),
        (EVERY_ROW, [1, 2, 3, None]),
    ],
)
def test_conditions(scores, condition, expected):
    assert ids(keep_rows(scores, condition)) == expected


def test_conditions_that_do_not_fit(scores):
    with pytest.raises(TableError):
        field("Score") < None
    with pytest.raises(TableError):
        keep_rows(scores, field("Score") == "high")
    with pytest.raises(TableError):
        keep_rows(scores, field("unknown") == 1)


def test_conditions_reach_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    kept = keep_rows(orders, (field("o_totalprice") > 1000) & (field("o_orderstatus") == "F")).select("o_orderkey")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,1000.0), EqualTo" in plan  # the rest of the line is cut off
    assert "o_orderdate" not in plan.split("ReadSchema")[1]


def test_column_choice(scores):
    assert select_columns(scores, ["Status", "no"], "Score").columns == ["Status", "Score"]
    for wrong in ([], ["Score"]):
        with pytest.raises(TableError):
            select_columns(scores, wrong, "Score")
    assert drop_columns(scores, ["ID", "no"]).columns == ["Score", "Status"]
    assert rename_columns(scores, {"ID": "Score", "Score": "ID"}).columns == ["Score", "ID", "Status"]
    with pytest.raises(TableError):
        rename_columns(scores, {"ID": "Score"})


def test_headers():
    assert clean_headers([" a ", "", "x", "x", "x", None]) == ["a", "column_2", "x", "x_2", "x_3", "column_6"]
    assert clean_headers(["x", "x", "x_2"]) == ["x", "x_3", "x_2"]
    assert clean_headers(["A", "a"]) == ["A", "a_2"]
    assert plain_name(" Unit-Price (EUR) ") == "unit_price_eur"


CSV = '﻿id, flag ,,x,x,note\n1,True,NA,0.5,007,"said ""no""\nand left"\n2,false,null,1e3,8,-\n\n3,,None,nan,9,N/A\n4,TRUE,,2,,plain\n'


def test_csv_reads_like_pandas(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV, encoding="utf-8")
    df = read_csv(spark, str(path), multiline=True)
    assert df.dtypes == [("id", "bigint"), ("flag", "boolean"), ("column_3", "double"), ("x", "double"), ("x_2", "bigint"), ("note", "string")]
    expected = pd.read_csv(path)
    found = df.orderBy("id").collect()
    assert len(found) == len(expected) == 4
    assert [r["note"] for r in found] == [None if pd.isna(v) else v for v in expected["note"]]
    assert [r["x"] for r in found] == [None if pd.isna(v) else v for v in expected["x"]]
    assert [r["x_2"] for r in found] == [7, 8, 9, None]
    assert df.count() == tables.count_rows(df).first()["rows"] == 4


def test_csv_with_a_schema_and_back(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n1,2024-01-02 03:04:05.123456\nx,\n", encoding="utf-8")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("at", T.TimestampNTZType())])
    df = read_csv(spark, str(path), schema, multiline=True)
    assert df.dtypes == [("n", "int"), ("at", "timestamp_ntz")]
    out = str(tmp_path / "out")
    write_csv(df, out)
    again = read_csv(spark, out, schema, multiline=True)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(TableError):
        read_csv(spark, str(path), T.StructType(schema.fields[:1]))


def test_unreadable_tables(spark, tmp_path):
    with pytest.raises(TableError):
        read_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(TableError):
        tables.read_parquet(spark, str(tmp_path / "absent"))
    with pytest.raises(TableError):
        tables.require_content(spark.createDataFrame([], "a long"))


def test_preview_is_safe(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5)], "id long, x double")
    assert [r["x"] for r in tables.preview(df, ["id"]).collect()] == [None, None, 1.5]
    assert tables.preview_json(df, ["id"], 1).first()["record"] == '{"id":1,"x":null}'


def test_row_keys_are_repeatable(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    first = tables.with_row_key(lines)
    assert first.select("_row_key").distinct().count() == lines.count()
    assert first.exceptAll(tables.with_row_key(spark.read.parquet(f"{folder}/lineitem.parquet"))).count() == 0


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "`a.b` long, `c.d` double")
    assert keep_rows(df, field("a.b") > 1).count() == 1
    assert select_columns(df, ["c.d"]).columns == ["c.d"]


@pytest.mark.parametrize(
    "texts, complaint",
    [(["a,b\n1,2\n3,4,5\n"], "more fields"), (['a,b\n1,"x\ny"\n'], "multiline=True"), (["a,b\n1,2\n", "b,a\n1,2\n"], "different headers")],
)
def test_faulty_csv_is_refused(spark, tmp_path, texts, complaint):
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_text(text)
    with pytest.raises(TableError, match=complaint):
        read_csv(spark, [str(tmp_path / f"{i}.csv") for i in range(len(texts))])


def test_short_rows_are_filled_and_files_are_joined(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1\n3,4\n")
    (tmp_path / "b.csv").write_text("a,b\n5,6\n")
    found = read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted(map(tuple, found.collect()), key=str) == [(1, None), (3, 4), (5, 6)]


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    from quillframe import session
    from quillframe.functions.sizing import store

    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    assert store(spark.range(5)).count() == 5 and any(tmp_path.iterdir())
    session.clear_scratch(spark)
    assert not [p for p in tmp_path.iterdir() if not p.name.endswith(".crc")]
