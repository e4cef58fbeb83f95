from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillframe import TableError, join_tables
from quillframe.operators.joins import equi_join


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 2.0), (2, "bb", 2.5), (3, "c", 3.0), (None, "n", 4.0), (None, "m", 5.0)], "k long, name string, v double"
    )
    right = spark.createDataFrame(
        [(2, "b", 9.0), (2, "x", 8.0), (3, "c", 7.0), (None, "n", 6.0), (7, "g", 5.0), (8, "h", 4.0)], "k2 long, name string, w double"
    )
    return left, right


def rows(df):
    return sorted((tuple(None if pd.isna(v) else v for v in row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_missing_keys_match_like_pandas(sides, how):
    left, right = sides
    joined = join_tables(left, right, "k", "k2", how, keep=["k2", "name_right"]).table
    expected = left.toPandas().merge(right.toPandas(), left_on="k", right_on="k2", how=how, suffixes=("_left", "_right"))
    assert joined.columns == list(expected.columns)
    found = [tuple(None if pd.isna(v) else v for v in row) for row in expected.itertuples(index=False)]
    assert rows(joined) == sorted(found, key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_shared_key_stays_one_column(sides, how):
    left, right = sides
    right = right.withColumnRenamed("k2", "k")
    joined = join_tables(left, right, "k", "k", how, keep=["name_right"]).table
    expected = left.toPandas().merge(right.toPandas(), on="k", how=how, suffixes=("_left", "_right"))
    assert joined.columns == list(expected.columns)
    found = [tuple(None if pd.isna(v) else v for v in row) for row in expected.itertuples(index=False)]
    assert rows(joined) == sorted(found, key=repr)


def test_redundant_columns(sides):
    left, _ = sides
    twin = left.where("k > 2").withColumn("v", F.col("v") + 1).withColumnRenamed("k", "k2")
    result = join_tables(left, twin, "k", "k2")
    assert [(r.column, r.matches) for r in result.removed] == [("name_right", "name_left"), ("k2", "k")]
    assert result.table.columns == ["k", "name_left", "v_left", "v_right"]
    assert result.table.count() == 1
    kept = join_tables(left, twin, "k", "k2", keep=["name_right", "k2"])
    assert kept.removed == [] and "k2" in kept.table.columns


def test_empty_join_makes_everything_redundant(sides):
    left, right = sides
    result = join_tables(left, right.where("k2 = 7"), "k", "k2")
    assert {r.column for r in result.removed} == {"name_right", "k2"} and result.table.count() == 0


def test_text_comparison_across_types(spark):
    left = spark.createDataFrame([(1, 5), (2, None)], "k long, v long")
    right = spark.createDataFrame([(1, "5"), (2, None)], "k long, v string")
    assert [r.column for r in join_tables(left, right, "k", "k").removed] == ["v_right"]
    floats = spark.createDataFrame([(1, 5.0), (2, None)], "k long, v double")
    assert join_tables(left, floats, "k", "k").removed == []  # 5 and 5.0 read differently


def test_column_that_merely_ends_like_the_suffix(spark):
    left = spark.createDataFrame([(1, "x")], "k long, hand string")
    right = spark.createDataFrame([(1, "x")], "k long, hand_right string")
    assert [r.column for r in join_tables(left, right, "k", "k").removed] == ["hand_right"]


def test_requests_that_do_not_fit(sides):
    left, right = sides
    for arguments in [("k", "k2", "cross"), ("unknown", "k2", "inner"), ("k", "name", "inner")]:
        with pytest.raises(TableError):
            join_tables(left, right, *arguments)
    with pytest.raises(TableError):
        equi_join(left, right, "k", "k2", suffixes=("", ""))


def test_plans_have_no_cross_product(spark, sides):
    left, right = sides
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left", "right", "outer"):
            plan = equi_join(left, right, "k", "k2", how)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("how", ["inner", "left", "outer"])
def test_hot_key_is_split_at_run_time(spark, how):
    """A key that holds a third of the left rows; Spark splits its partition, and every row is there."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        right = spark.range(0, 90000, 3, 8).select(F.when(F.col("id") == 0, None).otherwise(F.col("id") + 1).alias("k2"), F.col("id").alias("w"))
        joined = equi_join(left, right, "k", "k2", how)
        total = joined.agg(F.count(F.lit(1)), F.count("v"), F.count("w"))
        counts = total.collect()[0]
        plan = total._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        matched = 20000 + 19999  # the missing keys, and the keys 4, 7, ... below 60,000
        alone = 30000 - 1 - 19999  # right keys beyond the left table
        assert counts[0] == {"inner": matched, "left": 60000, "outer": 60000 + alone}[how]
        assert counts[2] == {"inner": matched, "left": matched, "outer": matched + alone}[how]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
