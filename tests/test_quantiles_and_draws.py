"""Quantiles, samples and splits against brute force, with one value or class holding much of the table."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from quillframe import TableError
from quillframe.functions.hashing import seeded_hash
from quillframe.operators import quantiles as Q, sampling as S
from quillframe.sources.tables import with_row_key

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("limit", [50_000, 100, 3])
def test_quantiles_equal_pandas_at_every_narrowing(spark, limit):
    chance = random.Random(5)
    hot = [0.5] * 2000  # a third of the rows
    values = hot + [chance.expovariate(1) * chance.choice([1, 1000]) for _ in range(4000)]
    rows = [(float(v), int(v * 7) % 50, None if i % 2 else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "x double, k long, half double")
    found = Q.exact_quantiles(df, ["x", "k", "half"], PROBABILITIES, bracket_values=limit)
    pdf = df.toPandas()
    for column in pdf.columns:
        assert np.allclose(found[column], pdf[column].quantile(PROBABILITIES), rtol=1e-12, atol=0)


def test_quantiles_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(None, 3.0), (None, None)], "a double, b double")
    assert Q.exact_quantiles(df, ["a", "b"], [0.25, 0.5]) == {"a": [None, None], "b": [3.0, 3.0]}
    assert Q.exact_quantiles(df, [], [0.5]) == {}


def test_quantiles_with_infinities_and_truth_values(spark):
    df = spark.createDataFrame([(float("inf"), True), (1.0, False), (2.0, True), (float("-inf"), None)], "a double, b boolean")
    assert Q.exact_quantiles(df, ["a"], [0.0, 1.0])["a"] == [float("-inf"), float("inf")]
    assert Q.exact_quantiles(df, ["b"], [0.5])["b"] == [1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows; class ``a`` holds about half of them, class ``d`` two."""
    names = F.when(F.col("id") < 2500, "a").when(F.col("id") < 4000, "b").when(F.col("id") < 4998, "c").otherwise("d")
    return spark.range(5000).withColumn("cls", names).withColumn("x", F.col("id") * 2.0)


def brute_rank(df, by=None):
    order = Window.orderBy("h", "id") if by is None else Window.partitionBy(by).orderBy("h", "id")
    return df.withColumn("h", seeded_hash(["id"], 42)).withColumn("place", F.row_number().over(order))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 4999])
def test_sample_is_the_rows_of_smallest_hash(spark, skewed, n):
    expected = {r["id"] for r in brute_rank(skewed).where(F.col("place") <= n).collect()}
    assert {r["id"] for r in S.hash_sample(skewed, n, ["id"]).collect()} == expected
    assert {r["id"] for r in S.hash_sample(skewed.repartition(7), n, ["id"]).collect()} == expected


@pytest.mark.parametrize("pct", [1, 33, 50, 99])
def test_exact_split_has_the_exact_size(skewed, pct):
    split = S.random_split(skewed, pct, ["id"], exact=True)
    expected = {r["id"] for r in brute_rank(skewed).where(F.col("place") <= 5000 * pct // 100).collect()}
    assert {r["id"] for r in split.where("split = 'train'").collect()} == expected
    assert split.count() == 5000


@pytest.mark.parametrize("pct", [1, 33, 70])
def test_stratified_split_equals_brute_force(skewed, pct, monkeypatch):
    if pct == 33:  # several rounds for the large classes, none for the small ones
        monkeypatch.setattr(S, "_RANKED_ROWS", 40)
        monkeypatch.setattr(S, "_STEP", 1)
    split = S.stratified_split(skewed, "cls", pct, ["id"])
    sizes = {r["cls"]: r["count"] for r in skewed.groupBy("cls").count().collect()}
    take = {c: n * pct // 100 for c, n in sizes.items()}
    owed = 5000 * pct // 100 - sum(take.values())
    for name in sorted(sizes, key=lambda c: (-(sizes[c] * pct % 100), c))[:owed]:
        take[name] += 1
    ranked = brute_rank(skewed, "cls").collect()
    expected = {r["id"] for r in ranked if r["place"] <= take[r["cls"]]}
    assert {r["id"] for r in split.where("split = 'train'").collect()} == expected
    assert split.count() == 5000


def test_stratified_split_leaves_rows_without_class_out(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "ab"[i % 2]) for i in range(40)], "id long, cls string")
    assert S.stratified_split(df, "cls", 50, ["id"]).count() == 30


def test_split_does_not_depend_on_the_partitioning(skewed):
    first = S.random_split(skewed, 70, ["id"]).where("split = 'train'").agg(F.sum("id"), F.count("id")).first()
    second = S.random_split(skewed.repartition(13, "x"), 70, ["id"]).where("split = 'train'").agg(F.sum("id"), F.count("id")).first()
    assert first == second and abs(first[1] - 3500) < 150


def test_whole_rows_serve_as_key(spark):
    df = spark.createDataFrame([(i % 50, "s") for i in range(500)], "a long, s string")
    split = S.random_split(df, 70)
    assert split.select("a", "split").distinct().count() == 50  # copies stay together
    assert split.count() == 500


@pytest.fixture(scope="module")
def copied(spark):
    """3,000 rows, of which 1,000 are the same."""
    return spark.range(3000).select(F.greatest(F.col("id"), F.lit(1000)).alias("a"), F.lit("s").alias("s"))


@pytest.mark.parametrize("n", [1, 500, 1500, 2999])
def test_sample_with_many_copies_has_the_exact_size(copied, n):
    assert S.hash_sample(copied, n).count() == n
    found = S.hash_sample(copied, n).groupBy("a").count().where("a <> 1000 AND count > 1")
    assert found.count() == 0


def test_split_by_a_stored_row_key(spark, copied, tmp_path):
    copied.write.parquet(str(tmp_path / "t"))
    keyed = with_row_key(spark.read.parquet(str(tmp_path / "t")))
    assert keyed.select("_row_key").distinct().count() == 3000
    split = S.random_split(keyed, 70, ["_row_key"], exact=True)
    assert split.where("split = 'train'").count() == 2100
    assert 600 < split.where("split = 'train' AND a = 1000").count() < 800  # the copies are divided as well


def test_one_class_of_all_rows_is_never_ranked_whole(spark, monkeypatch):
    monkeypatch.setattr(S, "_RANKED_ROWS", 30)
    monkeypatch.setattr(S, "_STEP", 2)
    df = spark.range(3000).select("id", F.lit("all").alias("cls"))
    kept, settle = [], S.settle
    monkeypatch.setattr(S, "settle", lambda table: kept.append(settle(table)) or kept[-1])
    assert S.stratified_split(df, "cls", 40, ["id"]).where("split = 'train'").count() == 1200
    assert any("inside" in table.columns and table.first()["inside"] <= 30 for table in kept)


def test_sample_by_a_key_that_is_not_unique_is_repeatable(spark):
    df = spark.range(4000).select((F.col("id") % 7).alias("k"), "id")
    first, again = (sorted(map(tuple, S.hash_sample(part, 1000, ["k"]).collect())) for part in (df.repartition(2), df.repartition(5)))
    assert first == again and len(first) == 1000


def test_the_cut_is_narrowed_until_its_bucket_is_small(spark, monkeypatch):
    monkeypatch.setattr(S, "_RANKED_ROWS", 2)
    monkeypatch.setattr(S, "_STEP", 1)
    df = spark.range(500).withColumn("v", F.col("id") * 2)
    wanted = sorted(r["id"] for r in S.hash_sample(df, 123, ["id"]).collect())
    monkeypatch.undo()
    assert wanted == sorted(r["id"] for r in S.hash_sample(df, 123, ["id"]).collect())


def test_stratified_split_with_many_copies_is_whole(copied):
    split = S.stratified_split(copied.withColumn("cls", (F.col("a") % 2).cast("string")), "cls", 70)
    assert split.count() == 3000 and split.select("a", "split").distinct().count() == 2001 - 1


def test_budgets(skewed):
    assert S.within_budget(skewed, "full") is skewed
    assert S.budget_limit("sample") == 10_000 and S.budget_limit("chunked") == 50_000
    for wrong in ("turbo", ""):
        with pytest.raises(TableError):
            S.budget_limit(wrong)
    for wrong in (0, 100):
        with pytest.raises(TableError):
            S.random_split(skewed, wrong, ["id"])
    with pytest.raises(TableError):
        S.require_rows(skewed.limit(9))
    with pytest.raises(TableError):
        S.hash_sample(skewed, 5, ["unknown"])


def test_class_sizes(skewed):
    sizes = S.class_sizes(skewed, "cls")
    assert (sizes.rows, sizes.classes, sizes.smallest, sizes.largest) == (5000, 4, 2, 2500)
    assert S.can_stratify(sizes)
    assert not S.can_stratify(S.class_sizes(skewed.where("id > 4998 OR cls = 'a'"), "cls"))
