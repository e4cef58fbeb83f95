from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillframe import TableError, profile
from quillframe.operators.frequency import distinct_counts, facts_and_top, modes, top_values, value_counts
from quillframe.plans import profile as P


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, 20 + i % 7, f"2024-01-{1 + i % 28:02d}", i * 1.25, "yes" if i % 3 else "no") for i in range(50)]
    return spark.createDataFrame(rows, "customer_id long, age long, update_note string, monthly_price double, churn string")


def test_ranking_scores(people):
    scores = {r["column"]: r["score"] for r in P.rank_targets(people).collect()}
    assert scores == {
        "customer_id": 0 + 6 - 28 - 80,
        "age": 16 + 6,
        "update_note": 6,
        "monthly_price": 55 - 7 + 6 - 28,
        "churn": 100 - 10 + 15 + 16 + 6,
    }


def test_earlier_hint_wins_and_identifier_needs_the_last_word(spark):
    df = spark.createDataFrame([(i, i % 2, i % 3, i % 4) for i in range(30)], "class_label long, paid long, zip_code long, id_number long")
    rows = {r["column"]: r for r in P.rank_targets(df).collect()}
    assert rows["class_label"]["score"] == 55 - 1 + 6 - 28
    assert rows["paid"]["score"] == 16 + 6  # ends in "id", but not as a word
    assert rows["zip_code"]["score"] == 16 + 6 - 80
    assert rows["id_number"]["score"] == 15 + 16 + 6


def test_confidence(spark, people):
    chosen = P.choose_target(P.rank_targets(people)).first()
    assert (chosen["target"], chosen["confidence"]) == ("churn", "high")
    assert chosen["reason"].count("; ") == 2
    plain = spark.createDataFrame([(i % 9, i % 9, i % 9) for i in range(40)], "a long, b long, c long")
    assert P.choose_target(P.rank_targets(plain)).first()["confidence"] == "medium"
    one = spark.createDataFrame([(i,) for i in range(40)], "a long")
    row = P.choose_target(P.rank_targets(one)).first()
    assert (row["lead"], row["confidence"]) == (row["score"], "low")


@pytest.mark.parametrize(
    "rows, distinct, expected",
    [(60, 12, "classification"), (59, 12, "regression"), (1000, 31, "classification"), (1000, 32, "regression"), (100, 1, "unknown")],
)
def test_task_limits(spark, rows, distinct, expected):
    df = spark.range(rows).select((F.col("id") % distinct).alias("y"))
    assert P.detect_task(df, "y").first()["task"] == expected
    assert next(r["task"] for r in P.column_profiles(df).collect()) == expected


def test_task_of_texts(spark):
    df = spark.createDataFrame([(str(i),) for i in range(30)], "y string")
    assert P.detect_task(df, "y").first()["task"] == "classification"
    with pytest.raises(TableError):
        P.detect_task(df, "unknown")


def test_dates(spark, people):
    assert P.datetime_columns(people) == ["update_note", "monthly_price"]  # "month" and numbers
    mixed = spark.createDataFrame([(i, "soon" if i % 4 == 0 else "2024-05-06", "x", 2000 + i) for i in range(20)], "id long, date_a string, lifetime string, year long")
    assert P.datetime_columns(mixed) == ["year"]
    assert P.datetime_columns(mixed.where("id % 4 <> 0")) == ["date_a", "year"]


def test_numeric_summary_edges(gaps, spark):
    rows = {r["column"]: r for r in P.numeric_summary(gaps).collect()}
    pdf = gaps.toPandas()
    assert rows["n"]["mean"] == round(pdf["n"].mean(), 4) and rows["n"]["std"] == round(pdf["n"].std(), 4)
    assert rows["empty"]["mean"] is None and rows["empty"]["std"] is None
    assert rows["same"]["std"] == 0.0 and "b" in rows and "s" not in rows
    single = spark.createDataFrame([(5.0,)], "x double")
    assert P.numeric_summary(single).first()["std"] == 0.0


def test_whole_profile(people):
    record = profile(people.union(people.where("customer_id < 3")), "people", ["customer_id"])
    assert (record["rows"], record["columns"], record["duplicate_rows"], record["missing_cells"]) == (53, 5, 3, 0)
    assert (record["target"], record["task"], record["date_column"]) == ("churn", "classification", "update_note")
    ages = next(c for c in record["column_profiles"] if c["column"] == "age")
    assert (ages["distinct"], ages["min"], ages["max"], ages["top_values"]) == (7, 20.0, 26.0, None)
    churn = next(c for c in record["column_profiles"] if c["column"] == "churn")
    assert [(t["value"], t["n"]) for t in churn["top_values"]] == [("yes", 35), ("no", 18)]
    assert len(record["preview"]) == 12 and len(record["target_rankings"]) == 5
    changed = P.override(people, record, target="monthly_price", columns=["age"])
    assert (changed["task"], changed["target_confidence"], changed["selected_columns"]) == ("regression", "manual", ["age", "monthly_price"])
    for wrong in ({"target": "no"}, {"columns": []}, {"date_column": "no"}):
        with pytest.raises(TableError):
            P.override(people, record, **wrong)
    with pytest.raises(TableError):
        profile(people.where("age > 100"))


def test_frequencies_share_one_shuffle_and_limit_early(people):
    df = facts_and_top(people, people.columns, 3)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "WindowGroupLimit" in plan


def test_top_values_skip_gaps_and_break_ties_by_value(spark):
    df = spark.createDataFrame([(None, 10), (None, 9), (None, 9), ("b", 10), ("a", 2)], "s string, v long")
    rows = top_values(value_counts(df), 2).orderBy("column", "place").select("column", "text", "n").collect()
    assert [tuple(r) for r in rows] == [("s", "a", 1), ("s", "b", 1), ("v", "9", 2), ("v", "10", 2)]


def test_approximate_distinct_counts(people):
    rows = {r["column"]: r["distinct"] for r in distinct_counts(people, approximate=True).collect()}
    assert rows["churn"] == 2 and abs(rows["customer_id"] - 50) <= 5


def test_long_texts_are_counted_by_digest(spark):
    rows = [("a" * 500 + str(i % 3), "b" * 300, "short") for i in range(9)] + [("a" * 128, None, "short"), ("a" * 500 + "0", None, "z" * 4000)]
    df = spark.createDataFrame(rows, "x string, y string, s string")
    found = {r["column"]: r for r in facts_and_top(df, df.columns, 2).collect()}
    assert (found["x"]["distinct"], found["y"]["distinct"], found["s"]["distinct"], found["y"]["missing"]) == (4, 1, 2, 2)
    assert [(t["value"], t["n"]) for t in found["x"]["top"]][0] == ("a" * 500 + "0", 4)
    assert [t["value"] for t in found["y"]["top"]] == ["b" * 300]
    assert [t["value"] for t in found["s"]["top"]] == ["short", "z" * 4000]


def test_ties_of_long_texts_go_by_value(spark):
    """Long texts of one frequency that begin alike, whatever their digests are."""
    head = "the same beginning of all of them " * 4
    texts = [head + c for c in "hgfedcba"] + ["z" * 70, "y" * 64, "y" * 65, "\0sha256:x", head.rstrip() + "\0sha256:"]
    rows = [(t, t if i % 2 else None, i) for i, t in enumerate(texts * 3)]
    df = spark.createDataFrame(rows, "t string, gaps string, i int").repartition(5)
    order = sorted(texts, key=str.encode)
    found = {r["column"]: r for r in facts_and_top(df, df.columns, 9).collect()}
    assert [e["value"] for e in found["t"]["top"]] == order[:9] and found["t"]["distinct"] == len(texts)
    assert {e["n"] for e in found["t"]["top"]} == {3} and found["i"]["distinct"] == 39
    assert [r["value"] for r in P.top_texts(df, ["t"]).orderBy("place").collect()] == order[:3]
    assert {r["column"]: r["label"] for r in modes(df, ["t", "gaps"]).collect()}["t"] == order[0]
    assert {r["distinct"] for r in distinct_counts(df, ["t"]).collect()} == {len(texts)}


def test_no_long_text_is_a_shuffle_key(spark):
    df = spark.createDataFrame([("x" * 500,), ("y",)], "t string")
    plan = distinct_counts(df)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in value_counts(df)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "CASE WHEN" in line]
    assert "hashpartitioning" in plan and keys and all("sha2" in line for line in keys)
    assert max(len(r["label"]) for r in value_counts(df).collect()) <= 64 + 8 + 64
