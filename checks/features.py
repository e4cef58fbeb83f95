"""Feature preparation, read back from the vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.registry import GAPPED, below, draw, gapped_events, query, table
from quillframe.operators.features import FEATURES, decode_numbered, encode_numbered, fit_features, number_labels
from quillframe.operators.sampling import random_split, split_parts

_TRAIN = f"{draw('event_id')} < {below(70)}"


@query(
    f"WITH {GAPPED}, train AS (SELECT * FROM gapped WHERE {_TRAIN}), m AS (SELECT quantile_cont(value, 0.5) AS v FROM train), "
    "s AS (SELECT avg(coalesce(value, v)) AS a, stddev_pop(coalesce(value, v)) AS d FROM train, m) "
    f"SELECT event_id, round((coalesce(value, v) - a) / d, 6) AS scaled, 0.0::DOUBLE AS constant FROM gapped, m, s WHERE NOT ({_TRAIN})"
)
def imputed_and_standardised(spark, folder):
    """Median, mean and deviation of the training rows, applied to the test rows; a constant column scales to 0."""
    events = gapped_events(spark, folder).select("event_id", "value", F.lit(3).alias("constant"))
    train, test = split_parts(random_split(events, 70, ["event_id"]))
    ready = fit_features(train, ["value", "constant"]).apply(test)
    x = vector_to_array(FEATURES)
    return ready.select("event_id", F.round(x[0], 6).alias("scaled"), x[1].alias("constant"))


@query(
    f"WITH {GAPPED} SELECT event_id, coalesce(event_type, (SELECT event_type FROM gapped WHERE event_type IS NOT NULL "
    "GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1)) AS category FROM gapped"
)
def imputed_category(spark, folder):
    events = gapped_events(spark, folder)
    plan = fit_features(events, ["event_type"])
    return _with_output_name(plan, plan.apply(events, training=True), "event_id", "category")


def _with_output_name(plan, ready, key, alias):
    """The name of the one-hot output that is 1; NULL if none is."""
    names = F.array(*[F.lit(name.split("=", 1)[1]) for name in plan.names])
    place = F.array_position(vector_to_array(FEATURES), 1.0).cast("int")
    return ready.select(key, F.when(place > 0, F.element_at(names, F.greatest(place, F.lit(1)))).alias(alias))


_PART_TRAIN = f"{draw('p_partkey')} < {below(70)}"
# Every tenth test row has a category that does not occur in training.
_KINDS = f"CASE WHEN p_partkey % 10 = 0 AND NOT ({_PART_TRAIN}) THEN 'new ' ELSE '' END || p_brand || ' ' || p_type AS kind"


@query(
    f"WITH p AS (SELECT p_partkey, {_KINDS} FROM part), train AS (SELECT * FROM p WHERE {_PART_TRAIN}), "
    "f AS (SELECT kind, row_number() OVER (ORDER BY count(*) DESC, kind) AS place FROM train GROUP BY kind), "
    "w AS (SELECT count(*) > 50 AS wide FROM f) "
    "SELECT p_partkey, CASE WHEN place IS NULL THEN NULL WHEN wide AND place > 49 THEN '(rare)' ELSE p.kind END AS category "
    f"FROM p LEFT JOIN f ON p.kind = f.kind, w WHERE NOT ({_PART_TRAIN})"
)
def one_hot_with_rare(spark, folder):
    """The 49 most frequent categories, one output for the rare ones, none for those absent from training."""
    parts = table(spark, folder, "part").select("p_partkey", F.concat_ws(" ", "p_brand", "p_type").alias("kind"))
    train, test = split_parts(random_split(parts, 70, ["p_partkey"]))
    test = test.withColumn("kind", F.concat(F.when(F.col("p_partkey") % 10 == 0, "new ").otherwise(""), "kind"))
    plan = fit_features(train, ["kind"])
    return _with_output_name(plan, plan.apply(test), "p_partkey", "category")


@query(
    "SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::DOUBLE AS label FROM orders"
)
def label_numbers(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return encode_numbered(orders, "o_orderpriority", number_labels(orders, "o_orderpriority")).select("o_orderkey", "label")


@query("SELECT o_orderkey, (dense_rank() OVER (ORDER BY concat('c', o_orderkey * 7919 % 1000003)) - 1)::DOUBLE AS label FROM orders")
def numbers_of_many_labels(spark, folder):
    """A class for each order, numbered and put back."""
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", "concat('c', o_orderkey * 7919 % 1000003) AS class")
    numbers = number_labels(orders, "class")
    known = decode_numbered(encode_numbered(orders, "class", numbers), "label", numbers, "again").where("again = class")
    return known.select("o_orderkey", "label")


@query(
    "WITH d AS (SELECT count(DISTINCT p_brand) AS b FROM part) SELECT count(*) AS rows, 2 + b AS width FROM part, d GROUP BY b"
)
def assembled_vectors(spark, folder):
    """Two numeric columns and one category make one vector: numbers first, then the outputs."""
    parts = table(spark, folder, "part").select("p_size", "p_brand", "p_retailprice")
    ready = fit_features(parts, parts.columns).apply(parts, training=True)
    return ready.groupBy(F.size(vector_to_array(FEATURES)).cast("bigint").alias("width")).agg(F.count(F.lit(1)).alias("rows"))
