"""Feature preparation: impute, standardise and one-hot encode, fitted on the training rows.

Fitting leaves a few numbers per numeric column and at most 50 labels per categorical one. Applying
is a projection with these as literals, followed by ``pyspark.ml``'s one-hot encoder and assembler, so
rows carry sparse vectors. Only new rows with a column of more than 50 categories need a join: to
tell a category that was rare in training from one that was absent.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillframe.errors import TableError
from quillframe.functions.sizing import broadcast_if_small, settle, store
from quillframe.functions.types import as_number, data_type, is_number, quoted
from quillframe.operators.frequency import facts_and_top
from quillframe.operators.quantiles import exact_quantiles

MAX_CATEGORIES = 50  # fixed value: one-hot outputs per column, the last for rare categories if there are more
FEATURES = "features"
RARE = "(rare)"
_TEXT, _NUMBER, _NO_LABEL = "_label_text", "_label_number", "\u0000"


@dataclass(frozen=True)
class NumericFeature:
    name: str
    median: float
    mean: float
    deviation: float

    def value(self, df: DataFrame) -> Column:
        """Gaps get the median; then mean 0 and population deviation 1, or 0 throughout without spread."""
        filled = F.coalesce(as_number(df, self.name), F.lit(self.median))
        return (filled - F.lit(self.mean)) / F.lit(self.deviation or 1.0)


@dataclass(frozen=True)
class CategoryFeature:
    name: str
    mode: str
    labels: list[str]
    has_rare: bool

    @property
    def size(self) -> int:
        return len(self.labels) + self.has_rare

    def filled(self) -> Column:
        """The text form; gaps get the most frequent value."""
        return F.coalesce(quoted(self.name).cast("string"), F.lit(self.mode))

    def slot(self, text: Column, seen: Column) -> Column:
        """The position of the output that is 1; beyond the last one for a category absent from training."""
        place = F.array_position(F.array(*[F.lit(label) for label in self.labels]), text)
        rare = F.when(seen, len(self.labels)).otherwise(self.size) if self.has_rare else F.lit(self.size)
        return F.when(place > 0, place - 1).otherwise(rare).cast("double")


@dataclass(frozen=True)
class FeaturePlan:
    numeric: list[NumericFeature]
    categorical: list[CategoryFeature]
    known: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    @property
    def names(self) -> list[str]:
        """One name per vector position: numeric columns, then ``column=label`` outputs."""
        outputs = [f"{c.name}={label}" for c in self.categorical for label in c.labels + [RARE] * c.has_rare]
        return [n.name for n in self.numeric] + outputs

    def apply(self, df: DataFrame, training: bool = False) -> DataFrame:
        """Add the vector column ``features``. ``training`` says that ``df`` is what the plan was fitted on."""
        columns = [feature.value(df).alias(f"_n{i}") for i, feature in enumerate(self.numeric)]
        texts = [feature.filled().alias(f"_t{i}") for i, feature in enumerate(self.categorical)]
        prepared = df.select("*", *columns, *texts)
        for i, feature in enumerate(self.categorical):
            seen = F.lit(True)
            if feature.has_rare and not training:
                known = broadcast_if_small(settle(self.known[feature.name].select(F.col("text").alias(f"_s{i}"))))
                prepared = prepared.join(known, F.col(f"_t{i}") == F.col(f"_s{i}"), "left")
                seen = F.col(f"_s{i}").isNotNull()
            nominal = {"ml_attr": {"type": "nominal", "num_vals": feature.size}}
            slot = feature.slot(F.col(f"_t{i}"), seen)
            prepared = prepared.select("*", slot.alias(f"_i{i}", metadata=nominal))
        places = range(len(self.categorical))
        if self.categorical:
            # "keep" gives absent categories a slot of their own, and dropLast removes that one again.
            encoder = OneHotEncoder(
                inputCols=[f"_i{i}" for i in places],
                outputCols=[f"_o{i}" for i in places],
                handleInvalid="keep",
                dropLast=True,
            )
            prepared = encoder.fit(prepared).transform(prepared)
        inputs = [f"_n{i}" for i in range(len(self.numeric))] + [f"_o{i}" for i in places]
        vectors = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(prepared)
        return vectors.select(*[quoted(n) for n in df.columns], FEATURES)


def fit_features(train: DataFrame, columns: Sequence[str]) -> FeaturePlan:
    """Medians, means, deviations, modes and labels of the training rows. Columns without any value are left out."""
    numeric = _fit_numeric(train, [n for n in columns if is_number(data_type(train, n))])
    categorical, known = _fit_categorical(train, [n for n in columns if not is_number(data_type(train, n))])
    if not numeric and not categorical:
        raise TableError("No usable feature column is left beside the target.")
    return FeaturePlan(numeric, categorical, known)


def _fit_numeric(train: DataFrame, names: list[str]) -> list[NumericFeature]:
    medians = {n: q[0] for n, q in exact_quantiles(train, names, [0.5]).items() if q[0] is not None}
    if not medians:
        return []
    filled = {n: F.coalesce(as_number(train, n), F.lit(m)) for n, m in medians.items()}
    seen = train.agg(*[F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("dev")) for x in filled.values()]).first()
    return [NumericFeature(n, m, s["mean"], s["dev"]) for (n, m), s in zip(medians.items(), seen)]


def _fit_categorical(train: DataFrame, names: list[str]) -> tuple[list[CategoryFeature], dict[str, DataFrame]]:
    """The features, and for columns with rare categories the table of all that occur in training."""
    features, known = [], {}
    if not names:
        return features, known
    found = {row["column"]: row for row in facts_and_top(train, names, MAX_CATEGORIES).collect()}
    for name in names:
        labels = [entry["value"] for entry in (found[name]["top"] or [])] if name in found else []
        if not labels:
            continue
        has_rare = found[name]["distinct"] > MAX_CATEGORIES
        kept = labels[: MAX_CATEGORIES - 1] if has_rare else labels
        features.append(CategoryFeature(name, labels[0], sorted(kept), has_rare))
        if has_rare:
            known[name] = train.where(quoted(name).isNotNull()).select(quoted(name).cast("string").alias("text")).distinct()
    return features, known


def number_labels(df: DataFrame, label: str) -> DataFrame:
    """``text, number``: the classes of a label column by text, numbered from 0 in alphabetical order. The result is stored.

    The different texts are sorted by range of the alphabet, each range in a task of its own; counts of the ranges before give every
    range its first number, so that no task and no driver sees all classes.
    """
    texts = df.where(quoted(label).isNotNull()).select(quoted(label).cast("string").alias("text")).distinct()
    ranges = texts.repartitionByRange("text").sortWithinPartitions("text")
    # the place in the table: the number of the range in the upper bits, that of the row in it in the lower 33
    placed = store(ranges.select("text", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = settle(sizes.select("part", before.alias("first")))  # one row per range
    within = F.col("place").bitwiseAND((1 << 33) - 1)
    numbered = placed.join(F.broadcast(firsts), part == F.col("part"))
    return store(numbered.select("text", (F.col("first") + within).alias("number")))


def encode_numbered(df: DataFrame, label: str, numbers: DataFrame, output: str = "label") -> DataFrame:
    """Add the class number of a label as a double from :func:`number_labels`; NULL for a class that is not there."""
    keys = numbers.select(F.col("text").alias(_TEXT), F.col("number").cast("double").alias(_NUMBER))
    joined = df.join(broadcast_if_small(keys), quoted(label).cast("string") == F.col(_TEXT), "left")
    return joined.withColumn(output, F.col(_NUMBER)).drop(_TEXT, _NUMBER)


def decode_numbered(df: DataFrame, number: str, numbers: DataFrame, output: str) -> DataFrame:
    """Add the class text of a class number."""
    keys = numbers.select(F.col("text").alias(_TEXT), F.col("number").cast("double").alias(_NUMBER))
    joined = df.join(broadcast_if_small(keys), quoted(number).cast("double") == F.col(_NUMBER), "left")
    return joined.withColumn(output, F.col(_TEXT)).drop(_TEXT, _NUMBER)


def label_order(df: DataFrame, label: str) -> list[str]:
    """For models, which hold a name for each class on the driver themselves: the classes of a label column by text, in alphabetical order: the position is the class number."""
    rows = df.where(quoted(label).isNotNull()).select(quoted(label).cast("string").alias("text")).distinct()
    return sorted(row["text"] for row in rows.collect())


def encode_label(df: DataFrame, label: str, order: Sequence[str], output: str = "label") -> DataFrame:
    """Add the class number of a label as a double; NULL for a class that is not in the order."""
    if not order:
        return df.withColumn(output, F.lit(None).cast("double"))
    held = df.withColumn(_TEXT, F.coalesce(quoted(label).cast("string"), F.lit(_NO_LABEL)))
    indexer = StringIndexerModel.from_labels([*order], inputCol=_TEXT, outputCol=_NUMBER, handleInvalid="keep")
    number = F.when(F.col(_NUMBER) < len(order), F.col(_NUMBER))
    return indexer.transform(held).withColumn(output, number).drop(_TEXT, _NUMBER)


def decode_label(df: DataFrame, number: str, order: Sequence[str], output: str) -> DataFrame:
    """Add the class text of a class number."""
    return IndexToString(inputCol=number, outputCol=output, labels=[*order]).transform(df)
