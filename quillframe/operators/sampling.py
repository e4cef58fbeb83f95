"""Repeatable samples and train/test splits by row hash.

Every row has a hash of its key and the seed. A draw of exactly ``n`` rows is the ``n`` rows with the
smallest hash. To find that cut without sorting the table, rows are counted by four hash digits at a time, inside each
task first, until the bucket that holds the cut is small; only its rows are ranked. The draw itself is then a filter. A class that holds a third of the
table is spread over the buckets like any other rows.

Rows that share a key share their hash and fall on the same side of a split, so splits have the exact
size if the key is unique. By default the key is the whole row. Copies are counted, never listed, so a row with any
number of copies is one row of the search for the cut. A sample always has its exact size; of rows that share a key it
takes those with the smallest digest of the whole row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillframe.errors import TableError
from quillframe.functions.hashing import row_digest, seeded_hash, share_of_hashes
from quillframe.functions.sizing import BROADCAST_BYTES, broadcast_if_small, settle
from quillframe.functions.types import quoted
from quillframe.operators.projection import rows_with_target

SPLIT = "split"
MIN_ROWS = 10  # fixed value: fewest rows a model is trained on

# Rows per resource budget, and older names for the budgets.
BUDGETS: dict[str, int | None] = {"economy": 10_000, "balanced": 50_000, "full": None}
BUDGET_ALIASES = {"sample": "economy", "chunked": "balanced"}

_HASH = "_draw_hash"
_BUCKET = "_draw_bucket"
_DIGEST = "_draw_digest"
_RANKED_ROWS = 65_536  # rows of the bucket that is ranked in one task, unless whole hashes agree
_STEP = 4  # hash digits looked at together: 65,536 counters at most


def budget_limit(mode: str) -> int | None:
    name = BUDGET_ALIASES.get(mode, mode)
    if name not in BUDGETS:
        raise TableError(f"Unknown budget '{mode}'; choose one of {', '.join(BUDGETS)}.")
    return BUDGETS[name]


def budget_plan(df: DataFrame) -> DataFrame:
    """``mode, row_limit, rows_used`` for each budget."""
    rows = [
        F.struct(
            F.lit(mode).alias("mode"),
            F.lit(limit).cast("bigint").alias("row_limit"),
            F.least(F.col("n"), F.lit(limit).cast("bigint")).alias("rows_used"),
        )
        for mode, limit in BUDGETS.items()
    ]
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*rows)))


def within_budget(df: DataFrame, mode: str, key: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """A uniform sample as large as the budget allows; the whole table under ``full``."""
    limit = budget_limit(mode)
    return df if limit is None else hash_sample(df, limit, key, seed)


def hash_sample(df: DataFrame, n: int, key: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest hash; the whole table if it has no more than that."""
    if n < 1:
        raise TableError("A sample needs at least one row.")
    total = df.count()
    if total <= n:
        return df
    ties = _tie_keys(df, key)
    hashed = _hashed(df, key, seed)
    if key:
        ties, hashed = [*ties, _DIGEST], hashed.withColumn(_DIGEST, row_digest(df))
    cut = _cut(hashed, n, total, ties)
    if not cut.surplus:
        return hashed.where(cut.reached(hashed)).drop(_HASH, _DIGEST)
    # The last row taken has more copies than are needed: one of them is repeated.
    below = hashed.where(cut.reached(hashed) & ~cut.at(hashed))
    copies = hashed.where(cut.at(hashed)).limit(1).withColumn(_BUCKET, F.explode(F.sequence(F.lit(1), F.lit(cut.needed)))).drop(_BUCKET)
    return below.union(copies).drop(_HASH, _DIGEST)


def require_rows(df: DataFrame, least: int = MIN_ROWS) -> DataFrame:
    """The table itself, if it has enough rows; at most ``least`` rows are looked at."""
    if df.limit(least).count() < least:
        raise TableError(f"At least {least} usable rows are needed.")
    return df


def random_split(
    df: DataFrame, train_pct: int, key: Sequence[str] = (), seed: int = 42, exact: bool = False
) -> DataFrame:
    """Add the column ``split`` with ``train`` or ``test``.

    By default each row is assigned by its own hash: one pass, no shuffle, shares right on average.
    With ``exact`` the training part has ``floor(rows * pct / 100)`` rows.
    """
    _check_pct(train_pct)
    if not exact:
        chosen = seeded_hash(_tie_keys(df, key), seed) < F.lit(share_of_hashes(train_pct))
        return df.withColumn(SPLIT, _side(chosen))
    total = df.count()
    take = total * train_pct // 100
    hashed = _hashed(df, key, seed)
    if take == 0:
        return df.withColumn(SPLIT, F.lit("test"))
    cut = _cut(hashed, take, total, _tie_keys(df, key))
    return hashed.withColumn(SPLIT, _side(cut.reached(hashed))).drop(_HASH)


@dataclass(frozen=True)
class ClassSizes:
    """The rows per class, written once, and what its totals say."""

    table: DataFrame
    rows: int
    classes: int
    smallest: int
    largest: int
    small: bool

    def near(self, df: DataFrame) -> DataFrame:
        """A table with one row per class, marked for broadcast if the class names were measured small."""
        return F.broadcast(df) if self.small else df


def class_sizes(df: DataFrame, label: str) -> ClassSizes:
    """Count the classes of a label; rows without a label are left out."""
    counted = rows_with_target(df, label).groupBy(quoted(label).alias("_class")).agg(F.count(F.lit(1)).alias("rows"))
    table = settle(counted)
    seen = table.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("classes"),
        F.coalesce(F.min("rows"), F.lit(0)).alias("smallest"),
        F.coalesce(F.max("rows"), F.lit(0)).alias("largest"),
        (F.coalesce(F.sum(F.octet_length(F.col("_class").cast("string")) + 64), F.lit(0)) <= BROADCAST_BYTES).alias("small"),
    ).first()
    return ClassSizes(table, *seen)


def stratified_split(
    df: DataFrame, label: str, train_pct: int, key: Sequence[str] = (), seed: int = 42, sizes: ClassSizes | None = None
) -> DataFrame:
    """Split each class in the same proportion, ``floor(rows * pct / 100)`` training rows in all.

    A class gets the whole part of its share; the rows still owed go to the classes with the largest
    remainders, ties by class. Rows without a label are left out.
    """
    _check_pct(train_pct)
    df = rows_with_target(df, label)
    ties = _tie_keys(df, key)
    hashed = _hashed(df, key, seed)
    sizes = sizes or class_sizes(df, label)
    quota = _class_quotas(sizes, train_pct)
    cuts = broadcast_if_small(settle(_class_cuts(hashed, label, sizes, quota, ties)))
    marked = hashed.join(cuts, quoted(label) == F.col("_class"), "left")
    reached = F.coalesce(_order(marked, ties) <= F.col("_cut"), F.lit(False))
    return marked.select(*[quoted(n) for n in df.columns], _side(reached).alias(SPLIT))


def can_stratify(sizes: ClassSizes) -> bool:
    """Whether there are rows and every class has at least two."""
    return sizes.smallest >= 2


def split_parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The training and the test rows of a split table, without the marker."""
    return df.where(F.col(SPLIT) == "train").drop(SPLIT), df.where(F.col(SPLIT) == "test").drop(SPLIT)


@dataclass(frozen=True)
class _Cut:
    """The hash and key of the last row taken, how many of its copies are needed and how many too many there are."""

    row: dict
    ties: Sequence[str]
    needed: int
    surplus: int

    def _last(self, hashed: DataFrame) -> Column:
        kinds = hashed.schema
        return F.struct(
            *[F.lit(self.row[name]).cast(kinds[name].dataType).alias(name) for name in (_HASH, *self.ties)]
        )

    def at(self, hashed: DataFrame) -> Column:
        same = F.col(_HASH) == F.lit(self.row[_HASH])
        return same & _order(hashed, self.ties).eqNullSafe(self._last(hashed))

    def reached(self, hashed: DataFrame) -> Column:
        last = self._last(hashed)
        # The plain comparison comes first, so rows beyond the cut are settled by one number.
        bound = F.lit(self.row[_HASH])
        return (F.col(_HASH) <= bound) & ((F.col(_HASH) < bound) | (_order(hashed, self.ties) <= last))


def _tie_keys(df: DataFrame, key: Sequence[str]) -> list[str]:
    absent = [name for name in key if name not in df.columns]
    if absent:
        raise TableError(f"There is no key column {', '.join(absent)}.")
    return list(key) or list(df.columns)


def _hashed(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    return df.withColumn(_HASH, seeded_hash(_tie_keys(df, key), seed))


def _order(df: DataFrame, ties: Sequence[str]) -> Column:
    return F.struct(F.col(_HASH), *[quoted(name) for name in ties])


def _cut(hashed: DataFrame, take: int, total: int, ties: Sequence[str]) -> _Cut:
    found, inside, owed = "", total, take
    while inside > _RANKED_ROWS and len(found) < 32:
        bucket = F.substring(F.col(_HASH), 1, len(found) + _STEP)
        counts = hashed.where(F.col(_HASH).startswith(found)).groupBy(bucket.alias(_BUCKET)).agg(F.count(F.lit(1)).alias("n"))
        running = counts.withColumn("upto", F.sum("n").over(Window.orderBy(_BUCKET)))
        at = running.where(F.col("upto") >= owed).orderBy(_BUCKET).first()
        found, inside, owed = at[_BUCKET], at["n"], owed - (at["upto"] - at["n"])
    candidates = hashed.where(F.col(_HASH).startswith(found)).groupBy(_order(hashed, ties).alias("row")).agg(F.count(F.lit(1)).alias("n"))
    ranked = candidates.withColumn("upto", F.sum("n").over(Window.orderBy("row")))
    last = ranked.where(F.col("upto") >= owed).orderBy("upto").first()
    surplus = last["upto"] - owed
    return _Cut(last["row"].asDict(), ties, last["n"] - surplus, surplus)


def _class_quotas(sizes: ClassSizes, pct: int) -> DataFrame:
    """``_class, take``: training rows owed to each class."""
    whole, rest = F.floor(F.col("rows") * pct / 100), F.col("rows") * pct % 100
    owed = sizes.rows * pct // 100 - (sizes.table.agg(F.sum(whole)).first()[0] or 0)
    if not owed:
        return sizes.table.select("_class", whole.alias("take"))
    more = sizes.table.orderBy(rest.desc(), "_class").limit(owed).select(F.col("_class").alias("_more"))
    with_more = sizes.table.join(sizes.near(more), F.col("_class") == F.col("_more"), "left")
    return with_more.select("_class", (whole + F.col("_more").isNotNull().cast("bigint")).alias("take"))


def _class_cuts(
    hashed: DataFrame, label: str, sizes: ClassSizes, quota: DataFrame, ties: Sequence[str]
) -> DataFrame:
    """``_class, _cut``: the last training row of each class that has any.

    For all classes at once: hashes are counted by some digits more each round, within the bucket that holds the cut of its class, until no such
    bucket has more than ``_RANKED_ROWS`` rows. Only those few are ranked, however large a class is.
    """
    rows = hashed.select(quoted(label).alias("_class"), F.col(_HASH), _order(hashed, ties).alias("_row"))
    whole = sizes.table.select("_class", F.col("rows").alias("inside")).join(sizes.near(quota), "_class").where("take > 0")
    state = settle(whole.select("_class", F.lit("").alias("found"), "inside", F.col("take").alias("owed")))
    large = F.col("inside") > _RANKED_ROWS
    digits = 0
    while digits < 32 and not state.where(large).isEmpty():
        digits += _STEP
        open_ = state.where(large).select("_class", "found", "owed")
        within = rows.join(sizes.near(open_), "_class").where(F.col(_HASH).startswith(F.col("found")))
        counts = within.groupBy("_class", "owed", F.substring(_HASH, 1, digits).alias(_BUCKET)).agg(F.count(F.lit(1)).alias("inside"))
        upto = counts.withColumn("upto", F.sum("inside").over(Window.partitionBy("_class").orderBy(_BUCKET)))
        at = upto.where((F.col("upto") >= F.col("owed")) & (F.col("upto") - F.col("inside") < F.col("owed")))
        narrowed = at.select("_class", F.col(_BUCKET).alias("found"), "inside", (F.col("owed") - (F.col("upto") - F.col("inside"))).alias("owed"))
        state = settle(state.where(~large).unionByName(narrowed))
    candidates = rows.join(sizes.near(state), "_class").where(F.col(_HASH).startswith(F.col("found")))
    copies = candidates.groupBy("_class", "_row", "owed").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_class").orderBy("_row"))
    last = copies.withColumn("upto", upto).where((F.col("upto") >= F.col("owed")) & (F.col("upto") - F.col("n") < F.col("owed")))
    return last.select("_class", F.col("_row").alias("_cut"))


def _side(chosen: Column) -> Column:
    return F.when(chosen, F.lit("train")).otherwise(F.lit("test"))


def _check_pct(train_pct: int) -> None:
    if not 1 <= train_pct <= 99:
        raise TableError("The training share must lie between 1 and 99 percent.")
