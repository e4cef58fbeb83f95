"""A folder with working copies, their lineage, and the ledger of model comparisons.

Copies are Parquet folders, which keep the column types. Lineage and ledger are Parquet tables that
only grow. Place the folder on storage that every executor reaches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillframe.errors import TableError
from quillframe.operators.joins import RemovedColumn
from quillframe.functions.types import has_nested
from quillframe.plans.compare import Comparison
from quillframe.plans.profile import profile as describe

HISTORY_ENTRIES = 100  # fixed value: newest ledger entries shown

_LINEAGE = (
    "id string, name string, path string, source_ids array<string>, message string, "
    "removed array<struct<column: string, matches: string, reason: string>>, "
    "columns array<string>, profile string, created_at string"
)
_LEDGER = (
    "id string, dataset_id string, dataset_name string, target string, task string, train_pct int, seed int, "
    "mode string, columns array<string>, rows_processed bigint, rows_available bigint, "
    "models array<struct<id: string, name: string, params: string, metrics: map<string, double>, "
    "training_seconds: double>>, training_seconds double, elapsed_seconds double, created_at string"
)


@dataclass(frozen=True)
class Workspace:
    spark: SparkSession
    root: str

    # Working copies

    def save_copy(
        self,
        df: DataFrame,
        name: str,
        source_ids: Sequence[str] = (),
        message: str | None = None,
        removed: Sequence[RemovedColumn] = (),
        profile: Mapping[str, Any] | None = None,
    ) -> str:
        """Write a table as a new copy, note where it came from and its profile, and return its id.

        Unless the caller brings a ``profile``, the written copy is profiled; one without rows or columns has none.
        """
        copy_id = uuid.uuid4().hex
        path = f"{self.root}/copies/{copy_id}"
        df.write.parquet(path)
        written = self.spark.read.parquet(path)
        if profile is None and not written.isEmpty() and not has_nested(written):
            profile = describe(written, name)
        entry = (
            copy_id, name, path, list(source_ids), message, [tuple(asdict(r).values()) for r in removed],
            list(df.columns), json.dumps(profile, default=str) if profile else None, _now(),
        )
        self._append("lineage", _LINEAGE, entry)
        return copy_id

    def open_copy(self, copy_id: str) -> DataFrame:
        entry = self.lineage().where(F.col("id") == copy_id).select("path").first()
        if entry is None:
            raise TableError(f"There is no working copy '{copy_id}'.")
        return self.spark.read.parquet(entry["path"])

    def lineage(self) -> DataFrame:
        """Every working copy with its sources, message and removed columns."""
        return self._table("lineage", _LINEAGE)

    def listing(self) -> DataFrame:
        """The working copies, newest first."""
        return self.lineage().orderBy(F.desc("created_at"), F.desc("id"))

    # Comparisons

    def record(self, run: Comparison) -> None:
        """Append a comparison to the ledger."""
        models = [
            (m.id, name, json.dumps(m.params, default=str), {k: float(v) for k, v in m.metrics.items()}, m.training_seconds)
            for m, name in zip(run.models, run.names())
        ]
        total = round(sum(m.training_seconds for m in run.models), 4)
        entry = (
            run.id, run.dataset_id, run.dataset_name, run.target, run.task, run.train_pct, run.seed, run.mode, run.columns,
            run.rows_processed, run.rows_available, models, total, run.elapsed_seconds, run.created_at,
        )
        self._append("ledger", _LEDGER, entry)

    def ledger(self) -> DataFrame:
        return self._table("ledger", _LEDGER)

    def history(self, entries: int = HISTORY_ENTRIES) -> DataFrame:
        """The newest comparisons."""
        return self.ledger().orderBy(F.desc("created_at"), F.desc("id")).limit(entries)

    def replays(self) -> DataFrame:
        """Each comparison of a working copy that is still listed, as a request that can be run again.

        ``run_id, dataset_id, path, target, columns, train_pct, seed, mode, models``; columns that the copy no
        longer has are left out, and so is a target that it lacks.
        """
        copies = self.lineage().select(F.col("id").alias("dataset_id"), "path", F.col("columns").alias("present"))
        runs = self.ledger().withColumnRenamed("id", "run_id").join(copies, "dataset_id")
        return runs.select(
            "run_id",
            "dataset_id",
            "path",
            F.when(F.array_contains("present", F.col("target")), F.col("target")).alias("target"),
            F.array_intersect("columns", "present").alias("columns"),
            "train_pct",
            "seed",
            "mode",
            F.transform("models", lambda m: F.struct(m["id"].alias("id"), m["params"].alias("params"))).alias("models"),
        )

    def replay(self, run_id: str) -> dict[str, Any]:
        """The request of one earlier comparison, as arguments for :func:`quillframe.plans.compare.compare_models`."""
        found = self.replays().where(F.col("run_id") == run_id).first()
        if found is None:
            raise TableError(f"There is no comparison '{run_id}' of a listed copy.")
        return {
            "dataset_id": found["dataset_id"],
            "target": found["target"],
            "columns": list(found["columns"]),
            "train_pct": found["train_pct"],
            "seed": found["seed"],
            "mode": found["mode"],
            "models": [(m["id"], json.loads(m["params"])) for m in found["models"]],
        }

    def _append(self, table: str, schema: str, entry: tuple) -> None:
        row = self.spark.createDataFrame([entry], schema).coalesce(1)
        row.write.mode("append").parquet(f"{self.root}/{table}")

    def _table(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")
