"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from quillframe.errors import TableError


def local_session(app: str = "quillframe", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the session you are given."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, read from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster session without it
    is refused, since a folder of one machine cannot be read by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise TableError("Set spark.checkpoint.dir to a folder that every executor can reach.")
        root = tempfile.mkdtemp(prefix="quillframe-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never reused."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has stored below the shared folder. Results that still read from there must be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/quillframe-{spark.sparkContext.applicationId}"
