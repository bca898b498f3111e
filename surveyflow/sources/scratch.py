"""Where jobs may put intermediate tables.

Intermediate results go to a folder all executors share, so they survive the loss of any machine. The folder is the
one the cluster names in ``spark.checkpoint.dir``; a local temporary folder is used only by a local-mode session that
names none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from surveyflow.sources.files import remove

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_root: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="surveyflow-"))
    return _local_root[0]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody else uses: parallel and repeated runs never collide."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write once, read many: cuts the lineage with a columnar table in the shared folder."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    stored.scratch_path = path
    return stored


def discard(*stored: DataFrame | None) -> None:
    """Deletes tables of `materialize` that nothing will read any more."""
    for df in stored:
        if df is not None:
            remove(df.sparkSession, df.scratch_path)
