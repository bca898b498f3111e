"""Stage tables in the catalog, replaced as a whole.

A write goes to a new folder of its own, is audited there, and becomes the table by one change of the catalog. Until then,
and whatever fails before it, the table is what it was; whoever reads the version before goes on reading it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from surveyflow.sources import files

Audit = Callable[[DataFrame], None]


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def _folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table lie: below its database, apart from where the catalog would put a table of its own."""
    *database, name = table.split(".")
    where = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    return f"{where.rstrip('/')}/versions/{name}"


def _shape(df: DataFrame) -> list[tuple]:
    return [(f.name, f.dataType) for f in df.schema.fields]


def _recover(spark: SparkSession, table: str) -> None:
    """A run that ended between the two renames of `_publish` left the old table under its other name."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}__before"):
        spark.sql(f"ALTER TABLE {table}__before RENAME TO {table}")


def _publish(spark: SparkSession, table: str, path: str, fmt: str, staged: DataFrame) -> None:
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source=fmt, schema=staged.schema)
    elif _shape(spark.table(table)) == _shape(staged):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:  # other columns: the catalog has no single step for this, but the old table is never gone
        for left in ("after", "before"):
            spark.sql(f"DROP TABLE IF EXISTS {table}__{left}")
        spark.catalog.createTable(f"{table}__after", path=path, source=fmt, schema=staged.schema)
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__before")
        spark.sql(f"ALTER TABLE {table}__after RENAME TO {table}")
        spark.sql(f"DROP TABLE {table}__before")
    spark.catalog.refreshTable(table)


def write_table(
    df: DataFrame, table: str, fmt: str = "parquet", replace_schema: bool = False, audit: Audit | None = None
) -> None:
    """Replace a table, all of it or nothing.

    ``audit`` sees the rows as they were stored and may refuse them by raising; then nothing is published. Without
    ``replace_schema`` a table that exists keeps its column names and types, and other rows are refused. Formats with
    transactions of their own (``fmt="delta"``, wherever the session carries that package) are left to do it their way.
    """
    spark = df.sparkSession
    _recover(spark, table)
    if not replace_schema and spark.catalog.tableExists(table):
        old, new = _shape(spark.table(table)), _shape(df)
        if old != new:
            raise ValueError(f"the schema of {table} would change: {sorted(map(str, {*map(str, old)} ^ {*map(str, new)}))}")
    if fmt == "delta":
        if audit:
            audit(df)
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", str(replace_schema).lower()).saveAsTable(table)
        return
    path = f"{_folder(spark, table)}/v-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).mode("errorifexists").save(path)
        staged = spark.read.format(fmt).schema(df.schema).load(path)
        if audit:
            audit(staged)
    except Exception:
        files.remove(spark, path)
        raise
    _publish(spark, table, path, fmt, staged)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    _recover(spark, table)
    return spark.table(table)


def expire_versions(spark: SparkSession, table: str, keep: int = 1) -> int:
    """Deletes the versions of a table but the one in use and the ``keep`` written last before it; returns their number."""
    folder = _folder(spark, table)
    used = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"].rstrip("/").rsplit("/", 1)[-1]
    written: dict[str, int] = {}
    for path, _, time in files.listing(spark, folder):
        version = path.split("/versions/", 1)[1].split("/")[1]
        written[version] = max(time, written.get(version, 0))
    idle = sorted((v for v in written if v != used), key=lambda v: (written[v], v), reverse=True)
    for version in idle[keep:]:
        files.remove(spark, f"{folder}/{version}")
    return len(idle[keep:])
