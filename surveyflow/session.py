"""Session settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: The JVM interprets methods of more bytecode than this for good. The many expressions of a survey row make one of 30,000
#: when a whole stage is generated as one method; beyond the limit Spark generates them in parts, which are compiled.
METHOD_LIMIT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def limit_methods(spark: SparkSession) -> None:
    """Sets the limit in a session that names none."""
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


def build_session(app: str = "surveyflow", **conf: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and vectorised reads; cluster size is left to the cluster.

    ``conf`` keys use ``__`` for dots: ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(METHOD_LIMIT, METHOD_BYTES)
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
