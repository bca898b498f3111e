"""Row counts, null tests and validation rules: each one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    value = F.col(column)
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return value.isNull() | F.isnan(value) if floating else value.isNull()


def null_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, has_null), all columns in one pass."""
    flags = df.agg(*[F.coalesce(F.bool_or(missing(df, c)), F.lit(False)).alias(c) for c in columns])
    return flags.unpivot([], list(columns), "column", "has_null")


def validate_range(df: DataFrame, column: str) -> DataFrame:
    """One row: min, max and number of missing values; NaN is missing."""
    absent = missing(df, column)
    value = F.when(~absent, F.col(column))
    return df.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.count_if(absent).alias("nulls"))


def expect(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations): rows for which a rule is false or cannot be decided."""
    broken = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return broken.unpivot([], list(rules), "rule", "violations")


def profile_stages(df: DataFrame, stages: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """(stage, rows, columns) for stages that are filters of one frame, without one scan per stage."""
    counts = df.agg(*[F.count_if(inside).alias(name) for name, (inside, _) in stages.items()])
    widths = F.create_map(*[F.lit(x) for name, (_, width) in stages.items() for x in (name, width)])
    return counts.unpivot([], list(stages), "stage", "rows").withColumn("columns", widths[F.col("stage")])


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys and null keys. A sound key has rows = distinct_keys and no nulls."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.col(key)).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
    )


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """(violation, keys, rows): how many keys are null or repeated, and how many rows carry such keys."""
    held = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    kind = F.when(F.col("key").isNull(), "null").when(F.col("n") > 1, "repeated")
    broken = held.select(kind.alias("violation"), "n").filter(F.col("violation").isNotNull())
    return broken.groupBy("violation").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"))


def require_sound_key(key: str):
    """An audit that refuses rows with null or repeated keys, by name and number.

    Keys are counted where they lie before they are shuffled, so one that stands on any share of the rows is one record.
    """

    def audit(df: DataFrame) -> None:
        broken = {r["violation"]: r for r in key_violations(df, key).collect()}
        if broken:
            found = ", ".join(f"{r['rows']} rows of {r['keys']} {kind} keys" for kind, r in sorted(broken.items()))
            raise ValueError(f"{key} is no key: {found}")

    return audit
