"""Group statistics. Grouping columns are closed code lists, so every result is a handful of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyflow.functions import ordinal
from surveyflow.operators.ranges import running_totals
from surveyflow.operators.score import SEVERITY_ORD
from surveyflow.sources.scratch import materialize
from surveyflow.spec import PATIENTS, Mean, SurveySpec


def group_mean(column: str, alias: str, digits: int | None = None) -> Column:
    mean = F.avg(column)
    return (mean if digits is None else F.round(mean, digits)).alias(alias)


def severity_stats(df: DataFrame, spec: SurveySpec, means: Sequence[Mean] | None = None) -> DataFrame:
    """Size and means per class in one aggregate; reports are projections of it, pruned to what they select."""
    chosen = [*spec.biomarkers, *spec.behaviour] if means is None else means
    stats = df.groupBy(spec.severity).agg(
        F.count(F.lit(1)).alias(PATIENTS), *[group_mean(*mean) for mean in chosen]
    )
    return stats.withColumn(SEVERITY_ORD, ordinal(spec.severity, spec.severity_order))


def largest_first(stats: DataFrame, column: str) -> DataFrame:
    """Descending by a statistic, nulls last, ties in clinical order."""
    return stats.orderBy(F.desc(column), SEVERITY_ORD).drop(SEVERITY_ORD)


def severity_distribution(df: DataFrame, spec: SurveySpec) -> DataFrame:
    stats = severity_stats(df, spec)
    return largest_first(stats.select(spec.severity, PATIENTS, SEVERITY_ORD), PATIENTS)


def biomarkers_by_severity(df: DataFrame, spec: SurveySpec) -> DataFrame:
    names = [alias for _, alias, _ in spec.biomarkers]
    return largest_first(severity_stats(df, spec).select(spec.severity, *names, SEVERITY_ORD), names[0])


def behaviour_by_severity(df: DataFrame, spec: SurveySpec) -> DataFrame:
    names = [alias for _, alias, _ in spec.behaviour]
    return largest_first(severity_stats(df, spec).select(spec.severity, *names, SEVERITY_ORD), names[1])


def with_percent(counts: DataFrame, count: str) -> DataFrame:
    """Share of the total. ``counts`` is already aggregated to one row per class, so its total is a small window."""
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn("percent", F.col(count) / total * 100)


def crosstab_percent(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Row-normalised contingency table x100; empty cells are 0, rows without a group are left out.

    The column values are given, which spares the pass that would look for them. Other values have no column but stay
    in the denominator; nulls do not.
    """
    counts = df.filter(F.col(row).isNotNull()).groupBy(row).agg(
        F.count(column).alias("__all"), *[F.count_if(F.col(column) == v).alias(v) for v in values]
    )
    share = lambda v: F.coalesce(F.try_divide(F.col(v), F.col("__all")), F.lit(0.0)) * 100
    return counts.select(row, *[share(v).alias(v) for v in values])


def numbered(values: DataFrame, column: str) -> DataFrame:
    """(at, column): the distinct values of a column in order, numbered from 0 range by range; stored."""
    placed = running_totals(values.select(column).distinct(), [F.col(column)], {"place": F.lit(1)}, "axis")
    return materialize(placed.select((F.col("run_place") - 1).alias("at"), column), "axis")


def zero_filled(counts: DataFrame, rows: DataFrame, row: str, axis: DataFrame, column: str) -> DataFrame:
    """Every pair of a row of ``rows`` and a value of a numbered ``axis`` with its ``n`` of ``counts``, or 0.

    The grid is the result itself: each row is repeated once a number of the axis and finds the values by number, so
    nothing is crossed.
    """
    width = axis.count()
    grid = rows.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))))
    named = grid.join(axis.withColumnsRenamed({"at": "__at", column: f"__{column}"}), "__at").drop("__at")
    known = counts.select(F.col(row).alias("__row"), F.col(column).alias("__column"), "n")
    same = (F.col(row) == F.col("__row")) & (F.col(f"__{column}") == F.col("__column"))
    filled = named.join(known, same, "left").drop("__row", "__column").withColumnRenamed(f"__{column}", column)
    return filled.withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def crosstab_open(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, percent): the contingency table of any two columns, in long form and filled with zeros.

    Both axes are what the data has, with no declared list, so a new class has its cells. ``percent`` is the share of the
    row. Rows where either is null are left out. Rows are counted once; all else works on the counts.
    """
    present = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    counts = materialize(present.groupBy(row, column).agg(F.count(F.lit(1)).alias("n")), "crosstab")
    totals = counts.groupBy(row).agg(F.sum("n").alias("__total"))
    filled = zero_filled(counts, totals, row, numbered(counts, column), column)
    return filled.select(row, column, "n", (F.col("n") / F.col("__total") * 100).alias("percent"))


def top_means(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """(item, mean_value): the k columns with the largest mean. One aggregate, turned on its side afterwards."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], list(columns), "item", "mean_value")
    return means.orderBy(F.desc("mean_value"), "item").limit(k)
