"""Running totals in a global order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyflow.sources.scratch import materialize


def running_totals(
    df: DataFrame, order: Sequence[Column], values: Mapping[str, Column], purpose: str, by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``run_<name>``: the total of each value over a row and all rows before it, within each group of ``by``.

    Rows are dealt into ranges of (by, order) and stored, so that the ranges stay what they are. The totals of the ranges,
    one row for each range and group in it, give what stands before a range; the rest is a window inside the range.
    """
    placed = materialize(
        df.repartitionByRange(*[F.col(b) for b in by], *order).withColumn("_range", F.spark_partition_id()), purpose
    )
    sums = placed.groupBy(*by, "_range").agg(*[F.sum(v).alias(f"_{name}") for name, v in values.items()])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        *[F.col(b).alias(f"_by_{b}") for b in by], F.col("_range").alias("_in"),
        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in values],
    )
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.select("*", *[F.sum(v).over(inside).alias(f"run_{n}") for n, v in values.items()])
    same = [F.col("_range") == F.col("_in"), *[F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]]
    # the ranges are partitions of a shuffle, so their totals do not follow the data
    joined = totals.join(F.broadcast(before), same)
    summed = {f"run_{n}": F.col(f"run_{n}") + F.col(f"_{n}") for n in values}
    return joined.withColumns(summed).drop("_range", "_in", *[f"_by_{b}" for b in by], *[f"_{n}" for n in values])
