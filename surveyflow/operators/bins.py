"""Cut points of features from the exact histogram of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyflow.operators.ranges import running_totals


def feature_bins(values: DataFrame, most: int) -> DataFrame:
    """(feature, bin, low, high, n, cut): at most ``most`` bins a feature, numbered from 0, from long (feature, value).

    A feature of at most ``most`` distinct values has one bin a value; otherwise a value goes by the rows below it to one of
    ``most`` even shares, so a bin holds a share of the rows and a frequent value a bin of its own. ``cut`` lies halfway to
    the next bin (null for the last): a value is in a bin up to its cut. Values are counted first; only distinct ones are
    put in order, in ranges.
    """
    histogram = values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(histogram, [F.col("value")], {"rows": F.col("n"), "distinct": F.lit(1)}, "bins", by=["feature"])
    sizes = placed.groupBy(F.col("feature").alias("of")).agg(
        F.max("run_distinct").alias("distinct"), F.max("run_rows").alias("total")
    )
    sized = placed.join(F.broadcast(sizes), F.col("feature") == F.col("of"))  # a row a feature
    share = F.expr(f"((run_rows - n) * {most}L) div total")
    shared = sized.withColumn("share", F.when(F.col("distinct") <= most, F.col("run_distinct") - 1).otherwise(share))
    bins = shared.groupBy("feature", "share").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"))
    order = Window.partitionBy("feature").orderBy("share")  # at most ``most`` rows
    following = F.lead("low").over(order)
    halfway = F.col("high") + (following - F.col("high")) / 2
    return bins.select(
        "feature", (F.row_number().over(order) - 1).alias("bin"), "low", "high", "n",
        F.when(halfway < following, halfway).when(following.isNotNull(), F.col("high")).alias("cut"),
    )
