"""Multiclass evaluation. The rows are counted once into (label, prediction, n); everything else is arithmetic on
at most classes x classes rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyflow.operators.stats import numbered, zero_filled
from surveyflow.sources.scratch import materialize


def confusion_counts(predicted: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n), non-empty cells only."""
    return predicted.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(counts: DataFrame, classes: Sequence[str], other: str | None = None) -> DataFrame:
    """One row per class and one column per predicted class, zero-filled, in the order of ``classes``.

    No row may vanish: what isn't among the classes is an error, or goes to a last row and column named ``other``.
    """

    def declared(column: str) -> Column:
        unknown = F.concat(F.lit(f"{column} outside the classes: "), F.coalesce(F.col(column), F.lit("null")))
        return F.when(F.col(column).isin(list(classes)), F.col(column)).otherwise(
            F.raise_error(unknown) if other is None else F.lit(other)
        )

    counts = counts.select(declared("label").alias("label"), declared("prediction").alias("prediction"), "n")
    classes = [*classes] if other is None else [*classes, other]
    axis = counts.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in classes])).alias("ord", "axis"))
    cells = counts.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n"))
    return (
        axis.join(F.broadcast(cells), F.col("axis") == F.col("label"), "left")  # at most one row per class
        .orderBy("ord")
        .select(F.col("axis").alias("label"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in classes])
    )


def confusion_open(counts: DataFrame) -> DataFrame:
    """(label, prediction, n): the matrix in long form, filled with zeros, over all classes that occur on either side."""
    counts = materialize(counts.filter(F.col("label").isNotNull() & F.col("prediction").isNotNull()), "confusion")
    classes = numbered(counts.select("label").union(counts.select("prediction")).toDF("prediction"), "prediction")
    rows = classes.select(F.col("prediction").alias("label"))
    return zero_filled(counts, rows, "label", classes, "prediction").select("label", "prediction", "n")


def _class_scores(counts: DataFrame) -> DataFrame:
    """(class, support, hits, precision, recall, f1) for every class that occurs as a label or as a prediction."""
    # Each cell speaks for two classes: it supports its label and was predicted as its prediction.
    none = F.lit(0).cast("long")
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(none)
    as_label = F.struct(
        F.col("label").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hits.alias("hits")
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")
    )
    sides = counts.select(F.inline(F.array(as_label, as_prediction)))
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    ratios = sums.select(
        "class",
        "support",
        "hits",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
    )
    precision, recall = F.col("precision"), F.col("recall")
    return ratios.withColumn("f1", _ratio(2 * precision * recall, precision + recall))


def class_report(counts: DataFrame) -> DataFrame:
    """(class, support, precision, recall, f1); a ratio without a denominator is 0."""
    return _class_scores(counts).drop("hits")


def weighted_metrics(counts: DataFrame) -> DataFrame:
    """One row: accuracy and the support-weighted f1, precision and recall."""
    support = F.sum("support")
    weighted = [(F.sum(F.col(m) * F.col("support")) / support).alias(m) for m in ("f1", "precision", "recall")]
    return _class_scores(counts).agg((F.sum("hits") / support).alias("accuracy"), *weighted)


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))
