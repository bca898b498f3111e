"""The datasets behind the report figures. Each is bounded by the number of classes, age groups or features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyflow.functions import display_or_self, ordinal
from surveyflow.operators import evaluate, forest, quantiles, stats
from surveyflow.operators.score import AGE_GROUP, SEVERITY_LABEL, SEVERITY_ORD, add_age_group, add_severity_label
from surveyflow.operators.score import add_severity_ordinal
from surveyflow.spec import PATIENTS, SurveySpec


def distribution(gold: DataFrame, spec: SurveySpec) -> DataFrame:
    """Size and share of each observed class, in clinical order."""
    sizes = stats.severity_stats(gold, spec, means=()).withColumnRenamed(PATIENTS, "patients")
    labelled = add_severity_label(stats.with_percent(sizes, "patients"), spec)
    return labelled.orderBy(SEVERITY_ORD).select(SEVERITY_LABEL, SEVERITY_ORD, "patients", "percent")


def biomarkers(gold: DataFrame, spec: SurveySpec) -> DataFrame:
    """Unrounded means per class, in clinical order."""
    means = add_severity_label(stats.severity_stats(gold, spec, spec.chart_biomarkers), spec)
    names = [alias for _, alias, _ in spec.chart_biomarkers]
    return means.orderBy(SEVERITY_ORD).select(SEVERITY_LABEL, SEVERITY_ORD, *names)


def age_severity(gold: DataFrame, spec: SurveySpec) -> DataFrame:
    """Share of each class within each age group."""
    table = stats.crosstab_percent(add_age_group(gold, spec), AGE_GROUP, spec.severity, spec.severity_order)
    shown = [F.col(c).alias(spec.severity_display[c]) for c in spec.severity_order]
    return table.select(AGE_GROUP, *shown).orderBy(ordinal(AGE_GROUP, spec.age_labels))


def severity_box(gold: DataFrame, spec: SurveySpec, measure: str) -> DataFrame:
    """Box-plot statistics of a measure per class, in clinical order."""
    boxes = add_severity_label(add_severity_ordinal(quantiles.box_stats(gold, measure, spec.severity, closed=spec.severity_order), spec), spec)
    rest = [c for c in boxes.columns if c not in (spec.severity, SEVERITY_LABEL, SEVERITY_ORD)]
    return boxes.orderBy(SEVERITY_ORD).select(SEVERITY_LABEL, SEVERITY_ORD, *rest)


def age_box(gold: DataFrame, spec: SurveySpec, measure: str) -> DataFrame:
    """Box-plot statistics of a measure per age group."""
    boxes = quantiles.box_stats(add_age_group(gold, spec), measure, AGE_GROUP, closed=spec.age_labels)
    return boxes.orderBy(ordinal(AGE_GROUP, spec.age_labels))


def confusion(predicted: DataFrame, spec: SurveySpec, label: str, prediction: str) -> DataFrame:
    """Confusion matrix with display names on both axes, in encoder order."""
    matrix = evaluate.confusion_matrix(evaluate.confusion_counts(predicted, label, prediction), spec.severity_classes)
    shown = [F.col(c).alias(spec.severity_display[c]) for c in spec.severity_classes]
    return matrix.select(display_or_self("label", spec.severity_display).alias(SEVERITY_LABEL), *shown)


def top_features(scores: DataFrame, spec: SurveySpec, k: int = 10) -> DataFrame:
    """The k most important features with display names, smallest first, as a horizontal bar chart draws them."""
    top = forest.top_features(scores, k)
    named = top.withColumn("feature_label", display_or_self("feature", spec.feature_display))
    return named.orderBy("importance", F.desc("feature"))
