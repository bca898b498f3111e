"""Scoring and classification of respondents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyflow.functions import display, ladder, ordinal, right_closed_bin, row_sum
from surveyflow.spec import SEVERITY_NAME, SurveySpec

SEVERITY_ORD = "severity_ord"
SEVERITY_LABEL = SEVERITY_NAME
AGE_GROUP = "age_group"


def add_score(df: DataFrame, spec: SurveySpec) -> DataFrame:
    return df.withColumn(spec.score, row_sum(spec.items))


def add_severity(df: DataFrame, spec: SurveySpec) -> DataFrame:
    return df.withColumn(spec.severity, ladder(F.col(spec.score), spec.cuts, spec.top))


def add_severity_ordinal(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Clinical rank of the class, so that results sort by severity and not by alphabet."""
    return df.withColumn(SEVERITY_ORD, ordinal(spec.severity, spec.severity_order))


def add_severity_label(df: DataFrame, spec: SurveySpec) -> DataFrame:
    return df.withColumn(SEVERITY_LABEL, display(spec.severity, spec.severity_display))


def add_age_group(df: DataFrame, spec: SurveySpec) -> DataFrame:
    return df.withColumn(AGE_GROUP, right_closed_bin(spec.age, spec.age_edges, spec.age_labels))
