"""The three table stages. Silver and gold are each one narrow pass; nothing is shuffled before the first aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from surveyflow.operators.clean import clean_bounds, clean_items, drop_unscored, filter_eligible, keep_scorable
from surveyflow.operators.clean import select_relevant
from surveyflow.operators.score import add_score, add_severity
from surveyflow.sources.readers import normalize_missing, require_key
from surveyflow.spec import SurveySpec


def bronze(raw: DataFrame, spec: SurveySpec) -> DataFrame:
    return normalize_missing(require_key(raw, spec.key))


def eligible(bronze_df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Selected columns of eligible respondents, codes and bounds cleaned, not yet scored."""
    return clean_bounds(clean_items(filter_eligible(select_relevant(bronze_df, spec), spec), spec), spec)


def silver(bronze_df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Cleaned and scored respondents.

    Filtering on the items before they are cleaned and summed keeps the same rows as dropping null scores afterwards,
    and lets every predicate reach the scan.
    """
    answered = keep_scorable(filter_eligible(select_relevant(bronze_df, spec), spec), spec)
    return drop_unscored(add_score(clean_bounds(answered, spec), spec), spec)


def gold(silver_df: DataFrame, spec: SurveySpec) -> DataFrame:
    return add_severity(silver_df, spec)
