"""Selection, eligibility and cleaning."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyflow.functions import fill_category, null_above
from surveyflow.spec import SurveySpec


def select_relevant(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """The key and the relevant columns out of the wide survey."""
    return df.select(spec.key, *spec.columns)


def filter_eligible(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Respondents of the minimum age or older; an unknown age is not eligible."""
    return df.filter(F.col(spec.age) >= spec.min_age)


def clean_items(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Refused and don't-know codes of the questionnaire items to null."""
    return df.withColumns({c: null_above(c, spec.item_max) for c in spec.items})


def clean_bounds(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Physically impossible values to null, per declared bound."""
    return df.withColumns({c: null_above(c, limit) for c, limit in spec.bounds.items()})


def keep_scorable(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Rows whose items are all answered.

    Keeps exactly the rows that cleaning, summing and dropping null scores would keep (null, NaN and codes above the
    maximum all fail the comparison), but as plain column predicates, which reach the Parquet scan.
    """
    return df.filter(reduce(operator.and_, [F.col(c) <= spec.item_max for c in spec.items]))


def drop_unscored(df: DataFrame, spec: SurveySpec) -> DataFrame:
    return df.dropna(subset=[spec.score])


def fill_unknown(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Missing categories become a category of their own."""
    return df.withColumns({c: fill_category(c, spec.missing_category) for c in spec.categorical})
