"""Questionnaire scoring, stratified statistics and severity classification on Spark."""

from surveyflow.spec import SurveySpec, default_spec

__all__ = ["SurveySpec", "default_spec"]
