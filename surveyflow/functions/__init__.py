"""Column expressions: all JVM-side, no Python workers."""

from surveyflow.functions.labels import display, display_or_self, ordinal
from surveyflow.functions.recode import fill_category, nan_to_null, null_above
from surveyflow.functions.scoring import ladder, right_closed_bin, row_sum

__all__ = [
    "display",
    "display_or_self",
    "fill_category",
    "ladder",
    "nan_to_null",
    "null_above",
    "ordinal",
    "right_closed_bin",
    "row_sum",
]
