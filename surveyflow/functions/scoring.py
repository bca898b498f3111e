"""Row-wise scoring: sums, threshold ladders and labelled bins."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns of one row; null as soon as one of them is null."""
    return reduce(operator.add, [F.col(c) for c in columns])


def ladder(value: Column, cuts: Sequence[tuple[float, str]], top: str) -> Column:
    """First class whose upper cut is not exceeded, ``top`` above the last cut, null for null."""
    (first_cut, first_name), *rest = cuts
    steps = F.when(value <= first_cut, F.lit(first_name))
    for cut, name in rest:
        steps = steps.when(value <= cut, F.lit(name))
    return steps.when(value > cuts[-1][0], F.lit(top))


def right_closed_bin(column: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(low, high]`` that holds the value; null outside all of them."""
    if len(labels) != len(edges) - 1:
        raise ValueError("a bin needs one label per interval")
    value = F.col(column)
    bins = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > low) & (value <= high)
        bins = F.when(inside, F.lit(label)) if bins is None else bins.when(inside, F.lit(label))
    return bins
