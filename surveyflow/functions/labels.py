"""Display labels and ordinals of closed code lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def display(column: str, mapping: Mapping[str, str]) -> Column:
    """Label of a code; null for a code the mapping does not know."""
    literal_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return literal_map[F.col(column)]


def display_or_self(column: str, mapping: Mapping[str, str]) -> Column:
    """Label of a code, or the code itself when there is none."""
    return F.coalesce(display(column, mapping), F.col(column))


def ordinal(column: str, order: Sequence[str]) -> Column:
    """Position of a value in a fixed order, from 0; null for null and for values outside the order."""
    position = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column))
    return F.nullif(position, F.lit(0).cast("long")).cast("int") - 1
