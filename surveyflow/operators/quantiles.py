"""Exact interpolated quantiles and box-plot statistics of any number of columns, at any size.

The built-in exact ``percentile`` ships a map of all distinct values from every task to one task per group. Here the
values are first counted by (group, measure, value) — partial aggregation leaves each task one row per distinct value
and the shuffle is spread over the values — and the histogram is stored. A key with few distinct values is ranked as it
is. Of larger ones the range that holds a wanted rank is cut again and again, at approximate quantiles of its distinct
values, until it has no more than a constant number of them. So what one task puts in order never follows the data, and
the approximate cuts only decide how fast the ranges shrink, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyflow.sources.scratch import materialize

#: Distinct values that one task may put in order.
RANKED = 1 << 16
#: Ranges that a round cuts a range into, a power of two, and the accuracy of the cuts.
STEPS = 256
ACCURACY = 16 * STEPS


def value_histogram(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., measure, value, n): how often each distinct non-missing value occurs."""
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(list(by), list(columns), "measure", "value")
    present = F.col("value").isNotNull() & ~F.isnan("value")
    return long.filter(present).groupBy(*by, "measure", "value").agg(F.count(F.lit(1)).alias("n"))


def stored_histogram(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return materialize(value_histogram(df, columns, by), "histogram")


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Inner join to an aggregate of the same frame with a fixed number of rows per key; null keys match.

    ``small`` says that the keys are declared lists (measures, classes, age groups), which bounds the right side by
    the spec and not by the data: it is broadcast. Otherwise the join is left to Spark, which shuffles when it must
    and splits frequent keys.
    """
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    side = F.broadcast(renamed) if small else renamed
    return left.join(side, condition).drop(*[f"__{k}" for k in keys])


def _position(probability: float, total: Column) -> Column:
    return (total - 1) * F.lit(float(probability))


def _wanted(probabilities: dict[str, float], total: str, ahead: Column, held: Column) -> Column:
    """Whether a range that has ``ahead`` rows before it and ``held`` in it holds a wanted rank."""
    ranks = [side(_position(p, F.col(total))) for p in probabilities.values() for side in (F.floor, F.ceil)]
    inside = [(r >= ahead) & (r < ahead + held) for r in ranks]
    wanted = inside[0]
    for condition in inside[1:]:
        wanted = wanted | condition
    return wanted


def _cut(stored: DataFrame, ranges: DataFrame, keys: Sequence[str], probabilities: dict[str, float], small: bool) -> DataFrame:
    """The parts of ``ranges`` that hold a wanted rank, each with about 1 / STEPS of its range's distinct values."""
    of = [*keys, "low", "high", "ahead", "total"]
    inside = F.col("value").between(F.col("low"), F.col("high"))
    steps = F.expr(f"array({', '.join(f'{i / STEPS}D' for i in range(1, STEPS))})")
    cuts = _on(stored, ranges, keys, small).filter(inside).groupBy(*of).agg(
        F.percentile_approx("value", steps, F.lit(ACCURACY)).alias("cuts")
    )
    placed = _on(stored, cuts, keys, small).filter(inside).withColumn("part", F.lit(0))
    step = STEPS // 2
    while step:  # a part is the number of cuts below the value, found by halving
        below = F.get("cuts", F.col("part") + (step - 1)) < F.col("value")
        placed = placed.withColumn("part", F.col("part") + F.when(below, step).otherwise(0))
        step //= 2
    counted = placed.groupBy(*of, "part").agg(
        F.sum("n").alias("held"), F.count(F.lit(1)).alias("distinct"), F.min("value").alias("from"), F.max("value").alias("to")
    )
    upto = F.sum("held").over(Window.partitionBy(*of).orderBy("part"))  # at most STEPS rows
    found = counted.withColumn("before", F.col("ahead") + upto - F.col("held"))
    return found.filter(_wanted(probabilities, "total", F.col("before"), F.col("held"))).select(
        *keys, F.col("from").alias("low"), F.col("to").alias("high"), F.col("before").alias("ahead"), "total", "distinct"
    )


def wanted_ranges(
    stored: DataFrame, keys: Sequence[str], probabilities: dict[str, float], small: bool, most: int = RANKED
) -> DataFrame | None:
    """(keys..., low, high, ahead, total, distinct): ranges of at most ``most`` distinct values that hold the wanted ranks.

    None, if every key has as few values as that anyway. A round reads the stored histogram twice; the rounds grow with the
    logarithm of the largest key.
    """
    largest = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("distinct")).agg(F.max("distinct")).first()[0] or 0
    if largest <= most:
        return None
    whole = stored.groupBy(*keys).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.lit(0).cast("long").alias("ahead"),
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"),
    )
    ranges = materialize(whole, "quantile-ranges")
    while ranges.agg(F.max("distinct")).first()[0] > most:
        wide = ranges.filter(F.col("distinct") > most)
        cut = _cut(stored, wide.drop("distinct"), keys, probabilities, small)
        ranges = materialize(ranges.filter(F.col("distinct") <= most).unionByName(cut), "quantile-ranges")
    return ranges


def declared(column: str, values: Sequence[str]) -> Column:
    """The column, if it has one of the declared values; anything else fails the job."""
    other = F.raise_error(F.concat(F.lit(f"{column} has an undeclared value: "), F.col(column).cast("string")))
    return F.when(F.col(column).isNull() | F.col(column).isin(list(values)), F.col(column)).otherwise(other)


def quantiles_of(
    histogram: DataFrame, probabilities: dict[str, float], by: Sequence[str] = (), closed: bool = False, most: int = RANKED
) -> DataFrame:
    """(by..., measure, total, one column per probability) from a stored value histogram.

    ``closed=True`` says that the grouping columns only have values of a declared list, which the caller has verified.
    """
    keys, small = [*by, "measure"], closed or not by
    ranges = wanted_ranges(histogram, keys, probabilities, small, most)
    if ranges is None:
        every = Window.partitionBy(*keys)
        ranked = histogram.withColumn("upto", F.sum("n").over(every.orderBy("value"))).withColumn("total", F.sum("n").over(every))
    else:
        hit = _on(histogram, ranges, keys, small).filter(F.col("value").between(F.col("low"), F.col("high")))
        within = Window.partitionBy(*keys, "low").orderBy("value")
        ranked = hit.withColumn("upto", F.col("ahead") + F.sum("n").over(within))
    bounds = []
    for name, p in probabilities.items():
        position = _position(p, F.col("total"))
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            bounds.append(F.min(F.when(F.col("upto") > rank, F.col("value"))).alias(f"{name}_{side}"))
    found = ranked.groupBy(*keys).agg(F.max("total").alias("total"), *bounds)
    return found.select(*keys, "total", *[_between(name, p).alias(name) for name, p in probabilities.items()])


def _between(name: str, probability: float) -> Column:
    """Linear interpolation between the two neighbours of the position; infinities stay what they are."""
    low, high, position = F.col(f"{name}_low"), F.col(f"{name}_high"), _position(probability, F.col("total"))
    return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))


def column_medians(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """(measure, median) over all rows, nulls and NaN ignored; a column without values has no row.

    ``approx=True`` is one pass with a bounded sketch, for continuous columns where almost every value is distinct.
    """
    if approx:
        present = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
        medians = df.agg(*[F.percentile_approx(v, 0.5).alias(c) for v, c in zip(present, columns)])
        return medians.unpivot([], list(columns), "measure", "median").filter(F.col("median").isNotNull())
    return quantiles_of(stored_histogram(df, columns), {"median": 0.5}).select("measure", "median")


def _grouped(df: DataFrame, by: str, closed: Sequence[str] | None) -> DataFrame:
    known = df.filter(F.col(by).isNotNull())
    return known.withColumn(by, declared(by, closed)) if closed else known


def box_stats(df: DataFrame, measure: str, by: str, closed: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, whiskers and number of outliers per group, all from one histogram of the measure.

    ``closed`` is the declared list of groups, verified row by row, so that per-group rows may be broadcast.

    A whisker ends at the most extreme value within 1.5 IQR of its quartile, or at the quartile when there is none.
    """
    histogram = stored_histogram(_grouped(df, by, closed), [measure], [by])
    fences = _fences(histogram, by, bool(closed))
    value, inside = F.col("value"), F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    found = _on(histogram, fences, [by, "measure"], bool(closed)).groupBy(by, "q1", "median", "q3").agg(
        F.sum("n").alias("n"),
        F.min(F.when(value >= F.col("low_fence"), value)).alias("lowest"),
        F.max(F.when(value <= F.col("high_fence"), value)).alias("highest"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("outliers"),
    )
    return found.select(
        by,
        "n",
        "q1",
        "median",
        "q3",
        F.least("q1", "lowest").alias("whisker_low"),
        F.greatest("q3", "highest").alias("whisker_high"),
        "outliers",
    )


def box_outliers(df: DataFrame, measure: str, by: str, closed: Sequence[str] | None = None) -> DataFrame:
    """The rows beyond the fences of their group."""
    grouped = _grouped(df, by, closed)
    fences = _fences(stored_histogram(grouped, [measure], [by]), by, bool(closed)).select(by, "low_fence", "high_fence")
    value = F.col(measure)
    beyond = (value < F.col("low_fence")) | (value > F.col("high_fence"))  # NaN is a missing value, not a large one
    present = ~F.isnan(value.cast("double"))
    return _on(grouped, fences, [by], bool(closed)).filter(present & beyond).drop("low_fence", "high_fence")


def _fences(histogram: DataFrame, by: str, closed: bool) -> DataFrame:
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return quantiles_of(histogram, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by], closed).select(
        by,
        "measure",
        "q1",
        "median",
        "q3",
        (F.col("q1") - reach).alias("low_fence"),
        (F.col("q3") + reach).alias("high_fence"),
    )
