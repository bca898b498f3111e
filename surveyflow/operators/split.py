"""Seeded, exactly stratified train/test split that does not depend on row order or partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyflow.operators.quantiles import declared

IS_TEST = "is_test"
DIGITS = 3  # hexadecimal, so 4,096 buckets per level


def class_quotas(sizes: DataFrame, label: str, test_size: Fraction) -> DataFrame:
    """(label, n, n_test) from (label, n): proportional quotas in whole rows.

    ``ceil(test_size * N)`` rows are test rows. Each class gets the whole part of its share of the training rows; the
    rows left over go to the largest fractions, ties in label order. Products are decimals because counts multiply.
    A class of one row cannot be in both parts and fails the job, as it does in the usual library splits.
    """
    everything = Window.partitionBy()  # one row per class
    by_fraction = Window.orderBy(F.desc("fraction"), label)
    wide = "decimal(18,0)"
    top, bottom = test_size.numerator, test_size.denominator
    shares = (
        sizes.withColumn("rows", F.sum("n").over(everything))
        .withColumn("n_train", F.expr(f"rows - (rows * {top} + {bottom - 1}) div {bottom}"))
        .withColumn("product", F.col("n").cast(wide) * F.col("n_train").cast(wide))
        .withColumn("whole", F.expr(f"product div cast(rows as {wide})"))
        .withColumn("fraction", F.expr(f"product % cast(rows as {wide})"))
        .withColumn("left_over", F.col("n_train") - F.sum("whole").over(everything))
        .withColumn("place", F.row_number().over(by_fraction))
    )
    train = F.col("whole") + F.when(F.col("place") <= F.col("left_over"), 1).otherwise(0)
    single = F.raise_error(F.concat(F.lit("class with a single row: "), F.col(label).cast("string")))
    n_test = F.when(F.col("n") < 2, single.cast("long")).otherwise(F.col("n") - train)
    return shares.select(label, "n", n_test.alias("n_test"))


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: Fraction = Fraction(1, 5), seed: int = 42,
    closed: Sequence[str] | None = None,
) -> DataFrame:
    """Adds ``is_test``: in each class the rows with the smallest ``md5(seed:key)``, up to the class's quota.

    Ranking a class would put it into one task. The hash's first digits cut each class into even buckets instead; their
    counts give the one bucket per class in which the quota runs out. Its rows, one in 4,096, are cut and counted once
    more by the next digits, and only the rows of that second bucket are ranked. What comes back is one threshold row
    per class, so the split itself is a comparison in place: nothing but counts and the rows of one bucket is shuffled,
    and the join is to as many rows as there are classes. ``closed`` is the declared list of classes, verified row by
    row, so that those rows may be broadcast. A null key or label fails the job, and so do repeated keys where they
    would break a quota: they have one hash, so they stand side by side at the threshold.
    """
    small = F.broadcast if closed else lambda side: side
    hashed = df.select(
        (declared(label, closed) if closed else F.col(label)).alias("__label"),
        F.col(key).alias("__key"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))).alias("__hash"),
    )
    # Joins infer not-null filters; stated here, they are the same on every use, so the exchanges below are shared.
    hashed = hashed.filter(F.col("__label").isNotNull() & F.col("__key").isNotNull())
    hashed = hashed.withColumn("bucket", _digits(1))

    buckets = hashed.groupBy("__label", "bucket").agg(F.count(F.lit(1)).alias("held"))
    sizes = buckets.groupBy("__label").agg(F.sum("held").alias("n"))
    quotas = class_quotas(sizes, "__label", test_size).select(F.col("__label").alias("quota_label"), "n_test")
    first = _running_out(buckets.join(small(quotas), F.col("__label") == F.col("quota_label")))

    in_first = _in_bucket(hashed, small(first))
    # Placed once, evenly; both the counts and the rows below are taken from this one exchange.
    candidates = in_first.select("__label", "__key", "__hash", F.col("take").alias("n_test")).repartition(
        "__label", "__hash"
    )
    finer = candidates.withColumn("bucket", _digits(1 + DIGITS))
    counts = finer.groupBy("__label", "bucket").agg(F.count("__key").alias("held"), F.max("n_test").alias("n_test"))
    second = _running_out(counts.withColumnRenamed("__label", "quota_label"))

    order = Window.partitionBy("__label").orderBy("__hash", "__key")
    place, following = F.row_number().over(order), F.lead("__key").over(order)
    repeated = F.raise_error(F.concat(F.lit("a quota ends within repeated keys: "), F.col("__key").cast("string")))
    last_key = F.when(F.col("following") == F.col("__key"), repeated.cast(df.schema[key].dataType)).otherwise(F.col("__key"))
    thresholds = (
        _in_bucket(finer, small(second))
        .withColumns({"place": place, "following": following})
        .filter(F.col("place") == F.col("n_test") - F.col("before"))
        .select("quota_label", F.col("__hash").alias("last_hash"), last_key.alias("last_key"))
    )

    row_hash = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    below = (row_hash < F.col("last_hash")) | ((row_hash == F.col("last_hash")) & (F.col(key) <= F.col("last_key")))
    unsound = F.raise_error(F.lit(f"null {key} or {label}")).cast("boolean")
    is_test = F.when(F.col(key).isNull() | F.col(label).isNull(), unsound).otherwise(F.coalesce(below, F.lit(False)))
    return df.join(small(thresholds), F.col(label) == F.col("quota_label"), "left").select(*df.columns, is_test.alias(IS_TEST))


def _digits(start: int) -> Column:
    """Never null, so that no join asks for it and computes the hash once more to find out."""
    return F.coalesce(F.substring("__hash", start, DIGITS), F.lit(""))


def _running_out(counts: DataFrame) -> DataFrame:
    """(quota_label, last_bucket, before, take): per class the bucket that holds its ``n_test``-th row."""
    upto = F.sum("held").over(Window.partitionBy("quota_label").orderBy("bucket"))
    return (
        counts.withColumn("before", upto - F.col("held"))
        .filter((F.col("before") < F.col("n_test")) & (F.col("n_test") <= F.col("before") + F.col("held")))
        .withColumn("take", F.col("n_test") - F.col("before"))
        .select("quota_label", F.col("bucket").alias("last_bucket"), "before", "take")
    )


def _in_bucket(rows: DataFrame, last: DataFrame) -> DataFrame:
    same = (F.col("__label") == F.col("quota_label")) & (F.col("bucket") == F.col("last_bucket"))
    return rows.join(last, same)


def split_counts(split: DataFrame, label: str) -> DataFrame:
    return split.groupBy(label).agg(
        F.count_if(~F.col(IS_TEST)).alias("train_rows"), F.count_if(F.col(IS_TEST)).alias("test_rows")
    )
