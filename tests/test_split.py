"""The split against its contract: exact quotas, seeded, independent of order and partitioning."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from surveyflow.operators.split import class_quotas, split_counts, stratified_split
from surveyflow.plans import queries as Q


def expected_quotas(sizes: dict, test_size: Fraction) -> dict:
    total = sum(sizes.values())
    n_train = total - math.ceil(test_size * total)
    train = {c: n * n_train // total for c, n in sizes.items()}
    fractions = sorted(sizes, key=lambda c: (-(sizes[c] * n_train % total), c))
    for c in fractions[: n_train - sum(train.values())]:
        train[c] += 1
    return {c: sizes[c] - train[c] for c in sizes}


def expected_test_keys(rows, test_size, seed) -> set:
    quotas = expected_quotas(Counter(c for _, c in rows), test_size)
    chosen = set()
    for label, quota in quotas.items():
        keys = [k for k, c in rows if c == label]
        keys.sort(key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        chosen |= set(keys[:quota])
    return chosen


def skewed_rows(n=3000):
    """One class holds most of the rows, one barely any."""
    return [(i, "big" if i % 3 else ("mid" if i % 30 else "rare")) for i in range(n)]


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1154, "b": 374, "c": 84},
        {"a": 2, "b": 2, "c": 3},
        {"a": 5, "b": 5, "c": 5},
        {"a": 700_000_000_000, "b": 299_999_999_999, "c": 13},
    ],
)
def test_quotas(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "label string, n bigint")
    for test_size in (Fraction(1, 5), Fraction(1, 3)):
        found = {r["label"]: r["n_test"] for r in class_quotas(df, "label", test_size).collect()}
        assert found == expected_quotas(sizes, test_size)


@pytest.mark.parametrize("closed", [["big", "mid", "rare"], None])
def test_same_rows_as_brute_force(spark, closed):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k bigint, c string")
    split = stratified_split(df, "k", "c", Fraction(1, 4), seed=7, closed=closed)
    test = {r["k"] for r in split.filter("is_test").collect()}
    assert test == expected_test_keys(rows, Fraction(1, 4), 7)
    assert split.count() == len(rows)


def test_independent_of_order_and_partitioning(spark, spec, small_dir):
    rows = Q.gold(spark, small_dir).select(spec.key, spec.severity)
    once = {r[0] for r in stratified_split(rows, spec.key, spec.severity).filter("is_test").select(spec.key).collect()}
    shuffled = rows.repartition(13, F.rand(1)).sortWithinPartitions(F.rand(2))
    again = stratified_split(shuffled, spec.key, spec.severity).filter("is_test").select(spec.key)
    assert {r[0] for r in again.collect()} == once
    other = stratified_split(rows, spec.key, spec.severity, seed=43).filter("is_test").select(spec.key)
    assert {r[0] for r in other.collect()} != once


def test_a_class_of_one_row_fails(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "lonely")], "k bigint, c string")
    with pytest.raises(Exception, match="single row"):
        split_counts(stratified_split(df, "k", "c"), "c").collect()


@pytest.mark.parametrize("row", [(None, "big"), (9999, None)])
def test_null_key_or_label_fails(spark, row):
    df = spark.createDataFrame([*skewed_rows(60), row], "k bigint, c string")
    with pytest.raises(Exception, match="null k or c"):
        stratified_split(df, "k", "c").collect()


def test_undeclared_class_fails(spark):
    df = spark.createDataFrame(skewed_rows(60), "k bigint, c string")
    with pytest.raises(Exception, match="undeclared"):
        stratified_split(df, "k", "c", closed=["big", "mid"]).collect()


def test_quota_within_repeated_keys_fails(spark):
    df = spark.createDataFrame([(7, "a")] * 10, "k bigint, c string")
    with pytest.raises(Exception, match="repeated keys"):
        stratified_split(df, "k", "c").collect()


def test_string_keys(spark):
    rows = [(f"id-{i}", "ab"[i % 2]) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, c string")
    test = {r["k"] for r in stratified_split(df, "k", "c").filter("is_test").collect()}
    assert test == expected_test_keys(rows, Fraction(1, 5), 42)
