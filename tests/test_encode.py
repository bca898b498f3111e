"""Encoding by dictionaries larger than what is looked up in place."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from surveyflow.operators import encode


def survey(spark, n: int, kinds: int):
    value = lambda seed: F.concat(F.lit("v"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(kinds)).cast("string"))
    missing = F.when(F.col("id") % 3 == 0, None)
    return spark.range(0, n, 1, 6).select(
        "id", missing.otherwise(value(1)).alias("a"), missing.otherwise(value(2)).alias("b"), (F.col("id") % 4).cast("string").alias("c")
    )


def indexer(df, held, invalid="error"):
    dictionary = encode.category_dictionary(df, ["a", "b", "c"], "UNKNOWN")
    return encode.CategoryIndexer.over(dictionary, ["a", "b", "c"], "UNKNOWN", "_Idx", invalid, held)


@pytest.mark.parametrize("held", [0, 1, 5, 50, 10_000])
def test_any_share_of_settled_values(spark, held):
    df = survey(spark, 3000, 200)
    rows = indexer(df, held).transform(df).collect()
    assert len(rows) == 3000
    for c in "abc":
        ranks = {v: float(i) for i, v in enumerate(sorted({r[c] or "UNKNOWN" for r in rows}))}
        assert all(r[f"{c}_Idx"] == ranks[r[c] or "UNKNOWN"] for r in rows)


def test_the_value_for_missing_is_settled_in_place(spark):
    df = survey(spark, 3000, 200)
    assert [v for v, _ in indexer(df, 1).settled["a"]] == ["UNKNOWN"]


@pytest.mark.parametrize("held", [3, 10_000])
def test_unseen_values(spark, held):
    df = survey(spark, 600, 50)
    new = df.filter("id < 10").withColumn("a", F.lit("never"))
    with pytest.raises(Exception, match="(?i)unseen"):
        indexer(df, held).transform(new).collect()
    kept = indexer(df, held, "keep").transform(new)
    assert {r["a_Idx"] for r in kept.collect()} == {float(indexer(df, held).sizes["a"])}
    assert kept.schema["a_Idx"].metadata["ml_attr"]["num_vals"] == indexer(df, held).sizes["a"] + 1


def test_large_dictionaries_take_one_exchange_of_the_rows(spark):
    """Two columns of 200,000 values: the rows move once, by their number; else only pairs and the dictionary move."""
    df = survey(spark, 1_200_000, 200_000)
    coded = indexer(df, encode.SETTLED)
    assert min(coded.sizes["a"], coded.sizes["b"]) > 180_000 > encode.SETTLED
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = coded.transform(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("hashpartitioning(__row" in line for line in exchanges) == 2, exchanges  # the rows, and a record a row
    assert sum("hashpartitioning(column" in line for line in exchanges) == 2, exchanges  # the pairs, and the dictionary
    assert len(exchanges) == 4, exchanges
    checked = out.agg(F.count("a_Idx"), F.count_if(F.col("a_Idx") < coded.sizes["a"])).first()
    assert tuple(checked) == (1_200_000, 1_200_000)


def test_no_columns_and_no_rows(spark):
    df = survey(spark, 10, 5)
    empty = df.limit(0)
    assert indexer(empty, 5).transform(empty).collect() == []
    none = encode.CategoryIndexer.over(encode.category_dictionary(df, [], "UNKNOWN"), [], "UNKNOWN", "_Idx")
    assert none.transform(df).columns == df.columns
