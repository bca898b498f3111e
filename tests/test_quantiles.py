"""Histogram quantiles against numpy on awkward distributions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from surveyflow.operators import quantiles as QT

PROBABILITIES = {"p0": 0.0, "p10": 0.1, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}


def distributions():
    rng = np.random.default_rng(5)
    return {
        "continuous": rng.normal(size=6000),
        "heavy_tail": rng.lognormal(sigma=6, size=5001),
        "one_hot_value": np.where(rng.random(6000) < 0.4, 7.0, np.round(rng.random(6000) * 50)),
        "constant": np.full(100, 3.25),
        "far_outlier": np.append(rng.integers(0, 1441, 4000).astype(float), [1e300, -1e300]),
        "two_values": np.array([1.0, 2.0]),
        "one_value": np.array([-4.5]),
        "signed_zero": np.array([-0.0, 0.0, 0.0, -0.0, 1.0]),
    }


@pytest.mark.parametrize(("closed", "most"), [(True, QT.RANKED), (False, QT.RANKED), (True, 40), (False, 2)])
def test_against_numpy_by_group(spark, closed, most):
    """With few distinct values a task, ranges are cut once or several times."""
    frames = [pd.DataFrame({"g": name, "x": values}) for name, values in distributions().items()]
    df = spark.createDataFrame(pd.concat(frames)).repartition(7)
    found = QT.quantiles_of(QT.stored_histogram(df, ["x"], ["g"]), PROBABILITIES, ["g"], closed, most).collect()
    assert {r["g"] for r in found} == set(distributions())
    for row in found:
        values = distributions()[row["g"]]
        assert row["total"] == len(values)
        for name, p in PROBABILITIES.items():
            assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300), (row["g"], name)


def test_many_columns_at_once(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({f"c{i}": rng.normal(size=2000) * 10**i for i in range(5)})
    pdf.loc[::3, "c2"] = np.nan
    df = spark.createDataFrame(pdf)
    found = {r["measure"]: r["median"] for r in QT.column_medians(df, list(pdf.columns)).collect()}
    assert found == pytest.approx(pdf.median().to_dict(), rel=1e-12)


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    found = QT.quantiles_of(QT.stored_histogram(df, ["x"], ["g"]), {"median": 0.5}, ["g"]).collect()
    assert {r["g"]: r["median"] for r in found} == {None: 2.0, "a": 5.0}


def test_missing_values_do_not_count(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert QT.column_medians(df, ["x"]).first()["median"] == 1.5


def test_nan_is_no_outlier(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4, 100)] + [("a", float("nan"))], "g string, x double")
    assert [r["x"] for r in QT.box_outliers(df, "x", "g", closed=["a"]).collect()] == [100.0]


def test_undeclared_group_fails(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, x double")
    with pytest.raises(Exception, match="undeclared"):
        QT.box_stats(df, "x", "g", closed=["a"]).collect()


def test_infinities(spark):
    df = spark.createDataFrame([(math.inf,), (math.inf,), (1.0,)], "x double")
    assert QT.column_medians(df, ["x"]).first()["median"] == math.inf


def test_approximate_medians(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("empty"))
    found = {r["measure"]: r["median"] for r in QT.column_medians(df, ["x", "empty"], approx=True).collect()}
    assert set(found) == {"x"} and math.isclose(found["x"], 5000, abs_tol=5)


def test_what_a_task_ranks_is_bounded(spark):
    """Two million distinct values: no ranked range exceeds the constant, and the ranks come out exactly."""
    df = spark.range(2_000_000).select(F.exp(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e8).alias("x"))
    stored = QT.stored_histogram(df, ["x"])
    wanted = {"q1": 0.25, "median": 0.5}
    ranges = QT.wanted_ranges(stored, ["measure"], wanted, True).collect()
    assert 1 <= len(ranges) <= 4 and all(0 < r["distinct"] <= QT.RANKED for r in ranges)
    for r in ranges:
        assert r["ahead"] == stored.filter(F.col("value") < r["low"]).agg(F.sum("n")).first()[0]
    found = QT.quantiles_of(stored, wanted).first()
    exact = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]
    assert [found["q1"], found["median"]] == pytest.approx(exact, rel=1e-12)
    fine = QT.wanted_ranges(stored, ["measure"], {"median": 0.5}, True, most=100).collect()
    assert all(r["distinct"] <= 100 for r in fine)


def test_box_stats_against_brute_force(spark):
    frames = [pd.DataFrame({"g": name, "x": values}) for name, values in distributions().items() if len(values) > 4]
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf)
    outliers = QT.box_outliers(df, "x", "g").groupBy("g").count().toPandas().set_index("g")["count"].to_dict()
    for row in QT.box_stats(df, "x", "g").collect():
        x = pdf.loc[pdf["g"] == row["g"], "x"]
        q1, q3 = np.quantile(x, [0.25, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        outside = int(((x < low) | (x > high)).sum())
        assert row["n"] == len(x) and row["outliers"] == outside == outliers.get(row["g"], 0)
        assert row["whisker_low"] == pytest.approx(min(q1, x[x >= low].min()))
        assert row["whisker_high"] == pytest.approx(max(q3, x[x <= high].max()))
