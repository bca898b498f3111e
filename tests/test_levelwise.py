"""The level-wise forest against one grown in plain Python, on the same rows."""

from __future__ import annotations

import dataclasses
import random
from collections import Counter

import numpy as np
import plain_forest
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from surveyflow.operators import bins, forest, levelwise
from surveyflow.operators.split import IS_TEST
from surveyflow.plans import queries as Q


@pytest.fixture(scope="module")
def trained(spark, small_dir):
    return Q.fitted(spark, small_dir)


@pytest.fixture(scope="module")
def plain(spark, spec, trained):
    """(trees, predicted class by key, test rows) of the full forest of the survey."""
    rows = trained.prepared.select(spec.key, spec.label, vector_to_array("features"), IS_TEST, spec.severity).collect()
    rule = forest.forest_rule(spec)
    trees = plain_forest.fit([(k, int(y), v) for k, y, v, test, _ in rows if not test], rule)
    test = [r for r in rows if r[3]]
    found = {r[0]: spec.severity_classes[plain_forest.predict(trees, r[2], rule.classes)] for r in test}
    return trees, found, {r[0]: r[4] for r in test}


def test_predictions(spark, spec, small_dir, plain):
    rows = Q.rf_predictions(spark, small_dir).collect()
    assert {r[spec.key]: r[forest.PREDICTED_CLASS] for r in rows} == plain[1] and len(rows) == len(plain[1]) == 197
    assert len(set(plain[1].values())) > 1


def test_top_features(spark, spec, small_dir, plain):
    expected = sorted(zip(spec.features, plain_forest.importances(plain[0], len(spec.features))), key=lambda x: (-x[1], x[0]))[:10]
    rows = Q.top_features(spark, small_dir).collect()
    assert [r["feature"] for r in rows] == [f for f, _ in expected]
    assert [r["importance"] for r in rows] == pytest.approx([x for _, x in expected], rel=1e-9)
    shown = Q.chart_top_features(spark, small_dir).collect()
    assert [r["feature"] for r in shown] == [f for f, _ in expected][::-1]
    assert [r["feature_label"] for r in shown] == [spec.feature_display.get(f, f) for f, _ in expected][::-1]


def test_metrics_and_confusion(spark, spec, small_dir, plain):
    cells = Counter((plain[2][k], p) for k, p in plain[1].items())
    classes, total = spec.severity_classes, len(plain[1])
    hits = {c: cells[c, c] for c in classes}
    support = {c: sum(cells[c, p] for p in classes) for c in classes}
    predicted = {c: sum(cells[a, c] for a in classes) for c in classes}
    precision = {c: hits[c] / predicted[c] if predicted[c] else 0.0 for c in classes}
    recall = {c: hits[c] / support[c] if support[c] else 0.0 for c in classes}
    f1 = {c: 2 * precision[c] * recall[c] / (precision[c] + recall[c]) if hits[c] else 0.0 for c in classes}
    weighted = lambda values: sum(values[c] * support[c] for c in classes) / total
    found = Q.rf_metrics(spark, small_dir).first()
    assert found["accuracy"] == pytest.approx(sum(hits.values()) / total)
    assert (found["precision"], found["recall"], found["f1"]) == pytest.approx((weighted(precision), weighted(recall), weighted(f1)))
    shown = {r[0]: list(r)[1:] for r in Q.chart_confusion(spark, small_dir).collect()}
    assert shown == {spec.severity_display[a]: [cells[a, p] for p in classes] for a in classes}


def rows_of(n: int, seed: int = 1) -> list:
    rng = random.Random(seed)
    rows = []
    for key in range(n):
        x = [rng.gauss(0, 1), float(rng.randrange(3)), rng.choice([0.5, 7.0]), round(rng.gauss(5, 2), 1)]
        rows.append((key, min(2, int(x[0] > 0.2) + int(x[1] == 2) * rng.randrange(2)), x))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, label int, features array<double>")


def nodes_of(model) -> list:
    text = model.toDebugString
    return text.splitlines()[1:]


@pytest.mark.parametrize("bootstrap", [True, False])
@pytest.mark.parametrize("most", [4, 64])
def test_any_forest(spark, bootstrap, most, monkeypatch):
    """Also with counting arrays so small that a level takes several passes, and batches of a few rows."""
    rows = rows_of(300)
    rule = levelwise.ForestRule(4, 4, most, 3, 2, bootstrap, 7)
    whole = levelwise.fit_levelwise(frame(spark, rows).repartition(5), "key", "label", "features", rule)
    monkeypatch.setattr(levelwise, "CELLS", 600)
    monkeypatch.setattr(levelwise, "BATCH", 16)
    again = levelwise.fit_levelwise(frame(spark, rows[::-1]).coalesce(1), "key", "label", "features", rule)
    assert nodes_of(whole) == nodes_of(again)
    trees = plain_forest.fit(rows, rule)
    assert list(whole.featureImportances.toArray()) == pytest.approx(plain_forest.importances(trees, 4))
    assert whole.totalNumNodes == sum(map(len, trees))
    from pyspark.ml.linalg import Vectors

    for _, _, x in rows_of(60, seed=2):
        assert whole.predict(Vectors.dense(x)) == plain_forest.predict(trees, x, 3)


def test_one_class_and_constant_features(spark):
    rule = levelwise.ForestRule(2, 3, 8, 2, 2)
    pure = levelwise.fit_levelwise(frame(spark, [(i, 1, [float(i), 1.0]) for i in range(20)]), "key", "label", "features", rule)
    assert pure.totalNumNodes == 2 and not pure.featureImportances.toArray().any()
    flat = levelwise.fit_levelwise(frame(spark, [(i, i % 2, [1.0, 1.0]) for i in range(20)]), "key", "label", "features", rule)
    assert flat.totalNumNodes == 2
    with pytest.raises(ValueError):
        levelwise.fit_levelwise(frame(spark, []), "key", "label", "features", rule)


def test_bags_are_poisson():
    numbers = np.random.default_rng(5).integers(0, levelwise.PRIME, 200_000)
    for tree in range(3):
        weights = levelwise.bag_weights(numbers, 42, tree, True)
        assert weights.mean() == pytest.approx(1, abs=0.01) and weights.var() == pytest.approx(1, abs=0.02)
    first, second = (levelwise.bag_weights(numbers, 42, t, True) for t in (0, 1))
    assert abs(np.corrcoef(first, second)[0, 1]) < 0.01


def test_feature_bins_hold_even_shares(spark):
    rng = random.Random(3)
    values = [0.0] * 4000 + [rng.random() for _ in range(8000)] + [float("inf"), float("-inf")]
    df = spark.createDataFrame([("x", v) for v in values] + [("y", 1.0), ("y", 2.0)], "feature string, value double")
    rows = bins.feature_bins(df, 32).orderBy("feature", "bin").collect()
    x = [r for r in rows if r["feature"] == "x"]
    assert [r["cut"] for r in x if r["cut"] is not None] == plain_forest.cut_points(values, 32)
    assert sum(r["n"] for r in x) == len(values) and [r["bin"] for r in x] == list(range(len(x)))
    assert all(r["n"] <= len(values) / 32 + 1 for r in x if not r["low"] <= 0.0 <= r["high"])
    assert [(r["bin"], r["cut"]) for r in rows if r["feature"] == "y"] == [(0, 1.5), (1, None)]


def test_the_librarys_fit_is_an_option(spark, spec, small_dir):
    few = dataclasses.replace(spec, trees=3, depth=3)
    rows = Q.fitted(spark, small_dir).prepared.filter(~F.col(IS_TEST))
    assert forest.fit_forest(rows, few, method="library").getNumTrees == 3
    with pytest.raises(ValueError):
        forest.fit_forest(rows, few, categorical="nominal", method="levelwise")
