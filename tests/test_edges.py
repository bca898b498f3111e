"""Hand-written boundary rows."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from surveyflow.functions import display, display_or_self, ladder, ordinal, right_closed_bin
from surveyflow.operators import clean, encode, evaluate, quality, quantiles, score, stats
from surveyflow.plans import charts, stages
from surveyflow.sources.readers import normalize_missing


def column(spark, values, name="x", kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} {kind}")


def listed(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def respondents(spark, spec, *rows):
    """Rows given as dicts over a fully answered adult."""
    base = {c: 0.0 for c in (*spec.items, *spec.numeric)} | {c: "L0" for c in (*spec.categorical, *spec.auxiliary)}
    base[spec.age] = 40.0
    kinds = {c: ("string" if isinstance(base[c], str) else "double") for c in spec.columns}
    schema = f"{spec.key} bigint, " + ", ".join(f"{c} {kinds[c]}" for c in spec.columns)
    data = [(i, *[{**base, **row}[c] for c in spec.columns]) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def test_item_boundary(spark, spec):
    item = spec.items[0]
    df = respondents(spark, spec, *[{item: v} for v in (3.0, 4.0, 7.0, 9.0, None, -1.0)])
    cleaned = clean.clean_items(df, spec).orderBy(spec.key).collect()
    assert [r[item] for r in cleaned] == [3.0, None, None, None, None, -1.0]


def test_sedentary_boundary(spark, spec):
    values = (1440.0, 1441.0, 7777.0, None)
    df = respondents(spark, spec, *[{"MinutesSedentaryActivity": v} for v in values])
    cleaned = clean.clean_bounds(df, spec).orderBy(spec.key).collect()
    assert [r["MinutesSedentaryActivity"] for r in cleaned] == [1440.0, None, None, None]
    found = quality.validate_range(clean.clean_bounds(df, spec), "MinutesSedentaryActivity").first()
    assert tuple(found) == (1440.0, 1440.0, 3)


def test_other_columns_keep_their_codes(spark, spec):
    df = respondents(spark, spec, {"SleepHoursWeekdaysOrWorkdays": 99.0})
    assert stages.silver(df, spec).first()["SleepHoursWeekdaysOrWorkdays"] == 99.0


def test_age_boundary(spark, spec):
    df = respondents(spark, spec, *[{spec.age: v} for v in (17.0, 18.0, None)])
    assert [r[spec.key] for r in clean.filter_eligible(df, spec).collect()] == [1]


@pytest.mark.parametrize("bad", [None, 4.0, 7.0, 9.0, float("nan")])
def test_one_unanswered_item_drops_the_row(spark, spec, bad):
    df = respondents(spark, spec, {c: 3.0 for c in spec.items}, {c: 3.0 for c in spec.items} | {spec.items[5]: bad})
    by_filter = stages.silver(df, spec)
    by_score = clean.drop_unscored(score.add_score(stages.eligible(df, spec), spec), spec)
    for scored in (by_filter, by_score):
        assert [(r[spec.key], r[spec.score]) for r in scored.collect()] == [(0, 24.0)]


def test_lowest_and_highest_class(spark, spec):
    df = respondents(spark, spec, {}, {c: 3.0 for c in spec.items})
    rows = stages.gold(stages.silver(df, spec), spec).orderBy(spec.key).collect()
    assert [(r[spec.score], r[spec.severity]) for r in rows] == [(0.0, "Minimala"), (24.0, "Severa")]


def test_ladder(spark, spec):
    df = column(spark, [4.0, 5.0, 9.0, 10.0, 14.0, 15.0, 19.0, 20.0, 4.5, None])
    classes = listed(df.withColumn("c", ladder(F.col("x"), spec.cuts, spec.top)), "c")
    assert classes == [
        "Minimala", "Usoara", "Usoara", "Moderata", "Moderata", "Moderat_Severa", "Moderat_Severa", "Severa", "Usoara",
        None,
    ]


def test_age_bins(spark, spec):
    df = column(spark, [17.0, 18.0, 29.0, 30.0, 44.0, 45.0, 59.0, 60.0, 100.0, 101.0, None])
    bins = listed(df.withColumn("b", right_closed_bin("x", spec.age_edges, spec.age_labels)), "b")
    a, b, c, d = spec.age_labels
    assert bins == [None, a, a, b, b, c, c, d, d, None, None]


def test_labels(spark, spec):
    df = column(spark, ["Usoara", "Severa", "other", None], kind="string")
    assert listed(df.withColumn("s", display("x", spec.severity_display)), "s") == ["Ușoară", "Severă", None, None]
    kept = listed(df.withColumn("s", display_or_self("x", spec.severity_display)), "s")
    assert kept == ["Ușoară", "Severă", "other", None]
    assert listed(df.withColumn("s", ordinal("x", spec.severity_order)), "s") == [1, 4, None, None]


def test_nan_at_ingest(spark):
    df = column(spark, [float("nan"), 1.0, None])
    assert listed(normalize_missing(df), "x") == [None, 1.0, None]


def test_encoder_order(spark):
    df = column(spark, ["b", "a", None, "a"], kind="string")
    found = {r["value"]: r["idx"] for r in encode.category_dictionary(df, ["x"], "UNKNOWN").collect()}
    assert found == {"UNKNOWN": 0, "a": 1, "b": 2}


def test_encoder_follows_code_points(spark, spec):
    """A code-unit sort would put the last two the other way round."""
    values = ["Z", "_", "a", "￮", "\U0001f600"]
    df = respondents(spark, spec, *[{"Gender": v} for v in reversed(values)])
    rows = encode.encode_categoricals(df, spec).orderBy(spec.key).collect()
    assert [r["Gender_Idx"] for r in rows] == [4.0, 3.0, 2.0, 1.0, 0.0]


def test_unseen_value_fails_or_gets_its_own_index(spark, spec):
    known = respondents(spark, spec, *[{"Gender": v} for v in ("d", "c", None)])
    dictionary = encode.category_dictionary(known, list(spec.categorical), spec.missing_category)
    new = respondents(spark, spec, {"Gender": "x"}, {"Gender": "c"})
    with pytest.raises(Exception, match="unseen value of Gender"):
        encode.CategoryIndexer.of(dictionary, spec).transform(new).collect()
    kept = encode.CategoryIndexer.of(dictionary, spec, invalid="keep").transform(new).orderBy(spec.key).collect()
    assert [r["Gender_Idx"] for r in kept] == [3.0, 1.0]


def test_quote_in_the_missing_category(spark, spec):
    odd = dataclasses.replace(spec, missing_category="it's")
    df = respondents(spark, odd, {"Gender": None}, {"Gender": "a"})
    rows = encode.encode_categoricals(df, odd).orderBy(odd.key).collect()
    assert [r["Gender_Idx"] for r in rows] == [1.0, 0.0]


def test_dictionary_of_many_values(spark, spec):
    """Numbered by ranges: the order is that of code points, without gaps, and no window is over a whole column."""
    df = spark.range(200_000).select(F.concat(F.lit("v"), F.hex(F.xxhash64("id"))).alias("x"), F.lit("one").alias("y"))
    found = encode.category_dictionary(df, ["x", "y"], "UNKNOWN").toPandas()
    values = found[found["column"] == "x"].sort_values("idx")
    assert values["idx"].tolist() == list(range(200_000)) and values["value"].is_monotonic_increasing
    assert found[found["column"] == "y"]["idx"].tolist() == [0]


def test_integer_columns_are_imputed_between_integers(spark):
    df = spark.createDataFrame([(0, 2), (1, 3), (2, None)], "id int, x int")
    assert listed(encode.impute_medians(df, ["x"]), "x") == [2.0, 3.0, 2.5]
    stages_ = [encode.as_doubles(["x"]), encode.median_imputer(df, ["x"])]
    for stage in stages_:
        df = stage.transform(df)
    assert listed(df, "x") == [2.0, 3.0, 2.5]


def test_nan_is_missing(spark):
    df = column(spark, [float("nan"), 1.0])
    assert tuple(quality.validate_range(df, "x").first()) == (1.0, 1.0, 1)
    assert quality.null_columns(df, ["x"]).first()["has_null"]


def test_undeclared_classes_stay_in_the_tables(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z"), ("z", "b"), ("b", "b")], "label string, p string")
    counts = evaluate.confusion_counts(df, "label", "p")
    with pytest.raises(Exception, match="outside the classes"):
        evaluate.confusion_matrix(counts, ["a", "b"]).collect()
    assert [tuple(r) for r in evaluate.confusion_matrix(counts, ["a", "b"], other="other").collect()] == [
        ("a", 1, 0, 1), ("b", 0, 1, 0), ("other", 0, 1, 0),
    ]
    shares = stats.crosstab_percent(df, "label", "p", ["a", "b"]).orderBy("label").collect()
    assert [tuple(r) for r in shares] == [("a", 50.0, 0.0), ("b", 0.0, 100.0), ("z", 0.0, 100.0)]
    only_other = spark.createDataFrame([("g", "z"), ("h", None)], "label string, p string")
    assert {tuple(r) for r in stats.crosstab_percent(only_other, "label", "p", ["a"]).collect()} == {("g", 0.0), ("h", 0.0)}


def test_age_groups_come_in_the_order_of_the_bins(spark, spec):
    named = dataclasses.replace(spec, age_labels=("young", "middle", "old", "aged"))
    df = respondents(spark, named, *[{named.age: a} for a in (70.0, 50.0, 35.0, 20.0)])
    shown = charts.age_severity(stages.gold(stages.silver(df, named), named), named).collect()
    assert [r[0] for r in shown] == ["young", "middle", "old", "aged"]



def test_target_encoding(spark, spec):
    df = column(spark, spec.severity_order, spec.severity, "string")
    encoded = encode.encode_label(df, spec)
    assert {r[spec.severity]: r[spec.label] for r in encoded.collect()} == {
        "Minimala": 0, "Moderat_Severa": 1, "Moderata": 2, "Severa": 3, "Usoara": 4,
    }
    decoded = encode.decode_label(encoded, spec, spec.label, "name")
    assert all(r["name"] == r[spec.severity] for r in decoded.collect())


def test_median_of_an_even_count(spark):
    df = column(spark, [1.0, 2.0, 3.0, 10.0, None])
    assert [tuple(r) for r in quantiles.column_medians(df, ["x"]).collect()] == [("x", 2.5)]
    assert [r["x"] for r in encode.impute_medians(df, ["x"]).orderBy("id").collect()] == [1.0, 2.0, 3.0, 10.0, 2.5]


def test_nothing_to_impute_from(spark):
    with pytest.raises(ValueError, match="no values"):
        encode.median_imputer(column(spark, [None, float("nan")]), ["x"])


def test_class_never_predicted(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "A"), ("B", "A")], "label string, prediction string")
    counts = evaluate.confusion_counts(df, "label", "prediction")
    report = {r["class"]: tuple(r)[1:] for r in evaluate.class_report(counts).collect()}
    assert report["B"] == (1, 0.0, 0.0, 0.0)
    assert report["A"] == (2, pytest.approx(2 / 3), 1.0, pytest.approx(0.8))
    metrics = evaluate.weighted_metrics(counts).first()
    assert metrics["accuracy"] == pytest.approx(2 / 3) == metrics["recall"]
    assert metrics["precision"] == pytest.approx(4 / 9) and metrics["f1"] == pytest.approx(1.6 / 3)
    matrix = [tuple(r) for r in evaluate.confusion_matrix(counts, ["A", "B", "C"]).collect()]
    assert matrix == [("A", 2, 0, 0), ("B", 1, 0, 0), ("C", 0, 0, 0)]


def test_class_predicted_but_never_true(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B")], "label string, prediction string")
    counts = evaluate.confusion_counts(df, "label", "prediction")
    report = {r["class"]: tuple(r)[1:] for r in evaluate.class_report(counts).collect()}
    assert report["B"] == (0, 0.0, 0.0, 0.0)
    assert evaluate.weighted_metrics(counts).first()["accuracy"] == 0.5


def test_metrics_agree_with_the_library_evaluator(spark, spec, small_dir):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from surveyflow.plans import queries as Q

    named = Q.rule_predictions(spark, small_dir)
    ours = evaluate.weighted_metrics(evaluate.confusion_counts(named, spec.severity, "guess")).first()
    indexed = encode.encode_label(named, spec).withColumn(
        "prediction", ordinal("guess", spec.severity_classes).cast("double")
    )
    for metric, name in (("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "precision"),
                         ("weightedRecall", "recall")):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=metric)
        assert evaluator.evaluate(indexed) == pytest.approx(ours[name], abs=1e-12)


def test_crosstab_empty_cell(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "a"), ("h", "b"), (None, "a")], "g string, c string")
    table = {r["g"]: tuple(r)[1:] for r in stats.crosstab_percent(df, "g", "c", ["a", "b"]).collect()}
    assert table == {"g": (100.0, 0.0), "h": (0.0, 100.0)}


def test_percent_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "c string, n bigint")
    assert {r["c"]: r["percent"] for r in stats.with_percent(df, "n").collect()} == {"a": 25.0, "b": 75.0}


def test_box_whiskers(spark):
    df = column(spark, [1.0, 2.0, 3.0, 4.0, 100.0]).withColumn("g", F.lit("all"))
    row = quantiles.box_stats(df, "x", "g").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.0, 3.0, 4.0)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"], row["n"]) == (1.0, 4.0, 1, 5)
    assert [r["x"] for r in quantiles.box_outliers(df, "x", "g").collect()] == [100.0]


def test_whisker_stays_at_the_quartile(spark):
    """No value lies between the fence and an interpolated quartile."""
    df = column(spark, [0.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0]).withColumn("g", F.lit("all"))
    row = quantiles.box_stats(df, "x", "g").first()
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (10.0, 10.0, 1)


def test_null_columns_and_rules(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, "x")], "a double, b string")
    assert {r["column"]: r["has_null"] for r in quality.null_columns(df, ["a", "b"]).collect()} == {
        "a": False, "b": True,
    }
    broken = quality.expect(df, {"a_small": F.col("a") < 2, "b_set": F.col("b") == "x"})
    assert {r["rule"]: r["violations"] for r in broken.collect()} == {"a_small": 1, "b_set": 1}


def test_key_profile(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert tuple(quality.key_profile(df, "k").first()) == (3, 1, 1)


def test_projection_excludes_leaks(spark, spec):
    df = stages.gold(stages.silver(respondents(spark, spec, {}), spec), spec)
    kept = set(encode.feature_projection(df, spec).columns)
    assert kept == {*spec.numeric, *spec.categorical} and not kept & spec.excluded


def test_fixed_names_of_the_default_survey(spec):
    """Literals of their own: the SQL and the queries share one spec, so a wrong entry there could not show."""
    assert len(spec.columns) == 37 and spec.key == "respondent_id" and spec.min_age == 18.0 and spec.item_max == 3.0
    assert spec.items[0] == "FeelingDownDepressedOrHopeless" and len(spec.items) == 8
    assert spec.cuts == ((4, "Minimala"), (9, "Usoara"), (14, "Moderata"), (19, "Moderat_Severa")) and spec.top == "Severa"
    assert spec.bounds == {"MinutesSedentaryActivity": 1440} and len(spec.features) == 25
    assert [alias for _, alias, _ in spec.biomarkers] == ["Avg_HbA1c", "Avg_Cholesterol", "Avg_Systolic", "Avg_Weight", "Avg_Waist"]
    assert [alias for _, alias, _ in spec.behaviour] == ["Avg_Sleep", "Avg_Sedentary_Min", "Avg_Alcohol", "Avg_Age"]
