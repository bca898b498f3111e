"""Every operator as a query over a data directory.

Most read the bronze table, which is derived from the ``orders`` of the directory once per session, the way the stages
of a production run read the table the stage before them wrote. It covers all rows. What is kept between queries is
keyed by the listing of the files it comes from, so changed files are read anew, and ``STORE.clear()`` drops it.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.functions import display_or_self, ladder, row_sum
from surveyflow.operators import bins, clean, encode, evaluate, forest, levelwise, quality, quantiles, score, split, stats
from surveyflow.plans import charts, medallion, stages
from surveyflow.session import limit_methods
from surveyflow.sources.files import listing
from surveyflow.sources.orders_survey import survey
from surveyflow.sources.readers import normalize_missing, read_survey_tsv, survey_schema, write_survey_tsv
from surveyflow.sources.scratch import materialize, scratch_path
from surveyflow.sources.tables import ensure_database, read_table, write_table
from surveyflow.spec import default_spec

SPEC = default_spec()
EXTRA = ("o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
METRIC_DIGITS = 12


class Store:
    """Bronze tables and fitted models of a session, by purpose, directory and state of its files."""

    def __init__(self):
        self.held: dict[tuple, object] = {}

    def once(self, spark: SparkSession, sf_dir: str, purpose: str, build: Callable):
        key = (spark.sparkContext.applicationId, purpose, sf_dir, listing(spark, f"{sf_dir}/orders.parquet"))
        if key not in self.held:
            self.held[key] = build()
        return self.held[key]

    def clear(self) -> None:
        self.held.clear()


STORE = Store()


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide raw survey (key, 37 survey columns, further order columns) as a columnar table."""
    limit_methods(spark)
    return STORE.once(
        spark, sf_dir, "bronze", lambda: materialize(stages.bronze(survey(spark, sf_dir, EXTRA), SPEC), "bronze")
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.silver(bronze(spark, sf_dir), SPEC)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.gold(silver(spark, sf_dir), SPEC)


def fitted(spark: SparkSession, sf_dir: str) -> forest.FittedForest:
    """The trained model; figures reuse it instead of fitting again."""
    return STORE.once(spark, sf_dir, "forest", lambda: forest.train_forest(gold(spark, sf_dir), SPEC))


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database for one query; what the query returns must be stored elsewhere before it goes."""
    name = f"surveyflow_{uuid.uuid4().hex[:12]}"
    ensure_database(spark, name, scratch_path(spark, "tables"))
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _split(df: DataFrame) -> DataFrame:
    return split.stratified_split(df, SPEC.key, SPEC.severity, SPEC.test_size, SPEC.seed, closed=SPEC.severity_classes)


def _columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(SPEC.key, *names)


# --- sources and sinks ---------------------------------------------------------------------------------------------


def load_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide survey as tab-separated files of one cycle, read back with declared types."""
    root, cycle = scratch_path(spark, "tsv"), "2017-2018"
    write_survey_tsv(bronze(spark, sf_dir), root, cycle)
    return clean.select_relevant(read_survey_tsv(spark, root, cycle, survey_schema(SPEC)), SPEC)


def respondent_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_profile(bronze(spark, sf_dir), SPEC.key)


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and repeated keys of the orders, keyed by customer with every eleventh customer unknown."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return quality.key_violations(orders.select(F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")).alias("key")), "key")


def with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey as a numeric library hands it over: NaN where a measure is missing."""
    raw = clean.select_relevant(bronze(spark, sf_dir), SPEC)
    numbers = [*SPEC.items, *SPEC.numeric]
    return raw.withColumns({c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in numbers})


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_missing(with_nan(spark, sf_dir))


def scan_stage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _database(spark) as database:
        write_table(silver(spark, sf_dir), f"{database}.silver_survey", replace_schema=True)
        return materialize(_columns(read_table(spark, f"{database}.silver_survey"), SPEC.age, SPEC.score), "read-back")


def write_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _database(spark) as database:
        write_table(bronze(spark, sf_dir), f"{database}.bronze_survey")
        return materialize(clean.select_relevant(read_table(spark, f"{database}.bronze_survey"), SPEC), "read-back")


def write_gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _database(spark) as database:
        write_table(gold(spark, sf_dir), f"{database}.gold_survey", replace_schema=True)
        return materialize(read_table(spark, f"{database}.gold_survey"), "read-back")


def stage_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stage, rows, columns) as observed while the whole chain of tables was written."""
    with _database(spark) as database:
        run = medallion.run_tables(spark, bronze(spark, sf_dir), database, SPEC)
    rows = [(stage, run.rows[stage], run.columns[stage]) for stage in run.rows]
    return spark.createDataFrame(rows, "stage string, rows bigint, columns int")


def stored_severity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _database(spark) as database:
        run = medallion.run_tables(spark, bronze(spark, sf_dir), database, SPEC)
        return materialize(read_table(spark, run.stats_table), "read-back")


def stage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze(spark, sf_dir)
    adult = F.col(SPEC.age) >= SPEC.min_age
    scored = adult & row_sum([c for c in SPEC.items]).isNotNull()
    cleaned = clean.clean_items(raw, SPEC)
    width = len(SPEC.columns) + 1
    return quality.profile_stages(
        cleaned,
        {"bronze": (F.lit(True), len(raw.columns)), "adults": (adult, width), "silver": (scored, width + 1)},
    )


# --- projections, filters, cleaning, scoring -----------------------------------------------------------------------


def select_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.select_relevant(bronze(spark, sf_dir), SPEC)


def clean_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(clean.clean_items(bronze(spark, sf_dir), SPEC), *SPEC.items)


def clean_sedentary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(clean.clean_bounds(bronze(spark, sf_dir), SPEC), *SPEC.bounds)


def filter_adults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.filter_eligible(select_relevant(spark, sf_dir), SPEC)


def row_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(score.add_score(clean.clean_items(bronze(spark, sf_dir), SPEC), SPEC), SPEC.score)


def scored_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_unscored(row_score(spark, sf_dir), SPEC)


def severity_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.add_severity(row_score(spark, sf_dir), SPEC)


def severity_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(score.add_severity_label(gold(spark, sf_dir), SPEC), SPEC.severity, score.SEVERITY_LABEL)


def severity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(score.add_severity_ordinal(gold(spark, sf_dir), SPEC), SPEC.severity, score.SEVERITY_ORD)


def age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(score.add_age_group(bronze(spark, sf_dir), SPEC), SPEC.age, score.AGE_GROUP)


def feature_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers per model input under its display name; names without a label stay as they are."""
    columns = [*SPEC.numeric, *SPEC.categorical]
    answers = gold(spark, sf_dir).agg(*[F.count(c).alias(c) for c in columns])
    long = answers.unpivot([], columns, "feature", "answers")
    return long.withColumn("feature_label", display_or_self("feature", SPEC.feature_display))


def null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_columns(gold(spark, sf_dir), [*SPEC.numeric, *SPEC.categorical, SPEC.score])


def fill_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(clean.fill_unknown(gold(spark, sf_dir), SPEC), *SPEC.categorical)


def validate_sedentary(spark: SparkSession, sf_dir: str) -> DataFrame:
    (column,) = SPEC.bounds
    return quality.validate_range(stages.eligible(bronze(spark, sf_dir), SPEC), column)


def expect_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    (column, limit), *_ = SPEC.bounds.items()
    rules = {
        "adult": F.col(SPEC.age) >= SPEC.min_age,
        "sedentary_in_day": F.col(column) <= limit,
        "first_item_valid": F.col(SPEC.items[0]).between(0, SPEC.item_max),
    }
    return quality.expect(bronze(spark, sf_dir), rules)


def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.feature_projection(gold(spark, sf_dir), SPEC)


# --- statistics ----------------------------------------------------------------------------------------------------


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = encode.encode_label(gold(spark, sf_dir), SPEC)
    return labelled.groupBy(SPEC.label).agg(F.count(F.lit(1)).alias("n")).orderBy(SPEC.label)


def column_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantiles.column_medians(gold(spark, sf_dir), SPEC.numeric)


def box_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = score.add_age_group(gold(spark, sf_dir), SPEC).select(SPEC.key, score.AGE_GROUP, SPEC.score)
    return quantiles.box_outliers(grouped, SPEC.score, score.AGE_GROUP, closed=SPEC.age_labels)


def box_outliers_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outliers of a measure with NaN for missing values, which are no outliers."""
    measure = "MinutesSedentaryActivity"
    grouped = score.add_age_group(with_nan(spark, sf_dir), SPEC).select(SPEC.key, score.AGE_GROUP, measure)
    return quantiles.box_outliers(grouped, measure, score.AGE_GROUP, closed=SPEC.age_labels)


def top_items_by_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_means(gold(spark, sf_dir), SPEC.items, 10)


def _on_gold(operator: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    return operator(gold(spark, sf_dir), SPEC)


# --- features, split, model ----------------------------------------------------------------------------------------


def category_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = encode.category_dictionary(gold(spark, sf_dir), SPEC.categorical, SPEC.missing_category)
    return held.select("column", "value", "idx")


def encode_categoricals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(encode.encode_categoricals(gold(spark, sf_dir), SPEC), *SPEC.indexed)


def encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(encode.encode_label(gold(spark, sf_dir), SPEC), SPEC.severity, SPEC.label)


def decode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = _columns(encode.encode_label(gold(spark, sf_dir), SPEC), SPEC.label)
    return encode.decode_label(encoded, SPEC, SPEC.label, "class_name")


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.impute_medians(_columns(gold(spark, sf_dir), *SPEC.numeric), SPEC.numeric)


def impute_median_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An integer measure whose median may lie between two integers."""
    column = SPEC.numeric[0]
    half = F.when(F.col(SPEC.key) % 5 != 0, F.col(SPEC.key) % 2 * 3).cast("int")
    return encode.impute_medians(gold(spark, sf_dir).select(SPEC.key, half.alias(column)), [column])


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector, one column per position so that the order can be compared."""
    df = gold(spark, sf_dir)
    indexer, stages_after = forest.fit_preparation(df, SPEC)
    df = indexer.transform(df)
    for stage in stages_after:
        df = stage.transform(df)
    vector = df.select(SPEC.key, SPEC.label, vector_to_array("features").alias("v"))
    parts = [F.get("v", F.lit(i)).alias(f"f_{i:02d}") for i in range(len(SPEC.features))]
    return vector.select(SPEC.key, SPEC.label, *parts)


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(_columns(gold(spark, sf_dir), SPEC.severity))


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_counts(stratified_split(spark, sf_dir), SPEC.severity)


def stump(spark: SparkSession, sf_dir: str) -> forest.FittedForest:
    """One tree of one cut over two features, on all rows and features: a forest that SQL can compute as well."""
    item = SPEC.items[0]
    spec = dataclasses.replace(
        SPEC, columns=(item, SPEC.age), items=(), auxiliary=(), categorical=(), trees=1, depth=1, bootstrap=False,
        features_per_node="all",
    )
    rows = gold(spark, sf_dir).select(SPEC.key, SPEC.severity, item, SPEC.age)
    return STORE.once(spark, sf_dir, "stump", lambda: forest.train_forest(rows, spec))


def stump_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stump(spark, sf_dir).predictions()


def stump_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.top_features(forest.importances(stump(spark, sf_dir), spark))


def stump_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = evaluate.confusion_counts(stump_predictions(spark, sf_dir), SPEC.severity, forest.PREDICTED_CLASS)
    return evaluate.confusion_matrix(counts, SPEC.severity_classes)


def feature_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of every model input, from the exact histogram of the training rows."""
    train = fitted(spark, sf_dir).prepared.filter(~F.col(split.IS_TEST))
    held = bins.feature_bins(levelwise.long_features(train, vector_to_array("features")), SPEC.max_bins)
    name = F.element_at(F.array(*map(F.lit, SPEC.features)), F.col("feature") + 1)
    return held.withColumn("feature", name)


def shallow(spark: SparkSession, sf_dir: str) -> forest.FittedForest:
    """Three trees of two levels over four measures, with bags and two features a node: SQL can grow them as well."""
    item = SPEC.items[0]
    columns = (item, SPEC.age, "WeightKg", "SleepHoursWeekdaysOrWorkdays")
    spec = dataclasses.replace(SPEC, columns=columns, items=(), auxiliary=(), categorical=(), trees=3, depth=2, max_bins=16)
    rows = gold(spark, sf_dir).select(SPEC.key, SPEC.severity, *columns)
    return STORE.once(spark, sf_dir, "shallow", lambda: forest.train_forest(rows, spec))


def shallow_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallow(spark, sf_dir).predictions()


def shallow_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tree, node, feature, cut) of every split, nodes numbered from the root 1 with children 2n and 2n + 1."""
    return levelwise.splits_of(shallow(spark, sf_dir).forest)


def rf_confusion_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many test rows of each class the forest's confusion matrix holds."""
    matrix = evaluate.confusion_matrix(_forest_counts(spark, sf_dir), SPEC.severity_classes)
    held = sum((F.col(c) for c in SPEC.severity_classes[1:]), F.col(SPEC.severity_classes[0]))
    return matrix.select("label", held.alias("test_rows"))


def rf_importance_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = forest.importances(fitted(spark, sf_dir), spark)
    listed = forest.top_features(scores).agg(F.count(F.lit(1)).alias("listed"))
    profile = scores.agg(
        F.count(F.lit(1)).alias("features"), F.count_if(F.col("importance") < 0).alias("negative"),
        F.round(F.sum("importance"), 9).alias("total"),
    )
    return profile.withColumn("listed", F.lit(listed.first()[0]))


def rf_metric_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support-weighted recall is accuracy, for any predictor."""
    metrics = rf_metrics(spark, sf_dir)
    return metrics.select((F.round("recall", 12) == F.round("accuracy", 12)).alias("recall_is_accuracy"))


def rf_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(spark, sf_dir).predictions()


def rf_scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows the forest scored, and whether each got one of the classes: the part of it SQL can check."""
    known = F.col(forest.PREDICTED_CLASS).isin(SPEC.severity_classes)
    return _columns(rf_predictions(spark, sf_dir).withColumn("has_class", known), SPEC.severity, "has_class")


def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.top_features(forest.importances(fitted(spark, sf_dir), spark))


def chart_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.top_features(forest.importances(fitted(spark, sf_dir), spark), SPEC)


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the model before saving and after loading, from their raw columns."""
    model, path = fitted(spark, sf_dir).model, scratch_path(spark, "model")
    forest.save_model(model, path)
    df = gold(spark, sf_dir)
    test = _split(df).filter(split.IS_TEST)
    before = model.transform(test).select(*df.columns, F.col(forest.PREDICTED_CLASS).alias("before"))
    after = forest.load_model(path).transform(before)
    return after.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col("before") == F.col(forest.PREDICTED_CLASS)).alias("rows_equal"),
    )


# --- evaluation ----------------------------------------------------------------------------------------------------


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predictor plain SQL can express as well: the class of four times the first two items."""
    guess = ladder(4 * row_sum(SPEC.items[:2]), SPEC.cuts, SPEC.top)
    return gold(spark, sf_dir).select(SPEC.severity, guess.alias("guess"))


def confusion_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predictor with a class of its own: its rows stay in the matrix."""
    return evaluate.confusion_matrix(_strange_counts(spark, sf_dir), SPEC.severity_classes, other="other")


def _strange_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = F.when(F.col(SPEC.items[2]) > 1, F.lit("Altele")).otherwise(
        ladder(4 * row_sum(SPEC.items[:2]), SPEC.cuts, SPEC.top)
    )
    guessed = gold(spark, sf_dir).select(SPEC.severity, extra.alias("guess"))
    return evaluate.confusion_counts(guessed, SPEC.severity, "guess")


def confusion_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts with the classes that occur, none declared."""
    return evaluate.confusion_open(_strange_counts(spark, sf_dir))


def crosstab_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity by age group, with a class that the spec lacks for those without a second item."""
    grouped = score.add_age_group(gold(spark, sf_dir), SPEC)
    strange = F.when(F.col(SPEC.items[1]) == 0, F.lit("Altele")).otherwise(F.col(SPEC.severity))
    return stats.crosstab_open(grouped.withColumn("seen", strange), score.AGE_GROUP, "seen")


def crosstab_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the milder classes per age group; the worst class has no column but stays in the denominator."""
    grouped = score.add_age_group(gold(spark, sf_dir), SPEC)
    return stats.crosstab_percent(grouped, score.AGE_GROUP, SPEC.severity, SPEC.severity_order[:-1])


def _rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_counts(rule_predictions(spark, sf_dir), SPEC.severity, "guess")


def _forest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_counts(fitted(spark, sf_dir).predictions(), SPEC.severity, forest.PREDICTED_CLASS)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of a few doubles differ in the last bit with their order."""
    return df.withColumns({c: F.round(c, METRIC_DIGITS) for c in columns})


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.class_report(_rule_counts(spark, sf_dir)), "precision", "recall", "f1")


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluate.weighted_metrics(_rule_counts(spark, sf_dir))
    return _rounded(metrics, *metrics.columns)


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_rule_counts(spark, sf_dir), SPEC.severity_classes)


def confusion_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_counts(spark, sf_dir)


def rf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.weighted_metrics(_forest_counts(spark, sf_dir))


def chart_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = fitted(spark, sf_dir).predictions()
    return charts.confusion(predicted, SPEC, SPEC.severity, forest.PREDICTED_CLASS)


def chart_confusion_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.confusion(rule_predictions(spark, sf_dir), SPEC, SPEC.severity, "guess")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name."""
    plain = [
        load_survey,
        respondent_key,
        key_violations,
        scan_stage_table,
        write_bronze_roundtrip,
        write_gold_roundtrip,
        stage_tables,
        stored_severity_stats,
        stage_profile,
        select_relevant,
        filter_adults,
        clean_items,
        clean_sedentary,
        row_score,
        scored_only,
        severity_class,
        severity_display,
        severity_ordinal,
        age_group,
        feature_labels,
        feature_projection,
        null_columns,
        fill_unknown,
        validate_sedentary,
        expect_rules,
        label_distribution,
        column_medians,
        box_outliers,
        box_outliers_nan,
        top_items_by_mean,
        category_dictionary,
        encode_categoricals,
        encode_label,
        decode_label,
        impute_median,
        impute_median_int,
        assemble_features,
        stratified_split,
        split_counts,
        confusion_cells,
        confusion_matrix,
        confusion_other,
        crosstab_other,
        crosstab_open,
        confusion_open,
        class_report,
        eval_metrics,
        chart_confusion_rule,
        feature_bins,
        shallow_predictions,
        shallow_cuts,
        stump_predictions,
        stump_importances,
        stump_confusion,
        rf_confusion_margins,
        rf_importance_profile,
        rf_metric_identity,
        rf_predictions,
        rf_scored_rows,
        rf_metrics,
        top_features,
        chart_top_features,
        chart_confusion,
        model_roundtrip,
    ]
    on_gold = {
        "severity_distribution": stats.severity_distribution,
        "biomarkers_by_severity": stats.biomarkers_by_severity,
        "behaviour_by_severity": stats.behaviour_by_severity,
        "chart_distribution": charts.distribution,
        "chart_biomarkers": charts.biomarkers,
        "chart_age_severity": charts.age_severity,
        "chart_box_sedentary": partial(charts.severity_box, measure="MinutesSedentaryActivity"),
        "chart_box_sleep": partial(charts.severity_box, measure="SleepHoursWeekdaysOrWorkdays"),
        "chart_box_score": partial(charts.age_box, measure=SPEC.score),
    }
    return {
        "normalize_missing": normalized,
        **{query.__name__: query for query in plain},
        **{name: partial(_on_gold, operator) for name, operator in on_gold.items()},
    }
