"""Random-forest severity model: preparation, fit, prediction, importances, persistence."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.operators.encode import (
    CategoryIndexer,
    as_doubles,
    assembler,
    category_dictionary,
    label_indexer,
    median_imputer,
)
from surveyflow.operators.levelwise import ForestRule, fit_levelwise
from surveyflow.operators.split import IS_TEST, stratified_split
from surveyflow.sources import files
from surveyflow.sources.scratch import materialize
from surveyflow.spec import SurveySpec

PREDICTED_CLASS = "predicted_class"


def fit_preparation(
    df: DataFrame, spec: SurveySpec, approx_medians: bool = False, invalid: str = "error"
) -> tuple[CategoryIndexer, list[Transformer]]:
    """From a classified row to its label and feature vector: the category indexer and fitted stages after it.

    What is fitted is the category dictionary, a table, and the medians, one number per column.
    """
    dictionary = category_dictionary(df, list(spec.categorical), spec.missing_category)
    stages = [
        label_indexer(spec), as_doubles(spec.numeric), median_imputer(df, spec.numeric, approx_medians), assembler(spec)
    ]
    return CategoryIndexer.of(dictionary, spec, invalid), stages


@dataclass(frozen=True)
class SeverityModel:
    """Everything from raw columns to a predicted class: the dictionary as a table, the rest as a pipeline."""

    indexer: CategoryIndexer
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.indexer.transform(df))


def forest_rule(spec: SurveySpec) -> ForestRule:
    """The parameters of the survey's forest; a single tree may split on all features, as the library's does."""
    features = len(spec.features)
    strategy = ("all" if spec.trees == 1 else "sqrt") if spec.features_per_node == "auto" else spec.features_per_node
    if strategy not in ("all", "sqrt"):
        raise ValueError(f"features per node: {strategy}")
    chosen = features if strategy == "all" else math.ceil(math.sqrt(features))
    return ForestRule(
        spec.trees, spec.depth, spec.max_bins, len(spec.severity_classes), chosen, spec.bootstrap, spec.seed
    )


def fit_forest(train: DataFrame, spec: SurveySpec, categorical: str = "ordinal", method: str | None = None, **options) -> RandomForestClassificationModel:
    """Fit on (key, label, features).

    ``method="levelwise"`` draws bags and features by hashes and takes cut points from all rows: the same rows give the
    same forest however they lie, without moving them. ``"library"`` is the library's own fit (see `fit_library`).
    ``categorical="ordinal"`` treats an encoded category as a number; ``"nominal"`` lets the trees split on sets of
    categories, which only the library does.
    """
    method = method or ("library" if categorical == "nominal" else "levelwise")
    if method == "library":
        return fit_library(train, spec, categorical, **options)
    if method != "levelwise" or categorical != "ordinal":
        raise ValueError(f"no {method} fit on {categorical} categories")
    rows = train.select(spec.key, spec.label, vector_to_array("features").alias("features"))
    return fit_levelwise(rows, spec.key, spec.label, "features", forest_rule(spec), labelCol=spec.label, featuresCol="features")


def fit_library(
    train: DataFrame, spec: SurveySpec, categorical: str = "ordinal", partitions: int | None = None, place_rows: bool = True
) -> RandomForestClassificationModel:
    """The library's fit. It looks for cut points among a bounded sample of rows and draws bags per partition, so the rows
    are placed by key and sorted; ``place_rows=False`` spares that shuffle, and the forest depends on how the table is split.
    """
    features = F.col("features")
    if categorical == "ordinal":
        features = features.alias("features", metadata={})
    placed = train.select(spec.key, spec.label, features)
    if place_rows:
        n = partitions or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = placed.repartition(n, spec.key).sortWithinPartitions(spec.key)
    placed = placed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return RandomForestClassifier(
            labelCol=spec.label,
            featuresCol="features",
            numTrees=spec.trees,
            maxDepth=spec.depth,
            maxBins=spec.max_bins,
            impurity="gini",
            featureSubsetStrategy=spec.features_per_node,
            bootstrap=spec.bootstrap,
            seed=spec.seed,
        ).fit(placed)
    finally:
        placed.unpersist()


@dataclass(frozen=True)
class FittedForest:
    """The whole model as one artefact, and the prepared rows it was fitted and is tested on."""

    spec: SurveySpec
    model: SeverityModel
    prepared: DataFrame

    @property
    def forest(self) -> RandomForestClassificationModel:
        return self.model.pipeline.stages[-2]

    def predictions(self) -> DataFrame:
        """(key, class, predicted class) of the test rows."""
        test = self.prepared.filter(F.col(IS_TEST))
        scored = PipelineModel(self.model.pipeline.stages[-2:]).transform(test)
        return scored.select(self.spec.key, self.spec.severity, PREDICTED_CLASS)


def train_forest(
    df: DataFrame,
    spec: SurveySpec,
    categorical: str = "ordinal",
    fit_on: str = "all",
    approx_medians: bool = False,
    method: str | None = None,
    **options,
) -> FittedForest:
    """Split, prepare, fit.

    ``fit_on="all"`` learns dictionaries and medians from all rows, ``"train"`` from the training rows only (values
    first seen in a test row then get an index of their own). The prepared rows are written once, because fitting
    reads them many times.
    """
    split = stratified_split(df, spec.key, spec.severity, spec.test_size, spec.seed, closed=spec.severity_classes)
    if fit_on == "train":
        split = materialize(split, "split")
        indexer, stages = fit_preparation(split.filter(~F.col(IS_TEST)), spec, approx_medians, invalid="keep")
    else:
        indexer, stages = fit_preparation(df, spec, approx_medians)
    prepared = PipelineModel(stages).transform(indexer.transform(split))
    prepared = materialize(prepared.select(spec.key, spec.severity, spec.label, "features", IS_TEST), "features")
    forest = fit_forest(prepared.filter(~F.col(IS_TEST)), spec, categorical, method, **options)
    decode = IndexToString(inputCol="prediction", outputCol=PREDICTED_CLASS, labels=spec.severity_classes)
    return FittedForest(spec, SeverityModel(indexer, PipelineModel([*stages, forest, decode])), prepared)


def importances(fitted: FittedForest, spark: SparkSession) -> DataFrame:
    """(feature, importance), one row per model input; the importances sum to 1."""
    pairs = zip(fitted.spec.features, fitted.forest.featureImportances.toArray().tolist())
    return spark.createDataFrame(list(pairs), "feature string, importance double")


def top_features(scores: DataFrame, k: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("importance"), "feature").limit(k)


#: Rows of a file of the dictionary, so that a digest reads no file of unbounded size.
DICTIONARY_ROWS = 5_000_000


def _digests(spark: SparkSession, path: str) -> list[list]:
    """[name, length, sha256] of every file of a stored model, by name."""
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = path.rstrip("/").rsplit("/", 1)[-1]
    name = F.substring_index("path", f"/{root}/", -1)
    rows = stored.select(name.alias("name"), "length", F.sha2("content", 256).alias("digest")).collect()
    return sorted([r["name"], r["length"], r["digest"]] for r in rows)


def save_model(model: SeverityModel, path: str) -> None:
    """A new version below ``path``: the dictionary as Parquet, its settings as a line of text, and the pipeline.

    The manifest, with the digests of all files, is written last and at once. Until it is there the version doesn't exist
    for `load_model`, and earlier versions are never touched.
    """
    indexer = model.indexer
    spark = indexer.dictionary.sparkSession
    version = f"{path}/versions/{uuid.uuid4().hex}"
    settings = {k: getattr(indexer, k) for k in ("columns", "missing", "suffix", "invalid")}
    indexer.dictionary.write.option("maxRecordsPerFile", DICTIONARY_ROWS).parquet(f"{version}/dictionary")
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.text(f"{version}/settings")
    model.pipeline.write().save(f"{version}/pipeline")
    manifest = {"version": version.rsplit("/", 1)[-1], "files": _digests(spark, version)}
    known = [int(name.split(".")[0]) for name in _manifests(spark, path)]
    files.write_once(spark, f"{path}/manifests/{max(known, default=0) + 1:012d}.json", json.dumps(manifest))


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return [name for name in files.names(spark, f"{path}/manifests") if name.endswith(".json")]


def load_model(path: str) -> SeverityModel:
    """The model saved last; a version that isn't what its manifest says is refused."""
    spark = SparkSession.active()
    manifests = _manifests(spark, path)
    if not manifests:
        raise ValueError(f"no whole model at {path}")
    manifest = json.loads(files.read_text(spark, f"{path}/manifests/{manifests[-1]}"))
    version = f"{path}/versions/{manifest['version']}"
    if _digests(spark, version) != manifest["files"]:
        raise ValueError(f"the model at {version} isn't the one that was saved")
    settings = json.loads(spark.read.text(f"{version}/settings").first()[0])
    indexer = CategoryIndexer.over(spark.read.parquet(f"{version}/dictionary"), **settings)
    return SeverityModel(indexer, PipelineModel.load(f"{version}/pipeline"))
