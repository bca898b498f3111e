"""The end-to-end run: raw survey to stage tables, persisted statistics and a saved model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyflow.operators.clean import drop_unscored
from surveyflow.operators.evaluate import confusion_counts, weighted_metrics
from surveyflow.operators.forest import PREDICTED_CLASS, FittedForest, save_model, train_forest
from surveyflow.operators.quality import require_sound_key
from surveyflow.operators.score import add_score
from surveyflow.operators.stats import severity_stats
from surveyflow.plans import stages
from surveyflow.sources.tables import ensure_database, read_table, write_table
from surveyflow.spec import SurveySpec


@dataclass
class MedallionRun:
    """Names of the tables written, and what was counted while writing them."""

    database: str
    rows: dict[str, int] = field(default_factory=dict)
    columns: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, dict[str, float]] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)
    fitted: FittedForest | None = None

    def table(self, stage: str) -> str:
        return f"{self.database}.{stage}_survey"

    @property
    def stats_table(self) -> str:
        return f"{self.database}.gold_severity_stats"


def _rows(observation: Observation, df: DataFrame, *more) -> DataFrame:
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *more)


def run_tables(
    spark: SparkSession, raw: DataFrame, database: str, spec: SurveySpec, fmt: str = "parquet"
) -> MedallionRun:
    """Write bronze, silver, gold and the gold statistics.

    Row counts and the range check of the cleaned columns are metrics of the writes themselves, so no stage is scanned
    again to be counted. Each stage reads the table the one before it wrote. The key is proven on the stored bronze rows
    before they become a table: with null or repeated keys no table is made or changed.
    """
    run = MedallionRun(database)
    ensure_database(spark, database)

    counted = Observation("bronze")
    bronze = _rows(counted, stages.bronze(raw, spec))
    write_table(bronze, run.table("bronze"), fmt, audit=require_sound_key(spec.key))
    run.rows["bronze"], run.columns["bronze"] = counted.get["rows"], len(bronze.columns)

    adults, scored = Observation("eligible"), Observation("silver")
    checks = [
        check
        for c in spec.bounds
        for check in (
            F.min(c).alias(f"{c}:min"),
            F.max(c).alias(f"{c}:max"),
            F.count_if(F.col(c).isNull()).alias(f"{c}:nulls"),
        )
    ]
    eligible = _rows(adults, stages.eligible(read_table(spark, run.table("bronze")), spec), *checks)
    silver = _rows(scored, drop_unscored(add_score(eligible, spec), spec))
    write_table(silver, run.table("silver"), fmt, replace_schema=True)
    found = adults.get
    run.rows["eligible"], run.rows["silver"] = found["rows"], scored.get["rows"]
    run.columns["eligible"], run.columns["silver"] = len(eligible.columns), len(silver.columns)
    run.ranges = {c: {k: found[f"{c}:{k}"] for k in ("min", "max", "nulls")} for c in spec.bounds}

    classified = Observation("gold")
    gold = _rows(classified, stages.gold(read_table(spark, run.table("silver")), spec))
    write_table(gold, run.table("gold"), fmt, replace_schema=True)
    run.rows["gold"], run.columns["gold"] = classified.get["rows"], len(gold.columns)

    stats = severity_stats(read_table(spark, run.table("gold")), spec)
    write_table(stats.coalesce(1), run.stats_table, fmt, replace_schema=True)  # one row per class
    return run


def run_model(spark: SparkSession, run: MedallionRun, model_path: str, spec: SurveySpec, **options) -> MedallionRun:
    """Train on the gold table, evaluate on the held-out rows, save everything as one artefact."""
    run.fitted = train_forest(read_table(spark, run.table("gold")), spec, **options)
    counts = confusion_counts(run.fitted.predictions(), spec.severity, PREDICTED_CLASS)
    run.metrics = weighted_metrics(counts).first().asDict()
    save_model(run.fitted.model, model_path)
    return run
