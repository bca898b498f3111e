"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of local cores. Every query is run once on a small data
directory first, so that class loading and code generation are not charged to the timed run, which
then builds, plans and fully executes each query once, over the whole tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from surveyflow.plans import queries as Q  # noqa: E402
from surveyflow.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")

# The model is trained once, timed by its own name; the queries about it share it.
HEADLINE = (
    "severity_distribution",
    "biomarkers_by_severity",
    "behaviour_by_severity",
    "stage_profile",
    "validate_sedentary",
    "load_survey",
    "write_bronze_roundtrip",
    "write_gold_roundtrip",
    "chart_distribution",
    "chart_biomarkers",
    "chart_age_severity",
    "chart_box_sedentary",
    "chart_box_score",
    "box_outliers",
    "column_medians",
    "category_dictionary",
    "encode_categoricals",
    "impute_median",
    "assemble_features",
    "stratified_split",
    "split_counts",
    "confusion_matrix",
    "eval_metrics",
    "rf_predictions",
    "rf_metrics",
    "top_features",
    "model_roundtrip",
)


def consume(df) -> None:
    """Run the whole query without shipping its rows to Python."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="surveyflow-bench-")
    spark = build_session(
        "surveyflow-bench",
        spark__master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
        spark__checkpoint__dir=f"{scratch}/checkpoints",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = Q.registered()

    for name in HEADLINE:
        consume(queries[name](spark, WARM_DIR))

    seconds = {}
    start = time.perf_counter()
    Q.bronze(spark, SF_DIR)
    seconds["ingest_bronze"] = time.perf_counter() - start
    start = time.perf_counter()
    Q.fitted(spark, SF_DIR)
    seconds["train_forest"] = time.perf_counter() - start
    for name in HEADLINE:
        start = time.perf_counter()
        consume(queries[name](spark, SF_DIR))
        seconds[name] = time.perf_counter() - start
    rows = Q.bronze(spark, SF_DIR).count()
    spark.stop()

    total = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline survey queries",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
