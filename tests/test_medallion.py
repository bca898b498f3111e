"""The end-to-end run and its observed counts."""

from __future__ import annotations

import dataclasses
import uuid

import pytest
from pyspark.sql import functions as F

from surveyflow.operators import forest
from surveyflow.plans import medallion
from surveyflow.plans import queries as Q
from surveyflow.sources.tables import expire_versions, read_table, write_table


@pytest.fixture
def database():
    return f"run_{uuid.uuid4().hex[:8]}"


def test_tables_statistics_and_model(spark, spec, small_dir, database, tmp_path):
    quick = dataclasses.replace(spec, trees=5, depth=4)
    run = medallion.run_tables(spark, Q.bronze(spark, small_dir), database, quick)
    assert run.rows == {"bronze": 1500, "eligible": 1372, "silver": 984, "gold": 984}
    assert run.columns == {"bronze": 42, "eligible": 38, "silver": 39, "gold": 40}
    sedentary = run.ranges["MinutesSedentaryActivity"]
    assert sedentary["max"] <= 1440 and sedentary["nulls"] > 0

    gold = read_table(spark, run.table("gold"))
    assert gold.columns == [spec.key, *spec.columns, spec.score, spec.severity]
    stored = read_table(spark, run.stats_table).agg(F.sum("Total_Pacienti")).first()[0]
    assert stored == gold.count() == 984

    run = medallion.run_model(spark, run, str(tmp_path / "model"), quick)
    assert set(run.metrics) == {"accuracy", "f1", "precision", "recall"} and 0 < run.metrics["accuracy"] < 1
    assert forest.load_model(str(tmp_path / "model")).transform(gold).count() == 984


def test_second_run_replaces_the_tables(spark, spec, small_dir, database):
    raw = Q.bronze(spark, small_dir)
    medallion.run_tables(spark, raw, database, spec)
    run = medallion.run_tables(spark, raw.filter(F.col(spec.key) % 2 == 0), database, spec)
    assert read_table(spark, run.table("bronze")).count() == run.rows["bronze"] < 1500


def test_replaced_schema(spark, database):
    spark.sql(f"CREATE DATABASE {database}")
    write_table(spark.range(3), f"{database}.t", replace_schema=True)
    write_table(spark.range(2).select(F.lit("x").alias("other")), f"{database}.t", replace_schema=True)
    assert read_table(spark, f"{database}.t").columns == ["other"]


def test_other_columns_never_leave_the_table_missing(spark, database):
    """A run that stopped between the two renames is put right by the next that reads or writes."""
    spark.sql(f"CREATE DATABASE {database}")
    write_table(spark.range(3), f"{database}.t")
    spark.sql(f"ALTER TABLE {database}.t RENAME TO {database}.t__before")
    assert read_table(spark, f"{database}.t").count() == 3


@pytest.mark.parametrize("columns", [["id"], ["id", "id AS more"]])
def test_a_failed_write_leaves_the_table_as_it_was(spark, database, columns):
    spark.sql(f"CREATE DATABASE {database}")
    write_table(spark.range(10), f"{database}.t", replace_schema=True)
    held = spark.table(f"{database}.t")
    rows = spark.range(0, 1000, 1, 4).selectExpr(*columns)
    fails = rows.filter(F.when(F.col("id") == 999, F.raise_error(F.lit("half-way")).cast("boolean")).otherwise(F.lit(True)))
    with pytest.raises(Exception, match="half-way"):
        write_table(fails, f"{database}.t", replace_schema=True)
    assert read_table(spark, f"{database}.t").count() == 10 and held.count() == 10
    write_table(rows, f"{database}.t", replace_schema=True)
    assert read_table(spark, f"{database}.t").count() == 1000
    assert held.count() == 10, "the version before stays readable"
    assert len(spark.catalog.listTables(database)) == 1


def test_old_versions_go_when_told(spark, database):
    spark.sql(f"CREATE DATABASE {database}")
    for n in range(1, 6):
        write_table(spark.range(n), f"{database}.t")
    assert expire_versions(spark, f"{database}.t", keep=1) == 3
    assert expire_versions(spark, f"{database}.t", keep=1) == 0
    assert read_table(spark, f"{database}.t").count() == 5


@pytest.mark.parametrize("broken", ["null", "repeated"])
def test_an_unsound_key_makes_no_table(spark, spec, small_dir, database, broken):
    raw = Q.bronze(spark, small_dir)
    key = F.col(spec.key)
    worse = F.when(key % 100 == 0, None).otherwise(key) if broken == "null" else F.when(key % 100 == 0, 7).otherwise(key)
    with pytest.raises(ValueError, match=f"{broken} keys"):
        medallion.run_tables(spark, raw.withColumn(spec.key, worse.cast("long")), database, spec)
    assert spark.catalog.listTables(database) == []
    medallion.run_tables(spark, raw, database, spec)
    before = {t.name: read_table(spark, f"{database}.{t.name}").count() for t in spark.catalog.listTables(database)}
    with pytest.raises(ValueError, match="is no key"):
        medallion.run_tables(spark, raw.union(raw.limit(1)), database, spec)
    assert {t.name: read_table(spark, f"{database}.{t.name}").count() for t in spark.catalog.listTables(database)} == before
