from __future__ import annotations

import pytest

from surveyflow.plans import queries as Q
from surveyflow.plans import stages
from surveyflow.sources import scratch
from surveyflow.plans import queries as Q
from surveyflow.sources.tables import ensure_database, write_table
from surveyflow.sources.readers import read_survey_parquet, read_survey_tsv, survey_schema, write_survey_tsv


@pytest.fixture
def cycle(spark, spec, small_dir, tmp_path):
    write_survey_tsv(Q.select_relevant(spark, small_dir).limit(20).coalesce(1), str(tmp_path), "2017-2018")
    return tmp_path


def test_round_trip_keeps_types_and_nulls(spark, spec, small_dir, tmp_path):
    written = Q.select_relevant(spark, small_dir)
    write_survey_tsv(written, str(tmp_path), "2017-2018")
    back = read_survey_tsv(spark, str(tmp_path), "2017-2018", survey_schema(spec))
    assert back.dtypes == written.dtypes
    assert back.exceptAll(written).count() == 0 and written.exceptAll(back).count() == 0


def test_malformed_value_fails(spark, spec, cycle):
    (part,) = (cycle / "2017-2018").glob("part-*.csv")
    header, first, *_ = part.read_text().splitlines()
    bad = cycle / "bad"
    bad.mkdir()
    cells = first.split("\t")
    cells[1] = "many"
    (bad / "data.tsv").write_text("\n".join([header, "\t".join(cells)]) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_survey_tsv(spark, str(cycle), "bad", survey_schema(spec)).collect()


def test_missing_column_fails(spark, spec, cycle):
    bad = cycle / "renamed"
    bad.mkdir()
    names = [spec.key, *spec.columns]
    names[1] = "SomethingElse"
    (bad / "data.tsv").write_text("\t".join(names) + "\n" + "\t".join(["1", *["0"] * 37]) + "\n")
    with pytest.raises(ValueError, match=spec.columns[0]):
        read_survey_tsv(spark, str(cycle), "renamed", survey_schema(spec))


def test_wide_file_in_any_column_order(spark, spec, tmp_path):
    wide = tmp_path / "wide"
    wide.mkdir()
    names = ["extra1", *reversed(spec.columns), spec.key, "extra2"]
    (wide / "data.tsv").write_text("\t".join(names) + "\n" + "\t".join(["x", *["1"] * 37, "9", ""]) + "\n")
    df = read_survey_tsv(spark, str(tmp_path), "wide", survey_schema(spec))
    assert df.columns == names
    row = df.first()
    assert (row[spec.key], row[spec.items[0]], row["Gender"], row["extra1"], row["extra2"]) == (9, 1.0, "1", "x", None)


def test_parquet_cycle_is_cast(spark, spec, small_dir, tmp_path):
    raw = Q.select_relevant(spark, small_dir).limit(10)
    raw.withColumn(spec.items[0], raw[spec.items[0]].cast("int")).write.parquet(str(tmp_path / "2017-2018"))
    back = read_survey_parquet(spark, str(tmp_path), "2017-2018", survey_schema(spec))
    assert back.dtypes == raw.dtypes and back.count() == 10


def test_survey_without_a_key_is_refused(spark, spec):
    with pytest.raises(ValueError, match="no key"):
        stages.bronze(spark.range(3), spec)


def test_schema_is_kept_unless_replaced(spark):
    ensure_database(spark, "kept_schema")
    try:
        write_table(spark.range(3), "kept_schema.t")
        write_table(spark.range(5), "kept_schema.t")
        with pytest.raises(ValueError, match="schema"):
            write_table(spark.range(3).selectExpr("CAST(id AS STRING) AS id"), "kept_schema.t")
        write_table(spark.range(4).selectExpr("CAST(id AS STRING) AS id"), "kept_schema.t", replace_schema=True)
        assert spark.table("kept_schema.t").dtypes == [("id", "string")]
    finally:
        spark.sql("DROP DATABASE kept_schema CASCADE")


def test_changed_files_are_read_anew(spark, small_dir, tmp_path):
    orders = spark.read.parquet(f"{small_dir}/orders.parquet")
    orders.limit(100).write.parquet(str(tmp_path / "orders.parquet"))
    assert Q.bronze(spark, str(tmp_path)).count() == 100
    orders.limit(50).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert Q.bronze(spark, str(tmp_path)).count() == 150


def test_no_database_is_left_over(spark, small_dir):
    before = {d.name for d in spark.catalog.listDatabases()}
    for name in ("scan_stage_table", "write_bronze_roundtrip", "write_gold_roundtrip", "stage_tables", "stored_severity_stats"):
        assert Q.registered()[name](spark, small_dir).count() > 0
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_scratch_follows_the_session(spark):
    assert scratch.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


class _Session:
    def __init__(self, **conf):
        self.conf = conf


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(_Session(**{"spark.master": "yarn"}))
    assert scratch.scratch_root(_Session(**{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
