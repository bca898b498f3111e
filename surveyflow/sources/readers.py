"""Loading raw surveys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from surveyflow.functions import nan_to_null
from surveyflow.spec import SurveySpec


def survey_schema(spec: SurveySpec, key_type: T.DataType | None = None) -> T.StructType:
    """Declared schema of a raw survey: key, doubles for items and measures, strings for the rest."""
    text = {*spec.categorical, *spec.auxiliary}
    fields = [T.StructField(spec.key, key_type or T.LongType(), False)]
    fields += [T.StructField(c, T.StringType() if c in text else T.DoubleType()) for c in spec.columns]
    return T.StructType(fields)


def wide_schema(header: list[str], declared: T.StructType) -> T.StructType:
    """Schema of a file with these columns: declared ones as declared, further ones kept as strings."""
    absent = [name for name in declared.names if name not in header]
    if absent:
        raise ValueError(f"the survey lacks {absent}")
    types = {f.name: f for f in declared.fields}
    return T.StructType([types.get(name, T.StructField(name, T.StringType())) for name in header])


def read_survey_tsv(spark: SparkSession, root: str, cycle: str, declared: T.StructType) -> DataFrame:
    """One survey cycle from tab-separated files below ``root/cycle``, with all its columns.

    Only the header line is read ahead; nothing is inferred from the data. Every file's header is checked against
    the first, a malformed value fails the job instead of turning into a null, and an empty field is a missing value.
    Columns a query does not use are not parsed.
    """
    path = f"{root}/{cycle}"
    reader = spark.read.option("sep", "\t").option("header", True)
    schema = wide_schema(reader.csv(path).columns, declared)
    return (
        reader.schema(schema)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_survey_parquet(spark: SparkSession, root: str, cycle: str, declared: T.StructType) -> DataFrame:
    """The same from Parquet, which brings its own types; declared columns are cast where they differ."""
    raw = spark.read.parquet(f"{root}/{cycle}")
    wide_schema(raw.columns, declared)
    wanted = {f.name: f.dataType for f in declared.fields}
    differing = [c for c, t in wanted.items() if raw.schema[c].dataType != t]
    return raw.withColumns({c: raw[c].cast(wanted[c]) for c in differing}) if differing else raw


def write_survey_tsv(df: DataFrame, root: str, cycle: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "").csv(f"{root}/{cycle}")


def require_key(df: DataFrame, key: str) -> DataFrame:
    """A survey without a respondent key is refused: row numbers would change with every read."""
    if key not in df.columns:
        raise ValueError(f"the survey has no key column {key!r}")
    return df


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN to null in every floating-point column, once, at ingest."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c).cast(df.schema[c].dataType) for c in floating}) if floating else df
