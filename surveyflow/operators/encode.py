"""Category dictionaries, index encoding, median imputation and the feature vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Imputer, ImputerModel, IndexToString, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyflow.functions import fill_category
from surveyflow.operators.quantiles import column_medians
from surveyflow.operators.ranges import running_totals
from surveyflow.sources.scratch import materialize
from surveyflow.spec import SurveySpec


#: Values of a column that are looked up where the rows are; rarer ones of larger dictionaries take an exchange.
SETTLED = 1 << 14


def category_dictionary(df: DataFrame, columns: Sequence[str], missing: str) -> DataFrame:
    """(column, value, idx, n): distinct values in code-point order, numbered from 0 per column, and their rows; stored.

    All columns in one pass. Only distinct values are shuffled, into ranges of (column, value) that are numbered each by
    itself, so a column may have any number of values.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, idx int, n long")
    filled = df.select(*[fill_category(c, missing).alias(c) for c in columns])
    values = filled.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(values, [F.col("value")], {"place": F.lit(1)}, "categories", by=["column"])
    return materialize(placed.select("column", "value", (F.col("run_place") - 1).cast("int").alias("idx"), "n"), "dictionary")


@dataclass(frozen=True)
class CategoryIndexer:
    """Adds ``<column><suffix>``, the index of each category, whatever the size of its dictionary.

    The most frequent values of every column, a fixed number, are looked up in place: that settles all columns of small
    dictionaries, and the hot values (such as that for missing) of large ones. What rows still lack then goes by (column,
    value) to the dictionary in one exchange for all columns, comes back folded to one record a row, and meets the rows in
    the only exchange they take. ``invalid="keep"`` gives values that the dictionary lacks an index of their own, the number
    of known ones; otherwise they fail the job.
    """

    columns: tuple[str, ...]
    dictionary: DataFrame
    sizes: dict[str, int]
    settled: dict[str, list[tuple[str, int]]]
    missing: str
    suffix: str
    invalid: str = "error"

    @classmethod
    def over(
        cls, dictionary: DataFrame, columns: Sequence[str], missing: str, suffix: str, invalid: str = "error", held: int | None = None
    ) -> CategoryIndexer:
        held = SETTLED if held is None else held
        sizes = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        small = [c for c in columns if sizes.get(c, 0) <= held]
        settled: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
        wanted = [dictionary.filter(F.col("column").isin(small))] if small else []
        wanted += [
            dictionary.filter(F.col("column") == c).orderBy(F.desc("n"), "value").limit(held) for c in columns if c not in small
        ]
        for part in wanted:  # at most ``held`` values a column
            for r in part.select("column", "value", "idx").collect():
                settled[r["column"]].append((r["value"], r["idx"]))
        return cls(tuple(columns), dictionary, sizes, {c: sorted(v, key=lambda x: x[1]) for c, v in settled.items()}, missing, suffix, invalid)

    @classmethod
    def of(cls, dictionary: DataFrame, spec: SurveySpec, invalid: str = "error") -> CategoryIndexer:
        return cls.over(dictionary, spec.categorical, spec.missing_category, spec.index_suffix, invalid)

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.columns:
            return df
        kept = df.columns
        filled = df.withColumns({f"__v_{c}": fill_category(c, self.missing) for c in self.columns})
        small = [c for c in self.columns if 0 < self.sizes.get(c, 0) <= len(self.settled[c])]
        large = [c for c in self.columns if c not in small]
        if small:
            labels = [[value for value, _ in self.settled[c]] for c in small]
            filled = StringIndexerModel.from_arrays_of_labels(
                labels, inputCols=[f"__v_{c}" for c in small], outputCols=[f"__{c}" for c in small], handleInvalid="keep"
            ).transform(filled)
            known = {c: F.col(f"__{c}") < len(held) for c, held in zip(small, labels)}
            filled = filled.withColumns({f"__{c}": F.when(inside, F.col(f"__{c}")) for c, inside in known.items()})
        if large:
            filled = self._looked_up(filled, large)
        return filled.select(*kept, *[self._index(c) for c in self.columns])

    def _looked_up(self, filled: DataFrame, large: list[str]) -> DataFrame:
        """``__<column>`` for columns whose dictionary is larger than what is settled; null for unknown values."""
        spark = filled.sparkSession
        for c in large:
            hot = spark.createDataFrame(self.settled[c], "value string, idx int") if self.settled[c] else self.dictionary.limit(0)
            ranks = hot.select(F.col("value").alias("__value"), F.col("idx").cast("double").alias(f"__{c}"))
            filled = filled.join(F.broadcast(ranks), F.col(f"__v_{c}") == F.col("__value"), "left").drop("__value")
        rows = materialize(filled.withColumn("__row", F.monotonically_increasing_id()), "encode-rows")
        open_values = [
            F.when(F.col(f"__{c}").isNull(), F.struct(F.lit(c).alias("column"), F.col(f"__v_{c}").alias("value"))) for c in large
        ]
        pairs = rows.select("__row", F.explode(F.array_compact(F.array(*open_values))).alias("p")).select("__row", "p.*")
        known = self.dictionary.filter(F.col("column").isin(large)).select("column", "value", "idx")
        coded = pairs.join(known, ["column", "value"])
        folded = coded.groupBy("__row").agg(
            *[F.max(F.when(F.col("column") == c, F.col("idx"))).cast("double").alias(f"__late_{c}") for c in large]
        )
        late = {f"__{c}": F.coalesce(f"__{c}", f"__late_{c}") for c in large}
        return rows.join(folded, "__row", "left").withColumns(late)

    def _index(self, c: str) -> Column:
        size = self.sizes.get(c, 0)
        unseen = F.raise_error(F.concat(F.lit(f"unseen value of {c}: "), F.col(c).cast("string"))).cast("double")
        other = unseen if self.invalid == "error" else F.lit(float(size))
        values = size + (self.invalid != "error")
        return F.coalesce(F.col(f"__{c}"), other).alias(
            c + self.suffix, metadata={"ml_attr": {"type": "nominal", "num_vals": values}}
        )


def encode_categoricals(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Replace each categorical by ``<column>_Idx``, its rank among the column's sorted values."""
    dictionary = category_dictionary(df, list(spec.categorical), spec.missing_category)
    encoded = CategoryIndexer.of(dictionary, spec).transform(df)
    return encoded.select(*[c for c in encoded.columns if c not in spec.categorical])


def label_indexer(spec: SurveySpec) -> StringIndexerModel:
    """Class name to index in code-point order. The classes are declared, so there is nothing to fit."""
    return StringIndexerModel.from_labels(
        spec.severity_classes, inputCol=spec.severity, outputCol=spec.label, handleInvalid="error"
    )


def encode_label(df: DataFrame, spec: SurveySpec) -> DataFrame:
    return label_indexer(spec).transform(df)


def decode_label(df: DataFrame, spec: SurveySpec, index: str, output: str) -> DataFrame:
    return IndexToString(inputCol=index, outputCol=output, labels=spec.severity_classes).transform(df)


def feature_projection(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """What is left when target, score, items, auxiliaries and key are excluded."""
    return df.select(*[c for c in df.columns if c not in spec.excluded])


def exact_medians(df: DataFrame, columns: Sequence[str], approx: bool = False) -> dict[str, float]:
    """One number per column; a column without values cannot be imputed and is an error."""
    medians = {r["measure"]: r["median"] for r in column_medians(df, columns, approx).collect()}
    empty = [c for c in columns if c not in medians]
    if empty:
        raise ValueError(f"no values to impute from in {empty}")
    return medians


def impute_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN to the median of the column; the columns become doubles, as a median may lie between two integers."""
    doubles = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return doubles.fillna(exact_medians(df, columns))


def as_doubles(columns: Sequence[str]) -> SQLTransformer:
    """The same cast as a stage: without it the imputer would cast its medians to the type of the column."""
    cast = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in columns)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in columns)}), {cast} FROM __THIS__")


def median_imputer(df: DataFrame, columns: Sequence[str], approx: bool = False) -> ImputerModel:
    """The same as a stage that can be saved.

    The library's own median strategy is approximate; fitted on the one-row frame of exact medians, its mean strategy
    stores precisely those.
    """
    medians = exact_medians(df, columns, approx)
    one_row = df.sparkSession.createDataFrame(
        [tuple(medians[c] for c in columns)], T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    )
    return Imputer(strategy="mean", inputCols=list(columns), outputCols=list(columns)).fit(one_row)


def assembler(spec: SurveySpec) -> VectorAssembler:
    return VectorAssembler(inputCols=spec.features, outputCol="features", handleInvalid="error")
