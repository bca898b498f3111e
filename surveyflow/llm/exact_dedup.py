"""Exact dedup by a heavy-hitter split.

A Misra-Gries summary of the digests (Spark's mergeable frequent-items sketch) names the digests that may be frequent.
Their groups are counted exactly and broadcast, at most ``heavy`` rows whatever the input, so rows of frequent texts are
settled where they are read. All other digests are infrequent and take one ordinary shuffle, of digests and ids only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyflow.llm.common import document_key, lower_ascii, materialize, narrow, one_each, table, whole


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, heavy: int = 1024, tracked: int = 8192
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; of equal texts the largest doc_id stays.

    Texts are equal if they are the same after lower-casing A-Z. A null text is an empty one. A null doc_id is smaller
    than any other and stays only if all of its group are null. Rows that repeat both id and text are one document
    delivered more than once: each counts in group_size and they share ``kept``. No rows in, no rows out. Further
    columns of the input are not returned.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    digests = materialize(
        rows.select("doc_id", F.sha2(lower_ascii(whole("text")), 256).alias("text_sha256")), "exact-digests"
    )

    frequent = digests.agg(F.expr(f"approx_top_k(text_sha256, {heavy}, {tracked})").alias("top"))
    candidates = frequent.select(F.explode("top").alias("top")).select(F.col("top.item").alias("text_sha256"))
    winners = (
        digests.join(F.broadcast(candidates), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )

    split = digests.join(F.broadcast(winners), "text_sha256", "left")
    settled = split.filter(F.col("group_size").isNotNull())
    same = Window.partitionBy("text_sha256")
    others = split.filter(F.col("group_size").isNull()).withColumns(
        {"keep_id": F.max("doc_id").over(same), "group_size": F.count(F.lit(1)).over(same)}
    )
    return settled.unionByName(others).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact dedup keeps, with all their columns; of repeated rows of a kept document, one.

    Rows that share id and normalised text may still differ in case or in other columns: the one with the smallest hash of
    all its columns stays. Whole rows are shuffled once, by one key of id and text for both the choice and the join.
    """
    stay = exact_dedup(docs, id_col, text_col).filter("kept").select(document_key("doc_id", F.col("text_sha256")).alias("__key"))
    key = document_key(f"`{id_col}`", F.sha2(lower_ascii(whole(f"`{text_col}`")), 256))
    return one_each(docs.withColumn("__key", key).join(stay, "__key", "left_semi"), docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT doc_id, text_sha256, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""
