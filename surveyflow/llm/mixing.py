"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a hashed order, repeated up to ``most`` times. The virtual finish time of a
copy is the queue's cumulative size at its end, divided by the source's weight. Taking copies in order of finish time
until the budget is spent serves all queues in proportion to their weights; an exhausted queue leaves its share to the
others, which is exactly how the targets are reshared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyflow.llm.common import WORD, materialize, narrow, running_totals, table, whole


@dataclass(frozen=True)
class MixRule:
    weights: tuple[float, ...] = (1, 2, 3)
    most: int = 3
    seed: str = "mix"


def source_targets(sized: DataFrame, rule: MixRule) -> DataFrame:
    """source, source_size, weight and target: shares of the total by weight, none above ``most`` times its size.

    With sources in order of cap / weight, those before the first whose fair level does not reach its cap are capped,
    and the rest share what is left by weight; this is where repeated resharing ends.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(sizes, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)}, "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, map(float, rule.weights))), ((F.col("run_rank") - 1) % len(rule.weights) + 1).cast("int"))
    capped = materialize(
        ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * rule.most).alias("cap"))
        .withColumn("reach", F.col("cap") / F.col("weight")),
        "mix-caps",
    )
    total, weights = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    order = [F.col("reach").asc(), F.col("source").asc_nulls_last()]
    levels = running_totals(capped, order, {"cap": F.col("cap"), "weight": F.col("weight")}, "mix-levels")
    level = (F.lit(total) - (F.col("run_cap") - F.col("cap"))) / (F.lit(weights) - (F.col("run_weight") - F.col("weight")))
    first = levels.withColumn("level", level).filter("reach >= level").agg(F.min(F.struct("reach", "level"))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(first["level"] if first else 0.0))
    return capped.select("source", "source_size", "weight", target.alias("target"))


def _size():
    return F.regexp_count(whole("text"), F.lit(WORD)).cast("long")


def cut_off(copies: DataFrame, budget: int):
    """The finish of the last copy that the budget reaches, or null.

    Copies are sorted into ranges of finish. The totals of the ranges, one row each, tell the range in which the budget
    runs out, and only that one is put in order.
    """
    dealt = materialize(copies.repartitionByRange("finish").withColumn("range", F.spark_partition_id()), "mix-served")
    totals = dealt.groupBy("range").agg(F.sum("size").alias("held"), F.max("finish").alias("last"))
    upto = F.sum("held").over(Window.orderBy("range"))  # one row a range
    ranges = materialize(totals.withColumn("before", upto - F.col("held")), "mix-ranges")
    whole_range = F.col("before") + F.col("held") <= budget
    full = ranges.filter(whole_range).agg(F.max("last").alias("finish"))
    ends = ranges.filter(~whole_range & (F.col("before") <= budget)).select(F.col("range").alias("in"), "before")
    order = Window.partitionBy("range").orderBy("finish").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.join(F.broadcast(ends), F.col("range") == F.col("in")).withColumn("run", F.col("before") + F.sum("size").over(order))
    part = inside.filter(F.col("run") <= budget).agg(F.max("finish").alias("finish"))
    return full.union(part).agg(F.max("finish")).scalar()


def mix_sources(
    docs: DataFrame, rule: MixRule = MixRule(), *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """doc_id, size, source_size, target, taken, times (copies taken), source and digest of the text of every row.

    The budget is the size of all documents. Documents are taken whole; each source ends within one document of its
    target, and all together within one of the budget. A null text has size 0, a null source is a source of its own and
    comes last. The order inside a source is md5 of seed, id and text, so reruns agree on any cluster; a null id is one more
    id, and each row has a place of its own, also among rows that repeat id, source and text: some of these may be taken
    once more than the others. An empty table gives no rows. Further columns are not returned.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, source=source_col).withColumn("digest", F.md5(whole("text")))
    named = F.concat_ws(":", F.lit(rule.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest")
    sized = rows.select("doc_id", "source", _size().alias("size"), "digest", F.md5(named).alias("key"))
    sized = materialize(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")  # parts rows that repeat
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    targets = source_targets(sized, rule).withColumnRenamed("source", "_source")

    order = [F.col("key"), F.col("doc_id"), F.col("row")]
    placed = running_totals(sized, order, {"size": F.col("size")}, "mix-places", by=["source"])
    queued = placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "digest", "key", "source_size", "weight", "target", F.col("run_size").alias("end")
    )
    queued = materialize(queued, "mix-queues")

    def finish(copy: int | F.Column):
        return F.struct(
            ((F.col("end") + (copy - 1) * F.col("source_size")) / F.col("weight")).alias("finish"),
            F.col("source").isNull().alias("last"), "source", "key", "end",
        )

    copies = queued.select(F.explode(F.sequence(F.lit(1), F.lit(rule.most))).alias("copy"), *queued.columns)
    last = cut_off(copies.select(finish(F.col("copy")).alias("finish"), "size"), budget)
    times = sum((F.when(finish(c) <= last, 1).otherwise(0) for c in range(1, rule.most + 1)), F.lit(0))
    marked = queued.withColumn("times", times)
    return marked.select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times", "source", "digest"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def repeat_mixed(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: left out, once, or up to ``rule.most`` times; columns as they are.

    Rows that repeat id, source and text share what the mix takes of them evenly; what is left over goes to those first by a
    digest of all columns.
    """
    same = [F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("digest").alias("__mix_text")]
    plan = mix_sources(docs, rule).groupBy(*same).agg(F.sum("times").alias("__mix_times"), F.count(F.lit(1)).alias("__mix_rows"))
    plan = materialize(plan.filter("__mix_times > 0"), "mix-plan")
    mine = (
        F.col("doc_id").eqNullSafe(F.col("__mix_id")) & F.col("source").eqNullSafe(F.col("__mix_source"))
        & (F.col("__mix_own") == F.col("__mix_text"))
    )
    taken = docs.withColumn("__mix_own", F.md5(whole("text"))).join(plan, mine)
    single = taken.filter("__mix_rows = 1").select(*docs.columns, "__mix_times")

    group = ["__mix_id", "__mix_source", "__mix_text"]
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    many = taken.filter("__mix_rows > 1").withColumn("__mix_all", F.sha2(F.to_json(columns), 256))
    kinds = many.groupBy(*group, "__mix_all", "__mix_times", "__mix_rows").agg(
        F.count(F.lit(1)).alias("__mix_n"), F.first(columns).alias("__mix_row")
    )
    earlier = Window.partitionBy(*group).orderBy("__mix_all").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__mix_n").over(earlier), F.lit(0))
    extra = F.least(F.greatest(F.expr("__mix_times % __mix_rows") - before, F.lit(0)), F.col("__mix_n"))
    shared = kinds.withColumn("__mix_share", F.expr("__mix_times div __mix_rows * __mix_n") + extra).filter("__mix_share > 0")
    shared = shared.select("__mix_row.*", F.col("__mix_share").alias("__mix_times"))
    every = single.union(shared)
    return every.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_times")))).select(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM d GROUP BY source
), c AS (
  SELECT *, 3 * source_size AS cap, 3 * source_size / weight AS reach FROM s
), l AS (
  SELECT reach, (CAST(sum(source_size) OVER () AS DOUBLE) - (CAST(sum(cap) OVER o AS DOUBLE) - cap))
                / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
  FROM c WINDOW o AS (ORDER BY reach, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), t AS (
  SELECT source, source_size, weight, cap,
         least(CAST(cap AS DOUBLE), weight * (SELECT arg_min(level, reach) FROM l WHERE reach >= level)) AS target
  FROM c
), q AS MATERIALIZED (
  SELECT d.*, t.source_size, t.weight, t.target,
         CAST(sum(d.size) OVER o AS BIGINT) AS ended, row_number() OVER o AS r
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
  WINDOW o AS (PARTITION BY d.source ORDER BY d.key ROWS UNBOUNDED PRECEDING)
), k AS (
  SELECT q.*, (ended + (copy - 1) * source_size) / weight AS finish FROM q, range(1, 4) r(copy)
), a AS MATERIALIZED (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, key, ended ROWS UNBOUNDED PRECEDING) AS served,
         row_number() OVER (ORDER BY finish, source NULLS LAST, key, ended) AS place FROM k
), e AS (SELECT max(place) AS cut FROM a WHERE served <= (SELECT sum(size) FROM d))
SELECT doc_id, size, source_size, target,
       CAST(count(*) FILTER (WHERE place <= (SELECT cut FROM e)) * size AS BIGINT) AS taken
FROM a GROUP BY source, r, doc_id, size, source_size, target
"""
