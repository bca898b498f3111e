"""Hard negatives: for each anchor and positive, the unlike rows that score just below the positive.

Candidates are written once, in blocks along a Hilbert curve within each label, with a zone map: the least and greatest
value of every dimension and of the label in a block. For an anchor, interval arithmetic over a block's zone map bounds all
scores of the block from above and below, which tells the blocks that its windows must read; the files of others are not
read. Anchors go in passes of a fixed number, so what is sent to the tasks doesn't grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyflow.llm.common import materialize, narrow, running_totals, table
from surveyflow.sources.scratch import scratch_path

NONE = -(2**62)  # below any score; scores must be less than 2^62 in size
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 5
    low: int = 80  # a negative scores at least so many hundredths of the positive
    high: int = 100  # and at most so many
    block: int = 1024  # rows
    axes: int = 15  # of the curve: the dimensions that vary most
    bits: int = 4  # of a coordinate; axes * bits <= 62
    anchors: int = 4096  # of one pass: 2 MB of 64 dimensions
    scored: int = 1 << 22  # scores that a task holds at a time


# --- the curve -------------------------------------------------------------------------------------------------------


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points on a grid of 2^bits cells an axis, (points, axes)."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(axes):
            upper = (x[i] >> level & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | x[i] >> level & 1
    return key


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)


def _axes(rows: DataFrame, rule: Mining) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """Length of the longest vector, and the dimensions that vary most with the edges of their grids: one row a dimension."""
    spread = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("s"))
    found = sorted(spread.collect(), key=lambda r: (-r["s"], r["at"]))
    chosen = found[: rule.axes]
    size = max((r["at"] + 1 for r in found), default=0)
    mean, step = (np.array(x, dtype=float) for x in ([r["mean"] for r in chosen], [max(r["s"], 1e-9) for r in chosen]))
    return size, [r["at"] for r in chosen], mean - 2 * step, 4 * step / (1 << rule.bits)


# --- candidates in blocks --------------------------------------------------------------------------------------------


def write_blocks(rows: DataFrame, rule: Mining) -> tuple[DataFrame, int]:
    """(part, block, vec_id, label, v), ordered by label and curve, stored by part; and the length of the vectors.

    Shorter vectors are filled up with zeros. Rows that repeat id, label and vector are written once: they are neighbours.
    Equal vectors have one place on the curve, but the ranges are cut by label, place and id, so they spread as well.
    """
    spark = rows.sparkSession
    size, at, low, step = _axes(rows, rule)
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), size - F.size("v")))
    filled = rows.select("vec_id", "label", padded.alias("v"))
    cells = 1 << rule.bits

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(batch.num_rows, dtype=np.int64)
            if at:
                scaled = (_matrix(batch, size)[:, at] - low) / step
                key = hilbert_index(np.clip(scaled, 0, cells - 1).astype(np.int64), rule.bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=["vec_id", "label", "v", "place"])

    types = "vec_id long, label long, v array<long>"
    placed = filled.mapInArrow(place, f"{types}, place long")
    ordered = placed.repartitionByRange("label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id", "v")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, written, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            whole = np.column_stack([ids, labels, _matrix(batch, size)])
            before = np.vstack([whole[:1] if last is None else last, whole[:-1]])
            fresh = (whole != before).any(axis=1)
            fresh[0] |= last is None
            last = whole[-1:]
            kept = batch.filter(pa.array(fresh))
            number = written + np.arange(kept.num_rows)
            written += kept.num_rows
            block = (part << 32) + number // rule.block
            columns = [pa.array(np.full(kept.num_rows, part, dtype=np.int32)), pa.array(block), *kept.columns[:3]]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "vec_id", "label", "v"])

    path = scratch_path(spark, "negative-blocks")
    ordered.mapInArrow(cut, f"part int, block long, {types}").write.partitionBy("part").parquet(path)
    return spark.read.schema(f"block long, {types}, part int").parquet(path), size


_ZONES = "block long, part int, low array<long>, high array<long>, label_low long, label_high long"


def blocks_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """(block, part, ids, labels, vectors) of rows that come block by block; a block across batches comes in pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, part, ids, labels = (batch.column(c).to_numpy() for c in ("block", "part", "vec_id", "label"))
        vectors = _matrix(batch, size)
        edges = np.flatnonzero(np.diff(block)) + 1
        for rows in np.split(np.arange(len(block)), edges):
            yield block[rows[0]], part[rows[0]], ids[rows], labels[rows], vectors[rows]


def zone_maps(candidates: DataFrame, size: int) -> DataFrame:
    """Least and greatest value of every dimension and of the label, for each block (or piece of one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part, _, labels, vectors in blocks_of(batches, size):
            row = (int(block), int(part), vectors.min(axis=0), vectors.max(axis=0), int(labels.min()), int(labels.max()))
            types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            names = ["block", "part", "low", "high", "label_low", "label_high"]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return materialize(candidates.mapInArrow(run, _ZONES), "negative-zones")


# --- one pass --------------------------------------------------------------------------------------------------------


@dataclass
class Windows:
    """Anchors of a pass, and the score windows each is to fill with its ``most`` best rows."""

    ids: np.ndarray  # (anchors,)
    labels: np.ndarray
    vectors: np.ndarray  # (anchors, size)
    low: np.ndarray  # (anchors, windows): least score wanted
    high: np.ndarray  # greatest score wanted
    same: bool  # rows of the anchor's label, or of others
    most: int

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that a vector between ``low`` and ``high`` can have with each anchor."""
        up, down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        return _products(up, low) + _products(down, high), _products(up, high) + _products(down, low)

    def wanted(self, low, high, label_low: int, label_high: int, least: np.ndarray) -> np.ndarray:
        """Numbers of the anchors with a window that the block may have rows for; ``least`` tightens the windows."""
        if self.same:
            fits = (self.labels >= label_low) & (self.labels <= label_high)
        else:
            fits = ~((self.labels == label_low) & (self.labels == label_high))
        below, above = self.bounds(low[None, :], high[None, :])
        return np.flatnonzero(fits & ((above >= least) & (below <= self.high) & (self.low <= self.high)).any(axis=1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (rows of a, rows of b) of integers: in doubles as long as these are exact."""
    most = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most >= -NONE:
        raise ValueError("scores of 2^62 and more don't fit")
    return a @ b.T


def merge(scores: np.ndarray, ids: np.ndarray, more_scores: np.ndarray, more_ids: np.ndarray, most: int):
    """The best of two lists a row, by score descending, then id."""
    scores, ids = np.concatenate([scores, more_scores], -1), np.concatenate([ids, more_ids], -1)
    order = np.lexsort((ids, -scores), axis=-1)[..., :most]
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


def best_rows(w: Windows, chosen: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
    """Scores and ids of the best ``most`` rows of a block in every window of the chosen anchors."""
    order = np.argsort(ids, kind="stable")
    ids, labels = ids[order], labels[order]
    scores = _products(w.vectors[chosen], vectors[order])
    equal = labels[None, :] == w.labels[chosen][:, None]
    fits = equal & (ids[None, :] != w.ids[chosen][:, None]) if w.same else ~equal
    scores[~fits] = NONE
    ranked = np.argsort(-scores, axis=1, kind="stable")  # rows are by id, so ties are too
    down = np.take_along_axis(scores, ranked, 1)
    shape = (len(chosen), w.high.shape[1], w.most)
    found, found_ids = np.full(shape, NONE, dtype=np.int64), np.full(shape, _NO_ID, dtype=np.int64)
    for window in range(w.high.shape[1]):
        start = (down > w.high[chosen, window][:, None]).sum(axis=1)
        at = start[:, None] + np.arange(w.most)[None, :]
        inside = at < len(ids)
        at = np.minimum(at, len(ids) - 1)
        value = np.take_along_axis(down, at, 1)
        inside &= (value >= w.low[chosen, window][:, None]) & (value > NONE)
        found[:, window][inside] = value[inside]
        found_ids[:, window][inside] = ids[np.take_along_axis(ranked, at, 1)][inside]
    return found, found_ids


_FOUND = pa.schema([("anchor", pa.int32()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def fill(candidates: DataFrame, zones: DataFrame, w: Windows, size: int, rule: Mining) -> DataFrame:
    """(anchor, slot, id, score, rank): the best rows of every window, over all blocks that may hold one."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("block", "part", "low", "high", "label_low", "label_high")))
            needed = [
                (block, part, len(w.wanted(np.array(low, dtype=np.int64), np.array(high, dtype=np.int64), first, last, w.low)))
                for block, part, low, high, first, last in rows
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*needed), (pa.int64(), pa.int32(), pa.int32()))], names=["block", "part", "anchors"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (*w.high.shape, w.most)
        scores, ids = np.full(shape, NONE, dtype=np.int64), np.full(shape, _NO_ID, dtype=np.int64)
        for _, _, row_ids, labels, vectors in blocks_of(batches, size):
            # once a window is full here, only rows at least as good as its last can enter
            least = np.maximum(w.low, scores[:, :, -1])
            needed = w.wanted(vectors.min(axis=0), vectors.max(axis=0), labels.min(), labels.max(), least)
            step = max(1, rule.scored // len(row_ids))
            for start in range(0, len(needed), step):
                chosen = needed[start : start + step]
                found, found_ids = best_rows(w, chosen, row_ids, labels, vectors)
                scores[chosen], ids[chosen] = merge(scores[chosen], ids[chosen], found, found_ids, w.most)
        anchor, slot, place = np.nonzero(scores > NONE)
        if len(anchor):
            columns = [anchor.astype(np.int32), slot.astype(np.int32), ids[anchor, slot, place], scores[anchor, slot, place]]
            for start in range(0, len(anchor), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[start : start + 100_000]) for c in columns], schema=_FOUND)

    needed = zones.mapInArrow(choose, "block long, part int, anchors int").filter("anchors > 0").select("part", "block").distinct()
    read = candidates.join(needed, ["part", "block"], "left_semi")
    found = read.mapInArrow(score, "anchor int, slot int, id long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= w.most)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _mine(spark: SparkSession, candidates: DataFrame, zones: DataFrame, anchors: DataFrame, size: int, rule: Mining) -> DataFrame:
    """The negatives of one pass. What reaches the driver is the pass: its anchors, and a few positives of each."""
    held = anchors.select("vec_id", "label", "v").toArrow().combine_chunks()
    ids, labels = (held.column(c).to_numpy() for c in ("vec_id", "label"))
    vectors = np.array(held.column("v").to_pylist(), dtype=np.int64).reshape(len(ids), size)
    every = (len(ids), 1)
    w = Windows(ids, labels, vectors, np.full(every, NONE + 1), np.full(every, -NONE - 1), True, rule.positives)
    found = fill(candidates, zones, w, size, rule).select("anchor", "rank", "id", "score").toArrow().to_pydict()

    at = np.array(found["anchor"], dtype=np.int64), np.array(found["rank"], dtype=np.int64) - 1
    shape = (len(ids), rule.positives)
    positive_ids, positive = np.full(shape, _NO_ID), np.full(shape, NONE)
    positive_ids[at], positive[at] = found["id"], found["score"]
    hundreds, rest = np.divmod(positive, 100)  # so that no product leaves 64 bits
    low = np.where(positive > NONE, rule.low * hundreds - (-rule.low * rest // 100), 0)  # the least whole number in the window
    high = np.where(positive > NONE, rule.high * hundreds + rule.high * rest // 100, -1)
    negatives = fill(candidates, zones, Windows(ids, labels, vectors, low, high, False, rule.negatives), size, rule)

    pairs = pa.table({
        "anchor": np.repeat(np.arange(len(ids), dtype=np.int32), rule.positives),
        "slot": np.tile(np.arange(rule.positives, dtype=np.int32), len(ids)),
        "anchor_id": np.repeat(ids, rule.positives), "positive_id": positive_ids.ravel(), "positive_score": positive.ravel(),
    })
    joined = negatives.join(F.broadcast(spark.createDataFrame(pairs)), ["anchor", "slot"])  # the pass again
    return joined.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def hard_negatives(rows: DataFrame, is_anchor: Column, rule: Mining = Mining()) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels within the window.

    ``rows`` has vec_id (long), label (long) and v (array of long, without nulls). Rows without id, label or vector take no
    part. A score is the inner product; a shorter vector counts as filled up with zeros. Ties go by the smaller id. Rows
    that repeat id, label and vector are one row. Rows that share an id but differ are rows of their own; none of them is a
    positive of another. An anchor without positives, or a window without rows (one of negative scores is empty), gives no
    row. No rows in, no rows out. Scores of 2^62 and more are refused.
    """
    spark = rows.sparkSession
    known = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("v").cast("array<long>"))
    known = known.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    candidates, size = write_blocks(known, rule)
    zones = zone_maps(candidates, size)
    numbered = running_totals(
        candidates.filter(is_anchor).select("block", "vec_id", "label", "v"),
        [F.col("block"), F.col("vec_id"), F.col("label"), F.col("v")], {"place": F.lit(1)}, "negative-anchors",
    )
    number = F.floor((F.col("run_place") - 1) / rule.anchors).cast("int")
    anchors = materialize(numbered.select("vec_id", "label", "v", number.alias("pass")), "negative-passes")
    passes = anchors.agg(F.max("pass")).first()[0]
    if passes is None:
        return spark.createDataFrame([], RESULT)
    out = scratch_path(spark, "negatives")
    for number in range(passes + 1):
        mined = _mine(spark, candidates, zones, anchors.filter(F.col("pass") == number), size, rule)
        mined.write.parquet(f"{out}/pass={number}")
    return spark.read.schema(RESULT).parquet(*[f"{out}/pass={number}" for number in range(passes + 1)])


def digested(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v): components as whole 256ths, labels moved on by one for ids divisible by 7.

    Rows with a null id, label, vector or component, or a component that isn't finite, are left out.
    """
    rows = narrow(embeddings, vec_id="vec_id", label="label", embedding="embedding")
    x = F.transform("embedding", lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(sound)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select("vec_id", label.cast("long").alias("label"), F.transform(x, lambda c: F.floor(256 * c)).alias("v"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(digested(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id AS id, r.label AS label,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id, score FROM pairs WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND n.label <> n.anchor_label
WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 5
"""
