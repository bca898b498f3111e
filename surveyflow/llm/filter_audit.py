"""How filters interact: what each removes in every order of application, from one number per document.

Every mask of failed filters (and of the two labels) maps to one big integer whose 64-bit fields hold what happens to such
a document at each of the 600 steps of the 120 orders. The integers of a part are added, first in the task that made the
masks, then across tasks; as no count reaches 2^64, no field runs over into the next, and the sum is unpacked once a part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.llm.common import buffered, materialize, narrow, table, text_rows

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
# Blocks of fields: 600 each, but one field a filter for what only that filter fails.
KEPT, REMOVED, REDUNDANT, GOOD, TOXIC, UNIQUE = (block * STEPS for block in range(6))
FIELDS = UNIQUE + len(FILTERS)
WIDTH = 8  # bytes of a field
GOOD_BIT, TOXIC_BIT = 1 << len(FILTERS), 2 << len(FILTERS)
HELD = 1000  # sums of parts that a task holds before it passes them on: 24 KB each

_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_NO_CAPITALS = bytes(c for c in range(256) if c not in _CAPITALS)
_SLICE = 4_000_000


@lru_cache(maxsize=None)
def packed(code: int) -> int:
    """The big integer of one document: ``code`` has a bit for each failed filter, for quality and for toxicity."""
    fields = np.zeros(FIELDS, dtype="<u8")
    for number, order in enumerate(ORDERS):
        gone = False
        for place, name in enumerate(order):
            at, fails = number * len(FILTERS) + place, bool(code >> FILTERS.index(name) & 1)
            here = fails and not gone
            fields[[REMOVED + at, GOOD + at, TOXIC + at]] = here, here and bool(code & GOOD_BIT), here and bool(code & TOXIC_BIT)
            fields[REDUNDANT + at] = fails and gone
            gone = gone or fails
            fields[KEPT + at] = not gone
    for number in range(len(FILTERS)):
        fields[UNIQUE + number] = (code & (1 << len(FILTERS)) - 1) == 1 << number
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    return np.frombuffer(total.to_bytes(FIELDS * WIDTH, "little"), dtype="<u8").astype("int64")


def _words(data: bytes) -> tuple[int, int]:
    """Words and distinct words. Long texts are cut at white space, so only distinct words are held."""
    if len(data) <= _SLICE:
        words = data.split()  # bytes split at exactly 0x20 and 0x09 to 0x0D
        return len(words), len(set(words))
    count, seen, rest = 0, set(), b""
    for start in range(0, len(data), _SLICE):
        piece = rest + data[start : start + _SLICE]
        words = piece.split()
        rest = words.pop() if words and not piece[-1:].isspace() else b""
        count += len(words)
        seen.update(words)
    return count + bool(rest), len(seen | ({rest} if rest else set()))


def text_mask(text: str) -> int:
    """The failed filters among A to D, which read nothing but the text."""
    data = text.encode("utf-8", "surrogatepass")
    words, distinct = _words(data)
    few, repeating = words < 200, 100 * distinct < 50 * words
    shouting = 100 * len(data.translate(None, _NO_CAPITALS)) > 3 * len(text)
    return few | repeating << 1 | shouting << 2 | bool(_MARKS.search(data)) << 3


MASKED = "doc_id {id}, part string, mask int, digest binary"
_MASKED = [("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary())]


def masks(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, part, mask of A to D, digest of the text), one row a document; the texts are read here only."""
    rows = narrow(docs, doc_id=id_col, part=part_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            made = [batch.column("part"), pa.array(map(text_mask, texts), pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", *(n for n, _ in _MASKED)])

    return rows.mapInArrow(run, MASKED.format(id=kind))


def codes(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(part, code, n): how many rows have these failed filters and labels; several rows may repeat a pair.

    Rows that repeat id, text and part are counted before anything is joined. A text's first row is found by its digest and
    joined back by (digest, id), so rows of a text that many share meet it in as many places as they have ids.
    """
    rows = masks(docs, id_col, text_col, part_col).groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = materialize(rows, "audit-masks")
    named = rows.filter(F.col("doc_id").isNotNull())
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = named.join(first, ["digest", "doc_id"], "left")
    later = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)

    known = narrow(labels, doc_id=id_col, quality="quality", toxic="toxic").filter(F.col("doc_id").isNotNull())
    flags = known.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, GOOD_BIT).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, TOXIC_BIT).otherwise(0)).alias("bad"),
    )
    flagged = marked.join(flags, "doc_id", "left")
    code = F.col("mask") + later + F.coalesce(F.col("good"), F.lit(0)) + F.coalesce(F.col("bad"), F.lit(0))
    nameless = rows.filter(F.col("doc_id").isNull()).select("part", F.col("mask").alias("code"), "n")
    return flagged.select("part", code.alias("code"), "n").unionByName(nameless)


_SUMS = pa.schema([("part", pa.string()), ("total", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, code, n) to sums of big integers; a task passes them on when it holds many parts."""
    held: dict[str, int] = {}

    def rows():
        for part, total in held.items():
            yield part, total.to_bytes(FIELDS * WIDTH, "little")

    for batch in batches:
        counted = pa.Table.from_batches([batch]).group_by(["part", "code"]).aggregate([("n", "sum")]).to_pydict()
        for part, code, n in zip(counted["part"], counted["code"], counted["n_sum"]):
            held[part] = held.get(part, 0) + n * packed(code)
        if len(held) >= HELD:
            yield from buffered(rows(), _SUMS, most=256)
            held.clear()
    yield from buffered(rows(), _SUMS, most=256)


REPORT = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)
_REPORT = pa.schema([
    ("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), ("filter", pa.string()),
    *((name, pa.int64()) for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")),
])


def report_of(part: str, total: int) -> pa.RecordBatch:
    """The 600 rows of a part."""
    fields = unpacked(total)
    name = np.array([FILTERS.index(f) for order in ORDERS for f in order])
    removed = fields[REMOVED : REMOVED + STEPS]
    shapley = np.zeros(len(FILTERS), dtype="int64")
    np.add.at(shapley, name, removed)
    columns = [
        [part] * STEPS, [o for o in ORDERS for _ in FILTERS], list(range(1, len(FILTERS) + 1)) * len(ORDERS),
        [FILTERS[i] for i in name], fields[KEPT : KEPT + STEPS], removed, fields[REDUNDANT : REDUNDANT + STEPS],
        fields[UNIQUE + name], fields[GOOD : GOOD + STEPS], fields[TOXIC : TOXIC + STEPS], shapley[name],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _REPORT.types)], schema=_REPORT)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums in the order of their parts to reports; one part at a time is held."""
    part, total = None, 0
    for batch in batches:
        for name, data in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist()):
            if name != part:
                if part is not None:
                    yield report_of(part, total)
                part, total = name, 0
            total += int.from_bytes(data, "little")
    if part is not None:
        yield report_of(part, total)


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """One row per part, order of the five filters and step: what the step keeps, removes, and would remove in vain.

    A null text is empty, a null part is the part ''. A document is a row: repeated rows count as often as they occur, and
    as they repeat their own id they are no copies of a smaller one. A null id is neither smaller nor larger than another:
    such rows never fail E, make no other row fail it and have no labels. Of labels that repeat an id, one of quality 1 (or
    toxic 1) is enough; null labels are none. No rows in, no rows out. Further columns of the inputs are not read.
    """
    sums = codes(docs, labels, id_col, text_col, part_col).mapInArrow(_pack, "part string, total binary")
    return sums.repartition("part").sortWithinPartitions("part").mapInArrow(_merge, REPORT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marked AS (
  SELECT part, doc_id,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS mask
  FROM words
), flags AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
), counted AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS n_good, sum(coalesce(bad, 0)) AS n_bad
  FROM marked LEFT JOIN flags USING (doc_id) GROUP BY part, mask
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(list_sum(bits[1:step - 1]) AS BIGINT) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), outcomes AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (coalesce(earlier, 0) | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(earlier, 0) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(earlier, 0) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(earlier, 0) = 0 THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & coalesce(earlier, 0) = 0 THEN n_bad ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS "filter",
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM outcomes
"""
