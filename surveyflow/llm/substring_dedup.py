"""Substring dedup by level-wise doubling of repeated word windows.

A window of ``length`` words can only occur twice if the shorter windows inside it do. The first level looks at windows of
three tenths of that length, and of these only at anchors: in every full window the short one with the smallest hash, which
is the same one wherever the window stands. Windows around an anchor that is repeated are extended to twice its length, those
around a repeated one of these to the full length, and of each full window that still occurs more than once all but the
earliest occurrence are removed. Documents that repeat another word for word are settled before the first level by a digest
of their words.

What is known to be repeated goes back to the texts as a bitmap of fixed size: it holds back windows and texts that can't
match, and what it lets through by chance ends at the next level or in the next join. So texts that have no part in a
repetition are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyflow.llm.bitmaps import bitmap_of, matching, marked
from surveyflow.llm.common import buffered, discard, materialize, narrow, table, text_rows, whole

#: Bytes of text that are cut into words at a time.
PIECE = 4_000_000
#: Anchors that occur more often than FEW are hot: their windows are counted before they are shuffled. At most HOT anchors
#: are; any other has less than one in HOT of all occurrences.
FEW, HOT = 4096, 1024


def levels(length: int) -> tuple[int, int]:
    """The window lengths before the full one: some three tenths of it, where few windows are repeated by chance, and twice
    that (for 20 words: 6 and 12; twice 12 is beyond the full length)."""
    first = -(-3 * length // 10)
    return first, min(2 * first, length)


def extended(offset: np.ndarray, length: int) -> np.ndarray:
    """Where in a window its part of the second level starts: at the anchor, or so that it ends with the anchor. Both stand
    by the anchor, so all windows around it have two such parts between them."""
    first, half = levels(length)
    return np.where(offset <= length - half, offset, np.clip(offset + first - half, 0, length - half))


def pieces(text: str, length: int) -> Iterator[tuple[int, list[bytes], int]]:
    """(number of the first word, words, how many of them came before): every window of ``length`` words is in one piece."""
    data = text.encode("utf-8", "surrogatepass")
    at, held, fresh, rest = 0, [], 0, b""
    for low in range(0, len(data) or 1, PIECE):
        part = rest + data[low : low + PIECE]
        words, rest = part.split(), b""
        last = low + PIECE >= len(data)
        if not last and words and not part[-1:].isspace():
            rest = words.pop()
        held += words
        if words or last:
            yield at, held, fresh
        kept = min(len(held), length - 1)
        at, held, fresh = at + len(held) - kept, held[len(held) - kept :], kept


def word_hashes(words: list[bytes]) -> np.ndarray:
    """(2, words): two independent 64-bit hashes of each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype="<u8").reshape(-1, 2).T


_SHIFTS = np.uint64(29), np.uint64(32), np.uint64(31)
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of a sequence from those of its two parts, which may overlap."""
    (first, second, third), (a, b, c) = _SHIFTS, _FACTORS
    mixed = left >> first
    mixed ^= left
    mixed *= a
    mixed += right * b
    mixed ^= mixed >> second
    mixed *= c
    mixed ^= mixed >> third
    return mixed


def longer(windows: np.ndarray, size: int, wanted: int) -> np.ndarray:
    """Hashes of the windows of ``wanted`` words from all those of ``size`` words, at least half as many: a window is told by
    the one that starts with it and the one that ends with it."""
    step = wanted - size
    return joined(windows[..., :-step], windows[..., step:]) if step else windows


def window_hashes(single: np.ndarray, size: int) -> np.ndarray:
    """Hashes (2, windows) of all windows of ``size`` words; spans double, and those in the binary form of size join up."""
    count = single.shape[1] - size + 1
    if count <= 0:
        return single[:, :0]
    out, start, span, now = None, 0, 1, single
    while True:
        if size & span:
            part = now[:, start : start + count]
            out = part if out is None else joined(out, part)
            start += span
        if span * 2 > size:
            return out
        now, span = joined(now[:, :-span], now[:, span:]), span * 2


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    span, now = 1, values
    while span * 2 <= width:
        now, span = pick(now[:-span], now[span:]), span * 2
    return pick(now[: len(values) - width + 1], now[width - span : len(values) - span + 1])


def anchored(half: np.ndarray, width: int) -> np.ndarray:
    """For each full window the smallest hash of its ``width`` halves."""
    return sliding(half, width, np.minimum)


def anchors(half: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all halves that are the anchor of a full window, as often as they occur."""
    least = anchored(half, width)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return half[sliding(padded, width, np.maximum) == half]


def offsets(quarter: np.ndarray, least: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Where in the windows at ``start`` the first quarter with the smallest hash stands."""
    found = np.empty(len(start), dtype=np.int64)
    for low in range(0, len(start), 1 << 14):
        part = start[low : low + (1 << 14), None]
        found[low : low + (1 << 14)] = (quarter[part + np.arange(width)] == least[part]).argmax(axis=1)
    return found


def among(hot: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``hot``."""
    if not len(hot):
        return np.zeros(len(values), dtype=bool)
    return hot[np.minimum(np.searchsorted(hot, values), len(hot) - 1)] == values


def _twice_at_most(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    kept = np.ones(len(ordered), dtype=bool)
    kept[2:] = ordered[2:] != ordered[:-2]
    return ordered[kept]


def repeats(keys: np.ndarray) -> np.ndarray:
    """Which columns of (2, n) stand before in it."""
    order = np.lexsort(keys)  # keeps equal ones in their order
    again = np.zeros(keys.shape[1], dtype=bool)
    again[order[1:]] = (keys[:, order[1:]] == keys[:, order[:-1]]).all(axis=0)
    return again


def first_level(rows: DataFrame, length: int) -> DataFrame:
    """(at, key, row, digest, n_words, quarters) of every row: the digest of its words and the anchors of its windows."""
    quarter, _ = levels(length)
    schema = [("row", pa.binary()), ("digest", pa.binary()), ("n_words", pa.int64()), ("quarters", pa.list_(pa.int64()))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch: pa.RecordBatch, texts: list[str]) -> Iterator[tuple]:
            known = (batch.column(c).to_pylist() for c in ("at", "key", "row"))
            for at, key, row, text in zip(*known, texts):
                digest, n_words, found = hashlib.sha256(), 0, []
                for _, words, before in pieces(text, length):
                    digest.update(b" ".join([b"", *words[before:]]))
                    n_words += len(words) - before
                    if len(words) >= length:
                        hashes = window_hashes(word_hashes(words)[:1], quarter)[0]
                        found.append(_twice_at_most(anchors(hashes, length - quarter + 1)))
                quarters = np.concatenate(found) if found else np.empty(0, np.uint64)
                yield at, key, row, digest.digest()[:16], n_words, quarters.view(np.int64)

        for batch, texts in text_rows(batches):
            out = pa.schema([batch.schema.field("at"), batch.schema.field("key"), *schema])
            yield from buffered(made(batch, texts), out, 2048, lambda row: 8 * len(row[5]))

    kind = rows.schema["at"].dataType.simpleString()
    rows = rows.select("at", "key", "row", "text")
    return rows.mapInArrow(work, f"at {kind}, key binary, row binary, digest binary, n_words long, quarters array<long>")


def second_level(rows: DataFrame, length: int, repeated: np.ndarray, hot: np.ndarray) -> DataFrame:
    """(row, halves, hot): of rows with repeated anchors, the halves around them, and whether any of them is hot."""
    quarter, half = levels(length)
    schema = pa.schema([("row", pa.binary()), ("halves", pa.list_(pa.int64())), ("hot", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch: pa.RecordBatch, texts: list[str]) -> Iterator[tuple]:
            for row, text in zip(batch.column("row").to_pylist(), texts):
                found, any_hot = [], False
                for _, words, _ in pieces(text, length):
                    if len(words) < length:
                        continue
                    single = word_hashes(words)[:1]
                    hashes = window_hashes(single, quarter)[0]
                    least = anchored(hashes, length - quarter + 1)
                    start = np.flatnonzero(marked(repeated, least))
                    own = among(hot, least[start])
                    any_hot |= bool(own.any())
                    start = start[~own]
                    if len(start):
                        marks = np.zeros(len(hashes), dtype=bool)
                        marks[start + extended(offsets(hashes, least, start, length - quarter + 1), length)] = True
                        at = np.flatnonzero(marks)
                        found.append(_twice_at_most(joined(hashes[at], hashes[at + half - quarter])))
                if found or any_hot:
                    halves = np.concatenate(found) if found else np.empty(0, np.uint64)
                    yield row, halves.view(np.int64), any_hot

        for batch, texts in text_rows(batches):
            yield from buffered(made(batch, texts), schema, 2048, lambda row: 8 * len(row[1]))

    return rows.select("row", "text").mapInArrow(work, "row binary, halves array<long>, hot boolean")


def full_windows(docs: DataFrame, length: int, repeated: np.ndarray, hot: np.ndarray, of_hot: bool) -> DataFrame:
    """(h1, h2, place, start, again) of the full windows of ``docs`` (place, text, halves): those around a hot anchor, or
    those around the others whose half is among the halves.

    ``again`` marks windows that stand before in the same piece of a text. They are later occurrences whatever else there is,
    so they go by a key of their own: a line that fills a document is no hot key.
    """
    quarter, half = levels(length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            halves = batch.column("halves")
            for k, (place, text) in enumerate(zip(batch.column("place").to_pylist(), texts)):
                known = np.sort(np.asarray(halves[k].values).view(np.uint64)) if halves[k].is_valid else np.empty(0, np.uint64)
                for at, words, _ in pieces(text, length):
                    if len(words) < length:
                        continue
                    both = window_hashes(word_hashes(words), quarter)
                    hashes = both[0]
                    least = anchored(hashes, length - quarter + 1)
                    start = np.flatnonzero(marked(repeated, least))
                    start = start[among(hot, least[start]) == of_hot]
                    if not of_hot and len(start):
                        at_half = start + extended(offsets(hashes, least, start, length - quarter + 1), length)
                        start = start[among(known, joined(hashes[at_half], hashes[at_half + half - quarter]))]
                    if not len(start):
                        continue
                    full = longer(longer(both, quarter, half), half, length)[:, start].view(np.int64)
                    again = repeats(full)
                    full[0, again] = place
                    full[1, again] = start[again] + at
                    for low in range(0, len(start), 100_000):
                        part = slice(low, low + 100_000)
                        columns = [full[0, part], full[1, part], np.full(len(start[part]), place), (start[part] + at).astype(np.int32), again[part]]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "place", "start", "again"])

    return docs.mapInArrow(work, "h1 bigint, h2 bigint, place bigint, start int, again boolean")


def keep_words(docs: DataFrame, length: int, losing: np.ndarray | None = None) -> DataFrame:
    """Applies ``copied`` and ``starts`` (removed windows) to the words of each row.

    With ``losing``, only to rows whose ``short`` key isn't marked there: those lose nothing.
    """
    schema = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(batch: pa.RecordBatch, texts: list[str]) -> Iterator[tuple]:
            starts = batch.column("starts") if losing is None else None
            copied = batch.column("copied").to_pylist() if losing is None else [False] * len(texts)
            for k, (at, text) in enumerate(zip(batch.column("at").to_pylist(), texts)):
                gone = None
                if starts is not None and starts[k].is_valid and not copied[k]:
                    own = np.sort(np.asarray(starts[k].values).astype(np.int64))
                    turns = np.zeros(own[-1] + length + 1, dtype=np.int32)
                    np.add.at(turns, own, 1)
                    np.add.at(turns, own + length, -1)
                    gone = np.cumsum(turns) > 0
                size, kept = 0, []
                for first, words, _ in pieces(text, 1):
                    size += len(words)
                    if gone is not None:
                        own = gone[first : first + len(words)]
                        words = [w for w, out in zip(words, own.tolist()) if not out] + words[len(own) :]
                    if not copied[k]:
                        kept += [(len(words), b" ".join(words))] if words else []
                text = b" ".join(part for _, part in kept).decode("utf-8", "surrogatepass")
                yield at, size, size - sum(n for n, _ in kept), text

        if losing is not None:
            batches = (b.filter(pa.array(~marked(losing, b.column("short").to_numpy()))) for b in batches)
        for batch, texts in text_rows(batches):
            out = pa.schema([batch.schema.field("at"), *schema])
            yield from buffered(made(batch, texts), out, 2048, lambda row: len(row[3]))

    kind = docs.schema["at"].dataType.simpleString()
    return docs.mapInArrow(work, f"at {kind}, n_words bigint, n_removed bigint, kept_text string")


def _short(row: str = "row"):
    return F.xxhash64(row).alias("short")


def _later(cold: DataFrame, hot: DataFrame | None) -> DataFrame:
    """(place, start) of all but the earliest occurrence of each window.

    Windows around hot anchors are counted before they are shuffled and then meet the earliest in a join that Spark splits
    by size. All others are few, and meet in one exchange.
    """
    here, same = F.struct("place", "start"), Window.partitionBy("h1", "h2", "again")
    later = cold.withColumn("first", F.min(here).over(same)).filter(F.col("again") | (here > F.col("first"))).select("place", "start")
    if hot is None:
        return later
    first = hot.filter(~F.col("again"))
    earliest = first.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    earliest = materialize(earliest.drop("n"), "windows-earliest")
    others = first.join(earliest, ["h1", "h2"]).filter(here > F.col("first")).select("place", "start")
    return later.union(hot.filter("again").select("place", "start")).union(others)


def substring_dedup(docs: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by a space) of every row.

    A word goes if a window over it also starts earlier: in a smaller doc_id, or before it in the same document. What was
    removed still counts as an earlier start. Texts of fewer than ``length`` words keep all; a null text has no words. A
    null doc_id comes after all others. Unlike texts of one id, or of none, are documents of their own and follow each
    other by the MD5 of their texts; rows that repeat both stand at the same place, so they lose the same words. No rows
    in, no rows out. Ids are of any type that has an order; further columns are not returned.
    """
    rows = narrow(docs, at=id_col, text=text_col).withColumn("text", whole("text"))
    named = F.coalesce(F.concat(F.lit("="), F.col("at").cast("string")), F.lit("none"))
    rows = rows.withColumn("key", F.unhex(F.md5("text")))
    rows = rows.withColumn("row", F.unhex(F.md5(F.concat(F.hex("key"), named))))
    first = materialize(first_level(rows, length), "windows-first")

    # numbered in the order of documents: ranges in order, and rows in order in each; of repeated rows one stands for all
    distinct = first.groupBy("row").agg(*[F.first(c).alias(c) for c in ("at", "key", "digest", "n_words")])
    order = [F.col("at").isNull(), F.col("at"), F.col("key")]
    ordered = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    places = materialize(ordered.select("row", "digest", "n_words", F.monotonically_increasing_id().alias("place")), "windows-places")
    long = places.filter(F.col("n_words") >= length)
    originals = long.groupBy("digest").agg(F.min("place").alias("place"))  # joined with the place, so copies are spread
    copies = materialize(long.join(originals, ["digest", "place"], "left_anti").select("row"), "windows-copies")

    # anchors stay where they are: a copy that gets through by chance only lets a few more of them be looked at
    heads = long.join(originals, ["digest", "place"]).select(_short())
    anchored_rows = matching(first.select("quarters", _short()), bitmap_of(heads, "short"), "short")
    counted = anchored_rows.select(F.explode("quarters").alias("quarter"))
    counted = counted.groupBy("quarter").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counted = materialize(counted, "windows-quarters")
    discard(first)
    repeated = bitmap_of(counted, "quarter")
    often = counted.filter(F.col("n") > FEW).orderBy(F.desc("n"), "quarter").limit(HOT).select("quarter").collect()
    hot = np.sort(np.array([r["quarter"] for r in often], dtype=np.int64).view(np.uint64))

    halves = materialize(second_level(rows, length, repeated, hot), "windows-halves")
    heads = halves.join(copies, "row", "left_anti").withColumn("short", _short())
    pairs = heads.select("short", F.explode("halves").alias("half"))
    again = pairs.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("half"))).filter("n > 1")
    # a row's short key may be another's too: it then gets halves that its text doesn't have, which is no harm
    found = again.select("short", "half", F.lit(False).alias("hot")).union(
        heads.filter("hot").select("short", F.lit(None).cast("long"), F.lit(True))
    )
    found = found.groupBy("short").agg(F.collect_set("half").alias("halves"), F.max("hot").alias("hot"))
    known = places.select("row", "place", _short())
    survivors = materialize(found.join(known, "short").select("short", "row", "place", "halves", "hot"), "windows-survivors")
    discard(halves, counted)

    held = matching(rows.select("row", "text", _short()), bitmap_of(survivors, "short"), "short").select("row", "text")
    # texts are joined in one way at any size, so small inputs tell what large ones take
    texts = held.join(survivors.drop("short").hint("merge"), "row").select("place", "text", "halves", "hot")
    texts = materialize(texts, "windows-texts") if len(hot) else texts  # read twice, but joined once
    of_hot = materialize(full_windows(texts.filter("hot"), length, repeated, hot, True), "windows-hot") if len(hot) else None
    later = _later(full_windows(texts, length, repeated, hot, False), of_hot)
    starts = later.groupBy("place").agg(F.collect_list("start").alias("starts")).join(places, "place")
    removed = starts.select("row", "starts", F.lit(False).alias("copied"))
    copied = copies.select("row", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copied"))
    removed = materialize(removed.unionByName(copied).withColumn("short", _short()), "windows-removed")
    discard(places, copies, survivors, of_hot, texts if len(hot) else None)

    wanted, losing = rows.select("at", "row", "text", _short()), bitmap_of(removed, "short")
    cut_rows = matching(wanted, losing, "short").join(removed.drop("short").hint("merge"), "row", "left").select(
        "at", "text", "starts", F.coalesce("copied", F.lit(False)).alias("copied")
    )
    kept = keep_words(wanted.select("at", "short", "text"), length, losing).union(keep_words(cut_rows, length))
    return kept.select(F.col("at").alias("doc_id"), "n_words", "n_removed", "kept_text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY md5(array_to_string(w[i:i + 19], ' ')) ORDER BY doc_id, i) AS r FROM places
  ) WHERE r > 1
), removed AS (
  SELECT DISTINCT doc_id, i + k AS p FROM later, range(0, 20) s(k)
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
