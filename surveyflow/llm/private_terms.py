"""Personal data by patterns, and by the words that give it away: information-theoretic sanitisation.

A match of a pattern is an entity to protect. The corpus tells how much a term near it reveals: with p(entity) and
p(entity | term) estimated from how many documents hold the entity, the term, and both within a window, the term gives
log2 p(entity | term) / p(entity) of the entity's -log2 p(entity) bits. From one share of them on a term is generalised,
from a higher one on it is removed; there it stands near that entity, and nowhere else.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.llm.common import buffered, lower_ascii, materialize, narrow, table, text_rows, whole

KINDS = ("email", "ip", "card", "phone")
TERM_KIND = "term"
Span = tuple[str, int, int]


@dataclass(frozen=True)
class Disclosure:
    """When a term says too much: all counts are over whole documents of the whole corpus."""

    window: int = 80  # code points on either side of an entity
    support: int = 3  # different contexts that hold both: copies of a text are one context
    bits: float = 4.0  # an entity of less information is no secret: it is in more than one document of 16
    generalise: float = 0.75  # share of the entity's information
    remove: float = 0.95


# Runs are matched whole (possessive), which finds what the plain patterns find, in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")
#: Between terms: what is ASCII and no letter or digit. The same class for Python and for Spark.
_GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_TERM = re.compile(f"[^{_GAP}]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
#: Candidate terms that are sent to every task; beyond it they are joined.
LOOKED_UP = 200_000


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """At each @ the run of local characters before it, not before the last match, and the longest domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                end = domain.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def _octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def _digits(text: str, start: int, end: int, most: int) -> str:
    """The digits of a match, or a few too many: a match may be as long as the text."""
    return _NO_DIGITS.sub("", text[start : min(end, start + 40 * most)])[: most + 1]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    found = [("email", s, e) for s, e in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = _digits(text, *m.span(), 19)
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NO_DIGITS.sub("", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def entity_of(kind: str, value: str) -> bytes:
    """A digest of the value as it is compared: letters in lower case, numbers without what is put between them."""
    if kind == "email":
        same = value.lower()
    elif kind == "ip":
        same = ".".join(part.lstrip("0") or "0" for part in value.split("."))
    else:
        same = _NO_DIGITS.sub("", value)
    return hashlib.blake2b(f"{kind}:{same}".encode(), digest_size=16).digest()


def terms_near(text: str, start: int, end: int, window: int, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of the whole terms of two characters or more in the window, without those in ``taken`` spans.

    ``taken`` is sorted and free of overlaps.
    """
    low, high = max(0, start - window), min(len(text), end + window)
    near = []
    for m in _TERM.finditer(text, low, high):
        s, e = m.span()
        cut = (s == low > 0 and _TERM.match(text[s - 1])) or (e == high < len(text) and _TERM.match(text[e]))
        before = bisect_right(taken, (e - 1, len(text))) - 1
        if not cut and e - s > 1 and not (before >= 0 and taken[before][1] > s):
            near.append((m.group().translate(_UPPER), s, e))
    return near


def union(spans: list[Span]) -> list[tuple[int, int]]:
    """Sorted (start, end) without overlaps."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def listing(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def evidence(text: str, spans: list[Span], window: int) -> Iterator[tuple]:
    """(entity, term, context, fresh, near, start, end) of every term near an entity, and of the entity without a term.

    ``fresh`` is 1 at a document's first row of the entity, and of the entity with that term, ``near`` at its first row of
    the term with any entity; ``context`` is a number for the terms of the window.
    """
    taken, seen = union(spans), set()
    for kind, start, end in spans:
        entity, near = entity_of(kind, text[start:end]), terms_near(text, start, end, window, taken)
        words = " ".join(term for term, _, _ in near).encode("utf-8", "surrogatepass")
        context = int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True)
        for term, s, e in [(None, start, end), *near]:
            fresh, first = (entity, term) not in seen, term not in seen
            seen.update([(entity, term), term])
            yield entity, term, context, int(fresh), int(first), s, e


_COUNTS = [f"n_{kind}" for kind in KINDS]
_ROWS = (
    [("digest", pa.binary()), *((n, pa.int64()) for n in _COUNTS), ("base", pa.string()), ("base_sha256", pa.string())]
    + [("entity", pa.binary()), ("term", pa.string()), ("context", pa.int64()), ("fresh", pa.int32()), ("near", pa.int32())]
    + [("start", pa.int64()), ("end", pa.int64())]
)
_TYPES = {pa.binary(): "binary", pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}


def scan(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: a row per document with its base spans, and rows of evidence (``entity`` is set)."""
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", whole("text"))
    rows = rows.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    nothing = (None,) * 7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for batch, texts in text_rows(batches):
                for doc_id, digest, text in zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist(), texts):
                    spans = base_spans(text)
                    counts = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
                    base = listing(spans)
                    yield (doc_id, digest, *counts, base, hashlib.sha256(base.encode()).hexdigest(), *nothing)
                    for row in evidence(text, spans, window):
                        yield (doc_id, digest, *(None,) * 6, *row)

        first = next(batches, None)
        if first is None:
            return
        batches = _chained(first, batches)
        schema = pa.schema([("doc_id", first.schema.field("doc_id").type), *_ROWS])
        yield from buffered(made(), schema, weight=lambda row: 200 + len(row[6] or ""))

    schema = ", ".join([f"doc_id {kind}", *(f"`{n}` {_TYPES[t]}" for n, t in _ROWS)])
    return rows.mapInArrow(run, schema)


def _chained(first, rest):
    yield first
    yield from rest


def disclosing(found: DataFrame, docs: DataFrame, rule: Disclosure, text_col: str) -> DataFrame:
    """(entity, term, share, remove): the terms that say too much of an entity, and whether they go or are generalised."""
    total = found.filter(F.col("entity").isNull()).count()
    rows = found.filter(F.col("entity").isNotNull())
    contexts = rows.groupBy("entity", "term", "context").agg(F.sum("fresh").alias("held"))
    counted = contexts.groupBy("entity", "term").agg(F.sum("held").alias("held"), F.count(F.lit(1)).alias("contexts"))
    counted = materialize(counted.filter(F.col("contexts") >= rule.support), "private-pairs")
    pairs = counted.filter(F.col("term").isNotNull()).select("entity", "term", F.col("held").alias("both"))
    bits = F.log2(F.lit(float(total)) / F.col("with_entity"))
    entities = counted.filter(F.col("term").isNull()).select("entity", F.col("held").alias("with_entity"))
    entities = entities.withColumn("bits", bits).filter(F.col("bits") >= rule.bits)

    def told(with_term: str):
        """The share of the entity's bits that a term in so many documents tells."""
        both = F.col("both") * F.lit(float(total)) / (F.col(with_term) * F.col("with_entity"))
        return F.log2(both) / F.col("bits")

    # A term is in at least the documents that hold it near some entity, which settles common words without a count.
    near = rows.filter((F.col("near") == 1) & F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("near"))
    possible = pairs.join(entities, "entity").join(near, "term").filter(told("near") >= rule.generalise)
    possible = materialize(possible, "private-possible")

    held = document_counts(narrow(docs, text=text_col), materialize(possible.select("term").distinct(), "private-candidates"))
    much = possible.join(held, "term").withColumn("share", told("with_term")).filter(F.col("share") >= rule.generalise)
    return much.select("entity", "term", "share", (F.col("share") >= rule.remove).alias("remove"))


def document_counts(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(term, with_term): how many texts hold each candidate term.

    Up to `LOOKED_UP` candidates go to the tasks, which look the terms of a text up and pass on one count a term; more of
    them meet the terms of all texts in a join. A candidate is no longer than a window, so their size is bounded as well.
    """
    if candidates.count() > LOOKED_UP:
        words = F.array_distinct(F.split(lower_ascii(whole("text")), f"[{_GAP}]+"))
        found = docs.select(F.explode(words).alias("term")).join(candidates, "term")
        return found.groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    wanted = frozenset(r["term"] for r in candidates.collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for _, texts in text_rows(batches):
            for text in texts:
                lowered = text.lower() if text.isascii() else text.translate(_UPPER)
                counts.update(wanted.intersection(_TERM.findall(lowered)))
        schema = pa.schema([("term", pa.string()), ("n", pa.int64())])
        yield from buffered(iter(counts.items()), schema)

    return docs.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("with_term"))


def private_spans(
    docs: DataFrame, rule: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, digest of its text, counts, base spans and their digest, terms and all spans.

    ``terms`` has (start, end, remove) of the terms near an entity of the document that reveal it, by start. ``spans`` has
    the base spans by kind and start, then the terms. A null text is empty and has no spans. Rows that repeat id and text
    have the same spans; rows that repeat an id with another text, or have none, are told apart by the text. A repeated row
    is a document of its own in all counts but that of the contexts. No rows in, no rows out. Further columns of the input
    are not returned.
    """
    found = materialize(scan(docs, rule.window, id_col, text_col), "private-found")
    terms = materialize(disclosing(found, docs, rule, text_col), "private-terms")
    near = found.filter(F.col("term").isNotNull()).select("doc_id", "digest", "entity", "term", "start", "end")
    marked = near.join(terms, ["entity", "term"]).groupBy("doc_id", "digest", "start", "end").agg(F.max("remove").alias("remove"))
    held = marked.groupBy(F.col("doc_id").alias("in_id"), F.col("digest").alias("in_text")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "remove"))).alias("terms")
    )
    rows = found.filter(F.col("entity").isNull()).select("doc_id", "digest", *_COUNTS, "base", "base_sha256")
    same = F.col("doc_id").eqNullSafe(F.col("in_id")) & (F.col("digest") == F.col("in_text"))
    joined = rows.join(held, same, "left").withColumn("terms", F.coalesce("terms", F.array()))
    added = F.transform("terms", lambda t: F.concat_ws(":", F.lit(TERM_KIND), t["start"], t["end"]))
    spans = F.array_join(F.concat(F.filter(F.array("base"), lambda base: base != ""), added), ",")
    return joined.select("doc_id", "digest", *_COUNTS, "base_sha256", "terms", spans.alias("spans"))


def general_form(term: str) -> str:
    """What a generalised term becomes: its sort."""
    return "<number>" if term.isdigit() else "<name>" if term[:1].isupper() else "<word>"


def sanitised(text: str, terms: list[tuple[int, int, bool]]) -> str:
    """The text with every base span as ``<kind>``, terms generalised or removed."""
    parts, end = [], 0
    marks = [(s, e, f"<{kind}>") for kind, s, e in base_spans(text)]
    marks += [(s, e, "" if remove else general_form(text[s:e])) for s, e, remove in terms]
    for start, stop, instead in sorted(marks):
        if start >= end:
            parts += [text[end:start], instead]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): every document without its personal data and without the terms that reveal it; null stays null.

    Texts move only if the spans of terms are too many to be sent to where the texts are, which is for Spark to tell.
    """
    spans = private_spans(docs, rule, id_col, text_col).filter(F.size("terms") > 0)
    spans = spans.groupBy(F.col("doc_id").alias("in_id"), F.col("digest").alias("in_text")).agg(F.first("terms").alias("terms"))
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("digest", F.unhex(F.sha2(whole("text"), 256)))
    same = F.col("doc_id").eqNullSafe(F.col("in_id")) & (F.col("digest") == F.col("in_text"))
    joined = rows.join(spans, same, "left").select("doc_id", "text", "terms")
    kind = joined.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            terms = [[(t["start"], t["end"], t["remove"]) for t in row or []] for row in batch.column("terms").to_pylist()]
            absent = [not v for v in batch.column("text").is_valid().to_pylist()]
            clean = [None if gone else sanitised(t, marks) for t, marks, gone in zip(texts, terms, absent)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(clean, pa.string())], names=["doc_id", "text"])

    return joined.mapInArrow(run, f"doc_id {kind}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = private_spans(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *_COUNTS, "base_sha256", "spans", F.size("terms").cast("long").alias("n_term"))
