"""Language identification by interpolated Kneser-Ney character models, one per language.

Symbols are letters as they are (lower case), and one symbol for runs of anything else. Spark counts the 4-grams of all
training documents into a table; lower orders use continuation counts, which follow from the distinct 4-grams. Models are
sorted arrays of 64-bit n-gram hashes with a column of log probabilities for each language. The language of lowest
cross-entropy per symbol wins. A document is marked as rejected if its cross-entropy is above what its language's own
training documents show.

No model is cut to fit: if all of them together exceed a fixed number of cells they are looked up in passes over the
documents, each with some of the languages or, of a large one, with the n-grams of some second-last letters. All that a
4-gram's probability needs has that letter in common, so the sums over the passes are the sums over the whole models.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyflow.llm.common import document_key, fold, materialize, narrow, table, text_rows, whole

BITS = 21  # of a code point: three fit an exact key of 63 bits
PAIR, TRIPLE = (1 << 2 * BITS) - 1, (1 << 3 * BITS) - 1
#: Symbols from which on more text doesn't make a prediction surer.
SURE_AT = 40
NONE = "und"
#: Counts times languages of one pass: 64 MB of log probabilities.
CELLS = 1 << 24
#: Unseen letters share what is left of the lowest order evenly: as many as there are code points.
LETTERS = sys.maxunicode + 1


def symbol_table() -> np.ndarray:
    """Symbol of each code point: the lower-case letter, or 0 for what isn't a letter."""
    out = np.zeros(LETTERS, dtype=np.int64)
    for cp in range(LETTERS):
        c = chr(cp)
        if c.isalpha():
            out[cp] = ord(c.lower()[0])
    return out


_symbols: list[np.ndarray] = []


def symbols() -> np.ndarray:
    if not _symbols:
        _symbols.append(symbol_table())
    return _symbols[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(first three symbols as one key, fourth symbol) at each symbol after the first; none without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    at = symbols()[points]
    at = at[(at != 0) | (np.concatenate([[1], at[:-1]]) != 0)]
    if not at.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if at[0] == 0:
        at = at[1:]
    if at[-1] != 0:
        at = np.append(at, 0)
    line = np.concatenate([[0, 0, 0], at])
    return line[:-3] << 2 * BITS | line[1:-2] << BITS | line[2:-1], at


def key4(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of a 4-gram."""
    mixed = context.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def key3(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The last three symbols of a 4-gram."""
    return (context & PAIR) << BITS | last


def found_at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each wanted key is among the sorted keys, where)."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in order, sum of the values of each, number of each)."""
    distinct, at, seen = np.unique(keys, return_inverse=True, return_counts=True)
    return distinct, np.bincount(at, weights=values, minlength=len(distinct)), seen


@dataclass
class Order:
    """One order of a language's model: log probabilities of its seen n-grams, log weights of the order below per context."""

    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray, lower: np.ndarray, cut: float) -> Order:
        """From n-grams in order of their keys, their contexts, and the log probabilities of the order below."""
        distinct, totals, seen = _grouped(contexts, counts)
        at = np.searchsorted(distinct, contexts)
        weight = cut * seen / totals
        p = np.maximum(counts - cut, 0) / totals[at] + weight[at] * np.exp(lower)
        return cls(keys, np.log(p), distinct, np.log(weight))

    def weight(self, contexts: np.ndarray) -> np.ndarray:
        found, at = found_at(self.contexts, contexts)
        return np.where(found, self.weights[at] if len(self.weights) else 0.0, 0.0)


@dataclass
class Language:
    """A language's model, or the part of it with some second-last symbols."""

    orders: list[Order]  # 2, 3 and 4
    letters: np.ndarray
    letter_logs: np.ndarray
    other: float

    @classmethod
    def of(cls, context: np.ndarray, last: np.ndarray, n: np.ndarray, ones: np.ndarray, one_counts: np.ndarray, cuts: list[float]) -> Language:
        """From distinct 4-grams and their counts; ``ones`` are all letters with the number of letters before each, and
        ``cuts`` the discounts of the orders, both of the whole language."""
        total = one_counts.sum()
        rest = np.log(cuts[0] * len(ones) / total / LETTERS)
        model = cls([], ones, np.logaddexp(np.log(np.maximum(one_counts - cuts[0], 1e-300) / total), rest), rest)
        full = key4(context, last)
        three, three_counts = np.unique(key3(context, last), return_counts=True)
        two, two_counts = np.unique(three & PAIR, return_counts=True)
        model.orders.append(Order.of(two, two_counts, two >> BITS, model.below(two & ((1 << BITS) - 1), 0), cuts[1]))
        model.orders.append(Order.of(three, three_counts, three >> BITS, model.below(three & PAIR, 1), cuts[2]))
        by = np.argsort(full)
        lower = model.below(key3(context, last)[by], 2)
        model.orders.append(Order.of(full[by], n[by], context[by], lower, cuts[3]))
        return model

    def below(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Log probabilities of n-grams of ``order`` + 1 symbols (up to three), seen or not."""
        if order == 0:
            found, at = found_at(self.letters, keys)
            return np.where(found, self.letter_logs[at] if len(self.letters) else 0.0, self.other)
        held = self.orders[order - 1]
        found, at = found_at(held.keys, keys)
        out = np.where(found, held.logs[at] if len(held.logs) else 0.0, 0.0)
        unseen = np.flatnonzero(~found)
        if len(unseen):
            shorter = keys[unseen] & ((1 << order * BITS) - 1)
            out[unseen] = held.weight(keys[unseen] >> BITS) + self.below(shorter, order - 1)
        return out

    def logs(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log probabilities of 4-grams."""
        held = self.orders[2]
        found, at = found_at(held.keys, key4(context, last))
        out = np.where(found, held.logs[at] if len(held.logs) else 0.0, 0.0)
        unseen = np.flatnonzero(~found)
        if len(unseen):
            out[unseen] = held.weight(context[unseen]) + self.below(key3(context[unseen], last[unseen]), 2)
        return out


@dataclass
class Models:
    """Some languages, or parts of them, with one table of all seen 4-grams. A part is about the second-last symbols
    ``seconds`` or, the last of a language, about all but those."""

    names: list[str]
    languages: list[Language]
    keys: np.ndarray
    known: np.ndarray
    seconds: np.ndarray | None = None
    last: bool = False

    @classmethod
    def of(cls, languages: dict[str, Language], grams: list[tuple[np.ndarray, np.ndarray]], seconds: np.ndarray | None = None, last: bool = False) -> Models:
        context, symbol = (np.concatenate(x) for x in zip(*grams))
        keys, first = np.unique(key4(context, symbol), return_index=True)
        known = np.stack([m.logs(context[first], symbol[first]) for m in languages.values()], axis=1)
        return cls(list(languages), list(languages.values()), keys, known.astype(np.float32), seconds, last)

    def sums(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Sum of the log probabilities under each language, over the 4-grams that this pass is about."""
        if self.seconds is not None:
            own = found_at(self.seconds, context & ((1 << BITS) - 1))[0] != self.last
            context, last = context[own], last[own]
        total = np.zeros(len(self.names))
        for start in range(0, len(last), 1 << 20):
            part = slice(start, start + (1 << 20))
            found, at = found_at(self.keys, key4(context[part], last[part]))
            total += self.known[at[found]].sum(axis=0, dtype=np.float64)
            rest = np.flatnonzero(~found)
            if len(rest):
                total += [m.logs(context[part][rest], last[part][rest]).sum() for m in self.languages]
        return total


def best_of(names: list[str], entropy: np.ndarray, size: int) -> tuple[str, float, float]:
    """(language, score, cross-entropy) of the lowest cross-entropy; ties go to the first name."""
    best = int(np.argmin(entropy))
    odds = np.exp((entropy[best] - entropy) * min(size, SURE_AT))
    return names[best], float(1 / odds.sum()), float(entropy[best])


# --- training --------------------------------------------------------------------------------------------------------


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, context, last, n): 4-grams over all rows of ``docs`` (lang, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches, size=2_000_000):  # sorting takes some fifty bytes a symbol
            by: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                by.setdefault(lang, []).append(grams(text))
            for lang, parts in by.items():
                context, last = (np.concatenate(x) for x in zip(*parts))
                _, first, n = np.unique(key4(context, last), return_index=True, return_counts=True)
                columns = [pa.array([lang] * len(first), pa.string()), pa.array(context[first]), pa.array(last[first]), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "context", "last", "n"])

    counted = docs.mapInArrow(work, "lang string, context long, last long, n long")
    return counted.groupBy("lang", "context", "last").agg(F.sum("n").alias("n"))


@dataclass
class Training:
    """The stored counts, and per language what its parts share: discounts, and the letters with what comes before them."""

    counts: DataFrame
    cuts: dict[str, list[float]]
    letters: DataFrame
    sizes: dict[str, int]

    @classmethod
    def of(cls, docs: DataFrame) -> Training:
        counts = materialize(count_grams(docs), "language-grams")
        three = F.shiftleft(F.col("context").bitwiseAND(F.lit(PAIR)), BITS).bitwiseOR(F.col("last"))
        threes = counts.groupBy("lang", three.alias("key")).agg(F.count(F.lit(1)).alias("n"))
        twos = threes.groupBy("lang", F.col("key").bitwiseAND(F.lit(PAIR)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        ones = twos.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << BITS) - 1)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        letters = materialize(ones, "language-letters")
        orders = [letters, twos, threes, counts]
        seen = [
            t.groupBy("lang").agg(
                F.lit(k).alias("order"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
                F.count(F.lit(1)).alias("size"),
            )
            for k, t in enumerate(orders)
        ]
        cuts: dict[str, list[float]] = {}
        sizes: dict[str, int] = {}
        for r in seen[0].union(seen[1]).union(seen[2]).union(seen[3]).collect():  # four rows a language
            cut = r["once"] / (r["once"] + 2 * r["twice"]) if r["once"] else 0.5
            cuts.setdefault(r["lang"], [0.5] * 4)[r["order"]] = cut
            if r["order"] == 3:
                sizes[r["lang"]] = r["size"]
        return cls(counts, cuts, letters, sizes)

    def passes(self) -> Iterator[tuple[list[str], list[int] | None, bool]]:
        """(languages, second-last symbols or None for all, whether all but those are meant): counts times languages stay
        below CELLS, or it is one letter."""
        together: list[str] = []
        for lang in sorted(self.sizes, key=lambda x: x.encode()):
            if self.sizes[lang] > CELLS:
                second = F.col("context").bitwiseAND(F.lit((1 << BITS) - 1)).alias("second")
                parts, held, done = [], 0, []
                rows = self.counts.filter(F.col("lang") == lang).groupBy(second).agg(F.count(F.lit(1)).alias("n"))
                for r in rows.orderBy("second").collect():  # a row a letter
                    if parts and held + r["n"] > CELLS:
                        yield [lang], parts, False
                        done += parts
                        parts, held = [], 0
                    parts.append(r["second"])
                    held += r["n"]
                yield [lang], done, True  # and what training doesn't have
                continue
            if together and (sum(self.sizes[x] for x in together) + self.sizes[lang]) * (len(together) + 1) > CELLS:
                yield together, None, False
                together = []
            together.append(lang)
        if together:
            yield together, None, False

    def models(self, languages: list[str], seconds: list[int] | None, last: bool) -> Models:
        rows = self.counts.filter(F.col("lang").isin(languages))
        if seconds is not None:
            rows = rows.filter(F.col("context").bitwiseAND(F.lit((1 << BITS) - 1)).isin(seconds) != F.lit(last))
        held = rows.toArrow().to_pandas()
        ones = self.letters.filter(F.col("lang").isin(languages)).toPandas()
        made, seen = {}, []
        for lang in languages:
            own, letters = held[held["lang"] == lang], ones[ones["lang"] == lang].sort_values("key")
            part = own["context"].to_numpy(np.int64), own["last"].to_numpy(np.int64)
            seen.append(part)
            made[lang] = Language.of(
                *part, own["n"].to_numpy(np.float64), letters["key"].to_numpy(np.int64), letters["n"].to_numpy(np.float64), self.cuts[lang]
            )
        return Models.of(made, seen, None if seconds is None else np.array(sorted(seconds), dtype=np.int64), last)


# --- prediction ------------------------------------------------------------------------------------------------------

_MADE = "lang_pred string, score double, entropy double"


def _predicted(rows: DataFrame, models: Models) -> DataFrame:
    """All languages in one pass."""
    kinds = dict(rows.dtypes)
    carried = [c for c in rows.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            found = []
            for text in texts:
                context, last = grams(text)
                size = len(last)
                found.append(best_of(models.names, -models.sums(context, last) / size, size) if size else (NONE, 0.0, None))
            made = [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*map(batch.column, carried), *made], names=[*carried, "lang_pred", "score", "entropy"])

    return rows.mapInArrow(work, ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), _MADE]))


def _predicted_in_passes(rows: DataFrame, training: Training) -> DataFrame:
    """The same from the sums of several passes, which meet by document."""
    keyed = rows.withColumn("key", document_key("doc_id", F.md5(whole("text"))))
    sums = None
    for part in training.passes():
        models = training.models(*part)

        def work(batches: Iterator[pa.RecordBatch], models: Models = models) -> Iterator[pa.RecordBatch]:
            for batch, texts in text_rows(batches):
                keys, names, values, sizes = [], [], [], []
                for key, text in zip(batch.column("key").to_pylist(), texts):
                    context, last = grams(text)
                    if len(last):
                        keys += [key] * len(models.names)
                        names += models.names
                        values += models.sums(context, last).tolist()
                        sizes += [len(last)] * len(models.names)
                types = (pa.binary(), pa.string(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((keys, names, values, sizes), types)], names=["key", "name", "total", "size"])

        each = keyed.select("key", "text").dropDuplicates(["key"]).mapInArrow(work, "key binary, name string, total double, size long")
        each = materialize(each, "language-sums")
        sums = each if sums is None else sums.union(each)
    each = sums.groupBy("key", "name").agg(F.sum("total").alias("total"), F.max("size").alias("size"))
    each = each.withColumn("entropy", -F.col("total") / F.col("size"))
    least = F.min(F.struct("entropy", "name")).over(Window.partitionBy("key"))  # a row a language
    odds = F.exp((F.col("least.entropy") - F.col("entropy")) * F.least("size", F.lit(SURE_AT)))
    best = each.withColumn("least", least).groupBy("key").agg(F.first("least").alias("least"), (1 / F.sum(odds)).alias("score"))
    joined = keyed.join(best, "key", "left")
    return joined.select(
        *[c for c in rows.columns if c != "text"], F.coalesce("least.name", F.lit(NONE)).alias("lang_pred"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.col("least.entropy").alias("entropy"),
    )


def predictions(rows: DataFrame, training: Training) -> DataFrame:
    """``rows`` (doc_id, text and others) without the text, with lang_pred, score and entropy."""
    passes = list(training.passes())
    if not passes:
        nothing = rows.withColumns({"lang_pred": F.lit(NONE), "score": F.lit(0.0), "entropy": F.lit(None).cast("double")})
        return nothing.drop("text")
    if len(passes) == 1:
        return _predicted(rows, training.models(*passes[0]))
    return _predicted_in_passes(rows, training)


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", reject_sd: float = 3.0
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected and entropy of every row.

    The models learn from rows outside the held-out third whose language isn't null. A null text or one without a letter
    is ``und`` with score 0 and no entropy. If nothing can be learned every row is ``und``. Repeated rows count as often as
    they occur in training and are predicted alike; no rows in, no rows out. Further columns are not returned. A row is
    rejected if its entropy is more than ``reject_sd`` deviations above the mean of the rows its language learned from.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col)
    learn = rows.filter((fold("doc_id", 3) != 1) & F.col("lang").isNotNull()).select("lang", "text")
    training = Training.of(learn)
    own = F.when(fold("doc_id", 3) != 1, F.col("lang")).alias("own")  # only the limits of rejection read it
    found = materialize(predictions(rows.select("doc_id", own, "text"), training), "languages")
    limits = found.filter("own = lang_pred").groupBy(F.col("own").alias("of")).agg(
        (F.avg("entropy") + F.lit(reject_sd) * F.stddev_pop("entropy")).alias("limit")
    )
    marked = found.join(limits, F.col("lang_pred") == F.col("of"), "left")
    rejected = F.col("entropy").isNull() | F.coalesce(F.col("entropy") > F.col("limit"), F.lit(False))
    return marked.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", rejected.alias("rejected"), "entropy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))
