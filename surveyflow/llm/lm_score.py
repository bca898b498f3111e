"""Language-model scores from a probabilistic suffix tree over the bytes of normalised text.

A text is its words, lower-cased (A-Z), each closed by a space and the last by the end symbol. Spark counts every
sequence of ``depth`` bytes and the one that follows, over all training documents; counts of shorter contexts are sums
of those. A context is a state of the tree if it occurs ``fewest`` times and what follows it differs enough from what
follows its suffix without the first byte (or if a longer state ends in it). Next-byte distributions are smoothed
towards that suffix, and a byte is scored in the longest state that its past ends in.

Both tests are of absolute counts, so the tree grows with the corpus. It is a table: the probability of each distinct
n-gram follows from joins, level by level, of at most 256 rows a context. N-grams of at least the part ``frequent`` of
all occurrences, or else the ``grams_held`` most frequent ones (but at most 1 / frequent), are looked up in memory, all
others by a shuffled join. So are words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyflow.llm.common import fold, materialize, narrow, table, text_rows

END = b"\n"  # not part of any word
SYMBOLS = 256
#: Bytes of text that a task works on at once; longer texts are looked up in slices of as many places.
SLICE = 2_000_000
#: Bytes of counts that a task holds before it adds them up; what is more than half of it then is handed on.
PENDING = 48_000_000
BLANK = np.isin(np.arange(SYMBOLS), list(b" \t\n\v\f\r"))


@dataclass(frozen=True)
class TreeRule:
    #: Longest context in bytes, 6 at most: context and next byte are packed into a positive 64-bit number.
    depth: int = 5
    #: Least number of occurrences that a state has.
    fewest: int = 2
    #: Least part of all occurrences that a state has; above 0 the tree stops growing with the corpus.
    least: float = 0.0
    #: Least gain, in nats over all its occurrences, that a context's own distribution brings.
    gain: float = 3.0
    #: Words with at least this part of all tokens are looked up in memory (at most 1 / common of them), others by a join.
    common: float = 1e-6
    #: N-grams with at least this part of all occurrences are looked up in memory, others by a join.
    frequent: float = 2.5e-7
    #: So many of the most frequent words and n-grams are looked up in memory in any case, within the bounds above.
    words_held: int = 250_000
    grams_held: int = 1_000_000


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def packed(lines: list[bytes], depth: int) -> np.ndarray:
    """Context and byte at each place of all lines, each line being preceded by end symbols only."""
    sizes = np.array([len(line) for line in lines], dtype=np.int64)
    return np.concatenate([np.empty(0, np.int64), *(gram for _, gram in packed_slices(b"".join(lines), sizes, depth))])


def packed_slices(octets: bytes, sizes: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray]]:
    """``packed`` of lines that lie one after the other, none of them empty, in slices with their first place."""
    before = END * 7 + octets
    firsts = np.cumsum(sizes) - sizes
    for start in range(0, len(octets), SLICE):
        stop = min(start + SLICE, len(octets))
        gram = np.ndarray(stop - start, ">i8", before, start, strides=(1,)).astype(np.int64)  # a byte and the seven before it
        gram &= (1 << 8 * (depth + 1)) - 1
        for k in range(depth):  # what lies before a line is the line above it
            at = firsts[sizes > k] + k
            at = at[(at >= start) & (at < stop)] - start
            own = (1 << 8 * (k + 1)) - 1
            gram[at] = gram[at] & own | int.from_bytes(END * (depth + 1), "big") & ~own
        yield start, gram


def line_of(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


@dataclass
class Lines:
    """``line_of`` the ``words_of`` many texts, and where each of their words is among the distinct ones."""

    octets: bytes
    sizes: np.ndarray  # of the lines
    words: np.ndarray  # of each line, how many
    distinct: pa.Array
    codes: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Lines:
        stripped = [text.encode("utf-8", "surrogatepass").strip() for text in texts]
        raw = np.frombuffer(END.join([*stripped, b""]).lower(), dtype=np.uint8)
        blank = BLANK[raw]
        letter = ~blank
        ends = np.cumsum([len(text) + 1 for text in stripped], dtype=np.int64) - 1
        lasts = np.flatnonzero(letter[:-1] & blank[1:])  # of each word
        firsts = np.flatnonzero(letter & np.concatenate([[True], blank[:-1]]))
        offsets = np.concatenate([[0], np.cumsum(lasts - firsts + 1)])
        letters = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lasts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[letter])])
        encoded = letters.dictionary_encode()
        before = np.searchsorted(lasts, ends)
        words = np.diff(before, prepend=0)
        keep = letter.copy()
        keep[lasts + 1] = True
        keep[ends] = True
        octets = np.where(blank, np.uint8(ord(" ")), raw)
        octets[ends] = ord(END)
        # a word brings its letters and what closes it, a line without words its end
        sizes = np.maximum(np.diff(offsets[before], prepend=0) + words, 1)
        return cls(octets[keep].tobytes(), sizes, words, encoded.dictionary.cast(pa.binary()), encoded.indices.to_numpy())

    def counted(self, held: np.ndarray) -> pa.Table:
        """(word, n) of the lines that aren't ``held``; the end symbol counts as a word."""
        n = np.bincount(self.codes[np.repeat(~held, self.words)], minlength=len(self.distinct))
        ends = int(np.sum(~held))
        found = pa.table({"word": pa.concat_arrays([self.distinct, pa.array([END], pa.binary())]), "n": np.append(n, ends)})
        return found.filter(pa.array(np.append(n, ends) > 0))

    def grams(self, held: np.ndarray, depth: int) -> Iterator[pa.Table]:
        """(gram, n, seen) of each slice, ``n`` being of the lines that aren't ``held``."""
        apart = np.repeat(held, self.sizes)
        for start, gram in packed_slices(self.octets, self.sizes, depth):
            for out in (False, True):
                part, seen = np.unique(gram[apart[start : start + len(gram)] == out], return_counts=True)
                yield pa.table({"gram": part, "n": np.zeros_like(seen) if out else seen, "seen": seen})


@dataclass
class Tally:
    """Counts by ``key``; equal keys of a task are added up, as long as those that differ are few enough."""

    key: str
    parts: list[pa.Table] = field(default_factory=list)

    def add(self, part: pa.Table) -> Iterator[pa.Table]:
        """What is to be handed on so that the rest is bounded."""
        self.parts.append(part)
        if sum(p.nbytes for p in self.parts) > PENDING:
            self.parts = [*self.rest()]
            if self.parts[0].nbytes > PENDING // 2:
                yield self.parts.pop()

    def rest(self) -> Iterator[pa.Table]:
        if self.parts:
            names = [name for name in self.parts[0].column_names if name != self.key]
            sums = pa.concat_tables(self.parts).group_by(self.key, use_threads=False).aggregate([(name, "sum") for name in names])
            yield sums.select([self.key, *(f"{name}_sum" for name in names)]).rename_columns([self.key, *names])


def task_counts(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """(word, gram, n, seen) of a task's texts, either word or gram being null."""

    def rows(counts: pa.Table) -> list[pa.RecordBatch]:
        columns = {name: counts.column(name) for name in counts.column_names}
        columns = {"word": pa.nulls(len(counts), pa.binary()), "gram": pa.nulls(len(counts), pa.int64()), "seen": counts.column("n")} | columns
        return pa.table(columns).select(["word", "gram", "n", "seen"]).to_batches(max_chunksize=1 << 16)

    words, grams = Tally("word"), Tally("gram")
    for batch, texts in text_rows(batches, size=SLICE):
        lines, held = Lines.of(texts), np.array(batch.column("held").to_pylist(), dtype=bool)
        for counts in words.add(lines.counted(held)):
            yield from rows(counts)
        for part in lines.grams(held, depth):
            for counts in grams.add(part):
                yield from rows(counts)
    for counts in (*words.rest(), *grams.rest()):
        yield from rows(counts)


def corpus_counts(docs: DataFrame, rule: TreeRule) -> tuple[DataFrame, DataFrame]:
    """(word, n) and (gram, n, seen) over all rows of ``docs`` (text); the end symbol counts as a word.

    Rows whose column ``held`` is true, if there is one, add to ``seen`` only, and their words aren't counted.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return task_counts(batches, rule.depth)

    rows = docs.select("text", "held" if "held" in docs.columns else F.lit(False).alias("held"))
    counted = rows.mapInArrow(work, "word binary, gram bigint, n bigint, seen bigint").groupBy("word", "gram").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    stored = materialize(counted, "lm-counts")
    return stored.filter("word IS NOT NULL").select("word", "n"), stored.filter("word IS NULL").select("gram", "n", "seen")


def suffix(length: int) -> Column:
    """The last ``length`` bytes of ``context``."""
    return F.col("context").bitwiseAND(F.lit((1 << 8 * length) - 1).cast("long"))


def level_counts(grams: DataFrame, rule: TreeRule) -> list[DataFrame]:
    """For each context length from 0 on: (context, symbol, n) of all n-grams, also those that training doesn't have."""
    levels = [grams.select(F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND(255).cast("int").alias("symbol"), "n")]
    for length in range(rule.depth - 1, -1, -1):
        shorter = levels[-1].groupBy(suffix(length).alias("context"), "symbol").agg(F.sum("n").alias("n"))
        levels.append(materialize(shorter, "lm-level"))
    return levels[::-1]


def known_levels(levels: list[DataFrame], rule: TreeRule) -> list[DataFrame]:
    """For each context length: (context, symbol, n, total, gain) of contexts that are frequent enough."""
    same = Window.partitionBy("context")  # at most 256 rows
    trained = [level.filter("n > 0").withColumn("total", F.sum("n").over(same)) for level in levels]
    everything = levels[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = [trained[0].withColumn("gain", F.lit(0.0))]
    for length in range(1, rule.depth + 1):
        known = trained[length].filter(F.col("total") >= max(rule.fewest, rule.least * everything))
        above = trained[length - 1].select(
            F.col("context").alias("suffix"), F.col("symbol").alias("next"), (F.col("n") / F.col("total")).alias("p")
        )
        held = known.join(above, (suffix(length - 1) == F.col("suffix")) & (F.col("symbol") == F.col("next")))
        gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("p"))).over(same)
        out.append(held.withColumn("gain", gain).select("context", "symbol", "n", "total", "gain"))
    return out


def tree_levels(grams: DataFrame, rule: TreeRule) -> list[DataFrame]:
    return known_levels(level_counts(grams, rule), rule)


def tree_states(known: list[DataFrame], rule: TreeRule) -> list[DataFrame]:
    """For each context length from 1 on: (context, total, kinds) of the states, with how many symbols follow each."""
    states: list[DataFrame] = []
    for length in range(rule.depth, 0, -1):
        each = known[length].groupBy("context").agg(F.max("total").alias("total"), F.count(F.lit(1)).alias("kinds"), F.max("gain").alias("gain"))
        chosen = F.col("gain") >= rule.gain
        if states:  # suffixes of longer states are states
            longer = states[-1].select(suffix(length).alias("context")).distinct().withColumn("ends", F.lit(True))
            each = each.join(longer, "context", "left")
            chosen = chosen | F.col("ends")
        states.append(materialize(each.filter(chosen).select("context", "total", "kinds"), "lm-states"))
    return states[::-1]


def gram_values(grams: DataFrame, rule: TreeRule) -> DataFrame:
    """(gram, seen, value) of every row of ``grams``: log10 probability of its last byte in the longest state before it."""
    levels = level_counts(grams, rule)
    states = tree_states(known_levels(levels, rule), rule)
    root = np.full(SYMBOLS, 0.5)
    for symbol, n in levels[0].select("symbol", "n").collect():  # at most 256 rows
        root[symbol] += n
    p = levels[0].select("context", "symbol", F.array(*map(F.lit, (root / root.sum()).tolist()))[F.col("symbol")].alias("p"))
    for length in range(1, rule.depth + 1):
        below = p.select(F.col("context").alias("suffix"), F.col("symbol").alias("next"), F.col("p").alias("below"))
        cells = levels[length].join(states[length - 1], "context", "left")
        cells = cells.join(below, (suffix(length - 1) == F.col("suffix")) & (F.col("symbol") == F.col("next")))
        # Witten-Bell: as much for the suffix as there are kinds of followers
        own = (F.col("n") + F.col("kinds") * F.col("below")) / (F.col("total") + F.col("kinds"))
        p = cells.select("context", "symbol", F.coalesce(own, "below").alias("p"))
    values = p.select(F.shiftleft("context", 8).bitwiseOR(F.col("symbol").cast("long")).alias("gram"), F.log10("p").alias("value"))
    return materialize(grams.select("gram", "seen").join(values, "gram"), "lm-values")


@dataclass
class Frequent:
    """N-grams, the most frequent first, and their log10 probability."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Frequent:
        keys, values, seen = (rows.column(name).to_numpy() for name in ("gram", "value", "seen"))
        order = np.lexsort((keys, -seen))
        return cls(keys[order], values[order])

    @cached_property
    def slots(self) -> np.ndarray:
        """For each slot the place of an n-gram, -1 if it is free: an n-gram whose slot is taken goes to the next free one."""
        slots = np.full(1 << max(10, (2 * len(self.keys)).bit_length()), -1, dtype=np.int32)
        rest = np.arange(len(self.keys), dtype=np.int32)
        at = self._first(self.keys, slots)
        while len(rest):
            free = slots[at] < 0
            slots[at[free][::-1]] = rest[free][::-1]
            left = slots[at] != rest
            rest, at = rest[left], (at[left] + 1) & (len(slots) - 1)
        return slots

    @staticmethod
    def _first(gram: np.ndarray, slots: np.ndarray) -> np.ndarray:
        return ((gram.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - len(slots).bit_length())).view(np.int64)

    def log10_each(self, gram: np.ndarray) -> np.ndarray:
        """The value of each n-gram, NaN for those that aren't here."""
        if not len(self.keys):
            return np.full(len(gram), np.nan)
        at = self._first(gram, self.slots)
        place = self.slots[at]
        rest = np.flatnonzero(self.keys[place] != gram)
        at = at[rest]
        while len(rest):  # in the next slot, up to a free one
            taken = place[rest] >= 0
            rest, at = rest[taken], (at[taken] + 1) & (len(self.slots) - 1)
            place[rest] = self.slots[at]
            other = self.keys[place[rest]] != gram[rest]
            rest, at = rest[other], at[other]
        return np.where(place >= 0, self.values[place], np.nan)


@dataclass
class SuffixTree:
    """The tree in memory, which small ones fit into; it gives the same values as ``gram_values``.

    By context length: sorted states with the log weight of their suffix, and sorted (context, byte) with log10 probability.
    """

    depth: int
    root: np.ndarray
    states: list[np.ndarray]
    weights: list[np.ndarray]
    keys: list[np.ndarray]
    values: list[np.ndarray]

    @classmethod
    def of(cls, levels: list[pa.Table], rule: TreeRule) -> SuffixTree:
        root = np.full(SYMBOLS, 0.5)
        root[levels[0].column("symbol").to_numpy()] += levels[0].column("n").to_numpy()
        tree = cls(rule.depth, np.log10(root / root.sum()), [], [], [], [])
        frames = [level.to_pandas() for level in levels[1:]]
        chosen: list[np.ndarray] = [np.empty(0, np.int64)] * (rule.depth + 1)
        for length in range(rule.depth, 0, -1):
            frame = frames[length - 1]
            own = frame.loc[frame["gain"] >= rule.gain, "context"].to_numpy()
            longer = chosen[length] & ((1 << 8 * length) - 1)  # suffixes of longer states are states
            chosen[length - 1] = np.unique(np.concatenate([own, longer]))
        for length in range(1, rule.depth + 1):
            frame, states = frames[length - 1], chosen[length - 1]
            frame = frame[np.isin(frame["context"].to_numpy(), states)]
            total = frame.drop_duplicates("context").set_index("context")["total"].reindex(states).to_numpy(np.float64)
            seen = frame[frame["n"].notna()]
            context = seen["context"].to_numpy(np.int64)
            symbol, n = seen["symbol"].to_numpy(np.int64), seen["n"].to_numpy(np.float64)
            at = np.searchsorted(states, context)
            kinds = np.bincount(at, minlength=len(states))
            held = np.bincount(at, weights=n, minlength=len(states))
            # Witten-Bell: as much for the suffix as there are kinds of followers
            weight = (np.maximum(kinds, 1) + total - held) / (total + np.maximum(kinds, 1))
            below = 10 ** tree.log10((context & ((1 << 8 * (length - 1)) - 1)) << 8 | symbol, length - 1)
            p = n / (total + np.maximum(kinds, 1))[at] + weight[at] * below
            order = np.argsort(context << 8 | symbol)
            tree.states.append(states)
            tree.weights.append(np.log10(weight))
            tree.keys.append((context << 8 | symbol)[order])
            tree.values.append(np.log10(p)[order])
        return tree

    def log10(self, gram: np.ndarray, longest: int | None = None) -> np.ndarray:
        """log10 probability of the last byte of each gram in the longest state of at most ``longest`` bytes."""
        out = np.zeros(len(gram))
        rest = np.arange(len(gram))
        for length in range(self.depth if longest is None else longest, 0, -1):
            if not len(rest) or not len(self.states[length - 1]):
                continue
            key = gram[rest] & ((1 << 8 * (length + 1)) - 1)
            keys, states = self.keys[length - 1], self.states[length - 1]
            found = np.zeros(len(rest), dtype=bool)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                found = keys[at] == key
                out[rest[found]] += self.values[length - 1][at[found]]
            rest, key = rest[~found], key[~found]
            at = np.minimum(np.searchsorted(states, key >> 8), len(states) - 1)
            inside = states[at] == key >> 8
            out[rest[inside]] += self.weights[length - 1][at[inside]]
        out[rest] += self.root[gram[rest] & 255]
        return out


def often(rows: DataFrame, count: str, part: float, held: int) -> Column:
    """Whether ``count`` is at least the ``part`` of all counts, or one of the highest that ``held`` rows and 1 / part have.

    For the latter, counts are told apart by eighths of a power of two, of which there are a few hundred.
    """
    total = rows.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    step = F.floor(8 * F.log2(count))
    sizes = dict(rows.groupBy(step.alias("step")).count().collect())
    lowest, most = 1 << 32, min(held, 1 / part) if part else held
    for each in sorted(sizes, reverse=True):
        most -= sizes[each]
        if most < 0:
            break
        lowest = each
    return (F.col(count) >= part * total) | (step >= lowest)


def repeats(line: np.ndarray, gram: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of each line, where each line's begin and the last ones end, and how often each occurs."""
    order = np.lexsort((gram, line))
    line, gram = line[order], gram[order]
    heads = np.flatnonzero(np.diff(line, prepend=-1).astype(bool) | np.diff(gram, prepend=-1).astype(bool))
    return gram[heads], np.searchsorted(line[heads], np.arange(lines + 1)), np.diff(heads, append=len(gram))


def score_rows(docs: DataFrame, frequent: Frequent, common: pa.Table, tokens: int, kinds: int, ends: int, rule: TreeRule) -> DataFrame:
    """doc_id, n_tokens, n_known and base of the common tokens, score of the frequent n-grams, and what else each row has.

    That is the other words (``rare``) and n-grams (``odd``), and how many times each occurs.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    norm = np.log10(tokens + 0.5 * (kinds + 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(zip(common.column("word").to_pylist(), (np.log10(common.column("n").to_numpy() + 0.5) - norm).tolist()))
        at_end = float(np.log10(ends + 0.5) - norm)
        for batch, texts in text_rows(batches, size=SLICE):
            lines = Lines.of(texts)
            ended = np.cumsum(lines.sizes)
            each, others = np.empty(len(lines.octets)), []
            for start, gram in packed_slices(lines.octets, lines.sizes, rule.depth):
                value = frequent.log10_each(gram)
                missing = np.flatnonzero(np.isnan(value))
                value[missing] = 0
                each[start : start + len(gram)] = value
                others.append(repeats(np.searchsorted(ended, start + missing, side="right"), gram[missing], len(texts)))
            score = np.add.reduceat(each, ended - lines.sizes)
            odd, times = (np.concatenate([other[k] for other in others]) for k in (0, 2))
            odd_offsets = sum(other[1] for other in others)  # later slices have later lines

            log = np.array([known.get(word, np.nan) for word in lines.distinct.to_pylist()], dtype=np.float64)[lines.codes]
            unknown = np.flatnonzero(np.isnan(log))
            stops = np.cumsum(lines.words)
            rare, rare_offsets, rare_times = repeats(np.searchsorted(stops, unknown, side="right"), lines.codes[unknown], len(texts))
            logs = log[~np.isnan(log)].tolist()
            of_line = np.concatenate([[0], stops - np.searchsorted(unknown, stops)])
            base = [math.fsum(logs[i:j]) + at_end for i, j in pairwise(of_line.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(lines.words + 1), pa.array(np.diff(of_line) + (ends > 0)), pa.array(base, pa.float64()), pa.array(score),
                pa.ListArray.from_arrays(rare_offsets.astype(np.int32), lines.distinct.take(pa.array(rare))),
                pa.ListArray.from_arrays(rare_offsets.astype(np.int32), pa.array(rare_times.astype(np.int32))),
                pa.ListArray.from_arrays(odd_offsets.astype(np.int32), pa.array(odd)),
                pa.ListArray.from_arrays(odd_offsets.astype(np.int32), pa.array(times.astype(np.int32))),
            ], names=["doc_id", "n_tokens", "n_known", "base", "score", "rare", "rare_times", "odd", "times"])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, n_tokens bigint, n_known bigint, base double, score double, rare array<binary>, rare_times array<int>, odd array<bigint>, times array<int>"
    )


def lm_scores(docs: DataFrame, rule: TreeRule = TreeRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Trains on all rows outside the held-out fifth. A null text is an empty one and consists of its end only. Rows that
    repeat are scored alike and count each time in training. With nothing to train on, the base score gives the end all
    of the smoothed mass and the tree is uniform over bytes. No rows in, no rows out. Further columns are not returned.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    words, grams = corpus_counts(rows.withColumn("held", fold("doc_id", 5) == 1), rule)
    tokens, kinds, ends = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("n"))), F.lit(0))
    ).first()
    values = gram_values(grams, rule)
    frequent_gram = often(values, "seen", rule.frequent, rule.grams_held)
    frequent = Frequent.of(values.filter(frequent_gram).select("gram", "value", "seen").toArrow())  # at most 1 / rule.frequent n-grams
    usual = often(words, "n", rule.common, rule.words_held)
    common = words.filter(usual).toArrow()  # at most 1 / rule.common words

    scored = materialize(
        score_rows(rows, frequent, common, tokens, kinds, ends, rule).withColumn("row", F.monotonically_increasing_id()), "lm-scored"
    )
    c = F.coalesce("n", F.lit(0))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_times").alias("times"))
    rare = rare.join(words.filter(~usual), "word", "left").select(
        "row", F.col("times") * (F.log10(c + 0.5) - F.lit(float(np.log10(tokens + 0.5 * (kinds + 1))))), F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0), F.lit(0.0)
    )
    odd = scored.select("row", F.explode(F.arrays_zip("odd", "times")).alias("o")).select("row", F.col("o.odd").alias("gram"), F.col("o.times").alias("times"))
    odd = odd.join(values.filter(~frequent_gram), "gram").select("row", F.lit(0.0), F.lit(0), F.col("times") * F.col("value"))
    parts = rare.union(odd).toDF("row", "more", "known", "less")
    sums = parts.groupBy("row").agg(F.sum("more").alias("more"), F.sum("known").alias("known"), F.sum("less").alias("less"))
    joined = scored.select("row", "doc_id", "n_tokens", "n_known", "base", "score").join(sums, "row", "left")
    return joined.select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("less", F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
