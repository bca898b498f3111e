"""op7: lines, counts and lookups by whole arrays give what plain Python does, and a task hands on each n-gram once."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from surveyflow.llm import lm_score

ODD = ["", " \t\n\v\f\r", "A", "  Ab  c\n", "\x1cé É\x85中\x00", "x\n\ny  \r\nZ", "a" * 9]


def batch_of(texts, held):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(held)], names=["text", "held"])


def test_lines_are_those_of_single_texts():
    chance = random.Random(5)
    for texts in (ODD, *[["".join(chance.choices("aB \n\t\x1cé中", k=chance.randrange(12))) for _ in range(5)] for _ in range(300)]):
        lines = lm_score.Lines.of(texts)
        words = [lm_score.words_of(t) for t in texts]
        each = [lm_score.line_of(w) for w in words]
        assert lines.octets == b"".join(each)
        assert lines.sizes.tolist() == list(map(len, each))
        assert lines.words.tolist() == list(map(len, words))
        assert lines.distinct.take(pa.array(lines.codes)).to_pylist() == sum(words, [])


@pytest.mark.parametrize("pending", [48_000_000, 0])
def test_a_task_adds_its_counts_up(monkeypatch, pending):
    """In slices of a text each, with as many batches: the rows handed on are those that differ, if they are few enough."""
    monkeypatch.setattr(lm_score, "SLICE", 1)
    monkeypatch.setattr(lm_score, "PENDING", pending)
    texts, held = [*ODD, None] * 4, [k % 5 == 1 for k in range(4 * len(ODD) + 4)]
    batches = [batch_of(texts[k : k + 8], held[k : k + 8]) for k in range(0, len(texts), 8)]
    rows = pa.Table.from_batches(lm_score.task_counts(iter(batches), 3)).to_pylist()
    words, n, seen = Counter(), Counter(), Counter()
    for text, out in zip(texts, held):
        own = lm_score.words_of(text or "")
        line = lm_score.END * 3 + lm_score.line_of(own)
        grams = Counter(int.from_bytes(line[k : k + 4], "big") for k in range(len(line) - 3))
        seen += grams
        if not out:
            words.update([*own, lm_score.END])
            n += grams
    found = [Counter(), Counter(), Counter()]
    for row in rows:
        for counter, key, value in zip(found, (row["word"], row["gram"], row["gram"]), (row["n"], row["n"], row["seen"])):
            if key is not None:
                counter[key] += value
    assert [+c for c in found] == [words, n, seen]
    if pending:
        assert len(rows) == len(words) + len(seen)


def test_long_words_are_handed_on(monkeypatch):
    monkeypatch.setattr(lm_score, "PENDING", 10_000)
    tally = lm_score.Tally("word")
    parts = [pa.table({"word": pa.array([bytes([k]) * 1000], pa.binary()), "n": [1]}) for k in range(100)]
    out = [*(row for part in parts for row in tally.add(part)), *tally.rest()]
    assert sum(map(len, out)) == 100
    assert max(table.nbytes for table in out) < 12_000


@pytest.mark.parametrize("count", [0, 1, 5, 5000])
def test_frequent_ngrams_are_found_wherever_their_slot_is(count):
    chance = np.random.default_rng(2)
    keys = np.unique(chance.integers(0, 1 << 48, count))
    frequent = lm_score.Frequent.of(pa.table({"gram": keys, "value": np.arange(len(keys), dtype=float), "seen": chance.integers(1, 9, len(keys))}))
    asked = np.concatenate([keys, keys[::-1], chance.integers(0, 1 << 48, 5000)])
    known = dict(zip(keys.tolist(), range(len(keys))))
    expected = [known.get(gram, np.nan) for gram in asked.tolist()]
    assert np.array_equal(frequent.log10_each(asked), expected, equal_nan=True)
    same = lm_score.Frequent(keys, np.arange(len(keys), dtype=float))
    same._first = lambda gram, slots: np.full(len(gram), len(slots) - 1)  # all in one slot, the last
    assert count > 5 or np.array_equal(same.log10_each(asked), expected, equal_nan=True)


def test_repeats_of_each_line():
    gram, begun, times = lm_score.repeats(np.array([0, 0, 0, 2]), np.array([7, 5, 7, 7]), 4)
    assert (gram.tolist(), begun.tolist(), times.tolist()) == ([5, 7, 7], [0, 2, 2, 3, 3], [1, 2, 1])


@pytest.mark.parametrize(("part", "held", "expected"), [(0.2, 0, {8, 4}), (0.2, 3, {8, 4}), (0.2, 4, {8, 4, 2}), (0.2, 9, {8, 4, 2, 1}), (0.45, 9, {8, 4}), (0.45, 0, {8}), (2.0, 9, set()), (0.0, 0, {8, 4, 2, 1})])
def test_most_frequent_rows(spark, part, held, expected):
    rows = spark.createDataFrame([(n,) for n in (8, 4, 2, 2, 1)], "n bigint")
    assert {r["n"] for r in rows.filter(lm_score.often(rows, "n", part, held)).collect()} == expected


def test_rare_words_and_ngrams_count_each_time(spark):
    """Held in memory or joined, once or often in a text."""
    rows = [(k, text) for k, text in enumerate(["rare rare rare b", "b b rare only", "only", "", None, "b rare " * 50])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    joined, held = (
        sorted(lm_score.lm_scores(docs, lm_score.TreeRule(common=part, frequent=part, words_held=most, grams_held=most)).collect(), key=lambda r: r["doc_id"])
        for part, most in ((2.0, 0), (0.0, 100_000))
    )
    for one, other in zip(joined, held, strict=True):
        assert one[:5] == other[:5]
        assert one[5:] == pytest.approx(other[5:])
