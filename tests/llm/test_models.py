"""Language-model scores."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import edge_rows, frame
from surveyflow.llm import lm_score


def brute_base(rows):
    tokens = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in tokens]
    counts = Counter(w for h, (_, words) in zip(held, tokens) for w in words if not h)
    norm = math.log10(counts.total() + 0.5 * (len(counts) + 1))
    for h, (i, words) in zip(held, tokens):
        yield i, h, len(words), sum(w in counts for w in words), counts.total(), sum(math.log10(counts[w] + 0.5) - norm for w in words)


@pytest.mark.parametrize("common", [1e-6, 0.01])
def test_base_scores(spark, common):
    """Whether words are looked up in memory or joined doesn't matter."""
    rule = lm_score.TreeRule(common=common)
    found = sorted(
        ((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lm_score.lm_scores(frame(spark), rule).collect()),
        key=repr,
    )
    for row, expected in zip(found, sorted(brute_base(edge_rows()), key=repr), strict=True):
        assert row[:5] == expected[:5] and row[5] == pytest.approx(expected[5])


def test_lm_on_nothing(spark):
    assert lm_score.lm_scores(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    (only,) = lm_score.lm_scores(frame(spark, [(held, "held out", None, None)])).collect()  # nothing to learn from
    assert only["train_tokens"] == 0 and only["n_known"] == 0
    assert only["score"] == pytest.approx(len("held out\n") * math.log10(1 / 256))


def test_packed_contexts():
    grams = lm_score.packed([b"ab\n", b"\n", b"c\n"], 2)
    end = ord("\n")
    unpacked = [((g >> 16) & 255, (g >> 8) & 255, g & 255) for g in grams.tolist()]
    assert unpacked == [
        (end, end, ord("a")), (end, ord("a"), ord("b")), (ord("a"), ord("b"), end), (end, end, end), (end, end, ord("c")), (end, ord("c"), end),
    ]


def tree_of(spark, texts, rule):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    _, grams = lm_score.corpus_counts(df, rule)
    return lm_score.SuffixTree.of([x.toArrow() for x in lm_score.tree_levels(grams, rule)], rule)


def test_distributions_of_the_tree_sum_to_one(spark, small_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{small_dir}/documents.parquet").limit(60).collect()]
    rule = lm_score.TreeRule(depth=3, least=1e-4)
    tree = tree_of(spark, texts, rule)
    assert all(len(s) for s in tree.states)
    contexts = [*tree.states[2][:20].tolist(), *tree.states[1][:5].tolist(), 0x7A7A7A, 0]
    for context in contexts:
        grams = (np.int64(context) << 8) | np.arange(256)
        assert (10 ** tree.log10(grams)).sum() == pytest.approx(1)
    shorter = {s & 0xFFFF for s in tree.states[2].tolist()}
    assert shorter <= set(tree.states[1].tolist())  # suffixes of states are states


def test_divergence_decides_on_states(spark):
    """After a letter of a random text comes what comes anywhere; where q is always followed by u, q is a state."""
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcd"), 400)) for _ in range(20)]
    rule = lm_score.TreeRule(depth=1, gain=60.0)
    assert not {*map(ord, "abcd")} & {*tree_of(spark, texts, rule).states[0].tolist()}
    assert ord("q") in tree_of(spark, [*texts, *["qu" * 300] * 4], rule).states[0]


def test_tree_scores_held_out_texts_better_than_a_shallow_one(spark, sf_dir):
    found = lm_score.query(spark, sf_dir).toPandas()
    held = found[found["held_out"]]
    shallow = lm_score.lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), lm_score.TreeRule(depth=1)).toPandas()
    assert held["score"].sum() > 0.8 * shallow[shallow["held_out"]]["score"].sum()


def test_the_tree_grows_with_the_corpus(spark):
    """A context of a few occurrences stays a state however much other text surrounds it."""
    rare = "kabcz mabcw " * 12
    filler = ["defg " * 400_000] * 12  # over a million places for each occurrence of the rare context
    for texts in ([rare], [rare, *filler]):
        states = tree_of(spark, texts, lm_score.TreeRule()).states
        assert int.from_bytes(b"kabc", "big") in states[3]


@pytest.mark.parametrize("frequent", [0.0, 1e-3, 2.0])
def test_scores_are_those_of_the_whole_tree(spark, frequent):
    """Whether n-grams are looked up in memory or joined doesn't matter, nor whether training has them."""
    rule = lm_score.TreeRule(frequent=frequent)
    tree = tree_of(spark, [t for i, t, *_ in edge_rows() if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1], rule)
    found = {(r["doc_id"], r["n_tokens"]): r["score"] for r in lm_score.lm_scores(frame(spark), rule).collect()}
    for i, text, *_ in edge_rows():
        words = lm_score.words_of(text or "")
        expected = tree.log10(lm_score.packed([lm_score.line_of(words)], rule.depth)).sum()
        assert found[i, len(words) + 1] == pytest.approx(expected)
