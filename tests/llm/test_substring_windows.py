"""Windows of the levels: told by the windows in them, placed and counted with a few array operations a text."""

from __future__ import annotations

import numpy as np
import pytest

from surveyflow.llm import substring_dedup as S


def words(seed: int, n: int, kinds: int) -> list[bytes]:
    return [b"w%d" % k for k in np.random.default_rng(seed).integers(0, kinds, n)]


@pytest.mark.parametrize("length", [1, 2, 3, 7, 20])
def test_longer_windows_are_equal_where_their_words_are(length):
    first, half = S.levels(length)
    text = words(1, 900, 2)
    both = S.window_hashes(S.word_hashes(text), first)
    full = S.longer(S.longer(both, first, half), half, length)
    assert full.shape == (2, len(text) - length + 1)
    for row in full:
        same = {}
        for start, found in enumerate(row.tolist()):
            same.setdefault(b" ".join(text[start : start + length]), set()).add(found)
        assert all(len(found) == 1 for found in same.values()) and len(set.union(*same.values())) == len(same)


def test_repeats_are_all_but_the_first_of_their_kind():
    keys = np.random.default_rng(2).integers(0, 5, (2, 200))
    seen, expected = set(), []
    for pair in zip(*keys.tolist()):
        expected.append(pair in seen)
        seen.add(pair)
    assert S.repeats(keys).tolist() == expected
    assert S.repeats(keys[:, :0]).tolist() == [] and S.repeats(keys[:, :1]).tolist() == [False]


def test_offsets_and_pairs_are_those_of_the_plain_way():
    values = np.random.default_rng(4).integers(0, 9, 40_000).astype(np.uint64)
    least = S.anchored(values, 15)
    start = np.arange(len(least))
    found = S.offsets(values, least, start, 15)
    assert found.tolist() == [int(np.argmin(values[k : k + 15])) for k in start]
    assert S._twice_at_most(np.array([3, 1, 3, 3, 2, 1], dtype=np.uint64)).tolist() == [1, 1, 2, 3, 3]


def test_texts_meet_their_windows_once_and_anchors_are_not_joined(spark, monkeypatch):
    """Whether or not there are hot anchors, texts take one join, and the lists of anchors none."""
    shared = " ".join(f"s{k}" for k in range(40))
    rows = [(k, f"{shared} own{k} " + " ".join(f"w{k}x{j}" for j in range(30))) for k in range(12)]
    rows += [(100 + k, rows[k][1]) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stored = {}
    plain = S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, purpose: stored.setdefault(purpose, (df, plain(df, purpose)))[1])
    expected = sorted(map(tuple, S.substring_dedup(docs).collect()))
    monkeypatch.setattr(S, "FEW", 3)
    stored.clear()
    assert sorted(map(tuple, S.substring_dedup(docs).collect())) == expected
    plans = {p: df._jdf.queryExecution().executedPlan().toString() for p, (df, _) in stored.items()}
    assert "Join" not in plans["windows-hot"] and "Join" in plans["windows-texts"]
    below = plans["windows-quarters"]
    assert "Generate explode(quarters" in below and "Join" not in below
    lost = {doc_id: n for doc_id, _, n, _ in expected}
    assert lost[0] == 0 and all(lost[k] == 40 for k in range(1, 12)) and all(lost[100 + k] == 71 for k in range(3))
