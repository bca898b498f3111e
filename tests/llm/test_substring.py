"""Substring dedup against a set of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm_cases import edge_rows, frame, listed, prose
from surveyflow.llm import bitmaps
from surveyflow.llm import substring_dedup as S


def brute(rows, length=20):
    seen, out = set(), {}
    for doc_id, text in sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is None, r[0] or 0)):
        words = text.encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - length + 1):
            window = tuple(words[k : k + length])
            if window in seen:
                gone[k : k + length] = [True] * length
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out[doc_id, text] = (len(words), sum(gone), kept)
    return sorted(((r[0], *out[r[0], r[1] or ""]) for r in rows), key=repr)


def shared_rows():
    rng = random.Random(7)
    passage, line = prose(50, 60), prose(51, 19)
    rows = [(i, prose(100 + i, rng.randint(5, 200)), None, None) for i in range(20)]
    rows += [(20 + i, f"{prose(200 + i, 30)} {passage} {prose(300 + i, i)}", None, None) for i in range(6)]
    rows += [(30, f"{passage} {passage}", None, None), (31, f"{line} {line} {line}", None, None), (32, "la " * 100, None, None)]
    rows += [(40, rows[20][1], None, None), (41, rows[20][1].replace(" ", "\n"), None, None), (42, rows[3][1] + " end", None, None)]
    rng.shuffle(rows)
    return rows


def test_shared_passages(spark):
    rows = shared_rows()
    assert listed(S.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_text") == brute(rows)


@pytest.mark.parametrize("hot", [True, False])
@pytest.mark.parametrize("bits", [1 << 15, 1 << 20])
def test_any_share_of_hot_windows_and_of_false_positives(spark, monkeypatch, hot, bits):
    """Texts cut into small pieces, a bitmap that is nearly full, and every repeated anchor hot."""
    monkeypatch.setattr(S, "PIECE", 150)
    monkeypatch.setattr(bitmaps, "BITS", bits)
    if hot:
        monkeypatch.setattr(S, "FEW", 2)
        monkeypatch.setattr(S, "HOT", 12)
    many = [(1000 + i, prose(1000 + i, 400), None, None) for i in range(30)]
    rows = shared_rows() + many + edge_rows()[:-4]
    rows = [r for r in rows if r[0] is not None]
    assert listed(S.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_text") == brute(rows)


def test_bitmaps(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "BITS", 1 << 16)
    keys = np.array([0, 1, 7, 8, 65535, 65536 + 9, -1, -(2**63), 2**63 - 1], dtype=np.int64)
    bitmap = bitmaps.bitmap_of(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    held = {int(k) % (1 << 16) for k in keys}
    assert bitmaps.marked(bitmap, np.arange(1 << 16, dtype=np.int64)).sum() == len(held)
    assert bitmaps.marked(bitmap, keys).all()
    df = spark.range(100).selectExpr("id AS k", "CAST(id AS STRING) AS t")
    assert {r["k"] for r in bitmaps.matching(df, bitmap, "k").collect()} == {k for k in range(100) if k in held}
    assert not bitmaps.bitmap_of(df.limit(0), "k").any()


@pytest.mark.parametrize("size", [1, 5, 40, 10_000])
@pytest.mark.parametrize("length", [1, 3, 20])
def test_pieces_hold_every_window_once(size, length, monkeypatch):
    monkeypatch.setattr(S, "PIECE", size)
    for text in ("", "  ", "one", prose(5, 60), " " + prose(6, 19) + "\n", "é " * 30):
        words = text.encode().split()
        found, fresh = {}, []
        for at, held, before in S.pieces(text, length):
            fresh += held[before:]
            for k in range(len(held) - length + 1):
                assert at + k not in found
                found[at + k] = held[k : k + length]
        assert fresh == words
        assert found == {k: words[k : k + length] for k in range(len(words) - length + 1)}


def test_largest_and_string_ids(spark):
    rows = shared_rows() + [(2**63 - 1, prose(700, 30), None, None), (2**63 - 2, f"{prose(700, 30)} {prose(701, 9)}", None, None)]
    found = S.substring_dedup(frame(spark, rows))
    assert listed(found, "doc_id", "n_words", "n_removed", "kept_text") == brute(rows)
    named = frame(spark, [r for r in rows if r[0] < 100]).withColumn("doc_id", S.F.format_string("d%02d", "doc_id"))
    expected = sorted(((f"d{i:02d}", *rest) for i, *rest in brute([r for r in rows if r[0] < 100])), key=repr)
    assert listed(S.substring_dedup(named), "doc_id", "n_words", "n_removed", "kept_text") == expected


def test_edges(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    assert listed(S.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_text") == brute(rows)
    nobody = listed(S.substring_dedup(frame(spark)), "doc_id", "n_words")
    assert (None, 1) in nobody and len(nobody) == len(edge_rows())
    assert S.substring_dedup(frame(spark, [])).count() == 0


def test_other_lengths(spark):
    rows = shared_rows()
    for length in (5, 7):
        assert listed(S.substring_dedup(frame(spark, rows), length), "doc_id", "n_words", "n_removed", "kept_text") == brute(rows, length)


def test_query_on_a_small_table(spark, small_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    expected = sorted(((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute(rows)), key=repr)
    assert listed(S.query(spark, small_dir), "doc_id", "n_words", "n_removed", "kept_sha256") == expected


def test_anchors_are_the_smallest_halves():
    rng = np.random.default_rng(3)
    half = rng.integers(0, 50, 200, dtype=np.uint64)
    least = [half[i : i + 11].min() for i in range(190)]
    assert (S.anchored(half, 11) == least).all()
    places = {j for i in range(190) for j in range(i, i + 11) if half[j] == least[i]}
    assert sorted(S.anchors(half, 11)) == sorted(half[sorted(places)])


def test_unlike_texts_of_one_id_are_documents_of_their_own(spark):
    """Null and repeated ids, one of them a copy, others sharing passages with each other, in the order of their MD5."""
    passage, whole = prose(60, 30), prose(61, 40)
    texts = [whole, prose(62, 50), f"{prose(63, 25)} {passage}", f"{passage} {prose(64, 90)}", prose(65, 21), f"{prose(66, 7)} {passage} {passage}"]
    rows = [(1, whole), *((None, t) for t in texts), (None, texts[2]), *((5, f"{t} end") for t in texts[1:4]), (6, texts[4])]
    docs = sorted({*rows}, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).digest()))
    numbered = {r: k for k, r in enumerate(docs)}
    by_number = {r[0]: r[1:] for r in brute([(k, t) for (_, t), k in numbered.items()])}
    expected = sorted(((r[0], *by_number[numbered[r]]) for r in rows), key=repr)
    found = S.substring_dedup(frame(spark, [(*r, None, None) for r in rows]))
    assert listed(found, "doc_id", "n_words", "n_removed", "kept_text") == expected
