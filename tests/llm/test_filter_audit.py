"""The filter audit against a loop over documents and orders, and against SQL."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest
from llm_cases import edge_rows, frame, prose
from oracle_check import connect, differences

from surveyflow.llm import filter_audit as A

LABELS = "doc_id bigint, quality int, toxic int, kept string, mask string"


def brute_force(rows, labels) -> dict:
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    found = Counter()
    shapley = Counter()
    parts = {part or "" for _, _, part, _ in rows}
    for i, text, part, _ in rows:
        text, part = text or "", part or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > first[text],
        }
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, order, step)
                if fails[f]:
                    found[(*key, "redundant" if gone else "removed")] += 1
                    found[(*key, "unique_fails")] += sum(fails.values()) == 1
                    if not gone:
                        shapley[part, f] += 1
                        found[(*key, "good_lost")] += i in good
                        found[(*key, "toxic_lost")] += i in toxic
                gone = gone or fails[f]
                found[(*key, "kept")] += not gone
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {
        (p, o, s): (*(found[p, o, s, n] for n in names), shapley[p, o[s - 1]])
        for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)
    }


def result(df) -> dict:
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    held = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(held) == len(rows) and all(r["filter"] == r["filter_order"][r["step"] - 1] for r in rows)
    return held


def test_edges(spark):
    long = prose(7, 250)
    rows = edge_rows() + [
        (20, long, "en", "a"), (21, long, "de", "a"), (22, long.upper(), "en", None), (23, long + " #", "", "a"),
        (None, long, "en", "a"), (24, "a b " * 300, "en", "a"), (25, "a b " * 300 + "|", None, "a"), (26, long, "en", "a"),
    ]
    labels = [(20, 1, 0), (21, 1, 1), (21, 0, None), (24, None, 1), (None, 1, 1), (1, 1, 0), (11, 1, 1), (99, 1, 1), (26, 1, None)]
    made = spark.createDataFrame([(*row, "x", "y") for row in labels], LABELS)
    assert result(A.filter_audit(frame(spark, rows), made)) == brute_force(rows, labels)


def test_empty(spark):
    labels = spark.createDataFrame([], LABELS)
    out = A.filter_audit(frame(spark, []), labels)
    assert out.count() == 0 and out.columns[:3] == ["part", "filter_order", "step"]
    assert A.filter_audit(frame(spark), labels).filter("good_lost + toxic_lost > 0").count() == 0


def test_many_parts_and_string_ids(spark, monkeypatch):
    rows = [(i, "one two" if i % 3 else prose(i, 220), f"part{i % 40}", "a") for i in range(200)]
    df = frame(spark, rows).withColumn("doc_id", A.F.format_string("%05d", "doc_id"))
    labels = spark.createDataFrame([("00007", 1, 1, "", "")], LABELS.replace("bigint", "string"))
    monkeypatch.setattr(A, "HELD", 3)
    assert result(A.filter_audit(df, labels)) == brute_force([(f"{i:05d}", *r) for i, *r in rows], [("00007", 1, 1)])


def test_fields_do_not_run_over():
    most = 2**62
    total = most * A.packed(0) + most * A.packed(31)
    fields = A.unpacked(total)
    assert fields.max() == most and fields[A.KEPT] == most and fields[A.REMOVED] == most
    assert all(A.unpacked(A.packed(c)).max() == 1 for c in range(128))


@pytest.mark.parametrize("size", [3, 7, 64])
def test_words_of_long_texts(size, monkeypatch):
    text = (prose(3, 60) + " \t" + prose(3, 30) + "\n").encode()
    whole = text.split()
    monkeypatch.setattr(A, "_SLICE", size)
    assert A._words(text) == (len(whole), len(set(whole))) and A._words(text + b"end") == (len(whole) + 1, len(set(whole)) + 1)


def test_sql(spark, sf_dir):
    assert differences(A.query(spark, sf_dir), connect(sf_dir), A.SQL) == []
