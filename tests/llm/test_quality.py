"""Quality rules and the quality classifier."""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_cases import edge_rows, frame, listed, prose
from surveyflow.llm import quality_mil, quality_rules


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len({*lines}), len(covered)


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def long_hash(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return signed(seed)


def brute_grams(text, buckets):
    hashes = [signed(xxhash.xxh64_intdigest(w, 42)) for w in (text or "").encode().split()]
    singles = [long_hash(h) % buckets for h in hashes]
    return singles + [long_hash(a, b) % buckets for a, b in zip(hashes, hashes[1:])]


def rule_rows():
    more = [(50 + k, prose(60 + k, 90), "en", "a") for k in range(12)]
    junk = [(70, " ".join(w + "###" for w in prose(70, 80).split()), "en", "a"), (71, "De De De sa sa sa " * 40, "en", "a")]
    lines = [(72, "one two\n\n one two\none two\nthree\n \none two\r\nthree", "en", "a"), (73, "a b c d a b c x a b a b c", "en", "a")]
    return edge_rows() + more + junk + lines


def test_rules_against_brute_force(spark):
    rows, rule = rule_rows(), quality_rules.RatioRule(buckets=512)
    labels = [(50 + k, 1, 0) for k in range(8)] + [(58, 1, 1), (59, 0, 0), (None, 1, 0), (70, None, 0), (50, 1, 0)]
    frame_labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in quality_rules.quality_rules(frame(spark, rows), frame_labels, rule).collect()}
    raw, target = Counter(), Counter()
    for doc_id, text, *_ in rows:
        raw.update(brute_grams(text, 512))
        if doc_id in range(50, 58):
            target.update(brute_grams(text, 512))
    r_all, t_all = raw.total() + 512, target.total() + 512
    for doc_id, text, *_ in rows:
        counts = brute_counts(text)
        row = found[doc_id, counts[0], counts[1]]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        grams = brute_grams(text, 512)
        score = sum(math.log((target[g] + 1) / t_all) - math.log((raw[g] + 1) / r_all) for g in grams) / max(len(grams), 1)
        assert row["base_failed"] == failed
        assert row["score"] == pytest.approx(score, abs=1e-9)
        assert row["kept"] == (not failed and score >= rule.threshold)


def test_rules_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = quality_rules.quality_rules(frame(spark), labels).collect()
    assert len(found) == len(edge_rows()) and all(r["score"] == 0 for r in found)
    assert quality_rules.quality_rules(frame(spark, []), labels).count() == 0


def test_rules_tell_junk_from_prose(spark, sf_dir):
    found = quality_rules.query(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").toPandas()
    judged = found[~found["base_failed"]]
    assert judged[judged["quality"] == 1]["kept"].mean() > 0.95 and judged[judged["quality"] == 0]["kept"].mean() < 0.05


def test_no_python_in_the_native_operators(spark, small_dir):
    from surveyflow.llm import exact_dedup

    for df in (quality_rules.query(spark, small_dir), exact_dedup.query(spark, small_dir)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_classifier_on_held_out_documents(spark, sf_dir):
    found = quality_mil.query(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").toPandas()
    assert found["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.3)).all()
    held = found[found["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.9
    assert held[held["quality"] == 1]["predicted"].mean() > 0.98


def test_classifier_edges(spark):
    labels = spark.createDataFrame([(1, 1), (3, 1), (8, 0), (9, None), (1, 0)], "doc_id bigint, quality int")
    scored = quality_mil.quality_scores(frame(spark), labels).collect()
    assert len(scored) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in scored)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality_mil.quality_scores(frame(spark), none).collect()} == {0.5}
    assert quality_mil.quality_scores(frame(spark, []), labels).count() == 0
    kept = quality_mil.keep_good(frame(spark), none)
    assert kept.columns == frame(spark).columns and kept.count() == len(edge_rows())


def test_bags_cover_the_whole_text():
    rule = quality_mil.BagRule(passage=64, most=4)
    for text in ("", "a", prose(1, 500), "é" * 1000):
        bag = quality_mil.passages(text, rule)
        assert 1 <= len(bag) <= 4 and np.isfinite(bag).all()
    assert not np.array_equal(quality_mil.passages(prose(1, 500), rule)[-1], quality_mil.passages(prose(1, 500)[:-20] + "#" * 20, rule)[-1])


def test_gradients_match_differences():
    rule = quality_mil.BagRule(slots=8, hidden=4, attention=3)
    rng = np.random.default_rng(0)
    model = quality_mil.AttentionModel.fresh(rule, rng)
    model.w = {k: v.astype(np.float64) + rng.normal(0, 0.1, v.shape) for k, v in model.w.items()}
    bags = quality_mil.Bags.of([rng.normal(size=(n, rule.width)) for n in (1, 3, 2)])
    label = np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(bags)["p"]
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    slopes = model.gradients(bags, label)
    for name, w in model.w.items():
        at = tuple(0 for _ in w.shape)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        down = loss()
        w[at] += 1e-5
        assert slopes[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6), name


def plain_score(model, rows: np.ndarray) -> float:
    """Gated attention over the passages of one bag, by loops over plain numbers."""
    w = {k: v.astype(float).tolist() for k, v in model.w.items()}
    dot = lambda a, b: math.fsum(x * y for x, y in zip(a, b))
    column = lambda m, k: [row[k] for row in m]
    hidden = [[math.tanh(dot(x, column(w["enc"], k)) + w["enc0"][k]) for k in range(len(w["enc0"]))] for x in rows.tolist()]
    weights = []
    for h in hidden:
        t = [math.tanh(dot(h, column(w["v"], k)) + w["v0"][k]) for k in range(len(w["v0"]))]
        g = [1 / (1 + math.exp(-(dot(h, column(w["u"], k)) + w["u0"][k]))) for k in range(len(w["u0"]))]
        weights.append(math.exp(dot([a * b for a, b in zip(t, g)], w["att"])))
    mean = [sum(a * h[k] for a, h in zip(weights, hidden)) / sum(weights) for k in range(len(w["out"]))]
    return 1 / (1 + math.exp(-(dot(mean, w["out"]) + w["out0"][0])))


def test_scores_are_those_of_a_plain_forward_pass(spark):
    rule = quality_mil.BagRule(passage=80, most=5, slots=16, hidden=5, attention=3, epochs=2)
    rows = edge_rows() + [(100 + i, prose(i, 60) if i % 2 else "# $ % " * 50, "en", "a") for i in range(40)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(40)], "doc_id bigint, label int")
    model = quality_mil.train(docs, labels, rule)
    found = {(r["doc_id"], r["score"]) for r in quality_mil.score_documents(docs, model, rule).collect()}
    for i, text, *_ in rows:
        expected = plain_score(model, quality_mil.passages(text or "", rule))
        assert any(j == i and s == pytest.approx(expected, abs=1e-4) for j, s in found), (i, expected)


def test_a_labelled_id_on_many_rows_is_one_bag(spark, monkeypatch):
    """The bound holds for bags, and the rows that share an id don't change which text is learned from."""
    taught = []
    fit = quality_mil.fit
    monkeypatch.setattr(quality_mil, "fit", lambda bags, labels, rule: taught.append([b.tobytes() for b in bags]) or fit(bags, labels, rule))
    rule = quality_mil.BagRule(sample=5, epochs=1)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id bigint, label int")
    rows = [(i, prose(i, 20), "en", "a") for i in range(1, 9)] + [(i, prose(50 + k % 3, 10), "en", "a") for i in (1, 2, 3) for k in range(3000)]
    for order in (rows, rows[::-1]):
        quality_mil.train(frame(spark, order).repartition(4), labels, rule)
    assert len(taught[0]) == 5 and taught[0] == taught[1]
