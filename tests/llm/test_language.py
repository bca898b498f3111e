"""Language identification against Kneser-Ney models in plain Python."""

from __future__ import annotations

import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import edge_rows, frame, prose
from surveyflow.llm import language_id as L


def symbols_of(text: str) -> list[str]:
    """Lower-case letters, and one blank for any run of others; a blank at the end, none at the start."""
    line = re.sub(r"\0+", "\0", "".join(c.lower()[0] if c.isalpha() else "\0" for c in text + "\0"))
    return list(line.lstrip("\0"))


class Plain:
    """Interpolated Kneser-Ney of order 4 over symbols, by dictionaries."""

    def __init__(self, texts):
        full = Counter()
        for text in texts:
            line = ["\0"] * 3 + symbols_of(text)
            if len(line) > 3:
                full.update(tuple(line[k : k + 4]) for k in range(len(line) - 3))
        self.counts = [None, Counter(), Counter(), Counter(), full]
        for order in (3, 2, 1):
            self.counts[order].update(g[1:] for g in self.counts[order + 1])
        self.cut, self.total, self.seen = [0.0], [None], [None]
        for order in range(1, 5):
            once = sum(n == 1 for n in self.counts[order].values())
            twice = sum(n == 2 for n in self.counts[order].values())
            self.cut.append(once / (once + 2 * twice) if once else 0.5)
            total, seen = Counter(), Counter()
            for g, n in self.counts[order].items():
                total[g[:-1]] += n
                seen[g[:-1]] += 1
            self.total.append(total)
            self.seen.append(seen)

    def p(self, gram) -> float:
        if not gram:
            return 1 / (sys.maxunicode + 1)
        order, context = len(gram), gram[:-1]
        total = self.total[order][context]
        if not total:
            return self.p(gram[1:])
        cut = self.cut[order]
        return max(self.counts[order][gram] - cut, 0) / total + cut * self.seen[order][context] / total * self.p(gram[1:])

    def entropy(self, text) -> float | None:
        line = ["\0"] * 3 + symbols_of(text)
        if len(line) == 3:
            return None
        return -sum(math.log(self.p(tuple(line[k : k + 4]))) for k in range(len(line) - 3)) / (len(line) - 3)


def corpus(seed=1):
    """Four languages of their own syllables, two of them in other scripts, with rows of unknown language and others."""
    scripts = {"x": "an be ço dü", "y": "ка ки ны нь", "z": "日本 語文 字学", "w": "an bé co du"}
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        lang = rng.choice(list(scripts))
        words = ["".join(rng.choices(scripts[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randint(1, 60))]
        rows.append((i, ", ".join(words), lang if i % 11 else None, "s"))
    return rows + [(r[0], *r[1:]) for r in edge_rows()] + [(500 + i, prose(i, 30), f"rare{i % 3}", "s") for i in range(9)]


def learned(rows):
    return [(t or "", g) for i, t, g, _ in rows if g is not None and not (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)]


@pytest.mark.parametrize("cells", [L.CELLS, 3000, 500])
def test_entropies_and_predictions(spark, monkeypatch, cells):
    """All languages at once, a few at a time, and one in parts by second-last letter."""
    rows = corpus()
    monkeypatch.setattr(L, "CELLS", cells)
    texts = defaultdict(list)
    for text, lang in learned(rows):
        texts[lang].append(text)
    plain = {lang: Plain(t) for lang, t in texts.items() if any(symbols_of(x) for x in t)}
    found = L.identify_languages(frame(spark, rows)).collect()
    by = defaultdict(list)
    for r in found:
        by[r["doc_id"]].append(r)
    assert len(found) == len(rows)
    for i, text, *_ in rows:
        entropy = {lang: m.entropy(text or "") for lang, m in plain.items()}
        candidates = by[i]
        if None in entropy.values():
            assert any(r["lang_pred"] == "und" and r["score"] == 0 and r["entropy"] is None and r["rejected"] for r in candidates)
            continue
        best = min(entropy, key=lambda g: (entropy[g], g.encode()))
        size = min(len(symbols_of(text)), L.SURE_AT)
        score = 1 / sum(math.exp((entropy[best] - e) * size) for e in entropy.values())
        assert any(
            r["lang_pred"] == best and r["entropy"] == pytest.approx(entropy[best], rel=1e-5) and r["score"] == pytest.approx(score, rel=1e-3)
            for r in candidates
        ), (i, best, candidates)


def test_letters_stay_apart(spark):
    """Two languages that differ in the letters of one script only, and in accents only."""
    rng = random.Random(9)
    rows = []
    for i in range(300):
        letters = ("àéûï", "óêùì", "ыіяє", "иауе")[i % 4]
        rows.append((i, " ".join("".join(rng.choices(letters, k=4)) for _ in range(20)), f"l{i % 4}", "s"))
    found = L.identify_languages(frame(spark, rows)).filter("held_out").collect()
    assert len(found) > 50 and sum(r["lang_pred"] == f"l{r['doc_id'] % 4}" for r in found) / len(found) > 0.95


def test_probabilities_sum_to_one():
    texts = ["the cat sat on the mat and the dog ate", "zeit und ort sind das maß der dinge"]
    plain = Plain(texts)
    letters = sorted({g[-1] for g in plain.counts[1]})
    for context in [("t", "h", "e"), ("\0", "q", "q"), ("z", "z", "z"), ("\0", "\0", "t")]:
        known = sum(plain.p((*context, c)) for c in letters)
        assert known + (sys.maxunicode + 1 - len(letters)) * plain.p((*context, "\U0010ffff")) == pytest.approx(1)


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    found = L.query(spark, sf_dir).join(docs, "doc_id").toPandas()
    assert found["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]
    held = found[found["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert found["score"].between(0, 1).all() and found["rejected"].mean() < 0.05


def test_nothing_learned_and_no_rows(spark):
    unlearned = L.identify_languages(frame(spark, [(1, "words", None, None)])).collect()
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in unlearned] == [("und", 0.0, True)]
    assert L.identify_languages(frame(spark, [])).count() == 0


def test_grams():
    context, last = L.grams(" Ab!! é")
    blank = 0
    expected = [(blank, blank, blank, "a"), (blank, blank, "a", "b"), (blank, "a", "b", blank), ("a", "b", blank, "é"), ("b", blank, "é", blank)]
    code = lambda c: ord(c) if c else 0
    assert [(int(k) >> 42, int(k) >> 21 & (1 << 21) - 1, int(k) & (1 << 21) - 1, int(d)) for k, d in zip(context, last)] == [tuple(map(code, g)) for g in expected]
    assert not len(L.grams("12 !? ")[1])
    assert len(np.unique(L.key4(np.arange(10_000), np.arange(10_000)))) == 10_000
