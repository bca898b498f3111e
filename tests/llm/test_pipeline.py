"""The pipeline, stage by stage, against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from llm_cases import edge_rows, frame
from surveyflow.llm import bpe, mixing, quality_mil
from test_exact_and_mix import lowered
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as entry_module


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def brute(spark, rows, labels_dir):
    docs = frame(spark, rows)
    labels = spark.read.parquet(f"{labels_dir}/labels.parquet")
    scored = {r["doc_id"]: r["predicted"] for r in quality_mil.quality_scores(docs, labels).collect()}
    good = [r for r in rows if scored[r[0]]]
    groups = defaultdict(list)
    for r in good:
        groups[lowered(r[1])].append(r)
    unique = [max(g, key=lambda r: r[0]) for g in groups.values()]
    roots = brute_components([brute_fingerprint(r[1]) for r in unique], 4)
    first = {}
    for r, root in zip(unique, roots):
        first[root] = min(first.get(root, r), r, key=lambda x: x[0])
    kept = list(first.values())
    times = {r["doc_id"]: r["times"] for r in mixing.mix_sources(frame(spark, kept)).collect()}
    tokenizer = Tokenizer.from_file(bpe.default_tokenizer())
    out = Counter()
    for doc_id, text, *_ in kept:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out[doc_id, len(ids), digest] += times[doc_id]
    return +out, good, unique, kept


def test_run_against_brute_force(spark, small_dir):
    rows = rows_of(spark.read.parquet(f"{small_dir}/documents.parquet"))
    expected, *_ = brute(spark, rows, small_dir)
    found = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in entry_module.queries()["pipeline"](spark, small_dir).collect())
    assert found == expected


def test_stages_keep_columns_and_cope_with_edges(spark, small_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]
    docs = frame(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small_dir)
        assert kept.columns == docs.columns and 0 < kept.count() <= 3 * len(edge_rows())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).count() == len(edge_rows())


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, small_dir, stage):
    assert stage(spark, frame(spark, []), small_dir).count() == 0
