"""Exact dedup and mixing against plain Python and SQL."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import edge_rows, frame, listed
from oracle_check import connect, differences
from surveyflow.llm import exact_dedup, mixing, registry, simhash


@pytest.mark.parametrize("name", sorted(registry.SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, name, sf):
    directory = f"/root/testdata/{sf}"
    assert differences(registry.QUERIES[name](spark, directory), connect(directory), registry.SQL[name]) == []


def lowered(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_exact_dedup_edges(spark):
    groups = defaultdict(list)
    for doc_id, text, *_ in edge_rows():
        groups[lowered(text)].append(doc_id)
    expected = []
    for doc_id, text, *_ in edge_rows():
        ids = groups[lowered(text)]
        keep = max((i for i in ids if i is not None), default=None)
        expected.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(lowered(text).encode()).hexdigest()))
    found = exact_dedup.exact_dedup(frame(spark))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert listed(found, *found.columns) == sorted(expected, key=repr)


def test_both_sides_of_the_split_agree(spark):
    """With room for one frequent digest, the rest go the ordinary way; the result is the same."""
    rows = [(i, f"text {i % 7 if i % 3 else 0}", "en", "a") for i in range(300)]
    many = exact_dedup.exact_dedup(frame(spark, rows))
    few = exact_dedup.exact_dedup(frame(spark, rows), heavy=1, tracked=8)
    assert listed(many, *many.columns) == listed(few, *few.columns)


def test_keep_one(spark):
    kept = exact_dedup.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    stay = {lowered(t): i for i, t, *_ in sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0))}
    assert listed(kept, "doc_id") == sorted(((i,) for i in stay.values()), key=repr)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert exact_dedup.exact_dedup(none).count() == exact_dedup.keep_one(none).count() == 0
    assert mixing.mix_sources(none).count() == mixing.repeat_mixed(none).count() == 0


def brute_targets(rows):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share > 3 * sizes[s]}
        if not full:
            return {**target, **{s: weight[s] * share for s in open_}}, sizes
        for s in full:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= full
    return target, sizes


def test_targets_by_repeated_resharing(spark):
    target, sizes = brute_targets(edge_rows())
    for row in mixing.mix_sources(frame(spark)).collect():
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]])
        assert row["taken"] in (0, row["size"], 2 * row["size"], 3 * row["size"])


def test_sources_end_near_their_targets_and_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = mixing.mix_sources(docs).toPandas()
    again = mixing.mix_sources(docs.repartition(13)).toPandas()
    assert sorted(map(tuple, found.values.tolist())) == sorted(map(tuple, again.values.tolist()))
    by = found.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((by["taken"] - by["target"]).abs() <= by["most"]).all()
    assert abs(by["target"].sum() - found["size"].sum()) < 1e-3
    assert found["taken"].sum() <= found["size"].sum()


def awkward_rows():
    """Rows without ids, repeated ids, repeated rows, sizes all equal."""
    ten = lambda n: " ".join(f"w{n}x{k}" for k in range(10))
    rows = [(None, ten(i), "en", "a") for i in range(300)] + [(i, ten(1000 + i), "en", "b") for i in range(300)]
    rows += [(7, ten(2000 + i), "en", "c") for i in range(150)] + [(8, ten(5), "en", "c")] * 150
    return rows + [(9, ten(i), "en", None) for i in range(20)]


def test_targets_are_met_whatever_the_ids(spark):
    rows = awkward_rows()
    target, sizes = brute_targets(rows)
    found = mixing.mix_sources(frame(spark, rows)).toPandas()
    assert len(found) == len(rows)
    for source, part in found.groupby("source", dropna=False):
        source = None if source != source or source is None else source
        assert abs(part["taken"].sum() - target[source]) <= 10, source
        assert part["taken"].max() <= 30 and part["source_size"].iloc[0] == sizes[source]
    assert abs(found["taken"].sum() - sum(sizes.values())) <= 10
    again = mixing.mix_sources(frame(spark, rows[::-1]).repartition(5))
    names = ["doc_id", "size", "source_size", "target", "taken", "times", "source", "digest"]
    assert listed(again, *names) == listed(mixing.mix_sources(frame(spark, rows)), *names)


@pytest.mark.parametrize("rows", [None, awkward_rows()])
def test_documents_repeat_as_taken(spark, rows):
    docs = frame(spark, rows)
    times = Counter()
    for row in mixing.mix_sources(docs).collect():
        times[row["doc_id"], row["digest"], row["source"]] += row["times"]
    repeated = mixing.repeat_mixed(docs)
    assert repeated.columns == docs.columns and repeated.dtypes == docs.dtypes
    found = Counter((r["doc_id"], hashlib.md5((r["text"] or "").encode()).hexdigest(), r["source"]) for r in repeated.collect())
    assert found == +times


def test_repeated_rows_that_differ_elsewhere_share_evenly(spark):
    """Of seven rows of one id and text, no two are taken more than one time apart."""
    rows = [(1, "a b c", f"l{i % 7}", "s") for i in range(7)] + [(2, "d e f g " * 3, "en", "t")]
    found = Counter(r["lang"] for r in mixing.repeat_mixed(frame(spark, rows)).collect() if r["doc_id"] == 1)
    counts = [found[f"l{i}"] for i in range(7)]
    assert max(counts) - min(counts) <= 1 and sum(counts) > 0


@pytest.mark.parametrize("keep", [exact_dedup.keep_one, simhash.keep_first])
def test_the_survivor_does_not_depend_on_the_run(spark, keep):
    """Rows of one id and one normalised text that differ in case, language or source: always the same one stays."""
    rows = [(1, "Same Text here now" if i % 2 else "same text here now", f"l{i % 5}", f"s{i % 3}") for i in range(60)]
    rows += [(None, "Other text", f"l{i}", None) for i in range(7)]
    found = [
        listed(keep(frame(spark, part).repartition(n)), "doc_id", "text", "lang", "source")
        for n, part in ((1, rows), (7, rows[::-1]), (3, rows))
    ]
    assert found[0] == found[1] == found[2]
    if keep is exact_dedup.keep_one:
        assert len(found[0]) == 2


def test_whole_rows_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = exact_dedup.keep_one(frame(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange hashpartitioning(__key" in line for line in plan.splitlines()) == 2, plan  # the rows, and the kept keys
