"""Hard negatives against all pairs in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from oracle_check import connect, differences

from surveyflow.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, part int, block string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, g, "x", 1, "y", 2) for i, e, g in rows], SCHEMA)


def vectors(n: int, size: int = 8, seed: int = 1) -> list:
    """Some near each other, some alone."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(size)] for _ in range(4)]
    rows = []
    for i in range(n):
        base = rng.choice(centres) if i % 3 else [rng.gauss(0, 0.3) for _ in range(size)]
        rows.append((i, [float(np.float32(x + rng.gauss(0, 0.05))) for x in base], rng.randrange(4)))
    return rows


def brute_force(rows, every=100, positives=5, negatives=5):
    held = set()
    for i, e, g in rows:
        if i is None or g is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        held.add((i, (g + 1) % 10 if i % 7 == 0 else g, tuple(math.floor(256 * float(np.float32(x))) for x in e)))
    found = []
    for a, g, v in held:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, h) for i, h, w in held]
        for s, p, h in sorted(r for r in scored if r[2] == g and r[1] != a)[:positives]:
            window = sorted(r for r in scored if r[2] != g and 80 * -s <= 100 * -r[0] <= 100 * -s)[:negatives]
            found += [(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(window, 1)]
    return sorted(found)


def mined(spark, rows, rule=H.Mining(), every=100):
    out = H.hard_negatives(H.digested(frame(spark, rows)), H.F.col("vec_id") % every == 0, rule)
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize(("axes", "bits"), [(2, 1), (2, 3), (3, 2), (4, 2), (1, 4)])
def test_curve_visits_neighbours(axes, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * axes, indexing="ij"), -1).reshape(-1, axes)
    key = H.hilbert_index(cells, bits)
    assert sorted(key) == list(range(side**axes))
    steps = np.abs(np.diff(cells[np.argsort(key)], axis=0))
    assert (steps.sum(axis=1) == 1).all()


def test_bounds_hold_for_every_row_of_a_block():
    rng = np.random.default_rng(3)
    anchors, block = rng.integers(-300, 300, (7, 9)), rng.integers(-50, 200, (40, 9))
    nothing = np.zeros((7, 1), dtype=np.int64)
    w = H.Windows(np.arange(7), np.zeros(7), anchors, nothing, nothing, True, 5)
    below, above = w.bounds(block.min(axis=0)[None, :], block.max(axis=0)[None, :])
    scores = anchors @ block.T
    assert (below[:, 0] <= scores.min(axis=1)).all() and (above[:, 0] >= scores.max(axis=1)).all()


def test_brute_force_small_blocks_and_passes(spark):
    rows = vectors(700)
    rule = H.Mining(block=16, axes=5, bits=3, anchors=20, scored=100)
    assert mined(spark, rows, rule, every=10) == brute_force(rows, every=10)


def test_blocks_out_of_reach_are_not_read(spark):
    """Two far clusters: of the second, no block is chosen for an anchor in the first."""
    rng = random.Random(5)
    rows = [(i, [(1 if i < 200 else -1) + rng.gauss(0, 0.01) for _ in range(6)], i % 2) for i in range(400)]
    known = H.digested(frame(spark, rows))
    candidates, size = H.write_blocks(known, H.Mining(block=20))
    zones = H.zone_maps(candidates, size)
    w = H.Windows(np.array([0]), np.array([0]), np.full((1, 6), 256), np.array([[300_000]]), np.array([[400_000]]), False, 5)
    chosen = [
        len(w.wanted(np.array(z["low"]), np.array(z["high"]), z["label_low"], z["label_high"], w.low)) for z in zones.collect()
    ]
    assert 0 < sum(chosen) < len(chosen) / 2  # the second cluster, and blocks of the anchor's label
    assert mined(spark, rows, H.Mining(block=20)) == brute_force(rows)


def test_edges(spark):
    rows = vectors(120, seed=2)
    rows += [(100, rows[50][1], 1)] * 3  # an anchor, repeated rows
    rows += [(1000 + i, rows[1][1], i % 3) for i in range(40)]  # ties
    rows += [(200, [0.0] * 8, 2), (300, [-x for x in rows[0][1]], 9), (400, [1.0, 1.0], 0), (500, [], 0), (401, [0.5], 0)]
    rows += [
        (600, None, 1), (None, rows[0][1], 1), (700, rows[0][1], None), (800, [float("nan")] + rows[0][1][1:], 0),
        (900, [None] + rows[0][1][1:], 0), (1100, [float("inf")] + rows[0][1][1:], 0), (1200, rows[3][1], 77), (49, rows[3][1], -1),
    ]
    padded = [(i, e and [*e, *[0.0] * (8 - len(e))] if e is not None else None, g) for i, e, g in rows]
    padded[[r[0] for r in rows].index(500)] = (500, [0.0] * 8, 0)
    assert mined(spark, rows, H.Mining(block=8, anchors=3)) == brute_force(padded)


def test_empty_and_alone(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None, None)]) == []
    assert mined(spark, [(100, [1.0, 0.0], 1)]) == [] and mined(spark, [(101, [1.0], 1), (102, [1.0], 1)]) == []


def test_scores_beyond_doubles(spark):
    rows = [(i, [2.0**21 + i, 1.0, 2.0**20], i % 2) for i in range(100, 140)]
    assert mined(spark, rows) == brute_force(rows)
    with pytest.raises(ValueError):
        H._products(np.full((1, 2), 2**31), np.full((1, 2), 2**31))


def test_sql(spark, sf_dir):
    assert differences(H.query(spark, sf_dir), connect(sf_dir), H.SQL) == []
