"""A random forest in plain Python, row by row, to compare the distributed one with."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

P = 2**31 - 1


def number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % P


def times_in_bag(key, seed, tree) -> int:
    u = (number(f"bag:{seed}:{key}") * (number(f"{seed}:{tree}:a") or 1) + number(f"{seed}:{tree}:b")) % P
    times, below = 0, 0.0
    for k in range(12):
        below += math.exp(-1) / math.factorial(k)
        times += u >= math.floor(below * P)
    return times


def cut_points(values: list[float], most: int) -> list[float]:
    counts = sorted(Counter(values).items())
    bins, before = {}, 0
    for place, (value, n) in enumerate(counts):
        share = place if len(counts) <= most else before * most // len(values)
        bins.setdefault(share, []).append(value)
        before += n
    ordered = [bins[b] for b in sorted(bins)]
    cuts = []
    for lower, upper in zip(ordered, ordered[1:]):
        half = lower[-1] + (upper[0] - lower[-1]) / 2
        cuts.append(half if half < upper[0] else lower[-1])
    return cuts


def purity(counts: list[int]) -> float:
    squares, total = float(counts[0]) * counts[0], float(counts[0])
    for n in counts[1:]:
        squares, total = squares + float(n) * n, total + n
    return squares / total


def gini(counts: list[int]) -> float:
    total = sum(counts)
    return 1.0 - sum((n / total) ** 2 for n in counts)


def grow(rows, cuts, tree, rule) -> dict:
    """Nodes of a tree: number -> (counts, feature, cut) with feature None for a leaf."""
    features = len(cuts)
    bag = [(label, v, w) for key, label, v in rows if (w := times_in_bag(key, rule.seed, tree) if rule.bootstrap else 1)]
    nodes, todo = {}, [(1, bag, 0)]
    while todo:
        node, held, depth = todo.pop()
        counts = [0] * rule.classes
        for label, _, w in held:
            counts[label] += w
        nodes[node] = (counts, None, None)
        if depth == rule.depth or sum(n > 0 for n in counts) < 2:
            continue
        ranked = sorted(range(features), key=lambda f: (hashlib.md5(f"{rule.seed}:{tree}:{node}:{f}".encode()).hexdigest(), f))
        best = None
        for f in sorted(ranked[: rule.per_node] if rule.per_node < features else range(features)):
            for cut in cuts[f]:
                left = [0] * rule.classes
                for label, v, w in held:
                    if v[f] <= cut:
                        left[label] += w
                right = [a - b for a, b in zip(counts, left)]
                if sum(left) and sum(right):
                    score = purity(left) + purity(right)
                    if best is None or score > best[0]:
                        best = (score, f, cut)
        if best is None or best[0] <= purity(counts):
            continue
        _, f, cut = best
        nodes[node] = (counts, f, cut)
        todo.append((2 * node, [r for r in held if r[1][f] <= cut], depth + 1))
        todo.append((2 * node + 1, [r for r in held if r[1][f] > cut], depth + 1))
    return nodes


def fit(rows, rule) -> list[dict]:
    """``rows``: (key, label, values)."""
    cuts = [cut_points([v[f] for _, _, v in rows], rule.bins) for f in range(len(rows[0][2]))]
    return [grow(rows, cuts, t, rule) for t in range(rule.trees)]


def predict(trees, values, classes: int) -> int:
    votes = [0.0] * classes
    for nodes in trees:
        node = 1
        while nodes[node][1] is not None:
            node = 2 * node + (values[nodes[node][1]] > nodes[node][2])
        counts = nodes[node][0]
        for c in range(classes):
            votes[c] += counts[c] / sum(counts)
    return votes.index(max(votes))


def importances(trees, features: int) -> list[float]:
    total = [0.0] * features
    for nodes in trees:
        own = [0.0] * features
        for node, (counts, f, _) in nodes.items():
            if f is not None:
                left, right = nodes[2 * node][0], nodes[2 * node + 1][0]
                n = sum(counts)
                own[f] += n * gini(counts) - sum(left) * gini(left) - sum(right) * gini(right)
        if sum(own):
            total = [a + b / sum(own) for a, b in zip(total, own)]
    return [a / sum(total) for a in total]
