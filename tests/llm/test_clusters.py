"""Clustering with loosened bounds, against plain rounds of whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidings.llm.clusters import LIMIT, assign, cluster, squared_distances, with_inertia

SCHEMA = "vec_id long, embedding array<float>, label string, cluster string, vector string, distance string"


def brute(rows, k=8, dims=64, rounds=10):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-LIMIT, min(LIMIT, math.floor(1024 * float(np.float32(x))))) for x in v]))
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centers = [v for _, v in named[:k]]
    if not centers:
        return []

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        found = nearest()
        for j in range(len(centers)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == j]
            if own:
                centers[j] = [sum(column) // len(own) for column in zip(*own)]
    found = nearest()
    sums = [sum(d for d, c in found if c == j) for j in range(len(centers))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, j, d, sums[j], sum(sums), digest[j]) for (i, _), (d, j) in zip(kept, found)), key=repr)


def vectors(n, seed, spread):
    rng = random.Random(seed)
    tops = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, spread) for x in rng.choice(tops)]) for i in range(n)]


CASES = {
    "apart": vectors(200, 1, 0.2),
    "mixed": vectors(250, 2, 2.0),
    "equal": [(i, [0.5] * 64) for i in range(30)] + [(99, [-0.25] * 64)],
    "ties": [(i, [float(i % 2), float(i // 2 % 2)] + [0.0] * 62) for i in range(40)],
    "few": vectors(3, 3, 1.0),
    "odd": [
        *vectors(20, 4, 1.0), (None, [1.0] * 64), (100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65),
        (104, [1.0] * 63 + [None]), (105, [float("nan")] * 64), (106, [float("inf")] * 64), (107, [-float("inf")] + [0.0] * 63),
        (5, [2.0] * 64), (5, [2.0] * 64), (108, [1e30] + [-1e30] * 63), (109, [-1e-9] * 64),
    ],
    "hot": [(i, [0.125] * 64) for i in range(300)] + vectors(100, 6, 0.5),
    "none": [],
    "no ids": [(None, [1.0] * 64)],
}


@pytest.mark.parametrize("name", list(CASES))
def test_against_brute_force(spark, name):
    table = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in CASES[name]], SCHEMA)
    got = sorted(map(tuple, with_inertia(cluster(table)).collect()), key=repr)
    expected = brute(CASES[name])
    if name == "odd":  # sums of clamped distances exceed a long and are null
        got, expected = ([r[:3] + r[5:] for r in x] for x in (got, expected))
    assert got == expected


def test_bounds_save_most_evaluations():
    rng = np.random.default_rng(0)
    tops = rng.normal(0, 2000, (8, 64)).astype(np.int64)
    points = tops[rng.integers(0, 8, 3000)] + rng.normal(0, 300, (3000, 64)).astype(np.int64)
    history = points[:8][None]
    exact = np.stack([squared_distances(points, c) for c in history[0]], axis=1)
    own, bounds, rounds = exact.argmin(axis=1), np.sqrt(exact), np.zeros((3000, 8), np.int64)
    work = []
    for _ in range(10):
        moved = [points[own == j].sum(axis=0) // max(1, (own == j).sum()) if (own == j).any() else history[-1][j] for j in range(8)]
        history = np.concatenate([history, np.array(moved)[None]])
        own, evaluated = assign(points, own, bounds, rounds, history)
        exact = np.stack([squared_distances(points, c) for c in history[-1]], axis=1)
        assert (own == exact.argmin(axis=1)).all()
        work.append(evaluated)
    assert sum(work) < 0.4 * 10 * 3000 * 8


def test_displacement_back_and_forth_cancels():
    """A centroid that returns loosens nothing: the norm of the sum, not the sum of the norms."""
    points = np.array([[0, 0], [10, 0]], np.int64)
    there = np.array([[0, 0], [100, 0]])
    away = np.array([[500, 0], [100, 0]])
    bounds = np.sqrt(np.stack([squared_distances(points, c) for c in there], axis=1))
    own, evaluated = assign(points, np.array([0, 0]), bounds, np.zeros((2, 2), np.int64), np.array([there, away, there]))
    assert own.tolist() == [0, 0] and evaluated == 0
