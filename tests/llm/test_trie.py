"""The prefix trie and tree contraction, against plain walks."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidings.llm import trie
from tidings.llm.contraction import subtree_totals
from tidings.llm.numbering import numbered
from tidings.llm.trie import prefix_trie, rebuilt_turns

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, place string, id string, parent string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """All nodes of (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, sha(role or "") + ":" + sha(text or ""), (role or "", text or "")))
    turns = {c: [x[3] for x in sorted(own[c], key=lambda x: (x[0], x[1] or 0, x[2]))] for c in own}
    rebuilt = {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out, totals = [], {}
    for path in sorted(members, key=len, reverse=True):
        own_saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [totals[x] for x in children[path]]
        totals[path] = (sum(x[0] for x in below) or int(not below), own_saved + sum(x[1] for x in below))
        ends = ",".join(str(c) for c in sorted(members[path]) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(members[path]), len(path), parent, len(members[path]), len(below), *totals[path], sha(ends)))
    return sorted(out, key=repr)


def nodes_of(spark, rows):
    filled = spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], SCHEMA)
    conv_id = F.col("conv_id")
    found = prefix_trie(*rebuilt_turns(filled, F.crc32(conv_id.cast("string").cast("binary")) % 9, conv_id - conv_id % 5, 8))
    return sorted(map(tuple, found.collect()), key=repr)


def random_rows(seed, conversations, vocabulary, longest):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"][: 1 + seed % 2]), f"t{rng.randrange(vocabulary)}" * rng.randrange(1, 4))
        for c in range(conversations)
        for t in range(rng.randrange(1, longest))
    ]


ODD = [
    (None, 0, "user", "x"), (None, None, None, None), (3, None, "user", None), (3, 0, None, "hé"), (3, None, "b", "a"),
    (3, 0, None, "hé"), (3, 0, None, "hé"), (4, None, None, None), (-1, 2, "user", ""), (-1, 1, "user", "z"), (-5, 1, "user", "z"),
]


def moved(rows, by):
    return [(None if c is None else c + by, *r) for c, *r in rows]


COPIES = [(c, t, "user", f"turn {t}") for c in range(70) for t in range(12)]
ALL = [
    *random_rows(1, 60, 2, 9),
    *moved(random_rows(2, 80, 40, 12), 100),
    *moved(ODD, 200),
    *moved([(c, t, "r", "x") for c in (0, 1, 2, 6, 7, 11, 10) for t in range(c)], 300),
    *[(400, t, "r", f"x{t % 3}") for t in range(700)],
    *[(409, t, "r", f"x{t % 3}") for t in range(350)],
    *[(c, t, "r", "é" * 40_000 + str(t)) for c in (500, 501, 505) for t in range(4)],
]
CASES = {"all kinds": ALL, "odd rows": ODD, "copies": COPIES, "only without id": [(None, 1, "a", "b")]}


@pytest.mark.parametrize("name", list(CASES))
def test_trie_against_brute_force(spark, name):
    assert nodes_of(spark, CASES[name]) == brute(CASES[name])


def test_small_chunks_and_runs_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_TURNS", 3)
    monkeypatch.setattr(trie, "RUN_IDS", 2)
    rows = [*random_rows(1, 60, 2, 9), *COPIES]
    assert nodes_of(spark, rows) == brute(rows)


def test_rows_without_differences_are_numbered_apart(spark):
    rows = spark.createDataFrame([(i % 2 or None, None, "same") for i in range(4000)], "k long, o long, x string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges, also of few rows
    try:
        got = numbered(rows, ["k"], ["o"], "n").groupBy("k").agg(F.countDistinct("n").alias("n"), F.max("n").alias("most")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {tuple(r) for r in got} == {(None, 2000, 2000), (1, 2000, 2000)}


def trees():
    rng = random.Random(5)
    yield [(i, i - 1 if i else None) for i in range(400)]
    yield [(i, 0 if i else None) for i in range(500)]
    yield [(i, rng.randrange(i) if i else None) for i in range(600)]
    yield [(i, (i - 1 if i < 200 else 199) if i else None) for i in range(400)]
    yield [(i, i - 7 if i >= 7 else None) for i in range(100)]
    yield [(0, None)]


def test_contraction_against_a_walk(spark):
    """A chain, a star, a random tree, a broom, a forest and a lone root, in one table."""
    tree = [(1000 * k + i, None if up is None else 1000 * k + up) for k, t in enumerate(trees()) for i, up in t]
    value = {i: (i * 37) % 101 - 20 for i, _ in tree}
    totals = dict(value)
    for i, up in sorted(tree, reverse=True):
        if up is not None:
            totals[up] += totals[i]
    table = spark.createDataFrame([(i, up, value[i], 1) for i, up in tree], "id long, parent long, v long, ones long")
    got = subtree_totals(table, ["v", "ones"]).collect()
    assert {r["id"]: r["v"] for r in got} == totals and len(got) == len(tree)
    assert sum(r["ones"] for r in got if r["id"] in {i for i, up in tree if up is None}) == len(tree)
    assert subtree_totals(table.limit(0), ["v", "ones"]).collect() == []
