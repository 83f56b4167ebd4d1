import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.llm.graph import components
from tidings.llm.near_duplicates import COMPONENTS, DISTANCE, block_pairs, chunk_keys, confirm_blocks, drop_near_duplicates, near_duplicates, sieved, sign


def shingles(text, size):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * len(sets[x] | sets[y]):
                    a, b = sorted((root(x), root(y)))
                    parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def _corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    rows, n = [], 0
    for _ in range(14):
        base = [word() for _ in range(rng.choice([3, 4, 6, 30, 120, 300]))]
        for _ in range(rng.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 9])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy), "s"))
            n += 1
    # A chain: neighbours are near, ends are not.
    chain = [f"c{i}" for i in range(100)]
    for k in range(8):
        rows.append((n, "\t".join(chain[6 * k : 6 * k + 60]).upper(), "s"))
        n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,size", [(1, 4), (2, 5)])
def test_components_against_brute_force(make_docs, seed, size):
    rows = _corpus(seed)
    got = near_duplicates(make_docs(rows), size, 80).collect()
    wanted = brute([(i, t) for i, t, _ in rows], size, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_odd_documents(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = near_duplicates(odd_docs, 4, 80).collect()
    assert len(got) == len(rows)
    wanted = brute(rows, 4, 80)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == wanted[r["doc_id"]]
    kept = drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 5, 7, 9, 10, 11, 12]
    assert ids.count(None) == 2
    assert near_duplicates(no_docs).count() == 0
    assert drop_near_duplicates(no_docs).count() == 0


def test_slices_of_a_hot_key_lose_no_block(spark, make_docs):
    base = [f"w{i}" for i in range(80)]
    docs = make_docs([(i, " ".join([*base, f"x{i}"]), "s") for i in range(40)])
    marked = sign(docs, 4)
    texts = marked.select(F.col("doc_id").alias("id"), "packed")
    own = F.col("doc_id")
    members = marked.select(F.lit(7).cast("long").alias("key"), own.alias("id"), own.alias("component"), (own % 10).alias("block"), "signature")
    for part in (1000, 7):
        pairs = {tuple(r) for r in block_pairs(members, slice_members=part).collect()}
        assert pairs == {(a, b) for b in range(10) for a in range(b + 1)}
    one = members.withColumn("component", F.lit(0).cast("long"))
    assert block_pairs(one, slice_members=7).count() == 0
    links = confirm_blocks(block_pairs(members), members.drop("key"), texts, 4, 80)
    assert {r["component"] for r in components(links).collect()} == {0}
    assert links.count() < 40 * 55


@pytest.mark.parametrize("differing,meet", [(0, True), (29, True), (30, True), (31, True), (32, False)])
def test_signatures_within_the_distance_meet(spark, differing, meet):
    """The differing components are dealt evenly over the chunks, which is the hardest case."""
    rng = np.random.default_rng(differing)
    one = rng.integers(0, 1 << 32, COMPONENTS, np.uint32)
    two = one.copy()
    at = np.arange(COMPONENTS).reshape(-1, 4).T.ravel()[:differing]
    two[at] ^= 1
    rows = [(1, 1, 1, bytearray(one.tobytes())), (2, 2, 2, bytearray(two.tobytes()))]
    members = spark.createDataFrame(rows, "id long, component long, block long, signature binary")
    members = chunk_keys(members).join(members, "id")
    assert [tuple(r) for r in block_pairs(members).collect()] == [(1, 2)] * meet
    assert DISTANCE == 31


def test_rows_of_one_id_are_judged_by_their_texts(make_docs):
    text = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcd"}
    rows = [(3, text["a"], "s"), (5, text["a"], "s"), (5, text["b"], "s"), (9, text["c"], "s"), (9, text["d"], "s"), (9, text["d"], "s"),
            (2, text["d"] + " more", "s"), (None, text["a"], "s"), (None, text["a"], "s"), (7, text["b"] + " x", "t")]
    got = sorted((r["doc_id"] or 0, (r["text"] or "")[:2]) for r in drop_near_duplicates(make_docs(rows)).collect())
    assert got == [(0, "a0"), (0, "a0"), (2, "d0"), (3, "a0"), (5, "b0"), (9, "c0")]
    found = sorted((r["doc_id"], r["component_id"]) for r in near_duplicates(make_docs(rows)).collect() if r["doc_id"])
    assert found == [(2, 2), (3, 3), (5, 3), (5, 5), (7, 5), (9, 2), (9, 2), (9, 9)]


def test_the_sieve_keeps_what_is_wanted(spark):
    texts = spark.range(-500, 500).select("id", F.lit(b"x").alias("packed"))
    kept = {r["id"] for r in sieved(texts, spark.createDataFrame([(-400,), (7,), (7,)], "id long")).collect()}
    assert {-400, 7} <= kept and len(kept) < 10
    assert sieved(texts, texts.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for a, b in edges if a != b for i in (a, b)}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
