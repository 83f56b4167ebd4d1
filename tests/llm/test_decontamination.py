import random
import re

import pytest

from tidings.llm.decontamination import drop_contaminated, find_items


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size + 1, 1)) if w else []:
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for phrase, names in windows.items():
            n = len(phrase)
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == phrase:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((doc, len(w), len(hit), len(found), sorted(found)))
    return sorted(out, key=repr)


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block,terms", [(100_000, 5_000_000), (5, 5_000_000), (100_000, 3)])
def test_phrases_against_brute_force(spark, make_docs, block, terms):
    rng = random.Random(3)
    vocabulary = ["the", "of", "Zeta", "été", "x1", "a", "b"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 4, 5, 9])))) for i in range(14)]
    items += [(50, None), (51, ""), (52, "--"), (53, items[3][1]), (54, "never met before at all")]
    rows = []
    for i in range(40):
        filler = lambda: " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))
        rows.append((i, f"{filler()}, {rng.choice(items)[1] or ''}! {filler()}", "s"))
    rows += [(40, None, None), (41, "", None), (None, items[2][1], None), (0, rows[0][1], "s"), (43, "the " * 3000, "s")]
    got = find_items(make_docs(rows), _items(spark, items), size=4, block=block, terms=terms).collect()
    wanted = brute([(i, t) for i, t, _ in rows], items, 4)
    assert sorted((tuple(r) for r in got), key=repr) == wanted


def test_proximity(spark, make_docs):
    docs = make_docs([(0, "alpha x x beta x gamma", "s"), (1, "alpha x x x x x beta gamma", "s"), (2, "gamma", "s"), (3, "alpha beta", "s")])
    items = _items(spark, [(1, "gamma beta alpha")])
    got = {r["doc_id"]: r["n_items"] for r in find_items(docs, items, size=10, span=5).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 0}
    assert {r["doc_id"]: r["n_items"] for r in find_items(docs, items, size=10).collect()} == {0: 0, 1: 0, 2: 0, 3: 0}


def test_rows_go_for_their_own_text_and_items_may_lack_an_id(spark, make_docs):
    items = _items(spark, [(None, "a b c d e f g h i j"), (7, "b c d e f g h i j k"), (None, "q r s t")])
    bad, clean = "x a b c d e f g h i j k y", "nothing of the kind"
    docs = make_docs([(None, bad, "s"), (None, clean, "s"), (3, clean, "s"), (3, bad, "s"), (None, None, "s"), (4, "q r s t", "s")])
    found = {(r["doc_id"], r["n_hit"]): r["items"] for r in find_items(docs, items).collect()}
    assert found[3, 11] == ["", "7"] and found[4, 4] == [""] and found[3, 0] == []
    kept = sorted(((r["doc_id"], r["text"]) for r in drop_contaminated(docs, items).collect()), key=repr)
    assert kept == sorted([(None, clean), (3, clean), (None, None)], key=repr)


def test_odd_tables(spark, odd_docs, no_docs):
    items = _items(spark, [(1, "a b c d e f g h i j")])
    hit = [r["doc_id"] for r in find_items(odd_docs, items).collect() if r["n_hit"]]
    assert sorted(hit) == [5, 5, 6]
    kept = drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count() - 3
    assert find_items(no_docs, items).count() == 0
    assert all(r["n_hit"] == 0 for r in find_items(odd_docs, _items(spark, [])).collect())
    assert drop_contaminated(odd_docs, _items(spark, [])).count() == odd_docs.count()
