import hashlib
import random

import numpy as np
import pytest

from tidings.llm.suffixes import adjacent_prefixes, remove_repeats, two_stage_order


def brute(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(r for r in rows if r[0] is not None):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(data[i : i + length])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc] = (doc, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_two_stage_order_is_a_suffix_order(seed):
    rng = random.Random(seed)
    text = bytes(rng.choices(b"ab" if seed % 3 else b"abcdefgh\x00\xff", k=rng.randint(1, 300)))
    if seed % 4 == 0:
        text = text[:20] * 9 + b"aaaaaaaaaaaa" + text
    data = np.frombuffer(text, np.uint8)
    wanted = np.array([rng.random() < 0.7 for _ in text])
    order = two_stage_order(data, wanted, 400)
    assert order.tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda i: text[i:])
    same = adjacent_prefixes(data, order, 12)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :][:12].ljust(12, b"\0"), text[order[k] :][:12].ljust(12, b"\0")
        assert same[k] == (a == b)


@pytest.mark.parametrize("length,hot,array", [(100, 20_000, 1 << 22), (40, 3, 1 << 12), (33, 20_000, 2_000), (12, 5, 500)])
def test_removed_bytes_against_brute_force(make_docs, length, hot, array):
    rng = random.Random(length)
    passage = "".join(rng.choices("abcdé ", k=160))
    rows = []
    for i in range(60):
        parts = ["".join(rng.choices("ab cd", k=rng.randint(0, 150))) for _ in range(3)]
        rows.append((i * 7 % 60, passage[: rng.randint(0, 160)].join(parts), "s"))
    rows += [(100, "a" * 500, None), (101, "ab" * 300, None), (102, passage * 3, None), (103, None, None), (104, "", None), (105, passage[:length], None)]
    docs = make_docs([*rows, rows[0], (None, passage, "s")])
    wanted = brute([(i, t) for i, t, _ in rows], length)
    got = remove_repeats(docs, length, array, hot, with_bytes=True).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r["doc_id"] is None:
            assert (r["n_removed"], r["n_spans"]) == (0, 0)
        else:
            assert (*tuple(r)[:5], bytes(r["kept"])) == wanted[r["doc_id"]]


def test_no_documents(no_docs, odd_docs):
    assert remove_repeats(no_docs).count() == 0
    assert remove_repeats(odd_docs).count() == odd_docs.count()


def test_windows_of_an_anchor_may_be_many(make_docs):
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdefgh ", k=900))
    rows = [(i, "".join(rng.choices("abc ", k=rng.randint(0, 90))) + passage[rng.randint(0, 300) : rng.randint(600, 900)] + "xyz"[i % 3], "s") for i in range(30)]
    rows += [(100, "a" * 1000, None), (101, passage * 2, None)]
    found = {r["doc_id"]: (r["doc_id"], r["n_bytes"], r["n_removed"]) for r in remove_repeats(make_docs(rows), 200).collect()}
    assert found == {doc: row[:3] for doc, row in brute([(i, t) for i, t, _ in rows], 200).items()}
