import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidings.llm.kernels import text_blocks
from tidings.llm.packing import encoded_pieces, pack, pack_documents, packing_plan
from tidings.llm.queries import tokenizer
from tidings.llm.tokens import encoder, length_report, token_counts

SPEC = tokenizer()
PLAIN = Tokenizer.from_str(SPEC)
TRICKY = [
    "", "a", " a", "a ", "  a  b\n\n c", "it's fine, 'tis don't!! x's", "a\u00a0 b\u3000 c \u2003d", "na\u00efve \u00e9, \u00e8.\n\u00c9 \u00e0", "\n",
    "a\n b\n\nc\n", "x<|endoftext|>y <|endoftext|> z", "123 45,6 a1 1a _x", "\u65e5\u672c \u8a9e\u3001\u30c6 \u30b9\u30c8", "a \x1c b \x85 c", "!!! ??? ... ,x",
    "ab,'s don'T", "e\u0301 x\u200d y \U0001f44d z", "\r\n a\r\nb", "a\u2028b \u2028 c",
]


def test_segments_do_not_change_ids():
    rng = random.Random(5)
    bits = ["a", "Z", " ", "  ", "\n", "\t", "'", "'s", ",", "!", "7", "\u00e9", "\u00a0", "\u3000", "\u2003", "\u65e5", "<|endoftext|>", "\u0085", "-"]
    texts = TRICKY + ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(600)]
    coder = encoder(SPEC)
    for _ in range(2):  # new segments, then cached ones
        for first, last, data, bounds in text_blocks(pa.array(texts), 700):
            ids, counts = coder.encode(data, bounds)
            ends = np.concatenate([[0], np.cumsum(counts)])
            for i in range(first, last):
                got = ids[ends[i - first] : ends[i - first + 1]].tolist()
                assert got == PLAIN.encode(texts[i], add_special_tokens=False).ids, repr(texts[i])


def _check(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_documents_are_cut_and_packed_whole(odd_docs):
    rows = pack_documents(odd_docs, SPEC, capacity=64, with_ids=True).collect()
    got, wanted = defaultdict(list), defaultdict(list)
    for r in odd_docs.collect():
        ids = [*PLAIN.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 64 or 64
        cuts = [ids[:head], *[ids[i : i + 64] for i in range(head, len(ids), 64)]]
        start = 0
        for piece, part in enumerate(cuts):
            raw = np.asarray(part, "<u4").tobytes()
            wanted[r["doc_id"]].append((piece, start, len(part), zlib.crc32(raw), tuple(part)))
            start += len(part)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    used = _check(rows, 64)
    assert used <= 1.1 * -(-sum(r["length"] for r in rows) // 64) + 1


def test_no_documents_no_pieces(no_docs):
    assert pack_documents(no_docs, SPEC).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1024])
    histogram = Counter(rng.randint(1, capacity) if seed % 2 else min(capacity, 1 + int(rng.expovariate(5 / capacity))) for _ in range(3000))
    plan = packing_plan(dict(histogram), capacity)
    used = Counter()
    for pattern, times in plan:
        assert times > 0 and sum(pattern) <= capacity
        for length in pattern:
            used[length] += times
    assert used == histogram
    least = -(-sum(k * v for k, v in histogram.items()) // capacity)
    assert sum(times for _, times in plan) <= 1.35 * least + 1
    assert len(plan) <= 8 * capacity


def test_exact_complements_come_first():
    assert packing_plan({7: 2, 3: 1, 2: 1, 1: 1}, 10) == [([7, 3], 1), ([7, 2, 1], 1)]
    assert packing_plan({4: 1, 3: 1, 2: 1, 1: 1}, 10) == [([4, 3, 2, 1], 1)]
    assert packing_plan({10: 5}, 10) == [([10], 5)]
    assert sorted(packing_plan({6: 4}, 10)) == [([6], 4)]
    assert packing_plan({}, 10) == []


def test_a_hot_length_is_numbered_in_runs(spark, monkeypatch):
    monkeypatch.setattr("tidings.llm.packing.RUN_PIECES", 7)
    pieces = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 > 0, 30).otherwise(F.col("id") % 64 + 1).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32")
    )
    rows = pack(pieces, 64).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(500))
    _check(rows, 64)


def test_length_report_against_brute_force(odd_docs, no_docs):
    lengths = [len(PLAIN.encode(r["text"] or "", add_special_tokens=False).ids) for r in odd_docs.collect()]
    rows = {r["encoded_length"]: r for r in token_counts(odd_docs, SPEC).collect()}
    assert set(rows) == set(lengths)
    for limit, r in rows.items():
        assert r["n_documents"] == lengths.count(limit)
        assert r["documents_over"] == sum(x > limit for x in lengths)
        assert r["tokens_over"] == sum(x for x in lengths if x > limit)
        assert r["truncated_total"] == sum(min(x, limit) for x in lengths)
        assert r["tokens_lost"] == sum(lengths) - r["truncated_total"]
        assert r["quantile"] == pytest.approx(sum(x <= limit for x in lengths) / len(lengths))
    assert token_counts(no_docs, SPEC).count() == 0


def test_length_report_over_many_runs(spark):
    lengths = spark.range(5000).select((F.col("id") * 37 % 4001).alias("encoded_length")).unionByName(spark.createDataFrame([(None,)], "encoded_length long"))
    rows = length_report(lengths, run=16).collect()
    values = [i * 37 % 4001 for i in range(5000)]
    assert len(rows) == len(set(values))
    assert all(r["documents_over"] == sum(v > r["encoded_length"] for v in values) for r in rows[::97])


def test_pieces_of_other_tables(spark):
    docs = spark.createDataFrame([("k", "one two")], "doc_id string, text string")
    assert encoded_pieces(docs, SPEC).first()["doc_id"] == "k"
