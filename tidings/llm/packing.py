"""Packing of encoded documents into sequences of a fixed number of tokens.

Pieces meet only as counts by length: the plan is made over at most ``capacity`` lengths on the
driver, whatever the size of the corpus, and pieces take their places in it by their rank among
the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.kernels import text_blocks
from tidings.llm.tables import stored
from tidings.llm.tokens import encoder

#: Pieces of one length that are numbered together, on average.
RUN_PIECES = 20_000


def encoded_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut where longer than ``capacity``.

    Columns: doc_id; piece, from 0; start, the document's ids before it; length; ids_crc32, of the
    ids as little-endian unsigned 32-bit numbers; with ``with_ids`` also ids. Of a document that
    is cut only the first piece may be shorter. A null or empty text is one piece of ``end_id``.
    Repeated rows are documents of their own; columns but doc_id and text are left out.
    """
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer)
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []),
    ]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(spec.value)
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(1)):
                ids, counts = coder.encode(data, bounds)
                ends = np.cumsum(counts + 1)
                ended = np.full(len(ids) + len(counts), end_id, np.dtype("<u4"))
                ended[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                total = counts + 1
                pieces = -(-total // capacity)
                head = total - (pieces - 1) * capacity
                row = np.repeat(np.arange(len(total)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.where(number == 0, 0, head[row] + (number - 1) * capacity)
                length = np.where(number == 0, head[row], capacity)
                begin = (ends - total)[row] + start
                raw = memoryview(ended.tobytes())
                crc = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist())]
                names = batch.column(0).slice(first, last - first).take(pa.array(row))
                columns = [names, pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    offsets = pa.array(np.append(begin, len(ended)), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ended.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(encode, T.StructType(fields))


def _exact_partners(counts: np.ndarray, gap: int) -> list[int] | None:
    """Lengths that fill ``gap`` exactly: one, else a pair, else a triple, large lengths first."""
    if gap <= 0 or gap >= len(counts):
        return None
    if counts[gap]:
        return [gap]
    there = counts > 0
    sizes = np.flatnonzero(there[: gap + 1])
    big = sizes[2 * sizes >= gap][::-1]
    pairs = big[there[gap - big] & ((2 * big != gap) | (counts[big] > 1))]
    if len(pairs):
        return [int(pairs[0]), int(gap - pairs[0])]
    for one in sizes[3 * sizes >= gap][::-1].tolist():
        rest = gap - one
        there_one = counts.copy()
        there_one[one] -= 1
        big = sizes[(2 * sizes >= rest) & (sizes <= min(one, rest))][::-1]
        low = rest - big
        ok = (there_one[big] > 0) & (there_one[low] > 0) & ((low != big) | (there_one[big] > 1))
        if ok.any():
            two = int(big[np.flatnonzero(ok)[0]])
            return [one, two, rest - two]
    return None


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns of lengths and how often each is used; every piece is in one of them.

    Exact complements first: the gap that the largest length leaves is looked up among the single
    lengths, the pair sums and the triple sums of what is still available, and a combination is
    consumed as often as its scarcest length allows. Lengths without a complement are then placed
    best-fit, longest first, again with all pieces of a length at once. Each step uses up a length
    or a kind of sequence, so the plan is bounded by the number of lengths, not of pieces.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] += n
    plan: list[tuple[list[int], int]] = []
    for length in range(capacity, 0, -1):
        while counts[length]:
            if length == capacity:
                plan.append(([length], int(counts[length])))
                counts[length] = 0
                break
            counts[length] -= 1
            partners = _exact_partners(counts, capacity - length)
            counts[length] += 1
            if partners is None:
                break
            pattern = [length, *partners]
            sizes, uses = np.unique(pattern, return_counts=True)
            times = int((counts[sizes] // uses).min())
            counts[sizes] -= uses * times
            plan.append((pattern, times))
    open_bins: dict[int, list[tuple[list[int], int]]] = {}
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            gap = min((g for g in open_bins if g >= length), default=None)
            if gap is None:
                each = capacity // length
                for size, n in ((each, left // each), (left % each, 1)):
                    if size and n:
                        open_bins.setdefault(capacity - size * length, []).append(([length] * size, n))
                break
            pattern, n = open_bins[gap].pop()
            used = min(n, left)
            if n > used:
                open_bins[gap].append((pattern, n - used))
            if not open_bins[gap]:
                del open_bins[gap]
            open_bins.setdefault(gap - length, []).append(([*pattern, length], used))
            left -= used
    return plan + [kind for kinds in open_bins.values() for kind in kinds]


def _places(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """For ranks of a length: from, to, the sequence of the first of them, the offset in it."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, first + times, sequence, offset))
            taken[length] = first + times
            offset += length
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32 and any more) with sequence_id and offset.

    Every piece gets one place; a sequence is filled without gaps from 0 and never beyond
    ``capacity``. Lengths are from 1 to ``capacity``. ``pieces`` is read twice, so it should be a
    stored table. A length that holds most pieces is numbered in many runs at once.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = max(1, -(-sum(histogram.values()) // RUN_PIECES))
    places = spark.createDataFrame(
        _places(packing_plan(histogram, capacity)),
        "length long, rank_from long, rank_to long, first_sequence long, offset long",
    )
    dealt = pieces.withColumn("run", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(runs)))
    earlier = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("length", "run")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    rank = F.row_number().over(Window.partitionBy("length", "run").orderBy("doc_id", "piece", "ids_crc32"))
    return (
        dealt.withColumn("rank_in_run", rank)
        .join(before, ["length", "run"])
        .withColumn("rank", F.col("before") + F.col("rank_in_run") - 1)
        .join(F.broadcast(places), "length")
        .where((F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("rank_from"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """:func:`encoded_pieces` of ``docs``, encoded once and stored, then :func:`pack` of them."""
    return pack(stored(encoded_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces"), capacity)
