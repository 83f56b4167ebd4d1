"""Exact removal of repeated byte strings over a whole corpus.

Every window of ``length`` bytes has an anchor, its smallest hashed gram, which depends on its bytes
alone: equal windows have equal anchors. The windows of one anchor form a fragment of the text. Fragments meet
by their anchor's hash. Equal fragments are settled by their earliest place; where an
anchor has different fragments, these are what may share some windows and not others, and a
suffix array over their bytes decides: suffixes smaller than their successors are sorted directly,
all others are induced by scanning the buckets, and adjacent common prefixes give equal windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.kernels import RangeHash, mix, ragged, signed, spans, text_blocks
from tidings.llm.tables import stored

GRAM = 32
#: A place and a number of windows share a long; both fit in 31 bits, as a text has less than 2 GB.
WINDOW_BITS = 31
WINDOWS = (1 << WINDOW_BITS) - 1
#: Bytes of fragments that one suffix array covers, and fragments of one anchor beyond which its
#: windows are settled by hash and count instead, so that no task holds a hot anchor whole.
ARRAY_BYTES = 4 << 20
HOT_FRAGMENTS = 20_000


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive keys, by doubling."""
    least, done = keys, 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    rest = width - done
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def anchored_fragments(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The fragments of a block of texts, in order: anchor hash, fragment hash, first window, windows."""
    gram = min(GRAM, length)
    sizes = np.diff(bounds)
    starts = ragged(bounds[:-1], np.maximum(sizes - length + 1, 0))
    if not len(starts):
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    hashes = RangeHash(data)
    places = np.arange(len(data) - gram + 1)
    grams = hashes(places, places + gram)
    bits = np.uint64(max(24, len(data).bit_length()))
    keys = (grams >> bits << bits) | places.astype(np.uint64)
    least = sliding_least(keys, length - gram + 1)
    anchor = (least[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    count = np.diff(new, append=len(anchor))
    first, anchor = starts[new], anchor[new]
    whole = hashes(first, first + count + length - 1)
    return grams[anchor], mix(whole + (anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first, count


def _firsts(keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Where sorted rows differ from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def gather_fragments(docs: DataFrame, length: int) -> DataFrame:
    """Rows (anchor, fragment, doc, at): at = first window << WINDOW_BITS | windows, or, for bytes that
    this block alone shows to be repeated, at = begin << WINDOW_BITS and fragment = end.

    Of the equal fragments of a block only the earliest goes on, so a passage that a third of all
    documents share is sent once for each block of text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, last, data, bounds in text_blocks(batch.column(1)):
                anchor, fragment, begin, count = anchored_fragments(data, bounds, length)
                doc = np.searchsorted(bounds, begin, "right") - 1
                own, lo = ids[first:last][doc], begin - bounds[doc]
                order = np.lexsort((lo, own, fragment, anchor))
                new = _firsts((anchor[order], fragment[order]))
                lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
                again = order[(own[order] != own[lead]) | (lo[order] != lo[lead])]
                sent = order[new]
                edges = np.bincount(begin[again], minlength=len(data) + 1) - np.bincount(
                    (begin + count + length - 1)[again], minlength=len(data) + 1
                )
                b, e, runs = spans(np.cumsum(edges[:-1]) > 0, bounds)
                owner = np.repeat(np.arange(last - first), runs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([signed(anchor[sent]), signed(mix(ids[first:last][owner].astype(np.uint64) + b.astype(np.uint64)))])),
                        pa.array(np.concatenate([signed(fragment[sent]), e - bounds[owner]])),
                        pa.array(np.concatenate([own[sent], ids[first:last][owner]])),
                        pa.array(np.concatenate([(lo[sent] << WINDOW_BITS) + count[sent], (b - bounds[owner]) << WINDOW_BITS])),
                    ],
                    ["anchor", "fragment", "doc", "at"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")
    return texts.mapInArrow(run, "anchor long, fragment long, doc long, at long")


def settle_fragments(gathered: DataFrame, length: int) -> DataFrame:
    """Rows (doc, begin, end, anchor): repeated bytes with a null anchor, and, with its anchor, every
    earliest fragment of an anchor that has several different ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, asked = None, False
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            known = (columns[3] & WINDOWS) == 0
            begin, end, doc = columns[3][known] >> WINDOW_BITS, columns[1][known], columns[2][known]
            anchor, fragment, own, at = (c[~known] for c in columns)
            out = [(doc, begin, end, None)]
            if len(anchor):
                if carried is not None:
                    anchor, fragment, own, at = (np.concatenate([[x], c]) for x, c in zip(carried, (anchor, fragment, own, at)))
                new = _firsts((anchor, fragment))
                lead = np.flatnonzero(new)[np.cumsum(new) - 1]
                again = (own != own[lead]) | (at >> WINDOW_BITS != at[lead] >> WINDOW_BITS)
                heads = np.flatnonzero(new)
                group = _firsts((anchor[heads],))
                sizes = np.diff(np.flatnonzero(group), append=len(heads))
                several = np.repeat(sizes > 1, sizes)
                wanted = heads[several]
                if carried is not None and asked:
                    wanted = wanted[wanted != 0]
                asked = bool(several[-1]) or (carried is not None and asked and heads[-1] == 0)
                carried = tuple(c[heads[-1]] for c in (anchor, fragment, own, at))
                for rows, named in ((np.flatnonzero(again), False), (wanted, True)):
                    b = at[rows] >> WINDOW_BITS
                    out.append((own[rows], b, b + (at[rows] & WINDOWS) + length - 1, anchor[rows] if named else None))
            parts = [
                pa.RecordBatch.from_arrays(
                    [pa.array(d), pa.array(b), pa.array(e), pa.nulls(len(d), pa.int64()) if a is None else pa.array(a)],
                    ["doc", "begin", "end", "anchor"],
                )
                for d, b, e, a in out
            ]
            yield from parts

    ordered = gathered.repartition("anchor").sortWithinPartitions("anchor", "fragment", "doc", "at")
    return ordered.mapInArrow(run, "doc long, begin long, end long, anchor long")


def direct_order(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` bytes from each, eight bytes at a time."""
    key = words[places].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    group = np.cumsum(_firsts((key,)))
    for done in range(8, depth, 8):
        sizes = np.bincount(group)
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        part, own = places[tied], group[tied]
        key = words[part + done].astype(np.uint64)
        order = np.lexsort((key, own))
        places[tied] = part[order]
        key = key[order]
        split = np.zeros(len(places), np.int64)
        split[tied[1:]] = (own[1:] == own[:-1]) & (key[1:] != key[:-1])
        new = np.zeros(len(places), np.int64)
        new[1:] = group[1:] != group[:-1]
        group = np.cumsum(new | split)
    return places


def two_stage_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes that ``wanted`` marks, sorted by their first ``depth`` bytes.

    A suffix is of the smaller kind if it is smaller than its successor. Only these are sorted
    directly. The others are induced: buckets of first bytes are scanned upwards, and every suffix
    met puts its predecessor, if that is of the larger kind, at the next free place in front of its
    bucket. Whole buckets are scanned at once; runs of one byte take a wave for each repetition.
    """
    n = len(data)
    step = np.sign(np.diff(data.astype(np.int16), append=-1))
    turns = np.flatnonzero(step)
    smaller = step[turns[np.searchsorted(turns, np.arange(n))]] > 0
    # An induced suffix needs its successors up to one that is sorted directly.
    direct = np.append(np.flatnonzero(smaller), n)
    until = np.minimum(direct[np.searchsorted(direct, np.flatnonzero(wanted))], n - 1)
    cover = np.bincount(np.flatnonzero(wanted), minlength=n + 1) - np.bincount(until + 1, minlength=n + 1)[: n + 1]
    needed = np.cumsum(cover[:n]) > 0
    larger = needed & ~smaller
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    words = np.ndarray(n + depth, ">u8", padded.data, strides=(1,))
    sorted_directly = direct_order(words, np.flatnonzero(needed & smaller), depth)
    first_bytes = data[sorted_directly]
    bounds = np.searchsorted(first_bytes, np.arange(257))
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and larger[n - 1]:
        fronts[data[n - 1]].append(np.array([n - 1]))
    buckets = []
    for byte in range(256):
        wave = np.concatenate(fronts[byte]) if fronts[byte] else np.empty(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[larger[before] & (data[before] == byte)]
        bucket.append(sorted_directly[bounds[byte] : bounds[byte + 1]])
        scanned = np.concatenate(bucket)
        buckets.append(scanned)
        before = scanned[scanned > 0] - 1
        before = before[larger[before] & (data[before] > byte)]
        if len(before):
            order = np.argsort(data[before], kind="stable")
            before = before[order]
            cuts = np.flatnonzero(np.diff(data[before])) + 1
            for part in np.split(before, cuts):
                fronts[data[part[0]]].append(part)
    suffixes = np.concatenate(buckets)
    return suffixes[wanted[suffixes]]


def adjacent_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix of ``order`` shares its first ``depth`` bytes with the one before."""
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    words = np.ndarray(len(data) + depth, ">u8", padded.data, strides=(1,))
    same = np.zeros(len(order), bool)
    same[1:] = True
    for done in [*range(0, depth - 7, 8), depth - 8]:
        left = np.flatnonzero(same)
        same[left] = words[order[left] + done] == words[order[left - 1] + done]
    return same


def repeats_of_array(texts: list[bytes], docs: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Repeated bytes (doc, begin, end) of fragments, from one suffix array over all of them."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    firsts = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - length + 1, 0)
    starts = ragged(firsts, counts)
    row = np.repeat(np.arange(len(texts)), counts)
    wanted = np.zeros(len(data), bool)
    wanted[starts] = True
    order = two_stage_order(data, wanted, length)
    same = adjacent_prefixes(data, order, length)
    owner = np.zeros(len(data), np.int64)
    owner[starts] = row
    doc = docs[owner[order]]
    place = begins[owner[order]] + order - firsts[owner[order]]
    rank = np.empty(len(order), np.int64)
    by_place = np.lexsort((place, doc))
    rank[by_place] = np.cumsum(_firsts((doc[by_place], place[by_place])))
    lead = np.minimum.reduceat(rank, np.flatnonzero(~same)) if len(order) else rank
    repeated = np.zeros(len(data), bool)
    repeated[order] = rank != lead[np.cumsum(~same) - 1]
    edges = np.append(firsts, len(data))
    b, e, runs = spans(repeated, edges)
    own = np.repeat(np.arange(len(texts)), runs)
    return docs[own], begins[own] + b - firsts[own], begins[own] + e - 1 - firsts[own] + length


def compare_fragments(fragments: DataFrame, length: int, array_bytes: int) -> DataFrame:
    """Repeated bytes of ``fragments`` (anchor, doc, begin, bytes): whole anchors, some megabytes at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            table = pa.Table.from_batches(held)
            anchor = table.column("anchor").to_numpy()
            end = len(anchor) if whole else int(np.searchsorted(anchor, anchor[-1]))
            if end:
                done = table.slice(0, end)
                found = repeats_of_array(
                    done.column("bytes").to_pylist(), done.column("doc").to_numpy(), done.column("begin").to_numpy(), length
                )
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["doc", "begin", "end"])
            held = table.slice(end).to_batches()
            size = sum(b.nbytes for b in held)

        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                held.append(batch.slice(at, 8192))
                size += held[-1].nbytes
                if size >= array_bytes:
                    yield from flush(False)
        if held:
            yield from flush(True)

    ordered = fragments.repartition("anchor").sortWithinPartitions("anchor", "doc", "begin")
    return ordered.mapInArrow(run, "doc long, begin long, end long")


def count_windows(fragments: DataFrame, length: int) -> DataFrame:
    """Repeated bytes of ``fragments`` of hot anchors: every window by its hash, equal ones combined
    before they are shuffled. Windows are compared as 64-bit hashes beside the anchor's."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, doc, begin = (batch.column(i).to_numpy() for i in range(3))
            for first, last, data, bounds in text_blocks(batch.column(3)):
                counts = np.maximum(np.diff(bounds) - length + 1, 0)
                starts = ragged(bounds[:-1], counts)
                row = np.repeat(np.arange(last - first), counts)
                hashes = RangeHash(data)(starts, starts + length)
                place = begin[first:last][row] + starts - bounds[row]
                columns = [anchor[first:last][row], signed(hashes), doc[first:last][row], place]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "window", "doc", "begin"])

    windows = fragments.select("anchor", "doc", "begin", "bytes").mapInArrow(run, "anchor long, window long, doc long, begin long")
    lead = windows.groupBy("anchor", "window").agg(F.min(F.struct("doc", "begin")).alias("lead"), F.count(F.lit(1)).alias("n"))
    lead = lead.where("n > 1").select("anchor", "window", "lead")
    again = windows.join(lead, ["anchor", "window"]).where(F.struct("doc", "begin") != F.col("lead"))
    return again.select("doc", "begin", (F.col("begin") + length).alias("end"))


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed for the shuffle; a null text as an empty one."""

    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [coder.compress((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "packed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(shrink, "doc_id long, packed binary")


def repeated_bytes(
    docs: DataFrame, length: int = 100, array_bytes: int = ARRAY_BYTES, hot_fragments: int = HOT_FRAGMENTS
) -> DataFrame:
    """Rows (doc, begin, end) whose union is every byte that a string of ``length`` bytes covers which
    also starts earlier, in a smaller doc_id or further ahead in the same document."""
    settled = stored(settle_fragments(gather_fragments(docs, length), length), "settled")
    asked = settled.where("anchor is not null")
    by_doc = asked.groupBy("doc").agg(F.collect_list(F.struct("anchor", "begin", "end")).alias("asked"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for doc, packed, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = coder.decompress(packed)
                for w in wanted:
                    for column, value in zip(rows, (w["anchor"], doc, w["begin"], text[w["begin"] : w["end"]])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in rows[:3]), pa.array(rows[3], pa.binary())], ["anchor", "doc", "begin", "bytes"]
            )

    joined = by_doc.join(_packed(docs), by_doc["doc"] == F.col("doc_id")).select("doc", "packed", "asked")
    fragments = stored(joined.mapInArrow(cut, "anchor long, doc long, begin long, bytes binary"), "fragments")
    hot = stored(asked.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_fragments).select("anchor"), "hot")
    found = settled.where("anchor is null").select("doc", "begin", "end")
    found = found.unionByName(compare_fragments(fragments.join(hot, "anchor", "left_anti"), length, array_bytes))
    return found.unionByName(count_windows(fragments.join(hot, "anchor", "left_semi"), length))


def remove_repeats(
    docs: DataFrame, length: int = 100, array_bytes: int = ARRAY_BYTES, hot_fragments: int = HOT_FRAGMENTS, with_bytes: bool = False
) -> DataFrame:
    """Every document's n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256, and with
    ``with_bytes`` also ``kept``: the bytes that are left, in order.

    Texts are UTF-8; a null text is empty. Matches never cross documents; strings are judged on the
    input, not on what is left. Rows of one doc_id are one document: the same places go in each. Rows
    with a null doc_id are left whole and are nobody's earlier copy.
    """
    found = repeated_bytes(docs, length, array_bytes, hot_fragments)
    by_doc = found.groupBy("doc").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    form = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc, packed, begins, ends in zip(*(batch.column(i) for i in range(4))):
                text = coder.decompress(packed.as_py())
                n = len(text)
                kept, removed, runs = text, 0, 0
                if begins.is_valid:
                    edges = np.bincount(np.minimum(np.asarray(begins.values), n), minlength=n + 1)
                    edges = edges - np.bincount(np.minimum(np.asarray(ends.values), n), minlength=n + 1)
                    gone = np.cumsum(edges[:n]) > 0
                    removed = int(gone.sum())
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                row = [doc.as_py(), n, removed, runs, hashlib.sha256(kept).hexdigest()]
                rows.append(row + [kept] if with_bytes else row)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_bytes]
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    joined = _packed(docs).join(by_doc, F.col("doc_id") == by_doc["doc"], "left")
    return joined.select("doc_id", "packed", "begins", "ends").mapInArrow(cut, form)
