"""Benchmark decontamination by a positional inverted index over the documents.

The index is partitioned by documents: every shard holds, for the terms that benchmark items use,
the ascending positions of their tokens in the shard's documents, as one stored row. A phrase is
found by intersecting offset-adjusted postings, from the term that is rarest in the whole corpus
to the most frequent one. Nothing is shuffled but term counts and results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.kernels import ALNUM, Words, ragged, signed, text_blocks
from tidings.llm.tables import stored

#: Windows of benchmark items searched at once: they are broadcast, about 250 bytes each.
BLOCK_WINDOWS = 100_000
#: Terms that may be broadcast to thin out the index (40 MB); beyond them it holds all terms.
INDEX_TERMS = 5_000_000

_INDEX = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("terms", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("positions", T.BinaryType()),
        T.StructField("names", T.ArrayType(T.LongType())),
        T.StructField("firsts", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
    ]
)
_ITEMS = "item_id string, window int, terms array<long>"


def item_windows(items: DataFrame, size: int = 10) -> DataFrame:
    """The windows of ``items`` (item_id, text): item_id as text, window, and the terms in order.

    A window is ``size`` consecutive words; an item of fewer words, but not none, is one window.
    Terms are 64-bit hashes of lower-cased words. Null texts and items without words give none. Items
    without an item_id are one item, whose id is the empty text.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(1)):
                words = Words(data, bounds, ALNUM)
                n = np.where(words.counts > 0, np.maximum(words.counts - size + 1, 1), 0)
                length = np.repeat(np.minimum(words.counts, size), n)
                window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(words.firsts[:-1], n) + window
                terms = pa.array(signed(words.hashes[ragged(start, length)]))
                offsets = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
                names = batch.column(0).slice(first, last - first).take(pa.array(np.repeat(np.arange(last - first), n)))
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(window, pa.int32()), pa.ListArray.from_arrays(offsets, terms)], ["item_id", "window", "terms"]
                )

    named = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    return items.select(named, F.col("text").cast("string")).mapInArrow(cut, _ITEMS)


def build_index(docs: DataFrame, terms: np.ndarray | None) -> DataFrame:
    """One row for each shard of some megabytes of text: postings of ``terms`` (None: of all
    words), and its documents.

    ``names`` are the doc_ids, ``firsts`` the positions of their first words and ``sizes`` their
    numbers of words; between two documents one position is left out, so that no phrase crosses.
    Every document is in the index once, also one without words. ``terms`` are broadcast.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(None if terms is None else np.unique(terms.view(np.uint64)))

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shard = wanted.value, TaskContext.get().partitionId() << 32
        if known is not None:
            sieve = np.zeros(1 << 20, bool)
            sieve[(known >> np.uint64(44)).astype(np.int64)] = True
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(1)):
                words = Words(data, bounds, ALNUM)
                starts = words.firsts[:-1] + np.arange(last - first)
                if known is None:
                    place = np.arange(len(words.hashes))
                    used, at = np.unique(words.hashes, return_inverse=True)
                else:
                    place = np.flatnonzero(sieve[(words.hashes >> np.uint64(44)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(known, words.hashes[place]), max(len(known) - 1, 0))
                    there = known[at] == words.hashes[place] if len(known) else np.zeros(len(place), bool)
                    used, place, at = known, place[there], at[there]
                order = np.argsort(at.astype(np.uint16) if len(used) < 1 << 16 else at, kind="stable")
                met, counts = np.unique(at, return_counts=True)
                positions = (place + words.texts[place])[order].astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int64()),
                        pa.array([signed(used[met])], pa.list_(pa.int64())),
                        pa.array([counts], pa.list_(pa.int64())),
                        pa.array([positions.tobytes()], pa.binary()),
                        pa.array([batch.column(0).slice(first, last - first).to_pylist()], pa.list_(pa.int64())),
                        pa.array([starts], pa.list_(pa.int64())),
                        pa.array([words.counts], pa.list_(pa.int64())),
                    ],
                    _INDEX.names,
                )
                shard += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(index, _INDEX)


class Windows:
    """Windows to search for, their terms from the rarest to the most frequent."""

    def __init__(self, windows: pa.Table, totals: pa.Table):
        self.items = np.asarray(windows.column("item_id").to_pylist(), object)
        terms = windows.column("terms").combine_chunks()
        self.lengths = np.diff(np.asarray(terms.offsets)).astype(np.int64)
        flat = np.asarray(terms.values.slice(terms.offsets[0].as_py())).view(np.uint64)[: self.lengths.sum()]
        row = np.repeat(np.arange(len(self.lengths)), self.lengths)
        offset = np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        known, n = totals.column("term").to_numpy(), totals.column("n").to_numpy()
        order = np.argsort(known)
        known, n = np.append(known[order], 0), np.append(n[order], 0)
        at = np.minimum(np.searchsorted(known[:-1], signed(flat)), len(known) - 1)
        frequency = np.where(known[at] == signed(flat), n[at], 0)
        order = np.lexsort((offset, frequency, row))
        self.terms, self.offsets = flat[order], offset[order]
        self.firsts = np.cumsum(self.lengths) - self.lengths
        # A window with a term that no document has cannot occur.
        self.possible = np.flatnonzero(frequency[order][self.firsts] > 0) if len(flat) else np.empty(0, np.int64)


def intersect(terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Window and start position of every exact occurrence in one shard."""
    ends = np.cumsum(counts)
    postings = (np.repeat(np.arange(len(terms), dtype=np.uint64), counts) << np.uint64(32)) | positions.astype(np.uint64)

    def term_at(wanted: np.ndarray) -> np.ndarray:
        if not len(terms):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
        return np.where(terms[at] == wanted, at, -1)

    w = windows.possible
    # Each window's terms must all be in the shard before its rarest list is opened.
    here = term_at(windows.terms) if len(w) else np.empty(0, np.int64)
    if len(w):
        w = w[np.minimum.reduceat(here, windows.firsts)[w] >= 0]
    if not len(w):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rarest = here[windows.firsts[w]]
    found = np.repeat(w, counts[rarest])
    start = positions[ragged((ends - counts)[rarest], counts[rarest])].astype(np.int64) - windows.offsets[windows.firsts[found]]
    for k in range(1, int(windows.lengths[w].max())):
        more = windows.lengths[found] > k
        place = windows.firsts[found] + np.where(more, k, 0)
        key = (here[place].astype(np.uint64) << np.uint64(32)) | np.maximum(start + windows.offsets[place], 0).astype(np.uint64)
        at = np.minimum(np.searchsorted(postings, key), len(postings) - 1)
        same = ~more | (postings[at] == key)
        found, start = found[same & (start >= 0)], start[same & (start >= 0)]
    return found, start


def near(
    terms: np.ndarray,
    counts: np.ndarray,
    positions: np.ndarray,
    windows: Windows,
    span: int,
    firsts: np.ndarray,
    sizes: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Windows all of whose terms are, in the same document, within ``span`` words of a posting of
    the rarest, in any order; and the positions of those postings."""
    ends = np.cumsum(counts)
    postings = (np.repeat(np.arange(len(terms), dtype=np.uint64), counts) << np.uint64(32)) | positions.astype(np.uint64)
    w = windows.possible
    if not len(terms) or not len(w):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(terms, windows.terms), len(terms) - 1)
    here = np.where(terms[at] == windows.terms, at, -1)
    w = w[np.minimum.reduceat(here, windows.firsts)[w] >= 0]
    rarest = here[windows.firsts[w]]
    found = np.repeat(w, counts[rarest])
    place = positions[ragged((ends - counts)[rarest], counts[rarest])].astype(np.int64)
    for k in range(1, int(windows.lengths[w].max(initial=1))):
        more = windows.lengths[found] > k
        term = here[windows.firsts[found] + np.where(more, k, 0)].astype(np.uint64) << np.uint64(32)
        doc = np.searchsorted(firsts, place, "right") - 1
        first = np.maximum(place - span, firsts[doc])
        last = np.minimum(place + span, firsts[doc] + sizes[doc] - 1)
        low = np.searchsorted(postings, term | first.astype(np.uint64))
        high = np.searchsorted(postings, term | last.astype(np.uint64), "right")
        found, place = found[~more | (high > low)], place[~more | (high > low)]
    return found, place


_HITS = "shard long, document int, items array<string>, runs array<array<int>>"


def _search(index: DataFrame, windows: Windows, span: int | None) -> DataFrame:
    """Of every document that a window hits: the items, and the runs of words that are hit."""
    sent = index.sparkSession.sparkContext.broadcast(windows)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                terms, counts, firsts, sizes = (np.asarray(row[c], np.int64) for c in ("terms", "counts", "firsts", "sizes"))
                terms, positions = terms.view(np.uint64), np.frombuffer(row["positions"], "<i4")
                if span is None:
                    found, start = intersect(terms, counts, positions, wanted)
                    length = wanted.lengths[found]
                else:
                    found, start = near(terms, counts, positions, wanted, span, firsts, sizes)
                    length = np.ones(len(found), np.int64)
                if not len(found):
                    continue
                doc = np.searchsorted(firsts, start, "right") - 1
                items: dict[int, set[str]] = {}
                for d, w in zip(doc.tolist(), found.tolist()):
                    items.setdefault(d, set()).add(wanted.items[w])
                total = int(firsts[-1] + sizes[-1]) + 1
                covered = np.cumsum(np.bincount(start, minlength=total + 1) - np.bincount(start + length, minlength=total + 1)) > 0
                edge = np.flatnonzero(np.diff(covered, prepend=False, append=False)).reshape(-1, 2)
                owner = np.searchsorted(firsts, edge[:, 0], "right") - 1
                hit = sorted(items)
                runs = [edge[owner == d].tolist() for d in hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(hit), pa.int64()),
                        pa.array(hit, pa.int32()),
                        pa.array([sorted(items[d]) for d in hit], pa.list_(pa.string())),
                        pa.array(runs, pa.list_(pa.list_(pa.int32()))),
                    ],
                    ["shard", "document", "items", "runs"],
                )

    return index.mapInArrow(search, _HITS)


def find_items(
    docs: DataFrame, items: DataFrame, size: int = 10, span: int | None = None, block: int = BLOCK_WINDOWS, terms: int = INDEX_TERMS
) -> DataFrame:
    """Every document with the words that benchmark windows hit, and the items that hit it.

    Columns: doc_id, n_words, n_hit (words inside any occurrence), n_items, items (item ids as
    sorted text). With ``span``, proximity instead of exact phrases: a window matches where all its
    terms are within ``span`` words of its rarest term, whose posting is the word that is hit.

    Words are runs of ASCII letters, digits and anything beyond ASCII; A-Z are lower-cased. A null
    or empty text has no words. Equal rows stay rows of their own. An empty benchmark hits nothing.
    The windows are searched in blocks of about ``block`` in one stored index; its terms are those
    of the benchmark, or all where the benchmark has more than ``terms``.
    """
    windows = stored(item_windows(items, size).dropDuplicates(["item_id", "terms"]), "windows")
    blocks = max(1, -(-windows.count() // block))
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    few = vocabulary.count() <= terms
    index = stored(build_index(docs, vocabulary.toArrow().column(0).to_numpy() if few else None), "index")
    postings = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("t.*")
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("item_id", "window"), F.lit(blocks)))
    hits = None
    for k in range(blocks):
        part = dealt.where(F.col("block") == k).drop("block")
        own = part.select(F.explode("terms").alias("term")).distinct()
        totals = postings.withColumnRenamed("terms", "term").join(F.broadcast(own), "term")
        totals = totals.groupBy("term").agg(F.sum("counts").alias("n"))
        found = _search(index, Windows(part.toArrow(), totals.toArrow()), span)
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy("shard", "document").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
    )
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(a: Column, run: Column) -> Column:
        fresh = F.greatest(run[1] - F.greatest(run[0], a["end"]), F.lit(0))
        return F.struct(F.greatest(run[1], a["end"]).alias("end"), (a["n"] + fresh).alias("n"))

    hits = hits.withColumn("n_hit", F.aggregate("runs", empty, add)["n"]).drop("runs")
    documents = index.select("shard", F.posexplode(F.arrays_zip("names", "sizes")).alias("document", "d"))
    return documents.join(hits, ["shard", "document"], "left").select(
        F.col("d.names").alias("doc_id"),
        F.col("d.sizes").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def items_digest(items: str = "items") -> Column:
    """Hex SHA-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` that no benchmark window hits, with all their columns.

    Rows are searched under a 64-bit hash of their doc_id and text, so that a row goes for its own
    text only, whatever rows share its doc_id or have none.
    """
    marked = F.xxhash64(F.col("doc_id").cast("string"), F.lit("text"), F.col("text").cast("string"))
    hit = find_items(docs.select(marked.alias("doc_id"), "text"), items, size).where(F.col("n_hit") > 0)
    return docs.join(hit.select(F.col("doc_id").alias("hit_mark")).distinct(), marked == F.col("hit_mark"), "left_anti")
