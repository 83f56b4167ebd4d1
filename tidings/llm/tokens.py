"""Encoding of whole texts with a byte-level BPE, and the exact histogram of encoded lengths."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.kernels import RangeHash, ragged, text_blocks
from tidings.llm.tables import stored

#: Cached segments per worker: slots of a direct-mapped table, and the ids after which it starts anew.
SLOTS = 1 << 20
STORE_IDS = 8_000_000

#: What a byte is, as bits: ASCII letter, other mark, printed ASCII, beyond ASCII, lead byte of a
#: character that may be white space (of two, of three bytes), space, line feed.
_LETTER, _MARK, _PRINTED, _WIDE, _TWO, _THREE, _SPACE, _FEED = (np.uint8(1 << i) for i in range(8))
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] |= _LETTER
_KIND[0x21:0x7F] |= _PRINTED
_KIND[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] |= _MARK
_KIND[0x80:] |= _WIDE
_KIND[0xC2] |= _TWO
_KIND[[0xE1, 0xE2, 0xE3]] |= _THREE
_KIND[0x20] |= _SPACE
_KIND[0x0A] |= _FEED
#: The pattern by which byte-level encoders of this family cut texts into pieces (fixed value).
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def segment_begins(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray = _KIND) -> np.ndarray:
    """Places where the pre-tokenizer surely ends one piece and begins another.

    A piece takes a space only in front, letters and marks never share one, and a single line
    feed between printed characters stands alone. So a text may be cut before a space or line
    feed between printed characters, after such a line feed, and between an ASCII letter and a
    mark other than the apostrophe, without changing an id. Where white space beyond ASCII could
    be involved there is no cut.
    """
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[bounds] = True
    if n > 2:
        k = kind[data]
        lead = (k & (_TWO | _THREE)) != 0
        odd = np.zeros(n, bool)
        odd[1:] = (k[:-1] & _TWO) != 0
        odd[2:] |= (k[:-2] & _THREE) != 0
        shown = (k & (_PRINTED | _WIDE)) != 0
        gap = shown[:-2] & ~odd[:-2] & shown[2:] & ~lead[2:] & ((k[1:-1] & (_SPACE | _FEED)) != 0)
        begins[1 : n - 1] |= gap
        begins[2:n] |= gap & ((k[1:-1] & _FEED) != 0)
        begins[1:n] |= ((k[:-1] & _LETTER) != 0) & ((k[1:] & _MARK) != 0)
    return np.flatnonzero(begins[:n])


def _byte_ranks(vocabulary: dict[str, int], merges: list) -> dict[bytes, int] | None:
    """Ranks by bytes where the ids follow the order of the merges, else None."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    parts = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(parts)):
        return None
    known = [c for c in vocabulary if all(x in letters for x in c) and vocabulary[c] < 256 + len(parts)]
    return {bytes(letters[x] for x in c): vocabulary[c] for c in known}


class Encoder:
    """Ids of whole texts. Segments met before are looked up, new ones are encoded.

    The ids are those of the tokenizer's JSON. Where its merges are in the order of their ids, new
    segments go through a faster implementation of the same merges, but for segments that hold one
    of the tokenizer's own added tokens.
    """

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._encoder = Tokenizer.from_str(spec)
        parts = json.loads(spec)
        form = parts.get("pre_tokenizer") or {}
        self._cuts = (
            parts.get("normalizer") is None
            and form.get("type") == "ByteLevel"
            and not form.get("add_prefix_space")
            and form.get("use_regex", True)
            and not any(c.isspace() for token in parts.get("added_tokens", []) for c in token["content"])
        )
        kind = _KIND.copy()
        kind[[b for token in parts.get("added_tokens", []) for b in token["content"].encode()]] &= ~_MARK
        self._kind = kind
        self._special = [token["content"] for token in parts.get("added_tokens", [])]
        self._ordinary = None
        model = parts["model"]
        ranks = _byte_ranks(model["vocab"], model["merges"]) if self._cuts and model["type"] == "BPE" else None
        if ranks:
            import tiktoken

            self._ordinary = tiktoken.Encoding("pieces", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._clear()

    def _encoded(self, texts: list[str], marked: bool) -> list[list[int]]:
        if self._ordinary is None:
            return [e.ids for e in self._encoder.encode_batch_fast(texts, add_special_tokens=False)]
        whole = [i for i, t in enumerate(texts) if any(x in t for x in self._special)] if marked else []
        found = [*map(self._ordinary, texts)]
        for i, e in zip(whole, self._encoder.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
            found[i] = e.ids
        return found

    def _clear(self) -> None:
        self._keys = np.zeros(SLOTS, np.uint64)
        self._sizes = np.zeros(SLOTS, np.int32)
        self._at = np.zeros(SLOTS, np.int64)
        self._lengths = np.zeros(SLOTS, np.int32)
        self._ids = np.empty(1 << 16, np.uint32)
        self._used = 0

    def _put(self, texts: list[str], marked: bool) -> tuple[np.ndarray, np.ndarray]:
        found = self._encoded(texts, marked)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        while self._used + len(flat) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty(len(self._ids), np.uint32)])
        self._ids[self._used : self._used + len(flat)] = flat
        starts = self._used + np.cumsum(lengths) - lengths
        self._used += len(flat)
        return starts, lengths

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts in one array, and how many each text has."""
        if self._used > STORE_IDS:
            self._clear()
        begin = segment_begins(data, bounds, self._kind) if self._cuts else np.unique(bounds[:-1][np.diff(bounds) > 0])
        end = np.append(begin[1:], len(data))[: len(begin)]
        keys = RangeHash(data)(begin, end)
        sizes = (end - begin).astype(np.int32)
        slots = (keys >> np.uint64(13)).astype(np.int64) % SLOTS
        starts, lengths = self._at[slots], self._lengths[slots].astype(np.int64)
        missed = np.flatnonzero((self._keys[slots] != keys) | (self._sizes[slots] != sizes))
        if len(missed):
            _, one, each = np.unique(keys[missed], return_index=True, return_inverse=True)
            one = missed[one]
            raw = data.tobytes()
            new = [raw[b:e].decode("utf-8", "replace") for b, e in zip(begin[one].tolist(), end[one].tolist())]
            at, n = self._put(new, any(x.encode() in raw for x in self._special))
            starts[missed], lengths[missed] = at[each], n[each]
            self._keys[slots[one]], self._sizes[slots[one]] = keys[one], sizes[one]
            self._at[slots[one]], self._lengths[slots[one]] = at, n
        ids = self._ids[ragged(starts, lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(ends[np.searchsorted(begin, bounds)])


_ENCODERS: dict[int, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """The encoder of this worker process for a tokenizer's JSON."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def read_tokenizer(path: str) -> str:
    """The JSON of a tokenizer file, read on the driver and shipped to the workers as text."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def with_length(docs: DataFrame, tokenizer: str, text: Column | str = "text", extra: int = 0) -> DataFrame:
    """One column ``encoded_length`` (long), a row for each document: its ids and ``extra`` more.

    ``tokenizer`` is the JSON of the tokenizer. A null or empty text has no ids.
    """
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(spec.value)
        for batch in batches:
            for _, _, data, bounds in text_blocks(batch.column(0)):
                _, counts = coder.encode(data, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(counts + extra, pa.int64())], ["encoded_length"])

    column = F.col(text) if isinstance(text, str) else text
    return docs.select(column.cast("string").alias("text")).mapInArrow(encode, "encoded_length long")


def length_report(lengths: DataFrame, column: str = "encoded_length", run: int = 1024) -> DataFrame:
    """What every context limit keeps and loses, from the exact histogram of lengths.

    One row for each length that occurs, as a limit: ``n_documents`` and ``n_tokens`` of exactly
    that length; ``documents_over`` and ``tokens_over`` of longer ones (suffix sums);
    ``documents_within`` and ``tokens_within``, those no longer; ``quantile``, the share of
    documents no longer; ``truncated_total``, tokens left when each document is cut to the limit;
    ``tokens_lost``. Between two lengths every total is linear, so these rows answer all limits.
    Null lengths count for nothing; an empty table gives no rows.

    Documents meet only as counts by length, which are stored, so lengths are made once. Sums run
    over runs of ``run`` lengths and then over the runs, so that no task sorts all lengths.
    """
    histogram = lengths.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("long").alias("encoded_length"))
    counted = (
        stored(histogram.agg(F.count(F.lit(1)).alias("n_documents")), "lengths")
        .withColumn("n_tokens", F.col("encoded_length") * F.col("n_documents"))
        .withColumn("run", F.floor(F.col("encoded_length") / run))
    )
    runs = counted.groupBy("run").agg(F.sum("n_documents").alias("run_documents"), F.sum("n_tokens").alias("run_tokens"))
    later = Window.partitionBy(F.lit(0)).orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    runs = runs.select(
        "run",
        F.coalesce(F.sum("run_documents").over(later), F.lit(0)).alias("later_documents"),
        F.coalesce(F.sum("run_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("run_documents").over(every).alias("all_documents"),
        F.sum("run_tokens").over(every).alias("all_tokens"),
    )
    inside = Window.partitionBy("run").orderBy(F.desc("encoded_length")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counted.join(runs, "run")
        .withColumn("documents_over", F.coalesce(F.sum("n_documents").over(inside), F.lit(0)) + F.col("later_documents"))
        .withColumn("tokens_over", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)) + F.col("later_tokens"))
        .withColumn("documents_within", F.col("all_documents") - F.col("documents_over"))
        .withColumn("tokens_within", F.col("all_tokens") - F.col("tokens_over"))
        .withColumn("truncated_total", F.col("tokens_within") + F.col("documents_over") * F.col("encoded_length"))
        .select(
            "encoded_length",
            "n_documents",
            "n_tokens",
            "documents_over",
            "tokens_over",
            "documents_within",
            "tokens_within",
            (F.col("documents_within") / F.col("all_documents")).alias("quantile"),
            "truncated_total",
            (F.col("all_tokens") - F.col("truncated_total")).alias("tokens_lost"),
        )
    )


def token_counts(docs: DataFrame, tokenizer: str, extra: int = 0) -> DataFrame:
    """:func:`length_report` of the encoded lengths of all ``docs`` (column ``text``)."""
    return length_report(with_length(docs, tokenizer, extra=extra))
