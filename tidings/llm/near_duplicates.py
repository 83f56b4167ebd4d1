"""Near-duplicate documents: b-bit MinHash signatures, joined by Hamming distance, links confirmed.

Signatures have 64 components of 32 bits in 16 chunks of 4. Two signatures that differ in at most
31 components have, by the pigeonhole principle, a chunk that differs in at most one; so every
chunk is indexed four times, each time with one component left out, and all pairs within that
distance meet under some key. Of documents as similar as 0.8 about one pair in ten millions is
farther apart. What meets within the distance is confirmed on full shingle sets.

Equal sets are one class from the start. A group of near copies meets under many keys, so it is
not taken apart into pairs. First every class is compared with one other only, the most central
member of the keys that it shares; the links found join most of what is similar. Members of a key
that are still in different components, and within the distance, are then compared in blocks of
documents, and a pair of blocks gives the links that join components, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.graph import components
from tidings.llm.kernels import SPACED, Words, grams, mix, seeds, signed, text_blocks
from tidings.llm.tables import stored, stored_alone

#: Two errors in each of 16 chunks take 32 differing components; with 31 one chunk has one at most.
COMPONENTS, CHUNK, DISTANCE = 64, 4, 31
#: Bytes of text whose shingles are made at once.
SIGN_BYTES = 1 << 19
#: Rows with texts that a Python worker gets at once.
TEXT_ROWS = 1000
#: Members of a key that one task compares with each other at once.
BLOCK_MEMBERS = 1024
#: Texts of a block; a task confirms two blocks at a time.
BLOCK_TEXTS = 256


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    words = Words(data, bounds, SPACED)
    all_grams = grams(words.hashes, size, 21)
    sets = []
    for first, n in zip(words.firsts[:-1].tolist(), words.counts.tolist()):
        if n >= size:
            sets.append(np.unique(all_grams[first : first + n - size + 1]))
        elif n:
            sets.append(grams(words.hashes[first : first + n], n, 40 + n))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _signatures(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The smallest hash of each set under each of the hash functions, its upper 32 bits."""
    out = np.empty((len(firsts), COMPONENTS), np.uint32)
    for j, (flip, factor) in enumerate(zip(seeds(COMPONENTS, 31), seeds(COMPONENTS, 32))):
        out[:, j] = np.minimum.reduceat((((values ^ flip) * factor) >> np.uint64(32)).astype(np.uint32), firsts)
    return out


_SIGNED = (
    "row long, doc_id long, mark_a long, mark_b long, n_shingles long, set_a long, set_b long, signature binary, packed binary"
)


def marks(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that tell rows apart by doc_id and text; equal rows have equal ones."""
    told = [doc_id.cast("string"), F.lit("text"), text.cast("string")]
    return [F.xxhash64(*told).alias("mark_a"), F.xxhash64(*told[::-1]).alias("mark_b")]


def sign(docs: DataFrame, size: int = 4) -> DataFrame:
    """For each row its number, doc_id and :func:`marks`, n_shingles, a 128-bit hash of the shingle set,
    the signature (null if empty) and the text, compressed for later shuffles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(4), SIGN_BYTES):
                sets = shingle_sets(data, bounds, size)
                counts = np.fromiter(map(len, sets), np.int64, len(sets))
                full = np.flatnonzero(counts)
                values = np.concatenate(sets) if len(full) else np.empty(0, np.uint64)
                firsts = (np.cumsum(counts) - counts)[full]
                hashes = np.zeros((2, len(sets)), np.uint64)
                signatures: list[bytes | None] = [None] * len(sets)
                packed: list[bytes | None] = [None] * len(sets)
                if len(full):
                    for k, flip in enumerate(seeds(2, 33)):
                        hashes[k, full] = np.add.reduceat(mix(values ^ flip), firsts)
                    for i, row in zip(full.tolist(), _signatures(values, firsts)):
                        signatures[i] = row.astype("<u4").tobytes()
                        packed[i] = coder.compress(data[bounds[i] : bounds[i + 1]].tobytes())
                kept = [batch.column(i).slice(first, last - first) for i in range(4)]
                found = [counts, signed(hashes[0]), signed(hashes[1])]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *map(pa.array, found), pa.array(signatures, pa.binary()), pa.array(packed, pa.binary())],
                    ["row", "doc_id", "mark_a", "mark_b", "n_shingles", "set_a", "set_b", "signature", "packed"],
                )

    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"), *marks(doc_id, text), text.alias("text"))
    return rows.mapInArrow(run, _SIGNED)


def chunk_keys(classes: DataFrame) -> DataFrame:
    """(key, id): for each class its chunks, each with one component left out in turn."""
    salts = seeds(COMPONENTS, 34)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            parts = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(n, COMPONENTS).astype(np.uint64)
            mixed = mix(parts * np.uint64(0x9E3779B97F4A7C15) ^ salts).reshape(n, -1, CHUNK)
            whole = mixed.sum(axis=2, dtype=np.uint64)
            keys = mix((whole[:, :, None] - mixed).reshape(n, COMPONENTS) ^ salts)
            ids = np.repeat(batch.column(0).to_numpy(), COMPONENTS)
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys.ravel())), pa.array(ids)], ["key", "id"])

    return classes.select("id", "signature").mapInArrow(run, "key long, id long")


#: Bits of the sieve of ids: 8 MB, whatever the number of ids.
SIEVE_BITS = 26


def _slot(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64)) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def sieved(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` (id, packed) that may be among ``ids`` (id), and few others.

    A bit map of a fixed size is broadcast, so that texts which no pair needs are not shuffled. It is
    only a sieve: a join on the id follows.
    """

    def slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                slot = np.unique(_slot(batch.column(0).to_numpy()))
                word, first = np.unique(slot >> 6, return_index=True)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (slot & 63).astype(np.uint64), first)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(signed(bits))], ["word", "bits"])

    words = ids.select("id").mapInArrow(slots, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    sent = texts.sparkSession.sparkContext.broadcast(bits)

    def sift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slot(batch.column(0).to_numpy())
            there = (sent.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(there.astype(bool)))

    return texts.select("id", "packed").mapInArrow(sift, "id long, packed binary")


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose texts' full sets overlap by ``percent``: 100 |A and B| >= percent |A or B|.

    ``texts`` (id, packed) travel compressed, once for each end of a pair.
    """

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()

        def shingles(packed: bytes) -> np.ndarray:
            text = coder.decompress(packed)
            return shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]), size)[0]

        last, known = None, np.empty(0, np.uint64)
        for batch in batches:
            passed = np.zeros(batch.num_rows, bool)
            packed_a, packed_b = batch.column(2), batch.column(3)
            for i, b in enumerate(batch.column(1).to_pylist()):
                if b != last:
                    last, known = b, shingles(packed_b[i].as_py())
                other = shingles(packed_a[i].as_py())
                both = len(known) + len(other)
                common = both - len(np.union1d(known, other))
                passed[i] = 100 * common >= percent * (both - common) > 0
            kept = pa.array(np.flatnonzero(passed))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], ["a", "b"])

    texts = sieved(texts, pairs.select(F.explode(F.array("a", "b")).alias("id")))
    one, two = (texts.select(F.col("id").alias(c), F.col("packed").alias(f"packed_{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "packed_a", "packed_b").mapInArrow(check, "a long, b long")


def block_pairs(members: DataFrame, distance: int = DISTANCE, slice_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Distinct (one, two) of the blocks of ``members`` (key, id, component, block, signature) that
    need a comparison: somewhere they share a key in different components, within ``distance``.

    Keys of many members are looked at slice by slice, every two slices in a group of their own,
    so that no task gets more than two slices at once and no pair is left out. What leaves a group
    is blocks, never its pairs.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / slice_members).cast("int").alias("slices"))
    dealt = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("id"), "slices").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    dealt = dealt.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "component", "block", "signature"
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def group(rows: pa.Table) -> set[tuple[int, int]]:
            parts, blocks = (rows.column(c).to_numpy() for c in ("component", "block"))
            if (parts == parts[0]).all():
                return set()
            marks = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<u4").reshape(len(parts), COMPONENTS)
            found: set[tuple[int, int]] = set()
            for i in range(len(parts) - 1):
                j = np.flatnonzero(parts[i + 1 :] != parts[i]) + 1 + i
                if len(j):
                    j = j[(marks[j] != marks[i]).sum(axis=1) <= distance]
                    own = int(blocks[i])
                    found.update((min(own, k), max(own, k)) for k in np.unique(blocks[j]).tolist())
            return found

        rest = None
        for batch in _closed(batches):
            table = rest if batch is None else pa.Table.from_batches([batch])
            if batch is not None and rest is not None:
                table = pa.concat_tables([rest, table])
            if table is None or not table.num_rows:
                continue
            marks = [table.column(c).to_numpy() for c in ("key", "low", "high")]
            cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in marks], axis=0)) + 1
            edges = [0, *cuts.tolist(), table.num_rows]
            whole = edges if batch is None else edges[:-1]
            rest = None if batch is None else table.slice(edges[-2])
            found = sorted(set().union(*(group(table.slice(x, y - x)) for x, y in zip(whole[:-1], whole[1:]))))
            if found:
                one, two = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["one", "two"])

    ordered = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "id")
    return ordered.mapInArrow(compare, "one long, two long").distinct()


def confirm_blocks(
    pairs: DataFrame, placed: DataFrame, texts: DataFrame, size: int, percent: int, distance: int = DISTANCE
) -> DataFrame:
    """Links (a, b) that join the components of the documents of each pair of blocks.

    ``placed`` has id, component, block and signature, ``texts`` id and packed. Every text goes once to each pair that its block is
    in; there its set is made once, and sets of different components within ``distance`` are
    compared, nearest signatures first, as long as no other link has joined them. A pair of blocks
    gives fewer links than it has documents.
    """

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()

        def group(rows: pa.Table) -> list[tuple[int, int]]:
            ids, parts, blocks = (rows.column(c).to_pylist() for c in ("id", "component", "block"))
            marks = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<u4").reshape(len(ids), COMPONENTS)
            packed, sets = rows.column("packed"), {}
            above = {p: p for p in parts}

            def root(p: int) -> int:
                while above[p] != p:
                    above[p] = p = above[above[p]]
                return p

            def shingles(i: int) -> np.ndarray:
                if i not in sets:
                    text = coder.decompress(packed[i].as_py())
                    sets[i] = shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]), size)[0]
                return sets[i]

            own, part = np.asarray(blocks), np.asarray(parts)
            near, left, right = [], [], []
            for i in range(len(ids) - 1):
                wanted = part[i + 1 :] != part[i]
                if own[0] != own[-1]:
                    wanted &= own[i + 1 :] != own[i]
                j = np.flatnonzero(wanted) + 1 + i
                far = (marks[j] != marks[i]).sum(axis=1)
                j, far = j[far <= distance], far[far <= distance]
                near.append(far)
                left.append(np.full(len(j), i))
                right.append(j)
            links = []
            if not near:
                return links
            near, left, right = map(np.concatenate, (near, left, right))
            order = np.argsort(near, kind="stable")
            for i, j in zip(left[order].tolist(), right[order].tolist()):
                x, y = root(parts[i]), root(parts[j])
                if x == y:
                    continue
                a, b = shingles(i), shingles(j)
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    continue
                if len(a) < len(b):
                    a, b = b, a
                common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
                if 100 * common >= percent * (len(a) + len(b) - common):
                    above[x] = y
                    links.append((ids[i], ids[j]))
            return links

        rest = None
        for batch in _closed(batches):
            table = rest if batch is None else pa.Table.from_batches([batch])
            if batch is not None and rest is not None:
                table = pa.concat_tables([rest, table])
            if table is None or not table.num_rows:
                continue
            marks = [table.column(c).to_numpy() for c in ("one", "two")]
            cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in marks], axis=0)) + 1
            edges = [0, *cuts.tolist(), table.num_rows]
            whole = edges if batch is None else edges[:-1]
            rest = None if batch is None else table.slice(edges[-2])
            links = [link for x, y in zip(whole[:-1], whole[1:]) for link in group(table.slice(x, y - x))]
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    sides = pairs.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    rows = placed.join(pairs.select(F.explode(F.array("one", "two")).alias("block")).distinct(), "block", "left_semi")
    rows = rows.join(sieved(texts, rows.select("id")), "id").join(sides, "block")
    rows = rows.select("one", "two", "block", "id", "component", "signature", "packed")
    ordered = rows.repartition("one", "two").sortWithinPartitions("one", "two", "block", "id")
    return ordered.mapInArrow(check, "a long, b long")


def _closed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _named(marked: DataFrame, size: int, percent: int) -> DataFrame:
    """Of every class of rows with one set: the set's marks, n_shingles, id, doc_id and component."""
    full = marked.where("n_shingles > 0 and doc_id is not null")
    # A class is named after its first row, since rows of one doc_id may be in several classes.
    classes = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct("doc_id", "row")).alias("top"), F.first("signature").alias("signature"))
    classes = stored(classes.select("set_a", "set_b", "n_shingles", F.col("top.row").alias("id"), F.col("top.doc_id").alias("doc_id"), "signature"), "classes")
    texts = marked.select(F.col("row").alias("id"), "packed")
    keys = chunk_keys(classes)
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(keys.join(sizes, "key"), "shared")
    # The member that meets most others under its keys is what near copies were made from, if anything is.
    weights = shared.groupBy("id").agg(F.sum("n").alias("weight"))
    met = shared.select("key", "id").join(weights, "id")
    centers = met.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("c"))).alias("best"))
    centers = centers.select("key", (-F.col("best.c")).alias("center"))
    votes = shared.join(centers, "key").where("id <> center").groupBy("id", "center").agg(F.count(F.lit(1)).alias("n"))
    chosen = votes.groupBy("id").agg(F.max(F.struct("n", (-F.col("center")).alias("c"))).alias("best"))
    pairs = stored(chosen.select(F.col("id").alias("a"), (-F.col("best.c")).alias("b")), "pairs")
    linked = stored(confirm(pairs, texts, size, percent), "links", TEXT_ROWS)
    first = components(linked)

    # Keys whose members are not all in one component yet, in blocks of what had the same center.
    parts = weights.select("id").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    parts = stored(parts.join(pairs.select(F.col("a").alias("id"), F.col("b").alias("home")), "id", "left"), "parts")
    parts = parts.withColumn("home", F.coalesce("home", "id"))
    joined = shared.select("key", "id").join(parts.select("id", "component"), "id")
    split = joined.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    split = stored(split.where("low < high").select("key"), "split")
    held = parts.groupBy("component").agg(F.count(F.lit(1)).alias("held"))
    sized = parts.join(held, "component").withColumn("settled", F.when(F.col("held") > 1, F.col("component")))
    groups = sized.groupBy("home", "settled").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).alias("blocks"))
    groups = groups.select(F.col("home").alias("g_home"), F.col("settled").alias("g_settled"), "blocks")
    same = (F.col("home") == F.col("g_home")) & F.col("settled").eqNullSafe(F.col("g_settled"))
    placed = sized.join(groups, same).withColumn("slot", F.pmod(F.xxhash64("id"), "blocks"))
    placed = placed.withColumn("block", F.xxhash64("home", "settled", "slot"))
    placed = stored(placed.join(classes.select("id", "signature"), "id").select("id", "component", "block", "signature"), "placed")
    members = shared.select("key", "id").join(split, "key").join(placed, "id")
    blocks = stored(block_pairs(members), "blocks")
    more = stored(confirm_blocks(blocks, placed, texts, size, percent), "links", TEXT_ROWS)
    one, two = (first.select(F.col("id").alias(c), F.col("component").alias(f"{c}_part")) for c in "ab")
    merged = more.join(one, "a", "left").join(two, "b", "left")
    merged = merged.select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b"))
    second = components(merged)

    labels = first.join(second.select(F.col("id").alias("component"), F.col("component").alias("top")), "component", "left")
    labels = labels.select("id", F.coalesce("top", "component").alias("component"))
    lone = second.join(first, "id", "left_anti").select("id", "component")
    named = classes.join(labels.unionByName(lone), "id", "left").withColumn("component", F.coalesce("component", "id"))
    return named.select("set_a", "set_b", "n_shingles", "id", "doc_id", "component")


def _classified(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of every row: doc_id, its marks, n_shingles, component_id, and whether it is ``linked`` to anything
    that has its words and the ``first`` row of its component."""
    marked = stored(sign(docs, size), "signatures", TEXT_ROWS)
    named = stored_alone(lambda: _named(marked, size, percent), "named")
    tops = named.groupBy("component").agg(F.min(F.struct("doc_id", "id")).alias("top"))
    named = named.join(tops, "component").select(
        "set_a", "set_b", "n_shingles", F.col("top.doc_id").alias("component_doc"), F.col("top.id").alias("component_row")
    )
    found = marked.drop("signature", "packed").join(named, ["set_a", "set_b", "n_shingles"], "left")
    linked_row = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return found.select(
        "doc_id",
        "mark_a",
        "mark_b",
        "n_shingles",
        F.when(linked_row, F.col("component_doc")).otherwise(F.col("doc_id")).alias("component_id"),
        linked_row.alias("linked"),
        (F.col("row") == F.col("component_row")).alias("first"),
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Every document's n_shingles, component_id and kept.

    Words are separated by white space, A-Z lower-cased; a document's set is its distinct shingles
    of ``size`` words, or its whole sequence if it has fewer. Documents are linked whose sets
    overlap by ``percent`` or more. component_id is the smallest doc_id that is linked, directly or
    over others; kept says whether that is the document itself. Documents without words (null,
    empty or blank texts) are linked with nothing. Equal rows get equal results; rows of one doc_id
    with different texts are judged each for itself. A null doc_id is linked with nothing, and kept.
    """
    found = _classified(docs, size, percent)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, of its smallest doc_id, with all columns.

    Rows without words or without an id all stay. Rows are told apart by doc_id and text, so that a
    row never goes because of another text under its doc_id. Of rows equal in both one stays; texts
    are shuffled for that only if there are such rows among those that stay.
    """
    found = stored_alone(lambda: _classified(docs, size, percent).where("linked"), "components")
    by_mark = found.groupBy("mark_a", "mark_b").agg(F.max("first").alias("first"), F.count(F.lit(1)).alias("n"))
    by_mark = stored(by_mark.where("not first or n > 1").select(F.col("mark_a").alias("own_a"), F.col("mark_b").alias("own_b"), "first"), "marks")
    mark_a, mark_b = marks(F.col("doc_id").cast("long"), F.col("text"))
    same = (mark_a == F.col("own_a")) & (mark_b == F.col("own_b"))
    left = docs.join(by_mark.where("not first"), same, "left_anti")
    several = by_mark.where("first")
    if several.isEmpty():
        return left
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = docs.join(several, same, "left_semi").groupBy(mark_a, mark_b).agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return left.join(several, same, "left_anti").unionByName(again.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
