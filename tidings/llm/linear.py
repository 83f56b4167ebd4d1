"""Logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Training runs on the workers, from a sample of bounded size; what reaches the driver is sparse
weights of a fixed number of coordinates. Scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.kernels import Words, mix, seeds, text_blocks
from tidings.llm.tables import stored

#: Bytes of text whose features are made at once, some 60 times as much memory.
BLOCK = 1 << 19
#: Ranges of coordinates whose sums are added up side by side.
RANGES = 64
#: Features of a block of texts: for each, its text and its 64-bit hash; texts ascend.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Ftrl:
    """Parameters of training.

    ``bits``: 2**bits coordinates. ``sample_rows``: about so many labelled rows are used at most
    (chosen by a hash of doc_id; all of them where there are fewer). ``shard_rows``: rows that one
    task learns from in the first pass. ``alpha``, ``beta``: the rate of a coordinate falls with
    its own gradients as alpha / (beta + sqrt(sum of squares)). ``proofs``: a coordinate gets a
    weight only if its summed gradients are so many times the root of their squares, an l1 bound
    that scales with the coordinate's rate; of several bounds, ascending, the one with the least
    loss in ``folds`` folds of the learned rows is taken. ``l1``, ``l2``, ``epochs``: regularisation
    and passes of a fit.
    """

    bits: int = 20
    sample_rows: int = 32_000
    shard_rows: int = 2_000
    epochs: int = 6
    alpha: float = 0.5
    beta: float = 1.0
    proofs: tuple[float, ...] = (1.5, 2.0, 2.5, 3.0)
    folds: int = 3
    l1: float = 0.5
    l2: float = 0.1


@dataclass(frozen=True)
class Model:
    """Sparse weights: coordinates, their weights, and the intercept; ``rows`` were learned from."""

    bits: int
    index: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.empty(0, np.float32))
    intercept: float = 0.0
    rows: int = 0


def word_features(inside: np.ndarray, lower: bool, order: int, skips: int) -> Features:
    """Features from words of class ``inside``: n-grams up to ``order``, and pairs with up to
    ``skips`` words left out between them."""
    single, pair, skipped = (int(x) for x in seeds(3, 11))

    def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = Words(data, bounds, inside, lower)
        texts, keys = [words.texts], [mix(words.hashes ^ np.uint64(single))]
        chain = words.hashes
        for n in range(2, order + 1):
            chain = mix(chain[:-1] * np.uint64(pair) + words.hashes[n - 1 :])
            same = words.texts[: len(chain)] == words.texts[n - 1 :]
            texts.append(words.texts[: len(chain)][same])
            keys.append(chain[same])
        for gap in range(2, skips + 2):
            ahead = mix(words.hashes[:-gap] * np.uint64(skipped) + words.hashes[gap:] + np.uint64(gap))
            same = words.texts[:-gap] == words.texts[gap:]
            texts.append(words.texts[:-gap][same])
            keys.append(ahead[same])
        return np.concatenate(texts), np.concatenate(keys)

    return features


def _leader(z: np.ndarray, n: np.ndarray, slack: np.ndarray | float, p: Ftrl) -> np.ndarray:
    """Weights that the sums of gradients ask for; 0 within the slack."""
    return np.where(np.abs(z) <= slack, 0.0, (np.sign(z) * slack - z) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


@dataclass(frozen=True)
class Rows:
    """Coordinates of the features present in each of some texts, one text after the other."""

    at: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def narrowed(self, place: np.ndarray) -> Rows:
        """Without the coordinates whose ``place`` is negative, the others moved to their place."""
        moved = place[self.at]
        kept = moved >= 0
        before = np.zeros(len(kept) + 1, np.int32)
        np.cumsum(kept, dtype=np.int32, out=before[1:])
        return Rows(moved[kept], before[self.bounds])


def places(kept: np.ndarray) -> np.ndarray:
    """For each coordinate its place among those that the mask ``kept`` has, or -1."""
    return np.where(kept, np.cumsum(kept) - 1, -1).astype(np.int32)


def descend(
    rows: Rows, chosen: np.ndarray, labels: np.ndarray, p: Ftrl, size: int, epochs: int, proof: float, l1: float
) -> tuple[np.ndarray, np.ndarray]:
    """Summed gradients and their squares of ``size`` coordinates and, last, of the intercept, from
    the ``chosen`` rows."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = chosen.copy()
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for i in order.tolist():
            x = rows.at[rows.bounds[i] : rows.bounds[i + 1]]
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = _leader(zx, nx, l1 + proof * (p.beta + root) if proof else l1, p)
            b = float(-z[size] / ((p.beta + np.sqrt(n[size])) / p.alpha))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -30, 30))) - labels[i]
            g2 = g * g
            z[x] = zx + g - (np.sqrt(nx + g2) - root) / p.alpha * w
            n[x] = nx + g2
            z[size] += g - (np.sqrt(n[size] + g2) - np.sqrt(n[size])) / p.alpha * b
            n[size] += g2
    return z, n


def fit_proven(rows: Rows, chosen: np.ndarray, labels: np.ndarray, p: Ftrl, size: int) -> tuple[np.ndarray, float]:
    """Weights of the ``size`` proven coordinates, and the intercept."""
    z, n = descend(rows, chosen, labels, p, size, p.epochs, 0.0, p.l1)
    w = _leader(z[:size], n[:size], p.l1, p)
    return w, float(-z[size] / ((p.beta + np.sqrt(n[size])) / p.alpha))


def proven(z: np.ndarray, n: np.ndarray, proof: float, p: Ftrl) -> np.ndarray:
    """Which coordinates have gradients that chance does not explain; all that are told for a bound of 0."""
    return np.abs(z) > proof * (p.beta + np.sqrt(n)) if proof else n > 0


def log_loss(rows: Rows, chosen: np.ndarray, labels: np.ndarray, w: np.ndarray, b: float) -> float:
    """Summed logistic loss over the ``chosen`` rows."""
    total = np.array([w[rows.at[rows.bounds[i] : rows.bounds[i + 1]]].sum() for i in chosen.tolist()]) + b
    return float(np.logaddexp(0, np.where(labels[chosen] > 0, -total, total)).sum())


def present(texts: np.ndarray, keys: np.ndarray, bits: int, n: int) -> Rows:
    """The distinct coordinates of each of ``n`` texts."""
    both = np.unique((texts.astype(np.uint64) << np.uint64(bits)) | (keys >> np.uint64(64 - bits)))
    at = np.searchsorted(both, np.arange(n + 1, dtype=np.uint64) << np.uint64(bits))
    return Rows((both & np.uint64((1 << bits) - 1)).astype(np.int32), at)


def joined(parts: list[Rows]) -> Rows:
    """The texts of all parts, one after the other."""
    before = np.cumsum([0, *[len(x.at) for x in parts]])
    bounds = [x.bounds[1:] + b for x, b in zip(parts, before)]
    return Rows(np.concatenate([np.empty(0, np.int32), *[x.at for x in parts]]), np.concatenate([np.zeros(1, np.int64), *bounds]))


def train(docs: DataFrame, known: DataFrame, features: Features, p: Ftrl) -> Model:
    """A model from the texts of ``docs`` (doc_id, text) whose labels are ``known`` (doc_id, label 0/1).

    Texts may have any length, a null text is an empty one. Of several rows of a doc_id the smallest
    text counts. Labels without a document teach nothing. Nothing to learn from: a model without
    weights, which scores 0 throughout. The labels are thinned out to about ``p.sample_rows`` at
    most before they are broadcast, so only texts of the sample leave their tasks.

    Two passes over the stored sample. In the first, shards of rows, each within one fold, follow
    the leader on their own; their summed gradients and squares add up over the shards, range by range of
    coordinates, and coordinates without proof in the sums get no weight. In the second one task fits the
    rest, from the sample's rows with only those coordinates. Of several bounds one is chosen before: for
    each fold a task proves by the shards of the other folds, fits their rows, and sums the loss over its own.
    """
    total = known.count()
    key = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 40))
    if total > p.sample_rows:
        known = known.where(key < int((1 << 40) * p.sample_rows / total))
    folds = p.folds if len(p.proofs) > 1 else 1
    shards = folds * max(1, -(-(min(total, p.sample_rows) // p.shard_rows) // folds))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")
    rows = texts.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("label").alias("label"))
    sample = stored(rows.select((key % shards).alias("shard"), "text", F.col("label").cast("double").alias("label")), "sample")
    if sample.isEmpty():
        return Model(p.bits)
    size, lowest = 1 << p.bits, min(p.proofs)
    width = -(-size // RANGES)

    def learn(table: pa.Table) -> pa.Table:
        rows = joined([present(*features(d, b), p.bits, j - i) for i, j, d, b in text_blocks(table.column("text"), BLOCK)])
        labels = table.column("label").to_numpy()
        z, n = descend(rows, np.arange(len(rows)), labels, p, size, 1, lowest, 0.0)
        told = [r for r in range(RANGES) if n[: size][r * width : (r + 1) * width].any()]
        parts = [[x[: size][r * width : (r + 1) * width].astype("<f4").tobytes() for r in told] for x in (z, n)]
        fold = np.full(len(told), table.column("shard")[0].as_py() % folds)
        return pa.table({"range": pa.array(told, pa.int32()), "fold": fold, "z": pa.array(parts[0], pa.binary()), "n": pa.array(parts[1], pa.binary())})

    # Sums over all shards (0) and, of several folds, over the shards outside each (1 and up).
    inside = [None, *range(folds)] if folds > 1 else [None]
    names = [f"{c}{j}" for j in range(len(inside)) for c in "zn"]

    def add(table: pa.Table) -> pa.Table:
        fold = table.column("fold").to_numpy()
        shard = {c: [np.frombuffer(x, "<f4").astype(np.float64) for x in table.column(c).to_pylist()] for c in "zn"}
        sums = [sum((x for x, f in zip(shard[c], fold) if f != k), np.zeros(len(shard[c][0]))) for k in inside for c in "zn"]
        some = np.any([proven(z, n, lowest, p) for z, n in zip(sums[::2], sums[1::2])], axis=0)
        index = np.flatnonzero(some)
        return pa.table({"index": index + table.column("range")[0].as_py() * width} | {name: x[index] for name, x in zip(names, sums)})

    told = sample.groupBy("shard").applyInArrow(learn, "range int, fold long, z binary, n binary")
    summed = told.groupBy("range").applyInArrow(add, "index long, " + ", ".join(f"{n} double" for n in names)).toArrow().sort_by("index")
    index = summed.column("index").to_numpy()
    masks = [[proven(summed.column(f"z{j}").to_numpy(), summed.column(f"n{j}").to_numpy(), c, p) for c in p.proofs] for j in range(len(inside))]

    def narrow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(size, -1, np.int32)
        place[index] = np.arange(len(index))
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(1), BLOCK):
                found = present(*features(data, bounds), p.bits, last - first).narrowed(place)
                at = pa.ListArray.from_arrays(pa.array(found.bounds, pa.int32()), pa.array(found.at))
                kept = [batch.column(i).slice(first, last - first) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays([*kept, at], ["shard", "label", "at"])

    few = sample.mapInArrow(narrow, "shard long, label double, at array<int>")

    def narrowed(table: pa.Table, kept: np.ndarray) -> Rows:
        """The rows with the coordinates of the mask, batch by batch, so that the others are never copied."""
        place, parts = places(kept), []
        for at in table.column("at").chunks:
            offsets = at.offsets.to_numpy().astype(np.int64)
            parts.append(Rows(at.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]).narrowed(place))
        return joined(parts)

    def weigh(table: pa.Table) -> pa.Table:
        labels, fold = table.column("label").to_numpy(), table.column("shard").to_numpy() % folds
        k = table.column("trial")[0].as_py()
        own, others = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        losses = []
        for kept in masks[k + 1]:
            less = narrowed(table, kept)
            w, b = fit_proven(less, others, labels, p, int(kept.sum()))
            losses.append(log_loss(less, own, labels, w, b))
        return pa.table({"losses": pa.array([losses], pa.list_(pa.float64()))})

    best = 0
    if folds > 1:
        few = stored(few, "narrowed", 1000)
        trials = few.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        losses = trials.groupBy("trial").applyInArrow(weigh, "losses array<double>").toArrow().column(0).to_pylist()
        lost = np.sum(losses, axis=0)
        best = int(np.flatnonzero(lost <= lost.min())[-1])
    mask = masks[0][best]

    def fit(table: pa.Table) -> pa.Table:
        rows, labels = narrowed(table, mask), table.column("label").to_numpy()
        w, b = fit_proven(rows, np.arange(len(rows)), labels, p, int(mask.sum()))
        return pa.table({"weight": [w], "intercept": [b], "n": [len(rows)]})

    found = few.groupBy().applyInArrow(fit, "weight array<double>, intercept double, n long").first()
    weight, chosen = np.asarray(found["weight"], np.float32), index[mask]
    return Model(p.bits, chosen[weight != 0], weight[weight != 0], found["intercept"], found["n"])


def block_scores(model: Model, dense: np.ndarray, features: Features, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Scores from 0 to 1 of a block of texts: a sparse dot product with the features present."""
    n = len(bounds) - 1
    if not model.rows:
        return np.zeros(n)
    texts, keys = features(data, bounds)
    low = (keys >> np.uint64(64 - model.bits)).astype(np.int64)
    known = np.flatnonzero(dense[low] != 0)
    both = np.unique((texts[known] << model.bits) | low[known])
    total = np.bincount(both >> model.bits, dense[both & ((1 << model.bits) - 1)].astype(np.float64), n)
    return 1 / (1 + np.exp(-np.clip(total + model.intercept, -500, 500)))


def _scorer(docs: DataFrame, model: Model, features: Features) -> Callable[[pa.Array], np.ndarray]:
    """Scores of a column of texts, block by block; the weights are broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts: pa.Array) -> np.ndarray:
        model = sent.value
        dense = np.zeros(1 << model.bits, np.float32)
        dense[model.index] = model.weight
        found = [block_scores(model, dense, features, data, bounds) for _, _, data, bounds in text_blocks(texts, BLOCK)]
        return np.concatenate([np.empty(0), *found])

    return scores


def score(docs: DataFrame, model: Model, features: Features, *columns: str) -> DataFrame:
    """``columns`` of every document and its ``score``; whole texts, null texts as empty ones."""
    scores = _scorer(docs, model, features)
    fields = [docs.schema[c] for c in columns] + [T.StructField("score", T.DoubleType())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(scores(batch.column(len(columns))))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], found], [f.name for f in fields])

    wanted = docs.select(*columns, F.col("text").cast("string").alias("text" if "text" not in columns else "text_"))
    return wanted.mapInArrow(run, T.StructType(fields))


def below(docs: DataFrame, model: Model, features: Features, threshold: float) -> DataFrame:
    """The rows of ``docs`` whose ``text`` scores below the ``threshold``, with all their columns.

    Rows are sent to the workers once, the text among them, and only those that stay come back.
    """
    scores = _scorer(docs, model, features)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at)) < threshold))

    return docs.mapInArrow(run, docs.schema)


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the rows of ``labels`` that have both; of several labels the largest."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.max(F.col(label)).alias("label"))
