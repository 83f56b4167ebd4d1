import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidings.llm.kernels import text_blocks
from tidings.llm.linear import Ftrl, Rows, block_scores, descend, fold, log_loss, places, present
from tidings.llm.quality import score_quality, train_quality
from tidings.llm.toxicity import FEATURES, drop_toxic, score_toxicity, train_toxicity

SF = "/root/testdata/sf0.1"


def _rates(scored, labels, label):
    rows = scored.where("held_out").join(labels, "doc_id").groupBy(F.col(label).alias("y"), F.col("predicted").alias("p")).count()
    return {(r["y"], r["p"]): r["count"] for r in rows.collect()}


def test_toxicity_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = train_toxicity(docs, labels)
    assert 10 < len(model.index) < 20_000
    found = _rates(score_toxicity(docs, model), labels, "toxic")
    assert found.get((0, 1), 0) <= 0.01 * found[0, 0]
    assert found[1, 1] >= 0.55 * (found[1, 1] + found.get((1, 0), 0))


def test_quality_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    found = _rates(score_quality(docs, train_quality(docs, labels)), labels, "quality")
    right = found[1, 1] + found[0, 0]
    assert right >= 0.93 * sum(found.values())


def test_held_out_labels_are_never_learned(spark, make_docs):
    docs = make_docs([(i, f"word{i} common" + " bad" * (i % 2), "s") for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = train_toxicity(docs, labels), train_toxicity(docs, flipped)
    assert len(one.index) and np.array_equal(one.index, two.index) and np.array_equal(one.weight, two.weight)
    scored = {r["doc_id"]: r["predicted"] for r in score_toxicity(docs, one).collect()}
    assert all(scored[i] == i % 2 for i in range(400))


def test_odd_documents_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (7, 0), (99, 1)], "doc_id long, toxic int")
    rows = score_toxicity(odd_docs, train_toxicity(odd_docs, labels)).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = train_toxicity(odd_docs, none)
    assert model.rows == 0 and {r["score"] for r in score_toxicity(odd_docs, model).collect()} == {0.0}
    assert score_quality(no_docs, train_quality(no_docs, none)).count() == 0
    kept = drop_toxic(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_the_sample_is_bounded(spark, make_docs):
    docs = make_docs([(i, "fine" + " bad" * (i % 2), "s") for i in range(2000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    model = train_toxicity(docs, labels, Ftrl(sample_rows=400, shard_rows=100))
    assert 300 < model.rows < 500
    assert {r["predicted"] for r in score_toxicity(docs.where("doc_id % 2 = 1"), model).collect()} == {1}


@pytest.mark.parametrize("folds,rest", [(5, 0), (4, 2)])
def test_folds_follow_crc32_of_the_id_as_text(spark, folds, rest):
    import zlib

    rows = spark.range(50).select("id", fold(F.col("id"), folds).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % folds for r in rows)


def test_evidence_spread_over_shards_adds_up(spark, make_docs):
    texts = [f"plain own{i}" + " calm" * (i % 40 == 1) for i in range(2000)]
    docs = make_docs([(i, text, "s") for i, text in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2000)], "doc_id long, toxic int")
    model = train_toxicity(docs, labels, Ftrl(shard_rows=50))
    calm, plain = [r["score"] for r in score_toxicity(make_docs([(1, "calm", "s"), (2, "plain", "s")]).coalesce(1), model).collect()]
    assert len(model.index) and calm < plain - 0.05


def test_toxicity_recall_by_language(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_toxicity(docs, train_toxicity(docs, labels)).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = scored.where("toxic = 1").groupBy("lang").agg(F.sum("predicted").alias("n"), F.count("*").alias("of")).collect()
    found = {r["lang"]: (r["n"], r["of"]) for r in rows}
    print(found, scored.where("toxic = 0 and predicted = 1").count())
    floors = {"en": 0.8, "fr": 0.6, "de": 0.5, "es": 0.3}
    assert all(found[lang][0] >= floor * found[lang][1] for lang, floor in floors.items())


def _plain_descent(rows, labels, p, epochs, proof, l1):
    """The update formulas over dictionaries, one coordinate at a time."""
    z, n = {}, {}

    def weight(i, bias=False):
        if i not in z:
            return 0.0
        slack = 0.0 if bias else l1 + proof * (p.beta + math.sqrt(n[i])) if proof else l1
        if abs(z[i]) <= slack and not bias:
            return 0.0
        rate = (p.beta + math.sqrt(n[i])) / p.alpha + (0.0 if bias else p.l2)
        return (math.copysign(slack, z[i]) - z[i]) / rate

    order = np.arange(len(rows))
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for r in order.tolist():
            w = {i: weight(i) for i in rows[r]} | {"bias": weight("bias", True)}
            g = 1 / (1 + math.exp(-max(-30, min(30, sum(w.values()))))) - labels[r]
            for i, x in w.items():
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / p.alpha * x
                n[i] = before + g * g
    return z, n


@pytest.mark.parametrize("epochs,proof,l1", [(1, 1.5, 0.0), (6, 0.0, 0.5), (3, 0.0, 0.0)])
def test_descent_against_plain_loops(epochs, proof, l1):
    rng = np.random.default_rng(7)
    p, rows = Ftrl(), [sorted(rng.choice(40, rng.integers(0, 9), replace=False).tolist()) for _ in range(120)]
    labels = np.array([float(3 in r or rng.random() < 0.2) for r in rows])
    flat = Rows(np.array([x for r in rows for x in r], np.int32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
    z, n = descend(flat, np.arange(len(rows)), labels, p, 40, epochs, proof, l1)
    plain_z, plain_n = _plain_descent(rows, labels, p, epochs, proof, l1)
    for i in range(40):
        assert z[i] == pytest.approx(plain_z.get(i, 0.0), abs=1e-9) and n[i] == pytest.approx(plain_n.get(i, 0.0), abs=1e-9)
    assert z[40] == pytest.approx(plain_z["bias"], abs=1e-9)


def test_narrowing_and_losses_against_plain_loops():
    rng = np.random.default_rng(8)
    rows = [sorted(rng.choice(30, rng.integers(0, 7), replace=False).tolist()) for _ in range(50)]
    flat = Rows(np.array([x for r in rows for x in r], np.int32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
    kept = rng.random(30) < 0.5
    less, new = flat.narrowed(places(kept)), {old: i for i, old in enumerate(np.flatnonzero(kept).tolist())}
    w, labels, chosen = rng.normal(size=len(new)), (rng.random(50) < 0.5).astype(float), np.arange(0, 50, 3)
    for i, r in enumerate(rows):
        assert less.at[less.bounds[i] : less.bounds[i + 1]].tolist() == [new[x] for x in r if x in new]
    total = [sum(w[new[x]] for x in r if x in new) + 0.25 for r in rows]
    loss = sum(math.log1p(math.exp(-t if labels[i] else t)) for i, t in enumerate(total) if i % 3 == 0)
    assert log_loss(less, chosen, labels, w, 0.25) == pytest.approx(loss)


def test_scores_against_plain_sums(spark, make_docs):
    texts = ["bad dog", "a fine day, a fine dog", "", "bad bad bad luck and a bad day", None]
    docs = make_docs([(i, f"{texts[i % 2]} n{i % 9}", "s") for i in range(300)])
    model = train_toxicity(docs, spark.createDataFrame([(i, 1 - i % 2) for i in range(300)], "doc_id long, toxic int"))
    weight = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert weight
    for text in texts:
        (_, _, data, bounds), = text_blocks(pa.array([text], pa.string()))
        shown = present(*FEATURES(data, bounds), model.bits, 1).at.tolist()
        plain = 1 / (1 + math.exp(-sum(weight.get(i, 0.0) for i in set(shown)) - model.intercept))
        dense = np.zeros(1 << model.bits, np.float32)
        dense[model.index] = model.weight
        assert block_scores(model, dense, FEATURES, data, bounds)[0] == pytest.approx(plain, rel=1e-6)


def test_dropping_keeps_whole_rows(spark, make_docs):
    rows = [(i if i % 5 else None, "you bad dog" if i % 2 else "a fine day", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    kept = drop_toxic(make_docs(rows), labels).collect()
    assert sorted(((r["doc_id"], r["text"], r["key"]) for r in kept), key=repr) == sorted(((i, t, "clash") for i, t, _ in rows if "fine" in t), key=repr)
