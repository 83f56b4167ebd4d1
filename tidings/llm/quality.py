"""Quality of documents: n-grams of words and marks, weights learned from labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.kernels import TEXT_AND_MARKS
from tidings.llm.linear import Ftrl, Model, fold, known_labels, score, train, word_features

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
PARAMETERS = Ftrl(proofs=(2.5,))
FEATURES = word_features(TEXT_AND_MARKS, lower=False, order=2, skips=0)


def train_quality(docs: DataFrame, labels: DataFrame, p: Ftrl = PARAMETERS) -> Model:
    """A model of ``labels.quality`` from the documents outside the held-out fold.

    Only texts are features. Runs of letters and digits and runs of other marks are words of
    their own, and case matters: shouting and symbol noise are what quality is about.
    """
    known = known_labels(labels, "quality").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    return train(docs, known, FEATURES, p)


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.7) of every document.

    A document without words gets the score of the intercept, or 0 where nothing was learned. A
    null doc_id is not held out.
    """
    scored = score(docs, model, FEATURES, "doc_id")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
