"""Toxicity of documents: word n-grams and skip-grams, weights learned from labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.kernels import ALNUM
from tidings.llm.linear import Ftrl, Model, below, fold, known_labels, score, train, word_features

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.5
PARAMETERS = Ftrl()
FEATURES = word_features(ALNUM, lower=True, order=2, skips=2)


def train_toxicity(docs: DataFrame, labels: DataFrame, p: Ftrl = PARAMETERS) -> Model:
    """A model of ``labels.toxic`` from the documents outside the held-out fold.

    Only texts are features. Words are runs of letters and digits; the features present count,
    not how often, so that one insult weighs the same in a long text.
    """
    known = known_labels(labels, "toxic").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    return train(docs, known, FEATURES, p)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5) of every document.

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


def drop_toxic(docs: DataFrame, labels: DataFrame, p: Ftrl = PARAMETERS) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns.

    Whole rows go through the scoring, so equal rows and null ids need no join. ``text`` is a string.
    """
    return below(docs, train_toxicity(docs, labels, p), FEATURES, THRESHOLD)
