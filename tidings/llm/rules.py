"""Quality rules judged by host: failures counted by host, shrunk, joined back to documents.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.tables import stored

_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_NOT_SYMBOLS = r"[^#*$%&|<>]+"

#: Fewest words of a document; and in percent: most words in repeated windows, most repeated
#: lines; most symbols for 100 words.
MIN_WORDS, MAX_REPEATED, MAX_LINES, MAX_SYMBOLS = 50, 50, 30, 100


def _rules() -> dict[str, Column]:
    """Each rule and when a document fails it."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEATED * n,
        "lines": 100 * F.col("n_dup_lines") > MAX_LINES * F.col("n_lines"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS * n,
    }


def text_figures(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the figures of every whole text, without a shuffle.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word),
    n_dup_lines (such lines equal to an earlier one), n_repeat_words (words in windows of three
    words that the text has twice or more). A null or empty text has none of them. Windows are
    compared as 64-bit hashes of one text. Windows are sorted only in texts that repeat one.
    """
    named = [F.col(c) for c in columns]
    rows = docs.select(F.struct(*named).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "row",
        F.length(F.regexp_replace("text", _NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: F.trim(line, F.lit(_SPACES)) != "").alias("lines"),
        F.filter(F.split("text", _SPACE), lambda word: word != "").alias("words"),
    )
    word = lambda i: F.get("words", i)
    rows = rows.select(
        "row",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= 3,
            F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))),
        ).alias("windows"),
    )
    rows = rows.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("windows")

    def twice(x: Column, i: Column) -> Column:
        return (x["h"] == F.get("ordered", i - 1)["h"]) | (x["h"] == F.get("ordered", i + 1)["h"])

    rows = rows.withColumn("again", F.sort_array(F.transform(F.filter("ordered", twice), lambda x: x["i"]))).drop("ordered")
    rows = rows.withColumn(
        "covered", F.transform("again", lambda x, j: F.least(F.lit(3), F.coalesce(x - F.get("again", j - 1), F.lit(3))))
    ).drop("again")
    total = F.aggregate("covered", F.lit(0), lambda a, b: a + b)
    return rows.select(
        *[F.col(f"row.`{c}`").alias(c) for c in columns],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def host_verdicts(figures: DataFrame, host: str = "host", limit: float = 0.5, strongest: float = 1000.0) -> DataFrame:
    """Hosts with their documents, the shrunk failure rate of each rule, and ``host_kept``.

    For each rule a beta prior is fitted to the hosts' rates by moments: its mean is the rate over
    all documents, its strength (1 to ``strongest``) follows from the variance of the rates,
    weighted by documents. The rate of a host is drawn to the mean by that strength, so that a
    small host is not judged on a few documents. A host is kept if no rate is above ``limit``.
    """
    rules = _rules()
    hosts = figures.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(failed.cast("long")).alias(f"k_{name}") for name, failed in rules.items()]
    )
    sums = hosts.agg(
        F.sum("n_docs").alias("n"),
        *[F.sum(f"k_{name}").alias(f"k_{name}") for name in rules],
        *[F.sum(F.col(f"k_{name}") * F.col(f"k_{name}") / F.col("n_docs")).alias(f"q_{name}") for name in rules],
    ).first()
    rates = {}
    for name in rules:
        n = sums["n"] or 1
        mean = (sums[f"k_{name}"] or 0) / n
        spread = max((sums[f"q_{name}"] or 0.0) / n - mean * mean, 0.0)
        strength = min(max(mean * (1 - mean) / spread - 1, 1.0), strongest) if spread > 1e-12 else strongest
        rates[name] = (F.col(f"k_{name}") + mean * strength) / (F.col("n_docs") + strength)
    judged = hosts.select(host, "n_docs", *[rate.alias(f"rate_{name}") for name, rate in rates.items()])
    return judged.withColumn("host_kept", F.greatest(*[F.col(f"rate_{name}") for name in rules]) <= limit)


def judge(docs: DataFrame, host: str = "source", limit: float = 0.5) -> DataFrame:
    """Every document's figures, ``base_failed``, its host's verdict and ``kept``.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. kept:
    not base_failed and the host kept. A null host is a host of its own (an empty name). Only
    figures leave the texts' tasks: they are stored, counted by host and joined with the verdicts.
    """
    named = docs.select("doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text")
    figures = stored(text_figures(named, "doc_id", "host"), "figures")
    verdicts = host_verdicts(figures, limit=limit).select("host", "host_kept")
    failed = _rules()["short"] | _rules()["repeats"]
    return (
        figures.join(verdicts, "host")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
    )
