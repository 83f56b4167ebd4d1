"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm.chat import fit_chain, hide_roles, recover_turns
from tidings.llm.clusters import cluster, with_inertia
from tidings.llm.decontamination import find_items, items_digest
from tidings.llm.linear import fold
from tidings.llm.lines import drop_boilerplate
from tidings.llm.mixing import mix_sources
from tidings.llm.near_duplicates import near_duplicates
from tidings.llm.packing import pack_documents
from tidings.llm.quality import score_quality, train_quality
from tidings.llm.rules import judge
from tidings.llm.suffixes import remove_repeats
from tidings.llm.tokens import read_tokenizer, token_counts
from tidings.llm.toxicity import score_toxicity, train_toxicity
from tidings.llm.trie import prefix_trie, rebuilt_turns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    """The JSON of the public tokenizer that the queries use."""
    import public_tokenizers

    return read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of at most 1024 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack_documents(docs, tokenizer()).select(columns)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations``, found again in transcripts with missing speaker markers.

    The chain is learned from the roles of conversations whose crc32 modulo 5 is not 0.
    """
    messages = hide_roles(table(spark, sf_dir, "conversations"))
    chain = fit_chain(messages.where(fold(F.col("conv_id"), 5) != 0))
    return recover_turns(messages.select("conv_id", "turn", "text"), chain)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those that its source repeats as boilerplate, and what is left."""
    cleaned = drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that a repeated string of 100 bytes covers, as a digest."""
    return remove_repeats(table(spark, sf_dir, "documents"), 100)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histogram of ``documents`` with its suffix sums, one row for each length."""
    return token_counts(table(spark, sf_dir, "documents"), tokenizer())


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near duplicates, by shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's figures and whether it and its source pass the rules."""
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *figures, "base_failed", "kept", "host_kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside occurrences of ten-word windows of ``benchmark``."""
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words and how many of them a mix of all sources by weight takes."""
    mixed = mix_sources(table(spark, sf_dir, "documents"), max_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of ``conversations``, each of which begins with up to eight turns of the first of its five."""
    conv_id = F.col("conv_id")
    borrowed = F.crc32(conv_id.cast("string").cast("binary")) % 9
    return prefix_trie(*rebuilt_turns(table(spark, sf_dir, "conversations"), borrowed, conv_id - conv_id % 5, most=8))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's centroid after ten rounds, its distance, and the inertia."""
    return with_inertia(cluster(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_decontamination": op10_decontamination,
    "op11_source_mix": op11_source_mix,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_centroid_clusters": op13_centroid_clusters,
}
