"""The registered queries of the package: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, fingerprints, hmm, jaccard, lexical, mixing, packing, rules, substrings, token_counts, toxicity, warc, weak_labels
from .common import fold, ready, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file of the queries' tokenizers; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts_after_edits(table(spark, sf_dir, "documents"), tokenizer_path(), token_counts.sample_edits)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    g = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("l_id"), 5) != 0)
    s = toxicity.score(docs, g)
    return s.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "n_clauses")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    r = rules.apply_rules(docs, rules.learn_rules(docs, table(spark, sf_dir, "labels")))
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = warc.archive_pages(table(spark, sf_dir, "pages"))
    return r.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _ready(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {f.__name__: _ready(f) for f in (op1_hmm_score, op2_jaccard_join, op3_token_counts, op4_fingerprints, op5_packing, op6_weak_labels, op7_toxicity, op8_mixing, op9_rules, op10_warc, op11_alignment, op12_substring_dedup, op13_lexical_search, pipeline)}
