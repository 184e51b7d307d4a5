"""The registered queries of this subpackage, over the whole tables they are made for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantiga.llm import align, codes, ctw, leaks, lines, mixing, packing, quality, secrets, simhash, topk, urls, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of one label."""
    return vectors.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by SimHash."""
    return simhash.near_duplicate_texts(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document go into a mix of the sources."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base patterns, and what a trained network adds."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(documents, secrets.learn(documents))


URL_RULES = [
    urls.UrlRule("allow", "com", "/"),
    urls.UrlRule("block", "example.com", "/en/"),
    urls.UrlRule("allow", "www.example.com", "/en/"),
    urls.UrlRule("block", "net", "/es/"),
    urls.UrlRule("block", "net", "/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow or block every page by its URL."""
    return urls.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def packing_tokenizer() -> str:
    """The tokenizer file that the packing query counts with."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), packing_tokenizer())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines."""
    cleaned = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_deleted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from four fifths of the labels."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = quality.held_out(F.col("id"), 5, 0)
    ensemble = quality.learn(documents, _table(spark, sf_dir, "labels"), ~held)
    scored = quality.score_quality(documents, ensemble)
    out = quality.held_out(F.col("doc_id"), 5, 0).alias("held_out")
    return scored.select("doc_id", out, "score", "predicted")


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree and add-one scores and bits per byte of every document, learned from six sevenths."""
    return ctw.score_texts(_table(spark, sf_dir, "documents"), quality.held_out(F.col("doc_id"), 7, 2))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every twentieth embedding."""
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 16-part code for every embedding, with its error and that of its label."""
    coded, books = codes.compress(_table(spark, sf_dir, "embeddings"))
    found = codes.label_errors(coded).withColumn("codebooks_sha256", F.lit(codes.digest(books)))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document are in passages of the benchmark, and in which items'."""
    found = leaks.leak_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def aligned_tokenizers() -> tuple[str, str]:
    """The tokenizer files that the alignment query compares."""
    import public_tokenizers

    return tuple(str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the ids of two tokenizers stand for each other in every document."""
    return align.align(_table(spark, sf_dir, "documents"), *aligned_tokenizers())[1]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_vector_dedup, op2_simhash_dedup, op3_mixing, op4_secrets, op5_url_filter, op6_packing, op7_line_dedup, op8_quality,
        op9_context_tree, op10_exact_top_k, op11_vector_codes, op12_decontamination, op13_tokenizer_alignment,
    )
}
