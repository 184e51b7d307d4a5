"""A training corpus from the raw documents, in stages that each write their result.

Every stage is one of the operators with the parameters of this corpus, applied to what the
stage before kept: documents of poor quality go, later copies of repeated lines go, one
document of each near-duplicate group stays, sources are mixed to their weights, and what
is left is packed. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantiga.llm import lines, mixing, packing, quality, simhash
from cantiga.llm.queries import packing_tokenizer
from cantiga.operators.skew import small
from cantiga.session import materialize

QUALITY = 0.3
# Kept rows that are broadcast: two numbers each, 16 MB at the most.
BROADCAST_IDS = 1_000_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _apart(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, and all columns but the text in one struct, where no name meets another."""
    return docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good. Labels of all documents may be learned from."""
    ensemble = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score_quality(_apart(docs), ensemble, threshold=QUALITY).where("predicted = 1")
    return scored.select("text", "doc.*").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated lines; those left without a line go.

    ``n_chars`` follows the text. A document that had no text stays as it is.
    """
    cleaned = lines.dedup_lines(_apart(docs)).where("n_deleted = 0 or n_deleted < n_lines")
    n_chars = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("doc.n_chars"))
    new = {"text": F.col("text"), "n_chars": n_chars}
    return cleaned.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, by the SimHash operator.

    Texts link when the fingerprints of their three-word shingles differ in two bits or fewer.
    One row of each group stays, whether ids are null or repeat: of those without an id or with
    the same one, the row with the smallest hash; one without an id only if the group has no other.
    """
    found = simhash.near_duplicate_rows(docs).groupBy("root", "doc_id", "row").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "n")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.row", "first.n")
    kept = materialize(kept, "kept-documents")
    # Hashes only; more of them than fit a broadcast move the texts once more.
    listed = F.broadcast(kept) if small(kept, BROADCAST_IDS) else kept
    whole = docs.select(F.struct(*docs.columns).alias("doc"), simhash.row_hash(docs).alias("row"))
    taken = whole.join(listed, "row")
    # Equal rows cannot be told apart, so of those one is picked; the others do not move.
    one = taken.where("n = 1").unionByName(taken.where("n > 1").dropDuplicates(["row"]))
    return one.select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    copies = mixing.mix(docs).groupBy("mark").agg(F.sum("copies").alias("copies"))
    copies = materialize(copies.where("copies > 0"), "mix-copies")
    mark = mixing.row_mark(F.col("doc_id"), F.col("text"), F.col("source"))
    one = docs.select(F.struct(*docs.columns).alias("doc"), mark.alias("mark")).dropDuplicates(["mark"])
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return one.join(copies, "mark").select("doc", copy).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, packing_tokenizer())


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mix", mix_sources),
    ("pack", pack),
]

# A learned score, a hash that SQL lacks, draws and a tokenizer: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
