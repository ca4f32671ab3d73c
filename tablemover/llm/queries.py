"""The operators over the whole test tables, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, divergence, mix, negatives, packing, quality, secrets, sharding, simhash, toxicity, warc, whitening
from .common import read_table, written

SHARDS = 32
TOKENIZER = "byte_bpe_50k.json"


def op1_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the cycling source weights; ``taken`` is copies times words."""
    docs = read_table(spark, sf_dir, "documents")
    sizes = written(docs.select(F.col("doc_id").alias("doc"), "source", mix.word_count(F.col("text")).alias("size")), "op1")
    d = mix.mix_decisions(sizes, mix.cycle_weights(sizes.select("source")))
    return d.select(F.col("doc").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict of every document."""
    d = divergence.quality_rules(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return d.drop("class_distance", "word_distance")


def op3_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a source is an owner, and its languages are its repositories."""
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"), ["doc_id"], owner="source", repository=["lang"])


def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from their chunked record table."""
    chunks = warc.record_chunks(warc.archive_pages(read_table(spark, sf_dir, "pages")), with_data=False)
    whole = F.col("record_type") == "response"
    return chunks.where("last").select(
        warc.page_of(F.col("record_id")).cast("long").alias("page_id"),
        F.when(whole, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(whole, F.col("running_sha1")).otherwise(F.col("stated_sha1")).alias("payload_digest"),
        "record_type", warc.page_of(F.col("refers_to")).cast("long").alias("refers_to"))


def op6_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 formatted in windows, then read back from the written windows."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return chat.read_back(written(chat.format_chats(turns.unionByName(own)), "op8"))


def op9_lookup_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.assign_shards(read_table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def op10_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, item_chars, edits) of every document that holds a benchmark item."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding and its five best positives."""
    e = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(e.select("vec_id", label.alias("label"), "embedding", (F.col("vec_id") % 100 == 0).alias("anchor")),
                                    "vec_id", "label", "embedding", "anchor")


def op12_config_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"), ["doc_id"], "text", public_tokenizers.path(TOKENIZER))
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(written(pieces, "op12"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 32 leading whitened components."""
    w = whitening.whiten(read_table(spark, sf_dir, "embeddings"), ["vec_id"])
    return (w.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error",
                     F.posexplode(F.arrays_zip("whitened", "explained")).alias("pos", "c"))
            .select("vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                    F.col("c.explained").alias("explained"), "identity_error"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over documents."""
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_pivotal_mix, op2_distribution_divergence, op3_ftrl_toxicity, op4_ownership_secrets, op5_warc_chunks,
    op6_simhash_vptree, op7_fm_quality, op8_chat_windows, op9_lookup_shards, op10_cgk_decontamination,
    op11_hard_negatives, op12_config_packing, op13_embedding_whitening, pipeline)}

_OP5 = """
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS keeper
    FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM k"""

ORACLES = {"op5_warc_chunks": _OP5, "op9_lookup_shards": sharding.oracle(SHARDS)}
