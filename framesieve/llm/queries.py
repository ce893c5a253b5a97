"""The registered corpus queries, each a thin projection of its operator, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprint, html_text, line_dedup, mixing, near_dedup, quality, sharding, topk, url_filter
from .common import scratch, table


def held_out(id_column: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(id_column).cast("string")) % 5 == 0


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = quality.score_quality(docs, model).drop("text")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page URL; the trees learn from the pages' own URLs, labelled by the list of bad host words."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit_url_model(url_filter.weak_labels(pages))
    return url_filter.filter_urls(pages, model).select("page_id", "host", "path", "rule", "verdict", "bad_probability")


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.successors(table(spark, sf_dir, "documents").select("doc_id", "text"))


def token_digests(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Digests of every text's ids and of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode_decode(docs.select(id_column, "text"), ranks, public_tokenizers.PATTERN)
    return coded.select(id_column, (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", "n_chars")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in two halves by hash; after compaction to 32 MB files, every row with whether a shard names it."""
    docs = table(spark, sf_dir, "documents")
    store = sharding.ShardStore(spark, scratch(spark, "shards"), target=32 << 20, arrival_rows=2000)
    for half in (0, 1):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half))
        store.compact()
    rows = store.read(shard_column="shard")
    return rows.select("doc_id", "n_chars", F.sha2("text", 256).alias("text_sha256"), F.col("shard").isNotNull().alias("sharded"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.weighted_fair_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "clean_text")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, similarity=0.85)


def queries() -> dict:
    return {
        "op1_quality": op1_quality,
        "op2_url_filter": op2_url_filter,
        "op3_fingerprint": op3_fingerprint,
        "op4_bpe": op4_bpe,
        "op5_html": op5_html,
        "op6_sharding": op6_sharding,
        "op7_mixing": op7_mixing,
        "op8_line_dedup": op8_line_dedup,
        "op9_topk": op9_topk,
        "op10_near_dedup": op10_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    from .sql import ORACLES

    return dict(ORACLES)
