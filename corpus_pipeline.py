"""A corpus pipeline over ``documents``: quality, line dedup, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
``documents``, with ``n_chars`` counted anew where a text changes. Decisions join the texts by a sort-merge join at every
size: there is one per document, so a broadcast of them would have no bound.

Every stage takes texts of any length whole, keeps null ids, sources and languages as they are, gives no rows for an empty
table, and returns only ``COLUMNS`` (the last: the digests), so further columns end at the first stage, whatever their names;
names that begin with two underscores are taken. What a stage does with null and empty texts, ties and repeated rows is
said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framesieve.llm import line_dedup, mixing, near_dedup, quality
from framesieve.llm.common import cut, free, made, table
from framesieve.llm.queries import held_out, token_digests

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.3 go. The classifier learns from the labelled rows that are not held out.

    Null and empty texts score the share of good texts; a score of 0.3 stays; rows that repeat share their fate.
    """
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = quality.score_quality(docs.select(*COLUMNS), model, score="__score")
    return scored.where("__score >= 0.3").select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated three-line windows go; a document all of whose lines went is a copy and goes too.

    Null and empty texts stay as they are. The first occurrence by (id, text, position) stays; rows that repeat an id and
    a text are one document here and share the outcome.
    """
    clean = line_dedup.dedup_lines(docs.select(*COLUMNS))
    clean = clean.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    changed = F.col("n_removed") > 0
    return clean.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest id. Rows without an id stay.

    Null, empty and blank texts are nobody's copies and stay. Rows that repeat the id of a kept document stay as often as
    they come; those of an id that is a copy by any of its texts go.
    """
    groups = near_dedup.near_duplicates(docs, k=5, similarity=0.8)
    gone = groups.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone.hint("merge"), "doc_id", "left_anti").select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice.

    Null and blank texts have no words and are never taken; null sources are a source. Equal finish times go by hash and
    id. Rows that repeat an id are taken as often as the one taken most.
    """
    mix = mixing.weighted_fair_mix(docs).where("copies > 0").groupBy("doc_id").agg(F.max("copies").alias("copies"))
    mix = mix.withColumnRenamed("doc_id", "__id")
    met = docs.select(*COLUMNS).join(mix.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")))
    return met.withColumn("__round", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; null texts count as empty, repeated rows are coded alike."""
    return token_digests(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("near-duplicate removal", near_dedup_stage),
    ("source mixing", mixing_stage),
    ("byte-level BPE", token_stage),
]

#: SQL expresses neither compression scores nor BPE; tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's output is written to the shared folder and read again.

    Once it is written, the stage's scratch tables and its predecessor's output are removed.
    """
    docs = table(spark, sf_dir, "documents")
    since = made()
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        free(since)
    return STAGES[-1][1](spark, docs, sf_dir)
