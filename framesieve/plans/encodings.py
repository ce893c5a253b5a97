"""Stand-ins built from the star-schema tables: frames, statuses and 8x8 luma maps, each with its SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A frame lasts six hours; numbering starts at the first of 2024.
FRAME_SECONDS, FIRST_FRAME = 21600, 78892
STATUS = {"purchase": "accept", "error": "invalid", "signup": "out_of_scope", "view": "review", "click": "reject"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _frame_index():
    return (F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / FRAME_SECONDS) - FIRST_FRAME).cast("long")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame_index): one frame per user and six hours with an event."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), _frame_index().alias("frame_index")).distinct()


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame_index, status): the status of a frame's first event."""
    kinds = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    first = F.min_by("event_type", F.struct("ts", "event_id"))
    grouped = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("video_id"), _frame_index().alias("frame_index")).agg(first.alias("event_type"))
    return grouped.select("video_id", "frame_index", F.coalesce(F.element_at(kinds, F.col("event_type")), F.lit("review")).alias("status"))


def luma_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, luma array<double>): embeddings as row-major 8x8 maps in [0, 1]."""
    luma = F.transform("embedding", lambda v: F.least(F.greatest((v.cast("double") + 1) / 2, F.lit(0.0)), F.lit(1.0)))
    return table(spark, sf_dir, "embeddings").select("vec_id", luma.alias("luma"))


#: Common table expressions for the DuckDB forms.
FR = f"fr AS (SELECT DISTINCT user_id AS video_id, CAST(floor(epoch(ts) / {FRAME_SECONDS}) AS BIGINT) - {FIRST_FRAME} AS frame_index FROM events)"
ST = (
    "st AS (SELECT user_id AS video_id, CAST(floor(epoch(ts) / %d) AS BIGINT) - %d AS frame_index, "
    "CASE arg_min(event_type, (ts, event_id)) %s ELSE 'review' END AS status FROM events GROUP BY 1, 2)"
) % (FRAME_SECONDS, FIRST_FRAME, " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items()))
PX = (
    "px AS (SELECT vec_id, (i - 1) % 8 AS x, (i - 1) // 8 AS y, "
    "least(greatest((CAST(embedding[i] AS DOUBLE) + 1) / 2, 0.0::DOUBLE), 1.0::DOUBLE) AS l "
    "FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))"
)
