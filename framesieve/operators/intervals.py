"""Closed frame intervals: union, barriers, hard centres, and the joins between segments, frames and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HARD = ("hard", "accept", "extremely_hard")
BARRIER = ("invalid", "out_of_scope")


def checked(intervals: DataFrame) -> DataFrame:
    """The intervals; the job fails where one has no video or ends before it starts."""
    bad = F.col("video_id").isNull() | (F.col("video_id").cast("string") == "") | (F.col("start") > F.col("end"))
    return intervals.withColumn("__ok", F.when(bad, F.raise_error(F.lit("interval without video or with start > end")).cast("boolean")).otherwise(F.lit(True))).where("__ok").drop("__ok")


def sorted_unique(column: Column) -> Column:
    return F.array_sort(F.array_distinct(column))


#: Frames of a video that one window or join key holds.
BLOCK = 4_096


def _merged(intervals: DataFrame, keys: list[str], adjacent: bool, provenance: tuple[str, ...]) -> DataFrame:
    w = W.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= reach + (1 if adjacent else 0), 0).otherwise(1)
    marked = intervals.withColumn("__open", opens).withColumn("__island", F.sum("__open").over(w.rowsBetween(W.unboundedPreceding, 0)))
    gathered = [sorted_unique(F.flatten(F.collect_list(c))).alias(c) for c in provenance]
    return marked.groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end"), *gathered).drop("__island")


def union(intervals: DataFrame, *, adjacent: bool = True, provenance: tuple[str, ...] = ("sample_ids",), block: int = BLOCK) -> DataFrame:
    """Merged intervals per video with the sorted unique union of each provenance array.

    Intervals that start in one block of frames are merged first, so the window over a whole video sees few of them.
    """
    local = _merged(intervals.withColumn("__block", F.floor(F.col("start") / block)), ["video_id", "__block"], adjacent, provenance).drop("__block")
    return _merged(local, ["video_id"], adjacent, provenance)


def binned(segments: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per block of frames that a segment touches: (video, block) keys split the ranges of a long video."""
    return segments.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(F.col("end") / block))))


def subtract(intervals: DataFrame, barriers: DataFrame) -> DataFrame:
    """Each interval cut around the barriers of its video; every piece keeps the interval's other columns.

    The barriers are unioned and gathered by (video, block of frames); an interval meets those of the blocks it touches and
    folds over the ones that overlap it. No frame is exploded, and a long video's barriers never meet in one row. Columns
    must be of types that can be grouped; rows that repeat stay as often as they are.
    """
    merged = union(barriers.select("video_id", "start", "end", F.array().cast("array<string>").alias("sample_ids")))
    per = binned(merged).groupBy(F.col("video_id").alias("__v"), F.col("__bin").alias("__at")).agg(F.collect_list(F.struct("start", "end")).alias("__b"))
    names = intervals.columns
    met = binned(intervals).join(per, (F.col("video_id") == F.col("__v")) & (F.col("__bin") == F.col("__at")), "left")
    overlapping = F.filter(F.coalesce("__b", F.array().cast(merged_type(merged))), lambda b: (b["end"] >= F.col("start")) & (b["start"] <= F.col("end")))
    met = met.withColumn("__hits", overlapping)
    # rows are known by their columns; equal ones are counted in the block where they start
    copies = F.count_if(F.col("__bin") == F.floor(F.col("start") / BLOCK)).alias("__copies")
    joined = met.groupBy(*names).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("__hits")))).alias("__hits"), copies)
    joined = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).drop("__copies", "__copy")
    # pieces run from behind one barrier to before the next
    pieces = F.transform(F.sequence(F.lit(0), F.size("__hits")), lambda i: F.struct(
        F.when(i == 0, F.col("start")).otherwise(F.get("__hits", i - 1)["end"] + 1).alias("a"),
        F.when(i == F.size("__hits"), F.col("end")).otherwise(F.get("__hits", i)["start"] - 1).alias("b"),
    ))
    joined = joined.withColumn("__piece", F.explode(F.filter(pieces, lambda p: p["a"] <= p["b"])))
    return joined.withColumn("start", F.col("__piece.a")).withColumn("end", F.col("__piece.b")).drop("__hits", "__piece")


def merged_type(merged: DataFrame) -> str:
    kinds = dict(merged.dtypes)
    return f"array<struct<start:{kinds['start']},end:{kinds['end']}>>"


def merge(intervals: DataFrame, barriers: DataFrame, *, adjacent: bool = True, min_length: int = 1, provenance: tuple[str, ...] = ("sample_ids",)) -> DataFrame:
    """Subtract, then union, so that a barrier is never bridged; shorter results are dropped."""
    if min_length < 1:
        raise ValueError("min_length must be positive")
    return union(subtract(intervals, barriers), adjacent=adjacent, provenance=provenance).where(F.col("end") - F.col("start") + 1 >= min_length)


def merge_classified(decisions: DataFrame, *, hard: tuple[str, ...] = HARD, barrier: tuple[str, ...] = BARRIER, min_length: int = 1, provenance: tuple[str, ...] = ("sample_ids",)) -> DataFrame:
    """Hard rows merged around barrier rows; other statuses are ignored."""
    return merge(decisions.where(F.col("status").isin(*hard)), decisions.where(F.col("status").isin(*barrier)), min_length=min_length, provenance=provenance)


def with_hard_centre(segments: DataFrame, triplets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Segments that hold some accepted triplet (video_id, start, end) as a whole."""
    t = triplets.select(F.col("video_id").alias("__v"), F.col("start").alias("__s"), F.col("end").alias("__e"), F.floor(F.col("start") / block).alias("__at"))
    inside = (F.col("video_id") == F.col("__v")) & (F.col("__bin") == F.col("__at")) & (F.col("start") <= F.col("__s")) & (F.col("__e") <= F.col("end"))
    held = binned(segments.select("video_id", "start", "end"), block).join(t, inside, "left_semi").select("video_id", "start", "end").distinct()
    return segments.join(held, ["video_id", "start", "end"], "left_semi").select(segments.columns)


def segment_id(run_hash: str, video: Column, start: Column, end: Column) -> Column:
    """First 20 hex digits of SHA-256 over the NUL-joined run, video and bounds."""
    return F.substring(F.sha2(F.concat_ws("\u0000", F.lit(run_hash), video.cast("string"), start.cast("string"), end.cast("string")), 256), 1, 20)


def segment_frames(segments: DataFrame, frames: DataFrame, *, least: int = 3) -> DataFrame:
    """(segment columns, frame_index) of all frames inside; the job fails at a segment with fewer than ``least``.

    Frames are counted by partial sums per segment and block, so a long segment meets in no task.
    """
    f = frames.select(F.col("video_id").alias("__v"), "frame_index", F.floor(F.col("frame_index") / BLOCK).alias("__at"))
    inside = (F.col("video_id") == F.col("__v")) & (F.col("__bin") == F.col("__at")) & F.col("frame_index").between(F.col("start"), F.col("end"))
    keys = ["video_id", "start", "end"]
    counts = binned(segments.select(*keys).distinct()).join(f, inside).groupBy(*keys).agg(F.count("*").alias("__n"))
    fail = F.raise_error(F.lit("a segment has too few frames")).cast("boolean")
    ready = segments.join(counts, keys, "left").withColumn("__ok", F.when(F.coalesce("__n", F.lit(0)) < least, fail).otherwise(F.lit(True)))
    return binned(ready.where("__ok").drop("__ok", "__n").select(segments.columns)).join(f, inside).drop("__v", "__at", "__bin")


def match_records(records: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds to each record (video_id, sample_id, status, start, end): covered_by_segment, contributed_to_segment, selected.

    Segments of a video don't overlap, so containment finds at most one; contributing means being in its sample_ids, and
    selected means covered and hard.
    """
    s = binned(segments).select(F.col("video_id").alias("__v"), "__bin", F.col("start").alias("segment_start"), F.col("end").alias("segment_end"))
    at = F.floor(F.col("start") / BLOCK)
    inside = (F.col("video_id") == F.col("__v")) & (at == F.col("__bin")) & (F.col("segment_start") <= F.col("start")) & (F.col("end") <= F.col("segment_end"))
    met = records.join(s, inside, "left")
    # a sample may lend frames to a segment that doesn't cover it whole
    lent = segments.select(F.explode("sample_ids").alias("__sid")).distinct()
    met = met.join(lent, F.col("sample_id") == F.col("__sid"), "left")
    covered = F.col("__v").isNotNull()
    return met.withColumns({"covered_by_segment": covered, "contributed_to_segment": F.col("__sid").isNotNull(), "selected": covered & F.col("status").isin(*HARD)}).drop("__v", "__bin", "__sid")
