"""Frames to triplets: parsing, runs, duplicates, self-join, identities and chunks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import cut
from .records import running_before


def java_pattern(pattern: str) -> tuple[str, dict[str, int]]:
    """A Python regular expression in Java syntax, case-insensitive and anchored, and its groups' numbers.

    Raises ValueError unless the pattern names a ``frame`` group.
    """
    groups = dict(re.compile(pattern).groupindex)
    if "frame" not in groups:
        raise ValueError("the frame pattern needs a group named 'frame'")
    return r"(?i)\A(?:" + pattern.replace("(?P<", "(?<").replace("(?P=", r"\k<").replace("$)", ")") + r")\z", groups


def parse_frame_name(name: Column, *, pattern: str | None = None, digits: int | None = None) -> Column:
    """struct<video_key, frame_index> of a file name, null where it doesn't parse.

    A pattern is matched against the whole file name first, then against the stem; without a video group (or with an
    empty one) the key is the text before the frame. Otherwise the last ``digits`` digits (5 by default) of the stem are
    the frame and the rest is the key.
    """
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    if pattern is None:
        if digits is not None and digits <= 0:
            raise ValueError("digits must be positive")
        tail = rf"(?s)\A(.*?)(\d{{{digits or 5}}})\z"
        return F.when(stem.rlike(tail), F.struct(F.regexp_extract(stem, tail, 1).alias("video_key"), F.regexp_extract(stem, tail, 2).cast("int").alias("frame_index")))
    java, groups = java_pattern(pattern)
    named = groups.get("video") or groups.get("prefix")

    def parsed(text: Column) -> Column:
        frame = F.regexp_extract(text, java, groups["frame"])
        before = F.call_function("substring_index", text, frame, F.lit(1)) if named is None else F.regexp_extract(text, java, named)
        if named is not None:
            before = F.when(before != "", before).otherwise(F.call_function("substring_index", text, frame, F.lit(1)))
        return F.when(text.rlike(java), F.struct(before.alias("video_key"), frame.cast("int").alias("frame_index")))

    return F.coalesce(parsed(name), parsed(stem))


def video_id(parent: Column, key: Column) -> Column:
    return F.concat_ws("::", parent, key)


def duplicate_frames(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of frames that occur more than once, with their number."""
    return frames.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def checked_unique(frames: DataFrame, video: str = "video_id", index: str = "frame_index") -> DataFrame:
    """The frames; the job fails at a repeated (video, index). One shuffle, combined before it: no window holds a video."""
    rest = [c for c in frames.columns if c not in (video, index)]
    held = F.first(F.struct(*rest)).alias("__row") if rest else F.lit(None).alias("__row")
    per = frames.groupBy(video, index).agg(F.count("*").alias("__n"), held)
    fail = F.raise_error(F.concat(F.lit("duplicate frame index "), F.col(index).cast("string"), F.lit(" in "), F.col(video).cast("string")))
    per = per.withColumn("__ok", F.when(F.col("__n") > 1, fail.cast("boolean")).otherwise(F.lit(True))).where("__ok")
    return per.select(*[F.col(c) if c in (video, index) else F.col(f"__row.`{c}`").alias(c) for c in frames.columns])


#: Frames of a video that one window holds: a long video is dealt over tasks by blocks of its indices.
BLOCK = 65_536


def block_of(index: Column, size: int) -> Column:
    return F.floor(index / size)


def consecutive_runs(frames: DataFrame, *, step: int = 1, video: str = "video_id", index: str = "frame_index", block: int = BLOCK) -> DataFrame:
    """(video, start, end, n_frames) of maximal runs whose neighbours differ by exactly ``step``.

    Runs are found inside blocks of indices first, so a window over a whole video only sees runs, not frames.
    """
    inside = W.partitionBy(video, "__block").orderBy(index)
    rows = frames.select(video, index).withColumn("__block", block_of(F.col(index), block))
    rows = rows.withColumn("__island", F.col(index) - step * F.row_number().over(inside))
    runs = rows.groupBy(video, "__block", "__island").agg(F.min(index).alias("start"), F.max(index).alias("end"), F.count("*").alias("n"))
    whole = W.partitionBy(video).orderBy("start")
    opens = F.when(F.col("start") - F.lag("end").over(whole) == step, 0).otherwise(1)
    runs = runs.withColumn("__open", opens).withColumn("__run", F.sum("__open").over(whole.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy(video, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n_frames")).drop("__run")


def triplets(frames: DataFrame, *, stride: int = 1, video: str = "video_id", index: str = "frame_index", block: int = BLOCK) -> DataFrame:
    """(video, img0_index, gt_index, img1_index) wherever k, k + stride and k + 2 stride exist in a video.

    One shuffle by (video, block of indices): a range frame sees whether both later frames exist, instead of two joins.
    The few frames that an earlier block's triplets reach are dealt to that block too.
    """
    if stride <= 0:
        raise ValueError("stride must be positive")
    blocks = F.sequence(block_of(F.col(index) - 2 * stride, block), block_of(F.col(index), block))
    rows = frames.select(video, index).distinct().withColumn("__block", F.explode(blocks))
    w = W.partitionBy(video, "__block").orderBy(index)
    at = lambda n: F.count("*").over(w.rangeBetween(n, n)) > 0
    found = rows.withColumn("__both", at(stride) & at(2 * stride)).where(F.col("__both") & (F.col("__block") == block_of(F.col(index), block)))
    return found.select(video, F.col(index).alias("img0_index"), (F.col(index) + stride).alias("gt_index"), (F.col(index) + 2 * stride).alias("img1_index"))


def contiguous(indices: Column, stride: Column) -> Column:
    """Whether three indices are a stride apart each."""
    return (F.size(indices) == 3) & (indices[1] - indices[0] == stride) & (indices[2] - indices[1] == stride)


def sample_id(video: Column, stride: int, frames: list[tuple[Column, Column]]) -> Column:
    """SHA-256 of the canonical JSON of (frames, stride, version, video): the same for any root folder.

    ``frames`` are (index, relative path) pairs; fields are in alphabetical order at every level.
    """
    listed = F.array(*[F.struct(i.cast("int").alias("index"), p.alias("path")) for i, p in frames])
    return F.sha2(F.to_json(F.struct(listed.alias("frames"), F.lit(stride).alias("stride"), F.lit(1).alias("version"), video.cast("string").alias("video_id"))), 256)


def chunks(records: DataFrame, size: int, *, video: str = "video_id", index: str = "frame_index", block: int = BLOCK) -> DataFrame:
    """Adds chunk_in_video (from 0) and chunk (global, videos in order): ``size`` consecutive rows of one video each.

    Places come from counts: per block of indices, then per video, then per range of videos, so no task holds a whole
    video or all videos. Rows of one index are numbered in any order.
    """
    if size <= 0:
        raise ValueError("chunk size must be positive")
    rows = records.withColumn("__block", block_of(F.col(index), block))
    counts = cut(rows.groupBy(video, "__block").agg(F.count("*").alias("__n")), "block-counts")  # read twice, small
    before = F.sum("__n").over(W.partitionBy(video).orderBy("__block").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(F.col(video).alias("__v"), F.col("__block").alias("__b"), F.coalesce(before, F.lit(0)).alias("__start"))
    per = counts.groupBy(video).agg(F.ceil(F.sum("__n") / size).alias("__k"))
    per = running_before(per, [F.col(video)], "__k", "__first").select(F.col(video).alias("__w"), "__first")
    place = F.row_number().over(W.partitionBy(video, "__block").orderBy(index)) - 1
    rows = rows.withColumn("__place", place).join(starts, (F.col(video) == F.col("__v")) & (F.col("__block") == F.col("__b"))).join(per, F.col(video) == F.col("__w"))
    rows = rows.withColumn("chunk_in_video", F.floor((F.col("__start") + F.col("__place")) / size).cast("long"))
    return rows.withColumn("chunk", F.col("__first") + F.col("chunk_in_video")).drop("__block", "__place", "__v", "__b", "__w", "__start", "__first")


def dynamic_chunk_size(n: int, workers: int, most: int) -> int:
    """Four chunks per worker, within 1 and ``most``."""
    return max(1, min(most, -(-n // (4 * max(1, workers)))))
