"""New frame files as a stream, and triplets found as their last frames arrive.

The batch engine freezes its input, so nothing here is needed for a run. It serves folders that are still being written:
a file source hands over new names, and a stateful operator keeps, per video, the indices that can still complete a
triplet.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.triplets import parse_frame_name, video_id
from ..sources.frames import EXTENSIONS, extensions, relative_path

LISTING = "path string, modificationTime timestamp, length long, content binary"


def arriving_frames(spark: SparkSession, root: str, *, digits: int | None = 5, pattern: str | None = None, allowed: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """(video_id, frame_index, relative_path, modified) of files as they appear; contents are not read."""
    files = spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", "true").load(root).select("path", F.col("modificationTime").alias("modified"))
    files = files.withColumn("relative_path", relative_path(F.col("path"), root))
    name = F.substring_index("relative_path", "/", -1)
    files = files.where(F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)).isin(*extensions(allowed)))
    parsed = parse_frame_name(name, digits=digits, pattern=pattern)
    parent = F.when(F.instr("relative_path", "/") > 0, F.regexp_replace("relative_path", "/[^/]*$", "")).otherwise(".")
    return files.withColumn("p", parsed).where("p IS NOT NULL").select(video_id(parent, F.col("p.video_key")).alias("video_id"), F.col("p.frame_index").cast("long").alias("frame_index"), "relative_path", "modified")


def completed_triplets(frames: DataFrame, *, stride: int = 1, late: int | None = None) -> DataFrame:
    """(video_id, img0_index, gt_index, img1_index), once each, when the last of three frames is there in any order.

    The state of a video is the set of its frame indices: a few bytes per frame file. With ``late``, indices further than
    that below the video's newest are forgotten, so its state has a bound; frames that come later than that make no triplet.
    """
    if late is not None and late < 2 * stride:
        raise ValueError("late must reach over a triplet")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = set(state.get[0]) if state.exists else set()
        fresh = {int(i) for b in batches for i in b["frame_index"]} - seen
        # what is too late, by what was seen before, counts as never come
        oldest = max(seen) - late if late is not None and seen else None
        fresh = {i for i in fresh if oldest is None or i >= oldest}
        both = seen | fresh
        starts = {i - j * stride for i in fresh for j in range(3)}
        found = sorted(s for s in starts if {s, s + stride, s + 2 * stride} <= both)
        state.update((sorted(i for i in both if late is None or i >= max(both) - late),))
        yield pd.DataFrame({"video_id": [key[0]] * len(found), "img0_index": found, "gt_index": [s + stride for s in found], "img1_index": [s + 2 * stride for s in found]})

    out = "video_id string, img0_index long, gt_index long, img1_index long"
    return frames.groupBy("video_id").applyInPandasWithState(step, out, "indices array<bigint>", "append", GroupStateTimeout.NoTimeout)
