"""Triplets from arriving files equal those of the batch scan."""

from framesieve.operators.triplets import triplets
from framesieve.sources.frames import scan_frames
from framesieve.streaming.frames import arriving_frames, completed_triplets


def test_arriving_frames_complete_triplets_once(spark, tmp_path):
    root, n = tmp_path / "in", 0
    (root / "v").mkdir(parents=True)
    query = completed_triplets(arriving_frames(spark, str(root))).writeStream.format("memory").queryName("found").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for batch in ((1, 3, 7), (2, 5), (4, 6)):
            for i in batch:
                (root / "v" / f"01{i:05d}.png").write_bytes(b"x")
            query.processAllAvailable()
            n += 1
        got = sorted(map(tuple, spark.sql("SELECT * FROM found").collect()))
    finally:
        query.stop()
    want = sorted(map(tuple, triplets(scan_frames(spark, str(root), digits=5)).collect()))
    assert got == want and len(got) == 5 and n == 3


def test_late_frames_are_forgotten(spark, tmp_path):
    root = tmp_path / "in"
    (root / "v").mkdir(parents=True)
    query = completed_triplets(arriving_frames(spark, str(root)), late=4).writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        for batch in ((1, 2, 10), (3, 8), (9,)):  # 3 comes later than four below the newest
            for i in batch:
                (root / "v" / f"01{i:05d}.png").write_bytes(b"x")
            query.processAllAvailable()
        got = [tuple(r) for r in spark.sql("SELECT * FROM late").collect()]
    finally:
        query.stop()
    assert got == [("v::01", 8, 9, 10)]
