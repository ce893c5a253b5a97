"""Queries over frames, intervals and records, with their DuckDB forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators import ledger, records
from ..operators import triplets as tr
from ..scratch import cut
from .encodings import FR, ST, STATUS, frames, statuses, table

_TRIPLES = "t AS (SELECT a.video_id, a.frame_index AS s, a.frame_index + 2 AS e FROM fr a JOIN fr b ON a.video_id = b.video_id AND b.frame_index = a.frame_index + 1 JOIN fr c ON a.video_id = c.video_id AND c.frame_index = a.frame_index + 2)"
#: Statuses of triplets are those of their middle frames.
_CLASSIFIED = f"WITH {FR}, {ST}, {_TRIPLES}, d AS (SELECT t.video_id, t.s, t.e, st.status, t.video_id || ':' || t.s AS sample_id FROM t JOIN st ON st.video_id = t.video_id AND st.frame_index = t.s + 1)"
_BARRIER_FRAMES = "bf AS (SELECT DISTINCT video_id, unnest(generate_series({})) AS f FROM d WHERE status IN ('invalid', 'out_of_scope'))"
_ISLANDS = """
hf AS (SELECT video_id, sample_id, s, e, unnest(generate_series(s, e)) AS f FROM d WHERE status = 'accept'),
kept AS (SELECT DISTINCT hf.video_id, hf.f, hf.sample_id FROM hf LEFT JOIN bf ON bf.video_id = hf.video_id AND bf.f = hf.f WHERE bf.f IS NULL),
runs AS (SELECT video_id, f, f - row_number() OVER (PARTITION BY video_id ORDER BY f) AS g FROM (SELECT DISTINCT video_id, f FROM kept)),
seg AS (SELECT video_id, min(f) AS seg_start, max(f) AS seg_end FROM runs GROUP BY video_id, g)
"""


def _triplets(stride: int):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return tr.triplets(frames(spark, sf), stride=stride)

    return query


def _triplet_sql(stride: int) -> str:
    return f"WITH {FR} SELECT a.video_id, a.frame_index AS img0_index, b.frame_index AS gt_index, c.frame_index AS img1_index FROM fr a JOIN fr b ON a.video_id = b.video_id AND b.frame_index = a.frame_index + {stride} JOIN fr c ON a.video_id = c.video_id AND c.frame_index = a.frame_index + {2 * stride}"


def triplet_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return tr.triplets(table(spark, sf, "conversations").select("conv_id", "turn"), video="conv_id", index="turn")


def consecutive_runs(spark: SparkSession, sf: str) -> DataFrame:
    return tr.consecutive_runs(frames(spark, sf)).select("video_id", F.col("start").alias("run_start"), F.col("end").alias("run_end"), "n_frames")


def duplicate_frames(spark: SparkSession, sf: str) -> DataFrame:
    return tr.duplicate_frames(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def frame_name_parse(spark: SparkSession, sf: str) -> DataFrame:
    """File names made from frames, parsed by digits and by pattern."""
    named = frames(spark, sf).withColumn("name", F.format_string("clip%02d_%05d.PNG", "video_id", "frame_index"))
    by_digits, by_pattern = tr.parse_frame_name(F.col("name"), digits=5), tr.parse_frame_name(F.col("name"), pattern=r"^(?P<video>clip\d+)_(?P<frame>\d{5})\.(?P<ext>png|jpg)$")
    return named.select("name", by_digits["video_key"].alias("digits_key"), by_digits["frame_index"].alias("digits_frame"), tr.video_id(F.lit("root"), by_pattern["video_key"]).alias("pattern_video"), by_pattern["frame_index"].alias("pattern_frame"))


def _with_ids(t: DataFrame) -> DataFrame:
    path = lambda c: F.format_string("v%d/%05d.png", "video_id", c)
    names = ("img0_index", "gt_index", "img1_index")
    return t.withColumn("sample_id", tr.sample_id(F.col("video_id"), 1, [(F.col(n), path(n)) for n in names]))


def sample_id_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _with_ids(tr.triplets(frames(spark, sf))).select("video_id", "img0_index", "sample_id")


def chunk_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return tr.chunks(frames(spark, sf), 7).select("video_id", "frame_index", "chunk_in_video", F.col("chunk").cast("long"))


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return records.status_counts(statuses(spark, sf), [*sorted(set(STATUS.values())), "hard", "extremely_hard"])


def _decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Triplets with the status of their middle frame."""
    t = tr.triplets(frames(spark, sf))
    st = statuses(spark, sf).select(F.col("video_id").alias("v"), F.col("frame_index").alias("f"), "status")
    met = t.join(st, (F.col("video_id") == F.col("v")) & (F.col("gt_index") == F.col("f")))
    sample = F.concat_ws(":", "video_id", "img0_index")
    found = met.select("video_id", F.col("img0_index").alias("start"), F.col("img1_index").alias("end"), "status", sample.alias("sample_id"), F.array(sample).alias("sample_ids"))
    return cut(found, "decisions")  # several branches of a plan read them


def _segments(d: DataFrame) -> DataFrame:
    return iv.with_hard_centre(iv.merge_classified(d, min_length=3), d.where(F.col("status").isin(*iv.HARD)))


def interval_union(spark: SparkSession, sf: str) -> DataFrame:
    merged = iv.union(_decisions(spark, sf).where("status = 'accept'"))
    return merged.select("video_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"), F.size("sample_ids").alias("n_samples"), F.array_join("sample_ids", ",").alias("samples"))


def interval_minus_barriers(spark: SparkSession, sf: str) -> DataFrame:
    merged = iv.merge_classified(iv.checked(_decisions(spark, sf)))
    return merged.select("video_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"), F.array_join("sample_ids", ",").alias("samples"))


def hard_centre_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _segments(_decisions(spark, sf)).select("video_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"), F.size("sample_ids").alias("n_samples"))


def hard_centre_gt_barriers(spark: SparkSession, sf: str) -> DataFrame:
    """Barriers are the middle frames only, so that some segments lose their last whole triplet."""
    d = _decisions(spark, sf)
    hard = d.where(F.col("status").isin(*iv.HARD))
    middle = d.where(F.col("status").isin(*iv.BARRIER)).withColumns({"start": F.col("start") + 1, "end": F.col("end") - 1})
    kept = iv.with_hard_centre(iv.merge(hard, middle, min_length=3), hard)
    return kept.select("video_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"))


def record_segment_match(spark: SparkSession, sf: str) -> DataFrame:
    d = _decisions(spark, sf)
    return iv.match_records(d, _segments(d)).select("sample_id", "status", "segment_start", "segment_end", "covered_by_segment", "contributed_to_segment", "selected")


def segment_frames(spark: SparkSession, sf: str) -> DataFrame:
    found = iv.segment_frames(_segments(_decisions(spark, sf)), frames(spark, sf))
    return found.select("video_id", F.col("start").alias("seg_start"), "frame_index")


def segment_ids(spark: SparkSession, sf: str) -> DataFrame:
    s = _segments(_decisions(spark, sf))
    return s.select("video_id", F.col("start").alias("seg_start"), iv.segment_id("0123456789abcdef", F.col("video_id"), F.col("start"), F.col("end")).alias("segment_id"))


def overlay_update(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates (accept and review) whose start is even get a new status and score."""
    main = _decisions(spark, sf).select("sample_id", "status", F.lit(0.25).alias("p_wrong"), "start")
    upd = main.where("status IN ('accept', 'review') AND start % 2 = 0").select("sample_id", F.when(F.col("status") == "review", "accept").otherwise("review").alias("status"), F.lit(0.75).alias("p_wrong"))
    wanted = F.col("status").isin("accept", "review") & (F.col("start") % 2 == 0)
    upd = records.checked_status(upd, ("accept", "review")).join(main.select(F.col("sample_id").alias("s"), "start"), F.col("sample_id") == F.col("s")).drop("s")
    return records.checked_overlay(main, upd, "sample_id", ["status", "p_wrong"], wanted, ("start",)).drop("start")


def coverage_missing(spark: SparkSession, sf: str) -> DataFrame:
    d = _decisions(spark, sf)
    return records.missing(d, d.where("start % 7 <> 0"), "sample_id")


def coverage_extra(spark: SparkSession, sf: str) -> DataFrame:
    d = _decisions(spark, sf)
    return records.missing(d.where("start % 5 <> 0"), d.where("start % 3 <> 0"), "sample_id")


def part_union_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping parts of whole documents merge to one row per identity."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("sample_id"), "text", "lang", "source", "n_chars")
    number = F.col("sample_id").cast("long")
    return records.union_records([rows.where(number % 3 != 0), rows.where(number % 2 == 0), rows.where(number % 3 == 0)])


def part_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and a copy of them in which every tenth has another source."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("sample_id"), "text", "source")
    both = rows.unionByName(rows.withColumn("source", F.when(F.col("sample_id").cast("long") % 10 == 0, F.lit("other")).otherwise(F.col("source"))))
    return records.conflicts(both, records.identity(both))


def record_sort(spark: SparkSession, sf: str) -> DataFrame:
    """Places in the typed order: toxic (nulls first), quality, then canonical JSON."""
    rows = table(spark, sf, "labels").select("doc_id", "quality", F.when(F.col("doc_id") % 11 != 0, F.col("toxic")).alias("toxic"))
    order = [F.col("toxic").asc_nulls_first(), F.col("quality").asc_nulls_first(), records.canonical_json(rows)]
    return records.numbered(rows, order).select("doc_id", F.col("place").cast("int"))


def _tasks(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("task_id"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise("done").alias("status"), (-F.substring("o_orderpriority", 1, 1).cast("int")).alias("priority"), F.col("o_orderdate").alias("created_at"))


def claim_order(spark: SparkSession, sf: str) -> DataFrame:
    """The next twenty tasks that workers would claim."""
    return ledger.claim_order(_tasks(spark, sf)).limit(20).select("task_id", "priority")


def _ledger_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a user as the history of a task: the first is its enqueueing, the others by type; owners alternate."""
    from pyspark.sql import Window as W

    e = table(spark, sf, "events")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    kinds = F.create_map(*[F.lit(x) for p in (("click", "claim"), ("view", "heartbeat"), ("purchase", "complete"), ("error", "retry"), ("signup", "requeue")) for x in p])
    e = e.withColumn("seq", F.row_number().over(w))
    kind = F.when(F.col("seq") == 1, "enqueue").when(F.col("event_id") % 17 == 0, "orphan").otherwise(F.element_at(kinds, F.col("event_type")))
    more = (F.concat(F.lit("r"), F.col("seq")).alias("result_path"), F.concat(F.lit("e"), F.col("seq")).alias("error"))
    return e.select(F.col("user_id").alias("task_id"), "seq", (F.col("seq") * 10.0).alias("at"), kind.alias("kind"), F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("owner"), F.lit(35.0).alias("lease_seconds"), *more)


def ledger_fold(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.fold(_ledger_events(spark, sf))


def ledger_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks that a resumed stage still has to do."""
    t = _tasks(spark, sf)
    return ledger.unfinished(t, t.where("status = 'done'")).select("task_id", "status")


def frame_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """(video, index) to its only path, over all triplets."""
    t = _with_ids(tr.triplets(frames(spark, sf)))
    f = t.select("video_id", F.explode(F.array("img0_index", "gt_index", "img1_index")).alias("frame_index"))
    return records.unique_paths(f.withColumn("path", F.format_string("v%d/%05d.png", "video_id", "frame_index")))


def triplets_per_segment(spark: SparkSession, sf: str) -> DataFrame:
    """How many triplets each segment offers for training."""
    s = _segments(_decisions(spark, sf))
    inside = iv.segment_frames(s, frames(spark, sf)).select(F.concat_ws(":", "video_id", "start").alias("segment"), "frame_index")
    return tr.triplets(inside, video="segment").groupBy("segment").agg(F.count("*").alias("triplets"))


_SEG = f"{_CLASSIFIED}, {_BARRIER_FRAMES.format('s, e')}, {_ISLANDS}"
_HARD_SEG = "hs AS (SELECT * FROM seg WHERE seg_end - seg_start >= 2 AND EXISTS (SELECT 1 FROM d WHERE d.status = 'accept' AND d.video_id = seg.video_id AND d.s >= seg_start AND d.e <= seg_end))"
_SAMPLES = "string_agg(DISTINCT k.sample_id, ',' ORDER BY k.sample_id)"

#: The ledger's state machine, one event at a time.
_LEDGER = """
WITH RECURSIVE ev AS (SELECT user_id AS task_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, event_id, event_type FROM events),
k AS (SELECT task_id, seq, seq * 10.0::DOUBLE AS tm, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS owner,
             CASE WHEN event_id % 17 = 0 THEN 'orphan' WHEN event_type = 'click' THEN 'claim' WHEN event_type = 'view' THEN 'heartbeat' WHEN event_type = 'purchase' THEN 'complete' WHEN event_type = 'error' THEN 'retry' WHEN event_type = 'signup' THEN 'requeue' END AS kind FROM ev),
f AS (
  SELECT task_id, seq, 'pending' AS status, 0 AS attempt, NULL::VARCHAR AS owner, NULL::DOUBLE AS lease, tm AS updated, NULL::VARCHAR AS result_path, NULL::VARCHAR AS error FROM k WHERE seq = 1
  UNION ALL
  SELECT task_id, seq,
    CASE act WHEN 'claim' THEN 'running' WHEN 'complete' THEN 'done' WHEN 'again' THEN 'pending' WHEN 'give up' THEN 'failed' WHEN 'requeue' THEN 'pending' WHEN 'orphan' THEN 'pending' ELSE status END,
    CASE act WHEN 'claim' THEN attempt + 1 ELSE attempt END,
    CASE WHEN act = 'claim' THEN k_owner WHEN act IN ('again', 'requeue', 'orphan') THEN NULL ELSE owner END,
    CASE WHEN act IN ('claim', 'heartbeat') THEN tm + 35 WHEN act = '' THEN lease END,
    CASE WHEN act = '' THEN updated ELSE tm END,
    CASE act WHEN 'complete' THEN 'r' || seq WHEN 'requeue' THEN NULL ELSE result_path END,
    CASE WHEN act IN ('claim', 'complete', 'requeue') THEN NULL WHEN act IN ('again', 'give up') THEN 'e' || seq WHEN act = 'orphan' THEN 'orphaned worker recovered' ELSE error END
  FROM (SELECT *, CASE WHEN kind = 'claim' AND (status = 'pending' OR status = 'running' AND lease <= tm) THEN 'claim' WHEN held AND kind = 'heartbeat' THEN 'heartbeat' WHEN held AND kind = 'complete' THEN 'complete'
                       WHEN held AND kind = 'retry' AND attempt < 2 THEN 'again' WHEN held AND kind = 'retry' THEN 'give up' WHEN kind = 'requeue' AND status IN ('done', 'failed') THEN 'requeue'
                       WHEN kind = 'orphan' AND status = 'running' AND owner = k_owner THEN 'orphan' ELSE '' END AS act
        FROM (SELECT k.task_id, k.seq, k.tm, k.kind, k.owner AS k_owner, f.status, f.attempt, f.owner, f.lease, f.updated, f.result_path, f.error,
                     coalesce(f.status = 'running' AND f.lease > k.tm AND f.owner = k.owner, false) AS held
              FROM f JOIN k ON k.task_id = f.task_id AND k.seq = f.seq + 1))
)
SELECT task_id, status, attempt, owner, lease AS lease_expires, updated AS updated_at, result_path, error FROM f QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY seq DESC) = 1
"""

_PATH = "'{\"index\":' || {0} || ',\"path\":\"v' || a.video_id || '/' || printf('%05d', {0}) || '.png\"}'"
_JSON = "'{\"frames\":[' || " + " || ',' || ".join(_PATH.replace("{0}", f"(a.frame_index + {i})") for i in range(3)) + " || '],\"stride\":1,\"version\":1,\"video_id\":\"' || a.video_id || '\"}'"

QUERIES = {
    "triplet_stride1": (_triplets(1), _triplet_sql(1)),
    "triplet_stride2": (_triplets(2), _triplet_sql(2)),
    "triplet_conversations": (triplet_conversations, "SELECT a.conv_id, a.turn AS img0_index, b.turn AS gt_index, c.turn AS img1_index FROM (SELECT DISTINCT conv_id, turn FROM conversations) a JOIN (SELECT DISTINCT conv_id, turn FROM conversations) b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 JOIN (SELECT DISTINCT conv_id, turn FROM conversations) c ON a.conv_id = c.conv_id AND c.turn = a.turn + 2"),
    "consecutive_runs": (consecutive_runs, f"WITH {FR}, r AS (SELECT *, frame_index - row_number() OVER (PARTITION BY video_id ORDER BY frame_index) AS g FROM fr) SELECT video_id, min(frame_index) AS run_start, max(frame_index) AS run_end, count(*) AS n_frames FROM r GROUP BY video_id, g"),
    "duplicate_frames": (duplicate_frames, "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1"),
    "frame_name_parse": (frame_name_parse, f"WITH {FR}, n AS (SELECT printf('clip%02d_%05d.PNG', video_id, frame_index) AS name FROM fr) SELECT name, regexp_extract(name, '^(.*?)([0-9]{{5}})\\.PNG$', 1) AS digits_key, CAST(regexp_extract(name, '^(.*?)([0-9]{{5}})\\.PNG$', 2) AS INTEGER) AS digits_frame, 'root::' || regexp_extract(name, '(?i)^(clip[0-9]+)_([0-9]{{5}})\\.(png|jpg)$', 1) AS pattern_video, CAST(regexp_extract(name, '(?i)^(clip[0-9]+)_([0-9]{{5}})\\.(png|jpg)$', 2) AS INTEGER) AS pattern_frame FROM n"),
    "sample_id_hash": (sample_id_hash, f"WITH {FR}, a AS (SELECT a.* FROM fr a JOIN fr b ON a.video_id = b.video_id AND b.frame_index = a.frame_index + 1 JOIN fr c ON a.video_id = c.video_id AND c.frame_index = a.frame_index + 2) SELECT video_id, frame_index AS img0_index, sha256({_JSON}) AS sample_id FROM a"),
    "chunk_assignment": (chunk_assignment, f"WITH {FR}, n AS (SELECT *, (row_number() OVER (PARTITION BY video_id ORDER BY frame_index) - 1) // 7 AS c FROM fr), p AS (SELECT video_id, max(c) + 1 AS k FROM n GROUP BY video_id), o AS (SELECT video_id, coalesce(sum(k) OVER (ORDER BY video_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM p) SELECT n.video_id, n.frame_index, CAST(n.c AS BIGINT) AS chunk_in_video, CAST(o.base + n.c AS BIGINT) AS chunk FROM n JOIN o USING (video_id)"),
    "status_counts": (status_counts, f"WITH {ST}, s AS (SELECT unnest(['accept', 'invalid', 'out_of_scope', 'reject', 'review', 'hard', 'extremely_hard']) AS status) SELECT s.status, count(st.video_id) AS n FROM s LEFT JOIN st USING (status) GROUP BY s.status"),
    "interval_union": (interval_union, f"{_CLASSIFIED}, h AS (SELECT * FROM d WHERE status = 'accept'), m AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY video_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS o FROM h), g AS (SELECT *, sum(o) OVER (PARTITION BY video_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m) SELECT video_id, min(s) AS seg_start, max(e) AS seg_end, CAST(count(DISTINCT sample_id) AS INTEGER) AS n_samples, string_agg(DISTINCT sample_id, ',' ORDER BY sample_id) AS samples FROM g GROUP BY video_id, i"),
    "interval_minus_barriers": (interval_minus_barriers, f"{_SEG} SELECT seg.video_id, seg_start, seg_end, {_SAMPLES} AS samples FROM seg JOIN kept k ON k.video_id = seg.video_id AND k.f BETWEEN seg_start AND seg_end GROUP BY ALL"),
    "hard_centre_segments": (hard_centre_segments, f"{_SEG}, {_HARD_SEG} SELECT hs.video_id, seg_start, seg_end, CAST(count(DISTINCT k.sample_id) AS INTEGER) AS n_samples FROM hs JOIN kept k ON k.video_id = hs.video_id AND k.f BETWEEN seg_start AND seg_end GROUP BY ALL"),
    "hard_centre_gt_barriers": (hard_centre_gt_barriers, f"{_CLASSIFIED}, {_BARRIER_FRAMES.format('s + 1, e - 1')}, {_ISLANDS}, {_HARD_SEG} SELECT video_id, seg_start, seg_end FROM hs"),
    "record_segment_match": (record_segment_match, f"{_SEG}, {_HARD_SEG}, lent AS (SELECT DISTINCT k.sample_id FROM hs JOIN kept k ON k.video_id = hs.video_id AND k.f BETWEEN seg_start AND seg_end) SELECT d.sample_id, d.status, hs.seg_start AS segment_start, hs.seg_end AS segment_end, hs.video_id IS NOT NULL AS covered_by_segment, lent.sample_id IS NOT NULL AS contributed_to_segment, hs.video_id IS NOT NULL AND d.status = 'accept' AS selected FROM d LEFT JOIN hs ON hs.video_id = d.video_id AND d.s >= seg_start AND d.e <= seg_end LEFT JOIN lent ON lent.sample_id = d.sample_id"),
    "segment_frames": (segment_frames, f"{_SEG}, {_HARD_SEG} SELECT hs.video_id, seg_start, fr.frame_index FROM hs JOIN fr ON fr.video_id = hs.video_id AND fr.frame_index BETWEEN seg_start AND seg_end"),
    "segment_ids": (segment_ids, f"{_SEG}, {_HARD_SEG} SELECT video_id, seg_start, substr(sha256('0123456789abcdef' || chr(0) || video_id || chr(0) || seg_start || chr(0) || seg_end), 1, 20) AS segment_id FROM hs"),
    "frame_lookup": (frame_lookup, f"WITH {FR}, {_TRIPLES}, f AS (SELECT DISTINCT video_id, unnest(generate_series(s, e)) AS frame_index FROM t) SELECT video_id, frame_index, 'v' || video_id || '/' || printf('%05d', frame_index) || '.png' AS path FROM f"),
    "triplets_per_segment": (triplets_per_segment, f"{_SEG}, {_HARD_SEG} SELECT hs.video_id || ':' || seg_start AS segment, count(*) AS triplets FROM hs JOIN t ON t.video_id = hs.video_id AND t.s >= seg_start AND t.e <= seg_end GROUP BY ALL"),
    "overlay_update": (overlay_update, f"{_CLASSIFIED} SELECT sample_id, CASE WHEN s % 2 = 0 AND status = 'review' THEN 'accept' WHEN s % 2 = 0 AND status = 'accept' THEN 'review' ELSE status END AS status, CASE WHEN s % 2 = 0 AND status IN ('accept', 'review') THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS p_wrong FROM d"),
    "coverage_missing": (coverage_missing, f"{_CLASSIFIED} SELECT DISTINCT sample_id FROM d WHERE s % 7 = 0"),
    "coverage_extra": (coverage_extra, f"{_CLASSIFIED} SELECT DISTINCT sample_id FROM d WHERE s % 5 <> 0 AND s % 3 = 0"),
    "part_union_dedup": (part_union_dedup, "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS sample_id, text, lang, source, n_chars FROM documents"),
    "part_conflicts": (part_conflicts, "SELECT 'sample_id:' || doc_id AS identity, 2::BIGINT AS versions FROM documents WHERE doc_id % 10 = 0 AND source IS DISTINCT FROM 'other'"),
    "record_sort": (record_sort, "WITH r AS (SELECT doc_id, quality, CASE WHEN doc_id % 11 <> 0 THEN toxic END AS toxic FROM labels) SELECT doc_id, CAST(row_number() OVER (ORDER BY toxic NULLS FIRST, quality NULLS FIRST, '{\"doc_id\":' || doc_id || ',\"quality\":' || quality || ',\"toxic\":' || coalesce(CAST(toxic AS VARCHAR), 'null') || '}') AS INTEGER) AS place FROM r"),
    "claim_order": (claim_order, "SELECT o_orderkey AS task_id, CAST(-CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER) AS priority FROM orders WHERE o_orderstatus = 'O' ORDER BY priority DESC, o_orderdate, o_orderkey LIMIT 20"),
    "ledger_fold": (ledger_fold, _LEDGER),
    "ledger_resume": (ledger_resume, "SELECT o_orderkey AS task_id, 'pending' AS status FROM orders WHERE o_orderstatus = 'O'"),
}
