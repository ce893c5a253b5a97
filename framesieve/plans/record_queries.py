"""Queries over the ledger, records, manifests, files and decisions, with their DuckDB forms."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import parse
from ..functions import maps
from ..operators import gates, ledger, records
from ..operators import triplets as tr
from ..operators.scoring import mapped
from ..scratch import scratch
from ..sources import frames as files
from ..sources import sinks
from . import mining
from .encodings import FR, PX, frames, luma_maps, statuses, table
from .frame_queries import _CLASSIFIED, _HARD_SEG, _JSON, _SEG, _decisions, _segments, _with_ids


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("task_id"), F.concat(F.lit('{"n":'), F.col("o_custkey"), F.lit("}")).alias("payload_json"), (F.col("o_orderkey") % 5).cast("int").alias("priority"))


def ledger_enqueue(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks, and a batch that holds some of them again."""
    t = _orders(spark, sf)
    number = F.col("task_id").cast("long")
    return ledger.enqueue(t.where(number % 2 == 0), t.where(number % 3 == 0))


def ledger_recover(spark: SparkSession, sf: str) -> DataFrame:
    """Running orders whose lease, their price, ran out at 150,000."""
    status = F.when(F.col("o_orderstatus") == "O", "running").when(F.col("o_orderstatus") == "F", "done").otherwise("pending")
    state = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), status.alias("status"), F.concat(F.lit("w"), F.col("o_custkey") % 3).alias("owner"), F.when(status == "running", F.col("o_totalprice").cast("double")).alias("lease_expires"), F.lit(1.0).alias("updated_at"))
    return ledger.recover_expired(state, 150_000.0)


def ledger_list(spark: SparkSession, sf: str) -> DataFrame:
    """Pending tasks in their order, with their places."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), F.when(F.col("o_orderstatus") == "P", "pending").otherwise("done").alias("status"), F.col("o_orderdate").alias("created_at"))
    return records.numbered(ledger.listed(o, "pending"), [F.col("created_at"), F.col("task_id")]).select("task_id", "place")


def task_binding(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of frames as tasks, bound to the frames."""
    named = tr.chunks(frames(spark, sf), 7).select(F.col("chunk").alias("task_id"), F.concat_ws(":", "video_id", "frame_index").alias("sample_id"))
    return records.bound(named.groupBy("task_id").agg(F.collect_list("sample_id").alias("sample_ids")), named.select("sample_id"))


def one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions beside their diagnostics."""
    d = _decisions(spark, sf).select("sample_id", "status")
    return records.one_to_one(d, d.select("sample_id", F.length("status").alias("letters")), "sample_id")


def run_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one run, checked to be."""
    found = statuses(spark, sf).select("video_id", "frame_index", F.lit("0123456789abcdef").alias("run_hash"), F.lit("main").alias("stage"))
    return records.checked_run(found, run_hash="0123456789abcdef", stage="main").select("video_id", "frame_index", "run_hash")


def casefold_order(spark: SparkSession, sf: str) -> DataFrame:
    """Places of customers' names, every other one in lower case, without regard to case."""
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("name"))
    return records.numbered(c, [*records.fold_order("name"), F.col("c_custkey")]).select("c_custkey", "place")


def label_values(spark: SparkSession, sf: str) -> DataFrame:
    """Three-way labels as booleans, and the union of two reason lists in order of first sight."""
    p = table(spark, sf, "part")
    pick = lambda c: F.element_at(F.array(*[F.lit(x) for x in ("accept", "review", "reject", "other")]), (c % 4 + 1).cast("int"))
    a, b = F.array(pick(F.col("p_partkey")), pick(F.col("p_size"))), F.when(F.col("p_size") % 5 != 0, F.array(pick(F.col("p_size") + 1), pick(F.col("p_partkey"))))
    return p.select("p_partkey", gates.label_value(pick(F.col("p_size"))).alias("value"), F.array_join(gates.ordered_reasons(a, b), ",").alias("reasons"))


def sorted_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Labels written as sorted JSON lines, read back strictly, and checked to be in order."""
    rows = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    path = scratch(spark, "jsonl")
    sinks.write_jsonl(rows, path, ["quality", "doc_id"])
    back = files.read_jsonl(spark, path, rows.schema)
    placed = records.numbered(back, [F.col("quality").asc_nulls_first(), F.col("doc_id")])
    return records.checked_order(placed, "place", "quality").select("doc_id", "quality", "toxic")


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    digest = F.sha2(F.col("s_suppkey").cast("string"), 256)
    return table(spark, sf, "supplier").select(F.concat(F.lit("r/"), "s_suppkey").alias("path"), F.col("s_name").alias("name"), F.lit("data").alias("kind"), F.lit("made").alias("source"), F.lit("1").alias("version"), F.lit("x").alias("license"), F.col("s_suppkey").cast("long").alias("size"), digest.alias("sha256"))


def resource_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Every third resource in a new version."""
    m = _manifest(spark, sf)
    return files.upsert_resources(m, m.where("size % 3 = 0").withColumn("version", F.lit("2"))).select("path", "version")


def resource_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Resources that break a rule, one kind each."""
    n = F.col("size")
    bad = _manifest(spark, sf).withColumns({"path": F.when(n % 7 == 1, F.concat(F.lit("/"), "path")).otherwise(F.col("path")), "sha256": F.when(n % 7 == 2, F.upper("sha256")).otherwise(F.col("sha256")), "license": F.when(n % 7 != 3, F.col("license"))})
    return files.bad_resources(bad)


def resource_problems(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest against files of which some are missing, longer or changed."""
    m = _manifest(spark, sf)
    n = F.col("size")
    there = m.where(n % 5 != 0).select("path", F.when(n % 5 == 1, n + 1).otherwise(n).alias("size"), F.when(n % 5 == 2, F.sha2("path", 256)).otherwise(F.col("sha256")).alias("sha256"))
    return files.verify_resources(m, there)


def _index(spark: SparkSession, sf: str) -> DataFrame:
    """Triplets as an index with paths."""
    names = ("img0", "gt", "img1")
    one = lambda n: F.struct(F.col(f"{n}_index").alias("frame_index"), F.format_string("root/v%d/%05d.png", "video_id", f"{n}_index").alias("path"), F.format_string("v%d/%05d.png", "video_id", f"{n}_index").alias("relative_path"), (F.col(f"{n}_index") + 1).alias("size"), F.col("video_id").alias("modified")).alias(n)
    return _with_ids(tr.triplets(frames(spark, sf))).select("sample_id", "video_id", F.array(*[F.col(f"{n}_index").cast("int") for n in names]).alias("frame_indices"), *[one(n) for n in names])


def changed_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of an index that a later listing lacks, or shows with another size or time."""
    i = F.col("frame_index")
    now = frames(spark, sf).where(i % 11 != 0).select(F.format_string("v%d/%05d.png", "video_id", "frame_index").alias("relative_path"), F.when(i % 7 == 0, i).otherwise(i + 1).alias("size"), F.when(i % 5 == 0, F.col("video_id") + 1).otherwise(F.col("video_id")).alias("modified"))
    return mining.changed_frames(_index(spark, sf), now).select("relative_path")


def index_digest(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(mining.index_digest(_index(spark, sf)),)], "digest string")


def _results(spark: SparkSession, sf: str) -> DataFrame:
    d = _decisions(spark, sf)
    return d.select(F.concat_ws("::", F.lit("."), F.concat(F.lit("v"), "video_id")).alias("video_id"), F.array(F.col("start"), F.col("start") + 1, F.col("end")).alias("frame_indices"), "status", "sample_id", F.array("status").alias("reasons"))


def segment_folders(spark: SparkSession, sf: str) -> DataFrame:
    """Segments with their ids, folders and reasons, as the final stage names them."""
    return mining.segments_of(_results(spark, sf), "0123456789abcdef").select("video_id", F.col("start").alias("seg_start"), F.col("end").alias("seg_end"), "segment_id", "output_directory", F.array_join("reasons", ",").alias("reasons"))


def annotated_results(spark: SparkSession, sf: str) -> DataFrame:
    r = _results(spark, sf)
    found = mining.annotated(r, mining.segments_of(r, "0123456789abcdef"))
    return found.select("sample_id", "covered_by_segment", "contributed_to_segment", "selected", F.array_join("segment_output_directories", ",").alias("folders"), F.array_join("segment_ids", ",").alias("segment_ids"))


def output_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Where the frames of every segment go."""
    s = _segments(_decisions(spark, sf)).withColumn("output_directory", F.concat_ws("_", "video_id", "start"))
    return mining.output_plan(s, _index(spark, sf), "segment_relative")


def _images(spark: SparkSession, sf: str) -> str:
    """Maps as grey 8x8 PNG files below a shared folder: video n % 10, frame n / 10."""
    root = scratch(spark, "images").removeprefix("file://")
    rows = luma_maps(spark, sf)

    def work(r) -> dict:
        grey = np.round(np.asarray(r.luma).reshape(8, 8) * 255).astype(np.uint8)
        return {"name": f"v{r.vec_id % 10}/clip{r.vec_id // 10:05d}", "png": sinks.png_bytes(np.repeat(grey[..., None], 3, axis=-1))}

    sinks.write_files(mapped(rows, "name string, png binary", work), root, name="name")
    return root


def frame_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files that were written, scanned and parsed."""
    found = files.scan_frames(spark, _images(spark, sf), digits=5, allowed=("PNG",))
    return found.select("video_id", F.col("frame_index").cast("int"), "relative_path")


def image_luma(spark: SparkSession, sf: str) -> DataFrame:
    """The sum of a channel of every decoded image."""
    root = _images(spark, sf)
    images = files.named_frames(files.read_images(spark, [f"{root}/v{i}" for i in range(10)]), root, digits=5)

    def work(r) -> dict:
        a = mining._rgb(r)
        return {"video_id": r.video_id, "frame_index": r.frame_index, "total": int(np.round(a[..., 0] * 255).sum())}

    return mapped(images.select("video_id", "frame_index", "height", "width", "nChannels", "bgr"), "video_id string, frame_index int, total int", work)


def image_index(spark: SparkSession, sf: str) -> DataFrame:
    """The index over files that were written."""
    config = parse({"data": {"root": _images(spark, sf), "frame_regex": None, "frame_digits": 5}, "model": {"factory": "mock"}})
    found = mining.build_index(spark, config)
    return found.select("sample_id", "video_id", F.array_join(F.transform("frame_indices", lambda i: i.cast("string")), ",").alias("indices"))


def model_names(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in mining.model_names()], "name string")


def contiguous_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Every three frames that follow each other in a video, and whether they are a stride apart."""
    w = W.partitionBy("video_id").orderBy("frame_index")
    three = F.array("frame_index", F.lead("frame_index").over(w), F.lead("frame_index", 2).over(w))
    found = frames(spark, sf).withColumn("three", three).where("three[2] IS NOT NULL")
    return found.select("video_id", "frame_index", tr.contiguous(F.col("three"), F.lit(1)).alias("contiguous"))


def metric_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics and local metrics of every map as one map."""
    s = maps.summary(F.col("luma"))
    whole = F.create_map(F.lit("mean"), s["mean"], F.lit("local_max"), F.lit(0.0))
    local = F.create_map(F.lit("mean"), s["q95"], F.lit("max"), s["max"])
    return luma_maps(spark, sf).select("vec_id", F.explode(maps.merged_metrics(whole, local)).alias("name", "v")).select("vec_id", "name", F.round("v", 6).alias("value"))


_SHA = "substr(sha256('0123456789abcdef' || chr(0) || '.::v' || {0}.video_id || chr(0) || {0}.seg_start || chr(0) || {0}.seg_end), 1, 20)"
_FOLDER = "'v' || {0}.video_id || '/segment_' || printf('%08d', {0}.seg_start) || '_' || printf('%08d', {0}.seg_end) || '_' || substr(" + _SHA + ", 1, 8)"
_FILE = "(SELECT vec_id, 'v' || (vec_id % 10) AS dir, CAST(vec_id // 10 AS INTEGER) AS f FROM embeddings)"
_ENTRY = "'{{\"index\":' || ({0}) || ',\"path\":\"' || a.dir || '/clip' || printf('%05d', {0}) || '.png\"}}'"
_FILE_JSON = "'{\"frames\":[' || " + " || ',' || ".join(_ENTRY.format(f"a.f + {i}") for i in range(3)) + " || '],\"stride\":1,\"version\":1,\"video_id\":\"' || a.dir || '::clip\"}'"
_IDS = f"WITH {FR}, a AS (SELECT a.* FROM fr a JOIN fr b ON a.video_id = b.video_id AND b.frame_index = a.frame_index + 1 JOIN fr c ON a.video_id = c.video_id AND c.frame_index = a.frame_index + 2)"

QUERIES = {
    "ledger_enqueue": (ledger_enqueue, "SELECT CAST(o_orderkey AS VARCHAR) AS task_id, '{\"n\":' || o_custkey || '}' AS payload_json, CAST(o_orderkey % 5 AS INTEGER) AS priority FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"),
    "ledger_recover": (ledger_recover, "SELECT o_orderkey AS task_id, CASE WHEN late THEN 'pending' ELSE status END AS status, CASE WHEN NOT late THEN 'w' || (o_custkey % 3) END AS owner, CASE WHEN NOT late THEN lease END AS lease_expires, CASE WHEN late THEN 150000.0::DOUBLE ELSE 1.0::DOUBLE END AS updated_at FROM (SELECT *, coalesce(status = 'running' AND lease <= 150000, false) AS late FROM (SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'done' ELSE 'pending' END AS status, CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DOUBLE) END AS lease FROM orders))"),
    "ledger_list": (ledger_list, "SELECT o_orderkey AS task_id, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS place FROM orders WHERE o_orderstatus = 'P'"),
    "task_binding": (task_binding, f"WITH {FR}, n AS (SELECT *, (row_number() OVER (PARTITION BY video_id ORDER BY frame_index) - 1) // 7 AS c FROM fr), p AS (SELECT video_id, max(c) + 1 AS k FROM n GROUP BY video_id), o AS (SELECT video_id, coalesce(sum(k) OVER (ORDER BY video_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM p) SELECT CAST(o.base + n.c AS BIGINT) AS task_id, n.video_id || ':' || n.frame_index AS sample_id FROM n JOIN o USING (video_id)"),
    "one_to_one": (one_to_one, f"{_CLASSIFIED} SELECT sample_id, status, CAST(length(status) AS INTEGER) AS letters FROM d"),
    "run_identity": (run_identity, f"WITH {FR} SELECT video_id, frame_index, '0123456789abcdef' AS run_hash FROM fr"),
    "casefold_order": (casefold_order, "WITH k AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE c_name END AS name FROM customer) SELECT c_custkey, row_number() OVER (ORDER BY lower(name), name, c_custkey) AS place FROM k"),
    "label_values": (label_values, "WITH k AS (SELECT p_partkey, p_size, ['accept', 'review', 'reject', 'other'] AS l FROM part), r AS (SELECT p_partkey, l[p_size % 4 + 1] AS s, [l[p_partkey % 4 + 1], l[p_size % 4 + 1]] || CASE WHEN p_size % 5 <> 0 THEN [l[(p_size + 1) % 4 + 1], l[p_partkey % 4 + 1]] ELSE [] END AS a FROM k) SELECT p_partkey, CASE s WHEN 'accept' THEN true WHEN 'reject' THEN false END AS value, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') AS reasons FROM r"),
    "sorted_parts": (sorted_parts, "SELECT doc_id, quality, toxic FROM labels"),
    "resource_upsert": (resource_upsert, "SELECT 'r/' || s_suppkey AS path, CASE WHEN s_suppkey % 3 = 0 THEN '2' ELSE '1' END AS version FROM supplier"),
    "resource_rules": (resource_rules, "SELECT CASE WHEN s_suppkey % 7 = 1 THEN '/' ELSE '' END || 'r/' || s_suppkey AS path, CASE s_suppkey % 7 WHEN 1 THEN 'unsafe path' WHEN 2 THEN 'sha256' ELSE 'field missing' END AS problem FROM supplier WHERE s_suppkey % 7 IN (1, 2, 3)"),
    "resource_problems": (resource_problems, "SELECT 'r/' || s_suppkey AS path, CASE s_suppkey % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'size' ELSE 'hash' END AS problem FROM supplier WHERE s_suppkey % 5 IN (0, 1, 2)"),
    "changed_frames": (changed_frames, f"{_CLASSIFIED}, f AS (SELECT DISTINCT video_id, unnest(generate_series(s, e)) AS i FROM t) SELECT 'v' || video_id || '/' || printf('%05d', i) || '.png' AS relative_path FROM f WHERE i % 11 = 0 OR i % 7 = 0 OR i % 5 = 0"),
    "index_digest": (index_digest, f"{_IDS}, s AS (SELECT sha256({_JSON}) AS i FROM a), g AS (SELECT substr(i, 1, 4) AS p, sha256(string_agg(i, chr(10) ORDER BY i)) AS d FROM s GROUP BY 1) SELECT sha256(string_agg(p || d, '' ORDER BY p)) AS digest FROM g"),
    "segment_folders": (segment_folders, f"{_SEG}, {_HARD_SEG} SELECT '.::v' || hs.video_id AS video_id, seg_start, seg_end, {_SHA.format('hs')} AS segment_id, {_FOLDER.format('hs')} AS output_directory, 'accept' AS reasons FROM hs"),
    "annotated_results": (annotated_results, f"{_SEG}, {_HARD_SEG}, lent AS (SELECT DISTINCT k.sample_id FROM hs JOIN kept k ON k.video_id = hs.video_id AND k.f BETWEEN seg_start AND seg_end) SELECT d.sample_id, hs.video_id IS NOT NULL AS covered_by_segment, lent.sample_id IS NOT NULL AS contributed_to_segment, hs.video_id IS NOT NULL AND d.status = 'accept' AS selected, CASE WHEN hs.video_id IS NULL THEN '' ELSE {_FOLDER.format('hs')} END AS folders, CASE WHEN hs.video_id IS NULL THEN '' ELSE {_SHA.format('hs')} END AS segment_ids FROM d LEFT JOIN hs ON hs.video_id = d.video_id AND d.s >= seg_start AND d.e <= seg_end LEFT JOIN lent ON lent.sample_id = d.sample_id"),
    "output_plan": (output_plan, f"{_SEG}, {_HARD_SEG} SELECT 'root/v' || hs.video_id || '/' || printf('%05d', frame_index) || '.png' AS source, hs.video_id || '_' || seg_start || '/' || printf('%05d', frame_index) || '.png' AS destination FROM hs JOIN fr ON fr.video_id = hs.video_id AND fr.frame_index BETWEEN seg_start AND seg_end"),
    "frame_scan": (frame_scan, f"SELECT dir || '::clip' AS video_id, f AS frame_index, dir || '/clip' || printf('%05d', f) || '.png' AS relative_path FROM {_FILE}"),
    "image_luma": (image_luma, "SELECT 'v' || (vec_id % 10) || '::clip' AS video_id, CAST(vec_id // 10 AS INTEGER) AS frame_index, CAST(sum(round_even(least(greatest((CAST(e AS DOUBLE) + 1) / 2, 0.0::DOUBLE), 1.0::DOUBLE) * 255, 0)) AS INTEGER) AS total FROM (SELECT vec_id, unnest(embedding) AS e FROM embeddings) GROUP BY vec_id"),
    "image_index": (image_index, f"SELECT sha256({_FILE_JSON}) AS sample_id, a.dir || '::clip' AS video_id, a.f || ',' || (a.f + 1) || ',' || (a.f + 2) AS indices FROM {_FILE} a JOIN {_FILE} b ON a.dir = b.dir AND b.f = a.f + 1 JOIN {_FILE} c ON a.dir = c.dir AND c.f = a.f + 2"),
    "contiguous_windows": (contiguous_windows, f"WITH {FR}, w AS (SELECT video_id, frame_index, lead(frame_index) OVER o AS b, lead(frame_index, 2) OVER o AS c FROM fr WINDOW o AS (PARTITION BY video_id ORDER BY frame_index)) SELECT video_id, frame_index, b = frame_index + 1 AND c = b + 1 AS contiguous FROM w WHERE c IS NOT NULL"),
    "metric_maps": (metric_maps, f"WITH {PX}, s AS (SELECT vec_id, avg(l) AS a, quantile_cont(l, 0.95::DOUBLE) AS b, max(l) AS c FROM px GROUP BY vec_id) SELECT vec_id, unnest(['mean', 'local_mean', 'local_max']) AS name, round(unnest([a, b, c]), 6) AS value FROM s"),
    "model_names": (model_names, "SELECT 'mock' AS name"),
}
