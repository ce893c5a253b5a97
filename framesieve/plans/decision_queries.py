"""Queries over the main and teacher stages' decisions on measured samples, with their DuckDB forms. Parts stand in for samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, parse
from ..operators import diagnosis
from ..scratch import cut
from . import mining
from .encodings import table
from .map_queries import r6


def _config() -> Config:
    model = {"factory": "mock"}
    return parse({"data": {"root": "unused"}, "model": model, "teacher": model})


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """What the main stage measures: none to two regions per part, quiet gates, and an error at every seventeenth."""
    p = table(spark, sf, "part").select("p_partkey", "p_size", F.floor("p_retailprice").alias("price"))

    def region(v: int):
        price, size = F.col("price") + 3 * v, F.col("p_size") + v
        share = lambda c, n: c % n / float(n)
        fields = {
            "x0": F.lit(v), "y0": F.lit(0), "x1": size % 8 + 1 + v, "y1": price % 8 + 1, "score": share(price, 10), "current": share(price, 10), "missing": share(size, 9), "extra": share(price, 7), "gt_edge": share(size, 5), "pred_edge": share(price, 6),
            "gt_endpoints": price % 3, "pred_endpoints": size % 4, "gt_components": price % 2, "pred_components": size % 2, "warp0": share(price, 13), "warp1": share(size, 13), "blend": share(price, 5), "copy_distance": share(price, 11), "width": size % 8 + 1, "height": price % 8 + 1,
            "ui_likelihood": F.lit(0.0), "priority_weight": F.when((F.col("p_partkey") + v) % 3 == 0, 0.5).otherwise(1.0), "metrics": F.create_map(F.lit("v"), F.lit(float(v))),
        }
        kinds = dict(x.split(":", 1) for x in mining.MEASURED.replace("map<string,double>", "map<string;double>").split(","))
        return F.struct(*[c.cast(kinds[n].replace(";", ",")).alias(n) for n, c in fields.items()])

    one, two = F.array(region(0)), F.array(region(0), region(1))
    key = F.col("p_partkey")
    quiet = {"decode_ok": True, "finite": True, "sequence_contiguous": True, "duplicate_distance": 0.1, "scene_cut_score": 0.1, "histogram_jump": 0.1, "temporal_asymmetry": 0.1, "max_adjacent_difference": 0.1, "menu_transition_score": 0.1}
    calm = dict.fromkeys(("out_of_bounds_ratio", "flow_discontinuity_ratio", "foreground_large_motion_ratio", "occlusion_ratio", "unexplained_motion_ratio", "background_motion"), 0.1)
    struct = lambda values, name: F.struct(*[F.lit(v).alias(k) for k, v in values.items()]).alias(name)
    return p.select(
        key.cast("string").alias("sample_id"), F.lit("run").alias("run_hash"), F.lit("v").alias("video_id"), F.lit(1).alias("stride"), F.array(key).alias("frame_indices"), F.when(key % 17 == 0, "unreadable").alias("error"),
        (F.col("p_size") / 50.0).alias("raw_p_wrong"), (F.col("p_size") / 50.0).alias("raw_mining_p_wrong"), struct(quiet, "validity"), struct(calm, "scope"), F.when((key % 17 == 0) | (key % 10 == 0), F.slice(one, 1, 0)).when(key % 10 < 4, one).otherwise(two).alias("measured"),
    )


def _main(spark: SparkSession, sf: str) -> DataFrame:
    config = _config()
    return mining._decided(mining.diagnosed(_raw(spark, sf), config.thresholds.edge_threshold), config).drop("measured", "diagnosis_reasons", "validity_gate", "scope_gate")


_SHOWN = ("p_wrong", "mining_p_wrong", "p_solvable")


def sample_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    """Each region's labels and solvability."""
    found = mining.diagnosed(_raw(spark, sf), _config().thresholds.edge_threshold)
    r = found.select("sample_id", F.posexplode("regions").alias("at", "r"))
    return r.select("sample_id", "at", r6(F.col("r.p_solvable")).alias("p_solvable"), F.array_join("r.reasons", ",").alias("reasons"), F.array_join(F.transform("r.box", lambda b: b.cast("string")), ",").alias("box"))


def main_records(spark: SparkSession, sf: str) -> DataFrame:
    """Primary region, probabilities, status and reasons of the main stage."""
    return _main(spark, sf).select("sample_id", "status", "primary_region_index", "valid", "in_scope", *[r6(F.col(n)).alias(n) for n in _SHOWN], F.array_join("reasons", ",").alias("reasons"))


def teacher_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records after a teacher judged the accepted and reviewed ones; every thirteenth of its calls fails."""
    main = cut(_main(spark, sf), "main-records")
    key = F.col("sample_id").cast("long")
    failed = key % 13 == 0
    seen = mining.candidates(main).select(
        "sample_id", F.when(~failed, key % 11 / 11.0).alias("teacher_p_wrong"), F.when(~failed, F.transform("regions", lambda r, i: ((key + i) % 9) / 9.0)).alias("teacher_local"), F.when(failed, "no frame").alias("teacher_failed")
    )
    taught = mining.teach(spark, main, _config(), seen)
    return taught.select("sample_id", "status", "primary_region_index", *[r6(F.col(n)).alias(n) for n in _SHOWN], F.array_join("reasons", ",").alias("reasons"), F.col("main_decision.status").alias("first_status"), r6(F.col("teacher_error")).alias("teacher_error"))


_CLIP = "least(greatest({0}, 0.0::DOUBLE), 1.0::DOUBLE)"
_GAIN = "least(greatest((cur - {0}) / greatest(cur, 0.05::DOUBLE), -1.0::DOUBLE), 1.0::DOUBLE)"
_EVIDENCE = _CLIP.format("0.8::DOUBLE * " + _CLIP.format("0.5::DOUBLE + 0.5::DOUBLE * " + _GAIN) + " + 0.2::DOUBLE * " + _CLIP.format("1.0::DOUBLE - {0} / 0.12::DOUBLE"))


def _solved(teacher: str | None) -> str:
    """p_solvable of an error ``cur`` beside a teacher's (or NULL) and the best warp ``best``."""
    low = lambda p: _CLIP.format(f"CASE WHEN cur < 0.05 THEN least({p}, 0.5::DOUBLE) ELSE {p} END")
    warp = f"(0.0::DOUBLE + {_EVIDENCE.format('best')} * 0.35::DOUBLE) / (0.0::DOUBLE + 0.35::DOUBLE)"
    if teacher is None:
        return low(warp)
    both = f"({_EVIDENCE.format(teacher)} * 0.65::DOUBLE + {_EVIDENCE.format('best')} * 0.35::DOUBLE) / (0.65::DOUBLE + 0.35::DOUBLE)"
    return f"CASE WHEN {teacher} IS NULL THEN {low(warp)} ELSE {low(both)} END"


def _alone(teacher: str) -> str:
    """p_solvable without a region: a teacher's error or nothing beside ``cur``."""
    p = f"CASE WHEN {teacher} IS NULL THEN 0.5::DOUBLE ELSE ({_EVIDENCE.format(teacher)} * 0.65::DOUBLE + 0.0::DOUBLE) / (0.65::DOUBLE + 0.0::DOUBLE) END"
    return _CLIP.format(f"CASE WHEN cur < 0.05 THEN least({p}, 0.5::DOUBLE) ELSE {p} END")


_LABELS = "[" + ", ".join(f"'{x}'" for x in diagnosis.LABELS) + "]"
_REGIONS = f"""
WITH pt AS (SELECT p_partkey, p_size, CAST(floor(p_retailprice) AS BIGINT) AS price, CASE WHEN p_partkey % 17 = 0 OR p_partkey % 10 = 0 THEN 0 WHEN p_partkey % 10 < 4 THEN 1 ELSE 2 END AS n FROM part),
k0 AS (SELECT p_partkey, v, price + 3 * v AS pr, p_size + v AS sz, CASE WHEN (p_partkey + v) % 3 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS w FROM (SELECT *, unnest(range(n)) AS v FROM pt)),
k AS (SELECT p_partkey, v, pr, sz, w, pr % 10 / 10.0::DOUBLE AS cur, sz % 9 / 9.0::DOUBLE AS mi, pr % 7 / 7.0::DOUBLE AS ex, sz % 5 / 5.0::DOUBLE AS ge, pr % 6 / 6.0::DOUBLE AS pe, pr % 3 AS gn, sz % 4 AS pn, pr % 2 AS gc, sz % 2 AS pc, sz % 8 + 1 AS wd, pr % 8 + 1 AS ht, pr % 11 / 11.0::DOUBLE AS cd, pr % 13 / 13.0::DOUBLE AS w0, sz % 13 / 13.0::DOUBLE AS w1, pr % 5 / 5.0::DOUBLE AS bl FROM k0),
lab AS (SELECT p_partkey, v, cur, w, least(w0, w1, bl) AS best, v || ',0,' || (wd + v) || ',' || ht AS box, list_filter([
  CASE WHEN mi >= 0.12 AND mi >= ex * 1.25::DOUBLE + 0.01::DOUBLE THEN 'missing_part' END, CASE WHEN mi >= 0.12 AND (pn > gn OR pc > gc OR greatest(wd, ht) / least(wd, ht) >= 1.75) THEN 'broken_structure' END,
  CASE WHEN mi >= 0.12 AND ex >= 0.12 AND mi / greatest(ex, 1e-6) BETWEEN 0.35 AND 2.85 THEN 'ghosting' END, CASE WHEN greatest(mi, ex) >= 0.12 THEN 'edge_tearing' END, CASE WHEN mi >= 0.12 AND ge - pe >= 0.08 THEN 'blur' END,
  CASE WHEN cur >= 0.05 AND cd <= greatest(0.03::DOUBLE, cur * (1 - 0.65::DOUBLE)) THEN 'endpoint_copy' END, CASE WHEN least(w0, w1) + 0.08::DOUBLE < bl THEN 'blend_mask_error' END], lambda q: q IS NOT NULL) AS labels FROM k),
reg AS (SELECT *, {_solved(None)} AS ps FROM lab)"""
_TOP = "(SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY cur * {0} * w DESC, cur * w DESC, cur DESC, v) AS rk FROM {1})"
#: Decision of quiet gates: label and reasons from wrongness ``mw`` and solvability ``ps``.
_DECISION = "CASE WHEN mw < 0.20 THEN 'reject' WHEN mw < 0.45 OR ps < 0.55 THEN 'review' ELSE 'accept' END"
_WHY = "CASE WHEN mw < 0.20 THEN ['prediction_not_wrong'] ELSE list_filter([CASE WHEN mw < 0.45 THEN 'wrongness_gray_zone' END, CASE WHEN ps < 0.30 THEN 'solvability_low' WHEN ps < 0.55 THEN 'solvability_gray_zone' END], lambda q: q IS NOT NULL) END"
_MAIN = f"""{_REGIONS},
why AS (SELECT p_partkey, list_filter({_LABELS}, lambda x: list_contains(flatten(list(labels)), x)) AS labels FROM lab GROUP BY p_partkey),
s0 AS (SELECT pt.p_partkey, t.v AS rp, coalesce(t.cur, p_size / 50.0::DOUBLE) AS cur, coalesce(t.cur * t.w, p_size / 50.0::DOUBLE) AS mw, t.ps AS tps, coalesce(why.labels, []) AS labels, pt.p_partkey % 17 = 0 AS bad FROM pt LEFT JOIN {_TOP.format('ps', 'reg')} t ON t.p_partkey = pt.p_partkey AND t.rk = 1 LEFT JOIN why ON why.p_partkey = pt.p_partkey),
s AS (SELECT *, CASE WHEN bad THEN 0.0::DOUBLE ELSE coalesce(tps, {_alone('NULL::DOUBLE')}) END AS ps FROM s0),
m AS (SELECT *, CASE WHEN bad THEN 'invalid' ELSE {_DECISION} END AS status, CASE WHEN bad THEN ['invalid_decode_or_shape'] ELSE labels || {_WHY} END AS reasons FROM s)"""
_TEACHER = f"""{_MAIN},
c AS (SELECT *, p_partkey % 13 = 0 AS failed, CASE WHEN p_partkey % 13 <> 0 THEN p_partkey % 11 / 11.0::DOUBLE END AS te FROM m WHERE status IN ('accept', 'review')),
r2 AS (SELECT *, {_solved('tl')} AS ps2 FROM (SELECT reg.*, CASE WHEN reg.p_partkey % 13 <> 0 THEN (reg.p_partkey + v) % 9 / 9.0::DOUBLE END AS tl FROM reg)),
t2 AS (SELECT p_partkey, v, cur AS c2, cur * w AS m2, ps2 FROM {_TOP.format('ps2', 'r2')} WHERE rk = 1),
n0 AS (SELECT c.p_partkey, t2.v AS rp, coalesce(t2.c2, c.cur) AS cur, coalesce(t2.m2, c.mw) AS mw, t2.ps2, c.te, c.failed, c.labels, c.status AS first_status FROM c LEFT JOIN t2 USING (p_partkey)),
n1 AS (SELECT *, coalesce(ps2, {_alone('te')}) AS ps FROM n0),
n AS (SELECT *, CASE WHEN failed THEN 'review' ELSE {_DECISION} END AS status, labels || {_WHY} || CASE WHEN failed THEN ['teacher_unavailable'] ELSE [] END AS reasons FROM n1)
SELECT CAST(m.p_partkey AS VARCHAR) AS sample_id, coalesce(n.status, m.status) AS status, CAST(CASE WHEN n.p_partkey IS NULL THEN m.rp ELSE n.rp END AS INTEGER) AS primary_region_index, round(coalesce(n.cur, m.cur), 6) AS p_wrong, round(coalesce(n.mw, m.mw), 6) AS mining_p_wrong, round(coalesce(n.ps, m.ps), 6) AS p_solvable,
  coalesce(array_to_string(coalesce(n.reasons, m.reasons), ','), '') AS reasons, n.first_status, round(n.te, 6) AS teacher_error FROM m LEFT JOIN n ON n.p_partkey = m.p_partkey
"""

QUERIES = {
    "sample_diagnosis": (sample_diagnosis, f"{_REGIONS} SELECT CAST(p_partkey AS VARCHAR) AS sample_id, CAST(v AS INTEGER) AS at, round(ps, 6) AS p_solvable, coalesce(array_to_string(labels, ','), '') AS reasons, box FROM reg"),
    "main_records": (main_records, f"{_MAIN} SELECT CAST(p_partkey AS VARCHAR) AS sample_id, status, CAST(rp AS INTEGER) AS primary_region_index, NOT bad AS valid, CASE WHEN NOT bad THEN true END AS in_scope, round(cur, 6) AS p_wrong, round(mw, 6) AS mining_p_wrong, round(ps, 6) AS p_solvable, coalesce(array_to_string(reasons, ','), '') AS reasons FROM m"),
    "teacher_records": (teacher_records, _TEACHER),
}
