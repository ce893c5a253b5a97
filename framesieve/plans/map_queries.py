"""Queries over 8x8 luma maps, gates and regions, with their DuckDB forms. Floats are rounded to six digits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import maps as m
from ..operators import diagnosis, gates, kernels, scoring
from .encodings import PX, luma_maps, table

H = W = 8


def r6(c: Column) -> Column:
    return F.round(c, 6)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(pair, truth, prediction): maps 2n and 2n + 1."""
    px = luma_maps(spark, sf)
    half = lambda odd, name: px.where(F.col("vec_id") % 2 == odd).select(F.floor(F.col("vec_id") / 2).alias("pair"), F.col("luma").alias(name))
    return half(0, "truth").join(half(1, "prediction"), "pair")


def _triples(spark: SparkSession, sf: str) -> DataFrame:
    """(first, a, b, c): maps n, n + 1, n + 2 in one shuffle."""
    px = luma_maps(spark, sf)
    spread = px.select(F.explode(F.array(*[F.struct((F.col("vec_id") - i).alias("first"), F.lit(i).alias("i"), "luma") for i in range(3)])).alias("e")).select("e.*")
    got = spread.groupBy("first").agg(*[F.max(F.when(F.col("i") == i, F.struct("luma"))).alias(n) for i, n in enumerate("abc")])
    return got.where("a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL").select("first", F.col("a.luma").alias("a"), F.col("b.luma").alias("b"), F.col("c.luma").alias("c"))


def luma_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = m.summary(F.col("luma"))
    return luma_maps(spark, sf).select("vec_id", *[r6(s[k]).alias(k) for k in ("mean", "max", "q95", "q99", "q999")])


def map_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    ordered = F.array_sort("luma")
    return luma_maps(spark, sf).select("vec_id", *[r6(m.quantile(ordered, q)).alias(f"q{round(q * 100)}") for q in (0.5, 0.75, 0.9, 0.96)])


FRACTIONS = (0.001, 0.05, 0.10, 0.5, 1.0)


def top_area_mean(spark: SparkSession, sf: str) -> DataFrame:
    ordered = F.array_sort("luma")
    return luma_maps(spark, sf).select("vec_id", *[r6(m.top_area_mean(ordered, f)).alias(f"top{i}") for i, f in enumerate(FRACTIONS)])


def robust_local_score(spark: SparkSession, sf: str) -> DataFrame:
    return luma_maps(spark, sf).select("vec_id", r6(m.robust_score(F.col("luma"))).alias("score"))


def sobel(spark: SparkSession, sf: str) -> DataFrame:
    edges = luma_maps(spark, sf).select("vec_id", F.posexplode(m.sobel(F.col("luma"), H, W)).alias("i", "edge"))
    return edges.select("vec_id", (F.col("i") % W).alias("x"), F.floor(F.col("i") / W).cast("int").alias("y"), r6(F.col("edge")).alias("edge"))


def error_maps(spark: SparkSession, sf: str) -> DataFrame:
    names = ("luminance", "gt_only_edge", "pred_only_edge", "structure")
    maps = _pairs(spark, sf).select("pair", m.error_maps(F.col("prediction"), F.col("truth"), H, W).alias("e"))
    return maps.select("pair", *[r6(f(F.col(f"e.{n}"))).alias(f"{n}_{k}") for n in names for k, f in (("mean", m.mean), ("max", F.array_max))])


def histogram_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).select("pair", r6(m.histogram_distance(F.col("truth"), F.col("prediction"))).alias("distance"))


def repeat_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).select("pair", r6(m.repeat_distance(F.col("truth"), F.col("prediction"))).alias("distance"))


def square(m, height: int = H, width: int = W) -> np.ndarray:
    return np.asarray(m, np.float64).reshape(height, width)


def validity_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The gate over the mining plan's metrics of three luma maps; the overlay score has a query of its own."""
    names = ("duplicate_distance", "scene_cut_score", "temporal_asymmetry", "max_adjacent_difference", "menu_transition_score")

    def work(row) -> dict:
        found = kernels.validity_of_luma(square(row.a), square(row.b), square(row.c), menu=0.0)
        return {"first": row.first, **{n: found[n] for n in names}}

    rows = scoring.mapped(_triples(spark, sf), "first long, " + ", ".join(f"{n} double" for n in names), work)
    flags = {n: F.lit(True) for n in ("decode_ok", "finite", "sequence_contiguous")}
    gate = gates.validity_gate({n: F.col(n) for n in names} | flags)
    return rows.withColumn("g", gate).select("first", r6(F.col("scene_cut_score")).alias("scene_cut"), F.col("g.label").alias("label"), F.array_join("g.reasons", ",").alias("reasons"), gates.label_value(F.col("g.label")).alias("valid"))


def _flow(e, height: int = 8, width: int = 4) -> np.ndarray:
    """Halves of an embedding as a motion field, in pixels after scaling by 8."""
    v = np.asarray(e, np.float64) * 8
    return np.stack([v[: height * width].reshape(height, width), v[height * width :].reshape(height, width)], axis=-1)


def flow_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The mining plan's motion metrics of 8x4 fields."""

    def work(row) -> dict:
        found = kernels.flow_metrics(_flow(row.embedding))
        return {"vec_id": row.vec_id, "out_of_bounds_ratio": found["out_of_bounds_ratio"], "unexplained_motion_ratio": float((found["residual"] > kernels.LARGE_MOTION).mean()), "flow_discontinuity_ratio": found["flow_discontinuity_ratio"], "background_motion": found["background_motion"]}

    names = ("out_of_bounds_ratio", "unexplained_motion_ratio", "flow_discontinuity_ratio", "background_motion")
    got = scoring.mapped(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id long, " + ", ".join(f"{n} double" for n in names), work)
    return got.select("vec_id", *[r6(F.col(n)).alias(n) for n in names])


def window_means(spark: SparkSession, sf: str) -> DataFrame:
    cells = luma_maps(spark, sf).select("vec_id", F.explode(m.window_means(F.col("luma"), H, W, 4)).alias("c"))
    return cells.select("vec_id", F.col("c.y").alias("y"), F.col("c.x").alias("x"), r6(F.col("c.mean")).alias("mean"))


def native_mask_components(spark: SparkSession, sf: str) -> DataFrame:
    """Components of the pixels at or above 0.55: number, and area, boundary and peak of all."""
    return scoring.component_rows(luma_maps(spark, sf), H, W, 0.55).select("vec_id", "x0", "y0", "x1", "y1", "area", "perimeter", r6(F.col("peak")).alias("peak"))


def nms_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy suppression of each brand's part boxes, natives first, eight at most: the chosen ones and their places."""
    b = _boxes(spark, sf).join(table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.floor("p_retailprice").alias("price")), F.col("p_partkey") == F.col("k"))
    held = b.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "x0", "y0", "x1", "y1", "price"))).alias("boxes"))

    def work(row) -> list[dict]:
        found = [kernels.Region((r["x0"], r["y0"], r["x1"], r["y1"]), int(r["price"]) % 64 / 64, r["p_partkey"] % 4 == 0, {"key": r["p_partkey"]}, weight=0.5 if r["p_partkey"] % 2 else 1.0) for r in row.boxes]
        return [{"p_brand": row.p_brand, "p_partkey": r.metrics["key"], "place": i + 1} for i, r in enumerate(kernels.suppress(found, 8, 0, 0.55))]

    return scoring.mapped(held, "p_brand string, p_partkey long, place int", work)


def score_samples(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_maps(_pairs(spark, sf), H, W).select("pair", r6(F.col("p_wrong")).alias("p_wrong"), r6(F.col("mining_p_wrong")).alias("mining_p_wrong"), F.size("regions").alias("n_regions"))


def _branch(truth: str, other: str) -> Column:
    return m.robust_score(m.abs_difference(F.col(truth), F.col(other)))


def solvability(spark: SparkSession, sf: str) -> DataFrame:
    """The prediction's error beside a teacher, the mean of both maps, where the pair is even."""
    p = _pairs(spark, sf).withColumn("teacher", F.zip_with("truth", "prediction", lambda a, b: (a + b) / 2))
    p = p.withColumn("current", _branch("truth", "prediction")).withColumn("better", F.when(F.col("pair") % 2 == 0, _branch("truth", "teacher")))
    p = p.withColumn("warp", F.when(F.col("pair") % 3 == 0, F.col("current") * 0.5))
    s = p.withColumn("s", diagnosis.solvability(F.col("current"), F.col("better"), (F.col("warp"),)))
    return s.select("pair", r6(F.col("s.p_solvable")).alias("p_solvable"), r6(F.col("s.teacher_gain")).alias("teacher_gain"), r6(F.col("s.warp_gain")).alias("warp_gain"), F.array_join("s.reasons", ",").alias("reasons"))


def _gated(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as samples: labels by number, probabilities by price and size."""
    label = lambda c: F.element_at(F.array(F.lit("accept"), F.lit("review"), F.lit("reject"), F.lit("accept")), (c % 4 + 1).cast("int"))
    gate = lambda c, why: F.struct(label(c).alias("label"), F.when(label(c) == "accept", F.array().cast("array<string>")).otherwise(F.array(F.lit(why))).alias("reasons"))
    p = table(spark, sf, "part")
    return p.select("p_partkey", gate(F.col("p_partkey"), "possible_scene_cut").alias("v"), gate(F.floor(F.col("p_partkey") / 4), "possible_flow_discontinuous").alias("s"), (F.floor(F.col("p_retailprice")) % 100 / 100.0).alias("p_wrong"), (F.col("p_size") / 50.0).alias("p_solvable"))


def decision_gate(spark: SparkSession, sf: str) -> DataFrame:
    d = _gated(spark, sf).withColumn("d", gates.decision_gate(F.col("v"), F.col("s"), F.col("p_wrong"), F.col("p_solvable")))
    return d.select("p_partkey", F.col("d.label").alias("decision"), F.array_join("d.reasons", ",").alias("reasons"), gates.status(F.col("v"), F.col("s"), F.col("d")).alias("status"))


def scope_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Ratios from the digits of part prices; sizes divisible by three lack some."""
    p = table(spark, sf, "part")
    digit = lambda k: F.floor(F.col("p_retailprice") / k) % 10 / 10.0
    has = F.col("p_size") % 3 != 0
    rows = p.select("p_partkey", digit(1).alias("o"), F.when(has, digit(10)).alias("d"), F.when(has, digit(100)).alias("f"), F.when(has | (F.col("p_size") % 2 == 0), digit(1) / 2).alias("c"), digit(10).alias("u"))
    names = {"out_of_bounds_ratio": "o", "flow_discontinuity_ratio": "d", "foreground_large_motion_ratio": "f", "occlusion_ratio": "c", "unexplained_motion_ratio": "u"}
    g = rows.withColumn("g", gates.scope_gate({k: F.col(v) for k, v in names.items()}))
    return g.select("p_partkey", F.col("g.label").alias("label"), F.array_join("g.reasons", ",").alias("reasons"), F.col("g.missing_metric_count").alias("n_missing"))


def _regions(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as regions of their brands."""
    return table(spark, sf, "part").select("p_brand", F.col("p_partkey").alias("region_index"), (F.floor(F.col("p_retailprice")) % 20 / 20.0).alias("p_wrong"), (F.col("p_size") % 10 / 10.0).alias("p_solvable"), F.when(F.col("p_partkey") % 2 == 0, 0.5).otherwise(1.0).alias("priority_weight"))


def primary_region(spark: SparkSession, sf: str) -> DataFrame:
    return diagnosis.primary_region(_regions(spark, sf), ["p_brand"]).select("p_brand", "region_index")


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_brand", "p_partkey", (F.col("p_size") % 7).alias("x0"), (F.col("p_partkey") % 5).cast("int").alias("y0"), (F.col("p_partkey") % 6 + 2).cast("int").alias("w"), (F.col("p_size") % 4 + 2).alias("h"))
    return p.select("p_brand", "p_partkey", "x0", "y0", (F.col("x0") + F.col("w")).alias("x1"), (F.col("y0") + F.col("h")).alias("y1"))


def iou_containment(spark: SparkSession, sf: str) -> DataFrame:
    """Each part's box beside the next part's of its brand."""
    from pyspark.sql import Window

    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    b = _boxes(spark, sf).withColumn("next", F.lead(F.struct("x0", "y0", "x1", "y1")).over(w)).where("next IS NOT NULL")
    b = b.withColumn("o", diagnosis.iou_containment({k: F.col(k) for k in ("x0", "y0", "x1", "y1")}, {k: F.col(f"next.{k}") for k in ("x0", "y0", "x1", "y1")}))
    return b.select("p_partkey", r6(F.col("o.iou")).alias("iou"), r6(F.col("o.containment")).alias("containment"))


def edge_endpoints(spark: SparkSession, sf: str) -> DataFrame:
    return luma_maps(spark, sf).select("vec_id", m.edge_endpoints(F.col("luma"), H, W, 0.57).alias("endpoints"))


def ui_weight(spark: SparkSession, sf: str) -> DataFrame:
    """Part boxes on an 16x16 image as regions that may be overlays."""
    b = _boxes(spark, sf)
    over = m.border_overlap(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), 16, 16, 0.20)
    b = b.withColumn("over", over).withColumn("u", diagnosis.ui_weight(F.col("over"), F.col("p_partkey") % 8 / 100.0, F.col("p_partkey") % 5 / 100.0, F.col("p_partkey") % 9 / 50.0))
    return b.select("p_partkey", r6(F.col("over")).alias("border_overlap"), r6(F.col("u.ui_likelihood")).alias("ui_likelihood"), r6(F.col("u.priority_weight")).alias("priority_weight"))


def region_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as measured regions."""
    p = table(spark, sf, "part")
    pick = lambda c, n: c % n / float(n)
    price = F.floor(F.col("p_retailprice"))
    cols = {"current": pick(price, 10), "missing": pick(F.col("p_size"), 9), "extra": pick(price, 7), "gt_edge": pick(F.col("p_size"), 5), "pred_edge": pick(price, 6), "gt_endpoints": price % 3, "pred_endpoints": F.col("p_size") % 4, "gt_components": price % 2, "pred_components": F.col("p_size") % 2, "width": F.col("p_size") % 8 + 1, "height": price % 8 + 1, "copy_distance": pick(price, 11), "warp0": pick(price, 13), "warp1": pick(F.col("p_size"), 13), "blend": pick(price, 5)}
    rows = p.select("p_partkey", *[v.alias(k) for k, v in cols.items()])
    return rows.select("p_partkey", F.array_join(diagnosis.region_labels({k: F.col(k) for k in cols}), ",").alias("labels"))


_QC = "quantile_cont({0}, {1}::DOUBLE)"
_RS = "least(greatest({0}, 0.0::DOUBLE), 1.0::DOUBLE)"
_PAIR = f"WITH {PX}, g AS (SELECT vec_id // 2 AS pair, x, y, l AS t FROM px WHERE vec_id % 2 = 0), q AS (SELECT vec_id // 2 AS pair, x, y, l AS p FROM px WHERE vec_id % 2 = 1), pr AS (SELECT pair, x, y, t, p FROM g JOIN q USING (pair, x, y))"


def _neighbour(v: str, dy: int, dx: int, key: str) -> str:
    """Edge-repeating neighbour by clamped self-join aliases."""
    return f"n{dy + 1}{dx + 1}.{v}"


def _sobel_sql(source: str, key: str, v: str, name: str) -> str:
    joins = " ".join(f"JOIN {source} n{dy + 1}{dx + 1} ON n{dy + 1}{dx + 1}.{key} = c.{key} AND n{dy + 1}{dx + 1}.y = least(greatest(c.y + {dy}, 0), 7) AND n{dy + 1}{dx + 1}.x = least(greatest(c.x + {dx}, 0), 7)" for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) != (0, 0))
    at = lambda dy, dx: _neighbour(v, dy, dx, key)
    gx = f"({at(-1, 1)} + 2 * {at(0, 1)} + {at(1, 1)}) - ({at(-1, -1)} + 2 * {at(0, -1)} + {at(1, -1)})"
    gy = f"({at(1, -1)} + 2 * {at(1, 0)} + {at(1, 1)}) - ({at(-1, -1)} + 2 * {at(-1, 0)} + {at(-1, 1)})"
    return f"{name} AS (SELECT c.{key}, c.x, c.y, least(sqrt(power({gx}, 2) + power({gy}, 2)) / 4, 1.0::DOUBLE) AS edge FROM {source} c {joins})"


def _robust_sql(rows: str, key: str, v: str, name: str, extra: str = "") -> str:
    """Robust score of the values v per key, by ranks."""
    top = lambda f: f"avg(CASE WHEN rk <= greatest(1, ceil(n * {f}::DOUBLE)) THEN {v} END)"
    return f"{name} AS (SELECT {key}, least(greatest(avg({v}), 0.90::DOUBLE * {top(0.10)}, 0.95::DOUBLE * {top(0.01)}, 0.85::DOUBLE * max({v})), 1.0::DOUBLE) AS score FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {v} DESC) AS rk, count(*) OVER (PARTITION BY {key}) AS n FROM {rows}) GROUP BY {key}{extra})"


_HIST = "least(floor({0} * 64), 63)"


def _hist_sql(a: str, b: str, key: str, name: str) -> str:
    """Histogram distance of two (key, v) relations of 64 pixels each."""
    return f"{name} AS (SELECT {key}, 0.5::DOUBLE * sum(abs(n1 - n2)) / 64 AS h FROM (SELECT {key}, b, sum(n1) AS n1, sum(n2) AS n2 FROM (SELECT {key}, {_HIST.format('v')} AS b, 1 AS n1, 0 AS n2 FROM {a} UNION ALL SELECT {key}, {_HIST.format('v')}, 0, 1 FROM {b}) GROUP BY ALL) GROUP BY {key})"


_TR = f"WITH {PX}, tt AS (SELECT a.vec_id AS first, a.x, a.y, a.l AS a, b.l AS b, c.l AS c FROM px a JOIN px b ON b.vec_id = a.vec_id + 1 AND a.x = b.x AND a.y = b.y JOIN px c ON c.vec_id = a.vec_id + 2 AND a.x = c.x AND a.y = c.y), va AS (SELECT first, a AS v FROM tt), vb AS (SELECT first, b AS v FROM tt), vc AS (SELECT first, c AS v FROM tt), {_hist_sql('va', 'vb', 'first', 'h1')}, {_hist_sql('vb', 'vc', 'first', 'h2')}"
_REP = "greatest(avg(abs({0} - {1})), 0.10::DOUBLE * quantile_cont(abs({0} - {1}), 0.95::DOUBLE), 0.05::DOUBLE * quantile_cont(abs({0} - {1}), 0.99::DOUBLE))"

_VALIDITY = f"""{_TR},
mm AS (SELECT first, avg(abs(a - b)) AS m1, avg(abs(b - c)) AS m2, least({_REP.format('a', 'b')}, {_REP.format('b', 'c')}) AS dup FROM tt GROUP BY first),
k AS (SELECT first, dup, greatest(m1, m2) AS adj, abs(m1 - m2) / (m1 + m2 + 1e-8::DOUBLE) AS asym, greatest(h1.h, h2.h) * (0.5 + 0.5 * abs(m1 - m2) / (m1 + m2 + 1e-8::DOUBLE)) AS cut FROM mm JOIN h1 USING (first) JOIN h2 USING (first)),
f AS (SELECT first, cut, list_filter([CASE WHEN dup <= 0.002 THEN 'duplicate_frame' END, CASE WHEN cut >= 0.62 THEN 'scene_cut' END, CASE WHEN adj >= 0.006 AND asym >= 0.90 THEN 'temporal_discontinuity' END], lambda z: z IS NOT NULL) AS rej,
      list_filter([CASE WHEN dup > 0.002 AND dup <= 0.006 THEN 'possible_duplicate_frame' END, CASE WHEN cut >= 0.45 AND cut < 0.62 THEN 'possible_scene_cut' END, CASE WHEN adj >= 0.006 AND asym >= 0.65 AND asym < 0.90 THEN 'temporal_asymmetry' END], lambda z: z IS NOT NULL) AS rev FROM k)
SELECT first, round(cut, 6) AS scene_cut, CASE WHEN len(rej) > 0 THEN 'reject' WHEN len(rev) > 0 THEN 'review' ELSE 'accept' END AS label,
       coalesce(array_to_string(CASE WHEN len(rej) > 0 THEN rej || rev ELSE rev END, ','), '') AS reasons,
       CASE WHEN len(rej) > 0 THEN false WHEN len(rev) > 0 THEN NULL ELSE true END AS valid FROM f
"""

_FLOW = """
WITH p AS (SELECT vec_id, i, i % 4 AS x, i // 4 AS y, CAST(embedding[i + 1] AS DOUBLE) * 8 AS dx, CAST(embedding[i + 33] AS DOUBLE) * 8 AS dy FROM (SELECT vec_id, embedding, unnest(range(0, 32)) AS i FROM embeddings)),
b AS (SELECT vec_id, median(dx) AS bx, median(dy) AS by_ FROM p WHERE x IN (0, 3) OR y IN (0, 7) GROUP BY vec_id),
r AS (SELECT p.*, bx, by_, sqrt((dx - bx) * (dx - bx) + (dy - by_) * (dy - by_)) / sqrt(80.0::DOUBLE) AS res FROM p JOIN b USING (vec_id)),
s AS (SELECT a.vec_id, count(*) AS n FROM r a JOIN r c ON a.vec_id = c.vec_id AND ((c.x = a.x + 1 AND c.y = a.y) OR (c.y = a.y + 1 AND c.x = a.x)) WHERE sqrt((a.dx - c.dx) * (a.dx - c.dx) + (a.dy - c.dy) * (a.dy - c.dy)) / sqrt(80.0::DOUBLE) > 0.02 GROUP BY a.vec_id)
SELECT r.vec_id, round(avg(CASE WHEN res > 0.08 AND (x + dx < 0 OR x + dx > 3 OR y + dy < 0 OR y + dy > 7) THEN 1.0::DOUBLE ELSE 0 END), 6) AS out_of_bounds_ratio, round(avg(CASE WHEN res > 0.08 THEN 1.0::DOUBLE ELSE 0 END), 6) AS unexplained_motion_ratio,
       round(coalesce(any_value(s.n), 0) / 52.0::DOUBLE, 6) AS flow_discontinuity_ratio, round(sqrt(any_value(bx) * any_value(bx) + any_value(by_) * any_value(by_)) / sqrt(80.0::DOUBLE), 6) AS background_motion
FROM r LEFT JOIN s ON s.vec_id = r.vec_id GROUP BY r.vec_id
"""

_COMPONENTS = f"""
WITH RECURSIVE {PX}, on_ AS (SELECT vec_id, x, y, l, y * 8 + x AS i FROM px WHERE l >= 0.55),
nb AS (SELECT a.vec_id, a.i, b.i AS j FROM on_ a JOIN on_ b ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
reach(vec_id, i, j) AS (SELECT vec_id, i, j FROM nb UNION SELECT r.vec_id, r.i, n.j FROM reach r JOIN nb n ON n.vec_id = r.vec_id AND n.i = r.j),
lab AS (SELECT vec_id, i, min(j) AS root FROM reach GROUP BY ALL),
z AS (SELECT o.*, lab.root FROM on_ o JOIN lab USING (vec_id, i)),
e AS (SELECT a.vec_id, a.root, count(*) AS n FROM z a JOIN z b ON a.vec_id = b.vec_id AND ((b.x = a.x + 1 AND b.y = a.y) OR (b.y = a.y + 1 AND b.x = a.x)) GROUP BY ALL)
SELECT z.vec_id, CAST(min(x) AS INTEGER) AS x0, CAST(min(y) AS INTEGER) AS y0, CAST(max(x) + 1 AS INTEGER) AS x1, CAST(max(y) + 1 AS INTEGER) AS y1, CAST(count(*) AS INTEGER) AS area, CAST(4 * count(*) - 2 * coalesce(any_value(e.n), 0) AS DOUBLE) AS perimeter, round(max(l), 6) AS peak
FROM z LEFT JOIN e ON e.vec_id = z.vec_id AND e.root = z.root GROUP BY z.vec_id, z.root
"""

_GAIN = "greatest(least((current - {0}) / greatest(current, 0.05::DOUBLE), 1.0::DOUBLE), -1.0::DOUBLE)"
_EVIDENCE = "least(greatest(0.8::DOUBLE * least(greatest(0.5 + 0.5 * {0}, 0), 1) + 0.2::DOUBLE * least(greatest(1 - {1} / 0.12::DOUBLE, 0), 1), 0), 1)"
_SOLVE = f"""{_PAIR}, c1 AS (SELECT pair, abs(t - p) AS v FROM pr), c2 AS (SELECT pair, abs(t - (t + p) / 2) AS v FROM pr), {_robust_sql('c1', 'pair', 'v', 's1')}, {_robust_sql('c2', 'pair', 'v', 's2')},
k AS (SELECT pair, s1.score AS current, CASE WHEN pair % 2 = 0 THEN s2.score END AS te, CASE WHEN pair % 3 = 0 THEN s1.score * 0.5 END AS wa FROM s1 JOIN s2 USING (pair)),
gg AS (SELECT *, {_GAIN.format('te')} AS tg, {_GAIN.format('wa')} AS wg FROM (SELECT * FROM k)),
e AS (SELECT pair, current, CASE WHEN te IS NOT NULL THEN tg END AS tg, CASE WHEN wa IS NOT NULL THEN wg END AS wg, CASE WHEN te IS NOT NULL THEN {_EVIDENCE.format('tg', 'te')} END AS ev1, CASE WHEN wa IS NOT NULL THEN {_EVIDENCE.format('wg', 'wa')} END AS ev2 FROM gg),
p0 AS (SELECT *, CASE WHEN ev1 IS NULL AND ev2 IS NULL THEN 0.5::DOUBLE ELSE (coalesce(ev1, 0) * 0.65::DOUBLE + coalesce(ev2, 0) * 0.35::DOUBLE) / (CASE WHEN ev1 IS NULL THEN 0 ELSE 0.65::DOUBLE END + CASE WHEN ev2 IS NULL THEN 0 ELSE 0.35::DOUBLE END) END AS pp FROM e),
p1 AS (SELECT *, CASE WHEN current < 0.05 THEN least(pp, 0.5) ELSE pp END AS ps FROM p0)
SELECT pair, round(ps, 6) AS p_solvable, round(tg, 6) AS teacher_gain, round(wg, 6) AS warp_gain, array_to_string(list_filter([CASE WHEN tg >= 0.25 THEN 'teacher_recovers' END, CASE WHEN wg >= 0.25 THEN 'warp_branch_recovers' END, CASE WHEN ev1 IS NULL AND ev2 IS NULL THEN 'solvability_evidence_missing' END, CASE WHEN current < 0.05 THEN 'wrongness_too_low_for_solvability' END, CASE WHEN ps < 0.55 THEN 'solvability_uncertain' END], lambda z: z IS NOT NULL), ',') AS reasons FROM p1
"""

_LABEL4 = "(['accept', 'review', 'reject', 'accept'])[CAST({0} % 4 AS INTEGER) + 1]"
_DECIDE = f"""
WITH k AS (SELECT p_partkey, {_LABEL4.format('p_partkey')} AS v, {_LABEL4.format('(p_partkey // 4)')} AS s, floor(p_retailprice) % 100 / 100.0::DOUBLE AS w, p_size / 50.0::DOUBLE AS z FROM part),
r AS (SELECT *, list_filter([CASE WHEN v = 'review' THEN 'possible_scene_cut' END, CASE WHEN v = 'review' THEN 'validity_review' END, CASE WHEN s = 'review' THEN 'possible_flow_discontinuous' END, CASE WHEN s = 'review' THEN 'scope_review' END, CASE WHEN w < 0.45 THEN 'wrongness_gray_zone' END, CASE WHEN z < 0.30 THEN 'solvability_low' WHEN z < 0.55 THEN 'solvability_gray_zone' END], lambda q: q IS NOT NULL) AS rev FROM k),
d AS (SELECT p_partkey, v, s, CASE WHEN v = 'reject' OR s = 'reject' OR w < 0.20 THEN 'reject' WHEN len(rev) > 0 THEN 'review' ELSE 'accept' END AS decision, CASE WHEN v = 'reject' THEN 'possible_scene_cut,invalid_data' WHEN s = 'reject' THEN 'possible_flow_discontinuous,out_of_scope' WHEN w < 0.20 THEN 'prediction_not_wrong' ELSE coalesce(array_to_string(rev, ','), '') END AS reasons FROM r)
SELECT p_partkey, decision, reasons, CASE WHEN v = 'reject' THEN 'invalid' WHEN s = 'reject' THEN 'out_of_scope' ELSE decision END AS status FROM d
"""

_BANDS = (("o", 0.45, 0.72, "flow_out_of_bounds"), ("d", 0.30, 0.60, "flow_discontinuous"), ("f", 0.35, 0.65, "foreground_motion_extreme"), ("c", 0.40, 0.70, "occlusion_extreme"), ("u", 0.35, 0.70, "unexplained_motion"))
_SCOPE = f"""
WITH k AS (SELECT p_partkey, floor(p_retailprice) % 10 / 10.0::DOUBLE AS o, CASE WHEN p_size % 3 <> 0 THEN floor(p_retailprice / 10) % 10 / 10.0::DOUBLE END AS d, CASE WHEN p_size % 3 <> 0 THEN floor(p_retailprice / 100) % 10 / 10.0::DOUBLE END AS f, CASE WHEN p_size % 3 <> 0 OR p_size % 2 = 0 THEN floor(p_retailprice) % 10 / 10.0::DOUBLE / 2 END AS c, floor(p_retailprice / 10) % 10 / 10.0::DOUBLE AS u FROM part),
r AS (SELECT *, list_filter([{', '.join(f"CASE WHEN {c} >= {hi}::DOUBLE THEN '{n}' END" for c, _, hi, n in _BANDS)}], lambda q: q IS NOT NULL) AS rej, list_filter([{', '.join(f"CASE WHEN {c} >= {lo}::DOUBLE AND {c} < {hi}::DOUBLE THEN 'possible_{n}' END" for c, lo, hi, n in _BANDS)}, CASE WHEN f IS NULL AND c IS NULL THEN 'scope_semantics_missing' END], lambda q: q IS NOT NULL) AS rev, CASE WHEN d IS NULL THEN 1 ELSE 0 END AS nm FROM k)
SELECT p_partkey, CASE WHEN len(rej) > 0 THEN 'reject' WHEN len(rev) > 0 OR nm > 0 THEN 'review' ELSE 'accept' END AS label, coalesce(array_to_string(CASE WHEN len(rej) > 0 THEN rej || rev WHEN nm > 0 THEN rev || ['scope_metrics_missing'] ELSE rev END, ','), '') AS reasons, CAST(nm AS INTEGER) AS n_missing FROM r
"""

_REGION_LABELS = """
WITH k AS (SELECT p_partkey, pr % 10 / 10.0::DOUBLE AS cur, p_size % 9 / 9.0::DOUBLE AS mi, pr % 7 / 7.0::DOUBLE AS ex, p_size % 5 / 5.0::DOUBLE AS ge, pr % 6 / 6.0::DOUBLE AS pe, pr % 3 AS gn, p_size % 4 AS pn, pr % 2 AS gc, p_size % 2 AS pc, p_size % 8 + 1 AS w, pr % 8 + 1 AS h, pr % 11 / 11.0::DOUBLE AS cd, pr % 13 / 13.0::DOUBLE AS w0, p_size % 13 / 13.0::DOUBLE AS w1, pr % 5 / 5.0::DOUBLE AS bl FROM (SELECT p_partkey, p_size, CAST(floor(p_retailprice) AS BIGINT) AS pr FROM part))
SELECT p_partkey, coalesce(array_to_string(list_filter([
  CASE WHEN mi >= 0.12 AND mi >= ex * 1.25::DOUBLE + 0.01::DOUBLE THEN 'missing_part' END,
  CASE WHEN mi >= 0.12 AND (pn > gn OR pc > gc OR greatest(w, h) / least(w, h) >= 1.75) THEN 'broken_structure' END,
  CASE WHEN mi >= 0.12 AND ex >= 0.12 AND mi / greatest(ex, 1e-6) BETWEEN 0.35 AND 2.85 THEN 'ghosting' END,
  CASE WHEN greatest(mi, ex) >= 0.12 THEN 'edge_tearing' END,
  CASE WHEN mi >= 0.12 AND ge - pe >= 0.08 THEN 'blur' END,
  CASE WHEN cur >= 0.05 AND cd <= greatest(0.03::DOUBLE, cur * (1 - 0.65::DOUBLE)) THEN 'endpoint_copy' END,
  CASE WHEN least(w0, w1) + 0.08::DOUBLE < bl THEN 'blend_mask_error' END], lambda q: q IS NOT NULL), ','), '') AS labels FROM k
"""

_BOX = "WITH k AS (SELECT p_brand, p_partkey, p_size % 7 AS x0, p_partkey % 5 AS y0, p_size % 7 + p_partkey % 6 + 2 AS x1, p_partkey % 5 + p_size % 4 + 2 AS y1 FROM part), n AS (SELECT *, lead(x0) OVER w AS a0, lead(y0) OVER w AS b0, lead(x1) OVER w AS a1, lead(y1) OVER w AS b1 FROM k WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)), i AS (SELECT *, greatest(least(x1, a1) - greatest(x0, a0), 0) * greatest(least(y1, b1) - greatest(y0, b0), 0) AS both_, (x1 - x0) * (y1 - y0) AS s1, (a1 - a0) * (b1 - b0) AS s2 FROM n WHERE a0 IS NOT NULL) SELECT p_partkey, round(both_ / CAST(s1 + s2 - both_ AS DOUBLE), 6) AS iou, round(CASE WHEN both_ > 0 THEN both_ / CAST(least(s1, s2) AS DOUBLE) ELSE 0 END, 6) AS containment FROM i"

_ENDS = f"WITH {PX}, o AS (SELECT vec_id, x, y FROM px WHERE l >= 0.57), n AS (SELECT a.vec_id, a.x, a.y, count(b.x) AS k FROM o a LEFT JOIN o b ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) GROUP BY ALL), c AS (SELECT vec_id, count(*) FILTER (k <= 1) AS e FROM n GROUP BY vec_id) SELECT e.vec_id, CAST(coalesce(c.e, 0) AS INTEGER) AS endpoints FROM embeddings e LEFT JOIN c ON c.vec_id = e.vec_id"
_UI = """
WITH k AS (SELECT p_partkey, p_size % 7 AS x0, p_partkey % 5 AS y0, p_size % 7 + p_partkey % 6 + 2 AS x1, p_partkey % 5 + p_size % 4 + 2 AS y1 FROM part),
o AS (SELECT p_partkey, least(greatest(1 - greatest(least(x1, 12) - greatest(x0, 4), 0) * greatest(least(y1, 12) - greatest(y0, 4), 0) / CAST((x1 - x0) * (y1 - y0) AS DOUBLE), 0), 1) AS ov FROM k),
u AS (SELECT p_partkey, ov, least(greatest((ov - 0.5::DOUBLE) / 0.5::DOUBLE, 0), 1) * least(greatest(1 - (0.6::DOUBLE * (p_partkey % 8 / 100.0::DOUBLE) + 0.4::DOUBLE * (p_partkey % 5 / 100.0::DOUBLE)) / 0.08::DOUBLE, 0), 1) * least(greatest(p_partkey % 9 / 50.0::DOUBLE / 0.12::DOUBLE, 0), 1) AS ui FROM o)
SELECT p_partkey, round(ov, 6) AS border_overlap, round(ui, 6) AS ui_likelihood, round(1 - ui * 0.65::DOUBLE, 6) AS priority_weight FROM u
"""

_NMS = """
WITH RECURSIVE k AS (SELECT p_brand, p_partkey, p_size % 7 AS x0, p_partkey % 5 AS y0, p_size % 7 + p_partkey % 6 + 2 AS x1, p_partkey % 5 + p_size % 4 + 2 AS y1, p_partkey % 4 = 0 AS native, CAST(floor(p_retailprice) AS BIGINT) % 64 / 64.0::DOUBLE AS score, CASE WHEN p_partkey % 2 = 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY native DESC, score * weight DESC, weight DESC, score DESC, y0, x0, y1, x1, p_partkey) AS rk FROM k),
g(p_brand, rk, chosen) AS (
  SELECT p_brand, 0::BIGINT, []::STRUCT(p_partkey BIGINT, x0 BIGINT, y0 BIGINT, x1 BIGINT, y1 BIGINT)[] FROM k GROUP BY p_brand
  UNION ALL
  SELECT g.p_brand, r.rk, CASE WHEN len(chosen) < 8 AND len(list_filter(chosen, lambda c:
      greatest(least(c.x1, r.x1) - greatest(c.x0, r.x0), 0) * greatest(least(c.y1, r.y1) - greatest(c.y0, r.y0), 0) >= 0.5::DOUBLE * ((c.x1 - c.x0) * (c.y1 - c.y0) + (r.x1 - r.x0) * (r.y1 - r.y0) - greatest(least(c.x1, r.x1) - greatest(c.x0, r.x0), 0) * greatest(least(c.y1, r.y1) - greatest(c.y0, r.y0), 0))
      OR greatest(least(c.x1, r.x1) - greatest(c.x0, r.x0), 0) * greatest(least(c.y1, r.y1) - greatest(c.y0, r.y0), 0) / CAST(least((c.x1 - c.x0) * (c.y1 - c.y0), (r.x1 - r.x0) * (r.y1 - r.y0)) AS DOUBLE) >= 0.85::DOUBLE)) = 0
    THEN list_append(chosen, {'p_partkey': r.p_partkey::BIGINT, 'x0': r.x0::BIGINT, 'y0': r.y0::BIGINT, 'x1': r.x1::BIGINT, 'y1': r.y1::BIGINT}) ELSE chosen END
  FROM g JOIN r ON r.p_brand = g.p_brand AND r.rk = g.rk + 1 WHERE len(g.chosen) < 8
),
l AS (SELECT p_brand, arg_max(chosen, rk) AS chosen FROM g GROUP BY p_brand)
SELECT p_brand, c.p_partkey AS p_partkey, CAST(i AS INTEGER) AS place FROM (SELECT p_brand, unnest(chosen) AS c, generate_subscripts(chosen, 1) AS i FROM l)
"""

QUERIES = {
    "luma_stats": (luma_stats, f"WITH {PX} SELECT vec_id, round(avg(l), 6) AS mean, round(max(l), 6) AS max, round(quantile_cont(l, 0.95::DOUBLE), 6) AS q95, round(quantile_cont(l, 0.99::DOUBLE), 6) AS q99, round(quantile_cont(l, 0.999::DOUBLE), 6) AS q999 FROM px GROUP BY vec_id"),
    "map_quantiles": (map_quantiles, f"WITH {PX} SELECT vec_id, " + ", ".join(f"round(quantile_cont(l, {q}::DOUBLE), 6) AS q{round(q * 100)}" for q in (0.5, 0.75, 0.9, 0.96)) + " FROM px GROUP BY vec_id"),
    "top_area_mean": (top_area_mean, f"WITH {PX}, k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY l DESC) AS rk FROM px) SELECT vec_id, " + ", ".join(f"round(avg(CASE WHEN rk <= greatest(1, ceil(64 * {f}::DOUBLE)) THEN l END), 6) AS top{i}" for i, f in enumerate(FRACTIONS)) + " FROM k GROUP BY vec_id"),
    "robust_local_score": (robust_local_score, f"WITH {PX}, {_robust_sql('px', 'vec_id', 'l', 's')} SELECT vec_id, round(score, 6) AS score FROM s"),
    "sobel": (sobel, f"WITH {PX}, {_sobel_sql('px', 'vec_id', 'l', 's')} SELECT vec_id, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, round(edge, 6) AS edge FROM s"),
    "error_maps": (error_maps, f"{_PAIR}, {_sobel_sql('pr', 'pair', 't', 'st')}, {_sobel_sql('pr', 'pair', 'p', 'sp')}, k AS (SELECT pr.pair, abs(p - t) AS luminance, greatest(st.edge - sp.edge, 0) AS gt_only_edge, greatest(sp.edge - st.edge, 0) AS pred_only_edge FROM pr JOIN st USING (pair, x, y) JOIN sp USING (pair, x, y)), z AS (SELECT *, greatest(luminance, least(greatest(gt_only_edge, pred_only_edge) * 1.25::DOUBLE, 1)) AS structure FROM k) SELECT pair, " + ", ".join(f"round({f}({n}), 6) AS {n}_{k}" for n in ("luminance", "gt_only_edge", "pred_only_edge", "structure") for k, f in (("mean", "avg"), ("max", "max"))) + " FROM z GROUP BY pair"),
    "histogram_distance": (histogram_distance, f"{_PAIR}, v1 AS (SELECT pair, t AS v FROM pr), v2 AS (SELECT pair, p AS v FROM pr), {_hist_sql('v1', 'v2', 'pair', 'h')} SELECT pair, round(h, 6) AS distance FROM h"),
    "repeat_distance": (repeat_distance, f"{_PAIR} SELECT pair, round({_REP.format('t', 'p')}, 6) AS distance FROM pr GROUP BY pair"),
    "validity_gate": (validity_gate, _VALIDITY),
    "flow_metrics": (flow_metrics, _FLOW),
    "window_means": (window_means, f"WITH {PX}, s AS (SELECT unnest([0, 2, 4]) AS s) SELECT px.vec_id, CAST(a.s AS INTEGER) AS y, CAST(b.s AS INTEGER) AS x, round(avg(l), 6) AS mean FROM px, s a, s b WHERE px.y >= a.s AND px.y < a.s + 4 AND px.x >= b.s AND px.x < b.s + 4 GROUP BY ALL"),
    "native_mask_components": (native_mask_components, _COMPONENTS),
    "nms_regions": (nms_regions, _NMS),
    "score_samples": (score_samples, None),
    "solvability": (solvability, _SOLVE),
    "decision_gate": (decision_gate, _DECIDE),
    "scope_gate": (scope_gate, _SCOPE),
    "primary_region": (primary_region, "WITH k AS (SELECT p_brand, p_partkey, floor(p_retailprice) % 20 / 20.0::DOUBLE AS w, p_size % 10 / 10.0::DOUBLE AS s, CASE WHEN p_partkey % 2 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS q FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY w * s * q DESC, w * q DESC, w DESC, p_partkey) AS k FROM k) SELECT p_brand, p_partkey AS region_index FROM r WHERE k = 1"),
    "iou_containment": (iou_containment, _BOX),
    "region_labels": (region_labels, _REGION_LABELS),
    "edge_endpoints": (edge_endpoints, _ENDS),
    "ui_weight": (ui_weight, _UI),
}
