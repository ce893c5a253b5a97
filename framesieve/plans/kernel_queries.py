"""Queries over the mining plan's NumPy kernels, with their DuckDB forms.

Maps are 8x8 luma in steps of 1/64 and motion is in quarter pixels, so that single precision holds every result exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import kernels, scoring
from .encodings import PX, luma_maps, table
from .map_queries import _TR, _flow, _triples, r6, square

STEPS = 64


def _maps(spark: SparkSession, sf: str) -> DataFrame:
    return luma_maps(spark, sf).select("vec_id", F.transform("luma", lambda v: F.floor(v * STEPS) / STEPS).alias("luma"))


def _quarters(m: np.ndarray) -> np.ndarray:
    """A motion field from a map: its values, and those of its transpose, as -8 to 8 quarter pixels."""
    q = np.floor(m * 16) - 8
    return np.stack([q, q.T], axis=-1) / 4


def _cells(image: np.ndarray, key: int) -> list[dict]:
    return [{"vec_id": key, "y": y, "x": x, "value": float(image[y, x])} for y in range(image.shape[0]) for x in range(image.shape[1])]


CELLS = "vec_id long, y int, x int, value double"


def mask_resize(spark: SparkSession, sf: str) -> DataFrame:
    """Maps at twice their size."""
    return scoring.mapped(_maps(spark, sf), CELLS, lambda r: _cells(kernels.resize(square(r.luma).astype(np.float32), 16, 16), r.vec_id))


def flow_resize(spark: SparkSession, sf: str) -> DataFrame:
    """Horizontal motion at half size, in pixels of the smaller image."""
    return scoring.mapped(_maps(spark, sf), CELLS, lambda r: _cells(kernels.resize_flow(_quarters(square(r.luma)).astype(np.float32), 4, 4, (8, 8))[..., 0], r.vec_id))


def backward_warp(spark: SparkSession, sf: str) -> DataFrame:
    """Maps drawn along the motion made from themselves, with the border beyond the image."""

    def work(r) -> list[dict]:
        m = square(r.luma)
        return _cells(kernels.backward_warp(m[..., None], _quarters(m))[..., 0], r.vec_id)

    return scoring.mapped(_maps(spark, sf), CELLS, work)


def midpoint_reconstruction(spark: SparkSession, sf: str) -> DataFrame:
    """Blend and prediction of maps n and n + 2 by motion and masks made from n + 1."""
    steps = lambda c: F.transform(c, lambda v: F.floor(v * STEPS) / STEPS).alias(c)

    def work(r) -> list[dict]:
        a, b, c = (square(m).astype(np.float32) for m in (r.a, r.b, r.c))
        outputs = {"flow_t0": _quarters(b).astype(np.float32), "flow_t1": -_quarters(b).astype(np.float32), "mask0": b, "mask1": (b > 0.5).astype(np.float32) / 4}
        made = kernels.reconstruct(a[..., None], c[..., None], outputs, (8, 8))
        return [{"first": r.first, "y": y, "x": x, "blend": float(made["warp_blend"][y, x, 0]), "prediction": float(made["prediction"][y, x, 0])} for y in range(8) for x in range(8)]

    return scoring.mapped(_triples(spark, sf).select("first", *[steps(c) for c in "abc"]), "first long, y int, x int, blend double, prediction double", work)


def overlay_score(spark: SparkSession, sf: str) -> DataFrame:
    """How much each map, less its least value, holds a dense band along a side."""

    def work(r) -> dict:
        m = square(r.luma)
        return {"vec_id": r.vec_id, "score": kernels.overlay_score(m - m.min())}

    return scoring.mapped(luma_maps(spark, sf), "vec_id long, score double", work).select("vec_id", r6(F.col("score")).alias("score"))


def menu_score(spark: SparkSession, sf: str) -> DataFrame:
    """The transition score of the changes between three maps."""

    def work(r) -> dict:
        a, b, c = square(r.a), square(r.b), square(r.c)
        return {"first": r.first, "score": kernels.menu_score(np.abs(a - b), np.abs(b - c))}

    return scoring.mapped(_triples(spark, sf), "first long, score double", work).select("first", r6(F.col("score")).alias("score"))


def scope_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Scope ratios of the 8x4 fields of embeddings 2n and 2n + 1."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    half = lambda odd, name: e.where(F.col("vec_id") % 2 == odd).select(F.floor(F.col("vec_id") / 2).alias("pair"), F.col("embedding").alias(name))
    names = ("out_of_bounds_ratio", "flow_discontinuity_ratio", "foreground_large_motion_ratio", "occlusion_ratio", "unexplained_motion_ratio", "background_motion")

    def work(r) -> dict:
        return {"pair": r.pair, **{k: v for k, v in kernels.scope_metrics(_flow(r.e0), _flow(r.e1)).items() if k in names}}

    got = scoring.mapped(half(0, "e0").join(half(1, "e1"), "pair"), "pair long, " + ", ".join(f"{n} double" for n in names), work)
    return got.select("pair", *[r6(F.col(n)).alias(n) for n in names])


def island_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Islands of each map at 0.55, counted by both component labellers."""

    def work(r) -> dict:
        m = square(r.luma)
        return {"vec_id": r.vec_id, "islands": kernels.island_count(m, 0.55), "filled": len(kernels.filled_components(m >= 0.55, m))}

    return scoring.mapped(luma_maps(spark, sf), "vec_id long, islands int, filled int", work)


def colour_error(spark: SparkSession, sf: str) -> DataFrame:
    """The ramp's three channels of every pixel, in steps."""

    def work(r) -> list[dict]:
        c = kernels.colour_error(square(r.luma))
        return [{"vec_id": r.vec_id, "y": y, "x": x, **{n: float(c[y, x, i]) for i, n in enumerate(("r", "g", "b"))}} for y in range(8) for x in range(8)]

    return scoring.mapped(_maps(spark, sf), "vec_id long, y int, x int, r double, g double, b double", work)


_Q = f"WITH {PX}, m AS (SELECT vec_id, x, y, floor(l * {STEPS}) / {STEPS}.0::DOUBLE AS v FROM px)"
_LERP = "lerp{n} AS (SELECT i, least(CAST(floor(pos) AS BIGINT), 7) AS lo, least(least(CAST(floor(pos) AS BIGINT), 7) + 1, 7) AS hi, pos - least(floor(pos), 7) AS f FROM (SELECT i, greatest((i + 0.5) * 8 / {n}.0 - 0.5, 0)::DOUBLE AS pos FROM (SELECT unnest(range({n})) AS i)))"


def _resized(n: int, source: str, value: str) -> str:
    """SELECT of a resized relation (vec_id, x, y, v) of 8x8 cells."""
    corner = lambda yy, xx: f"{yy}{xx}.v"
    joins = " ".join(f"JOIN {source} {a}{b} ON {a}{b}.vec_id = i.vec_id AND {a}{b}.y = ly.{a} AND {a}{b}.x = lx.{b}" for a in ("lo", "hi") for b in ("lo", "hi"))
    mixed = f"(1 - lx.f) * ((1 - ly.f) * {corner('lo', 'lo')} + ly.f * {corner('hi', 'lo')}) + lx.f * ((1 - ly.f) * {corner('lo', 'hi')} + ly.f * {corner('hi', 'hi')})"
    return f"SELECT i.vec_id, CAST(ly.i AS INTEGER) AS y, CAST(lx.i AS INTEGER) AS x, {value.format(mixed)} AS value FROM (SELECT DISTINCT vec_id FROM {source}) i, lerp{n} ly, lerp{n} lx {joins}"


#: Quarter-pixel motion of map ``v``: x from the cell itself, y from its mirror.
_FLOW = "fl AS (SELECT a.{k}, a.x, a.y, (floor(a.{v} * 16) - 8) / 4.0::DOUBLE AS dx, (floor(b.{v} * 16) - 8) / 4.0::DOUBLE AS dy FROM {t} a JOIN {t} b ON a.{k} = b.{k} AND a.x = b.y AND a.y = b.x)"


def _warped(name: str, source: str, key: str, value: str, sign: int) -> str:
    """A relation (key, x, y, w) of ``source`` sampled along the motion, border beyond the image."""
    at = f"at_{name} AS (SELECT {key}, x, y, least(greatest(x + {sign} * dx, 0), 7) AS ax, least(greatest(y + {sign} * dy, 0), 7) AS ay FROM fl)"
    return f"{at}, {name} AS (SELECT p.{key}, p.x, p.y, sum((1 - abs(p.ax - s.x)) * (1 - abs(p.ay - s.y)) * s.{value}) AS w FROM at_{name} p JOIN {source} s ON s.{key} = p.{key} AND abs(p.ax - s.x) < 1 AND abs(p.ay - s.y) < 1 GROUP BY ALL)"


_MIDPOINT = f"""{_TR}, st AS (SELECT first, x, y, floor(a * {STEPS}) / {STEPS}.0::DOUBLE AS a, floor(b * {STEPS}) / {STEPS}.0::DOUBLE AS b, floor(c * {STEPS}) / {STEPS}.0::DOUBLE AS c FROM tt),
{_FLOW.format(k='first', v='b', t='st')}, {_warped('w0', 'st', 'first', 'a', 1)}, {_warped('w1', 'st', 'first', 'c', -1)},
bl AS (SELECT st.first, st.x, st.y, st.b * w0.w + (1 - st.b) * w1.w AS blend, c, CASE WHEN b > 0.5 THEN 0.25::DOUBLE ELSE 0 END AS m1 FROM st JOIN w0 USING (first, x, y) JOIN w1 USING (first, x, y))
SELECT first, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, blend, m1 * c + (1 - m1) * blend AS prediction FROM bl
"""


def _overlays(source: str, key: str, value: str, name: str) -> str:
    """(key, score): the overlay score of relation (key, x, y, value)."""
    clip = lambda e: f"least(greatest({e}, 0.0::DOUBLE), 1.0::DOUBLE)"
    return f"""{name}_t AS (SELECT {key}, greatest(0.08::DOUBLE, 0.5::DOUBLE * quantile_cont({value}, 0.75::DOUBLE)) AS t FROM {source} GROUP BY {key}),
{name}_o AS (SELECT s.{key}, side, CASE side WHEN 0 THEN y WHEN 1 THEN 7 - x WHEN 2 THEN 7 - y ELSE x END AS r, {value} AS v, CASE WHEN {value} >= t THEN 1 ELSE 0 END AS o FROM {source} s JOIN {name}_t USING ({key}), (SELECT unnest([0, 1, 2, 3]) AS side)),
{name}_l AS (SELECT {key}, side, r, sum(o) AS n, sum(o * v) AS s FROM {name}_o GROUP BY ALL),
{name}_c AS (SELECT {key}, side, r + 1 AS size, sum(n) OVER w AS n, sum(s) OVER w AS s, first_value(n) OVER w AS top FROM {name}_l WINDOW w AS (PARTITION BY {key}, side ORDER BY r)),
{name} AS (SELECT {key}, max(CASE WHEN top / 8.0::DOUBLE >= 0.35 AND n > 0 AND n / (size * 8.0::DOUBLE) >= 0.45 THEN 0.4::DOUBLE * {clip('(n / (size * 8.0::DOUBLE) - 0.45::DOUBLE) / 0.55::DOUBLE')} + 0.4::DOUBLE * {clip('n / 64.0::DOUBLE / 0.40::DOUBLE')} + 0.2::DOUBLE * {clip('(s / greatest(n, 1) - 0.08::DOUBLE) / 0.32::DOUBLE')} ELSE 0 END) AS score FROM {name}_c GROUP BY {key})"""


_MENU = f"""{_TR}, da AS (SELECT first, x, y, abs(a - b) AS v FROM tt), db AS (SELECT first, x, y, abs(b - c) AS v FROM tt),
{_overlays('da', 'first', 'v', 'oa')}, {_overlays('db', 'first', 'v', 'ob')},
e AS (SELECT first, avg(abs(a - b)) AS e0, avg(abs(b - c)) AS e1 FROM tt GROUP BY first)
SELECT first, round(CASE WHEN greatest(oa.score, ob.score) <= 0 THEN 0 ELSE least(greatest(oa.score, ob.score) * (0.6::DOUBLE * abs(oa.score - ob.score) / greatest(oa.score, ob.score) + 0.4::DOUBLE * abs(e0 - e1) / (e0 + e1 + 1e-8::DOUBLE)), 1) END, 6) AS score FROM e JOIN oa USING (first) JOIN ob USING (first)
"""

_SCOPE = """
WITH p AS (SELECT vec_id, i % 4 AS x, i // 4 AS y, CAST(embedding[i + 1] AS DOUBLE) * 8 AS dx, CAST(embedding[i + 33] AS DOUBLE) * 8 AS dy FROM (SELECT vec_id, embedding, unnest(range(0, 32)) AS i FROM embeddings)),
b AS (SELECT vec_id, median(dx) AS bx, median(dy) AS by_ FROM p WHERE x IN (0, 3) OR y IN (0, 7) GROUP BY vec_id),
r AS (SELECT p.*, bx, by_, sqrt((dx - bx) * (dx - bx) + (dy - by_) * (dy - by_)) / sqrt(80.0::DOUBLE) > 0.08 AS big, (x + dx < 0 OR x + dx > 3 OR y + dy < 0 OR y + dy > 7) AS far FROM p JOIN b USING (vec_id)),
s AS (SELECT a.vec_id, count(*) AS n FROM r a JOIN r c ON a.vec_id = c.vec_id AND ((c.x = a.x + 1 AND c.y = a.y) OR (c.y = a.y + 1 AND c.x = a.x)) WHERE sqrt((a.dx - c.dx) * (a.dx - c.dx) + (a.dy - c.dy) * (a.dy - c.dy)) / sqrt(80.0::DOUBLE) > 0.02 GROUP BY a.vec_id),
v AS (SELECT r.vec_id, avg(CASE WHEN big AND far THEN 1.0::DOUBLE ELSE 0 END) AS oob, coalesce(any_value(s.n), 0) / 52.0::DOUBLE AS dis, sqrt(any_value(bx) * any_value(bx) + any_value(by_) * any_value(by_)) / sqrt(80.0::DOUBLE) AS bg FROM r LEFT JOIN s ON s.vec_id = r.vec_id GROUP BY r.vec_id),
j AS (SELECT f.vec_id // 2 AS pair, f.big OR g.big AS big, (sqrt((f.dx + g.dx) * (f.dx + g.dx) + (f.dy + g.dy) * (f.dy + g.dy)) / sqrt(80.0::DOUBLE) > 0.08) OR (f.big AND f.far) OR (g.big AND g.far) AS hid FROM r f JOIN r g ON g.vec_id = f.vec_id + 1 AND f.x = g.x AND f.y = g.y WHERE f.vec_id % 2 = 0),
k AS (SELECT pair, avg(CASE WHEN big THEN 1.0::DOUBLE ELSE 0 END) AS large, avg(CASE WHEN hid THEN 1.0::DOUBLE ELSE 0 END) AS hid FROM j GROUP BY pair)
SELECT k.pair, round(greatest(a.oob, c.oob), 6) AS out_of_bounds_ratio, round(greatest(a.dis, c.dis), 6) AS flow_discontinuity_ratio, round(large, 6) AS foreground_large_motion_ratio, round(hid, 6) AS occlusion_ratio, round(large, 6) AS unexplained_motion_ratio, round(greatest(a.bg, c.bg), 6) AS background_motion
FROM k JOIN v a ON a.vec_id = 2 * pair JOIN v c ON c.vec_id = 2 * pair + 1
"""

_ISLANDS = f"""
WITH RECURSIVE {PX}, o AS (SELECT vec_id, x, y, y * 8 + x AS i FROM px WHERE l >= 0.55), nb AS (SELECT a.vec_id, a.i, b.i AS j FROM o a JOIN o b ON a.vec_id = b.vec_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
reach(vec_id, i, j) AS (SELECT vec_id, i, j FROM nb UNION SELECT r.vec_id, r.i, n.j FROM reach r JOIN nb n ON n.vec_id = r.vec_id AND n.i = r.j), lab AS (SELECT vec_id, i, min(j) AS root FROM reach GROUP BY ALL), c AS (SELECT vec_id, count(DISTINCT root) AS n FROM lab GROUP BY vec_id)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS INTEGER) AS islands, CAST(coalesce(c.n, 0) AS INTEGER) AS filled FROM embeddings e LEFT JOIN c ON c.vec_id = e.vec_id
"""

QUERIES = {
    "mask_resize": (mask_resize, f"{_Q}, {_LERP.format(n=16)} {_resized(16, 'm', '{}')}"),
    "flow_resize": (flow_resize, f"{_Q}, {_FLOW.format(k='vec_id', v='v', t='m')}, u AS (SELECT vec_id, x, y, dx AS v FROM fl), {_LERP.format(n=4)} {_resized(4, 'u', '({}) * 0.5::DOUBLE')}"),
    "backward_warp": (backward_warp, f"{_Q}, {_FLOW.format(k='vec_id', v='v', t='m')}, {_warped('w0', 'm', 'vec_id', 'v', 1)} SELECT vec_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, w AS value FROM w0"),
    "midpoint_reconstruction": (midpoint_reconstruction, _MIDPOINT),
    "overlay_score": (overlay_score, f"WITH {PX}, z AS (SELECT vec_id, x, y, l - min(l) OVER (PARTITION BY vec_id) AS v FROM px), {_overlays('z', 'vec_id', 'v', 'o')} SELECT vec_id, round(score, 6) AS score FROM o"),
    "menu_score": (menu_score, _MENU),
    "scope_metrics": (scope_metrics, _SCOPE),
    "island_counts": (island_counts, _ISLANDS),
    "colour_error": (colour_error, f"{_Q} SELECT vec_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, least(v * 3, 1) AS r, least(greatest(v * 3 - 1, 0), 1) AS g, least(greatest(v * 3 - 2, 0), 1) AS b FROM m"),
}
