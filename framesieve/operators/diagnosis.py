"""Solvability, reason labels and the choice of the primary region, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.maps import clip

#: The labels in their order.
LABELS = ("missing_part", "broken_structure", "ghosting", "edge_tearing", "flicker", "blur", "endpoint_copy", "blend_mask_error")
#: Thresholds of the diagnosis.
GOOD, LEAST_WRONG, TEACHER_WEIGHT, WARP_WEIGHT = 0.12, 0.05, 0.65, 0.35
MISSING_RATIO, BRANCH_GAIN, COPY_RATIO, FLICKER = 1.25, 0.08, 0.65, 0.18


def gain(current: Column, other: Column) -> Column:
    """Relative improvement of another branch's error, within -1 and 1."""
    return clip((current - other) / F.greatest(current, F.lit(LEAST_WRONG)), -1.0, 1.0)


def evidence(current: Column, other: Column) -> Column:
    """How much a branch speaks for recoverability: four fifths relative, one fifth absolute."""
    return clip(0.8 * clip(0.5 + 0.5 * gain(current, other)) + 0.2 * clip(1.0 - other / GOOD))


def solvability(current: Column, teacher: Column | None = None, warps: tuple[Column, ...] = ()) -> Column:
    """struct<p_solvable, best_warp_error, teacher_gain, warp_gain, reasons> from local errors; null errors are absent."""
    none = F.lit(None).cast("double")
    teacher = none if teacher is None else teacher
    best = F.least(*warps) if len(warps) > 1 else (warps[0] if warps else none)
    weighed = [(F.when(e.isNotNull(), evidence(current, e)), F.when(e.isNotNull(), F.lit(w)).otherwise(0.0)) for e, w in ((teacher, TEACHER_WEIGHT), (best, WARP_WEIGHT))]
    total = weighed[0][1] + weighed[1][1]
    sums = F.coalesce(weighed[0][0], F.lit(0.0)) * weighed[0][1] + F.coalesce(weighed[1][0], F.lit(0.0)) * weighed[1][1]
    p = F.when(total > 0, sums / F.when(total > 0, total)).otherwise(0.5)
    low = current < LEAST_WRONG
    p = F.when(low, F.least(p, F.lit(0.5))).otherwise(p)
    gains = [F.when(e.isNotNull(), gain(current, e)) for e in (teacher, best)]
    reasons = F.array_compact(F.array(
        F.when(gains[0] >= 0.25, "teacher_recovers"), F.when(gains[1] >= 0.25, "warp_branch_recovers"), F.when(total == 0, "solvability_evidence_missing"),
        F.when(low, "wrongness_too_low_for_solvability"), F.when(p < 0.55, "solvability_uncertain"),
    ))
    return F.struct(clip(p).alias("p_solvable"), best.alias("best_warp_error"), gains[0].alias("teacher_gain"), gains[1].alias("warp_gain"), reasons.alias("reasons"))


def in_label_order(reasons: Column) -> Column:
    return F.filter(F.array(*[F.lit(x) for x in LABELS]), lambda x: F.array_contains(reasons, x))


def region_labels(m: dict[str, Column], edge: float = 0.12) -> Column:
    """Reason labels of a region from its measured errors, in the fixed order.

    ``m``: current, missing, extra, gt_edge, pred_edge, gt_endpoints, pred_endpoints, gt_components, pred_components,
    width, height, and where known temporal, copy_distance, warp0, warp1, blend.
    """
    get = lambda name: m.get(name, F.lit(None).cast("double"))
    missing, extra, current = m["missing"], m["extra"], m["current"]
    gone = missing >= edge
    long_side, short_side = F.greatest(m["width"], m["height"]), F.least(m["width"], m["height"])
    elongated = long_side / F.greatest(short_side, F.lit(1)) >= 1.75
    ratio = missing / F.greatest(extra, F.lit(1e-6))
    best = F.least(get("warp0"), get("warp1"))
    tests = {
        "missing_part": gone & (missing >= extra * MISSING_RATIO + 0.01),
        "broken_structure": gone & ((m["pred_endpoints"] > m["gt_endpoints"]) | (m["pred_components"] > m["gt_components"]) | elongated),
        "ghosting": gone & (extra >= edge) & ratio.between(0.35, 2.85),
        "edge_tearing": F.greatest(missing, extra) >= edge,
        "flicker": get("temporal") >= FLICKER,
        "blur": gone & (m["gt_edge"] - m["pred_edge"] >= BRANCH_GAIN),
        "endpoint_copy": (current >= LEAST_WRONG) & (get("copy_distance") <= F.greatest(F.lit(GOOD * 0.25), current * (1 - COPY_RATIO))),
        "blend_mask_error": best + BRANCH_GAIN < get("blend"),
    }
    return F.array_compact(F.array(*[F.when(tests[x], F.lit(x)) for x in LABELS]))


def priority(p_wrong: str = "p_wrong", p_solvable: str = "p_solvable", weight: str = "priority_weight", index: str = "region_index") -> list[Column]:
    """The descending order that picks the primary region."""
    wrong, solvable, w = F.col(p_wrong), F.col(p_solvable), F.col(weight)
    return [(wrong * solvable * w).desc(), (wrong * w).desc(), wrong.desc(), F.col(index).asc()]


def primary_region(regions: DataFrame, keys: list[str], **names: str) -> DataFrame:
    """The primary row of each sample's regions."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*priority(**names)))
    return regions.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def iou_containment(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """struct<iou, containment> of two half-open boxes x0, y0, x1, y1."""
    side = lambda axis: F.greatest(F.least(a[f"{axis}1"], b[f"{axis}1"]) - F.greatest(a[f"{axis}0"], b[f"{axis}0"]), F.lit(0))
    both = side("x") * side("y")
    area = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    union = area(a) + area(b) - both
    return F.struct(F.when(union != 0, both / F.when(union != 0, union)).otherwise(0.0).alias("iou"), F.when(both > 0, both / F.least(area(a), area(b))).otherwise(0.0).alias("containment"))


def ui_weight(border_overlap: Column, endpoint_mean: Column, endpoint_q90: Column, edge_density: Column) -> Column:
    """struct<ui_likelihood, priority_weight>: how much a static, edge-dense border region looks like an overlay."""
    border = clip((border_overlap - 0.5) / 0.5)
    static = clip(1.0 - (0.6 * endpoint_mean + 0.4 * endpoint_q90) / 0.08)
    ui = clip(border * static * clip(edge_density / 0.12))
    return F.struct(ui.alias("ui_likelihood"), (1.0 - ui * (1.0 - 0.35)).alias("priority_weight"))
