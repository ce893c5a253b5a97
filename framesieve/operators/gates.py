"""Three-way gates as Column builders: every gate is struct<label, reasons, missing_metric_count>."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GateThresholds:
    """Fixed default values; review bands left at None follow from their reject values."""

    duplicate_reject_at: float = 0.002
    duplicate_review_at: float | None = None
    scene_cut_reject_at: float = 0.62
    scene_cut_review_at: float | None = None
    temporal_asymmetry_review_at: float = 0.65
    temporal_asymmetry_reject_at: float = 0.90
    menu_transition_review_at: float = 0.40
    menu_transition_reject_at: float = 0.70
    out_of_bounds_reject_at: float = 0.72
    out_of_bounds_review_at: float | None = None
    occlusion_review_at: float = 0.40
    occlusion_reject_at: float = 0.70
    foreground_motion_review_at: float = 0.35
    foreground_motion_reject_at: float = 0.65
    flow_discontinuity_review_at: float = 0.30
    flow_discontinuity_reject_at: float = 0.60
    unexplained_motion_review_at: float = 0.35
    unexplained_motion_reject_at: float = 0.70
    wrong_reject_below: float = 0.20
    wrong_accept_at: float = 0.45
    solvable_review_below: float = 0.30
    solvable_accept_at: float = 0.55
    missing_metrics_to_review: bool = True

    #: Other names that configurations use.
    ALIASES = {"reject_duplicate": "duplicate_reject_at", "reject_scene_cut": "scene_cut_reject_at", "reject_out_of_bounds": "out_of_bounds_reject_at", "solvable_reject_below": "solvable_review_below"}

    def __post_init__(self):
        for name, value in {
            "duplicate_review_at": max(0.006, 3 * self.duplicate_reject_at),
            "scene_cut_review_at": min(0.45, 0.75 * self.scene_cut_reject_at),
            "out_of_bounds_review_at": min(0.45, 0.65 * self.out_of_bounds_reject_at),
        }.items():
            if getattr(self, name) is None:
                object.__setattr__(self, name, value)

    @classmethod
    def of(cls, values: Mapping | None) -> "GateThresholds":
        """From a mapping; a field's own name wins over its alias, None means the default, other keys are ignored."""
        known, given = {f.name for f in fields(cls)}, {k: v for k, v in (values or {}).items() if v is not None}
        renamed = {cls.ALIASES[k]: v for k, v in given.items() if k in cls.ALIASES}
        return cls(**(renamed | {k: v for k, v in given.items() if k in known}))


def finite(x: Column) -> Column:
    """The number, or null where it isn't one: text that doesn't parse, NaN, infinities."""
    n = x.try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def _at_least(x: Column, review: float, reject: float, reason: str, soft: str | None = None) -> tuple[Column, Column]:
    """(reject reason or null, review reason or null) of a metric that is worse the higher it is."""
    hard = F.when(x >= reject, F.lit(reason))
    return hard, F.when((x >= review) & (x < reject), F.lit(soft or f"possible_{reason}"))


def _texts(columns: list[Column]) -> Column:
    return F.array_distinct(F.array_compact(F.array(*columns)))


def _gate(rejects: list[Column], reviews: list[Column], missing: list[Column], note: str, cfg: GateThresholds) -> Column:
    reject, review, absent = _texts(rejects), _texts(reviews), F.size(_texts(missing))
    asks = (F.size(review) > 0) | ((absent > 0) & F.lit(cfg.missing_metrics_to_review))
    label = F.when(F.size(reject) > 0, "reject").when(asks, "review").otherwise("accept")
    noted = F.array_distinct(F.concat(review, F.when(absent > 0, F.array(F.lit(note))).otherwise(F.array().cast("array<string>"))))
    reasons = F.when(label == "reject", F.array_distinct(F.concat(reject, review))).when(label == "review", noted).otherwise(F.array().cast("array<string>"))
    return F.struct(label.alias("label"), reasons.alias("reasons"), absent.alias("missing_metric_count"))


def _null_name(x: Column, name: str) -> Column:
    return F.when(x.isNull(), F.lit(name))


def validity_gate(m: Mapping[str, Column], cfg: GateThresholds = GateThresholds()) -> Column:
    """Gate over decode_ok, finite, sequence_contiguous, duplicate_distance, scene_cut_score, temporal_asymmetry,
    max_adjacent_difference and menu_transition_score; metrics left out count as null."""
    get = lambda name, kind="double": m.get(name, F.lit(None).cast(kind))
    rejects, reviews, missing = [], [], []
    for name, reason in (("decode_ok", "invalid_decode"), ("finite", "invalid_nonfinite"), ("sequence_contiguous", "invalid_sequence_gap")):
        rejects.append(F.when(~get(name, "boolean"), F.lit(reason)))
        missing.append(_null_name(get(name, "boolean"), name))
    duplicate = finite(get("duplicate_distance"))
    rejects.append(F.when(duplicate <= cfg.duplicate_reject_at, F.lit("duplicate_frame")))
    reviews.append(F.when((duplicate > cfg.duplicate_reject_at) & (duplicate <= cfg.duplicate_review_at), F.lit("possible_duplicate_frame")))
    cut = finite(get("scene_cut_score"))
    asymmetry, adjacent = finite(get("temporal_asymmetry")), finite(get("max_adjacent_difference"))
    moving = adjacent.isNull() | (adjacent >= cfg.duplicate_review_at)
    for hard, soft in (
        _at_least(cut, cfg.scene_cut_review_at, cfg.scene_cut_reject_at, "scene_cut"),
        _at_least(F.when(moving, asymmetry), cfg.temporal_asymmetry_review_at, cfg.temporal_asymmetry_reject_at, "temporal_discontinuity", "temporal_asymmetry"),
        _at_least(finite(get("menu_transition_score")), cfg.menu_transition_review_at, cfg.menu_transition_reject_at, "menu_transition"),
    ):
        rejects.append(hard)
        reviews.append(soft)
    missing += [_null_name(duplicate, "duplicate_distance"), _null_name(cut, "scene_cut_score"), _null_name(asymmetry, "temporal_asymmetry")]
    return _gate(rejects, reviews, missing, "validity_metrics_missing", cfg)


def scope_gate(m: Mapping[str, Column], cfg: GateThresholds = GateThresholds()) -> Column:
    """Gate over the five motion ratios; only the first two count as missing, both semantic ones absent ask for review."""
    get = lambda name: finite(m.get(name, F.lit(None).cast("double")))
    bands = (
        ("out_of_bounds_ratio", cfg.out_of_bounds_review_at, cfg.out_of_bounds_reject_at, "flow_out_of_bounds"),
        ("flow_discontinuity_ratio", cfg.flow_discontinuity_review_at, cfg.flow_discontinuity_reject_at, "flow_discontinuous"),
        ("foreground_large_motion_ratio", cfg.foreground_motion_review_at, cfg.foreground_motion_reject_at, "foreground_motion_extreme"),
        ("occlusion_ratio", cfg.occlusion_review_at, cfg.occlusion_reject_at, "occlusion_extreme"),
        ("unexplained_motion_ratio", cfg.unexplained_motion_review_at, cfg.unexplained_motion_reject_at, "unexplained_motion"),
    )
    found = [_at_least(get(name), review, reject, reason) for name, review, reject, reason in bands]
    blind = get("foreground_large_motion_ratio").isNull() & get("occlusion_ratio").isNull() & F.lit(cfg.missing_metrics_to_review)
    reviews = [soft for _, soft in found] + [F.when(blind, F.lit("scope_semantics_missing"))]
    missing = [_null_name(get(n), n) for n in ("out_of_bounds_ratio", "flow_discontinuity_ratio")]
    return _gate([hard for hard, _ in found], reviews, missing, "scope_metrics_missing", cfg)


def decision_gate(validity: Column, scope: Column, p_wrong: Column, p_solvable: Column, cfg: GateThresholds = GateThresholds()) -> Column:
    """struct<label, reasons> from two gates and two probabilities (the job fails where these aren't finite)."""
    check = lambda p: F.when(finite(p).isNull(), F.raise_error(F.lit("probabilities must be finite")).cast("double")).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
    wrong, solvable = check(p_wrong), check(p_solvable)
    some = lambda test, reason: F.when(test, F.array(F.lit(reason))).otherwise(F.array().cast("array<string>"))
    of = lambda gate, note: F.when(gate["label"] == "review", F.concat(gate["reasons"], F.array(F.lit(note)))).otherwise(F.array().cast("array<string>"))
    review = F.array_distinct(F.concat(
        of(validity, "validity_review"), of(scope, "scope_review"), some(wrong < cfg.wrong_accept_at, "wrongness_gray_zone"),
        some(solvable < cfg.solvable_review_below, "solvability_low"), some((solvable >= cfg.solvable_review_below) & (solvable < cfg.solvable_accept_at), "solvability_gray_zone"),
    ))
    result = lambda label, reasons: F.struct(F.lit(label).alias("label"), reasons.alias("reasons"))
    return (
        F.when(validity["label"] == "reject", result("reject", F.array_distinct(F.concat(validity["reasons"], F.array(F.lit("invalid_data"))))))
        .when(scope["label"] == "reject", result("reject", F.array_distinct(F.concat(scope["reasons"], F.array(F.lit("out_of_scope"))))))
        .when(wrong < cfg.wrong_reject_below, result("reject", F.array(F.lit("prediction_not_wrong"))))
        .when(F.size(review) > 0, result("review", review))
        .otherwise(result("accept", F.array().cast("array<string>")))
    )


def status(validity: Column, scope: Column, decision: Column) -> Column:
    """invalid or out_of_scope where a gate rejects, else the decision."""
    return F.when(validity["label"] == "reject", "invalid").when(scope["label"] == "reject", "out_of_scope").otherwise(decision["label"])


def label_value(label: Column) -> Column:
    """accept is true, reject false, anything else null."""
    return F.when(label == "accept", True).when(label == "reject", False)


def ordered_reasons(*reasons: Column) -> Column:
    """The union in the order of first sight."""
    return F.array_distinct(F.concat(*[F.coalesce(r, F.array().cast("array<string>")) for r in reasons]))
