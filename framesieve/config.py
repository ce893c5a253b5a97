"""Configuration: strict JSON to frozen dataclasses, validated, and hashed for the run's identity."""

from __future__ import annotations

import hashlib
import json
import types
import typing
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path

from .operators.gates import GateThresholds
from .operators.kernels import ScoringThresholds


class ConfigError(ValueError):
    """A configuration that cannot be used, with the path of the offending key."""


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def _at(default, low: float | None = None, high: float | None = None):
    """A key with its default and the range of its values."""
    return field(default=default, metadata={"low": low, "high": high})


def _share(default: float | None):
    return _at(default, 0, 1)


# The keys of the sections below, their defaults and ranges are the configuration format.


@dataclass(frozen=True)
class Data:
    root: str
    frame_regex: str | None = r"^(?P<video>.*?)(?P<frame>\d{5})\.(?P<ext>png|jpg|jpeg)$"
    frame_digits: int | None = _at(None, 1)
    stride: int = _at(1, 1)
    recursive: bool = True
    extensions: tuple[str, ...] = (".png", ".jpg", ".jpeg")
    excluded_dirs: tuple[str, ...] = ("extremely_hard_case", "extremely_hard_case_visualization", ".git")


@dataclass(frozen=True)
class Model:
    factory: str
    checkpoint: str | None = None
    input_height: int = _at(540, 1)
    input_width: int = _at(960, 1)
    batch_size: int = _at(1, 1)
    mask0_role: typing.Literal["warp0_weight", "warp1_weight"] = "warp0_weight"
    align_corners: bool = False
    padding_mode: typing.Literal["zeros", "border", "reflection"] = "border"
    flow_units: typing.Literal["input_pixels"] = "input_pixels"
    output_order: tuple[str, ...] = ("flow_t0", "flow_t1", "mask0", "mask1")
    factory_kwargs: dict = field(default_factory=dict)


_GATES, _SCORING = GateThresholds, ScoringThresholds


@dataclass(frozen=True)
class Thresholds:
    """Gates and scorer in one section; defaults are those of the operators that use them."""

    reject_scene_cut: float = _share(_GATES.scene_cut_reject_at)
    reject_duplicate: float = _share(_GATES.duplicate_reject_at)
    reject_out_of_bounds: float = _share(_GATES.out_of_bounds_reject_at)
    duplicate_review_at: float | None = _share(None)
    scene_cut_review_at: float | None = _share(None)
    temporal_asymmetry_review_at: float = _share(_GATES.temporal_asymmetry_review_at)
    temporal_asymmetry_reject_at: float = _share(_GATES.temporal_asymmetry_reject_at)
    menu_transition_review_at: float = _share(_GATES.menu_transition_review_at)
    menu_transition_reject_at: float = _share(_GATES.menu_transition_reject_at)
    out_of_bounds_review_at: float | None = _share(None)
    occlusion_review_at: float = _share(_GATES.occlusion_review_at)
    occlusion_reject_at: float = _share(_GATES.occlusion_reject_at)
    foreground_motion_review_at: float = _share(_GATES.foreground_motion_review_at)
    foreground_motion_reject_at: float = _share(_GATES.foreground_motion_reject_at)
    flow_discontinuity_review_at: float = _share(_GATES.flow_discontinuity_review_at)
    flow_discontinuity_reject_at: float = _share(_GATES.flow_discontinuity_reject_at)
    unexplained_motion_review_at: float = _share(_GATES.unexplained_motion_review_at)
    unexplained_motion_reject_at: float = _share(_GATES.unexplained_motion_reject_at)
    wrong_reject_below: float = _share(_GATES.wrong_reject_below)
    wrong_accept_at: float = _share(_GATES.wrong_accept_at)
    solvable_reject_below: float = _share(_GATES.solvable_review_below)
    solvable_accept_at: float = _share(_GATES.solvable_accept_at)
    edge_threshold: float = _share(_SCORING.edge_threshold)
    candidate_quantile: float = _share(_SCORING.candidate_quantile)
    min_region_pixels: int = _at(_SCORING.min_region_pixels, 1)
    max_regions: int = _at(_SCORING.max_regions, 1)
    ui_border_fraction: float = _share(_SCORING.ui_border)
    ui_border_min_overlap: float = _share(_SCORING.ui_min_overlap)
    ui_static_threshold: float = _share(_SCORING.ui_static)
    ui_gt_edge_threshold: float = _share(_SCORING.ui_edge)
    ui_edge_density_target: float = _share(_SCORING.ui_density)
    ui_priority_floor: float = _share(_SCORING.ui_floor)
    ui_likelihood_threshold: float = _share(_SCORING.ui_likelihood)
    non_ui_region_reserve: int = _at(_SCORING.reserve, 0)
    missing_metrics_to_review: bool = _GATES.missing_metrics_to_review

    def gates(self) -> GateThresholds:
        return GateThresholds.of(asdict(self))

    def scoring(self) -> ScoringThresholds:
        return ScoringThresholds(self.edge_threshold, self.candidate_quantile, self.min_region_pixels, self.max_regions, ui_border=self.ui_border_fraction, ui_min_overlap=self.ui_border_min_overlap, ui_static=self.ui_static_threshold, ui_edge=self.ui_gt_edge_threshold, ui_density=self.ui_edge_density_target, ui_floor=self.ui_priority_floor, ui_likelihood=self.ui_likelihood_threshold, reserve=self.non_ui_region_reserve)


@dataclass(frozen=True)
class Runtime:
    """Of these, chunk_triplets, precision and run_dir steer this engine; the others are Spark's to decide and are kept."""

    backend: typing.Literal["cpu", "cuda", "npu"] = "cpu"
    devices: tuple[int, ...] = (0,)
    workers: int = _at(1, 1)
    chunk_triplets: int = _at(256, 1)
    prefetch: int = _at(2, 1)
    decode_cache_mb: int = _at(512, 16)
    cpu_threads_per_worker: int = _at(1, 1)
    postproc_workers: int = _at(0, 0)
    warmup_batches: int = _at(1, 0)
    lease_seconds: int = _at(1800, 30)
    precision: typing.Literal["float32", "float16", "bfloat16"] = "float32"
    reconstruction: typing.Literal["auto", "device", "cpu"] = "auto"
    state_db: str = "runs/state.sqlite3"
    run_dir: str = "runs/default"


@dataclass(frozen=True)
class Output:
    hard_case_dir: str = "extremely_hard_case"
    visualization_dir: str = "extremely_hard_case_visualization"
    manifest_name: str = "hard_case_manifest.jsonl"
    link_mode: typing.Literal["hardlink_then_copy", "copy"] = "hardlink_then_copy"
    layout: typing.Literal["segment_relative", "preserve_relative", "flat"] = "segment_relative"
    save_review: bool = False
    visualization_width: int = _at(320, 64)


@dataclass(frozen=True)
class Config:
    data: Data
    model: Model
    teacher: Model | None = None
    thresholds: Thresholds = field(default_factory=Thresholds)
    runtime: Runtime = field(default_factory=Runtime)
    output: Output = field(default_factory=Output)

    def check(self) -> None:
        """Ranges of all keys first, then what keys ask of each other."""
        for part in fields(self):
            section = getattr(self, part.name)
            for f in fields(section) if section is not None else ():
                _in_range(f"{part.name}.{f.name}", getattr(section, f.name), f.metadata)
        for ask, fits in _asked(self):
            _need(fits, ask)

    def canonical_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, sort_keys=True, separators=(",", ":"))

    def run_hash(self) -> str:
        """Sixteen hex digits that identify everything the configuration says."""
        return hashlib.sha256(self.canonical_json().encode()).hexdigest()[:16]


def _in_range(path: str, value, limits) -> None:
    for name, breaks in (("low", lambda v, limit: v < limit), ("high", lambda v, limit: v > limit)):
        limit = limits.get(name)
        _need(value is None or limit is None or not breaks(value, limit), f"{path} is {value}, beyond its {name} end {limit}")


def _asked(c: Config):
    """(what is asked, whether it holds) for all rules over more than one number."""
    t, r = c.thresholds, c.runtime
    gates = t.gates()
    for name, model in (("model", c.model), ("teacher", c.teacher)):
        if model is not None:
            yield f"{name}.factory: a short name, or module and function with a colon between", ":" in model.factory or model.factory.strip().isidentifier()
            yield f"{name}.output_order: the four outputs, each once", set(model.output_order) == set(Model.output_order) and len(model.output_order) == 4
    yield "data.root: a folder", bool(c.data.root)
    yield "data: a frame_regex or frame_digits, not both", [c.data.frame_regex, c.data.frame_digits].count(None) == 1
    yield "thresholds: duplicates are rejected at or below where they are reviewed", gates.duplicate_reject_at <= gates.duplicate_review_at
    for name in (f.name.removesuffix("_reject_at") for f in fields(gates) if f.name.endswith("_reject_at") and not f.name.startswith("duplicate")):
        yield f"thresholds: {name} is reviewed at or below where it is rejected", getattr(gates, f"{name}_review_at") <= getattr(gates, f"{name}_reject_at")
    for low, high in (("wrong_reject_below", "wrong_accept_at"), ("solvable_review_below", "solvable_accept_at")):
        yield f"thresholds: {low} up to {high}", getattr(gates, low) <= getattr(gates, high)
    yield "thresholds: non_ui_region_reserve within max_regions", t.non_ui_region_reserve <= t.max_regions
    yield "runtime.devices: one at least", bool(r.devices)
    yield "runtime: a device for each worker", r.backend == "cpu" or r.workers <= len(r.devices)
    for path in (c.output.hard_case_dir, c.output.visualization_dir, c.output.manifest_name):
        yield f"output: {path!r} stays below the root", bool(path) and not Path(path).is_absolute() and ".." not in Path(path).parts


def _build(kind, value, path: str):
    """``value`` as the annotated type; raises ConfigError with the path where it doesn't fit."""
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin in (typing.Union, types.UnionType):
        return None if value is None else _build(next(a for a in args if a is not type(None)), value, path)
    if origin is typing.Literal:
        _need(value in args, f"{path} must be one of {', '.join(map(str, args))}")
        return value
    if origin is tuple:
        _need(isinstance(value, (list, tuple)), f"{path} must be an array")
        return tuple(_build(args[0], v, f"{path}[{i}]") for i, v in enumerate(value))
    if is_dataclass(kind):
        _need(isinstance(value, dict), f"{path} must be an object")
        hints = typing.get_type_hints(kind)
        _need(not (extra := sorted(set(value) - set(hints))), f"unknown keys at {path}: {', '.join(extra)}")
        try:
            return kind(**{k: _build(hints[k], v, f"{path}.{k}") for k, v in value.items()})
        except TypeError as e:
            raise ConfigError(f"incomplete {path}: {e}") from e
    if kind is dict:
        _need(isinstance(value, dict), f"{path} must be an object")
    return value


def parse(payload: dict) -> Config:
    config = _build(Config, payload, "config")
    config.check()
    return config


def load(path: str | Path) -> Config:
    return parse(json.loads(Path(path).read_text(encoding="utf-8")))
