"""The mining plan on image files: index, main stage, teacher stage, finalised records."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Model
from ..operators import diagnosis, gates, intervals, kernels, ledger, records
from ..operators import triplets as tr
from ..scratch import cut, filesystem
from ..sources.frames import named_frames, read_images, scan_frames

#: Model short names and what makes them; others are given as module:function.
MODELS: dict[str, Callable] = {"mock": kernels.mock_model}


def model_names() -> list[str]:
    """The short names of models, sorted."""
    return sorted(MODELS)


def load_factory(spec: str) -> Callable:
    """A callable by short name or ``module:attribute.path``."""
    if spec in MODELS:
        return MODELS[spec]
    module, _, path = spec.partition(":")
    if not path:
        raise ValueError(f"unknown model {spec!r}; known: {', '.join(model_names())}")
    found = importlib.import_module(module)
    for name in path.split("."):
        found = getattr(found, name)
    if not callable(found):
        raise TypeError(f"{spec} is not callable")
    return found


def checked_outputs(raw, order: tuple[str, ...]) -> dict[str, np.ndarray]:
    """The four outputs of a model, a mapping or a sequence in the given order, with shapes and ranges checked."""
    named = dict(raw) if hasattr(raw, "keys") else dict(zip(order, raw, strict=True))
    out = {k: np.asarray(named[k], np.float32) for k in ("flow_t0", "flow_t1", "mask0", "mask1")}
    shape = out["mask0"].shape
    for k, v in out.items():
        if v.shape != (shape + (2,) if k.startswith("flow") else shape) or len(shape) != 2:
            raise ValueError(f"{k} has shape {v.shape}")
        if not np.isfinite(v).all() or (k.startswith("mask") and (v.min() < -1e-6 or v.max() > 1 + 1e-6)):
            raise ValueError(f"{k} holds values out of range")
    return out


def predictor(model: Model) -> Callable[[list[tuple[np.ndarray, np.ndarray]]], list[dict[str, np.ndarray]]]:
    """Reconstructions of pairs of frames: the factory is resolved and called where it runs.

    What a factory makes takes two images, or, where it has a true ``batched``, two stacks of up to ``batch_size`` images
    of one size, and then gives stacked outputs.
    """
    factory = load_factory(model.factory)
    network = (model.input_height, model.input_width)
    batched = False
    if factory is kernels.mock_model:
        kwargs = {{"output_scale": "scale", "endpoint_copy_box": "copy_box"}.get(k, k): v for k, v in model.factory_kwargs.items()}
        run = lambda a, b: factory(*network, **kwargs)
    else:
        built = factory(checkpoint=model.checkpoint, **model.factory_kwargs)
        batched = bool(getattr(built, "batched", False))
        run = built

    def outputs(pairs: list) -> list[dict[str, np.ndarray]]:
        if factory is kernels.mock_model:
            return [checked_outputs(run(None, None), model.output_order) for _ in pairs]
        small = [tuple(kernels.resize(x, *network, model.align_corners) for x in pair) for pair in pairs]
        if not batched:
            return [checked_outputs(run(a, b), model.output_order) for a, b in small]
        raw = run(np.stack([a for a, _ in small]), np.stack([b for _, b in small]))
        named = dict(raw) if hasattr(raw, "keys") else dict(zip(model.output_order, raw, strict=True))
        return [checked_outputs({k: v[i] for k, v in named.items()}, model.output_order) for i in range(len(pairs))]

    def predict(pairs: list) -> list[dict[str, np.ndarray]]:
        made = [o for at in range(0, len(pairs), model.batch_size) for o in outputs(pairs[at : at + model.batch_size])]
        return [kernels.reconstruct(a, b, o, network, model.mask0_role, model.align_corners, model.padding_mode) for (a, b), o in zip(pairs, made, strict=True)]

    return predict


# --- index


def build_index(spark: SparkSession, config: Config) -> DataFrame:
    """A row per triplet: run_hash, sample_id, video_id, stride, indices, and the three frames, by video, whatever its case, and first frame."""
    d = config.data
    frames = scan_frames(spark, d.root, pattern=d.frame_regex, digits=d.frame_digits, allowed=d.extensions, exclude=(*d.excluded_dirs, config.output.hard_case_dir, config.output.visualization_dir), recursive=d.recursive)
    found = tr.triplets(frames, stride=d.stride)
    for name in ("img0", "gt", "img1"):
        one = frames.select(F.col("video_id").alias("__v"), F.col("frame_index").alias("__i"), F.struct("frame_index", "path", "relative_path", "size", "modified").alias(name))
        found = found.join(one, (F.col("video_id") == F.col("__v")) & (F.col(f"{name}_index") == F.col("__i"))).drop("__v", "__i")
    pairs = [(F.col(f"{n}.frame_index"), F.col(f"{n}.relative_path")) for n in ("img0", "gt", "img1")]
    indices = F.array(*[F.col(f"{n}_index").cast("int") for n in ("img0", "gt", "img1")])
    return found.select(F.lit(config.run_hash()).alias("run_hash"), tr.sample_id(F.col("video_id"), d.stride, pairs).alias("sample_id"), "video_id", F.lit(d.stride).alias("stride"), indices.alias("frame_indices"), "img0", "gt", "img1").orderBy(*records.fold_order("video_id"), F.col("frame_indices")[0])


def index_digest(index: DataFrame) -> str:
    """One SHA-256 for an index, whatever its partitions: of the digests of its sample ids by their first four digits."""
    import hashlib

    parts = index.groupBy(F.substring("sample_id", 1, 4).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sample_id")), "\n"), 256).alias("d"))
    return hashlib.sha256("".join(r["p"] + r["d"] for r in parts.orderBy("p").collect()).encode()).hexdigest()


def changed_frames(index: DataFrame, frames: DataFrame) -> DataFrame:
    """Frames of a frozen index that a fresh listing lacks or shows with another size or time."""
    old = index.select(F.explode(F.array("img0", "gt", "img1")).alias("f")).select("f.relative_path", "f.size", "f.modified").distinct()
    new = frames.select(F.col("relative_path").alias("__p"), F.col("size").alias("__s"), F.col("modified").alias("__m"))
    same = (F.col("relative_path") == F.col("__p")) & (F.col("size") == F.col("__s")) & (F.col("modified") == F.col("__m"))
    return old.join(new, same, "left_anti")


# --- frames in order

def _rgb(row) -> np.ndarray | None:
    """The decoded image of a row (channels blue first), or None."""
    if row.bgr is None or row.height <= 0:
        return None
    a = np.frombuffer(row.bgr, np.uint8).reshape(row.height, row.width, row.nChannels)
    return kernels.as_rgb(a if row.nChannels == 1 else a[..., 2::-1])


def run_triplets(spark: SparkSession, index: DataFrame, work: Callable, columns: str, config: Config, *, batch: int = 1, block: int = 64, payload: str | None = None) -> DataFrame:
    """``work`` on every triplet of the index, decoded; returns sample_id and its ``columns``.

    A frame's video and index are read from its path, so images meet their triplets by being dealt to the same (video,
    block of indices), each with a copy in the blocks before that a triplet reaches over: pixels are shuffled once. Only
    images of blocks with a triplet go on. A sorted task streams them with the frames of one triplet, and ``batch``
    triplets, in hand. ``payload`` names an index column that ``work`` gets.

    Folders and blocks are small lists (they grow with the index: take it in waves, as ``in_waves`` does).
    """
    d, reach = config.data, 2 * config.data.stride
    folders = [r[0] for r in index.select(F.explode(F.array("img0.path", "gt.path", "img1.path")).alias("path")).select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    first = F.col("frame_indices")[0].cast("long")
    jobs = index.select("video_id", F.floor(first / block).alias("block"), (first + reach).alias("frame_index"), "sample_id", (F.col(payload) if payload else F.lit(None).cast("int")).alias("payload"))
    if not folders:
        return spark.createDataFrame([], f"sample_id string, {columns}")
    images = named_frames(read_images(spark, folders), d.root, pattern=d.frame_regex, digits=d.frame_digits, allowed=d.extensions, exclude=d.excluded_dirs)
    at = F.col("frame_index").cast("long")
    images = images.select("video_id", F.explode(F.sequence(F.floor(F.greatest(at - reach, F.lit(0)) / block), F.floor(at / block))).alias("block"), at.alias("frame_index"), "height", "width", "nChannels", "bgr")
    wanted = jobs.select(F.col("video_id").alias("__v"), F.col("block").alias("__b")).distinct()
    images = images.join(F.broadcast(wanted), (F.col("video_id") == F.col("__v")) & (F.col("block") == F.col("__b")), "left_semi")
    kind = dict(jobs.dtypes)["payload"]
    both = images.withColumns({"sample_id": F.lit(None).cast("string"), "payload": F.lit(None).cast(kind)}).unionByName(jobs, allowMissingColumns=True)
    both = both.fillna(0, ["height", "width", "nChannels"])  # whole numbers stay such in pandas
    # a triplet's row follows the row of its last frame
    dealt = both.repartition("video_id", "block").sortWithinPartitions("video_id", "block", "frame_index", F.col("sample_id").asc_nulls_first())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        do, place, held, waiting = work(), None, {}, []

        def flush() -> pd.DataFrame:
            done = do([(three, load) for _, three, load in waiting])
            out = pd.DataFrame([{"sample_id": s, **r} for (s, _, _), r in zip(waiting, done, strict=True)])
            waiting.clear()
            return out

        for rows in batches:
            for row in rows.itertuples(index=False):
                if (row.video_id, row.block) != place:
                    place, held = (row.video_id, row.block), {}
                if isinstance(row.sample_id, str):
                    waiting.append((row.sample_id, [held.get(row.frame_index - j * reach // 2) for j in (2, 1, 0)], row.payload))
                    if len(waiting) >= batch:
                        yield flush()
                else:
                    held = {i: v for i, v in held.items() if i >= row.frame_index - reach}
                    held[row.frame_index] = _rgb(row)
        if waiting:
            yield flush()

    return dealt.mapInPandas(run, f"sample_id string, {columns}")


def in_waves(index: DataFrame, folder: str, make: Callable[[DataFrame], DataFrame], *, wave: int) -> DataFrame:
    """``make`` of an index with ``chunk`` numbers, ``wave`` chunks at a time, each written whole to its own part below ``folder``.

    A part that was written is not made again, so a run that died goes on where it stopped: the unfinished waves are those
    whose parts lack Spark's mark of success. Chunk numbers must be frozen with the index.
    """
    spark = index.sparkSession
    last = index.agg(F.max("chunk")).first()[0]
    begins = range(0, (-1 if last is None else last) + 1, wave)
    part = lambda a: f"{folder}/chunks-{a:010d}-{a + wave:010d}"
    exists = lambda path: (lambda fs, p: fs.exists(p))(*filesystem(spark, path))
    tasks = spark.createDataFrame([(a,) for a in begins], "task_id long")
    written = spark.createDataFrame([(a,) for a in begins if exists(f"{part(a)}/_SUCCESS")], "task_id long")
    for a in sorted(r["task_id"] for r in ledger.unfinished(tasks, written).collect()):
        make(index.where(F.col("chunk").between(a, a + wave - 1)).drop("chunk")).write.mode("overwrite").parquet(part(a))
    if not begins:
        return make(index.drop("chunk"))
    return spark.read.parquet(*[part(a) for a in begins])


# --- main stage

MEASURED = (
    "x0:int,y0:int,x1:int,y1:int,score:double,current:double,missing:double,extra:double,gt_edge:double,pred_edge:double,gt_endpoints:int,pred_endpoints:int,gt_components:int,pred_components:int,"
    "warp0:double,warp1:double,blend:double,copy_distance:double,width:int,height:int,ui_likelihood:double,priority_weight:double,metrics:map<string,double>"
)
VALIDITY = "decode_ok:boolean,finite:boolean,sequence_contiguous:boolean,duplicate_distance:double,scene_cut_score:double,histogram_jump:double,temporal_asymmetry:double,max_adjacent_difference:double,menu_transition_score:double"
SCOPE = "out_of_bounds_ratio:double,flow_discontinuity_ratio:double,foreground_large_motion_ratio:double,occlusion_ratio:double,unexplained_motion_ratio:double,background_motion:double"
MAIN = f"error string, raw_p_wrong double, raw_mining_p_wrong double, scoring map<string,double>, validity struct<{VALIDITY}>, scope struct<{SCOPE}>, measured array<struct<{MEASURED}>>"


def _predicted(predict: Callable, use: Callable, nothing: dict) -> Callable:
    """Work on a list of (three frames, payload): ``use`` with the pair's reconstruction, ``nothing`` where frames fail."""

    def do(triplets: list) -> list[dict]:
        good = [all(i is not None for i in three) and len({i.shape for i in three}) == 1 for three, _ in triplets]
        made = iter(predict([(three[0], three[2]) for (three, _), g in zip(triplets, good, strict=True) if g]))
        return [use(three, next(made), load) if g else dict(nothing) for (three, load), g in zip(triplets, good, strict=True)]

    return do


def _measure(config: Config) -> Callable:
    """The numeric part of the main stage for one triplet; everything that decides is a Column later."""
    predict, thresholds, edge = predictor(config.model), config.thresholds.scoring(), config.thresholds.edge_threshold

    def region(r: kernels.Region, maps: dict, others: dict) -> dict:
        x0, y0, x1, y1 = r.box
        cut = lambda m: m[y0:y1, x0:x1]
        et, ep = cut(maps["sobel_gt"]), cut(maps["sobel_prediction"])
        local = {k: kernels.robust_score(cut(v)) for k, v in others.items()}
        return {"x0": x0, "y0": y0, "x1": x1, "y1": y1, "score": r.score, "current": kernels.robust_score(cut(maps["structure"])), "missing": kernels.robust_score(cut(maps["gt_only_edge"])), "extra": kernels.robust_score(cut(maps["pred_only_edge"])), "gt_edge": kernels.top_mean(et, 0.05), "pred_edge": kernels.top_mean(ep, 0.05), "gt_endpoints": kernels.edge_endpoints(et, edge), "pred_endpoints": kernels.edge_endpoints(ep, edge), "gt_components": kernels.island_count(et, edge), "pred_components": kernels.island_count(ep, edge), **local, "width": x1 - x0, "height": y1 - y0, "ui_likelihood": r.ui, "priority_weight": r.weight, "metrics": {k: float(v) for k, v in r.metrics.items()}}

    def one(three: list, made: dict) -> dict:
        a, truth, b = three
        maps, regions, metrics = kernels.score(made["prediction"], truth, thresholds, a, b)
        branch = lambda image, other: kernels.error_maps(image, other)["structure"]
        others = {"warp0": branch(made["warp0"], truth), "warp1": branch(made["warp1"], truth), "blend": branch(made["warp_blend"], truth), "copy_distance": branch(made["prediction"], b)} if regions else {}
        return {"error": None, "raw_p_wrong": metrics["p_wrong"], "raw_mining_p_wrong": metrics["mining_p_wrong"], "scoring": metrics, "validity": kernels.validity_metrics(a, truth, b), "scope": kernels.scope_metrics(made["flow_t0"], made["flow_t1"]), "measured": [region(r, maps, others) for r in regions]}

    nothing = {"error": "a frame cannot be read, or shapes differ", "raw_p_wrong": 0.0, "raw_mining_p_wrong": 0.0, "scoring": {}, "validity": None, "scope": None, "measured": []}
    return _predicted(predict, lambda three, made, _: one(three, made), nothing)


def _primary(regions, wrong: str = "p_wrong"):
    """Position of the primary region of an array column, null for none: the greatest key, the first among equals."""
    keyed = F.transform(regions, lambda r, i: F.struct((r[wrong] * r["p_solvable"] * r["priority_weight"]).alias("a"), (r[wrong] * r["priority_weight"]).alias("b"), r[wrong].alias("c"), (-i).alias("d")))
    return -F.array_max(keyed)["d"]


def _decided(df: DataFrame, config: Config) -> DataFrame:
    """Adds labels, status and reasons from validity, scope, mining_p_wrong, p_solvable and diagnosis_reasons."""
    cfg = config.thresholds.gates()
    columns = lambda name, kinds: {c.split(":")[0]: F.col(f"{name}.{c.split(':')[0]}") for c in kinds.split(",")}
    df = df.withColumn("validity_gate", gates.validity_gate(columns("validity", VALIDITY), cfg)).withColumn("scope_gate", gates.scope_gate(columns("scope", SCOPE), cfg))
    df = df.withColumn("decision", gates.decision_gate(F.col("validity_gate"), F.col("scope_gate"), F.col("mining_p_wrong"), F.col("p_solvable"), cfg))
    status = gates.status(F.col("validity_gate"), F.col("scope_gate"), F.col("decision"))
    reasons = gates.ordered_reasons(F.col("diagnosis_reasons"), F.col("validity_gate.reasons"), F.col("scope_gate.reasons"), F.col("decision.reasons"))
    bad = F.col("error").isNotNull()
    return df.withColumns({
        "status": F.when(bad, "invalid").otherwise(status), "validity_label": F.when(bad, "reject").otherwise(F.col("validity_gate.label")), "in_scope_label": F.when(bad, "review").otherwise(F.col("scope_gate.label")),
        "valid": F.when(bad, False).otherwise(gates.label_value(F.col("validity_gate.label"))), "in_scope": F.when(~bad, gates.label_value(F.col("scope_gate.label"))),
        "reasons": F.when(bad, F.array(F.lit("invalid_decode_or_shape"))).otherwise(reasons),
    })


def diagnosed(raw: DataFrame, edge: float) -> DataFrame:
    """Regions with labels and solvability, the primary one, and the sample's probabilities."""

    def one(r):
        fields = {k: r[k] for k in ("current", "missing", "extra", "gt_edge", "pred_edge", "gt_endpoints", "pred_endpoints", "gt_components", "pred_components", "width", "height", "copy_distance", "warp0", "warp1", "blend")}
        solvable = diagnosis.solvability(r["current"], None, (r["warp0"], r["warp1"], r["blend"]))
        return F.struct(F.array(r["x0"], r["y0"], r["x1"], r["y1"]).alias("box"), r["current"].alias("p_wrong"), solvable["p_solvable"].alias("p_solvable"), (r["current"] * r["priority_weight"]).alias("mining_p_wrong"), diagnosis.region_labels(fields, edge).alias("reasons"), r["priority_weight"].alias("priority_weight"), r["ui_likelihood"].alias("ui_likelihood"), r["warp0"].alias("warp0"), r["warp1"].alias("warp1"), r["blend"].alias("blend"), r["metrics"].alias("metrics"))

    df = raw.withColumn("regions", F.transform("measured", one)).withColumn("primary_region_index", _primary(F.col("regions")).cast("int"))
    first = F.get("regions", F.col("primary_region_index"))
    alone = diagnosis.solvability(F.col("raw_p_wrong"))["p_solvable"]
    return df.withColumns({
        "p_wrong": F.coalesce(first["p_wrong"], F.col("raw_p_wrong")), "mining_p_wrong": F.coalesce(first["mining_p_wrong"], F.col("raw_mining_p_wrong")),
        "p_solvable": F.when(F.col("error").isNotNull(), 0.0).otherwise(F.coalesce(first["p_solvable"], alone)),
        "diagnosis_reasons": diagnosis.in_label_order(F.flatten(F.transform("regions", lambda r: r["reasons"]))),
    })


def mine(spark: SparkSession, index: DataFrame, config: Config) -> DataFrame:
    """The main stage: a result per triplet of the index."""
    raw = run_triplets(spark, index, partial(_measure, config), MAIN, config, batch=config.model.batch_size)
    met = index.join(raw, "sample_id")
    steady = tr.contiguous(F.col("frame_indices"), F.col("stride"))
    met = met.withColumn("validity", F.col("validity").withField("sequence_contiguous", steady))
    return _decided(diagnosed(met, config.thresholds.edge_threshold), config).drop("measured", "diagnosis_reasons", "validity_gate", "scope_gate")


# --- teacher stage

#: Statuses of a record, and what a teacher must leave as it is.
STATUSES = ("accept", "review", "reject", "invalid", "out_of_scope")
IMMUTABLE = ("run_hash", "video_id", "stride", "frame_indices")
TEACHER = "teacher_p_wrong double, teacher_local array<double>, teacher_failed string"


def _teach(config: Config) -> Callable:
    predict, thresholds = predictor(config.teacher), config.thresholds.scoring()

    def one(three: list, made: dict, boxes) -> dict:
        maps, _, metrics = kernels.score(made["prediction"], three[1], thresholds)
        local = [kernels.robust_score(maps["structure"][b[1] : b[3], b[0] : b[2]]) for b in (boxes if boxes is not None else [])]
        return {"teacher_p_wrong": metrics["p_wrong"], "teacher_local": local, "teacher_failed": None}

    return _predicted(predict, one, {"teacher_p_wrong": None, "teacher_local": None, "teacher_failed": "a frame cannot be read, or shapes differ"})


def judged(spark: SparkSession, wanted: DataFrame, config: Config) -> DataFrame:
    """(sample_id, teacher's errors) of results, by the images."""
    boxed = wanted.withColumn("boxes", F.transform("regions", lambda r: r["box"]))
    return run_triplets(spark, boxed, partial(_teach, config), TEACHER, config, batch=config.teacher.batch_size, payload="boxes")


def candidates(results: DataFrame) -> DataFrame:
    """The results that a teacher judges again."""
    return results.where(F.col("status").isin("accept", "review"))


def teach(spark: SparkSession, results: DataFrame, config: Config, seen: DataFrame | None = None) -> DataFrame:
    """All results, with accepted and reviewed ones judged again beside the teacher's errors (``seen``, or made here).

    The candidates' regions keep their wrongness and get new solvability; the primary region is chosen anew, gates are
    evaluated on the stored metrics, and the first decision is kept in ``main_decision``. Where a frame fails, the sample
    is reviewed. The stage fails unless every candidate is judged exactly once, no other sample is, what identifies a
    sample is unchanged, and every status is one that a record may have.
    """
    wanted = candidates(results)
    seen = judged(spark, wanted, config) if seen is None else seen
    seen = cut(seen, "teacher-seen")
    df = wanted.join(seen, "sample_id")

    def again(r, error):
        s = diagnosis.solvability(r["p_wrong"], error, (r["warp0"], r["warp1"], r["blend"]))
        return r.withField("p_solvable", s["p_solvable"])

    first = F.struct("status", "p_wrong", "mining_p_wrong", "p_solvable", "reasons")
    df = df.withColumn("main_decision", first).withColumn("regions", F.zip_with("regions", F.coalesce("teacher_local", F.transform("regions", lambda r: F.lit(None).cast("double"))), again))
    df = df.withColumn("primary_region_index", _primary(F.col("regions")).cast("int"))
    top = F.get("regions", F.col("primary_region_index"))
    alone = diagnosis.solvability(F.col("p_wrong"), F.col("teacher_p_wrong"))["p_solvable"]
    df = df.withColumns({"p_wrong": F.coalesce(top["p_wrong"], F.col("p_wrong")), "mining_p_wrong": F.coalesce(top["mining_p_wrong"], F.col("mining_p_wrong")), "p_solvable": F.coalesce(top["p_solvable"], alone), "diagnosis_reasons": F.filter("reasons", lambda r: r.isin(*diagnosis.LABELS))})
    # written here, as the gates read each probability many times and the optimizer would repeat what makes them
    df = _decided(cut(df.drop("decision"), "teacher-regions"), config)
    failed = F.col("teacher_failed").isNotNull()
    df = df.withColumns({"status": F.when(failed, "review").otherwise(F.col("status")), "reasons": F.when(failed, F.array_distinct(F.concat("reasons", F.array(F.lit("teacher_unavailable"))))).otherwise(F.col("reasons"))})
    columns = ["status", "validity_label", "in_scope_label", "valid", "in_scope", "p_wrong", "mining_p_wrong", "p_solvable", "reasons", "regions", "primary_region_index", "decision"]
    df = cut(records.checked_status(df, STATUSES), "teacher-records")  # the checks below read them several times
    updated = records.checked_overlay(results, df, "sample_id", columns, F.col("status").isin("accept", "review"), IMMUTABLE)
    extra = df.select(F.col("sample_id").alias("__s"), "main_decision", F.col("teacher_p_wrong").alias("teacher_error"))
    return updated.join(extra, F.col("sample_id") == F.col("__s"), "left").drop("__s")


# --- segments


def segments_of(results: DataFrame, run_hash: str) -> DataFrame:
    """Segments with a hard centre, of three frames at least, with their ids and output folders."""
    d = results.select("video_id", F.col("frame_indices")[0].alias("start"), F.col("frame_indices")[2].alias("end"), "status", "sample_id", F.array("sample_id").alias("sample_ids"), "reasons")
    merged = intervals.merge_classified(intervals.checked(d), min_length=3, provenance=("sample_ids", "reasons"))
    kept = intervals.with_hard_centre(merged, d.where(F.col("status").isin(*intervals.HARD)))
    named = kept.withColumn("segment_id", intervals.segment_id(run_hash, F.col("video_id"), F.col("start"), F.col("end")))
    parent, key = F.substring_index("video_id", "::", 1), F.expr("substring(video_id, instr(video_id, '::') + 2)")
    leaf = F.format_string("segment_%08d_%08d_%s", "start", "end", F.substring("segment_id", 1, 8))
    return named.withColumn("output_directory", F.concat_ws("/", F.when(parent != ".", parent), F.when(key == "", "video").otherwise(key), leaf))


def annotated(results: DataFrame, segments: DataFrame) -> DataFrame:
    """Results with covered_by_segment, contributed_to_segment, selected and the ids of their segments."""
    flat = results.withColumns({"start": F.col("frame_indices")[0], "end": F.col("frame_indices")[2]})
    found = intervals.match_records(flat, segments)
    ids = segments.select(F.col("video_id").alias("__v"), F.col("start").alias("__s"), "segment_id", "output_directory")
    found = found.join(ids, (F.col("video_id") == F.col("__v")) & (F.col("segment_start") == F.col("__s")), "left")
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))
    return found.withColumns({"segment_ids": one("segment_id"), "segment_output_directories": one("output_directory")}).drop("__v", "__s", "segment_id", "output_directory", "start", "end", "segment_start", "segment_end")


def output_plan(segments: DataFrame, index: DataFrame, layout: str) -> DataFrame:
    """(source, destination) of every frame to publish; the job fails where two sources meet in one destination."""
    frames = index.select("video_id", F.explode(F.array("img0", "gt", "img1")).alias("f")).select("video_id", F.col("f.frame_index").cast("long").alias("frame_index"), F.struct(F.col("f.path").alias("source"), F.col("f.relative_path").alias("relative_path")).alias("path"))
    frames = records.unique_paths(frames).select("video_id", "frame_index", "path.source", "path.relative_path")
    met = intervals.segment_frames(segments.select("video_id", "start", "end", "output_directory"), frames.select("video_id", "frame_index"))
    met = met.join(frames, ["video_id", "frame_index"])
    name = F.substring_index("relative_path", "/", -1)
    where = {"segment_relative": F.concat_ws("/", "output_directory", name), "preserve_relative": F.col("relative_path"), "flat": name}[layout]
    plan = met.select("source", where.alias("destination")).distinct()
    fail = F.raise_error(F.concat(F.lit("two sources for "), F.col("destination"))).cast("boolean")
    per = plan.groupBy("destination").agg(F.min("source").alias("source"), F.count("*").alias("__n"))
    return per.withColumn("__ok", F.when(F.col("__n") > 1, fail).otherwise(True)).where("__ok").select("source", "destination")


def without_triplets(spark: SparkSession, root: str, segments: DataFrame, config: Config) -> DataFrame:
    """Segments whose published folder, scanned again, holds no triplet to train on."""
    d = config.data
    frames = scan_frames(spark, root, pattern=d.frame_regex, digits=d.frame_digits, allowed=d.extensions)
    found = tr.triplets(frames, stride=d.stride).select(F.substring_index("video_id", "::", 1).alias("__d")).distinct()
    return segments.join(found, F.col("output_directory") == F.col("__d"), "left_anti")


def _drawn(config: Config) -> Callable:
    predict, width = predictor(config.model), config.output.visualization_width

    def one(three: list, made: dict, boxes) -> dict:
        from ..sources.sinks import png_bytes

        regions = [tuple(int(v) for v in b) for b in (boxes if boxes is not None else [])]
        return {"png": png_bytes(kernels.diagnostic_grid(*three[:2], made["prediction"], three[2], made, regions, width))}

    return _predicted(predict, one, {"png": None})


def diagnostic_images(spark: SparkSession, selected: DataFrame, config: Config) -> DataFrame:
    """(sample_id, png) of selected results."""
    wanted = selected.withColumn("boxes", boxes("regions"))
    return run_triplets(spark, wanted, partial(_drawn, config), "png binary", config, payload="boxes")


def execution_snapshot(index: DataFrame, config: Config) -> dict:
    """What a run's results depend on, and the id made from it: configuration, index, checkpoints, the engine's source."""
    import hashlib
    import json
    from pathlib import Path

    def file_digest(path: str | None) -> dict | None:
        if path is None:
            return None
        with open(path, "rb") as f:
            return {"path": path, "sha256": hashlib.file_digest(f, "sha256").hexdigest()}

    package = Path(__file__).parents[1]
    source = hashlib.sha256()
    parts = [package, *(package / name for name in ("functions", "operators", "plans", "sources", "streaming"))]
    for file in sorted(p for folder in parts for p in folder.glob("*.py")):
        source.update(file.relative_to(package).as_posix().encode() + b"\0" + file.read_bytes())
    out = {"schema_version": 1, "config_hash": config.run_hash(), "index": index_digest(index), "source": source.hexdigest(), "model": file_digest(config.model.checkpoint), "teacher": file_digest(config.teacher.checkpoint) if config.teacher else None}
    return out | {"execution_id": hashlib.sha256(json.dumps(out, sort_keys=True).encode()).hexdigest()[:24]}


def boxes(regions) -> Column:
    """The boxes of a region array; boxes that don't have four numbers are passed over."""
    return F.filter(F.transform(regions, lambda r: r["box"]), lambda b: b.isNotNull() & (F.size(b) == 4))


def summary(results: DataFrame, segments: DataFrame, plan: DataFrame) -> dict[str, int]:
    """Counts of a finished run."""
    counts = results.agg(F.count("*").alias("records"), F.count_if("selected").alias("selected")).first()
    return {"records": counts[0], "selected": counts[1], "segments": segments.count(), "frames": plan.count()}


__all__ = ["annotated", "build_index", "changed_frames", "diagnosed", "diagnostic_images", "execution_snapshot", "in_waves", "index_digest", "judged", "mine", "output_plan", "run_triplets", "segments_of", "summary", "teach", "without_triplets"]
