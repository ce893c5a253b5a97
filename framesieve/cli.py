"""Command line: index, mine, teacher, finalize, run, status, probe, verify-bundle, build-bundle."""

from __future__ import annotations

import argparse
import json
import shutil
import sys
import tarfile
from pathlib import Path

from pyspark.sql import functions as F

from . import __version__, config
from .operators import records
from .operators import triplets as tr
from .plans import mining
from .scratch import cut, filesystem
from .session import build_session
from .sources import frames, sinks


def _path(cfg: config.Config, name: str) -> str:
    """A path of the run: on the file system that ``run_dir`` names, or a full local path."""
    base = cfg.runtime.run_dir
    return f"{base.rstrip('/') if '://' in base else Path(base).resolve()}/{cfg.run_hash()}/{name}"


def _has(spark, path: str) -> bool:
    fs, hadoop = filesystem(spark, f"{path}/_SUCCESS")
    return fs.exists(hadoop)


def _wave(spark) -> int:
    """Chunks that are done, and committed, together: some for every core."""
    return max(64, 4 * spark.sparkContext.defaultParallelism)


def index(spark, cfg: config.Config) -> dict:
    """Freezes the index with its chunks; a second run checks that the frames are still the same."""
    path = _path(cfg, "index")
    if not _has(spark, path):
        found = cut(mining.build_index(spark, cfg), "index")
        size = tr.dynamic_chunk_size(found.count(), spark.sparkContext.defaultParallelism, cfg.runtime.chunk_triplets)
        first = F.col("frame_indices")[0].cast("long")
        chunked = tr.chunks(found.withColumn("first_frame", first), size, index="first_frame").drop("first_frame", "chunk_in_video")
        chunked.orderBy("video_id", first).write.mode("overwrite").parquet(path)
    found = spark.read.parquet(path)
    d = cfg.data
    fresh = frames.scan_frames(spark, d.root, pattern=d.frame_regex, digits=d.frame_digits, allowed=d.extensions, exclude=d.excluded_dirs, recursive=d.recursive)
    if changed := mining.changed_frames(found, fresh).limit(3).collect():
        raise ValueError("frames changed since they were indexed: " + ", ".join(r[0] for r in changed))
    return {"run_hash": cfg.run_hash(), "triplets": found.count(), "videos": found.select("video_id").distinct().count(), "digest": mining.index_digest(found)}


def mine(spark, cfg: config.Config) -> dict:
    """The main stage in waves of chunks; a run that stopped does only the waves that are missing."""
    index(spark, cfg)
    path = _path(cfg, "main")
    if not _has(spark, path):
        found = spark.read.parquet(_path(cfg, "index"))
        snapshot = mining.execution_snapshot(found, cfg)["execution_id"]
        make = lambda part: mining.mine(spark, part, cfg).withColumn("execution_id", F.lit(snapshot))
        mining.in_waves(found, _path(cfg, "main.parts"), make, wave=_wave(spark)).write.mode("overwrite").parquet(path)
    return status(spark, cfg)["main"]


def teacher(spark, cfg: config.Config) -> dict:
    if cfg.teacher is None:
        raise ValueError("no teacher is configured")
    mine(spark, cfg)
    path = _path(cfg, "teacher")
    if not _has(spark, path):
        results = spark.read.parquet(_path(cfg, "main"))
        chunks = spark.read.parquet(_path(cfg, "index")).select("sample_id", "chunk")
        wanted = mining.candidates(results).join(chunks, "sample_id")
        seen = mining.in_waves(wanted, _path(cfg, "teacher.parts"), lambda part: mining.judged(spark, part, cfg), wave=_wave(spark))
        mining.teach(spark, results, cfg, seen).write.mode("overwrite").parquet(path)
    return status(spark, cfg)["teacher"]


def finalize(spark, cfg: config.Config) -> dict:
    """Checks coverage, merges segments, and publishes frames, segments and manifest together."""
    stage = "teacher" if cfg.teacher is not None else "main"
    results, found = spark.read.parquet(_path(cfg, stage)), spark.read.parquet(_path(cfg, "index")).drop("chunk")
    for a, b, what in ((found, results, "missing"), (results, found, "unexpected")):
        if n := records.missing(a, b, "sample_id").count():
            raise ValueError(f"{n} {what} results")
    records.checked_status(results, mining.STATUSES).select("status").write.format("noop").mode("overwrite").save()
    if cfg.runtime.precision != "float32":
        raise ValueError("only float32 results are published")
    results = records.checked_run(results, run_hash=cfg.run_hash())
    segments = mining.segments_of(results, cfg.run_hash()).cache()
    plan = mining.output_plan(segments, found, cfg.output.layout)
    annotated = mining.annotated(results, segments)
    root = Path(cfg.data.root.removeprefix("file://"))
    staging = Path(_path(cfg, "staging"))
    shutil.rmtree(staging, ignore_errors=True)
    (staging / "frames").mkdir(parents=True)
    methods = sinks.materialise(plan, str(staging / "frames"), cfg.output.link_mode)
    if cfg.output.layout == "segment_relative" and (empty := mining.without_triplets(spark, str(staging / "frames"), segments, cfg).limit(3).collect()):
        raise ValueError("segments without a triplet: " + ", ".join(r["segment_id"] for r in empty))
    (staging / "images").mkdir()
    shown = annotated.where("selected" if not cfg.output.save_review else "selected OR (covered_by_segment AND status = 'review')").select("sample_id")
    drawn = sinks.write_files(mining.diagnostic_images(spark, results.join(shown, "sample_id", "left_semi"), cfg), str(staging / "images"))
    if drawn != shown.count():
        raise ValueError(f"{drawn} diagnostic images of {shown.count()}")
    sinks.jsonl_file(segments.drop("reasons"), staging / "segments.jsonl", ["video_id", "start"])
    n = sinks.jsonl_file(annotated.drop("scoring", "img0", "gt", "img1"), staging / "manifest.jsonl", ["video_id", "sample_id"])
    out = mining.summary(annotated, segments, plan) | {"methods": methods, "manifest_records": n, "images": drawn, **mining.execution_snapshot(found, cfg)}
    sinks.publish(root, {cfg.output.hard_case_dir: staging / "frames", cfg.output.visualization_dir: staging / "images", f"{cfg.output.manifest_name}.segments": staging / "segments.jsonl", cfg.output.manifest_name: staging / "manifest.jsonl"}, out)
    return out


def run(spark, cfg: config.Config) -> dict:
    return {"index": index(spark, cfg), "main": mine(spark, cfg), **({"teacher": teacher(spark, cfg)} if cfg.teacher else {}), "final": finalize(spark, cfg)}


def status(spark, cfg: config.Config) -> dict:
    return {s: {r["status"]: r["n"] for r in records.status_counts(spark.read.parquet(_path(cfg, s)), list(mining.STATUSES)).collect()} for s in ("main", "teacher") if _has(spark, _path(cfg, s))}


def probe(spark, _cfg=None) -> dict:
    return {"engine": __version__, "spark": spark.version, "python": sys.version.split()[0], "master": spark.sparkContext.master, "parallelism": spark.sparkContext.defaultParallelism}


def verify_bundle(spark, root: str) -> dict:
    """Compares the files below a root with its ``resources.jsonl``."""
    manifest = frames.read_jsonl(spark, f"{root}/resources.jsonl", frames.RESOURCE_SCHEMA)
    problems = frames.verify_resources(manifest, frames.file_inventory(spark, root)).collect()
    return {"resources": manifest.count(), "problems": {r["path"]: r["problem"] for r in problems}}


def build_bundle(spark, root: str, output: str) -> dict:
    """A tar.gz of a verified root with an inventory, read back before it gets its name."""
    if bad := verify_bundle(spark, root)["problems"]:
        raise ValueError(f"the bundle has problems: {bad}")
    listed = sorted((r["path"], r["size"], r["sha256"]) for r in frames.file_inventory(spark, root).where(F.col("path") != "inventory.json").collect())
    sinks.atomic_json(f"{root}/inventory.json", [dict(zip(("path", "size", "sha256"), x, strict=True)) for x in listed])
    aside = f"{output}.new"
    with tarfile.open(aside, "w:gz") as tar:
        for path, _, _ in [*listed, ("inventory.json", 0, "")]:
            tar.add(f"{root}/{path}", arcname=path)
    with tarfile.open(aside) as tar:
        sizes = {m.name: m.size for m in tar.getmembers()}
    if any(sizes.get(p) != s for p, s, _ in listed):
        raise ValueError("the archive differs from the inventory")
    Path(aside).replace(output)
    return {"files": len(listed), "archive": output}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="framesieve", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for f in (index, mine, teacher, finalize, run, status):
        commands.add_parser(f.__name__).add_argument("--config", required=True)
    commands.add_parser("probe")
    for name in ("verify-bundle", "build-bundle"):
        p = commands.add_parser(name)
        p.add_argument("--root", required=True)
        if name == "build-bundle":
            p.add_argument("--output", required=True)
    a = parser.parse_args(argv)
    try:
        spark = build_session(master=None)
        if a.command in ("verify-bundle", "build-bundle"):
            out = verify_bundle(spark, a.root) if a.command == "verify-bundle" else build_bundle(spark, a.root, a.output)
        else:
            out = globals()[a.command](spark, config.load(a.config) if a.command != "probe" else None)
    except (ValueError, OSError, RuntimeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    print(json.dumps(out, ensure_ascii=False, sort_keys=True, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
