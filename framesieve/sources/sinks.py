"""Sinks: sorted JSON lines, PNG files, linked or copied frames, and all-or-nothing publication."""

from __future__ import annotations

import json
import os
import shutil
import struct
import tempfile
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.records import canonical_json, sort_records


class OutputCollision(RuntimeError):
    """A destination exists with other content, or is not ours."""


def atomic_bytes(path: str | Path, data: bytes) -> None:
    """The file appears whole or not at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, aside = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(aside, path)
    finally:
        Path(aside).unlink(missing_ok=True)


def atomic_json(path: str | Path, payload) -> None:
    atomic_bytes(path, (json.dumps(payload, ensure_ascii=False, sort_keys=True, indent=2, allow_nan=False) + "\n").encode())


def write_jsonl(df: DataFrame, folder: str, fields: list[str]) -> None:
    """Canonical JSON lines in a global order, as numbered part files that concatenate to it."""
    ordered = sort_records(df, fields)
    ordered.select(canonical_json(df).alias("value")).write.mode("overwrite").text(folder)


def jsonl_file(df: DataFrame, path: str | Path, fields: list[str]) -> int:
    """One sorted JSON lines file, streamed through the driver a partition at a time; returns its lines."""
    path, n = Path(path), 0
    path.parent.mkdir(parents=True, exist_ok=True)
    aside = path.with_name(f".{path.name}.new")
    with aside.open("w", encoding="utf-8", newline="\n") as f:
        for row in sort_records(df, fields).select(canonical_json(df)).toLocalIterator():
            f.write(row[0] + "\n")
            n += 1
        f.flush()
        os.fsync(f.fileno())
    os.replace(aside, path)
    return n


def png_bytes(image: np.ndarray) -> bytes:
    """PNG of an HxWx3 or HxW image, floats in [0, 1] or uint8."""
    a = np.asarray(image)
    if a.dtype != np.uint8:
        a = np.rint(np.clip(a, 0, 1) * 255).astype(np.uint8)
    a = np.repeat(a[..., None], 3, axis=-1) if a.ndim == 2 else a[..., :3]
    h, w = a.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), a.reshape(h, -1)], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def write_png(path: str | Path, image: np.ndarray) -> None:
    atomic_bytes(path, png_bytes(image))


def link_or_copy(source: str | Path, destination: str | Path, mode: str = "hardlink_then_copy") -> str:
    """``existing``, ``hardlink`` or ``copy``; OutputCollision where other content is in the way."""
    source, destination = Path(source), Path(destination)
    if mode not in ("hardlink_then_copy", "copy"):
        raise ValueError("mode must be hardlink_then_copy or copy")
    if destination.exists():
        same = destination.stat().st_size == source.stat().st_size and destination.read_bytes() == source.read_bytes()
        if not same:
            raise OutputCollision(f"{destination} exists with other content")
        return "existing"
    destination.parent.mkdir(parents=True, exist_ok=True)
    if mode == "hardlink_then_copy":
        try:
            os.link(source, destination)
            return "hardlink"
        except OSError:  # another device, or links not allowed
            pass
    shutil.copy2(source, destination)
    return "copy"


def safe_path(root: str | Path, relative: str) -> Path:
    """A path below the root; ValueError for absolute ones and those that leave it."""
    p = Path(relative)
    if p.is_absolute() or ".." in p.parts or not p.parts:
        raise ValueError(f"unsafe path {relative!r}")
    return Path(root) / p


def materialise(plan: DataFrame, root: str, mode: str = "hardlink_then_copy") -> dict[str, int]:
    """Puts every (source, destination) of a plan below a root that all nodes share; counts of the methods used."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            used = Counter(link_or_copy(s.removeprefix("file:").replace("//", "/"), safe_path(root, d), mode) for s, d in zip(batch["source"], batch["destination"], strict=True))
            yield pd.DataFrame(sorted(used.items()), columns=["method", "n"])

    done = plan.select("source", "destination").mapInPandas(run, "method string, n long")
    return {r["method"]: r["n"] for r in done.groupBy("method").agg(F.sum("n").alias("n")).collect()}


def write_files(rows: DataFrame, root: str, name: str = "sample_id", data: str = "png", ending: str = ".png") -> int:
    """Writes a binary column to one file per row below a root that all nodes share; null data is passed over."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            kept = [(n, d) for n, d in zip(batch[name], batch[data], strict=True) if d is not None]
            for n, d in kept:
                atomic_bytes(safe_path(root, f"{n}{ending}"), bytes(d))
            yield pd.DataFrame({"n": [len(kept)]})

    return int(rows.select(name, data).mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0)


MARKER = ".framesieve-output.json"


def publish(root: str | Path, staged: dict[str, Path], payload: dict) -> None:
    """Moves staged folders and files to their names below the root, all or none, and points CURRENT at them.

    What was there is kept aside until everything is in place and put back if anything fails. Folders that hold no marker
    of ours are left alone.
    """
    root = Path(root)
    root.mkdir(parents=True, exist_ok=True)
    lock = root / ".publish.lock"
    handle = _locked(lock)
    moved: list[tuple[Path, Path | None]] = []
    try:
        for name, source in staged.items():
            target = safe_path(root, name)
            if target.is_dir() and any(target.iterdir()) and not (target / MARKER).exists():
                raise OutputCollision(f"{target} holds files that are not ours")
            if source.is_dir():
                atomic_json(source / MARKER, payload)
            aside = None
            if target.exists():
                aside = target.with_name(f".{target.name}.old")
                _remove(aside)
                os.replace(target, aside)
            moved.append((target, aside))
            target.parent.mkdir(parents=True, exist_ok=True)
            os.replace(source, target)
        atomic_json(root / "CURRENT.json", payload)
    except BaseException:
        for target, aside in reversed(moved):
            _remove(target)
            if aside is not None:
                os.replace(aside, target)
        raise
    else:
        for _, aside in moved:
            if aside is not None:
                _remove(aside)
    finally:
        os.close(handle)
        lock.unlink(missing_ok=True)


def _locked(path: Path) -> int:
    """An exclusive lock file; one whose process is gone is taken over."""
    for _ in range(2):
        try:
            handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            os.write(handle, str(os.getpid()).encode())
            return handle
        except FileExistsError:
            try:
                os.kill(int(path.read_text() or "0"), 0)
            except (ProcessLookupError, ValueError):
                path.unlink(missing_ok=True)
                continue
            raise OutputCollision(f"{path} is held by another run") from None
    raise OutputCollision(f"{path} cannot be taken")


def _remove(path: Path) -> None:
    shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
