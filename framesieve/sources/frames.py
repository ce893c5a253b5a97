"""Sources: frame files, images, JSON lines, resource manifests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.triplets import checked_unique, parse_frame_name, video_id
from ..scratch import filesystem

EXTENSIONS = (".png", ".jpg", ".jpeg")
#: Folders that hold the engine's own output.
OUTPUT_DIRS = ("extremely_hard_case", "extremely_hard_case_visualization")


def extensions(names: tuple[str, ...]) -> tuple[str, ...]:
    """Lower case, with a dot; ValueError for none."""
    out = tuple(dict.fromkeys("." + n.strip().lower().lstrip(".") for n in names if n.strip(" .")))
    if not out:
        raise ValueError("at least one extension is needed")
    return out


def relative_path(path: Column, root: str) -> Column:
    """Path below the root, with slashes."""
    plain = F.regexp_replace(path, r"^[a-z][a-z0-9+.-]*:(//)?(?=/)", "")
    base = root.split(":", 1)[-1] if "://" in root or root.startswith("file:") else root
    return F.regexp_replace(plain, "^/*" + "".join(f"\\{c}" if not c.isalnum() and c != "/" else c for c in base.strip("/")) + "/+", "")


def excluded(relative: Column, names: tuple[str, ...], hidden: bool = True) -> Column:
    """Whether a folder on the way has an excluded name, lies below an excluded path of the root, or starts with a dot."""
    folders = F.slice(F.split(relative, "/"), 1, F.greatest(F.size(F.split(relative, "/")) - 1, F.lit(0)))
    single = [n for n in names if "/" not in n]
    out = F.exists(folders, lambda d: d.isin(*single)) if single else F.lit(False)
    for n in names:
        if "/" in n:
            out = out | F.startswith(relative, F.lit(n.strip("/") + "/"))
    return out | F.exists(folders, lambda d: F.startswith(d, F.lit("."))) if hidden else out


def below_root(names: tuple[str, ...], root: str) -> tuple[str, ...]:
    """Excluded names and paths as names and paths below the root: absolute paths lose it, those outside it are dropped."""
    plain = lambda p: "/" + re.sub(r"^[a-z][a-z0-9+.-]*:(//)?(?=/)", "", p).strip("/")
    base = plain(root)
    kept = []
    for name in names:
        if not plain(name).startswith(base + "/") and not name.startswith("/") and "://" not in name:
            kept.append(name)
        elif plain(name).startswith(base + "/"):
            kept.append(plain(name)[len(base) + 1 :] + "/")
    return tuple(kept)


def named_frames(files: DataFrame, root: str, *, pattern: str | None = None, digits: int | None = None, allowed: tuple[str, ...] = EXTENSIONS, exclude: tuple[str, ...] = (), hidden: bool = True) -> DataFrame:
    """The rows of ``files`` whose ``path`` parses as a frame below the root, with video_id, frame_index and relative_path."""
    files = files.withColumn("relative_path", relative_path(F.col("path"), root))
    name = F.substring_index("relative_path", "/", -1)
    extension = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    files = files.where(extension.isin(*extensions(allowed)) & ~excluded(F.col("relative_path"), (*OUTPUT_DIRS, *below_root(exclude, root)), hidden))
    parsed = parse_frame_name(name, pattern=pattern, digits=digits)
    parent = F.when(F.instr("relative_path", "/") > 0, F.regexp_replace("relative_path", "/[^/]*$", "")).otherwise(".")
    files = files.withColumn("__parsed", parsed).where("__parsed IS NOT NULL")
    return files.withColumns({"video_id": video_id(parent, F.col("__parsed.video_key")), "frame_index": F.col("__parsed.frame_index")}).drop("__parsed")


def pruned_roots(spark: SparkSession, root: str, exclude: tuple[str, ...] = (), hidden: bool = True) -> list[str]:
    """What to list of a root: its entries without the excluded folders right below it, which are never listed."""
    fs, hadoop = filesystem(spark, root)
    entries = [(x.getPath().getName(), x.isDirectory(), x.getPath().toString()) for x in fs.listStatus(hadoop)]
    dropped = {n.strip("/") for n in (*OUTPUT_DIRS, *below_root(exclude, root))}
    out = lambda name, folder: folder and (name in dropped or hidden and name.startswith("."))
    if not any(out(name, folder) for name, folder, _ in entries):
        return [root]
    return [path for name, folder, path in entries if not out(name, folder) and (folder or not name.startswith("."))]


def scan_frames(spark: SparkSession, root: str, *, pattern: str | None = None, digits: int | None = None, allowed: tuple[str, ...] = EXTENSIONS, exclude: tuple[str, ...] = (), hidden: bool = True, recursive: bool = True) -> DataFrame:
    """(video_id, frame_index, path, relative_path, size, modified) of every file that parses as a frame.

    Only listings are read, never contents; excluded folders below the root itself are not even listed. Names that don't
    parse are passed over, as are those that begin with an underscore, which Spark takes for its own; a repeated frame of
    a video fails.
    """
    found = pruned_roots(spark, root, exclude, hidden) if recursive else [root]
    if not found:
        return spark.createDataFrame([], "video_id string, frame_index int, path string, relative_path string, size long, modified timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(found).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    frames = named_frames(files, root, pattern=pattern, digits=digits, allowed=allowed, exclude=exclude, hidden=hidden)
    return checked_unique(frames.select("video_id", "frame_index", "path", "relative_path", "size", "modified"))


def read_images(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, height, width, rgb): decoded by the JVM, channels in RGB order; unreadable files have height -1 and no rgb."""
    image = spark.read.format("image").option("dropInvalid", False).load(paths).select("image.*")
    return image.select(F.col("origin").alias("path"), "height", "width", "nChannels", F.when(F.col("height") > 0, F.col("data")).alias("bgr"))


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines of a known schema; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


RESOURCE_SCHEMA = "path string, name string, kind string, source string, version string, license string, size long, sha256 string"


def verify_resources(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, problem) of every resource that is missing or differs in size or hash; ``files``: path, size, sha256."""
    f = files.select(F.col("path").alias("__p"), F.col("size").alias("__size"), F.col("sha256").alias("__sha"))
    problem = F.when(F.col("__p").isNull(), "missing").when(F.col("size") != F.col("__size"), "size").when(F.lower("sha256") != F.lower("__sha"), "hash")
    return manifest.join(f, F.col("path") == F.col("__p"), "left").select("path", problem.alias("problem")).where("problem IS NOT NULL")


def upsert_resources(manifest: DataFrame, new: DataFrame) -> DataFrame:
    """The manifest with the records of ``new`` in place of those of the same path, sorted by path."""
    both = manifest.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    rank = F.row_number().over(W.partitionBy("path").orderBy(F.col("__new").desc()))
    return both.withColumn("__rank", rank).where("__rank = 1").drop("__rank", "__new").orderBy("path")


def bad_resources(manifest: DataFrame) -> DataFrame:
    """(path, problem) of records that break the manifest's rules: eight fields, a lower-case SHA-256, unique safe paths."""
    n = F.count("*").over(W.partitionBy("path"))
    empty = [F.col(c).isNull() for c in ("path", "name", "kind", "source", "version", "license", "size", "sha256")]
    any_empty = empty[0]
    for e in empty[1:]:
        any_empty = any_empty | e
    unsafe = F.startswith("path", F.lit("/")) | F.array_contains(F.split("path", "/"), "..")
    problem = F.when(any_empty, "field missing").when(~F.col("sha256").rlike("^[0-9a-f]{64}$"), "sha256").when(unsafe, "unsafe path").when(n > 1, "repeated path")
    return manifest.withColumn("problem", problem).where("problem IS NOT NULL").select("path", "problem")


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, sha256) of all files below a root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(relative_path(F.col("path"), root).alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
