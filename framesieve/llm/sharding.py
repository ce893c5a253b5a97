"""Sharding by size-tiered compaction: small immutable shards, merges of similar sizes, a versioned manifest."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import astuple, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import filesystem, remove

#: Up to so many shards (some 10 MB of names) their ids are broadcast to the rows; beyond, both are shuffled.
BROADCAST_SHARDS = 100_000
#: Small shards that one round of compaction plans on the driver; further rounds take the others.
PLANNED = 100_000
_LIST = "id string, path string, bytes long, tier int"


class CommitConflict(RuntimeError):
    """Another writer committed the version first; read the manifest again and retry."""


@dataclass(frozen=True)
class Shard:
    """One immutable parquet file."""

    id: str
    path: str
    bytes: int
    tier: int


@dataclass(frozen=True)
class Manifest:
    """A version: its rows' schema, and the Parquet lists of its full and of its small shards."""

    version: int
    schema: str
    full: tuple[str, ...]
    small: tuple[str, ...]


def tier_of(size: int, smallest: int, ratio: int) -> int:
    """0 for sizes up to ``smallest``, one more for each factor of ``ratio`` beyond."""
    return 0 if size <= smallest else math.ceil(math.log(size / smallest, ratio) - 1e-9)


def plan_merges(shards: list[Shard], *, target: int, fan_in: int) -> list[list[Shard]]:
    """Groups of shards of one tier to merge, each of about ``target`` bytes.

    Shards of at least half the target are done. A tier is due once it holds ``fan_in`` shards or half a target of
    bytes; its shards are packed in order into groups that end before they pass the target, and groups of one are left.
    """
    by_tier: dict[int, list[Shard]] = {}
    for s in shards:
        if 2 * s.bytes < target:
            by_tier.setdefault(s.tier, []).append(s)
    groups = []
    for _, members in sorted(by_tier.items()):
        if len(members) < fan_in and 2 * sum(s.bytes for s in members) < target:
            continue
        group: list[Shard] = []
        for s in sorted(members, key=lambda s: (s.bytes, s.id)):
            if group and sum(x.bytes for x in group) + s.bytes > target:
                groups.append(group)
                group = []
            group.append(s)
        groups.append(group)
    return [g for g in groups if len(g) > 1]


class ShardStore:
    """A table of shards under one folder of a file system that all nodes share.

    ``append`` adds an arrival, ``compact`` merges what is due, ``read`` gives the rows of a version. A version is a small
    JSON file that names Parquet lists of shards: those of full shards (half the target or more), which are never written
    again, and the one of small shards. Each change ends in one commit: the JSON file of the next number is written aside
    and put into place by an operation that fails if the name exists (a hard link on a local disk, a rename without
    overwriting elsewhere), so of two racing writers one wins and the other gets ``CommitConflict``. Object stores whose
    rename is a copy need a single writer.

    Files are never changed, and neither ``append`` nor ``compact`` removes any: a reader of an older version goes on
    reading until ``vacuum`` is called, which keeps the newest ``keep`` versions. Work that dies before its commit leaves
    files that no version names. Rows, nulls, empty and long texts, repeated rows and all columns are kept as they are; an
    empty arrival adds no shard.
    """

    def __init__(self, spark: SparkSession, root: str, *, target: int = 128 << 20, smallest: int = 1 << 20, ratio: int = 4, fan_in: int = 4, arrival_rows: int = 20_000):
        self.spark, self.root = spark, root.rstrip("/")
        self.target, self.smallest, self.ratio, self.fan_in, self.arrival_rows = target, smallest, ratio, fan_in, arrival_rows

    def _files(self, path: str, ending: str) -> list[tuple[str, int]]:
        fs, hadoop = filesystem(self.spark, path)
        if not fs.exists(hadoop):
            return []
        return sorted((x.getPath().toString(), x.getLen()) for x in fs.listStatus(hadoop) if x.getPath().getName().endswith(ending))

    def versions(self) -> dict[int, str]:
        """The file of every version that is kept."""
        return {int(p.rsplit("-", 1)[1].split(".")[0]): p for p, _ in self._files(f"{self.root}/manifests", ".json")}

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The given version, or the newest; None before the first commit. A version that vacuum removed is a KeyError."""
        found = self.versions()
        if not found:
            return None
        raw = json.loads(self.spark.read.text(found[max(found) if version is None else version], wholetext=True).first()[0])
        return Manifest(raw["version"], raw["schema"], tuple(raw["full"]), tuple(raw["small"]))

    def shards(self, manifest: Manifest, *, full: bool = True) -> DataFrame:
        """(id, path, bytes, tier) of a version's shards, or of its small ones only."""
        lists = [f"{self.root}/lists/{name}" for name in (*(manifest.full if full else ()), *manifest.small)]
        return self.spark.read.schema(_LIST).parquet(*lists) if lists else self.spark.createDataFrame([], _LIST)

    def _write_list(self, shards: DataFrame) -> tuple[str, ...]:
        name = uuid.uuid4().hex
        shards.write.parquet(f"{self.root}/lists/{name}")
        return (name,)

    def _put(self, aside: str, final: str) -> bool:
        """Gives the file ``aside`` its final name; False if that exists. Only one of any callers gets True."""
        jvm = self.spark._jvm
        fs, hadoop = filesystem(self.spark, aside)
        place = jvm.org.apache.hadoop.fs.Path(final)
        try:
            if fs.getScheme() == "file":
                local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(local(place), local(hadoop))
                fs.delete(hadoop, False)
            else:
                options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(hadoop.toUri(), self.spark._jsc.hadoopConfiguration()).rename(hadoop, place, options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            return False
        return True

    def _commit(self, base: Manifest | None, schema: str, full: tuple[str, ...], small: tuple[str, ...]) -> Manifest:
        new = Manifest((base.version if base else 0) + 1, schema, full, small)
        aside = f"{self.root}/manifests/_{uuid.uuid4().hex}"
        fs, hadoop = filesystem(self.spark, aside)
        out = fs.create(hadoop, False)
        out.write(bytearray(json.dumps({"version": new.version, "schema": schema, "full": full, "small": small}).encode()))
        out.close()
        if not self._put(aside, f"{self.root}/manifests/manifest-{new.version:08d}.json"):
            fs.delete(hadoop, False)
            raise CommitConflict(f"version {new.version} exists")
        return new

    def _written(self, folder: str, version: int) -> list[Shard]:
        return [Shard(f"{version:06d}-{i:06d}", path, size, tier_of(size, self.smallest, self.ratio)) for i, (path, size) in enumerate(self._files(folder, ".parquet"))]

    def _listed(self, shards: list[Shard]) -> DataFrame:
        return self.spark.createDataFrame([astuple(s) for s in shards], _LIST)

    def _advance(self, base: Manifest | None, schema: str, small: DataFrame | None, added: list[Shard]) -> Manifest:
        """Commits ``added`` beside the full shards of ``base`` and the given small ones."""
        full, rest = ([s for s in added if (2 * s.bytes >= self.target) == v] for v in (True, False))
        listed = self._listed(rest) if small is None else small.unionAll(self._listed(rest))
        kept = (base.full if base else ()) + (self._write_list(self._listed(full).coalesce(1)) if full else ())
        return self._commit(base, schema, kept, self._write_list(listed.coalesce(1)))

    def append(self, arrival: DataFrame) -> Manifest:
        """Writes the arrival as it is partitioned, in files of at most ``arrival_rows`` rows, and commits them."""
        base = self.manifest()
        version = (base.version if base else 0) + 1
        folder = f"{self.root}/data/{version:06d}-{uuid.uuid4().hex}"
        arrival.write.option("maxRecordsPerFile", self.arrival_rows).parquet(folder)
        added = self._written(folder, version)
        if self.spark.read.schema(arrival.schema).parquet(folder).isEmpty():
            added = []  # a file without rows only carries the schema
        return self._advance(base, arrival.schema.json(), self.shards(base, full=False) if base else None, added)

    def due(self, manifest: Manifest) -> list[list[Shard]]:
        """The groups that the next round of compaction merges; at most ``PLANNED`` small shards are looked at, smallest tiers first."""
        small = self.shards(manifest, full=False).orderBy("tier", "bytes", "id").limit(PLANNED)
        return plan_merges([Shard(**r.asDict()) for r in small.collect()], target=self.target, fan_in=self.fan_in)

    def compact(self, *, batch: int = 200) -> Manifest | None:
        """Merges what is due, one task and one file per group, until nothing is; each round is one commit.

        A task reads its group's files one after the other and writes them through: nothing is shuffled or held. The files
        of older versions stay.
        """
        while (base := self.manifest()) is not None:
            groups = self.due(base)
            if not groups:
                break
            version, schema = base.version + 1, StructType.fromJson(json.loads(base.schema))
            folder = f"{self.root}/data/{version:06d}-{uuid.uuid4().hex}"
            for at in range(0, len(groups), batch):
                merged = None
                for group in groups[at : at + batch]:
                    run = self.spark.read.schema(schema).parquet(*[s.path for s in group]).coalesce(1)
                    merged = run if merged is None else merged.unionAll(run)
                merged.write.mode("append").parquet(folder)
            gone = self.spark.createDataFrame([(s.id,) for group in groups for s in group], "gone string")
            left = self.shards(base, full=False).join(gone, F.col("id") == F.col("gone"), "left_anti")
            self._advance(base, base.schema, left, self._written(folder, version))
        return base

    def vacuum(self, keep: int = 10) -> int:
        """Removes all but the newest ``keep`` versions, and the shards and lists that only those name; returns their number."""
        found = sorted(self.versions())
        old, kept = ([self.manifest(v) for v in some] for some in (found[:-keep], found[-keep:]))
        if not old:
            return 0
        names = lambda some: {n for m in some for n in (*m.full, *m.small)}
        lists = names(old) - names(kept)
        live = self.shards(Manifest(0, "", tuple(names(kept)), ())).select(F.col("path").alias("live"))
        gone = self.shards(Manifest(0, "", tuple(lists), ())).select("path").distinct().join(live, F.col("path") == F.col("live"), "left_anti")
        paths = [r["path"] for r in gone.collect()]
        for m in old:  # first the versions, so that none is found without its files
            remove(self.spark, self.versions()[m.version])
        for path in [*paths, *(f"{self.root}/lists/{name}" for name in lists)]:
            remove(self.spark, path)
        return len(paths)

    def read(self, version: int | None = None, shard_column: str | None = None) -> DataFrame:
        """The rows of a version; with ``shard_column``, also the id of the shard that holds each row.

        The driver lists the version's files, some 100 bytes each. An existing column of that name is replaced.
        """
        found = self.manifest(version)
        if found is None:
            raise ValueError("nothing was committed yet")
        schema = StructType.fromJson(json.loads(found.schema))
        shards = self.shards(found)
        paths = [r["path"] for r in shards.select("path").collect()]
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(shard_column, F.lit(None).cast("string")) if shard_column else empty
        rows = self.spark.read.schema(schema).parquet(*paths)
        if not shard_column:
            return rows
        # file names carry a task's number and a write's own id, so they tell shards apart
        names = shards.select(F.substring_index("path", "/", -1).alias("__file"), F.col("id").alias("__shard"))
        names = F.broadcast(names) if len(paths) <= BROADCAST_SHARDS else names
        rows = rows.withColumn("__name", F.col("_metadata.file_name")).join(names, F.col("__name") == F.col("__file"), "left")
        return rows.withColumn(shard_column, F.col("__shard")).drop("__name", "__file", "__shard")
