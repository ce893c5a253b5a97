"""Record sets: canonical JSON, unions with conflict detection, overlays, coverage, ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..scratch import cut

#: Columns that can name a record, in order of precedence.
IDENTITIES = ("sample_id", "segment_id", "task_id")


def comparable(kind) -> bool:
    """Whether values of a type can be ordered (maps and what holds them cannot)."""
    if isinstance(kind, StructType):
        return all(comparable(f.dataType) for f in kind.fields)
    return comparable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, MapType)


def canonical_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """JSON of a row with its fields and map keys in alphabetical order at every level, nulls kept.

    Maps whose values hold maps keep their order. Floats are written Java's way, so hash only integers and strings across systems.
    """

    def ordered(column: Column, kind) -> Column:
        if isinstance(kind, StructType):
            return F.when(column.isNotNull(), F.struct(*[ordered(column[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]))
        if isinstance(kind, ArrayType):
            return F.transform(column, lambda x: ordered(x, kind.elementType))
        if isinstance(kind, MapType):
            entries = F.array_sort(F.transform(F.map_keys(column), lambda k: F.struct(k.cast("string").alias("key"), ordered(F.element_at(column, k), kind.valueType).alias("value")))) if comparable(kind.valueType) else None
            return F.map_from_entries(entries) if entries is not None else column
        return column

    names = sorted(columns or df.columns)
    return F.to_json(F.struct(*[ordered(F.col(n), df.schema[n].dataType).alias(n) for n in names]), {"ignoreNullFields": "false"})


def identity(df: DataFrame) -> Column:
    """``field:value`` of the first identity field that is set, else null."""
    found = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in IDENTITIES if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def conflicts(df: DataFrame, key: Column) -> DataFrame:
    """(identity, versions) of identities with more than one distinct record."""
    return df.select(key.alias("identity"), canonical_json(df).alias("__json")).where("identity IS NOT NULL").groupBy("identity").agg(F.count_distinct("__json").alias("versions")).where("versions > 1")


def union_records(parts: list[DataFrame], key: Column | None = None) -> DataFrame:
    """The union of parts with one row per identity; the job fails where an identity has two different records.

    Rows without an identity are kept, repeats included. One shuffle by identity decides both.
    """
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    named = df.withColumn("__id", identity(df) if key is None else key).withColumn("__json", canonical_json(df))
    w = W.partitionBy("__id")
    known = named.where("__id IS NOT NULL").withColumn("__rank", F.row_number().over(w.orderBy("__json"))).withColumn("__same", F.min("__json").over(w) == F.max("__json").over(w))
    fail = F.raise_error(F.concat(F.lit("conflicting records for "), F.col("__id"))).cast("boolean")
    known = known.where("__rank = 1").withColumn("__ok", F.when(F.col("__same"), True).otherwise(fail)).where("__ok")
    return known.select(df.columns).unionByName(named.where("__id IS NULL").select(df.columns))


def sort_records(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows by the fields, nulls first, ties by canonical JSON."""
    return df.withColumn("__json", canonical_json(df)).orderBy(*[F.col(f).asc_nulls_first() for f in fields], "__json").drop("__json")


def _ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows, dealt by ranges of the order and written, with their range's number ``__p``."""
    spark = df.sparkSession
    return cut(df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("__p", F.spark_partition_id()), "ranges")


def _offset(totals: list[tuple[int, int]]) -> Column:
    """For a range's number: the sum of the ranges before it; the driver sees one number per range."""
    upto, at = [], 0
    for p, n in sorted(totals):
        upto += [F.lit(p), F.lit(at)]
        at += n
    return F.element_at(F.create_map(*upto), F.col("__p")).cast("long") if upto else F.lit(0).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Adds each row's place from 1 in a global order: places inside ranges plus the ranges before; no task holds all rows."""
    rows = _ranges(df, order).withColumn(name, F.row_number().over(W.partitionBy("__p").orderBy(*order)).cast("long"))
    counts = [(r["__p"], r["count"]) for r in rows.groupBy("__p").count().collect()]
    return rows.withColumn(name, F.col(name) + _offset(counts)).drop("__p")


def running_before(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds the sum of a whole-numbered column over the rows before each in a global order, range by range."""
    window = W.partitionBy("__p").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = _ranges(df, order)
    sums = [(r["__p"], r["s"] or 0) for r in rows.groupBy("__p").agg(F.sum(value).alias("s")).collect()]
    return rows.withColumn(name, F.coalesce(F.sum(value).over(window), F.lit(0)) + _offset(sums)).drop("__p")


def checked_order(df: DataFrame, position: str, *fields: str) -> DataFrame:
    """The rows; fails where the fields decrease along ``position``. Ranges of positions are checked by themselves, then their borders."""
    key = F.struct(*fields)
    rows = _ranges(df, [F.col(position)])
    before = F.lag(key).over(W.partitionBy("__p").orderBy(position))
    wrong = rows.withColumn("__bad", before > key).where("__bad").select(position).limit(1).collect()
    edges = rows.groupBy("__p").agg(F.min_by(key, position).alias("a"), F.max_by(key, position).alias("b"), F.min(position).alias("at"))
    one, two = edges.alias("x"), edges.alias("y")
    later = [r["__p"] for r in edges.select("__p").orderBy("__p").collect()]
    pairs = df.sparkSession.createDataFrame(list(zip(later, later[1:], strict=False)), "p int, q int")
    across = pairs.join(one, F.col("p") == F.col("x.__p")).join(two, F.col("q") == F.col("y.__p")).where(F.col("x.b") > F.col("y.a")).select("y.at").limit(1).collect()
    if found := wrong or across:
        raise ValueError(f"not sorted at {found[0][0]}")
    return rows.drop("__p")


def checked_status(df: DataFrame, allowed: tuple[str, ...], column: str = "status") -> DataFrame:
    """The rows; the job fails at a null status or one that isn't allowed."""
    fail = F.raise_error(F.concat(F.lit("status not allowed: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))).cast("boolean")
    return df.withColumn("__ok", F.when(F.coalesce(F.col(column).isin(*allowed), F.lit(False)), True).otherwise(fail)).where("__ok").drop("__ok")


def fold_order(column: str) -> list[Column]:
    """The order of names without regard to case, ties by the names themselves."""
    return [F.lower(column).asc_nulls_first(), F.col(column).asc_nulls_first()]


def checked_run(df: DataFrame, **expected) -> DataFrame:
    """The rows; the job fails at one that belongs to another run: whose run_hash, stage or execution_id differs."""
    out = df
    for name, value in expected.items():
        fail = F.raise_error(F.concat(F.lit(f"{name} of another run: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("boolean")
        out = out.withColumn("__ok", F.when(F.col(name).eqNullSafe(F.lit(value)), True).otherwise(fail)).where("__ok").drop("__ok")
    return out


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The inner join on a key that both sides hold exactly once and alike; ValueError otherwise."""
    problems = (
        duplicates(left, key).unionByName(duplicates(right, key)).select(F.concat(F.lit("repeated "), F.col(key).cast("string")).alias("p"))
        .unionAll(missing(left, right, key).unionByName(missing(right, left, key)).select(F.concat(F.lit("unmatched "), F.col(key).cast("string")).alias("p")))
    )
    if found := problems.limit(5).collect():
        raise ValueError("; ".join(r["p"] for r in found))
    return left.join(right, key)


def bound(tasks: DataFrame, samples: DataFrame, task: str = "task_id", key: str = "sample_id") -> DataFrame:
    """(task, sample) of tasks with an array ``sample_ids``: every sample is in exactly one task, and no other is; else ValueError."""
    pairs = tasks.select(task, F.explode("sample_ids").alias(key))
    return one_to_one(pairs, samples.select(key), key).select(task, key)


def unique_paths(frames: DataFrame, path: str = "path") -> DataFrame:
    """(video_id, frame_index, path) once per frame; the job fails where a frame has two paths."""
    per = frames.groupBy("video_id", "frame_index").agg(F.min(path).alias(path), F.max(path).alias("__other"))
    fail = F.raise_error(F.concat(F.lit("two paths for a frame: "), F.col(path).cast("string"), F.lit(", "), F.col("__other").cast("string"))).cast("boolean")
    return per.withColumn("__ok", F.when(F.col(path) == F.col("__other"), True).otherwise(fail)).where("__ok").drop("__ok", "__other")


def overlay(main: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """All rows of ``main`` with ``columns`` taken from ``updates`` where these have the key."""
    renamed = updates.select(F.col(key).alias("__k"), F.struct(*columns).alias("__u"))
    met = main.join(renamed, F.col(key) == F.col("__k"), "left")
    return met.withColumns({c: F.when(F.col("__k").isNotNull(), F.col(f"__u.{c}")).otherwise(F.col(c)) for c in columns}).drop("__k", "__u")


def checked_overlay(main: DataFrame, updates: DataFrame, key: str, columns: list[str], candidates: Column, immutable: tuple[str, ...] = ()) -> DataFrame:
    """Overlay that fails unless the updates are exactly the candidates, once each, with immutable fields unchanged."""
    problems = (
        duplicates(main, key).select(F.concat(F.lit("duplicate record "), F.col(key).cast("string")).alias("p"))
        .unionAll(duplicates(updates, key).select(F.concat(F.lit("duplicate update "), F.col(key).cast("string")).alias("p")))
        .unionAll(missing(main.where(candidates), updates, key).select(F.concat(F.lit("no update for "), F.col(key).cast("string")).alias("p")))
        .unionAll(missing(updates, main.where(candidates), key).select(F.concat(F.lit("unexpected update "), F.col(key).cast("string")).alias("p")))
    )
    for c in immutable:
        other = updates.select(F.col(key).alias("__k"), F.col(c).alias("__c"))
        changed = main.join(other, F.col(key) == F.col("__k")).where(~F.col(c).eqNullSafe(F.col("__c")))
        problems = problems.unionAll(changed.select(F.concat(F.lit(f"changed {c} of "), F.col(key).cast("string")).alias("p")))
    if found := problems.limit(5).collect():
        raise ValueError("; ".join(r["p"] for r in found))
    return overlay(main, updates, key, columns)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def missing(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys of ``expected`` that ``actual`` lacks."""
    return expected.select(key).distinct().join(actual.select(F.col(key).alias("__k")), F.col(key).eqNullSafe(F.col("__k")), "left_anti")


def status_counts(df: DataFrame, domain: list[str], column: str = "status") -> DataFrame:
    """A row per status of the domain, with 0 for those that don't occur."""
    all_of = df.sparkSession.createDataFrame([(s,) for s in domain], f"{column} string")
    return all_of.join(df.groupBy(F.col(column).alias("__s")).agg(F.count("*").alias("__n")), F.col(column) == F.col("__s"), "left").select(column, F.coalesce("__n", F.lit(0)).alias("n"))
