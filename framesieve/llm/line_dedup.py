"""Line dedup by overlapping three-line windows; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut


def dedup_lines(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", window: int = 3) -> DataFrame:
    """Adds clean_text, n_lines and n_removed to every row of ``docs``.

    Lines are split at line feeds. Every run of ``window`` consecutive lines is hashed to 128 bits; the first occurrence
    of a hash, by (id, text, position), stays, and every later one covers its lines. Lines that any later occurrence
    covers are removed, except that an occurrence which overlaps the first one in the same document leaves the first
    one's lines. Documents with fewer lines than a window, and null or empty texts, stay as they are. A row is known by
    its (id, text): rows that repeat both are treated as one and share its outcome. Null ids come first. An empty table
    gives no rows.

    Only hashes and positions are shuffled to find repeats. First occurrences are combined before the shuffle, and the
    join that carries them back is one that Spark can split where a window is very frequent.
    """
    lines = F.split(F.col("__t"), "\n", -1)
    keyed = docs.select(F.col(id_column).alias("__id"), F.col(text).alias("__t")).where(F.col("__t").isNotNull())
    keyed = keyed.select("__id", F.xxhash64("__t").alias("__k"), lines.alias("__lines")).where(F.size("__lines") >= window)
    runs = F.transform(F.sequence(F.lit(1), F.size("__lines") - (window - 1)), lambda i: F.array_join(F.slice("__lines", i, window), "\n"))
    runs = keyed.select("__id", "__k", F.posexplode(runs).alias("pos", "run"))
    runs = runs.select("__id", "__k", "pos", F.xxhash64("run").alias("w1"), F.xxhash64(F.lit(1), "run").alias("w2")).distinct()
    runs = cut(runs, "line-windows")
    place = F.struct(F.col("__id").alias("i"), F.col("__k").alias("k"), F.col("pos").alias("p"))
    firsts = runs.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = cut(firsts, "line-firsts")
    runs = runs.select("__id", "__k", "pos", F.col("w1").alias("v1"), F.col("w2").alias("v2"))
    later = runs.join(firsts, (F.col("v1") == F.col("w1")) & (F.col("v2") == F.col("w2"))).where(place > F.col("first"))
    same = F.col("first.i").eqNullSafe(F.col("__id")) & (F.col("first.k") == F.col("__k"))
    begin = F.when(same, F.greatest(F.col("pos"), F.col("first.p") + window)).otherwise(F.col("pos"))
    spans = later.select("__id", "__k", begin.alias("a"), (F.col("pos") + window).alias("b")).where("a < b")
    # touching spans of a document are merged by a running maximum; one shuffle by document serves all three steps
    order = W.partitionBy("__id", "__k").orderBy("a", "b")
    opens = F.when(F.col("a") <= F.max("b").over(order.rowsBetween(W.unboundedPreceding, -1)), 0).otherwise(1)
    spans = spans.withColumn("open", opens).withColumn("run", F.sum("open").over(order.rowsBetween(W.unboundedPreceding, 0)))
    spans = spans.groupBy("__id", "__k", "run").agg(F.struct(F.min("a").alias("a"), F.max("b").alias("b")).alias("span"))
    covered = spans.groupBy("__id", "__k").agg(F.array_sort(F.collect_list("span")).alias("__spans"))
    covered = covered.select(F.col("__id").alias("__cid"), F.col("__k").alias("__ck"), "__spans")
    left = docs.withColumn("__k", F.xxhash64(text))
    joined = left.join(covered, F.col(id_column).eqNullSafe(F.col("__cid")) & (F.col("__k") == F.col("__ck")) & F.col(text).isNotNull(), "left")
    all_lines = F.split(F.col(text), "\n", -1)
    gone = F.aggregate("__spans", F.lit(0), lambda n, s: n + s["b"] - s["a"])
    # pieces between the spans: slices, so that each line is touched once
    edges = F.transform(F.sequence(F.lit(0), F.size("__spans")), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.get("__spans", i - 1)["b"]).alias("a"),
        F.when(i == F.size("__spans"), F.size(all_lines)).otherwise(F.get("__spans", i)["a"]).alias("b"),
    ))
    pieces = F.flatten(F.transform(edges, lambda e: F.slice(F.col("__all"), e["a"] + 1, e["b"] - e["a"])))
    joined = joined.withColumn("__all", all_lines)
    touched = F.col("__spans").isNotNull()
    out = joined.withColumns({
        "clean_text": F.when(touched, F.array_join(pieces, "\n")).otherwise(F.col(text)),
        "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size("__all")),
        "n_removed": F.when(touched, gone).otherwise(0),
    })
    return out.drop("__k", "__cid", "__ck", "__spans", "__all")

