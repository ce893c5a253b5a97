"""Mixing sources to target weights by weighted fair queueing; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, n_words

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (3, 1, 2)


def source_ranks(sources: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0, in code-point order of ``source``, null last.

    Sources may be hosts, millions of them: they are sorted by ranges, and a range's rows are numbered from the sum of the
    ranges before it; the driver sees one number per range.
    """
    spark = sources.sparkSession
    key = F.col("source").asc_nulls_last()
    ranges = sources.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), key).withColumn("p", F.spark_partition_id())
    numbered = cut(ranges.withColumn("nth", F.row_number().over(W.partitionBy("p").orderBy(key)) - 1), "mix-ranks")
    upto, at = {}, 0
    for r in numbered.groupBy("p").count().orderBy("p").collect():
        upto[r["p"]], at = at, at + r["count"]
    earlier = F.element_at(F.create_map(*[F.lit(v).cast("long") for pair in upto.items() for v in pair]), F.col("p").cast("long")) if upto else F.lit(0)
    return numbered.withColumn("rank", F.col("nth") + earlier).drop("p", "nth")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, repeat: int = 2) -> DataFrame:
    """(source, source_size, n_docs, target): ``share`` of all words dealt by weight, capped at ``repeat`` sizes.

    The excess over caps is dealt anew by weight until no source is above its cap: each round caps the sources whose
    part at the present level (words per weight) passes it, and the level rises with what they leave. A round is one
    aggregate over the table of sources; no window holds them all.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = source_ranks(per)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * repeat)
    total, every = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total = float(total or 0) * share
    level = total / every if every else 0.0
    before = None
    while True:
        above = F.col("cap") < F.col("weight") * F.lit(level)
        n, capped, rest = ranked.agg(F.count_if(above), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        if n == before or not rest:
            break
        before, level = n, max(level, (total - (capped or 0.0)) / rest)
    return ranked.select("source", "source_size", "n_docs", F.least(F.col("cap"), F.col("weight") * F.lit(level)).alias("target"))


def weighted_fair_mix(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, share: float = 1.5, repeat: int = 2, seed: int = 7, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, size, source, source_size, target, taken, copies, finish_time.

    Each source's documents queue in the order of an MD5 of seed, id and source, ``repeat`` rounds of them. A document's virtual finish time in round
    r is (words of earlier rounds + running words of its source) / target. The queue of all sources is sorted by finish
    time in ranges and cut where the running total first passes the total budget; documents that would finish at twice
    their target or later are not in the queue. ``taken`` is size times the rounds before the cut.

    Running sums never hold a source in one task: hash ranges of (source, range) are summed first, the sums are
    accumulated, and only then each range by itself. Null or empty texts have size 0 and are never taken; null sources
    are a source of their own; an empty table gives no rows. Equal finish times are ordered by the document's hash, id and
    round, so reruns agree; rows that repeat are documents of their own, one after
    the other in their queue. Of further
    columns only those named in ``carry`` are kept, after the others; names of the result are its own.
    """
    spark = docs.sparkSession
    extra = [F.col(c).alias(f"__carry_{i}") for i, c in enumerate(carry)]
    sized = docs.select(F.col(id_column).alias("id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), *extra)
    sized = cut(sized.withColumn("h", F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string"), F.col("source"))), 1, 15), 16, 10).cast("long")), "mix-sizes")
    targets = cut(source_targets(sized.select("source", "size"), weights, share, repeat), "mix-targets")
    top = targets.agg(F.sum("n_docs"), F.sum("target")).first()
    n, budget = int(top[0] or 0), float(top[1] or 0.0)
    bits = min(20, max(10, math.ceil(math.log2(max(2, n)) / 2)))  # about as many ranges as rows in one
    sized = sized.withColumn("b", F.shiftright("h", 60 - bits))
    before = W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    sums = sized.groupBy("source", "b").agg(F.sum("size").alias("words"))
    sums = sums.select("source", "b", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("earlier"))
    inside = W.partitionBy("source", "b").orderBy("h", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    sized = sized.withColumn("inside", F.sum("size").over(inside))
    key = [F.col("a.source").eqNullSafe(F.col("c.source")), F.col("a.b") == F.col("c.b")]
    queue = sized.alias("a").join(sums.alias("c"), key).select("a.*", (F.col("c.earlier") + F.col("inside")).alias("running"))
    # the catalogue of sources has its own size check: Spark broadcasts it below its threshold and shuffles it above
    queue = queue.alias("q").join(targets.alias("t"), F.col("q.source").eqNullSafe(F.col("t.source"))).select("q.*", "t.source_size", "t.target")
    queue = cut(queue.drop("b", "inside"), "mix-queue")

    def finish(r) -> Column:
        return (r * F.col("source_size") + F.col("running")) / F.col("target")

    rounds = queue.where((F.col("size") > 0) & (F.col("target") > 0)).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
    rounds = rounds.withColumn("v", finish(F.col("r"))).where("v < 2")
    rounds = rounds.withColumn("g", F.floor(F.col("v") * F.lit(2**bits)))
    ranges = rounds.groupBy("g").agg(F.sum("size").alias("words"))
    ranges = ranges.withColumn("upto", F.sum("words").over(W.orderBy("g").rowsBetween(W.unboundedPreceding, 0)))
    crossing = ranges.where(F.col("upto") > F.lit(budget)).orderBy("g").limit(1).first()  # one row
    place = ["v", "h", "id", "r"]
    if crossing is None:
        passed = lambda r: finish(r) < 2
    else:
        at = rounds.where(F.col("g") == crossing["g"]).withColumn("upto", F.sum("size").over(W.orderBy(*place).rowsBetween(W.unboundedPreceding, 0)) + F.lit(crossing["upto"] - crossing["words"]))
        end = at.where(F.col("upto") > F.lit(budget)).orderBy(*place).select(*place).first()
        cutoff = F.struct(F.lit(end["v"]), F.lit(end["h"]), F.lit(end["id"]).cast(docs.schema[id_column].dataType), F.lit(end["r"]))
        passed = lambda r: F.struct(finish(r), F.col("h"), F.col("id"), r) < cutoff
    counted = F.when((F.col("size") > 0) & (F.col("target") > 0), sum((F.when(passed(F.lit(r)), 1).otherwise(0) for r in range(repeat)), F.lit(0))).otherwise(0)
    out = queue.withColumn("copies", counted)
    kept = [F.col(f"__carry_{i}").alias(c) for i, c in enumerate(carry)]
    time = F.when(F.col("target") > 0, finish(F.lit(0)))
    return out.select(F.col("id").alias(id_column), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.col("copies").cast("int").alias("copies"), F.col("source").alias("source"), time.alias("finish_time"), *kept)
