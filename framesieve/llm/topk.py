"""Exact top-k inner products by no-random-access aggregation over sorted component lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, scratch

#: Packed queries that one pass over the blocks takes by broadcast.
BROADCAST_BYTES = 32 << 20
#: Shares of every list that are read before bounds are compared again.
DEPTHS = (1 / 32, 1 / 16, 1 / 8, 3 / 16, 1 / 4, 3 / 8, 1 / 2, 3 / 4, 1.0)
LONG_MAX, EXACT = 2**63 - 1, 2.0**53


def quantised(vectors: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, x array<double>): floor(scale * component), components taken as doubles, as whole-numbered doubles.

    Rows whose vector is null, empty, or holds a null or non-finite component take no part, nor do rows without an id or
    with a component that is no longer finite once scaled. Where dimensions differ, missing trailing components count as 0.
    """
    parts = F.transform(F.col(vector), lambda c: c.cast("double") * F.lit(float(scale)))
    sound = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(parts, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    # floor of a double gives a long: numbers beyond 2^53 are whole already and stay doubles
    whole = F.transform(parts, lambda c: F.when(F.abs(c) < F.lit(EXACT), F.floor(c).cast("double")).otherwise(c))
    return vectors.where(sound & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), whole.alias("x"))


def _packs(rows: int):
    """Packs the vectors of a partition into blocks of ``rows``: ids and components as binary."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        xs: list[np.ndarray] = []

        def block():
            dim = max(map(len, xs))
            m = np.zeros((len(xs), dim))
            for i, x in enumerate(xs):
                m[i, : len(x)] = x
            return pa.RecordBatch.from_arrays([pa.array([np.asarray(ids, np.int64).tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()), pa.array([dim], pa.int32())], names=["ids", "xs", "dim"])

        for batch in batches:
            edges, values = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy(zero_copy_only=False)
            for n, i in enumerate(batch.column(0).to_pylist()):
                ids.append(i)
                xs.append(values[edges[n] : edges[n + 1]])
                if len(ids) == rows:
                    yield block()
                    ids, xs = [], []
        if ids:
            yield block()

    return pack


def _unpack(ids: bytes, xs: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(xs, np.float64).reshape(len(ids), dim)


def exact_scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered doubles as exact integers: longs where they cannot pass 2^63, else Python's."""
    most = (np.abs(x).max(axis=0, initial=0.0) * np.abs(query)).sum() if len(x) else 0.0
    if most < EXACT:
        return (x @ query).astype(np.int64)
    if most < 2.0**62 and max(np.abs(x).max(), np.abs(query).max()) < 2.0**62:
        return x.astype(np.int64) @ query.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return (whole(x) * whole(query)[None, :]).sum(axis=1)


class SortedLists:
    """One list per component, rows ascending by value; read from either end as a query's sign asks."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        order = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, order, axis=0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(ids))[:, None], axis=0)
        #: Entries that searches had read when they stopped, and entries there were.
        self.read = self.entries = 0

    def _shown(self, depth: int, ends: int):
        """What reading ``depth`` entries from the lists' upper (1) or lower (0) ends shows: values, unseen mask, edges."""
        seen = self.rank >= len(self.ids) - depth if ends else self.rank < depth
        edge = self.values[len(self.ids) - depth if ends else depth - 1]
        return np.where(seen, self.x, 0.0), (~seen).astype(np.float64), edge

    def top(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, exact scores) per query of the rows of this block that can be among its k best, k at most, ties to smaller ids.

        Reads every list from the query's better end, down to the next of ``DEPTHS`` in each round, for all queries
        together: what is shown at a depth does not depend on the query. A row's lower bound adds, for lists that have not shown it, their worst value; its upper
        bound their value at the read position. A query ends when the rows whose upper bound reaches its k-th lower bound
        (or ``floor``, a score that k rows of other blocks reach) are few, or at the lists' ends; exact scores settle
        those rows. Bounds are widened by their rounding error, so they hold for numbers of any size.
        """
        n, dim = self.x.shape
        out: list = [None] * len(queries)
        floor = np.full(len(queries), -np.inf) if floor is None else floor
        open_ = np.arange(len(queries))
        # a sum of products errs by at most (terms + 2) roundings of the sum of their sizes; none below 2^53
        sizes = np.abs(queries) @ np.abs(self.x).max(axis=0, initial=0.0)
        slack = np.where(sizes < EXACT, 0.0, sizes * (dim + 4) * 2.0**-51)
        for share in DEPTHS:
            depth = n if share == 1 else max(min(k, n), int(n * share))
            q = queries[open_]
            up, down = np.maximum(q, 0.0).T, np.minimum(q, 0.0).T
            upper, lower = np.zeros((n, len(open_))), np.zeros((n, len(open_)))
            for part, ends, worst in ((up, 1, self.values[0]), (down, 0, self.values[-1])):
                shown, unseen, edge = self._shown(depth, ends)
                seen = shown @ part
                upper += seen + unseen @ (edge[:, None] * part)
                lower += seen + unseen @ (worst[:, None] * part)
            lower -= slack[open_]
            upper += slack[open_]
            self_row = self.ids[:, None] == own[open_][None, :]
            lower[self_row], upper[self_row] = -np.inf, -np.inf
            kth = floor[open_]
            if n > k:
                kth = np.maximum(kth, np.partition(lower, n - k, axis=0)[n - k])
            able = (upper >= kth[None, :]) & ~self_row
            done = np.count_nonzero(able, axis=0) <= max(4 * k, n // 32) if depth < n else np.ones(len(open_), bool)
            for j in np.flatnonzero(done):
                i = open_[j]
                live = np.count_nonzero(queries[i])
                self.read += depth * live
                self.entries += n * live
                found = np.flatnonzero(able[:, j])
                scores = exact_scores(self.x[found], queries[i])
                best = np.lexsort((self.ids[found], -scores))[:k] if scores.dtype != object else sorted(range(len(found)), key=lambda r: (-scores[r], self.ids[found[r]]))[:k]
                out[i] = self.ids[found][best], scores[best]
            open_ = open_[~done]
            if not len(open_):
                break
        return out


def _search(k: int, at_once: int = 256):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a query's k best exact scores in the blocks this task has met: their least is a floor for its later blocks
        best: dict[int, np.ndarray] = {}
        last, lists = None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids, x = _unpack(row["ids"], row["xs"], row["dim"])
                qids, qx = _unpack(row["qids"], row["qxs"], row["qdim"])
                dim = max(row["dim"], row["qdim"])
                if row["ids"] != last or lists.x.shape[1] != dim:
                    lists, last = SortedLists(ids, np.pad(x, ((0, 0), (0, dim - row["dim"])))), row["ids"]
                qx = np.pad(qx, ((0, 0), (0, dim - row["qdim"])))
                for at in range(0, len(qids), at_once):
                    some = qids[at : at + at_once]
                    floor = np.array([best[i][0] if len(best.get(i, ())) == k else -np.inf for i in some.tolist()])
                    found = lists.top(qx[at : at + at_once], some, k, floor)
                    for i, (_, scores) in zip(some.tolist(), found, strict=True):
                        # rounded down, a floor stays one for scores that no double holds
                        known = np.nextafter(scores.astype(np.float64), -np.inf) if scores.dtype == object or np.abs(scores).max(initial=0) >= EXACT else scores.astype(np.float64)
                        best[i] = np.sort(np.append(best.get(i, np.empty(0)), known))[-k:]
                    pairs = [(own, i, s) for own, (near, scores) in zip(some.tolist(), found, strict=True) for i, s in zip(near.tolist(), scores.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64()), pa.array([str(p[2]) for p in pairs], pa.string())], names=["query_id", "vec_id", "exact"])

    return search


def exact_top_k(vectors: DataFrame, *, k: int = 10, every: int = 100, id_column: str = "vec_id", vector: str = "embedding", scale: int = 1024, block: int = 4096, query_block: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k best integer inner products of every query, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``; candidates all rows but the query's own id. Rows are packed
    into blocks, written once to the shared folder, and each block of queries meets each block of rows once: queries of
    32 MB at a time are broadcast to the blocks, one pass after the other, so no row is shuffled for a query. Each pass
    leaves k rows at most per query and block.

    Null or non-finite vectors take no part; fewer candidates than k give fewer rows; ids that repeat are candidates
    each, and as queries stand for their smallest vector; rows of the query's id are none of its candidates. Further
    columns are not read. Scores are exact integers and ranked as such whatever their size; ``score`` shows those beyond
    a long's range as its end. Ids must fit a long. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_column=id_column, vector=vector, scale=scale)
    packed = "ids binary, xs binary, dim int"
    blocks = cut(rows.mapInArrow(_packs(block), packed), "topk-blocks")
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("x").alias("x")).mapInArrow(_packs(query_block), packed)
    queries = cut(queries.select(F.col("ids").alias("qids"), F.col("xs").alias("qxs"), F.col("dim").alias("qdim")), "topk-queries")
    size = queries.agg(F.coalesce(F.sum(F.length("qids") + F.length("qxs")), F.lit(0))).first()[0]
    passes = 1 if size <= BROADCAST_BYTES else 2 * size // max(1, BROADCAST_BYTES) + 1
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # few packed rows hold much work, so they are dealt one by one
    blocks = blocks.repartition(tasks, F.xxhash64("ids"))
    out = scratch(spark, "topk-found")
    for part in range(passes):
        some = queries if passes == 1 else queries.where(F.pmod(F.xxhash64("qids"), F.lit(passes)) == part)
        met = blocks.join(F.broadcast(some))
        found = met.mapInArrow(_search(k), "query_id long, vec_id long, exact string")
        # integers of more than 38 digits sort by sign, length and digits
        negative = F.startswith("exact", F.lit("-"))
        order = [negative.asc(), F.when(negative, -F.length("exact")).otherwise(F.length("exact")).desc(), F.when(~negative, F.col("exact")).desc_nulls_last(), F.when(negative, F.col("exact")).asc_nulls_last(), F.col("vec_id")]
        ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
        shown = F.coalesce(F.expr("try_cast(exact AS BIGINT)"), F.when(negative, F.lit(-LONG_MAX - 1)).otherwise(F.lit(LONG_MAX)))
        ranked.select("query_id", F.col("rank").cast("int"), "vec_id", shown.alias("score")).write.mode("append").parquet(out)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(out)
