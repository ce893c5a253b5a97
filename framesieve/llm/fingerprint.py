"""Document fingerprints by Order MinHash, sensitive to edit distance, and each document's successor in id order."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)
#: Elements of a (sketch x k-mer) matrix that are handled at once.
_CELLS = 1 << 18


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S)) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> _S)


class OrderMinHash:
    """``sketches`` tuples of ``length`` k-mers each.

    A k-mer of code points is numbered by its occurrences so far, (k-mer, number) is hashed anew for every sketch, the
    ``length`` smallest are put back in text order, and the tuple of their k-mers is hashed to 32 bits. Two texts agree in
    a sketch only where they share the minimal k-mers and their order. Texts shorter than k are one k-mer; with fewer
    k-mers than ``length`` all are taken. The empty text has a fingerprint of its own.
    """

    def __init__(self, k: int = 8, length: int = 2, sketches: int = 32, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.k, self.length, self.sketches = k, length, sketches
        self.salts = draw.integers(0, 2**63, sketches, dtype=np.uint64)
        self.factors = draw.integers(0, 2**63, sketches, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def kmers(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each k-mer, hash of each k-mer with its occurrence number), in text order."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        k = max(1, min(self.k, len(points)))
        n = len(points) - k + 1
        rolled = np.zeros(n, np.uint64)
        for i in range(k):
            rolled = rolled * _C + points[i : n + i] + np.uint64(1)
        grams = _mix(rolled)
        # the position in the low bits makes a plain sort stable; the gram keeps the rest
        bits = np.uint64(max(1, int(n).bit_length()))
        order = np.sort((grams >> bits << bits) | np.arange(n, dtype=np.uint64))
        group = order >> bits
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        number = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
        numbered = np.empty(n, np.uint64)
        numbered[(order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = number
        return grams, _mix(grams + numbered * _A)

    def __call__(self, text: str) -> np.ndarray:
        """The signature: uint32 per sketch."""
        if not text:
            return np.zeros(self.sketches, np.uint32)
        grams, numbered = self.kmers(text)
        n, take = len(grams), min(self.length, len(grams))
        chosen = np.empty((self.sketches, take), np.int64)
        rows = max(1, _CELLS // n)
        for at in range(0, self.sketches, rows):
            some = slice(at, min(self.sketches, at + rows))
            ranks = (numbered[None, :] ^ self.salts[some, None]) * self.factors[some, None]
            chosen[some] = self._least(ranks, take)
        chosen.sort(axis=1)
        out = np.full(self.sketches, take, np.uint64)
        for column in chosen.T:
            out = _mix(out * _C + grams[column])
        return (out >> _S).astype(np.uint32)

    @staticmethod
    def _least(ranks: np.ndarray, take: int) -> np.ndarray:
        """Column indices of the ``take`` smallest of every row, ties to the left; a low pass picks out a few of each row."""
        rows, n = ranks.shape
        if n > 64 * take:
            low = ranks < np.uint64(2**64 * (8.0 * take / n))
            r, c = np.nonzero(low)
            if np.bincount(r, minlength=rows).min() >= take:
                values = ranks[r, c]
                order = np.lexsort((values, r))
                first = np.searchsorted(r, np.arange(rows))
                return c[order][first[:, None] + np.arange(take)]
        return np.argsort(ranks, axis=1, kind="stable")[:, :take]


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sketches, 0 to 1."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _longs(values: list):
    """A constant array."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _bucket(i, borders: list[int]):
    """How many of the sorted borders are at or below ``i`` (0 for null), by a search in two steps."""
    step = max(1, math.isqrt(len(borders)))
    groups = [borders[j : j + step] for j in range(0, len(borders), step)]
    upto = lambda table: F.size(F.filter(table, lambda b: b <= i))
    if not groups:
        return F.lit(0)
    full = F.greatest(upto(_longs([g[-1] for g in groups])), F.lit(0))
    inner = F.get(F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>"), full)
    return F.when(i.isNull(), 0).otherwise(F.when(inner.isNull(), len(borders)).otherwise(full * step + upto(inner))).cast("int")


def in_id_order(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, last, id, text) partitioned by bucket and sorted, so that a streaming pass sees each row's successor.

    Buckets are ranges of the id. Each bucket ends with a copy (``last`` true) of the row that starts the next one, and
    the last bucket with the first row of all. Null ids come first, repeated ids in the order of their texts' hashes.
    Bucket borders and first rows are a few numbers per bucket; texts move once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * parts
    ids = docs.select(F.col(id_column).cast("long").alias("id"))
    borders = sorted(set(ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 20 * n)).first()[0] or []))
    bucket = _bucket(F.col("id"), borders)
    at = F.min(F.struct(F.col("id").isNotNull().alias("known"), "id"))
    firsts = {r["bucket"]: r["at"]["id"] for r in ids.groupBy(bucket.alias("bucket")).agg(at.alias("at")).collect()}
    place = sorted(firsts)
    prior = {b: place[i - 1] for i, b in enumerate(place)}
    slots = range(len(borders) + 1)
    start, into = _longs([firsts.get(b) for b in slots]), _longs([prior.get(b) for b in slots])
    rows = rows.withColumn("bucket", bucket)
    here, there = F.struct("bucket", F.lit(False).alias("last")), F.struct(F.get(into, F.col("bucket")).cast("int").alias("bucket"), F.lit(True).alias("last"))
    copies = F.when(F.get(start, F.col("bucket")).eqNullSafe(F.col("id")), F.array(here, there)).otherwise(F.array(here))
    rows = rows.select("id", "text", F.explode(copies).alias("c")).select("c.bucket", "c.last", "id", "text")
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "last", F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")


def successors(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", k: int = 8, length: int = 2, sketches: int = 32, seed: int = 7) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses, one row per row of ``docs``.

    Null texts count as empty. The edited text takes from the successor in ascending id order, after the last row from
    the first; a single row is its own successor. Rows that repeat an id follow each other in the order of their texts'
    hashes. Two empty texts are alike (1.0); an empty table gives no rows. Texts of any length are signed whole. Ids must be
    integers; null ones come first. Further columns are not read, whatever their names.
    """
    maker = OrderMinHash(k, length, sketches, seed)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (bucket, id, text, signature) waiting for its successor
        known: dict[bytes, np.ndarray] = {}

        def sign(text: str) -> np.ndarray:
            key = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
            if key not in known:
                if len(known) > 4096:
                    known.clear()
                known[key] = maker(text)
            return known[key]

        for batch in batches:
            out: list[tuple] = []
            for bucket, last, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] == bucket:
                    changed = edited(held[2], text)
                    mark, after = sign(changed), sign(text)
                    out.append((held[1], len(held[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_text(held[3]), as_text(mark), likeness(held[3], mark), likeness(held[3], after)))
                # a bucket's copies of later rows end it: the first of them is the successor, the others are repeats of its id
                held = None if last else (bucket, i, text, sign(text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()), strict=True)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    found = in_id_order(docs, id_column=id_column, text=text).mapInArrow(run, schema)
    return found if id_column == "doc_id" else found.withColumnRenamed("doc_id", id_column)
