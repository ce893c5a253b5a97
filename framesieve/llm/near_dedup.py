"""Near-duplicate groups: fast similarity sketching, banding, exact verification, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: A pair at the threshold is missed by every band with at most this probability.
MISS = 1e-6
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(32)


def banding(similarity: float, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): rows such that a band of a pair at the threshold agrees about once in three."""
    rows = max(1, round(math.log(0.35) / math.log(similarity)))
    return math.ceil(math.log(miss) / math.log1p(-(similarity**rows))), rows


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> _SHIFT)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, k: int):
        self.k = k

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        k = min(self.k, len(h))
        out = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            out = _mix(out + h[i : len(h) - k + 1 + i])
        return np.unique(out)


def fast_sketch(items: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketch of a set of hashes: ``size`` coordinates, each the smallest (round, value) placed in it.

    Rounds 1..size throw every item into a hashed bin, rounds size+1..2*size throw every item into the bin of the round's
    own number, so each coordinate is filled for sure; filling ends after the first round that leaves no bin empty, which
    takes about log(size) * size / items rounds. Two sketches agree in a coordinate with the sets' Jaccard similarity,
    concentrated as for independent draws.
    """
    best = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    if not len(items):
        return best
    left = size
    for r in range(2 * size):
        h = _mix(items + np.uint64((r + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        # round in the top 16 bits, so earlier rounds win; the item's value below
        value = (np.uint64(min(r, 65535)) << np.uint64(48)) | (h >> np.uint64(16))
        if r < size:
            bins = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(size)) >> _SHIFT
            np.minimum.at(best, bins.astype(np.int64), value)
        else:
            best[r - size] = min(best[r - size], value.min())
        if r >= size - 1 or len(items) * (r + 1) >= size:
            left = int((best == np.iinfo(np.uint64).max).sum())
            if not left:
                break
    return best


def _band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.zeros(bands, np.uint64)
    for column in sketch.reshape(bands, rows).T:
        h = _mix(h + column)
    return _mix(h + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _sketches(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        for batch in batches:
            n, digests, keys = [], [], []
            for text in batch.column(2):
                items = shingles(text.as_py())
                n.append(len(items))
                digests.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                keys.append(_band_keys(fast_sketch(items, bands * rows), bands, rows) if len(items) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "th", "n", "digest", "bands"])

    return run


def similar(both: int, n: int, m: int, percent: int) -> bool:
    """Whether two sets of n and m items with ``both`` in common reach the similarity, in 1/10000."""
    return 10_000 * both >= percent * (n + m - both)


def needed_in_common(differing: int, n_centre: int, n: int, similarity: float) -> int:
    """How many items of D(y) every similar x, itself not similar to the centre, has in D(x); see near_duplicates."""
    kappa = (1 - similarity) / (1 + similarity)
    return max(1, math.floor((differing + kappa * (n_centre - n)) / 2 - 1e-9) + 1)


#: Centres with more pairs than this, and than a 1/10000 of all pairs, are dealt to several tasks: 10,000 centres at most.
HOT_PAIRS = 256
_PAIR = "a long, salt int, b long, n long, linked boolean, size long, prefix int, items array<bigint>"


def _verify(k: int, similarity: float):
    """Compares the full shingle sets of pairs (a, salt, ta, b, tb), and gives the items by which b differs from a.

    These are b's additions and, hashed anew, its omissions. a's set is kept while a repeats.
    """
    percent = round(similarity * 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        sets: dict[int, np.ndarray] = {}
        for batch in batches:
            out: list[tuple] = []
            for ia, salt, ta, ib, tb in zip(*(batch.column(i) for i in range(5)), strict=True):
                ia = ia.as_py()
                if ia not in sets:
                    if len(sets) > 64:
                        sets.clear()
                    sets[ia] = shingles(ta.as_py())
                one, two = sets[ia], shingles(tb.as_py())
                added, left_out = np.setdiff1d(two, one, assume_unique=True), np.setdiff1d(one, two, assume_unique=True)
                linked = similar(len(two) - len(added), len(one), len(two), percent)
                items = np.concatenate([added, _mix(left_out + _A)])
                prefix = max(0, len(items) - needed_in_common(len(items), len(one), len(two), similarity) + 1)
                out.append((ia, salt.as_py(), ib.as_py(), len(two), linked, len(items), prefix, items.view(np.int64)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["a", "salt", "b", "n", "linked", "size", "prefix", "items"])

    return run


def _same(a, b):
    return F.col(a) == F.col(b)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over (a, b) edges, for every node with an edge.

    Alternating large-star and small-star rounds; each sums up neighbours before it shuffles, and each round's links are
    written to the shared folder. Ends when a round changes nothing.
    """
    links = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), label)
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("w"), "m")
        large = both.where("v > u").join(least, _same("u", "w")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, _same("u", "w")).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        links = cut(small.where("u > v").distinct(), label)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", k: int = 5, similarity: float = 0.8, miss: float = MISS) -> DataFrame:
    """(id, n_shingles, component_id, kept): one row per row of ``docs``.

    Words are lower-cased in A-Z; a text with fewer than ``k`` words is one shingle. Null, empty and blank texts have no
    shingles and link with nothing. Rows whose shingle sets are equal form a class; classes are linked where the exact
    similarity of their sets reaches ``similarity``; ``component_id`` is the smallest id reachable, ``kept`` tells the
    rows with that id. Rows that repeat an id are one class if their texts are, and link by their own texts if not; ids
    must be integers and not null (such rows link with nothing and keep a null component). Texts of any length are
    compared whole. Further columns are not read, whatever their names. An empty table gives no rows.

    Below, ``rep`` numbers a class: its smallest id, or a hash for every further class with that smallest id. One row with
    the class's text stands for it, however often it is repeated.

    Candidates come from bands of a fast similarity sketch. Every class meets the centre of each of its bands,
    the class that shares its own bands with most others, and similar pairs are links. For the other pairs of a band let D(x) be the items by which x differs from the
    centre c. Then x and y differ by D(x) and D(y) without what these share, and similarity s means that they differ by
    at most (1 - s) / (1 + s) of their sizes' sum. Unless both are linked to c already, one of them, x, is not, which
    bounds |D(x)| from below, so x and y must share at least ``needed_in_common`` items of D(y), and D(x) must hold one of
    D(y)'s first |D(y)| - needed + 1 items in any fixed order; rare items come first. A join on (centre, item) therefore
    finds every link that the bands hold, with no pair of a group emitted for being in it; position and size rule out
    most of what it meets.
    No cap is set on a band.
    """
    bands, rows = banding(similarity, miss)
    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("text"))
    sketched = cut(slim.mapInArrow(_sketches(k, bands, rows), "id long, th long, n long, digest binary, bands array<bigint>"), "near-sketches")
    known = sketched.where("digest IS NOT NULL AND id IS NOT NULL")
    classes = known.groupBy("digest").agg(F.min("id").alias("low"), F.min_by("th", "id").alias("low_th"))
    nth = F.row_number().over(W.partitionBy("low").orderBy("digest"))
    classes = cut(classes.withColumn("rep", F.when(nth == 1, F.col("low")).otherwise(F.xxhash64("low", "digest"))), "near-classes")
    heads = known.join(classes.select(F.col("digest").alias("d"), "low", "rep"), _same("digest", "d") & _same("id", "low"))
    keyed = cut(heads.select("rep", F.explode("bands").alias("band")).distinct(), "near-bands")
    counts = keyed.groupBy(F.col("band").alias("key")).agg(F.count("*").alias("n_in")).where("n_in > 1")
    shared = cut(keyed.join(cut(counts, "near-counts"), _same("band", "key")).select("band", "rep", "n_in"), "near-shared")
    # the more rows a class meets in all its bands, the nearer it is to the middle of its group
    met_by = shared.groupBy(F.col("rep").alias("r")).agg(F.sum("n_in").alias("met"))
    ranked = shared.join(cut(met_by, "near-met"), _same("rep", "r"))
    centres = ranked.groupBy(F.col("band").alias("key")).agg(F.max(F.struct("met", (-F.col("rep")).alias("minus"))).alias("top"))
    centres = cut(centres.select("key", (-F.col("top.minus")).alias("centre")), "near-centres")
    pairs = shared.join(centres, _same("band", "key")).where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = cut(pairs, "near-pairs")
    # whole texts move once, and only those of some pair go on; later pairs are among the same representatives
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct()
    wanted = wanted.join(classes.select("rep", "low", "low_th"), _same("w", "rep")).select(F.col("rep").alias("tid"), "low", "low_th")
    texts = slim.where("id IS NOT NULL AND text IS NOT NULL").join(cut(wanted, "near-wanted").hint("merge"), _same("id", "low") & _same("th", "low_th"))
    # a row that is repeated counts once, or every pair of its class would be compared and counted as often
    texts = cut(texts.dropDuplicates(["id", "th"]).select("tid", "text"), "near-texts")

    def compared(pairs: DataFrame) -> DataFrame:
        """The pairs of representatives with what ``_verify`` says of them.

        The pairs of a hot centre are dealt to several tasks by a salt; its text goes once to each of them.
        """
        most = max(HOT_PAIRS, pairs.count() // 10_000)
        hot = pairs.groupBy(F.col("a").alias("h")).agg(F.count("*").alias("n_pairs")).where(F.col("n_pairs") > most)
        parts = F.coalesce(F.ceil(F.col("n_pairs") / most), F.lit(1))
        dealt = pairs.join(F.broadcast(hot), _same("a", "h"), "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("salt"))
        left = dealt.join(texts, _same("b", "tid")).select("a", "salt", "b", F.col("text").alias("tb"))
        heads = dealt.select(F.col("a").alias("ha"), F.col("salt").alias("hs")).distinct()
        right = heads.join(texts, _same("ha", "tid")).select("ha", "hs", F.col("text").alias("ta"))
        met = left.join(right, _same("a", "ha") & _same("salt", "hs")).select("a", "salt", "ta", "b", "tb")
        return cut(met.mapInArrow(_verify(k, similarity), _PAIR), "near-compared")

    stars = compared(pairs)
    edges = stars.where("linked").select("a", "b")
    part = cut(components(edges), "near-parts")
    kappa = (1 - similarity) / (1 + similarity)
    # groups without an unlinked row have nothing to find
    open_ = stars.where("NOT linked").select(F.col("a").alias("oa")).distinct()
    open_ = stars.select(F.col("a").alias("__a"), F.col("salt").alias("__s")).distinct().join(open_, _same("__a", "oa"), "left_semi")
    items = stars.join(open_, _same("a", "__a") & _same("salt", "__s"), "left_semi").select("a", "b", "n", "linked", "size", "prefix", F.explode("items").alias("i"))
    items = cut(items, "near-items")
    often = items.groupBy(F.col("a").alias("oa"), F.col("i").alias("oi")).agg(F.count("*").alias("df")).where("df > 1")
    ranked = items.join(cut(often, "near-often"), _same("a", "oa") & _same("i", "oi"), "left").withColumn("df", F.coalesce("df", F.lit(1)))
    place = F.row_number().over(W.partitionBy("a", "b").orderBy("df", "i")) - 1
    ranked = cut(ranked.withColumn("at", place).where("df > 1"), "near-ranked")
    x = ranked.where("NOT linked").select(F.col("a").alias("c"), F.col("b").alias("x"), F.col("n").alias("nx"), F.col("size").alias("dx"), F.col("at").alias("q"), "i")
    y = ranked.where("at < prefix").select(F.col("a").alias("cy"), F.col("b").alias("y"), F.col("n").alias("ny"), F.col("size").alias("dy"), F.col("at").alias("p"), F.col("i").alias("j"))
    # positions count from 0: what can still be shared from here on
    most = F.least(F.col("dx") - F.col("q"), F.col("dy") - F.col("p"))
    enough = 2 * most >= F.col("dx") + F.col("dy") - F.lit(kappa) * (F.col("nx") + F.col("ny")) - F.lit(1e-6)
    fits = (F.col("x") != F.col("y")) & enough & (F.least("nx", "ny") >= F.lit(similarity - 1e-9) * F.greatest("nx", "ny"))
    met = x.join(y, _same("c", "cy") & _same("i", "j") & fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    for end in ("a", "b"):  # links inside a component change nothing
        met = met.join(part.select(F.col("node").alias("__node"), F.col("component").alias(f"part_{end}")), _same(end, "__node"), "left").drop("__node")
    met = met.where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
    more = compared(cut(met, "near-more")).where("linked").select("a", "b")
    if not more.isEmpty():
        part = cut(components(edges.unionAll(more)), "near-parts")
    if not classes.where("rep <> low").isEmpty():  # a component's smallest number is then not always its smallest id
        least = part.join(classes, _same("node", "rep")).groupBy(F.col("component").alias("c")).agg(F.min("low").alias("least"))
        part = part.join(least, _same("component", "c")).select("node", F.col("least").alias("component"))
    joined = sketched.select("id", "n", "digest").join(classes.select(F.col("digest").alias("d"), "low", "rep"), _same("digest", "d"), "left")
    joined = joined.join(part, _same("rep", "node"), "left")
    component = F.coalesce("component", "low", "id")
    return joined.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
