"""Quality classifier by compression: dictionaries of good and bad text, size difference, calibrated score."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Texts are compressed in blocks, so that a long text is judged by the dictionaries and not by what it says earlier.
BLOCK = 2048


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the weights of a logistic calibration; a few hundred KB at most, shipped with the tasks."""

    good: bytes
    bad: bytes
    level: int
    weights: tuple[float, ...]
    empty_score: float

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Holds the loaded dictionaries of one task."""

    def __init__(self, model: CompressionModel):
        self.model = model
        self.packers = []
        for raw in (model.good, model.bad):
            loaded = zstandard.ZstdCompressionDict(raw)
            loaded.precompute_compress(level=model.level)
            self.packers.append(zstandard.ZstdCompressor(level=model.level, dict_data=loaded, write_content_size=False, write_checksum=False, write_dict_id=False))
        self.packers.append(zstandard.ZstdCompressor(level=1, write_content_size=False, write_checksum=False))

    def evidence(self, text: str) -> tuple[float, float]:
        """(normalised size difference, bytes per input byte without a dictionary) of a whole text.

        The second tells repetition, which packs well beside any dictionary.
        """
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return 0.0, 1.0
        good = bad = alone = 0
        first, second, plain = self.packers
        for at in range(0, len(data), BLOCK):
            piece = data[at : at + BLOCK]
            good += len(first.compress(piece))
            bad += len(second.compress(piece))
            alone += len(plain.compress(piece))
        return (bad - good) / (bad + good), alone / len(data)

    def score(self, text: str | None) -> float:
        if not text:
            return self.model.empty_score
        z = float(np.dot(self.model.weights, _terms(*self.evidence(text))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _terms(difference: float, ratio: float) -> np.ndarray:
    packed = max(0.0, -math.log(max(ratio, 1e-4)))
    return np.array([1.0, 10 * difference, packed, packed**2])


def _logistic(x: np.ndarray, y: np.ndarray, row_weights: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method on the ridge-penalised logistic loss of weighted rows."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (row_weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (row_weights * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; plain content where there is too little text to train on."""
    samples = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b" "


def train(good: list[str], bad: list[str], *, counts: tuple[int, int] | None = None, dict_bytes: int = 64 << 10, level: int = 3) -> CompressionModel:
    """Half of the texts of each label makes the dictionaries, the other half the calibration.

    ``counts`` are the good and bad texts there are where these are samples; the calibration rows are weighted to that
    ratio, so a bound on the sample does not move the scores.
    """
    data = [[t.encode("utf-8", "surrogatepass") for t in texts if t] for texts in (good, bad)]
    made = [_dictionary(texts[::2] or texts, dict_bytes) for texts in data]
    n_good, n_bad = counts or (len(good), len(bad))
    prior = n_good / (n_good + n_bad) if n_good or n_bad else 0.5
    draft = CompressionModel(made[0], made[1], level, (0.0, 10.0, 0.0, 0.0), prior)
    scorer = draft.scorer()
    held = [texts[1::2] for texts in data]
    if not held[0] or not held[1]:
        return draft
    x = np.array([_terms(*scorer.evidence(t.decode("utf-8", "surrogatepass"))) for texts in held for t in texts])
    y = np.array([1.0] * len(held[0]) + [0.0] * len(held[1]))
    shares = (prior, 1 - prior)
    row_weights = np.concatenate([np.full(len(texts), share * len(y) / len(texts)) for texts, share in zip(held, shares, strict=True)])
    return CompressionModel(made[0], made[1], level, tuple(_logistic(x, y, row_weights)), prior)


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 1500, longest: int = 32768, seed: int = 7) -> CompressionModel:
    """Fits on at most ``sample`` labelled texts of each label, in hash order, of at most ``longest`` characters each.

    The bounds cover what reaches the driver; scoring has none. Ids are drawn where their hash lies under the share that
    twice the bound is of their label's rows, so no table is sorted for it. The labels' ratio is counted over all
    labelled rows with a text, however many are drawn. Rows with null ids, labels or texts are left out, rows that repeat
    an (id, label) count once, further columns are not read. Without rows of a label the dictionaries fall back to what
    there is, and scores to the size difference.
    """
    wanted = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull()).select(F.col(id_column).alias("__id"), F.col(label).cast("int").alias("__label")).where("__label IN (0, 1)").distinct()
    order = F.xxhash64(F.lit(seed), "__id")
    labelled = {r["__label"]: r["count"] for r in wanted.groupBy("__label").count().collect()}  # two rows

    def below(value: int) -> int:
        """The hash below which about twice the bound of this label's ids lie."""
        return min(2**63 - 1, int(2**64 * min(1.0, 2 * sample / labelled.get(value, 1))) - 2**63)

    drawn = wanted.where(order <= F.when(F.col("__label") == 1, F.lit(below(1))).otherwise(F.lit(below(0))))
    rows = docs.where(F.col(text).isNotNull() & (F.length(text) <= longest)).select(F.col(id_column).alias("__id"), F.col(text).alias("__text"))
    found = rows.join(F.broadcast(drawn), "__id")  # about 4 * sample ids
    good, bad = ([r[0] for r in found.where(F.col("__label") == v).orderBy(order, "__id", "__text").limit(sample).select("__text").collect()] for v in (1, 0))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(id_column).alias("__id"))
    counts = dict(texts.join(wanted, "__id").groupBy("__label").count().collect())
    return train(good, bad, counts=(counts.get(1, 0), counts.get(0, 0)))


def score_quality(docs: DataFrame, model: CompressionModel, *, text: str = "text", score: str = "score") -> DataFrame:
    """Adds ``score`` to every row: near 1 where the text packs better beside good text.

    Whole texts are compressed, block by block. Null and empty texts score the share of good texts in the fit. Rows that
    repeat score alike; an empty table gives no rows. An incoming column named ``score`` is replaced (unless it is the
    text's own), any other column is kept.
    """
    if score == text:
        raise ValueError("the score needs a column of its own")
    kept = docs.drop(score)
    schema = StructType([*kept.schema.fields, StructField(score, DoubleType())])
    names = kept.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            scores = pa.array([scorer.score(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*names, score])

    return kept.mapInArrow(run, schema)
