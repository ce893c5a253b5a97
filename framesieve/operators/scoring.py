"""The scorer as Arrow stages: rows of maps or images in, regions and scores out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import kernels as k

REGION = "struct<x0:int,y0:int,x1:int,y1:int,score:double,native:boolean,ui_likelihood:double,priority_weight:double,metrics:map<string,double>>"


def region_row(r: k.Region) -> dict:
    return {"x0": r.box[0], "y0": r.box[1], "x1": r.box[2], "y1": r.box[3], "score": r.score, "native": r.native, "ui_likelihood": r.ui, "priority_weight": r.weight, "metrics": {n: float(v) for n, v in r.metrics.items()}}


def component_rows(maps: DataFrame, height: int, width: int, threshold: float, key: str = "vec_id", luma: str = "luma") -> DataFrame:
    """A row for every 8-connected component of the pixels at or above a threshold; null maps have none."""
    schema = f"{key} long, x0 int, y0 int, x1 int, y1 int, area int, total double, peak double, perimeter double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, c.x0, c.y0, c.x1, c.y1, c.area, c.total, c.peak, c.perimeter) for i, m in zip(batch[key], batch[luma], strict=True) if m is not None for a in [np.asarray(m, float).reshape(height, width)] for c in k.components(a >= threshold, a)]
            yield pd.DataFrame(rows, columns=[key, "x0", "y0", "x1", "y1", "area", "total", "peak", "perimeter"])

    return maps.select(key, luma).mapInPandas(run, schema)


def score_maps(pairs: DataFrame, height: int, width: int, key: str = "pair", thresholds: k.ScoringThresholds = k.ScoringThresholds()) -> DataFrame:
    """(key, p_wrong, mining_p_wrong, metrics, regions) of (key, truth, prediction) luma maps, read as grey images."""
    schema = f"{key} long, p_wrong double, mining_p_wrong double, metrics map<string,double>, regions array<{REGION}>"

    def grey(m) -> np.ndarray:
        return np.repeat(np.asarray(m, np.float32).reshape(height, width)[..., None], 3, axis=-1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, t, p in zip(batch[key], batch["truth"], batch["prediction"], strict=True):
                _, regions, metrics = k.score(grey(p), grey(t), thresholds)
                rows.append((i, metrics["p_wrong"], metrics["mining_p_wrong"], metrics, [region_row(r) for r in regions]))
            yield pd.DataFrame(rows, columns=[key, "p_wrong", "mining_p_wrong", "metrics", "regions"])

    return pairs.select(key, "truth", "prediction").mapInPandas(run, schema)


def mapped(rows: DataFrame, schema: str, work) -> DataFrame:
    """``work`` on every row (a namedtuple), in Arrow batches: one dict of the schema's columns each, or a list of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            found = [work(row) for row in batch.itertuples(index=False)]
            yield pd.DataFrame([r for x in found for r in (x if isinstance(x, list) else [x])], columns=names)

    return rows.mapInPandas(run, schema)
