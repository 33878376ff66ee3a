"""Agreement bars: what k-means and Ward agree by chance on structureless panels like one's own.

A null panel has the panel's size and either a Gaussian of its covariance or its columns shuffled each by itself. The
bar for k is a high percentile of the agreement over replicates, rounded up; planted clusters have to score near 1, and
few fresh null panels may clear the bar. One Spark task for each (k, null, replicate).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

from lectern.model import kernels as kn

GAUSSIAN, PERMUTE = "gaussian", "permute"
PERCENTILE, DECIMALS = 95.0, 2
#: Least score of planted clusters, and the largest share of fresh null panels over the bar.
PLANTED_FLOOR, CLEARANCE = 0.9, 0.15


def null_panel(x: np.ndarray, kind: str, rng: np.random.Generator) -> np.ndarray:
    if kind == GAUSSIAN:
        return rng.multivariate_normal(x.mean(0), np.cov(x, rowvar=False, ddof=0), size=len(x), method="eigh")
    if kind == PERMUTE:
        return np.column_stack([rng.permutation(c) for c in x.T])
    raise ValueError(f"unknown null {kind!r}")


def planted_panel(k: int, dims: int, rng: np.random.Generator, rows: int = 200) -> np.ndarray:
    centers = np.zeros((k, dims))
    for j in range(k):
        centers[j, j % dims] = 12.0 * (1 + j // dims)
    return np.concatenate([c + rng.normal(size=(rows, dims)) for c in centers])


def statistic(x: np.ndarray, k: int, starts: int, seed: int) -> float:
    return kn.adjusted_rand(kn.champion(x, k, starts, (seed,))[0].labels, kn.ward(x, k))


def round_up(value: float, decimals: int = DECIMALS) -> float:
    return math.ceil(round(value * 10**decimals, 9)) / 10**decimals


@dataclass(frozen=True)
class Bar:
    k: int
    null: str
    bar: float
    mean: float
    planted: float
    clearance: float

    @property
    def trusted(self) -> bool:
        return self.planted >= PLANTED_FLOOR and self.clearance <= CLEARANCE


def derive(spark: SparkSession, x: np.ndarray, grid: tuple[int, ...], nulls: tuple[str, ...] = (GAUSSIAN,), replicates: int = 40, starts: int = 5, seed: int = 0) -> list[Bar]:
    """A bar for each k and null; half as many fresh replicates test it. x is a bounded panel, as Ward is quadratic."""
    sent = spark.sparkContext.broadcast(x)
    fresh = max(1, replicates // 2)
    cells = [(k, null, r) for k in grid for null in nulls for r in range(replicates + fresh)] + [(k, "planted", 0) for k in grid]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for k, null, r in (cells[at] for at in part.id):
                rng = np.random.default_rng([seed, k, len(null), r])
                panel = planted_panel(k, sent.value.shape[1], rng) if null == "planted" else null_panel(sent.value, null, rng)
                rows.append((k, null, r, statistic(panel, k, starts, seed + r)))
            yield pd.DataFrame(rows, columns=["k", "null", "r", "score"])

    schema = "k int, null string, r int"
    # a task for each cell: they are few and long, and dealt by a hash some would wait for others
    frame = spark.range(0, len(cells), 1, min(len(cells), 512))
    found = frame.mapInPandas(run, f"{schema}, score double").toPandas()
    planted = found[found.null == "planted"].set_index("k").score
    out = []
    for k in grid:
        for null in nulls:
            rows = found[(found.k == k) & (found.null == null)].sort_values("r")
            own, test = rows.score[rows.r < replicates], rows.score[rows.r >= replicates]
            bar = round_up(float(np.percentile(own, PERCENTILE)))
            out.append(Bar(k, null, bar, float(own.mean()), float(planted[k]), float((test >= bar).mean())))
    return out
