"""Nearest centroids and typical distances, as column arithmetic over a frozen model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.model.calibration import Calibration

OOD, OOD_SEVERE = 0.95, 0.99
#: Distances are compared with training distances at so many decimals: numpy and generated code differ in the last bits.
DECIMALS = 10


class AssignmentError(ValueError):
    """The model and the rows don't fit."""


def distances(columns: Sequence[Column], centers: np.ndarray) -> list[Column]:
    """Euclidean distances to each centroid; a few times a few terms, so they stay in generated code."""
    if centers.shape[1] != len(columns):
        raise AssignmentError(f"{len(columns)} features, but centroids of {centers.shape[1]}")
    return [F.sqrt(reduce(Column.__add__, ((c - F.lit(float(x))) * (c - F.lit(float(x))) for c, x in zip(columns, center, strict=True)))) for center in centers]


def assign(df: DataFrame, columns: Sequence[Column], centers: np.ndarray) -> DataFrame:
    """df with cluster_index, cluster_distance, cluster_second_distance and cluster_confidence_margin; ties to the lower index."""
    ranked = F.array_sort(F.array(*(F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(distances(columns, centers)))))
    out = df.withColumn("_r", ranked)
    second = F.col("_r")[1]["d"] if len(centers) > 1 else F.lit(float("inf"))
    out = out.withColumns({"cluster_index": F.col("_r")[0]["i"], "cluster_distance": F.col("_r")[0]["d"], "cluster_second_distance": second})
    return out.withColumn("cluster_confidence_margin", F.col("cluster_second_distance") - F.col("cluster_distance")).drop("_r")


@dataclass(frozen=True)
class Typical:
    """For each cluster the 95th and 99th percentile of training distances, and all of them in order."""

    p95: dict[int, float]
    p99: dict[int, float]
    training: dict[int, tuple[float, ...]]

    def as_dict(self) -> dict:
        return {"p95": {str(k): x for k, x in self.p95.items()}, "p99": {str(k): x for k, x in self.p99.items()}, "training": {str(k): list(x) for k, x in self.training.items()}}

    @classmethod
    def of(cls, raw: dict) -> Typical:
        return cls({int(k): x for k, x in raw["p95"].items()}, {int(k): x for k, x in raw["p99"].items()}, {int(k): tuple(x) for k, x in raw["training"].items()})


def fit_typical(x: np.ndarray, centers: np.ndarray) -> Typical:
    """On the bounded matrix that the centroids were fitted on."""
    d = np.sqrt(((x[:, None, :] - centers[None]) ** 2).sum(axis=2))
    labels, nearest = d.argmin(1), d.min(1)
    own = {k: np.sort(nearest[labels == k]) for k in range(len(centers))}
    if empty := [k for k, v in own.items() if not len(v)]:
        raise AssignmentError(f"no training row belongs to clusters {empty}")
    return Typical({k: float(np.quantile(v, OOD)) for k, v in own.items()}, {k: float(np.quantile(v, OOD_SEVERE)) for k, v in own.items()}, {k: tuple(map(float, v)) for k, v in own.items()})


def typicality(df: DataFrame, t: Typical) -> DataFrame:
    """within_cluster_distance_pct (share of training distances no larger) and the two out-of-distribution marks."""
    d, i = F.col("cluster_distance"), F.col("cluster_index")
    by = lambda values: F.element_at(F.create_map(*(F.lit(x) for k, v in values.items() for x in (k, float(v)))), i)
    scales = {k: Calibration(0, 1, 0, 1, *map(tuple, np.unique(np.round(v, DECIMALS), return_counts=True))) for k, v in t.training.items()}

    @F.pandas_udf("double")
    def share(index, distance):  # noqa: ANN001, ANN202
        import pandas as pd

        out = np.full(len(index), np.nan)
        for k, scale in scales.items():
            here = (index == k).to_numpy()
            cum = np.concatenate([[0], np.cumsum(scale.counts)])
            out[here] = cum[np.searchsorted(np.asarray(scale.values), distance.to_numpy(dtype=float)[here].round(DECIMALS), "right")] / scale.n
        return pd.Series(out).where(index.notna().to_numpy())

    return df.withColumns({"within_cluster_distance_pct": share(i, d), "out_of_distribution": F.coalesce((d > by(t.p95)).cast("int"), F.lit(0)), "out_of_distribution_severe": F.coalesce((d > by(t.p99)).cast("int"), F.lit(0))})


def rank_labels(centers: np.ndarray, prefix: str = "tier") -> dict[int, str]:
    """Names by the mean of each centroid, the lowest first."""
    return {int(c): f"{prefix}_{n}" for n, c in enumerate(np.argsort(centers.mean(axis=1), kind="stable"), 1)}
