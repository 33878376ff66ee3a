"""Scales of features, fitted on the panel in one aggregation and applied as column arithmetic."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import z_score
from lectern.operators.ranks import quantiles, ranked
from lectern.session import staged

Z_CLIP, PCT_LOW, PCT_HIGH, STD_EPS = 5.0, 0.001, 0.999, 1e-12
WINSOR_QUANTILE, ZERO_SHARE = 0.995, 0.90
#: Rows whose distinct values one aggregation buffer may hold, and distinct values that a frozen scale keeps at most.
ONE_BUFFER, MOST_VALUES = 1_000_000, 100_000


class CalibrationError(ValueError):
    """There is nothing to fit a scale on."""


@dataclass(frozen=True)
class Calibration:
    """values and counts: the distinct panel values in order, and how many rows have each."""

    mean: float
    std: float
    median: float
    iqr: float
    values: tuple[float, ...] = ()
    counts: tuple[int, ...] = ()

    @property
    def n(self) -> int:
        return sum(self.counts)

    def z(self, c: Column, clip: float | None = None) -> Column:
        return z_score(c, self.mean, self.std, clip)

    def robust_z(self, c: Column) -> Column:
        return (c - F.lit(self.median)) / F.lit(max(self.iqr, STD_EPS))

    def mid_rank(self, values: np.ndarray) -> np.ndarray:
        """Share of panel rows below, and half of those equal."""
        known, below = np.asarray(self.values), np.concatenate([[0], np.cumsum(self.counts)])
        left, right = np.searchsorted(known, values, "left"), np.searchsorted(known, values, "right")
        return (below[left] + 0.5 * (below[right] - below[left])) / self.n

    def pct(self, c: Column) -> Column:
        @F.pandas_udf("double")
        def look_up(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                yield pd.Series(self.mid_rank(part.to_numpy(dtype=float))).where(part.notna().to_numpy())

        return look_up(c.cast("double"))

    def rank_normal(self, c: Column) -> Column:
        normal = NormalDist()

        @F.pandas_udf("double")
        def inverse(p: pd.Series) -> pd.Series:
            return p.clip(PCT_LOW, PCT_HIGH).map(normal.inv_cdf, na_action="ignore")

        return inverse(self.pct(c))

    def as_dict(self) -> dict:
        return asdict(self) | {"values": list(self.values), "counts": list(self.counts)}

    @classmethod
    def of(cls, raw: dict) -> Calibration:
        return cls(raw["mean"], raw["std"], raw["median"], raw["iqr"], tuple(raw["values"]), tuple(raw["counts"]))


def exact_quantiles(df: DataFrame, features: Mapping[str, Column], at: Sequence[float], rows: int) -> dict[str, list[float | None]]:
    """Exact quantiles of each feature; `rows` of df decide the route only: few values fit one buffer, many are ranked in ranges."""
    if rows > ONE_BUFFER:
        return quantiles(df, features, at)
    row = df.agg(*(F.percentile(c, F.array(*(F.lit(float(q)) for q in at))).alias(n) for n, c in features.items())).first()
    return {n: row[n] or [None] * len(at) for n in features}


def statistics(df: DataFrame, features: Mapping[str, Column]) -> dict[str, tuple[float, float, float, float, float]]:
    """Mean, population deviation and exact quartiles of each feature that has a value; nulls are left out."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *(x for n, c in features.items() for x in (F.avg(c).alias(f"{n}|mean"), F.stddev_pop(c).alias(f"{n}|std")))).first()
    quarters = exact_quantiles(df, features, (0.25, 0.5, 0.75), row["rows"])
    return {n: (row[f"{n}|mean"], row[f"{n}|std"], *quarters[n]) for n in features if row[f"{n}|mean"] is not None}


def long_statistics(df: DataFrame, features: Mapping[str, Column]) -> DataFrame:
    """feature, mean, std, median, iqr."""
    rows = [(n, mean, std, mid, high - low) for n, (mean, std, low, mid, high) in statistics(df, features).items()]
    return df.sparkSession.createDataFrame(rows, "feature string, mean double, std double, median double, iqr double")


def known_values(df: DataFrame, c: Column) -> tuple[tuple[float, ...], tuple[int, ...]]:
    """The distinct values in order and how many rows have each; of over MOST_VALUES, as many at evenly spaced ranks, each
    counted with the rows since the one before, so that no rank is off by more than one in MOST_VALUES."""
    sizes = staged(df.select(c.cast("double").alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n")), "values")
    distinct, rows, last = sizes.agg(F.count(F.lit(1)), F.sum("n"), F.max("v")).first()
    if distinct <= MOST_VALUES:
        found = sorted((r.v, r.n) for r in sizes.collect())
        return tuple(v for v, _ in found), tuple(n for _, n in found)
    step = rows / MOST_VALUES
    upto = F.col("_before") + F.col("n")
    kept = ranked(sizes, [], "v", "n").where((F.floor(upto / step) > F.floor(F.col("_before") / step)) | (F.col("v") == last))
    found = sorted((r.v, r.upto) for r in kept.select("v", upto.alias("upto")).collect())
    return tuple(v for v, _ in found), tuple(int(n) for n in np.diff([0, *(u for _, u in found)]))


def fit(df: DataFrame, features: Mapping[str, Column], with_values: bool = False) -> dict[str, Calibration]:
    """A calibration for each feature; the panel's values are kept on request, by value and count."""
    found = statistics(df, features)
    out = {}
    for name, c in features.items():
        if name not in found:
            raise CalibrationError(f"{name} has no value to fit a scale on")
        mean, std, low, mid, high = found[name]
        out[name] = Calibration(mean, std, mid, high - low, *(known_values(df, c) if with_values else ((), ())))
    return out


@dataclass(frozen=True)
class Winsor:
    lower: float
    upper: float
    quantile: float
    zero_share: float
    positive_only: bool

    def apply(self, c: Column) -> Column:
        return F.least(F.greatest(c, F.lit(self.lower)), F.lit(self.upper))

    def log_count(self, c: Column) -> Column:
        return F.log1p(self.apply(c))


def winsor_statistics(df: DataFrame, features: Mapping[str, Column], quantile: float = WINSOR_QUANTILE) -> dict[str, float | None]:
    """For each feature its number of values, least, largest, share of zeros, and the quantile of all and of the positive ones."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for n, c in features.items():
        aggs += [F.count(c).alias(f"{n}|n"), F.min(c).alias(f"{n}|low"), F.max(c).alias(f"{n}|high"), F.avg((c == 0).cast("double")).alias(f"{n}|zero")]
    out = df.agg(*aggs).first().asDict()
    parts = {f"{n}|all": c for n, c in features.items()} | {f"{n}|pos": F.when(c > 0, c) for n, c in features.items()}
    return out | {n: q for n, (q,) in exact_quantiles(df, parts, (quantile,), out["rows"]).items()}


def fit_winsor(df: DataFrame, features: Mapping[str, Column], quantile: float = WINSOR_QUANTILE, zero_share: float = ZERO_SHARE) -> dict[str, Winsor]:
    """Upper limits of counts: the quantile of all values, or of the positive ones where nearly all are 0."""
    row, out = winsor_statistics(df, features, quantile), {}
    for n in features:
        if not row[f"{n}|n"]:
            raise CalibrationError(f"{n} has no value")
        if row[f"{n}|low"] < 0:
            raise CalibrationError(f"{n} has negative values, so it is no count")
        sparse = row[f"{n}|zero"] >= zero_share
        upper = (row[f"{n}|pos"] or 0.0) if sparse else row[f"{n}|all"]
        if row[f"{n}|high"] > 0 and upper <= 0:
            raise CalibrationError(f"the upper limit of {n} would be 0")
        out[n] = Winsor(0.0, float(upper), quantile, row[f"{n}|zero"], sparse)
    return out
