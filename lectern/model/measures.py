"""Three scalar measures of engagement: fitted once on the panel's bounded matrix, applied as weighted sums."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.contract import vocabulary as v
from lectern.model.kernels import first_component
from lectern.operators.ranks import ranked
from lectern.session import staged

#: Signals and the weekly features they are read from. Fixed values.
SOURCES = {f"{c}_views": f"{c}_views_28d" for c in v.CHANNELS} | {
    "resolved_section_views": "resolved_section_views_28d",
    "overall_active_days": "overall_active_days_28d",
    "distinct_sections": "distinct_sections_28d",
    "topic_entropy": "topic_entropy_28d",
    "community_actions": "community_actions_28d",
    "community_active_days": "community_active_days_28d",
    "email_cadence": "email_click_active_weeks_4",
}
MEASURES = ("m1", "m2", "m3")
QUANTUM = 10


class MeasuresError(ValueError):
    """The measures can't be fitted or applied."""


def layout(has_email: bool, has_community: bool, channels: tuple[str, ...] = v.CHANNELS) -> dict[str, tuple[str, ...]]:
    """The blocks of signals that the available inputs allow."""
    out = {"intensity": (*(f"{c}_views" for c in channels), "resolved_section_views", "overall_active_days"), "breadth": ("distinct_sections", "topic_entropy")}
    if has_community:
        out["community"] = ("community_actions", "community_active_days")
    if has_email:
        out["loyalty"] = ("email_cadence",)
    return out


@dataclass(frozen=True)
class Block:
    signals: tuple[str, ...]
    loadings: tuple[float, ...]
    turn: float
    explained: float
    center: float
    scale: float


@dataclass(frozen=True)
class Measures:
    model_version: str
    center: dict[str, float]
    scale: dict[str, float]
    m1: Block
    eta_sq: dict[str, float]
    weights: dict[str, float]
    blocks: dict[str, Block]

    def __post_init__(self) -> None:
        if sorted(s for b in self.blocks.values() for s in b.signals) != sorted(self.center):
            raise MeasuresError("the blocks don't part the signals")
        if (total := sum(self.weights.values())) and abs(total - 1) > 1e-6:
            raise MeasuresError("the blocks' weights don't sum to 1")

    def as_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def of(cls, raw: dict) -> Measures:
        block = lambda b: Block(**{k: tuple(x) if isinstance(x, list) else x for k, x in b.items()})
        return cls(**raw | {"m1": block(raw["m1"]), "blocks": {k: block(b) for k, b in raw["blocks"].items()}})


def fit_measures(x: np.ndarray, labels: np.ndarray, blocks: dict[str, tuple[str, ...]], model_version: str) -> Measures:
    """x: the signals in the blocks' order. m2 weighs blocks by how much of their signals' spread the clusters explain."""
    signals = tuple(s for b in blocks.values() for s in b)
    if len(x) < 2 or x.shape[1] != len(signals):
        raise MeasuresError(f"{x.shape} values for {len(signals)} signals")
    scale = np.where(x.std(axis=0) == 0, 1.0, x.std(axis=0))
    _, load, explained, turn = first_component(x)
    total = ((x - x.mean(0)) ** 2).sum(0)
    between = sum(((x[labels == c].mean(0) - x.mean(0)) ** 2) * (labels == c).sum() for c in np.unique(labels))
    eta = np.where(total > 0, between / np.where(total > 0, total, 1), 0.0)
    eta_sq = dict(zip(signals, map(float, eta), strict=True))
    raw = {b: sum(eta_sq[s] for s in own) for b, own in blocks.items()}
    whole = sum(raw.values())
    fitted = {}
    for b, own in blocks.items():
        at = [signals.index(s) for s in own]
        score, loads, share, sign = first_component(x[:, at]) if len(at) > 1 else ((x[:, at[0]] - x[:, at[0]].mean()) / scale[at[0]], np.array([1.0]), 1.0, 1.0)
        fitted[b] = Block(own, tuple(map(float, loads)), sign, share, float(score.mean()), float(score.std()) or 1.0)
    return Measures(model_version, dict(zip(signals, map(float, x.mean(0)), strict=True)), dict(zip(signals, map(float, scale), strict=True)), Block(signals, tuple(map(float, load)), turn, explained, 0.0, 1.0), eta_sq, {b: r / whole if whole else 0.0 for b, r in raw.items()}, fitted)


def fit_measures_rows(rows: DataFrame, label: str, blocks: dict[str, tuple[str, ...]], model_version: str) -> Measures:
    """What fit_measures() gives for all rows of a frame with the weekly features and a label, from two aggregations.

    The components are those of the correlation matrix; a component's scores have mean 0 and its eigenvalue as variance.
    """
    signals = tuple(s for b in blocks.values() for s in b)
    n, pairs = len(signals), [(i, j) for i in range(len(signals)) for j in range(i + 1, len(signals))]
    x = [F.coalesce(signal(s), F.lit(0.0)) for s in signals]
    whole = rows.agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{k}{i}") for i, c in enumerate(x) for k, f in (("m", F.avg), ("s", F.stddev_pop))), *(F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    if whole.n < 2:
        raise MeasuresError(f"{whole.n} rows for {n} signals")
    mean, std = (np.array([whole[f"{k}{i}"] for i in range(n)]) for k in "ms")
    r = np.diag((std > 0).astype(float))
    for i, j in pairs:
        r[i, j] = r[j, i] = whole[f"c{i}_{j}"] / (std[i] * std[j]) if std[i] > 0 and std[j] > 0 else 0.0
    each = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(x))).collect()
    between = sum(g.n * (np.array([g[f"m{i}"] for i in range(n)]) - mean) ** 2 for g in each)
    total = std**2 * whole.n
    eta = np.where(total > 0, between / np.where(total > 0, total, 1), 0.0)
    eta_sq = dict(zip(signals, map(float, eta), strict=True))

    def component(at: list[int]) -> tuple[np.ndarray, float, float, float]:
        """Loadings that sum to no less than 0, explained share, the turn, and the variance of the scores."""
        part = r[np.ix_(at, at)]
        values, vectors = np.linalg.eigh(part)
        load = vectors[:, -1]
        turn = 1.0 if load.sum() >= 0 else -1.0
        return load * turn, float(values[-1] / values.sum()) if values.sum() else 0.0, turn, float(max(values[-1], 0.0))

    load, explained, turn, _ = component(list(range(n)))
    raw = {b: sum(eta_sq[s] for s in own) for b, own in blocks.items()}
    all_raw, fitted = sum(raw.values()), {}
    for b, own in blocks.items():
        loads, share, sign, variance = component([signals.index(s) for s in own]) if len(own) > 1 else (np.array([1.0]), 1.0, 1.0, float(std[signals.index(own[0])] > 0))
        fitted[b] = Block(own, tuple(map(float, loads)), sign, share, 0.0, variance**0.5 or 1.0)
    scale = np.where(std == 0, 1.0, std)
    return Measures(model_version, dict(zip(signals, map(float, mean), strict=True)), dict(zip(signals, map(float, scale), strict=True)), Block(signals, tuple(map(float, load)), turn, explained, 0.0, 1.0), eta_sq, {b: v / all_raw if all_raw else 0.0 for b, v in raw.items()}, fitted)


def signal(name: str) -> Column:
    return F.col(SOURCES[name]).cast("double")


def scores(m: Measures) -> dict[str, Column]:
    """The three scores and the blocks' own, from the weekly features."""
    z = {s: (signal(s) - F.lit(m.center[s])) / F.lit(m.scale[s]) for s in m.center}
    dot = lambda b: reduce(Column.__add__, (z[s] * F.lit(x) for s, x in zip(b.signals, b.loadings, strict=True)))
    mean = lambda cs: reduce(Column.__add__, cs) / F.lit(float(len(cs)))
    own = {b: (dot(p) - F.lit(p.center)) / F.lit(p.scale or 1.0) for b, p in m.blocks.items()}
    m2 = reduce(Column.__add__, (F.lit(m.weights[b]) * mean([z[s] for s in p.signals]) for b, p in m.blocks.items()))
    return {"m1_score": dot(m.m1), "m2_score": m2, "m3_score": mean(list(own.values()))} | {f"m3_{b}": c for b, c in own.items()}


def with_percentile(df: DataFrame, score: str, name: str, week: str = "as_of_week_end") -> DataFrame:
    """Percentile of a score within its week, ties at their mean rank, of values rounded half to even.

    Only values and how many rows have each are ranked, in ranges, so no task sorts a whole week.
    """
    rows = df.withColumn("_q", F.bround(F.col(score), QUANTUM))
    sizes = staged(rows.where("_q IS NOT NULL").groupBy(week, "_q").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    ranks = ranked(sizes, [week], "_q", "_n").select(F.col(week).alias("_w"), F.col("_q").alias("_v"), ((F.col("_before") + (F.col("_n") + 1) / 2) / F.col("_total") * 100).alias(name))
    return rows.join(ranks, (F.col(week) == F.col("_w")) & (F.col("_q") == F.col("_v")), "left").drop("_q", "_w", "_v")


def apply_measures(features: DataFrame, m: Measures) -> DataFrame:
    if missing := [SOURCES[s] for s in m.center if SOURCES[s] not in features.columns]:
        raise MeasuresError(f"the features lack {missing}")
    found = scores(m)
    out = features.select("reader_id", "as_of_week_end", *(c.alias(n) for n, c in found.items()))
    for key in MEASURES:
        out = with_percentile(out, f"{key}_score", f"{key}_percentile")
    order = [n for key in MEASURES for n in (f"{key}_score", f"{key}_percentile")] + [f"m3_{b}" for b in m.blocks]
    return out.select("reader_id", "as_of_week_end", *order, F.lit(m.model_version).alias("model_version"))
