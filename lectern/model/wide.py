"""The wide construction: semantic blocks of features, each one component, weighted into one matrix.

A block's component is the first principal one of its standardised inputs if it explains enough and follows its anchor,
else the anchor alone, else the mean of the inputs, else it is dropped; the choice and the reasons are kept. Fits take
one aggregation each: means and deviations, and then the inputs' correlations.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.contract import vocabulary as v
from lectern.functions.columns import recency_score
from lectern.model.calibration import Calibration, Winsor, fit, fit_winsor
from lectern.model.guards import require_model_columns
from lectern.model.settings import BlockWeights
from lectern.model.surface import VARIANCE_BOUNDS

RAW, LOG_COUNT, ONE_MINUS, NEGATE = "raw", "log_count", "one_minus", "negate"
PCA, ANCHOR, EQUAL, DROPPED = "pca", "anchor", "equal_weight", "dropped"
#: Least explained share and least correlation with the anchor, for dense and for sparse blocks. Fixed values.
DENSE, SPARSE, REDUNDANT = (0.50, 0.60), (0.35, 0.40), 0.80
FLAG = "_imputed_flag"


class WideError(ValueError):
    """A block or the matrix can't be built as declared."""


@dataclass(frozen=True)
class Spec:
    """inputs: feature and transform. active: the column that has to be above 0 for the block to be defined."""

    name: str
    inputs: tuple[tuple[str, str], ...]
    anchor: str
    active: str | None = None
    sparse: bool = False

    def __post_init__(self) -> None:
        if not self.inputs or self.anchor not in [c for c, _ in self.inputs]:
            raise WideError(f"block {self.name} needs inputs, and its anchor among them")

    @property
    def bars(self) -> tuple[float, float]:
        return SPARSE if self.sparse else DENSE


def specs(channels: tuple[str, ...] = v.CHANNELS, email: bool = True, community: bool = True) -> list[Spec]:
    """The blocks of a delivery."""
    out = []
    for c in channels:
        alive = f"{c}_views_28d"
        out += [
            Spec(f"{c}_intensity", ((f"{c}_views_28d", LOG_COUNT), (f"{c}_sessions_28d", LOG_COUNT), (f"{c}_events_28d", LOG_COUNT)), f"{c}_views_28d"),
            Spec(f"{c}_habit", ((f"{c}_active_days_28d", RAW), (f"{c}_active_weeks_4", RAW)), f"{c}_active_days_28d"),
            Spec(f"{c}_recency", ((f"{c}_recency_days", NEGATE),), f"{c}_recency_days"),
            Spec(f"{c}_depth", ((f"{c}_time_per_view_28d", LOG_COUNT), (f"{c}_articles_per_session_28d", LOG_COUNT)), f"{c}_time_per_view_28d", alive),
            Spec(f"{c}_momentum", ((f"{c}_momentum_4", RAW),), f"{c}_momentum_4", alive),
            Spec(f"{c}_consistency", ((f"{c}_weekly_evenness_entropy_4", RAW), (f"{c}_weekly_cv_4", NEGATE), (f"{c}_top_week_share_4", ONE_MINUS)), f"{c}_weekly_evenness_entropy_4", alive),
        ]
    if email:
        out += [
            Spec("email_click_intensity", (("email_clicks_28d", LOG_COUNT),), "email_clicks_28d", sparse=True),
            Spec("email_click_habit", (("email_click_days_28d", RAW), ("email_click_active_weeks_4", RAW)), "email_click_days_28d", sparse=True),
            Spec("email_click_recency", (("email_click_recency_days", NEGATE),), "email_click_recency_days", sparse=True),
        ]
    if community:
        out += [
            Spec("community_intensity", (("community_actions_28d", LOG_COUNT),), "community_actions_28d", sparse=True),
            Spec("community_habit", (("community_active_days_28d", RAW), ("community_active_weeks_4", RAW)), "community_active_days_28d", sparse=True),
            Spec("community_recency", (("community_recency_days", NEGATE),), "community_recency_days", sparse=True),
            Spec("community_contribution_depth", (("community_contribution_ratio_28d", RAW), ("community_contribution_per_active_day_28d", LOG_COUNT)), "community_contribution_ratio_28d", "community_actions_28d", True),
        ]
    return out


@dataclass
class Block:
    spec: Spec
    method: str
    loadings: tuple[float, ...]
    winsor: dict[str, Winsor]
    scales: dict[str, Calibration]
    out: Calibration | None
    explained: float | None = None
    anchor_corr: float | None = None
    failures: list[str] = field(default_factory=list)

    def record(self) -> dict:
        return {"name": self.spec.name, "method": self.method, "gate_failures": list(self.failures), "explained": self.explained, "anchor_corr": self.anchor_corr}


def transformed(column: str, how: str, winsor: Mapping[str, Winsor]) -> Column:
    c = F.col(column).cast("double")
    return winsor[column].log_count(c) if how == LOG_COUNT else 1.0 - c if how == ONE_MINUS else -c if how == NEGATE else c


def correlations(df: DataFrame, columns: list[Column]) -> np.ndarray:
    """The correlation matrix of columns from one aggregation; constant columns correlate with nothing."""
    n = len(columns)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    # rows with a null in either column count for neither, as in a correlation of the two
    both = lambda i, j: columns[i].isNotNull() & columns[j].isNotNull()
    spread = lambda i, j, c: F.stddev_pop(F.when(both(i, j), c))
    row = df.agg(F.count(F.lit(1)).alias("n"), *(x for i, j in pairs for x in (F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}"), spread(i, j, columns[i]).alias(f"a{i}_{j}"), spread(i, j, columns[j]).alias(f"b{i}_{j}")))).first()
    out = np.eye(n)
    for i, j in pairs:
        c, a, b = (row[f"{k}{i}_{j}"] for k in "cab")
        out[i, j] = out[j, i] = c / (a * b) if a and b else 0.0
    return out


def component(z: list[Column], loadings: tuple[float, ...]) -> Column:
    return reduce(Column.__add__, (c * F.lit(float(x)) for c, x in zip(z, loadings, strict=True)))


def fit_block(panel: DataFrame, spec: Spec) -> Block:
    if missing := [c for c, _ in spec.inputs if c not in panel.columns]:
        raise WideError(f"block {spec.name} lacks {missing}")
    rows = panel.where(F.coalesce(F.col(spec.active), F.lit(0.0)) > 0) if spec.active else panel
    counts = {c: F.col(c).cast("double") for c, how in spec.inputs if how == LOG_COUNT}
    if rows.isEmpty():
        return Block(spec, DROPPED, (), {}, {}, None, failures=["no_active_rows"])
    winsor = fit_winsor(rows, counts) if counts else {}
    scales = fit(rows, {c: transformed(c, how, winsor) for c, how in spec.inputs})
    names = [c for c, _ in spec.inputs]
    live = [scales[c].std > 0 for c in names]
    z = [scales[c].z(transformed(c, how, winsor)) for c, how in spec.inputs]
    at, n = names.index(spec.anchor), len(names)
    failures: list[str] = []
    explained = corr = None
    method, loadings = ANCHOR, tuple(float(k == at) for k in range(n))
    if not any(live):
        return Block(spec, DROPPED, (), winsor, scales, None, failures=["constant_inputs"])
    if n > 1 and all(live):
        r = correlations(rows, z)
        values, vectors = np.linalg.eigh(r)
        load = vectors[:, -1] * (1 if vectors[at, -1] >= 0 else -1)
        explained, corr = float(values[-1] / n), float(r[at] @ load / math.sqrt(values[-1]))
        failures = ["explained_variance"] * (explained < spec.bars[0]) + ["anchor_correlation"] * (corr < spec.bars[1])
        if not failures:
            method, loadings = PCA, tuple(map(float, load))
    elif n > 1:
        failures = ["constant_input"]
    if method == ANCHOR and not live[at]:
        method, loadings = EQUAL, tuple(float(x) / sum(live) for x in live)
    out = fit(rows, {"out": component(z, loadings)})["out"]
    return Block(spec, method, loadings, winsor, scales, out, explained, corr, failures)


def block_value(b: Block, clip: float) -> Column:
    """The standardised component; 0, which is neutral, where the block isn't defined."""
    z = [b.scales[c].z(transformed(c, how, b.winsor)) for c, how in b.spec.inputs]
    value = b.out.z(component(z, b.loadings), clip)
    return F.when(inactive(b.spec), F.lit(0.0)).otherwise(value) if b.spec.active else value


def inactive(spec: Spec) -> Column:
    return ~(F.coalesce(F.col(spec.active), F.lit(0.0)) > 0) if spec.active else F.lit(False)


def redundancy(panel: DataFrame, columns: dict[str, Column], active: Column) -> list[tuple[str, str, float]]:
    """Pairs of columns whose correlation on active rows is above the limit."""
    names = list(columns)
    r = correlations(panel.where(active), list(columns.values()))
    return [(names[i], names[j], float(r[i, j])) for i in range(len(names)) for j in range(i + 1, len(names)) if abs(r[i, j]) > REDUNDANT]


@dataclass
class Wide:
    blocks: dict[str, Block]
    signals: dict[str, Calibration]
    anchors: dict[str, str]
    singles: dict[str, tuple[str, Calibration]]
    topics: dict[str, Calibration]
    mix: dict[str, Calibration]
    clip: float

    @property
    def membership(self) -> dict[str, list[str]]:
        """Matrix columns by weighted block."""
        of = lambda keep: [n for n, b in self.blocks.items() if b.method != DROPPED and keep(n)]
        out = {
            "consumption": of(lambda n: n.startswith(v.CHANNELS)),
            "email_click": of(lambda n: n.startswith("email_click_")),
            "community": of(lambda n: n.startswith("community_")),
            "cross_channel": [*(f"channel_mix_{c}" for c in self.mix), *self.singles],
            "topic": list(self.topics),
        }
        return {k: x for k, x in out.items() if x}


def channel_signal(anchor: str, scale: Calibration) -> Column:
    """Percentile of a channel's activity among panel rows that have any; 0 without activity."""
    x = F.coalesce(F.col(anchor).cast("double"), F.lit(0.0))
    return F.when(x > 0, scale.pct(F.log1p(x))).otherwise(F.lit(0.0))


def with_mix(df: DataFrame, signals: Mapping[str, Calibration], anchors: Mapping[str, str]) -> DataFrame:
    """Each channel's signal, their sum, and each one's share of it; 0 of nothing."""
    out = df.withColumns({f"channel_signal_{c}": channel_signal(anchors[c], s) for c, s in signals.items()})
    total = reduce(Column.__add__, (F.col(f"channel_signal_{c}") for c in signals))
    out = out.withColumn("total_channel_signal", total)
    return out.withColumns({f"channel_mix_{c}": F.when(F.col("total_channel_signal") > 0, F.col(f"channel_signal_{c}") / F.col("total_channel_signal")).otherwise(F.lit(0.0)) for c in signals})


def singles() -> dict[str, Column]:
    return {"overall_recency": recency_score(F.col("overall_recency_days")), "overall_active_days": F.log1p(F.col("overall_active_days_28d")), "overall_momentum": F.col("overall_momentum_4")}


def topic_inputs(buckets: tuple[str, ...]) -> dict[str, Column]:
    return {f"topic_share_{b}": F.col(f"topic_share_28d__{b}") for b in buckets} | {"topic_breadth": F.log1p(F.col("distinct_sections_28d"))}


def fit_wide(panel: DataFrame, anchors: Mapping[str, str], buckets: tuple[str, ...], clip: float = 5.0) -> Wide:
    """All fits on the panel; topics on its content-active rows. Columns that don't vary are left out of the matrix."""
    blocks = {s.name: fit_block(panel, s) for s in specs(email="email" in anchors, community="community" in anchors)}
    signals = {}
    for c, anchor in anchors.items():
        active = panel.where(F.coalesce(F.col(anchor), F.lit(0.0)) > 0)
        if active.isEmpty():
            raise WideError(f"no row of the panel is active on {c}")
        signals |= fit(active, {c: F.log1p(F.col(anchor).cast("double"))}, with_values=True)
    mixed = with_mix(panel, signals, anchors)
    mix = fit(mixed, {c: F.col(f"channel_mix_{c}") for c in anchors})
    lone = fit(panel, singles())
    reading = panel.where("content_active_flag")
    if reading.isEmpty():
        raise WideError("no row of the panel is content-active")
    topics = fit(reading, topic_inputs(buckets))
    return Wide(blocks, signals, dict(anchors), {n: (n, s) for n, s in lone.items() if s.std > 0}, {n: s for n, s in topics.items() if s.std > 0}, {c: s for c, s in mix.items() if s.std > 0}, clip)


def apply_wide(features: DataFrame, w: Wide) -> DataFrame:
    """Key, standardised matrix columns, and a flag for each column that may be imputed."""
    rows = with_mix(features, w.signals, w.anchors)
    out = {n: block_value(b, w.clip) for n, b in w.blocks.items() if b.method != DROPPED}
    out |= {f"channel_mix_{c}": s.z(F.col(f"channel_mix_{c}"), w.clip) for c, s in w.mix.items()}
    lone = singles()
    out |= {n: s.z(lone[n], w.clip) for n, (_, s) in w.singles.items()}
    reading = F.coalesce(F.col("content_active_flag"), F.lit(False))
    sources = topic_inputs(tuple(n.removeprefix("topic_share_") for n in w.topics if n.startswith("topic_share_")))
    out |= {n: F.when(reading, s.z(sources[n], w.clip)).otherwise(F.lit(0.0)) for n, s in w.topics.items()}
    require_model_columns(out)
    flags = {f"{n}{FLAG}": inactive(b.spec).cast("int") for n, b in w.blocks.items() if b.method != DROPPED and b.spec.active}
    flags |= {f"{n}{FLAG}": (~reading).cast("int") for n in w.topics}
    return rows.select("reader_id", "as_of_week_end", *(c.alias(n) for n, c in (out | flags).items()))


def imputation_shares(matrix: DataFrame) -> DataFrame:
    flags = [c for c in matrix.columns if c.endswith(FLAG)]
    row = matrix.agg(*(F.avg(c).alias(c) for c in flags))
    return row.select(F.inline(F.array(*(F.struct(F.lit(c.removesuffix(FLAG)).alias("column"), F.col(c).alias("share")) for c in flags))))


def require_matrix(matrix: DataFrame, columns: list[str], documented: tuple[str, ...] = ()) -> dict[str, float]:
    """Variances of the columns, if all are there, finite, and vary within bounds."""
    if missing := [c for c in columns if c not in matrix.columns and c not in documented]:
        raise WideError(f"columns are gone without a record: {missing}")
    if odd := [c for c in documented if c in matrix.columns]:
        raise WideError(f"columns recorded as dropped are there: {odd}")
    there = [c for c in columns if c in matrix.columns]
    row = matrix.agg(*(F.var_pop(c).alias(c) for c in there), *(F.count_if(F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))).alias(f"bad {c}") for c in there)).first()
    if bad := [c for c in there if row[f"bad {c}"]]:
        raise WideError(f"values that are no numbers in {bad}")
    return {c: row[c] for c in there}


def unit_variance(variances: Mapping[str, float], bounds: tuple[float, float] = VARIANCE_BOUNDS) -> None:
    if off := {c: x for c, x in variances.items() if not bounds[0] <= x <= bounds[1]}:
        raise WideError(f"variances out of {bounds}: {off}")


def weighted(matrix: DataFrame, membership: Mapping[str, list[str]], weights: Mapping[str, float]) -> DataFrame:
    """Each column times sqrt(weight of its block / columns of the block), so that a block's share of distance is its weight."""
    if abs(sum(weights.values()) - 1) > 1e-9 or set(weights) != set(membership):
        raise WideError(f"weights {dict(weights)} don't sum to 1 over {list(membership)}")
    every = [c for cols in membership.values() for c in cols]
    if len(every) != len(set(every)):
        raise WideError("a column is in two blocks")
    if missing := [c for c in every if c not in matrix.columns]:
        raise WideError(f"no columns {missing}")
    return matrix.select("reader_id", "as_of_week_end", *((F.col(c) * math.sqrt(weights[b] / len(cols))).alias(c) for b, cols in membership.items() for c in cols))


def contributions(matrix: DataFrame, membership: Mapping[str, list[str]]) -> dict[str, float]:
    """Each block's share of the mean squares."""
    row = matrix.agg(*(F.avg(F.col(c) * F.col(c)).alias(c) for cols in membership.values() for c in cols)).first()
    raw = {b: sum(row[c] or 0.0 for c in cols) for b, cols in membership.items()}
    total = sum(raw.values())
    return {b: x / total if total else 0.0 for b, x in raw.items()}


def weights_of(w: BlockWeights, membership: Mapping[str, list[str]]) -> dict[str, float]:
    """The declared weights of the blocks that there are, scaled to sum to 1."""
    raw = {b: getattr(w, b) for b in membership}
    return {b: x / sum(raw.values()) for b, x in raw.items()}
