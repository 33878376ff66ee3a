"""The engagement lane: weekly features, panel, surface, choice of k, frozen bundle, scores, measures and gates."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.contract.manifest import Manifest
from lectern.model import gates as gt
from lectern.model import selection
from lectern.model.assignment import assign, fit_typical, rank_labels
from lectern.model.bundle import Bundle, cluster_profile, score, score_measures
from lectern.model.measures import fit_measures_rows, layout
from lectern.model.settings import LaneSettings
from lectern.model.surface import fit_surface, out_of_bounds, variances
from lectern.operators import checks, daily
from lectern.plans import panel as pn
from lectern.plans import temporal
from lectern.plans.weekly import bucket_completeness, build_weekly, fanned_out, full_weeks, latest_dates, resolved_share, stale_sources, unclosed_shares
from lectern.session import staged

#: Tables that a run may write. Fixed values.
LANE_OUTPUTS = ("reader_week_features", "reader_week_cluster", "reader_week_measures", "cluster_profile", "k_selection", "gate_report")
PROFILE = ("overall_active_days_28d", "resolved_section_views_28d", "distinct_sections_28d", "topic_entropy_28d", "email_clicks_28d", "email_click_active_weeks_4", "community_actions_28d")


class LaneError(ValueError):
    """The delivery can't be modelled."""


@dataclass
class LaneResult:
    settings: LaneSettings
    weeks: list[date]
    champion: int | None
    bundle: Bundle | None
    decision: gt.Decision
    tables: dict[str, DataFrame] = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)

    def summary(self) -> str:
        lines = [self.settings.describe(), f"weeks scored    : {len(self.weeks)}, {self.weeks[0]} to {self.weeks[-1]}", f"champion k      : {self.champion}", f"publication     : {self.decision.describe()}", *(f"note: {n}" for n in self.notes)]
        return "\n".join(lines)


def daily_tables(inputs: dict[str, DataFrame], manifest: Manifest) -> dict[str, DataFrame]:
    """The published daily tables of a build that passed its checks."""
    c = daily.context(inputs, manifest).stage(*daily.SHARED, "reader_section_day", "subscription_state_interval")
    checks.require(checks.run_checks(c))
    return {n: df for n, df in daily.outputs(c).items() if daily.OUTPUTS[n].published}


def read_daily(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Published daily tables as written before; optional ones may be absent."""
    from lectern.sources.delivery import read_if_there

    found = {n: read_if_there(spark, f"{directory}/{n}.parquet") for n, o in daily.OUTPUTS.items() if o.published}
    if missing := [n for n in ("subscription_state_interval", "reader_channel_day", "reader_section_day") if found[n] is None]:
        raise LaneError(f"{directory} has no {missing}")
    return {n: df for n, df in found.items() if df is not None}


def fit_rows(panel: DataFrame, limit: int | None, seed: int) -> DataFrame:
    """The panel by digest, whole without a limit, else the rows with the least digests of it."""
    digest = F.sha2(F.concat_ws(":", F.lit(f"fit{seed}"), "reader_id", F.col("as_of_week_end").cast("string")).cast("binary"), 256)
    rows = panel.withColumn("_d", digest).orderBy("_d", "reader_id")
    return (rows if limit is None else rows.limit(limit)).drop("_d")


def run_lane(spark: SparkSession, tables: dict[str, DataFrame], s: LaneSettings, reviewed: bool = False, max_weeks: int | None = None) -> LaneResult:
    weekly = s.weekly()
    weeks = full_weeks(tables, weekly.grid)
    weeks = weeks[-max_weeks:] if max_weeks else weeks
    if len(weeks) < 2:
        raise LaneError(f"{len(weeks)} weeks have a whole window of data; 2 are needed")
    built = build_weekly(tables, weeks, weekly)
    features = staged(built.features, "features")
    notes: list[str] = []
    duplicates = fanned_out(features).count()
    if unclosed_shares(features, weekly).limit(1).count():
        raise LaneError("bucket shares of content-active readers don't sum to 1")
    sampled = staged(pn.sample(pn.eligible(features), s.panel_seed), "sampled")
    balanced = staged(pn.balance(sampled, s.panel_seed), "balanced")
    n = pn.require_panel(balanced, max(20, len(weeks)), weeks[-1])
    active = staged(pn.content_active(balanced), "active")
    n_active = active.count()
    if not n_active:
        raise LaneError("no row of the panel is content-active")
    notes.append(f"panel: {sampled.count()} sampled, {n} after balancing, {n_active} content-active")
    surface = fit_surface(active, s.surface)
    spread = variances(active, surface)
    if odd := out_of_bounds(spread):
        notes.append(f"variances out of bounds: {odd}")
    blocks = layout("reader_email_day" in tables, "reader_community_day" in tables)
    x = np.array([r.x for r in fit_rows(active, s.max_fit_rows, s.panel_seed).select(surface.vector().alias("x")).collect()])
    if not np.isfinite(x).all():
        raise LaneError("the model matrix has values that are no numbers")
    candidates = selection.sweep(spark, x, s.k_grid, s.gates, s.starts)
    champion_k, table = selection.select(candidates, s.gates)
    buckets = bucket_completeness(tables["reader_section_day"], weeks[-1], weekly)
    stale = stale_sources(latest_dates({k: t for k, t in tables.items() if k != "subscription_state_interval"}), weeks[-1])
    resolved = float(np.mean([r.resolved_view_share for r in resolved_share(features).collect()]))
    gates = gt.data_gates(duplicates=duplicates, stale=stale, resolved_share=resolved, buckets=buckets, finite=True, variance_ok=not odd, g=s.gates)
    out = {"k_selection": spark.createDataFrame(table)}
    if champion_k is None:
        notes.append("no k survived the screens, so nothing was frozen and no labels were given")
        gates += gt.model_gates(champion=None, survival=None, smallest=None, reviewed=reviewed, g=s.gates)
        out["gate_report"] = spark.createDataFrame(pd.DataFrame(gates))
        return LaneResult(s, weeks, None, None, gt.decide(gates), out, notes)
    selection.require_derived(champion_k, candidates, s.gates)
    best = next(c for c in candidates if c.k == champion_k)
    version = f"{s.surface}-k{best.k}-{s.bucket_map.version}"
    record = pn.balance_record(sampled, balanced).orderBy("month").collect()
    bundle = Bundle(
        version,
        datetime.now(tz=UTC).date().isoformat(),
        s.feature_version,
        surface,
        best.centers,
        rank_labels(best.centers),
        fit_typical(x, best.centers),
        {"rule": pn.RULE, "seed": s.panel_seed, "n_rows": n, "n_content_active": n_active, "baseline_end": weeks[-1].isoformat(), "month_balance": [r.asDict() for r in record]},
        s.bucket_map.version,
        {b: list(parts) for b, parts in s.bucket_map.buckets.items()},
        fit_measures_rows(assign(active, list(surface.standardised().values()), best.centers), "cluster_index", blocks, version),
        {"grid": list(s.k_grid), "champion": best.k, "seed_ari": best.report.median_ari, "survival_lower_bound": best.survival_lower, "variances": spread},
        list(notes),
    )
    scores = staged(score(features, bundle, s.feature_version), "scores")
    columns = [c for c in (*(f"{ch}_views_28d" for ch in weekly.channels), *PROFILE) if c in features.columns]
    last = F.col("as_of_week_end") == F.lit(weeks[-1])
    kept = alike = None
    if len(weeks) >= 5:
        kept = temporal.retention(temporal.pairs(scores, weeks[-5], weeks[-1])).first().retention
        alike = temporal.profile_similarity(features, scores, surface.source_columns(), weeks[-5], weeks[-1])
    sizes = np.bincount(best.labels, minlength=best.k) / len(best.labels)
    gates += gt.model_gates(champion=best.k, survival=best.survival_lower, smallest=float(sizes.min()), reviewed=reviewed, g=s.gates)
    gates += gt.temporal_gates(retention=kept, similarity=alike, g=s.gates)
    out |= {
        "reader_week_features": features,
        "reader_week_cluster": scores,
        "reader_week_measures": score_measures(features, bundle),
        "cluster_profile": cluster_profile(scores.where(last), features.where(last), columns),
        "gate_report": spark.createDataFrame(pd.DataFrame(gates)),
    }
    return LaneResult(s, weeks, best.k, bundle, gt.decide(gates), out, notes)


def write_outputs(tables: dict[str, DataFrame], directory: str) -> None:
    """Each table as Parquet; names that a run doesn't declare are refused before anything is written."""
    if odd := set(tables) - set(LANE_OUTPUTS):
        raise LaneError(f"undeclared outputs {sorted(odd)}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{directory}/{name}.parquet")


def write_result(result: LaneResult, directory: str) -> None:
    write_outputs(result.tables, directory)
    if result.bundle is not None:
        os.makedirs(directory, exist_ok=True)
        result.bundle.save(f"{directory}/frozen_bundle.json")
