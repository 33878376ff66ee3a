"""Thresholds and settings of a lane run, checked when they are made."""

from __future__ import annotations

import math
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from types import MappingProxyType

from lectern.contract import schema
from lectern.contract import vocabulary as v
from lectern.contract.manifest import Manifest
from lectern.plans.buckets import BucketMap
from lectern.plans.grid import WeekGrid
from lectern.plans.weekly import Settings as WeeklySettings

INTENSITY, JOINT = "intensity", "joint"
CLICK_UNIT = "click_event"
#: Least agreement of k-means and Ward for each k. Fixed values.
AGREEMENT_BARS = {3: 0.46, 4: 0.42, 5: 0.38, 6: 0.35, 7: 0.34, 8: 0.33, 9: 0.32, 10: 0.31}


class SettingsError(ValueError):
    """A setting is out of its range."""


def checked_bars(bars: Mapping[int, float]) -> Mapping[int, float]:
    for k, bar in bars.items():
        if isinstance(k, bool) or not isinstance(k, int) or k < 2:
            raise SettingsError(f"a bar belongs to a number of clusters of 2 and more, not {k!r}")
        if not math.isfinite(bar) or not -1 <= bar <= 1:
            raise SettingsError(f"the bar {bar} for k={k} is no adjusted Rand index")
    return MappingProxyType({k: float(bars[k]) for k in sorted(bars)})


@dataclass(frozen=True)
class Thresholds:
    seed_ari: float = 0.70
    cross_algorithm_ari_by_k: Mapping[int, float] = field(default_factory=lambda: AGREEMENT_BARS)
    centroid_distinctness_corr: float = 0.90
    tiny_cluster_floor: float = 0.01
    major_cluster_share: float = 0.01
    topic_coverage_floor: float = 0.80
    t4_retention: float = 0.45
    t4_profile_similarity: float = 0.80
    selection_perturbation_draws: int = 50
    selection_perturbation_row_fraction: float = 0.001
    selection_survival_floor: float = 0.50
    selection_rng_seed: int = 20260824

    def __post_init__(self) -> None:
        object.__setattr__(self, "cross_algorithm_ari_by_k", checked_bars(self.cross_algorithm_ari_by_k))
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, float) and not (math.isfinite(value) and 0 <= value <= 1):
                raise SettingsError(f"{f.name} is {value}; it has to be from 0 to 1")
        if self.selection_perturbation_draws < 1 or self.selection_perturbation_row_fraction <= 0:
            raise SettingsError("a survival rate needs a draw, and each draw has to leave rows out")

    def bar(self, k: int) -> float:
        if k not in self.cross_algorithm_ari_by_k:
            raise SettingsError(f"no agreement bar is declared for k={k}, only for {list(self.cross_algorithm_ari_by_k)}")
        return self.cross_algorithm_ari_by_k[k]

    def with_bars(self, bars: Mapping[int, float]) -> Thresholds:
        return replace(self, cross_algorithm_ari_by_k=bars)


def parse_thresholds(text: str) -> Thresholds:
    """The [gates] table of a TOML file; unknown names and wrong kinds are refused."""
    try:
        raw = tomllib.loads(text)
    except tomllib.TOMLDecodeError as e:
        raise SettingsError(f"no TOML: {e}") from e
    if odd := set(raw) - {"gates"}:
        raise SettingsError(f"unknown tables {sorted(odd)}")
    gates, known = dict(raw.get("gates", {})), {f.name: f.type for f in fields(Thresholds)}
    if odd := set(gates) - set(known):
        raise SettingsError(f"unknown thresholds {sorted(odd)}")
    if (bars := gates.pop("cross_algorithm_ari_by_k", None)) is not None:
        try:
            gates["cross_algorithm_ari_by_k"] = {int(k): float(x) for k, x in bars.items()}
        except (AttributeError, TypeError, ValueError) as e:
            raise SettingsError("cross_algorithm_ari_by_k maps numbers of clusters to bars") from e
    for name, value in gates.items():
        if name != "cross_algorithm_ari_by_k" and (isinstance(value, bool) or not isinstance(value, int if known[name] == "int" else (int, float))):
            raise SettingsError(f"{name} is {value!r}")
        if known[name] == "float":
            gates[name] = float(value)
    return Thresholds(**gates)


def load_thresholds(path: str) -> Thresholds:
    try:
        with open(path, encoding="utf-8") as f:
            return parse_thresholds(f.read())
    except FileNotFoundError as e:
        raise SettingsError(f"no gates file at {path}") from e


def render_thresholds(t: Thresholds | None = None) -> str:
    """A TOML file that parse_thresholds() reads back to the same thresholds."""
    t = t or Thresholds()
    plain = [f"{f.name} = {getattr(t, f.name)}" for f in fields(t) if f.name != "cross_algorithm_ari_by_k"]
    return "\n".join(["[gates]", *plain, "", "[gates.cross_algorithm_ari_by_k]", *(f"{k} = {bar}" for k, bar in t.cross_algorithm_ari_by_k.items()), ""])


def resolve_surface(m: Manifest) -> str:
    """The joint surface needs clicks and community actions."""
    return JOINT if all(m.available(t) for t in ("email_click", "community_action")) else INTENSITY


@dataclass(frozen=True)
class BlockWeights:
    consumption: float = 0.40
    email_click: float = 0.125
    community: float = 0.075
    cross_channel: float = 0.25
    topic: float = 0.15


@dataclass(frozen=True)
class LaneSettings:
    manifest: Manifest
    bucket_map: BucketMap
    surface: str | None = None
    email_lists: tuple[str, ...] | None = None
    min_views: int = 3
    min_sections: int = 2
    panel_seed: int = 20260824
    z_clip: float = 5.0
    weights: BlockWeights = field(default_factory=BlockWeights)
    gates: Thresholds = field(default_factory=Thresholds)
    k_grid: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    starts: int = 20
    #: Rows on which clusters are fitted at most; a larger panel is thinned by digest, as Ward is quadratic.
    max_fit_rows: int = 20_000

    def __post_init__(self) -> None:
        able = resolve_surface(self.manifest)
        object.__setattr__(self, "surface", self.surface or able)
        object.__setattr__(self, "k_grid", tuple(sorted(set(self.k_grid))))
        if self.surface not in (INTENSITY, JOINT):
            raise SettingsError(f"unknown surface {self.surface!r}")
        if self.surface == JOINT and able != JOINT:
            raise SettingsError("the joint surface needs email clicks and community actions, which the manifest declares absent")
        if not self.k_grid or self.k_grid[0] < 2:
            raise SettingsError(f"no usable numbers of clusters in {self.k_grid}")
        for k in self.k_grid:
            self.gates.bar(k)
        self.weekly()

    def weekly(self) -> WeeklySettings:
        m = self.manifest
        return WeeklySettings(WeekGrid.of(m.week_anchor), self.bucket_map, m.population.entitled_states, m.exclusions, v.CHANNELS, self.email_lists, self.min_views, self.min_sections)

    @property
    def feature_version(self) -> str:
        m = self.manifest
        parts = {"contract": m.contract_version, "article_view": m.article_view.definition_id, "population": m.population.definition_id, "week": WeekGrid.of(m.week_anchor).end_day, "tz": m.timezone, "buckets": self.bucket_map.version, "click_unit": CLICK_UNIT, "surface": self.surface}
        return "|".join(f"{k}={x}" for k, x in parts.items())

    def describe(self) -> str:
        m = self.manifest
        rows = {"time zone": m.timezone, "weeks end on": WeekGrid.of(m.week_anchor).end_day, "article view": m.article_view.definition_id, "population": f"{m.population.definition_id} ({', '.join(m.population.entitled_states)})", "excluded readers": len(m.exclusions), "surface": self.surface, "buckets": f"{self.bucket_map.version}: {', '.join(self.bucket_map.names)}", "email lists": "all" if self.email_lists is None else ", ".join(self.email_lists), "content-active": f"{self.min_views} views in {self.min_sections} sections", "candidate k": ", ".join(map(str, self.k_grid)), "feature version": self.feature_version}
        return "\n".join(f"{k:16}: {x}" for k, x in rows.items())


#: Feature sets that a delivery allows, by what its optional inputs leave out. Fixed values.
DEGRADED = {"email_click": "no-email-cadence", "email_open": "no-deliverability", "community_action": "no-community"}


@dataclass(frozen=True)
class FeatureSet:
    id: str
    kept_blocks: tuple[str, ...]
    dropped: dict[str, str]


def resolve_feature_set(m: Manifest, present: set[str] | None = None) -> FeatureSet:
    """The blocks that a delivery supports; an input that isn't available drops its block, whatever the reason for it."""
    missing = [t for t in schema.OPTIONAL if not m.available(t) or (present is not None and t not in present)]
    dropped = {schema.BY_NAME[t].block: m.optional_inputs[t].status for t in missing}
    kept = tuple(dict.fromkeys(t.block for t in schema.TABLES if t.block not in dropped))
    return FeatureSet("+".join(DEGRADED[t] for t in missing) or "full", kept, dropped)
