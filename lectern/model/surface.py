"""The space that readers are clustered in: standardised logs of counts, and two raw features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.contract import vocabulary as v
from lectern.model.calibration import Calibration, fit
from lectern.model.guards import require_model_columns
from lectern.model.settings import JOINT

BREADTH, ENTROPY = "distinct_sections_28d", "topic_entropy_28d"
COMMUNITY = ("community_actions_28d", "community_active_days_28d")
CADENCE, CADENCE_FEATURE = "email_click_active_weeks_4", "email_cadence__active_weeks_4"
VARIANCE_BOUNDS = (0.5, 2.0)


class SurfaceError(ValueError):
    """The frame can't be put on the surface."""


def sources(surface: str, channels: tuple[str, ...] = v.CHANNELS) -> dict[str, tuple[str, bool]]:
    """Model columns in their order, each with its source and whether its log is taken."""
    logs = (*(f"{c}_views_28d" for c in channels), "resolved_section_views_28d", "overall_active_days_28d", BREADTH)
    out = {f"z_log__{c}": (c, True) for c in logs} | {f"z__{ENTROPY}": (ENTROPY, False)}
    if surface == JOINT:
        out |= {f"z_log__{c}": (c, True) for c in COMMUNITY} | {CADENCE_FEATURE: (CADENCE, False)}
    return out


def value(source: str, logged: bool) -> Column:
    x = F.coalesce(F.col(source).cast("double"), F.lit(0.0))
    return F.log1p(x) if logged else x


@dataclass(frozen=True)
class Surface:
    name: str
    scales: dict[str, Calibration]

    @property
    def columns(self) -> list[str]:
        return list(self.scales)

    def source_columns(self) -> list[str]:
        return [sources(self.name)[c][0] for c in self.columns]

    def standardised(self) -> dict[str, Column]:
        return {c: scale.z(value(*sources(self.name)[c])) for c, scale in self.scales.items()}

    def vector(self) -> Column:
        return F.array(*self.standardised().values())

    def as_dict(self) -> dict:
        return {"name": self.name, "scales": {c: s.as_dict() for c, s in self.scales.items()}}

    @classmethod
    def of(cls, raw: dict) -> Surface:
        return cls(raw["name"], {c: Calibration.of(s) for c, s in raw["scales"].items()})


def fit_surface(panel: DataFrame, name: str, cadence_rows: Column | None = None) -> Surface:
    """Scales of all columns from one aggregation. cadence_rows: the rows that the cadence's scale is fitted on, if not all."""
    wanted = sources(name)
    if missing := [s for s, _ in wanted.values() if s not in panel.columns]:
        raise SurfaceError(f"the {name} surface needs {missing}")
    require_model_columns(wanted)
    if cadence_rows is not None and CADENCE_FEATURE in wanted and panel.where(cadence_rows).isEmpty():
        raise SurfaceError("no rows to fit the cadence on")
    features = {c: value(*s) for c, s in wanted.items()}
    if cadence_rows is not None and CADENCE_FEATURE in features:
        features[CADENCE_FEATURE] = F.when(cadence_rows, features[CADENCE_FEATURE])
    return Surface(name, fit(panel, features))


def variances(panel: DataFrame, surface: Surface) -> dict[str, float]:
    row = panel.agg(*(F.var_pop(x).alias(c) for c, x in surface.standardised().items())).first()
    return {c: float(row[c]) for c in surface.columns}


def out_of_bounds(found: dict[str, float]) -> dict[str, float]:
    return {c: x for c, x in found.items() if not VARIANCE_BOUNDS[0] <= x <= VARIANCE_BOUNDS[1]}
