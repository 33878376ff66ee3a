"""Every number that a run depends on: those that its settings can change, and those that are fixed in the code."""

from __future__ import annotations

from dataclasses import fields

from lectern.functions import columns as fn
from lectern.model import assignment, calibration, surface, wide
from lectern.model.measures import QUANTUM
from lectern.model.settings import BlockWeights, Thresholds
from lectern.plans.weekly import CLOSURE

SETTABLE, FIXED = "settable", "fixed"


def census() -> list[tuple[str, str, str]]:
    """(kind, name, value) of each parameter."""
    out = [(SETTABLE, f"gates.{f.name}", str(getattr(Thresholds(), f.name))) for f in fields(Thresholds) if f.name != "cross_algorithm_ari_by_k"]
    out += [(SETTABLE, f"gates.cross_algorithm_ari_by_k.{k}", str(x)) for k, x in Thresholds().cross_algorithm_ari_by_k.items()]
    out += [(SETTABLE, f"weights.{f.name}", str(getattr(BlockWeights(), f.name))) for f in fields(BlockWeights)]
    fixed = {
        "window days": fn.WINDOW_DAYS,
        "weekly bins": fn.BINS,
        "recency without activity": fn.RECENCY_CAP,
        "least views of a rate": fn.FLOORS["views"],
        "least sessions of a rate": fn.FLOORS["sessions"],
        "share closure": CLOSURE,
        "z clip": calibration.Z_CLIP,
        "upper limit quantile": calibration.WINSOR_QUANTILE,
        "zero share of sparse counts": calibration.ZERO_SHARE,
        "least variance": surface.VARIANCE_BOUNDS[0],
        "largest variance": surface.VARIANCE_BOUNDS[1],
        "redundant correlation": wide.REDUNDANT,
        "out of distribution": assignment.OOD,
        "far out of distribution": assignment.OOD_SEVERE,
        "decimals of scores": QUANTUM,
    }
    return out + [(FIXED, k, str(x)) for k, x in fixed.items()]
