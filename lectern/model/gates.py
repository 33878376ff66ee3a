"""Conditions for publication: each check blocks all output, the topic block only, or nothing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from lectern.model.settings import Thresholds
from lectern.plans.buckets import Completeness

ALL, TOPIC, NOTHING = "all", "topic_only", "none"


@dataclass(frozen=True)
class Gate:
    family: str
    check: str
    passed: bool
    detail: str = ""
    blocks: str = ALL


@dataclass(frozen=True)
class Decision:
    blocking: tuple[str, ...]
    topic_only: tuple[str, ...]

    @property
    def publish_labels(self) -> bool:
        return not self.blocking

    @property
    def publish_topics(self) -> bool:
        return not self.blocking and not self.topic_only

    def describe(self) -> str:
        parts = [f"blocking: {', '.join(self.blocking)}"] * bool(self.blocking) + [f"topic block only: {', '.join(self.topic_only)}"] * bool(self.topic_only)
        return "; ".join(parts) or "every gate passed"


def data_gates(*, duplicates: int, stale: list[str], resolved_share: float, buckets: Completeness, finite: bool, variance_ok: bool, g: Thresholds) -> list[Gate]:
    f = "data_quality"
    return [
        Gate(f, "no_duplicate_spine_rows", not duplicates, f"{duplicates} reader-weeks on several rows"),
        Gate(f, "sources_reach_the_week_end", not stale, "; ".join(stale)),
        Gate(f, "topic_metadata_coverage", resolved_share >= g.topic_coverage_floor, f"{resolved_share:.4f} of reading is resolved; the floor is {g.topic_coverage_floor}", TOPIC),
        Gate(f, "bucket_map_completeness", buckets.passed, f"catch-all share {buckets.catch_all_share:.4f}; unmapped {list(buckets.unmapped)}", TOPIC),
        Gate(f, "model_matrix_finite", finite),
        Gate(f, "baseline_variance_in_bounds", variance_ok),
    ]


def feature_gates(*, blocks: list[dict], imputed: Mapping[str, float], active_share: float, tolerance: float = 0.01) -> list[Gate]:
    f = "feature_quality"
    forced = [b["name"] for b in blocks if b["method"] == "pca" and b["gate_failures"]]
    dropped = [b["name"] for b in blocks if b["method"] == "dropped"]
    topics = {k: x for k, x in imputed.items() if k.startswith("topic_")}
    off = [k for k, x in topics.items() if abs(x - (1 - active_share)) > tolerance]
    return [
        Gate(f, "no_forced_pca_blocks", not forced, f"{forced}"),
        Gate(f, "dropped_blocks_recorded", True, f"{dropped}", NOTHING),
        Gate(f, "topic_imputation_share_reconciles", not off, f"{off} differ from {1 - active_share:.4f}", TOPIC),
    ]


def model_gates(*, champion: int | None, survival: float | None, smallest: float | None, reviewed: bool, g: Thresholds) -> list[Gate]:
    f = "model_quality"
    out = [Gate(f, "a_k_survived_selection", champion is not None, f"champion k={champion}")]
    if survival is not None:
        out.append(Gate(f, "champion_survives_perturbed_panels", survival >= g.selection_survival_floor, f"{survival:.4f}; the floor is {g.selection_survival_floor}"))
    if smallest is not None:
        out.append(Gate(f, "no_unintended_micro_clusters", smallest >= g.tiny_cluster_floor, f"{smallest:.4f}; the floor is {g.tiny_cluster_floor}"))
    return [*out, Gate(f, "interpretability_reviewed", reviewed, "" if reviewed else "nobody has reviewed the clusters")]


def temporal_gates(*, retention: float | None, similarity: float | None, g: Thresholds) -> list[Gate]:
    """Without weeks that are far enough apart the checks are not evaluated, and block nothing."""
    out = []
    for name, value, floor in (("four_week_retention", retention, g.t4_retention), ("four_week_profile_similarity", similarity, g.t4_profile_similarity)):
        out.append(Gate("temporal", name, False, "not evaluated", NOTHING) if value is None else Gate("temporal", name, value >= floor, f"{value:.4f}; the floor is {floor}"))
    return out


def decide(gates: list[Gate]) -> Decision:
    failed = [(f"{x.family}.{x.check}", x.blocks) for x in gates if not x.passed and x.blocks != NOTHING]
    return Decision(tuple(n for n, b in failed if b != TOPIC), tuple(n for n, b in failed if b == TOPIC))
