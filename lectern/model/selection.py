"""Choice of the number of clusters: candidates are fitted and screened on perturbed panels, one Spark task each.

The panel's matrix is bounded (see LaneSettings.max_fit_rows), so it is sent to the tasks once. A task fits all starts
of one (k, draw) in numpy; draw 0 is the whole panel. The results are a few numbers for each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

from lectern.model import kernels as kn
from lectern.model.settings import Thresholds

SCREENS = ("seed_stability", "cross_algorithm", "distinctness")


class SelectionError(ValueError):
    """The candidates can't be fitted or compared."""


@dataclass(frozen=True)
class SeedReport:
    median_ari: float
    unstable_share: float
    major_min: int
    major_max: int

    def passes(self, g: Thresholds) -> bool:
        return self.median_ari >= g.seed_ari and self.major_min == self.major_max


def seed_report(labelings: list[np.ndarray], g: Thresholds) -> SeedReport:
    stacked = np.stack([labelings[0], *(kn.matched(labelings[0], other) for other in labelings[1:])])
    majors = [int((np.unique(x, return_counts=True)[1] / len(x) >= g.major_cluster_share).sum()) for x in labelings]
    return SeedReport(kn.median_agreement(labelings), float((stacked != stacked[0]).any(axis=0).mean()), min(majors), max(majors))


def screen(x: np.ndarray, k: int, starts: int, g: Thresholds) -> tuple[kn.KMeans, SeedReport, float, int]:
    best, labelings = kn.champion(x, k, starts)
    return best, seed_report(labelings, g), kn.adjusted_rand(best.labels, kn.ward(x, k)), kn.alike_centroids(best.centers, g.centroid_distinctness_corr)


@dataclass
class Candidate:
    k: int
    report: SeedReport
    agreement: float
    alike: int
    silhouette: float
    balance: float
    centers: np.ndarray
    labels: np.ndarray
    passed: dict[str, list[bool]]
    values: dict[str, list[float]]

    @property
    def draws(self) -> int:
        return len(self.passed[SCREENS[0]])

    def lower(self, name: str) -> float:
        return kn.wilson_lower(sum(self.passed[name]), self.draws)

    @property
    def survivals(self) -> int:
        return sum(map(all, zip(*self.passed.values(), strict=True)))

    @property
    def survival_lower(self) -> float:
        return kn.wilson_lower(self.survivals, self.draws)

    def failures(self, g: Thresholds) -> list[str]:
        if not self.draws:
            raise SelectionError(f"k={self.k} was never screened on a perturbed panel")
        out = [n for n in SCREENS if self.lower(n) < g.selection_survival_floor]
        return out or (["joint_reproducibility"] if self.survival_lower < g.selection_survival_floor else [])

    def row(self, g: Thresholds) -> dict:
        failed = self.failures(g)
        out = {
            "k": self.k,
            "seed_median_ari": self.report.median_ari,
            "unstable_row_share": self.report.unstable_share,
            "major_clusters_min": self.report.major_min,
            "major_clusters_max": self.report.major_max,
            "cross_algorithm_ari": self.agreement,
            "cross_algorithm_bar": g.bar(self.k),
            "distinctness_violations": self.alike,
            "silhouette": self.silhouette,
            "size_balance": self.balance,
            "survival_rate": self.survivals / self.draws,
            "survival_lower_bound": self.survival_lower,
        }
        for n in SCREENS:
            out |= {f"{n}_pass_rate": sum(self.passed[n]) / self.draws, f"{n}_mean": float(np.mean(self.values[n]))}
        return out | {"failures": ",".join(failed), "survives": not failed}


def kept_rows(n: int, k: int, draw: int, g: Thresholds) -> np.ndarray:
    """Rows of a perturbed panel; draw 0 is the whole one."""
    if not draw:
        return np.arange(n)
    dropped = max(1, int(round(n * g.selection_perturbation_row_fraction)))
    if dropped >= n:
        raise SelectionError(f"a draw would drop {dropped} of {n} rows")
    out = np.ones(n, dtype=bool)
    out[np.random.default_rng([g.selection_rng_seed, k, draw]).choice(n, dropped, replace=False)] = False
    return np.flatnonzero(out)


def sweep(spark: SparkSession, x: np.ndarray, grid: tuple[int, ...], g: Thresholds, starts: int) -> list[Candidate]:
    """A candidate for each k, with its screens on the whole panel and on each perturbed one."""
    if max(grid) >= len(x):
        raise SelectionError(f"{max(grid)} clusters of {len(x)} rows are no model")
    kept_rows(len(x), grid[0], 1, g)
    sent = spark.sparkContext.broadcast(x)
    cells = [(k, d) for d in range(g.selection_perturbation_draws + 1) for k in grid]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for k, draw in part[["k", "draw"]].itertuples(index=False):
                values = sent.value[kept_rows(len(sent.value), k, draw, g)]
                best, report, agreement, alike = screen(values, k, starts, g)
                whole = draw == 0
                share = np.bincount(best.labels, minlength=k)
                rows.append([k, draw, report.median_ari, report.unstable_share, report.major_min, report.major_max, agreement, alike, kn.silhouette(values, best.labels) if whole else None, share.min() / share.max() if whole else None, best.centers.ravel() if whole else None, best.labels if whole else None])
            yield pd.DataFrame(rows, columns=names)

    schema = "k int, draw int, median_ari double, unstable double, major_min int, major_max int, agreement double, alike int, silhouette double, balance double, centers array<double>, labels array<int>"
    names = [part.split()[0] for part in schema.split(", ")]
    # a task for each cell: they are few and long
    found = spark.createDataFrame(cells, "k int, draw int").repartition(len(cells), "k", "draw").mapInPandas(run, schema).collect()
    out = []
    for k in grid:
        rows = sorted((r for r in found if r.k == k), key=lambda r: r.draw)
        base, rest = rows[0], rows[1:]
        reports = [SeedReport(r.median_ari, r.unstable, r.major_min, r.major_max) for r in rest]
        passed = {SCREENS[0]: [p.passes(g) for p in reports], SCREENS[1]: [r.agreement >= g.bar(k) for r in rest], SCREENS[2]: [r.alike == 0 for r in rest]}
        values = {SCREENS[0]: [p.median_ari for p in reports], SCREENS[1]: [r.agreement for r in rest], SCREENS[2]: [float(r.alike) for r in rest]}
        out.append(Candidate(k, SeedReport(base.median_ari, base.unstable, base.major_min, base.major_max), base.agreement, base.alike, base.silhouette, base.balance, np.array(base.centers).reshape(k, -1), np.array(base.labels), passed, values))
    return out


def select(candidates: list[Candidate], g: Thresholds) -> tuple[int | None, pd.DataFrame]:
    """The least k that survives all screens, or None, and the table of all."""
    ordered = sorted(candidates, key=lambda c: c.k)
    return min((c.k for c in ordered if not c.failures(g)), default=None), pd.DataFrame([c.row(g) for c in ordered])


def require_derived(k: int, candidates: list[Candidate], g: Thresholds) -> None:
    """A champion that doesn't survive its own screens is refused."""
    survivors = [c.k for c in candidates if not c.failures(g)]
    if k not in survivors:
        raise SelectionError(f"k={k} doesn't survive the screens; {survivors} do")
