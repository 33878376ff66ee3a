"""The frozen model: everything that scoring a week needs, as one JSON document."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.model.assignment import Typical, assign, typicality
from lectern.model.measures import Measures, apply_measures
from lectern.model.surface import Surface
from lectern.plans.weekly import NO_RECENT

SCORE_COLUMNS = ("reader_id", "as_of_week_end", "cluster_label", "cluster_index", "cluster_distance", "cluster_second_distance", "cluster_confidence_margin", "within_cluster_distance_pct", "out_of_distribution", "out_of_distribution_severe", "partial_window_flag", "projected_flag", "model_version")


class BundleError(ValueError):
    """The bundle contradicts itself, or belongs to other features."""


@dataclass(frozen=True)
class Bundle:
    model_version: str
    frozen_at: str
    lineage: str
    surface: Surface
    centers: np.ndarray
    labels: dict[int, str]
    typical: Typical
    panel: dict
    bucket_version: str
    buckets: dict[str, list[str]]
    measures: Measures | None = None
    selection: dict = field(default_factory=dict)
    notes: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        if self.centers.ndim != 2 or self.centers.shape[1] != len(self.surface.columns):
            raise BundleError(f"centroids of {self.centers.shape} don't fit {len(self.surface.columns)} columns")
        if set(self.labels) != set(range(len(self.centers))) or not all(x.strip() for x in self.labels.values()):
            raise BundleError("each cluster needs a label")
        if missing := {"rule", "seed"} - set(self.panel):
            raise BundleError(f"the panel's record has no {sorted(missing)}")

    def require_lineage(self, feature_version: str) -> None:
        if feature_version != self.lineage:
            raise BundleError(f"fitted on {self.lineage}, offered {feature_version}")

    def to_json(self) -> str:
        raw = {k: getattr(self, k) for k in ("model_version", "frozen_at", "lineage", "panel", "bucket_version", "buckets", "selection", "notes")}
        raw |= {"surface": self.surface.as_dict(), "centers": self.centers.tolist(), "labels": {str(k): x for k, x in self.labels.items()}, "typical": self.typical.as_dict(), "measures": self.measures and self.measures.as_dict()}
        # in the given order: that of the columns is part of the model
        return json.dumps(raw, indent=1, default=str)

    @classmethod
    def from_json(cls, text: str) -> Bundle:
        raw = json.loads(text)
        raw |= {"surface": Surface.of(raw["surface"]), "centers": np.array(raw["centers"], dtype=float), "labels": {int(k): x for k, x in raw["labels"].items()}, "typical": Typical.of(raw["typical"]), "measures": Measures.of(raw["measures"]) if raw["measures"] else None}
        return cls(**raw)

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(self.to_json())

    def write(self, spark: SparkSession, path: str) -> None:
        """As one text file through Spark, in whatever store the path is."""
        spark.createDataFrame([(self.to_json(),)], "text string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Bundle:
        return cls.from_json(spark.read.text(path, wholetext=True).first().value)

    @classmethod
    def load(cls, path: str) -> Bundle:
        with open(path, encoding="utf-8") as f:
            return cls.from_json(f.read())


def score(features: DataFrame, b: Bundle, feature_version: str) -> DataFrame:
    """A label for each reader-week: the nearest cluster's, or that of no recent engagement, which has no distance."""
    b.require_lineage(feature_version)
    out = features.withColumns({f"_s{k}": c for k, c in enumerate(b.surface.standardised().values())})
    out = assign(out, [F.col(f"_s{k}") for k in range(len(b.surface.columns))], b.centers)
    idle = F.col("no_recent_flag")
    none = ("cluster_index", "cluster_distance", "cluster_second_distance", "cluster_confidence_margin")
    out = typicality(out.withColumns({c: F.when(~idle, F.col(c)) for c in none}), b.typical)
    names = F.create_map(*(F.lit(x) for kv in b.labels.items() for x in kv))
    out = out.withColumns({"cluster_label": F.when(idle, NO_RECENT).otherwise(F.element_at(names, F.col("cluster_index"))), "model_version": F.lit(b.model_version)})
    return out.select(*SCORE_COLUMNS)


def score_measures(features: DataFrame, b: Bundle) -> DataFrame:
    if b.measures is None:
        raise BundleError("the bundle has no measures")
    return apply_measures(features, b.measures)


def cluster_profile(scores: DataFrame, features: DataFrame, columns: list[str]) -> DataFrame:
    """Means of features, size and share of each cluster, those without one included."""
    if missing := [c for c in columns if c not in features.columns]:
        raise BundleError(f"the features lack {missing}")
    key = ["reader_id", "as_of_week_end"]
    rows = scores.select(*key, "cluster_index", "cluster_label").join(features.select(*key, *columns), key, "left")
    each = rows.groupBy("cluster_index", "cluster_label").agg(*(F.avg(c).alias(c) for c in columns), F.count(F.lit(1)).alias("n_readers"))
    total = each.agg(F.sum("n_readers").alias("_all"))
    return each.join(F.broadcast(total)).withColumn("share", F.col("n_readers") / F.col("_all")).drop("_all")
