"""How labels and profiles move between two weeks."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.columns import BINS, WINDOW_DAYS


def pairs(scores: DataFrame, early: date, late: date, label: str = "cluster_label") -> DataFrame:
    """Labels of readers who have one in both weeks."""
    of = lambda w, name: scores.where((F.col("as_of_week_end") == F.lit(w)) & F.col(label).isNotNull()).select("reader_id", F.col(label).alias(name))
    return of(early, "t").join(of(late, "t_plus"), "reader_id")


def retention(both: DataFrame) -> DataFrame:
    """Share of readers whose label stayed; 0 of none."""
    return both.agg(F.coalesce(F.avg((F.col("t") == F.col("t_plus")).cast("double")), F.lit(0.0)).alias("retention"), F.count(F.lit(1)).alias("n_rows"))


def transitions(both: DataFrame) -> DataFrame:
    """t, t_plus and the share of t's readers that went there."""
    each = both.groupBy("t", "t_plus").agg(F.count(F.lit(1)).alias("n"))
    total = each.groupBy("t").agg(F.sum("n").alias("total"))
    return each.join(total, "t").select("t", "t_plus", (F.col("n") / F.col("total")).alias("share"))


def overlap(weeks_apart: int) -> int:
    """Days that two windows share; agreement of such weeks is no evidence."""
    return max(0, WINDOW_DAYS - WINDOW_DAYS // BINS * weeks_apart)


def profile_similarity(features: DataFrame, scores: DataFrame, columns: list[str], early: date, late: date) -> float | None:
    """Mean correlation of clusters' mean features in the two weeks, over clusters in both; constant profiles are left out."""
    key = ["reader_id", "as_of_week_end"]
    rows = features.join(scores.select(*key, "cluster_index"), key).where(F.col("as_of_week_end").isin(early, late) & F.col("cluster_index").isNotNull())
    means = rows.groupBy("as_of_week_end", "cluster_index").agg(*(F.avg(c).alias(c) for c in columns))
    of = lambda w, p: means.where(F.col("as_of_week_end") == F.lit(w)).select("cluster_index", *(F.col(c).alias(p + c) for c in columns))
    both = of(early, "a_").join(of(late, "b_"), "cluster_index")
    mean = lambda cs: reduce(Column.__add__, cs) / len(cs)
    a, b = [F.col("a_" + c) for c in columns], [F.col("b_" + c) for c in columns]
    ma, mb = mean(a), mean(b)
    cov = mean([(x - ma) * (y - mb) for x, y in zip(a, b, strict=True)])
    va, vb = mean([(x - ma) * (x - ma) for x in a]), mean([(y - mb) * (y - mb) for y in b])
    return both.where((va > 0) & (vb > 0)).agg(F.avg(cov / F.sqrt(va * vb))).first()[0]
