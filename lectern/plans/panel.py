"""The training panel: one week for each reader and month, months balanced, chosen by digests so that order plays no part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.columns import digest_mod

RULE = "one_week_per_reader_per_month"
#: Hex digits of a digest by which a month's rows are counted before any is ranked.
PREFIX = 4


class PanelError(ValueError):
    """The panel can't be used for a fit."""


def month() -> Column:
    return F.date_format("as_of_week_end", "yyyy-MM")


def _joined(seed: int, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts))


def sample(eligible: DataFrame, seed: int) -> DataFrame:
    """One of the weeks that each reader has in a month; a reader-month has five weeks at most."""
    own = Window.partitionBy("reader_id", "_month")
    rows = eligible.withColumn("_month", month())
    rows = rows.withColumn("_n", F.count(F.lit(1)).over(own)).withColumn("_at", F.row_number().over(own.orderBy("as_of_week_end")))
    pick = digest_mod(_joined(seed, F.col("reader_id"), F.col("_month")), F.col("_n"))
    return rows.where(F.col("_at") == pick + 1).drop("_month", "_n", "_at")


def month_counts(panel: DataFrame) -> DataFrame:
    return panel.groupBy(month().alias("month")).agg(F.count(F.lit(1)).alias("n"))


def balance(panel: DataFrame, seed: int, target: int | None = None) -> DataFrame:
    """As many rows of each month as the smallest month has: those with the least digests.

    A month isn't ranked whole: rows are counted by the digests' first digits, whole classes below the limit stay, and
    only the class that the limit falls into is ranked.
    """
    if target is None:
        target = month_counts(panel).agg(F.min("n")).first()[0] or 0
    rows = panel.withColumn("_month", month()).withColumn("_digest", F.sha2(_joined(seed, F.col("reader_id"), F.col("as_of_week_end")).cast("binary"), 256))
    rows = rows.withColumn("_class", F.substring("_digest", 1, PREFIX))
    sizes = rows.groupBy("_month", "_class").agg(F.count(F.lit(1)).alias("_size"))
    below = F.sum("_size").over(Window.partitionBy("_month").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("_before", F.coalesce(below, F.lit(0))).where(F.col("_before") < target)
    kept = rows.join(sizes, ["_month", "_class"])
    whole = kept.where(F.col("_before") + F.col("_size") <= target)
    cut = kept.where(F.col("_before") + F.col("_size") > target)
    place = F.row_number().over(Window.partitionBy("_month", "_class").orderBy("_digest", "reader_id", "as_of_week_end"))
    cut = cut.withColumn("_at", place).where(F.col("_at") <= F.lit(target) - F.col("_before")).drop("_at")
    return whole.unionByName(cut).drop("_month", "_digest", "_class", "_size", "_before")


def balance_record(before: DataFrame, after: DataFrame) -> DataFrame:
    a, b = month_counts(before), month_counts(after).withColumnRenamed("n", "n_after")
    return a.withColumnRenamed("n", "n_before").join(b, "month", "left").select("month", "n_before", F.coalesce("n_after", F.lit(0)).alias("n_after"))


def repeated_months(panel: DataFrame) -> DataFrame:
    return panel.groupBy("reader_id", month().alias("month")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_panel(panel: DataFrame, least: int = 1, baseline_end=None) -> int:
    """The number of rows, if there are enough, none repeats a reader-month and none is after the baseline."""
    n, last = panel.agg(F.count(F.lit(1)), F.max("as_of_week_end")).first()
    if n < least:
        raise PanelError(f"the panel has {n} rows; {least} are needed")
    if bad := repeated_months(panel).limit(5).collect():
        raise PanelError(f"more than one row for a reader and month: {[(r.reader_id, r.month) for r in bad]}")
    if baseline_end is not None and last > baseline_end:
        raise PanelError(f"rows up to {last} are after the baseline's end {baseline_end}")
    return n


def content_active(panel: DataFrame) -> DataFrame:
    if "content_active_flag" not in panel.columns:
        raise PanelError("the panel has no content_active_flag")
    return panel.where("content_active_flag")


def eligible(features: DataFrame) -> DataFrame:
    """Reader-weeks that are entitled for the whole window and active in it."""
    return features.where(~F.col("partial_window_flag") & ~F.col("no_recent_flag"))
