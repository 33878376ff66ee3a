"""Visits from event times: a new one after a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessionize(df: DataFrame, user_col: str, time_col: str, tie_col: str, gap: str = "30 MINUTES") -> DataFrame:
    """df with session_no, counted from 1 for each user; events at one time are ordered by tie_col."""
    own = Window.partitionBy(user_col).orderBy(time_col, tie_col)
    last = F.lag(time_col).over(own)
    starts = F.when(last.isNull() | (F.col(time_col) - last > F.expr(f"INTERVAL {gap}")), 1).otherwise(0)
    return df.withColumn("_new", starts).withColumn("session_no", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
