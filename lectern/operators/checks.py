"""Checks that every daily build has to pass; each recomputes what it checks from another layer."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.contract import vocabulary as v
from lectern.functions.columns import local_date
from lectern.operators.daily import EVENTS, OUTPUTS, Context

TOLERANCE, SAMPLE = 1e-9, 5
KEYS_UNIQUE = "dedup_keys_are_unique"
SESSIONS_MAXIMISED = "sessions_are_maximised_not_summed"
ATTRIBUTION = "section_attribution_reconciles"
SENTINEL = "unresolved_metadata_is_its_own_outcome"
SECTION_SET = "section_is_never_null"
DAY_EVENTS, DAY_EMAIL, DAY_COMMUNITY = (f"one_timezone_applied_to_{x}" for x in ("reader_events", "email", "community"))


@dataclass(frozen=True)
class Check:
    name: str
    offenders: int
    sample: tuple[dict, ...] = ()

    @property
    def passed(self) -> bool:
        return not self.offenders

    def __str__(self) -> str:
        head = f"[{'PASS' if self.passed else 'FAIL'}] {self.name}"
        return "\n".join([head + (f": {self.offenders} rows" if self.offenders else ""), *(f"    {row}" for row in self.sample)])


class ChecksFailed(RuntimeError):
    def __init__(self, failed: list[Check]) -> None:
        self.failed = failed
        super().__init__("\n".join([f"{len(failed)} checks failed: {', '.join(c.name for c in failed)}", *map(str, failed)]))


def duplicates(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Key values on more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_per_key")).where("rows_per_key > 1")


def sessions_off(c: Context) -> DataFrame:
    want = c[EVENTS].where("is_view").groupBy("reader_id", "channel", "local_date").agg(F.countDistinct("session_id").alias("expected_sessions"))
    have = c["reader_channel_day"].select("reader_id", "channel", "local_date", F.col("sessions").alias("emitted_sessions"))
    return have.join(want, ["reader_id", "channel", "local_date"]).where("emitted_sessions <> expected_sessions")


def _apart(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Reader-days where the two sums differ, or that only one side has."""
    both = left.withColumn("in_left", F.lit(True)).join(right.withColumn("in_right", F.lit(True)), ["reader_id", "local_date"], "full_outer")
    return both.where(F.col("in_left").isNull() | F.col("in_right").isNull() | (F.abs(F.col(a) - F.col(b)) > TOLERANCE)).drop("in_left", "in_right")


def _daily_sum(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy("reader_id", "local_date").agg(value.alias(name))


def attribution_off(c: Context) -> DataFrame:
    have = _daily_sum(c["reader_section_day"], F.sum("section_views"), "attributed_views")
    return _apart(have, _daily_sum(c[EVENTS].where("is_view"), F.count(F.lit(1)), "actual_views"), "attributed_views", "actual_views")


def sentinel_off(c: Context) -> DataFrame:
    have = _daily_sum(c["reader_section_day"].where(F.col("section") == v.UNRESOLVED_SECTION), F.sum("section_views"), "sentinel_views")
    unresolved = ~F.col("content_metadata_present") | (F.col("section_resolution") != v.RESOLVED) | F.col("sections").isNull() | (F.size("sections") == 0)
    return _apart(have, _daily_sum(c[EVENTS].where(F.col("is_view") & unresolved), F.count(F.lit(1)), "unresolved_views"), "sentinel_views", "unresolved_views")


def sections_unset(c: Context) -> DataFrame:
    return c["reader_section_day"].where(F.col("section").isNull()).select("reader_id", "local_date")


def days_off(c: Context, source: DataFrame, emitted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys and days that only the output has, or only the instants give in the manifest's zone."""
    want = source.select(*keys, local_date(F.col("event_ts"), c.manifest.timezone).alias("local_date")).distinct()
    have = emitted.select(*keys, "local_date").distinct()
    only = lambda a, b, side: a.join(b, [*keys, "local_date"], "left_anti").withColumn("only_in", F.lit(side))
    return only(have, want, "output").unionByName(only(want, have, "instants"))


def offenders(c: Context) -> dict[str, DataFrame]:
    """The rows that speak against each check; a check whose table wasn't built is absent, which is not a pass."""
    built = [n for n in c.builders if n in OUTPUTS]
    out = {f"{KEYS_UNIQUE}[{n}]": duplicates(c[n], OUTPUTS[n].key) for n in built}
    out[SESSIONS_MAXIMISED] = sessions_off(c)
    out[DAY_EVENTS] = days_off(c, c[EVENTS].where("is_view"), c["reader_channel_day"], ("reader_id", "channel"))
    out[ATTRIBUTION], out[SENTINEL], out[SECTION_SET] = attribution_off(c), sentinel_off(c), sections_unset(c)
    if "reader_email_day" in built:
        there = [c.inputs[t].select("reader_id", "list_id", "event_ts") for t in ("email_click", "email_open") if t in c.inputs]
        out[DAY_EMAIL] = days_off(c, reduce(DataFrame.unionByName, there), c["reader_email_day"], ("reader_id", "list_id"))
    if "reader_community_day" in built:
        out[DAY_COMMUNITY] = days_off(c, c.inputs["community_action"], c["reader_community_day"], ("reader_id",))
    return out


def run_checks(c: Context) -> list[Check]:
    """All checks; samples are taken only of those that fail."""
    out = []
    for name, rows in offenders(c).items():
        n = rows.count()
        sample = tuple(r.asDict() for r in rows.orderBy(*rows.columns).limit(SAMPLE).collect()) if n else ()
        out.append(Check(name, n, sample))
    return out


def require(checks: list[Check]) -> None:
    """Raises once, naming all that failed."""
    if failed := [c for c in checks if not c.passed]:
        raise ChecksFailed(failed)
