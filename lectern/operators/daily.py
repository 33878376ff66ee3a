"""Daily aggregates from a delivery: named builders that take a context and return DataFrames.

A build is a mapping of names to builders, so a builder can be replaced by name. Optional tables that are absent drop
their outputs; they are never filled with zeros. Nothing is computed until an output is used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.contract import schema
from lectern.contract import vocabulary as v
from lectern.contract.manifest import Manifest
from lectern.functions.columns import effective_sections, is_view, local_date
from lectern.session import staged

EVENTS, SESSIONS = "event_layer", "session_layer"
#: Tables that several others, or several weekly features, are made of, each after those it is made of.
SHARED = ("reader_content_day", "reader_channel_day", "reader_email_day", "reader_community_day")


class BuildError(ValueError):
    """The inputs or the settings can't give a build."""


@dataclass(frozen=True)
class Output:
    name: str
    key: tuple[str, ...]
    published: bool
    columns: tuple[str, ...]


OUTPUTS = {
    o.name: o
    for o in (
        Output("content_dimension", ("content_id",), False, ("content_id", "content_type", "section_resolution", "sections")),
        Output("reader_content_day", ("reader_id", "channel", "content_id", "local_date"), False, ("reader_id", "channel", "content_id", "local_date", "views", "sessions", "distinct_sessions_day", "total_time_seconds", "measured_time_deliveries", "events")),
        Output("reader_channel_day", ("reader_id", "channel", "local_date"), True, ("reader_id", "channel", "local_date", "views", "sessions", "total_time_seconds", "measured_time_deliveries", "events")),
        Output("reader_section_day", ("reader_id", "section", "local_date"), True, ("reader_id", "section", "local_date", "section_views", "section_time_seconds", "distinct_content_ids")),
        Output("reader_email_day", ("list_id", "reader_id", "local_date"), True, ("list_id", "reader_id", "local_date", "clicks", "opens")),
        Output("reader_community_day", ("reader_id", "local_date"), True, ("reader_id", "local_date", *v.ACTION_COLUMNS.values())),
        Output("subscription_state_interval", ("reader_id", "start_ts"), True, ("reader_id", "state", "payer_type", "start_ts", "end_ts", "start_date", "end_date", "is_open")),
    )
}


@dataclass
class Context:
    """Inputs, manifest and what was built so far; a table is built when first asked for."""

    inputs: dict[str, DataFrame]
    manifest: Manifest
    builders: dict[str, Callable[[Context], DataFrame]] = field(default_factory=dict)
    built: dict[str, DataFrame] = field(default_factory=dict)
    written: set[str] = field(default_factory=set)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = self.builders[name](self)
        return self.built[name]

    def stage(self, *names: str) -> Context:
        """Writes tables that several others or several plans use, in the given order, so that each is computed once.
        Tables that were asked for before are built anew from the written ones."""
        for name in names:
            if name in self.builders:
                self.built = {n: df for n, df in self.built.items() if n in self.written}
                self.built[name] = staged(self[name], name)
                self.written.add(name)
        return self


def event_layer(c: Context) -> DataFrame:
    """Events with their local day, their content's metadata and whether they are views. Content is joined by its unique
    id; Spark broadcasts it where its size allows and otherwise shuffles both sides once."""
    content = c.inputs["content"].select("content_id", "content_type", "section_resolution", "sections", F.lit(True).alias("content_metadata_present"))
    joined = c.inputs["reader_event"].join(content, "content_id", "left")
    return joined.select(
        "event_id",
        "reader_id",
        "event_ts",
        local_date(F.col("event_ts"), c.manifest.timezone).alias("local_date"),
        "channel",
        "event_kind",
        "content_id",
        "session_id",
        "engagement_time_seconds",
        F.coalesce("content_metadata_present", F.lit(False)).alias("content_metadata_present"),
        "content_type",
        "section_resolution",
        "sections",
        is_view(c.manifest.article_view, F.col("event_kind"), F.col("content_id"), F.col("content_type")).alias("is_view"),
    )


def session_layer(c: Context) -> DataFrame:
    return c[EVENTS].where("is_view").groupBy("reader_id", "channel", "local_date").agg(F.countDistinct("session_id").alias("distinct_sessions_day"))


def content_dimension(c: Context) -> DataFrame:
    return c.inputs["content"].select(*OUTPUTS["content_dimension"].columns)


def reader_content_day(c: Context) -> DataFrame:
    """Views of each piece of content; other events on it that day are counted, days without a view are left out."""
    view = F.col("is_view")
    each = (
        c[EVENTS]
        .where(F.col("content_id").isNotNull())
        .groupBy("reader_id", "channel", "content_id", "local_date")
        .agg(
            F.count_if(view).alias("views"),
            F.countDistinct(F.when(view, F.col("session_id"))).alias("sessions"),
            F.sum(F.when(view, F.col("engagement_time_seconds"))).alias("total_time_seconds"),
            F.count(F.when(view, F.col("engagement_time_seconds"))).alias("measured_time_deliveries"),
            F.count(F.lit(1)).alias("events"),
        )
        .where("views > 0")
    )
    return each.join(c[SESSIONS], ["reader_id", "channel", "local_date"]).select(*OUTPUTS["reader_content_day"].columns)


def reader_channel_day(c: Context) -> DataFrame:
    """Sessions are the largest of the day's carried count: summing those of each content would count a session again."""
    return (
        c["reader_content_day"]
        .groupBy("reader_id", "channel", "local_date")
        .agg(
            F.sum("views").alias("views"),
            F.max("distinct_sessions_day").alias("sessions"),
            F.sum("total_time_seconds").alias("total_time_seconds"),
            F.sum("measured_time_deliveries").alias("measured_time_deliveries"),
            F.sum("events").alias("events"),
        )
    )


def section_parts(c: Context) -> DataFrame:
    """A row for each section of each content day, with its share of the day's views."""
    content = c.inputs["content"].select("content_id", "section_resolution", "sections")
    weighted = c["reader_content_day"].join(content, "content_id", "left").withColumn("effective", effective_sections(F.col("section_resolution"), F.col("sections")))
    return weighted.withColumn("weight", F.lit(1.0) / F.size("effective").cast("double")).select("reader_id", "local_date", "content_id", "views", "total_time_seconds", "weight", F.explode("effective").alias("section"))


def reader_section_day(c: Context) -> DataFrame:
    return (
        section_parts(c)
        .groupBy("reader_id", "section", "local_date")
        .agg(F.sum(F.col("views") * F.col("weight")).alias("section_views"), F.sum(F.col("total_time_seconds") * F.col("weight")).alias("section_time_seconds"), F.countDistinct("content_id").alias("distinct_content_ids"))
    )


def reader_email_day(c: Context) -> DataFrame:
    """Clicks and opens of those of the two inputs that there are."""
    counts = {"clicks": "email_click", "opens": "email_open"}
    there = {k: t for k, t in counts.items() if t in c.inputs}
    if not there:
        raise BuildError("reader_email_day needs email_click or email_open")
    parts = [c.inputs[t].select("list_id", "reader_id", local_date(F.col("event_ts"), c.manifest.timezone).alias("local_date"), *(F.lit(int(k == own)).cast("long").alias(k) for k in there)) for own, t in there.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("list_id", "reader_id", "local_date").agg(*(F.sum(k).alias(k) for k in there))


def reader_community_day(c: Context) -> DataFrame:
    rows = c.inputs["community_action"].withColumn("local_date", local_date(F.col("event_ts"), c.manifest.timezone))
    return rows.groupBy("reader_id", "local_date").agg(*(F.count_if(F.col("action_kind") == kind).alias(name) for kind, name in v.ACTION_COLUMNS.items()))


def subscription_state_interval(c: Context) -> DataFrame:
    zone = c.manifest.timezone
    return c.inputs["subscription_span"].select("reader_id", "state", "payer_type", "start_ts", "end_ts", local_date(F.col("start_ts"), zone).alias("start_date"), local_date(F.col("end_ts"), zone).alias("end_date"), F.col("end_ts").isNull().alias("is_open"))


def builders(inputs: set[str]) -> dict[str, Callable[[Context], DataFrame]]:
    """The builders that the present inputs allow, in the order of their use of each other."""
    out = {EVENTS: event_layer, SESSIONS: session_layer, "content_dimension": content_dimension, "reader_content_day": reader_content_day, "reader_channel_day": reader_channel_day, "reader_section_day": reader_section_day}
    if inputs & {"email_click", "email_open"}:
        out["reader_email_day"] = reader_email_day
    if "community_action" in inputs:
        out["reader_community_day"] = reader_community_day
    return out | {"subscription_state_interval": subscription_state_interval}


def context(inputs: dict[str, DataFrame], manifest: Manifest, replaced: dict[str, Callable[[Context], DataFrame]] | None = None) -> Context:
    """A build that hasn't computed anything yet. `replaced` puts other builders in the place of named ones."""
    if missing := [n for n in schema.REQUIRED if n not in inputs]:
        raise BuildError(f"the delivery has no {missing}")
    inputs = {n: df for n, df in inputs.items() if manifest.available(n)}
    own = builders(set(inputs))
    if unknown := set(replaced or {}) - set(own):
        raise BuildError(f"no builder is named {sorted(unknown)}; there are {list(own)}")
    return Context(inputs, manifest, own | (replaced or {}))


def outputs(c: Context) -> dict[str, DataFrame]:
    return {n: c[n] for n in c.builders if n in OUTPUTS}
