"""Weekly features for all weeks in one pass.

Each daily row goes to the at most four week ends whose 28 days hold it, with the number of the week it falls in; one
aggregation by reader and week end then gives all windows and all channels. The spine is made of subscription spans;
features are joined to it, and what a missing feature row means is decided by the feature's class: counts are 0,
recency is 29 days, and features that are undefined without activity stay null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.contract import vocabulary as v
from lectern.functions import columns as fn
from lectern.plans.buckets import BucketMap, Completeness
from lectern.plans.grid import WeekGrid

KEY = ["reader_id", "as_of_week_end"]
SPINE = (*KEY, "state", "payer_type", "entitled_days_in_window", "partial_window_flag", "projected_flag")
#: Features that have no value without activity on their channel. Fixed values.
CONDITIONAL = ("_time_per_view_28d", "_articles_per_session_28d", "_momentum_4", "_top_week_share_4", "_weekly_cv_4", "_weekly_evenness_entropy_4", "_contribution_ratio_28d", "_contribution_per_active_day_28d")
STEMS = {"posts_created": "community_posts", "replies_created": "community_replies", "likes_given": "community_likes", "dislikes_given": "community_dislikes", "flags_given": "community_flags"}
CONTRIBUTIONS, REACTIONS = ("posts_created", "replies_created"), ("likes_given", "dislikes_given", "flags_given")
NO_RECENT, NO_READING, UNRESOLVED_METADATA, BELOW = "NO_RECENT_OBSERVED_ENGAGEMENT", "no_reading", "unresolved_metadata", "below_threshold"
CLOSURE = 1e-9


class WeeklyError(ValueError):
    """The inputs can't give weekly features."""


@dataclass(frozen=True)
class Settings:
    grid: WeekGrid
    bucket_map: BucketMap
    entitled_states: tuple[str, ...]
    exclusions: tuple[str, ...] = ()
    channels: tuple[str, ...] = v.CHANNELS
    email_lists: tuple[str, ...] | None = None
    min_views: int = 3
    min_sections: int = 2

    def __post_init__(self) -> None:
        if self.min_views < 1 or self.min_sections < 2:
            raise WeeklyError("content activity needs at least 1 view and 2 sections")
        if self.email_lists is not None and not self.email_lists:
            raise WeeklyError("an empty choice of lists would report that nobody clicks")


@dataclass
class Weekly:
    """features: a row for each reader and week; counters: per week readers out of the population and excluded."""

    features: DataFrame
    counters: DataFrame
    anchors: dict[str, str] = field(default_factory=dict)


def week_list(weeks: Sequence[date]) -> Column:
    return F.array(*(F.lit(w) for w in weeks)).cast("array<date>")


def windowed(df: DataFrame, weeks: Sequence[date], grid: WeekGrid) -> DataFrame:
    """df for each of the weeks whose window holds the row's day, with as_of_week_end and bin (1: the latest week)."""
    first = F.date_add("local_date", F.pmod(F.lit(grid.end_index) - F.weekday("local_date"), F.lit(7)))
    each = F.transform(F.sequence(F.lit(1), F.lit(fn.BINS)), lambda b: F.struct(F.date_add(first, (b - 1) * 7).alias("week"), b.alias("bin")))
    kept = F.filter(each, lambda w: F.array_contains(week_list(weeks), w["week"]))
    out = df.where(F.col("local_date").isNotNull()).withColumn("_w", F.explode(kept))
    return out.withColumn("as_of_week_end", F.col("_w.week")).withColumn("bin", F.col("_w.bin")).drop("_w")


def require_columns(df: DataFrame, names: Sequence[str], where: str) -> DataFrame:
    """The named columns alone; a missing one is named, and so is one whose kind may not become a feature."""
    from lectern.model.guards import require_inputs

    if missing := [n for n in names if n not in df.columns]:
        raise WeeklyError(f"{where} has no {missing}")
    require_inputs(names, where)
    return df.select(*names)


def _sums(value: Column, names: dict[str, Column]) -> list[Column]:
    return [F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("double").alias(name) for name, cond in names.items()]


def _days(names: dict[str, Column]) -> list[Column]:
    """Active days of rows that are unique by reader, channel and day, which every build checks: no distinct count is needed."""
    return [F.count_if(cond).cast("double").alias(name) for name, cond in names.items()]


def _bins(cond: Column) -> dict[int, Column]:
    return {k: cond & (F.col("bin") == k) for k in range(1, fn.BINS + 1)}


def consumption(channel_day: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    """All channels and windows from one aggregation; a channel without rows keeps its conditional features null."""
    names = ("reader_id", "channel", "local_date", "views", "sessions", "total_time_seconds", "measured_time_deliveries", "events")
    rows = windowed(require_columns(channel_day, names, "reader_channel_day").where(F.col("reader_id").isNotNull()), weeks, s.grid)
    aggs: list[Column] = []
    for c in s.channels:
        here = F.col("channel") == c
        for label, cond in (("7d", here & (F.col("bin") == 1)), ("28d", here)):
            aggs += [x for m in ("views", "sessions", "events") for x in _sums(F.col(m), {f"{c}_{m}_{label}": cond})] + _days({f"{c}_active_days_{label}": cond})
        aggs += [F.max(F.when(here, F.col("local_date"))).alias(f"_{c}_last"), F.count_if(here).alias(f"_{c}_rows")]
        aggs += _sums(F.col("total_time_seconds"), {f"_{c}_time": here}) + _sums(F.col("measured_time_deliveries"), {f"_{c}_timed": here})
        aggs += [x for k, cond in _bins(here).items() for x in _sums(F.col("views"), {f"_{c}_b{k}": cond})]
    out = rows.groupBy(*KEY).agg(*aggs)
    more: dict[str, Column] = {}
    for c in s.channels:
        some = F.col(f"_{c}_rows") > 0
        b = [F.col(f"_{c}_b{k}") for k in range(1, fn.BINS + 1)]
        more[f"{c}_recency_days"] = fn.recency_days(F.col(f"_{c}_last"), F.col("as_of_week_end"))
        undefined = {
            f"{c}_time_per_view_28d": fn.safe_rate(F.col(f"_{c}_time"), F.col(f"_{c}_timed"), fn.FLOORS["views"]),
            f"{c}_articles_per_session_28d": fn.safe_rate(F.col(f"{c}_views_28d"), F.col(f"{c}_sessions_28d"), fn.FLOORS["sessions"]),
            f"{c}_momentum_4": fn.momentum(*b),
        } | {f"{c}_{n}": x for n, x in fn.bin_metrics(b).items()}
        more |= {n: F.when(some, x) if n.endswith(CONDITIONAL) else x for n, x in undefined.items()}
    return out.withColumns(more).drop(*(n for n in out.columns if n.startswith("_")))


def email(email_day: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    rows = require_columns(email_day, ("reader_id", "list_id", "local_date", "clicks"), "reader_email_day").where((F.col("clicks") > 0) & F.col("reader_id").isNotNull())
    if s.email_lists is not None:
        rows = rows.where(F.col("list_id").isin(*s.email_lists))
    rows = rows.groupBy("reader_id", "local_date").agg(F.sum("clicks").alias("clicks"))
    every, recent = F.lit(True), F.col("bin") == 1
    aggs = _sums(F.col("clicks"), {"email_clicks_7d": recent, "email_clicks_28d": every}) + _days({"email_click_days_7d": recent, "email_click_days_28d": every})
    aggs += [F.max("local_date").alias("_last")] + [x for k, cond in _bins(every).items() for x in _sums(F.col("clicks"), {f"_b{k}": cond})]
    out = windowed(rows, weeks, s.grid).groupBy(*KEY).agg(*aggs)
    metrics = fn.bin_metrics([F.col(f"_b{k}") for k in range(1, fn.BINS + 1)])
    out = out.withColumns({"email_click_recency_days": fn.recency_days(F.col("_last"), F.col("as_of_week_end"))} | {f"email_click_{n}": x for n, x in metrics.items()})
    return out.drop("_last", *(f"_b{k}" for k in range(1, fn.BINS + 1)))


def community(community_day: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    rows = require_columns(community_day, ("reader_id", "local_date", *STEMS), "reader_community_day").where(F.col("reader_id").isNotNull())
    rows = rows.withColumn("_actions", reduce(Column.__add__, (F.coalesce(F.col(c), F.lit(0)) for c in STEMS))).where("_actions > 0")
    every, recent = F.lit(True), F.col("bin") == 1
    aggs: list[Column] = []
    for label, cond in (("7d", recent), ("28d", every)):
        aggs += [x for c, stem in STEMS.items() for x in _sums(F.col(c), {f"{stem}_{label}": cond})]
        aggs += _sums(F.col("_actions"), {f"community_actions_{label}": cond}) + _days({f"community_active_days_{label}": cond})
    aggs += [F.max("local_date").alias("_last")] + [x for k, cond in _bins(every).items() for x in _sums(F.col("_actions"), {f"_b{k}": cond})]
    out = windowed(rows, weeks, s.grid).groupBy(*KEY).agg(*aggs)
    total = lambda names: reduce(Column.__add__, (F.col(f"{STEMS[n]}_28d") for n in names))
    out = out.withColumns({"community_contribution_actions_28d": total(CONTRIBUTIONS), "community_reaction_actions_28d": total(REACTIONS)})
    given = F.col("community_contribution_actions_28d")
    metrics = fn.bin_metrics([F.col(f"_b{k}") for k in range(1, fn.BINS + 1)])
    out = out.withColumns(
        {
            "community_contribution_ratio_28d": fn.safe_rate(given, F.col("community_actions_28d"), fn.FLOORS["actions"]),
            "community_contribution_per_active_day_28d": fn.safe_rate(given, F.col("community_active_days_28d"), fn.FLOORS["active_days"]),
            "community_recency_days": fn.recency_days(F.col("_last"), F.col("as_of_week_end")),
        }
        | {f"community_{n}": x for n, x in metrics.items()}
    )
    return out.drop("_last", *(f"_b{k}" for k in range(1, fn.BINS + 1)))


def bucketed(section_day: DataFrame, s: Settings) -> DataFrame:
    """Section rows with their bucket; unresolved reading has none. The map is a bounded settings file, so it is broadcast."""
    spark = section_day.sparkSession
    pairs = list(s.bucket_map.bucket_of.items())
    names = spark.createDataFrame(pairs, "section string, _bucket string")
    joined = section_day.join(F.broadcast(names), "section", "left")
    bucket = F.when(F.col("section") != v.UNRESOLVED_SECTION, F.coalesce("_bucket", F.lit(s.bucket_map.catch_all)))
    return joined.withColumn("bucket", bucket).drop("_bucket")


def topics(section_day: DataFrame, weeks: Sequence[date], s: Settings, weight: str = "section_views") -> DataFrame:
    rows = require_columns(section_day, ("reader_id", "section", "local_date", weight), "reader_section_day").where(F.col("reader_id").isNotNull())
    rows = windowed(bucketed(rows, s), weeks, s.grid)
    resolved = F.col("section") != v.UNRESOLVED_SECTION
    buckets = s.bucket_map.names
    aggs = _sums(F.col(weight), {"resolved_section_views_28d": resolved, "unresolved_views_28d": ~resolved})
    aggs.append(F.countDistinct(F.when(resolved, F.col("section"))).cast("double").alias("distinct_sections_28d"))
    aggs += _sums(F.col(weight), {f"bucket_views_28d__{b}": F.col("bucket") == b for b in buckets})
    out = rows.groupBy(*KEY).agg(*aggs)
    total = F.col("resolved_section_views_28d")
    out = out.withColumns({f"topic_share_28d__{b}": F.when(total > 0, F.col(f"bucket_views_28d__{b}") / total).otherwise(F.lit(0.0)) for b in buckets})
    shares = [F.col(f"topic_share_28d__{b}") for b in buckets]
    return out.withColumns({"top_bucket_share_28d": F.greatest(*shares), "topic_entropy_28d": fn.entropy(shares)})


def overall(daily: Sequence[DataFrame], weeks: Sequence[date], s: Settings) -> DataFrame:
    """Days on which a reader was active on any channel."""
    union = reduce(DataFrame.unionByName, (d.select("reader_id", "local_date") for d in daily)).where(F.col("reader_id").isNotNull()).distinct()
    aggs = [F.count(F.lit(1)).cast("double").alias("overall_active_days_28d"), *(F.count_if(cond).cast("double").alias(f"_b{k}") for k, cond in _bins(F.lit(True)).items())]
    out = windowed(union, weeks, s.grid).groupBy(*KEY).agg(*aggs)
    return out.select(*KEY, "overall_active_days_28d", fn.momentum(*(F.col(f"_b{k}") for k in range(1, fn.BINS + 1))).alias("overall_momentum_4"))


def span_weeks(intervals: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    """Spans with each week whose window they reach, the state they cover on the week end, and the covered days as bits."""
    end = F.col("end_date")
    near = F.filter(week_list(weeks), lambda w: (F.col("start_date") <= w) & (end.isNull() | (end > F.date_sub(w, fn.WINDOW_DAYS - 1))))
    rows = intervals.withColumn("as_of_week_end", F.explode(near))
    week = F.col("as_of_week_end")
    low = F.greatest(F.date_diff(F.col("start_date"), F.date_sub(week, fn.WINDOW_DAYS - 1)), F.lit(0))
    high = F.least(F.coalesce(F.date_diff(end, F.date_sub(week, fn.WINDOW_DAYS - 1)), F.lit(fn.WINDOW_DAYS)), F.lit(fn.WINDOW_DAYS))
    ones = lambda n: F.expr(f"shiftleft(1L, {n}) - 1L")
    rows = rows.withColumn("_low", low.cast("int")).withColumn("_high", high.cast("int"))
    bits = F.when((F.col("_high") > F.col("_low")) & F.col("state").isin(*s.entitled_states), ones("_high") - ones("_low")).otherwise(F.lit(0).cast("long"))
    covers = (F.col("start_date") <= week) & (end.isNull() | (end > week))
    return rows.withColumn("_bits", bits).withColumn("_covers", covers).drop("_low", "_high")


def population(intervals: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    """For each reader with a span near a week: the covering state (the latest start wins) and the entitled days."""
    if missing := {"reader_id", "state", "start_date", "end_date"} - set(intervals.columns):
        raise WeeklyError(f"subscription_state_interval has no {sorted(missing)}")
    if "payer_type" not in intervals.columns:
        intervals = intervals.withColumn("payer_type", F.lit(None).cast("string"))
    order = F.when(F.col("_covers"), F.struct("start_date", *(["start_ts"] if "start_ts" in intervals.columns else []), "state"))
    return (
        span_weeks(intervals, weeks, s)
        .groupBy(*KEY)
        .agg(F.max_by(F.struct("state", "payer_type"), order).alias("_now"), F.bit_count(F.bit_or("_bits")).cast("int").alias("entitled_days_in_window"))
    )


def _excluded(s: Settings) -> Column:
    return F.coalesce(F.col("reader_id").isin(*s.exclusions), F.lit(False)) if s.exclusions else F.lit(False)


def spine(intervals: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    """One row for each entitled reader and week."""
    people = population(intervals, weeks, s).where(~_excluded(s) & F.col("_now.state").isin(*s.entitled_states))
    partial = F.col("entitled_days_in_window") < fn.WINDOW_DAYS
    return people.select(*KEY, "_now.state", "_now.payer_type", "entitled_days_in_window", partial.alias("partial_window_flag"), partial.cast("int").alias("projected_flag"))


def counters(intervals: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    """For each week how many readers of the spans are in the population, out of it, or excluded by the manifest."""
    readers = intervals.select("reader_id").distinct().agg(F.count(F.lit(1)).alias("_all"), F.count_if(_excluded(s)).alias("excluded"))
    inside = spine(intervals, weeks, s).groupBy("as_of_week_end").agg(F.count(F.lit(1)).alias("in_population"))
    every = readers.withColumn("as_of_week_end", F.explode(week_list(weeks))).join(inside, "as_of_week_end", "left")
    have = F.coalesce("in_population", F.lit(0))
    return every.select("as_of_week_end", have.alias("in_population"), (F.col("_all") - F.col("excluded") - have).alias("out_of_population"), "excluded")


def joined(frame: DataFrame, features: DataFrame) -> DataFrame:
    """Features on the spine, with the fill that each feature's class asks for."""
    out = frame.join(features, KEY, "left")
    names = [n for n in features.columns if n not in KEY]
    fill = {n: F.coalesce(n, F.lit(float(fn.RECENCY_CAP) if n.endswith("_recency_days") else 0.0)) for n in names if not n.endswith(CONDITIONAL)}
    return out.withColumns(fill)


def no_recent(anchors: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.coalesce(F.col(a), F.lit(0.0)) == 0 for a in anchors))


def content_active(s: Settings) -> Column:
    return (F.coalesce("resolved_section_views_28d", F.lit(0.0)) >= s.min_views) & (F.coalesce("distinct_sections_28d", F.lit(0.0)) >= s.min_sections)


def no_topic_reason(s: Settings) -> Column:
    resolved, unresolved = (F.coalesce(c, F.lit(0.0)) for c in ("resolved_section_views_28d", "unresolved_views_28d"))
    text = F.lit(None).cast("string")
    return F.when(content_active(s), text).when((resolved == 0) & (unresolved == 0), NO_READING).when((resolved == 0) & (unresolved > 0), UNRESOLVED_METADATA).otherwise(BELOW)


def anchors_of(s: Settings, email_there: bool, community_there: bool) -> dict[str, str]:
    return {c: f"{c}_views_28d" for c in s.channels} | ({"email": "email_clicks_28d"} if email_there else {}) | ({"community": "community_actions_28d"} if community_there else {})


def build_weekly(tables: dict[str, DataFrame], weeks: Sequence[date], s: Settings) -> Weekly:
    """The wide weekly table of all weeks; optional tables that are absent leave their columns out."""
    for w in weeks:
        s.grid.require(w)
    mail, social = tables.get("reader_email_day"), tables.get("reader_community_day")
    frame = joined(spine(tables["subscription_state_interval"], weeks, s), consumption(tables["reader_channel_day"], weeks, s))
    recency = [f"{c}_recency_days" for c in s.channels]
    if mail is not None:
        frame = joined(frame, email(mail, weeks, s))
        recency.append("email_click_recency_days")
    if social is not None:
        frame = joined(frame, community(social, weeks, s))
        recency.append("community_recency_days")
    plain = lambda df: frame_fill(frame, df)
    frame = plain(topics(tables["reader_section_day"], weeks, s))
    frame = plain(overall([t for t in (tables["reader_channel_day"], mail, social) if t is not None], weeks, s))
    frame = frame.withColumn("overall_recency_days", F.least(*recency))
    anchors = anchors_of(s, mail is not None, social is not None)
    frame = frame.withColumns({"content_active_flag": content_active(s), "no_recent_flag": no_recent(list(anchors.values())), "no_topic_profile_reason": no_topic_reason(s)})
    return Weekly(frame, counters(tables["subscription_state_interval"], weeks, s), anchors)


def frame_fill(frame: DataFrame, features: DataFrame) -> DataFrame:
    """Features on the spine with 0 for all that is missing."""
    out = frame.join(features, KEY, "left")
    return out.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in features.columns if n not in KEY})


def fanned_out(frame: DataFrame) -> DataFrame:
    """Reader-weeks on more than one row."""
    return frame.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unclosed_shares(frame: DataFrame, s: Settings) -> DataFrame:
    """Content-active reader-weeks whose bucket shares don't sum to 1."""
    total = reduce(Column.__add__, (F.col(f"topic_share_28d__{b}") for b in s.bucket_map.names))
    return frame.where("content_active_flag").select(*KEY, (total - 1.0).alias("deviation")).where(F.abs("deviation") > CLOSURE)


def future_rows(df: DataFrame, week_end: date) -> DataFrame:
    return df.where(F.col("local_date") > F.lit(week_end))


def section_shares(section_day: DataFrame, weeks: Sequence[date], s: Settings) -> DataFrame:
    """Share of each section in a week's resolved reading."""
    rows = windowed(section_day.where(F.col("section") != v.UNRESOLVED_SECTION), weeks, s.grid)
    each = rows.groupBy("as_of_week_end", "section").agg(F.sum("section_views").alias("views"))
    total = each.groupBy("as_of_week_end").agg(F.sum("views").alias("total"))
    return each.join(total, "as_of_week_end").where("total > 0").select("as_of_week_end", "section", (F.col("views") / F.col("total")).alias("share"))


def bucket_completeness(section_day: DataFrame, week: date, s: Settings) -> Completeness:
    """The map's completeness in a week: the rest's share is summed in the plan, only unmapped sections of weight come back."""
    rest = bucketed(section_shares(section_day, [week], s), s).where(F.col("bucket") == s.bucket_map.catch_all)
    share = rest.agg(F.coalesce(F.sum("share"), F.lit(0.0))).first()[0]
    heavy = tuple(sorted(r.section for r in rest.where(F.col("share") >= s.bucket_map.completeness_min_view_share).select("section").collect()))
    return Completeness(heavy, float(share), not heavy and share <= s.bucket_map.catch_all_share_max)


def resolved_share(features: DataFrame) -> DataFrame:
    """Resolved reading over all reading by week; 0 where there was none."""
    r, u = F.sum("resolved_section_views_28d"), F.sum("unresolved_views_28d")
    return features.groupBy("as_of_week_end").agg(F.when(r + u > 0, r / (r + u)).otherwise(F.lit(0.0)).alias("resolved_view_share"))


def full_weeks(tables: dict[str, DataFrame], grid: WeekGrid) -> list[date]:
    """Week ends whose whole window lies within the days that the daily tables have."""
    there = [tables[n].agg(F.min("local_date").alias("a"), F.max("local_date").alias("b")) for n in ("reader_channel_day", "reader_section_day", "reader_email_day", "reader_community_day") if tables.get(n) is not None]
    first, last = reduce(DataFrame.unionByName, there).agg(F.min("a"), F.max("b")).first()
    return grid.full_window_ends(first, last) if first else []


def latest_dates(tables: dict[str, DataFrame]) -> DataFrame:
    """The last day of each daily table."""
    return reduce(DataFrame.unionByName, (df.agg(F.lit(n).alias("source"), F.max("local_date").alias("latest")) for n, df in tables.items() if df is not None and "local_date" in df.columns))


def stale_sources(latest: DataFrame, week_end: date) -> list[str]:
    return sorted(f"{r.source} (through {r.latest})" for r in latest.where(F.col("latest") < F.lit(week_end)).collect())
