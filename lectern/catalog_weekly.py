"""Queries of the weekly layer, the panel, calibration and scoring, with their SQL.

All week ends that the daily tables cover are used, so windows reach back before the first day for the first ones.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import cached_property, reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.catalog import build, register, rounded
from lectern.contract import validate as va
from lectern.functions import columns as fn
from lectern.model import calibration as cal
from lectern.model.assignment import assign
from lectern.model.measures import with_percentile
from lectern.operators import daily
from lectern.operators.ranks import ranked
from lectern.operators.sessions import sessionize
from lectern.plans import panel as pn
from lectern.plans import temporal, weekly
from lectern.plans.buckets import BucketMap
from lectern.plans.grid import WeekGrid
from lectern.session import staged
from lectern.sources.testdata import delivery, manifest, sql

BUCKETS = BucketMap("testdata-1", {"english": ("en",), "romance": ("fr", "es")})
SEED = 20260824
SETTINGS = weekly.Settings(WeekGrid.of(manifest().week_anchor), BUCKETS, manifest().population.entitled_states)


class Run:
    """The daily tables, weeks and weekly features of one call, each made once."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: weekly.Settings = SETTINGS) -> None:
        self.settings, self.spark, self.sf_dir = settings, spark, sf_dir
        c = build(spark, sf_dir)
        self.tables = daily.outputs(c)
        # the days that the daily tables have, from the events themselves: the tables needn't be built for that
        zone = c.manifest.timezone
        dated = [c[daily.EVENTS].where("is_view").select("local_date")]
        dated += [c.inputs[t].select(fn.local_date(F.col("event_ts"), zone).alias("local_date")) for t in ("email_click", "email_open", "community_action")]
        first, last = reduce(DataFrame.unionByName, dated).agg(F.min("local_date"), F.max("local_date")).first()
        self.weeks = settings.grid.week_ends(first, last)

    @cached_property
    def features(self) -> DataFrame:
        """The weekly table over staged daily tables, for a query that reads it once."""
        tables = daily.outputs(build(self.spark, self.sf_dir).stage("reader_content_day", "reader_channel_day"))
        return weekly.build_weekly(tables, self.weeks, self.settings).features

    @cached_property
    def written(self) -> DataFrame:
        """The weekly table as written once, for queries that read it several times."""
        return staged(self.features, "features")

    @property
    def intervals(self) -> DataFrame:
        return self.tables["subscription_state_interval"]


def query(*names: str, body: str | None = None, **more: str) -> Callable[[Callable[[Run], DataFrame]], Callable[[Run], DataFrame]]:
    """Registers a query over a Run under each of its inventory ids."""

    def add(make: Callable[[Run], DataFrame]) -> Callable[[Run], DataFrame]:
        for name in names:
            register(name, sql(body, **(TABLES | more)) if body else None)(lambda spark, sf_dir: rounded(make(Run(spark, sf_dir))))
        return make

    return add


def _metrics(b: list[str], prefix: str) -> dict[str, str]:
    total = "(" + " + ".join(b) + ")"
    mean = "(" + " + ".join(f"ln(1 + {x})" for x in b) + ") / 4"
    share = lambda x: f"CASE WHEN {x} > 0 THEN {x} / {total} * ln({x} / {total}) ELSE 0 END"
    return {
        f"{prefix}_active_weeks_4": "(" + " + ".join(f"CASE WHEN {x} > 0 THEN 1.0 ELSE 0.0 END" for x in b) + ")::DOUBLE",
        f"{prefix}_top_week_share_4": f"CASE WHEN {total} > 0 THEN greatest({', '.join(b)}) / {total} ELSE 0 END",
        f"{prefix}_weekly_cv_4": "sqrt((" + " + ".join(f"power(ln(1 + {x}) - {mean}, 2)" for x in b) + f") / 4) / ({mean} + 1e-9)",
        f"{prefix}_weekly_evenness_entropy_4": f"CASE WHEN {total} > 0 THEN -(" + " + ".join(map(share, b)) + ") / ln(4) ELSE 0 END",
    }


def _sum(value: str, cond: str) -> str:
    return f"coalesce(sum({value}) FILTER ({cond}), 0)::DOUBLE"


def _momentum(b: list[str]) -> str:
    return f"ln(1 + {b[0]} + {b[1]}) - ln(1 + {b[2]} + {b[3]})"


_INNER, _OUTER = [], []
for _c in SETTINGS.channels:
    _here = f"channel = '{_c}'"
    for _label, _cond in (("7d", f"{_here} AND bin = 1"), ("28d", _here)):
        _INNER += [f"{_sum(m, _cond)} AS {_c}_{m}_{_label}" for m in ("views", "sessions", "events")] + [f"(count(DISTINCT local_date) FILTER ({_cond}))::DOUBLE AS {_c}_active_days_{_label}"]
    _INNER += [f"max(local_date) FILTER ({_here}) AS {_c}_last", f"count(*) FILTER ({_here}) AS {_c}_rows", f"{_sum('total_time_seconds', _here)} AS {_c}_time", f"{_sum('measured_time_deliveries', _here)} AS {_c}_timed"]
    _INNER += [f"{_sum('views', f'{_here} AND bin = {k}')} AS {_c}_b{k}" for k in range(1, 5)]
    _b = [f"{_c}_b{k}" for k in range(1, 5)]
    _OUTER += [f"{_c}_{m}_{w}" for w in ("7d", "28d") for m in ("views", "sessions", "events", "active_days")]
    _OUTER.append(f"coalesce(datediff('day', {_c}_last, as_of_week_end), 29)::DOUBLE AS {_c}_recency_days")
    _some = {f"{_c}_time_per_view_28d": f"{_c}_time / greatest({_c}_timed, 3.0)", f"{_c}_articles_per_session_28d": f"{_c}_views_28d / greatest({_c}_sessions_28d, 2.0)", f"{_c}_momentum_4": _momentum(_b)} | _metrics(_b, _c)
    _OUTER += [(f"CASE WHEN {_c}_rows > 0 THEN {x} END" if n.endswith(weekly.CONDITIONAL) else x) + f" AS {n}" for n, x in _some.items()]
_EB, _MB, _UB = ([f"b{k}" for k in range(1, 5)] for _ in range(3))
_MAIL = ["email_clicks_7d", "email_clicks_28d", "email_click_days_7d", "email_click_days_28d", "coalesce(datediff('day', last, as_of_week_end), 29)::DOUBLE AS email_click_recency_days", *(f"{x} AS {n}" for n, x in _metrics(_EB, "email_click").items())]
_SOCIAL_IN, _SOCIAL = [], []
for _label, _cond in (("7d", "bin = 1"), ("28d", "true")):
    _SOCIAL_IN += [f"{_sum(c, _cond)} AS {stem}_{_label}" for c, stem in weekly.STEMS.items()] + [f"{_sum('actions', _cond)} AS community_actions_{_label}", f"(count(DISTINCT local_date) FILTER ({_cond}))::DOUBLE AS community_active_days_{_label}"]
    _SOCIAL += [f"{stem}_{_label}" for stem in weekly.STEMS.values()] + [f"community_actions_{_label}", f"community_active_days_{_label}"]
_GIVEN = "(community_posts_28d + community_replies_28d)"
_SOCIAL += [f"{_GIVEN} AS community_contribution_actions_28d", "community_likes_28d + community_dislikes_28d + community_flags_28d AS community_reaction_actions_28d", f"{_GIVEN} / greatest(community_actions_28d, 1.0) AS community_contribution_ratio_28d", f"{_GIVEN} / greatest(community_active_days_28d, 1.0) AS community_contribution_per_active_day_28d", "coalesce(datediff('day', last, as_of_week_end), 29)::DOUBLE AS community_recency_days", *(f"{x} AS {n}" for n, x in _metrics(_MB, "community").items())]
_SHARES = [f"topic_share_28d__{b}" for b in BUCKETS.names]
_ENTROPY = "-(" + " + ".join(f"CASE WHEN {s} > 0 THEN {s} * ln({s}) ELSE 0 END" for s in _SHARES) + f") / ln({len(_SHARES)})"
_WINDOW = "JOIN weeks w ON d.local_date BETWEEN w.as_of_week_end - 27 AND w.as_of_week_end"
_BIN = "w.as_of_week_end, datediff('day', d.local_date, w.as_of_week_end) // 7 + 1 AS bin"
_BUCKET = "CASE WHEN section = '__unresolved__' THEN NULL " + " ".join(f"WHEN section IN ({', '.join(repr(x) for x in parts)}) THEN '{b}'" for b, parts in BUCKETS.buckets.items()) + f" ELSE '{BUCKETS.catch_all}' END"


def _names(parts: list[str]) -> list[str]:
    return [p.rsplit(" AS ", 1)[-1] for p in parts]


def _fill(table: str, names: list[str]) -> list[str]:
    return [f"{table}.{n}" if n.endswith(weekly.CONDITIONAL) else f"coalesce({table}.{n}, {'29' if n.endswith('_recency_days') else '0'}) AS {n}" for n in names]


_TOPIC = ["resolved_section_views_28d", "unresolved_views_28d", "distinct_sections_28d", *(f"bucket_views_28d__{b}" for b in BUCKETS.names), *_SHARES, "top_bucket_share_28d", "topic_entropy_28d"]
_ACTIVE = "(resolved_section_views_28d >= 3 AND distinct_sections_28d >= 2)"
TABLES = {
    "days": "SELECT local_date FROM reader_channel_day UNION ALL SELECT local_date FROM reader_section_day UNION ALL SELECT local_date FROM reader_email_day UNION ALL SELECT local_date FROM reader_community_day",
    "weeks": "SELECT w::DATE AS as_of_week_end FROM (SELECT a, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS w FROM (SELECT min(local_date) AS a, max(local_date) AS b FROM days)) WHERE isodow(w) = 7 AND w::DATE - 6 >= a",
    "cw": f"SELECT d.*, {_BIN} FROM reader_channel_day d {_WINDOW}",
    "ew": f"SELECT d.*, {_BIN} FROM reader_email_day d {_WINDOW} WHERE clicks > 0",
    "social": f"SELECT *, {' + '.join(weekly.STEMS)} AS actions FROM reader_community_day",
    "mw": f"SELECT d.*, {_BIN} FROM social d {_WINDOW} WHERE actions > 0",
    "sw": f"SELECT d.*, {_BUCKET} AS bucket, {_BIN} FROM reader_section_day d {_WINDOW}",
    "active": "SELECT DISTINCT reader_id, local_date FROM (SELECT reader_id, local_date FROM reader_channel_day UNION ALL SELECT reader_id, local_date FROM reader_email_day UNION ALL SELECT reader_id, local_date FROM reader_community_day)",
    "uw": f"SELECT d.*, {_BIN} FROM active d {_WINDOW}",
    "consumption": f"SELECT reader_id, as_of_week_end, {', '.join(_OUTER)} FROM (SELECT reader_id, as_of_week_end, {', '.join(_INNER)} FROM cw GROUP BY reader_id, as_of_week_end)",
    "mail": f"SELECT reader_id, as_of_week_end, {', '.join(_MAIL)} FROM (SELECT reader_id, as_of_week_end, {_sum('clicks', 'bin = 1')} AS email_clicks_7d, {_sum('clicks', 'true')} AS email_clicks_28d, (count(DISTINCT local_date) FILTER (bin = 1))::DOUBLE AS email_click_days_7d, count(DISTINCT local_date)::DOUBLE AS email_click_days_28d, max(local_date) AS last, {', '.join(f'{_sum("clicks", f"bin = {k}")} AS b{k}' for k in range(1, 5))} FROM ew GROUP BY reader_id, as_of_week_end)",
    "community": f"SELECT reader_id, as_of_week_end, {', '.join(_SOCIAL)} FROM (SELECT reader_id, as_of_week_end, {', '.join(_SOCIAL_IN)}, max(local_date) AS last, {', '.join(f'{_sum("actions", f"bin = {k}")} AS b{k}' for k in range(1, 5))} FROM mw GROUP BY reader_id, as_of_week_end)",
    "topic": f"SELECT *, greatest({', '.join(_SHARES)}) AS top_bucket_share_28d, {_ENTROPY} AS topic_entropy_28d FROM (SELECT *, {', '.join(f'CASE WHEN resolved_section_views_28d > 0 THEN bucket_views_28d__{b} / resolved_section_views_28d ELSE 0 END AS topic_share_28d__{b}' for b in BUCKETS.names)} FROM (SELECT reader_id, as_of_week_end, {_sum('section_views', 'bucket IS NOT NULL')} AS resolved_section_views_28d, {_sum('section_views', 'bucket IS NULL')} AS unresolved_views_28d, (count(DISTINCT section) FILTER (bucket IS NOT NULL))::DOUBLE AS distinct_sections_28d, {', '.join(f"{_sum('section_views', f"bucket = '{b}'")} AS bucket_views_28d__{b}" for b in BUCKETS.names)} FROM sw GROUP BY reader_id, as_of_week_end))",
    "overall": f"SELECT reader_id, as_of_week_end, n AS overall_active_days_28d, {_momentum(_UB)} AS overall_momentum_4 FROM (SELECT reader_id, as_of_week_end, count(*)::DOUBLE AS n, {', '.join(f'(count(*) FILTER (bin = {k}))::DOUBLE AS b{k}' for k in range(1, 5))} FROM uw GROUP BY reader_id, as_of_week_end)",
    "reach": "SELECT i.*, w.as_of_week_end FROM subscription_state_interval i JOIN weeks w ON i.start_date <= w.as_of_week_end AND (i.end_date IS NULL OR i.end_date > w.as_of_week_end - 27)",
    "covering": "SELECT reader_id, as_of_week_end, state, payer_type FROM (SELECT *, row_number() OVER (PARTITION BY reader_id, as_of_week_end ORDER BY start_date DESC, start_ts DESC) AS pos FROM reach WHERE end_date IS NULL OR end_date > as_of_week_end) WHERE pos = 1",
    "covered": "SELECT reader_id, as_of_week_end, count(DISTINCT d) AS n FROM (SELECT reader_id, as_of_week_end, unnest(generate_series(greatest(start_date, as_of_week_end - 27)::TIMESTAMP, least(coalesce(end_date - 1, as_of_week_end), as_of_week_end)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM reach WHERE state IN ('trial', 'active', 'grace')) GROUP BY reader_id, as_of_week_end",
    "spine": "SELECT c.reader_id, c.as_of_week_end, c.state, c.payer_type, coalesce(d.n, 0)::INTEGER AS entitled_days_in_window, coalesce(d.n, 0) < 28 AS partial_window_flag, (coalesce(d.n, 0) < 28)::INTEGER AS projected_flag FROM covering c LEFT JOIN covered d ON d.reader_id = c.reader_id AND d.as_of_week_end = c.as_of_week_end WHERE c.state IN ('trial', 'active', 'grace')",
    "wide0": "SELECT s.*, " + ", ".join(_fill("consumption", _names(_OUTER)) + _fill("mail", _names(_MAIL)) + _fill("community", _names(_SOCIAL)) + [f"coalesce(topic.{n}, 0) AS {n}" for n in _TOPIC] + [f"coalesce(overall.{n}, 0) AS {n}" for n in ("overall_active_days_28d", "overall_momentum_4")]) + " FROM spine s " + " ".join(f"LEFT JOIN {t} ON {t}.reader_id = s.reader_id AND {t}.as_of_week_end = s.as_of_week_end" for t in ("consumption", "mail", "community", "topic", "overall")),
    "features": f"SELECT *, least(web_recency_days, app_recency_days, email_click_recency_days, community_recency_days) AS overall_recency_days, {_ACTIVE} AS content_active_flag, web_views_28d = 0 AND app_views_28d = 0 AND email_clicks_28d = 0 AND community_actions_28d = 0 AS no_recent_flag, CASE WHEN {_ACTIVE} THEN NULL WHEN resolved_section_views_28d = 0 AND unresolved_views_28d = 0 THEN 'no_reading' WHEN resolved_section_views_28d = 0 THEN 'unresolved_metadata' ELSE 'below_threshold' END AS no_topic_profile_reason FROM wide0",
    "eligible": "SELECT * FROM features WHERE NOT partial_window_flag AND NOT no_recent_flag",
    "numbered": f"SELECT *, strftime(as_of_week_end, '%Y-%m') AS month, count(*) OVER (PARTITION BY reader_id, strftime(as_of_week_end, '%Y-%m')) AS n, row_number() OVER (PARTITION BY reader_id, strftime(as_of_week_end, '%Y-%m') ORDER BY as_of_week_end) AS place, sha256('{SEED}:' || reader_id || ':' || strftime(as_of_week_end, '%Y-%m')) AS h FROM eligible",
    "panel": "SELECT * FROM numbered WHERE place = 1 + list_reduce([0::HUGEINT] || [('0x' || substr(h, 8 * k + 1, 8))::BIGINT::HUGEINT FOR k IN range(8)], lambda acc, x: (acc * 4294967296 + x) % n)",
    "balanced": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY sha256('{SEED}:' || reader_id || ':' || as_of_week_end)) AS pos FROM panel) WHERE pos <= (SELECT min(c) FROM (SELECT count(*) AS c FROM panel GROUP BY month))",
    "active_panel": "SELECT * FROM balanced WHERE content_active_flag",
}
_FLOATS = {n for n in _names(_OUTER) + _names(_MAIL) + _names(_SOCIAL) + _TOPIC} | {"overall_active_days_28d", "overall_momentum_4", "overall_recency_days"}
_ALL = [*weekly.SPINE, *_names(_OUTER), *_names(_MAIL), *_names(_SOCIAL), *_TOPIC, "overall_active_days_28d", "overall_momentum_4", "overall_recency_days", "content_active_flag", "no_recent_flag", "no_topic_profile_reason"]


def pick(names: list[str], table: str, where: str = "") -> str:
    return "SELECT " + ", ".join(f"round({n}, 6) + 0.0 AS {n}" if n in _FLOATS else n for n in names) + f" FROM {table} {where}"


KEY = ["reader_id", "as_of_week_end"]


def columns_query(names: tuple[str, ...], columns: list[str], table: str, make: Callable[[Run], DataFrame]) -> None:
    query(*names, body=pick([*KEY, *columns], table))(lambda r: make(r).select(*KEY, *columns))


consumed = lambda r: weekly.consumption(r.tables["reader_channel_day"], r.weeks, r.settings)
columns_query(("fe_3",), _names(_OUTER), "consumption", consumed)
columns_query(("agg_8", "flt_2"), [n for n in _names(_OUTER) if n.split("_")[1] in ("views", "sessions", "events")], "consumption", consumed)
columns_query(("agg_9",), [n for n in _names(_OUTER) if "active_days" in n], "consumption", consumed)
columns_query(("agg_10", "fn_6"), [n for n in _names(_OUTER) if "recency" in n], "consumption", consumed)
columns_query(("fe_6", "fn_8"), [n for n in _names(_OUTER) if n.endswith("_4")], "consumption", consumed)
columns_query(("fn_7",), ["web_momentum_4", "app_momentum_4"], "consumption", consumed)
columns_query(("fn_5",), ["web_time_per_view_28d", "app_time_per_view_28d", "web_articles_per_session_28d", "app_articles_per_session_28d"], "consumption", consumed)
columns_query(("fe_4",), _names(_MAIL), "mail", lambda r: weekly.email(r.tables["reader_email_day"], r.weeks, r.settings))
columns_query(("fe_5", "fn_15"), _names(_SOCIAL), "community", lambda r: weekly.community(r.tables["reader_community_day"], r.weeks, r.settings))
topical = lambda r: weekly.topics(r.tables["reader_section_day"], r.weeks, r.settings)
columns_query(("fe_7", "agg_12"), _TOPIC, "topic", topical)
columns_query(("fn_12", "fn_16"), ["top_bucket_share_28d", "topic_entropy_28d"], "topic", topical)
columns_query(("flt_5",), ["resolved_section_views_28d", "unresolved_views_28d"], "topic", topical)
columns_query(("agg_13", "set_4"), ["overall_active_days_28d", "overall_momentum_4"], "overall", lambda r: weekly.overall([r.tables[t] for t in ("reader_channel_day", "reader_email_day", "reader_community_day")], r.weeks, r.settings))
columns_query(("fe_2", "win_7", "jn_11"), list(weekly.SPINE[2:]), "spine", lambda r: weekly.spine(r.intervals, r.weeks, r.settings))
columns_query(("win_3",), ["entitled_days_in_window"], "spine", lambda r: weekly.spine(r.intervals, r.weeks, r.settings))
columns_query(("fe_10",), _ALL[2:], "features", lambda r: r.features)
columns_query(("jn_9",), [*_names(_OUTER), *_names(_MAIL), *_names(_SOCIAL)], "features", lambda r: r.features)
columns_query(("jn_10",), [*_TOPIC, "overall_active_days_28d", "overall_momentum_4"], "features", lambda r: r.features)
columns_query(("fn_14",), ["overall_recency_days"], "features", lambda r: r.features)
columns_query(("flt_7",), ["no_recent_flag"], "features", lambda r: r.features)
columns_query(("flt_9",), ["content_active_flag"], "features", lambda r: r.features)
columns_query(("flt_10",), ["no_topic_profile_reason"], "features", lambda r: r.features)


@query("flt_1", "agg_11", body="SELECT reader_id, channel, local_date, as_of_week_end, bin::INTEGER AS bin, views FROM cw")
def flt_1(r: Run) -> DataFrame:
    return weekly.windowed(r.tables["reader_channel_day"], r.weeks, r.settings.grid).select("reader_id", "channel", "local_date", "as_of_week_end", "bin", "views")


@query("flt_3", body="SELECT reader_id, as_of_week_end, sum(clicks)::DOUBLE AS email_clicks_28d FROM ew WHERE list_id = 'lst-0' GROUP BY ALL")
def flt_3(r: Run) -> DataFrame:
    only = weekly.Settings(r.settings.grid, BUCKETS, r.settings.entitled_states, email_lists=("lst-0",))
    return weekly.email(r.tables["reader_email_day"], r.weeks, only).select(*KEY, "email_clicks_28d")


@query("flt_4", body="SELECT reader_id, local_date FROM social WHERE actions > 0")
def flt_4(r: Run) -> DataFrame:
    total = reduce(lambda a, b: a + b, (F.col(c) for c in weekly.STEMS))
    return r.tables["reader_community_day"].where(total > 0).select("reader_id", "local_date")


@query("flt_6", body="SELECT * FROM spine WHERE reader_id NOT IN ('rdr-3', 'rdr-10')")
def flt_6(r: Run) -> DataFrame:
    out = weekly.Settings(r.settings.grid, BUCKETS, r.settings.entitled_states, exclusions=("rdr-3", "rdr-10"))
    return weekly.spine(r.intervals, r.weeks, out)


@query("flt_8", body="SELECT reader_id, as_of_week_end FROM features WHERE NOT no_recent_flag")
def flt_8(r: Run) -> DataFrame:
    return r.features.where("NOT no_recent_flag").select(*KEY)


@query("flt_11", body="SELECT reader_id, as_of_week_end FROM eligible")
def flt_11(r: Run) -> DataFrame:
    return pn.eligible(r.features).select(*KEY)


@query("flt_13", body="SELECT reader_id, as_of_week_end, web_views_28d > 0 AS web_active, app_views_28d > 0 AS app_active FROM features")
def flt_13(r: Run) -> DataFrame:
    return r.features.select(*KEY, *((F.col(f"{c}_views_28d") > 0).alias(f"{c}_active") for c in r.settings.channels))


@query("flt_14", body="SELECT reader_id, channel, local_date, views FROM reader_channel_day WHERE local_date > (SELECT max(as_of_week_end) FROM weeks)")
def flt_14(r: Run) -> DataFrame:
    return weekly.future_rows(r.tables["reader_channel_day"], r.weeks[-1]).select("reader_id", "channel", "local_date", "views")


@query("agg_14", body="SELECT as_of_week_end, section, round(sum(section_views) / sum(sum(section_views)) OVER (PARTITION BY as_of_week_end), 6) AS share FROM sw WHERE section <> '__unresolved__' GROUP BY as_of_week_end, section")
def agg_14(r: Run) -> DataFrame:
    return weekly.section_shares(r.tables["reader_section_day"], r.weeks, r.settings)


@query("agg_15", body="SELECT as_of_week_end, round(CASE WHEN sum(resolved_section_views_28d + unresolved_views_28d) > 0 THEN sum(resolved_section_views_28d) / sum(resolved_section_views_28d + unresolved_views_28d) ELSE 0 END, 6) AS resolved_view_share FROM topic GROUP BY as_of_week_end")
def agg_15(r: Run) -> DataFrame:
    return weekly.resolved_share(topical(r))


@query("agg_22", body=" UNION ALL ".join(f"SELECT '{t}' AS source, max(local_date) AS latest FROM {t}" for t in ("reader_channel_day", "reader_community_day", "reader_content_day", "reader_email_day", "reader_section_day")))
def agg_22(r: Run) -> DataFrame:
    return weekly.latest_dates(r.tables)


@query("agg_24", body="SELECT w.as_of_week_end, count(s.reader_id) AS in_population, (SELECT count(DISTINCT reader_id) FROM subscription_state_interval) - count(s.reader_id) AS out_of_population, 0::BIGINT AS excluded FROM weeks w LEFT JOIN spine s ON s.as_of_week_end = w.as_of_week_end GROUP BY w.as_of_week_end")
def agg_24(r: Run) -> DataFrame:
    return weekly.counters(r.intervals, r.weeks, r.settings)


@query("jn_15", body=f"SELECT reader_id, section, local_date, {_BUCKET} AS bucket FROM reader_section_day")
def jn_15(r: Run) -> DataFrame:
    return weekly.bucketed(r.tables["reader_section_day"], r.settings).select("reader_id", "section", "local_date", "bucket")


@query("jn_16", "set_5", body="SELECT count(*) AS n FROM (SELECT 1 FROM features GROUP BY reader_id, as_of_week_end HAVING count(*) > 1)")
def jn_16(r: Run) -> DataFrame:
    return weekly.fanned_out(r.features).agg(F.count(F.lit(1)).alias("n"))


@query("fe_8", body="SELECT count(*) AS n FROM features WHERE content_active_flag AND abs(" + " + ".join(_SHARES) + " - 1) > 1e-9")
def fe_8(r: Run) -> DataFrame:
    return weekly.unclosed_shares(r.features, r.settings).agg(F.count(F.lit(1)).alias("n"))


@query("fe_1", body="SELECT as_of_week_end, as_of_week_end - 6 AS week_start, as_of_week_end - 27 AS window_start FROM weeks")
def fe_1(r: Run) -> DataFrame:
    rows = [(w, w - timedelta(6), r.settings.grid.trailing(w).start) for w in r.weeks]
    return r.intervals.sparkSession.createDataFrame(rows, "as_of_week_end date, week_start date, window_start date")


@query("fe_9", body=f"SELECT as_of_week_end, round(sum(CASE WHEN bucket = '{BUCKETS.catch_all}' THEN section_views ELSE 0 END) / sum(section_views), 6) AS catch_all_share FROM sw WHERE bucket IS NOT NULL GROUP BY as_of_week_end")
def fe_9(r: Run) -> DataFrame:
    shares = weekly.bucketed(weekly.section_shares(r.tables["reader_section_day"], r.weeks, r.settings), r.settings)
    return shares.groupBy("as_of_week_end").agg(F.sum(F.when(F.col("bucket") == BUCKETS.catch_all, F.col("share")).otherwise(F.lit(0.0))).alias("catch_all_share"))


# --- panel and calibration ---


@query("win_5", "fn_17", "fn_18", body="SELECT reader_id, as_of_week_end FROM panel")
def win_5(r: Run) -> DataFrame:
    return pn.sample(pn.eligible(r.features), SEED).select(*KEY)


def balanced(r: Run) -> DataFrame:
    return pn.balance(staged(pn.sample(pn.eligible(r.features), SEED), "sampled"), SEED)


query("win_6", "fe_11", body="SELECT reader_id, as_of_week_end FROM balanced")(lambda r: balanced(r).select(*KEY))
query("flt_12", body="SELECT reader_id, as_of_week_end FROM active_panel")(lambda r: pn.content_active(balanced(r)).select(*KEY))


@query("agg_18", body="SELECT month, count(*) AS n_before, coalesce((SELECT count(*) FROM balanced b WHERE b.month = p.month), 0) AS n_after FROM panel p GROUP BY month")
def agg_18(r: Run) -> DataFrame:
    chosen = staged(pn.sample(pn.eligible(r.features), SEED), "sampled")
    return pn.balance_record(chosen, pn.balance(chosen, SEED))


SCALED = {"z_log__web_views_28d": ("web_views_28d", True), "z_log__app_views_28d": ("app_views_28d", True), "z_log__overall_active_days_28d": ("overall_active_days_28d", True), "z__topic_entropy_28d": ("topic_entropy_28d", False)}
_VALUE = {n: f"ln(1 + {c})" if logged else c for n, (c, logged) in SCALED.items()}
_LONG = " UNION ALL ".join(f"SELECT '{n}' AS feature, avg({x}) AS mean, stddev_pop({x}) AS std, quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) AS iqr FROM eligible" for n, x in _VALUE.items())


def scaled() -> dict:
    from lectern.model.surface import value

    return {n: value(c, logged) for n, (c, logged) in SCALED.items()}


@query("fe_12", "agg_19", "agg_20", body="SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std, round(median, 6) AS median, round(iqr, 6) AS iqr FROM scales", scales=_LONG)
def fe_12(r: Run) -> DataFrame:
    return cal.long_statistics(pn.eligible(r.written), scaled())


@query("fe_13", "fn_11", body="SELECT reader_id, as_of_week_end, " + ", ".join(f"round(({x} - (SELECT mean FROM scales WHERE feature = '{n}')) / greatest((SELECT std FROM scales WHERE feature = '{n}'), 1e-12), 6) AS {n}" for n, x in _VALUE.items()) + " FROM features", scales=_LONG)
def fe_13(r: Run) -> DataFrame:
    features = r.written
    scales = cal.long_statistics(pn.eligible(features), scaled()).groupBy().agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std")))).alias("_s"))
    z = {n: (c - F.col("_s")[n]["mean"]) / F.greatest(F.col("_s")[n]["std"], F.lit(1e-12)) for n, c in scaled().items()}
    # one row, of a fixed number of features
    return features.join(F.broadcast(scales)).select(*KEY, *(c.alias(n) for n, c in z.items()))


@query("fn_9", body="SELECT round(avg((web_views_28d = 0)::INT), 6) AS zero_share, round(quantile_cont(web_views_28d, 0.995), 6) AS upper_all, round(quantile_cont(web_views_28d, 0.995) FILTER (web_views_28d > 0), 6) AS upper_positive FROM eligible")
def fn_9(r: Run) -> DataFrame:
    row = cal.winsor_statistics(pn.eligible(r.written), {"w": F.col("web_views_28d")})
    return r.spark.createDataFrame([(row["w|zero"], row["w|all"], row["w|pos"])], "zero_share double, upper_all double, upper_positive double")


@query("fn_10", body="SELECT reader_id, as_of_week_end, round(ln(1 + least(greatest(web_views_28d, 0), 12)), 6) AS logged FROM features")
def fn_10(r: Run) -> DataFrame:
    return r.features.select(*KEY, fn.log_count(F.col("web_views_28d"), 0.0, 12.0).alias("logged"))


@query("win_1", body="SELECT reader_id, as_of_week_end, round((rank() OVER (PARTITION BY as_of_week_end ORDER BY v) + (count(*) OVER (PARTITION BY as_of_week_end, v) - 1) / 2.0) / count(*) OVER (PARTITION BY as_of_week_end) * 100, 6) AS percentile FROM (SELECT *, overall_active_days_28d + web_views_28d AS v FROM features)")
def win_1(r: Run) -> DataFrame:
    return with_percentile(r.written.withColumn("v", F.col("overall_active_days_28d") + F.col("web_views_28d")), "v", "percentile").select(*KEY, "percentile")


@query("win_2", body="SELECT f.reader_id, f.as_of_week_end, round(((SELECT count(*) FROM eligible e WHERE e.web_views_28d < f.web_views_28d) + 0.5 * (SELECT count(*) FROM eligible e WHERE e.web_views_28d = f.web_views_28d)) / (SELECT count(*) FROM eligible), 6) AS pct FROM features f")
def win_2(r: Run) -> DataFrame:
    # every value that occurs is ranked once among the eligible rows, and joined by value
    fits = ~F.col("partial_window_flag") & ~F.col("no_recent_flag")
    sizes = staged(r.written.groupBy("web_views_28d").agg(F.count_if(fits).alias("n")), "sizes")
    ranks = ranked(sizes, [], "web_views_28d", "n").select("web_views_28d", ((F.col("_before") + 0.5 * F.col("n")) / F.col("_total")).alias("pct"))
    return r.written.join(ranks, "web_views_28d").select(*KEY, "pct")


# --- scoring with given centroids ---

CENTERS = np.array([[0.5, 0.5, 0.5, 0.1], [1.5, 1.5, 1.5, 0.5], [2.5, 2.5, 2.5, 0.9]])
_RAW = list(_VALUE.values())
_D = [" + ".join(f"power({x} - {float(c)!r}, 2)" for x, c in zip(_RAW, center, strict=True)) for center in CENTERS]
_SCORED = {"dist": "SELECT *, " + ", ".join(f"sqrt({d}) AS d{k}" for k, d in enumerate(_D)) + " FROM features", "scored": "SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster_index, least(d0, d1, d2) AS cluster_distance, d0 + d1 + d2 - least(d0, d1, d2) - greatest(d0, d1, d2) AS cluster_second_distance FROM dist"}


def scored(r: Run, written: bool = False) -> DataFrame:
    return assign(r.written if written else r.features, list(scaled().values()), CENTERS)


@query("ml_13", "srt_5", "fn_22", body="SELECT reader_id, as_of_week_end, cluster_index, round(cluster_distance, 6) AS cluster_distance, round(cluster_second_distance, 6) AS cluster_second_distance, round(cluster_second_distance - cluster_distance, 6) AS cluster_confidence_margin FROM scored", **_SCORED)
def ml_13(r: Run) -> DataFrame:
    return scored(r).select(*KEY, "cluster_index", "cluster_distance", "cluster_second_distance", "cluster_confidence_margin")


@query("agg_16", "jn_13", body="SELECT as_of_week_end, cluster_index, round(avg(overall_active_days_28d), 6) AS overall_active_days_28d, count(*) AS n_readers, round(count(*) / sum(count(*)) OVER (PARTITION BY as_of_week_end), 6) AS share FROM scored GROUP BY as_of_week_end, cluster_index", **_SCORED)
def agg_16(r: Run) -> DataFrame:
    each = scored(r).groupBy("as_of_week_end", "cluster_index").agg(F.avg("overall_active_days_28d").alias("overall_active_days_28d"), F.count(F.lit(1)).alias("n_readers"))
    total = each.groupBy("as_of_week_end").agg(F.sum("n_readers").alias("_all"))
    return each.join(total, "as_of_week_end").withColumn("share", F.col("n_readers") / F.col("_all")).drop("_all")


_PAIRS = _SCORED | {"pairs": "SELECT a.reader_id, a.cluster_index AS t, b.cluster_index AS t_plus FROM scored a JOIN scored b ON a.reader_id = b.reader_id WHERE a.as_of_week_end = (SELECT min(as_of_week_end) FROM weeks) AND b.as_of_week_end = (SELECT max(as_of_week_end) FROM weeks)"}


@query("agg_17", body="SELECT t, t_plus, round(count(*) / sum(count(*)) OVER (PARTITION BY t), 6) AS share FROM pairs GROUP BY t, t_plus", **_PAIRS)
def agg_17(r: Run) -> DataFrame:
    return temporal.transitions(temporal.pairs(scored(r, True), r.weeks[0], r.weeks[-1], "cluster_index"))


@query("jn_14", "set_6", "ml_19", body="SELECT round(coalesce(avg((t = t_plus)::INT), 0), 6) AS retention, count(*) AS n_rows FROM pairs", **_PAIRS)
def jn_14(r: Run) -> DataFrame:
    return temporal.retention(temporal.pairs(scored(r, True), r.weeks[0], r.weeks[-1], "cluster_index"))


@query("agg_21", body="SELECT round(coalesce(sum(n * power(m - g, 2)) / max(t), 0), 6) AS eta_sq FROM (SELECT count(*) AS n, avg(web_views_28d) AS m FROM scored GROUP BY cluster_index), (SELECT avg(web_views_28d) AS g, sum(power(web_views_28d - (SELECT avg(web_views_28d) FROM scored), 2)) AS t FROM scored)", **_SCORED)
def agg_21(r: Run) -> DataFrame:
    rows = scored(r, True).select("cluster_index", F.col("web_views_28d").alias("x"))
    whole = rows.agg(F.avg("x").alias("g"), (F.var_pop("x") * F.count("x")).alias("t"))
    each = rows.groupBy("cluster_index").agg(F.count("x").alias("n"), F.avg("x").alias("m"))
    spread = each.join(F.broadcast(whole)).agg(F.sum(F.col("n") * F.pow(F.col("m") - F.col("g"), 2)).alias("b"), F.max("t").alias("t"))
    return spread.select(F.coalesce(F.when(F.col("t") > 0, F.col("b") / F.col("t")), F.lit(0.0)).alias("eta_sq"))


@query("agg_23", body="SELECT round(avg(power(web_views_28d, 2)) / (avg(power(web_views_28d, 2)) + avg(power(app_views_28d, 2))), 6) AS web, round(avg(power(app_views_28d, 2)) / (avg(power(web_views_28d, 2)) + avg(power(app_views_28d, 2))), 6) AS app FROM features")
def agg_23(r: Run) -> DataFrame:
    sq = r.features.agg(*(F.avg(F.pow(f"{c}_views_28d", F.lit(2))).alias(c) for c in ("web", "app")))
    return sq.select(*((F.col(c) / (F.col("web") + F.col("app"))).alias(c) for c in ("web", "app")))


@query("agg_25", body="SELECT as_of_week_end, round(avg((NOT content_active_flag)::INT), 6) AS imputed FROM features GROUP BY as_of_week_end")
def agg_25(r: Run) -> DataFrame:
    return r.features.groupBy("as_of_week_end").agg(F.avg((~F.col("content_active_flag")).cast("double")).alias("imputed"))


@query("fe_20", body="SELECT reader_id, as_of_week_end, round(CASE WHEN content_active_flag THEN topic_entropy_28d ELSE 0 END, 6) AS topic_entropy, (NOT content_active_flag)::INTEGER AS topic_entropy_imputed_flag FROM features")
def fe_20(r: Run) -> DataFrame:
    active = F.col("content_active_flag")
    return r.features.select(*KEY, F.when(active, F.col("topic_entropy_28d")).otherwise(F.lit(0.0)).alias("topic_entropy"), (~active).cast("int").alias("topic_entropy_imputed_flag"))


@query("fe_17", body="SELECT round(corr(web_views_28d, web_active_days_28d), 6) AS r FROM features WHERE web_views_28d > 0")
def fe_17(r: Run) -> DataFrame:
    return r.features.where("web_views_28d > 0").agg(F.corr("web_views_28d", "web_active_days_28d").alias("r"))


@query("fn_13", body="SELECT reader_id, as_of_week_end, round(CASE WHEN s > 0 THEN web / s ELSE 0 END, 6) AS channel_mix_web, round(CASE WHEN s > 0 THEN app / s ELSE 0 END, 6) AS channel_mix_app FROM (SELECT *, web + app AS s FROM (SELECT reader_id, as_of_week_end, " + ", ".join(f"CASE WHEN {c}_views_28d > 0 THEN ((SELECT count(*) FROM eligible e WHERE e.{c}_views_28d > 0 AND e.{c}_views_28d < f.{c}_views_28d) + 0.5 * (SELECT count(*) FROM eligible e WHERE e.{c}_views_28d = f.{c}_views_28d)) / (SELECT count(*) FROM eligible e WHERE e.{c}_views_28d > 0) ELSE 0 END AS {c}" for c in ("web", "app")) + " FROM features f))")
def fn_13(r: Run) -> DataFrame:
    from lectern.model.wide import with_mix

    features, anchors = r.written, {c: f"{c}_views_28d" for c in r.settings.channels}
    signals: dict = {}
    for c, a in anchors.items():
        active = pn.eligible(features).where(F.col(a) > 0)
        if not active.isEmpty():
            signals |= cal.fit(active, {c: F.log1p(F.col(a))}, with_values=True)
    if len(signals) < len(anchors):
        return features.select(*KEY, F.lit(0.0).alias("channel_mix_web"), F.lit(0.0).alias("channel_mix_app"))
    return with_mix(features, signals, anchors).select(*KEY, "channel_mix_web", "channel_mix_app")


# --- validator counts and sessions ---


def contract_query(name: str, body: str) -> Callable[[Callable[[dict[str, DataFrame]], DataFrame]], Callable]:
    def add(make: Callable[[dict[str, DataFrame]], DataFrame]) -> Callable:
        register(name, sql(body, **TABLES))(lambda spark, sf_dir: rounded(make(delivery(spark, sf_dir))))
        return make

    return add


def _row(df: DataFrame, table: str, prefixes: tuple[str, ...]) -> DataFrame:
    t = va.schema.BY_NAME[table]
    found = va.counters(t, set(t.names))
    return df.agg(*(c.cast("long").alias(k.replace("|", "_")) for k, c in found.items() if k.startswith(prefixes)))


contract_query("val_5", "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in ("event_id", "reader_id", "event_ts", "channel", "event_kind", "session_id")) + ", count(*) FILTER (engagement_time_seconds < 0) AS negative_engagement_time_seconds FROM reader_event")(lambda t: _row(t["reader_event"], "reader_event", ("null", "negative")))
contract_query("val_6", "SELECT count(*) FILTER (content_type NOT IN ('article', 'liveblog', 'gallery', 'video', 'podcast', 'newsletter', 'other')) AS enum_content_type, count(*) FILTER (section_resolution NOT IN ('resolved', 'unresolved')) AS enum_section_resolution FROM content")(lambda t: _row(t["content"], "content", ("enum",)))
contract_query("val_7", "SELECT count(*) AS keys, coalesce(sum(n), 0)::BIGINT AS rows FROM (SELECT count(*) AS n FROM reader_event GROUP BY event_id HAVING count(*) > 1)")(lambda t: t["reader_event"].groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")))
contract_query("val_8", "SELECT count(*) FILTER (section_resolution = 'resolved' AND (sections IS NULL OR len(sections) = 0)) AS rule_resolved_requires_sections, count(*) FILTER (section_resolution = 'unresolved' AND len(sections) > 0) AS rule_unresolved_forbids_sections FROM content")(lambda t: _row(t["content"], "content", ("rule",)))
for _id in ("val_9", "jn_12"):
    contract_query(_id, "SELECT DISTINCT reader_id FROM reader_event WHERE reader_id NOT IN (SELECT reader_id FROM subscription_span)")(lambda t: t["reader_event"].join(t["subscription_span"].select("reader_id").distinct(), "reader_id", "left_anti").select("reader_id").distinct())
for _id in ("val_10", "fn_21"):
    contract_query(_id, "SELECT count(*) FILTER (len(list_distinct(sections)) < len(sections)) AS repeats FROM content")(lambda t: _row(t["content"], "content", ("repeats",)))
for _id in ("val_11", "win_4"):
    contract_query(_id, "SELECT count(*) FILTER (place > 1 AND (prev IS NULL OR prev > start_ts)) AS overlaps, count(*) FILTER (end_ts <= start_ts) AS inverted FROM (SELECT *, row_number() OVER w AS place, lag(end_ts) OVER w AS prev FROM subscription_span WINDOW w AS (PARTITION BY reader_id ORDER BY start_ts))")(lambda t: va.span_order(t["subscription_span"]).agg(F.count_if("overlaps").alias("overlaps"), F.count_if(F.col("end_ts") <= F.col("start_ts")).alias("inverted")))
contract_query("src_3", "SELECT channel, event_kind, count(*) AS n FROM reader_event GROUP BY ALL")(lambda t: t["reader_event"].groupBy("channel", "event_kind").agg(F.count(F.lit(1)).alias("n")))


@register("win_8", "SELECT event_id, user_id, session_no::BIGINT AS session_no FROM (SELECT event_id, user_id, sum(CASE WHEN prev IS NULL OR ts - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))")
def win_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionize(spark.read.parquet(f"{sf_dir}/events.parquet"), "user_id", "ts", "event_id").select("event_id", "user_id", "session_no")


__all__ = ["BUCKETS", "Run"]
