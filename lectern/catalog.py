"""Registered queries of the engine by inventory id, and their SQL.

Floats are rounded to six places on both sides, as sums depend on their order; instants are given in microseconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import checks, daily
from lectern.sources.testdata import SQL_TABLES, ZONE, delivery, manifest, sql

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "agg_3"
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, statement: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if statement:
            SQL[name] = statement
        return query

    return add


def build(spark: SparkSession, sf_dir: str) -> daily.Context:
    return daily.context(delivery(spark, sf_dir), manifest())


def rounded(df: DataFrame) -> DataFrame:
    """Floats to six places, instants to microseconds, lists to text; so that two engines' values compare."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        out.append((F.round(c, 6) if kind == "double" else F.unix_micros(c) if kind == "timestamp" else F.array_join(c, ",") if kind == "array<string>" else c).alias(f.name))
    return df.select(*out)


def table_sql(name: str) -> str:
    """All columns of a daily table with the same rules as rounded()."""
    made = {
        "content_dimension": "SELECT content_id, content_type, section_resolution, array_to_string(sections, ',') AS sections FROM content",
        "subscription_state_interval": "SELECT reader_id, state, payer_type, epoch_us(start_ts) AS start_ts, epoch_us(end_ts) AS end_ts, start_date, end_date, is_open FROM subscription_state_interval",
    }
    floats = {"total_time_seconds", "section_views", "section_time_seconds"}
    return sql(made.get(name) or "SELECT " + ", ".join(f"round({c}, 6) AS {c}" if c in floats else c for c in daily.OUTPUTS[name].columns) + f" FROM {name}")


def _daily(ids: tuple[str, ...], name: str) -> None:
    for i in ids:
        register(i, table_sql(name))(lambda spark, sf_dir, name=name: rounded(build(spark, sf_dir)[name]))


_daily(("agg_2", "jn_2"), "reader_content_day")
_daily(("agg_3",), "reader_channel_day")
_daily(("agg_4", "jn_4"), "reader_section_day")
_daily(("agg_5", "set_1"), "reader_email_day")
_daily(("agg_6",), "reader_community_day")
_daily(("prj_5",), "content_dimension")
_daily(("prj_6",), "subscription_state_interval")

_LAYER = ["event_id", "reader_id", "event_ts", "local_date", "channel", "event_kind", "content_id", "session_id", "engagement_time_seconds", "content_metadata_present", "content_type", "section_resolution", "sections", "is_view"]


@register("jn_1", sql("SELECT event_id, reader_id, epoch_us(event_ts) AS event_ts, local_date, channel, event_kind, content_id, session_id, round(engagement_time_seconds, 6) AS engagement_time_seconds, content_metadata_present, content_type, section_resolution, array_to_string(sections, ',') AS sections, is_view FROM event_layer"))
def jn_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(build(spark, sf_dir)[daily.EVENTS].select(*_LAYER))


@register("agg_1", sql("SELECT * FROM session_layer"))
def agg_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir)[daily.SESSIONS]


@register("prj_1", sql(f"SELECT event_id, CAST(event_ts AT TIME ZONE '{ZONE}' AS DATE) AS local_date FROM ev"))
def prj_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.functions.columns import instant, local_date

    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", local_date(instant(F.col("ts")), ZONE).alias("local_date"))


@register("prj_2", sql("SELECT event_id, is_view FROM event_layer"))
def prj_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir)[daily.EVENTS].select("event_id", "is_view")


@register("prj_3", sql("SELECT content_id, array_to_string(CASE WHEN section_resolution = 'resolved' AND sections IS NOT NULL AND len(sections) > 0 THEN sections ELSE ['__unresolved__'] END, ',') AS effective FROM content"))
def prj_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.functions.columns import effective_sections

    return delivery(spark, sf_dir)["content"].select("content_id", F.array_join(effective_sections(F.col("section_resolution"), F.col("sections")), ",").alias("effective"))


@register("jn_3", sql("SELECT reader_id, local_date, content_id, views, section, round(weight, 6) AS weight FROM section_parts"))
def jn_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily.section_parts(build(spark, sf_dir)).select("reader_id", "local_date", "content_id", "views", "section", "weight"))


def _counts(parts: dict[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{name}' AS check_name, count(*) AS offenders FROM ({body})" for name, body in parts.items())


_DAYS = {
    checks.DAY_EVENTS: ("reader_id, channel", "SELECT * FROM event_layer WHERE is_view", "reader_channel_day"),
    checks.DAY_EMAIL: ("reader_id, list_id", "SELECT reader_id, list_id, event_ts FROM email_click UNION ALL SELECT reader_id, list_id, event_ts FROM email_open", "reader_email_day"),
    checks.DAY_COMMUNITY: ("reader_id", "SELECT * FROM community_action", "reader_community_day"),
}
_CHECK_SQL = {f"{checks.KEYS_UNIQUE}[{n}]": f"SELECT {', '.join(o.key)} FROM {n} GROUP BY {', '.join(o.key)} HAVING count(*) > 1" for n, o in daily.OUTPUTS.items() if n != "content_dimension"} | {
    f"{checks.KEYS_UNIQUE}[content_dimension]": "SELECT content_id FROM content GROUP BY content_id HAVING count(*) > 1",
    checks.SESSIONS_MAXIMISED: "SELECT 1 FROM reader_channel_day d JOIN session_layer o ON o.reader_id = d.reader_id AND o.channel = d.channel AND o.local_date = d.local_date WHERE d.sessions <> o.distinct_sessions_day",
    checks.ATTRIBUTION: "SELECT 1 FROM (SELECT reader_id, local_date, sum(section_views) AS a FROM reader_section_day GROUP BY ALL) s FULL JOIN (SELECT reader_id, local_date, count(*) AS b FROM event_layer WHERE is_view GROUP BY ALL) o ON s.reader_id = o.reader_id AND s.local_date = o.local_date WHERE s.reader_id IS NULL OR o.reader_id IS NULL OR abs(a - b) > 1e-9",
    checks.SENTINEL: "SELECT 1 FROM (SELECT reader_id, local_date, sum(section_views) AS a FROM reader_section_day WHERE section = '__unresolved__' GROUP BY ALL) s FULL JOIN (SELECT reader_id, local_date, count(*) AS b FROM event_layer WHERE is_view AND (NOT content_metadata_present OR section_resolution <> 'resolved' OR sections IS NULL OR len(sections) = 0) GROUP BY ALL) o ON s.reader_id = o.reader_id AND s.local_date = o.local_date WHERE s.reader_id IS NULL OR o.reader_id IS NULL OR abs(a - b) > 1e-9",
    checks.SECTION_SET: "SELECT 1 FROM reader_section_day WHERE section IS NULL",
    **{
        name: f"(SELECT DISTINCT {keys}, local_date FROM {table} EXCEPT SELECT DISTINCT {keys}, CAST(event_ts AT TIME ZONE '{ZONE}' AS DATE) FROM ({source})) UNION ALL (SELECT DISTINCT {keys}, CAST(event_ts AT TIME ZONE '{ZONE}' AS DATE) AS local_date FROM ({source}) EXCEPT SELECT DISTINCT {keys}, local_date FROM {table})"
        for name, (keys, source, table) in _DAYS.items()
    },
}


def _check_query(names: tuple[str, ...]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = checks.offenders(build(spark, sf_dir))
        parts = [rows.agg(F.lit(n).alias("check_name"), F.count(F.lit(1)).alias("offenders")) for n, rows in found.items() if n in names]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    return query


for _id, _names in {
    "chk_1": tuple(n for n in _CHECK_SQL if n.startswith(checks.KEYS_UNIQUE)),
    "chk_2": (checks.SESSIONS_MAXIMISED,),
    "chk_3": (checks.ATTRIBUTION,),
    "chk_4": (checks.SENTINEL,),
    "chk_5": (checks.SECTION_SET,),
    "chk_6": (checks.DAY_EVENTS,),
    "chk_7": (checks.DAY_EMAIL,),
    "chk_8": (checks.DAY_COMMUNITY,),
}.items():
    register(_id, sql(_counts({n: _CHECK_SQL[n] for n in _names})))(_check_query(_names))
for _id, _like in {"agg_7": "chk_1", "jn_8": "chk_2", "jn_5": "chk_3", "jn_6": "chk_4", "jn_7": "chk_6", "set_3": "chk_7", "set_2": "chk_7"}.items():
    register(_id, SQL[_like])(QUERIES[_like])

__all__ = ["FLAGSHIP", "QUERIES", "SQL", "SQL_TABLES", "register"]
