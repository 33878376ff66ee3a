"""The benchmark tables seen as a delivery: every row of events and documents, by arithmetic that SQL can repeat."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.contract import vocabulary as v
from lectern.contract.manifest import ArticleView, Availability, Manifest, Population, WeekAnchor
from lectern.functions.columns import instant

ZONE = "America/New_York"
#: Content numbers from here on have no metadata.
UNKNOWN_FROM = 95


def manifest() -> Manifest:
    there = Availability(v.AVAILABLE, date(2023, 12, 1))
    return Manifest(
        "1.0.0",
        ZONE,
        WeekAnchor("Sunday", v.WEEK_ENDS_ON),
        ArticleView("article-view", ("article",), (v.DELIVERY,)),
        Population("subscribers", ("trial", "active", "grace")),
        {"email_click": there, "email_open": there, "community_action": there},
    )


def delivery(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value", instant(F.col("ts")).alias("event_ts"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source")
    text = lambda prefix, col: F.concat(F.lit(prefix), F.col(col).cast("string"))
    reader = text("rdr-", "user_id").alias("reader_id")
    ident = text("evt-", "event_id").alias("event_id")
    known = F.col("k") < UNKNOWN_FROM
    content_id = F.concat(F.when(known, F.lit("cnt-")).otherwise(F.lit("cnt-x")), F.col("k").cast("string"))
    span = F.floor(F.unix_seconds("event_ts") / 21600).cast("string")
    reading = events.where(F.col("event_type").isin("view", "purchase", "error"))
    clicks, signups = events.where("event_type = 'click'"), events.where("event_type = 'signup'")
    mail = [reader, F.concat(F.lit("lst-"), (F.col("event_id") % 2).cast("string")).alias("list_id"), F.when(F.col("event_id") % 5 != 0, text("cmp-", "k")).alias("campaign_id")]
    users = events.select("user_id").distinct()
    n = F.col("user_id") % 10
    day = lambda s: F.timestamp_micros(F.lit((date.fromisoformat(s) - date(1970, 1, 1)).days * 86_400_000_000))
    start = F.when(n == 0, day("2024-01-10")).otherwise(day("2023-06-01"))
    lapsed = n == 2
    spans = users.where(n != 1).select(reader, F.lit("active").alias("state"), F.when(n == 3, F.lit("guest")).alias("payer_type"), start.alias("start_ts"), F.when(lapsed, day("2024-01-20")).alias("end_ts"))
    after = users.where(lapsed).select(reader, F.lit("cancelled").alias("state"), F.lit(None).cast("string").alias("payer_type"), day("2024-01-20").alias("start_ts"), F.lit(None).cast("timestamp").alias("end_ts"))
    return {
        "reader": users.select(reader, F.lit("resolved_person").alias("id_grain")),
        "reader_event": reading.select(
            ident,
            reader,
            "event_ts",
            F.when(F.col("event_id") % 3 == 0, "app").otherwise("web").alias("channel"),
            F.when(F.col("event_type") == "error", v.INTERACTION).otherwise(v.DELIVERY).alias("event_kind"),
            content_id.alias("content_id"),
            F.concat(F.lit("ses-"), F.col("user_id").cast("string"), F.lit("-"), span).alias("session_id"),
            F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("engagement_time_seconds"),
        ),
        "content": docs.select(
            text("cnt-", "doc_id").alias("content_id"),
            F.when(F.col("doc_id") % 10 == 0, "video").otherwise("article").alias("content_type"),
            F.when(F.col("doc_id") % 12 == 0, v.UNRESOLVED).otherwise(v.RESOLVED).alias("section_resolution"),
            F.when(F.col("doc_id") % 24 == 0, F.lit(None).cast("array<string>")).when(F.col("doc_id") % 12 == 0, F.array().cast("array<string>")).when(F.col("doc_id") % 7 == 0, F.array("lang", "source")).otherwise(F.array("lang")).alias("sections"),
            F.lit(None).cast("timestamp").alias("published_ts"),
        ),
        "subscription_span": spans.unionByName(after),
        "email_click": clicks.select(ident, *mail, "event_ts"),
        "email_open": clicks.select(text("opn-", "event_id").alias("event_id"), *mail, F.timestamp_micros(F.unix_micros("event_ts") - 60_000_000).alias("event_ts")),
        "community_action": signups.select(
            ident, reader, "event_ts", F.element_at(F.array(*map(F.lit, v.ACTIONS)), (F.col("k") % 5 + 1).cast("int")).alias("action_kind"), F.lit("site-main").alias("site_id"), F.when(known, text("cnt-", "k")).alias("target_content_id")
        ),
    }


#: The same tables and the daily layers as common table expressions, in the order they use each other.
SQL_TABLES = {
    "ev": """SELECT event_id, user_id, event_type, value, ts AT TIME ZONE 'UTC' AS event_ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "reader": "SELECT DISTINCT 'rdr-' || user_id AS reader_id, 'resolved_person' AS id_grain FROM ev",
    "reader_event": f"""SELECT 'evt-' || event_id AS event_id, 'rdr-' || user_id AS reader_id, event_ts,
        CASE WHEN event_id % 3 = 0 THEN 'app' ELSE 'web' END AS channel,
        CASE WHEN event_type = 'error' THEN 'content_interaction' ELSE 'content_delivery' END AS event_kind,
        CASE WHEN k < {UNKNOWN_FROM} THEN 'cnt-' ELSE 'cnt-x' END || k AS content_id,
        'ses-' || user_id || '-' || CAST(floor(epoch(event_ts) / 21600) AS BIGINT) AS session_id,
        CASE WHEN event_id % 6 <> 0 THEN value END AS engagement_time_seconds
        FROM ev WHERE event_type IN ('view', 'purchase', 'error')""",
    "content": """SELECT 'cnt-' || doc_id AS content_id, CASE WHEN doc_id % 10 = 0 THEN 'video' ELSE 'article' END AS content_type,
        CASE WHEN doc_id % 12 = 0 THEN 'unresolved' ELSE 'resolved' END AS section_resolution,
        CASE WHEN doc_id % 24 = 0 THEN NULL WHEN doc_id % 12 = 0 THEN CAST([] AS VARCHAR[]) WHEN doc_id % 7 = 0 THEN [lang, source] ELSE [lang] END AS sections
        FROM documents""",
    "email_click": """SELECT 'evt-' || event_id AS event_id, 'rdr-' || user_id AS reader_id, 'lst-' || event_id % 2 AS list_id,
        CASE WHEN event_id % 5 <> 0 THEN 'cmp-' || k END AS campaign_id, event_ts FROM ev WHERE event_type = 'click'""",
    "email_open": """SELECT 'opn-' || event_id AS event_id, 'rdr-' || user_id AS reader_id, 'lst-' || event_id % 2 AS list_id,
        CASE WHEN event_id % 5 <> 0 THEN 'cmp-' || k END AS campaign_id, event_ts - INTERVAL 60 SECOND AS event_ts FROM ev WHERE event_type = 'click'""",
    "community_action": f"""SELECT 'evt-' || event_id AS event_id, 'rdr-' || user_id AS reader_id, event_ts,
        ['post_created', 'reply_created', 'like_given', 'dislike_given', 'flag_given'][k % 5 + 1] AS action_kind, 'site-main' AS site_id,
        CASE WHEN k < {UNKNOWN_FROM} THEN 'cnt-' || k END AS target_content_id FROM ev WHERE event_type = 'signup'""",
    "subscription_span": """SELECT 'rdr-' || user_id AS reader_id, 'active' AS state, CASE WHEN user_id % 10 = 3 THEN 'guest' END AS payer_type,
        CASE WHEN user_id % 10 = 0 THEN TIMESTAMPTZ '2024-01-10 00:00:00+00' ELSE TIMESTAMPTZ '2023-06-01 00:00:00+00' END AS start_ts,
        CASE WHEN user_id % 10 = 2 THEN TIMESTAMPTZ '2024-01-20 00:00:00+00' END AS end_ts
        FROM (SELECT DISTINCT user_id FROM ev) WHERE user_id % 10 <> 1
        UNION ALL SELECT 'rdr-' || user_id, 'cancelled', NULL, TIMESTAMPTZ '2024-01-20 00:00:00+00', NULL
        FROM (SELECT DISTINCT user_id FROM ev) WHERE user_id % 10 = 2""",
    "event_layer": f"""SELECT e.*, CAST(e.event_ts AT TIME ZONE '{ZONE}' AS DATE) AS local_date, c.content_id IS NOT NULL AS content_metadata_present,
        c.content_type, c.section_resolution, c.sections,
        coalesce(e.event_kind = 'content_delivery' AND e.content_id IS NOT NULL AND (c.content_type IS NULL OR c.content_type = 'article'), false) AS is_view
        FROM reader_event e LEFT JOIN content c ON c.content_id = e.content_id""",
    "session_layer": """SELECT reader_id, channel, local_date, count(DISTINCT session_id) AS distinct_sessions_day
        FROM event_layer WHERE is_view GROUP BY ALL""",
    "reader_content_day": """SELECT p.reader_id, p.channel, p.content_id, p.local_date, views, sessions, distinct_sessions_day, total_time_seconds, measured_time_deliveries, events
        FROM (SELECT reader_id, channel, content_id, local_date, count(*) FILTER (is_view) AS views, count(DISTINCT session_id) FILTER (is_view) AS sessions,
            sum(engagement_time_seconds) FILTER (is_view) AS total_time_seconds, count(engagement_time_seconds) FILTER (is_view) AS measured_time_deliveries, count(*) AS events
            FROM event_layer WHERE content_id IS NOT NULL GROUP BY reader_id, channel, content_id, local_date) p
        JOIN session_layer s ON s.reader_id = p.reader_id AND s.channel = p.channel AND s.local_date = p.local_date WHERE views > 0""",
    "reader_channel_day": """SELECT reader_id, channel, local_date, sum(views)::BIGINT AS views, max(distinct_sessions_day) AS sessions, sum(total_time_seconds) AS total_time_seconds,
        sum(measured_time_deliveries)::BIGINT AS measured_time_deliveries, sum(events)::BIGINT AS events FROM reader_content_day GROUP BY reader_id, channel, local_date""",
    "section_parts": """SELECT reader_id, local_date, content_id, views, total_time_seconds, 1.0::DOUBLE / len(effective) AS weight, unnest(effective) AS section FROM (
        SELECT d.*, CASE WHEN c.section_resolution = 'resolved' AND c.sections IS NOT NULL AND len(c.sections) > 0 THEN c.sections ELSE ['__unresolved__'] END AS effective
        FROM reader_content_day d LEFT JOIN content c ON c.content_id = d.content_id)""",
    "reader_section_day": """SELECT reader_id, section, local_date, sum(views * weight) AS section_views, sum(total_time_seconds * weight) AS section_time_seconds,
        count(DISTINCT content_id) AS distinct_content_ids FROM section_parts GROUP BY reader_id, section, local_date""",
    "reader_email_day": f"""SELECT list_id, reader_id, local_date, sum(click)::BIGINT AS clicks, sum(opened)::BIGINT AS opens FROM (
        SELECT list_id, reader_id, CAST(event_ts AT TIME ZONE '{ZONE}' AS DATE) AS local_date, 1 AS click, 0 AS opened FROM email_click
        UNION ALL SELECT list_id, reader_id, CAST(event_ts AT TIME ZONE '{ZONE}' AS DATE), 0, 1 FROM email_open) GROUP BY list_id, reader_id, local_date""",
    "reader_community_day": f"""SELECT reader_id, CAST(event_ts AT TIME ZONE '{ZONE}' AS DATE) AS local_date, """
    + ", ".join(f"count(*) FILTER (action_kind = '{k}') AS {c}" for k, c in v.ACTION_COLUMNS.items())
    + " FROM community_action GROUP BY ALL",
    "subscription_state_interval": f"""SELECT *, CAST(start_ts AT TIME ZONE '{ZONE}' AS DATE) AS start_date, CAST(end_ts AT TIME ZONE '{ZONE}' AS DATE) AS end_date, end_ts IS NULL AS is_open FROM subscription_span""",
}


def sql(body: str, **more: str) -> str:
    """A statement over the tables above, and over more common table expressions, with those it doesn't use left out."""
    tables = SQL_TABLES | more
    wanted: set[str] = set()

    def need(text: str) -> None:
        for word in re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", text, re.I):
            if word in tables and word not in wanted:
                wanted.add(word)
                need(tables[word])

    need(body)
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in tables.items() if n in wanted) + "\n" + body if wanted else body
