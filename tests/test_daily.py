"""Daily tables of the small delivery by hand, mutations that exactly their checks catch, and refusals."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from lectern.contract.manifest import Manifest
from lectern.operators import checks, daily
from lectern.sources import demo
from lectern.sources.delivery import build_delivery, write_delivery


@pytest.fixture(scope="module")
def inputs(spark):
    return {n: df.persist() for n, df in demo.build(spark).items()}


@pytest.fixture(scope="module")
def built(inputs):
    return daily.context(inputs, demo.manifest())


def failed(inputs, **replaced):
    return {c.name for c in checks.run_checks(daily.context(inputs, demo.manifest(), replaced)) if not c.passed}


def test_by_hand(built):
    channel = {(r.reader_id, r.channel, r.local_date): r for r in built["reader_channel_day"].collect()}
    day = channel["rdr-a", "web", date(2026, 2, 16)]
    # three deliveries and the one after midnight in UTC; two visits and one of the boundary
    assert (day.views, day.sessions, day.total_time_seconds, day.measured_time_deliveries, day.events) == (4, 3, 61.5, 3, 4)
    assert ("rdr-a", "web", date(2026, 2, 18)) not in channel and ("rdr-h", "web", date(2026, 3, 5)) in channel
    assert channel["rdr-b", "app", date(2026, 2, 17)].total_time_seconds == 0.0
    sections = {(r.reader_id, r.section, r.local_date): (r.section_views, r.section_time_seconds, r.distinct_content_ids) for r in built["reader_section_day"].collect()}
    assert sections["rdr-a", "news", date(2026, 2, 16)] == (3.5, 61.5, 2)
    assert sections["rdr-a", "science", date(2026, 2, 16)] == (0.5, None, 1)
    assert sections["rdr-a", "arts", date(2026, 2, 20)] == (pytest.approx(1 / 3), pytest.approx(20.0), 1)
    assert sections["rdr-b", "__unresolved__", date(2026, 2, 24)] == (1.0, 25.0, 1)
    assert sections["rdr-c", "__unresolved__", date(2026, 2, 18)] == (1.0, 10.0, 1)
    mail = {(r.reader_id, r.list_id, r.local_date): (r.clicks, r.opens) for r in built["reader_email_day"].collect()}
    assert mail["rdr-a", "lst-1", date(2026, 2, 16)] == (2, 2) and mail["rdr-d", "lst-1", date(2026, 3, 8)] == (0, 1)
    social = {(r.reader_id, r.local_date): r for r in built["reader_community_day"].collect()}
    assert (social["rdr-a", date(2026, 2, 17)].posts_created, social["rdr-a", date(2026, 2, 17)].replies_created) == (1, 1)
    assert social["rdr-a", date(2026, 3, 8)].posts_created == 1
    spans = {(r.reader_id, r.start_date): r for r in built["subscription_state_interval"].collect()}
    assert spans["rdr-h", date(2026, 1, 1)].end_date == date(2026, 3, 1) and spans["rdr-a", date(2025, 6, 1)].is_open


def test_boundaries(inputs, built):
    found = {r.event_id: r.local_date for r in built[daily.EVENTS].collect()}
    assert {i: found[i] for i, _, _ in demo.BOUNDARIES[:3]} == {i: d for i, _, d in demo.BOUNDARIES[:3]}


def test_any_session_zone(spark, inputs):
    want = {n: sorted(map(str, df.drop("start_ts", "end_ts").collect())) for n, df in daily.outputs(daily.context(inputs, demo.manifest())).items()}
    for zone in ("America/New_York", "Asia/Tokyo", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {n: sorted(map(str, df.drop("start_ts", "end_ts").collect())) for n, df in daily.outputs(daily.context(inputs, demo.manifest())).items()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == want, zone


def summed(c):
    rows = c["reader_content_day"]
    return daily.reader_channel_day(c).drop("sessions").join(rows.groupBy("reader_id", "channel", "local_date").agg(F.sum("sessions").alias("sessions")), ["reader_id", "channel", "local_date"])


def regrouped(parts):
    return parts.groupBy("reader_id", "section", "local_date").agg(F.sum(F.col("views") * F.col("weight")).alias("section_views"), F.sum("total_time_seconds").alias("section_time_seconds"), F.countDistinct("content_id").alias("distinct_content_ids"))


def bare(table):
    return lambda c: getattr(daily, table)(daily.Context({**c.inputs}, Manifest(**{**c.manifest.__dict__, "timezone": "UTC"})))


def bare_events(c):
    return daily.event_layer(c).withColumn("local_date", F.col("event_ts").cast("date"))


SENTINEL = "section = '__unresolved__'"
MUTATIONS = {
    "sessions summed": ({"reader_channel_day": summed}, {checks.SESSIONS_MAXIMISED}),
    "full weight": ({"reader_section_day": lambda c: regrouped(daily.section_parts(c).withColumn("weight", F.lit(1.0)))}, {checks.ATTRIBUTION}),
    "unresolved dropped": ({"reader_section_day": lambda c: regrouped(daily.section_parts(c).where(f"NOT {SENTINEL}"))}, {checks.ATTRIBUTION, checks.SENTINEL}),
    "unresolved folded": ({"reader_section_day": lambda c: regrouped(daily.section_parts(c).withColumn("section", F.when(F.expr(SENTINEL), "news").otherwise(F.col("section"))))}, {checks.SENTINEL}),
    "events in another zone": ({"event_layer": bare_events}, {checks.DAY_EVENTS}),
    "mail in another zone": ({"reader_email_day": bare("reader_email_day")}, {checks.DAY_EMAIL}),
    "actions in another zone": ({"reader_community_day": bare("reader_community_day")}, {checks.DAY_COMMUNITY}),
    "split grain": ({"reader_section_day": lambda c: daily.section_parts(c).groupBy("reader_id", "section", "local_date", "content_id").agg(F.sum(F.col("views") * F.col("weight")).alias("section_views"), F.sum("total_time_seconds").alias("section_time_seconds"), F.lit(1).alias("distinct_content_ids")).drop("content_id")}, {f"{checks.KEYS_UNIQUE}[reader_section_day]"}),
    "null section": ({"reader_section_day": lambda c: daily.reader_section_day(c).withColumn("section", F.when(F.col("section") == "food", F.lit(None)).otherwise(F.col("section")))}, {checks.SECTION_SET}),
}


@pytest.mark.parametrize("name", list(MUTATIONS))
def test_mutations(inputs, name):
    replaced, want = MUTATIONS[name]
    assert failed(inputs, **replaced) == want


def test_unchanged_passes(inputs):
    found = checks.run_checks(daily.context(inputs, demo.manifest()))
    checks.require(found)
    assert len(found) == 14


def test_refusals(inputs):
    with pytest.raises(daily.BuildError, match="content"):
        daily.context({n: df for n, df in inputs.items() if n != "content"}, demo.manifest())
    with pytest.raises(daily.BuildError, match="no builder"):
        daily.context(inputs, demo.manifest(), {"other": summed})
    with pytest.raises(checks.ChecksFailed, match="sessions_are_maximised"):
        checks.require(checks.run_checks(daily.context(inputs, demo.manifest(), {"reader_channel_day": summed})))


def test_optional_inputs(inputs):
    only = lambda *gone: {n: df for n, df in inputs.items() if n not in gone}
    assert daily.context(only("email_open"), demo.manifest())["reader_email_day"].columns == ["list_id", "reader_id", "local_date", "clicks"]
    assert "reader_email_day" not in daily.outputs(daily.context(only("email_open", "email_click"), demo.manifest()))
    assert "reader_community_day" not in daily.outputs(daily.context(only("community_action"), demo.manifest()))


def test_build_writes(spark, inputs, tmp_path):
    write_delivery(inputs, demo.manifest(), str(tmp_path))
    report = build_delivery(spark, str(tmp_path), str(tmp_path / "out"))
    assert report["feature_set"] == "full" and all(c["passed"] for c in report["checks"])
    assert spark.read.parquet(str(tmp_path / "out/reader_channel_day.parquet")).count() == report["tables"]["reader_channel_day"]


def test_filters_reach_the_scan(spark, inputs, tmp_path):
    write_delivery(inputs, demo.manifest(), str(tmp_path))
    stored = {n: spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in inputs}
    plan = daily.context(stored, demo.manifest())["reader_channel_day"]._jdf.queryExecution().executedPlan().toString()
    assert "published_ts" not in plan and "IsNotNull(content_id)" in plan
