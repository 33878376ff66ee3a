"""A small delivery by hand: each row shows a rule, and five rows sit where a day ends."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from lectern.contract import schema
from lectern.contract import vocabulary as v
from lectern.contract.manifest import ArticleView, Availability, Manifest, Population, WeekAnchor

ZONE = "America/New_York"
#: Rows near midnight: id, instant, and the day it is in the manifest's zone.
BOUNDARIES = (
    ("evt-90", "2026-02-17T03:15:00", date(2026, 2, 16)),
    ("evt-91", "2026-03-09T02:30:00", date(2026, 3, 8)),
    ("evt-92", "2026-03-08T06:45:00", date(2026, 3, 8)),
    ("opn-90", "2026-03-09T02:33:00", date(2026, 3, 8)),
    ("act-90", "2026-03-09T02:35:00", date(2026, 3, 8)),
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def manifest() -> Manifest:
    there = Availability(v.AVAILABLE, date(2026, 2, 1))
    return Manifest("1.0.0", ZONE, WeekAnchor("Sunday", v.WEEK_ENDS_ON), ArticleView("demo-view", ("article", "liveblog"), (v.DELIVERY,)), Population("demo-subscribers", ("trial", "active", "grace")), {t: there for t in schema.OPTIONAL}, ("rdr-i",))


def rows() -> dict[str, list[tuple]]:
    r = [f"rdr-{x}" for x in "abcdefghi"]
    deliver, interact = v.DELIVERY, v.INTERACTION
    content = [
        ("cnt-1", "article", v.RESOLVED, ["news"], at("2026-02-10T10:00:00")),
        ("cnt-2", "article", v.RESOLVED, ["news", "science"], at("2026-02-11T10:00:00")),
        ("cnt-3", "liveblog", v.RESOLVED, ["sports"], None),
        ("cnt-4", "article", v.RESOLVED, ["food"], at("2026-02-12T10:00:00")),
        ("cnt-5", "video", v.RESOLVED, ["arts"], None),
        ("cnt-6", "newsletter", v.RESOLVED, ["news"], None),
        ("cnt-7", "article", v.UNRESOLVED, None, None),
        ("cnt-8", "gallery", v.UNRESOLVED, [], None),
        ("cnt-9", "article", v.RESOLVED, ["sports", "news", "arts"], None),
        ("cnt-10", "podcast", v.RESOLVED, ["arts"], None),
    ]
    plan = [
        # reader, day, hour, channel, kind, content, session, seconds
        (0, "02-16", 14, "web", deliver, "cnt-1", "s1", 40.0),
        (0, "02-16", 15, "web", deliver, "cnt-2", "s1", None),
        (0, "02-16", 20, "web", deliver, "cnt-1", "s2", 12.5),
        (0, "02-16", 21, "app", deliver, "cnt-3", "s3", 90.0),
        (0, "02-18", 14, "web", interact, "cnt-1", "s4", None),
        (0, "02-20", 14, "web", deliver, "cnt-9", "s5", 60.0),
        (1, "02-17", 14, "app", deliver, "cnt-4", "s6", 0.0),
        (1, "02-19", 14, "app", deliver, "cnt-5", "s7", 30.0),
        (1, "02-24", 14, "app", deliver, "cnt-7", "s8", 25.0),
        (2, "02-18", 14, "web", deliver, "cnt-x", "s9", 10.0),
        (2, "02-18", 15, "web", interact, "cnt-x", "s9", None),
        (2, "02-25", 15, "web", deliver, "cnt-8", "s10", 10.0),
        (3, "02-22", 14, "web", deliver, "cnt-2", "s11", 33.0),
        (3, "03-01", 14, "web", deliver, "cnt-4", "s12", None),
        (3, "03-01", 15, "app", deliver, "cnt-4", "s13", 15.0),
        (4, "02-20", 14, "web", deliver, "cnt-6", "s14", 8.0),
        (4, "03-02", 14, "web", deliver, "cnt-3", "s15", 80.0),
        (5, "03-03", 14, "web", interact, None, "s16", None),
        (6, "03-04", 14, "app", deliver, "cnt-1", "s17", 20.0),
        (7, "03-05", 14, "web", deliver, "cnt-10", "s18", 20.0),
        (7, "03-05", 16, "web", deliver, "cnt-9", "s18", 21.0),
        (8, "03-06", 14, "web", deliver, "cnt-1", "s19", 5.0),
        (1, "03-07", 14, "web", deliver, "cnt-2", "s20", 44.0),
    ]
    events = [(f"evt-{n}", r[i], at(f"2026-{d}T{h:02}:00:00"), channel, kind, item, s, t) for n, (i, d, h, channel, kind, item, s, t) in enumerate(plan, 1)]
    events += [(i, r[0], at(t), "web", deliver, "cnt-1", f"b{n}", 9.0) for n, (i, t, _) in enumerate(BOUNDARIES[:3])]
    spans = [
        (r[0], "active", "individual", "2025-06-01", None),
        (r[1], "trial", "institutional", "2026-01-20", "2026-02-10"),
        (r[1], "active", "institutional", "2026-02-10", None),
        (r[2], "registered_unpaid", None, "2025-12-01", "2026-02-15"),
        (r[2], "trial", "individual", "2026-02-15", "2026-03-15"),
        (r[2], "active", "individual", "2026-03-15", None),
        (r[3], "active", None, "2025-09-01", "2026-02-20"),
        (r[3], "payment_failed", None, "2026-02-20", "2026-02-25"),
        (r[3], "grace", None, "2026-02-25", "2026-03-20"),
        (r[3], "expired", None, "2026-03-20", None),
        (r[4], "registered_unpaid", None, "2025-11-01", None),
        (r[5], "registered_unpaid", None, "2026-01-01", None),
        (r[7], "active", "guest", "2026-01-01", "2026-03-01"),
        (r[7], "cancelled", "guest", "2026-03-01", "2026-03-04"),
        (r[7], "active", "guest", "2026-03-04", None),
        (r[8], "active", "individual", "2025-10-01", None),
    ]
    mail = [(0, "02-16", "lst-1", "cmp-1"), (0, "02-16", "lst-1", "cmp-1"), (0, "02-23", "lst-2", None), (1, "02-18", "lst-1", "cmp-2"), (3, "02-27", "lst-2", "cmp-3"), (4, "03-02", "lst-1", "cmp-4"), (7, "03-05", "lst-2", "cmp-5")]
    acts = [(0, "02-17", "post_created", "cnt-1"), (0, "02-17", "reply_created", "cnt-1"), (0, "02-19", "like_given", None), (1, "02-21", "dislike_given", "cnt-4"), (2, "02-26", "flag_given", None), (4, "03-01", "like_given", "cnt-3")]
    sent = lambda prefix, hour: [(f"{prefix}-{n}", r[i], at(f"2026-{d}T{hour}"), lst, c) for n, (i, d, lst, c) in enumerate(mail, 1)]
    return {
        "reader": [(x, v.READER_GRAINS[0]) for x in r],
        "reader_event": events,
        "content": content,
        "subscription_span": [(i, s, p, at(f"{a}T05:00:00"), b and at(f"{b}T05:00:00")) for i, s, p, a, b in spans],
        "email_click": sent("clk", "15:01:00"),
        "email_open": [*sent("opn", "15:00:00")[:6], ("opn-90", r[3], at(BOUNDARIES[3][1]), "lst-1", None)],
        "community_action": [*((f"act-{n}", r[i], at(f"2026-{d}T16:00:00"), k, "site-1", c) for n, (i, d, k, c) in enumerate(acts, 1)), ("act-90", r[0], at(BOUNDARIES[4][1]), "post_created", "site-1", None)],
    }


def build(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame(data, schema.BY_NAME[n].schema) for n, data in rows().items()}
