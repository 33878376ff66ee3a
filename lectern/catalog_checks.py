"""Queries that show what the contract, the settings and the model kernels decide, each with what SQL says of the same.

Refusals and texts are constants, so their SQL lists them. Statistics of clusterings are shown on three labelings that
SQL can repeat (a: the nearest of given centroids, b and c: steps of web and app views); what they need of the rows is
counted by Spark, and the kernels get the counts.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from datetime import date

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.catalog import build, register, rounded, table_sql
from lectern.catalog_model import EASY, LANE, _gone, _summed, frame
from lectern.catalog_weekly import _SCORED, BUCKETS, KEY, SCALED, Run, query, scaled, scored
from lectern.contract import example, mapping, oracle, reference, schema, validate
from lectern.contract import manifest as mf
from lectern.functions import columns as fn
from lectern.model import calibration as cal
from lectern.model import gates, selection
from lectern.model import kernels as kn
from lectern.model import spread
from lectern.model.assignment import Typical, rank_labels
from lectern.model.bundle import Bundle, BundleError
from lectern.model.calibration import Calibration
from lectern.model.census import census
from lectern.model.measures import SOURCES, fit_measures_rows, layout
from lectern.model.settings import INTENSITY, JOINT, resolve_feature_set, resolve_surface
from lectern.model.surface import CADENCE_FEATURE, Surface, fit_surface, sources
from lectern.operators import checks, daily
from lectern.plans import lane, weekly
from lectern.plans import panel as pn
from lectern.plans.buckets import completeness
from lectern.session import scratch_dir
from lectern.sources.testdata import delivery, manifest, sql


def values(names: str, *rows: tuple) -> str:
    """A statement that lists rows of texts, numbers and truth values."""
    text = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) AS t({names})"


def refused(act: Callable[[], object], *errors: type[Exception]) -> bool:
    try:
        act()
    except errors:
        return True
    return False


# --- settings and manifests ---

_MANIFEST = values(
    "key, value",
    ("contract_name", "reader-engagement-input"),
    ("contract_version", "1.0.0"),
    ("day_boundary_timezone", "America/New_York"),
    ("week_anchor", "{'weekday': 'Sunday', 'position': 'week_ends_on'}"),
    ("article_view", "{'definition_id': 'article-view', 'content_types': ['article'], 'event_kinds': ['content_delivery']}"),
    ("scored_population", "{'definition_id': 'subscribers', 'entitled_states': ['trial', 'active', 'grace']}"),
    ("optional_inputs", "{'email_click': {'status': 'available', 'available_from': '2023-12-01'}, 'email_open': {'status': 'available', 'available_from': '2023-12-01'}, 'community_action': {'status': 'available', 'available_from': '2023-12-01'}}"),
)
register("src_4", _MANIFEST)(lambda spark, sf_dir: frame(spark, [(k, str(x)) for k, x in mf.as_dict(mf.parse(mf.as_dict(manifest()))).items()], "key string, value string"))
register("src_5", _MANIFEST)(lambda spark, sf_dir: frame(spark, [(k, str(x)) for k, x in mf.as_dict(manifest()).items()], "key string, value string"))
register("src_6", values("section, bucket", ("en", "english"), ("fr", "romance"), ("es", "romance")))(lambda spark, sf_dir: frame(spark, list(BUCKETS.bucket_of.items()), "section string, bucket string"))
_GATES = values(
    "line",
    ("[gates]",),
    ("seed_ari = 0.7",),
    ("centroid_distinctness_corr = 0.9",),
    ("tiny_cluster_floor = 0.01",),
    ("major_cluster_share = 0.01",),
    ("topic_coverage_floor = 0.8",),
    ("t4_retention = 0.45",),
    ("t4_profile_similarity = 0.8",),
    ("selection_perturbation_draws = 50",),
    ("selection_perturbation_row_fraction = 0.001",),
    ("selection_survival_floor = 0.5",),
    ("selection_rng_seed = 20260824",),
    ("[gates.cross_algorithm_ari_by_k]",),
    ("3 = 0.46",),
    ("4 = 0.42",),
    ("5 = 0.38",),
    ("6 = 0.35",),
    ("7 = 0.34",),
    ("8 = 0.33",),
    ("9 = 0.32",),
    ("10 = 0.31",),
)


@register("src_7", _GATES)
@register("misc_4", _GATES)
def misc_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.model.settings import parse_thresholds, render_thresholds

    return frame(spark, [(x,) for x in render_thresholds(parse_thresholds(render_thresholds())).splitlines() if x], "line string")


register("misc_5", values("k, bar", (2, "0.5"), (3, "0.4")).replace("'0.5'", "0.5::DOUBLE").replace("'0.4'", "0.4::DOUBLE"))(lambda spark, sf_dir: frame(spark, list(EASY.with_bars({2: 0.5, 3: 0.4}).cross_algorithm_ari_by_k.items()), "k int, bar double"))
register(
    "misc_10",
    values(
        "line",
        ("time zone       : America/New_York",),
        ("weeks end on    : Sunday",),
        ("article view    : article-view",),
        ("population      : subscribers (trial, active, grace)",),
        ("excluded readers: 0",),
        ("surface         : joint",),
        ("buckets         : testdata-1: english, romance, other",),
        ("email lists     : all",),
        ("content-active  : 3 views in 2 sections",),
        ("candidate k     : 3",),
        ("feature version : contract=1.0.0|article_view=article-view|population=subscribers|week=Sunday|tz=America/New_York|buckets=testdata-1|click_unit=click_event|surface=joint",),
    ),
)(lambda spark, sf_dir: frame(spark, [(x,) for x in LANE.describe().splitlines()], "line string"))
register(
    "val_15",
    values("id, kept, dropped", ("full", "spine,consumption,topic,email_cadence,deliverability,community", ""), ("no-email-cadence", "spine,consumption,topic,deliverability,community", "email_cadence"), ("no-deliverability+no-community", "spine,consumption,topic,email_cadence", "community,deliverability")),
)(lambda spark, sf_dir: frame(spark, [(x.id, ",".join(x.kept_blocks), ",".join(sorted(x.dropped))) for x in (resolve_feature_set(_gone(manifest(), *names)) for names in ((), ("email_click",), ("email_open", "community_action")))], "id string, kept string, dropped string"))
register("fe_14", values("left_out, surface", ("none", "joint"), ("email_click", "intensity"), ("email_open", "joint"), ("community_action", "intensity")))(lambda spark, sf_dir: frame(spark, [(",".join(names) or "none", resolve_surface(_gone(manifest(), *names))) for names in ((), ("email_click",), ("email_open",), ("community_action",))], "left_out string, surface string"))
_BASIC = [("intensity", "web_views"), ("intensity", "app_views"), ("intensity", "resolved_section_views"), ("intensity", "overall_active_days"), ("breadth", "distinct_sections"), ("breadth", "topic_entropy")]
_SOCIAL, _MAIL = [("community", "community_actions"), ("community", "community_active_days")], [("loyalty", "email_cadence")]
register("ml_18", values("email, community, block, signal", *((e, c, *x) for e in (True, False) for c in (True, False) for x in _BASIC + _SOCIAL * c + _MAIL * e)))(lambda spark, sf_dir: frame(spark, [(e, c, b, s) for e in (True, False) for c in (True, False) for b, own in layout(e, c).items() for s in own], "email boolean, community boolean, block string, signal string"))
register(
    "misc_6",
    values(
        "kind, name, value",
        ("settable", "gates.seed_ari", "0.7"),
        ("settable", "gates.centroid_distinctness_corr", "0.9"),
        ("settable", "gates.tiny_cluster_floor", "0.01"),
        ("settable", "gates.major_cluster_share", "0.01"),
        ("settable", "gates.topic_coverage_floor", "0.8"),
        ("settable", "gates.t4_retention", "0.45"),
        ("settable", "gates.t4_profile_similarity", "0.8"),
        ("settable", "gates.selection_perturbation_draws", "50"),
        ("settable", "gates.selection_perturbation_row_fraction", "0.001"),
        ("settable", "gates.selection_survival_floor", "0.5"),
        ("settable", "gates.selection_rng_seed", "20260824"),
        ("settable", "gates.cross_algorithm_ari_by_k.3", "0.46"),
        ("settable", "gates.cross_algorithm_ari_by_k.4", "0.42"),
        ("settable", "gates.cross_algorithm_ari_by_k.5", "0.38"),
        ("settable", "gates.cross_algorithm_ari_by_k.6", "0.35"),
        ("settable", "gates.cross_algorithm_ari_by_k.7", "0.34"),
        ("settable", "gates.cross_algorithm_ari_by_k.8", "0.33"),
        ("settable", "gates.cross_algorithm_ari_by_k.9", "0.32"),
        ("settable", "gates.cross_algorithm_ari_by_k.10", "0.31"),
        ("settable", "weights.consumption", "0.4"),
        ("settable", "weights.email_click", "0.125"),
        ("settable", "weights.community", "0.075"),
        ("settable", "weights.cross_channel", "0.25"),
        ("settable", "weights.topic", "0.15"),
        ("fixed", "window days", "28"),
        ("fixed", "weekly bins", "4"),
        ("fixed", "recency without activity", "29"),
        ("fixed", "least views of a rate", "3.0"),
        ("fixed", "least sessions of a rate", "2.0"),
        ("fixed", "share closure", "1e-09"),
        ("fixed", "z clip", "5.0"),
        ("fixed", "upper limit quantile", "0.995"),
        ("fixed", "zero share of sparse counts", "0.9"),
        ("fixed", "least variance", "0.5"),
        ("fixed", "largest variance", "2.0"),
        ("fixed", "redundant correlation", "0.8"),
        ("fixed", "out of distribution", "0.95"),
        ("fixed", "far out of distribution", "0.99"),
        ("fixed", "decimals of scores", "10"),
    ),
)(lambda spark, sf_dir: frame(spark, census(), "kind string, name string, value string"))
register(
    "misc_8",
    values(
        "line",
        ("# reader-engagement-input 1.0.0",),
        ("## reader (required)",),
        ("key: reader_id",),
        ("- reader_id: string",),
        ("- id_grain: string, one of resolved_person",),
        ("## subscription_span (required)",),
        ("key: reader_id, start_ts",),
        ("- reader_id: string",),
        ("- state: string, one of registered_unpaid, trial, active, grace, payment_failed, cancelled, expired",),
        ("- payer_type: string, may be null, one of individual, institutional, guest",),
        ("- start_ts: timestamp",),
        ("- end_ts: timestamp, may be null",),
    ),
)(lambda spark, sf_dir: frame(spark, [(x,) for x in reference.render((schema.BY_NAME["reader"], schema.BY_NAME["subscription_span"])).splitlines() if x], "line string"))


# --- the validator, the lint and the runner ---


def findings(change: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m, tables = change(manifest(), delivery(spark, sf_dir))
        rows = [(f.table, f.code, f.column or "", f.rows or 0) for t in validate.validate_tables(tables, m) for f in t.findings]
        return frame(spark, rows, "table_name string, code string, col string, n long")

    return run


def _found(*rows: tuple[str, str, str, str]) -> str:
    return sql(" UNION ALL ".join(f"SELECT '{t}' AS table_name, '{code}' AS code, '{col}' AS col, {f'(SELECT count(*) FROM {n})' if n else '0::BIGINT'} AS n" for t, code, col, n in rows))


register("val_1", _found(("content", "MISSING_REQUIRED_TABLE", "", ""), ("email_click", "FILE_ABSENT_BUT_DECLARED_AVAILABLE", "", "")))(findings(lambda m, t: (m, {k: df for k, df in t.items() if k not in ("content", "email_click")})))
register("val_2", _found(("email_open", "FILE_PRESENT_BUT_DECLARED_ABSENT", "", "")))(findings(lambda m, t: (_gone(m, "email_open"), t)))
register("val_3", _found(("content", "MISSING_REQUIRED_COLUMN", "published_ts", "content"), ("content", "UNEXPECTED_COLUMN", "headline", "content"), ("content", "FORBIDDEN_COLUMN", "scroll_depth", "content")))(
    findings(lambda m, t: (m, t | {"content": t["content"].drop("published_ts").withColumn("headline", F.lit("x")).withColumn("scroll_depth", F.lit(1))}))
)
register("val_4", _found(("reader_event", "TIMESTAMP_NOT_TIMEZONE_AWARE", "event_ts", "reader_event"), ("email_open", "COLUMN_TYPE_MISMATCH", "event_ts", "email_open")))(
    findings(lambda m, t: (m, t | {"reader_event": t["reader_event"].withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")), "email_open": t["email_open"].withColumn("event_ts", F.lit("x"))}))
)
_FIELDS = {
    "reader": "reader_id, id_grain",
    "reader_event": "event_id, reader_id, event_ts, channel, event_kind, content_id, session_id, engagement_time_seconds",
    "content": "content_id, content_type, section_resolution, sections, published_ts",
    "subscription_span": "reader_id, state, payer_type, start_ts, end_ts",
    "email_click": "event_id, reader_id, event_ts, list_id, campaign_id",
    "email_open": "event_id, reader_id, event_ts, list_id, campaign_id",
    "community_action": "event_id, reader_id, event_ts, action_kind, site_id, target_content_id",
}
register("val_14", values("table_name, field, compatible", *((t, f, True) for t, names in _FIELDS.items() for f in names.split(", "))))(
    lambda spark, sf_dir: frame(spark, [(t.name, f.name, schema.compatible(f.type, df.schema[f.name].dataType)) for t in schema.TABLES for df in [delivery(spark, sf_dir)[t.name]] for f in t.fields], "table_name string, field string, compatible boolean")
)


@register("val_13", sql("SELECT 'contract: reader-engagement-input 1.0.0' AS line UNION ALL SELECT 'directory: tables' UNION ALL SELECT 'PASS: no findings' UNION ALL " + " UNION ALL ".join(f"SELECT 'PASS  ' || rpad('{t}', 20, ' ') || ' ' || count(*) || ' rows' FROM {t}" for t in _FIELDS)))
def val_13(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = validate.Report("tables", "1.0.0", None, validate.validate_tables(delivery(spark, sf_dir), manifest()))
    return frame(spark, [(x,) for x in report.render().splitlines() if x], "line string")


@register("src_1", values("table_name, col, refused", ("reader_event", "event_ts", True), ("email_open", "event_ts", True), ("content", "sections", True), ("reader_event", "engagement_time_seconds", True), ("community_action", "event_ts", False)))
def src_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed reading: another type than the contract's is refused, not cast."""
    t = delivery(spark, sf_dir)
    changes = [("reader_event", "event_ts", "timestamp_ntz"), ("email_open", "event_ts", "string"), ("content", "sections", "string"), ("reader_event", "engagement_time_seconds", "int"), ("community_action", "event_ts", "timestamp")]
    rows = [(name, c, c not in validate.check_types(t[name].withColumn(c, F.col(c).cast(kind)), schema.BY_NAME[name])[1]) for name, c, kind in changes]
    return frame(spark, rows, "table_name string, col string, refused boolean")


@register("val_12", sql("SELECT 'EVENT_BEFORE_AVAILABILITY_FLOOR' AS code, 'event_ts' AS col, count(*) AS early FROM email_click WHERE event_ts < TIMESTAMPTZ '2024-01-05 05:00:00+00' HAVING count(*) > 0"))
def val_12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validator's floor: local midnight of the first day that the manifest declares."""
    m = manifest()
    late = dataclasses.replace(m, optional_inputs=m.optional_inputs | {"email_click": mf.Availability("available", date(2024, 1, 5))})
    found = validate.check_floor(delivery(spark, sf_dir)["email_click"], schema.BY_NAME["email_click"], {"event_ts"}, late)
    return frame(spark, [(f.code, f.column, f.rows) for f in found], "code string, col string, early long")


@register(
    "val_16",
    values(
        "change, code, place",
        ("another version", "contract_mismatch", "contract.version"),
        ("no table", "missing_table", "tables.content"),
        ("no answer", "placeholder_value", "tables.content.content_id.rationale"),
        ("a person", "personal_identifier", "declarations.week_anchor.owner_role"),
        ("a path upwards", "implementation_path_escapes", "tables.content.content_id.implementation.path"),
    ),
)
def val_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lint's errors for a document in order (none) and for changed ones."""
    one = lambda d: d["tables"]["content"]["fields"]["content_id"]
    changes: dict[str, Callable[[dict], object]] = {
        "none": lambda d: None,
        "another version": lambda d: d["contract"].update(version="0.9"),
        "no table": lambda d: d["tables"].pop("content"),
        "no answer": lambda d: one(d).update(rationale="TBD"),
        "a person": lambda d: d["declarations"]["week_anchor"].update(owner_role="jo@paper.org"),
        "a path upwards": lambda d: one(d)["implementation"].update(path="../x.sql"),
    }
    rows = []
    for name, change in changes.items():
        document = mapping.example()
        change(document)
        rows += [(name, f.code, f.where) for f in mapping.lint(document).errors]
    return frame(spark, rows, "change string, code string, place string")


_CASES = values("id, passed, exit_code", ("baseline", True, 0), ("no-population", True, 2), ("no-zone", True, 1), ("no-content", True, 1), ("scrolling", True, 1))


@register("val_17", _CASES)
@register("val_18", _CASES)
def val_18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worked example, written and put through the runner."""
    directory = scratch_dir(spark).removeprefix("file:")
    example.build(spark, directory)
    return frame(spark, [(c.id, c.passed, c.exit_code) for c in oracle.run(spark, oracle.load(directory), directory)], "id string, passed boolean, exit_code int")


_BUILT = [f"{checks.KEYS_UNIQUE}[{n}]" for n in ("content_dimension", "reader_content_day", "reader_channel_day", "reader_section_day", "reader_email_day", "subscription_state_interval")]
_ALL_CHECKS = [*_BUILT, f"{checks.KEYS_UNIQUE}[reader_community_day]", checks.SESSIONS_MAXIMISED, checks.ATTRIBUTION, checks.SENTINEL, checks.SECTION_SET, checks.DAY_EVENTS, checks.DAY_EMAIL, checks.DAY_COMMUNITY]


@register("chk_9", values("check_name, outcome", *((n, "failed" if n == checks.SESSIONS_MAXIMISED else "skipped" if "community" in n else "passed") for n in _ALL_CHECKS)))
def chk_9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raise that names all that failed; a check whose table isn't built is skipped, which is no pass."""
    c = daily.context(delivery(spark, sf_dir), _gone(manifest(), "community_action"), {"reader_channel_day": _summed})
    ran = checks.run_checks(c)
    failed: list[str] = []
    try:
        checks.require(ran)
    except checks.ChecksFailed as e:
        failed = [x.name for x in e.failed]
    outcomes = {x.name: "failed" if x.name in failed else "passed" for x in ran}
    return frame(spark, [(n, outcomes.get(n, "skipped")) for n in _ALL_CHECKS], "check_name string, outcome string")


# --- sinks and fetches ---


@register("src_8", table_sql("reader_channel_day"))
def src_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published daily tables, written by one run and read by another."""
    directory, c = scratch_dir(spark), build(spark, sf_dir).stage("reader_content_day")
    for name in ("subscription_state_interval", "reader_channel_day", "reader_section_day"):
        c[name].write.parquet(f"{directory}/{name}.parquet")
    return rounded(lane.read_daily(spark, directory)["reader_channel_day"])


@register("snk_2", values("name, outcome, n", ("gate_report", "written", 2), ("notes", "refused", 0)))
def snk_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory, rows = scratch_dir(spark), frame(spark, [("a",), ("b",)], "x string")
    lane.write_outputs({"gate_report": rows}, directory)
    n = spark.read.parquet(f"{directory}/gate_report.parquet").count()
    return frame(spark, [("gate_report", "written", n), ("notes", "refused" if refused(lambda: lane.write_outputs({"notes": rows}, directory), lane.LaneError) else "written", 0)], "name string, outcome string, n int")


@register("snk_4", values("table_name, printed", *((n, True) for n in ("content_dimension", "reader_content_day", "reader_channel_day", "reader_section_day", "reader_email_day", "reader_community_day", "subscription_state_interval"))))
def snk_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of every daily table, printed without running it."""
    plans = {n: df._jdf.queryExecution().optimizedPlan().toString() for n, df in daily.outputs(build(spark, sf_dir)).items()}
    return frame(spark, [(n, "Relation" in p) for n, p in plans.items()], "table_name string, printed boolean")


@register("snk_5", sql("SELECT way, channel, sum(views)::BIGINT AS views FROM reader_channel_day, (VALUES ('arrow'), ('rows'), ('scalar')) AS w(way) GROUP BY way, channel"))
def snk_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result of a row a channel, fetched as an Arrow table, as rows and value by value."""
    sums = build(spark, sf_dir)["reader_channel_day"].groupBy("channel").agg(F.sum("views").alias("views"))
    fetched = {"arrow": sums.toArrow().to_pylist(), "rows": [r.asDict() for r in sums.collect()]}
    fetched["scalar"] = [{"channel": r["channel"], "views": sums.where(F.col("channel") == r["channel"]).first()["views"]} for r in fetched["rows"]]
    return frame(spark, [(way, r["channel"], r["views"]) for way, rows in fetched.items() for r in rows], "way string, channel string, views long")


@register(
    "src_9",
    values(
        "reader_id, channel, local_date, views, sessions, seconds, events",
        ("rdr-a", "app", "2026-02-16", 1, 1, "90.0", 1),
        ("rdr-a", "web", "2026-02-16", 4, 3, "61.5", 4),
        ("rdr-a", "web", "2026-02-20", 1, 1, "60.0", 1),
        ("rdr-a", "web", "2026-03-08", 2, 2, "18.0", 2),
        ("rdr-b", "app", "2026-02-17", 1, 1, "0.0", 1),
        ("rdr-b", "app", "2026-02-24", 1, 1, "25.0", 1),
        ("rdr-b", "web", "2026-03-07", 1, 1, "44.0", 1),
        ("rdr-c", "web", "2026-02-18", 1, 1, "10.0", 2),
        ("rdr-d", "app", "2026-03-01", 1, 1, "15.0", 1),
        ("rdr-d", "web", "2026-02-22", 1, 1, "33.0", 1),
        ("rdr-d", "web", "2026-03-01", 1, 1, "none", 1),
        ("rdr-e", "web", "2026-03-02", 1, 1, "80.0", 1),
        ("rdr-g", "app", "2026-03-04", 1, 1, "20.0", 1),
        ("rdr-h", "web", "2026-03-05", 1, 1, "21.0", 1),
        ("rdr-i", "web", "2026-03-06", 1, 1, "5.0", 1),
    ),
)
def src_9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.sources import demo

    day = daily.context(demo.build(spark), demo.manifest())["reader_channel_day"]
    ints = (F.col(c).cast("int").alias(c) for c in ("views", "sessions"))
    return day.select("reader_id", "channel", F.col("local_date").cast("string").alias("local_date"), *ints, F.coalesce(F.col("total_time_seconds").cast("string"), F.lit("none")).alias("seconds"), F.col("events").cast("int").alias("events"))


query(
    "fn_20",
    "fe_15",
    body=values(
        "col, rule",
        ("as_of_week_end", "name"),
        ("content_active_flag", "*_flag"),
        ("entitled_days_in_window", "name"),
        ("no_recent_flag", "*_flag"),
        ("partial_window_flag", "*_flag"),
        ("payer_type", "name"),
        ("projected_flag", "*_flag"),
        ("reader_id", "name"),
        ("state", "name"),
        ("top_bucket_share_28d", "name"),
        ("topic_entropy_28d", "name"),
        ("unresolved_views_28d", "*unresolved*"),
    ),
)(lambda r: frame(r.spark, sorted(_refused(r).items()), "col string, rule string"))


def _refused(r: Run) -> dict[str, str]:
    from lectern.model.guards import refused_columns

    return refused_columns(weekly.build_weekly(r.tables, r.weeks, r.settings).features.columns)


# --- the frozen model ---


def given_bundle(**changes: object) -> Bundle:
    """A bundle by hand: three centroids on the intensity surface with unit scales."""
    surface = Surface(INTENSITY, {c: Calibration(0.0, 1.0, 0.0, 1.0) for c in sources(INTENSITY)})
    centers = np.array([[float(k)] * len(surface.columns) for k in (0, 2, 1)])
    typical = Typical(dict.fromkeys(range(3), 1.0), dict.fromkeys(range(3), 2.0), {k: (0.5, 1.5) for k in range(3)})
    parts = {"model_version": "given", "frozen_at": "2024-01-31", "lineage": LANE.feature_version, "surface": surface, "centers": centers, "labels": rank_labels(centers), "typical": typical, "panel": {"rule": pn.RULE, "seed": 1}, "bucket_version": BUCKETS.version, "buckets": {k: list(p) for k, p in BUCKETS.buckets.items()}}
    return Bundle(**parts | changes)


@register("ml_15", values("offered, refused", ("own features", False), ("features of another zone", True)))
def ml_15(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = given_bundle()
    other = LANE.feature_version.replace("America/New_York", "Europe/Paris")
    return frame(spark, [(n, refused(lambda v=v: b.require_lineage(v), BundleError)) for n, v in (("own features", LANE.feature_version), ("features of another zone", other))], "offered string, refused boolean")


@register("ml_22", values("bundle, refused", ("complete", False), ("narrow centroids", True), ("no label for a cluster", True), ("a blank label", True), ("no seed", True)))
def ml_22(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes: dict[str, dict] = {"complete": {}, "narrow centroids": {"centers": np.zeros((3, 2))}, "no label for a cluster": {"labels": {0: "x", 1: "y"}}, "a blank label": {"labels": {0: "x", 1: "y", 2: " "}}, "no seed": {"panel": {"rule": pn.RULE}}}
    return frame(spark, [(n, refused(lambda c=c: given_bundle(**c), BundleError)) for n, c in changes.items()], "bundle string, refused boolean")


@register("snk_3", values("part, same", ("document", True), ("centroids", True), ("labels", True), ("scales", True)))
def snk_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle written and read again."""
    path, b = f"{scratch_dir(spark)}/bundle", given_bundle()
    b.write(spark, path)
    again = Bundle.read(spark, path)
    return frame(spark, [("document", again.to_json() == b.to_json()), ("centroids", bool((again.centers == b.centers).all())), ("labels", again.labels == b.labels), ("scales", again.surface == b.surface)], "part string, same boolean")


# --- clusterings ---

_RAW = list(SCALED)
_LABELS = _SCORED | {
    "ab": "SELECT *, cluster_index AS a, CASE WHEN web_views_28d <= 5 THEN 0 WHEN web_views_28d <= 10 THEN 1 ELSE 2 END AS b, CASE WHEN app_views_28d <= 2 THEN 0 WHEN app_views_28d <= 5 THEN 1 ELSE 2 END AS c, "
    "ln(1 + web_views_28d) AS v0, ln(1 + app_views_28d) AS v1, ln(1 + overall_active_days_28d) AS v2, topic_entropy_28d AS v3 FROM scored WHERE NOT partial_window_flag AND NOT no_recent_flag",
}


def _index(x: str, y: str) -> str:
    pairs = lambda by: f"(SELECT sum(n * (n - 1) / 2.0) FROM (SELECT count(*) AS n FROM ab GROUP BY {by}))"
    return f"SELECT '{x} {y}' AS pair, CASE WHEN (r + c) / 2 = r * c / e THEN 1.0 ELSE (p - r * c / e) / ((r + c) / 2 - r * c / e) END::DOUBLE AS ari FROM (SELECT {pairs(f'{x}, {y}')} AS p, {pairs(x)} AS r, {pairs(y)} AS c, (SELECT count(*) * (count(*) - 1) / 2.0 FROM ab) AS e)"


_LABELS |= {"aris": " UNION ALL ".join(_index(*p) for p in (("a", "b"), ("a", "c"), ("b", "c")))}


def labelings(r: Run) -> DataFrame:
    """Eligible reader-weeks with the three labels."""
    step = lambda col, low, high: F.when(F.col(col) <= low, 0).when(F.col(col) <= high, 1).otherwise(2)
    return pn.eligible(scored(r, True)).withColumns({"a": F.col("cluster_index"), "b": step("web_views_28d", 5, 10), "c": step("app_views_28d", 2, 5)})


def counted(r: Run) -> np.ndarray:
    """Rows by the three labels."""
    out = np.zeros((3, 3, 3))
    for x in labelings(r).groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n")).collect():
        out[x.a, x.b, x.c] = x.n
    return out


def indexes(n: np.ndarray) -> dict[str, float]:
    return {"a b": kn.adjusted_rand_of(n.sum(2)), "a c": kn.adjusted_rand_of(n.sum(1)), "b c": kn.adjusted_rand_of(n.sum(0))}


@query("ml_3", body="SELECT pair AS statistic, round(ari, 6) AS value FROM aris UNION ALL SELECT 'median', round(median(ari), 6) FROM aris", **_LABELS)
def ml_3(r: Run) -> DataFrame:
    found = indexes(counted(r))
    return frame(r.spark, [*found.items(), ("median", float(np.median(list(found.values()))))], "statistic string, value double")


_MAJOR = " UNION ALL ".join(f"SELECT count(*) AS m FROM (SELECT {x} FROM ab GROUP BY {x} HAVING count(*) >= 0.01 * (SELECT count(*) FROM ab))" for x in "abc")


@query("ml_5", body="SELECT 'median_ari' AS statistic, round(median(ari), 6) AS value FROM aris UNION ALL SELECT 'major_min', min(m)::DOUBLE FROM majors UNION ALL SELECT 'major_max', max(m)::DOUBLE FROM majors", **_LABELS, majors=_MAJOR)
def ml_5(r: Run) -> DataFrame:
    """The seed report of three labelings: median agreement, and how many clusters of weight each has."""
    n = counted(r)
    majors = [int((n.sum(axis=other) >= EASY.major_cluster_share * n.sum()).sum()) for other in ((1, 2), (0, 2), (0, 1))]
    report = selection.SeedReport(float(np.median(list(indexes(n).values()))), 0.0, min(majors), max(majors))
    return frame(r.spark, [("median_ari", report.median_ari), ("major_min", float(report.major_min)), ("major_max", float(report.major_max))], "statistic string, value double")


_PERMS = "SELECT * FROM (VALUES (0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 2, 0), (2, 0, 1), (2, 1, 0)) AS t(t0, t1, t2)"


@query("ml_4", body="SELECT max(overlap)::BIGINT AS overlap, max(n)::BIGINT AS n FROM (SELECT (SELECT count(*) FROM ab WHERE a = CASE b WHEN 0 THEN t0 WHEN 1 THEN t1 ELSE t2 END) AS overlap, (SELECT count(*) FROM ab) AS n FROM perms)", **_LABELS, perms=_PERMS)
def ml_4(r: Run) -> DataFrame:
    """Rows on which the labels agree once b's are renamed to a's by the largest overlap."""
    table = counted(r).sum(2).T
    to = kn.assignment(table)
    return frame(r.spark, [(int(sum(table[b, a] for b, a in enumerate(to))), int(table.sum()))], "overlap long, n long")


@query("ml_6", body="SELECT count(*) AS violations FROM (SELECT i, j FROM (SELECT x.a AS i, y.a AS j, unnest(x.m) AS p, unnest(y.m) AS q FROM means x JOIN means y ON x.a < y.a) GROUP BY i, j HAVING corr(p, q) > 0.9)", **_LABELS, means="SELECT a, [avg(v0), avg(v1), avg(v2), avg(v3)] AS m FROM ab GROUP BY a")
def ml_6(r: Run) -> DataFrame:
    """Pairs of clusters whose mean profiles are correlated above the limit."""
    means = labelings(r).groupBy("a").agg(*(F.avg(c).alias(f"m{k}") for k, c in enumerate(scaled().values()))).collect()
    return frame(r.spark, [(kn.alike_centroids(np.array([[m[f"m{k}"] for k in range(len(_RAW))] for m in means]), EASY.centroid_distinctness_corr),)], "violations long")


@query("ml_7", body="SELECT 3 AS k, round(ari, 6) AS agreement, 0.46::DOUBLE AS bar, ari >= 0.46 AS passed FROM aris WHERE pair = 'a b'", **_LABELS)
def ml_7(r: Run) -> DataFrame:
    found = indexes(counted(r))["a b"]
    return frame(r.spark, [(3, found, EASY.bar(3), found >= EASY.bar(3))], "k int, agreement double, bar double, passed boolean")


_GAPS = "SELECT x.reader_id, x.as_of_week_end, x.b AS own, y.b AS other, avg(sqrt(power(x.v0 - y.v0, 2) + power(x.v1 - y.v1, 2) + power(x.v2 - y.v2, 2) + power(x.v3 - y.v3, 2))) AS gap FROM ab x JOIN ab y ON x.reader_id <> y.reader_id OR x.as_of_week_end <> y.as_of_week_end GROUP BY ALL"


@query(
    "ml_10",
    body="SELECT round((SELECT avg(CASE WHEN i IS NULL THEN 0 ELSE (o - i) / greatest(o, i) END) FROM (SELECT reader_id, as_of_week_end, min(gap) FILTER (own = other) AS i, min(gap) FILTER (own <> other) AS o FROM gaps GROUP BY reader_id, as_of_week_end)), 6) AS silhouette, "
    "round((SELECT min(n) / max(n) FROM (SELECT count(*) AS n FROM ab GROUP BY b)), 6) AS size_balance",
    **_LABELS,
    gaps=_GAPS,
)
def ml_10(r: Run) -> DataFrame:
    """Silhouette and size balance of b."""
    rows = labelings(r).select("b", F.array(*scaled().values()).alias("x"))
    sizes = rows.groupBy("b").agg(F.count(F.lit(1)).alias("n")).agg((F.min("n") / F.max("n")).alias("size_balance"))
    # two single rows
    return spread.silhouette(rows, "x", "b").join(F.broadcast(sizes))


@query("ml_8", body="SELECT d::INTEGER AS draw, (n - greatest(1, round_even(n * 0.001, 0)))::BIGINT AS kept, true AS distinct_rows FROM (SELECT count(*) AS n FROM eligible), (SELECT unnest([1, 2, 3]) AS d)")
def ml_8(r: Run) -> DataFrame:
    """Rows that perturbed panels keep."""
    n = pn.eligible(r.features).count()
    draws = {d: selection.kept_rows(n, 3, d, EASY) for d in (1, 2, 3)}
    return frame(r.spark, [(d, len(rows), len(np.unique(rows)) == len(rows)) for d, rows in draws.items()], "draw int, kept long, distinct_rows boolean")


_TRIED = values("k, successes", (3, 20), (4, 45), (5, 48), (6, 24))
_LEAST = sql(
    "SELECT k, round(lower_bound, 6) AS survival_lower_bound, lower_bound >= 0.5 AS survives, k = min(k) FILTER (lower_bound >= 0.5) OVER () AS chosen FROM (SELECT k, (p + zz / 2 - 1.645::DOUBLE * sqrt((p * (1 - p) + zz / 4) / 50)) / (1 + zz) AS lower_bound FROM (SELECT k, successes / 50.0::DOUBLE AS p, 1.645::DOUBLE * 1.645::DOUBLE / 50 AS zz FROM tried))",
    tried=_TRIED,
)


@register("ml_11", _LEAST)
@register("srt_4", _LEAST)
def ml_11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least k that survives, of candidates with given screens."""

    def candidate(k: int, good: int) -> selection.Candidate:
        passed = {n: [True] * good + [False] * (50 - good) for n in selection.SCREENS}
        return selection.Candidate(k, selection.SeedReport(0.9, 0.0, k, k), 0.9, 0, 0.5, 0.5, np.zeros((k, 2)), np.zeros(9, dtype=int), passed, {n: [0.5] * 50 for n in selection.SCREENS})

    chosen, table = selection.select([candidate(*x) for x in ((6, 24), (4, 45), (3, 20), (5, 48))], EASY)
    rows = [(int(x.k), float(x.survival_lower_bound), bool(x.survives), x.k == chosen) for x in table.itertuples()]
    return rounded(frame(spark, rows, "k int, survival_lower_bound double, survives boolean, chosen boolean"))


_ALL_SIGNALS = layout(True, True)
_LONG_SIGNALS = " UNION ALL ".join(f"SELECT '{s}' AS signal, a, {SOURCES[s]}::DOUBLE AS x FROM ab" for own in _ALL_SIGNALS.values() for s in own)


@query(
    "ml_16",
    body="SELECT signal, round(g, 6) AS center, round(CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS scale, round(CASE WHEN s > 0 THEN (SELECT sum(e.n * power(e.m - w.g, 2)) FROM each_label e WHERE e.signal = w.signal) / (w.n * s * s) ELSE 0 END, 6) AS eta_sq FROM whole w",
    **_LABELS,
    signals=_LONG_SIGNALS,
    whole="SELECT signal, avg(x) AS g, stddev_pop(x) AS s, count(*) AS n FROM signals GROUP BY signal",
    each_label="SELECT signal, a, avg(x) AS m, count(*) AS n FROM signals GROUP BY signal, a",
)
def ml_16(r: Run) -> DataFrame:
    """Centres, scales and explained spread of the signals, from all eligible rows."""
    m = fit_measures_rows(labelings(r), "a", _ALL_SIGNALS, "testdata")
    return frame(r.spark, [(s, m.center[s], m.scale[s], m.eta_sq[s]) for s in m.center], "signal string, center double, scale double, eta_sq double")


_STALE = " UNION ALL ".join(f"SELECT max(local_date) AS latest FROM {t}" for t in ("reader_channel_day", "reader_community_day", "reader_content_day", "reader_email_day", "reader_section_day"))
_LAST = "SELECT section, sum(section_views) / sum(sum(section_views)) OVER () AS share FROM sw WHERE section <> '__unresolved__' AND as_of_week_end = (SELECT max(as_of_week_end) FROM weeks) GROUP BY section"
_RESOLVED = "SELECT as_of_week_end, CASE WHEN sum(resolved_section_views_28d + unresolved_views_28d) > 0 THEN sum(resolved_section_views_28d) / sum(resolved_section_views_28d + unresolved_views_28d) ELSE 0 END AS share FROM features GROUP BY as_of_week_end"


@query(
    "ml_20",
    body="SELECT 'no_duplicate_spine_rows' AS check_name, (SELECT count(*) = 0 FROM (SELECT 1 FROM features GROUP BY reader_id, as_of_week_end HAVING count(*) > 1)) AS passed, 'all' AS blocks "
    "UNION ALL SELECT 'sources_reach_the_week_end', (SELECT min(latest) FROM stale) >= (SELECT max(as_of_week_end) FROM weeks), 'all' "
    "UNION ALL SELECT 'topic_metadata_coverage', (SELECT avg(share) FROM resolved) >= 0.8, 'topic_only' "
    "UNION ALL SELECT 'bucket_map_completeness', (SELECT count(*) FILTER (share >= 0.005) = 0 AND coalesce(sum(share), 0) <= 0.15 FROM last_week WHERE section NOT IN ('en', 'fr', 'es')), 'topic_only' "
    "UNION ALL SELECT 'model_matrix_finite', true, 'all' UNION ALL SELECT 'baseline_variance_in_bounds', true, 'all' "
    "UNION ALL SELECT 'four_week_retention', false, 'none' UNION ALL SELECT 'four_week_profile_similarity', false, 'none'",
    stale=_STALE,
    last_week=_LAST,
    resolved=_RESOLVED,
)
def ml_20(r: Run) -> DataFrame:
    shares = {x.section: x.share for x in weekly.section_shares(r.tables["reader_section_day"], r.weeks[-1:], r.settings).collect()}
    resolved = [x.resolved_view_share for x in weekly.resolved_share(r.written).collect()]
    stale = weekly.stale_sources(weekly.latest_dates(r.tables), r.weeks[-1])
    found = gates.data_gates(duplicates=weekly.fanned_out(r.written).count(), stale=stale, resolved_share=float(np.mean(resolved or [0.0])), buckets=completeness(BUCKETS, shares), finite=True, variance_ok=True, g=EASY)
    found += gates.temporal_gates(retention=None, similarity=None, g=EASY)
    return frame(r.spark, [(x.check, x.passed, x.blocks) for x in found], "check_name string, passed boolean, blocks string")


# --- scales ---

_WEB = {"web": "SELECT avg(web_views_28d) AS m, stddev_pop(web_views_28d) AS s, quantile_cont(web_views_28d, 0.5) AS mid, quantile_cont(web_views_28d, 0.75) - quantile_cont(web_views_28d, 0.25) AS iqr, count(*) AS n FROM eligible"}


@query(
    "misc_1",
    body="SELECT reader_id, as_of_week_end, web_views_28d AS web_views_28d_raw, round(greatest(-5, least(5, (web_views_28d - m) / greatest(s, 1e-12))), 6) AS web_views_28d_z, round(((SELECT count(*) FROM eligible e WHERE e.web_views_28d < f.web_views_28d) + 0.5 * (SELECT count(*) FROM eligible e WHERE e.web_views_28d = f.web_views_28d)) / n, 6) AS web_views_28d_pct FROM features f, (SELECT * FROM web)",
    **_WEB,
)
def misc_1(r: Run) -> DataFrame:
    c = cal.fit(pn.eligible(r.written), {"w": F.col("web_views_28d")}, with_values=True)["w"]
    x = F.col("web_views_28d")
    return r.written.select(*KEY, x.alias("web_views_28d_raw"), c.z(x, cal.Z_CLIP).alias("web_views_28d_z"), c.pct(x).alias("web_views_28d_pct"))


_SHARE = "CASE WHEN {c} > 0 THEN {c} / (web_views_28d + app_views_28d) * ln({c} / (web_views_28d + app_views_28d)) ELSE 0 END"


@query(
    "misc_2",
    body=f"SELECT reader_id, as_of_week_end, round((web_views_28d - mid) / greatest(iqr, 1e-12), 6) AS robust_z, round(-({_SHARE.format(c='web_views_28d')} + {_SHARE.format(c='app_views_28d')}) / ln(2), 6) + 0.0 AS channel_entropy, NOT no_recent_flag AS clusterable, NOT partial_window_flag AND NOT no_recent_flag AS fit_cohort FROM features f, (SELECT * FROM web)",
    **_WEB,
)
def misc_2(r: Run) -> DataFrame:
    """Helpers of the weekly layer: a robust scale, the spread over channels, and the masks of rows that are clustered and fitted on."""
    c = cal.fit(pn.eligible(r.written), {"w": F.col("web_views_28d")})["w"]
    web, app = F.col("web_views_28d"), F.col("app_views_28d")
    shares = [F.when(web + app > 0, x / (web + app)).otherwise(F.lit(0.0)) for x in (web, app)]
    active = ~F.col("no_recent_flag")
    return r.written.select(*KEY, c.robust_z(web).alias("robust_z"), (fn.entropy(shares) + 0.0).alias("channel_entropy"), active.alias("clusterable"), (active & ~F.col("partial_window_flag")).alias("fit_cohort"))


@query("misc_3", body=f"SELECT '{CADENCE_FEATURE}' AS feature, round(avg(email_click_active_weeks_4), 6) AS mean, round(stddev_pop(email_click_active_weeks_4), 6) AS std FROM eligible WHERE email_clicks_28d > 0 UNION ALL SELECT 'z_log__web_views_28d', round(avg(ln(1 + web_views_28d)), 6), round(stddev_pop(ln(1 + web_views_28d)), 6) FROM eligible")
def misc_3(r: Run) -> DataFrame:
    """The cadence's scale fitted on readers who click, the others on all."""
    scales = fit_surface(pn.eligible(r.written), JOINT, F.col("email_clicks_28d") > 0).scales
    return frame(r.spark, [(c, scales[c].mean, scales[c].std) for c in (CADENCE_FEATURE, "z_log__web_views_28d")], "feature string, mean double, std double")


