"""Queries of the model layer, of sources and sinks, and of the remaining functions.

Those that fit something have no SQL; they run on the weekly features of the benchmark tables with small settings.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.catalog import build, register, rounded, table_sql
from lectern.catalog_weekly import _SCORED, BUCKETS, CENTERS, KEY, SEED, Run, contract_query, query, scaled, scored
from lectern.contract import manifest as mf
from lectern.contract import schema
from lectern.model import bars, wide
from lectern.model import kernels as kn
from lectern.model.assignment import rank_labels
from lectern.model.measures import SOURCES, Block, Measures, layout, scores
from lectern.model.settings import LaneSettings, Thresholds
from lectern.operators import checks, daily
from lectern.plans import panel as pn
from lectern.plans import weekly
from lectern.session import scratch_dir, staged
from lectern.sources import cohort
from lectern.sources.testdata import delivery, manifest, sql

EASY = Thresholds(selection_perturbation_draws=3)
LANE = LaneSettings(manifest(), BUCKETS, k_grid=(3,), starts=4, gates=EASY)


def frame(spark: SparkSession, rows: list, names: str) -> DataFrame:
    return spark.createDataFrame(rows, names)


# --- sources and sinks ---

_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in schema.BY_NAME)


def _counted(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (tables[t].agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n")) for t in schema.BY_NAME))


contract_query("src_2", _COUNTS)(_counted)


@register("snk_1", table_sql("reader_channel_day"))
def snk_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/reader_channel_day.parquet"
    build(spark, sf_dir)["reader_channel_day"].write.option("compression", "none").parquet(path)
    return rounded(spark.read.parquet(path))


register("srt_1", table_sql("reader_channel_day"))(lambda spark, sf_dir: rounded(build(spark, sf_dir)["reader_channel_day"].orderBy(*daily.OUTPUTS["reader_channel_day"].key)))
register("src_10")(lambda spark, sf_dir: cohort.build(spark, cohort.Cohort(readers=30, weeks=4))["reader_event"].groupBy("reader_id", "channel").agg(F.count(F.lit(1)).alias("n")))


# --- projections, orders and scalar functions ---

_ATOMS = ("reader_id", "channel", "local_date", "views", "sessions", "events")
query("prj_7", body=f"SELECT {', '.join(_ATOMS)} FROM reader_channel_day")(lambda r: weekly.require_columns(r.tables["reader_channel_day"], _ATOMS, "reader_channel_day"))
query("srt_2", body="SELECT reader_id, channel, local_date, views FROM reader_channel_day ORDER BY ALL LIMIT 5")(lambda r: r.tables["reader_channel_day"].select("reader_id", "channel", "local_date", "views").orderBy("reader_id", "channel", "local_date", "views").limit(checks.SAMPLE))
query("srt_6", body="SELECT as_of_week_end FROM weeks ORDER BY as_of_week_end DESC LIMIT 2")(lambda r: frame(r.intervals.sparkSession, [(w,) for w in r.weeks[-2:]], "as_of_week_end date"))
contract_query("prj_4", "SELECT event_id FROM reader_event WHERE event_kind IN ('content_delivery')")(lambda t: t["reader_event"].where(F.col("event_kind").isin(*manifest().article_view.event_kinds)).select("event_id"))
contract_query("fn_1", "SELECT event_id, CAST(event_ts AT TIME ZONE 'America/New_York' AS DATE) AS local_date FROM email_open")(lambda t: t["email_open"].select("event_id", daily.local_date(F.col("event_ts"), manifest().timezone).alias("local_date")))
contract_query("fn_2", "SELECT content_id, len(sections)::INTEGER AS n FROM content")(lambda t: t["content"].select("content_id", F.size("sections").alias("n")))
contract_query("fn_3", "SELECT event_id, CASE WHEN engagement_time_seconds IS NULL THEN 'unmeasured' WHEN abs(engagement_time_seconds) IN (0) THEN 'none' ELSE 'some' END AS kind, round(coalesce(engagement_time_seconds, -1), 6) AS seconds FROM reader_event")(lambda t: t["reader_event"].select("event_id", F.when(F.col("engagement_time_seconds").isNull(), "unmeasured").when(F.abs("engagement_time_seconds").isin(0.0), "none").otherwise("some").alias("kind"), F.coalesce("engagement_time_seconds", F.lit(-1.0)).alias("seconds")))
contract_query("fn_4", "SELECT content_id, unnest(sections) AS section FROM content")(lambda t: t["content"].select("content_id", F.explode("sections").alias("section")))
contract_query("fn_19", "SELECT session_id, contains(session_id, ':') AS namespaced, split_part(session_id, '-', 2) AS part FROM reader_event")(lambda t: t["reader_event"].select("session_id", F.col("session_id").contains(":").alias("namespaced"), F.split_part("session_id", F.lit("-"), F.lit(2)).alias("part")))
contract_query("fn_24", "SELECT event_id, nullif(list_id, 'lst-0') AS list_id, reader_id || '/' || list_id AS both_ids FROM email_click")(lambda t: t["email_click"].select("event_id", F.nullif("list_id", F.lit("lst-0")).alias("list_id"), F.concat("reader_id", F.lit("/"), "list_id").alias("both_ids")))
register("fn_23", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")(lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k")))


# --- validator findings and overridden builds ---


_gone = lambda m, *names: dataclasses.replace(m, optional_inputs=m.optional_inputs | {n: mf.Availability("not_deployed") for n in names})


def _summed(c: daily.Context) -> DataFrame:
    key = ["reader_id", "channel", "local_date"]
    wrong = c["reader_content_day"].groupBy(*key).agg(F.sum("sessions").alias("sessions"))
    return daily.reader_channel_day(c).drop("sessions").join(wrong, key)


@register("chk_10", sql("SELECT reader_id, channel, local_date, emitted_sessions, distinct_sessions_day AS expected_sessions FROM (SELECT reader_id, channel, local_date, sum(sessions)::BIGINT AS emitted_sessions, max(distinct_sessions_day) AS distinct_sessions_day FROM reader_content_day GROUP BY ALL) WHERE emitted_sessions <> distinct_sessions_day"))
def chk_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.sessions_off(daily.context(delivery(spark, sf_dir), manifest(), {"reader_channel_day": _summed}))


# --- model ---


def matrix(r: Run) -> tuple[DataFrame, np.ndarray]:
    """Keys in order, and the matrix of the four scaled columns, of all eligible reader-weeks."""
    from lectern.plans.lane import fit_rows

    rows = fit_rows(pn.eligible(r.features), None, SEED).select(*KEY, F.array(*scaled().values()).alias("x")).collect()
    return [(x.reader_id, x.as_of_week_end) for x in rows], np.array([x.x for x in rows])


def flat(table: pa.Table) -> np.ndarray:
    """The arrays of column x as a matrix."""
    x = table.column("x").combine_chunks()
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(scaled()))


def labelled(r: Run, keys: list, labels: np.ndarray) -> DataFrame:
    return frame(r.intervals.sparkSession, [(*k, int(x)) for k, x in zip(keys, labels, strict=True)], "reader_id string, as_of_week_end date, label int")


@query("ml_1")
def ml_1(r: Run) -> DataFrame:
    keys, x = matrix(r)
    return labelled(r, keys, kn.champion(x, 3, 4)[0].labels)


@query("ml_2")
def ml_2(r: Run) -> DataFrame:
    """Ward's clusters of all eligible reader-weeks; the driver gets their distinct points only, and fits them with their numbers of rows."""
    rows = staged(pn.eligible(r.features).select(*KEY, F.array(*scaled().values()).alias("x")), "rows")
    points = rows.groupBy("x").agg(F.count(F.lit(1)).alias("n")).toArrow()
    x = flat(points)
    order = np.lexsort(x.T[::-1])
    labels = np.empty(len(x), dtype=np.int32)
    labels[order] = kn.ward_points(x[order], points.column("n").to_numpy()[order], 3)
    named = r.spark.createDataFrame(points.select(["x"]).append_column("label", pa.array(labels)))
    return rows.join(named, "x").select(*KEY, "label")


@register("ml_9", "SELECT s::INTEGER AS successes, round(greatest(0, (p + zz / 2 - 1.645::DOUBLE * sqrt((p * (1 - p) + zz / 4) / 50)) / (1 + zz)), 6) AS lower_bound FROM (SELECT s, s / 50.0::DOUBLE AS p, 1.645::DOUBLE * 1.645::DOUBLE / 50 AS zz FROM range(51) t(s))")
def ml_9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(frame(spark, [(s, float(kn.wilson_lower(s, 50))) for s in range(51)], "successes int, lower_bound double"))


query("ml_12", body="SELECT cluster_index, round(quantile_cont(cluster_distance, 0.95), 6) AS p95, round(quantile_cont(cluster_distance, 0.99), 6) AS p99, count(*) AS n FROM scored GROUP BY cluster_index", **_SCORED)(lambda r: scored(r).groupBy("cluster_index").agg(F.percentile("cluster_distance", 0.95).alias("p95"), F.percentile("cluster_distance", 0.99).alias("p99"), F.count(F.lit(1)).alias("n")))
_TIERS = rank_labels(CENTERS)
query("ml_14", "srt_3", body=f"SELECT reader_id, as_of_week_end, CASE WHEN no_recent_flag THEN '{weekly.NO_RECENT}' {' '.join(f'WHEN cluster_index = {k} THEN ' + repr(x) for k, x in _TIERS.items())} END AS cluster_label, round(CASE WHEN NOT no_recent_flag THEN cluster_distance END, 6) AS cluster_distance FROM scored", **_SCORED)(
    lambda r: scored(r).select(*KEY, F.when(F.col("no_recent_flag"), weekly.NO_RECENT).otherwise(F.element_at(F.create_map(*(F.lit(x) for kv in _TIERS.items() for x in kv)), F.col("cluster_index"))).alias("cluster_label"), F.when(~F.col("no_recent_flag"), F.col("cluster_distance")).alias("cluster_distance"))
)
_BLOCKS = layout(True, True)
_SIGNALS = tuple(s for b in _BLOCKS.values() for s in b)
GIVEN = Measures("given", dict.fromkeys(_SIGNALS, 1.0), dict.fromkeys(_SIGNALS, 2.0), Block(_SIGNALS, tuple(0.1 * (n + 1) for n in range(len(_SIGNALS))), 1.0, 0.5, 0.0, 1.0), {}, {b: 0.25 for b in _BLOCKS}, {b: Block(own, tuple(0.5 for _ in own), 1.0, 1.0, 0.1, 1.5) for b, own in _BLOCKS.items()})
_Z = {s: f"({SOURCES[s]} - 1.0) / 2.0" for s in _SIGNALS}
_OWN = {b: "((" + " + ".join(f"{_Z[s]} * 0.5" for s in own) + ") - 0.1) / 1.5" for b, own in _BLOCKS.items()}
_M = {
    "m1_score": " + ".join(f"{_Z[s]} * {0.1 * (n + 1)!r}" for n, s in enumerate(_SIGNALS)),
    "m2_score": " + ".join(f"0.25 * ({' + '.join(_Z[s] for s in own)}) / {len(own)}" for own in _BLOCKS.values()),
    "m3_score": f"({' + '.join(_OWN.values())}) / {len(_OWN)}",
} | {f"m3_{b}": x for b, x in _OWN.items()}
query("ml_17", body="SELECT reader_id, as_of_week_end, " + ", ".join(f"round({x}, 6) AS {n}" for n, x in _M.items()) + " FROM features")(lambda r: r.features.select(*KEY, *(c.alias(n) for n, c in scores(GIVEN).items())))


@query("ml_21")
def ml_21(r: Run) -> DataFrame:
    from lectern.plans.lane import fit_rows

    spark = r.intervals.sparkSession
    rows = fit_rows(pn.eligible(r.features), None, SEED).select(F.array(*scaled().values()).alias("x"))
    return spark.createDataFrame(pd.DataFrame(bars.derive(spark, flat(rows.toArrow()), (3,), (bars.GAUSSIAN, bars.PERMUTE), replicates=4, starts=2)))


def fitted_wide(r: Run) -> tuple[wide.Wide, DataFrame]:
    rows = pn.eligible(r.written)
    return wide.fit_wide(rows, weekly.anchors_of(r.settings, True, True), BUCKETS.names), rows


@query("fe_16")
def fe_16(r: Run) -> DataFrame:
    records = [b.record() for b in fitted_wide(r)[0].blocks.values()]
    return frame(r.intervals.sparkSession, [(b["name"], b["method"], ",".join(b["gate_failures"]), b["explained"], b["anchor_corr"]) for b in records], "name string, method string, failures string, explained double, anchor_corr double")


@query("fe_18", "fe_19")
def fe_18(r: Run) -> DataFrame:
    w, rows = fitted_wide(r)
    return wide.apply_wide(rows, w)


@query("fe_21")
def fe_21(r: Run) -> DataFrame:
    w, rows = fitted_wide(r)
    m = wide.apply_wide(rows, w)
    wide.require_matrix(m, [c for cols in w.membership.values() for c in cols])
    shares = wide.weights_of(LANE.weights, w.membership)
    found = wide.contributions(wide.weighted(m, w.membership, shares), w.membership)
    return frame(r.intervals.sparkSession, [(b, shares[b], x) for b, x in found.items()], "block string, weight double, contribution double")
