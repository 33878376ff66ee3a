"""The whole lane on a made-up cohort: structure, determinism and refusals."""

from datetime import date

import numpy as np
import pytest

from lectern.contract import validate
from lectern.model import wide
from lectern.model.bundle import Bundle, BundleError, score
from lectern.model.settings import LaneSettings, SettingsError, Thresholds, parse_thresholds, render_thresholds, resolve_feature_set
from lectern.plans import lane, panel, weekly
from lectern.sources import cohort

EASY = Thresholds(seed_ari=0.05, selection_survival_floor=0.3, selection_perturbation_draws=3, cross_algorithm_ari_by_k={3: 0.05, 4: 0.05, 7: 0.05})


@pytest.fixture(scope="module")
def delivery(spark):
    return {n: df.persist() for n, df in cohort.build(spark, cohort.Cohort(readers=90, weeks=12)).items()}


@pytest.fixture(scope="module")
def tables(delivery):
    return {n: df.persist() for n, df in lane.daily_tables(delivery, cohort.manifest()).items()}


@pytest.fixture(scope="module")
def settings():
    return LaneSettings(cohort.manifest(), cohort.bucket_map(), k_grid=(3, 4), starts=4, gates=EASY)


@pytest.fixture(scope="module")
def result(spark, tables, settings):
    return lane.run_lane(spark, tables, settings)


def test_cohort_conforms(delivery):
    reports = validate.validate_tables(delivery, cohort.manifest())
    assert [str(f) for r in reports for f in r.findings] == []


def test_lane_freezes_and_scores(result, tmp_path):
    assert result.champion == 3 and result.bundle is not None and set(result.tables) == set(lane.LANE_OUTPUTS)
    features, scores = result.tables["reader_week_features"], result.tables["reader_week_cluster"]
    assert scores.count() == features.count() == result.tables["reader_week_measures"].count()
    assert scores.where("cluster_label IS NULL").count() == 0
    idle = scores.where(f"cluster_label = '{weekly.NO_RECENT}'")
    assert idle.where("cluster_distance IS NOT NULL OR cluster_index IS NOT NULL").count() == 0
    assert abs(sum(r.share for r in result.tables["cluster_profile"].collect()) - 1) < 1e-9
    measures = result.tables["reader_week_measures"]
    assert measures.where("m1_percentile <= 0 OR m1_percentile > 100 OR m1_percentile IS NULL").count() == 0
    assert "interpretability_reviewed" in result.decision.describe() and not result.decision.publish_labels
    lane.write_result(result, str(tmp_path))
    again = Bundle.load(str(tmp_path / "frozen_bundle.json"))
    assert again.to_json() == result.bundle.to_json()
    a, b = (sorted(map(str, score(features, x, result.settings.feature_version).collect())) for x in (again, result.bundle))
    assert a == b
    with pytest.raises(BundleError, match="fitted on"):
        score(features, again, "other")
    with pytest.raises(lane.LaneError, match="undeclared"):
        lane.write_outputs({"other": features}, str(tmp_path))


def test_scores_equal_numpy(result):
    b = result.bundle
    rows = result.tables["reader_week_features"].where("NOT no_recent_flag").select("reader_id", "as_of_week_end", b.surface.vector().alias("x")).collect()
    got = {(r.reader_id, r.as_of_week_end): r for r in result.tables["reader_week_cluster"].collect()}
    for r in rows:
        d = np.sqrt(((np.array(r.x) - b.centers) ** 2).sum(1))
        s = got[r.reader_id, r.as_of_week_end]
        k = int(d.argmin())
        assert s.cluster_index == k and s.cluster_distance == pytest.approx(d.min()) and s.cluster_confidence_margin == pytest.approx(np.sort(d)[1] - d.min())
        assert s.within_cluster_distance_pct == pytest.approx((np.array(b.typical.training[k]) <= d.min() + 1e-9).mean())
        assert s.out_of_distribution == int(d.min() > b.typical.p95[k])


def test_measures_equal_numpy(result):
    from lectern.model.measures import SOURCES

    m = result.bundle.measures
    frame = result.tables["reader_week_features"].toPandas().set_index(["reader_id", "as_of_week_end"])
    got = result.tables["reader_week_measures"].toPandas().set_index(["reader_id", "as_of_week_end"]).loc[frame.index]
    z = np.column_stack([(frame[SOURCES[s]].to_numpy(float) - m.center[s]) / m.scale[s] for s in m.center])
    assert np.allclose(z @ np.array(m.m1.loadings), got["m1_score"])
    q = np.round(got["m1_score"], 10)
    assert np.allclose(q.groupby(level=1).rank(pct=True) * 100, got["m1_percentile"])
    signals = list(m.center)
    m2 = sum(m.weights[b] * z[:, [signals.index(s) for s in p.signals]].mean(1) for b, p in m.blocks.items())
    assert np.allclose(m2, got["m2_score"])


def test_no_champion_still_reports(spark, tables, settings):
    strict = LaneSettings(settings.manifest, settings.bucket_map, k_grid=(3,), starts=3, gates=Thresholds(seed_ari=1.0, cross_algorithm_ari_by_k={3: 1.0}, selection_perturbation_draws=2))
    out = lane.run_lane(spark, tables, strict)
    assert out.champion is None and out.bundle is None and set(out.tables) == {"k_selection", "gate_report"}
    assert "a_k_survived_selection" in out.decision.describe()


def test_too_few_weeks(spark, tables, settings):
    with pytest.raises(lane.LaneError, match="2 are needed"):
        lane.run_lane(spark, tables, settings, max_weeks=1)


def test_panel_is_one_week_a_month(result, settings):
    import hashlib

    features = result.tables["reader_week_features"]
    chosen = panel.sample(panel.eligible(features), 5).collect()
    groups = {}
    for r in panel.eligible(features).collect():
        groups.setdefault((r.reader_id, f"{r.as_of_week_end:%Y-%m}"), []).append(r.as_of_week_end)
    want = {(reader, sorted(weeks)[int(hashlib.sha256(f"5:{reader}:{month}".encode()).hexdigest(), 16) % len(weeks)]) for (reader, month), weeks in groups.items()}
    assert {(r.reader_id, r.as_of_week_end) for r in chosen} == want and len(chosen) == len(want)
    months = {}
    for reader, week in want:
        months.setdefault(f"{week:%Y-%m}", []).append((hashlib.sha256(f"5:{reader}:{week}".encode()).hexdigest(), reader, week))
    least = min(map(len, months.values()))
    kept = {(r.reader_id, r.as_of_week_end) for r in panel.balance(panel.sample(panel.eligible(features), 5), 5).collect()}
    assert kept == {(reader, week) for rows in months.values() for _, reader, week in sorted(rows)[:least]}


def test_wide_construction(result, settings):
    features = result.tables["reader_week_features"]
    rows = panel.eligible(features)
    anchors = weekly.anchors_of(settings.weekly(), True, True)
    w = wide.fit_wide(rows, anchors, settings.bucket_map.names)
    assert {b.method for b in w.blocks.values()} <= {wide.PCA, wide.ANCHOR, wide.EQUAL, wide.DROPPED}
    matrix = wide.apply_wide(rows, w)
    columns = [c for cols in w.membership.values() for c in cols]
    spread = wide.require_matrix(matrix, columns)
    dense = {c: x for c, x in spread.items() if c.startswith(("web_intensity", "app_intensity", "overall_active"))}
    wide.unit_variance(dense)
    shares = wide.weights_of(settings.weights, w.membership)
    parts = wide.contributions(wide.weighted(matrix, w.membership, shares), w.membership)
    assert parts["consumption"] == pytest.approx(shares["consumption"], abs=0.12) and sum(parts.values()) == pytest.approx(1)
    assert {r.column for r in wide.imputation_shares(matrix).collect()} >= {"topic_breadth", "web_depth"}
    with pytest.raises(wide.WideError, match="without a record"):
        wide.require_matrix(matrix, [*columns, "gone"])
    with pytest.raises(wide.WideError, match="sum to 1"):
        wide.weighted(matrix, w.membership, {b: 0.5 for b in w.membership})


def test_settings():
    assert parse_thresholds(render_thresholds()) == Thresholds()
    for bad in ("[gates]\nseed_ari = 2.0", "[gates]\nnope = 1", "[gates]\nseed_ari = true", "[other]\nx = 1", "[gates", "[gates.cross_algorithm_ari_by_k]\n1 = 0.3"):
        with pytest.raises(SettingsError):
            parse_thresholds(bad)
    with pytest.raises(SettingsError, match="no agreement bar"):
        LaneSettings(cohort.manifest(), cohort.bucket_map(), k_grid=(2,))
    m = cohort.manifest()
    assert resolve_feature_set(m).id == "full"
    gone = {**m.optional_inputs, "email_click": type(m.optional_inputs["email_click"])("not_deployed")}
    less = type(m)(m.contract_version, m.timezone, m.week_anchor, m.article_view, m.population, gone)
    assert resolve_feature_set(less).id == "no-email-cadence" and LaneSettings(less, cohort.bucket_map()).surface == "intensity"
    with pytest.raises(SettingsError, match="declares absent"):
        LaneSettings(less, cohort.bucket_map(), surface="joint")


def test_without_optional_inputs(delivery, tables, settings):
    less = {n: t for n, t in tables.items() if n not in ("reader_email_day", "reader_community_day")}
    built = weekly.build_weekly(less, [date(2026, 2, 15)], settings.weekly())
    assert not [c for c in built.features.columns if c.startswith(("email", "community"))] and built.features.count()
