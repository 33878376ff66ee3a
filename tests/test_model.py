"""Kernels against brute force and known values; grid, buckets, guards, calibration, bars and command line."""

import itertools
import json
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern import cli
from lectern.contract.manifest import WeekAnchor
from lectern.functions import columns as fn
from lectern.model import bars, calibration, gates, guards, selection
from lectern.model import kernels as kn
from lectern.model.settings import Thresholds
from lectern.plans import buckets
from lectern.plans.grid import GridError, WeekGrid


def blobs(k=3, rows=60, dims=3, seed=0):
    return bars.planted_panel(k, dims, np.random.default_rng(seed), rows), np.repeat(np.arange(k), rows)


def test_kmeans_and_ward_find_planted_clusters():
    x, truth = blobs(4)
    assert kn.adjusted_rand(kn.champion(x, 4, 5)[0].labels, truth) == 1.0
    assert kn.adjusted_rand(kn.ward(x, 4), truth) == 1.0
    a, b = kn.kmeans(x, 4, [1]), kn.kmeans(x, 4, [1])
    assert np.array_equal(a.labels, b.labels) and a.inertia == b.inertia


def test_ward_equals_greedy_merging():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(24, 3))
    groups = [[i] for i in range(24)]
    cost = lambda a, b: len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum()
    while len(groups) > 5:
        i, j = min(itertools.combinations(range(len(groups)), 2), key=lambda p: cost(groups[p[0]], groups[p[1]]))
        groups[i] += groups.pop(j)
    want = np.empty(24, dtype=int)
    for n, g in enumerate(groups):
        want[g] = n
    assert kn.adjusted_rand(kn.ward(x, 5), want) == 1.0


def test_adjusted_rand():
    assert kn.adjusted_rand(np.array([0, 0, 1, 1]), np.array([5, 5, 3, 3])) == 1.0
    assert kn.adjusted_rand(np.array([0, 0, 1, 2]), np.array([0, 0, 1, 1])) == pytest.approx(0.5714285714)
    assert kn.adjusted_rand(np.array([0, 0, 0, 0]), np.array([0, 1, 2, 3])) == pytest.approx(0.0)


def test_assignment_is_optimal():
    rng = np.random.default_rng(4)
    for r, c in [(1, 1), (3, 3), (4, 2), (2, 5), (5, 5)]:
        value = rng.integers(0, 20, (r, c)).astype(float)
        got = kn.assignment(value)
        assert len([g for g in got if g >= 0]) == min(r, c) == len({g for g in got if g >= 0})
        best = max(sum(value[i, j] for i, j in zip(rows, cols, strict=True)) for rows in itertools.permutations(range(r), min(r, c)) for cols in itertools.combinations(range(c), min(r, c)))
        assert sum(value[i, g] for i, g in enumerate(got) if g >= 0) == best
    assert kn.matched(np.array([0, 0, 1, 1, 2]), np.array([7, 7, 5, 5, 9])).tolist() == [0, 0, 1, 1, 2]


def test_silhouette():
    x, truth = blobs(3, 20)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = []
    for i in range(len(x)):
        own = [d[i, j] for j in range(len(x)) if truth[j] == truth[i] and j != i]
        other = min(d[i, truth == c].mean() for c in set(truth) - {truth[i]})
        want.append((other - np.mean(own)) / max(other, np.mean(own)))
    assert kn.silhouette(x, truth, block=7) == pytest.approx(np.mean(want))


def test_small_statistics():
    assert kn.wilson_lower(50, 50) == pytest.approx(0.9487, abs=1e-3) and kn.wilson_lower(0, 5) == 0.0
    assert kn.alike_centroids(np.array([[1, 2, 3], [2, 4, 6.1], [3, 2, 1], [1, 1, 1]]), 0.9) == 1
    scores, load, share, turn = kn.first_component(np.column_stack([np.arange(9.0), -np.arange(9.0), np.arange(9.0) * 2]))
    assert share == pytest.approx(1.0) and load.sum() > 0 and abs(turn) == 1 and scores.std() > 0


def test_sweep(spark):
    x, truth = blobs(4, 40, 5)
    g = Thresholds(selection_perturbation_draws=6)
    found = selection.sweep(spark, x, (3, 4), g, 4)
    k, table = selection.select(found, g)
    assert k in (3, 4) and list(table.k) == [3, 4] and bool(table.survives[1])
    four = found[1]
    assert kn.adjusted_rand(four.labels, truth) == 1.0 and four.agreement == 1.0 and four.silhouette > 0.5
    selection.require_derived(4, found, g)
    with pytest.raises(selection.SelectionError):
        selection.require_derived(5, found, g)
    with pytest.raises(selection.SelectionError, match="no model"):
        selection.sweep(spark, x[:3], (3,), g, 2)


def test_bars(spark):
    x, _ = blobs(3, 20)
    (bar,) = bars.derive(spark, x, (3,), replicates=8, starts=2)
    assert bar.planted > 0.95 and 0 < bar.mean < 0.95 and bar.bar >= bar.mean
    assert bars.round_up(0.4501) == 0.46 and bars.round_up(0.45) == 0.45


def test_grid():
    sunday = WeekGrid.of(WeekAnchor("Sunday", "week_ends_on"))
    assert sunday == WeekGrid.of(WeekAnchor("Monday", "week_starts_on"))
    assert sunday.week_ends(date(2024, 1, 1), date(2024, 1, 30)) == [date(2024, 1, d) for d in (7, 14, 21, 28)]
    assert sunday.full_window_ends(date(2024, 1, 1), date(2024, 2, 4)) == [date(2024, 1, 28), date(2024, 2, 4)]
    assert sunday.full_window_ends(date(2024, 1, 2), date(2024, 1, 28)) == []
    assert [b.days for b in sunday.bins(date(2024, 1, 28))] == [7] * 4 and sunday.trailing(date(2024, 1, 28)).start == date(2024, 1, 1)
    with pytest.raises(GridError):
        sunday.require(date(2024, 1, 27))


def test_buckets():
    good = {"version": "1", "buckets": {"a": ["x", "y"], "b": ["z"]}}
    m = buckets.parse(good)
    assert m.names == ("a", "b", "other") and m.bucket_for("q") == "other"
    done = buckets.completeness(m, {"x": 0.9, "q": 0.1})
    assert done.unmapped == ("q",) and done.catch_all_share == 0.1 and not done.passed
    for change in ({"buckets": {}}, {"buckets": {"a": ["x"], "b": ["x"]}}, {"buckets": {"a": ["__unresolved__"]}}, {"buckets": {"other": ["x"]}}, {"buckets": {"a": []}}, {"catch_all_share_max": 0}, {"buckets": {"a_rate": ["x"]}}, {"min_buckets": 1}, {"max_buckets": 2}):
        with pytest.raises(buckets.BucketError):
            buckets.parse(good | change)
    with pytest.raises(buckets.BucketError):
        m.bucket_for("__unresolved__")


def test_guards():
    assert guards.refused_columns(["state", "web_open_7d", "x_flag", "web_views_28d", "topic_share_a"]) == {"state": "name", "web_open_7d": "*open*", "x_flag": "*_flag"}
    with pytest.raises(guards.ForbiddenColumn):
        guards.require_inputs(["views", "opens"], "here")


def test_calibration(spark):
    values = [0.0, 1.0, 1.0, 2.0, 5.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    c = calibration.fit(df, {"x": F.col("x")}, with_values=True)["x"]
    known = np.array(values[:5])
    assert (c.mean, c.std, c.median) == pytest.approx((known.mean(), known.std(), 1.0)) and c.iqr == pytest.approx(np.subtract(*np.quantile(known, [0.75, 0.25])))
    rows = df.select("x", c.z(F.col("x"), 1.0).alias("z"), c.pct(F.col("x")).alias("p"), c.rank_normal(F.col("x")).alias("r"), c.robust_z(F.col("x")).alias("q")).collect()
    assert [r.p for r in rows] == [pytest.approx(p) if p is not None else None for p in (0.1, 0.4, 0.4, 0.7, 0.9, None)]
    assert rows[4].z == 1.0 and rows[3].q == pytest.approx(1.0) and rows[1].r < 0 < rows[3].r
    w = calibration.fit_winsor(spark.range(1000).select(F.when(F.col("id") < 950, 0.0).otherwise(F.col("id").cast("double")).alias("x")), {"x": F.col("x")})["x"]
    assert w.positive_only and w.upper == pytest.approx(np.quantile(np.arange(950, 1000), 0.995))
    with pytest.raises(calibration.CalibrationError, match="negative"):
        calibration.fit_winsor(df.select((F.col("x") - 1).alias("x")), {"x": F.col("x")})
    with pytest.raises(calibration.CalibrationError):
        calibration.fit(df.limit(0), {"x": F.col("x")})


def test_bin_metrics(spark):
    rows = [(4.0, 0.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0), (0.0, 0.0, 0.0, 0.0), (3.0, 1.0, 0.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = df.select(*(x.alias(n) for n, x in fn.bin_metrics([F.col(x) for x in "abcd"]).items()), fn.momentum(*(F.col(x) for x in "abcd")).alias("m")).collect()
    for r, b in zip(got, np.array(rows), strict=True):
        share = b / b.sum() if b.sum() else np.zeros(4)
        logs = np.log1p(b)
        assert r.active_weeks_4 == (b > 0).sum() and r.top_week_share_4 == pytest.approx(share.max())
        assert r.weekly_cv_4 == pytest.approx(logs.std() / (logs.mean() + 1e-9)) and r.m == pytest.approx(np.log1p(b[:2].sum()) - np.log1p(b[2:].sum()))
        assert abs(r.weekly_evenness_entropy_4) == pytest.approx(-sum(s * np.log(s) for s in share if s) / np.log(4), abs=1e-12)


def test_gates():
    ok = gates.Gate("f", "a", True)
    assert gates.decide([ok]).describe() == "every gate passed"
    d = gates.decide([ok, gates.Gate("f", "b", False, blocks=gates.TOPIC), gates.Gate("f", "c", False, blocks=gates.NOTHING)])
    assert d.publish_labels and not d.publish_topics
    assert not gates.decide([gates.Gate("f", "d", False)]).publish_labels
    found = gates.feature_gates(blocks=[{"name": "x", "method": "pca", "gate_failures": ["y"]}], imputed={"topic_a": 0.4}, active_share=0.5)
    assert [x.passed for x in found] == [False, True, False]


def test_command_line(spark, tmp_path, capsys):
    d = str(tmp_path / "demo")
    assert cli.main(["demo", d], spark) == 0 and cli.main(["validate", d, "--json"], spark) == 0
    assert json.loads(capsys.readouterr().out.split("\n", 0)[0])["passed"]
    assert cli.main(["build", d, "--out", f"{d}/out"], spark) == 0
    assert cli.main(["gates-template"]) == 0 and "[gates]" in capsys.readouterr().out
    c = str(tmp_path / "cohort")
    assert cli.main(["cohort", c, "--readers", "70", "--weeks", "8"], spark) == 0
    code = cli.main(["lane", c, "--bucket-map", f"{c}/bucket-map.json", "--k-max", "3", "--seeds", "2", "--draws", "2", "--out", f"{c}/out"], spark)
    assert code in (cli.NO_MODEL, cli.GATED) and spark.read.parquet(f"{c}/out/gate_report.parquet").count() > 5
    assert cli.main(["lane", c, "--bucket-map", f"{c}/none.json"], spark) == cli.UNTRUSTED
    assert cli.main(["lint-mapping", c]) == cli.UNTRUSTED


def test_model_queries_label_all_eligible_rows(spark):
    from lectern.catalog_model import labelled, matrix
    from lectern.catalog_weekly import Run
    from lectern.plans import panel as pn

    r = Run(spark, "/root/testdata/sf0.1")
    keys, x = matrix(r)
    eligible = pn.eligible(r.features).count()
    assert eligible > 2000 and len(keys) == len(set(keys)) == len(x) == eligible
    assert labelled(r, keys, kn.champion(x, 3, 4)[0].labels).count() == eligible


def test_ranks_and_quantiles_in_ranges(spark, monkeypatch):
    from lectern.operators import ranks

    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=700), np.repeat([0.0, 1.0, -3.0], 100), rng.integers(0, 9, 200)])
    df = spark.createDataFrame([(float(x), k % 2) for k, x in enumerate(values)] + [(None, 0)], "x double, half int")
    monkeypatch.setattr(ranks, "RANGES", 16)
    at = (0.0, 0.013, 0.25, 0.5, 0.995, 1.0)
    got = ranks.quantiles(df, {"x": F.col("x"), "none": F.when(F.col("x") > 1e9, F.col("x"))}, at)
    assert got["x"] == pytest.approx(np.quantile(values, at).tolist()) and got["none"] == [None] * 6
    sizes = df.where("x IS NOT NULL").groupBy("half", "x").agg(F.count(F.lit(1)).alias("n"))
    for r in ranks.ranked(sizes, ["half"], "x", "n").collect():
        own = values[r.half :: 2]
        assert (r._before, r._total) == ((own < r.x).sum(), len(own))
    monkeypatch.setattr(calibration, "ONE_BUFFER", 10)
    monkeypatch.setattr(calibration, "MOST_VALUES", 50)
    c = calibration.fit(df, {"x": F.col("x")}, with_values=True)["x"]
    assert c.median == pytest.approx(np.median(values)) and c.iqr == pytest.approx(np.subtract(*np.quantile(values, [0.75, 0.25])))
    assert len(c.values) <= 52 and c.n == len(values)
    asked = np.linspace(-4, 9, 60)
    true = np.array([(values < x).mean() + 0.5 * (values == x).mean() for x in asked])
    assert np.abs(c.mid_rank(asked) - true).max() < 0.1


def test_measures_of_rows_equal_those_of_a_matrix(spark):
    from lectern.model import measures as ms

    rng = np.random.default_rng(1)
    blocks = ms.layout(True, True)
    signals = [s for own in blocks.values() for s in own]
    x = rng.gamma(2.0, size=(300, 2)) @ rng.random((2, len(signals))) + rng.random((300, len(signals)))
    x[:, 3] = 4.0
    labels = (x[:, 0] > np.median(x[:, 0])).astype(int)
    df = spark.createDataFrame([(int(c), *map(float, r)) for c, r in zip(labels, x, strict=True)], "c int, " + ", ".join(f"{ms.SOURCES[s]} double" for s in signals))
    a, b = ms.fit_measures(x, labels, blocks, "v"), ms.fit_measures_rows(df, "c", blocks, "v")
    for part in ("center", "scale", "eta_sq", "weights"):
        assert getattr(b, part) == pytest.approx(getattr(a, part), abs=1e-9)
    for p, q in [(a.m1, b.m1), *((a.blocks[k], b.blocks[k]) for k in blocks)]:
        assert q.signals == p.signals and q.loadings == pytest.approx(p.loadings, abs=1e-6)
        assert (q.explained, q.center, q.scale) == pytest.approx((p.explained, p.center, p.scale), abs=1e-6)


def test_ward_of_many_and_of_equal_rows():
    """As many rows as the quadratic hierarchy would take hours for; equal rows and equal distances against greedy merging."""
    rng = np.random.default_rng(4)
    for x in (rng.normal(size=(260, 3)), np.repeat(rng.normal(size=(90, 4)), 3, axis=0), rng.lognormal(size=(200, 2)) ** 2):
        center, size, label = [list(c) for c in x], [1] * len(x), {n: [n] for n in range(len(x))}
        while len(label) > 4:
            at = sorted(label)
            c, n = np.array([center[i] for i in at]), np.array([size[i] for i in at])
            cost = ((c[:, None] - c[None]) ** 2).sum(2) * (n[:, None] * n) / (n[:, None] + n)
            np.fill_diagonal(cost, np.inf)
            i, j = (at[v] for v in np.unravel_index(cost.argmin(), cost.shape))
            center[i] = (np.array(center[i]) * size[i] + np.array(center[j]) * size[j]) / (size[i] + size[j])
            size[i] += size[j]
            label[i] += label.pop(j)
        want = np.empty(len(x), dtype=int)
        for n, rows in enumerate(label.values()):
            want[rows] = n
        assert kn.adjusted_rand(kn.ward(x, 4), want) == 1.0
    assert len(np.unique(kn.ward(np.zeros((9, 2)), 3))) == 3
    lattice = np.stack(np.meshgrid(*[np.arange(12.0)] * 4), -1).reshape(-1, 4)
    assert sorted(np.unique(kn.ward(lattice, 3))) == [0, 1, 2]
    truth = np.arange(40_000) % 3
    assert kn.adjusted_rand(kn.ward(rng.normal(size=(40_000, 3)) + 40 * truth[:, None], 3), truth) == 1.0


def test_silhouette_of_a_table(spark, monkeypatch):
    from lectern.model import spread

    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(300, 3)), 1)
    x[200:] = x[:100]
    labels = rng.integers(0, 3, 300)
    labels[200:] = labels[:100]
    x[7], labels[7] = 9.0, 5
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, labels, strict=True)], "x array<double>, b int")
    for block in (10_000, 40):
        monkeypatch.setattr(spread, "BLOCK", block)
        assert spread.silhouette(df, "x", "b").first().silhouette == pytest.approx(kn.silhouette(x, labels), abs=1e-7)
    assert spread.silhouette(df.where("b = 1"), "x", "b").first().silhouette is None
    assert spread.silhouette(df.limit(0), "x", "b").first().silhouette is None


def test_model_queries_bring_no_rows_to_the_driver():
    """ml_2 and ml_10 collected all eligible reader-weeks as Python rows."""
    import inspect

    from lectern import catalog_checks, catalog_model

    assert ".collect()" not in inspect.getsource(catalog_checks.ml_10) and "matrix(" not in inspect.getsource(catalog_model.ml_2)
