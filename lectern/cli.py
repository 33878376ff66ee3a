"""Command line: validate, build, lane, lint-mapping, check-oracle, demo, cohort, gates-template."""

from __future__ import annotations

import argparse
import dataclasses
import json
import os
import sys

from lectern.contract import manifest as mf
from lectern.contract import mapping, oracle, validate
from lectern.model.settings import LaneSettings, SettingsError, load_thresholds, render_thresholds
from lectern.operators import checks, daily
from lectern.plans import buckets, lane
from lectern.session import build_session
from lectern.sources import cohort, demo
from lectern.sources.delivery import build_delivery, read_delivery, write_delivery

OK, FAILED, UNTRUSTED, NO_MODEL, GATED = 0, 1, 2, 3, 4


def _lane(spark, args: argparse.Namespace) -> int:
    m = mf.load(spark, args.delivery)
    gates = load_thresholds(args.gates) if args.gates else None
    settings = LaneSettings(m, buckets.load(args.bucket_map), k_grid=tuple(range(args.k_min, args.k_max + 1)), starts=args.seeds, **({"gates": gates} if gates else {}))
    if args.draws:
        settings = dataclasses.replace(settings, gates=dataclasses.replace(settings.gates, selection_perturbation_draws=args.draws))
    print(settings.describe())
    result = lane.run_lane(spark, lane.daily_tables(read_delivery(spark, args.delivery), m), settings, args.reviewed, args.max_weeks)
    if args.out:
        lane.write_result(result, args.out)
    print(result.summary())
    return NO_MODEL if result.bundle is None else OK if result.decision.publish_labels else GATED


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lectern", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    add = lambda name, *names: [c := sub.add_parser(name), *(c.add_argument(n) for n in names)][0]
    add("validate", "delivery").add_argument("--json", action="store_true")
    b = add("build", "delivery")
    b.add_argument("--out")
    b.add_argument("--json", action="store_true")
    b.add_argument("--explain", action="store_true", help="print the plans and run nothing")
    r = add("lane", "delivery")
    r.add_argument("--bucket-map", required=True)
    for name, default in (("--k-min", 3), ("--k-max", 8), ("--seeds", 20), ("--draws", 0), ("--max-weeks", None)):
        r.add_argument(name, type=int, default=default)
    r.add_argument("--gates")
    r.add_argument("--out")
    r.add_argument("--reviewed", action="store_true")
    m = add("lint-mapping", "path")
    m.add_argument("--adapter-bundle")
    m.add_argument("--warnings-as-errors", action="store_true")
    add("check-oracle", "path").add_argument("--min-negative", type=int, default=oracle.LEAST_CASES)
    add("demo", "out")
    c = add("cohort", "out")
    c.add_argument("--readers", type=int, default=400)
    c.add_argument("--weeks", type=int, default=26)
    add("gates-template")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    if args.command == "gates-template":
        print(render_thresholds())
        return OK
    if args.command == "lint-mapping":
        try:
            found = mapping.lint(mapping.load(args.path), args.adapter_bundle)
        except mapping.MappingError as e:
            print(e, file=sys.stderr)
            return UNTRUSTED
        print(found.render(args.warnings_as_errors))
        return OK if found.passed(args.warnings_as_errors) else FAILED
    spark = spark or build_session("lectern")
    try:
        if args.command == "validate":
            report = validate.validate(spark, args.delivery)
            print(report.to_json() if args.json else report.render())
            return report.exit_code
        if args.command == "build":
            if args.explain:
                c = daily.context(read_delivery(spark, args.delivery), mf.load(spark, args.delivery))
                for df in daily.outputs(c).values():
                    df.explain("formatted")
                return OK
            report = build_delivery(spark, args.delivery, args.out)
            print(json.dumps(report, indent=2) if args.json else "\n".join(f"{n}: {k} rows" for n, k in report["tables"].items()))
            return OK
        if args.command == "lane":
            return _lane(spark, args)
        if args.command == "check-oracle":
            root = args.path if os.path.isdir(args.path) else os.path.dirname(args.path)
            cases = oracle.run(spark, oracle.load(args.path), root, args.min_negative)
            print("\n".join(f"{'PASS' if c.passed else 'FAIL'}  {c.id}  {'; '.join(c.problems)}" for c in cases))
            return OK if all(c.passed for c in cases) else FAILED
        os.makedirs(args.out, exist_ok=True)
        if args.command == "demo":
            write_delivery(demo.build(spark), demo.manifest(), args.out)
        else:
            write_delivery(cohort.build(spark, cohort.Cohort(args.readers, args.weeks)), cohort.manifest(), args.out)
            with open(f"{args.out}/bucket-map.json", "w", encoding="utf-8") as f:
                bm = cohort.bucket_map()
                json.dump({"version": bm.version, "buckets": {k: list(x) for k, x in bm.buckets.items()}, "catch_all_bucket": bm.catch_all}, f, indent=2)
        return OK
    except (mf.ManifestError, buckets.BucketError, SettingsError, oracle.OracleError, daily.BuildError, lane.LaneError) as e:
        print(e, file=sys.stderr)
        return UNTRUSTED
    except checks.ChecksFailed as e:
        print(e, file=sys.stderr)
        return FAILED


if __name__ == "__main__":
    sys.exit(main())
