"""Deliveries: a directory with a Parquet table for each input, and a manifest."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.contract import manifest as mf
from lectern.contract import schema
from lectern.model.settings import resolve_feature_set
from lectern.operators import checks, daily


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its own types, never cast; None if there is none."""
    return spark.read.parquet(path) if exists(spark, path) else None


def read_delivery(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The tables that there are; absent ones are simply not in the result."""
    found = {t.name: read_if_there(spark, f"{directory}/{t.name}.parquet") for t in schema.TABLES}
    return {n: df for n, df in found.items() if df is not None}


def register_views(inputs: dict[str, DataFrame]) -> list[str]:
    """Temporary views input_<table>, for queries in SQL."""
    for name, df in inputs.items():
        df.createOrReplaceTempView(f"input_{name}")
    return [f"input_{n}" for n in inputs]


def write_delivery(tables: dict[str, DataFrame], manifest: mf.Manifest, directory: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{directory}/{name}.parquet")
    with open(f"{directory}/{mf.FILENAME}", "w", encoding="utf-8") as f:
        json.dump(mf.as_dict(manifest), f, indent=2)


def build_delivery(spark: SparkSession, directory: str, out: str | None = None, replaced: dict[str, Callable] | None = None) -> dict:
    """Builds and checks a delivery's daily tables, writes them if asked to, and returns the report."""
    manifest = mf.load(spark, directory)
    inputs = read_delivery(spark, directory)
    c = daily.context(inputs, manifest, replaced)
    found = checks.run_checks(c)
    features = resolve_feature_set(manifest, set(inputs))
    report = {
        "contract_version": manifest.contract_version,
        "timezone": manifest.timezone,
        "article_view": manifest.article_view.definition_id,
        "feature_set": features.id,
        "replaced": sorted(replaced or {}),
        "checks": [{"name": x.name, "passed": x.passed, "offenders": x.offenders} for x in found],
        "tables": {},
    }
    if not replaced:
        checks.require(found)
    tables = daily.outputs(c)
    for name, df in tables.items():
        if out:
            # sorted by key, so that equal builds give equal files
            df.orderBy(*daily.OUTPUTS[name].key).write.mode("overwrite").option("compression", "none").parquet(f"{out}/{name}.parquet")
            df = spark.read.parquet(f"{out}/{name}.parquet")
        report["tables"][name] = df.count()
    if out:
        with open(f"{out}/build-report.json", "w", encoding="utf-8") as f:
            json.dump(report, f, indent=2)
    return report


__all__ = ["build_delivery", "exists", "read_delivery", "read_if_there", "register_views", "write_delivery"]
