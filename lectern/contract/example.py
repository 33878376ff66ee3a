"""A worked case set for the oracle runner: a delivery that is in order, and variants that each break one thing.

The variants are made from the baseline when they are asked for, so each differs from it in the declared files alone. The
directory has to be one that both Spark and the driver can list.
"""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.contract import manifest as mf
from lectern.contract import oracle

BASELINE = "baseline"


def _changed(table: str, change: Callable[[DataFrame], DataFrame]) -> Callable[[dict[str, DataFrame], str], None]:
    def write(tables: dict[str, DataFrame], directory: str) -> None:
        change(tables[table]).coalesce(1).write.mode("overwrite").parquet(f"{directory}/{table}.parquet")

    return write


def _without_population(tables: dict[str, DataFrame], directory: str) -> None:
    path = os.path.join(directory, mf.FILENAME)
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    del raw["scored_population"]
    # Spark's reader would compare the file with the checksum written beside the old one
    with open(path, "w", encoding="utf-8") as f:
        json.dump(raw, f, indent=2)


#: Name, what is broken, exit code, codes that have to be raised, and the change.
VARIANTS = (
    ("no-population", "the manifest no longer says who is scored, so nothing can be checked", 2, ("manifest_error",), _without_population),
    ("no-zone", "the zone of all instants of reader_event was stripped", 1, ("TIMESTAMP_NOT_TIMEZONE_AWARE",), _changed("reader_event", lambda df: df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")))),
    ("no-content", "the required table of content was taken out of the delivery", 1, ("MISSING_REQUIRED_TABLE",), lambda tables, directory: shutil.rmtree(f"{directory}/content.parquet")),
    ("scrolling", "a column that the contract refuses was added to reader_event", 1, ("FORBIDDEN_COLUMN",), _changed("reader_event", lambda df: df.withColumn("scroll_depth", F.lit(50.0)))),
)


def build(spark: SparkSession, directory: str) -> dict:
    """Writes the baseline, the variants and the case file; returns what the case file says."""
    from lectern.sources import demo
    from lectern.sources.delivery import write_delivery

    tables = {n: df.coalesce(1) for n, df in demo.build(spark).items()}
    os.makedirs(directory, exist_ok=True)
    base = os.path.join(directory, BASELINE)
    write_delivery(tables, demo.manifest(), base)
    cases = []
    for name, what, code, codes, change in VARIANTS:
        own = os.path.join(directory, name)
        shutil.copytree(base, own)
        change(tables, own)
        cases.append({"id": name, "path": name, "expected_exit": code, "required_codes": list(codes), "changed_files": oracle.changed_files(base, own), "mutation": what})
    out = {"baseline": {"path": BASELINE}, "negative_cases": cases}
    with open(os.path.join(directory, oracle.FILENAME), "w", encoding="utf-8") as f:
        json.dump(out, f, indent=2)
    return out
