"""Spark session with the settings that the engine relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "lectern", master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster, master and partitions come from the submit settings."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return session


def require_utc(spark: SparkSession) -> None:
    """Local days are computed from the session zone, so it has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; the engine computes local days from a UTC session")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir). Where it is unset, a local master, which is one machine,
    gets a temporary one; any other master has to name one, as its executors don't see each other's disks."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"spark.checkpoint.dir is unset; with the master {spark.sparkContext.master} it has to name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder of this application below the shared one."""
    return f"{shared_dir(spark)}/lectern/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


#: The setting by which Spark removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: what several plans use is computed once, and a lost executor costs nothing.

    The shuffle files of the write are removed when it ends, as nothing reads them again; otherwise they stay until the
    driver's garbage collector finds them.
    """
    spark, path = df.sparkSession, f"{scratch_dir(df.sparkSession)}-{name}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of rows that Spark and a Python worker exchange at once; by default 64 MiB, held several times on both sides.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, so that their Python workers can import it wherever the driver was started, and sets the size of the batches they get."""
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = f"{tempfile.mkdtemp(prefix='lectern-')}/lectern-{app}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.join("lectern", os.path.relpath(file, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
