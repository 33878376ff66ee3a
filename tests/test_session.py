"""Staged tables."""

import time

import pyarrow as pa

from lectern import session


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for name in (files.apply(k).getName() for k in range(files.size())) if name.startswith("shuffle_")}


def test_staged_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(session.CLEANUP)
    spark.conf.set(session.CLEANUP, "false")
    counts = spark.range(1000).selectExpr("id % 700 AS k").groupBy("k").count()
    out = session.staged(counts, "counts")
    assert spark.conf.get(session.CLEANUP) == "false"
    spark.conf.set(session.CLEANUP, setting)
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert out.count() == 700 and counts.count() == 700


def test_batches_for_python_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    session.ship(spark)
    found = [r.size for r in spark.range(0, 9000, 1, 1).selectExpr("repeat('x', 5000) AS text").mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 45_000_000 and max(found) < 2 * session.BATCH_BYTES
