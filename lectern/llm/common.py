"""Helpers that the corpus operators share: staged tables and batch-wise passes over whole texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lectern.session import staged

__all__ = ["per_text", "read", "sliced", "staged"]

#: Rows that a Python pass holds as Python objects at once; a batch is walked in such slices.
SLICE_ROWS = 128


def _release() -> None:
    """Gives freed memory back to the system: workers live on after a pass, and what one keeps another stage's workers lack."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most `rows` rows, so that few texts are Python strings at one time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    _release()


def per_text(df: DataFrame, id_col: str, text_col: str, out: str, make: Callable[[], Callable[[list], list]], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: the id, columns to keep, then the fields of `out` (a DDL list) that the function from make() returns for each text.

    make() runs once in each task; its function gets a list of texts (None for null) and returns a list of tuples.
    Only the named columns are read, so other columns of df, whatever their names, have no effect.
    """
    kept = [id_col, *keep]
    narrow = df.select(*(F.col(c).alias(f"_k{n}") for n, c in enumerate(kept)), F.col(text_col).alias("_text"))
    fields = list(to_arrow_schema(StructType.fromDDL(out)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for part in sliced(batches):
            rows = work(part.column(len(kept)).to_pylist())
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *(pa.array(c, type=t.type) for c, t in zip(columns, fields, strict=True))], names=[*(f"_k{n}" for n in range(len(kept))), *(t.name for t in fields)])

    schema = StructType([*narrow.schema.fields[: len(kept)], *StructType.fromDDL(out).fields])
    return narrow.mapInArrow(run, schema).select(*(F.col(f"_k{n}").alias(c) for n, c in enumerate(kept)), *(t.name for t in fields))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
