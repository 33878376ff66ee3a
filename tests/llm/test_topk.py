"""The index against all inner products, with ties, repeats and vectors that take no part."""

import math

import numpy as np
import pytest

from lectern.llm import topk
from lectern.llm.queries import SQL


def brute(rows, k, every):
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in clean:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in clean if j != i)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)}
    return out


@pytest.mark.parametrize("spread", [0.05, 0.3])
def test_index_is_exact(spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 16)) * 0.3
    vectors = np.floor(256 * (centres[rng.integers(0, 6, 900)] + rng.normal(size=(900, 16)) * spread))
    vectors[100:140] = vectors[7]
    ids = rng.permutation(900)
    index = topk.Index(ids, vectors)
    for row in range(0, 900, 29):
        got, scores = index.best(vectors[row], 5, ids[row])
        every = sorted((-int(v @ vectors[row]), int(i)) for i, v in zip(ids, vectors, strict=True) if i != ids[row])[:5]
        assert list(zip((-scores).tolist(), got.tolist(), strict=True)) == every
    assert topk.Index(ids[:3], vectors[:3]).best(np.zeros(16), 5, None)[0].tolist() == sorted(ids[:3].tolist())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_few_rows_are_rescored(sf):
    import pyarrow.parquet as pq

    table = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], [math.floor(256 * x) for x in r["embedding"]]) for r in table if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    index = topk.Index(ids, vectors)
    for i, v in zip(ids, vectors, strict=True):
        if i % 50 == 0:
            before = index.rescored
            got, scores = index.best(v, 5, i)
            assert index.rescored - before < 0.1 * len(ids)
            every = (index.vectors @ v).astype(np.int64)
            others = index.ids != i
            order = np.lexsort((index.ids[others], -every[others]))[:5]
            assert got.tolist() == index.ids[others][order].tolist() and scores.tolist() == every[others][order].tolist()
    assert index.asked and index.rescored / index.asked < 0.06 * len(ids)
    assert topk.Index(np.array([], dtype=int), np.zeros((0, 4))).best(np.ones(4), 5, None)[0].tolist() == []


def test_search_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8).tolist(), 1) for k in range(300)]
    rows += [(1000, None, 1), (1001, [None] * 8, 1), (1002, [math.nan] * 8, 1), (1003, [math.inf] * 8, 1), (None, [1.0] * 8, 1), (50, [0.0] * 8, 1)]
    rows += [(400 + k, [0.5] * 8, 1) for k in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    for blocks in ((10_000, 10_000), (60, 3)):
        got = {tuple(r) for r in topk.search(df, row_block=blocks[0], query_block=blocks[1]).collect()}
        want = brute([r[:2] for r in rows if r[0] != 50], 5, 50)
        assert {r for r in got if r[0] != 50} == {r for r in brute([r[:2] for r in rows], 5, 50) if r[0] != 50} and want
    assert topk.search(df.limit(0)).count() == 0


def test_sql_is_registered():
    assert "op7_topk" in SQL


def test_bounds_of_large_and_odd_values():
    """Integers beyond single precision, repeated rows, few rows and one live component; and the walk stays within a time a posting."""
    import time

    rng = np.random.default_rng(9)
    for scale in (1, 2**15):
        vectors = np.floor(rng.normal(size=(700, 8)) * 256 * scale)
        vectors[50:90], vectors[200, 1:] = vectors[3], 0
        index = topk.Index(np.arange(700), vectors)
        for row in range(0, 700, 25):
            got, scores = index.best(vectors[row], 5, row)
            every = sorted((-int(v @ vectors[row]), i) for i, v in enumerate(vectors) if i != row)[:5]
            assert list(zip((-scores).tolist(), got.tolist(), strict=True)) == every
    vectors = np.floor(256 * rng.normal(size=(8192, 64)) / 8)
    index = topk.Index(np.arange(8192), vectors)
    began = time.process_time()
    for row in range(100):
        index.best(vectors[row], 5, row)
    walked, began = time.process_time() - began, time.process_time()
    for row in range(100):
        np.bincount(np.tile(np.arange(8192), 64), weights=vectors.ravel() * row)
    assert walked < 2 * (time.process_time() - began)
