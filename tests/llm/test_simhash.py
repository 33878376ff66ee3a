"""Fingerprints, links and components against brute force."""

import random
import re

import pytest
import xxhash

from lectern.llm import simhash
from lectern.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if root[i] != root[j] and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    return root


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a B", "a b C", "É é x y", "x " * 5000, "a\x1cb c\x85d e f g", "日本 語 z A"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_fingerprint(text)


def test_tables_cover_the_radius():
    masks = simhash.table_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(i + 1):
            assert any(not m & (1 << i | 1 << j) for m in masks)


def test_components(spark):
    rnd = random.Random(2)
    chain = [(k, k + 1) for k in range(40)] + [(100 + k, 100) for k in range(1, 30)] + [(200, 200), (None, 5)]
    loose = [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    edges = chain + loose
    nodes = {n for e in edges for n in e if n is not None}
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in nodes} == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_in_small_and_large_buckets(spark, monkeypatch):
    rnd = random.Random(4)
    prints = {}
    for base in range(6):
        x = rnd.getrandbits(64)
        for _ in range(40):
            prints[len(prints)] = x
            x ^= 1 << rnd.randrange(64)
            x ^= rnd.choice([0, 1 << rnd.randrange(64)]) if base % 2 else 0
    want = brute_components(prints)
    classes = spark.createDataFrame([(signed(x),) for x in set(prints.values())], "fp long")
    for small in (2, 1000):
        monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
        got = {r.node: r.root for r in components(simhash.links(classes)).collect()}
        of = {i: got.get(signed(x), signed(x)) for i, x in prints.items()}
        assert {(of[i] == of[j]) == (want[i] == want[j]) for i in prints for j in prints} == {True}


def test_groups_and_keep_one(spark):
    body = " ".join(f"w{k}" for k in range(300))
    rows = [(5, body, 1), (3, body, 1), (9, body + " tail", 2), (1, "quite another text here", 3), (7, None, 0), (8, "", 0), (8, "", 0), (None, "one more, unlike", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.groups(df).collect()]
    assert sorted((i or -1, f) for i, f, _ in got) == sorted((i or -1, brute_fingerprint(t)) for i, t, _ in rows)
    ids = {i: c for i, _, c in got}
    assert (ids[5], ids[3], ids[1], ids[7], ids[8], ids[None]) == (3, 3, 1, 7, 7, None)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted({c for c in ids.values() if c} | {-1})
    assert simhash.groups(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(2, "solo text", 0), (2, "solo text", 0)], "doc_id long, text string, fp int")
    assert simhash.keep_one(twice).count() == 1


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    want = brute_components(prints)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.groups(docs).collect()}
    assert got == {i: (prints[i], want[i]) for i in prints}
