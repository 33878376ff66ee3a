"""Links of resembling texts against all pairs by brute force."""

import random
import re

import pytest

from lectern.llm import resemblance, simhash


def brute_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[k : k + 5]) for k in range(len(words) - 4)} or ({" ".join(words)} if words else set())


def brute_roots(texts, similarity=0.8):
    """The least id that links of at least the similarity reach, for each id."""
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(texts):
        for b in texts:
            if a < b and sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) >= similarity * max(len(sets[a]), len(sets[b])) - 1:
                common = len(sets[a] & sets[b])
                if common / (len(sets[a]) + len(sets[b]) - common) >= similarity and up(a) != up(b):
                    x, y = sorted((up(a), up(b)))
                    root[y] = x
    return {i: up(i) for i in texts}


def found_roots(spark, texts, rows=None):
    df = spark.createDataFrame(rows or list(texts.items()), "doc_id long, text string")
    got = {r.node: r.root for r in resemblance.resembling(df, df.selectExpr("doc_id AS id").distinct(), 0.8).collect()}
    return {i: got.get(i, i) for i in texts}


def edited(words, rnd, edits):
    out = list(words)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"e{rnd.randrange(10**9)}"
    return " ".join(out)


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B c d", "a b C d e", "x " * 9000, "É é x y z 日本 w"])
def test_shingles(text):
    assert len(resemblance.shingle_set(text)) == len(brute_shingles(text))


def test_small_groups_at_the_threshold(spark):
    rnd, texts = random.Random(1), {}
    for group in range(60):
        words = [f"g{group}w{k}" for k in range(rnd.randrange(30, 200))]
        for _ in range(rnd.randrange(1, 6)):
            texts[len(texts)] = edited(words, rnd, rnd.randrange(0, 1 + len(words) // 30))
    want = brute_roots(texts)
    assert len(set(want.values())) < len(texts)
    assert found_roots(spark, texts) == want


def test_large_group_and_common_passage(spark, monkeypatch):
    """300 near copies of one text; 300 unlike texts that share half their words, some of them with near copies."""
    monkeypatch.setattr(resemblance, "PART", 32)
    rnd, texts = random.Random(3), {}
    base, passage = [f"b{k}" for k in range(150)], [f"p{k}" for k in range(60)]
    for _ in range(300):
        texts[len(texts)] = edited(base, rnd, rnd.randrange(0, 2))
    for k in range(300):
        words = passage + [f"q{k}x{j}" for j in range(60)]
        texts[len(texts)] = " ".join(words)
        if k % 10 == 0:
            texts[len(texts)] = edited(words, rnd, 1)
    want, got = brute_roots(texts), found_roots(spark, texts)
    assert len(set(want.values())) == 301 and got == want


def test_odd_rows(spark):
    body = " ".join(f"w{k}" for k in range(100))
    rows = [(4, body), (2, body + " x"), (2, body + " x"), (None, body), (7, None), (8, ""), (9, "two words"), (10, "Two  WORDS"), (11, "two words more")]
    texts = {i: t for i, t in rows if i is not None}
    assert found_roots(spark, texts, rows) == {4: 2, 2: 2, 7: 7, 8: 8, 9: 9, 10: 9, 11: 11}
    none = spark.createDataFrame([], "doc_id long, text string, key long, id long, low string")
    assert resemblance.resembling(none, none.select("id"), 0.8).count() == 0


def test_keep_one_drops_near_copies(spark):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(120)]
    rows = [(3, " ".join(words), 1, 2), (6, edited(words, rnd, 2), 3, 4), (5, "quite another text", 5, 6), (None, " ".join(words), 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, id int")
    kept = simhash.keep_one(df, similarity=0.8)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 5]


def test_pairs_that_bands_and_parts_miss(spark, monkeypatch):
    """Without any candidate of the bands, the prefixes still find every pair, and whatever shingles they put last."""
    rnd, texts = random.Random(7), {}
    passage = [f"p{k}" for k in range(40)]
    for group in range(40):
        words = passage * (group % 2) + [f"g{group}w{k}" for k in range(rnd.randrange(1, 90))]
        for _ in range(rnd.randrange(1, 5)):
            texts[len(texts)] = edited(words, rnd, rnd.randrange(0, 1 + len(words) // 25))
    for k in range(30):
        texts[len(texts)] = " ".join(passage + [f"t{k}"] * (k % 7))
    want = brute_roots(texts)
    monkeypatch.setattr(resemblance, "candidates", lambda sketches, similarity: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(resemblance, "PART", 8)
    for common in (2, 30, 10**6):
        monkeypatch.setattr(resemblance, "COMMON", common)
        assert found_roots(spark, texts) == want
    assert len(set(want.values())) < len(texts) - 40


def test_links_of_texts_that_fingerprints_group(spark, monkeypatch):
    """Text 2 shares a fingerprint group with 1, which resembles nothing, and resembles 3."""
    words = [f"w{k}" for k in range(100)]
    rows = [(1, "quite another text altogether it is"), (2, " ".join(words)), (3, " ".join(words[:-2] + ["x"])), (4, "and one more that is alone")]
    monkeypatch.setattr(simhash, "fingerprint", lambda text: {"q": 0, "a": 2**40 - 1}.get(text[0], 1 if text.endswith("w99") else 2**20 - 1))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "fingerprints", lambda df, *cols: spark.createDataFrame([(i, simhash.fingerprint(t)) for i, t in rows], "doc_id long, fp long"))
    assert sorted(r.doc_id for r in simhash.keep_one(df, similarity=0.8).collect()) == [1, 4]


def test_parity_tells_long_texts_apart(spark):
    """Pairs of long texts that are far below the threshold are left out before any text is moved; those at it never are."""
    words = [f"w{k}" for k in range(5000)]
    like, unlike = words[:4450] + [f"x{k}" for k in range(400)], words[:3800] + [f"y{k}" for k in range(1200)]
    longer, shorter = words[:4000], words[:3250]
    texts = {1: words, 2: like, 3: unlike, 4: longer, 5: shorter}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "id long, text string")
    assert len(resemblance.parity(resemblance.shingle_set(" ".join(longer)))) < len(resemblance.parity(resemblance.shingle_set(" ".join(words))))
    roots = spark.createDataFrame([], "node long, root long")
    pairs = {(r.a, r.b) for r in resemblance.unjoined(df, df.select("id"), roots, 0.8).collect()}
    sets = {i: brute_shingles(" ".join(w)) for i, w in texts.items()}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert {(1, 2), (4, 5)} <= want <= pairs and (1, 3) not in pairs


def test_whole_sets_decide_at_the_threshold(spark):
    """8 of 10 shingles are a link, 7 of 10 are none; a text without words, or with an id twice, does no harm."""
    words = [f"w{k}" for k in range(14)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:12])), (3, " ".join(words[:-3])), (4, None), (4, ""), (5, "one"), (6, " ".join(words))]
    df = spark.createDataFrame(rows, "id long, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (4, 5), (1, 6), (1, 4)], "a long, b long")
    assert {(r.a, r.b) for r in resemblance._alike(df, pairs, 0.8).collect()} == {(1, 2), (2, 3), (1, 6)}


def joined_rows(spark, action):
    """The most rows that a join made in what action() runs."""
    store, done = spark._jsparkSession.sharedState().statusStore(), set()
    each = lambda seq: (seq.apply(k) for k in range(seq.size()))
    done = {e.executionId() for e in each(store.executionsList())}
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    most = 0
    for execution in [e.executionId() for e in each(store.executionsList()) if e.executionId() not in done]:
        values = store.executionMetrics(execution)
        for node in each(store.planGraph(execution).allNodes()):
            for metric in each(node.metrics()) if "Join" in node.name() else ():
                if metric.name() == "number of output rows" and (v := values.get(metric.accumulatorId())).isDefined():
                    most = max(most, int(v.get().replace(",", "")))
    return most


def test_pairs_of_a_common_passage_and_of_much_edited_copies_are_not_made(spark):
    """Texts that share a passage beside 14 to 18 own words, and copies of a text with up to 8 edits: a little below the threshold, or joined by others."""
    rnd, texts = random.Random(11), {}
    passage, other, base = ([f"{c}{k}" for k in range(n)] for c, n in (("p", 100), ("o", 100), ("b", 150)))
    for k in range(300):
        texts[len(texts)] = " ".join(passage + [f"q{k}x{j}" for j in range(14 + k % 5)])
        texts[len(texts)] = edited(base, rnd, k % 9)
    for k in range(100):
        texts[len(texts)] = " ".join(other + [f"r{k}x{j}" for j in range(14 + k % 5 if k != 70 else 7)])
    want, got = brute_roots(texts), []
    assert 400 < len(set(want.values())) < 500
    # a row for each text, band and shingle of a prefix, or less; 300 * 300 / 2 pairs of either kind would be 45,000
    assert joined_rows(spark, lambda: got.append(found_roots(spark, texts))) < 32 * len(texts) < 22_500
    assert got == [want]
