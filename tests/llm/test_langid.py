"""The kernel against sets of n-grams, the fit against exact kernel ridge regression, and held-out accuracy."""

import zlib

import numpy as np

from lectern.llm import langid


def grams(text, letters):
    c = [letters.index(x) + 1 if x in letters else 0 for x in text.lower()]
    return {tuple(c[k : k + n]) for n in (1, 2, 3) for k in range(len(c) - n + 1)}


def kernel(a, b, letters):
    x, y = grams(a, letters), grams(b, letters)
    return len(x & y) / (len(x) * len(y)) ** 0.5


SAMPLES = [("the cat sat on the mat with them", "en"), ("der hund und die katze sind nicht da", "de"), ("le chat est sur la table avec eux", "fr"), ("they are there then", "en"), ("das ist ein haus über dem fluß", "de"), ("où est la gare dans ce pays", "fr")]


def test_scores_are_kernel_ridge_regression():
    model = langid.fit(SAMPLES, landmarks=len(SAMPLES), penalty=1e-2)
    texts = [t for t, _ in SAMPLES]
    k = np.array([[kernel(a, b, model.letters) for b in texts] for a in texts])
    y = np.array([[1.0 if lang == own else -1.0 for lang in model.languages] for _, own in SAMPLES])
    n = len(texts)
    centre = np.eye(n) - 1 / n
    alpha = np.linalg.solve(centre @ k @ centre + 1e-2 * n * np.eye(n), y - y.mean(0))
    test = [*texts, "the haus est", "q", "x" * 500, "日本語 text"]
    kt = np.array([[kernel(a, b, model.letters) for b in texts] for a in test])
    want = (kt - k.mean(0)) @ centre @ alpha + y.mean(0)
    got = model.scores(test, langid.Presence(model.letters))
    assert np.allclose(got, want, atol=2e-3)


def test_more_than_64_languages_and_scripts_of_many_letters():
    import random

    rnd = random.Random(4)
    scripts = [(97, 123), (0x3B1, 0x3C9), (0x430, 0x44F), (0x5D0, 0x5EA), (0x628, 0x648), (0x905, 0x939), (0xAC00, 0xAE00), (0x4E00, 0x4F00)]
    own = []
    for k in range(72):
        a, b = scripts[k % len(scripts)]
        own.append([chr(rnd.randrange(a, b)) + chr(rnd.randrange(a, b)) + chr(rnd.randrange(a, b)) for _ in range(12)])
    text = lambda k: " ".join(rnd.choice(own[k]) for _ in range(30))
    samples = [(text(k), f"l{k:02}") for k in range(72) for _ in range(8)]
    model = langid.fit(samples)
    assert len(model.languages) == 72 and len(model.letters) == langid.LETTERS
    for a, b in scripts[:6]:
        assert sum(a <= ord(c) < b for c in model.letters) > 15
    found = model.predict([text(k) for k in range(72)], langid.Presence(model.letters))
    assert sum(lang == f"l{k:02}" for k, (lang, _) in enumerate(found)) > 0.9 * 72


def test_over_64_labels_in_a_table(spark):
    rows = [(k, "some words that are long enough " + "abcdefghij"[k % 10] * 5, f"l{k % 70}") for k in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = langid.training_sample(df, "doc_id", "text", "lang")
    assert len({lang for _, lang in samples}) == 70 and len(samples) <= langid.SAMPLE
    assert langid.identify(df).count() == 700


def test_undetermined_and_empty():
    model = langid.fit(SAMPLES)
    presence = langid.Presence(model.letters)
    assert [p[0] for p in model.predict([None, "", "12 ²½ !!", "٣"], presence)] == ["und"] * 4
    assert all(0 <= s <= 1 for _, s in model.predict(["the", "日本"], presence))
    assert langid.fit([]).predict(["abc", None], langid.Presence("")) == [("und", 0.0)] * 2


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.identify(docs).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    tested = [r for r in rows if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in tested) / len(tested) > 0.95


def test_odd_rows(spark):
    rows = [(k, t, lang, "p") for k, (t, lang) in enumerate(SAMPLES * 4)] + [(None, "the mat", None, "p"), (7, None, "en", "p"), (8, "", None, "p"), (8, "", None, "p"), (9, "the " * 50_000, None, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = langid.identify(df).collect()
    assert len(got) == len(rows) and sum(r.lang_pred == "und" for r in got) == 3
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    kept = langid.keep_identified(df, langid.train(df), least_score=0.0)
    assert kept.schema == df.schema and kept.count() == len(rows) - 3
    assert [r.lang for r in kept.where("text like 'the the%'").collect()] == ["en"]
    assert langid.identify(df.limit(0)).count() == 0


def test_unlearned_texts_are_rejected(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = ["Это обычный текст на русском языке.", "日本語の文章です。これは試験です。", "Αυτό είναι ένα κείμενο.", "xqzv kjwq pzxx vbnm qwrtp zzkq jjxv", "#### 12345 x !! 6789 ()", "12345 !! a", "Đây là một văn bản tiếng Việt."]
    clean = ["A.", "Re.", "Éaux."]
    planted = spark.createDataFrame([(10_000_000 + k, t) for k, t in enumerate(odd + clean)], "doc_id long, text string").selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "'s' AS source", "CAST(length(text) AS bigint) AS n_chars")
    both = docs.unionByName(planted)
    kept = {r.doc_id for r in langid.keep_identified(both, langid.train(both)).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} | {10_000_000 + len(odd) + k for k in range(len(clean))}
