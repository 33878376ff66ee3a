"""The stages one by one against what brute force says of their own input."""

import numpy as np
import pytest
from test_pii import brute as personal
from test_resemblance import brute_roots
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm import langid, mixing
from lectern.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.limit(1).selectExpr("doc_id + 900000 AS doc_id", "'12345 !!' AS text", "lang", "source", "9L AS n_chars"))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [{r.doc_id: r for r in d.collect()} for d in out], out


def test_columns(kept):
    _, frames = kept
    for frame in frames[1:-1]:
        assert frame.dtypes == frames[0].dtypes
    assert frames[-1].columns == ["doc_id", "source", "lang", "n_tokens", "token_ids"]


def test_language_keeps_clean_documents(kept):
    docs, language, *_ = kept[0]
    assert set(docs) - set(language) == {i for i in docs if i >= 900000}


def test_one_of_each_group_stays(kept):
    _, before, after, *_ = kept[0]
    groups = brute_components({i: brute_fingerprint(r.text) for i, r in before.items()})
    alike = brute_roots({i: before[i].text for i in set(groups.values())}, corpus_pipeline.SIMILARITY)
    assert set(after) == set(alike.values())


def test_base_spans_are_gone(kept):
    _, _, before, after, *_ = kept[0]
    assert set(before) == set(after)
    for i, r in before.items():
        spans = personal(r.text)
        assert (after[i].text == r.text) or len(after[i].text) == after[i].n_chars
        assert not any(r.text[a:b] in after[i].text for k, a, b in spans if k in ("email", "ip"))
        if not any(c in "0123456789@" for c in r.text):
            assert after[i].text == r.text


def test_mix_draws_by_probability(kept):
    _, _, _, before, after, _ = kept[0]
    drawn = {r.doc_id for r in mixing.sample(kept[1][3], rate=corpus_pipeline.MIX_RATE).collect() if r.selected}
    assert set(after) == drawn and all(after[i] == before[i] for i in after)


def test_tokens(kept):
    *_, before, after = kept[0]
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert set(before) == set(after)
    for i, r in after.items():
        assert np.array_equal(r.token_ids, library.encode(before[i].text, add_special_tokens=False).ids) and r.n_tokens == len(r.token_ids)


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and langid.UNDETERMINED not in {r.lang for r in out.select("lang").distinct().collect()}
