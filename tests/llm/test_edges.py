"""Every operator and stage on nulls in all columns, empty tables, repeated rows and columns with clashing names."""

import pytest

import corpus_pipeline
from lectern.llm import bpe, chat, langid, licenses, mixing, pii, simhash, tiff, topk, unigram
from lectern.llm.queries import tokenizer_path

BPE, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
CLASH = "fp int, component_id string, lang_pred int, score string, labels int, spans int, _id int, _text int, topic int, selected string, n_tokens string, row int, factor string"
FIELD = pii.train(pii.training_rows(40), steps=5)
OPERATORS = {
    "simhash": simhash.groups,
    "langid": langid.identify,
    "licenses": licenses.scan,
    "pii": lambda df: pii.detect(df, field=FIELD),
    "tiff": tiff.text_media,
    "bpe": lambda df: bpe.round_trip(df, BPE),
    "unigram": lambda df: unigram.token_counts(df, PIECES),
    "mixing": mixing.sample,
}
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
PAD = (None,) * 13


def docs(spark):
    long = "word " * 60_000
    rows = [(1, "the cat sat on the mat today", "en", "a", 28), (1, "the cat sat on the mat today", "en", "a", 28), (2, None, None, None, None), (None, None, None, None, None), (None, "ein hund und eine katze", "de", None, 5), (3, "", "de", "a", 0), (4, long, None, "b", len(long)), (5, "12 ²", "en", "b", 4)]
    return spark.createDataFrame([(*r, *PAD) for r in rows], SCHEMA)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operator(spark, name):
    df = docs(spark)
    out = OPERATORS[name](df)
    assert out.columns[0] == "doc_id" and out.count() == df.count()
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted(r.doc_id or 0 for r in df.collect())
    empty = OPERATORS[name](df.limit(0))
    assert empty.count() == 0 and empty.columns == out.columns
    nulls = spark.createDataFrame([(None,) * 18] * 3, SCHEMA)
    assert OPERATORS[name](nulls).count() == 3


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage(spark, sf_dir, name, stage, tmp_path):
    for n, df in enumerate((docs(spark), docs(spark).limit(0), spark.createDataFrame([(None,) * 18] * 2, SCHEMA))):
        df.write.parquet(str(tmp_path / f"in{n}"))
        stage(spark, spark.read.parquet(str(tmp_path / f"in{n}")), sf_dir).write.parquet(str(tmp_path / f"out{n}"))
        out = spark.read.parquet(str(tmp_path / f"out{n}"))
        assert out.count() <= df.count() and (name == "tokens" or out.dtypes == df.dtypes)


def test_chat_and_search(spark):
    empty = spark.createDataFrame([(None,) * 4] * 2, "conv_id long, turn long, role string, text string")
    assert [(r.n_turns, r.intact) for r in chat.digest(chat.format_chats(empty)).collect()] == [(2, True)]
    assert topk.search(spark.createDataFrame([(None, None), (1, None)], "vec_id long, embedding array<float>")).count() == 0
    one = spark.createDataFrame([(50, [0.5, 1.0])], "vec_id long, embedding array<float>")
    assert topk.search(one).count() == 0
