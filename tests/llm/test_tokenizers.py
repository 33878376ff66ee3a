"""BPE ids and unigram counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from lectern.llm import bpe, unigram
from lectern.llm.queries import tokenizer_path

ODD = ["a", "b", "the", " ", "  ", "\n", "\t", "\x1c", "é", "日", "😀", "1", "²", "½", "<|endoftext|>", " ", " ", "'s", ".", "!", "\x85", "▁"]


def texts(n=400, seed=3):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice([*ODD, chr(rnd.randrange(0x20, 0x3000))]) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]
    return [*made, "", "a" * 4000, " " * 2000, "ab" * 2000, "the cat " * 500, "<|endoftext|><|endoftext|>"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load(tokenizer_path("byte_bpe_50k.json")))


def test_bpe_equals_library(codec):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    for text in texts():
        ids, want = codec.encode(text), library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert codec.decode(ids).decode() == library.decode(want, skip_special_tokens=False) == text


def test_backtracking_equals_merges_on_any_bytes(codec):
    rnd = random.Random(5)
    for _ in range(300):
        data = bytes(rnd.choice(b"aenthiors \xc3\xa9") for _ in range(rnd.randrange(1, 60)))
        assert codec.encode_word(data) == codec.merge(data)


def test_round_trip_query(spark):
    rows = [(1, "abc <|endoftext|> x", "c"), (1, "abc <|endoftext|> x", "c"), (None, "z", "c"), (3, None, None), (4, "", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.n_tokens, r.decoded_sha256) for r in bpe.round_trip(df, tokenizer_path("byte_bpe_50k.json")).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {(1, 4, sha("abc <|endoftext|> x")), (None, 1, sha("z")), (3, 0, sha("")), (4, 0, sha(""))}
    assert bpe.round_trip(df.limit(0), tokenizer_path("byte_bpe_50k.json")).count() == 0
    ids = {r.doc_id: list(r.token_ids) for r in bpe.encode(df, tokenizer_path("byte_bpe_50k.json")).collect()}
    assert ids[1][2] == 50256 and ids[3] == []
    path = tokenizer_path("byte_bpe_50k.json")
    back = bpe.decode(bpe.encode(df, path, keep=("n_tokens",)).toDF("doc_id", "kept", "n", "token_ids"), path)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(i, t or "") for i, t, _ in rows}


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_equals_library(fallback):
    pieces = unigram.load(tokenizer_path("piece_bpe_32k.model"))
    if not fallback:
        pieces = [(p, s) for p, s in pieces if not (p.startswith("<0x") and p.endswith(">"))]
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    counter = unigram.Counter(pieces)
    for text in texts(seed=4):
        assert counter.count(text)[1] == len(library.encode(text, add_special_tokens=False).ids), text


def test_unigram_ties_go_to_the_earlier_start():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("c", -1.0), ("ab", -2.0), ("bc", -2.0), ("abc", -3.0), ("▁abc", -4.0)]
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    for text in ["abc", "abcabc", "bcab abc", "xabcx  x", "cab"]:
        assert unigram.Counter(pieces).count(text)[1] == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_query(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (None, " a")], "doc_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_tokens) for r in unigram.token_counts(df, tokenizer_path("piece_bpe_32k.model")).collect()}
    assert rows == {1: (2, 2), 2: (0, 0), 3: (0, 0), None: (1, 1)}
