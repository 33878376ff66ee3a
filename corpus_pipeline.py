"""A corpus from raw documents to token ids: each stage is one operator of lectern.llm on all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import bpe, langid, mixing, pii, simhash
from lectern.llm.common import read, staged
from lectern.llm.queries import tokenizer_path
from lectern.session import ship

#: Share of the tokens that the mix keeps; at 0.8 the scarce languages and topics can't be raised to their targets.
MIX_RATE = 0.6
#: Documents whose five-word shingles are alike to this Jaccard coefficient are near copies.
SIMILARITY = 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; a null lang is filled in."""
    ship(spark)
    return langid.keep_identified(docs, langid.train(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the least id, of each group of linked fingerprints and of alike five-word shingles."""
    ship(spark)
    return simhash.keep_one(docs, similarity=SIMILARITY)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found spans replaced by their kind; n_chars follows the text."""
    ship(spark)
    return pii.redact(docs, length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by calibrated probabilities."""
    return mixing.keep_sample(docs, MIX_RATE)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: doc_id, source, lang, n_tokens, token_ids."""
    ship(spark)
    return bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), keep=("source", "lang"))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

#: Trained models, fingerprints and merges can't be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole documents table, each written to the shared folder before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
