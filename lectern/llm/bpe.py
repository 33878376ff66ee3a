"""Byte-level BPE encoding by backtracking over longest token matches, and decoding by an offset table.

A token sequence is the encoding of a word exactly if each two neighbours are what the merges give for their joined
bytes. So the encoder walks a word with the longest token that fits (all matches come from one Aho-Corasick pass) and
checks each neighbour pair against a table of compatible pairs; where a pair doesn't hold it takes the next shorter
prefix token, or steps back. Each position is given up at most once, so the work is linear in the word.

Nulls are encoded as empty texts; an empty text has no tokens. Special tokens in a text get their own ids.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import numpy as np
from pyspark.sql import DataFrame

from lectern.llm.common import per_text

#: Fixed value: the pattern that byte-level tokenizers of this family cut texts with before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept with their ids in each Python worker (as many again from before the last renewal), and the longest of
#: them; others are encoded each time.
CACHED_WORDS, CACHED_LENGTH = 200_000, 48
#: Compatible pairs kept in each worker before the table starts anew.
CACHED_PAIRS = 250_000
#: Largest vocabulary that is sent to the executors.
MAX_VOCABULARY = 1_000_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, to the byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def load(path: str) -> dict:
    """Vocabulary of a tokenizers JSON file with a byte-level BPE model: token bytes by id, merges, special tokens."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    model, symbol = raw["model"], byte_symbols()
    special = {t["content"]: t["id"] for t in raw.get("added_tokens", [])}
    size = 1 + max([*model["vocab"].values(), *special.values()])
    if size > MAX_VOCABULARY:
        raise ValueError(f"{size} tokens are more than the {MAX_VOCABULARY} that may be sent to executors")
    tokens = [b""] * size
    for text, i in model["vocab"].items():
        tokens[i] = text.encode() if text in special else bytes(symbol[c] for c in text)
    for text, i in special.items():
        tokens[i] = text.encode()
    vocab = model["vocab"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {"tokens": tokens, "special": special, "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]}


class _Words(dict):
    """Ids of words already encoded, as little-endian unsigned 32-bit integers; when full, words still in use move on."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = array("I", self.encode(word.encode())).tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, vocabulary: dict) -> None:
        import ahocorasick
        import regex

        self.tokens, self.special = vocabulary["tokens"], vocabulary["special"]
        taken = set(self.special.values())
        self.id_of = {t: i for i, t in enumerate(self.tokens) if i not in taken and t}
        self.merged = {(a, b): (rank, to) for rank, (a, b, to) in enumerate(vocabulary["merges"])}
        self.sizes = [len(t) for t in self.tokens]
        self.reachable: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            if self.own(i):
                self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, i))
        self.automaton.make_automaton()
        self.shorter_of: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = _Words(self.encode_word)
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def merge(self, data: bytes) -> list[int]:
        """The merges themselves, one after another; only for the few bytes of a token or a pair."""
        ids = [self.id_of[data[k : k + 1]] for k in range(len(data))]
        while len(ids) > 1:
            rank, at = min(((self.merged.get(pair, (1 << 60,))[0], k) for k, pair in enumerate(zip(ids, ids[1:], strict=False))), default=(1 << 60, 0))
            if rank == 1 << 60:
                break
            ids[at : at + 2] = [self.merged[ids[at], ids[at + 1]][1]]
        return ids

    def own(self, token: int) -> bool:
        """Whether the merges make this token of its own bytes."""
        if (known := self.reachable.get(token)) is None:
            known = self.reachable[token] = self.merge(self.tokens[token]) == [token]
        return known

    def compatible(self, left: int, right: int) -> bool:
        if (known := self.pairs.get((left, right))) is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        if (known := self.shorter_of.get(token)) is None:
            data = self.tokens[token]
            found = (self.id_of.get(data[:n], -1) for n in range(len(data) - 1, 0, -1))
            known = self.shorter_of[token] = next((t for t in found if t >= 0 and self.own(t)), -1)
        return known

    def encode_word(self, data: bytes) -> list[int]:
        total, sizes, pairs = len(data), self.sizes, self.pairs
        longest = [-1] * (total + 1)
        for end, (back, token) in self.automaton.iter(data.decode("latin-1")):
            longest[end - back] = token  # later ends of one start are longer matches
        token = longest[0]
        if sizes[token] == total:
            return [token]
        ids: list[int] = []
        dead: set[int] = set()
        at = 0
        while at < total:
            while token >= 0:
                end = at + sizes[token]
                if end not in dead:
                    if not ids:
                        break
                    fits = pairs.get((ids[-1], token))
                    if fits or fits is None and self.compatible(ids[-1], token):
                        break
                token = self.shorter(token)
            if token >= 0:
                ids.append(token)
                at, token = end, longest[end]
            else:
                dead.add(at)
                token = ids.pop()
                at -= sizes[token]
                token = self.shorter(token)
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(self.words.__getitem__, self.find(text)))
        out = []
        for part in self.cut(text):
            out += [array("I", [self.special[part]]).tobytes()] if part in self.special else map(self.words.__getitem__, self.find(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of all tokens, gathered from one blob through the table of offsets."""
        at = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        first, size = self.offsets[at], self.offsets[at + 1] - self.offsets[at]
        out = np.cumsum(size)
        if not len(at):
            return b""
        return self.blob[np.arange(out[-1]) + np.repeat(first - (out - size), size)].tobytes().decode("utf-8", "replace").encode()


_codecs: dict[str, Codec] = {}


def codec(key: str, vocabulary: dict) -> Codec:
    """The worker's codec for a vocabulary, built once."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(vocabulary)
    return _codecs[key]


def shared_codec(df: DataFrame, path: str):
    """A function that gives executors the codec: the driver reads the file, its bounded tables are broadcast."""
    sent = df.sparkSession.sparkContext.broadcast(load(path))
    return lambda: codec(path, sent.value)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, columns to keep, n_tokens, token_ids (array<int>), one row per row of df; null and empty texts have no tokens."""
    get = shared_codec(df, path)

    def make():
        c = get()
        return lambda texts: [(len(i) // 4, np.frombuffer(i, dtype="<u4").astype(np.int32)) for i in map(c.encode, texts)]

    return per_text(df, id_col, text_col, "n_tokens bigint, token_ids array<int>", make, keep)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """id and the text of the token ids, one row per row of df; null ids give a null text."""
    get = shared_codec(df, path)

    def make():
        c = get()
        return lambda rows: [(None if ids is None else c.decode(np.array(ids, dtype="<u4").tobytes()).decode(),) for ids in rows]

    return per_text(df, id_col, ids_col, "text string", make)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256, one row per row of df, repeated rows and null ids included."""
    get = shared_codec(df, path)

    def make():
        c = get()

        def work(texts: list) -> list:
            out = []
            for text in texts:
                ids = c.encode(text)
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()))
            return out

        return work

    return per_text(df, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
