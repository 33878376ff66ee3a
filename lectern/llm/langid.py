"""Language identification with a string kernel, Nystroem landmarks and one-versus-rest kernel ridge regression.

The kernel of two texts is the number of distinct character n-grams (n from 1 to 3) that both have, divided by the
geometric mean of the numbers each has. Letters are the 223 that have the largest share in any one language's training
texts, so each language and script brings its own; if there are more, all other letters share 32 classes by code point,
and all other characters share one class. The landmarks are training
texts; a text's scores are its kernel values against them times one matrix, for whole batches at once: presence rows
times landmark rows, scaled, times the ridge weights.

The model is fitted on a bounded sample of labelled rows: for each language at most `per_language` texts (fewer, down to
8, where there are over 64 languages, so that there are about as many in all) of 20 to `max_chars` characters, the ones
with the least hash in as many hash classes; about 150 MB of text at most. Prediction reads whole texts.

The scores say which language, not whether any: they sum to a constant, so some language always has a fair one. Whether
a text is in a learned language at all is told by its words' letter triples: the share that the language's training
texts have, against the share that these texts reach when one half of them is judged by the other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import per_text, sliced, staged

#: Letters with a class of their own at most, classes of further letters, and lengths of the n-grams.
LETTERS, FURTHER, ORDERS = 223, 32, (1, 2, 3)
#: Bounds of the training sample: texts for each language, characters of a text, texts in all, and texts a language at least.
PER_LANGUAGE, MAX_CHARS, SAMPLE, LEAST_EACH = 300, 8000, 19_200, 8
#: Landmarks in all, and the ridge penalty.
LANDMARKS, PENALTY = 128, 1e-3
#: A text is rejected if its language is undetermined, or if in each language the known share of its letter triples is
#: under this part of the usual one: what all but a hundredth of the language's training texts reach, 0.5 at least.
LEAST_SCORE, LEAST_USUAL = 0.6, 0.5
UNDETERMINED = "und"


def held_out(id_col: str) -> F.Column:
    """Whether crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Presence:
    """Which n-grams texts have, by a reused table with one place for each possible n-gram."""

    def __init__(self, letters: str) -> None:
        further = FURTHER if len(letters) >= LETTERS else 0
        self.classes = 1 + len(letters) + further
        self.table = np.zeros(0x110000, dtype=np.uint8)
        if further:
            other = np.flatnonzero(kinds() == 1)
            self.table[other] = 1 + len(letters) + other % further
        for k, c in enumerate(letters):
            self.table[ord(c)] = k + 1
        #: Where the n-grams of each order start.
        self.starts = [sum(self.classes**m for m in ORDERS if m < n) for n in ORDERS]
        self.marks = np.zeros(sum(self.classes**n for n in ORDERS), dtype=bool)
        self.last: list[np.ndarray] = []

    def mark(self, text: str) -> np.ndarray:
        """The table for one text; valid until the next call."""
        for places in self.last:
            self.marks[places] = False
        c = self.table[np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)].astype(np.int32)
        self.last, grams = [], c
        for n, start in zip(ORDERS, self.starts, strict=True):
            if n > 1:
                grams = grams[:-1] * self.classes + c[n - 1 :]
            self.last.append(start + grams)
            self.marks[self.last[-1]] = True
        return self.marks


@cache
def kinds() -> np.ndarray:
    """Of each character: 0 space, 1 letter or mark, 2 number, 3 other."""
    import unicodedata

    of = {"L": 1, "M": 1, "N": 2, "Z": 0}
    out = np.array([of.get(unicodedata.category(chr(c))[0], 3) for c in range(0x110000)], dtype=np.uint8)
    out[[9, 10, 11, 12, 13, 28, 29, 30, 31, 0x85]] = 0
    return out


def triples(text: str) -> tuple[np.ndarray, int]:
    """Each letter with its neighbours in the word, as one number, and how many other things the text has.

    Words with a number in them and runs of two or more signs are other things; single signs are nothing.
    """
    c = np.frombuffer(f"  {text.lower()}  ".encode("utf-32-le", "replace"), dtype=np.uint32)
    kind = kinds()[c]
    inside = (kind == 1) | (kind == 2)
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1, np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    numbers = np.concatenate([[0], np.cumsum(kind == 2)])
    mixed = numbers[ends] > numbers[starts]
    turns = np.zeros(len(c) + 1, dtype=np.int32)
    turns[starts[mixed]] += 1
    turns[ends[mixed]] -= 1
    letter = (kind == 1) & (np.cumsum(turns)[:-1] == 0)
    x, at = np.where(letter, c, 32).astype(np.int64), np.flatnonzero(letter)
    sign = kind == 3
    runs = np.count_nonzero(sign[1:-1] & sign[2:] & ~sign[:-2])
    return x[at - 1] << 42 | x[at] << 21 | x[at + 1], int(np.count_nonzero(mixed) + runs)


@dataclass
class Familiar:
    """The letter triples that training texts have, sorted, whether each language has them, and the usual known share by language."""

    found: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    has: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=bool))
    usual: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def shares(self, text: str) -> np.ndarray:
        """The known share of the text's triples and other things, in each language."""
        own, others = triples(text)
        if not len(own) or not len(self.found):
            return np.zeros(self.has.shape[1])
        at = np.minimum(np.searchsorted(self.found, own), len(self.found) - 1)
        places, times = np.unique(at[self.found[at] == own], return_counts=True)
        return times @ self.has[places] / (len(own) + others)

    def score(self, text: str) -> float:
        """The known share as a part of the usual one, in the language where that is most."""
        return float((self.shares(text) / self.usual).max(initial=0.0))


def familiar(samples: list[tuple[str, str]], languages: list[str]) -> Familiar:
    """What the samples make familiar; the usual shares are measured on each half of a language's samples by the other half."""

    def table(parts: list[list[str]]) -> Familiar:
        own = [np.unique(np.concatenate([triples(t)[0] for t in texts])) if texts else np.zeros(0, dtype=np.int64) for texts in parts]
        found = np.unique(np.concatenate(own))
        return Familiar(found, np.stack([np.isin(found, x) for x in own], axis=1))

    of = [[t for t, own in samples if own == lang] for lang in languages]
    halves = table([texts[::2] for texts in of]), table([texts[1::2] for texts in of])
    judged = [[halves[1 - k % 2].shares(t)[n] for k, t in enumerate(texts)] for n, texts in enumerate(of)]
    out = table(of)
    out.usual = np.array([max(LEAST_USUAL, np.quantile(x, 0.01)) for x in judged])
    return out


@dataclass
class Model:
    """languages: learned values; rows: landmarks by n-grams they have, scaled; columns: those n-grams; weights: landmarks by languages."""

    languages: list[str]
    letters: str
    columns: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    familiar: Familiar = field(default_factory=Familiar)

    def scores(self, texts: list[str], presence: Presence) -> np.ndarray:
        have = np.zeros((len(texts), len(self.columns)), dtype=np.float32)
        size = np.ones(len(texts), dtype=np.float32)
        for k, text in enumerate(texts):
            marks = presence.mark(text)
            have[k] = marks[self.columns]
            size[k] = max(1, np.count_nonzero(marks))
        kernel = (have @ self.rows.T) / np.sqrt(size)[:, None]
        return kernel @ self.weights + self.bias

    def predict(self, texts: list[str | None], presence: Presence) -> list[tuple[str, float]]:
        """(language, score) of each text; undetermined and 0 for null, for texts without a letter, and if nothing was learned."""
        import regex

        out = [(UNDETERMINED, 0.0)] * len(texts)
        letter = regex.compile(r"\p{L}").search
        at = [k for k, t in enumerate(texts) if t and letter(t)] if self.languages else []
        if at:
            scores = self.scores([texts[k] for k in at], presence)
            best = scores.argmax(axis=1)
            for k, b, s in zip(at, best, scores.max(axis=1), strict=True):
                out[k] = (self.languages[b], float(min(1.0, max(0.0, (s + 1) / 2))))
        return out


def letters_of(samples: list[tuple[str, str]], languages: list[str], most: int = LETTERS) -> str:
    """The letters with the largest share of texts that have them, in the language where that share is largest."""
    best: dict[str, float] = {}
    for lang in languages:
        texts = [t for t, own in samples if own == lang]
        for c, n in Counter(c for t in texts for c in set(t.lower()) if c.isalpha()).items():
            best[c] = max(best.get(c, 0.0), n / len(texts))
    return "".join(sorted(best, key=lambda c: (-best[c], c))[:most])


def fit(samples: list[tuple[str, str]], landmarks: int = LANDMARKS, penalty: float = PENALTY) -> Model:
    """The model of (text, language) rows, in their order; the landmarks are spread evenly over the languages."""
    languages = sorted({lang for _, lang in samples})
    if not languages:
        return Model([], "", *[np.zeros((0, 0), dtype=np.float32)] * 4)
    letters = letters_of(samples, languages)
    presence = Presence(letters)
    chosen: list[int] = []
    of = {lang: [k for k, s in enumerate(samples) if s[1] == lang] for lang in languages}
    for turn in range(max(map(len, of.values()))):
        chosen += [of[lang][turn] for lang in languages if turn < len(of[lang])]
    chosen = chosen[: max(landmarks, len(languages))]
    marks = [np.flatnonzero(presence.mark(samples[k][0])) for k in chosen]
    columns = np.unique(np.concatenate(marks))
    rows = np.zeros((len(chosen), len(columns)), dtype=np.float32)
    for k, m in enumerate(marks):
        rows[k, np.searchsorted(columns, m)] = 1 / np.sqrt(max(1, len(m)))
    model = Model(languages, letters, columns, rows, np.eye(len(chosen), dtype=np.float32), np.zeros(len(chosen), dtype=np.float32))
    among = (rows @ rows.T).astype(np.float64)
    values, vectors = np.linalg.eigh(among)
    half = vectors / np.sqrt(np.maximum(values, 1e-6))
    texts = [t for t, _ in samples]
    mapped = np.concatenate([model.scores(texts[k : k + 128], presence) for k in range(0, len(texts), 128)]).astype(np.float64) @ half
    wanted = np.array([[1.0 if lang == own else -1.0 for lang in languages] for _, own in samples])
    middle, mean = mapped.mean(axis=0), wanted.mean(axis=0)
    centred = mapped - middle
    ridge = np.linalg.solve(centred.T @ centred + penalty * len(samples) * np.eye(len(chosen)), centred.T @ (wanted - mean))
    model.familiar = familiar(samples, languages)
    model.weights, model.bias = (half @ ridge).astype(np.float32), (mean - middle @ ridge).astype(np.float32)
    return model


def training_sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS) -> list[tuple[str, str]]:
    """The bounded sample, in a fixed order; two passes that shuffle one number a hash class, whatever the tables' size."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id") & F.length("text").between(20, max_chars))
    rows = rows.withColumn("h", F.xxhash64(F.col("id")))
    # a row a label; the number of texts a label gives way before the sample outgrows its bound
    labels = rows.select("lang").distinct().count()
    per_language = max(LEAST_EACH, min(per_language, SAMPLE // max(1, labels)))
    least = staged(rows.groupBy("lang", F.pmod("h", F.lit(per_language)).alias("class")).agg(F.min("h").alias("h")).select("lang", "h"), "sample")
    # the stage's size is known, so the planner broadcasts it where it is small enough
    found = rows.join(least, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    return sorted(((r.text, r.lang) for r in found.collect()), key=lambda s: (s[1], hash_of(s[0])))


def hash_of(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode("utf-8", "replace"))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    return fit(training_sample(df, id_col, text_col, lang_col))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, one row per row of df."""

    def make():
        presence = Presence(model.letters)
        return lambda texts: model.predict(texts, presence)

    return per_text(df, id_col, text_col, "lang_pred string, score double", make)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score: learned from the labelled rows that aren't held out, predicted for every row from its text alone."""
    out = predict(df, train(df, id_col, text_col, lang_col), id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")


def keep_identified(df: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of df whose language is determined and which are familiar with the least score, in df's columns; a null language becomes the predicted one."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(model.letters)
        for part in sliced(batches):
            texts = part.column(names.index(text_col)).to_pylist()
            found = model.predict(texts, presence)
            columns, at = list(part.columns), names.index(lang_col)
            columns[at] = pa.array([old if old is not None else new for old, (new, _) in zip(columns[at].to_pylist(), found, strict=True)], type=columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema).filter(pa.array([lang != UNDETERMINED and model.familiar.score(t) >= least_score for t, (lang, _) in zip(texts, found, strict=True)]))

    return df.mapInArrow(run, df.schema)
