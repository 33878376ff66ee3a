"""Token counts of a unigram vocabulary without the tokens: a Viterbi pass that carries score and piece count only.

One Aho-Corasick pass over a word lists the vocabulary pieces that end at each character, longest first; the best score
up to a character and the number of pieces on that path are all that is kept. Ties go to the piece that starts first,
as the tokenizer's lattice updates a node only on a strictly better score. A character that no one-character piece
covers may also be an unknown one (lowest score less 10); with byte fallback it counts as its UTF-8 bytes.

Texts are cut at spaces as the tokenizer's metaspace step does: each space starts a word and becomes its mark, and a
text that doesn't start with one gets one. Null and empty texts have no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lectern.llm.common import per_text

MARK = "▁"
#: Fixed value: what an unknown character scores below the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Words kept with their counts in each Python worker (as many again from before the last renewal), and the longest of them.
CACHED_WORDS, CACHED_LENGTH = 600_000, 48
#: Largest vocabulary that is sent to the executors.
MAX_VOCABULARY = 1_000_000


def load(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.get_piece_size() > MAX_VOCABULARY:
        raise ValueError(f"{model.get_piece_size()} pieces are more than the {MAX_VOCABULARY} that may be sent to executors")
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class _Words(dict):
    """Counts of words already seen; when full, words still in use move on."""

    def __init__(self, count) -> None:
        super().__init__()
        self.count, self.before = count, {}

    def __missing__(self, word: str) -> int:
        n = self.before.get(word)
        if n is None:
            n = self.count(MARK + word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = n
        return n


class Counter:
    """Counts the pieces on the best path of each word."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        import ahocorasick

        names = {p for p, _ in pieces}
        self.bytes_known = all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.words = _Words(self.count_word)

    def best(self, word: str) -> tuple[float, int]:
        """Score and piece count of the best path over a word."""
        size = len(word)
        ends: list[list] = [[] for _ in range(size)]
        for end, match in self.automaton.iter(word):
            ends[end].append(match)
        score, count, open_run = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        for end in range(1, size + 1):
            top, n, run, single = None, 0, False, False
            for length, own in sorted(ends[end - 1], reverse=True) if len(ends[end - 1]) > 1 else ends[end - 1]:
                single = single or length == 1
                if top is None or score[end - length] + own > top:
                    top, n = score[end - length] + own, count[end - length] + 1
            if not single and (top is None or score[end - 1] + self.unknown > top):
                top, run = score[end - 1] + self.unknown, True
                n = count[end - 1] + (len(word[end - 1].encode()) if self.bytes_known else not open_run[end - 1])
            score[end], count[end], open_run[end] = top, n, run
        return score[size], count[size]

    def count_word(self, word: str) -> int:
        return self.best(word)[1]

    def count(self, text: str | None) -> tuple[int, int]:
        """Words and pieces of a text."""
        if not text:
            return 0, 0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:
            del words[0]
        return len(words), sum(map(self.words.__getitem__, words))


_counters: dict[str, Counter] = {}


def counter(key: str, pieces: list[tuple[str, float]]) -> Counter:
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(pieces)
    return _counters[key]


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_tokens, one row per row of df, repeated rows and null ids included."""
    sent = df.sparkSession.sparkContext.broadcast(load(path))

    def make():
        c = counter(path, sent.value)
        return lambda texts: [c.count(t) for t in texts]

    return per_text(df, id_col, text_col, "n_words bigint, n_tokens bigint", make)
