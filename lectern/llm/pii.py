"""Personal data: patterns with checks, and a linear-chain conditional random field over word shapes.

The patterns (email, ip, card, phone) are searched leftmost and non-overlapping for each kind; a match that fails its
check is dropped. The field adds spans of its own kinds. Its words are the runs of non-space characters; a word that
has no digit and no @ can't be part of an entity, so its state is known to be "outside", which parts the chain there
exactly. Only the runs of other words are decoded, many at a time, by Viterbi in numpy; each sees its neighbours' shapes.

The field is trained on a small labelled table (a bundled one, or the caller's) by full-batch gradient steps.
Null and empty texts have no spans.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lectern.llm.common import per_text, sliced

KINDS = ("email", "ip", "card", "phone")
#: Kinds that the field may add beside the patterns' matches.
ADDED = ("email", "phone", "secret")

#: The patterns of the base search, written so that no place is tried twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"(?<!\S)\S*?[0-9@]\S*")
_ANY = re.compile(r"[0-9@]")
_DIGIT_OUT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches: the part before each @ is the whole run of its characters since the last match."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in (("card", _CARD, 13, 19), ("phone", _PHONE, 9, 15)):
        if kind == "phone" and "+" not in text:
            continue
        for m in pattern.finditer(text):
            if m.end() - m.start() >= least:
                digits = _DIGIT_OUT.sub("", m[0])
                if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                    out.append((kind, *m.span()))
    return out


# --- the field ---

STATES = ("O", *(f"{p}-{k}" for k in (*KINDS, "secret") for p in "BI"))
#: Words before or after a candidate that are features by themselves.
CUES = frozenset("token password passwd secret key api version tel phone call fax mail email contact ip host card no license page section chapter by at on in of".split())
_SHAPES = str.maketrans({**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "9" for c in "0123456789"}})
_RUNS = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Letters as a or A, digits as 9, repeats once; words of over 64 characters by their first and last 32."""
    if len(word) > 64:
        word = word[:32] + word[-32:]
    return _RUNS.sub(r"\1", word.translate(_SHAPES))[:14]


def bucket(n: int, steps: tuple[int, ...]) -> int:
    return sum(n >= s for s in steps)


def features(word: str, before: str, after: str) -> list[str]:
    core = word.strip("\"'.,;:!?()[]{}<>=")
    digits = sum(map(word.count, "0123456789"))
    value = re.split(r"[=:]", core)[-1].strip("\"'")
    letters = sum(c.isalpha() for c in value)
    mixed = "hex" if re.fullmatch(r"[0-9a-f]{16,}", value) else "upper" if re.fullmatch(r"[0-9A-Z]{16,}", value) else "mixed" if re.fullmatch(r"[0-9A-Za-z_/+-]{20,}", value) else "no"
    left, right = before.lower().strip("\"'.,;:!?()[]"), after.lower().strip("\"'.,;:!?()[]")
    return [
        "bias",
        f"shape {shape(core)}",
        f"whole {shape(word)}",
        f"digits {bucket(digits, (1, 3, 5, 9, 13, 20))}",
        f"length {bucket(len(core), (2, 4, 6, 9, 13, 20, 32))}",
        f"kind {mixed} {letters > 0} {digits > 0}",
        f"before {left if left in CUES else shape(before)[:6]}",
        f"after {right if right in CUES else shape(after)[:4]}",
        f"key {next((c for c in ('token', 'password', 'secret', 'key') if c in word.lower()), '')}",
    ]


def training_rows(n: int = 600, seed: int = 20240131) -> list[tuple[list[str], list[str]]]:
    """The bundled labelled table: sentences of made-up words with planted entities and with harmless numbers."""
    rnd = random.Random(seed)
    digits = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rnd.choice("aeionrstlhdcumpb") for _ in range(rnd.randrange(2, 9)))
    hexes = lambda k: "".join(rnd.choice("0123456789abcdef") for _ in range(k))
    upper = lambda k: "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k))
    edge = lambda w: rnd.choice(["", "", "", '"', "("]) + w + rnd.choice(["", "", "", ".", ",", ";", ")"])

    def entity() -> tuple[list[str], str]:
        kind = rnd.choice((*KINDS, "secret", "secret"))
        if kind == "email":
            return [edge(f"{word()}.{digits(2)}@{word()}{digits(1)}.{word()}.{rnd.choice(['com', 'org', 'net', 'de'])}")], kind
        if kind == "ip":
            return [edge(".".join(str(rnd.randrange(1, 256)) for _ in range(4)))], kind
        if kind == "card":
            return ([edge("4" + digits(15))] if rnd.random() < 0.6 else [digits(4) for _ in range(4)]), kind
        if kind == "phone":
            form = rnd.randrange(4)
            return [[f"+{rnd.randrange(1, 99)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"({digits(3)})", edge(f"{digits(3)}-{digits(4)}")], [f"+{digits(11)}"], [f"+{digits(2)}", digits(3), digits(3), digits(4)]][form], kind
        form = rnd.randrange(5)
        if form == 0:
            return [rnd.choice(["password=", "token=", "secret:", "api_key="]) + hexes(16)], kind
        if form == 1:
            return [f'"{hexes(rnd.choice([32, 40]))}"'], kind
        if form == 2:
            return [edge("AKIA" + upper(16))], kind
        if form == 3:
            return [edge(hexes(rnd.choice([24, 32, 40])))], kind
        return [edge(rnd.choice(["sk-", "ghp_"]) + "".join(rnd.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJK23456789") for _ in range(28)))], kind

    def harmless() -> list[str]:
        forms = [
            lambda: ["version", edge(f"{rnd.randrange(9)}.{rnd.randrange(9)}")],
            lambda: [edge(str(rnd.randrange(1, 2100)))],
            lambda: [edge(digits(rnd.randrange(1, 9)))],
            lambda: ["page", edge(str(rnd.randrange(1, 999)))],
            lambda: [f"20{digits(2)}-0{rnd.randrange(1, 9)}-1{digits(1)}"],
            lambda: [f"{rnd.randrange(10, 23)}:{rnd.randrange(10, 59)}"],
            lambda: [f"{digits(2)}%"],
            lambda: [f"{rnd.randrange(1, 999)},{digits(3)}", word()],
            lambda: ["BY-NC", "4.0."],
            lambda: [f"{rnd.randrange(1, 9)}{word()}"],
            lambda: [f"{word()}{digits(2)}"],
            lambda: [f"${rnd.randrange(1, 99)}.{digits(2)}"],
            lambda: [f"@{word()}"],
            lambda: [digits(4), f"{digits(3)}"],
            lambda: [f"https://{word()}.com/{word()}/{digits(3)}"],
        ]
        return rnd.choice(forms)()

    rows = []
    for _ in range(n):
        words, labels = [], []
        for _ in range(rnd.randrange(2, 6)):
            plain = [word() for _ in range(rnd.randrange(0, 4))]
            words += plain
            labels += ["O"] * len(plain)
            if rnd.random() < 0.5:
                part, kind = entity()
                if kind == "secret" and rnd.random() < 0.5:
                    cue = rnd.choice([["token", "="], ["secret"], ["key"]])
                    words += cue
                    labels += ["O"] * len(cue)
                words += part
                labels += [f"{'I' if k else 'B'}-{kind}" for k in range(len(part))]
            else:
                part = harmless()
                words += part
                labels += ["O"] * len(part)
        rows.append((words, labels))
    return rows


def runs_of(words: list[str]) -> Iterator[list[int]]:
    """The stretches of words that have a digit or an @."""
    run: list[int] = []
    for k, w in enumerate(words):
        if _ANY.search(w):
            run.append(k)
        elif run:
            yield run
            run = []
    if run:
        yield run


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """Weights of the features and of the moves between states; outside states stand before and after each run."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray) -> None:
        self.index, self.weights, self.moves = index, weights, moves

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), len(STATES)))
        at = np.array([k for k, r in enumerate(rows) for f in r if f in self.index], dtype=np.int64)
        which = np.array([self.index[f] for r in rows for f in r if f in self.index], dtype=np.int64)
        np.add.at(out, at, self.weights[which])
        return out

    def decode(self, runs: list[np.ndarray]) -> list[list[int]]:
        """The best states of many runs of emissions, all at once; longer runs simply stay longer in the batch."""
        order = sorted(range(len(runs)), key=lambda k: -len(runs[k]))
        sizes = [len(runs[k]) for k in order]
        best = np.stack([runs[k][0] for k in order]) + self.moves[0]
        back: list[np.ndarray] = []
        live = len(order)
        for step in range(1, sizes[0]):
            while sizes[live - 1] <= step:
                live -= 1
            paths = best[:live, :, None] + self.moves[None]
            back.append(paths.argmax(axis=1).astype(np.int8))
            best[:live] = paths.max(axis=1) + np.stack([runs[k][step] for k in order[:live]])
        last = (best + self.moves[:, 0]).argmax(axis=1)
        out: list[list[int]] = [[] for _ in runs]
        for row, k in enumerate(order):
            path = [int(last[row])]
            for step in range(sizes[row] - 1, 0, -1):
                path.append(int(back[step - 1][row, path[-1]]))
            out[k] = path[::-1]
        return out


def allowed_moves() -> np.ndarray:
    """0 where a state may follow another, else a large penalty: an inner state follows its own kind only."""
    out = np.zeros((len(STATES), len(STATES)))
    for i, a in enumerate(STATES):
        for j, b in enumerate(STATES):
            if b[0] == "I" and a[1:] != b[1:]:
                out[i, j] = -1e4
    return out


def train(rows: list[tuple[list[str], list[str]]] | None = None, steps: int = 120, rate: float = 0.1, penalty: float = 0.02) -> Field:
    """Maximum conditional likelihood with an L2 penalty, by Adam steps over all rows; deterministic."""
    rows = training_rows() if rows is None else rows
    runs = [([features(words[k], words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else "") for k in run], [STATES.index(labels[k]) for k in run]) for words, labels in rows for run in runs_of(words)]
    runs.sort(key=lambda r: -len(r[0]))
    if not runs:
        raise ValueError("no labelled word has a digit or an @")
    index = {f: k for k, f in enumerate(sorted({f for r, _ in runs for fs in r for f in fs}))}
    n, size, s = len(runs), max(len(r) for r, _ in runs), len(STATES)
    x = np.zeros((n, size, len(index)), dtype=np.float32)
    y = np.zeros((n, size), dtype=np.int64)
    length = np.array([len(r) for r, _ in runs])
    for i, (r, states) in enumerate(runs):
        y[i, : len(r)] = states
        for t, fs in enumerate(r):
            x[i, t, [index[f] for f in fs]] = 1
    inside = np.arange(size) < length[:, None]
    live, ends = inside.sum(axis=0), (np.arange(n), length - 1)
    flat = x[inside]
    hard = allowed_moves()
    theta = [np.zeros((len(index), s)), np.zeros((s, s))]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        weights, moves = theta[0], theta[1] + hard
        e = np.zeros((n, size, s))
        e[inside] = flat @ weights.astype(np.float32)
        alpha, beta = np.zeros((n, size, s)), np.zeros((n, size, s))
        alpha[:, 0] = e[:, 0] + moves[0]
        for t in range(1, size):
            k = live[t]
            alpha[:k, t] = _log_sum(alpha[:k, t - 1, :, None] + moves, 1) + e[:k, t]
        beta[ends] = moves[:, 0]
        for t in range(size - 2, -1, -1):
            k = live[t + 1]
            beta[:k, t] = _log_sum(moves + (e[:k, t + 1] + beta[:k, t + 1])[:, None, :], 2)
        z = _log_sum(alpha[ends] + moves[:, 0], 1)
        node = np.exp(np.where(inside[:, :, None], alpha + beta - z[:, None, None], -np.inf))
        gold = np.zeros((n, size, s))
        np.put_along_axis(gold, y[:, :, None], 1.0, axis=2)
        gold *= inside[:, :, None]
        g_weights = flat.T @ (gold - node)[inside].astype(np.float32) - penalty * weights
        g_moves = np.zeros((s, s))
        g_moves[0] += (gold[:, 0] - node[:, 0]).sum(0)
        g_moves[:, 0] += (gold[ends] - node[ends]).sum(0)
        for t in range(1, size):
            k = live[t]
            g_moves -= np.exp(alpha[:k, t - 1, :, None] + moves + (e[:k, t] + beta[:k, t])[:, None, :] - z[:k, None, None]).sum(0)
            np.add.at(g_moves, (y[:k, t - 1], y[:k, t]), 1)
        g_moves -= penalty * theta[1]
        for k, g in enumerate((g_weights, g_moves)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            theta[k] = theta[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Field(index, theta[0], theta[1] + hard)


@cache
def bundled() -> Field:
    """The field of the bundled table, trained once in a process."""
    return train()


def candidates(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, word before, word after) of each word with a digit or an @; neighbours by their 40 nearest characters."""
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        before, after = text[max(0, a - 40) : a].split(), text[b : b + 40].split()
        yield a, b, before[-1] if before else "", after[0] if after else ""


def trimmed(text: str, start: int, end: int, kind: str) -> tuple[int, int]:
    """The span without the marks around it; of a secret given as name=value, the value."""
    while end > start and text[end - 1] in "\"'.,;:!?)]}>*%&$#":
        end -= 1
    if kind == "secret":
        cut = max(text.rfind("=", start, end), text.rfind(":", start, end))
        start = cut + 1 if cut >= 0 else start
    while start < end and text[start] in "\"'.,;:!?[{<*%&$#" + ("(" if kind == "secret" else ""):
        start += 1
    return start, end


def spans_of(texts: list[str | None], field: Field) -> list[tuple[list, list]]:
    """For each text its base spans, and those with what the field adds, each sorted by kind and start."""
    rank = {k: n for n, k in enumerate((*KINDS, "secret"))}
    found, runs, where = [], [], []
    for row, text in enumerate(texts):
        base = base_spans(text) if text and _ANY.search(text) else []
        found.append(base)
        run: list[tuple[int, int]] = []
        rows: list[list[str]] = []
        end_of_last = -1
        for a, b, before, after in candidates(text) if text and _ANY.search(text) else ():
            if run and text[end_of_last:a].strip():
                runs.append(field.emissions(rows))
                where.append((row, run))
                run, rows = [], []
            run.append((a, b))
            rows.append(features(text[a:b], before, after))
            end_of_last = b
        if run:
            runs.append(field.emissions(rows))
            where.append((row, run))
    more: list[list] = [[] for _ in texts]
    for (row, run), states in zip(where, field.decode(runs) if runs else [], strict=True):
        text, k = texts[row], 0
        while k < len(run):
            name = STATES[states[k]]
            last = k
            while last + 1 < len(run) and name != "O" and STATES[states[last + 1]] == f"I{name[1:]}":
                last += 1
            if name[2:] in ADDED:
                more[row].append((name[2:], *trimmed(text, run[k][0], run[last][1], name[2:])))
            k = last + 1
    out = []
    for base, added in zip(found, more, strict=True):
        held = Held(base)
        free = [(k, a, b) for k, a, b in added if a < b and not held.overlaps(a, b) and (k != "email" or "@" in texts[len(out)][a + 1 : b - 1])]
        key = lambda s: (rank[s[0]], s[1])
        out.append((sorted(base, key=key), sorted(base + free, key=key)))
    return out


class Held:
    """Spans, which may overlap each other, in ascending order of start, with the largest end up to each."""

    def __init__(self, spans: list[tuple[str, int, int]]) -> None:
        pairs = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in pairs]
        self.ends = list(itertools.accumulate((b for _, b in pairs), max))

    def overlaps(self, a: int, b: int) -> bool:
        """Whether any of the spans that start before b ends after a."""
        before = bisect.bisect_left(self.starts, b)
        return before > 0 and self.ends[before - 1] > a


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """One row per row of df: counts by kind, base_sha256 and the list of all spans (kind:start:end in code points)."""
    field = field or bundled()

    def row(base: list, spans: list) -> tuple:
        return (*(sum(k == kind for k, _, _ in base) for kind in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans))

    return per_text(df, id_col, text_col, "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string", lambda: lambda texts: [row(b, s) for b, s in spans_of(texts, field)])


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    if not spans:
        return text
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(df: DataFrame, text_col: str = "text", field: Field | None = None, length_col: str | None = None) -> DataFrame:
    """df with the found spans taken out of its text; all other columns pass as they are, but for the length column."""
    field = field or bundled()
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            at = names.index(text_col)
            texts = part.column(at).to_pylist()
            new = [redacted(t, s) for t, (_, s) in zip(texts, spans_of(texts, field), strict=True)]
            columns = list(part.columns)
            columns[at] = pa.array(new, type=columns[at].type)
            if length_col:
                k = names.index(length_col)
                columns[k] = pa.array([old if a is b else len(b) for old, a, b in zip(columns[k].to_pylist(), texts, new, strict=True)], type=columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return df.mapInArrow(run, df.schema)
