"""Base phrases against a plain scan; templates against words put in, left out and replaced."""

import re

import pytest

from lectern.llm import licenses

MIT = re.sub(r"<<.*?>>", " ", licenses.TEMPLATES["mit-text"].replace("<<var 1 12>>", "the authors").replace("<<optional>>(including the next paragraph)<<end>>", ""))


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in at}))


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


@pytest.mark.parametrize("text", [None, "", "no words?!", "CC BY cc-by, CC  BY. MIT-License mit license", "GNU General Public GNU general public license", "cc bye", "é cc by ñ ñ", "mitlicense mit licence", "apache license " * 3000])
def test_base(scanner, text):
    assert scanner.scan(text)[:5] == brute(text)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(docs).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_templates(scanner):
    labels = lambda t: scanner.scan(t)[5].split(",")
    assert labels("Released under the MIT License.") == ["mit", "mit-notice"]
    assert labels("Licensed under the terms of the Apache License, Version 2.0.") == ["apache", "apache-2.0-notice"]
    assert labels("licensed under the Apache License 1.1") == ["apache"]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["gpl", "gpl-3.0-notice"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by", "cc-by-nc-notice", "cc-by-notice"]
    assert "mit-text" in labels(MIT)
    assert "mit-text" in labels(MIT.replace("permission notice", "permission notice (including the next paragraph)"))
    assert "mit-text" in labels(MIT.replace("the authors", "John Doe and all other holders of the rights at large"))
    assert "mit-text" not in labels(MIT.replace("the authors", " ".join(["x"] * 13)))
    assert "mit-text" not in labels(MIT.replace("sublicense", "relicense"))
    assert "mit-text" not in labels(MIT.replace("sublicense,", ""))
    assert scanner.scan("Released under the MIT License")[6] == pytest.approx(4 / 5)


def plain(label):
    """A template's text with its optional parts, first choices and placeholders of names."""
    text = re.sub(r"<<any ([^|>]*)[^>]*>>", r"\1", licenses.TEMPLATES[label].replace("<<optional>>", "").replace("<<end>>", ""))
    return re.sub(r"<<var (\d+) \d+>>", lambda m: "name " * int(m[1]), text)


@pytest.mark.parametrize("label", [k for k in licenses.TEMPLATES if k.endswith("-text")])
def test_whole_texts_need_all_their_wording(scanner, label):
    words = plain(label).split()
    found = lambda ws: label in scanner.scan(" ".join(["before", *ws, "after"]))[5].split(",")
    assert found(words)
    optional = [k for k, w in enumerate(words) if w in ("1", "2", "3") or "next" in w or "paragraph" in w or "(including" in w or w == "the" and words[k + 1 : k + 2] == ["next"]]
    for k in range(0, len(words), 7):
        if k not in optional and words[k] != "name" and licenses.words_of(words[k]):
            assert not found([*words[:k], "changed", *words[k + 1 :]])


def test_template_without_plain_wording():
    scanner = licenses.Scanner({"odd": "<<any alpha|beta>> <<any one|two>>"}, {})
    assert scanner.scan("x beta two y")[5] == "odd" and scanner.scan("beta three")[5] == "" and scanner.scan(None)[0] == 0


def test_automaton_against_backtracking():
    import itertools

    a = licenses.Automaton("x <<optional>>b <<optional>>c<<end>> d<<end>> <<var 0 2>> <<any b|e>> e")

    def accepts(words):
        for opt, inner, gap, last in itertools.product((0, 1), (0, 1), range(3), (b"b", b"e")):
            shape = [b"x", *([b"b", *([b"c"] if inner else []), b"d"] if opt else []), *[None] * gap, last, b"e"]
            if len(shape) == len(words) and all(s is None or s == w for s, w in zip(shape, words, strict=True)):
                return True
        return False

    for n in range(1, 7):
        for words in itertools.product([b"x", b"b", b"c", b"d", b"e"], repeat=n):
            want = max((k for k in range(n + 1) if accepts(words[:k])), default=-1)
            assert a.match(list(words), 0) == want
    with pytest.raises(ValueError, match="start with wording"):
        licenses.Automaton("<<optional>>a<<end>>")


def test_odd_rows(spark):
    rows = [(1, None, "z"), (1, None, "z"), (None, "MIT License", "z")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.labels) for r in got) == [(0, 2, "mit"), (1, 0, ""), (1, 0, "")]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
