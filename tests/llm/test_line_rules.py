from __future__ import annotations

import re

import pytest
from helpers_llm import AWKWARD, by_id, documents
from pulseframe.llm import line_rules
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCE = "Seven plain words make one short sentence."


def line_of(n: int, seed: str, end: str = ".") -> str:
    """A line of ``n`` words that no other line has."""
    return " ".join(f"{seed}{i}x" for i in range(n)) + end


def base(text: str | None) -> tuple:
    """The contract's counts, word by word."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n_dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), n_dup, len(again), failed


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_equal_the_definition(spark):
    texts = [
        "a b c a b c a", "a a a a", "x\n\nx\n x\nx", "one word only \x1c\x85 two", "\U0001f600 é\tz\r\nq\x0bq\x0cq", "#*$%&|<> ok",
        " \n\t\r", "a b", "a b c", "a b c d a b c d e f a b", "l l l l l l l\nl l l l l l l",
    ]
    docs = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(100, None)]
    got = by_id(line_rules.line_rules(documents(spark, docs)))
    for i, t, *_ in docs[:-1]:
        assert tuple(got[i][c] for c in BASE) == base(t), repr(t)
    assert tuple(got[100][c] for c in BASE) == base(None) and got[100]["cleaned"] is None


def test_counts_of_the_given_documents(spark):
    rows = table(spark, SF, "documents").filter("n_chars < 3000").limit(60).collect()
    got = by_id(line_rules.line_rules(documents(spark, [(r["doc_id"], r["text"]) for r in rows])))
    for r in rows:
        assert tuple(got[r["doc_id"]][c] for c in BASE) == base(r["text"])


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        (SENTENCE, None),
        ("He asked: \"Why not here?\"", None),
        ("No end of a sentence in this line", "punctuation"),
        ("a.### b,*** c&&& done.", "punctuation"),
        ("BUY!! IT!! NOW!! HERE.", "punctuation"),
        ("Home | News | Sport | Login.", "navigation"),
        ("Home » News.", "navigation"),
        ("All rights reserved.", "boilerplate"),
        ("We said that cookies are fine to bake.", None),
        ("This site uses cookies.", "boilerplate"),
        ("这里没有空格。", None),
    ],
)
def test_line_rules(line, rule):
    assert line_rules.failed_rule(line, len(WORD.findall(line)), False) == rule


def test_a_phrase_in_a_long_line_is_no_boilerplate():
    line = "The privacy policy of a state is a matter of law. " * 5
    assert line_rules.failed_rule(line, len(WORD.findall(line)), False) is None


def test_repeated_lines_go_and_the_first_stays(spark):
    body = [line_of(9, f"b{i}") for i in range(8)]
    text = "\n".join([SENTENCE, *body[:4], SENTENCE, "", *body[4:], SENTENCE, "Menu | Shop | Basket"])
    row = line_rules.line_rules(documents(spark, [(1, text)])).first()
    assert row["cleaned"].split("\n") == [SENTENCE, *body[:4], "", *body[4:]]
    assert (row["n_boilerplate"], row["n_navigation"], row["n_dup_lines"], row["kept"]) == (2, 1, 2, True)


def test_losing_over_half_rejects(spark):
    good = "\n".join(line_of(8, f"g{i}") for i in range(10))
    bad = "\n".join(line_of(8, f"b{i}", "") for i in range(10))
    worse = bad + "\n" + line_of(12, "more", "")
    got = by_id(line_rules.line_rules(documents(spark, [(1, good), (2, good + "\n" + bad[: len(good) // 2]), (3, good + "\n" + worse)])))
    assert [got[i]["kept"] for i in (1, 2, 3)] == [True, True, False]
    assert not got[3]["base_failed"] and got[3]["lost_chars"] * 2 > got[3]["word_chars"]


def test_awkward_documents(spark):
    rows = line_rules.line_rules(documents(spark, AWKWARD, extra=True)).collect()
    assert len(rows) == len(AWKWARD)
    assert not any(r["kept"] for r in rows if r["doc_id"] in (1, 2, 3, 4, 5))
    long = next(r for r in rows if r["doc_id"] == 7)
    assert long["n_words"] == 80_000 and long["n_repeat_words"] == 80_000 and long["base_failed"]
    assert line_rules.line_rules(documents(spark, [])).count() == 0


def test_cleaned_keeps_the_columns(spark):
    text = "\n".join(line_of(8, f"t{i}") for i in range(12))
    rows = [(1, text + "\nAll rights reserved.", "en", "a"), (2, None, "en", "a"), (3, "short.", "en", "a"), (1, text + "\nAll rights reserved.", "en", "a")]
    docs = documents(spark, rows, extra=True)
    out = line_rules.cleaned(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert [(r["doc_id"], r["text"], r["lang"], r["rank"]) for r in got] == [(1, text, "en", "clash")] * 2


def test_patterns_are_linear_in_long_runs():
    for junk in ("!" * 200_000 + "x", "." * 200_000 + "x", '."' * 100_000 + "x", "|" * 200_000 + "x", "#" * 200_000, "a" * 500_000):
        line_rules.judged(junk)
