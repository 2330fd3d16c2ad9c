from __future__ import annotations

import random

import pytest
from helpers_llm import AWKWARD, documents
from pulseframe.llm.decontaminate import EDIT_RATE, Index, Q, WINDOW, clean, contamination, normal

ITEMS = "item_id long, text string"


def least_distance(pattern: str, text: str) -> int:
    """Edit distance of ``pattern`` to its nearest stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def brute(item: str, text: str) -> int | None:
    """Fewest edits of a window of the item in the text, if any window is within its budget."""
    item, text = normal(item), normal(text)
    w = min(WINDOW, len(item))
    if w < Q:
        return None
    budget = max(0, min(int(EDIT_RATE * w), w // Q - 1))
    best = min(least_distance(item[s : s + w], text) for s in range(len(item) - w + 1))
    return best if best <= budget else None


def changed(rng: random.Random, text: str, edits: int) -> str:
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyz")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz"))
    return "".join(chars)


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["tion", "ander", "the", "of", "reous", "inga", "stent", "whole", "ithe", "orat"]) + rng.choice(["", "ly", "ed", "s"]) for _ in range(n))


def test_equals_brute_force(spark):
    rng = random.Random(5)
    items = [(i, words(rng, 18)) for i in range(4)] + [(8, words(rng, 9)[:30]), (9, words(rng, 8)[:41]), (10, "short"), (11, "")]
    docs = []
    for d in range(36):
        text = words(rng, 25)
        if d % 4:
            _, item = items[rng.randrange(6)]
            part = item if d % 3 else item[10:95]
            text += " " + changed(rng, part, rng.randrange(0, 13)) + " " + words(rng, 12)
        docs.append((d, text))
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in contamination(documents(spark, docs), spark.createDataFrame(items, ITEMS)).collect()}
    want = {(d, i): e for d, t in docs for i, s in items if (e := brute(s, t)) is not None}
    assert got == want and len(want) > 15


def test_case_and_white_space_do_not_hide_a_passage(spark):
    item = words(random.Random(1), 20)
    docs = documents(spark, [(1, "Before. " + item.upper().replace(" ", "\n  ") + " after"), (2, "nothing")], extra=True)
    items = spark.createDataFrame([(3, item)], ITEMS)
    rows = contamination(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["edits"], r["item_start"]) for r in rows] == [(1, 3, 0, 0)]
    kept = clean(docs, items)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2]


@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (3, "tiny")]])
def test_awkward_rows(spark, items):
    docs, bench = documents(spark, AWKWARD, extra=True), spark.createDataFrame(items, ITEMS)
    assert contamination(docs, bench).count() == 0
    assert clean(docs, bench).count() == len(AWKWARD)


def test_empty_table(spark):
    bench = spark.createDataFrame([(1, words(random.Random(2), 20))], ITEMS)
    assert contamination(documents(spark, []), bench).count() == 0
    assert clean(documents(spark, []), bench).count() == 0


def test_repeated_rows_and_passages_that_span_two_texts(spark):
    item = words(random.Random(3), 20)
    docs = [(1, item), (1, item), (2, item[: len(item) // 2 - 20]), (3, item[len(item) // 2 + 20 :])]
    got = sorted(r["doc_id"] for r in contamination(documents(spark, docs), spark.createDataFrame([(1, item)], ITEMS)).collect())
    want = sorted(d for d, t in docs if brute(item, t) is not None)
    assert got == want and got[:2] == [1, 1]


def scans(items, texts, group):
    """What is found when ``group`` texts are scanned together."""
    index = Index([(i, normal(t)) for i, t in items], Q, WINDOW, EDIT_RATE)
    return sorted((begin + d, *rest) for begin in range(0, len(texts), group) for d, *rest in index.scan([normal(t) for t in texts[begin : begin + group]]))


def test_a_passage_is_found_in_the_text_that_holds_it():
    """A chance q-gram on the passage's diagonal in the text before it draws nothing to that text."""
    rng = random.Random(11)
    item = normal(words(rng, 120))
    middle = len(item) // 2
    passage = item[middle : middle + 90]
    clean_text = "q" * 400
    # The item's diagonal of the passage at the start of the second text runs through the first text.
    gap = 1 + int(EDIT_RATE * WINDOW)
    start = len(clean_text) + gap - middle
    at = next(p for p in range(20, middle - 20) if 0 <= start + p < len(clean_text) - Q)
    first = clean_text[: start + at] + item[at : at + Q] + clean_text[start + at + Q :]
    texts = [first, passage + " zz" * 40, "nothing of it"]
    found = scans([(1, item)], texts, 3)
    assert [f[0] for f in found] == [1] and found == scans([(1, item)], texts, 1)


def test_results_do_not_depend_on_the_batch():
    rng = random.Random(12)
    items = [(i, words(rng, rng.choice([14, 60, 200]))) for i in range(5)]
    texts = []
    for d in range(60):
        _, item = items[rng.randrange(5)]
        cut = rng.randrange(max(1, len(item) - 100))
        part = changed(rng, item[cut : cut + rng.choice([70, 90, 140])], rng.randrange(9)) if d % 3 else ""
        texts.append("" if d % 17 == 0 else part if d % 5 == 0 else words(rng, rng.randrange(8)) + " " + part + " " + words(rng, rng.randrange(8)))
    one = scans(items, texts, 1)
    assert one and all(scans(items, texts, n) == one for n in (2, 7, 60))
