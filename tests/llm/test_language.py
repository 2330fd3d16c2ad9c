from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
from helpers_llm import AWKWARD, by_id, documents
from pulseframe.llm import language
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"


def kneser_ney(texts: list[str]):
    """Probability of a character after three others, by the textbook."""
    counts: Counter[str] = Counter()
    for t in texts:
        s = "  " + " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        counts.update(s[i : i + 4] for i in range(len(s) - 3))
    levels = {4: counts}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    letters = len(levels[1]) + 1
    discount = {}
    total, kinds = defaultdict(int), defaultdict(int)
    for n, level in levels.items():
        n1, n2 = (sum(v == x for v in level.values()) for x in (1, 2))
        discount[n] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        for g, v in level.items():
            total[n, g[:-1]] += v
            kinds[n, g[:-1]] += 1

    def p(g: str, n: int) -> float:
        if n == 0:
            return 1 / letters
        h = g[:-1]
        if not total[n, h]:
            return p(g[1:], n - 1)
        d = discount[n]
        return max(levels[n][g] - d, 0) / total[n, h] + d * kinds[n, h] / total[n, h] * p(g[1:], n - 1)

    return lambda g: p(g, 4), levels


def test_probabilities_are_interpolated_kneser_ney(spark):
    texts = ["the cat sat on the mat", "a cat and a rat that sat", "on the hat, the bat"]
    model = language.fit(documents(spark, [(i, t, "en") for i, t in enumerate(texts)]), least_share=0.0)
    p, levels = kneser_ney(texts)
    letters = sorted(levels[1])
    for h in itertools.islice(itertools.product(letters, repeat=3), 0, None, 7):
        total = 0.0
        for c in letters:
            g = "".join(h) + c
            key = np.array([sum(ord(x) << 16 * (3 - i) for i, x in enumerate(g))], dtype=np.uint64)
            got = float(np.exp(model.logs(key)[0, 0]))
            assert abs(got - p(g)) < 1e-9, g
            total += got
        assert total <= 1 + 1e-9


def test_held_out_accuracy(spark):
    got = by_id(language.identify(table(spark, SF, "documents")))
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(got[r["doc_id"]]["held_out"] for r in held) and sum(r["held_out"] for r in got.values()) == len(held)
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held if r["lang"]]
    assert sum(right) / len(right) > 0.99
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_foreign_text_is_rejected_but_named(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    odd = documents(spark, [(10**6 + i, "ξένο κείμενο άλλης γλώσσας " * 20) for i in range(4)])
    got = by_id(language.identify(docs.union(odd)).filter("doc_id >= 1000000"))
    assert all(r["rejected"] and r["lang_pred"] in ("en", "fr", "de", "es") for r in got.values())


def test_held_out_texts_and_labels_change_nothing(spark):
    rows = [(i, "der hund und die katze" if i % 2 else "the dog and the cat", "de" if i % 2 else "en") for i in range(60)]
    other = [(i, "zzz" if zlib.crc32(str(i).encode()) % 4 == 2 else t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else g) for i, t, g in rows]
    a, b = (by_id(language.identify(documents(spark, r))) for r in (rows, other))
    same = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    assert all(a[i] == b[i] for i in same) and {r["lang_pred"] for r in b.values()} <= {"de", "en"}


def test_awkward_rows(spark):
    rows = language.identify(documents(spark, AWKWARD, extra=True)).collect()
    assert len(rows) == len(AWKWARD)
    got = {r["doc_id"]: r for r in rows}
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (1, 2, 3))
    assert got[7]["lang_pred"] in ("en", "fr") and not got[None]["held_out"]


def test_no_labels_and_empty_table(spark):
    rows = language.identify(documents(spark, [(1, "some text"), (2, None)])).collect()
    assert [r["lang_pred"] for r in rows] == ["und", "und"]
    assert language.identify(documents(spark, [])).count() == 0
