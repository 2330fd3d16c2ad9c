from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import AWKWARD, documents
from pulseframe.llm import lm
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"


def words(text):
    return (text or "").encode().lower().split() + [b""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def same_base(rows, docs):
    counts = Counter(w for d, t in docs if not held(d) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    texts = {(d, len(words(t))): t for d, t in docs}
    for r in rows:
        w = words(texts[r["doc_id"], r["n_tokens"]])
        assert r["held_out"] == held(r["doc_id"]) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[x] > 0 for x in w)
        want = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        assert abs(r["base_score"] - want) < 1e-6 * max(1, abs(want))


def test_unigram_columns_and_a_better_model_of_held_out_texts(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    rows = lm.score(table(spark, SF, "documents")).collect()
    assert len(rows) == len(docs)
    same_base(rows, docs)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 0.1 * sum(r["n_tokens"] for r in out)
    assert all(r["score"] < 0 and r["perplexity"] > 1 for r in rows)


def likelihood(pairs, classes, many):
    m = np.zeros((many, many))
    for (p, q), n in pairs.items():
        m[classes[p], classes[q]] += n
    x = lambda v: float((v * np.log(np.maximum(v, 1e-300))).sum())
    return x(m) - x(m.sum(1)) - x(m.sum(0)), m


def test_the_gain_of_a_move_is_the_gain_in_likelihood():
    rng = np.random.default_rng(2)
    units, many = 12, 4
    pairs = Counter((int(p), int(q)) for p, q in rng.integers(0, units, (400, 2)))
    classes = np.concatenate([[0], rng.integers(1, many, units - 1)])
    before, m = likelihood(pairs, classes, many)
    for u in range(1, units):
        s, p = np.zeros(many), np.zeros(many)
        for (a, b), n in pairs.items():
            if a == u and b != u:
                s[classes[b]] += n
            if b == u and a != u:
                p[classes[a]] += n
        to, gain = lm.best_class(m, int(classes[u]), s, p, float(pairs[u, u]))
        every = {}
        for c in range(1, many):
            moved = classes.copy()
            moved[u] = c
            every[c] = likelihood(pairs, moved, many)[0] - before
        assert abs(gain - max(every.values())) < 1e-6 and abs(every[to] - max(every.values())) < 1e-6


def test_exchange_finds_the_two_languages(spark):
    rng = np.random.default_rng(3)
    texts = []
    for i in range(300):
        a, b = (["le", "la", "de"], ["chat", "chien", "nuit"]) if i % 2 else (["the", "a", "of"], ["cat", "dog", "night"])
        texts.append((i, " ".join(f"{rng.choice(a)} {rng.choice(b)}" for _ in range(30))))
    train = documents(spark, texts).selectExpr("text AS _text")
    counts = train.mapInArrow(lm._word_counts, "word binary, n long").groupBy("word").sum("n").toDF("word", "n")
    model = lm.fit(train, counts, many=5, rounds=12)
    of = lambda *w: {int(model.classes[model.units.of(x.encode())]) for x in w}
    groups = [of("le", "la", "de"), of("chat", "chien", "nuit"), of("the", "a", "of"), of("cat", "dog", "night")]
    assert sum(map(len, groups)) <= 6 and len(set.union(*groups)) == 4


def test_probabilities_of_the_next_token_sum_to_one(spark):
    docs = documents(spark, [(i, "red green blue red red deep sky " + "rare%d" % i) for i in range(1, 40)])
    train = docs.selectExpr("text AS _text")
    counts = train.mapInArrow(lm._word_counts, "word binary, n long").groupBy("word").sum("n").toDF("word", "n")
    m = lm.fit(train, counts, many=4, rounds=4)
    steps = (10**m.step).sum(axis=1)
    assert np.allclose(steps, 1)
    emitted = np.zeros(4)
    for r in counts.collect():
        c = m.classes[m.units.of(bytes(r["word"]))]
        emitted[c] += (r["n"] + 1) / 10 ** m.room[c]
    assert np.allclose(emitted + 1 / 10**m.room, 1)  # and one unseen word of each class


def test_awkward_rows(spark):
    docs = [(r[0], r[1]) for r in AWKWARD] + [(30 + i, "A b  A\x0bB é x") for i in range(9)]
    rows = lm.score(documents(spark, docs, extra=True)).collect()
    assert len(rows) == len(docs)
    same_base(rows, docs)


def test_empty_table_and_no_training_text(spark):
    assert lm.score(documents(spark, [])).count() == 0
    only = next(i for i in range(100) if held(i))
    row = lm.score(documents(spark, [(only, "a b")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)


def test_most_tokens_have_a_clustered_word(spark):
    docs = table(spark, SF, "documents").selectExpr("text AS _text")
    counts = docs.mapInArrow(lm._word_counts, "word binary, n long").groupBy("word").sum("n").toDF("word", "n")
    model = lm.fit(docs, counts, rounds=1)
    assert set(model.head) - {b""} <= set(model.units.known)  # every word that travels is a unit of its own
    assert sum(model.head.values()) >= 0.75 * model.total


def test_texts_are_cut_into_words_many_at_once(monkeypatch):
    """No text is split alone, however batches are cut, and the words are those of ``tokens``."""
    import pyarrow as pa

    texts = ["a B a", " \tx\x0by\x0c\r\nz ", "", None, "   ", "\x1c \x85 É é\xa0É", "\x00ab b", "one"] * 3
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 5], pa.string())], names=["t"]) for i in range(0, len(texts), 5)]
    want = Counter(w for t in texts for w in [*lm.tokens(t), lm.END])
    split = lm.tokens
    monkeypatch.setattr(lm, "tokens", lambda text: pytest.fail("a text was split alone"))
    for limit in (1, 10, 1000):
        monkeypatch.setattr(lm, "_CHUNK_BYTES", limit)
        chunks = list(lm._chunks(batches))
        assert [t for c in chunks for t in c.column(0).to_pylist()] == texts
        assert len(chunks) == (len(texts) if limit == 1 else len(chunks)) and (limit < 1000 or len(chunks) == 1)
        for c in chunks:
            words, codes, owners = lm._encoded(c.column(0))
            found = [[] for _ in range(c.num_rows)]
            for code, owner in zip(codes.tolist(), owners.tolist()):
                found[owner].append(words[code].as_py())
            assert found == [split(t) for t in c.column(0).to_pylist()]
        counted = Counter()
        for b in lm._word_counts(batches):
            counted.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
        assert counted == want


def test_batches_to_and_from_python_stay_small(spark, monkeypatch, tmp_path):
    """Whole tables of long texts and words cross in small pieces: buffers as large as a batch stay with an executor."""
    import pyarrow as pa

    count, key = lm._word_counts, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def noted(batches):
        def each():
            for b in batches:
                with open(tmp_path / "sizes", "a") as f:
                    f.write(f"{b.num_rows} {b.nbytes}\n")
                yield b

        yield from count(each())

    monkeypatch.setattr(lm, "_word_counts", noted)
    docs = documents(spark, [(i, f"word{i} same " * 500) for i in range(900)] + [(900, "x " * 1_500_000)]).coalesce(1)
    rows = lm.score(docs, rounds=1).collect()
    assert len(rows) == 901 and spark.conf.get(key) == before
    sizes = [tuple(map(int, x.split())) for x in (tmp_path / "sizes").read_text().splitlines()]
    assert sum(n for n, _ in sizes) == sum(not held(i) for i in range(901))
    assert max(b for n, b in sizes if n > 1) < 1.5 * lm._BATCH_BYTES  # a longer text goes alone

    table = pa.RecordBatch.from_arrays([pa.array(range(250_000))], names=["n"])
    for sizes in (None, np.full(250_000, 3), np.append(np.ones(249_999, int), 500_000)):
        parts = list(lm._pieces(table, sizes))
        assert pa.Table.from_batches(parts) == pa.Table.from_batches([table])
        ends = np.cumsum([p.num_rows for p in parts])
        entries = [int((np.ones(250_000, int) if sizes is None else sizes)[e - p.num_rows : e].sum()) for p, e in zip(parts, ends)]
        assert all(n <= lm._BATCH_ENTRIES or p.num_rows == 1 for p, n in zip(parts, entries))
    pairs = [b for b in count([pa.RecordBatch.from_arrays([pa.array([" ".join(map(str, range(250_000)))])], names=["t"])])]
    assert max(b.num_rows for b in pairs) <= lm._BATCH_ENTRIES
