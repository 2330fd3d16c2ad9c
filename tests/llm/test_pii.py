from __future__ import annotations

import hashlib
import re
import time

import numpy as np
from helpers_llm import AWKWARD, by_id, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pulseframe.llm import pii
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"


def literal(text: str) -> dict:
    """The base patterns as they are written, scanned from left to right."""

    def digits(m):
        return "".join(re.findall("[0-9]", m.group()))

    def luhn(s):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(s))) % 10 == 0

    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15],
    }


pieces = st.sampled_from(["a", "b.c", "@", "x@y.z", ".", "-", " ", "+1", "+", "(", ")", "0", "7", "12", "255", "256", "1.2.3.4", "4111111111111111", "4111 1111 1111 1111", "+1 (724) 555-7058", "é", "٣", "\n", "%", "_"])


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base(text) == literal(text)


def test_base_columns_on_the_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    got = by_id(pii.find(table(spark, SF, "documents")))
    for d, text in docs.items():
        want = literal(text or "")
        line = ",".join(f"{k}:{s}:{e}" for k in want for s, e in want[k])
        assert got[d]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [got[d][f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS]
        spans = got[d]["spans"].split(",") if got[d]["spans"] else []
        assert set(line.split(",")) - {""} <= set(spans)
        assert len(spans) == sum(map(len, want.values())) + got[d]["n_added"]
        for k, s, e in (x.split(":") for x in spans):
            assert text[int(s) : int(e)] not in got[d]["redacted"] or k == "phone"


def test_other_forms_are_found_and_plain_numbers_left(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    redactor = pii.learn(docs)
    assert set(redactor.bounds) >= {"phone", "card", "email"}

    def added(text):
        return redactor.added(text, pii.base(text))

    assert added("some words (724) 555-7058 and more words")["phone"] == [(11, 25)]
    assert added("write to janed.29 at mail3 dot example dot com today")["email"]
    plain = ["in 2024-01-02 it was", "version 1.2.3.4.5 of it", "about 123456789 people", "pi is 3.14159265", "items 1001 1002 1003 1004"]
    assert all(not any(added(t).values()) for t in plain)


def test_trees_learn_a_rule_and_their_chances_are_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5)).astype(float)
    p = pii.Trees().fit(x[:2000], y[:2000]).chance(x[2000:])
    assert np.mean((p > 0.5) == y[2000:]) > 0.98 and np.mean((p - y[2000:]) ** 2) < 0.02


def test_long_runs_take_linear_time():
    n = 300_000
    begin = time.time()
    for text in ("a" * n, "1" * n, "1." * n, "+1" + " " * n, "a@" * (n // 2), "1 " * 20_000, "(at)" * 20_000):
        pii.base(text)
        list(pii.proposals(text))
    assert time.time() - begin < 60


def test_awkward_rows(spark):
    rows = pii.find(documents(spark, [*AWKWARD, (20, "mail a@b.c now"), (20, "mail a@b.c now")], extra=True)).collect()
    assert len(rows) == len(AWKWARD) + 2
    empty = hashlib.sha256(b"").hexdigest()
    got = {r["doc_id"]: r for r in rows}
    assert got[1]["base_sha256"] == empty and got[1]["redacted"] is None and got[2]["redacted"] == ""
    assert got[20]["redacted"] == "mail [email] now" and got[20]["spans"] == "email:5:10"
    assert pii.find(documents(spark, [])).count() == 0


def test_numbers_of_many_groups_are_proposed():
    for number in ("0033 6 12 34 56 78", "00 33 6 12 34 56 78", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"):
        text = f"call {number} now"
        kinds = {k for k, s, e in pii.proposals(text) if text[s:e] == number}
        assert kinds and kinds <= {"phone", "card"}


def test_spelled_out_addresses_are_proposed_whatever_else_is_there():
    for address in ("jane7 at example (dot) com", "jane7 at example.com", "jane7(at)example dot com"):
        for more in ("", " and me@there.org"):
            text = f"write to {address}{more}"
            assert address in {text[s:e] for k, s, e in pii.proposals(text) if k == "email"}


def test_long_lists_of_numbers_stay_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_CANDIDATES", 300)
    text = " ".join(f"call +1 202 555 {i:04} or 10.0.{i % 250}.{i % 7}" for i in range(2000))
    rows = [(i, text + f" note {i}", "en", "a") for i in range(6)]
    got = pii.find(documents(spark, rows)).collect()
    assert {(r["n_phone"], r["n_ip"]) for r in got} == {(2000, 2000)}
