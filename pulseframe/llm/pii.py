"""Personal data in whole texts: fixed base patterns, and boosted trees over looser candidates.

Base spans are decided by the patterns alone. Generators of high recall propose further, overlapping
spans (digits in any grouping, parts of longer runs of digits, spelled-out mail addresses); trees
score each by its format and its surroundings, and those that reach their kind's calibrated threshold
and touch no base span are added, best first.

The trees learn from a bounded sample of documents: base spans, and the same data written in other
common forms, against proposals that are neither and against numbers that only look alike (dates,
versions, failing checksums, plain counts). A held-out half of the sample sets the thresholds.

Every pattern starts where a run of its characters starts, so a text is read in linear time.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# At most so many documents, smallest hash first among those with a digit group or an address, fit the trees.
SAMPLE_DOCS = 3000
# Of their labelled candidates, at most so many, smallest hash first.
SAMPLE_CANDIDATES = 200_000
PRECISION = 0.995

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_RUN = re.compile(r"(?<![0-9])[+(]?[0-9](?:[ ().\-/]{0,2}[0-9])+")
_SPELLED = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64} ?(?:\(at\)|\[at\]|@| at ) ?[\w-]{1,64}(?: ?(?:\(dot\)|\[dot\]|\.| dot ) ?[\w-]{1,64}){1,5}")
_AT_SIGNS = ("@", "(at)", "[at]", " at ")  # every spelled-out address has one
# Words that announce a kind, in the languages at hand; fixed values.
_WORDS = {
    "email": re.compile(r"mail|contact|correo|courriel|kontakt", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse|addr", re.I),
    "card": re.compile(r"card|visa|master|credit|carte|karte|tarjeta", re.I),
    "phone": re.compile(r"phone|\btel|call|fax|mobile|handy|llama", re.I),
}
_AROUND = 40

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_emails(text: str) -> list[Span]:
    """Every address stands around an ``@``: its local part is the run of allowed characters before it."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, end))
        else:
            end = max(end, at + 1)  # no match contains this sign
        at = text.find("@", max(at + 1, end))
    return out


def base_ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split("."))]


def base_cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def base_phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m.group())) <= 15]


def base(text: str) -> dict[str, list[Span]]:
    """The base spans of each kind, in order."""
    digits = _DIGITS.search(text) is not None
    return {
        "email": base_emails(text) if "@" in text else [],
        "ip": base_ips(text) if digits else [],
        "card": base_cards(text) if digits else [],
        "phone": base_phones(text) if digits and "+" in text else [],
    }


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidate spans of each kind, overlapping, each once."""
    seen = set()

    def new(kind: str, start: int, end: int) -> bool:
        fresh = (kind, start, end) not in seen
        seen.add((kind, start, end))
        return fresh

    if any(sign in text for sign in _AT_SIGNS):
        for m in _SPELLED.finditer(text):
            if new("email", *m.span()):
                yield "email", *m.span()
    if not _DIGITS.search(text):
        return
    for m in _RUN.finditer(text):
        if m.end() - m.start() < 7:
            continue
        pieces = [(m.start() + p.start(), m.start() + p.end()) for p in re.finditer(r"[^ ]+", m.group())]
        for i in range(len(pieces)):
            for j in range(i, len(pieces)):  # every piece has a digit
                start, end = pieces[i][0], pieces[j][1]
                part = text[start:end]
                n = len(_DIGITS.findall(part))
                if n > 19:
                    break
                if part.count(".") == 3 and new("ip", start, end):
                    yield "ip", start, end
                if 7 <= n <= 15 and new("phone", start, end):
                    yield "phone", start, end
                if 13 <= n <= 19 and new("card", start, end):
                    yield "card", start, end


def _side(c: str) -> float:
    return 0.0 if not c or c.isspace() else 1.0 if c.isalpha() else 2.0 if c.isdigit() else 3.0


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and what surrounds it."""
    part = text[start:end]
    groups = re.findall(r"[0-9]+", part)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, start - _AROUND) : start], text[end : end + _AROUND]
    around = before + after
    return [
        float(KINDS.index(kind)), float(len(part)), float(len(digits)), float(sum(c.isalpha() for c in part)), float(len(groups)),
        _side(part[0]), float(part[0] == "+"), float("(" in part), float(part.count("-")), float(part.count(".")), float(part.count(" ")), float(part.count("/")),
        float(luhn(digits)) if digits else 0.0, float(max(sizes)), float(min(sizes)), float(sizes[0]), float(sizes[-1]),
        float(min(max([int(g[-9:]) for g in groups] or [0]), 10**6)), float("@" in part), float(" at " in part or "at)" in part or "at]" in part),
        float(" dot " in part or "dot)" in part or "dot]" in part), float(len(re.split(r"\W+", part)[-1])),
        _side(text[start - 1 : start]), _side(text[end : end + 1]),
        *[float(bool(_WORDS[k].search(around))) for k in KINDS],
        sum(c.isdigit() for c in around) / max(1, len(around)),
    ]


def variants(kind: str, part: str) -> list[tuple[str, str, float]]:
    """Other forms of a base span, and look-alikes made from its digits: ``(kind, text, label)``."""
    digits = "".join(re.findall(r"[0-9]", part))
    if kind == "email":
        local, _, domain = part.partition("@")
        return [
            ("email", f"{local} at {domain.replace('.', ' dot ')}", 1.0),
            ("email", f"{local}[at]{domain.replace('.', '[dot]')}", 1.0),
            ("email", f"{local} (at) {domain}", 1.0),
            ("email", f"{local} at {domain.split('.')[0]}.The", 0.0),
        ]
    if kind == "phone":
        d = digits[-10:]
        if len(d) < 10:
            return []
        return [
            ("phone", f"({d[:3]}) {d[3:6]}-{d[6:]}", 1.0), ("phone", f"{d[:3]}-{d[3:6]}-{d[6:]}", 1.0), ("phone", f"{d[:3]}.{d[3:6]}.{d[6:]}", 1.0),
            ("phone", d, 0.0), ("phone", d[:8], 0.0), ("phone", f"20{d[:2]}-0{d[2]}-1{d[3]}", 0.0), ("phone", f"{d[:4]} {d[4:8]}", 0.0),
            ("phone", f"{d[:2]}/{d[2:4]}/{d[4:8]}", 0.0), ("phone", f"{d[:3]} {d[3:5]} {d[5:7]}", 0.0), ("phone", f"{d[:1]}.{d[1:9]}", 0.0),
        ]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 5) % 10)
        return [
            ("card", ".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), 1.0), ("card", "/".join(digits[i : i + 4] for i in range(0, len(digits), 4)), 1.0),
            ("card", wrong, 0.0), ("card", " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), 0.0), ("card", digits[1:] + "0", 0.0 if not luhn(digits[1:] + "0") else 1.0),
        ]
    a = part.split(".")
    return [("ip", f"{int(a[0][-3:]) + 256}.{a[1]}.{a[2]}.{a[3]}", 0.0), ("ip", f"{a[0]}.{a[1]}.{a[2]}.{a[3]}.{a[1]}", 0.0), ("ip", f"{a[0]}.{a[1]}.{a[2]}.{int(a[3][-3:]) + 300}", 0.0)]


def examples(text: str) -> Iterator[tuple[str, float, list[float]]]:
    """Labelled candidates of a text."""
    found = base(text)
    spans = {(k, *s) for k in KINDS for s in found[k]}
    for k, s, e in spans:
        yield k, 1.0, features(text, k, s, e)
        for kind, form, label in variants(k, text[s:e]):
            yield kind, label, features(text[max(0, s - _AROUND) : s] + form + text[e : e + _AROUND], kind, min(s, _AROUND), min(s, _AROUND) + len(form))
    for k, s, e in proposals(text):
        if (k, s, e) not in spans:
            inside = any(k == x and bs <= s and e <= be for x, bs, be in spans)
            if not inside:  # part of a base span is neither right nor wrong
                alone = (0, e - s) in base(text[s:e])[k]  # a whole one that only its neighbours hide from the patterns
                yield k, float(alone), features(text, k, s, e)


class Trees:
    """Gradient boosted trees for a yes-or-no question: logistic loss, splits at quantiles."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.start, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) if len(c) else np.empty(0) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1) if len(x) else x
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, value = self._grow(binned, cuts, p - y, p * (1 - p))
            self.trees.append(tree)
            score += value
        return self

    def _grow(self, binned, cuts, gradient, curve):
        nodes = 2 ** (self.depth + 1) - 1
        column, cut, leaf = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        at = np.zeros(len(gradient), dtype=np.int64)
        for node in range(nodes):
            own = np.flatnonzero(at == node)
            if not len(own):
                continue
            g, h = gradient[own], curve[own]
            leaf[node] = -self.rate * g.sum() / (h.sum() + self.least)
            if 2 * node + 2 >= nodes:
                continue
            best = 1e-6
            for c, own_cuts in enumerate(cuts):
                if not len(own_cuts):
                    continue
                b = binned[own, c]
                lg = np.cumsum(np.bincount(b, g, len(own_cuts) + 1))[:-1]
                lh = np.cumsum(np.bincount(b, h, len(own_cuts) + 1))[:-1]
                gain = lg**2 / (lh + self.least) + (g.sum() - lg) ** 2 / (h.sum() - lh + self.least) - g.sum() ** 2 / (h.sum() + self.least)
                i = int(np.argmax(gain))
                if gain[i] > best and lh[i] > 1e-6 and h.sum() - lh[i] > 1e-6:
                    best, column[node], cut[node] = gain[i], c, own_cuts[i]
                    right = b > i
            if column[node] >= 0:
                at[own] = 2 * node + 1 + right
        return (column, cut, leaf), leaf[at]

    def chance(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for column, cut, leaf in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                inner = column[at] >= 0
                right = x[np.arange(len(x)), np.maximum(column[at], 0)] > cut[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            score += leaf[at]
        return 1 / (1 + np.exp(-score))


class Redactor:
    """The trees, and for each kind the least chance at which an added span is right often enough."""

    def __init__(self, trees: Trees, bounds: dict[str, float]):
        self.trees, self.bounds = trees, bounds

    def added(self, text: str, found: dict[str, list[Span]]) -> dict[str, list[Span]]:
        """Spans beyond the base ones that reach their threshold and overlap no other span."""
        out: dict[str, list[Span]] = {k: [] for k in KINDS}
        taken: list[Span] = []  # without overlaps, in order
        for s, e in sorted(s for k in KINDS for s in found[k]):
            if taken and s < taken[-1][1]:
                taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
            else:
                taken.append((s, e))

        def free(s: int, e: int) -> bool:
            at = bisect_left(taken, (e, 0))  # the last one that starts before e
            return not at or taken[at - 1][1] <= s

        some = [p for p in proposals(text) if p[0] in self.bounds and free(p[1], p[2])]
        if some:
            chance = self.trees.chance(np.array([features(text, *p) for p in some]))
            for c, (k, s, e) in sorted(zip((-chance).tolist(), some), key=lambda r: (r[0], r[1][1] - r[1][2], r[1])):
                if -c >= self.bounds[k] and free(s, e):
                    out[k].append((s, e))
                    insort(taken, (s, e))
        return {k: sorted(v) for k, v in out.items()}


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_DOCS) -> Redactor:
    """A redactor fitted on ``most`` documents, and ``SAMPLE_CANDIDATES`` of their candidates, at the most; without examples of a kind none is added."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    likely = rows.filter(F.col("text").rlike(r"@|[0-9][0-9 ().+-]{5}")).select("id", F.xxhash64(F.lit("pii"), "id").alias("h"))
    ids = likely.distinct().orderBy("h", "id").limit(most)

    def run(batches):
        for batch in batches:
            kinds, labels, folds, xs = [], [], [], []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k, y, x in examples(text.as_py()):
                    kinds.append(k), labels.append(y), folds.append(h % 2), xs.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(labels, pa.float64()), pa.array(folds, pa.int32()), pa.array(xs, pa.list_(pa.float64()))], names=["kind", "label", "fold", "x"])

    # Equal candidates count once; a long list of numbers has more than the model needs.
    sample = rows.join(F.broadcast(ids), "id").select("h", "text").mapInArrow(run, "kind string, label double, fold int, x array<double>")
    own = ["kind", "label", "fold", "x"]
    some = sample.groupBy(*own).count().orderBy(F.xxhash64(*own), *own).limit(SAMPLE_CANDIDATES)
    frame = some.toPandas().sort_values(own, key=lambda c: c.map(str))
    if frame.empty:
        return Redactor(Trees().fit(np.empty((0, 1)), np.empty(0)), {})
    x, y = np.array(frame["x"].tolist()), frame["label"].to_numpy()
    first = frame["fold"].to_numpy() == 0
    trees = Trees().fit(x[first], y[first])
    chance, bounds = trees.chance(x[~first]), {}
    for k in KINDS:
        own = frame["kind"].to_numpy()[~first] == k
        c, t = chance[own], y[~first][own]
        order = np.argsort(-c, kind="stable")
        right = np.cumsum(t[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero((right >= PRECISION) & (np.append(np.diff(c[order]), -1) < 0))
        if len(good) and t.sum():
            bounds[k] = max(0.9, float(c[order][good[-1]]))
    return Redactor(trees, bounds)


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redactor: Redactor | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, redacted`` of every row.

    The counts and ``base_sha256`` are of the base spans; ``spans`` are all, ``kind:start:end`` in code
    points with an exclusive end, by kind and start; ``redacted`` is the text with every span replaced
    by its kind in brackets. A null text is an empty one, ``redacted`` then null. Repeated rows are
    rows of their own. An empty table gives an empty result.
    """
    redactor = redactor or learn(docs, id_col, text_col)

    def run(batches):
        own = redactor
        for batch in batches:
            counts, digests, spans, added, texts = {k: [] for k in KINDS}, [], [], [], []
            for value in batch.column(1):
                text = value.as_py()
                found = base(text or "")
                more = own.added(text or "", found)
                every = {k: sorted(found[k] + more[k]) for k in KINDS}
                for k in KINDS:
                    counts[k].append(len(found[k]))
                digests.append(hashlib.sha256(joined(found).encode()).hexdigest())
                spans.append(joined(every))
                added.append(sum(map(len, more.values())))
                if text is not None:
                    out, end = [], 0
                    for s, e, k in sorted((s, e, k) for k in KINDS for s, e in every[k]):
                        if s >= end:
                            out += [text[end:s], f"[{k}]"]
                        end = max(end, e)
                    text = "".join([*out, text[end:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(digests), pa.array(spans), pa.array(added, pa.int64()), pa.array(texts, pa.string())],
                names=[id_col, *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "redacted"],
            )

    slim = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = slim.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, redacted string"
    return slim.mapInArrow(run, schema)
