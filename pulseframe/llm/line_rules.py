"""Line-first cleaning: rules for single lines, then a verdict on what is left of the document.

A text is cut at line breaks, and every line with a word is held against three kinds of rules:

- punctuation: it ends fewer than one sentence in ``WORDS_A_SENTENCE`` words, or many of its words
  carry symbols or end in doubled marks;
- navigation: a fifth of its words, or more, are separators alone, as in menus and link bars;
- boilerplate: it repeats an earlier line, or is short and holds a stock phrase of web pages.

The first rule that fails removes the line. A document that loses more than half of the characters
of its words is rejected, and so is one that fails the document rules (too few words, or most of
them in repeated windows). All rules are about the document alone, so nothing is shuffled, and a
repeated document gets one verdict however often it occurs.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_WORDS = 50
WINDOW = 3
MOST_REPEATED = 50  # percent of the words in repeated windows
MOST_LOST = 50  # percent of the characters of words in removed lines
WORDS_A_SENTENCE = 100
MOST_MARKED = 30  # percent of a line's words with symbols, or with doubled marks
LEAST_SEPARATORS = 20  # percent of a line's words that are separators alone
PHRASE_WORDS = 30  # a stock phrase counts in lines of so many words at most

WHITE = "\x20\x09-\x0d"
SYMBOLS = "#*$%&|<>"
_END = rf"[.!?…。！？][\"'”’»)\]]*(?=[{WHITE}]|\Z)"
_DOUBLED = rf"(?<![!?])[!?]{{2,}}(?=[{WHITE}]|\Z)"
_SEPARATOR = rf"(?<![^{WHITE}])[|»›>•·/\\]+(?![^{WHITE}])"
_SYMBOL_WORD = rf"[{SYMBOLS}][^{WHITE}]*"
PHRASES = (
    "all rights reserved",
    "cookie policy",
    "uses cookies",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "terms of service",
    "terms of use",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "click here to",
    "licensed under the",
    "released under the",
)
_PATTERNS = {k: re.compile(p) for k, p in (("end", _END), ("doubled", _DOUBLED), ("separator", _SEPARATOR), ("symbol", _SYMBOL_WORD))}
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)))
RULES = ("punctuation", "navigation", "boilerplate")

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_lines long, n_punctuation long, n_navigation long, n_boilerplate long, lost_chars long, kept boolean, cleaned string"
)


def word_chars(text: str) -> int:
    """Characters outside white space."""
    return len(text) - sum(map(text.count, "\x20\x09\x0a\x0b\x0c\x0d"))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    grams = ids[:n]
    for i in range(1, window):
        # Numbers of the shorter windows stay below n, so the pairs are distinct and small enough.
        grams = np.unique(grams * len(numbers) + ids[i : i + n], return_inverse=True)[1]
    again = np.bincount(grams)[grams] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(window):
        covered[i : i + n] |= again
    return int(covered.sum())


def failed_rule(line: str, n_words: int, seen: bool) -> str | None:
    """The first rule that a line of ``n_words`` words fails; ``seen`` if an earlier line equals it."""
    count = {k: len(p.findall(line)) for k, p in _PATTERNS.items()}
    if 100 * count["separator"] >= LEAST_SEPARATORS * n_words:
        return "navigation"
    marked = max(count["symbol"], count["doubled"])
    if count["end"] * WORDS_A_SENTENCE < n_words or 100 * marked > MOST_MARKED * n_words:
        return "punctuation"
    if seen or (n_words <= PHRASE_WORDS and _PHRASE.search(line.lower())):
        return "boilerplate"
    return None


def judged(text: str | None) -> tuple:
    """The values of ``COLUMNS`` for one text."""
    lines = (text or "").split("\n")
    words: list[bytes] = []
    earlier: set[str] = set()
    removed = dict.fromkeys(RULES, 0)
    left, n_lines, n_dup, lost = [], 0, 0, 0
    for line in lines:
        own = line.encode().split()  # bytes are cut at the six ASCII white-space characters alone
        failed = None
        if own:
            seen = line in earlier
            n_lines += 1
            n_dup += seen
            words += own
            failed = failed_rule(line, len(own), seen)
        earlier.add(line)
        if failed:
            removed[failed] += 1
            lost += word_chars(line)
        else:
            left.append(line)
    chars = word_chars(text or "")
    repeated = repeated_words(words)
    base_failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    kept = not base_failed and 100 * lost <= MOST_LOST * chars
    symbols = sum(map((text or "").count, SYMBOLS))
    cleaned = None if text is None else "\n".join(left)
    return (len(words), chars, symbols, n_dup, repeated, base_failed, n_lines, *removed.values(), lost, kept, cleaned)


def _judge(batches):
    types = [pa.int64()] * 5 + [pa.bool_()] + [pa.int64()] * 5 + [pa.bool_(), pa.string()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    for batch in batches:
        rows = [judged(t.as_py()) for t in batch.column(1)]
        columns = list(zip(*rows)) if rows else [()] * len(types)
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, types)], names=["id", *names])


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COLUMNS`` for every row of ``docs``.

    ``cleaned`` is the text without the removed lines; lines without a word stay. A null text has
    no words and stays null; it, an empty text and one of white space fail the document rules, so
    they are not kept. Lines are equal only character by character; the first of equal lines is not
    a repetition. Repeated rows are rows of their own, other columns are ignored, and an empty
    table gives an empty result. Texts are read whole, whatever their length.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([slim.schema["id"], *T.StructType.fromDDL(COLUMNS).fields])
    return slim.mapInArrow(_judge, schema).withColumnRenamed("id", id_col)


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs``, all their columns, with the failing lines taken out of the text.

    Null, empty and blank texts are not kept; repeated rows are each kept; an empty table stays empty.
    """
    inner = docs.withColumnsRenamed({c: f"_{i}" for i, c in enumerate(docs.columns)})
    at = docs.columns.index(text_col)
    other = [f"_{i}" for i in range(len(docs.columns)) if i != at]
    packed = inner.select(F.struct(*other, F.lit(1).alias("_one")).alias("rest"), F.col(f"_{at}").alias("text"))
    rows = line_rules(packed, "rest", "text").filter("kept")
    columns = [F.col("cleaned") if i == at else F.col(f"rest._{i}") for i in range(len(docs.columns))]
    return rows.select(*[c.alias(name) for c, name in zip(columns, docs.columns)])


def oracle(table: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    """SQL of the registered query's columns over ``table``."""
    quoted = ", ".join(f"'{p}'" for p in PHRASES)
    word = "[^\\x20\\x09-\\x0D]+"
    end = """[.!?…。！？]["''”’»)\\]]*$"""
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, {id_col} AS id, coalesce({text_col}, '') AS t FROM {table}),
word AS (SELECT r, generate_subscripts(w, 1) AS i, unnest(w) AS w FROM (SELECT r, regexp_extract_all(t, '{word}') AS w FROM doc)),
gram AS (SELECT r, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM word WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM gram WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT i + d) AS n FROM again, (VALUES (0), (1), (2)) s(d) GROUP BY r),
line AS (SELECT r, generate_subscripts(x, 1) AS i, unnest(x) AS x FROM (SELECT r, string_split(t, chr(10)) AS x FROM doc)),
said AS (
    SELECT r, x, words, len(words) AS n, row_number() OVER (PARTITION BY r, x ORDER BY i) > 1 AS seen,
        len(array_to_string(words, '')) AS chars
    FROM (SELECT *, regexp_extract_all(x, '{word}') AS words FROM line) WHERE len(words) > 0
),
ruled AS (
    SELECT *,
        100 * len(list_filter(words, lambda w: regexp_full_match(w, '[|»›>•·/\\\\]+'))) >= {LEAST_SEPARATORS} * n AS navigation,
        {WORDS_A_SENTENCE} * len(list_filter(words, lambda w: regexp_matches(w, '{end}'))) < n
            OR 100 * len(list_filter(words, lambda w: regexp_matches(w, '[{SYMBOLS}]'))) > {MOST_MARKED} * n
            OR 100 * len(list_filter(words, lambda w: regexp_matches(w, '[!?][!?]$'))) > {MOST_MARKED} * n AS punctuation,
        seen OR n <= {PHRASE_WORDS} AND len(list_filter([{quoted}], lambda p: contains(lower(x), p))) > 0 AS boilerplate
    FROM said
),
lines AS (
    SELECT r, sum(n) AS n_words, sum(chars) AS word_chars, count(*) AS n_lines, count(*) FILTER (seen) AS n_dup_lines,
        count(*) FILTER (navigation) AS n_navigation, count(*) FILTER (punctuation AND NOT navigation) AS n_punctuation,
        count(*) FILTER (boilerplate AND NOT punctuation AND NOT navigation) AS n_boilerplate,
        coalesce(sum(chars) FILTER (navigation OR punctuation OR boilerplate), 0) AS lost_chars
    FROM ruled GROUP BY r
),
every AS (
    SELECT id, t, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_punctuation, 0) AS n_punctuation,
        coalesce(n_navigation, 0) AS n_navigation, coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(lost_chars, 0) AS lost_chars
    FROM doc LEFT JOIN lines USING (r) LEFT JOIN covered c USING (r)
)
SELECT id AS {id_col}, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(len(t) - len(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
    n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed, n_lines, n_punctuation, n_navigation, n_boilerplate,
    CAST(lost_chars AS BIGINT) AS lost_chars,
    NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND 100 * lost_chars <= {MOST_LOST} * word_chars AS kept
FROM every
"""
