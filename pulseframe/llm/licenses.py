"""Licences of files: sparse TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

Templates are one-line notices, headers of source files, and whole licences. A file is compared with them
as single lines, as blocks (lines up to one without a word, such as the paragraphs of a header) and as a whole; a long
line is also compared in windows as long as a short template, laid where one of the template's heavy words stands.
A vector has a weight for each of its words: one and the logarithm of how often it stands there, times how rare it is
among the templates. What reaches the cosine ``least`` with a template is a notice of the most similar one.
Only texts that can reach it are looked at word by word: without one of a template's
heaviest words the rest of its weights is too short, so a pattern of these words finds all of them.

A file's licence is that of its best notice. A file without one inherits from the nearest directory
above it that holds a licence file: a file with such a name, one that is a notice as a whole, or one of notices alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import drop_stored, store

LEAST = 0.6
# Templates of so many words are looked for within longer lines; longer ones are headers and texts.
WINDOW_WORDS = 30
IDENTIFIER = "SPDX-License-Identifier"
RESERVED = "Proprietary"  # counts where there is no other notice
# A file that is so similar to a longer template is a licence file, whatever its name.
WHOLE = 0.9
# Licence notices, headers and texts, fixed values.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0"),
    ("Proprietary", "All rights reserved"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "MIT",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
        "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
        "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "GPL-3.0",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim "
        "copies of this license document, but changing it is not allowed.",
    ),
    (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
)
# Base names of licence files, fixed values.
LICENSE_FILES = r"(?i)^(license|licence|copying|unlicense)([.-][^/]*)?$"
_BREAK = "[^a-z0-9]+"
_BLANK = r"\n(?:[^A-Za-z0-9\n]*\n)+"  # lines without a word
# Words of any sentence, which say little about a licence; fixed values.
ORDINARY = frozenset(
    "a above all also an and any anyone appear are as at be but by c can do even everyone except following for form from has have if in into is it"
    " its may must neither no non nor not of on one or other our person prior shall so some such that the their these this to under use used v was"
    " we whether which whatsoever will with without work you your".split()
)
ORDINARY_RARITY = 0.3
# Words that many other texts have as well: a pattern takes them last; fixed values.
PLAIN = frozenset("binary cc code file files forms free general http https language later library list met mit name names only org program sa see source subject version way www".split())


def words_of(text: str) -> list[str]:
    return [w for w in re.split(_BREAK, text.lower()) if w]


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), _BREAK), lambda w: w != "")


def rarity(templates: tuple[tuple[str, str], ...]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' words, and of any other word; ordinary words have a low one."""
    families: dict[int, set[str]] = {}  # identifiers are one text, written out for each licence
    for i, (_, t) in enumerate(templates):
        families.setdefault(-1 if t.startswith(IDENTIFIER) else i, set()).update(words_of(t))
    seen = Counter(w for said in families.values() for w in said)
    n = len(families)
    return {w: math.log((1 + n) / (1 + c)) + 1 for w, c in seen.items()} | dict.fromkeys(ORDINARY, ORDINARY_RARITY), math.log(1 + n) + 1


def weights(templates: tuple[tuple[str, str], ...]) -> list[tuple[int, str, str, float]]:
    """``(template, licence, word, weight)``, the weights of a template of length one."""
    idf, _ = rarity(templates)
    out = []
    for i, (name, text) in enumerate(templates):
        raw = {w: (1 + math.log(n)) * idf[w] for w, n in Counter(words_of(text)).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out += [(i, name, w, x / norm) for w, x in sorted(raw.items())]
    return out


def _anchors_of(template: int, templates: tuple[tuple[str, str], ...], least: float) -> list[str]:
    """Words of a template of which any text of cosine ``least`` to it has one: the heaviest, plain ones last, until the rest is too short."""
    out = []
    rows = [(x, w) for i, _, w, x in weights(templates) if i == template]
    rest = sum(x * x for x, _ in rows)
    for x, w in sorted(rows, key=lambda r: (r[1] in ORDINARY, r[1] in PLAIN or r[1].isdigit(), -r[0], r[1])):
        if math.sqrt(max(0.0, rest)) < least - 1e-9:
            break
        out.append(w)
        rest -= x * x
    return out


def anchors(templates: tuple[tuple[str, str], ...], least: float) -> list[str]:
    """Words of which any text of cosine ``least`` to some template has one."""
    return sorted({w for i in range(len(templates)) for w in _anchors_of(i, templates, least)})


def any_of(words_: list[str]) -> str:
    """A pattern of the words that shares their beginnings, so a text tries few alternatives at each place."""
    tree: dict = {}
    for w in words_:
        at = tree
        for c in w:
            at = at.setdefault(c, {})
        at[""] = {}

    def text(at: dict) -> str:
        parts = [c + text(at[c]) for c in sorted(at) if c]
        if not parts:
            return ""
        inner = parts[0] if len(parts) == 1 and "" not in at else f"(?:{'|'.join(parts)})"
        return inner + "?" if "" in at else inner

    return rf"(?i)(?<![a-z0-9]){text(tree)}(?![a-z0-9])" if words_ else "(?!)"


def short_anchors(templates: tuple[tuple[str, str], ...], least: float) -> list[tuple[str, int, int, int]]:
    """``(word, template, offset, words)``: where the heavy words of short templates stand in them."""
    out = []
    for i, (_, text) in enumerate(templates):
        said = words_of(text)
        if len(said) <= WINDOW_WORDS:
            heavy = set(_anchors_of(i, templates, least))
            out += [(w, i, at, len(said)) for at, w in enumerate(said) if w in heavy]
    return out


def _long(templates: tuple[tuple[str, str], ...]) -> list[int]:
    return [i for i, (_, text) in enumerate(templates) if len(words_of(text)) > WINDOW_WORDS]


def _unit_lists(text: Column) -> Column:
    """Lines, blocks of several lines, and the whole of a text of several lines, as ``unit, no, content``."""

    def numbered(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("unit"), i.alias("no"), x.alias("content")))

    lines, blocks = numbered("line", F.split(text, "\n")), numbered("block", F.split(text, _BLANK))
    several = F.filter(blocks, lambda b: (F.instr(b["content"], "\n") > 0) & (F.size(blocks) > 1))
    whole = F.when(F.instr(text, "\n") > 0, numbered("file", F.array(text))).otherwise(F.slice(lines, 1, 0))
    return F.concat(lines, several, whole)


def _dots(said: DataFrame, keys: list[str], templates, by: str | None = None) -> DataFrame:
    """``keys, template, cosine`` of the bags of ``said(keys, word)``; with ``by``, each with the template that column names alone."""
    spark = said.sparkSession
    idf, other = rarity(templates)
    rare = spark.createDataFrame(sorted(idf.items()), "word string, idf double")
    table = spark.createDataFrame([(i, w, x) for i, _, w, x in weights(templates)], "template int, word string, w double")
    counted = said.groupBy(*keys, "word").agg(F.count("*").alias("n"))
    weighed = counted.join(F.broadcast(rare), "word", "left").withColumn("x", (F.log("n") + 1) * F.coalesce("idf", F.lit(other)))
    dot, norm = F.sum(F.col("x") * F.coalesce("w", F.lit(0.0))), F.sqrt(F.sum(F.col("x") * F.col("x")))
    if by:
        one = weighed.join(F.broadcast(table.withColumnRenamed("template", by)), ["word", by], "left")  # the templates' words, some thousand rows
        return one.groupBy(*keys).agg(dot.alias("dot"), norm.alias("norm")).select(*keys, F.col(by).alias("template"), F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
    hit = weighed.join(F.broadcast(table), "word").groupBy(*keys, "template").agg(dot.alias("dot"))
    lengths = weighed.groupBy(*keys).agg(norm.alias("norm"))
    return hit.join(lengths, keys).select(*keys, "template", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))


def _whole_units(files: DataFrame, templates, least: float) -> DataFrame:
    """``path, unit, no, c, template, cosine`` of units as they are."""
    idf, other = rarity(templates)
    pattern = any_of(anchors(templates, least))
    units = (
        files.filter(F.col("text").rlike(pattern))
        .select("path", F.inline(_unit_lists(F.col("text"))))
        .filter(F.col("content").rlike(pattern))
    )
    # What a unit's words can add to a product at most, against the least length of one with so many others.
    heavy = sorted(set(idf) - ORDINARY)
    reach = {of: max([idf[w] * x for _, _, w, x in weights(templates) if (w in ORDINARY) == of], default=0.0) for of in (True, False)}
    said = words(F.col("content"))
    n_heavy = F.size(F.filter(said, lambda w: w.isin(*heavy)))
    n_ordinary = F.size(F.filter(said, lambda w: w.isin(*ORDINARY)))
    others = F.size(F.array_distinct(F.filter(said, lambda w: ~w.isin(*heavy, *ORDINARY))))
    units = units.filter(n_heavy * reach[False] + n_ordinary * reach[True] >= F.sqrt(others) * (least * other) - 1e-9).distinct()
    keys = ["path", "unit", "no", "c"]
    # What is worked out beside an explode is worked out for every row it makes; so first, and then explode.
    bags = units.select("path", "unit", "no", F.xxhash64("content").alias("c"), said.alias("said"))
    return _dots(bags.select(*keys, F.explode("said").alias("word")), keys, templates)


def _windows(files: DataFrame, templates, least: float) -> DataFrame:
    """``path, unit, no, c, template, cosine`` of long lines: windows as long as a short template, where it has a heavy word."""
    spark = files.sparkSession
    places = short_anchors(templates, least)
    pattern = any_of(sorted({p[0] for p in places}))
    lines = files.filter(F.col("text").rlike(pattern)).select("path", F.posexplode(F.split("text", "\n")).alias("no", "content")).filter(F.col("content").rlike(pattern)).distinct()
    said = words(F.col("content"))
    own = ["path", "no", "c"]
    bags = lines.select("path", "no", F.xxhash64("content").alias("c"), F.size(said).alias("size"), said.alias("said"))
    bags = bags.filter(F.col("size") > min([n for _, _, _, n in places], default=0))
    rows = store(bags.select(*own, "size", F.posexplode("said").alias("pos", "word")), "said")
    heavy = spark.createDataFrame(places, "word string, t int, offset int, words int")
    hits = rows.join(F.broadcast(heavy), "word").filter("size > words").select(*own, "t", (F.col("pos") - F.col("offset")).alias("start"), "words").distinct()
    at = F.explode(F.sequence(F.greatest("start", F.lit(0)), F.col("start") + F.col("words") - 1)).alias("pos")
    bags = hits.filter("start + words > 0").select(*own, "t", "start", at).join(rows.select(*own, "pos", "word"), [*own, "pos"]).select(*own, "t", "start", "word")
    found = _dots(bags, [*own, "t", "start"], templates, "t").filter(F.col("cosine") >= least)
    found = store(found.groupBy(*own, "template").agg(F.max("cosine").alias("cosine")), "windows")
    drop_stored(rows)
    return found.select("path", F.lit("line").alias("unit"), "no", "c", "template", "cosine")


def notices(files: DataFrame, path_col: str, text_col: str, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``path, unit, no, licence, template, cosine`` of every line, block or whole file that is a notice."""
    slim = files.filter(F.col(path_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    found = _whole_units(slim, templates, least).unionByName(_windows(slim, templates, least)).filter(F.col("cosine") >= least)
    top = F.max(F.struct("cosine", (-F.col("template")).alias("t"))).alias("top")
    names = F.array(*[F.lit(n) for n, _ in templates])
    best = found.groupBy("path", "unit", "no", "c").agg(top).withColumn("template", -F.col("top.t"))
    return best.select("path", "unit", "no", F.element_at(names, F.col("template") + 1).alias("licence"), "template", F.col("top.cosine").alias("cosine"))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``path, licence, origin, cosine, n_notices, unit`` for every distinct path of ``files``.

    ``origin`` is ``own``, ``inherited`` or null; the licence of an inherited row has no cosine of its
    own. ``n_notices`` counts lines that are notices, ``unit`` is what the best notice is: a line, block or the file. Ties of cosine go to the template listed first. A null or empty text has no notice; a path
    that stands in several rows is one file with all their lines; rows with a null path are left
    out. An empty table gives an empty result.
    """
    rows = files.filter(F.col(path_col).isNotNull()).select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    # Two narrow facts of a file besides its notices: its directory, and how many lines say something.
    said = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x) != ""))
    slim = rows.groupBy("path").agg(F.sum(said).alias("lines"))
    slim = slim.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1))
    found = notices(rows, "path", "text", templates, least)
    # Rights may be reserved beside a licence that grants some.
    top = F.max(F.struct((F.col("licence") != RESERVED).alias("grants"), "cosine", (-F.col("template")).alias("t"), "unit", "licence")).alias("top")
    whole = (F.col("unit") == "file") & (F.col("cosine") >= WHOLE) & F.col("template").isin(_long(templates))
    own = found.groupBy("path").agg(F.count_if(F.col("unit") == "line").alias("n_notices"), F.bool_or(whole).alias("whole"), top)
    known = slim.join(own, "path", "left").select(
        "path", "dir", "name", "lines", F.coalesce("n_notices", F.lit(0)).alias("n_notices"), "whole",
        F.col("top.licence").alias("licence"), F.col("top.cosine").alias("cosine"), F.col("top.unit").alias("unit"),
    )
    is_file = F.col("name").rlike(LICENSE_FILES) | F.col("whole") | (F.col("n_notices") == F.col("lines"))
    declared = known.filter("licence is not null").filter(is_file).groupBy("dir").agg(F.max(F.struct("cosine", F.col("licence"))).alias("d"))
    declared = declared.select(F.col("dir").alias("above"), F.col("d.licence").alias("inherits"))
    # Each directory once, with all that are above it; the deepest that declares a licence counts.
    parts = F.split("dir", "/")
    dirs = slim.select("dir").distinct().withColumn("depth", F.explode(F.sequence(F.lit(0), F.size(parts))))
    above = F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")
    nearest = (
        dirs.withColumn("above", above)
        .join(declared, "above")
        .groupBy("dir")
        .agg(F.max_by("inherits", "depth").alias("inherits"))
    )
    return known.join(nearest, "dir", "left").select(
        "path",
        F.coalesce("licence", "inherits").alias("licence"),
        F.when(F.col("licence").isNotNull(), "own").when(F.col("inherits").isNotNull(), "inherited").alias("origin"),
        "cosine",
        "n_notices",
        "unit",
    )


def oracle(table: str, path: str, templates=TEMPLATES, least: float = LEAST) -> str:
    """The scan as SQL over ``table``, whose path is the SQL expression ``path``; every word of every unit is weighed."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quoted(n)}, {quoted(t)})" for i, (n, t) in enumerate(templates))
    heavy = ", ".join(f"('{w}', {t}, {o}, {n})" for w, t, o, n in short_anchors(templates, least))
    ordinary = ", ".join(f"'{w}'" for w in sorted(ORDINARY))
    families = len({-1 if t.startswith(IDENTIFIER) else i for i, (_, t) in enumerate(templates)})
    longer = ", ".join(map(str, [-1, *_long(templates)]))
    other = f"ln(1.0 + {families}) + 1"
    return f"""
    WITH template(t, licence, body) AS (VALUES {rows}),
    heavy(w, t, o, size) AS (VALUES {heavy}),
    tw AS (SELECT t, f, w, count(*) AS n FROM (SELECT t, CASE WHEN starts_with(body, '{IDENTIFIER}') THEN -1 ELSE t END AS f, unnest(regexp_split_to_array(lower(body), '{_BREAK}')) AS w FROM template) WHERE w <> '' GROUP BY ALL),
    idf AS (SELECT w, CASE WHEN w IN ({ordinary}) THEN {ORDINARY_RARITY} ELSE ln((1.0 + {families}) / (1 + count(DISTINCT f))) + 1 END AS idf FROM tw GROUP BY w),
    tx AS (SELECT t, w, (1 + ln(n)) * idf AS x FROM tw JOIN idf USING (w)),
    tn AS (SELECT t, sqrt(sum(x * x)) AS norm FROM tx GROUP BY t),
    file AS (SELECT {path} AS path, coalesce(text, '') AS text FROM {table}),
    blocks AS (SELECT path, text, regexp_split_to_array(text, '{_BLANK}') AS b FROM file),
    unit AS (
        SELECT path, 'line' AS unit, unnest(string_split(text, chr(10))) AS content, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM file
        UNION ALL SELECT * FROM (SELECT path, 'block' AS unit, unnest(b) AS content, generate_subscripts(b, 1) - 1 AS no FROM blocks WHERE len(b) > 1) WHERE contains(content, chr(10))
        UNION ALL SELECT path, 'file', text, 0 FROM file WHERE contains(text, chr(10))
    ),
    split AS (SELECT path, unit, no, list_filter(regexp_split_to_array(lower(content), '{_BREAK}'), lambda w: w <> '') AS words FROM unit),
    said AS (SELECT path, unit, no, len(words) AS size, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS pos FROM split),
    word AS (SELECT path, unit, no, w, count(*) AS n FROM said GROUP BY ALL),
    weighed AS (SELECT path, unit, no, w, (1 + ln(n)) * CASE WHEN w IN ({ordinary}) THEN {ORDINARY_RARITY} ELSE coalesce(idf, {other}) END AS x FROM word LEFT JOIN idf USING (w)),
    norm AS (SELECT path, unit, no, sqrt(sum(x * x)) AS norm FROM weighed GROUP BY ALL),
    hit AS (SELECT path, unit, no, t, round(sum(weighed.x * tx.x / tn.norm) / any_value(norm.norm), 6) AS cosine
            FROM weighed JOIN tx USING (w) JOIN tn USING (t) JOIN norm USING (path, unit, no) GROUP BY path, unit, no, t),
    start AS (SELECT DISTINCT path, no, t, pos - o AS start, heavy.size FROM said JOIN heavy USING (w) WHERE unit = 'line' AND said.size > heavy.size),
    bag AS (SELECT path, s.no, s.t, s.start, a.w, count(*) AS n FROM start s JOIN said a USING (path)
            WHERE a.unit = 'line' AND a.no = s.no AND a.pos BETWEEN s.start AND s.start + s.size - 1 GROUP BY ALL),
    heaped AS (SELECT path, no, t, start, w, (1 + ln(n)) * CASE WHEN w IN ({ordinary}) THEN {ORDINARY_RARITY} ELSE coalesce(idf, {other}) END AS x FROM bag LEFT JOIN idf USING (w)),
    seen AS (SELECT path, 'line' AS unit, h.no, h.t, round(sum(h.x * coalesce(tx.x, 0) / tn.norm) / sqrt(sum(h.x * h.x)), 6) AS cosine
             FROM heaped h JOIN tn ON tn.t = h.t LEFT JOIN tx ON tx.t = h.t AND tx.w = h.w GROUP BY path, h.no, h.t, h.start),
    notice AS (SELECT path, unit, no, max((cosine, -t)) AS k FROM (SELECT * FROM hit UNION ALL SELECT * FROM seen) WHERE cosine >= {least} GROUP BY path, unit, no),
    own AS (SELECT path, count(*) FILTER (unit = 'line') AS n_notices, bool_or(unit = 'file' AND k[1] >= {WHOLE} AND -k[2] IN ({longer})) AS whole, max((licence <> '{RESERVED}', k[1], k[2], unit)) AS top FROM notice JOIN template ON t = -k[2] GROUP BY path),
    lines AS (SELECT path, count(*) FILTER (trim(content) <> '') AS lines FROM unit WHERE unit = 'line' GROUP BY path),
    known AS (SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, coalesce(n_notices, 0) AS n_notices, whole, licence, top[2] AS cosine, top[4] AS unit, lines
              FROM lines LEFT JOIN own USING (path) LEFT JOIN template ON t = -top[3]),
    declared AS (SELECT dir, arg_max(licence, (cosine, licence)) AS inherits FROM known
                 WHERE licence IS NOT NULL AND (whole OR n_notices = lines OR regexp_matches(regexp_extract(path, '([^/]*)$', 1), '(?i)^(license|licence|copying|unlicense)([.-][^/]*)?$')) GROUP BY dir),
    nearest AS (SELECT d.dir, arg_max(inherits, length(declared.dir)) AS inherits FROM (SELECT DISTINCT dir FROM known) d
                JOIN declared ON d.dir = declared.dir OR declared.dir = '' OR starts_with(d.dir, declared.dir || '/') GROUP BY d.dir)
    SELECT path, coalesce(licence, inherits) AS licence, CASE WHEN licence IS NOT NULL THEN 'own' WHEN inherits IS NOT NULL THEN 'inherited' END AS origin, cosine, n_notices, unit
    FROM known LEFT JOIN nearest USING (dir)
    """
