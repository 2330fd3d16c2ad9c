from __future__ import annotations

import re

import duckdb
from pulseframe.llm import licenses

FILES = [
    ("a/LICENSE", "Licensed under the Apache License, Version 2.0"),
    ("a/x.py", "print(1)\nprint(2)"),
    ("a/b/c/y.py", "nothing here"),
    ("a/b/c/own.py", "# This work is licensed under the GNU General Public License, version 3.\ncode"),
    ("a/b/COPYING.txt", "Preamble\nReleased under the MIT License.\nmore"),
    ("a/b/z.py", ""),
    ("ab/not_below_a.py", "text"),
    ("notice_only/readme", "\nAll rights reserved.\n\n"),
    ("notice_only/sub/file", None),
    ("top.py", "a general source of free public files, version 4"),
    ("twice.py", "Licensed under CC BY-NC 4.0"),
    ("twice.py", "Licensed under CC BY-NC 4.0\nReleased under the MIT License"),
    ("long.py", "word other " * 5000 + "\nLicensed under CC BY-SA 4.0 " + "tail " * 400),
]


def results(spark, files, extra=False):
    df = spark.createDataFrame(files, "path string, text string")
    if extra:
        df = df.selectExpr("*", "1 AS line", "'z' AS licence", "'z' AS word", "'z' AS dir", "2 AS cosine")
    return {r["path"]: (r["licence"], r["origin"], r["n_notices"]) for r in licenses.scan(df).collect()}


def test_own_and_inherited_licences(spark):
    got = results(spark, FILES, extra=True)
    assert got["a/LICENSE"] == ("Apache-2.0", "own", 1)
    assert got["a/x.py"] == ("Apache-2.0", "inherited", 0)
    assert got["a/b/c/y.py"] == ("MIT", "inherited", 0)
    assert got["a/b/c/own.py"] == ("GPL-3.0", "own", 1)
    assert got["ab/not_below_a.py"] == (None, None, 0)
    assert got["notice_only/sub/file"] == ("Proprietary", "inherited", 0)
    assert got["top.py"] == (None, None, 0)
    assert got["long.py"] == ("CC-BY-SA-4.0", "own", 1)  # within a line of four thousand other words
    assert got["twice.py"][1:] == ("own", 2)  # the equal line of both rows is one line
    assert len(got) == 12


def test_equals_sql(spark):
    files = [f for f in FILES if f[0] != "twice.py"]
    con = duckdb.connect()
    con.execute("CREATE TABLE files(path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO files VALUES (?, ?)", files)
    want = {r[0]: (r[1], r[2], r[4]) for r in con.execute(licenses.oracle("files", "path")).fetchall()}
    assert results(spark, files) == want


def body(name: str, words: int) -> str:
    """The template of that licence with at least so many words."""
    return next(t for n, t in licenses.TEMPLATES if n == name and len(licenses.words_of(t)) >= words)


def wrapped(text: str, prefix: str = "", width: int = 9) -> str:
    """A text in lines of some words, as in a comment."""
    said = text.split()
    return "\n".join(prefix + " ".join(said[i : i + width]) for i in range(0, len(said), width))


GPL_TAIL = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
)
CODE = "\n\nimport os\n\n\ndef main():\n    return os.getcwd()\n"
REAL = [
    ("gpl/src/a.c", "/*\n * Copyright (C) 2019 Jane Doe\n *\n" + wrapped(body("GPL-3.0", 40), " * ") + "\n *\n" + wrapped(GPL_TAIL, " * ") + "\n */\n" + CODE, "GPL-3.0", "block"),
    ("gpl2/b.py", "# Copyright 2001 Someone\n#\n" + wrapped(body("GPL-2.0", 40), "# ") + CODE, "GPL-2.0", "block"),
    ("apache/c.go", "// Copyright 2021 The Authors\n//\n" + wrapped(body("Apache-2.0", 60), "// ") + CODE, "Apache-2.0", None),
    ("mit/LICENSE", "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + wrapped(body("MIT", 100)), "MIT", None),
    ("bsd2/COPYING", "Copyright (c) 2010, Some Company\nAll rights reserved.\n\n" + wrapped(body("BSD-2-Clause", 100)), "BSD-2-Clause", None),
    ("bsd3/LICENSE.txt", "Copyright (c) 2010, Some Company\n\n" + wrapped(body("BSD-3-Clause", 100)), "BSD-3-Clause", None),
    ("isc/LICENSE.md", "# ISC\n\n" + wrapped(body("ISC", 60)), "ISC", None),
    ("spdx/d.rs", "// SPDX-License-Identifier: GPL-3.0-or-later\n" + CODE, "GPL-3.0", "line"),
    ("spdx/e.rs", "# SPDX-License-Identifier: MIT" + CODE, "MIT", "line"),
    ("spdx/f.rs", "/* SPDX-License-Identifier: Apache-2.0 */" + CODE, "Apache-2.0", "line"),
    ("own/g.txt", "Copyright 2020 Jane Doe. All rights reserved." + CODE, "Proprietary", "line"),
    ("page/h.txt", "The project began in a garage and grew. It is licensed under the Apache License, Version 2.0, as most of our work is, and we like it." + CODE, "Apache-2.0", "line"),
    ("none/i.txt", "The free public can use any general version of this work; a copy of the software was lost in 2004." + CODE, None, None),
]


def test_headers_files_and_identifiers(spark):
    df = spark.createDataFrame([(p, t) for p, t, _, _ in REAL], "path string, text string")
    got = {r["path"]: r for r in licenses.scan(df).collect()}
    for path, _, licence, unit in REAL:
        assert got[path]["licence"] == licence, (path, got[path])
        assert unit is None or got[path]["unit"] == unit, (path, got[path])


def test_a_licence_file_gives_its_licence_to_what_is_below(spark):
    mit = next(t for p, t, _, _ in REAL if p == "mit/LICENSE")
    files = [("r/LICENSE", mit), ("r/src/x.py", "print()"), ("r/src/deep/er/y.py", ""), ("r/vendor/legal", wrapped(body("ISC", 60))), ("r/vendor/lib/z.js", "go()"), ("other.py", "x")]
    got = results(spark, files)
    assert got["r/src/x.py"][:2] == got["r/src/deep/er/y.py"][:2] == ("MIT", "inherited")
    assert got["r/vendor/lib/z.js"][:2] == ("ISC", "inherited")  # the nearer file, a notice as a whole
    assert got["other.py"][:2] == (None, None)


def test_ties_go_to_the_template_listed_first(spark):
    templates = (("A", "alpha beta gamma delta"), ("B", "alpha beta gamma delta"))
    df = spark.createDataFrame([("x", "alpha beta gamma delta")], "path string, text string")
    assert [r["licence"] for r in licenses.scan(df, templates=templates).collect()] == ["A"]
    assert [r["licence"] for r in licenses.scan(df, templates=templates[::-1]).collect()] == ["B"]


def test_real_files_equal_sql(spark):
    files = [(p, t) for p, t, _, _ in REAL]
    con = duckdb.connect()
    con.execute("CREATE TABLE files(path VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO files VALUES (?, ?)", files)
    want = sorted(con.execute(licenses.oracle("files", "path")).fetchall())
    df = spark.createDataFrame(files, "path string, text string")
    assert sorted(tuple(r) for r in licenses.scan(df).collect()) == want


def test_the_pattern_finds_each_word_alone():
    words = ["a", "ab", "abc", "b", "license", "licensed", "x1"]
    found = re.compile(licenses.any_of(words))
    assert all(found.search(f"-{w.upper()}-") for w in words)
    assert not any(found.search(x) for x in ("abcd", "licenses", "1a", "x", "", "x12"))
    assert not re.compile(licenses.any_of([])).search("anything")


def test_a_line_without_an_anchor_cannot_reach_the_cosine():
    anchors = set(licenses.anchors(licenses.TEMPLATES, licenses.LEAST))
    by = {}
    for t, _, w, x in licenses.weights(licenses.TEMPLATES):
        by.setdefault(t, []).append(0 if w in anchors else x * x)
    assert all(sum(rest) ** 0.5 < licenses.LEAST for rest in by.values())


def test_empty_table_and_null_paths(spark):
    assert results(spark, []) == {}
    assert results(spark, [(None, "Released under the MIT License")]) == {}


def test_no_python_in_the_plan(spark):
    plan = licenses.scan(spark.createDataFrame(FILES, "path string, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
