import math
import re

import pytest

from quillstone.llm import licenses


def files(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.txt", "words only"), ("a/b/c/y.txt", "more words"), ("a/b/LICENSE.md", "intro\nLicensed under the Apache License, Version 2.0.\nend"),
        ("a/b/z.txt", "Licensed under CC BY-NC 4.0.\nand prose " * 3), ("q/r.txt", None), ("q/s.txt", ""), (None, "All rights reserved."), ("top.txt", "the license of the of the in and with words"), ("a/x.txt", "words only"),
    ]
    return spark.createDataFrame([(p, t, 1, "z", "u") for p, t in rows], "path string, text string, score int, line string, dir string")


def test_own_and_inherited_licences(spark):
    got = {r.path: r for r in licenses.scan(files(spark)).collect()}
    assert licenses.scan(files(spark)).count() == 10
    assert (got["a/LICENSE"].license, got["a/LICENSE"].inherited, got["a/LICENSE"].distance) == ("MIT", "MIT", 0)
    assert (got["a/x.txt"].license, got["a/x.txt"].inherited, got["a/x.txt"].inherited_from) == (None, "MIT", "a/LICENSE")
    assert (got["a/b/c/y.txt"].inherited, got["a/b/c/y.txt"].distance, got["a/b/c/y.txt"].inherited_from) == ("Apache-2.0", 1, "a/b/LICENSE.md")
    assert (got["a/b/z.txt"].license, got["a/b/z.txt"].inherited) == ("CC-BY-NC-4.0", "Apache-2.0")
    assert got["q/r.txt"].inherited is None and got["top.txt"].license is None and got[None].inherited is None


def test_scores_are_cosines(spark):
    docs = [("p1", "Released under the MIT License."), ("p2", "Released under the MIT License of today."), ("p3", "the words under"), ("p4", "Licensed under CC BY 4.0.")]
    got = {r.path: (r.license, r.score) for r in licenses.direct(spark.createDataFrame(docs, "path string, text string")).collect()}
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    vocabulary = {w for _, t in licenses.TEMPLATES for w in split(t)}
    df = {w: sum(w in split(t) for _, t in docs) for w in vocabulary}
    idf = lambda w: math.log(5 / (1 + df.get(w, 0))) + 1
    vector = lambda t: {w: split(t).count(w) * idf(w) for w in split(t)}
    cosine = lambda u, v: sum(x * v.get(w, 0) for w, x in u.items()) / math.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))
    for path, text in docs:
        best = max((round(cosine(vector(text), vector(t)), 9), name) for name, t in licenses.TEMPLATES)
        if best[0] >= licenses.LEAST_COSINE and re.search(licenses.ANCHORS, text):
            assert got[path] == (best[1], pytest.approx(best[0], abs=1e-8))
        else:
            assert path not in got


def test_empty_table(spark, none):
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).count() == 0
    assert licenses.scan(licenses.document_paths(none)).count() == 0


def test_whole_files_headers_and_identifiers(spark):
    holder = "Copyright (c) 2020 Foo Bar Inc. All rights reserved.\n\n"
    named = dict(licenses.TEMPLATES)  # the last, longest one of each
    mit = "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + next(t for n, t in licenses.TEMPLATES if n == "MIT" and "NONINFRINGEMENT" in t)
    rows = [
        ("p/LICENSE", mit.replace(". ", ".\n")), ("q/COPYING.txt", holder + named["BSD-3-Clause"].replace(", ", ",\n")), ("r/a.py", "# SPDX-License-Identifier: MIT\nimport os\n" + "word " * 50_000),
        ("r/b.py", "// Copyright 2020 Foo Bar Inc. Licensed under the Apache License, Version 2.0."), ("r/c.py", "nothing about it"), ("r/d.py", holder), ("r/c.py", None),
    ]
    for extra in (0, 3_000):  # the score does not depend on how many other files there are
        others = [(f"x/{i}.txt", f"plain words {i}") for i in range(extra)]
        got = {r.path: r.license for r in licenses.direct(spark.createDataFrame(rows + others, "path string, text string").fillna("")).collect()}
        assert got == {"p/LICENSE": "MIT", "q/COPYING.txt": "BSD-3-Clause", "r/a.py": "MIT", "r/b.py": "Apache-2.0"} | ({"r/d.py": got["r/d.py"]} if "r/d.py" in got else {})
