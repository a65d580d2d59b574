from __future__ import annotations

import math
import re
from collections import Counter

from etoile.llm import licences

SCHEMA = "file long, path string, text string, license string, dir string, words int"


def frame(spark, rows):
    return spark.createDataFrame([(i, p, t, "x", "y", 1) for i, p, t in rows], SCHEMA)


ROWS = [
    (1, "a/LICENSE", "Released under the MIT License.\nmore text follows here"),
    (2, "a/b/c/main.c", "int main"),
    (3, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (4, "a/b/c/d.c", "// Licensed under the Apache License, Version 2.0.\nint d and so many more words of a program that it is a header only"),
    (5, "z/x.c", "nothing"),
    (6, "a/y.c", "a licence to fish is no match of anything at all"),
    (7, "q/1", "All rights reserved."),                     # licence lines are half of its words: speaks for q
    (8, "q/2/3", "plain"),
    (9, "r/1", "All rights reserved. and very many other words stand in this line\nand in the next one too\nCopyright me"),
    (10, None, None), (11, "", "x"), (12, "top.c", "y"),
    (13, "w/1", "Licensed under CC BY-NC 4.0.\nAll rights reserved."),
    (5, "z/x.c", "nothing"),
]


def brute(rows, min_cosine=licences.MIN_COSINE):
    terms = lambda s: Counter(re.findall(licences.TERM, s.lower()))
    heads = [(n, k, line) for n, (_, _, t) in enumerate(rows) for k, line in enumerate((t or "").split("\n")) if re.search(licences.TRIGGER, line)]
    df = Counter(w for *_, line in heads for w in terms(line))
    idf = lambda w: math.log((1 + len(heads)) / (1 + df[w])) + 1
    vec = lambda s: {w: n * idf(w) for w, n in terms(s).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own, said = {}, Counter()
    for n, k, line in heads:
        v = vec(line)
        models = {name: vec(t) for name, t in licences.TEMPLATES.items()}
        score, name = min((-round(sum(v.get(w, 0) * x for w, x in u.items()) / norm(u) / norm(v), 9), name) for name, u in models.items())
        if -score >= min_cosine:
            said[n] += len(line.split())
            own[n] = min(own.get(n, (1, "", 0)), (score, name, k))
    dirs = {}
    for n, (score, name, _) in own.items():
        p = rows[n][1] or ""
        if re.search(licences.FILE_NAME, p) or 2 * said[n] >= len(rows[n][2].split()):
            d = re.sub("/?[^/]*$", "", p)
            dirs[d] = max(dirs.get(d, (-1, "", "")), (-score, name, p))
    out = []
    for n, (i, p, _) in enumerate(rows):
        d = re.sub("/?[^/]*$", "", p or "")
        ups = [d] + ["/".join(d.split("/")[:k]) for k in range(len(d.split("/")) - 1, -1, -1)]
        up = next((u for u in ups if u in dirs), None)
        if n in own:
            out.append((i, own[n][1], "own", round(-own[n][0], 6)))
        elif up is not None:
            out.append((i, dirs[up][1], "inherited", round(dirs[up][0], 6)))
        else:
            out.append((i, None, "none", None))
    return sorted(out, key=str)


def test_scan_equals_brute_force(spark):
    unique = [(100 + n, p, t) for n, (_, p, t) in enumerate(ROWS)]
    got = licences.scan(frame(spark, unique)).collect()
    assert sorted(((r.file, r.license, r.origin, None if r.cosine is None else round(r.cosine, 6)) for r in got), key=str) == brute(unique)
    by = {r.path: r for r in got}
    assert by["a/b/c/main.c"].license == "GPL-3.0" and by["a/b/c/main.c"].from_path == "a/b/COPYING"
    assert by["a/b/c/d.c"].origin == "own" and by["a/y.c"].license == "MIT" and by["q/2/3"].license == "Proprietary"
    assert by["z/x.c"].origin == "none" and by["top.c"].origin == "none"


def test_empty_tables_and_no_headers(spark):
    assert licences.scan(frame(spark, [])).collect() == []
    out = licences.scan(frame(spark, [(1, "a/b", "x"), (2, None, None)])).collect()
    assert [r.origin for r in out] == ["none", "none"]


def test_no_python_on_the_executors(spark):
    plan = licences.scan(frame(spark, ROWS[:5]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


REAL = [
    ("a/1.c", "// SPDX-License-Identifier: MIT\nint a;", "MIT", "own"),
    ("a/2.py", "# SPDX-License-Identifier: apache-2.0\n", "Apache-2.0", "own"),
    ("a/3.c", "/* SPDX-License-Identifier: (GPL-3.0-or-later OR mit) AND LicenseRef-Own */", "(GPL-3.0-or-later OR MIT) AND LicenseRef-Own", "own"),
    ("a/4.c", "/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */", "GPL-2.0-only WITH Linux-syscall-note", "own"),
    ("a/5.c", "# SPDX-License-Identifier: NOASSERTION", None, "none"),
    ("b/1.py", "#!/usr/bin/python\n\n# BSD 3-Clause License\nimport os\n", "BSD-3-Clause", "own"),
    ("b/2.py", "Mozilla Public License Version 2.0", "MPL-2.0", "own"),
    ("b/3.java", """/*
 * Copyright 2019 The Authors
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
package a;
""" + "int and = more * code;\n" * 200, "Apache-2.0", "own"),
    ("b/4.c", """# This file is part of Thing.
#
# Thing is free software: you can redistribute it and/or modify it under the terms of
# the GNU Lesser General Public License as published by the Free Software Foundation, either
# version 3 of the License, or (at your option) any later version.
#
# Thing is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
# even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
# GNU Lesser General Public License for more details.
x = 1
""", "LGPL-3.0", "own"),
    ("c/LICENSE", """Copyright 2021 Someone

Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS.""", "ISC", "own"),
    ("c/d/e.c", "int main", "ISC", "inherited"),
    ("e/1.c", "see the license of the thing before you use any of it, or ask whoever holds the copyright", None, "none"),
]


def test_real_headers_texts_and_spdx_expressions(spark):
    full = (licences.Path(licences.__file__).parent / "license_texts" / "GPL-2.0.txt").read_text().split("\n")
    rows = [*REAL, ("g/7", "\n".join(full[8:-60]), "GPL-2.0", "own"), ("g/h/8", "plain", "GPL-2.0", "inherited")]         # no name: most of its words
    out = {r.path: (r.license, r.origin) for r in licences.scan(frame(spark, [(i, p, t) for i, (p, t, *_) in enumerate(rows)])).collect()}
    assert out == {p: (license, origin) for p, _, license, origin in rows}


def test_a_long_run_of_lines_is_one_block(spark):
    text = "# licence\n" * 30_000 + "\n" + "licence x\n" * 30_000
    out = licences.passages(frame(spark, [(1, "a", text)]).select("file", "path", "text")).collect()
    assert sorted((r.passage, r.words) for r in out) == [(-1, 120_000), (0, 30_000), (1, 60_000)]
