"""Operator 3, license scans: TF-IDF cosine of license lines, header blocks and whole files to templates, then inheritance along paths. Native.

A *header* is a line of a file that names a license (``TRIGGER``). Its terms and the templates' are weighted by

    tf * idf,   idf(t) = ln((1 + N) / (1 + n(t))) + 1

with N the headers and n(t) those that hold the term, over all headers of the corpus (sparse rows of header, term and weight). A header has
the license of its nearest template by cosine, if that is at least ``min_cosine``. A *passage* is the whole text of a file with a license word, or one of its *blocks*
(adjacent lines of a comment, or other adjacent lines) that has one. It is compared with the full texts, notices and titles of licenses by

    (1 + ln tf) * idf,   n(t) and N over these templates

so that the many common words of a long text do not decide, and a score does not depend on other files. An SPDX expression is split into its terms; it states the
license of its own file with cosine 1. A file has the license of its best header or passage. A *license file* (by its base name, or, for rows without
names, by matched lines or passages being at least half of its words) speaks for its directory. A file without a license of its
own takes that of the nearest ancestor directory that has a license file.

Plan. Whole texts are read by one filter that keeps files with a trigger word; only the terms of these files are shuffled, with their
counts. The passages' templates are a broadcast of fixed size (some 2,000 terms). Inheritance is found per directory (one row each), by a join of each directory's ancestors with the
licensed directories, then joined to the files. A directory or a license that a third of the files share is a key of
plain joins to one row, which Spark splits. The lines' templates are in the plan as literals.

Rules. Null text or path counts as empty: no license, root directory. Ties go to the higher score, then the template's name, then the smaller line
number. Rows are told apart by ``file``, any unique number, so repeated rows get a row each. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from etoile.session import materialize

#: Names and notices of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0. Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
TRIGGER = r"(?i)licen[sc]e|copyright|all rights reserved|spdx"
TERM = r"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]"
WORD = r"[^\x20\x09-\x0D]+"
#: Titles, and the notices that licenses give for the head of a source file; the full texts are in ``license_texts``.
NOTICES = {
    "AGPL-3.0": ("GNU Affero General Public License Version 3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
        FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."""),
    "Apache-2.0": ("Apache License Version 2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
        implied. See the License for the specific language governing permissions and limitations under the License."""),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD 2-Clause Simplified License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD 3-Clause New or Revised License",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License",),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License",),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License",),
    "CC0-1.0": ("CC0 1.0 Universal",),
    "GPL-2.0": ("GNU General Public License Version 2", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    "GPL-3.0": ("GNU General Public License Version 3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License Version 2.1", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This
        library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
        FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."""),
    "LGPL-3.0": ("GNU Lesser General Public License Version 3", """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
        FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."""),
    "MIT": ("MIT License", "The MIT License (MIT)", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    "MPL-2.0": ("Mozilla Public License Version 2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
}
#: Identifiers whose spelling is settled; others stay as written.
SPDX_IDS = ("0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 "
            "CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 Classpath-exception-2.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later "
            "GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later LLVM-exception "
            "Linux-syscall-note MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL NCSA OFL-1.1 OpenSSL PostgreSQL Python-2.0 Unlicense Zlib").split()
_ID = r"[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?"
SPDX = rf"(?i)spdx-license-identifier:[ \t]*(\(*[ \t]*{_ID}(?:[ \t)]+(?:and|or|with)[ \t(]+{_ID})*[ \t)]*)"
#: What begins a line of a comment.
MARK = r"(?m)^[ \t]*(?://+|/\*+|\*+/?|#+|--+|;+|%+|<!--|\x01)[ \t]*"
#: Adjacent lines of a comment (begun by \x01), or other adjacent lines.
BLOCK = r"\x01[^\n]*+(?:\n\x01[^\n]*+)*+|[^\n\x01][^\n]*+(?:\n[^\n\x01][^\n]*+)*+"
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)[^/]*$"
MIN_COSINE = 0.6


def _templates(spark: SparkSession) -> DataFrame:
    """(template, term, tf) from literals."""
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("template"), F.lit(v).alias("line")) for k, v in sorted(TEMPLATES.items())]))
    t = spark.range(1).select(rows.alias("t")).select("t.*")
    return (t.select("template", F.explode(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0))).alias("term"))
            .groupBy("template", "term").agg(F.count("*").alias("tf")))


def headers(files: DataFrame) -> DataFrame:
    """(file, line_no, words, line) of the license lines of whole texts."""
    line = F.posexplode(F.split("text", "\n"))
    return (files.where(F.col("text").rlike(TRIGGER)).select("file", line.alias("line_no", "line"))
            .where(F.col("line").rlike(TRIGGER)).withColumn("words", F.regexp_count("line", F.lit(WORD))))


def match_headers(found: DataFrame) -> DataFrame:
    """(file, line_no, template, cosine) of the nearest template of each header."""
    spark = found.sparkSession
    terms = (found.select("file", "line_no", F.explode(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0))).alias("term"))
             .groupBy("file", "line_no", "term").agg(F.count("*").alias("tf")))
    terms = materialize(terms, "header-terms")
    total = float(found.count())
    held = terms.groupBy("term").agg(F.count("*").alias("n"))
    idf = F.log(F.lit(1.0 + total) / (1.0 + F.coalesce("n", F.lit(0)))) + 1.0
    weighted = terms.join(materialize(held, "header-df"), "term").withColumn("w", F.col("tf") * idf)
    model = _templates(spark).join(held, "term", "left").withColumn("v", F.col("tf") * idf)
    size = model.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("template_norm"))
    model = materialize(model.join(size, "template").select("template", "term", "v", "template_norm"), "templates")
    norm = weighted.groupBy("file", "line_no").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (weighted.join(model, "term").groupBy("file", "line_no", "template")
            .agg((F.sum(F.col("w") * F.col("v")) / F.first("template_norm")).alias("dot")))
    score = F.round(F.col("dot") / F.col("norm"), 9)
    order = W.partitionBy("file", "line_no").orderBy(F.desc("cosine"), "template")          # a line's own templates
    return (dots.join(norm, ["file", "line_no"]).select("file", "line_no", "template", score.alias("cosine"))
            .withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank"))


def passage_model() -> tuple[list[str], dict[str, list[float]], float]:
    """(template of each column, weights of each term in every column's unit vector with the term's idf at the end, idf of other terms)."""
    texts = [(f.stem, f.read_text()) for f in (Path(__file__).parent / "license_texts").glob("*.txt")]
    texts = sorted([*texts, *((name, t) for name, some in NOTICES.items() for t in some)])
    tfs = [Counter(re.findall(TERM, t.lower())) for _, t in texts]
    held = Counter(term for tf in tfs for term in tf)
    idf = {term: math.log((1 + len(tfs)) / (1 + n)) + 1 for term, n in held.items()}
    vectors = [{term: (1 + math.log(n)) * idf[term] for term, n in tf.items()} for tf in tfs]
    norms = [math.sqrt(sum(x * x for x in v.values())) for v in vectors]
    rows = {term: [*(v.get(term, 0.0) / norm for v, norm in zip(vectors, norms)), idf[term]] for term in sorted(held)}
    return [name for name, _ in texts], rows, math.log(1 + len(tfs)) + 1


def passages(files: DataFrame) -> DataFrame:
    """(file, passage, words, text): whole texts with a license word (passage -1) and their blocks of adjacent lines that have one."""
    text = F.regexp_replace(F.regexp_replace("text", r"(?m)[ \t\r]+$", ""), MARK, "\x01")
    blocks = F.filter(F.regexp_extract_all(text, F.lit(BLOCK), F.lit(0)), lambda b: b.rlike(TRIGGER))
    each = F.posexplode(F.concat(F.array("text"), blocks)).alias("passage", "text")
    return (files.where(F.col("text").rlike(TRIGGER)).select("file", each)
            .select("file", (F.col("passage") - 1).alias("passage"), F.regexp_count("text", F.lit(WORD)).alias("words"), "text"))


def match_passages(found: DataFrame) -> DataFrame:
    """(file, passage, words, template, cosine) of the nearest full text, notice or title of each passage."""
    names, rows, other = passage_model()
    lines = "\n".join(" ".join([term, *map(repr, v)]) for term, v in rows.items())
    row = F.split("row", " ")
    model = (found.sparkSession.range(1).select(F.explode(F.split(F.lit(lines), "\n")).alias("row"))
             .select(row[0].alias("term"), F.slice(row, 2, len(names) + 1).cast("array<double>").alias("v")))
    model = F.broadcast(materialize(model, "passage-model"))                                  # fixed: terms of the templates
    terms = (found.select("file", "passage", "words", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0))).alias("term"))
             .groupBy("file", "passage", "words", "term").agg(F.count("*").alias("tf")))
    w = (F.log(F.col("tf")) + 1.0) * F.coalesce(F.col("v")[len(names)], F.lit(other))
    sums = (terms.join(model, "term", "left").withColumn("w", w).groupBy("file", "passage", "words")
            .agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *(F.sum(F.col("w") * F.col("v")[i]).alias(f"dot{i}") for i in range(len(names)))))
    near = F.array_min(F.array(*(F.struct((-F.round(F.coalesce(F.col(f"dot{i}"), F.lit(0.0)) / F.col("norm"), 9)).alias("less"), F.lit(name).alias("template"))
                                 for i, name in enumerate(names))))
    return sums.select("file", "passage", "words", near.alias("b")).select("file", "passage", "words", "b.template", (-F.col("b.less")).alias("cosine"))


def spdx(found: DataFrame) -> DataFrame:
    """(file, line_no, template, cosine) of header lines that state an SPDX expression: its terms, in their settled spelling, with cosine 1."""
    known = {**{i.lower(): i for i in SPDX_IDS}, **{o: o.upper() for o in ("and", "or", "with")},
             **{f"{g}-{v}+": f"{g.upper()}-{v}-or-later" for g, v in (("gpl", "2.0"), ("gpl", "3.0"), ("lgpl", "2.1"), ("lgpl", "3.0"), ("agpl", "3.0"))}}
    settled = F.create_map(*(F.lit(x) for kv in sorted(known.items()) for x in kv))
    terms = F.regexp_extract_all(F.regexp_extract("line", SPDX, 1), F.lit(r"[()]|[^ \t()]+"), F.lit(0))
    said = F.array_join(F.transform(terms, lambda t: F.coalesce(settled[F.lower(t)], t)), " ")
    said = F.regexp_replace(F.regexp_replace(said, r"\( ", "("), r" \)", ")")
    return (found.where(F.col("line").rlike(SPDX)).select("file", "line_no", said.alias("template"), F.lit(1.0).alias("cosine"))
            .where(~F.upper("template").isin("NONE", "NOASSERTION")))


def directory(path):
    """The directory of a path, without a slash at its end; '' is the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """``files``: file (unique number), path, text. Returns file, license, origin (own, inherited, none), cosine, from_path."""
    files = files.select("file", F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = materialize(headers(files), "headers")
    lines = match_headers(found).where(F.col("cosine") >= min_cosine)
    near = materialize(match_passages(passages(files)).where(F.col("cosine") >= min_cosine), "near")
    order = W.partitionBy("file").orderBy(F.desc("cosine"), "template", "line_no")
    every = lines.unionByName(spdx(found)).unionByName(near.select("file", F.col("passage").alias("line_no"), "template", "cosine"))
    own = (every.withColumn("rank", F.row_number().over(order)).where("rank = 1")
           .select("file", F.col("template").alias("license"), "cosine"))                       # one file's own headers and passages
    own = materialize(own, "own")
    said = found.join(lines.select("file", "line_no"), ["file", "line_no"], "left_semi").groupBy("file").agg(F.sum("words").alias("said"))
    # passages hold lines, and the whole text holds its blocks: a word counts once
    blocks = F.sum(F.when(F.col("passage") >= 0, F.col("words")).otherwise(0))
    whole = F.max(F.when(F.col("passage") < 0, F.col("words")).otherwise(0))
    said = said.unionByName(near.groupBy("file").agg(F.greatest(blocks, whole).alias("said"))).groupBy("file").agg(F.max("said").alias("said"))
    paths = materialize(files.select("file", "path", F.when(F.col("text").rlike(TRIGGER), F.regexp_count("text", F.lit(WORD))).alias("words")), "paths")
    speaks = F.col("path").rlike(FILE_NAME) | (2 * F.col("said") >= F.col("words"))
    voices = (own.join(paths, "file").join(said, "file", "left").where(speaks)
              .select(directory(F.col("path")).alias("dir"), "license", "cosine", "path"))
    best = F.max(F.struct("cosine", "license", "path"))
    licensed = materialize(voices.groupBy("dir").agg(best.alias("b")).select("dir", "b.license", "b.cosine", F.col("b.path").alias("from_path")), "licensed")
    # ancestors of every directory, itself included: a/b/c -> a/b/c, a/b, a, ''
    parts = F.split("dir", "/")
    dirs = paths.select(directory(F.col("path")).alias("dir")).distinct()
    up = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))),
                                                  lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))).alias("u"))
    nearest = (up.select("dir", "u.depth", "u.above").join(licensed.withColumnRenamed("dir", "above"), "above")
               .groupBy("dir").agg(F.max(F.struct("depth", "license", "cosine", "from_path")).alias("b"))
               .select("dir", F.col("b.license").alias("above_license"), F.col("b.cosine").alias("above_cosine"), F.col("b.from_path").alias("from_path")))
    out = (paths.withColumn("dir", directory(F.col("path"))).join(own, "file", "left").join(materialize(nearest, "nearest"), "dir", "left"))
    mine, theirs = F.col("license").isNotNull(), F.col("above_license").isNotNull()
    return out.select("file", "path", F.coalesce("license", "above_license").alias("license"),
                      F.when(mine, "own").when(theirs, "inherited").otherwise("none").alias("origin"),
                      F.coalesce("cosine", "above_cosine").alias("cosine"),
                      F.when(~mine & theirs, F.col("from_path")).alias("from_path"))
