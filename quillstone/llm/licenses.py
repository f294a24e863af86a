"""Licence scans, with DataFrame operations only: TF-IDF cosine of header lines and licence files to templates, then
inheritance from the nearest ancestor directory by joins on paths.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

# Notices as projects commonly write them, the texts of short licences, and the headers of longer ones.
TEMPLATES = (
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
)
#: A line is a header line if it holds one of these; they are terms of every template.
ANCHORS = r"(?i)licen[sc]e|copyright|rights reserved|permission is hereby|redistribut|public license"
#: Least cosine of a header line, or of a whole licence file, to a template.
LEAST_COSINE = 0.6
#: Terms in fewer than one of so many files, those outside the templates among them, weigh alike, so that scores do not fall as a corpus grows.
RARE = 1_000
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-][\w.-]+)?$"
TERM = r"[\p{L}\p{N}]+"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), 1)


def template_terms(spark: SparkSession) -> DataFrame:
    """(template, license, term, tf), a fixed table."""
    rows = []
    for i, (name, text) in enumerate(TEMPLATES):
        words = re.findall(r"[^\W_]+", text.lower())
        rows += [(i, name, w, words.count(w)) for w in sorted(set(words))]
    return spark.createDataFrame(rows, "template int, license string, term string, tf int")


def document_frequencies(files: DataFrame, templates: DataFrame) -> DataFrame:
    """(term, idf) of the templates' terms over all rows of files: ln((1 + N) / (1 + df)) + 1, the logarithm RARE's at most."""
    vocabulary = sorted({w for _, text in TEMPLATES for w in re.findall(r"[^\W_]+", text.lower())})
    seen = F.array_intersect(F.split(F.lower(F.col("text")), r"[^\p{L}\p{N}]+"), F.array(*map(F.lit, vocabulary)))
    df = files.select(F.explode_outer(seen).alias("term")).where("term is not null").groupBy("term").agg(F.count("*").alias("df"))
    n = float(files.count())
    out = templates.select("term").distinct().join(df, "term", "left")
    share = F.least(F.lit(1 + n) / (1 + F.coalesce("df", F.lit(0))), F.lit(float(RARE)))
    return materialize(out.select("term", (F.log(share) + 1).alias("idf")), "idf")


def direct(files: DataFrame) -> DataFrame:
    """(path, license, score) of the files that match a template by a header line, or as a whole where the name is a licence file's.

    files: path, text. Terms outside the templates weigh as much as a term that no file holds. Of templates with an equal
    cosine the alphabetically first licence wins.
    """
    spark = files.sparkSession
    templates = template_terms(spark)
    idf = document_frequencies(files, templates)
    weights = templates.join(F.broadcast(idf), "term")  # as many rows as the fixed templates have terms
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm"))
    weights = F.broadcast(weights.join(norms, "template").select("license", "template", "term", (F.col("tf") * F.col("idf") / F.col("norm")).alias("weight")))
    unseen = F.least(F.lit(float(files.count()) + 1.0), F.lit(float(RARE)))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(ANCHORS))
    whole = F.when(name.rlike(LICENCE_FILE), F.array(F.col("text"))).otherwise(F.array().cast("array<string>"))
    units = files.select("path", F.explode_outer(F.array_distinct(F.concat(lines, whole))).alias("line")).where("line is not null")
    words = units.select("path", F.xxhash64("line").alias("unit"), F.explode(_terms(F.col("line"))).alias("term"))
    counts = words.groupBy("path", "unit", "term").agg(F.count("*").alias("tf"))
    counts = counts.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.log(unseen) + 1))
    lengths = counts.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = counts.join(weights, "term").groupBy("path", "unit", "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(lengths, ["path", "unit"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 9)).where(F.col("score") >= LEAST_COSINE)
    best = scored.groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("license"))).alias("best"))
    return best.select("path", "best.license", (-F.col("best.s")).alias("score"))


def scan(files: DataFrame) -> DataFrame:
    """files' other columns (but for those of these names), and license, score, inherited, inherited_from and distance, for each row.

    files needs path and text. license is the file's own. inherited is the licence of the licence file in the nearest
    directory on the way up, distance how many levels up that is (0: the file's own directory), null without one. Several
    licence files of one directory: the first path counts. Only directories and licence files meet in the path join, the
    files join their directory's result. Null text is empty, a null path has no directory. Long texts are scanned whole.
    Rows that share a path have the best match of them all, repeated rows stay repeated; an empty table gives an empty one.
    """
    own = files.select("path", F.coalesce("text", F.lit("")).alias("text"))
    found = materialize(direct(own), "direct")
    parent = lambda c: F.regexp_extract(c, r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    granted = found.where(name.rlike(LICENCE_FILE)).groupBy(parent(F.col("path")).alias("dir")).agg(F.min(F.struct("path", "license")).alias("g"))
    granted = granted.select(F.col("dir").alias("up"), F.col("g.license").alias("inherited"), F.col("g.path").alias("inherited_from"))
    dirs = own.select(parent(F.col("path")).alias("dir")).where("dir is not null").distinct()
    steps = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: F.struct(i.alias("distance"), F.array_join(F.slice(steps, F.lit(1), F.size(steps) - i), "/").alias("up")))
    near = dirs.select("dir", F.inline(ups)).join(granted, "up")
    nearest = near.groupBy("dir").agg(F.min(F.struct("distance", "inherited", "inherited_from")).alias("n")).select("dir", "n.*")
    nearest = materialize(nearest, "nearest")
    rest = [c for c in files.columns if c not in ("text", "license", "score", "inherited", "inherited_from", "distance", "dir")]
    out = files.select(*rest, parent(F.col("path")).alias("dir")).join(found, "path", "left").join(nearest, "dir", "left")
    return out.select(*rest, "license", "score", "inherited", "inherited_from", "distance")


def document_paths(docs: DataFrame) -> DataFrame:
    """documents as a file tree: source/language/number/id; every 64th id is named as a licence file, of its directory or of the one above."""
    part = lambda c: F.coalesce(F.regexp_replace(c, "/", "_"), F.lit("none"))
    deep = F.format_string("%s/%s/%d", part("source"), part("lang"), F.floor(F.coalesce("doc_id", F.lit(0)) / 640))
    top = F.format_string("%s/%s", part("source"), part("lang"))
    path = F.when(F.col("doc_id") % 256 == 0, F.format_string("%s/LICENSE-%d", top, "doc_id")).when(F.col("doc_id") % 64 == 0, F.format_string("%s/LICENSE-%d", deep, "doc_id")).otherwise(F.format_string("%s/%d.txt", deep, F.coalesce("doc_id", F.lit(-1))))
    return docs.select("doc_id", path.alias("path"), "text")
