"""Licence scans, in SQL functions only.

A file's statement of licence is the passage closest to a template by TF-IDF
cosine. Passages are windows of consecutive lines with a word: from every line
1, 2, 4, ... lines and as many as reach the template's number of words, and
the whole file where it has at most twice the template's words. The templates
are statements, titles, header blocks and licence texts. A window is compared
only if its words can reach the least cosine: the cosine is at most the norm
of the template's words that the window has over the norm of all of them, so
no window above the threshold is lost. The weights of words come from all files: ln((1 + files) / (1 + files with the word)) + 1;
words that no template has weigh as much as a word of no file. From
``WEIGHT_FILES`` files on the counts are scaled down to that many, so that
equal shares of files give equal weights, and equal scores, in a table of any
size. A file is a licence file if its name says so, if all its lines with a word are statements
of one licence, or if it is as a whole one and each line starts with
``copyright`` or takes half its words or more from the template. A file without a statement inherits the licence of
the licence file in the nearest directory above it (its own directory first),
by joins of directories: the directories that occur, each with the directories
above it, against those that hold a licence file.

Edge cases: null texts and empty ones state nothing, null paths lie in no
directory and inherit nothing; paths are cut at ``/`` and repeated slashes
count once; of several licence files in one directory the first path rules
; ties between lines go to the first line, between
templates to the last by name; texts of any length are read whole; repeated rows are judged each;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.shared import table, written

MIN_COSINE = 0.7
WEIGHT_FILES = 10_000
# Short statements of common licences, and what each names (up
# to a slash: further statements of the same licence).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under the CC0 1.0 Universal license.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "Copyright. All rights reserved.",
    "Proprietary/short": "All rights reserved.",
    "MIT/title": "The MIT License",
    "MIT/grant":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software.",
    "MIT/text":
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, '
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall "
        'be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    "BSD-2-Clause/text":
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
        "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
        "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause/text":
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
        'prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
        "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
        "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY "
        "OF SUCH DAMAGE.",
    "BSD-3-Clause/first line": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "ISC/grant":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense/grant":
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    "Apache-2.0/header":
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the "
        "License.",
    "Apache-2.0/title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "MPL-2.0/header":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MPL-2.0/title": "Mozilla Public License Version 2.0",
    "GPL-3.0/header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU "
        "General Public License along with this program. If not, see",
    "GPL-3.0/title": "GNU General Public License Version 3, 29 June 2007",
    "GPL-2.0/header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU "
        "General Public License along with this program. If not, see",
    "GPL-2.0/title": "GNU General Public License Version 2, June 1991",
    "LGPL-3.0/header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy "
        "of the GNU Lesser General Public License along with this program. If not, see",
    "LGPL-3.0/title": "GNU Lesser General Public License Version 3, 29 June 2007",
    "LGPL-2.1/header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have "
        "received a copy of the GNU Lesser General Public License along with this program. If not, see",
    "LGPL-2.1/title": "GNU Lesser General Public License Version 2.1, February 1999",
    "AGPL-3.0/header":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy "
        "of the GNU Affero General Public License along with this program. If not, see",
    "AGPL-3.0/title": "GNU Affero General Public License Version 3, 19 November 2007",
    "MIT/SPDX": "SPDX-License-Identifier: MIT",
    "Apache-2.0/SPDX": "SPDX-License-Identifier: Apache-2.0",
    "BSD-2-Clause/SPDX": "SPDX-License-Identifier: BSD-2-Clause",
    "BSD-3-Clause/SPDX": "SPDX-License-Identifier: BSD-3-Clause",
    "ISC/SPDX": "SPDX-License-Identifier: ISC",
    "MPL-2.0/SPDX": "SPDX-License-Identifier: MPL-2.0",
    "Unlicense/SPDX": "SPDX-License-Identifier: Unlicense",
    "CC0-1.0/SPDX": "SPDX-License-Identifier: CC0-1.0",
    "CC-BY-4.0/SPDX": "SPDX-License-Identifier: CC-BY-4.0",
    "GPL-3.0/SPDX only": "SPDX-License-Identifier: GPL-3.0-only",
    "GPL-3.0/SPDX or-later": "SPDX-License-Identifier: GPL-3.0-or-later",
    "GPL-2.0/SPDX only": "SPDX-License-Identifier: GPL-2.0-only",
    "GPL-2.0/SPDX or-later": "SPDX-License-Identifier: GPL-2.0-or-later",
    "LGPL-3.0/SPDX only": "SPDX-License-Identifier: LGPL-3.0-only",
    "LGPL-3.0/SPDX or-later": "SPDX-License-Identifier: LGPL-3.0-or-later",
    "LGPL-2.1/SPDX only": "SPDX-License-Identifier: LGPL-2.1-only",
    "LGPL-2.1/SPDX or-later": "SPDX-License-Identifier: LGPL-2.1-or-later",
    "AGPL-3.0/SPDX only": "SPDX-License-Identifier: AGPL-3.0-only",
    "AGPL-3.0/SPDX or-later": "SPDX-License-Identifier: AGPL-3.0-or-later",
}
LICENSE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.-][^/]*)?$"


def _terms(line: Column) -> Column:
    """Lower-case words of letters, digits, inner dots and hyphens."""
    plain = F.regexp_replace(F.lower(line), r"[^\p{L}\p{Nd}.\-]+", " ")
    return F.filter(F.transform(F.split(plain, " "), lambda w: F.regexp_replace(w, r"^[.\-]+|[.\-]+$", "")), lambda w: w != "")


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "licence string, statement string")
    return rows.select("licence", _terms(F.col("statement")).alias("terms"))


def term_weights(files: DataFrame, templates: DataFrame) -> DataFrame:
    """A row with all template terms' weights (map) and the weight of others."""
    vocabulary = templates.select(F.explode("terms").alias("term")).distinct()
    listed = vocabulary.agg(F.sort_array(F.collect_list("term")).alias("vocabulary"))       # the templates' words
    with_term = (files.join(F.broadcast(listed)).select(F.explode(F.array_intersect(
        F.array_distinct(_terms(F.coalesce("text", F.lit("")))), "vocabulary")).alias("term"))
        .groupBy("term").agg(F.count("*").alias("df")))
    total = files.agg(F.count("*").alias("n")).withColumn("m", F.least("n", F.lit(WEIGHT_FILES)))
    scaled = F.coalesce(F.try_divide(F.coalesce("df", F.lit(0)) * F.col("m"), F.col("n")), F.lit(0.0))
    known = (vocabulary.join(F.broadcast(with_term), "term", "left").join(F.broadcast(total))
             .select("term", (F.log((1 + F.col("m")) / (1 + scaled)) + 1).alias("w")))
    return (known.agg(F.map_from_entries(F.collect_list(F.struct("term", "w"))).alias("weights"))
            .join(F.broadcast(total)).withColumn("other", F.log(1.0 + F.col("m")) + 1).drop("n", "m"))


_COUNT = "(size({t}) - size(array_remove({t}, {x})))"
_VECTOR = (f"transform(array_distinct({{t}}), x -> named_struct('t', x, 'w', {_COUNT.format(t='{t}', x='x')} * coalesce(element_at(weights, x), other), "
           "'b', coalesce(element_at(weights, x), other)))")
_NORM = "sqrt(aggregate({v}, 0D, (a, x) -> a + x.w * x.w))"
_SLACK = 1 - 1e-6           # for the rounding of sums


def _models(base: DataFrame, weights: DataFrame, min_cosine: float) -> DataFrame:
    """A row: models (licence, terms with their weights, norm, number of words,
    ``heavy``: words of which a window needs one at least, and ``need``: the
    squared norm of the words that it needs), keys (all heavy words) and vocabulary."""
    heavy = """aggregate(array_sort(v, (a, b) -> IF(a.w > b.w, -1, IF(a.w < b.w, 1, 0))),
        named_struct('rest', norm * norm, 't', CAST(array() AS array<string>)),
        (a, x) -> IF(a.rest >= need, named_struct('rest', a.rest - x.w * x.w, 't', concat(a.t, array(x.t))), a), a -> a.t)"""
    return (base.join(F.broadcast(weights)).withColumn("v", F.expr(_VECTOR.format(t="terms")))
            .withColumn("norm", F.expr(_NORM.format(v="v"))).filter("norm > 0")
            .withColumn("need", F.col("norm") * F.col("norm") * F.lit(min_cosine * min_cosine * _SLACK))
            .withColumn("heavy", F.expr(heavy)).withColumn("words", F.size("terms"))
            .agg(F.sort_array(F.collect_list(F.struct("licence", "v", "norm", "words", "heavy", "need"))).alias("models"))
            .withColumn("keys", F.expr("array_distinct(flatten(transform(models, m -> m.heavy)))"))
            .withColumn("vocabulary", F.expr("array_distinct(flatten(transform(models, m -> transform(m.v, x -> x.t))))")))


_REACHES = "arrays_overlap({t}, m.heavy) AND aggregate(m.v, 0D, (a, x) -> a + IF(array_contains({t}, x.t), x.w * x.w, 0D)) >= m.need"
# Numbers of lines of the windows from line i on.
_LENGTHS = """
transform(array(aggregate(slice(counts, i + 1, m.words), named_struct('n', 0, 's', 0),
    (a, c) -> IF(a.s >= m.words, a, named_struct('n', a.n + 1, 's', a.s + c)), a -> a.n)),
  n -> array_distinct(concat(filter(transform(sequence(0, 30), k -> shiftleft(1, k)), k -> k < n), array(n),
    IF(i = 0 AND n_words <= 2 * m.words, array(n_lines), CAST(array() AS array<int>)))))[0]"""
_SCORE = (f"round(aggregate(m.v, 0D, (a, x) -> a + x.w * {_COUNT.format(t='t', x='x.t')} * x.b) "
          f"/ sqrt(aggregate(array_distinct(t), 0D, (a, x) -> a + pow({_COUNT.format(t='t', x='x')} * coalesce(element_at(weights, x), other), 2))) / m.norm, 9)")
_COVERED = """
forall(named, t -> t[0] = 'copyright' OR 2 * size(array_intersect(t, transform(best_model.v, x -> x.t))) >= size(array_distinct(t)))"""


# Each line is a statement, and the best statements of all lines name one
# licence: one pass over the lines' scores, best first.
_SINGLE = """
aggregate(array_sort(transform(filter(best, b -> b.n = -1), b -> named_struct('nth', b.nth, 'less', -b.score, 'name', substring_index(b.licence, '/', 1)))),
  named_struct('nth', 1, 'less', 0D, 'name', CAST(NULL AS STRING), 'lines', 0, 'one', true),
  (a, x) -> IF(x.nth = a.nth AND x.less > a.less, a, named_struct('nth', x.nth, 'less', x.less, 'name', x.name,
    'lines', a.lines + IF(x.nth = a.nth, 0, 1), 'one', a.one AND (a.name IS NULL OR a.name = x.name))),
  a -> a.one AND a.lines = n_lines)"""


def statements(files: DataFrame, templates: dict[str, str] | None = None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """files (id, path, text) -> id, path, licence, score, whole (it is a
    licence and nothing else)."""
    spark = files.sparkSession
    base = written(_templates(spark, templates or TEMPLATES), "templates")
    weights = written(term_weights(files, base), "weights")
    models = written(_models(base, weights, min_cosine), "models")
    # Files whose words cannot reach a template have no lines to compare.
    rows = (files.join(F.broadcast(models))
            .withColumn("known", F.array_intersect(F.array_distinct(_terms(F.coalesce("text", F.lit("")))), "vocabulary"))
            .withColumn("near", F.expr(f"CASE WHEN arrays_overlap(known, keys) THEN filter(models, m -> {_REACHES.format(t='known')}) END"))
            .withColumn("_lines", F.when(F.size("near") > 0, F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[\p{L}\p{Nd}]"))))
            .withColumn("named", F.filter(F.transform("_lines", _terms), lambda t: F.size(t) > 0))
            .select("id", "path", "near", "named")
            .withColumn("counts", F.expr("transform(named, t -> size(t))")).withColumn("n_lines", F.size("named"))
            .withColumn("n_words", F.expr("aggregate(counts, 0, (a, c) -> a + c)")))
    rows = written(rows, "near")
    found = (rows.join(F.broadcast(weights))
             .withColumn("best", F.expr(f"""
               flatten(transform(near, (m, at) -> flatten(transform(IF(n_lines > 0, sequence(0, n_lines - 1), CAST(array() AS array<int>)), i ->
                 flatten(transform({_LENGTHS}, n -> transform(filter(array(flatten(slice(named, i + 1, n))), t -> {_REACHES.format(t='t')}), t ->
                   named_struct('score', {_SCORE}, 'nth', -i, 'n', -n, 'licence', m.licence, 'at', at))))))))"""))
             .withColumn("best", F.expr(f"filter(best, b -> b.score >= {min_cosine})"))
             .withColumn("top", F.array_max("best"))
             .withColumn("entire", F.array_max(F.filter("best", lambda b: -b["n"] == F.col("n_lines"))))
             .withColumn("best_model", F.expr("get(near, entire.at)")))
    top, name = F.col("top"), lambda c: F.substring_index(c, "/", 1)
    return found.select("id", "path", name(top["licence"]).alias("licence"), top["score"].alias("score"),
                        F.coalesce((F.col("n_lines") > 0) & (F.expr(_SINGLE) | F.expr(_COVERED)), F.lit(False)).alias("whole"))


def _directory(path: Column) -> Column:
    """The directory of a path, without a slash at its end ('' for the root)."""
    return F.regexp_replace(F.regexp_replace(path, "/+", "/"), "/?[^/]*$", "")


def licence_scan(files: DataFrame, templates: dict[str, str] | None = None, min_cosine: float = MIN_COSINE) -> DataFrame:
    """files (id, path, text) -> id, path, licence, score, origin ('own',
    'inherited' or null), licence_path (the licence file it comes from)."""
    stated = written(statements(files.select("id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text")),
                                templates, min_cosine).withColumn("directory", _directory(F.col("path"))), "statements")
    holders = written(stated.filter(F.col("path").isNotNull() & F.col("licence").isNotNull()
                                    & (F.col("whole") | F.col("path").rlike(LICENSE_NAMES)))
                      .groupBy("directory").agg(F.min(F.struct("path", "licence")).alias("from")), "holders")
    # Every directory that occurs, with itself and the directories above it.
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    folders = (stated.filter("path IS NOT NULL AND licence IS NULL").select("directory").distinct()
               .select("directory", F.explode(F.array_distinct(above)).alias("upper")))
    nearest = written(folders.join(holders.withColumnRenamed("directory", "upper"), "upper").groupBy("directory")
                      .agg(F.max_by("from", F.length("upper")).alias("from")), "nearest")
    own = stated.filter("licence IS NOT NULL OR path IS NULL").select(
        "id", "path", "licence", "score", F.when(F.col("licence").isNotNull(), "own").alias("origin"), F.lit(None).cast("string").alias("licence_path"))
    rest = (stated.filter("licence IS NULL AND path IS NOT NULL").join(nearest, "directory", "left")
            .select("id", "path", F.col("from.licence").alias("licence"), F.lit(None).cast("double").alias("score"),
                    F.when(F.col("from").isNotNull(), "inherited").alias("origin"), F.col("from.path").alias("licence_path")))
    return own.unionByName(rest)


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source/language/doc_id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licence_scan(docs.select(F.col("doc_id").alias("id"), path.alias("path"), "text")).withColumnRenamed("id", "doc_id")
