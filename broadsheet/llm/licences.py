"""Licence scans: TF-IDF cosine of statements to templates, then inheritance along paths.

A file's statements are its lines (for pages: the text between tags) with a word that begins
with "licen", its paragraphs with such a word or the opening words of a licence, and, where
words of a licence's text occur, the whole file. Equal statements are one, whatever the number
of files that carry them. Each statement is a sparse vector over words, weighed by how rare a
word is among the templates, so a score does not depend on other files; a template is matched
when the cosine reaches ``COSINE``. Lines and paragraphs meet sentences, headers and titles;
whole files meet whole texts, and one that matches has no other licence. SPDX tags are read as
they stand, each identifier of an expression with score 1.

A file named like a licence file (or the index page of a directory) speaks for its directory.
A file without a statement of its own inherits from its nearest ancestor directory with a
licence; paths are joined on their directory prefixes.

JVM functions only. Null or empty texts have no statement and can inherit; a null path has no
directory. A file that states several licences gets one row for each; rows that repeat a path
and id are kept as they are. Ties in score go to the template's name in order.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import tables

#: Licence names as used in public lists, and sentences that state them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
#: Terms of a header's first paragraph; GNU headers differ in name and version only.
GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the {} "
    "as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
)
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    *((f"GPL-{v}.0", GNU.format("GNU General Public License", v)) for v in (2, 3)),
    *((f"LGPL-{v}", GNU.format("GNU Lesser General Public License", v)) for v in ("2.1", "3.0")),
    ("LGPL-3.0", GNU.format("GNU Lesser General Public License", "3")),
    ("AGPL-3.0", GNU.format("GNU Affero General Public License", "3")),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("ISC", "ISC License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
)
TEXTS = Path(__file__).parent / "licence_texts"
COSINE = 0.75
#: Opening words of licences that need not name themselves, and words of whole texts.
OPENS = r"(?i)\blicen|permission\s+is\s+hereby\s+granted|permission\s+to\s+use,\s+copy"
WHOLE = r"(?i)permission\s+is\s+hereby\s+granted|permission\s+to\s+use,\s+copy|redistribution\s+and\s+use\s+in\s+source|terms\s+and\s+conditions|covered\s+software|additional\s+definitions"
TAG = "[A-Za-z0-9][A-Za-z0-9.+-]*"
SPDX = rf"SPDX-License-Identifier:[ \t]*(\(*{TAG}\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*{TAG}\)*)*)"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def weighed(rows: DataFrame, key: str, rarity: DataFrame, total: int) -> DataFrame:
    """(key, word, weight): word counts times rarity, scaled to length 1."""
    counts = rows.select(key, F.explode("words").alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))
    each = counts.join(rarity, "word", "left").select(
        key, "word", (F.col("n") * F.coalesce("rare", F.log(F.lit(1.0 + total)))).alias("w")
    )
    norms = each.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return each.join(norms, key).select(key, "word", (F.col("w") / F.col("norm")).alias("weight"))


def templates() -> list[tuple[int, str, str, bool]]:
    """(template, licence, text, whole). The AGPL's text is taken from the GPL's, with its name."""
    whole = {p.name.removesuffix(".txt"): p.read_text() for p in sorted(TEXTS.glob("*.txt"))}
    gpl = whole["GPL-3.0"]
    for name in ("General Public License", "GENERAL PUBLIC LICENSE"):
        gpl = gpl.replace(f"GNU {name}", f"GNU {'AFFERO' if name.isupper() else 'Affero'} {name}")
    whole["AGPL-3.0"] = gpl
    rows = [(n, t, False) for n, t in TEMPLATES + HEADERS] + [(n, t, True) for n, t in whole.items()]
    return [(i, *r) for i, r in enumerate(rows)]


def statements(files: DataFrame) -> DataFrame:
    """(file, path, statement, whole, key): lines, tag contents, paragraphs and whole files.

    Words are counted by key, a hash, so that no row carries a whole file for each of its words.
    """
    text = F.when(F.col("text").rlike(f"{OPENS}|{WHOLE}"), F.col("text"))
    tagless = F.regexp_replace(text, r"</?[A-Za-z][^<>]{0,2000}>", "\n\n")
    lines = F.filter(F.split(tagless, r"\n"), lambda x: x.rlike(r"(?i)\blicen"))
    blocks = F.filter(F.split(tagless, r"\n(?:[ \t\r*/#;-]*\n)+"), lambda x: x.rlike(OPENS))
    parts = F.array_distinct(
        F.transform(F.concat(lines, blocks), lambda x: F.struct(F.array_join(words_of(x), " ").alias("statement"), F.lit(False).alias("whole")))
    )
    all_of = F.when(text.rlike(WHOLE), F.array(F.struct(F.array_join(words_of(tagless), " ").alias("statement"), F.lit(True).alias("whole"))))
    none = F.array().cast("array<struct<statement:string,whole:boolean>>")
    return files.select("file", "path", F.explode(F.concat(parts, F.coalesce(all_of, none))).alias("x")).select(
        "file", "path", "x.statement", "x.whole"
    ).withColumn("key", F.concat(F.when(F.col("whole"), "w").otherwise("p"), F.sha2("statement", 256)))


def tagged(files: DataFrame) -> DataFrame:
    """(file, path, licence, score) of SPDX tags, without -only, -or-later and exceptions."""
    found = F.flatten(F.transform(
        F.regexp_extract_all("text", F.lit(SPDX), F.lit(1)),
        lambda x: F.regexp_extract_all(F.regexp_replace(x, rf"WITH[ \t]+\(*{TAG}|\b(AND|OR)\b", ""), F.lit(TAG), F.lit(0)),
    ))
    return files.select("file", "path", F.explode(found).alias("tag")).select(
        "file", "path", F.regexp_replace("tag", r"(-only|-or-later|\+)$", "").alias("licence"), F.lit(1.0).alias("score")
    )


def matched(found: DataFrame) -> DataFrame:
    """(key, licence, score) of each different statement's best template."""
    different = found.groupBy("key").agg(F.any_value("statement").alias("statement"))
    different = different.select("key", F.split("statement", " ").alias("words"))
    spark, fixed = found.sparkSession, templates()
    counts = [Counter(re.findall(WORD, t.lower())) for _, _, t, _ in fixed]
    df = Counter(w for c in counts for w in c)
    rare = {w: math.log(1 + len(fixed) / n) for w, n in df.items()}
    norms = [math.sqrt(sum((n * rare[w]) ** 2 for w, n in c.items())) for c in counts]
    rarity = spark.createDataFrame(list(rare.items()), "word string, rare double")
    right = spark.createDataFrame(
        [(i, w, n * rare[w] / norms[i]) for i, c in enumerate(counts) for w, n in c.items()],
        "template int, word string, part double",
    )
    names = spark.createDataFrame([(i, n, whole) for i, n, _, whole in fixed], "template int, licence string, of_whole boolean")
    left = weighed(different, "key", F.broadcast(rarity), len(fixed))
    # The templates are a fixed list; their words are broadcast.
    scores = (
        left.join(F.broadcast(right), "word")
        .groupBy("key", "template")
        .agg(F.sum(F.col("weight") * F.col("part")).alias("score"))
        .filter(F.col("score") >= COSINE)
        .join(F.broadcast(names), "template")
        .filter(F.startswith("key", F.lit("w")) == F.col("of_whole"))
    )
    ordered = scores.groupBy("key").agg(
        F.min(F.struct(-F.round("score", 9), "licence", "score")).alias("best")
    )
    return ordered.select("key", F.col("best.licence").alias("licence"), F.col("best.score").alias("score"))


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def ancestors(path: Column) -> Column:
    """Directory prefixes of a path with their depth."""
    parts = F.split(parent(path), "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")),
    )


def scanned(files: DataFrame) -> DataFrame:
    """file, path, licence, score, basis and origin for every row of ``files``.

    ``files`` has (file, path, text); file is any column that names the row. basis is stated,
    inherited or none; origin is the directory that an inherited licence comes from.
    """
    found = tables.written(statements(files), "statements")
    stated = found.join(matched(found), "key").select("file", "path", "licence", "score", "whole")
    stated = stated.unionByName(tagged(files).withColumn("whole", F.lit(False)))
    each = tables.written(
        stated.groupBy("file", "path", "licence").agg(F.max("score").alias("score"), F.max("whole").alias("whole")),
        "each",
    )
    # A file that is a licence's text has that licence only, whatever others it mentions.
    texts = each.filter("whole").select("file", "path")
    same = F.col("l.file").eqNullSafe(F.col("t.file")) & F.col("l.path").eqNullSafe(F.col("t.path"))
    other = each.filter("NOT whole").alias("l").join(texts.alias("t"), same, "left_anti")
    own = tables.written(each.filter("whole").unionByName(other).drop("whole"), "own")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    speaks = own.filter(name.rlike(LICENCE_FILE) | (name == ""))
    by_dir = (
        speaks.filter(F.col("path").contains("/"))
        .groupBy(parent(F.col("path")).alias("dir"))
        .agg(F.min(F.struct(-F.col("score"), "licence", "score")).alias("best"))
        .select("dir", "best.licence", "best.score")
    )
    silent = files.select("file", "path").join(own.select("file", "path").distinct(), ["file", "path"], "left_anti")
    inherited = (
        silent.filter(F.col("path").contains("/"))
        .select("file", "path", F.explode(ancestors(F.col("path"))).alias("up"))
        .select("file", "path", "up.depth", "up.dir")
        .join(by_dir, "dir")
        .groupBy("file", "path")
        .agg(F.max(F.struct("depth", "dir", "licence", "score")).alias("near"))
        .select("file", "path", "near.licence", "near.score", F.lit("inherited").alias("basis"), F.col("near.dir").alias("origin"))
    )
    direct = own.select("file", "path", "licence", "score", F.lit("stated").alias("basis"), F.lit(None).cast("string").alias("origin"))
    known = direct.unionByName(inherited).withColumnsRenamed({"file": "of", "path": "of_path"})
    return files.select("file", "path").join(
        known, F.col("file").eqNullSafe(F.col("of")) & F.col("path").eqNullSafe(F.col("of_path")), "left"
    ).select("file", "path", "licence", F.round("score", 6).alias("score"), F.coalesce("basis", F.lit("none")).alias("basis"), "origin")


def url_path(url: Column) -> Column:
    """Host and path of a page's address, without scheme, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
