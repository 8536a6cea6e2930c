"""License scans: Dice coefficient over word bigrams between normalised text and licence templates.

Units of a text are its lines, its paragraphs of two or more lines, its runs of adjacent paragraphs with words (the whole
text is one) of no more bigrams than the largest template can be like, and the sentences of lines and paragraphs of
several sentences. Two bigram sets of sizes a and b have a Dice coefficient of 2 min(a, b) / (a + b) at most, so a unit of
size a needs comparing only with templates whose size is from a t / (2 - t) to a (2 - t) / t; a table from sizes to
templates, fixed by the templates alone, finds them. They share b t / (2 - t) bigrams at least, so where some words are in
more of a template's bigrams than the others leave, a text without any of these words is not like it. Each template has
several such groups of words, and a text must have a word of every group of some template.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweft.llm.common import INNER, table
from claimweft.llm.line_dedup import _fixed

THRESHOLD = 0.8

# Notices and texts of well-known licences.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MIT-notice": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-2-Clause-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "LGPL-header": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "AGPL-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "All-rights-reserved": "All rights reserved.",
}

SEPARATORS = "[^\\p{L}\\p{N}]+"


def template_bigrams(text: str) -> list[str]:
    """The distinct bigrams of the normalised text, in order."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_table(templates: dict[str, str], threshold: float) -> list[tuple[int, str, list[str]]]:
    """(size of a unit, template, its bigrams) for each size within the bounds of each template."""
    rows = []
    for name, text in sorted(templates.items()):
        grams = template_bigrams(text)
        b = len(grams)
        if b:
            low, high = b * threshold / (2 - threshold), b * (2 - threshold) / threshold
            rows += [(a, name, grams) for a in range(max(1, math.ceil(low - 1e-9)), math.floor(high + 1e-9) + 1)]
    return rows


# Words that are frequent everywhere and tell little.
FREQUENT = ("a", "all", "an", "and", "any", "are", "as", "at", "be", "but", "by", "can", "for", "from", "has", "if", "in", "is", "it", "may", "must", "no", "not", "of", "on", "one", "or", "that", "the", "this", "to", "use", "was", "will", "with", "you", "your")


def telling_groups(text: str, threshold: float) -> list[list[str]]:
    """Groups of words; each text that is like the template has a word of every group. Rare and long words come first."""
    grams = [g.split(" ") for g in template_bigrams(text)]
    least = math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)
    words = sorted({w for g in grams for w in g}, key=lambda w: (w in FREQUENT, -len(w), w))
    out: list[list[str]] = []
    while True:
        group, left = [], grams
        for word in words:
            if len(left) < least:
                break
            if any(word in g for g in left):
                group.append(word)
                left = [g for g in left if word not in g]
        if len(left) >= least or not group:
            return out
        out.append(group)
        words = [w for w in words if w not in group]


def bigram_set(text: Column) -> tuple[Column, Column]:
    """Words of the normalised text; how to make bigrams of the words once they are a column."""
    words = F.filter(F.split(F.regexp_replace(F.lower(text), SEPARATORS, " "), " "), lambda w: w != "")
    return words, lambda w: F.array_distinct(F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Units of the texts that are like a licence: doc_id, unit, place (its number from 0), license, dice.

    The place of a sentence is that of its line ("sentence") or, if it goes over several lines, of its paragraph
    ("wrapped sentence"); that of a run is its first paragraph's; several of one place may be found. A unit gets its best
    template, by name among equals. Null and empty texts and units of fewer than two words have no match. Repeated rows
    give repeated matches. No shuffle: the templates' table is fixed and small.
    """
    spark = docs.sparkSession
    table_rows = size_table(templates, threshold)
    most = max((r[0] for r in table_rows), default=0)
    groups = {name: telling_groups(t, threshold) for name, t in templates.items()}
    telling = sorted({w for gs in groups.values() for g in gs for w in g})
    literal = lambda ws: F.array(*map(F.lit, ws))

    def telling_only(df: DataFrame, words: Column) -> DataFrame:
        """The rows whose words have one of every group of some template."""
        held = _fixed(df, **{present: F.array_intersect(words, literal(telling))})
        like = (reduce(lambda a, b: a & b, (F.arrays_overlap(present, literal(g)) for g in gs), F.lit(True)) for gs in groups.values())
        return held.where(reduce(lambda a, b: a | b, like, F.lit(False))).drop(present)

    text, present, lines, blocks, worded, parts = (f"{INNER}{n}" for n in ("text", "present", "lines", "blocks", "worded", "parts"))
    plain = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text))
    base = telling_only(plain, F.split(F.lower(text), SEPARATORS, -1))
    unit = lambda name, i, t: F.struct(F.lit(name).alias("unit"), i.alias("place"), t.alias("part"))
    base = _fixed(base, **{lines: F.split(text, "\n", -1), blocks: F.split(text, "\n[ \t\r]*\n", -1)})

    def sentences(of: str, name: str, keep) -> Column:
        each = lambda t, i: F.transform(F.filter(F.split(t, "(?<=[.!?])[ \t\r\n]+", -1), lambda x: keep(x, t)), lambda x: unit(name, i, x))
        return F.flatten(F.transform(of, each))

    several = F.concat(
        F.transform(lines, lambda t, i: unit("line", i, t)), F.filter(F.transform(blocks, lambda t, i: unit("paragraph", i, t)), lambda u: F.contains(u["part"], F.lit("\n"))),
        sentences(lines, "sentence", lambda x, t: F.length(x) < F.length(F.trim(t))), sentences(blocks, "wrapped sentence", lambda x, t: F.contains(x, F.lit("\n")) & (F.length(x) < F.length(F.trim(t)))),
    )
    units = base.select("doc_id", F.explode(several).alias("u")).select("doc_id", "u.unit", "u.place", "u.part")
    words, grams = bigram_set(F.col("part"))
    single = telling_only(_fixed(units, **{worded: words}).drop("part"), F.col(worded))
    # runs: from each paragraph as many as follow it within the largest size
    spoken = F.filter(F.transform(blocks, lambda t, i: F.struct(i.alias("place"), bigram_set(t)[0].alias("w"))), lambda p: F.size(p["w"]) > 0)
    parted = _fixed(base.where(F.size(blocks) > 1), **{parts: spoken})
    step = lambda s, p: F.struct((s["n"] + F.size(p["w"])).alias("n"), F.when(s["n"] + F.size(p["w"]) <= most + 1, s["k"] + 1).otherwise(s["k"]).alias("k"))
    follow = lambda i: F.aggregate(F.slice(parts, i + 1, most + 1), F.struct(F.lit(0).alias("n"), F.lit(0).alias("k")), step, lambda s: s["k"])
    reach = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.struct(i.alias("i"), follow(i).alias("k")))
    longer = parted.where(F.size(parts) > 1).select("doc_id", parts, F.explode(F.filter(reach, lambda r: r["k"] > 1)).alias("r"))
    longer = longer.select("doc_id", F.explode(F.transform(F.sequence(F.lit(2), F.col("r.k")), lambda k: F.slice(parts, F.col("r.i") + 1, k))).alias("p"))
    runs = _fixed(longer, **{worded: F.flatten(F.transform("p", lambda p: p["w"]))}).select("doc_id", F.lit("run").alias("unit"), F.get("p", F.lit(0))["place"].alias("place"), worded)
    sized = _fixed(single.unionByName(telling_only(runs, F.col(worded))), **{f"{INNER}grams": grams(F.col(worded))}).drop(worded).withColumn(f"{INNER}size", F.size(f"{INNER}grams"))
    by_size = _literal(spark, table_rows).groupBy("size").agg(F.collect_list(F.struct("license", "rank", "grams")).alias("near"))
    found = sized.join(F.broadcast(by_size), F.col(f"{INNER}size") == F.col("size"))

    def likeness(t: Column) -> Column:
        common = F.size(F.array_intersect(f"{INNER}grams", t["grams"]))
        return F.struct(F.round(2.0 * common / (F.col("size") + F.size(t["grams"])), 6).alias("dice"), t["rank"].alias("rank"), t["license"].alias("license"))

    best = found.select("doc_id", "unit", "place", F.array_max(F.transform("near", likeness)).alias("b"))
    return best.where(F.col("b.dice") >= threshold).select("doc_id", "unit", "place", "b.license", "b.dice")


def _literal(spark: SparkSession, rows: list[tuple[int, str, list[str]]]) -> DataFrame:
    """The size table as a frame made from one JSON literal; rank is larger for names that come first."""
    import json

    names = sorted({r[1] for r in rows}, reverse=True)
    grams = {n: g for _, n, g in rows}
    by_name = json.dumps([{"license": n, "rank": names.index(n), "grams": g, "sizes": [s for s, m, _ in rows if m == n]} for n, g in grams.items()])
    kind = "array<struct<license:string,rank:int,grams:array<string>,sizes:array<int>>>"
    return spark.range(1).select(F.explode(F.from_json(F.lit(by_name), kind)).alias("t")).select("t.license", "t.rank", "t.grams", F.explode("t.sizes").alias("size"))


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """All findings in all documents; see ``scan`` for nulls, empty texts and repeated rows."""
    return scan(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))


def oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(n)}, [{', '.join(map(quoted, template_bigrams(t)))}])" for n, t in sorted(TEMPLATES.items()))
    most = max(r[0] for r in size_table(TEMPLATES, THRESHOLD))
    words = "list_filter(string_split(regexp_replace(lower(part), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')".replace("\\\\", "\\")
    split = lambda t: f"string_split(regexp_replace({t}, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), chr(1))"
    return f"""
WITH templates(license, grams) AS (VALUES {rows}),
lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place, unnest(string_split(text, chr(10))) AS part FROM documents WHERE text IS NOT NULL
), blocks AS (
  SELECT doc_id, generate_subscripts(string_split_regex(text, '\n[ \t\r]*\n'), 1) - 1 AS place, unnest(string_split_regex(text, '\n[ \t\r]*\n')) AS part FROM documents WHERE text IS NOT NULL
), spoken AS (
  SELECT *, len(w) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY place) AS upto FROM (SELECT doc_id, place, {words} AS w FROM blocks) WHERE len(w) > 0
), single AS (
  SELECT doc_id, 'line' AS unit, place, part FROM lines
  UNION ALL SELECT doc_id, 'paragraph', place, part FROM blocks WHERE contains(part, chr(10))
  UNION ALL SELECT doc_id, 'sentence', place, x FROM (SELECT doc_id, place, part AS t, unnest({split('part')}) AS x FROM lines) WHERE length(x) < length(trim(t, ' '))
  UNION ALL SELECT doc_id, 'wrapped sentence', place, x FROM (SELECT doc_id, place, part AS t, unnest({split('part')}) AS x FROM blocks) WHERE length(x) < length(trim(t, ' ')) AND contains(x, chr(10))
), worded AS (
  SELECT doc_id, unit, place, {words} AS w FROM single
  UNION ALL SELECT doc_id, 'run', place, w FROM (
    SELECT a.doc_id, a.place, b.k, flatten(list(c.w ORDER BY c.k)) AS w FROM spoken a
    JOIN spoken b ON a.doc_id = b.doc_id AND b.k > a.k AND b.upto - a.upto + a.n <= {most + 1} JOIN spoken c ON a.doc_id = c.doc_id AND c.k BETWEEN a.k AND b.k GROUP BY ALL)
), bigrams AS (
  SELECT doc_id, unit, place, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g, row_number() OVER () AS u FROM worded WHERE len(w) > 1
), scored AS (
  SELECT doc_id, unit, place, u, license, round(2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)), 6) AS dice
  FROM bigrams, templates WHERE len(g) BETWEEN len(grams) * {THRESHOLD} / {2 - THRESHOLD} - 0.001 AND len(grams) * {2 - THRESHOLD} / {THRESHOLD} + 0.001
)
SELECT doc_id, unit, place::INT AS place, license, dice FROM scored WHERE dice >= {THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY u ORDER BY dice DESC, license) = 1
"""
