"""Licence texts and notices in documents, by Dice's coefficient over word bigrams.

A text is normalised to lower-case letters and digits with single spaces; its bag of pairs of
neighbouring words is compared with that of each template: 2 * common / (own + template's), where a pair
that both have several times is common as often as the one that has it less often. Units compared
are every line of a document and the document as a whole; with `windows` also runs of as many words as
a template has, across lines and within them. They are placed so that a word pair stands where the template has it, for every
pair of the template found; of windows that overlap the best one per template counts, at the line it begins on.
A window over a line that matches by itself and is long enough for that template is left to the line, and a
document that matches as a whole has no windows.

The number of words alone prunes: a unit of n pairs and a template of b can only reach the threshold if
200 * min(n, b) >= percent * (n + b). Pairs are made of the units that fit some template, and compared with
those it fits.

Templates are a fixed list held in the plan as a constant, about twenty texts; everything happens within a row, so
documents are neither shuffled nor joined.

Defined cases. Null counts as empty; an empty text matches nothing, as do units of fewer than two words.
Ids may be null or repeat; every row is scanned by itself and other columns are not read. Equally
good templates are all reported, in the order of their names. An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from match_lake.llm.words import text_or_empty

PERCENT = 80

# Public licence texts and the notices that refer to them, by SPDX identifier.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall
be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("BSD-2-Clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", f"{_BSD_HEAD} {_BSD_NAME} {_BSD_TAIL}"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a
copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of
this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered
from any source distribution."""),
)

# What is neither a letter, a digit nor the end of a line.
GAP = r"[^\p{L}\p{N}\n]+"


def template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def known_templates() -> list[tuple[str, list[str]]]:
    """Licence and word pairs, repeats included."""
    return [(name, [f"{a} {b}" for a, b in zip(w, w[1:])]) for name, w in ((name, template_words(t)) for name, t in TEMPLATES)]


def least_common(b: int, percent: int) -> int:
    """Of a template of b pairs, as many at least are in any unit at the threshold."""
    return -(-percent * b // (200 - percent))


def template_column(percent: int) -> Column:
    """name, pairs, and how many different pairs any unit at the threshold holds at least."""
    return F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.array(*[F.lit(b) for b in pairs]).alias("pairs"),
            F.lit(len(set(pairs)) - len(pairs) + least_common(len(pairs), percent)).alias("least"),
        )
        for name, pairs in known_templates()
    ])


# Frequent words, which tell little.
PLAIN = frozenset("the of and or to in a is this any for with not be you that it by on as at are from may must have if all an no can see work free use".split())


def telling_words(percent: int) -> list[str]:
    """Words of which every unit at the threshold has one: without them too few pairs of its template are left."""
    chosen: set[str] = set()
    for _, pairs in known_templates():
        while sum(not chosen & set(p.split()) for p in pairs) >= least_common(len(pairs), percent):
            left = [w for p in pairs if not chosen & set(p.split()) for w in p.split()]
            chosen.add(max(left, key=lambda w: (w not in PLAIN and not w.isdigit(), left.count(w), len(w), w)))
    return sorted(chosen)


def fits(n: Column | int, b: Column | int, percent: int) -> Column | bool:
    if isinstance(n, int):
        return 200 * min(n, b) >= percent * (n + b)
    return F.least(n, b) * 200 >= (n + b) * percent


def pairs_of(text: Column) -> Column:
    words = F.split(text, " ")
    return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))


def times(pairs: Column, pair: Column) -> Column:
    return F.size(F.filter(pairs, lambda p: p == pair))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, windows: bool = False) -> DataFrame:
    """One row per row of `docs`: id, matches (license, line, percent) at or above `percent`; line 0 is the whole text.

    With `windows` also licences that are a part of a longer text or line, at the line they begin on.
    """
    sizes = [len(pairs) for _, pairs in known_templates()]
    possible = F.array(*[F.lit(any(fits(n, b, percent) for b in sizes)) for n in range(1 + max(sizes) * (200 - percent) // percent)])

    def common(own: Column, template: Column) -> Column:
        both = F.array_intersect(own, template)
        return F.aggregate(both, F.lit(0), lambda total, pair: total + F.least(times(own, pair), times(template, pair)))

    def scores(unit: Column) -> Column:
        fitting = F.filter("templates", lambda t: fits(unit["n"], F.size(t["pairs"]), percent))
        return F.transform(fitting, lambda t: F.struct(
            t["name"].alias("license"), unit["line"].alias("line"),
            F.floor(common(unit["pairs"], t["pairs"]) * 200 / (unit["n"] + F.size(t["pairs"]))).cast("int").alias("percent"),
        ))

    plain = F.regexp_replace(F.lower(text_or_empty(text)), GAP, " ")
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.transform(F.split(plain, "\n"), lambda line: F.trim(line)).alias("lines"))
    counted = F.transform("lines", lambda line, i: F.struct(
        (i + 1).alias("line"), line.alias("text"), (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))).alias("n")
    ))
    found = found.select("id", "lines", counted.alias("units"))
    words = F.aggregate("units", F.lit(0), lambda total, u: total + u["n"] + F.when(u["text"] == "", 0).otherwise(1))
    fitting = F.filter("units", lambda u: F.coalesce(F.get(possible, u["n"]), F.lit(False)))
    found = found.select("id", "lines", fitting.alias("units"), (words - 1).alias("n"))
    whole = F.struct(F.lit(0).alias("line"), F.array_join(F.filter("lines", lambda line: line != ""), " ").alias("text"), F.col("n"))
    is_unit = (F.size("lines") > 1) & (F.col("n") > 0) & F.coalesce(F.get(possible, F.greatest(F.col("n"), F.lit(0))), F.lit(False))
    found = found.select("id", "lines", F.when(is_unit, F.concat(F.array(whole), F.col("units"))).otherwise(F.col("units")).alias("units"))
    paired = F.transform("units", lambda u: F.struct(u["line"].alias("line"), u["n"].alias("n"), pairs_of(u["text"]).alias("pairs")))
    found = found.select("id", "lines", paired.alias("units"), template_column(percent).alias("templates"))
    matches = F.filter(F.flatten(F.transform("units", scores)), lambda m: m["percent"] >= percent)
    if not windows:
        return found.select(F.col("id").alias(id_col), F.array_sort(F.array_distinct(matches)).alias("matches"))
    found = found.select("id", "lines", "units", matches.alias("matches"))
    own = F.filter("units", lambda u: F.exists("matches", lambda m: m["line"] == u["line"]))
    telling = f"(?:^| )(?:{'|'.join(telling_words(percent))})(?: |$)"
    may_hold = F.exists("lines", lambda line: line.rlike(telling)) & ~F.exists("matches", lambda m: m["line"] == 0)
    # Of the many documents without a telling word none of the following is computed.
    by_line = F.transform("lines", lambda line, i: F.when(line == "", F.array().cast("array<struct<word:string,line:int>>")).otherwise(
        F.transform(F.split(line, " "), lambda word: F.struct(word.alias("word"), (i + 1).alias("line")))
    ))
    found = found.select("id", "matches", F.transform(own, lambda u: F.struct(u["line"].alias("line"), u["n"].alias("n"))).alias("own"), F.when(may_hold, F.flatten(by_line)).alias("words"))
    found = found.select("id", "matches", "own", F.col("words.line").alias("at"), F.when(
        F.size("words") > 1, pairs_of(F.array_join(F.col("words.word"), " "))
    ).alias("own_pairs"))
    # What of a template a window at the threshold may lack at most leaves this many of its different pairs.
    held = F.filter(template_column(percent), lambda t: F.size(F.array_intersect("own_pairs", t["pairs"])) >= t["least"])
    found = found.select("id", "matches", "own", "at", "own_pairs", F.when(F.col("own_pairs").isNotNull(), held).alias("templates"))

    def passages(t: Column) -> Column:
        b = F.size(t["pairs"])
        # Each pair of the text that the template has, as often as the template has it.
        starts = F.array_distinct(F.flatten(F.transform("own_pairs", lambda pair, i: F.transform(
            F.filter(F.transform(t["pairs"], lambda p, j: F.when(p == pair, j)), lambda j: j.isNotNull()), lambda j: F.greatest(F.lit(0), i - j)
        ))))
        cut = F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice("own_pairs", s + 1, b).alias("pairs")))
        near = F.filter(cut, lambda c: F.size(F.array_intersect(c["pairs"], t["pairs"])) >= t["least"])
        rated = F.transform(near, lambda c: F.struct(
            F.floor(-common(c["pairs"], t["pairs"]) * 200 / (F.size(c["pairs"]) + b)).cast("int").alias("order"), c["start"].alias("start"), F.size(c["pairs"]).alias("n"),
            F.floor(common(c["pairs"], t["pairs"]) * 200 / (F.size(c["pairs"]) + b)).cast("int").alias("percent"),
            F.element_at("at", c["start"] + 1).alias("line"), F.element_at("at", c["start"] + F.size(c["pairs"]) + 1).alias("last"),
        ))
        good = F.filter(rated, lambda c: (c["percent"] >= percent) & ~F.exists(
            "own", lambda u: (u["line"] >= c["line"]) & (u["line"] <= c["last"]) & fits(u["n"], b, percent)
        ))
        best = F.aggregate(
            F.array_sort(good), F.array().cast("array<struct<order:int,start:int,n:int,percent:int,line:int,last:int>>"),
            lambda taken, c: F.when(F.exists(taken, lambda o: (c["start"] <= o["start"] + o["n"]) & (o["start"] <= c["start"] + c["n"])), taken).otherwise(F.concat(taken, F.array(c))),
        )
        return F.transform(best, lambda c: F.struct(t["name"].alias("license"), c["line"].alias("line"), c["percent"].alias("percent")))

    inside = F.coalesce(F.flatten(F.transform("templates", passages)), F.array().cast("array<struct<license:string,line:int,percent:int>>"))
    return found.select(F.col("id").alias(id_col), F.array_sort(F.array_distinct(F.concat("matches", inside))).alias("matches"))


def summary(found: DataFrame) -> DataFrame:
    """id, n_matches, licenses (distinct, comma-joined in order), best_percent (0 without a match)."""
    return found.select(
        *[c for c in found.columns if c != "matches"], F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"),
        F.coalesce(F.array_max("matches.percent"), F.lit(0)).alias("best_percent"),
    )


def oracle_sql() -> str:
    """The query as joins of word pairs, for DuckDB."""
    rows = ", ".join(f"({i}, '{name}', {pairs!r})" for i, (name, pairs) in enumerate(known_templates()))
    return rf"""
with templates(template, license, pairs) as (values {rows}),
template_pairs as (
  select template, license, len(pairs) as b, pair, count(*) as times
  from (select template, license, pairs, unnest(pairs) as pair from templates) group by all
), plain as (
  select doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') as t from documents
), units as (
  select doc_id, 0 as line, trim(regexp_replace(t, '\s+', ' ', 'g')) as t from plain where contains(t, chr(10))
  union all
  select doc_id, line, trim(l) from (
    select doc_id, unnest(string_split(t, chr(10))) as l, unnest(range(1, len(string_split(t, chr(10))) + 1)) as line from plain)
), unit_pairs as (
  select doc_id, line, len(w) - 1 as n, pair, count(*) as times
  from (
    select doc_id, line, w, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) as pair
    from (select doc_id, line, string_split(t, ' ') as w from units))
  group by all
), scored as (
  select doc_id, line, template, license, floor(sum(least(u.times, t.times)) * 200 / (any_value(n) + any_value(b)))::int as percent
  from unit_pairs u join template_pairs t using (pair) group by all
), matched as (
  select distinct doc_id, line, license, percent from scored where percent >= {PERCENT}
)
select d.doc_id, count(line) as n_matches, coalesce(string_agg(distinct license, ',' order by license), '') as licenses,
  coalesce(max(percent), 0) as best_percent
from documents d left join matched m on d.doc_id = m.doc_id group by d.doc_id
"""
