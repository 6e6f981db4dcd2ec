"""License scans by sparse TF-IDF cosine and directory inheritance (operator 6, DataFrame functions only).

Every line of every text that has a licensing word is a candidate. Distinct candidate lines are
compared with the templates: a token's weight is its count times ln((1 + N) / (1 + df)) + 1,
N and df counted over all candidate lines and the templates. In the same way, and with weights
of their own, the blocks of every text with a word of licence texts are compared with BLOCKS:
the whole text, the comment block it opens with, its paragraphs, and one to WRAP lines in a row
(statements that are wrapped), of the last three those that hold such a word. An SPDX tag
declares its first licence with a cosine of 1. A file's licence is that of its best line, block
or tag with a cosine of at least `least`. Only blocks that can reach it are weighed in full: a
templates' words are all a block can share with one, and another word weighs at least its count
times the least idf of its bucket, so the cosine is at most the root of shared / (shared + others),
both sums of squared weights.
A directory's licence is the one most of its own
licensed files declare (ties: the first in alphabetical order). A file without a licence of its
own takes that of its nearest licensed directory upwards, found by joins of directory paths.

Defined cases: a null or empty text declares nothing; a null path is in the root directory; every
row is a file of its own, whatever ids and paths it shares with others or has null; ties between
templates go to the first license_id; repeated rows are repeated and each count for their
directory; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgrove.llm.shared import pick, settle, unsettle

# Usual short statements of licences (license_id, statement).
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, the Creative Commons Attribution License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This source code is subject to the terms of the Mozilla Public License, version 2.0."),
]
#: Lines without one of these words are no candidates (fixed values).
CANDIDATE = r"licen[sc]e|licen[sc]ed|public domain|spdx"
#: Headings, headers, opening paragraphs and full texts (license_id, text); one id may have several.
_GNU = "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
_WARRANTY = " This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}General Public License for more details. You should have received a copy of the GNU {name}General Public License along with this {what}. If not, see <https://www.gnu.org/licenses/>."
_GNU_KINDS = [("AGPL-3.0", "Affero ", "3", "program"), ("GPL-2.0", "", "2", "program"), ("GPL-3.0", "", "3", "program"), ("LGPL-2.1", "Lesser ", "2.1", "library")]
_APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_END = " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
BLOCKS = [
    *TEMPLATES,
    *[(i, _GNU.format(what=what, name=name, version=v)) for i, name, v, what in _GNU_KINDS],
    *[(i, (_GNU + _WARRANTY).format(what=what, name=name, version=v)) for i, name, v, what in _GNU_KINDS],
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", _BSD + _BSD_NAME + _BSD_END),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("ISC", "ISC License"),
    ("ISC", _ISC),
    ("ISC", _ISC + _ISC_END),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", _MIT),
    ("MIT", _MIT + _MIT_END),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
#: Blocks without one of these words are no candidates.
BLOCK_CANDIDATE = CANDIDATE + r"|permission\s+(?:is\s+hereby|to\s+use)|redistribut|creative\s+commons|cc0|as\s+is|general\s+public|hereby\s+granted|public\s+domain"
#: Lines that are blank but for comment marks part paragraphs; the opening comment block ends at a line without a mark.
BLANK, COMMENT = r"^[\s#*/;%!<>-]*$", r"^\s*(?:#|/\*|\*|//|;|--|%|<!--|$)"
SPDX = r"spdx-license-identifier:[\s(]*([a-z0-9][a-z0-9.+-]*)"
#: Buckets of words of which the least idf is known everywhere; their number changes speed only.
BUCKETS = 1 << 17
#: Keys of blocks that are sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Lines of a wrapped statement.
WRAP = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST = 0.75


def _tokens(line):
    """Runs of A-Z, a-z and 0-9, lowered; with an empty one where a line begins or ends otherwise."""
    # the two other letters whose lower case has an ASCII letter
    ascii_only = F.replace(F.replace(line, F.lit("\u0130"), F.lit(" ")), F.lit("\u212a"), F.lit(" "))
    return F.split(F.lower(ascii_only), "[^a-z0-9]+")


def _terms(df: DataFrame, *key: str) -> DataFrame:
    """df (key, body) -> key, terms: an array of (token, tf). Nothing is shuffled if df is partitioned by a column of the key."""
    counted = df.select(*key, F.explode(_tokens(F.col("body"))).alias("token")).filter("token <> ''").groupBy(*key, "token").agg(F.count(F.lit(1)).alias("tf"))
    return counted.groupBy(*key).agg(F.collect_list(F.struct("token", "tf")).alias("terms"))


def _bucket(token: str):
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def _template_tokens(spark, templates: list[tuple[str, str]]) -> DataFrame:
    rows = spark.createDataFrame(templates, "license_id string, statement string")
    return rows.select("license_id", F.explode(_tokens(F.col("statement"))).alias("token")).filter("token <> ''").groupBy("license_id", "token").agg(F.count(F.lit(1)).alias("tf"))


def _frequencies(counted: DataFrame, t_tokens: DataFrame, total: DataFrame) -> DataFrame:
    """counted (token, n: texts that hold it) and the templates -> (token, idf), at least 1."""
    df = counted.unionByName(t_tokens.select("token", F.lit(1).cast("long").alias("n"))).groupBy("token").agg(F.sum("n").alias("df"))
    return df.crossJoin(F.broadcast(total)).select("token", (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1).alias("idf"))


def score(blocks: DataFrame, templates: list[tuple[str, str]], least: float = LEAST) -> DataFrame:
    """blocks (row, line: a key, terms), a table of lines or blocks with words -> (line, license_id, cosine) of those that match a template."""
    t_tokens = _template_tokens(blocks.sparkSession, [(f"{i:03d}", text) for i, (_, text) in enumerate(templates)])
    counted = blocks.select(F.explode("terms.token").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    total = blocks.agg((F.count(F.lit(1)) + len(templates)).alias("total"))  # one row
    idf = settle(_frequencies(counted, t_tokens, total), "license-weights")
    words = idf.join(F.broadcast(t_tokens.select("token").distinct()), "token", "left_semi")  # words of the fixed templates
    # at most BUCKETS rows: what the lightest word of a bucket weighs
    floors = idf.groupBy(_bucket("token").alias("bucket")).agg(F.min("idf").alias("floor"))
    weighed = blocks.select("line", "row", F.explode("terms").alias("t")).select("line", "row", "t.token", "t.tf", _bucket("t.token").alias("bucket"))
    weighed = weighed.join(F.broadcast(words), "token", "left").join(F.broadcast(floors), "bucket")
    square = lambda weight: F.col("tf") * F.col("tf") * F.col(weight) * F.col(weight)
    shared, others = F.sum(square("idf")), F.sum(F.when(F.col("idf").isNull(), square("floor")))
    # rounding takes less than the margin
    able = weighed.groupBy("line", "row").agg(F.coalesce(shared, F.lit(0.0)).alias("shared"), F.coalesce(others, F.lit(0.0)).alias("others")).filter(F.col("shared") >= max(least - 1e-5, 0.0) ** 2 * (F.col("shared") + F.col("others")))
    one = settle(able.groupBy("line").agg(F.min("row").alias("row")), "license-able")
    few = F.broadcast(one) if one.count() <= BROADCAST_ROWS else one
    full = settle(blocks.join(few, ["line", "row"], "left_semi").select("line", "terms"), "license-full")
    names = F.array(*[F.lit(name) for name, _ in templates])
    scored = settle(_best(full, t_tokens, idf, least).withColumn("license_id", F.element_at(names, F.col("license_id").cast("int") + 1)), "license-scored")
    for table in (idf, one, full):
        unsettle(table)
    return scored


def _best(terms: DataFrame, t_tokens: DataFrame, idf: DataFrame, least: float) -> DataFrame:
    """terms (line, terms) of distinct lines -> (line, license_id, cosine) of their best templates."""
    l_tokens = terms.select("line", F.explode("terms").alias("t")).select("line", "t.token", "t.tf")
    t_weighed = t_tokens.join(idf, "token").select("license_id", "token", (F.col("tf") * F.col("idf")).alias("tw"))
    t_norm = t_weighed.groupBy("license_id").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    l_weighed = l_tokens.join(idf, "token").select("line", "token", (F.col("tf") * F.col("idf")).alias("lw"))
    l_norm = l_weighed.groupBy("line").agg(F.sqrt(F.sum(F.col("lw") * F.col("lw"))).alias("ln"))
    # the templates are a fixed short list
    dots = l_weighed.join(F.broadcast(t_weighed), "token").groupBy("line", "license_id").agg(F.sum(F.col("lw") * F.col("tw")).alias("dot"))
    cosines = dots.join(l_norm, "line").join(F.broadcast(t_norm), "license_id").select("line", "license_id", F.round(F.col("dot") / (F.col("ln") * F.col("tn")), 6).alias("cosine"))
    best = cosines.filter(F.col("cosine") >= least).groupBy("line").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license_id")).alias("b"))
    return best.select("line", "b.license_id", (-F.col("b.c")).alias("cosine"))


def _any_case(pattern: str, first: str) -> str:
    """The pattern for A-Z in either case (Java's (?i) knows no other letters), tried only at a letter of `first`: every match begins with one."""
    return f"(?i)(?=[{first}])(?:{pattern})"


def _marked(every):
    """Numbers of the lines in or at whose end a word of licence texts begins, from 1."""
    near = lambda i: F.concat_ws(" ", F.element_at(every, i), F.element_at(every, F.least(i + 1, F.size(every))))
    return F.filter(F.sequence(F.lit(1), F.size(every)), lambda i: near(i).rlike(_any_case(BLOCK_CANDIDATE, "acghlprs")))


def _blocks(named: DataFrame) -> DataFrame:
    """named (row, every: lines, blank: of each line, marked, opening) -> row, line: a key, terms: each distinct block of a file that may hold a licence text."""
    every, size = F.col("every"), F.size("every")
    blank = lambda i: F.element_at("blank", i)
    join = lambda a: F.array_join(a, " ")
    # a paragraph runs from a line after a blank one to the next blank one
    starts = F.filter(F.sequence(F.lit(1), size), lambda i: ~blank(i) & ((i == 1) | blank(F.greatest(i - 1, F.lit(1)))))
    ends = F.filter(F.sequence(F.lit(1), size), lambda i: ~blank(i) & ((i == size) | blank(F.least(i + 1, size))))
    spans = F.filter(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda s: F.exists("marked", lambda j: (j >= s["a"]) & (j <= s["b"])))
    paragraphs = F.transform(spans, lambda s: join(F.slice(every, s["a"], s["b"] - s["a"] + 1)))
    # every run of at most WRAP lines that holds a marked one
    from_line = lambda j, s: F.transform(F.sequence(j - s + 1, F.least(F.lit(WRAP), size - s + 1)), lambda n: F.struct(s.alias("s"), n.alias("n")))
    runs = F.array_distinct(F.flatten(F.transform("marked", lambda j: F.flatten(F.transform(F.sequence(F.greatest(j - WRAP + 1, F.lit(1)), j), lambda s: from_line(j, s))))))
    wrapped = F.transform(runs, lambda w: join(F.slice(every, w["s"], w["n"])))
    opening = F.when(F.exists("marked", lambda j: j <= F.col("opening")), F.array(join(F.slice(every, 1, F.col("opening"))))).otherwise(F.array().cast("array<string>"))
    out = named.filter("size(marked) > 0").select("row", F.explode(F.array_distinct(F.concat(F.array(join(every)), opening, paragraphs, wrapped))).alias("body"))
    return _terms(out.select("row", F.xxhash64("body").alias("line"), "body"), "row", "line")


def _tags(named: DataFrame) -> DataFrame:
    """SPDX tags: (line, row, license_id, cosine); GNU ids lose -only, -or-later and +, as templates have them."""
    lines = named.select("row", F.explode("lines").alias("line"))
    tag = lines.select("line", "row", F.regexp_replace(F.regexp_extract("line", "(?i)" + SPDX, 1), r"(?i)(?:-only|-or-later|\+)$", "").alias("id")).filter("id <> ''")
    known = sorted({name for name, _ in BLOCKS})
    named_as = F.coalesce(*[F.when(F.lower("id") == name.lower(), F.lit(name)) for name in known], F.col("id"))
    return tag.select("line", "row", named_as.alias("license_id"), F.lit(1.0).alias("cosine"))


def license_scan(files: DataFrame, least: float = LEAST) -> DataFrame:
    """files (doc_id, path, text) -> doc_id, path, license_id, cosine (of its own line, else null), declared_in (the directory or path)."""
    rows = pick(files, doc_id="long", path="string", text="string").withColumn("path", F.coalesce("path", F.lit("")))
    every = F.col("every")
    cut = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "path",
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"),
        F.when(F.col("text").rlike(_any_case(BLOCK_CANDIDATE, "acghlprs")), F.split("text", "\n")).alias("every"),
    )
    opening = F.coalesce(F.nullif(F.array_position(F.transform(every, lambda x: x.rlike(COMMENT)), F.lit(False)), F.lit(0)) - 1, F.size(every).cast("long")).cast("int")
    lines = F.array_distinct(F.filter(every, lambda x: x.rlike(_any_case(CANDIDATE, "lps"))))
    found = F.struct(lines.alias("lines"), "every", F.transform(every, lambda x: x.rlike(BLANK)).alias("blank"), _marked(every).alias("marked"), opening.alias("opening"))
    # read below more than once: without this table every reading would scan the texts
    named = settle(cut.select("row", "doc_id", "path", "dir", F.when(every.isNotNull(), found).alias("found")), "license-lines")
    some = named.filter("found IS NOT NULL").select("row", "found.*")
    # partitioned by row, so that no word is shuffled
    lines = some.select("row", "lines").repartition("row").select("row", F.explode("lines").alias("body"))
    lines = settle(_terms(lines.select("row", F.xxhash64("body").alias("line"), "body"), "row", "line"), "license-line-terms")
    blocks = settle(_blocks(some.select("row", "every", "blank", "marked", "opening").repartition("row")), "license-block-terms")
    found = _tags(some).drop("line")
    for table, templates in ((lines, TEMPLATES), (blocks, BLOCKS)):
        found = found.unionByName(table.select("row", "line").join(score(table, templates, least), "line").select("row", "license_id", "cosine"))
    own = found.groupBy("row").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license_id")).alias("b")).select("row", F.col("b.license_id").alias("own_license"), (-F.col("b.c")).alias("cosine"))
    files_own = settle(named.select("row", "doc_id", "path", "dir").join(own, "row", "left"), "license-own")
    for table in (named, lines, blocks):
        unsettle(table)
    votes = files_own.filter("own_license IS NOT NULL").groupBy("dir", "own_license").agg(F.count(F.lit(1)).alias("n"))
    declared = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("n"), "own_license")).alias("b")).select(F.col("dir").alias("above"), F.col("b.own_license").alias("dir_license"))
    # every directory that holds files, with each directory above it; nearest licensed one wins
    parts = F.split("dir", "/")
    steps = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(F.array_join(F.slice(parts, 1, F.size(parts) - k), "/").alias("above"), k.alias("up")))
    above = files_own.select("dir").distinct().select("dir", F.explode(steps).alias("s")).select("dir", "s.above", "s.up")
    near = above.join(declared, "above").groupBy("dir").agg(F.min(F.struct("up", "above", "dir_license")).alias("b")).select("dir", F.col("b.above").alias("above"), F.col("b.dir_license").alias("dir_license"))
    return files_own.join(near, "dir", "left").select(
        "doc_id",
        "path",
        F.coalesce("own_license", "dir_license").alias("license_id"),
        "cosine",
        F.when(F.col("own_license").isNotNull(), F.col("path")).otherwise(F.col("above")).alias("declared_in"),
    )


def op6_license_scan(spark, sf_dir):
    """Documents as files: source / source's block of 50 ids / document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.expr("cast(doc_id div 50 as string)"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    return license_scan(docs.select("doc_id", path.alias("path"), "text"))


OP6_SQL = (
    r"""
WITH t(license_id, statement) AS (VALUES """
    + ", ".join(f"('{a}', '{b}')" for a, b in TEMPLATES)
    + rf"""),
f AS (
  SELECT doc_id, coalesce(source, 'none') || '/' || CAST(doc_id // 50 AS VARCHAR) || '/doc-' || CAST(doc_id AS VARCHAR) AS path, coalesce(source, 'none') AS top, coalesce(source, 'none') || '/' || CAST(doc_id // 50 AS VARCHAR) AS dir, text
  FROM documents
), o AS (
  SELECT DISTINCT doc_id, path, dir, line FROM (SELECT doc_id, path, dir, unnest(string_split(text, chr(10))) AS line FROM f)
  WHERE regexp_matches(translate(line, '{UPPER}', '{LOWER}'), '{CANDIDATE}')
), u AS (SELECT line, count(*) AS n FROM o GROUP BY line),
lt AS (
  SELECT line, n, token, count(*) AS tf FROM (SELECT line, n, unnest(regexp_split_to_array(translate(line, '{UPPER}', '{LOWER}'), '[^a-z0-9]+')) AS token FROM u) WHERE token <> '' GROUP BY ALL
), tt AS (
  SELECT license_id, token, count(*) AS tf FROM (SELECT license_id, unnest(regexp_split_to_array(translate(statement, '{UPPER}', '{LOWER}'), '[^a-z0-9]+')) AS token FROM t) WHERE token <> '' GROUP BY ALL
), idf AS (
  SELECT token, ln((1 + (SELECT coalesce(sum(n), 0) + (SELECT count(*) FROM t) FROM u)) / (1 + sum(n))) + 1 AS idf
  FROM (SELECT token, n FROM lt UNION ALL SELECT token, 1 FROM tt) GROUP BY token
), lw AS (SELECT line, token, tf * idf AS w FROM lt JOIN idf USING (token)),
tw AS (SELECT license_id, token, tf * idf AS w FROM tt JOIN idf USING (token)),
c AS (
  SELECT line, license_id, round(sum(lw.w * tw.w) / (any_value(ln.norm) * any_value(tn.norm)), 6) AS cosine
  FROM lw JOIN tw USING (token)
  JOIN (SELECT line, sqrt(sum(w * w)) AS norm FROM lw GROUP BY line) ln USING (line)
  JOIN (SELECT license_id, sqrt(sum(w * w)) AS norm FROM tw GROUP BY license_id) tn USING (license_id)
  GROUP BY line, license_id
), b AS (
  SELECT doc_id, path, dir, license_id, cosine FROM o JOIN c USING (line) WHERE cosine >= {LEAST}
  QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY cosine DESC, license_id) = 1
), d AS (
  SELECT dir, license_id FROM (SELECT dir, license_id, count(*) AS n FROM b GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, license_id) = 1
)
SELECT f.doc_id, f.path, coalesce(b.license_id, d.license_id) AS license_id, b.cosine,
  CASE WHEN b.license_id IS NOT NULL THEN f.path ELSE d.dir END AS declared_in
FROM f LEFT JOIN b USING (doc_id, path) LEFT JOIN d ON d.dir = f.dir
"""
)

QUERIES = {"op6_license_scan": op6_license_scan}
ORACLES = {"op6_license_scan": OP6_SQL}
