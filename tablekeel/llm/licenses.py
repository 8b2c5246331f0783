"""License scans by canonical digests.

Two texts that differ in case, punctuation, spacing, copyright lines or the spelling of a
few words have the same canonical form. A document, and each of its lines, is looked up
as a whole: its canonical digest is joined to those of known licences and notices. Lines
that only say 'all rights reserved' do not keep a document from being found.
Everything is a DataFrame expression.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeel.llm.common import pick, small

# Spellings that licence texts use for the same word (left: as found, right: as kept).
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("authoris", "authoriz"),
    ("centre", "center"),
    ("favour", "favor"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("organis", "organiz"),
    ("per cent", "percent"),
    ("programme", "program"),
    ("recognis", "recogniz"),
    ("sub license", "sublicense"),
    ("sub-license", "sublicense"),
    ("whilst", "while"),
    ("http:", "https:"),
    ("copyright owner", "copyright holder"),
    # Letters that have two small forms.
    ("ς", "σ"),
    ("i\u0307", "i"),
]
#: Lines that only say who holds the copyright.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©|portions copyright)[^\n]*$"
#: What is neither a letter, with its marks, nor a digit of any script.
NOISE = r"[^a-z0-9\n\p{L}\p{M}\p{N}]+"
#: Lines of a canonical form that say no more than that.
RESERVED_LINE = r"(?m)^ ?all rights reserved ?$"

# Notices and short licences; whole licences as they are published are in licenses.json.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        'SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
]


def canonical_lines(text: Column) -> Column:
    """The text in its canonical form, with its line feeds."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for found, kept in SPELLINGS:
        out = F.replace(out, F.lit(found), F.lit(kept))
    return F.regexp_replace(out, NOISE, " ")


def _digest(canonical: Column) -> Column:
    words = F.trim(F.regexp_replace(canonical, r"\s+", " "))
    return F.when(words != "", F.sha2(words, 256))


def _unreserved(canonical: Column) -> Column:
    """The digest without lines that only say 'all rights reserved', null if there is no such line."""
    return F.when(canonical.rlike(RESERVED_LINE), _digest(F.regexp_replace(canonical, RESERVED_LINE, "")))


def whole_licenses() -> list[tuple[str, str]]:
    """(license_id, text) of the package's whole licences, with their lines as published and with a line for each paragraph."""
    texts = [tuple(x) for x in json.loads(Path(__file__).with_name("licenses.json").read_text(encoding="utf-8"))]
    return texts + [(i, re.sub(r"(?<!\n)\n(?!\n)[ \t]*", " ", t)) for i, t in texts]


def known_licenses(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """license_id and text of known licences and notices, by default all of the package; several texts may have one id."""
    return spark.createDataFrame([*KNOWN, *whole_licenses()] if known is None else known, "license_id string, text string")


def scan_licenses(
    docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, text_digest, license_id and notices.

    text_digest is the sha-256 of the whole text's canonical form, null where nothing is
    left of it (null, empty, marks only). license_id is the known licence that the whole
    text is, or is but for lines that only say 'all rights reserved', else null. notices are the distinct ids, sorted, of known texts that a whole
    line is, as one string with commas, empty for none. If a known text stands under
    several ids, the least counts; nulls among them are passed over. Ids may be null or repeat.
    """
    spark = docs.sparkSession
    known = pick(known_licenses(spark) if known is None else known, license_id="license_id", text="text")
    known = known.select("license_id", canonical_lines(F.col("text")).alias("canonical"))
    known = known.select("license_id", F.explode(F.array(_digest(F.col("canonical")), _unreserved(F.col("canonical")))).alias("digest"))
    known = known.where("license_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "doc_id", canonical_lines(F.col("text")).alias("canonical"))
    rows = rows.select(
        "row",
        "doc_id",
        _digest(F.col("canonical")).alias("text_digest"),
        _unreserved(F.col("canonical")).alias("unreserved"),
        F.array_distinct(F.transform(F.split("canonical", "\n"), _digest)).alias("lines"),
    )
    unit = lambda kind, digest: F.struct(F.lit(kind).alias("kind"), digest.alias("digest"))
    whole = F.array(unit("whole", F.col("text_digest")))
    whole = F.when(F.col("unreserved").isNull(), whole).otherwise(F.concat(whole, F.array(unit("unreserved", F.col("unreserved")))))
    lines = F.transform("lines", lambda d: unit("line", d))
    units = rows.select("row", "doc_id", "text_digest", F.explode(F.concat(whole, F.coalesce(lines, F.array().cast("array<struct<kind:string,digest:string>>")))).alias("unit"))
    units = units.select("row", "doc_id", "text_digest", "unit.kind", "unit.digest")
    found = units.join(small(known), "digest", "left")
    # All units of a row leave the same task, so that they are one row before the shuffle.
    return (
        found.groupBy("row", "doc_id", "text_digest")
        .agg(
            F.coalesce(*[F.max(F.when(F.col("kind") == k, F.col("license_id"))) for k in ("whole", "unreserved")]).alias("license_id"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") == "line", F.col("license_id")))), ",").alias("notices"),
        )
        .select("doc_id", "text_digest", "license_id", "notices")
    )


def oracle(known: list[tuple[str, str]] | None = None) -> str:
    """The same as DuckDB SQL over documents, by default with all known texts of the package."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    line = r"(^|\n)[ \t]*(copyright|\(c\)|©|portions copyright)[^\n]*"

    def form(x: str) -> str:
        x = f"regexp_replace(lower({x}), {quote(line)}, '\\1', 'g')"
        for a, b in SPELLINGS:
            x = f"replace({x}, {quote(a)}, {quote(b)})"
        return f"regexp_replace({x}, {quote(NOISE)}, ' ', 'g')"

    def digest(x: str) -> str:
        words = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
        return f"CASE WHEN {words} <> '' THEN sha256({words}) END"

    reserved = quote(RESERVED_LINE)
    without = digest(f"regexp_replace(f, {reserved}, '', 'g')")
    unreserved = f"CASE WHEN regexp_matches(f, {reserved}) THEN {without} END"
    values = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in ([*KNOWN, *whole_licenses()] if known is None else known))
    return f"""
        WITH known_forms AS (SELECT id, {form("t")} AS f FROM (VALUES {values}) v(id, t)),
        known AS (
            SELECT min(id) AS id, digest FROM (
                SELECT id, {digest("f")} AS digest FROM known_forms
                UNION ALL SELECT id, {unreserved} FROM known_forms
            ) WHERE digest IS NOT NULL GROUP BY digest),
        forms AS (SELECT doc_id, {form("text")} AS f FROM documents),
        wholes AS (SELECT doc_id, {digest("f")} AS text_digest, {unreserved} AS unreserved FROM forms),
        lines AS (SELECT DISTINCT doc_id, {digest("u")} AS digest FROM (
            SELECT doc_id, unnest(string_split(f, chr(10))) AS u FROM forms)),
        notices AS (SELECT doc_id, string_agg(DISTINCT id, ',' ORDER BY id) AS ids
            FROM lines JOIN known USING (digest) GROUP BY doc_id)
        SELECT w.doc_id, w.text_digest, coalesce(k.id, u.id) AS license_id, coalesce(n.ids, '') AS notices
        FROM wholes w LEFT JOIN known k ON k.digest = w.text_digest LEFT JOIN known u ON u.digest = w.unreserved
        LEFT JOIN notices n ON n.doc_id = w.doc_id"""
