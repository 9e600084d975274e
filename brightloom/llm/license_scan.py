"""Licence texts by the digest of their canonical form. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import only

# Published licence names and notices, and their short identifiers.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
]
#: Equivalent spellings, applied in order to texts already in lower case without punctuation.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"),
    ("noninfringment", "noninfringement"), ("non infringement", "noninfringement"), ("http", "https"),
    ("copyright owner", "copyright holder"), ("merchantibility", "merchantability"), ("v 2 0", "version 2 0"),
    ("creative commons", "cc"), ("attribution noncommercial", "by nc"),
]
_COPYRIGHT_LINE = r"^[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*$"
_OTHER = r"[^a-z0-9]+"
#: Known texts up to which their digests go to every worker; more of them are shuffled.
SHARED = 100_000


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical(text: Column) -> Column:
    """A-Z lowered, copyright lines with a year left out, all but letters a-z and digits as
    single blanks, equivalent spellings made one."""
    return _canonical(_lower(text))


def _canonical(low: Column) -> Column:
    may_claim = F.contains(low, F.lit("copyright")) | F.contains(low, F.lit("(c)")) | F.contains(low, F.lit("©"))
    plain = F.when(may_claim, F.regexp_replace(low, "(?dm)" + _COPYRIGHT_LINE, " ")).otherwise(low)
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, _OTHER, " ")), F.lit(" "))
    for other, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.trim(plain)


def digest(text: Column) -> Column:
    return F.md5(canonical(text))


def known_digests(spark, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license) of the known texts, one row per digest. A table of the size of `notices`."""
    listed = list(NOTICES if notices is None else notices)
    rows = spark.createDataFrame(listed, "license string, text string").coalesce(1 + len(listed) // SHARED)
    known = rows.select(digest(F.col("text")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))
    return F.broadcast(known) if len(listed) <= SHARED else known


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, whole_license, n_notices, licenses, lines.

    whole_license is the licence whose text the whole text is. n_notices counts the
    lines, and the paragraphs of several lines, that are a known text of themselves,
    `lines` lists the lines' numbers from 1, and `licenses` all licences met, sorted.
    Texts match by the digest of their canonical form.

    The known texts are hash-joined: up to SHARED of them are broadcast, so no part of a
    document is shuffled; of more, a shuffle by digest. Only what matches is grouped, by a
    128-bit key of the text.

    Null and empty texts match nothing. Repeated rows and null ids are scanned like
    others; other columns are ignored; no rows give no rows."""
    known = known_digests(docs.sparkSession, notices)
    rows = only(docs, **{id_col: "doc_id", text_col: "text"}).select(
        "doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("second"), "text").alias("k2"))
    whole = F.array(F.struct(F.lit(0).alias("line"), F.col("low").alias("part")))
    lines = F.transform(F.split("low", "\n"), lambda part, i: F.struct((i + 1).alias("line"), part.alias("part")))
    paragraphs = F.transform(F.filter(F.split("low", "\n[ \t]*\n"), lambda part: F.contains(part, F.lit("\n"))),
                             lambda part: F.struct(F.lit(-1).alias("line"), part.alias("part")))
    parts = rows.where("text is not null").select("k1", "k2", _lower(F.col("text")).alias("low")).select("k1", "k2", F.explode(F.concat(whole, lines, paragraphs)).alias("x"))
    # Never null, or the join would test for it by computing the digest once more.
    never_null = F.coalesce(F.md5(_canonical(F.col("x.part"))), F.lit(""))
    met = parts.select("k1", "k2", "x.line", never_null.alias("digest")).join(known, "digest")
    found = (met.groupBy("k1", "k2", "line", "license").agg(F.count("*").alias("n"))
             .groupBy("k1", "k2").agg(
                 F.max(F.when(F.col("line") == 0, F.col("license"))).alias("whole_license"),
                 F.sum(F.when(F.col("line") > 0, 1).when(F.col("line") < 0, F.col("n"))).alias("n_notices"),
                 F.array_sort(F.collect_set("license")).alias("licenses"),
                 F.array_sort(F.collect_set(F.when(F.col("line") > 0, F.col("line")))).alias("lines")))
    return rows.drop("text").join(found, ["k1", "k2"], "left").select(
        "doc_id", "whole_license", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("lines", F.array().cast("array<int>")).alias("lines"))


def licenses_sql() -> str:
    """The scan of `documents` for DuckDB, from the same tables of notices and spellings."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def plain(text: str) -> str:
        text = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        text = f"regexp_replace({text}, {quote('(?m)' + _COPYRIGHT_LINE)}, ' ', 'g')"
        text = f"' ' || trim(regexp_replace({text}, {quote(_OTHER)}, ' ', 'g')) || ' '"
        for other, usual in SPELLINGS:
            text = f"replace({text}, ' {other} ', ' {usual} ')"
        return f"md5(trim({text}))"

    notices = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in NOTICES)
    return f"""
WITH known AS (SELECT {plain("t")} AS digest, min(license) AS license FROM (VALUES {notices}) v(license, t) GROUP BY 1),
u AS (SELECT doc_id, 0 AS line, text AS part FROM documents
      UNION ALL SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))), unnest(string_split(text, chr(10))) FROM documents
      UNION ALL SELECT doc_id, -1, part FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) AS part FROM documents) WHERE contains(part, chr(10))),
m AS (SELECT doc_id, line, license FROM (SELECT doc_id, line, {plain("part")} AS digest FROM u) JOIN known USING (digest)),
g AS (SELECT doc_id, max(license) FILTER (line = 0) AS whole_license, count(*) FILTER (line <> 0) AS n_notices,
        array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses FROM m GROUP BY doc_id)
SELECT doc_id, whole_license, coalesce(n_notices, 0)::BIGINT AS n_notices, coalesce(licenses, '') AS licenses FROM documents LEFT JOIN g USING (doc_id)
"""
