"""License scans by canonical digest.

A text is brought to a canonical form: lower case, copyright notices dropped (with a sign or year: to the end of a line
that begins with one, or within 80 characters before a licence's opening words; lines of the word and a short name),
equivalent spellings made one, everything but letters and digits turned into single spaces. Its SHA-256 is looked up in the digests
of known licences by a hash join. Looked up are each document as a whole (a licence file) and each of its lines (a
notice in a text). A line with an SPDX identifier counts as a notice named SPDX: and the identifier, known or not.

Defined results: null and empty texts, and texts that are only copyright lines, have the canonical form '' and match
nothing. Rows of one doc_id, repeated rows and null ids each keep their row. Empty tables give no rows; extra columns are
ignored. Licences with equal canonical forms are reported by the smallest name.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.llm.common import any_of, let

# Public licence notices and texts.
NOTICES = [
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice-long", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0-notice", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT-notice", "Released under the MIT License."),
    ("MPL-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
TEXTS = [
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
]
#: Spellings that mean the same, on canonical words.
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("sublicence", "sublicense"),
    ("merchantibility", "merchantability"),
    ("v", "version"),
    ("organisation", "organization"),
    ("noncommercial", "nc"),
    ("https", "http"),
]
#: Titles that may stand before a text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("0BSD License", "Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License"),
}
#: What begins a copyright notice, not a clause such as "copyright holders be liable"; (c) alone may be a list's letter.
NOTICE = r"(?:\bcopyright[\s:]*(?:\(c\)|©|[12]\d{3}\b|[<\[{](?:year|yyyy))|(?:\(c\)|©)\s*[12]\d{3}\b)"
#: A line of a name only: not the words that follow "copyright" in licences.
NAMED = (
    r"copyright[ \t]+(?!(?:holder|owner|notice|law|licen[sc]e|statement|interest|protection|disclaimer|treat|right|act|permission|doctrine)"
    r"|(?:and|or|if|on|in|of|to|by|is|as|for|that|are|nor|the(?! regents)|patent|under|with|you|it|this|be|may|shall)\b)"
    r"(?:[^\s]+[ \t]*){1,8}$"
)
#: Where a text begins that may stand behind a notice on the same line.
OPENING = (
    r"\s*(?:permission\s+is\s+hereby|permission\s+to\s+use|redistribution\s+and\s+use|this\s+software\s+is\s+provided"
    r"|licensed\s+under\s+the|everyone\s+is\s+permitted|(?:this|gnomovision|<program>)\s+(?:program|library|comes)\b)"
)
#: The foundation's own notice has an address, which changes and may stand on a line of its own.
FOUNDATION = r"copyright\s+\(c\)[\s\d,]*free\s+software\s+foundation[\s\S]{0,120}?(?=everyone\s+is\s+permitted)"
COPYRIGHT = (
    rf"(?m){FOUNDATION}|{NOTICE}(?:[^\n]|\n(?![ \t]*\n)){{0,80}}?(?={OPENING})|^[ \t#*/;-]*(?:{NOTICE}[^\n]*|{NAMED})"
    r"|\ball\s+rights\s+reserved\b"
)
#: An identifier line: one identifier, or several joined by and, or, with; brackets are left out.
SPDX = r"(?i)spdx-license-identifier:[ \t(]*([a-z0-9][a-z0-9.+-]*(?:[ \t()]+(?:and|or|with)[ \t(]+[a-z0-9][a-z0-9.+-]*)*)"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form of `text`; equal licences have equal forms."""
    def without_notices(lower: Column) -> Column:
        may = any_of([lower.contains(x) for x in ("copyright", "(c)", "©", "rights")])
        return F.when(may, F.regexp_replace(lower, COPYRIGHT, "")).otherwise(lower)

    lower = let(F.lower(F.coalesce(text, F.lit(""))), without_notices)
    plain = F.concat(F.lit(" "), F.btrim(F.regexp_replace(lower, OTHER, " ")), F.lit(" "))
    for found, meant in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {found} "), F.lit(f" {meant} "))
    return F.btrim(plain)


def digest(text: Column) -> Column:
    return let(canonical(text), lambda c: F.when(c != "", F.sha2(c, 256)))


def known_texts(spark: SparkSession) -> DataFrame:
    """license, text: the fixed lists above, texts also with titles, and those of licenses.json. Any frame of these columns may be used instead."""
    titled = [(name, f"{title}\n\n{text}") for name, text in TEXTS for title in TITLES.get(name, ())]
    full = [(x["license"], x["text"]) for x in json.loads(Path(__file__).with_suffix(".json").read_text("utf-8"))]
    return spark.createDataFrame([*NOTICES, *TEXTS, *titled, *full], "license string, text string")


def licensed(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license (of the whole text), line_licenses (comma-joined names), n_license_lines of every row."""
    known = known_texts(docs.sparkSession) if known is None else known
    digests = known.select("license", digest(F.col("text")).alias("known")).where("known is not null")
    digests = digests.groupBy("known").agg(F.min("license").alias("license"))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    marked = (
        rows.where(F.lower("text").contains("spdx-license-identifier:"))
        .select("row_key", F.explode(lines).alias("line"))
        .select("row_key", F.regexp_extract("line", SPDX, 1).alias("id"))
        .where("id <> ''")
        .select("row_key", F.concat(F.lit("SPDX:"), F.regexp_replace("id", r"[ \t()]+", " ")).alias("license"))
    )
    line_hits = (
        rows.select("doc_id", "row_key", F.explode_outer(lines).alias("line"))
        .where(F.length("line") > 0)
        .select("row_key", digest(F.col("line")).alias("known"))
        .join(digests, "known")
        .select("row_key", "license")
        .union(marked)
        .groupBy("row_key", "license")
        .agg(F.count("*").alias("n"))
        .groupBy(F.col("row_key").alias("_key"))
        .agg(
            F.array_join(F.array_sort(F.collect_list("license")), ",").alias("line_licenses"),
            F.sum("n").alias("n"),
        )
    )
    # A repeated row counts its lines again; each of its copies has its own share.
    whole = rows.select("doc_id", "row_key", digest(F.col("text")).alias("digest"))
    copies = whole.groupBy(F.col("row_key").alias("_row")).agg(F.count("*").alias("copies"))
    per_row = line_hits.join(copies, F.col("_key") == F.col("_row")).select(
        "_key", "line_licenses", (F.col("n") / F.col("copies")).cast("long").alias("n_license_lines")
    )
    return (
        whole.join(per_row, F.col("row_key") == F.col("_key"), "left")
        .join(digests.withColumnRenamed("known", "_known"), F.col("digest") == F.col("_known"), "left")
        .select(
            "doc_id",
            "digest",
            "license",
            F.coalesce("line_licenses", F.lit("")).alias("line_licenses"),
            F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"),
        )
    )
