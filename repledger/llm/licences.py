"""Operator 4: texts and lines in canonical form, joined by digest with known licences. Built-in expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repledger.llm.licence_digests import DIGESTS

# Notices and texts of well-known public licences. More can be given as a table (license_id, text).
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
]
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.")
TEXTS = [
    ("MIT", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.")),
    ("ISC", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        + _WARRANTY)),
    ("0BSD", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _WARRANTY)),
    ("Zlib", (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
        "to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as "
        "such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or "
        "altered from any source distribution.")),
]

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n{0}Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer.\n\n{1}Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.\n\n{2}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
    "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {3} OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n")
#: Wordings of the BSD licences: points by number or not, and whose liability it is.
BSD = [
    (name, _BSD.format(one, two, three, whose)) for whose in ("HOLDER", "HOLDERS", "OWNER") for name, one, two, three in (
        ("BSD-2-Clause", "1. ", "2. ", ""), ("BSD-2-Clause", "", "", ""),
        ("BSD-3-Clause", "1. ", "2. ", "3. " + _ENDORSE), ("BSD-3-Clause", "", "", _ENDORSE))]
#: Title lines that licence files begin with.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"),
    "Zlib": ("zlib License", "The zlib License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License",
                     "BSD 2-Clause \"Simplified\" License", "BSD License", "The BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                     "BSD 3-Clause \"New\" or \"Revised\" License", "BSD License", "The BSD License"),
}

#: Steps to the canonical form, on lower case: pattern and replacement, in patterns that Java and RE2 read alike.
STEPS = [
    (r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*", r"\n"),  # copyright lines
    (r"(^|\n)[ \t]*all rights reserved[^\n]*", r"\n"),
    (r"licence", "license"),
    (r"organis|organiz", "organiz"),
    (r"merchantibility", "merchantability"),
    (r"acknowledgement", "acknowledgment"),
    (r"https?://", ""),
    (r"&", " and "),
    (r"[^\p{L}\p{N}]+", " "),
    (r"^ | $", ""),
    (r"^(this (work|software|file|program|project|code) is )?(licensed|released|distributed|available|made available) "
     r"under (the terms of )?(the )?", "licensed under "),
    (r"\bv(ersion )?([0-9])", r"\2"),
    (r"\bversion ([0-9])", r"\1"),
    (r"\bcreative commons attribution\b", "cc by"),
    (r"\bgnu general public license\b|\bgnu gpl\b|\bgpl\b", "gnu gpl"),
]
#: Lines of more letters and digits than this times the longest notice are no notice, whatever their canonical form.
SLACK = 4


def canonical(text: Column) -> Column:
    java = [(p, r.replace("\\1", "$1").replace("\\2", "$2").replace("\\n", "\n")) for p, r in STEPS]
    return reduce(lambda x, s: F.regexp_replace(x, F.lit(s[0]), F.lit(s[1])), java, F.lower(text))


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def known(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """(license_id, digest, unit): texts count against whole documents, notices against lines as well."""
    texts = TEXTS + BSD
    texts = texts + [(i, f"{title}\n\n{t}") for i, t in texts for title in TITLES[i]]
    rows = [(i, t, "line") for i, t in NOTICES] + [(i, t, "text") for i, t in texts]
    df = spark.createDataFrame(rows, "license_id string, text string, unit string")
    if more is not None:
        df = df.unionByName(more.select("license_id", "text", F.lit("text").alias("unit")))
    long = spark.createDataFrame([(i, d, "text") for i, ds in DIGESTS.items() for d in ds],
                                 "license_id string, known_digest string, unit string")
    return df.select("license_id", digest(F.col("text")).alias("known_digest"), "unit").unionByName(long).distinct()


def scan(docs: DataFrame, licences: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_digest, text_license, line_licenses) of every row.

    text_digest is of the canonical form of the whole text; text_license is the licence that has that digest, if one
    does (the first by id, if several); line_licenses are the licences, sorted, of whose notices a whole line has the
    digest. Null text counts as empty, and no licence is empty. Repeated and null ids stay; an empty table gives no
    row. Other columns are left out.

    Both joins are by digest. Lines that cannot be a notice by their length don't enter theirs; the hits alone go back
    to the documents.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    licences = known(docs.sparkSession, licences)
    rows = docs.select("doc_id", digest(body).alias("text_digest"))
    longest = SLACK * max(len(t) for _, t in NOTICES)
    # Few lines name a licence at all: the word below stands in every notice, so no hit is lost.
    named = F.array_distinct(F.filter(F.split("text", "\n"), lambda x: F.lower(x).contains("under")))
    lines = docs.select("doc_id", F.explode(named).alias("line"), "text")
    # What the canonical form folds, such as rules and padding, doesn't count.
    lines = lines.where(F.length(F.regexp_replace(F.lower("line"), r"https?://|[^\p{L}\p{N}]+", "")) <= longest)
    hits = lines.withColumn("line_digest", digest(F.col("line")))
    notices = licences.where("unit = 'line'").select(F.col("license_id").alias("line_license"), "known_digest")
    hits = hits.join(notices, F.col("line_digest") == F.col("known_digest")).select(
        F.col("doc_id").alias("hit_id"), digest(F.coalesce("text", F.lit(""))).alias("hit_digest"), "line_license").distinct()
    hits = hits.groupBy("hit_id", "hit_digest").agg(F.sort_array(F.collect_set("line_license")).alias("line_licenses"))
    whole = licences.groupBy("known_digest").agg(F.min("license_id").alias("text_license"))
    out = rows.join(whole, F.col("text_digest") == F.col("known_digest"), "left").join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_digest") == F.col("hit_digest")), "left")
    return out.select("doc_id", "text_digest", "text_license",
                      F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses"))


def oracle() -> str:
    """The same over the view `documents` for DuckDB."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canon(x: str) -> str:
        for p, r in STEPS:
            rep = "chr(10)" if r == r"\n" else quoted(r)
            x = f"regexp_replace({x}, {quoted(p)}, {rep}, 'g')"
        return x

    values = ",\n".join(f"({quoted(i)}, {quoted(t)}, {u})" for i, t, u in
                        [(i, t, "true") for i, t in NOTICES] + [(i, t, "false") for i, t in TEXTS])
    longest = SLACK * max(len(t) for _, t in NOTICES)
    return f"""
with known as (select license_id, sha256({canon('lower(t)')}) as d, is_line from (values {values}) v(license_id, t, is_line)),
docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
whole as (select r, doc_id, sha256({canon('lower(text)')}) as text_digest from docs),
line as (select distinct r, x from (select r, unnest(string_split(text, chr(10))) as x from docs)
         where length(x) between 1 and {longest} and contains(lower(x), 'under')),
hit as (select r, list_sort(list(distinct license_id)) as l from line join known on is_line and d = sha256({canon('lower(x)')})
        group by r),
names as (select d, min(license_id) as text_license from known group by d)
select doc_id, text_digest, text_license, coalesce(array_to_string(l, ' '), '') as line_licenses
from whole left join names on text_digest = d left join hit using (r)"""
