"""Licence scan by canonical digest lookup. DataFrame and SQL functions only."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pairs of spellings that count as one, after punctuation is gone; applied in this order.
EQUIVALENT = [
    ("licenc", "licens"),
    ("organis", "organiz"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("favour", "favor"),
    ("sub licens", "sublicens"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("https ", "http "),
]
#: A line that only says who holds the rights.
COPYRIGHT_LINE = r"\n[^\p{L}\p{N}\n]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|<year>|\[year\])|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
_BSD_TAIL = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
#: Known texts: whole licences (with and without their title) and one-line notices, by SPDX identifier.
KNOWN = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _AS_IS),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" + _BSD_TAIL),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
]

#: Identifiers of the entire licences in the folder licenses, and whether the part up to the end of the terms counts too.
TEXTS = {
    "Apache-2.0": True, "Artistic-1.0-Perl": False, "BSD-3-Clause": False, "CC0-1.0": False, "GFDL-1.2-only": False, "GFDL-1.3-only": False, "GPL-1.0-only": True, "GPL-2.0-only": True,
    "GPL-3.0-only": True, "LGPL-2.0-only": True, "LGPL-2.1-only": True, "LGPL-3.0-only": False, "MPL-1.1": False, "MPL-2.0": False,
}
_TERMS_END = "END OF TERMS AND CONDITIONS"


def entire_texts() -> list[tuple[str, str]]:
    """(license_id, text) of the licences in the package, read on the driver."""
    out = []
    for name, parts in TEXTS.items():
        text = (files("lexflume.llm") / "licenses" / f"{name}.txt").read_text(encoding="utf-8")
        out.append((name, text))
        if parts:
            terms = text[: text.index(_TERMS_END)]
            out += [(name, terms), (name, terms + _TERMS_END)]
    return out


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one space for each run of other than letters and digits, one spelling."""
    t = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), COPYRIGHT_LINE, "")
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
    for spelling, one in EQUIVALENT:
        t = F.replace(t, F.lit(spelling), F.lit(one))
    return t


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, license_id) of the known texts: as many rows as the list has different texts."""
    rows = spark.createDataFrame(known, "license_id string, text string")
    return rows.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def license_scan(docs: DataFrame, *, known: list[tuple[str, str]] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, digest (of the canonical whole text), license_id, notice_ids, n_notice_lines of every row.

    license_id: the known licence that the entire text is, else null; entire texts are
    hash-joined to the known digests. notice_ids: identifiers, sorted and joined by
    commas, of known texts that an entire line of it is (null if none), looked up by
    the same digest within the row; n_notice_lines counts these lines. The known texts
    are a fixed list of the caller's, KNOWN and the package's entire licences if none
    is given: as many digests are broadcast. Nothing of the documents is shuffled.

    Empty and null texts have the digest of '' and no licence, whatever the key, which
    may be null or come again: each row is judged by itself. A very long text is
    handled line by line within its row. Columns other than the key are not carried,
    whatever their names; an empty table gives no rows.
    """
    found = known_digests(docs.sparkSession, [*KNOWN, *entire_texts()] if known is None else known)
    listed = {r["digest"]: r["license_id"] for r in found.collect()}  # one row of each known text
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x: F.sha2(canonical(x), 256))
    hits = F.filter(lines, lambda x: x.isin(list(listed))) if listed else F.array().cast("array<string>")
    name = F.create_map(*[F.lit(x) for pair in listed.items() for x in pair]) if listed else F.create_map().cast("map<string, string>")
    rows = rows.select("key", F.sha2(canonical(F.col("text")), 256).alias("digest"), hits.alias("hits"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda x: F.element_at(name, x))))
    joined = rows.join(F.broadcast(found), "digest", "left")
    return joined.select(F.col("key").alias(key), "digest", "license_id", F.nullif(F.concat_ws(",", names), F.lit("")).alias("notice_ids"), F.size("hits").cast("long").alias("n_notice_lines"))
