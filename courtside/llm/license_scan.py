"""Operator 6: licence scans by canonical digest lookup, in DataFrame operations alone.

A text and every line of it are brought to a canonical form: lower case, punctuation and blanks
collapsed to one blank, spellings made equal, empty and copyright lines left out.  The digest of
the entire text is hash-joined to the digests of known licence texts and notices, and the lines'
digests are looked up among them, so a notice is found wherever it stands on a line of its own.
The known table is fixed (some thousand entries), which bounds its broadcast.

Known entries are licence texts (the short ones here, the longer ones in ``license_texts``), with and
without each usual title and, where a text has one, its appendix; the titles alone; and notices made
by rule: each wording for each name.  ``MISSING`` are the listed licences whose texts aren't known.

Null and empty texts: no licence (text_license null, notices '').  A text in which nothing is
left (only copyright lines) likewise.  Empty table: no rows.  Repeated rows each get a row.
Extra columns are ignored or passed on (``keep``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.common import col, table

# Spellings treated as equal (left is written as right).
SPELLINGS = (
    ("©", " copyright "), ("acknowledgement", "acknowledgment"), ("analogue", "analog"),
    ("authorisation", "authorization"), ("authorise", "authorize"), ("behaviour", "behavior"),
    ("favour", "favor"), ("https://", "http://"), ("initialise", "initialize"),
    ("licence", "license"), ("organisation", "organization"), ("organise", "organize"),
    ("recognise", "recognize"), ("sub-license", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"),
)

# Licences and the names under which notices give them.
NAMES = (
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD License")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-NC-ND-4.0", ("CC BY-NC-ND 4.0",)),
    ("CC-BY-NC-SA-4.0", ("CC BY-NC-SA 4.0",)),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0",)),
    ("CC-BY-SA-3.0", ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC0-1.0", ("CC0 1.0", "Creative Commons Zero v1.0 Universal", "CC0-1.0")),
    ("EPL-2.0", ("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0")),
    ("ISC", ("ISC License",)),
    ("LGPL-2.1", ("GNU Lesser General Public License, version 2.1", "LGPL-2.1")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "LGPL-3.0")),
    ("MIT", ("MIT License", "MIT licence", "Expat License")),
    ("MPL-2.0", ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0")),
    ("Unlicense", ("Unlicense",)),
    ("Zlib", ("zlib License",)),
)

# Wordings of a notice.
WORDINGS = (
    "{}", "SPDX-License-Identifier: {}", "Released under {}", "Released under the {}",
    "Licensed under {}", "Licensed under the {}", "Distributed under the {}",
    "This work is licensed under {}", "This work is licensed under the {}",
    "This work is licensed under a {}", "This project is licensed under the {}",
    "This file is part of a work released under the {}",
)

# Short licence texts (without their copyright lines).
TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event
will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.
3. This notice may not be removed or altered from any source distribution."""),
)

# The BSD licences' parts; the enumeration and the names differ between copies.
BSD = ("""Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
""", """Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.
""", """Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution.
""", """Neither the name of {} nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
""", """THIS SOFTWARE IS PROVIDED BY THE {} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE.""")
HOLDERS = (("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"), ("COPYRIGHT HOLDERS", "COPYRIGHT OWNER"),
           ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"), ("REGENTS", "REGENTS"))
ENDORSERS = ("the copyright holder", "the copyright holders", "the copyright owner", "the University")

# Title lines beside the names above.
TITLES = {
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License',
                     "Modified BSD License"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License"),
    "ISC": ("The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "MIT": ("The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "Unlicense": ("The Unlicense",),
    "Zlib": ("The zlib License", "zlib/libpng License", "The zlib/libpng License"),
}

# Texts in ``license_texts`` and how many of their first lines are a title.
FILES = (("Apache-2.0", 3), ("BSL-1.0", 1), ("CC-BY-SA-3.0", 2), ("CC-BY-SA-4.0", 1), ("CC0-1.0", 2), ("GPL-2.0", 2),
         ("GPL-3.0", 2), ("LGPL-2.1", 2), ("LGPL-3.0", 2), ("MPL-2.0", 1), ("Unlicense", 0))
APPENDIX = ("END OF TERMS AND CONDITIONS", "For more information, please refer to")  # a copy may end here
MISSING = ("AGPL-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "EPL-2.0")

JUNK = r"[^\p{L}\p{N}\n]+"
COPYRIGHT = r"^(copyright|c (19|20)[0-9][0-9]|all rights reserved)( |$)"


def bodies() -> Iterator[tuple[str, list[str], str]]:
    """(licence, the text's own title lines, the text without them) of all known texts."""
    for key, text in TEXTS:
        yield key, [], text
    for key, clauses in (("BSD-2-Clause", BSD[1:3]), ("BSD-3-Clause", BSD[1:4])):
        for sign in ("{}. ", "* "):
            listed = BSD[0] + "".join(sign.format(i + 1) + c for i, c in enumerate(clauses)) + "{}"
            for holders in HOLDERS:
                for name in ENDORSERS if len(clauses) > 2 else ("",):
                    yield key, [], listed.format(*[name][:len(clauses) - 2], BSD[4].format(*holders))
    for key, titles in FILES:
        text = (resources.files(__package__) / "license_texts" / f"{key}.txt").read_text(encoding="utf-8")
        lines = [x for x in text.split("\n") if x.strip()]
        head, rest = lines[:titles], lines[titles:]
        yield key, head, "\n".join(rest)
        for i, line in enumerate(rest):
            if line.strip().startswith(APPENDIX):
                yield key, head, "\n".join(rest[:i])
                if line.strip() == APPENDIX[0]:
                    yield key, head, "\n".join(rest[:i + 1])


def known_entries() -> list[tuple[str, str]]:
    """(licence, text) of all known texts and notices."""
    names = dict(NAMES)
    out = [*TEXTS]
    for key, own, body in bodies():
        out += [(key, "\n".join([*own[i:], body])) for i in range(len(own) + 1)]
        out += [(key, t + "\n" + body) for t in (*names[key], *TITLES.get(key, ()))]
    out += [(key, t) for key, titles in TITLES.items() for t in titles]
    return list(dict.fromkeys([*out, *((key, w.format(n)) for key, names in NAMES for n in names for w in WORDINGS)]))


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text: array of strings, empty and copyright lines left out."""
    s = F.lower(F.coalesce(text, F.lit("")))
    for old, new in SPELLINGS:
        s = F.replace(s, F.lit(old), F.lit(new))
    lines = F.split(F.regexp_replace(s, JUNK, " "), "\n")
    return F.filter(F.transform(lines, lambda x: F.btrim(x, F.lit(" "))),
                    lambda x: (x != "") & ~F.rlike(x, F.lit(COPYRIGHT)))


def text_digest(lines: Column) -> Column:
    return F.when(F.size(lines) > 0, F.md5(F.array_join(lines, " ").cast("binary")))


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license) of all known entries; a digest of several licences is the first's."""
    entries = spark.createDataFrame(known_entries(), "license string, text string")
    rows = entries.select("license", canonical_lines(F.col("text")).alias("lines"))
    return rows.select(text_digest(F.col("lines")).alias("digest"), "license").groupBy("digest").agg(
        F.min("license").alias("license"))


def scan(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(doc struct, text_license, notices): the licence that the entire text is, or null, and the
    licences of which a line is a known entry, in order, joined by commas."""
    known = known_digests(docs.sparkSession)
    pairs = sorted((r["digest"], r["license"]) for r in known.collect())  # the fixed table's size
    digests = F.array(*[F.lit(d) for d, _ in pairs])
    license_of = F.create_map(*[F.lit(x) for p in pairs for x in p])
    rows = docs.select(F.struct(*[col(c) for c in keep]).alias("doc"),
                       canonical_lines(col("text").cast("string")).alias("lines"))
    rows = rows.select("doc", text_digest(F.col("lines")).alias("digest"),
                       F.array_intersect(F.transform("lines", lambda x: F.md5(x.cast("binary"))), digests).alias("hits"))
    notices = F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda d: license_of[d]))), ",")
    return (rows.join(F.broadcast(known), "digest", "left")
            .select("doc", F.col("license").alias("text_license"),
                    F.when(F.size("hits") > 0, notices).otherwise("").alias("notices")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    return scan(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "text_license", "notices")


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The query in DuckDB SQL."""
    def lines(text: str) -> str:
        s = f"lower(coalesce({text}, ''))"
        for old, new in SPELLINGS:
            s = f"replace({s}, {_quoted(old)}, {_quoted(new)})"
        s = f"string_split(regexp_replace({s}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10))"
        return f"[trim(x, ' ') FOR x IN {s} IF trim(x, ' ') <> '' AND NOT regexp_matches(trim(x, ' '), {_quoted(COPYRIGHT)})]"

    values = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in known_entries())
    return f"""
WITH entries(license, text) AS (VALUES {values}),
known AS (
  SELECT md5(array_to_string({lines("text")}, ' ')) AS digest, min(license) AS license
  FROM entries GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, {lines("text")} AS l FROM documents),
notices AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT r, unnest(l) AS x FROM docs) JOIN known ON md5(x) = digest GROUP BY r)
SELECT doc_id, known.license AS text_license, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known ON len(l) > 0 AND md5(array_to_string(l, ' ')) = digest
LEFT JOIN notices USING (r)
"""
