"""License scans by canonical digest lookup.

A text is brought to a canonical form (case, copyright lines, punctuation and white space,
equivalent spellings) and digested; the digest is hash-joined to the digests of known licence
texts, which are made by the same expressions.  Entire texts are compared, so there is no near
match.  One-line notices are looked up as entire lines in the same way.

Only DataFrame operations.  The known table has a fixed number of rows and is broadcast.

Defined results: a null text is an empty text; a text that is empty in canonical form matches
nothing; repeated rows match each; null ids are kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import local_table, pick

#: Lines of a copyright statement, in lower case.
COPYRIGHT = r"(?m)^[\x20\x09]*(copyright(?![\x20\x09]+(?:notices?|holders?|owners?|laws?|statements?|licen[cs]es?)\b)|\(c\)|©|copr\.|all rights reserved)[^\n]*$"

# Equivalent spellings, in lower case and without punctuation.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("authoris", "authoriz"),
    ("behaviour", "behavior"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("non commercial", "noncommercial"),
    ("organis", "organiz"),
    ("per cent", "percent"),
    ("recognis", "recogniz"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    # notices that say the same in other words
    ("made available under", "licensed under"),
    ("available under", "licensed under"),
    ("released under", "licensed under"),
    ("distributed under", "licensed under"),
    ("this work is licensed under", "licensed under"),
]

# Known licence texts and one-line notices.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
_AUTHOR = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_BSD2 = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
KNOWN = {
    "MIT": 'MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n'
    + _AS_IS
    + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _AUTHOR,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _AUTHOR,
    "BSD-2-Clause": _BSD2 + "\n" + _BSD,
    "BSD-3-Clause": _BSD2 + "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _BSD,
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.",
}
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Licensed under the MIT License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
}
# Canonical digests of long licences, of their published plain texts as a whole
# (another canonical form makes other digests; a test compares them with the texts where a system has these).
DIGESTS = {
    "Apache-2.0": "d71babf91d8c981d3cbc3ecdc8b468fbbb3305a8198126e7b2acd755fab3d033",
    "Artistic-1.0-Perl": "d1ce9579b2c8d32b706b421d9c42208152298e00849e57ce7da8e906ed3802f2",
    "CC0-1.0": "d24369f38fdf7181917831aa40ec7761926fead9e1c43fbb25e4ed156fc0ba0f",
    "GFDL-1.3": "bb3e0facf142c1760d8f070bcc919ae5d64ead3ed61e2de04f65b56be41a8f88",
    "GPL-1.0": "5c1318be3b0b805eb2380f144320bc0b8ff14964622c642205310c963e8cf0ab",
    "GPL-2.0": "3cce4a6a72274f2e99fccd846294e0cb94ea165fd3b48e04604924ff731d8ee0",
    "GPL-3.0": "4d371fe7b281ac4c3eb50912598e50e55c6a09a488263ee4849169bf16e1831f",
    "LGPL-2.0": "f8437c9123dac839969d73607d0012df17151df482b591bf1a1d438655990234",
    "LGPL-2.1": "0f9f3659c41f76c03008d0c96b1a9e8e705bd707ceb6c945cd1108f7a4c99f63",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "d5d8f9478fcec675211ed42501cf82bb035b5a84dc403d50eac60f562d13670c",
    "MPL-2.0": "711eacc5cdff886d6ebbeb7a7395d1dfce988a9ca9e2e7ed754544cc70bd77ef",
}
#: Title lines with which the texts are published.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
}
#: Every notice has it, in any spelling; lines without it are no notice.
CUE = "licen[cs]|(released|distributed|available)[^a-z0-9]+under"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(F.coalesce(text, F.lit(""))), 256)


def known(spark, texts: dict[str, str]) -> DataFrame:
    """(license_id, digest) of the known texts."""
    return local_table(spark, [{"license_id": k, "text": t} for k, t in texts.items()], "license_id string, text string").select("license_id", digest(F.col("text")).alias("digest"))


def variants(spark) -> DataFrame:
    """(license_id, text): the known texts with and without their titles, and the notices."""
    rows = []
    for k, t in KNOWN.items():
        bare = t.removeprefix("MIT License\n")
        rows += [{"license_id": k, "text": x} for x in (bare, *(f"{title}\n{bare}" for title in TITLES[k]))]
    rows += [{"license_id": f"{k} notice", "text": t} for k, t in NOTICES.items()]
    return local_table(spark, rows, "license_id string, text string")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", known_texts: DataFrame | None = None) -> DataFrame:
    """Per row: id, license_digest, license_id of the entire text, licenses of its notice lines, their number.

    ``known_texts`` (license_id, text) are further whole texts, any number of variants of each.
    """
    spark = docs.sparkSession
    docs = pick(docs, id_col, text_col)
    notices = {r.digest: r.license_id for r in known(spark, NOTICES).collect()}  # as many as NOTICES
    by_digest = F.create_map(*(F.lit(x) for pair in notices.items() for x in pair))
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1), lambda x: F.lower(x).rlike(CUE))
    found = F.filter(F.transform(lines, lambda x: F.element_at(by_digest, digest(x))), lambda x: x.isNotNull())
    rows = docs.select(F.col(id_col), digest(F.col(text_col)).alias("license_digest"), found.alias("_lines"))
    texts = variants(spark)
    if known_texts is not None:
        texts = texts.union(known_texts.select("license_id", "text"))
    # one row a digest: of licences with the same text the first name
    digests = texts.select("license_id", digest(F.col("text")).alias("digest")).union(local_table(spark, [{"license_id": k, "digest": d} for k, d in DIGESTS.items()], "license_id string, digest string"))
    whole = digests.groupBy("digest").agg(F.min("license_id").alias("license_id")).filter(F.col("digest") != F.sha2(F.lit(""), 256))
    if known_texts is None:  # then as many rows as are written above
        whole = F.broadcast(whole)
    joined = rows.join(whole, rows["license_digest"] == whole["digest"], "left")
    return joined.select(id_col, "license_digest", "license_id", F.array_join(F.array_sort(F.array_distinct("_lines")), ",").alias("line_licenses"), F.size("_lines").cast("long").alias("n_license_lines"))


def oracle_sql() -> str:
    """The same lookup in DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    form = r"trim(regexp_replace(regexp_replace(lower(t), '(?m)^[\x20\x09]*(copyright|\(c\)|©|copr\.|all rights reserved)[^\n]*$', '', 'g'), '[^\p{L}\p{N}]+', ' ', 'g'))"
    for old, new in SPELLINGS:
        form = f"replace({form}, {quote(old)}, {quote(new)})"
    values = lambda d: ", ".join(f"({quote(k)}, {quote(t)})" for k, t in d.items())
    return f"""
WITH whole AS (SELECT id, sha256({form}) AS digest FROM (VALUES {values(KNOWN | {f"{k} notice": t for k, t in NOTICES.items()})}) v(id, t)),
notice AS (SELECT id, sha256({form}) AS digest FROM (VALUES {values(NOTICES)}) v(id, t)),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS t FROM docs),
hits AS (SELECT l.r, n.id FROM (SELECT r, sha256({form}) AS digest FROM lines WHERE regexp_matches(lower(t), '{CUE}')) l JOIN notice n USING (digest)),
by_doc AS (SELECT r, string_agg(DISTINCT id, ',' ORDER BY id) AS ids, count(*) AS n FROM hits GROUP BY r)
SELECT d.doc_id, d.digest AS license_digest, w.id AS license_id, coalesce(b.ids, '') AS line_licenses, coalesce(b.n, 0)::BIGINT AS n_license_lines
FROM (SELECT r, doc_id, sha256({form}) AS digest FROM docs) d LEFT JOIN whole w USING (digest) LEFT JOIN by_doc b USING (r)"""
