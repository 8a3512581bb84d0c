"""License scans (operator 10), DataFrame functions only: canonical digests looked up by hash join.

A text is brought to a canonical form: A-Z in lower case, lines that only state a copyright dropped, every run of other
characters than letters, digits and non-ASCII ones turned into one space, equivalent spellings replaced. The SHA-256 of the
form is joined to the digests of known licence texts, which go through the same expressions. Both the whole document and
each of its lines, as a text of its own, are looked up.

Known texts are a table (license_id, text): by default the usual short licences, with and without their titles, and notices;
license_files reads a folder of full texts, one a file. The table is broadcast up to BROADCAST_ROWS digests, and shuffled
beyond. The canonical form is computed once: the digests of a text and of its lines are written with a number for the row.

Defined results: null texts and texts of which nothing is left have no digest and match nothing; repeated lines and rows
count as often as they stand, each row by its own text, whatever its id; a text known under several licences takes the
first in the alphabet; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .storage import materialize

#: Known digests up to this many are broadcast to the lookups.
BROADCAST_ROWS = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Spellings that licence texts use for one another, as (found, canonical), applied in this order.
SPELLINGS = [
    ("licence", "license"), ("organisation", "organization"), ("authoris", "authoriz"), ("sub license", "sublicense"),
    ("non commercial", "noncommercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http"),
    ("judgement", "judgment"), ("whilst", "while"), ("favour", "favor"), ("programme", "program"),
]

# A line that states a copyright and nothing that binds.
COPYRIGHT = r"(^|\n)[^a-z0-9\n]*(copyright[ \t]*(\(c\)|©|[0-9]|<|\[)|\(c\)|©)[^\n]*"
OTHER = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"

# What the two BSD licences have in common.
BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_END = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

# Known notices and licence texts, by SPDX identifier.
TEXTS = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", BSD_START + BSD_END),
    ("BSD-3-Clause", BSD_START + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission." + BSD_END),
    ("MIT-0", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>'),
]

# Titles that stand above a licence's text.
TITLES = [
    ("MIT", "MIT License"), ("MIT", "The MIT License"), ("MIT", "The MIT License (MIT)"), ("MIT-0", "MIT No Attribution"), ("ISC", "ISC License"), ("0BSD", "Zero-Clause BSD"), ("0BSD", "BSD Zero Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("Zlib", "zlib License"),
]
KNOWN = TEXTS + [(i, f"{title}\n{text}") for i, title in TITLES for j, text in TEXTS if i == j and len(text) > 300]


def canonical_lines(text: Column) -> Column:
    """The canonical form of a text, its lines kept apart: an array of non-empty lines."""
    t = F.regexp_replace(F.translate(text, UPPER, LOWER), COPYRIGHT, "$1")
    t = F.regexp_replace(t, OTHER, " ")
    for found, canonical in SPELLINGS:
        t = F.replace(t, F.lit(found), F.lit(canonical))
    return F.filter(F.transform(F.split(t, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def digest(lines: Column) -> Column:
    """The digest of a whole text from its canonical lines; null if nothing is left."""
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, " "), 256))


def known_texts(spark) -> DataFrame:
    """(license_id, text) of the texts known here."""
    return spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in KNOWN))))


def license_files(spark, folder: str) -> DataFrame:
    """(license_id, text) of a folder of full texts, each file named by its licence, with or without .txt."""
    name = F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.txt$", "")
    return spark.read.text(folder, wholetext=True).select(name.alias("license_id"), F.col("value").alias("text"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Per row: id, digest of the whole text, license_id of the whole text (or null), n_notices (lines that are a known
    text) and notices (their sorted distinct licences, comma-joined). known: (license_id, text) of the texts looked for."""
    known = known_texts(docs.sparkSession) if known is None else known
    known = known.select("license_id", digest(canonical_lines(F.col("text"))).alias("digest")).where("digest is not null")
    known = materialize(known.groupBy("digest").agg(F.min("license_id").alias("license_id")), "licenses")
    known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    forms = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("lines"))
    # Written once: row numbers are settled by the write.
    forms = materialize(forms.select("row", "id", digest(F.col("lines")).alias("digest"), F.transform("lines", lambda x: F.unhex(F.sha2(x, 256))).alias("lines")), "forms")
    each = forms.select("row", F.explode("lines").alias("line")).select("row", F.lower(F.hex("line")).alias("digest"))
    found = each.join(known, "digest").groupBy("row").agg(F.count(F.lit(1)).alias("n_notices"), F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    out = forms.select("row", "id", "digest").join(known, "digest", "left").join(found, "row", "left")
    return out.select(F.col("id").alias(id_col), "digest", "license_id", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices"))


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def oracle_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    form = f"regexp_replace(regexp_replace(translate(text, '{UPPER}', '{LOWER}'), {quote(COPYRIGHT)}, '\\1', 'g'), {quote(OTHER)}, ' ', 'g')"
    for found, canonical in SPELLINGS:
        form = f"replace({form}, {quote(found)}, {quote(canonical)})"
    lines = f"list_filter(list_transform(string_split({form}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    digest_of = "CASE WHEN len(l) > 0 THEN sha256(array_to_string(l, ' ')) END"
    values = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in KNOWN)
    return f"""
WITH known AS (SELECT {digest_of} AS digest, min(license_id) AS license_id FROM (SELECT license_id, {lines} AS l FROM (VALUES {values}) v(license_id, text)) GROUP BY 1),
f AS (SELECT doc_id, {lines} AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS line FROM f),
n AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS s FROM e JOIN known ON sha256(line) = digest GROUP BY doc_id)
SELECT f.doc_id, {digest_of} AS digest, k.license_id, coalesce(n.n, 0) AS n_notices, coalesce(n.s, '') AS notices
FROM f LEFT JOIN known k ON k.digest = {digest_of} LEFT JOIN n ON n.doc_id = f.doc_id
"""
