"""License scans by canonical digest lookup.

A text's canonical form has lower-case ASCII letters, no copyright lines, equivalent spellings made one, and one blank
for each run of other characters than letters and digits. A copyright line claims something: it begins with the sign, or
with the word (or "(c)") and has a sign, a year or the phrase "all rights reserved"; or it is that phrase alone. A line of
a wrapped licence that merely begins with the word stays. Its SHA-256 digest is looked up, by a hash join, among the
digests of known licences in the same form: the whole text against everything known, and each line as an entire notice
likewise. Only DataFrame functions are used. The known side is a table the caller gives (the catalogue below by
default, `catalogue_of` for a folder of licence texts); it is broadcast behind a check of its size, so that lines are
looked up where they lie and only found ones are shuffled. A text's form is made once: one pass writes its digest and
those of its lines, and both look-ups read that narrow table.

Edge cases: null texts count as empty; an empty form matches nothing; rows of one id are one document (its notices are
those of all its rows), null ids included; repeated rows are kept; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.shared import broadcast_if_small, documents, id_and_text, written

#: Equivalent spellings, replaced in this order after lower-casing.
SPELLINGS = [("licence", "license"), ("licencing", "licensing"), ("organisation", "organization"), ("merchantibility", "merchantability"), ("non-infringement", "noninfringement"), ("https://", "http://"), ("v. ", "version "), ("©", "copyright"), ("(c)", "copyright")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_YEAR = r"(?:\b(?:19|20)[0-9]{2}\b|[<\[{](?:year|yyyy)[>\]}])"
#: A copyright line of a text in lower case whose signs are still there.
CLAIM = rf"(^|\n)[ \t*#/;-]*(?:©[^\n]*|copyright\b(?=[^\n]*(?:©|\(c\)|{_YEAR}|all rights reserved))[^\n]*|\(c\)(?=[ \t]*copyright\b|[^\n]*{_YEAR})[^\n]*|all rights reserved[.!]?[ \t\r]*(?=\n|\z))"
#: The same in SQL, where a pattern can't look ahead: the line is taken with its mark.
CLAIM_SQL = rf"(?m)^[ \t*#/;-]*(?:©[^\n]*|copyright\b[^\n]*(?:©|\(c\)|{_YEAR}|all rights reserved)[^\n]*|\(c\)(?:[ \t]*copyright\b[^\n]*|[^\n]*{_YEAR}[^\n]*)|all rights reserved[.!]?[ \t\r]*$)"
OTHER = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"

#: Full texts of short licences, without their copyright lines.
_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
_ISC_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
TEXTS = [("MIT", _GRANT + _AS_IS), ("MIT", "MIT License\n\n" + _GRANT + _AS_IS), ("MIT", "The MIT License (MIT)\n\n" + _GRANT + _AS_IS), ("ISC", _ISC + _ISC_AS_IS), ("ISC", "ISC License\n\n" + _ISC + _ISC_AS_IS), ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "") + _ISC_AS_IS)]

_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
_BSD = ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."
_UNLICENSE = "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n" + _AS_IS.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS") + "\n\nFor more information, please refer to <https://unlicense.org>"
_APACHE = ["Licensed under the Apache License, Version 2.0 (the \"License\");", "you may not use this file except in compliance with the License.", "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."]
_SPDX = ["Apache-2.0", "MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Unlicense", "BSL-1.0", "MPL-2.0", "EPL-2.0", "CC0-1.0", *[f"{g}-{v}{way}" for g, v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")) for way in ("-only", "-or-later")]]


def more_texts() -> list[tuple[str, str]]:
    """(licence, text): further full texts, with numbered clauses or marks, and the headers and tags of source files."""
    found = []
    for name, title, count in (("BSD-2-Clause", "BSD 2-Clause License", 2), ("BSD-3-Clause", "BSD 3-Clause License", 3)):
        for clauses in (_BSD[:count], [f"{k}. {c}" for k, c in enumerate(_BSD[:count], 1)]):
            body = _BSD_GRANT + "\n".join(clauses) + "\n\n" + _BSD_AS_IS
            found += [(name, body), (name, f"{title}\n\n{body}")]
    found += [("Zlib", _ZLIB), ("Zlib", f"zlib License\n\n{_ZLIB}"), ("Unlicense", _UNLICENSE)]
    found += [("Apache-2.0", _APACHE[0]), ("Apache-2.0", " ".join(_APACHE[:2])), ("Apache-2.0", " ".join(_APACHE))]
    return found + [(name, f"SPDX-License-Identifier: {name}") for name in _SPDX]


def notices() -> list[tuple[str, str]]:
    """(licence, notice line) of usual one-line notices: each name in each wording."""
    names = [("Apache-2.0", "the Apache License, Version 2.0"), ("MIT", "the MIT License"), ("ISC", "the ISC License"), ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"), ("MPL-2.0", "the Mozilla Public License, Version 2.0")]
    names += [(f"{short}-{v}.0-only", f"the GNU {long}General Public License, version {v}") for short, long, versions in (("GPL", "", (1, 2, 3)), ("LGPL", "Lesser ", (2, 3)), ("AGPL", "Affero ", (3,))) for v in versions]
    names += [(f"CC-{kind.upper()}-{v}", f"CC {kind.upper()} {v}") for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for v in ("2.0", "2.5", "3.0", "4.0")]
    return [(short, f"{lead} under {long}.") for short, long in names for lead in ("Licensed", "Released", "Distributed", "This work is licensed", "This software is licensed")]


def lined(text: Column) -> Column:
    """The canonical form with its line ends."""
    x = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), CLAIM, "$1")
    for old, new in SPELLINGS:
        x = F.replace(x, F.lit(old), F.lit(new))
    return F.regexp_replace(x, OTHER, " ")


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digests_of(table: DataFrame) -> DataFrame:
    """(license, digest) of texts (license, text), one licence for each digest."""
    form = whole(lined(F.col("text")))
    return table.select("license", form.alias("form")).where("form <> ''").groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license").alias("license"))


def catalogue(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, digest) of known texts."""
    return digests_of(spark.createDataFrame(TEXTS + more_texts() + notices() if known is None else known, "license string, text string"))


def catalogue_of(spark: SparkSession, path: str) -> DataFrame:
    """(license, digest) of a folder of whole licence texts, each file named after its licence, besides those of the catalogue."""
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.(txt|md)$", "")
    files = spark.read.text(path, wholetext=True).select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("license"), F.col("value").alias("text"))
    return files.transform(digests_of).unionByName(catalogue(spark)).groupBy("digest").agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, canonical_sha256, license of the whole text or null, n_notices, notices): for every row, `notices` naming the licences of its lines."""
    known = broadcast_if_small(written(catalogue(docs.sparkSession) if known is None else known, "licences"))
    forms = id_and_text(docs, id_col, text_col).select("doc_id", lined(F.col("text")).alias("lines"))
    lines = F.array_distinct(F.transform(F.split("lines", "\n"), lambda x: F.trim(x)))
    lines = F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.unhex(F.sha2(x, 256)))  # nearly every text has an empty line, which is no notice
    rows = written(forms.select("doc_id", F.sha2(whole(F.col("lines")), 256).alias("digest"), lines.alias("lines")), "forms")
    each = rows.select("doc_id", F.explode("lines").alias("line")).select("doc_id", F.lower(F.hex("line")).alias("digest"))
    found = each.join(known, "digest").groupBy("doc_id").agg(F.array_sort(F.collect_set("license")).alias("names")).withColumnRenamed("doc_id", "id")
    out = rows.select("doc_id", "digest").join(known, "digest", "left").join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return out.select("doc_id", F.col("digest").alias("canonical_sha256"), "license", F.size(names).cast("long").alias("n_notices"), F.array_join(names, ",").alias("notices"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def _sql_form(text: str) -> str:
    x = rf"regexp_replace(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{CLAIM_SQL}', '', 'g')"
    for old, new in SPELLINGS:
        x = f"replace({x}, '{old}', '{new}')"
    return rf"regexp_replace({x}, '{OTHER}', ' ', 'g')"


def _sql_values() -> str:
    return ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in TEXTS + more_texts() + notices())


OP9_SQL = rf"""
with given(license, text) as (values {_sql_values()}),
known as (select sha256(form) as digest, min(license) as license
          from (select license, trim(regexp_replace({_sql_form("text")}, '[ \n]+', ' ', 'g'), ' ') as form from given) where form <> '' group by 1),
rows as (select cast(doc_id as bigint) as doc_id, {_sql_form("text")} as lines from documents),
lines as (select doc_id, sha256(trim(unnest(list_distinct(string_split(lines, chr(10)))), ' ')) as digest from rows),
found as (select doc_id, list_sort(list(distinct license)) as names from lines join known using (digest) group by doc_id)
select r.doc_id, sha256(trim(regexp_replace(r.lines, '[ \n]+', ' ', 'g'), ' ')) as canonical_sha256, k.license,
       cast(coalesce(len(f.names), 0) as bigint) as n_notices, coalesce(array_to_string(f.names, ','), '') as notices
from rows r
left join known k on k.digest = sha256(trim(regexp_replace(r.lines, '[ \n]+', ' ', 'g'), ' '))
left join found f on f.doc_id is not distinct from r.doc_id
"""
