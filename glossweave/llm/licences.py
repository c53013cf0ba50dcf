"""Licence scan by canonical digests, in DataFrame functions only.

Whole texts, runs of paragraphs and whole lines are brought to a canonical form (lower case, no copyright, rights and title
lines, one spelling, no punctuation, single blanks), and their SHA-256 digests are joined with those of known licence texts.
Only units as long as a known text are hashed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.llm.common import filled

#: Known digests are broadcast up to this number of rows (about 100 bytes each) and joined by shuffling beyond.
BROADCAST_ROWS = 200_000

#: Paragraphs in a run; no known text has more once its title is gone.
MAX_RUN = 8
#: Lengths of known texts that are compared one by one; of more, only the smallest and the largest.
MAX_LENGTHS = 2_000

#: Spellings that count as equal, after punctuation has become blanks.
SPELLINGS = [
    ("licence", "license"), ("licencing", "licensing"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"), ("behaviour", "behavior"),
    ("modernisation", "modernization"), ("recognised", "recognized"), ("acknowledgement", "acknowledgment"),
    ("copyright holder", "copyright owner"), ("https", "http"), ("per cent", "percent"), ("merchantibility", "merchantability"),
]

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)

#: Public licence texts and notices by SPDX name.
KNOWN_TEXTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "MIT License " + _MIT),
    ("MIT", _MIT),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD_START + _BSD_WARRANTY),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission.\n" + _BSD_WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details. You should have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("proprietary", "All rights reserved."),
]

#: Lines without a say, in lower case: copyright and title lines, and rights lines beside others.
_SILENT_LINE = (
    r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
    r"|^[ \t]*(the )?(mit|isc|expat|(new |modified |simplified |revised )?bsd|bsd[ -][23][ -]clause|[23][ -]clause bsd) licen[sc]e( \((mit|isc|bsd|expat)\))?[ \t\r.:]*$"
    r"|^[ \t]*all rights reserved[.]?[ \t\r]*\n|\n[ \t]*all rights reserved[.]?[ \t\r]*$"
)
_OTHER = r"[^\p{L}\p{N}]+"
_BREAK = r"\n[ \t\r\n]*\n"


def canonical(text: Column) -> Column:
    """The form in which two texts of the same licence are equal."""
    plain = F.regexp_replace(F.lower(text), _SILENT_LINE, "")
    plain = F.concat(F.lit(" "), F.btrim(F.regexp_replace(plain, _OTHER, " ")), F.lit(" "))
    for other, one in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(one))
    return F.btrim(plain)


def known_digests(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN_TEXTS) -> DataFrame:
    """(``licence``, ``digest``, ``size``) of each known text; ``size`` is the length of its canonical form."""
    known = spark.createDataFrame(texts, "licence string, text string").select("licence", canonical(F.col("text")).alias("form"))
    return known.select("licence", F.sha2("form", 256).alias("digest"), F.char_length("form").alias("size")).distinct()


def _as_long_as(known: DataFrame) -> Callable[[Column], Column]:
    """Whether a length is that of a known text; a condition on one number, so units are dropped before they are hashed."""
    sizes = sorted(r[0] for r in known.select("size").distinct().limit(MAX_LENGTHS + 1).collect())
    if len(sizes) <= MAX_LENGTHS:
        return lambda size: size.isin(sizes)
    low, high = known.agg(F.min("size"), F.max("size")).first()
    return lambda size: size.between(low, high)


def licence_scan(docs: DataFrame, ident: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """(``ident``, ``licence``, ``unit``, ``n``): how often a unit of a row is a known licence.

    Units are the whole ``text``, ``paragraphs`` (runs of at most ``MAX_RUN`` between blank lines, of a text that has several) and
    each ``line`` of a text that has several; one place may count in more than one unit. NULL and empty texts, and units
    without letters or digits, match nothing; rows that repeat an id are counted together, NULL ids as one. Of an empty
    table nothing comes. Only matches are grouped, and counted before they move. ``known`` is a table like that of
    ``known_digests``.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    fits = _as_long_as(known)
    known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    whole = filled(F.col(text))
    forms = F.filter(F.transform(F.split(whole, _BREAK), canonical), lambda v: v != "")
    lines = F.split(whole, "\n")
    lines = F.transform(F.when(F.size(lines) > 1, lines).otherwise(F.array()), canonical)
    read = docs.select(F.col(ident).alias("__id"), forms.alias("forms"), lines.alias("lines"))

    def run(at: Column, n: int) -> Column:
        return F.slice("forms", at, n)

    def size(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(-1), lambda total, v: total + F.char_length(v) + 1)

    several = F.size("forms") > 1
    starts = F.when(several, F.sequence(F.lit(1), F.size("forms"))).otherwise(F.array().cast("array<int>"))

    def runs_of(n: int) -> Column:
        inside = F.filter(starts, lambda at: (at + (n - 1) <= F.size("forms")) & (F.size("forms") > n) & fits(size(run(at, n))))
        return F.transform(inside, lambda at: F.struct(F.lit("paragraphs").alias("unit"), F.array_join(run(at, n), " ").alias("form")))

    runs = [runs_of(n) for n in range(1, MAX_RUN + 1)]
    texts = F.when(fits(size(F.col("forms"))), F.array(F.struct(F.lit("text").alias("unit"), F.array_join("forms", " ").alias("form"))))
    single = F.transform(F.filter("lines", lambda v: fits(F.char_length(v))), lambda v: F.struct(F.lit("line").alias("unit"), v.alias("form")))
    rows = read.select("__id", F.explode(F.concat(F.coalesce(texts, F.filter(single, lambda _: F.lit(False))), single, *runs)).alias("__u"))
    rows = rows.select("__id", "__u.unit", F.sha2("__u.form", 256).alias("digest"))
    found = rows.join(known, "digest").groupBy("__id", "licence", "unit").agg(F.count("*").alias("n"))
    return found.select(F.col("__id").alias(ident), "licence", "unit", "n")


def _sql_canonical(value: str) -> str:
    plain = f"regexp_replace(lower({value}), '{_SILENT_LINE}', '', 'g')"
    plain = f"' ' || trim(regexp_replace({plain}, '{_OTHER}', ' ', 'g')) || ' '"
    for other, one in SPELLINGS:
        plain = f"replace({plain}, '{other}', '{one}')"
    return f"trim({plain})"


def _sql_texts() -> str:
    quoted = ["('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN_TEXTS]
    return ", ".join(quoted)


SCAN_SQL = f"""
WITH known AS (
  SELECT DISTINCT licence, sha256({_sql_canonical("text")}) AS digest FROM (VALUES {_sql_texts()}) AS k(licence, text)
), split AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, '{_BREAK}')) AS part, generate_subscripts(regexp_split_to_array(text, '{_BREAK}'), 1) AS place FROM documents
), forms AS (
  SELECT doc_id, list(form ORDER BY place) AS forms FROM (SELECT doc_id, place, {_sql_canonical("part")} AS form FROM split) WHERE form <> '' GROUP BY doc_id
), runs AS (
  SELECT doc_id, array_to_string(forms[a.place : a.place + b.n - 1], ' ') AS form
  FROM forms, unnest(range(1, len(forms) + 1)) AS a(place), unnest(range(1, {MAX_RUN} + 1)) AS b(n) WHERE a.place + b.n - 1 <= len(forms) AND b.n < len(forms)
), units AS (
  SELECT doc_id, 'text' AS unit, array_to_string(forms, ' ') AS form FROM forms
  UNION ALL
  SELECT doc_id, 'paragraphs', form FROM runs
  UNION ALL
  SELECT doc_id, 'line', {_sql_canonical("value")} FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents WHERE contains(text, chr(10)))
)
SELECT doc_id, licence, unit, count(*) AS n
FROM units JOIN known ON sha256(form) = digest GROUP BY doc_id, licence, unit
"""
