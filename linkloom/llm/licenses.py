"""Whole-text licence recognition by canonical digests, in DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Iterator
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts of well-known short licences, whole, one per name.
LICENCES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use
this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim
that you wrote the original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,
and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any
source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the
License.""",
    "SPDX MIT": "SPDX-License-Identifier: MIT",
    "SPDX Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
}
# Title lines that files put above the short texts.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"),
}
# How the last clause of BSD-3-Clause names the holder.
NEITHER = ("the copyright holder nor the names of its", "the copyright holders nor the names of its", "the author nor the names of its")
# Spellings that count as the same word, after lower-casing.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "authorise": "authorize",
    "authorised": "authorized",
    "behaviour": "behavior",
    "favour": "favor",
    "fulfil": "fulfill",
    "initialise": "initialize",
    "judgement": "judgment",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "merchantibility": "merchantability",
    "modelled": "modeled",
    "organisation": "organization",
    "organise": "organize",
    "programme": "program",
    "recognise": "recognize",
    "sub-license": "sublicense",
    "sublicence": "sublicense",
    "wilful": "willful",
}
# Lines that state a holder: a copyright with the sign or a year, one that begins a paragraph, or the reserved rights.
# A wrapped line of licence text ("copyright notice, ...", "(c) You must ...") is none of these.
HOLDER = (
    r"^[^\n0-9a-z]*(?:portions )?copyright[ \t:]*(?:\(c\)|©|(?:19|20)[0-9]{2}\b)[^\n]*$",
    r"^[^\n0-9a-z]*(?:portions )?(?:\(c\)|©)[^\n]*\b(?:19|20)[0-9]{2}\b[^\n]*$",
    r"^[^\n0-9a-z]*©[^\n]*$",
    r"^[^\n0-9a-z]*all rights reserved[^\n0-9a-z]*$",
    r"(?:\A|\n[^\n0-9a-z]*\n)[^\n0-9a-z]*copyright[ \t]+"
    r"(?!(?:notice|holder|owner|licen[cs]e|law|statement|interest|and|or)s?\b)[^\n]*$",
)
# The SQL twin's pattern, which takes wrapped licence text that begins with "copyright" for such a line.
COPYRIGHT_LINE = r"^[^\n0-9A-Za-z]*(?:portions )?(?:copyright[ \t]|\(c\)|©|all rights reserved)[^\n]*$"
NO_WORD = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """Lower-cased words of a text, one space between them, without lines that state a holder; null gives the empty text."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    words = F.regexp_replace(F.regexp_replace(lower, "(?md)" + "|".join(HOLDER), " "), NO_WORD, " ")
    padded = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    for spelling, usual in SPELLINGS.items():
        spelling = spelling.replace("-", "  ")
        padded = F.replace(padded, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return F.trim(F.replace(padded, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def licence_digests(spark: SparkSession, licences: dict[str, str] | None = None) -> DataFrame:
    """``digest, license`` of every known licence; of licences with equal canonical texts the first name."""
    rows = [
        F.struct(F.lit(name).alias("license"), F.lit(body).alias("body")) for name, body in (licences or LICENCES).items()
    ]
    known = spark.range(1).select(F.inline(F.array(*rows)))
    return known.groupBy(digest(F.col("body")).alias("digest")).agg(F.min("license").alias("license"))


def licence_texts() -> Iterator[tuple[str, str]]:
    """``name, body`` of all shipped licences: with and without title, with and without what follows their terms."""
    whole = list(LICENCES.items())
    for file in (resources.files(__package__) / "licence_texts").iterdir():
        name, body = file.name.removesuffix(".txt"), file.read_text("utf-8")
        whole.append((name, body))
        if name == "BSD-3-Clause":
            body = re.sub(r"\A.*?(?=Redistribution)", "", body, flags=re.S).replace("REGENTS AND", "COPYRIGHT HOLDERS AND")
            body = body.replace("THE REGENTS OR", "THE COPYRIGHT HOLDER OR")
            whole += [(name, re.sub(r"the University nor the names of its", holder, body)) for holder in NEITHER]
        elif name not in TITLES:
            # The title is the first paragraph.
            whole.append((name, re.sub(r"\A\s*\S.*?\n[ \t]*\n", "", body, count=1, flags=re.S)))
    for name, body in whole:
        yield name, body
        yield from ((name, f"{title}\n\n{body}") for title in TITLES.get(name, ()))
        if ends := re.search(r"END OF TERMS AND CONDITIONS", body):
            yield name, body[: ends.start()]
            yield name, body[: ends.end()]
    for name in sorted({name for name, _ in whole if " " not in name} - {"MIT", "Apache-2.0"}):
        yield f"SPDX {name}", f"SPDX-License-Identifier: {name}"


def shipped_digests(spark: SparkSession) -> DataFrame:
    """``digest, license`` of :func:`licence_texts`."""
    known = spark.createDataFrame(list(licence_texts()), "license string, body string")
    return known.groupBy(digest(F.col("body")).alias("digest")).agg(F.min("license").alias("license"))


def license_scan(
    docs: DataFrame, licences: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, digest, license``; ``license`` is null where no licence is the whole text.

    ``licences`` are ``digest, license`` rows of any number; whether they are
    small enough to broadcast is measured by Spark.  A null or empty text has the
    digest of the empty text and no licence.  Repeated rows give a row each, a
    null id stays null, and other columns are not read.
    """
    known = licence_digests(docs.sparkSession) if licences is None else licences
    rows = docs.select(F.col(id_column).alias("doc_id"), digest(F.col(text_column)).alias("digest"))
    return rows.join(known, "digest", "left").select("doc_id", "digest", "license")


def _sql_canonical(text: str) -> str:
    line = COPYRIGHT_LINE.removeprefix("(?m)").replace("'", "''")
    words = f"regexp_replace(regexp_replace(lower(coalesce({text}, '')), '(?m){line}', ' ', 'g'), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')"
    padded = f"' ' || replace({words}, ' ', '  ') || ' '"
    for spelling, usual in SPELLINGS.items():
        padded = f"replace({padded}, ' {spelling.replace('-', '  ')} ', ' {usual} ')"
    return f"trim(replace({padded}, '  ', ' '), ' ')"


def oracle() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(name)}, {quote(body)})" for name, body in LICENCES.items())
    return f"""
WITH known AS (SELECT sha256({_sql_canonical("body")}) AS digest, min(license) AS license
               FROM (VALUES {rows}) AS l(license, body) GROUP BY 1)
SELECT d.doc_id, d.digest, k.license
FROM (SELECT doc_id, sha256({_sql_canonical("text")}) AS digest FROM documents) d LEFT JOIN known k USING (digest)
"""
