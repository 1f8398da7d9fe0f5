"""Licence scans by canonical digests, in DataFrame operations only.

A text is brought to a canonical form: lower case, copyright lines dropped, equivalent
spellings made one, punctuation and white space made single spaces.  Its SHA-256 digest is
hash-joined with the digests of known licence texts, so a text is a licence as a whole or not
at all.  The same look-up of each line finds licence notices inside other texts.

Null texts count as empty, and an empty text is no licence; each row gives one row, repeated
or not; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as one.
SPELLINGS = {
    "licence": "license",
    "sub-license": "sublicense",
    "non-infringement": "noninfringement",
    "non-commercial": "noncommercial",
    "copyright owner": "copyright holder",
    "organisation": "organization",
    "authorisation": "authorization",
    "acknowledgement": "acknowledgment",
    "per cent": "percent",
    "whilst": "while",
    "favour": "favor",
    "judgement": "judgment",
    "&": " and ",
    "http://": "https://",
}
#: Lines that name an owner: decoration, then a mark.
COPYRIGHT_LINE = "(^|\\n)[ \\t#*/;-]*(copyright|\\(c\\)|©)[^\\n]*"
#: Punctuation and white space except the line end.
MARKS = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F©®™«»“”‘’–—…·•\\xA0]+"

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so"
)
# Public licence texts and notices, by identifier.
KNOWN = (
    ("MIT", f"{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission "
            f"notice shall be included in all copies or substantial portions of the Software.\n\n{_WARRANTY}"),
    ("MIT-0", f"{_MIT_GRANT}.\n\n{_WARRANTY}"),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be "
                     "used to endorse or promote products derived from this software without specific prior written "
                     "permission. " + _BSD_END),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies.\n\n" + _ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted.\n\n" + _ISC_WARRANTY),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License. You may obtain a copy of the License at\n\n"
                   "http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in "
                   'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)


def canonical(text: Column) -> Column:
    """The canonical form, lines still apart."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "$1")
    for one, other in SPELLINGS.items():
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.regexp_replace(out, MARKS, " ")


def digest(lines: Column) -> Column:
    """The digest of a text in canonical form."""
    return F.sha2(F.trim(F.regexp_replace(lines, "[ \\n]+", " ")), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``digest`` and ``licence`` of the known texts; a fixed table of a few rows."""
    texts = spark.createDataFrame(list(known), "licence string, known_text string")
    found = texts.select(digest(canonical(F.col("known_text"))).alias("known_digest"), "licence")
    return found.groupBy("known_digest").agg(F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``digest``, ``licence`` (of the whole text, or null), ``notices`` (identifiers of
    the lines that are known texts, sorted, joined by commas) and ``notice_lines``."""
    known = known_digests(docs.sparkSession) if known is None else known
    lines = canonical(docs["text"].cast("string"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), lines.alias("lines"))
    # Known texts are a fixed list, a row each, so their digests can stand in the plan.
    table = [F.lit(x) for r in known.collect() for x in (r.known_digest, r.licence)]
    names = F.create_map(*table) if table else F.create_map().cast("map<string,string>")
    found = F.transform(F.split("lines", "\n"), lambda line: F.try_element_at(names, digest(line)))
    found = F.filter(found, lambda name: name.isNotNull())
    rows = rows.select("doc_id", digest(F.col("lines")).alias("digest"), found.alias("found"))
    # Identical texts meet in the join; the known side is the small one by construction.
    joined = rows.join(F.broadcast(known), rows["digest"] == known["known_digest"], "left")
    return joined.select(
        "doc_id",
        "digest",
        "licence",
        F.array_join(F.sort_array(F.array_distinct("found")), ",").alias("notices"),
        F.size("found").cast("long").alias("notice_lines"),
    )
