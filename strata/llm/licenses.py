"""License scan by canonical digests: texts that are a known licence, or a known notice of one, found by a hash join.

A text's canonical form has no case, punctuation, copyright lines or spelling variants; its digest is joined with the
digests of the known texts.  That is done for the whole document and, since documents carry notices, for each of its
lines as a whole text of its own.  Comparison is of entire texts only: a licence with one more word has another digest.

Null and empty texts have no licence; a canonical form without words matches nothing.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common

#: Known texts by licence; notices are the lines by which works state their licence.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

#: Whole licences in this folder, a file for each, named by licence.
TEXTS = Path(__file__).with_name("license_texts")
#: What follows the terms in some files: advice on using the licence, which copies often leave out.
AFTER_TERMS = re.compile(r"END OF TERMS AND CONDITIONS")
#: Titles of texts above, put before them.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "Expat License"], "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License", "BSD License",
    ],
}
#: Names by which notices call a licence.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache-2.0"],
    "MIT": ["MIT License", "MIT"], "ISC": ["ISC License", "ISC"], "BSD": ["BSD License", "BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1", "MPL-1.1"],
    # Notices without a version name the family only.
    "MPL": ["Mozilla Public License", "MPL"], "GPL": ["GNU General Public License", "GNU GPL", "GPL"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL", "LGPL"], "Artistic-1.0": ["Artistic License"], "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
}
for _short, _long, _versions in (
    ("GPL", "GNU General Public License", "1.0 2.0 3.0"), ("LGPL", "GNU Lesser General Public License", "2.1 3.0"),
    ("LGPL", "GNU Library General Public License", "2.0"), ("GFDL", "GNU Free Documentation License", "1.2 1.3"),
):
    for _v in _versions.split():
        _digit = _v.removesuffix(".0")
        NAMES[f"{_short}-{_v}"] = [
            n for v in {_v, _digit} for n in (
                f"{_long}, version {v}", f"{_long} version {v}", f"{_long} v{v}", f"{_long}, version {v} only", f"{_long}, version {v} or later",
                f"{_long}, version {v} or any later version", f"{_short} v{v}", f"{_short}v{v}", f"{_short} {v}", f"{_short}-{v}",
            )
        ]
#: How notices begin.
NOTICES = (
    "Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under", "This file is licensed under",
    "This software is licensed under", "This project is licensed under", "This software is released under", "This project is released under",
)
KNOWN = [
    ("MIT", MIT), ("ISC", ISC), ("BSD-2-Clause", BSD_HEAD + BSD_TAIL), ("BSD-3-Clause", BSD_HEAD + BSD_THIRD + BSD_TAIL),
    ("Apache-2.0", APACHE_NOTICE), ("MPL-2.0", MPL_NOTICE),
]


def with_variants(licence: str, text: str) -> list[tuple[str, str]]:
    """A whole text with and without title, numbers of its list and what follows its terms."""
    texts = [text]
    if licence.startswith("BSD"):
        # Copies have bullets in place of numbers, or one or two paragraphs for the name.
        texts += [re.sub(r"(?m)^\s*[123]\. ", "", text)]
    for title in TITLES.get(licence, ()):
        texts += [f"{title}\n\n{t}" for t in list(texts) if not t.startswith(tuple(TITLES[licence]))]
    return [(licence, t) for t in texts]


def from_file(licence: str, text: str) -> list[tuple[str, str]]:
    """A licence's file with and without its title (first line, or first paragraph) and what follows its terms."""
    whole = text.strip()
    texts = [whole]
    if end := AFTER_TERMS.search(whole):
        texts += [whole[: end.start()], whole[: end.end()]]
    # Titles take one or two paragraphs.
    untitled = [t.split("\n", 1)[1] for t in texts] + [re.split(r"\n\s*\n", t, maxsplit=n)[n] for t in texts for n in (1, 2)]
    return [(licence, t) for t in texts + untitled]


def known_texts(folder: Path = TEXTS) -> list[tuple[str, str]]:
    """All known texts as (licence, text): whole licences of this module and the folder, notices and identifiers."""
    out = [row for licence, text in KNOWN for row in with_variants(licence, text)]
    for path in sorted(folder.glob("*.txt")):
        text, licence = path.read_text("utf-8"), path.stem
        licence = {"BSD": "BSD-3-Clause", "Artistic": "Artistic-1.0"}.get(licence, re.sub(r"^(L?GPL-\d)$", r"\1.0", licence))
        if path.stem == "BSD":  # begins with its copyright lines; the University's wording
            out += with_variants(licence, text)
        else:
            out += from_file(licence, text)
    for licence, names in NAMES.items():
        out += [(licence, f"{begin} {the}{name}") for begin in NOTICES for the in ("", "the ", "a ") for name in names]
        ids = [licence] if licence[:2] not in ("GP", "LG", "GF") else [licence, f"{licence}-only", f"{licence}-or-later", f"{licence}+"]
        out += [(licence, f"SPDX-License-Identifier: {i}") for i in ids if i not in ("BSD", "MPL", "GPL", "LGPL", *(f"{f}{e}" for f in ("GPL", "LGPL") for e in ("-only", "-or-later", "+")))]
    return out


#: Spellings that count as one.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"), ("favour", "favor"),
    ("colour", "color"), ("noncommercial", "non commercial"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"),
    ("https", "http"), ("v2", "version 2"), ("v3", "version 3"), ("copyright holders", "copyright holder"), ("copyright owners", "copyright holder"), ("copyright owner", "copyright holder"),
]

#: Those of several words may stand across a line's end, so they count anew in the whole text.
LONG_SPELLINGS = [(other, one) for other, one in SPELLINGS if " " in other]

#: What goes on after "copyright" in licences' own sentences, where a line may begin with it, and what
#: paragraphs numbered (c) begin with.
PROSE_AFTER = (
    r"(?:and|or|in|on|to|is|are|as|of|for|if|that|which|with|under|from|has|have|shall|may|can|will|does|notices?|holders?|holder's|owners?|owner's|owned|"
    r"laws?|licen[cs]es?|licensors?|licensees?|statements?|information|interests?|claims?|permissions?|protections?|treaty|treaties|"
    r"patents?|trademarks?|disclaimers?|doctrines?|rights?|status|years?|lines?|page|terms|infringement|like|resulting|the\s+software|grants?|date)"
)
SENTENCE_STARTS = (
    r"(?:you|your|the|this|that|these|those|any|all|each|every|if|in|to|an?|such|subject|under|for|accompany|convey|cause|where|when|"
    r"unless|except|no|not|provide|provided|use|give|make|prohibit|require|requiring|limiting|declining|include|it|which|or|and|by\s+the\s+terms|"
    r"licensor|licensee|contributors?|initial|modifications?|however|notwithstanding|redistributions?|neither|rename|distribute|place)\b"
)
YEARS = r"[\d<\[{(][^\n]*"
#: A line that begins with copyright, its sign or (c) and names a holder, a year or a place for them.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\n©]*(?:"
    rf"(?i:copyright)\b[ \t:,]*(?i:\(c\)|©|&copy;|{YEARS})[^\n]*"
    rf"|(?i:copyright)\b[ \t:,]+(?!(?i:{PROSE_AFTER})\b)[\p{{L}}\p{{N}}\"'“][^\n]*"
    rf"|(?i:\(c\))[ \t]*(?:{YEARS}|(?i:copyright)\b[^\n]*"
    rf"|(?!(?i:{SENTENCE_STARTS}))(?:(?i:by)\s+)?\p{{Lu}}[^\s,]*(?:[ \t,&]+(?:\p{{Lu}}[^\s,]*|[\d\-–]+|and|of|the|et|al\.?|for|contributors|others|de|van|von|<[^>\n]*>)){{0,40}}"
    r"(?i:[ \t,.]*all rights reserved)?[ \t.,;*/#]*)"
    r"|©[^\n]*|(?i:all rights reserved)[^\n]*)$"
)


def spelled(words: Column, spellings: list[tuple[str, str]]) -> Column:
    """Words, each with a space of its own on both sides, with every spelling replaced, also next to another one."""
    for other, one in spellings:
        words = F.replace(words, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {one.replace(' ', '  ')} "))
    return words


def canonical_lines(text: Column) -> Column:
    """The lines of a text as lower-case words of letters and digits with two spaces between, in one spelling, without
    copyright lines."""
    kept = F.when(text.rlike(r"(?i)copyright|©|\(c\)|all rights"), F.regexp_replace(text, COPYRIGHT_LINE, "")).otherwise(text)
    words = F.regexp_replace(F.lower(kept), r"[^\p{L}\p{N}\n]+", "  ")
    return F.split(spelled(F.concat(F.lit(" "), F.replace(words, F.lit("\n"), F.lit(" \n ")), F.lit(" ")), SPELLINGS), "\n")


def digests(text: Column) -> Column:
    """Digests of the whole text, first, and of its different lines; lines without words are left out.

    Line ends do not count in the whole text: spellings of several words are replaced across them.
    """
    squeezed = lambda words: F.trim(F.regexp_replace(words, " +", " "))
    joined = lambda lines: F.concat(F.lit(" "), F.replace(F.array_join(lines, " "), F.lit(" "), F.lit("  ")), F.lit(" "))
    return common.let(
        F.filter(F.transform(canonical_lines(text), squeezed), lambda line: line != ""),
        lambda lines: F.concat(
            F.array(F.sha2(squeezed(spelled(joined(lines), LONG_SPELLINGS)), 256)),
            F.transform(F.array_distinct(lines), lambda line: F.sha2(line, 256)),
        ),
    )


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    texts = spark.createDataFrame(known_texts() if known is None else known, "license string, known string")
    return texts.select(digests(F.col("known"))[0].alias("digest"), "license").dropDuplicates(["digest"])


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): digest of the whole text, the licence that it is, if any, and the licences
    that its lines are, in order and each once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), digests(text).alias("digests"))
    # Broadcast: as many rows as the list of known texts.
    table = F.broadcast(known_digests(docs.sparkSession, known))
    whole = F.col("at") == 0
    return (
        rows.select("row", "doc_id", F.posexplode("digests").alias("at", "digest")).join(table, "digest", "left")
        .groupBy("row", "doc_id").agg(
            F.max(F.when(whole, F.col("digest"))).alias("digest"), F.max(F.when(whole, F.col("license"))).alias("license"),
            F.array_sort(F.collect_set(F.when(~whole, F.col("license")))).alias("notices"),
        )
        .select("doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"))
    )
