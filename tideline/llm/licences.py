"""Licence scan by canonical digest: whole texts hash-joined to known licences.

A text's canonical form is lower case, without copyright statements, with words
of equivalent spelling made one, and with everything but letters and digits
turned into single spaces.  A known text that opens with its title is looked up
with any of its usual titles and without one.  Its SHA-256 is joined to the
digests of known licences.

Known texts inside a longer text are found by the same digests.  The canonical
form keeps where lines and sentences end; where the opening words of a known
text follow such an end, the next characters, as many as a known text with
those words has, are hashed and looked up if they stop at such an end too.  So a
known text is found however its lines are wrapped or marked, and nothing but the
known texts decides which places are looked at.  All of it is column
expressions; no row of the documents moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as one word.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("https", "http"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
    ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("sublicence", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"),
)

# Short licences in full, and notices that stand for one.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
    "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.\n"
)
_BSD_CLOSING = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = (
    ("MIT", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a "
     'copy of this software and associated documentation files (the "Software"), to deal in the '
     "Software without restriction, including without limitation the rights to use, copy, modify, "
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
     "The above copyright notice and this permission notice shall be included in all copies or "
     'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
     "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
     "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
     "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
     "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any "
     "purpose with or without fee is hereby granted, provided that the above copyright notice and "
     "this permission notice appear in all copies.\n\n" + _AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted.\n\n" + _AS_IS),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_OPENING + _BSD_CLOSING),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_OPENING
     + "3. Neither the name of the copyright holder nor the names of its contributors may be used "
     "to endorse or promote products derived from this software without specific prior written "
     "permission.\n" + _BSD_CLOSING),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)

# The notices that files usually carry, and more short licences.
_GNU = (
    "This {0} is free software{6} you can redistribute it and/or modify it under the terms of the "
    "GNU {1} as published by the Free Software Foundation{2} either version {3} of the License, or "
    "{4}at your option{5} any later version."
)
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use '
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    *((f"{kind}-{version}-or-later", _GNU.format(thing, title, ",", shown, "(", ")", ":"))
      for kind, version, shown, title in (
          ("GPL", "2.0", "2", "General Public License"), ("GPL", "3.0", "3", "General Public License"),
          ("LGPL", "2.1", "2.1", "Lesser General Public License"),
          ("LGPL", "3.0", "3", "Lesser General Public License"),
          ("AGPL", "3.0", "3", "Affero General Public License"))
      for thing in ("program", "library", "file")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
     "If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\n"
     "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
     "either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means.\n\n"
     "In jurisdictions that recognize copyright laws, the author or authors of this software "
     "dedicate any and all copyright interest in the software to the public domain. We make this "
     "dedication for the benefit of the public at large and to the detriment of our heirs and "
     "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of "
     "all present and future rights to this software under copyright law.\n\n"
     'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
     "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
     "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\n"
     "For more information, please refer to <https://unlicense.org>"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no "
     "event will the authors be held liable for any damages arising from the use of this "
     "software.\n\nPermission is granted to anyone to use this software for any purpose, including "
     "commercial applications, and to alter it and redistribute it freely, subject to the following "
     "restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim "
     "that you wrote the original software. If you use this software in a product, an "
     "acknowledgment in the product documentation would be appreciated but is not required.\n"
     "2. Altered source versions must be plainly marked as such, and must not be misrepresented as "
     "being the original software.\n"
     "3. This notice may not be removed or altered from any source distribution."),
)

OPENING_WORDS = 4  # of a known text; where they stand a digest is looked up
BODY_WORDS = 40  # a known text of as many words may stand under its licence's titles
# Titles under which the known texts usually stand, the first that of KNOWN if it has one.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT",
            "Expat License", "License: MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD",
             "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License",
                     "2-Clause BSD License", "Simplified BSD License", "BSD License", "FreeBSD License",
                     'BSD 2-Clause "Simplified" License', "The BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                     "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "The BSD License", "BSD-3-Clause"),
}

# A copyright statement ends where its line, a sentence or a licence's opening words say so.
_YEAR = r"(?:(?:19|20)\d\d\b|[<\[{]+ ?(?:year|yyyy))"
_LEGAL = r"(?:notice|holder|owner|law|licen[sc]e|act|statement|claim|interest|protection)s?\b"
_OPENING = (
    r"\b(?:permission (?:is hereby|to use)|redistributions? |licen[sc]ed (?:under|to)|released under|"
    r"(?:distributed|available|published) under|dedicated to|the above copyright|"
    r"this (?:work|software|program|library|file|project|code) (?:is|may)|use of this)"
)
_LAST = r"(?<=[\p{L}\p{N}>)]{3}\.)(?<!\b(?:inc|ltd|corp|llc|pty|bros|gmbh|esq)\.)(?=\s+\p{L})"
_MARKED = (
    rf"(?:copyright[ \t:,]*(?:\(c\)|©|[<\[{{]|{_YEAR})|(?:\(c\)|©)[ \t]*(?:copyright[ \t:,]*)?{_YEAR})"
)
_NAMED = rf"copyright(?! {_LEGAL})[^\n.]{{0,80}}?\b{_YEAR}"
_RESERVED = r"all rights reserved(?:\.|(?=[^\p{L}\p{N}\n]*$))"
_RIGHTS = (
    rf"(?im)^[^\p{{L}}\p{{N}}\n]*(?:©|{_MARKED}|{_NAMED})[^\n]*?(?:$|(?={_OPENING})|(?=\b{_RESERVED})|{_LAST})"
    rf"|\b{_MARKED}[^\n]{{0,200}}?(?=\b{_RESERVED}|{_OPENING})"
)
# a holder without a year is known by its capitals
_HOLDER = (
    rf"(?m)^[^\p{{L}}\p{{N}}\n]*Copyright (?:by )?(?!(?i:{_LEGAL}))\p{{Lu}}[^\n]*?"
    rf"(?:$|(?=(?i:{_OPENING}))|(?=\b(?i:{_RESERVED}))|{_LAST})"
)
_ALL_RIGHTS = rf"(?im)(?:^[^\p{{L}}\p{{N}}\n]*|(?<=\x00)[^\p{{L}}\p{{N}}\n]*){_RESERVED}"
_VARIANTS = "|".join(a for a, _ in SPELLINGS)


def canonical_lines(text: Column) -> Column:
    """Canonical form of a text with its ends: "\\n" ends a line, "\\r" a sentence.

    Ends stand in place of the blank between two words.  NULL counts as empty.

    A copyright statement is "copyright" with "(c)", the sign, a year or a
    placeholder, or one of the signs with a year.  At the start of a line, after
    marks and blanks, it goes up to the end of the line or sentence or the
    opening words of a licence, elsewhere only up to such words; at the start of
    a line the sign alone and "Copyright" with a name in capitals count too.
    "All rights reserved" goes after a statement or at the start of a line.
    """
    whole = F.translate(F.coalesce(text, F.lit("")), "\r", " ")
    low = F.lower(whole)
    marks = [F.contains(low, F.lit(m)) for m in ("copyright", "(c)", "©", "all rights reserved")]
    any_mark = marks[0] | marks[1] | marks[2] | marks[3]
    bare = F.regexp_replace(F.regexp_replace(whole, _RIGHTS, "\0"), _HOLDER, "\0")
    bare = F.when(any_mark, F.lower(F.regexp_replace(bare, _ALL_RIGHTS, " "))).otherwise(low)
    ends = F.regexp_replace(bare, r"[.!?:;](?=[ \t\n\x00]|\z)|[。！？]", "\r")
    words = F.regexp_replace(ends, r"[^\p{L}\p{N}\n\r]+", " ")
    words = F.regexp_replace(words, r" ?\n[ \n\r]*| ?\r[ \r]*\n[ \n\r]*", "\n")
    words = F.btrim(F.regexp_replace(words, r" ?\r[ \r]*", "\r"), F.lit(" \n\r"))
    # spellings are changed only where one occurs
    changed = words
    for variant, usual in SPELLINGS:
        changed = F.regexp_replace(changed, rf"\b{variant}\b", usual)
    return F.when(F.regexp_like(words, F.lit(rf"\b(?:{_VARIANTS})\b")), changed).otherwise(words)


def _joined(lines: Column) -> Column:
    return F.translate(lines, "\n\r", "  ")


def canonical(text: Column) -> Column:
    """Canonical form of a text, see ``canonical_lines``; words with single blanks."""
    return _joined(canonical_lines(text))


def known_digests(
    spark: SparkSession, known: DataFrame | Sequence[tuple[str, str]]
) -> DataFrame:
    """(known_digest, license, opening, chars), one row per known canonical text.

    ``known`` holds (license, text).  A text that begins with one of its
    licence's titles, or has 40 words or more, counts under any of those titles
    and without one.  Texts that are NULL or hold no word are left out; of texts
    with one canonical form the smallest name counts.
    """
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(known), "license string, text string")
    titles = spark.createDataFrame(
        [(n, t) for n, ts in TITLES.items() for t in ts], "license string, title string"
    ).groupBy("license").agg(F.collect_set(canonical(F.col("title"))).alias("titles"))
    texts = known.select("license", canonical(F.col("text")).alias("words")).join(
        F.broadcast(titles), "license", "left"
    ).withColumn("titles", F.coalesce("titles", F.array().cast("array<string>")))
    ahead = F.filter("titles", lambda t: F.startswith(F.col("words"), F.concat(t, F.lit(" "))))
    cut = F.coalesce(F.array_max(F.transform(ahead, F.length)), F.lit(-1)) + 2
    body = F.col("words").substr(cut, F.length("words"))
    long = F.size(F.split("words", " ")) >= BODY_WORDS
    under = F.transform("titles", lambda t: F.concat(t, F.lit(" "), body))
    forms = F.when(
        (F.size("titles") > 0) & ((cut > 1) | long), F.concat(F.array("words", body), under)
    ).otherwise(F.array("words"))
    rows = texts.select("license", F.explode(forms).alias("words")).filter("words <> ''")
    return rows.groupBy(F.sha2("words", 256).alias("known_digest")).agg(
        F.min("license").alias("license"),
        F.first(F.substring_index("words", " ", OPENING_WORDS)).alias("opening"),
        F.first(F.length("words")).alias("chars"),
    )


def _found(lines: Column, rows: list) -> Column:
    """Known texts at the ends of ``lines``: an array of (license, line), NULLs included.

    ``line`` says that the text is one whole line.
    """
    pairs = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    names = pairs({r.known_digest: r.license for r in rows})
    lengths: dict[str, set[int]] = {}
    for r in rows:
        lengths.setdefault(r.opening.split(" ")[0], set()).add(r.chars)
    sizes = F.create_map(
        *[x for w, ns in lengths.items() for x in (F.lit(w), F.array(*map(F.lit, sorted(ns))))]
    )
    openings = "|".join(sorted({r.opening.replace(" ", "[ \n\r]") for r in rows}, reverse=True))
    longest = max(r.chars for r in rows)
    # the end before, the opening words, and as much as the longest known text and the end after need
    place = rf"(?s)(?=((?:\A|[\n\r])(?:{openings})(?=[ \n\r]|\z).{{0,{longest + 1}}}))(?:\A|[\n\r])"

    def at(piece: Column) -> Column:
        ended = F.regexp_like(piece, F.lit(r"\A[\n\r]"))
        rest = F.when(ended, F.substr(piece, F.lit(2))).otherwise(piece)
        line_before = ~F.startswith(piece, F.lit("\r"))

        def of(n: Column) -> Column:
            part = F.substr(rest, F.lit(1), n)
            after = F.substr(rest, n + 1, F.lit(1))
            line = line_before & (after != "\r") & ~F.contains(part, F.lit("\n"))
            return F.when(
                (F.length(part) == n) & after.isin("", "\n", "\r"),
                F.struct(
                    F.try_element_at(names, F.sha2(_joined(part), 256)).alias("license"),
                    line.alias("line"),
                ),
            )

        first = F.substring_index(_joined(rest), " ", 1)
        return F.transform(
            F.coalesce(F.try_element_at(sizes, first), F.array().cast("array<int>")), of
        )

    pieces = F.regexp_extract_all(lines, F.lit(place), F.lit(1))
    return F.flatten(F.transform(pieces, at))


def _listed(names: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(names))), ",")


def declared_licences(text: Column) -> Column:
    """Names in "SPDX-License-Identifier:" tags, sorted, joined by commas; exceptions are left out."""
    said = F.regexp_extract_all(
        F.coalesce(text, F.lit("")),
        F.lit(r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)"), F.lit(1),
    )
    terms = F.transform(
        said, lambda x: F.split(F.regexp_replace(x, r"(?i)\bwith[ \t]+[^ \t)]+", " "), r"[ \t()]+")
    )
    named = F.filter(
        F.flatten(terms),
        lambda t: F.regexp_like(t, F.lit(r"\A[A-Za-z0-9]")) & ~F.upper(t).isin("AND", "OR"),
    )
    return _listed(named)


def scan_licences(
    docs: DataFrame, known: DataFrame | Sequence[tuple[str, str]] = KNOWN + HEADERS,
    id_col: str = "doc_id", text_col: str = "text", max_known: int = 20_000,
) -> DataFrame:
    """One row per row: id, license, notices, passages, declared, canonical_sha256.

    ``known`` is a table or list of (license, text).  ``license``: the known
    licence that the whole text is, else NULL.  ``notices``: licences of which a
    line of the text is a known text.  ``passages``: licences of which a known
    text stands anywhere in the text from one line or sentence end to another,
    over as many lines as it may.  ``declared``: names in SPDX tags.  All three
    are sorted and joined by commas, empty if none.  NULL and empty texts have
    the digest of the empty text, which no known licence has.  An empty table
    gives an empty result; other columns are ignored.

    Digest, opening words and length of the known texts travel with the plan;
    more than ``max_known`` forms of known texts are refused with a ValueError.
    """
    spark = docs.sparkSession
    digests = known_digests(spark, known)
    rows = digests.limit(max_known + 1).collect()  # digests, no texts
    if len(rows) > max_known:
        raise ValueError(f"more than {max_known} forms of known texts")
    text = F.col(text_col)
    lines = docs.select(
        F.col(id_col).alias("__id"), canonical_lines(text).alias("__lines"),
        declared_licences(text).alias("declared"),
    )
    found = (
        _found(F.col("__lines"), rows) if rows
        else F.array().cast("array<struct<license:string,line:boolean>>")
    )
    out = lines.select(
        "__id", "declared", F.sha2(_joined(F.col("__lines")), 256).alias("canonical_sha256"),
        found.alias("__found"),
    ).select(
        "__id", "declared", "canonical_sha256",
        _listed(F.transform(F.filter("__found", lambda x: x.line), lambda x: x.license))
        .alias("notices"),
        _listed(F.transform("__found", lambda x: x.license)).alias("passages"),
    )
    table = spark.createDataFrame(
        [(r.known_digest, r.license) for r in rows], "known_digest string, license string"
    )
    return out.join(
        F.broadcast(table), F.col("canonical_sha256") == F.col("known_digest"), "left"
    ).select(
        F.col("__id").alias(id_col), "license", "notices", "passages", "declared", "canonical_sha256"
    )
