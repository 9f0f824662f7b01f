"""Known licence texts and notices in documents, by the digest of a canonical form; DataFrame functions only.

Units are the whole text, each paragraph (between blank lines) and each line; whole licences are also found anywhere inside a text:
where their first words stand, the run of as many words as they have is a unit. The whole text may have a usual heading. A unit is brought to a canonical form: lower case,
copyright lines dropped, equivalent spellings made equal, every run of other characters than letters and digits one
blank. The SHA-256 of this form is joined with the digests of the known texts, which are a small fixed table. Only texts
with a word that every known text contains are cut into units.

Defined results: NULL and empty texts match nothing; rows equal in id and text are one document; an empty table gives no rows. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.llm.common import HASH, ID, KEY, keyed

#: Words by which the place of a whole licence in a text is found.
HEAD = 8
#: Each known text holds one of these.
MARKERS = ("licen", "software")

#: Spellings made equal, as (pattern, replacement) on lower-case words.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("organisation", "organization"), ("recognised", "recognized"),
    ("authorised", "authorized"), ("favour", "favor"), ("fulfil", "fulfill"), ("non commercial", "noncommercial"),
    ("sub license", "sublicense"), ("per cent", "percent"), ("version 2 0", "version 2"), ("version 3 0", "version 3"),
)

#: Public licence texts and notices.
KNOWN = {
    "Apache-2.0 notice": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\")",),
    "MIT notice": ("Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."),
    "GPL-3.0 notice": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."),
    "CC-BY-NC-4.0 notice": ("Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."),
    "CC-BY-4.0 notice": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
    "BSD-3-Clause notice": ("Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software.\n3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
}

BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN |= {"BSD-3-Clause": (BSD + BSD_NAMES + BSD_END,), "BSD-2-Clause": (BSD + BSD_END,)}

#: Usual headings of whole texts.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"),
    "Zlib": ("zlib License", "The zlib License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License"), "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License"),
}

#: Whole texts of other licences, read by the driver.
TEXTS = Path(__file__).with_name("license_texts")
#: The appendix behind it is often left out.
LAST_LINE = "END OF TERMS AND CONDITIONS"

COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[^\n]*(?:\b\d{4}\b|\(c\)|©|yyyy)|\(c\)[^\n\p{L}]*\d{4}|©)[^\n]*$"
    r"|^[^\p{L}\p{N}\n]*all rights reserved\W*$"
)


def whole_texts() -> list[tuple[str, str]]:
    """license, text of each whole licence."""
    out = [(name, text) for name, texts in KNOWN.items() if not name.endswith(" notice") for text in texts]
    for file in sorted(TEXTS.glob("*.txt")):
        text = file.read_text()
        out.append((file.stem, text))
        if LAST_LINE in text:
            terms = text[: text.index(LAST_LINE)]
            out += [(file.stem, terms), (file.stem, terms + LAST_LINE)]
    return out


def canonical(text: Column) -> Column:
    """The form that is digested."""
    words = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " "), r"[^\p{L}\p{N}]+", "  ")
    # Two blanks between words, so that of neighbouring spellings each has its own.
    out = F.concat(F.lit(" "), F.btrim(words), F.lit(" "))
    for pair in SPELLINGS:
        old, new = (f" {x.replace(' ', '  ')} " for x in pair)
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.btrim(F.replace(out, F.lit("  "), F.lit(" ")))


def known_digests(spark: SparkSession) -> DataFrame:
    """license, digest of the fixed table."""
    rows = [(name, text) for name, texts in KNOWN.items() for text in texts] + whole_texts()
    rows += [(name, f"{heading}\n\n{text}") for name, text in whole_texts() for heading in HEADINGS.get(name, ())]
    table = spark.createDataFrame(rows, "license string, text string")
    return table.select("license", F.sha2(canonical(F.col("text")).cast("binary"), 256).alias("digest")).distinct()


def find_licenses(docs: DataFrame) -> DataFrame:
    """Matches: key, unit (text, paragraph, line, or passage for a whole licence inside a text), its number from 0, and the licence."""
    low = F.lower("_text")
    marked = keyed(docs).where(low.contains(MARKERS[0]) | low.contains(MARKERS[1])).distinct()

    def parts(kind: str, pieces: Column) -> Column:
        return F.transform(pieces, lambda x, i: F.struct(F.lit(kind).alias("unit"), i.alias("number"), x.alias("raw")))

    units = F.concat(
        parts("text", F.array("_text")), parts("paragraph", F.split("_text", r"\n[ \t\r]*\n")), parts("line", F.split("_text", "\n"))
    )
    cut = marked.select(*KEY, F.explode(units).alias("u")).select(*KEY, "u.unit", "u.number", canonical(F.col("u.raw")).alias("form"))
    digests = cut.where("form != ''").select(*KEY, "unit", "number", F.sha2(F.col("form").cast("binary"), 256).alias("digest"))
    # The known texts are the fixed table above.
    found = digests.join(F.broadcast(known_digests(docs.sparkSession)), "digest").select(*KEY, "unit", "number", "license")
    return found.union(whole_passages(marked).select(*KEY, F.lit("passage").alias("unit"), F.lit(0).alias("number"), "license"))


def known_passages(spark: SparkSession) -> DataFrame:
    """license, first words, number of words and digest of each whole licence."""
    table = spark.createDataFrame(whole_texts(), "license string, text string").select("license", canonical(F.col("text")).alias("form"))
    words = F.split("form", " ")
    return table.select(
        "license", F.array_join(F.slice(words, 1, HEAD), " ").alias("head"), F.size(words).alias("size"),
        F.sha2(F.col("form").cast("binary"), 256).alias("digest"),
    ).distinct()


def whole_passages(marked: DataFrame) -> DataFrame:
    """Key and licence of each whole licence anywhere in a text: where a text has the first words of one, as many words from there on as this licence
    has are digested, and looked up by first words and digest."""
    known = known_passages(marked.sparkSession)
    # One row for each licence.
    heads = sorted({r.head for r in known.select("head").collect()})
    forms = marked.select(*KEY, canonical(F.col("_text")).alias("form")).where(F.col("form").rlike(f"(?:^| )(?:{'|'.join(heads)})(?: |$)"))
    words = forms.select(*KEY, F.split("form", " ").alias("_words"))
    head_at = lambda i: F.array_join(F.slice("_words", i, HEAD), " ")
    places = F.filter(F.sequence(F.lit(1), F.size("_words")), lambda i: F.array_contains(F.array(*map(F.lit, heads)), head_at(i)))
    spots = words.select(*KEY, "_words", F.explode(places).alias("_at")).withColumn("head", head_at(F.col("_at")))
    found = spots.join(F.broadcast(known.select("license", "head", "size", F.col("digest").alias("_known"))), "head")
    run = F.array_join(F.slice("_words", F.col("_at"), F.col("size")), " ")
    return found.where(F.sha2(run.cast("binary"), 256) == F.col("_known")).select(*KEY, "license")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: its licences, and the licence that its whole text is, if any."""
    found = find_licenses(docs).groupBy(*KEY).agg(
        F.array_sort(F.collect_set("license")).alias("licenses"),
        F.max(F.when(F.col("unit") == "text", F.col("license"))).alias("whole_text"),
        F.count_if(F.col("unit") == "line").alias("n_lines"),
    ).withColumnsRenamed({ID: "_fid", HASH: "_ftx"})
    rows = keyed(docs).select(*KEY).distinct()
    on = rows[ID].eqNullSafe(found["_fid"]) & (rows[HASH] == found["_ftx"])
    return rows.join(found, on, "left").select(
        F.col(ID).alias("doc_id"), F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"), "whole_text",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
    )
