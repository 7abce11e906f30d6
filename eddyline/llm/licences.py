"""Operator 4, licence scan by canonical digest lookup.

A text unit is brought into a canonical form (lower case; copyright lines
dropped; equivalent spellings made one; punctuation and white space runs turned
into one space) and its SHA-256 digest is looked up among the digests of known
licences by a hash join.  Units are the whole document and each of its lines, so
both a licence file and a licence notice inside another text are found; a unit
matches only if the whole unit is the licence.

Every step is a built-in function; a text is never shuffled.  The digests of up
to ``BROADCAST_ROWS`` known licences are broadcast; of more, or of a table of known
licences, Spark's own check of the size decides.

A copyright line begins with ``copyright``, ``(c)`` or ``©`` and names a year, a
sign or a holder; a line of wrapped licence text (``copyright notice and this
...``, ``(c) You must retain ...``) is none.  A line that is only ``All rights
reserved`` is dropped too.  A holder without year, sign or ``by`` is known by its
capital letter.

Nulls: a null text has no units.  A unit that is empty after normalising matches
nothing.  Repeated rows each give their own matches.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as the same word.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "copyright holder": "copyright owner",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "non commercial": "noncommercial",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "per cent": "percent",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sub license": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# Known licences and notices, entire texts.
KNOWN = {
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.\n\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE."),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted.\n\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software.\n\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:\n\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required.\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented "
        "as being the original software.\n"
        "3. This notice may not be removed or altered from any source distribution."),
}

# Titles that the licence texts carry.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)", "0BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License",
                     "The 2-Clause BSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License",
                     "The 3-Clause BSD License", "BSD License"),
}

# Wordings in use besides those above.
WORDINGS = {
    "MIT": (("this permission notice shall", "this permission notice (including the next paragraph) shall"),),
    "ISC": (("modify, and/or distribute", "modify, and distribute"),),
    "0BSD": (("modify, and/or distribute", "modify, and distribute"),),
}

# Licences whose full texts lie in the folder ``texts``.
FULL_TEXTS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-1.0", "GPL-2.0", "GPL-3.0",
              "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0")
END_OF_TERMS = "END OF TERMS AND CONDITIONS"


def known_texts() -> list[tuple[str, str]]:
    """``licence, text``: KNOWN and the full texts, each in the wordings, with the
    titles and without the appendix that files of it have."""
    texts = list(KNOWN.items())
    for name in FULL_TEXTS:
        text = pkgutil.get_data(__package__, f"texts/{name}.txt").decode()
        texts += [(name, text), (name, text.replace("https://", "http://"))]
        if name.startswith("BSD"):
            texts.append((name, re.sub(r"(?m)^[123]\.", "*", text)))
        if END_OF_TERMS in text:
            ends = text[:text.index(END_OF_TERMS)]
            texts += [(name, t) for e in (ends, ends.replace("https://", "http://")) for t in (e, e + END_OF_TERMS)]
    texts += [(n, t.replace(a, b)) for n, t in texts for a, b in WORDINGS.get(n, ())]
    texts += [(n, f"{title}\n\n{t}") for n, t in texts for title in TITLES.get(n, ())]
    return list(dict.fromkeys(texts))


# Fixed values of the SQL: a copyright line (wider than the rule below, and with
# KNOWN alone: the SQL holds where neither makes a difference), and what becomes a space.
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
NOT_WORD = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f©«»‘’‚“”„–—…]+"

# Words that follow "copyright" in the text of a licence, not in a copyright line.
_TEXT = (r"(?!(?i:notices?|licen[cs]\w*|holders?|owners?|ownership|laws?|acts?|treaty|treaties|statements?|interests?|"
         r"permissions?|rights?|protection|office|infringement|claims?|status|information|disclaimers?|works?|"
         r"material|grants?|exceptions?|terms?|directive|convention|and|or|in|on|of|to|is|for|with|the)\b)")
_YEAR = r"\b(?:19|20)\d\d\b"
# A copyright line, before the text becomes lower case.
LINE_OF_COPYRIGHT = (
    r"(?dm)^[ \t]*+(?:(?:©"
    r"|\([cC]\)[ \t,:]*+(?:" + _YEAR + r"|(?i:by)[ \t]|[^\n]*" + _YEAR + r"\.?[ \t\r]*$|\p{Lu}[\p{L}.'’-]*+[ \t]++\p{Lu}\p{Ll})"
    r"|(?:\([cC]\)[ \t]*+)?(?i:copyright)(?:"
    r"[ \t,:]*+(?:\([cC]\)|©|" + _YEAR + r"|[\[{<])"
    r"|(?:[ \t]++(?i:holders?|owners?))?[ \t]*+:[ \t]*+[^\s]"
    r"|[ \t]++(?i:by)[ \t]"
    r"|[ \t]++" + _TEXT + r"[^\n]*" + _YEAR +
    r"|(?<=opyright)[ \t]++(?:[Tt]he[ \t]++)?" + _TEXT + r"\p{Lu}))[^\n]*+"
    r"|(?i:all[ \t]++rights[ \t]++reserved)[ \t]*+[.!]?[ \t\r]*+$)")
# NOT_WORD in the form that runs faster here: single characters.
NOT_WORD_CHARS = "".join(c for c in map(chr, range(0x2100)) if re.fullmatch(NOT_WORD, c) and c != "\n")
BROADCAST_ROWS = 50_000      # known texts whose digests (about 100 bytes each) are broadcast; more are joined by shuffle


def plain_lines(text: Column) -> Column:
    """Copyright lines emptied, lower case, all that is no word one space; line
    breaks are kept."""
    s = F.lower(F.regexp_replace(text, LINE_OF_COPYRIGHT, ""))
    return F.regexp_replace(F.translate(s, NOT_WORD_CHARS, " " * len(NOT_WORD_CHARS)), " {2,}", " ")


def one_line(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(s, F.lit("\n"), F.lit(" ")), " {2,}", " "))


def spelt_otherwise(s: Column) -> Column:
    """Whether a text of plain words holds an equivalent spelling."""
    return F.concat(F.lit(" "), s, F.lit(" ")).rlike(" (" + "|".join(EQUIVALENT) + ") ")


def respelt(s: Column) -> Column:
    """Equivalent spellings made one."""
    out = F.concat(F.lit(" "), s, F.lit(" "))
    for spelt, as_ in EQUIVALENT.items():
        out = F.replace(out, F.lit(f" {spelt} "), F.lit(f" {as_} "))
    return F.trim(out)


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    return respelt(one_line(plain_lines(text)))


def known_digests(spark: SparkSession, known: Mapping[str, str] | Iterable[tuple[str, str]] | DataFrame) -> DataFrame:
    """``digest, licence``: one row per digest (the first name in order)."""
    if not isinstance(known, DataFrame):
        pairs = known.items() if isinstance(known, Mapping) else known
        known = spark.createDataFrame(list(pairs), "licence string, text string")
    c = canonical(F.col("text"))
    return known.where(c != "").groupBy(F.sha2(c, 256).alias("digest")).agg(F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known: Mapping[str, str] | DataFrame | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, unit, digest, licence`` per matching unit; unit 0 is the whole
    text, unit ``n`` its ``n``-th line (of a text of several lines).  Without
    ``known`` the texts of :func:`known_texts` are looked up."""
    known = known_texts() if known is None else known
    # A text is made plain once; its lines and the whole are both cut from that.
    plain = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), plain_lines(F.col(f"`{text_col}`")).alias("plain"))
             .select("doc_id", "plain", one_line(F.col("plain")).alias("whole"))
             .withColumn("otherwise", spelt_otherwise(F.col("whole"))))
    lines = F.split(F.col("plain"), "\n")
    units = F.concat(F.array("whole"), F.when(F.size(lines) > 1, lines).otherwise(F.array().cast("array<string>")))
    # No digest is null, so no filter on it repeats the work below.
    d = (plain.select("doc_id", "otherwise", F.posexplode(units).alias("unit", "text"))
         .select("doc_id", "otherwise", F.col("unit").cast("bigint").alias("unit"), F.trim("text").alias("text"))
         .select("doc_id", "unit", F.coalesce(F.sha2(
             F.when(F.col("otherwise"), respelt(F.col("text"))).otherwise(F.col("text")), 256),
             F.lit("")).alias("digest")))
    digests = known_digests(docs.sparkSession, known)
    if not isinstance(known, DataFrame) and len(known) <= BROADCAST_ROWS:
        digests = F.broadcast(digests)
    return d.join(digests, "digest").select("doc_id", "unit", "digest", "licence")
