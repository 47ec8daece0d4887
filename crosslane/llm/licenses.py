"""Licence scan by canonical digests, in DataFrame functions only.

A text is canonical in lower case, without lines that are copyright notices and without punctuation, with one
spelling of equivalent words and single spaces. A line of a licence's own sentences that wraps at the word 'copyright'
stays. Its SHA-256 is joined with the digests of known licences (whole
texts) and of known licence notices (single lines of a text).
"""

from __future__ import annotations

from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import spread

# Equivalent words of the public licence matching guidelines.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("licencing", "licensing"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"), ("centre", "center"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"), ("noncommercial", "non commercial"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("sublicence", "sublicense"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TOP = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
#: Whole texts by licence id. More can be given to ``scan``.
LICENSES = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_REST}"),
    ("ISC", f"ISC License\n\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_REST}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_REST}"),
    ("BSD-2-Clause", _BSD_TOP + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_TOP + _BSD_END),
    ("BSD-3-Clause", _BSD_TOP + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_TOP + _BSD_THIRD + _BSD_END),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org>"),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <http://unlicense.org/>"),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
)


def _shipped() -> tuple[tuple[str, str], ...]:
    """Texts of license_texts (file name: licence id), each also without what follows its terms, with links of either scheme."""
    found = []
    for f in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name):
        text, end = f.read_text("utf-8"), "END OF TERMS AND CONDITIONS"
        for t in (text, text[: text.find(end) + len(end)]) if end in text else (text,):
            found += [(f.name.removesuffix(".txt"), x) for x in dict.fromkeys((t, t.replace("https://", "http://"), t.replace("http://", "https://")))]
    return tuple(found)


@cache
def whole_texts() -> tuple[tuple[str, str], ...]:
    """All known whole texts: LICENSES and the data files, which only a driver that scans reads."""
    return LICENSES + _shipped()


#: Single lines that state a licence.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words after 'copyright' in a licence's own sentences, and those between names in a line of names.
_BODY = (
    "notices?|lines?|holders?|owners?|ownership|licen[cs]\\w*|laws?|legal|interests?|rights?|permissions?|disclaim\\w*|statements?|protect\\w*|acts?|treat(?:y|ies)|claims?|works?|materials?"
    "|infring\\w*|legislation|regist\\w*|information|terms?|grant\\w*|and|or|on|in|is|are|was|be|to|for|as|of|if|not|with|which|that|also|like|under|from|may|shall|must|will|can|has|have"
)
_BETWEEN = "and|of|the|its|by|for|at|other|others|authors?|contributors|affiliates|all|rights|reserved"
# A line is a notice if the word or sign starts it and a sign, a number, a placeholder or a name follows. A lone '(c)' is
# also how a list counts: without a year in its line, only two names or more may follow it, not all in capitals.
_AFTER = "[^A-Za-z0-9\\n]*?(?:\\(c\\)|©|&copy|[0-9]|[\\[<{$%]|\\(?(?:years?|y{2,4}|x{4})\\b)"
_COPYRIGHT = (
    "(^|\\n)[^A-Za-z0-9\\n]*(?:©|&copy;"
    f"|(?i:copyright(?:s|ed)?\\b{_AFTER})"
    f"|(?i:copyright)\\b[^A-Za-z0-9.;\"\\n\\x{{80}}-\\x{{10FFFF}}]*(?:(?i:by)[^A-Za-z0-9\\n]+)?(?!(?i:{_BODY})\\b)[A-Z\\x{{80}}-\\x{{10FFFF}}]"
    f"|(?i:\\(c\\))(?i:[^A-Za-z0-9\\n]*copyright\\b{_AFTER}|{_AFTER}|[^\\n]*\\b(?:19|20)[0-9]{{2}}\\b"
    f"|(?-i:(?=[^\\n]*[A-Z][^\\n]*[a-z])[^A-Za-z0-9\\n]*[A-Z\\x{{80}}-\\x{{10FFFF}}][^\\s]*(?:[ \\t]+(?:[^a-z\\s][^\\s]*|(?i:{_BETWEEN})[,.;]*(?=\\s|$)))+[ \\t\\r]*(?=\\n|$)))"
    ")[^\\n]*"
)
_WORDLESS = "[^a-z0-9\u0080-\U0010ffff]+"


def canonical(text: Column) -> Column:
    """Null as empty. Letters other than ASCII stay as they are."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), _COPYRIGHT, "\n")
    out = F.translate(out, _UPPER, _LOWER)
    # Two spaces between words, so that each has its own on either side and neighbours are replaced alike.
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, _WORDLESS, "  ")), F.lit(" "))
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(F.replace(out, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, texts: tuple[tuple[str, str], ...]) -> DataFrame:
    """(license_id, sha) of known texts, one row for each digest; a few hundred bytes for each text."""
    made = spark.createDataFrame(list(texts), "license_id string, text string")
    return made.select("license_id", digest(F.col("text")).alias("sha")).groupBy("sha").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", licenses: tuple | None = None, notices: tuple = NOTICES) -> DataFrame:
    """Per row of ``docs``: the id, canonical_sha256 and canonical_chars of its whole text, license_id (of the licence
    that it is; else null) and notice_ids (licences that single lines state, sorted, comma-joined; else empty).

    Null and empty texts have the digest of no bytes and match nothing. Lines are told apart by line feeds.
    Known digests are a parameter of this job: texts join them by broadcast, lines look them up in a map; no row
    of ``docs`` is shuffled.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    clean = canonical(text)
    whole = known(spark, whole_texts() if licenses is None else licenses).withColumnRenamed("license_id", "_license").withColumnRenamed("sha", "_sha")
    marks = F.create_map(*[F.lit(x) for r in known(spark, notices).collect() for x in (r["sha"], r["license_id"])]).cast("map<string,string>")
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    # Where every notice has this word in it, a line without it needs no digest.
    worded = all("licens" in t.lower() for _, t in notices)
    stated = F.filter(lines, lambda x: x.rlike("(?i)licen[cs]")) if worded else lines
    return (
        docs.select(F.col(id_col), F.sha2(clean, 256).alias("canonical_sha256"), F.char_length(clean).cast("long").alias("canonical_chars"), F.transform(stated, digest).alias("_shas"))
        .join(F.broadcast(whole), F.col("canonical_sha256") == F.col("_sha"), "left")
        .select(
            id_col, "canonical_sha256", "canonical_chars", F.col("_license").alias("license_id"),
            F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform("_shas", lambda s: F.try_element_at(marks, s)), lambda x: x.isNotNull()))), ",").alias("notice_ids"),
        )
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


_START, _NAME = r"^[^A-Za-z0-9\n]*", r"[A-Z\x{80}-\x{10FFFF}]"
_WORD, _BY = rf"{_START}(?i:copyright)\b[^A-Za-z0-9.;\"\n\x{{80}}-\x{{10FFFF}}]*", r"(?i:by)[^A-Za-z0-9\n]+"
_SIGN = rf"{_START}(?i:\(c\))"


def _sql_notice(line: str) -> str:
    """Whether a line is a copyright notice, as _COPYRIGHT has it, in patterns without a look ahead."""
    has = lambda *parts: f"regexp_matches({line}, '{''.join(parts)}')"
    names = rf"(?:[ \t]+(?:[^a-z\s][^\s]*|(?i:{_BETWEEN})[,.;]*))+[ \t\r]*$"
    any_of = [
        has(_START, "(?:©|&copy;)"), has(_START, rf"(?i:copyright(?:s|ed)?\b{_AFTER})"), has(_SIGN, rf"(?i:[^A-Za-z0-9\n]*copyright\b{_AFTER}|{_AFTER}|[^\n]*\b(?:19|20)[0-9]{{2}}\b)"),
        f"({has(_WORD, _NAME)} AND NOT {has(_WORD, rf'(?i:{_BODY})', r'\b')})", has(_WORD, _BY, r"[\x{80}-\x{10FFFF}]"), f"({has(_WORD, _BY, '[A-Z]')} AND NOT {has(_WORD, _BY, rf'(?i:{_BODY})', r'\b')})",
        f"({has(_SIGN, r'[^\n]*[A-Z][^\n]*[a-z]')} AND {has(_SIGN, r'[^A-Za-z0-9\n]*', _NAME, r'[^\s]*', names)})",
    ]
    return "(" + " OR ".join(any_of) + ")"


def _sql_canonical(x: str) -> str:
    """Lines that may be a notice are looked at one by one; a text without the words and signs of one has none."""
    lines = f"array_to_string(list_transform(string_split({x}, chr(10)), lambda line: CASE WHEN {_sql_notice('line')} THEN '' ELSE line END), chr(10))"
    out = rf"CASE WHEN regexp_matches({x}, '(?i:copyright|\(c\)|©|&copy;)') THEN {lines} ELSE coalesce({x}, '') END"
    out = f"translate({out}, '{_UPPER}', '{_LOWER}')"
    out = f"' ' || trim(regexp_replace({out}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', '  ', 'g')) || ' '"
    for other, one in SPELLINGS:
        out = f"replace({out}, ' {other} ', ' {one} ')"
    return f"trim(replace({out}, '  ', ' '))"


def _sql_rows(texts: tuple[tuple[str, str], ...]) -> str:
    return ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in texts)


def oracle() -> str:
    return f"""
WITH l AS (SELECT sha256({_sql_canonical("t")}) AS sha, min(i) AS license_id FROM (VALUES {_sql_rows(whole_texts())}) v(i, t) GROUP BY 1),
n AS (SELECT sha256({_sql_canonical("t")}) AS sha, min(i) AS license_id FROM (VALUES {_sql_rows(NOTICES)}) v(i, t) GROUP BY 1),
d AS (SELECT doc_id, {_sql_canonical("text")} AS c FROM documents),
s AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
m AS (SELECT s.doc_id, string_agg(DISTINCT n.license_id, ',' ORDER BY n.license_id) AS ids
      FROM s JOIN n ON sha256({_sql_canonical("s.line")}) = n.sha GROUP BY s.doc_id)
SELECT d.doc_id, sha256(d.c) AS canonical_sha256, CAST(length(d.c) AS BIGINT) AS canonical_chars, l.license_id, coalesce(m.ids, '') AS notice_ids
FROM d LEFT JOIN l ON sha256(d.c) = l.sha LEFT JOIN m USING (doc_id)
"""


ORACLE = {"op4_license_scan": oracle}
QUERIES = {"op4_license_scan": op4_license_scan}
