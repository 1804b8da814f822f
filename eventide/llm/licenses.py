"""License scans by canonical digest.

A text is brought to a canonical form (lower case, no copyright notices,
equivalent spellings unified, punctuation and white space as single spaces) and the SHA-256
of that form is looked up among the digests of known licence texts with a hash join.  Every
line of a text is looked up in the same way among one-line licence notices.

The known texts are the short licences below with their usual titles and wordings, and the whole
texts in ``license_texts``, also without the appendix after their terms.  A text with another
wording, or with names of its own inside a sentence, has no licence here.

A copyright notice is removed with its line if that is short, else up to the terms or the sentence end after it, or alone;
a text that is nothing but a notice keeps it, so only texts without words have the empty form.

DataFrame functions only.  The known digests are these fixed lists (a broadcast of that size); of two licences with one
canonical text the first by name is given.
Null and empty texts have the digest of the empty text and no licence; repeated rows give repeated results; very long texts
are taken whole; an empty table gives no rows; extra columns of any name are ignored.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

# Words of equal meaning in licence texts, and what they are written as here.
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sublicence", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("https", "http"),
]
# A copyright notice: the word or sign, and a year soon after.  Without a year the sign must follow the word:
# wrapped sentences can begin with "copyright" or "(c)".
_NOTICE = (r"(?:(?:copyright|\(c\)|©)[^\n]{0,200}?(?:[0-9]{4}|year|yyyy)|copyright[ \t]*(?:\(c\)|©)|©)")
_START = r"^[^\p{L}\p{N}\n]*"
# How the terms begin that may follow a notice in the same line.
_OPENINGS = ["permission is hereby granted", "permission to use", "redistribution and use", "this software is provided",
             "licensed under", "released under", "distributed under"]
#: (pattern, number of the groups that stay): a notice up to the terms after it; a whole line of notice length; in longer
#: lines the sentence, or else just the notice.
_REMOVED = [
    (rf"({_START}(?:[^\n]{{0,60}}?[^\p{{L}}\p{{N}}\n])??){_NOTICE}[^\n]{{0,120}}?\b({'|'.join(_OPENINGS)})", 2),
    (rf"{_START}{_NOTICE}[^\n]{{0,200}}(\n|\z)", 1),
    (rf"{_START}{_NOTICE}[^\n]{{0,80}}?\.[ \t]", 0),
    (rf"{_START}{_NOTICE}", 0),
    (rf"{_START}all rights reserved[^\p{{L}}\p{{N}}\n]*(\n|\z)", 1),
]
_OTHER, _OTHER_IN_LINE = r"[^\p{L}\p{N}]+", r"[^\p{L}\p{N}\n]+"

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Texts of public licences (their copyright lines are left out by the canonical form).
_BASE = [
    ("MIT", f"""MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{_WARRANTY} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", f"""ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

{_ISC_WARRANTY}"""),
    ("0BSD", f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

{_ISC_WARRANTY}"""),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_TWO}{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_TWO}{_BSD_THIRD}{_BSD_WARRANTY}"),
    ("Zlib", """zlib License

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
]
_TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT", "MIT Licensed", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC", "ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "0BSD", "BSD 0-Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "BSD License",
                     "The BSD License", "Simplified BSD License", 'BSD 2-Clause "Simplified" License', "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "BSD License",
                     "The BSD License", "New BSD License", "Modified BSD License", 'BSD 3-Clause "New" or "Revised" License'],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"],
}
#: Other usual wordings: (licence, what is replaced, by what).
_WORDINGS = [
    ("ISC", "copy, modify, and/or distribute", "copy, modify, and distribute"),
    ("BSD", "SHALL THE COPYRIGHT HOLDER OR", "SHALL THE COPYRIGHT OWNER OR"),
    ("BSD", "name of the copyright holder nor", "names of the copyright holders nor"),
    ("BSD", "\n1. ", "\n* "),
    ("Zlib", "\n1. ", "\n* "),
]


def _wordings(name: str, text: str) -> list[str]:
    """The text under every usual title and without one, in every combination of the usual wordings."""
    title = text.split("\n", 1)[0]
    found = [text.split("\n", 1)[1] if title in _TITLES[name] else text]
    for start, old, new in _WORDINGS:
        if name.startswith(start) and old in found[0]:
            both = [(old, new)] if not old.startswith("\n") else [(f"\n{n}. ", new) for n in (1, 2, 3)]
            found += [reduce(lambda t, w: t.replace(*w), both, f"\n{f}")[1:] for f in found]
    return [head + f for f in found for head in ["", *(t + "\n" for t in _TITLES[name] if t != title), f"{title}\n"]
            if head != f"{title}\n" or title in _TITLES[name]]


def _whole() -> list[tuple[str, str]]:
    """(licence, text) of the files, whole and up to the end of their terms."""
    found = []
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = path.read_text("utf-8")
        end = text.find("END OF TERMS AND CONDITIONS")
        found += [(path.stem, text)] + ([(path.stem, text[:end]), (path.stem, text[:end] + "END OF TERMS AND CONDITIONS")]
                                        if end > 0 else [])
    if not found:
        raise FileNotFoundError("the folder license_texts is not beside this module")
    return found


LICENSES = _whole() + [(name, t) for name, text in _BASE for t in _wordings(name, text)]
_NAMES = {
    "MIT": ["MIT License", "MIT", "Expat License"], "ISC": ["ISC License"], "0BSD": ["Zero-Clause BSD License", "0BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "Zlib": ["zlib License"], "Unlicense": ["Unlicense"], "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0"],
}
for _id, _long, _short, _versions in [("GPL", "GNU General Public License", "GPL", ("1.0", "2.0", "3.0")),
                                      ("LGPL", "GNU Lesser General Public License", "LGPL", ("2.1", "3.0")),
                                      ("LGPL", "GNU Library General Public License", "LGPL", ("2.0",)),
                                      ("AGPL", "GNU Affero General Public License", "AGPL", ("3.0",)),
                                      ("GFDL", "GNU Free Documentation License", "GFDL", ("1.2", "1.3")),
                                      ("MPL", "Mozilla Public License", "MPL", ("1.1", "2.0"))]:
    for _v in _versions:
        for _w in sorted({_v, _v.removesuffix(".0")}):
            _NAMES.setdefault(f"{_id}-{_v}", []).extend(
                [f"{_long}, version {_w}", f"{_long} v{_w}", f"{_long} {_w}", f"{_short} v{_w}", f"{_short}v{_w}", f"{_short} {_w}"])
            _NAMES.setdefault(f"{_id}-{_v}-or-later", []).extend(
                [f"{_long}, version {_w} or later", f"{_long}, version {_w} or any later version", f"{_short}v{_w} or later"])
for _part, _words in [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                      ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]:
    for _v, _kind in [("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]:
        _NAMES[f"CC-{_part}-{_v}"] = [f"CC {_part} {_v}", f"CC {_part} {_v} License"] + [
            f"Creative Commons {_words} {_v}{x}" for x in ("", " License", f" {_kind}", f" {_kind} License")]
_SENTENCES = [f"{start} under {the}{{}}" for start in (
    "Released", "Licensed", "Distributed", "Available", "This work is licensed", "This project is licensed",
    "This software is licensed", "This software is released") for the in ("", "the ")] + ["License: {}"]

# One-line notices.
_NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
]
NOTICES = _NOTICES + [(name, sentence.format(n)) for name, names in _NAMES.items() for n in names for sentence in _SENTENCES] + [
    (name, f"SPDX-License-Identifier: {name}{x}") for name in _NAMES if not name.endswith("-or-later")
    for x in ([""] if "GPL" not in name and "GFDL" not in name else ["", "-only"])] + [
    (name, f"SPDX-License-Identifier: {name}") for name in _NAMES if name.endswith("-or-later") and "MPL" not in name]


def with_canonical(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the canonical form as __form, and with line ends kept as __lines.

    Every step is a projection of its own, so a form used twice is computed once;
    the rarer replacements run only on texts that need them.
    """
    t = F.col("__t")
    steps = [F.lower(F.coalesce(F.col(text), F.lit(""))),
             F.when(reduce(Column.__or__, [t.contains(x) for x in ("copyright", "(c)", "©", "all rights reserved")]),
                    reduce(lambda c, r: F.regexp_replace(c, "(?dm)" + r[0], " ".join(["", *[f"${i}" for i in range(1, r[1] + 1)]]) or " "),
                           _REMOVED, t)).otherwise(F.lit(None)),
             F.when(t.rlike(r"[\p{L}\p{N}]"), t).otherwise(F.col("__whole")),
             F.regexp_replace(t, _OTHER_IN_LINE, " "),
             F.when(F.arrays_overlap(F.split(F.translate(t, "\n", " "), " "), F.array(*[F.lit(a) for a, _ in EQUIVALENT])),
                    reduce(lambda c, w: F.regexp_replace(c, rf"\b{w[0]}\b", w[1]), EQUIVALENT, t)).otherwise(t)]
    for i, step in enumerate(steps):
        rows = rows.withColumn("__t", step)
        if i == 0:
            rows = rows.withColumn("__whole", t)
    return (rows.drop("__whole").withColumn("__form", F.trim(F.regexp_replace(t, "[ \n]+", " ")))
            .withColumnRenamed("__t", "__lines"))


def known(spark, texts) -> DataFrame:
    """(digest, license, first two words), one row per digest."""
    rows = with_canonical(spark.createDataFrame(texts, "license string, text string"), "text")
    return rows.groupBy(F.sha2("__form", 256).alias("digest")).agg(
        F.min("license").alias("license"), F.min(F.substring_index("__form", " ", 2)).alias("first"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", licenses=None, notices=None) -> DataFrame:
    """Per row: doc_id, digest, license (whole text), notices (comma-joined, of its lines), n_words."""
    spark = docs.sparkSession
    rows = with_canonical(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text")
    lines = known(spark, notices or NOTICES).collect()
    table = F.map_from_arrays(*[F.split(F.lit("\n".join(r[c] for r in lines)), "\n") for c in ("digest", "license")])
    # Only lines that begin as a notice does are looked up.
    firsts = sorted({r["first"] for r in lines})
    likely = F.filter(F.transform(F.split("__lines", "\n"), lambda s: F.trim(s)), lambda s: F.substring_index(s, " ", 2).isin(firsts))
    of_line = F.transform(likely, lambda s: F.try_element_at(table, F.sha2(s, 256)))
    found = F.array_sort(F.array_distinct(F.filter(of_line, lambda x: x.isNotNull())))
    form = F.col("__form")
    words = F.when(form == "", F.lit(0)).otherwise(F.length(form) - F.length(F.replace(form, F.lit(" "), F.lit(""))) + 1)
    rows = rows.select("doc_id", F.sha2(form, 256).alias("digest"), words.cast("long").alias("n_words"), found.alias("found"))
    return (rows.join(F.broadcast(known(spark, licenses or LICENSES).drop("first")), "digest", "left")
            .select("doc_id", "digest", "license",
                    F.when(F.size("found") > 0, F.array_join("found", ",")).alias("notices"), "n_words"))
