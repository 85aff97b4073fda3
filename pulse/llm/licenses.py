"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, twice: once with every line end as a boundary, once with line ends as
spaces except at blank lines (licence texts are often wrapped). A sentence is normalised (lower case, ``licence`` spelled
``license``, everything but letters and digits one space) and mapped to an identifier: that of a known
licence sentence, ``n:X`` for a notice ("licensed under the X License") or an SPDX tag whose name is known,
``copyright``, ``reserved``, or ``unknown`` for a notice whose name is not. The sequence of identifiers is
then matched against ordered rules; a rule's sentences are taken out before the next rule is tried, so
the four sentences of the MIT text are one licence and a BSD text with three clauses is not also one with two.

Only texts that hold one of ``ANCHORS`` (with anything but letters and digits between the words of one, as sentences
are normalised) are cut; every known sentence and notice holds one, so nothing is lost.

Defined results: null and empty texts have no licence ('' and zero counts); repeated rows each get a row; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import ensure_columns

# --- fixed values: sentences of public licence texts, names and rules ------------------------
ANCHORS = ["licen", "copyright", "permission", "warrant", "redistribut", "public domain", "spdx", "rights reserved", "liable",
           "free software", "released under", "distributed under", "available under", "published under", "provided under"]
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-asis": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-asis": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-asis": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "apache-use": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "gpl-free": "This program is free software",
    "gpl-2": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2",
    "gpl-2+": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    "gpl-3+": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl-3+": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl-3+": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-2-cut": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mpl-2-text": "All distribution of Covered Software in Source Code Form, including any Modifications that You create or to which You contribute, must be under the terms of this License",
    "mpl-1-text": "The Source Code version of Covered Code may be distributed only under the terms of this License or a future version of this License released under Section 6.1, and You must include a copy of this License with every copy of the Source Code You distribute",
    "apache-text": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form",
    "gpl-2-text": "The licenses for most software are designed to take away your freedom to share and change it",
    "gpl-2-share": "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users",
    "gpl-3-text": "The GNU General Public License is a free, copyleft license for software and other kinds of works",
    "agpl-3-text": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software",
    "lgpl-2-share": "By contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users",
    "lgpl-2-text": "This license, the Lesser General Public License, applies to some specially designated software packages--typically libraries--of the Free Software Foundation and other authors who decide to use it",
    "lgpl-3-text": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below",
    "gfdl-text": "The purpose of this License is to make a manual, textbook, or other functional and useful document \"free\" in the sense of freedom",
    "cc0-text": "To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's Copyright and Related Rights and associated claims and causes of action, whether now known or unknown (including existing as well as future claims and causes of action), in the Work (i) in all territories worldwide, (ii) for the maximum duration provided by applicable law or treaty (including future time extensions), (iii) in any current or future medium and for any number of copies, and (iv) for any purpose whatsoever, including without limitation commercial, advertising or promotional purposes (the \"Waiver\")",
    "epl-1-title": "Eclipse Public License - v 1.0",
    "epl-2-title": "Eclipse Public License - v 2.0",
    "epl-text": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")",
    "zlib-asis": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    "artistic-1-text": "The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package, while giving the users of the package the right to use and distribute the Package in a more-or-less customary fashion, plus the right to make reasonable modifications",
    "artistic-2-text": "This license establishes the terms under which a given free software Package may be copied, modified, distributed, and/or redistributed",
    "wtfpl-text": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "public": "This work is in the public domain",
    "reserved": "All rights reserved",
}
# Rules in order: licence, identifiers; a trailing ? makes one optional.
RULES = [
    ("MIT", "mit-grant mit-notice? mit-asis? mit-liable?"),
    ("ISC", "isc-grant isc-asis?"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-name bsd-asis?"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary bsd-asis?"),
    ("Apache-2.0", "n:Apache-2.0 apache-use apache-copy? apache-asis? apache-see?"),
    ("Apache-2.0", "apache-text n:Apache-2.0?"),
    # full texts of the GNU family: the notice of their appendix says how to apply them
    ("AGPL-3.0", "agpl-3-text gpl-free? agpl-3+? agpl-terms? either-3+?"),
    ("LGPL-3.0", "lgpl-3-text"),
    ("LGPL-2.1", "gpl-2-text? lgpl-2-share? lgpl-2-text gpl-free? lgpl-2.1+? lgpl-terms? either-2.1+?"),
    ("GPL-3.0", "gpl-3-text gpl-free? gpl-3+? gpl-terms? either-3+?"),
    ("GPL-2.0", "gpl-2-text gpl-2-share gpl-free? gpl-2+? gpl-terms? either-2+?"),
    ("GFDL", "gfdl-text"),
    ("AGPL-3.0-or-later", "gpl-free? agpl-3+"),
    ("LGPL-3.0-or-later", "gpl-free? lgpl-3+"),
    ("GPL-3.0-or-later", "gpl-free? gpl-3+"),
    ("GPL-2.0-or-later", "gpl-free? gpl-2+"),
    ("GPL-2.0-only", "gpl-free? gpl-2"),
    ("MPL-2.0", "mpl-2-text mpl-2? mpl-2-cut?"),
    ("MPL-2.0", "mpl-2"),
    ("MPL-2.0", "mpl-2-cut"),
    ("MPL-1.1", "mpl-1-text"),
    ("CC0-1.0", "cc0-text"),
    ("EPL-1.0", "epl-1-title epl-text"),
    ("EPL-2.0", "epl-2-title epl-text"),
    ("EPL", "epl-text"),
    ("Zlib", "zlib-asis? zlib-liable? zlib-grant"),
    ("BSL-1.0", "bsl-grant"),
    ("Artistic-1.0", "artistic-1-text"),
    ("Artistic-2.0", "artistic-2-text"),
    ("WTFPL", "wtfpl-text"),
    ("0BSD", "0bsd-grant isc-asis?"),
    ("Unlicense", "unlicense"),
    ("Public-Domain", "public"),
]
PLAIN_NAMES = {
    "MIT": ["mit", "expat", "mit expat"], "ISC": ["isc"], "Unlicense": ["unlicense"], "Zlib": ["zlib"], "WTFPL": ["wtfpl"],
    "BSD-2-Clause": ["bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"],
    "BSD-3-Clause": ["bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd"], "BSD": ["bsd"],
    "Apache-1.1": ["apache 1 1", "apache software 1 1"], "Apache-2.0": ["apache 2 0", "apache 2", "apache", "apache software 2 0", "asl 2 0"],
    "MPL-1.1": ["mozilla public 1 1", "mpl 1 1"], "MPL-2.0": ["mozilla public 2 0", "mpl 2 0", "mozilla public", "mpl 2"],
    "EPL-1.0": ["eclipse public 1 0", "epl 1 0"], "EPL-2.0": ["eclipse public 2 0", "epl 2 0"],
    "CDDL-1.0": ["common development and distribution 1 0", "cddl 1 0"], "BSL-1.0": ["boost software 1 0", "bsl 1 0", "boost"],
    "CC0-1.0": ["cc0", "cc0 1 0", "creative commons zero", "creative commons cc0 1 0 universal"],
}
# The published notices of the GNU family, by licence name and version, also as cut at a semicolon; only :func:`scan`
# has them and the patterns below, its SQL form knows the sentences and rules above.
GNU = [("gpl", "GPL", "general public", ("1", "2", "3")), ("lgpl", "LGPL", "lesser general public", ("2", "2.1", "3")),
       ("library", "LGPL", "library general public", ("2",)), ("agpl", "AGPL", "affero general public", ("3",))]
# Sentences with a slot for the holder, on normalised sentences; the last one is the first line of a wrapped clause.
SLOTS = [
    ("bsd-name", r"^neither the names? of .+ n?or the names of (?:[a-z]+ )?(?:other )?contributors may be used to endorse or promote products derived from this software without (?:specific )?prior written permission$"),
    ("bsd-name", r"^(?:the )?names? of .+ may not be used to endorse or promote products derived from this software without (?:specific )?prior written permission$"),
    ("bsd-asis", r"^this software is provided by .+ as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed$"),
    ("bsd-neither", r"^neither the names? of "),
]
# A full stop inside the holder of "neither the name of Google Inc. nor the names of" ends no sentence.
HOLDER_STOP = r"[.!?:]+(?=\s[^;]{0,150}n?or the names? of)(?<=neither\s{1,9}the\s{1,9}names?\s{1,9}of\s[^;]{1,150})"
NOTICE = (r"^(?:(?:this|the|all) [a-z]+ (?:is|are) )?(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?(.+)$")
SPDX = r"^spdx license identifier (.+)$"
BREAK = "\x1e"


def licence_names() -> dict[str, str]:
    """Normalised name -> licence; the GNU and Creative Commons families by rule."""
    names = {a: k for k, v in PLAIN_NAMES.items() for a in v}
    gnu = {"GPL": (["gnu general public", "general public", "gnu gpl", "gpl"], ("1.0", "2.0", "3.0")),
           "LGPL": (["gnu lesser general public", "lesser general public", "gnu lgpl", "lgpl"], ("2.0", "2.1", "3.0")),
           "AGPL": (["gnu affero general public", "affero general public", "gnu agpl", "agpl"], ("3.0",))}
    for short, (spoken, versions) in gnu.items():
        for name in spoken:
            names[name] = short
            for v in versions:
                major, minor = v.split(".")
                for number in [f"{major} {minor}", *([major] if minor == "0" else [])]:
                    for tail, kind in (("", "only"), (" only", "only"), (" or later", "or-later"), (" or any later", "or-later")):
                        names[f"{name} {number}{tail}"] = f"{short}-{v}-{kind}"
    words = {"BY": "attribution", "SA": "sharealike", "NC": "noncommercial", "ND": "noderivatives"}
    for parts in (("BY",), ("BY", "SA"), ("BY", "NC"), ("BY", "ND"), ("BY", "NC", "SA"), ("BY", "NC", "ND")):
        for name in ("cc " + " ".join(parts).lower(), "creative commons " + " ".join(words[p] for p in parts), "creative commons " + " ".join(parts).lower()):
            for v in ("", "1.0", "2.0", "2.5", "3.0", "4.0"):
                names[f"{name} {v.replace('.', ' ')}".strip()] = "CC-" + "-".join(parts) + ("-" + v if v else "")
    return names


def normal(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", text.lower().replace("licence", "license")).strip()


def normal_name(name: str) -> str:
    name = re.sub(r" the license$", "", normal(name))
    name = re.sub(r"\b(?:the|license|licenses|version|international|unported|generic)\b", " ", re.sub(r"\bv(?:ersion)? ?([0-9])", r"\1", name))
    return re.sub(r" +", " ", name).strip()


def rule_pattern(sequence: str) -> str:
    """A rule as a regular expression over ``<id><id>...``."""
    out = ""
    for x in sequence.split():
        one = "<" + re.sub(r"[.+]", lambda m: "\\" + m[0], x.rstrip("?")) + ">"
        out += f"(?:{one})?" if x.endswith("?") else one
    return out


def gnu_notices() -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Normalised sentences of the GNU notices with their identifiers, and the rules for these."""
    known = {f"this {x} is free software": "gpl-free" for x in ("program", "library", "software", "file", "package", "module", "code")}
    rules = []
    for key, short, name, versions in GNU:
        terms = f"you can redistribute it and or modify it under the terms of the gnu {name} license"
        by = "as published by the free software foundation"
        known[f"{terms} {by}"] = f"{key}-terms"
        for v in versions:
            number, full = v.replace(".", " "), v if "." in v else v + ".0"
            for n in dict.fromkeys((number, full.replace(".", " "))):
                for later in (f"either version {n} of the license or at your option any later version", f"either version {n} of the license or any later version"):
                    known[later] = f"either-{v}+"
                    known[f"{terms} {by} {later}"] = f"{key}-{v}+"
                for only in (f"version {n} of the license", f"version {n} of the license only", f"only version {n} of the license"):
                    known[only] = f"version-{v}"
                    known[f"{terms} {by} {only}"] = f"{key}-{v}"
                for one in (f"{terms} {by} version {n}", f"{terms} {by} version {n} only", f"{terms} version {n} {by}", f"{terms} version {n} only {by}",
                            f"you can redistribute it and or modify it under the terms of version {n} of the gnu {name} license {by}"):
                    known[one] = f"{key}-{v}"
            for kind, whole, part in (("or-later", f"{key}-{v}+", f"either-{v}+"), ("only", f"{key}-{v}", f"version-{v}")):
                rules += [(f"{short}-{full}-{kind}", f"gpl-free? {whole}"), (f"{short}-{full}-{kind}", f"gpl-free? {key}-terms {part}")]
    return known, rules


def rule_patterns() -> list[tuple[str, str]]:
    """All rules as patterns; a BSD text with a third clause, even if that is cut by line ends, is not one with two."""
    two = "<bsd-binary>"
    return [(name, rule_pattern(rule).replace(two, two + "(?!<bsd-name>|<bsd-neither>)") if name == "BSD-2-Clause" else rule_pattern(rule))
            for name, rule in [*RULES, *gnu_notices()[1]]]


# The two engines' spellings are built from the same steps: (pattern, replacement).
_LINES = [(r"spdx-license-identifier:", "spdx-license-identifier "), (r"\s*[\r\n]+\s*", BREAK), (r"[.!?;:]+\s+", BREAK)]
_WRAPPED = [(r"spdx-license-identifier:", "spdx-license-identifier "), (r"[\r\n][ \t]*[\r\n]\s*", BREAK), (r"[.!?;:]+\s+", BREAK)]
_NAME = [(r" the license$", ""), (r"\bv(?:ersion)? ?([0-9])", "$1"), (r"\b(?:the|license|licenses|version|international|unported|generic)\b", " "), (r" +", " ")]


def _steps(c: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


def _identifiers(text: Column, steps: list[tuple[str, str]]) -> Column:
    """The identifiers of the sentences of a text (lower case), as one string ``<id><id>...``."""
    sentences = gnu_notices()[0] | {normal(s): k for k, s in SENTENCES.items()}
    known = F.create_map(*[F.lit(x) for s, k in sentences.items() for x in (s, k)])
    names = F.create_map(*[F.lit(x) for k, v in licence_names().items() for x in (k, v)])

    def one(sentence: Column) -> Column:
        x = F.trim(_steps(sentence, [("licence", "license"), ("[^a-z0-9]+", " ")]))
        called = F.concat(F.regexp_extract(x, NOTICE, 1), F.regexp_extract(x, SPDX, 1))
        name = F.element_at(names, F.trim(_steps(called, _NAME)))
        return F.coalesce(F.element_at(known, x), *[F.when(x.rlike(pattern), k) for k, pattern in SLOTS], F.when(called != "", F.when(name.isNotNull(), F.concat(F.lit("n:"), name))
                          .when(called.contains("licen") | x.startswith("spdx"), "unknown")),
                          F.when(x.rlike("^copyright (?:c )?[0-9]"), "copyright"))

    text = F.when(text.rlike(r"neither\s+the\s+name"), F.regexp_replace(text, HOLDER_STOP, "")).otherwise(text)
    parts = F.transform(F.split(_steps(text, steps), BREAK), one)
    out = F.array_join(F.transform(F.filter(parts, lambda i: i.isNotNull()), lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    # these are words of a licence only after one of its sentences
    return F.regexp_replace(out, "(?<!<bsd-binary>)<bsd-neither>|(?<!-terms>)<(?:either|version)-[0-9.]+[+]?>", "")


def _matched(sequence: Column) -> tuple[Column, Column]:
    """(licences found, in rule order and then by notice; identifiers that no rule took). The rules are tried
    only where there are identifiers."""
    some, found, left = sequence != "", [], sequence
    for name, pattern in rule_patterns():
        found.append(F.when(left.rlike(pattern), F.lit(name)))
        left = F.regexp_replace(left, pattern, "")
    notices = F.regexp_extract_all(left, F.lit("<n:([^>]+)>"), 1)
    rest = F.regexp_replace(left, "<n:[^>]+>|<copyright>|<reserved>", "")
    names = F.concat(F.filter(F.array(*found), lambda x: x.isNotNull()), notices)
    return F.when(some, names).otherwise(F.array().cast("array<string>")), F.when(some, rest).otherwise("")


def scan(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_sentences, licenses, n_unmatched): licence sentences met (by the cut that has
    more), the licences of both cuts, comma-separated and sorted, and that cut's identifiers that fit no rule."""
    rows = ensure_columns(docs, {"doc_id": "long", "text": "string"}).withColumn("low", F.lower(F.coalesce("text", F.lit(""))))
    some = F.lit(False)
    for a in ANCHORS:
        if " " not in a:
            some = some | F.col("low").contains(a)
    some = some | F.col("low").rlike("|".join(a.replace(" ", "[^a-z0-9]+") for a in ANCHORS if " " in a))
    rows = rows.select("doc_id", F.when(some, F.col("low")).alias("low"))
    rows = rows.select("doc_id", F.when(F.col("low").isNotNull(), _identifiers(F.col("low"), _LINES)).alias("a"),
                       F.when(F.col("low").isNotNull(), _identifiers(F.col("low"), _WRAPPED)).alias("b"))
    rows = rows.select("doc_id", F.coalesce("a", F.lit("")).alias("a"), F.coalesce("b", F.lit("")).alias("b"))
    (names_a, rest_a), (names_b, rest_b) = _matched(F.col("a")), _matched(F.col("b"))
    number = lambda c: F.length(c) - F.length(F.replace(c, F.lit("<"), F.lit("")))
    rest = F.when(number(F.col("b")) > number(F.col("a")), number(rest_b)).otherwise(number(rest_a))
    return rows.select("doc_id", F.greatest(number(F.col("a")), number(F.col("b"))).cast("long").alias("n_sentences"),
                       F.array_join(F.array_sort(F.array_distinct(F.concat(names_a, names_b))), ",").alias("licenses"),
                       rest.cast("long").alias("n_unmatched"))


# --- the same in DuckDB SQL -----------------------------------------------------------------

def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_steps(x: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        x = f"regexp_replace({x}, {_sql(pattern)}, {_sql(to.replace('$1', chr(92) + '1'))}, 'g')"
    return x


def scan_sql() -> str:
    """DuckDB SQL for :func:`scan` over the table documents."""
    known = "MAP {" + ", ".join(f"{_sql(normal(s))}: {_sql(k)}" for k, s in SENTENCES.items()) + "}"
    names = "MAP {" + ", ".join(f"{_sql(k)}: {_sql(v)}" for k, v in licence_names().items()) + "}"
    any_anchor = " OR ".join(f"contains(low, {_sql(a)})" for a in ANCHORS)
    words = _sql_steps("s", [("licence", "license"), ("[^a-z0-9]+", " ")])
    cut = []
    for tag, steps in (("a", _LINES), ("b", _WRAPPED)):
        cut.append(f"SELECT rid, doc_id, '{tag}' AS cut, unnest(string_split({_sql_steps('low', steps)}, {_sql(BREAK)})) AS s, "
                   f"generate_subscripts(string_split({_sql_steps('low', steps)}, {_sql(BREAK)}), 1) AS i FROM hit")
    rules, seq = [], "seq"
    for name, rule in RULES:
        pattern = rule_pattern(rule)
        rules.append(f"CASE WHEN regexp_matches({seq}, {_sql(pattern)}) THEN {_sql(name)} END")
        seq = f"regexp_replace({seq}, {_sql(pattern)}, '', 'g')"
    count = lambda c: f"length({c}) - length(replace({c}, '<', ''))"
    return f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS low FROM documents),
hit AS (SELECT * FROM base WHERE {any_anchor}),
cut AS ({' UNION ALL '.join(cut)}),
norm AS (SELECT *, trim({words}) AS x FROM cut),
called AS (SELECT *, regexp_extract(x, {_sql(NOTICE)}, 1) || regexp_extract(x, {_sql(SPDX)}, 1) AS called FROM norm),
named AS (SELECT *, {names}[trim({_sql_steps('called', _NAME)})] AS name, {known}[x] AS known FROM called),
ids AS (SELECT rid, cut, i, coalesce(known, CASE WHEN called <> '' THEN CASE WHEN name IS NOT NULL THEN 'n:' || name
          WHEN contains(called, 'licen') OR starts_with(x, 'spdx') THEN 'unknown' END END,
          CASE WHEN regexp_matches(x, '^copyright (?:c )?[0-9]') THEN 'copyright' END) AS id FROM named),
seqs AS (SELECT rid, cut, string_agg('<' || id || '>', '' ORDER BY i) AS seq FROM ids WHERE id IS NOT NULL GROUP BY rid, cut),
found AS (SELECT rid, cut, {count('seq')} AS n, list_filter([{', '.join(rules)}], lambda z: z IS NOT NULL) || regexp_extract_all({seq}, '<n:([^>]+)>', 1) AS names,
          regexp_replace({seq}, '<n:[^>]+>|<copyright>|<reserved>', '', 'g') AS rest FROM seqs),
per AS (SELECT rid, max(n) AS n, list_sort(list_distinct(flatten(list(names)))) AS names, first({count('rest')} ORDER BY n DESC, cut) AS u FROM found GROUP BY rid)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(array_to_string(names, ','), '') AS licenses, coalesce(u, 0)::BIGINT AS n_unmatched
FROM base LEFT JOIN per USING (rid)"""
