import os
import sys

from conftest_llm import SF, with_clashes
from pulse.llm import licenses as L
from pulse.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

S = L.SENTENCES
MIT = ("MIT License\n\nCopyright (c) 2020 X\n\n" + S["mit-grant"].replace("copy of", "copy\nof") + ":\n\n" + S["mit-notice"] + ".\n\n"
       + S["mit-asis"] + ". " + S["mit-liable"] + ".")
BSD3 = f"{S['bsd-grant']}:\n1. {S['bsd-source']}.\n2. {S['bsd-binary']}.\n3. {S['bsd-name']}.\n{S['bsd-asis']}."
BSD2 = f"{S['bsd-grant']}:\n* {S['bsd-source']}.\n* {S['bsd-binary']}.\n{S['bsd-asis']}."
CASES = [
    (MIT, "MIT", 0), (BSD3, "BSD-3-Clause", 0), (BSD2, "BSD-2-Clause", 0), (MIT + "\n" + BSD2, "BSD-2-Clause,MIT", 0),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\n"
     "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n", "Apache-2.0", 0),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
     "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.", "GPL-3.0-or-later", 0),
    ("# SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1-only", 0), ("# SPDX-License-Identifier: Own-1.0", "", 1), ("# SPDX-License-Identifier: MIT", "MIT", 0), ("Released under the MIT License.", "MIT", 0),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", 0), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 0),
    ("This work is licenced under a strange Foo Licence.", "", 1), ("released under pressure", "", 0), ("All rights reserved.", "", 0), ("words of no licence", "", 0),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "", 1),
    ("2. Waiver. " + S["cc0-text"] + ".", "CC0-1.0", 0), (S["zlib-asis"] + ". " + S["zlib-liable"] + ".\n" + S["zlib-grant"] + ": 1", "Zlib", 0),
    ("3.1. " + S["mpl-2-text"] + ". " + S["mpl-2"] + ". If", "MPL-2.0", 0), ("Eclipse Public License - v 1.0\n" + S["epl-text"] + ".", "EPL-1.0", 0),
    ("It is provided under the CC BY-SA 3.0 Unported license!", "", 0), (None, "", 0), ("", "", 0), ("x " * 60000 + "\nReleased under the ISC license.", "ISC", 0),
]


def test_anchors_cover_all_sentences():
    for s in [*S.values(), "licensed under the x", "released under x", "distributed under x", "available under x", "published under x", "provided under x", "spdx-license-identifier: x"]:
        assert any(a in s.lower() for a in L.ANCHORS), s


def test_cases(frame):
    rows = [(i, c[0]) for i, c in enumerate(CASES)] + [(0, CASES[0][0]), (None, CASES[0][0])]
    got = L.scan(with_clashes(frame(rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        text, licences, unmatched = CASES[r["doc_id"] or 0]
        assert (r["licenses"], r["n_unmatched"]) == (licences, unmatched), text
    assert L.scan(frame([])).collect() == []


GPL2 = """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
LGPL21 = """    This library is free software; you can redistribute it and/or
    modify it under the terms of the GNU Lesser General Public
    License as published by the Free Software Foundation; either
    version 2.1 of the License, or (at your option) any later version.
"""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

   * Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
   * Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the
distribution.
"""
GOOGLE = BSD_HEAD + """   * Neither the name of Google Inc. nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""


def test_published_notices(frame):
    own = BSD3.replace("the copyright holder nor", "St. Example Ltd. nor")
    cases = [(GPL2, "GPL-2.0-or-later"), (GPL2.replace("2 of", "3 of"), "GPL-3.0-or-later"), (LGPL21, "LGPL-2.1-or-later"),
             (LGPL21.replace("Lesser", "Library").replace("2.1", "2"), "LGPL-2.0-or-later"), (LGPL21.replace("Foundation; either", "Foundation, either"), "LGPL-2.1-or-later"),
             (LGPL21.replace("either\n    ", "").replace(", or (at your option) any later version", ""), "LGPL-2.1-only"),
             ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
              "the Free Software Foundation, version 3.", "GPL-3.0-only"),
             (GOOGLE, "BSD-3-Clause"), (BSD_HEAD, "BSD-2-Clause"), (own, "BSD-3-Clause"), (BSD3.replace("nor the names", "nor\nthe names"), "BSD-3-Clause"),
             ("Copyright\nNeither the name of a king. Version 2 of the license. Either version 2 of the license, or any later version.", "")]
    got = {r["doc_id"]: r for r in L.scan(frame([(i, c[0]) for i, c in enumerate(cases)])).collect()}
    assert [got[i]["licenses"] for i in range(len(cases))] == [c[1] for c in cases]
    assert all(r["n_unmatched"] == 0 for i, r in got.items() if i != 10)


def wrapped(text, width=70):
    import textwrap
    return "\n".join(textwrap.wrap(text, width))


def test_full_texts(frame):
    """What tells the published texts, in the surroundings and the wrapping they have there; an appendix on how to
    apply a licence is not a notice of its own."""
    gpl3 = GPL2.replace("software;", "software:").replace("Foundation; either version 2", "Foundation, either version 3")
    cases = [
        ("Apache License\nVersion 2.0, January 2004\n\n2. Grant of Copyright License. " + wrapped(S["apache-text"] + ".") + "\n\n3. Grant of Patent License.", "Apache-2.0"),
        ("Preamble\n\n  " + wrapped(S["gpl-2-text"] + ".  " + S["gpl-2-share"] + ".") + "\n\nHow to Apply These Terms to Your New Programs\n\n" + GPL2, "GPL-2.0"),
        ("Preamble\n\n  " + wrapped(S["gpl-3-text"] + ".") + "\n\nHow to Apply These Terms\n\n" + gpl3, "GPL-3.0"),
        ("Preamble\n\n  " + wrapped(S["agpl-3-text"] + ".") + "\n\n" + gpl3.replace("General", "Affero General"), "AGPL-3.0"),
        ("Preamble\n\n  " + wrapped(S["gpl-2-text"] + ".  " + S["lgpl-2-share"] + ".") + "\n\n  " + wrapped(S["lgpl-2-text"] + ".") + "\n\n" + LGPL21, "LGPL-2.1"),
        ("  " + wrapped(S["lgpl-3-text"] + ".") + "\n", "LGPL-3.0"),
        ("3.1. Distribution of Source Form\n\n" + wrapped(S["mpl-2-text"] + ". You must inform recipients.") + "\n\nExhibit A\n\n  This Source Code Form is subject to the terms of the Mozilla\n"
         "  Public License, v. 2.0. If a copy of the MPL was not distributed with this\n  file, You can obtain one.", "MPL-2.0"),
        ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. */".replace(" * ", "   ").replace("/* ", ""), "MPL-2.0"),
        ("2. Waiver. " + wrapped(S["cc0-text"] + ".") + "\n", "CC0-1.0"),
        ("Eclipse Public License - v 2.0\n\n    " + wrapped(S["epl-text"] + ". ANY USE") + "\n", "EPL-2.0"),
        ("zlib License\n\n" + wrapped(S["zlib-asis"] + ". " + S["zlib-liable"] + ".") + "\n\n" + wrapped(S["zlib-grant"] + ":") + "\n\n1. The origin", "Zlib"),
        ("Boost Software License\n\n" + wrapped(S["bsl-grant"] + ":") + "\n\nThe copyright notices", "BSL-1.0"),
        ("Preamble\n\n" + wrapped(S["artistic-2-text"] + ".") + "\n", "Artistic-2.0"), (wrapped(S["0bsd-grant"] + ".") + "\n", "0BSD"),
        (wrapped(S["gfdl-text"] + ": to assure everyone the effective freedom."), "GFDL"), (GPL2, "GPL-2.0-or-later"),
    ]
    got = {r["doc_id"]: r["licenses"] for r in L.scan(frame([(i, c[0]) for i, c in enumerate(cases)])).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1] for c in cases]


def test_anchors_across_line_ends(frame):
    cases = [("This work is in the public\ndomain.", "Public-Domain"), ("Released\nunder the GNU GPL 3.0", "GPL-3.0-only"), ("x\n\n# Distributed \n# under  MIT.", "MIT"),
             ("available  under ISC", "ISC"), ("in the public eye, a domain", "")]
    got = {r["doc_id"]: r["licenses"] for r in L.scan(frame([(i, c[0]) for i, c in enumerate(cases)])).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1] for c in cases]


def test_cases_in_sql(frame):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, c[0]) for i, c in enumerate(CASES)])
    want = sorted(con.execute(L.scan_sql()).fetchall())
    got = sorted(tuple(r) for r in L.scan(frame([(i, c[0]) for i, c in enumerate(CASES)])).collect())
    assert got == want


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op9_license_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query(spark):
    from oracle_check import compare, duck
    ok, said = compare(spark, SF, "op9_license_rules", QUERIES["op9_license_rules"], ORACLE_SQL["op9_license_rules"], duck(SF))
    assert ok, said
