"""Licence sentences and rules against a plain version."""
import re

from sensorloom.llm import licenses as lic

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def slow_sequence(text, unwrap):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("licence", "license")
    if unwrap:
        t = t.replace("\n", " ")
    t = re.sub("[.!?:;]+([ \t\n\v\f\r]+|\\Z)", "\n", t.replace("spdx-license-identifier:", "spdx-license-identifier"))
    known = {v: k for k, v in lic.SENTENCES.items()}
    out = []
    plain = re.sub("neither the name of [^\n]{1,120}(?: |\n ?)nor the names of (?:its|their) contributors",
                   "neither the name of the copyright holder nor the names of its contributors", re.sub("[^a-z0-9.\n]+", " ", t))
    plain = re.sub("this product includes software developed by [^\n]{1,120}", "this product includes software developed by the holder", plain)
    for s in plain.split("\n"):
        if s := s.strip(" "):
            out.append(known.get(s) or ("?" if "licen" in s or "copyright" in s else "."))
    return out


def slow(text):
    found, left = set(), []
    for unwrap in (True, False):
        left = lic.tagged(slow_sequence(text, unwrap))
        for name, ids in lic.RULES:
            if lic.tagged(ids) in left:
                found.add(name)
                left = left.replace(lic.tagged(ids), "<.>")
    ids = [x for x in slow_sequence(text, False) if x not in "?."]
    return (ids, [n for n in dict.fromkeys(n for n, _ in lic.RULES) if n in found], len([x for x in re.findall("<(.*?)>", left) if x not in "?."]),
            sum(x == "?" for x in slow_sequence(text, False)))


TEXTS = [None, "", "Nothing here.", APACHE, "Some words.\n" + APACHE.replace("\n", " ") + "\nMore.", "Released under the MIT License.\nAll Rights Reserved!",
         "LICENSED UNDER CC BY-NC 4.0.", "words words\nThis work is licensed under the GNU General Public Licence, version 3.\nwords", "See the licence file. Copyright 2020 me.",
         "# Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
         "Released under the\nMIT License.", "a licence; " * 2000, "Licensed under the MIT License. Licensed under the MIT License. Licensed under CC BY 4.0"]


def test_matches_plain_version(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "y"), (3, TEXTS[3], "z")], "doc_id long, text string, sentences string")
    rows = lic.licenses(df).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert (r.sentences, r.licenses, r.n_unmatched, r.n_unknown) == slow(TEXTS[3 if r.doc_id is None else r.doc_id]), r
    by = {r.doc_id: r.licenses for r in rows}
    assert by[3] == by[4] == ["Apache-2.0"] and by[5] == ["MIT", "all-rights-reserved"] and by[10] == ["MIT"] and by[7] == ["GPL-3.0-only"]
    assert lic.licenses(df.limit(0)).count() == 0


def test_every_sentence_has_a_cue_and_a_rule():
    for s in lic.SENTENCES.values():
        assert any(c in s for c in lic.CUES), s
        assert s == re.sub("[^a-z0-9.]+", " ", s).strip() and "licence" not in s
    used = {x for _, ids in lic.RULES for x in ids}
    assert used <= set(lic.SENTENCES)


GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program"""
GPL2 = GPL.format(";", ";", 2) + "; if not, write to the Free Software\nFoundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA."
GPL3 = GPL.format(":", ",", 3) + ".  If not, see <https://www.gnu.org/licenses/>."
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http{0}://mozilla.org/MPL/2.0/."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_standard_notices(spark):
    texts = {"GPL-2.0-or-later": [GPL2], "GPL-3.0-or-later": [GPL3], "MPL-2.0": [MPL.format(""), MPL.format("s")], "BSD-2-Clause": [BSD2], "BSD-3-Clause": [BSD3]}
    cases = [(name, "Some words.\n" + wrap(t)) for name, ts in texts.items() for t in ts
             for wrap in (str, lambda t: t.replace("\n", " "), lambda t: "# " + t.replace("\n", "\n# "))]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id int, text string")
    got = {r.doc_id: r for r in lic.licenses(df).collect()}
    assert [got[i].licenses for i in range(len(cases))] == [[name] for name, _ in cases]
    assert all(got[i].n_unmatched == 0 for i, (_, t) in enumerate(cases) if t.count("\n") == 1), "notices on one line"


LATER = """This {what} is free software{cut} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{comma} either version {v} of the License, or
(at your option) any later version."""


def test_other_families_and_holders(spark):
    texts = {"LGPL-2.1-or-later": [LATER.format(what="library", cut=";", kind="Lesser ", comma=";", v="2.1")],
             "LGPL-3.0-or-later": [LATER.format(what="library", cut=":", kind="Lesser ", comma=",", v="3")],
             "AGPL-3.0-or-later": [LATER.format(what="program", cut=":", kind="Affero ", comma=c, v="3") for c in ",;"],
             "GPL-2.0-only": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License\n"
                              "version 2 as published by the Free Software Foundation."],
             "BSD-3-Clause": [BSD3.replace("the copyright holder nor the names of its", f"{who} nor the names of {whose}")
                              for who in ("Google Inc.", "the University of Somewhere", "Acme, Ltd.") for whose in ("its", "their")]}
    cases = [(name, "Some words.\n" + wrap(t)) for name, ts in texts.items() for t in ts for wrap in (str, lambda t: t.replace("\n", " "))]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id int, text string")
    got = {r.doc_id: r for r in lic.licenses(df).collect()}
    assert [got[i].licenses for i in range(len(cases))] == [[name] for name, _ in cases]
    for i, (name, t) in enumerate(cases):
        if name == "BSD-3-Clause":
            continue  # the plain version does not take list numbers away
        assert (got[i].sentences, got[i].licenses, got[i].n_unmatched, got[i].n_unknown) == slow(t)


def test_more_families_and_tags(spark):
    bsd4 = BSD2 + """
3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement:
   This product includes software developed by the University of Somewhere.

4. Neither the name of the University nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.
"""
    apache1 = BSD2 + """
3. The end-user documentation included with the redistribution, if any, must
   include the following acknowledgment:
   "This product includes software developed by the Apache Software Foundation (http://www.apache.org/)."
"""
    zlib = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:"""
    epl1 = """This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html"""
    mpl1 = """The contents of this file are subject to the Mozilla Public License Version
1.1 (the "License"); you may not use this file except in compliance with
the License."""
    texts = {"BSD-4-Clause": [bsd4], "Apache-1.1": [apache1], "Zlib": [zlib], "EPL-1.0": [epl1], "MPL-1.1": [mpl1],
             "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)"],
             "ISC": ["Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the "
                     "above\ncopyright notice and this permission notice appear in all copies."],
             "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted."],
             "WTFPL": ["This work is free. You can redistribute it and/or modify it under the\nterms of the Do What The Fuck You Want To Public License, "
                       "Version 2,\nas published by Sam Hocevar."],
             "Artistic-1.0-Perl": ["This library is free software; you can redistribute it and/or modify\nit under the same terms as Perl itself."],
             "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
             "CC-BY-NC-ND-3.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 3.0 Unported License."],
             **{n: [f"/* SPDX-License-Identifier: {n} */\nint x;"] for n in ("MIT", "GPL-2.0-only", "GPL-2.0-or-later", "EPL-2.0", "BSD-3-Clause", "Apache-2.0")}}
    cases = [(n, "Some words.\n" + t) for n, ts in texts.items() for t in ts]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id int, text string")
    got = {r.doc_id: r for r in lic.licenses(df).collect()}
    assert [got[i].licenses for i in range(len(cases))] == [[name] for name, _ in cases]
    for i, (name, t) in enumerate(cases):
        if "\n1. " not in t:  # the plain version does not take list numbers away
            assert (got[i].sentences, got[i].licenses, got[i].n_unmatched, got[i].n_unknown) == slow(t)
    # a tag with a plus is of no known licence, and a name alone is no tag
    odd = spark.createDataFrame([(1, "SPDX-License-Identifier: GPL-2.0+"), (2, "All of MIT. A licence.")], "doc_id int, text string")
    assert all(r.licenses == [] for r in lic.licenses(odd).collect())
