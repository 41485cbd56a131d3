"""Licence recognition by sentences and ordered rules (operator 3), in DataFrame functions only.

A text is cut into sentences, each is normalised and looked up in a fixed table
of licence sentences.  The identifiers in order of appearance form a string in
which the rules are tried one after the other; what a rule matches is used up.
Everything happens inside the row: no shuffle, whatever the skew.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.sources.tables import table

# Normalised sentences of public licence notices.
SENTENCES = {
    "ApacheShort": "licensed under the apache license version 2.0",
    "ApacheYou": "licensed under the apache license version 2.0 the license",
    "ApacheUse": "you may not use this file except in compliance with the license",
    "ApacheCopy": "you may obtain a copy of the license at",
    "ApacheUrl": "http www.apache.org licenses license 2.0",
    "ApacheAsIs": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
                  "without warranties or conditions of any kind either express or implied",
    "ApacheSee": "see the license for the specific language governing permissions and limitations under the license",
    "MitShort": "released under the mit license",
    "MitLicensed": "licensed under the mit license",
    "MitGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
                "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
                "to the following conditions",
    "MitNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "AsIsMit": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
               "merchantability fitness for a particular purpose and noninfringement",
    "LiabMit": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of "
               "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "IscGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
                "the above copyright notice and this permission notice appear in all copies",
    "BsdGrant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
                 "the documentation and or other materials provided with the distribution",
    "BsdEndorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                  "from this software without specific prior written permission",
    "Gpl3Work": "this work is licensed under the gnu general public license version 3",
    "GplFree": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
               "published by the free software foundation either version 2 of the license or at your option any later version",
    "Gpl3Free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
                "published by the free software foundation either version 3 of the license or at your option any later version",
    "GplHope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
               "merchantability or fitness for a particular purpose",
    "GplSee": "see the gnu general public license for more details",
    "GplReceived": "you should have received a copy of the gnu general public license along with this program",
    # The same notices as they are cut at their ';', ':' and 'v. '.
    "GplTerms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    **{f"Gpl{v}Later": f"either version {v} of the license or at your option any later version" for v in (2, 3)},
    **{f"Gpl{v}You": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
                     f"foundation either version {v} of the license or at your option any later version" for v in (2, 3)},
    **{f"Gpl{v}Only": "you can redistribute it and or modify it under the terms of the gnu general public license "
                      f"version {v} as published by the free software foundation" for v in (2, 3)},
    "LgplTerms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "Lgpl21Later": "either version 2.1 of the license or at your option any later version",
    **{f"{n}3You": f"you can redistribute it and or modify it under the terms of the gnu {kind} general public license as published by the free software "
                   "foundation either version 3 of the license or at your option any later version" for n, kind in (("Lgpl", "lesser"), ("Agpl", "affero"))},
    "AgplTerms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "GplHopeBut": "this program is distributed in the hope that it will be useful but without any warranty",
    "GplWithoutEven": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "Mpl2Terms": "this source code form is subject to the terms of the mozilla public license v",
    "Mpl2ObtainHttps": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0",
    "Mpl2Subject": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "Mpl2Obtain": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0",
    "CcByNc4": "licensed under cc by nc 4.0",
    "CcBy4": "licensed under cc by 4.0",
    "CcBySa4": "licensed under cc by sa 4.0",
    "Cc0": "released under cc0 1.0 into the public domain",
    "PublicDomain": "this work is in the public domain",
    "Unlicense": "this is free and unencumbered software released into the public domain",
    "Reserved": "all rights reserved",
    "IscGrantAnd": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that "
                   "the above copyright notice and this permission notice appear in all copies",
    "ZeroBsdGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "BsdAdvert": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "BsdProduct": "this product includes software developed by the holder",
    "ApacheEndUser": "the end user documentation included with the redistribution if any must include the following acknowledgment",
    "ZlibAsIs": "this software is provided as is without any express or implied warranty",
    "ZlibLiable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "ZlibGrant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
                 "redistribute it freely subject to the following restrictions",
    "BoostShort": "distributed under the boost software license version 1.0",
    "BoostTitle": "boost software license version 1.0 august 17th 2003",
    "BoostGrant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
                  "documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to "
                  "prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "Epl1": "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this "
            "distribution and is available at http www.eclipse.org legal epl v10.html",
    "Epl2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at "
            "https www.eclipse.org legal epl 2.0",
    "Mpl11Subject": "the contents of this file are subject to the mozilla public license version 1.1 the license",
    "PerlTerms": "you can redistribute it and or modify it under the same terms as perl itself",
    "Artistic2": "you can redistribute it and or modify it under the terms of the the artistic license 2.0",
    "Wtfpl": "you can redistribute it and or modify it under the terms of the do what the fuck you want to public license version 2 as published by sam hocevar",
}
# The licences of the Creative Commons in short and in words, versions 3.0 and 4.0.
CC = {"by": "attribution", "by sa": "attribution sharealike", "by nc": "attribution noncommercial", "by nd": "attribution noderivatives",
      "by nc sa": "attribution noncommercial sharealike", "by nc nd": "attribution noncommercial noderivatives"}
CC_RULES = []
for _short, _words in CC.items():
    for _v, _port in (("3.0", "unported"), ("4.0", "international")):
        _id = "Cc" + "".join(x.capitalize() for x in _short.split()) + _v[0]
        SENTENCES.setdefault(_id, f"licensed under cc {_short} {_v}")
        SENTENCES[f"{_id}Work"] = f"this work is licensed under a creative commons {_words} {_v} {_port} license"
        CC_RULES += [(f"CC-{_short.upper().replace(' ', '-')}-{_v}", [x]) for x in (f"{_id}Work", _id)]
# Licence and the sentences that show it, longest notices first.
RULES = [
    ("Apache-2.0", ["ApacheYou", "ApacheUse", "ApacheCopy", "ApacheUrl", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheYou", "ApacheUse"]),
    ("MIT", ["MitGrant", "MitNotice", "AsIsMit", "LiabMit"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("BSD-4-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdAdvert", "BsdProduct", "BsdEndorse"]),
    ("BSD-4-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdAdvert"]),
    ("Apache-1.1", ["BsdGrant", "BsdSource", "BsdBinary", "ApacheEndUser"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("GPL-3.0-or-later", ["Gpl3Free", "GplHope", "GplSee", "GplReceived"]),
    ("GPL-3.0-or-later", ["Gpl3Free"]),
    ("GPL-2.0-or-later", ["GplFree", "GplHope", "GplSee", "GplReceived"]),
    ("GPL-2.0-or-later", ["GplFree"]),
    *[(f"GPL-{v}.0-or-later", [*head, *tail]) for v in (3, 2) for head in ([f"Gpl{v}You"], ["GplTerms", f"Gpl{v}Later"])
      for tail in (["GplHopeBut", "GplWithoutEven", "GplSee", "GplReceived"], [])],
    ("LGPL-2.1-or-later", ["LgplTerms", "Lgpl21Later"]),
    *[(f"{name}-3.0-or-later", ids) for name, n in (("LGPL", "Lgpl"), ("AGPL", "Agpl")) for ids in ([f"{n}Terms", "Gpl3Later"], [f"{n}3You"])],
    *[(f"GPL-{v}.0-only", [f"Gpl{v}Only"]) for v in (2, 3)],
    ("MPL-2.0", ["Mpl2Subject", "Mpl2Obtain"]),
    ("MPL-2.0", ["Mpl2Subject"]),
    # 'v. 2.0.' leaves '2.0' between these; the wording is that of version 2.0 only
    ("MPL-2.0", ["Mpl2Terms"]),
    ("MPL-2.0", ["Mpl2Obtain"]),
    ("MPL-2.0", ["Mpl2ObtainHttps"]),
    ("ISC", ["IscGrant"]),
    ("Apache-2.0", ["ApacheShort"]),
    ("Apache-2.0", ["ApacheYou"]),
    ("MIT", ["MitShort"]),
    ("MIT", ["MitLicensed"]),
    ("GPL-3.0-only", ["Gpl3Work"]),
    *CC_RULES,
    ("ISC", ["IscGrantAnd"]),
    ("0BSD", ["ZeroBsdGrant"]),
    ("Zlib", ["ZlibAsIs", "ZlibLiable", "ZlibGrant"]),
    ("Zlib", ["ZlibGrant"]),
    *[("BSL-1.0", [x]) for x in ("BoostGrant", "BoostTitle", "BoostShort")],
    ("EPL-1.0", ["Epl1"]),
    ("EPL-2.0", ["Epl2"]),
    ("MPL-1.1", ["Mpl11Subject", "ApacheUse"]),
    ("MPL-1.1", ["Mpl11Subject"]),
    ("Artistic-1.0-Perl", ["PerlTerms"]),
    ("Artistic-2.0", ["Artistic2"]),
    ("WTFPL", ["Wtfpl"]),
    ("CC0-1.0", ["Cc0"]),
    ("Unlicense", ["Unlicense"]),
    ("public-domain", ["PublicDomain"]),
    ("all-rights-reserved", ["Reserved"]),
]
# A tag 'SPDX-License-Identifier: X' is a sentence for every licence X above; its colon ends no sentence.
TAG = "spdx-license-identifier"
for _name in dict.fromkeys(n for n, _ in RULES):
    if _name not in ("public-domain", "all-rights-reserved"):
        SENTENCES["Spdx" + "".join(c for c in _name if c.isalnum())] = f"{TAG.replace('-', ' ')} {_name.lower().replace('-', ' ')}"
        RULES.append((_name, [list(SENTENCES)[-1]]))
# Every sentence above holds one of these, so a text without any has none of them.
CUES = ["licen", "cc0", "warrant", "permission", "redistribut", "copyright", "domain", "reserved", "mpl", "liable", "advertising", "developed by"]
# A list number after the end of a sentence goes with the end.
ENDS = r"[.!?:;]+([\x20\x09-\x0D]+|\z)([#*/\x20\x09-\x0D]*[(]?[0-9]{1,2}[.)][\x20\x09-\x0D]+)?"
NOISE = r"[^a-z0-9.\n]+"
# A sentence with a hole for the holder's name, which may end in a stop ('Inc.'), and the same with the name of the table.
HOLDER = r"neither the name of [^\n]{1,120}( |\n ?)nor the names of (its|their) contributors"
ANY_HOLDER = "neither the name of the copyright holder nor the names of its contributors"
PRODUCT, ANY_PRODUCT = r"this product includes software developed by [^\n]{1,120}", "this product includes software developed by the holder"


def tagged(sequence: list[str]) -> str:
    return "".join(f"<{x}>" for x in sequence)


def _normal(text: Column) -> Column:
    return F.replace(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit("licence"), F.lit("license"))


def _sequence(lower: Column, unwrap: bool) -> Column:
    """``<id><id>…`` of the sentences in order; ``<?>`` for others that speak of a licence, ``<.>`` between for the rest."""
    lines = F.translate(lower, "\n", " ") if unwrap else lower
    lines = F.replace(lines, F.lit(TAG + ":"), F.lit(TAG))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(lines, ENDS, "\n"), NOISE, " "), HOLDER, ANY_HOLDER)
    plain = F.regexp_replace(plain, PRODUCT, ANY_PRODUCT)
    known = F.create_map(*[F.lit(x) for s, t in SENTENCES.items() for x in (t, f"<{s}>")])
    sentences = F.filter(F.transform(F.split(plain, "\n"), lambda s: F.trim(s)), lambda s: s != "")
    tags = F.transform(sentences, lambda s: F.coalesce(F.try_element_at(known, s), F.when(s.rlike("licen|copyright"), "<?>"), F.lit("<.>")))
    return F.array_join(tags, "")


def _apply_rules(sequence: Column) -> Column:
    """(found licences in rule order, the sequence with what they used up as ``<.>``)."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(tagged(ids)).alias("tags")) for name, ids in RULES])
    start = F.struct(F.array().cast("array<string>").alias("found"), sequence.alias("left"))
    return F.aggregate(rules, start, lambda acc, r: F.struct(
        F.when(acc["left"].contains(r["tags"]), F.concat(acc["found"], F.array(r["name"]))).otherwise(acc["found"]).alias("found"),
        F.replace(acc["left"], r["tags"], F.lit("<.>")).alias("left")))


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, sentences, licenses, n_unmatched, n_unknown`` per row.

    ``sentences`` are the recognised identifiers in order, lines being taken as
    sentences of their own; a second reading joins wrapped lines, and
    ``licenses`` (distinct, in rule order) are those of either.
    ``n_unmatched`` recognised sentences fit no rule and ``n_unknown`` others
    speak of a licence or copyright, both by lines.  Null and empty texts have
    none; nothing is grouped, so repeated rows and null ids are rows like
    others; other columns are not read."""
    raw = F.coalesce(F.col(text), F.lit(""))
    # explode of one element: each step is computed once
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.array(_normal(raw))).alias("t"))
    cue = F.col("t").rlike("|".join(CUES))
    rows = rows.select("doc_id", F.explode(F.array(F.struct(*[
        F.when(cue, _sequence(F.col("t"), w)).otherwise("").alias(n) for n, w in (("lines", False), ("joined", True))]))).alias("s"))
    rows = rows.select("doc_id", "s", F.explode(F.array(F.struct(*[_apply_rules(F.col(f"s.{n}")).alias(n) for n in ("lines", "joined")]))).alias("r"))
    found = F.array_union("r.lines.found", "r.joined.found")
    names = F.array(*map(F.lit, dict.fromkeys(n for n, _ in RULES)))
    ids = F.regexp_extract_all("s.lines", F.lit("<([A-Za-z0-9]+)>"), 1)
    return rows.select("doc_id", ids.alias("sentences"), F.filter(names, lambda n: F.array_contains(found, n)).alias("licenses"),
                       F.regexp_count("r.lines.left", F.lit("<[A-Za-z0-9]+>")).cast("long").alias("n_unmatched"),
                       F.regexp_count("s.lines", F.lit("<[?]>")).cast("long").alias("n_unknown"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: sentences and licences of every document."""
    rows = licenses(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.array_join("sentences", ",").alias("sentences"), F.array_join("licenses", ",").alias("licenses"),
                       F.size("sentences").cast("long").alias("n_sentences"), "n_unmatched", "n_unknown")


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = "MAP {" + ", ".join(f"{q(t)}: {q(f'<{s}>')}" for s, t in SENTENCES.items()) + "}"

    def seq(lines: str) -> str:
        plain = f"regexp_replace(regexp_replace(replace({lines}, '{TAG}:', '{TAG}'), '{ENDS}', chr(10), 'g'), '{NOISE}', ' ', 'g')"
        plain = f"regexp_replace(regexp_replace({plain}, '{HOLDER}', '{ANY_HOLDER}', 'g'), '{PRODUCT}', '{ANY_PRODUCT}', 'g')"
        return (f"array_to_string(list_transform(list_filter(list_transform(string_split({plain}, chr(10)), lambda s: trim(s)), lambda s: s <> ''), "
                f"lambda s: coalesce({known}[s], CASE WHEN regexp_matches(s, 'licen|copyright') THEN '<?>' ELSE '<.>' END)), '')")

    cue = " OR ".join(f"contains(t, '{c}')" for c in CUES)
    steps, last = [], "s"
    for k, (_, ids) in enumerate(RULES):
        steps.append(f"r{k} AS (SELECT *, contains(a, '{tagged(ids)}') OR contains(b, '{tagged(ids)}') AS f{k} FROM {last}),\n"
                     f"q{k} AS (SELECT * REPLACE (replace(a, '{tagged(ids)}', '<.>') AS a, replace(b, '{tagged(ids)}', '<.>') AS b) FROM r{k})")
        last = f"q{k}"
    names = dict.fromkeys(n for n, _ in RULES)
    found = ", ".join(f"CASE WHEN {' OR '.join(f'f{k}' for k, (m, _) in enumerate(RULES) if m == n)} THEN '{n}' END" for n in names)
    return f"""
WITH t AS (SELECT doc_id, replace(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), 'licence', 'license') AS t FROM documents),
s0 AS (SELECT doc_id, CASE WHEN {cue} THEN {seq('t')} ELSE '' END AS lines, CASE WHEN {cue} THEN {seq("translate(t, chr(10), ' ')")} ELSE '' END AS b FROM t),
s AS (SELECT *, lines AS a FROM s0),
{', '.join(steps)}
SELECT doc_id, array_to_string(regexp_extract_all(lines, '<([A-Za-z0-9]+)>', 1), ',') AS sentences,
       array_to_string(list_filter([{found}], lambda x: x IS NOT NULL), ',') AS licenses,
       CAST(len(regexp_extract_all(lines, '<([A-Za-z0-9]+)>', 1)) AS BIGINT) AS n_sentences,
       CAST(len(regexp_extract_all(a, '<[A-Za-z0-9]+>')) AS BIGINT) AS n_unmatched, CAST(len(regexp_extract_all(lines, '<[?]>')) AS BIGINT) AS n_unknown
FROM {last}
"""


SQL = _sql()
