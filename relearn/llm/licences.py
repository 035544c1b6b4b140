"""Operator 8: licence scans by sentence rules.

A text is cut into segments at line ends and after sentence marks.  One segment, or several in a row, whose normalised
words are a known licence sentence become that sentence's identifier; of several readings from one place the longest
counts.  Other segments are read with slots: the clause on names with any holder (``CLAUSE``), statements that
something is licensed under one or several named licences (``STATED``) with other words around them, unless they are denied,
SPDX expressions (after ``SPDX-License-Identifier`` or ``License``, or alone with an operator) and links to licences.
The text's identifiers, in order, are then matched with ordered rules: the first rule whose identifiers occur
as a run takes them, until no rule matches.  Of a whole licence text the title and the terms listed here are read;
of a choice between licences each one is given.  Work is per text and linear in it, very long texts included; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised (lower case, words only).
SENTENCES = {
    "mit-name": ["mit license", "the mit license", "the mit license mit", "released under the mit license", "licensed under the mit license",
                 "this project is licensed under the mit license", "distributed under the mit license", "spdx license identifier mit"],
    "permission-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                         "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
                         "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to "
                         "do so subject to the following conditions"],
    "notice-included": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is-software": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
                       "merchantability fitness for a particular purpose and noninfringement"],
    "no-liability-authors": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action "
                             "of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "apache-name": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
                    "apache license version 2 0", "released under the apache license version 2 0", "spdx license identifier apache 2 0"],
    "apache-compliance": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "apache-as-is": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
                     "without warranties or conditions of any kind either express or implied"],
    "apache-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "gpl3-name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
                  "gnu general public license version 3", "released under the gnu general public license version 3",
                  "spdx license identifier gpl 3 0 only"],
    "gpl2-name": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2",
                  "gnu general public license version 2", "released under the gnu general public license version 2",
                  "spdx license identifier gpl 2 0 only"],
    "gpl3-later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
                   "published by the free software foundation either version 3 of the license or at your option any later version",
                   "spdx license identifier gpl 3 0 or later"],
    "gpl2-later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
                   "published by the free software foundation either version 2 of the license or at your option any later version",
                   "spdx license identifier gpl 2 0 or later"],
    "gpl-useful": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
                   "merchantability or fitness for a particular purpose"],
    "gpl-received": ["you should have received a copy of the gnu general public license along with this program"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
                   "documentation and or other materials provided with the distribution"],
    "bsd-names": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
                  "this software without specific prior written permission"],
    "bsd2-name": ["bsd 2 clause license", "spdx license identifier bsd 2 clause"],
    "bsd3-name": ["bsd 3 clause license", "spdx license identifier bsd 3 clause"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
                  "above copyright notice and this permission notice appear in all copies"],
    "mpl2-form": ["this source code form is subject to the terms of the mozilla public license v 2 0", "spdx license identifier mpl 2 0"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0",
              "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0",
                 "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0",
                 "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-nd": ["licensed under cc by nd 4 0", "this work is licensed under cc by nd 4 0",
                 "this work is licensed under a creative commons attribution noderivatives 4 0 international license"],
    "cc-by-nc-sa": ["licensed under cc by nc sa 4 0", "this work is licensed under cc by nc sa 4 0",
                    "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"],
    "cc-by-nc-nd": ["licensed under cc by nc nd 4 0", "this work is licensed under cc by nc nd 4 0",
                    "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"],
    "cc0": ["cc0 1 0 universal", "licensed under cc0 1 0", "spdx license identifier cc0 1 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    # titles of whole texts
    "apache-title": ["apache license version 2 0 january 2004"],
    "gpl3-title": ["gnu general public license version 3 29 june 2007"],
    "gpl2-title": ["gnu general public license version 2 june 1991"],
    "lgpl21-title": ["gnu lesser general public license version 2 1 february 1999"],
    "lgpl3-title": ["gnu lesser general public license version 3 29 june 2007"],
    "agpl3-title": ["gnu affero general public license version 3 19 november 2007"],
    "mpl2-title": ["mozilla public license version 2 0", "mozilla public license 2 0"],
    "epl2-title": ["eclipse public license v 2 0", "eclipse public license version 2 0"],
    "bsl1-title": ["boost software license version 1 0 august 17th 2003", "boost software license version 1 0"],
    "isc-title": ["isc license", "the isc license"],
    "cc-by-title": ["creative commons attribution 4 0 international public license"],
    "cc-by-sa-title": ["creative commons attribution sharealike 4 0 international public license"],
    "epl2-terms": ["the accompanying program is provided under the terms of this eclipse public license agreement",
                   "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at "
                   "https www eclipse org legal epl 2 0"],
    "bsl1-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation "
                   "covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works "
                   "of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "bsl1-form": ["distributed under the boost software license version 1 0"],
}
for _key, _name, _version, _spdx in (("lgpl21", "lesser", "2 1", "lgpl 2 1"), ("lgpl3", "lesser", "3", "lgpl 3 0"), ("agpl3", "affero", "3", "agpl 3 0")):
    _long = f"gnu {_name} general public license"
    SENTENCES[f"{_key}-name"] = [f"{_long} version {_version}", f"licensed under the {_long} version {_version}", f"released under the {_long} version {_version}",
                                 f"this work is licensed under the {_long} version {_version}", f"spdx license identifier {_spdx} only"]
    SENTENCES[f"{_key}-later"] = [f"{_what} is free software you can redistribute it and or modify it under the terms of the {_long} as published by the free "
                                  f"software foundation either version {_version} of the license or at your option any later version"
                                  for _what in ("this program", "this library")] + [f"spdx license identifier {_spdx} or later"]

# Names after "licensed under", with the identifier of the sentence; the more specific ones first.
_VERSION = r"(?: licen[sc]e)? ?(?:version |v ?)?"
_LATER = r" (?:of the license )?or (?:at your option )?(?:any )?(?:later|newer|above)"
NAMES = [(f"{key}-{kind}", rf"(?:gnu )?(?:{long}|{short}){_VERSION}{version}{end}(?! \d)") for key, long, short, version in (
    ("lgpl21", "lesser general public", "lgpl", "2 1"), ("lgpl3", "lesser general public", "lgpl", "3(?: 0)?"), ("agpl3", "affero general public", "agpl", "3(?: 0)?"),
    ("gpl3", "general public", "gpl", "3(?: 0)?"), ("gpl2", "general public", "gpl", "2(?: 0)?")) for kind, end in (("later", _LATER), ("name", ""))] + [
    ("mit-name", r"(?:mit|expat)(?: licen[sc]e|$|(?= (?:or|and) ))"), ("apache-name", rf"apache(?: software)?{_VERSION}2(?: 0)?"), ("mpl2-form", rf"(?:mozilla public|mpl){_VERSION}2(?: 0)?"),
    ("bsd2-name", "(?:bsd 2 clause|2 clause bsd|simplified bsd)"), ("bsd3-name", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)"), ("isc-name", "isc(?: licen[sc]e|$)"),
    *((f"cc-{code.replace(' ', '-')}", rf"(?:creative commons |cc )(?:{code}|{name})(?: license)? 4 0") for code, name in (
        ("by nc sa", "attribution non ?commercial share ?alike"), ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"), ("by nc", "attribution non ?commercial"),
        ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?deriv(?:ative)?s"), ("by", "attribution"))), ("cc0", "(?:creative commons )?cc0(?: 1 0)?"),
    ("epl2-name", rf"(?:eclipse public|epl){_VERSION}2(?: 0)?"), ("bsl1-name", rf"(?:boost software|bsl|boost){_VERSION}1(?: 0)?"), ("bsd-name", "bsd(?: style)?(?: licen[sc]e|$)")]

# SPDX identifiers, normalised, with the identifier of the sentence; the longer ones first.
SPDX = {**{f"{code} {version} {end}": f"{key}-{kind}" for key, code, version in (("lgpl21", "lgpl", "2 1"), ("lgpl3", "lgpl", "3 0"), ("agpl3", "agpl", "3 0"), ("gpl3", "gpl", "3 0"), ("gpl2", "gpl", "2 0"))
           for end, kind in (("or later", "later"), ("only", "name"))},
        **{f"{code} {version}": f"{key}-name" for key, code, version in (("lgpl21", "lgpl", "2 1"), ("lgpl3", "lgpl", "3 0"), ("agpl3", "agpl", "3 0"), ("gpl3", "gpl", "3 0"), ("gpl2", "gpl", "2 0"))},
        "apache 2 0": "apache-name", "bsd 2 clause": "bsd2-name", "bsd 3 clause": "bsd3-name", "mpl 2 0": "mpl2-form", "epl 2 0": "epl2-name", "bsl 1 0": "bsl1-name",
        **{f"cc {code} 4 0": f"cc-{code.replace(' ', '-')}" for code in ("by nc sa", "by nc nd", "by nc", "by sa", "by nd", "by")}, "cc0 1 0": "cc0",
        "unlicense": "unlicense", "isc": "isc-name", "mit": "mit-name", "bsd": "bsd-name"}

# Addresses of licences, normalised, with the identifier of the sentence.
LINKS = [(r"creativecommons org licenses by nc sa 4 0", "cc-by-nc-sa"), (r"creativecommons org licenses by nc nd 4 0", "cc-by-nc-nd"), (r"creativecommons org licenses by nc 4 0", "cc-by-nc"),
         (r"creativecommons org licenses by sa 4 0", "cc-by-sa"), (r"creativecommons org licenses by nd 4 0", "cc-by-nd"), (r"creativecommons org licenses by 4 0", "cc-by"),
         (r"creativecommons org publicdomain zero 1 0", "cc0"), (r"apache org licenses license 2 0", "apache-link"), (r"gnu org licenses (?:old licenses )?lgpl 2 1", "lgpl21-name"),
         (r"gnu org licenses lgpl 3 0", "lgpl3-name"), (r"gnu org licenses agpl 3 0", "agpl3-name"), (r"gnu org licenses gpl 3 0", "gpl3-name"),
         (r"gnu org licenses old licenses gpl 2 0", "gpl2-name"), (r"mozilla org (?:en us )?mpl 2 0", "mpl2-form"), (r"eclipse org legal epl 2 0", "epl2-name"),
         (r"boost org license 1 0", "bsl1-name"), (r"opensource org licenses? mit", "mit-name"), (r"opensource org licenses? apache 2 0", "apache-link"),
         (r"opensource org licenses? bsd 3 clause", "bsd3-name"), (r"opensource org licenses? bsd 2 clause", "bsd2-name"), (r"opensource org licenses? isc", "isc-name"), (r"unlicense org", "unlicense")]

# Ordered rules, the more specific ones first.
RULES = [
    ("MIT", ("mit-name", "permission-grant", "notice-included", "as-is-software", "no-liability-authors")),
    ("MIT", ("permission-grant", "notice-included", "as-is-software", "no-liability-authors")),
    ("MIT", ("permission-grant", "notice-included")),
    ("Apache-2.0", ("apache-name", "apache-compliance", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-name", "apache-compliance", "apache-copy")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-useful", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-useful", "gpl-received")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    *((f"{name}-or-later", (f"{key}-later", "gpl-useful")) for key, name in (("lgpl21", "LGPL-2.1"), ("lgpl3", "LGPL-3.0"), ("agpl3", "AGPL-3.0"))),
    *((f"{name}-{end}", (f"{key}-{kind}",)) for key, name in (("lgpl21", "LGPL-2.1"), ("lgpl3", "LGPL-3.0"), ("agpl3", "AGPL-3.0"))
      for end, kind in (("or-later", "later"), ("only", "name"))),
    ("GPL-3.0-or-later", ("gpl3-later",)), ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-3.0-only", ("gpl3-name",)), ("GPL-2.0-only", ("gpl2-name",)),
    *((licence, (f"{key}-title",)) for key, licence in (
        ("apache", "Apache-2.0"), ("gpl3", "GPL-3.0-only"), ("gpl2", "GPL-2.0-only"), ("lgpl21", "LGPL-2.1-only"), ("lgpl3", "LGPL-3.0-only"), ("agpl3", "AGPL-3.0-only"),
        ("mpl2", "MPL-2.0"))),
    ("EPL-2.0", ("epl2-title", "epl2-terms")), ("BSL-1.0", ("bsl1-title", "bsl1-grant")), ("ISC", ("isc-title", "isc-grant")),
    *((licence, (name,)) for licence, names in (("EPL-2.0", ("epl2-title", "epl2-terms", "epl2-name")), ("BSL-1.0", ("bsl1-title", "bsl1-grant", "bsl1-form", "bsl1-name")),
                                               ("ISC", ("isc-title",)), ("CC-BY-4.0", ("cc-by-title",)), ("CC-BY-SA-4.0", ("cc-by-sa-title",)), ("Apache-2.0", ("apache-link",)))
      for name in names),
    ("BSD", ("bsd-name",)),
    ("Apache-2.0", ("apache-name",)), ("MIT", ("mit-name",)), ("MIT", ("permission-grant",)), ("ISC", ("isc-name", "isc-grant")), ("ISC", ("isc-grant",)), ("ISC", ("isc-name",)),
    ("BSD-3-Clause", ("bsd3-name",)), ("BSD-2-Clause", ("bsd2-name",)), ("MPL-2.0", ("mpl2-form",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)), ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd",)), ("CC-BY-ND-4.0", ("cc-by-nd",)), ("CC-BY-NC-4.0", ("cc-by-nc",)), ("CC-BY-SA-4.0", ("cc-by-sa",)), ("CC-BY-4.0", ("cc-by",)), ("CC0-1.0", ("cc0",)), ("Unlicense", ("unlicense",)),
]

_WORDS, _PLUS = re.compile(r"[^\W_]+"), re.compile(r"(?<=gpl-[0-9][.][0-9])[+]")
_CUT = re.compile(r"[\n\r]+|(?<=[.;:!?])\s+")
#: Every known sentence has one of these stems, so other texts need no reading in detail (checked when the module loads).
_STEMS = ("licen", "warrant", "permission", "copyright", "redistribut", "notice", "liab", "public domain", "cc0", r"\bunder\b", r"\b(?:or|and)\b[^a-z]*[a-z0]+-?[0-9]", "publicdomain", "/mpl/", "/legal/epl")
_ANY_STEM = re.compile("|".join(_STEMS))


def normalised(text: str) -> str:
    return " ".join(_WORDS.findall(_PLUS.sub(" or later", text.lower())))


KNOWN = {sentence: name for name, sentences in SENTENCES.items() for sentence in sentences}
_PREFIXES = {" ".join(words[:i]) for words in (s.split() for s in KNOWN) for i in range(1, len(words) + 1)}
if not all(_ANY_STEM.search(s) for s in KNOWN):
    raise ValueError("a known sentence has none of the stems")

_UNDER = r"\b(?:licen[sc]ed|released|distributed|available|published|provided|covered|redistributed) (?:\w+ ){0,4}?under (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?"
STATED = [(name, re.compile(_UNDER + "(?:" + pattern + r")\b")) for name, pattern in NAMES]
_STATEMENT = re.compile(_UNDER)
_DENIED = re.compile(r"\b(?:not|never|no longer|neither)(?: \w+){0,2} $")
#: The clause on names: who is named is free, and so are line ends and full stops in the name.
CLAUSE = re.compile(r"(?:\d )?(?:neither )?(?:the )?names? of .{1,300}? may (?:not )?be used to endorse or promote products derived from this software "
                    r"without (?:specific )?prior written permission")
_CLAUSE_START = re.compile(r"(?:\d )?(?:neither (?:the )?names? of|the names? of) ")
_CLAUSE_SEGMENTS = 12


_NAMED = re.compile("|".join(f"(?P<n{i}>{pattern}\\b)" for i, (_, pattern) in enumerate(NAMES)))
_EITHER, _NEXT = re.compile(r"(?:either |any |one )?(?:of )?(?:the )?"), re.compile(r",? ?(?:or|and)(?: at your option)?(?: under)?(?: the| an?)? ")
_ID = "|".join(sorted(map(re.escape, SPDX), key=len, reverse=True))
_EXPRESSION = re.compile(rf"(?:{_ID})(?: (?:or|and) (?:{_ID})| with (?:\w+ ?){{1,6}})*")
_IDS = re.compile(rf"\b(?:{_ID})\b")
_HEAD = re.compile(r"(?:spdx )?licen[sc]es?(?: identifier| expression)?")
_LINK = re.compile("|".join(f"(?P<l{i}>{pattern})" for i, (pattern, _) in enumerate(LINKS)))


def _listed(words: str, at: int) -> list[str]:
    """Identifiers of the licences named from ``at`` on: one, or several with "or" and "and" between them."""
    out, m = [], _EITHER.match(words, at)
    at = m.end() if m else at
    while m := _NAMED.match(words, at):
        out.append(NAMES[int(m.lastgroup[1:])][0])
        more = _NEXT.match(words, m.end())
        if not more:
            break
        at = more.end()
    return out


def _expression(words: str, alone: bool) -> list[str]:
    """Identifiers of an SPDX expression; without a heading (``alone``) it must have an operator."""
    m = _EXPRESSION.fullmatch(words)
    ids = [SPDX[x] for x in _IDS.findall(words)] if m else []
    return [] if alone and len(ids) < 2 else ids


def _with_slots(segments: list[tuple[str, int, int]], i: int) -> tuple[list[str], int, int, int] | None:
    """The sentence with slots that begins with segment ``i``: identifiers, first and last character, last segment."""
    words, a, b = segments[i]
    m = _STATEMENT.search(words)
    if m and not _DENIED.search(words[:m.start()]):
        names = _listed(words, m.end()) or [name for name, pattern in STATED if pattern.search(words)][:1]
        if names:
            return names, a, b, i
    if _CLAUSE_START.match(words + " "):
        text = words
        for j in range(i, min(i + _CLAUSE_SEGMENTS, len(segments))):
            text += " " + segments[j][0] if j > i else ""
            if CLAUSE.match(text):
                return ["bsd-names"], a, segments[j][2], j
    head = _HEAD.match(words + " ")
    if head and head.end() >= len(words) and i + 1 < len(segments):
        names = _expression(segments[i + 1][0], False)
        if names:
            return names, a, segments[i + 1][2], i + 1
    names = _expression(words[head.end():].strip(), False) if head else _expression(words, True)
    if not names and (m := _LINK.search(words)):
        names = [LINKS[int(m.lastgroup[1:])][1]]
    return (names, a, b, i) if names else None


def sentences(text: str | None) -> list[tuple[str, int, int]]:
    """Known sentences of a text in order: identifier, first and last character (its end)."""
    if not text or not _ANY_STEM.search(text.lower()):
        return []
    at, segments = 0, []
    for m in [*_CUT.finditer(text), None]:
        end = m.start() if m else len(text)
        words = normalised(text[at:end])
        if words:
            segments.append((words, at, end))
        at = m.end() if m else end
    out, i = [], 0
    while i < len(segments):
        words, best = segments[i][0], None        # best: identifiers, first and last character, last segment
        j = i
        while words in _PREFIXES:
            if words in KNOWN:
                best = ([KNOWN[words]], segments[i][1], segments[j][2], j)
            j += 1
            if j == len(segments):
                break
            words += " " + segments[j][0]
        best = best or _with_slots(segments, i)
        if best:
            out += [(name, *best[1:3]) for name in best[0]]
        i = best[3] + 1 if best else i + 1
    return out


def licences(names: list[str]) -> list[tuple[str, int]]:
    """Licences of a sequence of identifiers and the place of each one's first identifier, in text order."""
    free, found = list(names), []
    for licence, rule in RULES:
        n, i = len(rule), 0
        while i + n <= len(free):
            if tuple(free[i:i + n]) == rule:
                found.append((licence, i))
                free[i:i + n] = [None] * n
                i += n
            else:
                i += 1
    return sorted(found, key=lambda x: x[1])


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, licences, sentences, starts, ends)`` for every row: licences and known sentences in text order.

    starts and ends are character places of the sentences.  Null and empty texts and texts without known sentences
    have empty lists, sentences that no rule takes give no licence.  Rows are read one by one, also those that repeat a
    doc_id; very long texts are read whole; other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [sentences(t.as_py()) for t in batch.column("text")]
            names = [[f[0] for f in row] for row in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([[k for k, _ in licences(n)] for n in names], pa.list_(pa.string())), pa.array(names, pa.list_(pa.string())),
                 pa.array([[f[1] for f in row] for row in found], pa.list_(pa.int32())), pa.array([[f[2] for f in row] for row in found], pa.list_(pa.int32()))],
                names=["doc_id", "licences", "sentences", "starts", "ends"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, licences array<string>, sentences array<string>, starts array<int>, ends array<int>")
