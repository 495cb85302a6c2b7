"""Licence recognition by sentences and rules.

Known licence sentences are kept as a table of normalised words (a trie, so that one walk finds the longest known sentence
at a place). Normalising makes lower case, drops punctuation, comment marks, line ends, articles and "version", and spells
numbers and names one way; so it doesn't matter over how many lines a sentence is wrapped. Sentences are looked up where a
line or a sentence of the text begins; notices ("released under the ... license") and SPDX tags wherever they stand.

The sequence of a document's sentence identifiers is then matched against ordered licence rules: at each place the first
rule whose identifiers follow (those in brackets may be missing) wins and takes its sentences; a sentence that no rule takes
counts as unmatched. SPDX expressions are rules of their own and keep AND, OR and WITH.

Null and empty texts have no sentences; repeated rows give repeated rows; an empty table gives an empty table; other columns
are ignored. Time is in proportion to a text's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import map_rows, texts

# Names and wording of public licences.

#: Names by SPDX identifier; "license" and "version" may be left out or added in texts.
NAMES = {
    "MIT": ["MIT", "Expat", "X11", "MIT X11"],
    "Apache-1.1": ["Apache 1.1", "Apache Software 1.1"],
    "Apache-2.0": ["Apache 2.0", "Apache Software 2.0", "ASL 2.0"],
    "BSD-2-Clause": ["BSD 2 clause", "2 clause BSD", "simplified BSD", "FreeBSD"],
    "BSD-3-Clause": ["BSD 3 clause", "3 clause BSD", "new BSD", "modified BSD", "revised BSD"],
    "0BSD": ["0BSD", "zero clause BSD", "BSD zero clause"],
    "ISC": ["ISC"],
    "Zlib": ["zlib", "zlib libpng"],
    "Unlicense": ["Unlicense"],
    "BSL-1.0": ["Boost Software 1.0", "Boost 1.0", "Boost Software", "Boost"],
    "BUSL-1.1": ["Business Source 1.1"],
    "WTFPL": ["WTFPL", "Do What The Fuck You Want To Public"],
    "MPL-1.1": ["Mozilla Public 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public 2.0", "MPL 2.0"],
    "EPL-1.0": ["Eclipse Public 1.0", "EPL 1.0"],
    "EPL-2.0": ["Eclipse Public 2.0", "EPL 2.0"],
    "CDDL-1.0": ["Common Development and Distribution 1.0", "CDDL 1.0"],
    "CDDL-1.1": ["Common Development and Distribution 1.1", "CDDL 1.1"],
    "EUPL-1.1": ["European Union Public 1.1", "EUPL 1.1"],
    "EUPL-1.2": ["European Union Public 1.2", "EUPL 1.2"],
    "Artistic-1.0": ["Artistic 1.0"],
    "Artistic-2.0": ["Artistic 2.0"],
    "AFL-3.0": ["Academic Free 3.0", "AFL 3.0"],
    "MS-PL": ["Microsoft Public", "Ms PL"],
    "OFL-1.1": ["SIL Open Font 1.1", "Open Font 1.1", "OFL 1.1"],
    "PostgreSQL": ["PostgreSQL"],
    "Python-2.0": ["Python Software Foundation 2", "PSF 2"],
    "ODbL-1.0": ["Open Database 1.0", "ODbL 1.0", "ODC Open Database 1.0"],
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons Zero 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons CC0"],
}
#: Families with versions: identifier, names, versions. "or later" makes "-or-later" of "-only".
GNU = [
    ("GPL", ["GNU General Public", "GNU GPL", "GPL"], ["1.0", "2.0", "3.0"]),
    ("LGPL", ["GNU Lesser General Public", "GNU Library General Public", "GNU LGPL", "LGPL"], ["2.0", "2.1", "3.0"]),
    ("AGPL", ["GNU Affero General Public", "Affero General Public", "GNU AGPL", "AGPL"], ["3.0"]),
]
CREATIVE = [("BY", "attribution"), ("BY-SA", "attribution sharealike"), ("BY-NC", "attribution noncommercial"), ("BY-ND", "attribution noderivatives"), ("BY-NC-SA", "attribution noncommercial sharealike"), ("BY-NC-ND", "attribution noncommercial noderivatives")]
CREATIVE_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: identifier -> sentences; one that ends in "..." goes on in any way.
SENTENCES = {
    "apache2obey": ["you may not use this file except in compliance with the License"],
    "apache2copy": ["You may obtain a copy of the License at ..."],
    "apache2asis": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "apache2see": ["See the License for the specific language governing permissions and limitations under the License"],
    "mitgrant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files ..."],
    "mitnotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software"],
    "mitasis": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND ..."],
    "mitliable": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY ..."],
    "iscgrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsdgrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "iscasis": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE ..."],
    "iscliable": ["IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES ..."],
    "zlibasis": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlibgrant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "unlicenseanyone": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software ..."],
    "boostgrant": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license ..."],
    "mpl2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "mpl2copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at ..."],
    "epl2": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 ...", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 ..."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsdsource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsdbinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer ..."],
    "bsdnames": ["Neither the name of ..."],
    "bsdasis": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" ...", "THIS SOFTWARE IS PROVIDED BY THE AUTHOR \"AS IS\" ...", "THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS \"AS IS\" ..."],
    "publicdomain": ["This work is in the public domain", "This file is in the public domain", "This program is in the public domain", "This software is in the public domain", "This work is released into the public domain", "This file is released into the public domain", "This text is released into the public domain", "This software is released into the public domain", "released into the public domain", "in the public domain"],
}
#: Ordered; under:... are notices. Longer sequences stand before those that they begin with.
RULES = [
    ("Apache-2.0", ["under:Apache-2.0", "[apache2obey]", "[apache2copy]", "[apache2asis]", "[apache2see]"]),
    ("Apache-2.0", ["apache2obey", "[apache2copy]", "apache2asis", "[apache2see]"]),
    ("MIT", ["[under:MIT]", "mitgrant", "mitnotice", "[mitasis]", "[mitliable]"]),
    ("ISC", ["[under:ISC]", "iscgrant", "[iscasis]", "[iscliable]"]),
    ("0BSD", ["[under:0BSD]", "0bsdgrant", "[iscasis]", "[iscliable]"]),
    ("Zlib", ["zlibasis", "zlibgrant"]),
    ("Unlicense", ["unlicense", "[unlicenseanyone]", "[mitasis]", "[mitliable]"]),
    ("BSL-1.0", ["[under:BSL-1.0]", "boostgrant", "[mitasis]"]),
    ("MPL-2.0", ["mpl2", "[mpl2copy]"]),
    ("EPL-2.0", ["epl2"]),
    ("BSD-3-Clause", ["[under:BSD-3-Clause]", "bsd", "bsdsource", "bsdbinary", "bsdnames", "[bsdasis]"]),
    ("BSD-2-Clause", ["[under:BSD-2-Clause]", "bsd", "bsdsource", "bsdbinary", "[bsdasis]"]),
    ("LicenseRef-public-domain", ["publicdomain"]),
]
VERBS = "licensed|licenced|released|distributed|redistributed|published|available|provided|offered|shared|covered|usable"

_TOKEN = re.compile(r"[^\W_]+(?:\.[0-9]+)*\+?")
_SPDX = re.compile(r"spdx-license-identifier\s*:\s*([^\n]+)")
_DROPPED = {"the", "a", "an", "terms", "of", "version", "v", "ver"}
_IN_NAMES = _DROPPED | {"license", "licence", "international", "unported", "generic", "public"}
_GLUED = re.compile(r"(gpl|lgpl|agpl|mpl|epl|eupl|cddl|v|version)\.?v?([0-9][0-9.]*\+?)$")
_SPELLED = {"licence": "license", "licences": "licenses", "licenced": "licensed"}


def words(low: str, at: int = 0) -> Iterator[tuple[str, int]]:
    """The normalised words of lower-cased text from at on, each with the place where it ends."""
    for m in _TOKEN.finditer(low, at):
        w, end = m.group(), m.end()
        if g := _GLUED.match(w):
            if g[1] not in _DROPPED:
                yield g[1], end
            w = g[2]
        later = w[-1] == "+" and w[0].isdigit()
        w = w.rstrip("+") if later else w
        while w[0].isdigit() and w.endswith(".0"):
            w = w[:-2]
        if w not in _DROPPED:
            yield _SPELLED.get(w, w), end
        if later:
            yield from (("or", end), ("later", end))


def _named(low: str, at: int = 0) -> Iterator[tuple[str, int]]:
    return ((w, e) for w, e in words(low, at) if w not in _IN_NAMES)


def _grow(trie: dict, path: Iterator[tuple[str, int]], value: str) -> None:
    for w, _ in path:
        trie = trie.setdefault(w, {})
    trie.setdefault("", value)


def _longest(trie: dict, path: Iterator[tuple[str, int]]) -> tuple[str, int] | None:
    """The value of the longest known sequence at the beginning of path, and where it ends."""
    best = None
    for w, end in path:
        if (trie := trie.get(w)) is None:
            break
        if "" in trie:
            best = trie[""], end
    return best


def _licence_names() -> dict:
    """The trie of licence names, built by rule for families with versions."""
    trie: dict = {}
    for spdx, some in NAMES.items():
        for n in some:
            _grow(trie, _named(n.lower()), spdx)
    for family, some, versions in GNU:
        for v in versions:
            for n in some:
                _grow(trie, _named(f"{n} {v}".lower()), f"{family}-{v}-only")
                for later in ("or later", "or any later", "or at your option any later", "or newer"):
                    _grow(trie, _named(f"{n} {v} {later}".lower()), f"{family}-{v}-or-later")
    for short, long in CREATIVE:
        for v in CREATIVE_VERSIONS:
            spaced = long.replace("sharealike", "share alike").replace("noncommercial", "non commercial").replace("noderivatives", "no derivatives")
            for n in (f"cc {short}", f"creative commons {short}", f"creative commons {long}", f"creative commons {spaced}", f"cc {long}"):
                _grow(trie, _named(f"{n} {v}".lower()), f"CC-{short}-{v}")
    return trie


def _known_sentences() -> dict:
    """The trie of sentences; those of the GNU licences are built by rule."""
    trie: dict = {}
    for k, some in SENTENCES.items():
        for s in some:
            _grow(trie, words(s.lower()), k)
    for thing in ("program", "library", "software", "file"):
        _grow(trie, words(f"this {thing} is distributed in the hope that it will be useful, but without any warranty"), "gplwarranty")
        for family, some, versions in GNU:
            _grow(trie, words(f"you should have received a copy of the {some[0].lower()} license along with this {thing}"), "gplcopy")
            for v in versions:
                free = f"this {thing} is free software: you can redistribute it and/or modify it under the terms of the {some[0].lower()} license as published by the free software foundation"
                for middle in ("either", ""):
                    _grow(trie, words(f"{free}, {middle} version {v} of the license"), f"gnu:{family}-{v}-only")
                    _grow(trie, words(f"{free}, {middle} version {v} of the license, or (at your option) any later version"), f"gnu:{family}-{v}-or-later")
    return trie


_NAME_TRIE, _SENTENCE_TRIE = _licence_names(), _known_sentences()
_GAP = r"[\W_]+(?:(?:the|an?|terms|of)[\W_]+)*"
#: Where a known sentence may begin: its first two words.
_STARTS = re.compile(rf"(?<![^\W_])(?:{'|'.join(sorted(rf'{re.escape(a)}{_GAP}(?:{"|".join(sorted(map(re.escape, b)))})' for a, b in _SENTENCE_TRIE.items()))})(?![^\W_])")
#: What may stand before it: a line's or sentence's end, marks, a list's number, an article.
_BEFORE = re.compile(r"(?:\A|[\n.!?:;])[\W_]*(?:[0-9a-z][.)][\W_]*|\([0-9a-z]\)[\W_]*)?(?:(?:the|an?)[\W_]+)?\Z")
_NOTICE = re.compile(rf"(?<![^\W_])(?:{VERBS})[\W_]+(?:[^\W_]+[\W_]+){{0,3}}?(?:under|by)(?![^\W_])")
_NOT = re.compile(r"(?<![^\W_])(?:not|never)[\W_]+(?:[^\W_]+[\W_]+){0,2}\Z")
_JOINED = {"or", "and"}
_SPDX_NAMES = {k.lower(): k for k in [*NAMES, *(f"{f}-{v}-{e}" for f, _, vs in GNU for v in vs for e in ("only", "or-later")), *(f"CC-{s}-{v}" for s, _ in CREATIVE for v in CREATIVE_VERSIONS)]}
_SPDX_OLD = {f"{f}-{v}{p}".lower(): f"{f}-{v}-{e}" for f, _, vs in GNU for v in vs for p, e in (("", "only"), ("+", "or-later"))}


def expression(raw: str) -> str:
    """An SPDX expression with identifiers and operators as SPDX spells them; what SPDX doesn't know stays as it is."""
    out = []
    for t in re.findall(r"[()]|[A-Za-z0-9.+:-]+", raw):
        low = t.lower()
        known = low.upper() if low in ("and", "or", "with") else _SPDX_NAMES.get(low) or _SPDX_OLD.get(low)
        if not known and out and not re.search(r"[()\d-]", t):
            break  # a plain word after the first: a remark
        out.append(known or t)
        if len(out) > 1 and out[-2] not in ("AND", "OR", "WITH", "(") and out[-1] not in ("AND", "OR", "WITH", ")"):
            out.pop()  # the expression has ended: what follows is a remark
            break
    while out and out[-1] in ("AND", "OR", "WITH", "("):
        out.pop()
    return " ".join(out).replace("( ", "(").replace(" )", ")")


def sentences(text: str) -> list[tuple[str, str]]:
    """(identifier, SPDX expression if it is a tag) of the known sentences of text, in order."""
    low = text.lower()
    raw = text if len(low) == len(text) else low
    found: list[tuple[int, int, str, str]] = []
    for m in _SPDX.finditer(low):
        if e := expression(raw[m.start(1) : m.end(1)]):
            found.append((m.start(), m.end(), "spdx", e))
    for m in _NOTICE.finditer(low):
        at = m.end()
        if _NOT.search(low, max(0, m.start() - 60), m.start()):
            continue
        while got := _longest(_NAME_TRIE, _named(low, at)):
            found.append((m.start() if at == m.end() else at, got[1], f"under:{got[0]}", ""))
            rest = _named(low, got[1])
            joint = next(rest, ("", 0))
            if joint[0] not in _JOINED:
                break
            at = joint[1]
    for m in _STARTS.finditer(low):
        if _BEFORE.search(low, max(0, m.start() - 60), m.start()) and (got := _longest(_SENTENCE_TRIE, words(low, m.start()))):
            found.append((m.start(), got[1], got[0], ""))
    out, end = [], 0
    for s, e, k, x in sorted(found):
        if s >= end:  # what lies within a known sentence is a part of it
            out.append((k, x))
            end = e
    return out


def _matches(rule: list[str], ids: list[str], at: int) -> int:
    """How many identifiers from at on the rule takes; 0 if it doesn't apply."""
    n = at
    for part in rule:
        if n < len(ids) and ids[n] == part.strip("[]"):
            n += 1
        elif part[0] != "[":
            return 0
    return n - at


def licences(found: list[tuple[str, str]], rules=RULES) -> tuple[list[str], int]:
    """The licences of a sequence of known sentences, in order, and how many sentences no rule took."""
    ids, out, at, rest = [k for k, _ in found], [], 0, 0
    while at < len(ids):
        name, n = next(((name, n) for name, rule in rules if (n := _matches(rule, ids, at))), ("", 0))
        kind, _, spdx = ids[at].partition(":")
        if not n and kind == "spdx":
            name, n = found[at][1], 1
        elif not n and kind in ("under", "gnu"):
            name, n = spdx, 1 + _matches(["[gplwarranty]", "[gplcopy]"], ids, at + 1) * (kind == "gnu" or "GPL" in spdx)
        if n:
            out.append(name)
        rest += not n
        at += max(n, 1)
    return out, rest


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentences (identifiers in order), licenses (in order) and n_unmatched of every whole text."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        found = [sentences(t) for t in cols["text"]]
        named = [licences(f) for f in found]
        return {
            "doc_id": cols["doc_id"],
            "n_sentences": [len(f) for f in found],
            "sentences": [",".join(k for k, _ in f) for f in found],
            "licenses": [",".join(n) for n, _ in named],
            "n_unmatched": [r for _, r in named],
        }

    return map_rows(texts(docs), run, "doc_id long, n_sentences long, sentences string, licenses string, n_unmatched long")
