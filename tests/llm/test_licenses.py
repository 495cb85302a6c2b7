"""Licence recognition: names, sentences over many lines, SPDX expressions, and a plain version of the matching."""

import pytest

from lexigraph.llm import licenses
from lexigraph.llm.licenses import licences, sentences


def named(text):
    return licences(sentences(text))[0]


def test_licences_without_hints_and_over_many_lines():
    assert named("Released under CC BY 4.0.") == ["CC-BY-4.0"]
    assert named("Distributed under Creative Commons BY-SA 4.0") == ["CC-BY-SA-4.0"]
    assert named("It is so.\nreleased under CC0 1.0") == ["CC0-1.0"]
    assert named("This work is in the public\ndomain.") == ["LicenseRef-public-domain"]
    asis = "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    assert [k for k, _ in sentences(asis.replace(" ", "\n# "))] == ["apache2asis"]
    warranty = "This program is distributed in the hope that it will be useful, but without\nany warranty whatever."
    assert [k for k, _ in sentences(warranty.replace(" ", "\n"))] == ["gplwarranty"]
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the Software), to deal\n" + "in it without limit\n" * 20
    assert named(grant + "subject to these conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.") == ["MIT"]
    apache = "You may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n http://www.apache.org/licenses/LICENSE-2.0\n\n"
    assert [k for k, _ in sentences(apache + asis)] == ["apache2obey", "apache2copy", "apache2asis"]


@pytest.mark.parametrize("text,want", [
    ("This work is released under CC0 1.0.", ["CC0-1.0"]),
    ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
    ("// SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT OR Apache-2.0"]),
    ("/* SPDX-License-Identifier: (gpl-2.0+ with Classpath-exception-2.0) */", ["(GPL-2.0-or-later WITH Classpath-exception-2.0)"]),
    ("spdx-license-identifier: LicenseRef-Own", ["LicenseRef-Own"]),
    ("SPDX-License-Identifier: MIT and more words", ["MIT"]),
    ("Distributed under the terms of the GNU General Public License, version 2 or later.", ["GPL-2.0-or-later"]),
    ("It is distributed under the GPLv3.", ["GPL-3.0-only"]),
    ("released under GPLv2+", ["GPL-2.0-or-later"]),
    ("Licensed under the GNU Affero General Public Licence v3.0", ["AGPL-3.0-only"]),
    ("licensed under LGPL 2.1", ["LGPL-2.1-only"]),
    ("Available under the ISC license", ["ISC"]),
    ("This library is provided under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
    ("licensed under the Eclipse Public License 2.0", ["EPL-2.0"]),
    ("Dual-licensed under the MIT license or the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
    ("published under a Creative Commons Attribution-ShareAlike 3.0 Unported License", ["CC-BY-SA-3.0"]),
    ("This file is not licensed under the MIT license.", []),
    ("The apache helicopter flew under the bridge 2.0 times.", []),
    ("", []),
])
def test_names_and_tags(text, want):
    assert named(text) == want


def test_every_known_sentence_is_found_alone_and_wrapped():
    for k, some in licenses.SENTENCES.items():
        for s in some:
            s = s.removesuffix("...").strip()
            for text in (s, f"1. {s}.", f" * {s}".replace(" ", "\n # "), f"One more. {s}; and so on"):
                got = [i for i, _ in sentences(text)]
                assert k in got, (k, text, got)


def test_every_name_is_found():
    for spdx, some in licenses.NAMES.items():
        for n in some:
            assert named(f"Released under the {n} License.") == [spdx], n
    for family, some, versions in licenses.GNU:
        for n in some:
            for v in versions:
                assert named(f"released under the {n} version {v}") == [f"{family}-{v}-only"], (n, v)
                assert named(f"released under the {n} v{v} or any later version") == [f"{family}-{v}-or-later"]


def test_full_texts():
    gpl = """This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY.  You should have received a copy of the GNU General Public License
    along with this program."""
    assert licences(sentences(gpl)) == (["GPL-3.0-or-later"], 0)
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
"""
    assert licences(sentences(bsd)) == (["BSD-2-Clause"], 0)
    assert licences(sentences(bsd + "3. Neither the name of X nor its contributors may be used to endorse.")) == (["BSD-3-Clause"], 0)
    assert licences(sentences("See the License for the specific language governing permissions and limitations under the License.")) == ([], 1)


def plain(ids, rules):
    """All ways are tried, place by place."""
    out, rest, at = [], 0, 0
    while at < len(ids):
        for name, rule in rules:
            n = at
            ok = True
            for part in rule:
                bare = part.strip("[]")
                if n < len(ids) and ids[n] == bare:
                    n += 1
                elif part == bare:
                    ok = False
                    break
            if ok and n > at:
                out.append(name)
                at = n
                break
        else:
            rest += 1
            at += 1
    return out, rest


def test_rules_match_a_plain_version():
    import random

    r = random.Random(4)
    ids = sorted({p.strip("[]") for _, rule in licenses.RULES for p in rule if ":" not in p})
    for _ in range(500):
        some = [r.choice(ids) for _ in range(r.randrange(8))]
        if r.random() < 0.5:
            some += [p.strip("[]") for p in r.choice(licenses.RULES)[1] if ":" not in p]
        assert licences([(k, "") for k in some]) == plain(some, licenses.RULES)


def test_long_text_in_linear_time():
    import time

    text = "The software is what it is.\nThis work is under the sun.\n" * 40_000
    began = time.time()
    sentences(text)
    assert time.time() - began < 30
