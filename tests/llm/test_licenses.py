"""License scans: prose around notices, wrapped notices, names of other licenses, the order by size gain."""

import random
import textwrap
from functools import lru_cache

import pytest

from lakeloom.llm import licenses

AROUND = [
    "Copyright 2021 Example Corp. {} No part of this software or its documentation files may be copied, modified or "
    "distributed without a license, subject to the terms and conditions of the agreement and in compliance with the law.",
    "This project is a free software and you can redistribute it. {} Permission to use, copy and modify the source and "
    "binary forms is subject to the conditions below; you may obtain a copy of the terms at the site.",
]


def found(text):
    return [(name, diffs) for _, name, _, diffs in licenses.Scanner().scan(text)]


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("name", ["MIT", "All-rights-reserved", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0"])
def test_prose_like_another_template_hides_no_notice(around, name):
    assert (name, 0) in found(around.format(licenses.TEMPLATES[name]))


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# ", "-- ", "    "])
@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_wrapped_notices(name, mark):
    lines = textwrap.wrap(licenses.TEMPLATES[name], 40, break_long_words=False)
    text = "some code\n" + "\n".join(mark + x for x in lines) + "\nmore code"
    assert found(text) == [(name, 0)]
    assert licenses.may_hold(text.lower().encode())


@pytest.mark.parametrize("text", [
    "Released under the BSD License.", "released under the Motown license", "a man of the release under a new license",
    "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC 3.0.",
    "This work is licensed under a Creative Commons Attribution ShareAlike 3.0 International License.",
    "Licensed under the Apache License, Version 1.1.", "my driving license is old",
    "This work is licensed under the GNU Lesser General Public License, version 4.",
    "SPDX-License-Identifier: Foo-1.0", "SPDX-License-Identifier:", "the Apache 2.0 web server", "a redistribution of income",
])
def test_other_licenses_get_no_name(text):
    assert found(text) == []


@pytest.mark.parametrize("text, name", [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU GPL version 2", "GPL-2.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation,", "LGPL-notice"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("This project uses the MIT License", "MIT"), ("Licensed under the GPL-3.0 license", "GPL-3.0"),
    ("Licensed under GPLv3", "GPL-3.0"), ("Covered by the LGPL v2.1", "LGPL-2.1"), ("under the ISC license", "ISC"),
    ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "BSL-1.0"),
    ("Licensed under Apache 2.0", "Apache-2.0"), ("a 3-clause BSD license", "BSD-3-Clause"), ("the Unlicense", "Unlicense"),
    ("made available under the terms of the Eclipse Public License v2.0", "EPL-2.0"),
])
def test_each_license_gets_its_own_name(text, name):
    assert [n for n, _ in found(text)] == [name]
    assert licenses.may_hold(text.lower().encode())


@pytest.mark.parametrize("identifier", licenses.SPDX)
def test_tags(identifier):
    assert found(f"// SPDX-License-Identifier: {identifier}\nint main() {{}}") == [(identifier, 0)]
    assert found(f"spdx-license-identifier: {identifier.lower()}") == [(identifier, 0)]


def test_tags_with_expressions():
    assert [n for n, _ in found("# SPDX-License-Identifier: (MIT OR Apache-2.0)\nimport x")] == ["MIT", "Apache-2.0"]
    assert [n for n, _ in found("SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0")] == ["GPL-2.0-or-later"]
    text = "SPDX-License-Identifier: Foo AND MIT\nReleased under the MIT License."
    assert [n for n, _ in found(text)] == ["MIT"]  # an unknown first identifier: the notice below still counts


@pytest.mark.parametrize("text", [
    "not released under the MIT License", "This code is NOT licensed under the Apache License, Version 2.0.",
    "It isn't covered by the MIT License", "never distributed under the GPLv3",
    "This was not at any time licensed under GPLv3",
])
def test_a_negation_before_the_notice_makes_it_none(text):
    assert found(text) == []


@pytest.mark.parametrize("text", [
    "It does not work. Released under the MIT License.", "This is not a fork but is released under the MIT License.",
    "No warranty!\n\nReleased under the MIT License.",
])
def test_a_negation_of_something_else_does_not(text):
    assert found(text) == [("MIT", 0)]


def test_clauses_tell_the_texts_of_one_family_apart():
    two, three, opening = (licenses.TEMPLATES[x] for x in ("BSD-2-Clause", "BSD-3-Clause", "BSD-notice"))
    assert found(two) == [("BSD-2-Clause", 0)]
    assert found(three) == [("BSD-3-Clause", 0)]
    assert found(opening + " be nice.") == [("BSD-notice", 0)]
    bullets = three.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ").replace("the copyright holder", "Acme")
    assert [n for n, _ in found(bullets)] == ["BSD-3-Clause"]
    assert [n for n, _ in found(f"{two}\n{three}\n{two}")] == ["BSD-2-Clause", "BSD-3-Clause", "BSD-2-Clause"]


def test_the_template_that_saves_most_of_those_that_fit_wins():
    """Of all templates whose wording holds around a name, by every name of a text, with sizes taken anew."""
    scanner = licenses.Scanner()
    rng = random.Random(3)
    filler = "the code of this work is given to all people under terms and may be used at any time".split()
    for _ in range(40):
        name = rng.choice(sorted(licenses.TEMPLATES))
        text = " ".join([*rng.choices(filler, k=9), licenses.TEMPLATES[name], *rng.choices(filler, k=9)])
        words = [w for w, _, _ in licenses.spelled(text)]
        best = []
        for t in scanner.templates:
            for k, w in enumerate(words):
                if w == t.words[t.pin] and (d := t.fit(words, k)[0]) <= t.slack:
                    plain = len(scanner.sizes.plain.compress(text.lower().encode()))
                    scanner.sizes.ranked(text, [t.text])
                    best.append((len(scanner.sizes.given[t.text].compress(text.lower().encode())) - plain, d, t.name))
        assert found(text)[0][0] == min(best)[2] == name


def test_fit_equals_brute_force():
    """Every stretch and every alignment, by recursion over pairs of words."""
    rng = random.Random(5)
    for _ in range(60):
        body = rng.choices(["a1", "b", "c", "of"], k=rng.randint(2, 4))
        name = rng.sample(["x", "y", "z"], 2)
        t = licenses.Template("t", " ".join([*body, *name, "c"]), (" ".join(name),), slack=99)
        words = rng.choices(["a1", "b", "c", "of", "not"], k=3) + name + rng.choices(["c", "b", "not", "of"], k=2)
        if rng.random() < 0.5:
            words.insert(4, rng.choice(["of", "b"]))
        pin = words.index(name[0])

        @lru_cache(None)
        def cost(i, j, end):
            """Template words from i on against words j to end."""
            if i == len(t.words) and j == end:
                return 0
            ways = [1 << 20]
            if i < len(t.words) and not t.fixed[i]:
                ways.append(1 + cost(i + 1, j, end))
            if j < end and words[j] != "not" and (not t.joined[i] or words[j] in ("of",)):
                ways.append(1 + cost(i, j + 1, end))
            if i < len(t.words) and j < end and (i != t.pin or j == pin):
                if words[j] == t.words[i]:
                    ways.append(cost(i + 1, j + 1, end))
                elif not t.fixed[i] and words[j] != "not":
                    ways.append(1 + cost(i + 1, j + 1, end))
            return min(ways)

        best = min(cost(0, s, e) for s in range(len(words) + 1) for e in range(s, len(words) + 1))
        d, s, e = t.fit(words, pin)
        assert min(d, 1 << 20) == best
        assert d >= 1 << 20 or cost(0, s, e) == best


def test_broken_utf8_and_odd_texts():
    scanner = licenses.Scanner()
    assert scanner.scan("") == [] and scanner.scan("-") == []
    assert scanner.scan("SPDX-License-Identifier: \ufffd\nx") == []
    assert [x[1] for x in scanner.scan("\ufffd Released under the MIT License. \ufffd")] == ["MIT"]
    long = "word " * 200_000 + licenses.TEMPLATES["MIT"] + " word" * 200_000
    assert [x[1] for x in scanner.scan(long)] == ["MIT"]


@pytest.mark.parametrize("text, name", [
    ("Distributed under the MIT License", "MIT"), ("Released under the MIT Licence.", "MIT"),
    ("Licensed under the Apache License 2.0", "Apache-2.0"), ("Released under CC BY-NC 4.0", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU GPLv3", "GPL-3.0"), ("This work is licensed under the GNU GPL, version 3", "GPL-3.0"),
    ("This file is subject to the terms of the Mozilla Public License, version 2.0", "MPL-2.0"),
])
def test_words_around_the_name_may_differ(text, name):
    assert [n for n, _ in found(text)] == [name]
