"""License scans by conditional compression.

Blocks are windows of words around the words that name a license, over the whole text: line breaks,
comment marks and punctuation only separate words, so a notice may be wrapped. A block is compressed
with zstandard alone and with each template that has its name there as raw dictionary. The bytes
saved rank the templates; their wording is confirmed in that order until one holds, so of
the templates that fit a block the one that shortens it most wins, and so it is where notices overlap.
A size alone drops nothing: every template of a block is tried before the block is given up. Templates
without their name in the block can't be confirmed and are not compressed.

The differences are an edit distance in words between the template and the stretch of the block that
fits it best. Names (``NAMES``: license, version, variant) must be there word for word, in one
piece; only the words around them may differ, and none of them may turn to a negation. A negation
before the notice in its clause ("not released under the MIT License") makes it none. Spellings
of one name count as equal ("GPLv3", "Licence", "2.0" and "2", "BY-NC" and "Attribution-NonCommercial").
``SPDX-License-Identifier`` tags are blocks of their own, one for each identifier of their expression;
identifiers beyond ``SPDX`` are not reported.

Defined cases: a null or empty text has no finding; a text may hold several notices, each is
reported; repeated rows and repeated notices are reported each; a null doc_id is carried; an empty
table gives an empty result; only doc_id and text are read; bytes that are not UTF-8 read as U+FFFD.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

# Wordings of license notices, by identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "This work has been dedicated to the public domain under CC0 1.0 Universal.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
    "contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction,",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation,",
    "All-rights-reserved": "All rights reserved.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation",
    "AGPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "Affero General Public License as published by the Free Software Foundation",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-notice": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
    "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
    "distribute, execute, and transmit the Software",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain.",
}
# The words of each template that name its license; words of one phrase stay together.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0",),
    "MIT": ("MIT License",),
    "GPL-3.0": ("GNU General Public License, version 3",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0",),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0",),
    "CC0-1.0": ("CC0 1.0",),
    "MPL-2.0": ("Mozilla Public License, v. 2.0",),
    "BSD-notice": ("Redistribution", "source", "binary", "following conditions"),
    "BSD-2-Clause": ("Redistribution", "following conditions", "Redistributions", "retain", "Redistributions", "reproduce"),
    "BSD-3-Clause": ("Redistribution", "following conditions", "Redistributions", "retain", "Redistributions", "reproduce",
                     "Neither", "endorse or promote"),
    "MIT-notice": ("hereby granted", "free of charge", "deal", "without restriction"),
    "Apache-2.0-notice": ("www.apache.org/licenses/LICENSE-2.0",),
    "GPL-notice": ("GNU General Public License",),
    "All-rights-reserved": ("rights reserved",),
    "GPL-2.0": ("GNU General Public License, version 2",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "LGPL-notice": ("GNU Lesser General Public License",),
    "AGPL-notice": ("GNU Affero General Public License",),
    "EPL-2.0": ("Eclipse Public License 2.0",),
    "ISC-notice": ("Permission to use", "with or without fee", "hereby granted"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "BSL-notice": ("hereby granted", "free of charge", "organization", "accompanying documentation"),
    "Unlicense-notice": ("unencumbered software", "public domain"),
}
# Names that count as a notice by themselves, (license, name).
SHORT = (
    ("MIT", "MIT License"),
    ("ISC", "ISC License"),
    ("Apache-2.0", "Apache License 2.0"),
    ("Apache-2.0", "Licensed under Apache 2.0"),
    ("GPL-2.0", "GNU General Public License 2"),
    ("GPL-3.0", "GNU General Public License 3"),
    ("LGPL-2.1", "GNU Lesser General Public License 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License 3"),
    ("AGPL-3.0", "GNU Affero General Public License 3"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License 2.0"),
    ("BSL-1.0", "Boost Software License 1.0"),
    ("BSD-2-Clause", "BSD 2-Clause"),
    ("BSD-2-Clause", "2-Clause BSD"),
    ("BSD-3-Clause", "BSD 3-Clause"),
    ("BSD-3-Clause", "3-Clause BSD"),
    ("CC0-1.0", "CC0 1.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("Unlicense", "Unlicense"),
)
# Identifiers of SPDX tags.
SPDX = (
    "MIT", "ISC", "Apache-2.0", "MPL-2.0", "EPL-2.0", "BSL-1.0", "BSD-2-Clause", "BSD-3-Clause", "Unlicense",
    "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
)
# Every text with a name holds one of these, lower-cased, or matches _CC.
CUES = (
    b"licen", b"apache", b"gnu", b"gpl", b"mozilla", b"mpl", b"commons", b"reserved", b"redistribution", b"hereby",
    b"unencumbered", b"clause",
)
TOLERANCE = 0.25  # words that may differ, as a share of the template's words

_CC = re.compile(rb"\bcc(?:0\b|[\W_]*by\b)")
_LOOSE = frozenset("the a an of version".split())  # may be left out of or put into a name
_NEGATIONS = frozenset("not no non never nor neither cannot isn aren wasn don doesn didn".split())
_CLAUSE_WORDS = frozenset("but and or".split())  # a negation before one of these is about something else
_CLAUSE_END = re.compile(r"[.;:!?]\s|\n\s*\n")
BEFORE = 8  # words before a name in which a negation is looked for
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([\w.+\- \t()]*)", re.I)
_IDENTIFIER = re.compile(r"[A-Za-z0-9][\w.+\-]*")
_OPERATORS = frozenset("and or".split())
_NEVER = 1 << 20

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
_PART = re.compile(r"[^\-]+")
_VERSION = re.compile(r"v?\.?(\d+(?:\.\d+)*)$")
_GPL = re.compile(r"([al]?)gpl(?:v?(\d+(?:\.\d+)*))?$")
_SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "v": "version"}
_AFTER = {  # (word before, word): what the two are in a name
    ("commons", "by"): ["commons", "attribution"],
    ("attribution", "nc"): ["attribution", "noncommercial"],
    ("attribution", "sa"): ["attribution", "sharealike"],
    ("noncommercial", "sa"): ["noncommercial", "sharealike"],
    ("non", "commercial"): ["noncommercial"],
    ("share", "alike"): ["sharealike"],
}
_SHORT = {"cc": ["creative", "commons"], "mpl": ["mozilla", "public", "license"], "epl": ["eclipse", "public", "license"]}


def _words(text: str) -> list[str]:
    return [p.lower() for w in _WORD.findall(text) for p in w.split("-")]


def _number(text: str) -> str:
    while text.endswith(".0"):
        text = text[:-2]
    return text


def spelled(text: str) -> list[tuple[str, int, int]]:
    """(word in the one spelling of license names, start, end) of every word of a text."""
    out: list[tuple[str, int, int]] = []
    for token in _WORD.finditer(text):
        for part in _PART.finditer(token.group()):
            s, e = token.start() + part.start(), token.start() + part.end()
            w = part.group().lower()
            w = _SPELLINGS.get(w, w)
            new = [w]
            if out and (out[-1][0], w) in _AFTER:
                new = _AFTER[out[-1][0], w]
                s = out.pop()[1]
            elif w in _SHORT:
                new = _SHORT[w]
            elif "gpl" in w[:4]:
                if m := _GPL.match(w):
                    new = ["general", "public", "license"]
                    new = {"a": ["affero"], "l": ["lesser"], "": []}[m[1]] + new
                    if [x[0] for x in out[-len(new) :]] == new:  # the short form after the long one
                        new = []
                    elif not out or out[-1][0] != "gnu":
                        new = ["gnu"] + new
                    if m[2]:
                        new = new + ["version", _number(m[2])]
            elif m := _VERSION.match(w):
                new = ["version", _number(m[1])] if w[0] == "v" else [_number(w)]
            if w in _SHORT and [x[0] for x in out[-len(new) :]] == new:
                new = []
            out.extend((x, s, e) for x in new)
    return out


class Template:
    def __init__(self, name: str, text: str, names: tuple[str, ...], slack: int | None = None) -> None:
        self.name, self.text, self.raw = name, text, _words(text)
        self.words = [w for w, _, _ in spelled(text)]
        self.fixed = [False] * len(self.words)  # must be there
        self.joined = [False] * (len(self.words) + 1)  # nothing may stand between the word before and this one
        at = 0
        for phrase in names:
            p = [w for w, _, _ in spelled(phrase)]
            at = next(k for k in range(at, len(self.words)) if self.words[k : k + len(p)] == p)
            for k in range(at, at + len(p)):
                self.fixed[k], self.joined[k] = self.words[k] not in _LOOSE, k > at
            at += len(p)
        self.needed = {w for w, f in zip(self.words, self.fixed) if f}
        self.pin = self.fixed.index(True)  # the first word of the name: windows are around it
        self.slack = int(TOLERANCE * len(self.words)) if slack is None else slack

    def fit(self, words: list[str], pin: int) -> tuple[int, int, int]:
        """(edit distance, start, end) of the nearest stretch whose first name word is at ``pin``."""
        row = [(0, j) for j in range(len(words) + 1)]
        for i, t in enumerate(self.words):
            fixed, joined = self.fixed[i], self.joined[i + 1]
            new = [(_NEVER if fixed else row[0][0] + 1, 0)]
            for j, w in enumerate(words):
                a, b, c = row[j], row[j + 1], new[j]
                cost = int(t != w)
                if (cost and (fixed or w in _NEGATIONS)) or (i == self.pin and j != pin):
                    cost = _NEVER
                extra = _NEVER if w in _NEGATIONS or joined and w not in _LOOSE else 1
                new.append(min((a[0] + cost, a[1]), (b[0] + (_NEVER if fixed else 1), b[1]), (c[0] + extra, c[1])))
            row = new
        end = min(range(len(row)), key=lambda j: (row[j][0], j - row[j][1], j))
        return row[end][0], row[end][1], end


class Compressors:
    """Bytes that a template as raw dictionary saves on a block."""

    def __init__(self, level: int = 3) -> None:
        self.level, self.plain, self.given = level, zstandard.ZstdCompressor(level=level), {}

    def ranked(self, block: str, texts: list[str]) -> list[tuple[int, float, int]]:
        """(-bytes saved, share saved, place in ``texts``), most saved first."""
        data = block.lower().encode("utf-8", "replace")
        alone = len(self.plain.compress(data))
        out = []
        for i, text in enumerate(texts):
            if text not in self.given:
                words = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.given[text] = zstandard.ZstdCompressor(level=self.level, dict_data=words)
            saved = alone - len(self.given[text].compress(data))
            out.append((-saved, saved / alone, i))
        return sorted(out, key=lambda x: (x[0], x[2]))


def edits(a: list[str], b: list[str]) -> int:
    """Edit distance in words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


class Scanner:
    def __init__(self) -> None:
        self.sizes = Compressors()
        self.templates = [Template(name, text, NAMES[name]) for name, text in TEMPLATES.items()]
        self.templates += [Template(name, text, (text,), slack=1) for name, text in SHORT]  # 1: a word of _LOOSE
        self.pins: dict[str, list[Template]] = {}
        for t in self.templates:
            self.pins.setdefault(t.words[t.pin], []).append(t)
        self.tags = [f"SPDX-License-Identifier: {x}" for x in SPDX]
        self.identifiers = [[w for w, _, _ in spelled(x)] for x in SPDX]

    def tagged(self, text: str) -> list[tuple[int, str, float, int, int]]:
        """(start, license, gain, start, end of the tag) of every known identifier of SPDX tags."""
        out = []
        for tag in _TAG.finditer(text):
            after_with = False
            for m in _IDENTIFIER.finditer(text, tag.start(1), tag.end(1)):
                w = m.group()
                if w.lower() == "with":
                    after_with = True  # what follows is an exception's name
                elif w.lower() in _OPERATORS:
                    after_with = False
                elif not after_with:
                    w = w[:-1] + "-or-later" if w.endswith("+") else w
                    words = [x for x, _, _ in spelled(w)]
                    for _, share, i in self.sizes.ranked(f"SPDX-License-Identifier: {w}", self.tags):
                        if self.identifiers[i] == words:
                            out.append((m.start(), SPDX[i], share, tag.start(), tag.end()))
                            break
                    else:
                        if not out or out[-1][4] != tag.end():
                            break  # the first word is no identifier known here: the rest may be prose
        return out

    @staticmethod
    def negated(text: str, at: list[tuple[str, int, int]], first: int, pin: int) -> bool:
        """Whether a negation stands before word ``first`` in its clause."""
        for j in range(first - 1, max(-1, pin - BEFORE - 1), -1):
            if at[j][0] in _CLAUSE_WORDS or _CLAUSE_END.search(text, at[j][2], at[j + 1][1]):
                return False
            if at[j][0] in _NEGATIONS:
                return True
        return False

    def scan(self, text: str) -> list[tuple[int, str, float, int]]:
        """(start, license, gain, differing words) of every notice of a text."""
        at = spelled(text)
        words = [w for w, _, _ in at]
        todo: list[tuple] = []

        def look(k: int, low: int, high: int) -> None:
            """The template that saves most of those whose wording holds around the name at ``k``."""
            spans = []
            for t in self.pins[words[k]]:
                s, e = max(low, k - t.pin - t.slack), min(high, k - t.pin + len(t.words) + t.slack)
                if t.needed.issubset(words[s:e]):
                    spans.append((t, s, e))
            if not spans:
                return
            block = text[at[min(s for _, s, _ in spans)][1] : at[max(e for _, _, e in spans) - 1][2]]
            for saved, share, i in self.sizes.ranked(block, [t.text for t, _, _ in spans]):
                t, s, e = spans[i]
                d, a, b = t.fit(words[s:e], k - s)
                if d <= t.slack:
                    if not self.negated(text, at, s + a, k):
                        heappush(todo, (saved, d, s + a, s + b, k, share, t.name, i, t))
                    return

        tags = self.tagged(text) if "-" in text else []
        found = [(start, name, share, 0) for start, name, share, _, _ in tags]
        taken: list[tuple[int, int]] = []  # stretches of words, sorted
        starts = [s for _, s, _ in at]
        for low, high in sorted({(x[3], x[4]) for x in tags}):
            taken.append((bisect_left(starts, low), bisect_left(starts, high)))
        for k, w in enumerate(words):
            if w in self.pins:
                look(k, 0, len(words))
        while todo:
            _, d, a, b, k, share, name, _, t = heappop(todo)
            place = bisect_left(taken, (k + 1,))
            low = taken[place - 1][1] if place else 0
            high = taken[place][0] if place < len(taken) else len(words)
            if low > k:
                continue  # its name is part of a better notice
            if a < low or b > high:
                look(k, low, high)  # once more, in what is left between better notices
                continue
            taken.insert(place, (a, b))
            start, end = at[a][1], at[b - 1][2]
            found.append((start, name, share, edits(t.raw, _words(text[start:end]))))
        return sorted(found)


def may_hold(text: bytes) -> bool:
    """Whether a lower-cased text can hold the name of a license."""
    return any(c in text for c in CUES) or b"cc" in text and _CC.search(text) is not None


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for b in batches:
        out = []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            if text and may_hold(text.lower()):
                out.extend((doc, *x, x[3] == 0) for x in scanner.scan(text.decode("utf-8", "replace")))
        cols = list(zip(*out)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds)],
            names=["doc_id", "start", "license", "size_gain", "word_diffs", "exact"],
        )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, start, license, size_gain, word_diffs, exact: one row per notice found."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        _scan, "doc_id long, start long, license string, size_gain double, word_diffs int, exact boolean"
    )
