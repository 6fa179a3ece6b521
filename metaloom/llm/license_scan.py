"""License scans by conditional compression."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from metaloom.llm.blocks import slices

# Wordings that licenses are noticed by.
_GNU = "This work is licensed under the GNU {} License, version {}."
_GNU_HEADER = (
    "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met"
)
_BSD_CONDITIONS = (
    _BSD + ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "GPL-2.0-header": _GNU_HEADER.format("program", "General Public", "2"),
    "LGPL-2.1": _GNU.format("Lesser General Public", "2.1"),
    "LGPL-2.1-header": _GNU_HEADER.format("library", "Lesser General Public", "2.1"),
    "LGPL-3.0-header": _GNU_HEADER.format("library", "Lesser General Public", "3"),
    "AGPL-3.0": _GNU.format("Affero General Public", "3"),
    "AGPL-3.0-header": _GNU_HEADER.format("program", "Affero General Public", "3"),
    # how both begin
    "BSD-2-Clause OR BSD-3-Clause": _BSD,
    "BSD-2-Clause": _BSD_CONDITIONS + "This software is provided by the copyright holders and contributors",
    "BSD-3-Clause": _BSD_CONDITIONS + "3. Neither the name of",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "proprietary": "No part of this publication may be reproduced without the prior written permission of the publisher.",
}
#: Names that licenses go by, and the wordings that only differ by the name.
_NAMED = {
    "MIT": "MIT",
    "Apache-2.0": "Apache License 2.0",
    "BSD-2-Clause": "BSD 2-Clause",
    "BSD-3-Clause": "BSD 3-Clause",
    "ISC": "ISC",
    "MPL-2.0": "Mozilla Public License 2.0",
    "GPL-2.0": "GNU General Public License v2.0",
    "GPL-3.0": "GNU General Public License v3.0",
    "LGPL-2.1": "GNU Lesser General Public License v2.1",
    "LGPL-3.0": "GNU Lesser General Public License v3.0",
    "AGPL-3.0": "GNU Affero General Public License v3.0",
    "CC0-1.0": "CC0 1.0 Universal",
    "CC-BY-4.0": "Creative Commons Attribution 4.0 International",
    "CC-BY-SA-4.0": "Creative Commons Attribution-ShareAlike 4.0 International",
    "CC-BY-NC-4.0": "Creative Commons Attribution-NonCommercial 4.0 International",
    "CC-BY-ND-4.0": "Creative Commons Attribution-NoDerivatives 4.0 International",
}
_WORDINGS = {
    "spdx": "SPDX-License-Identifier: {id}",
    "field": "License: {id}",
    "file": "This file is licensed under the {name} License.",
    "terms": "Distributed under the terms of the {name} License.",
}


def _with_wordings(templates: dict[str, str]) -> dict[str, str]:
    more = {
        f"{key}-{kind}": text.format(id=key, name=name.removesuffix(" License"))
        for key, name in _NAMED.items()
        for kind, text in _WORDINGS.items()
    }
    return templates | more


TEMPLATES = _with_wordings(TEMPLATES)


def license_of(template: str) -> str:
    """The license that a template is a wording of."""
    for kind in ("header", *_WORDINGS):
        template = template.removesuffix(f"-{kind}")
    return template


#: Words that tell a license from others, by the template's name without "-header"; without all of them none is confirmed.
REQUIRED = {
    "MIT-notice": "mit",
    "MIT": "deal sublicense",
    "Apache-2.0": "apache 2.0",
    "GPL-2.0": "gnu general public 2",
    "GPL-3.0": "gnu general public 3",
    "LGPL-2.1": "gnu lesser general public 2.1",
    "LGPL-3.0": "gnu lesser general public 3",
    "AGPL-3.0": "gnu affero general public 3",
    "CC-BY-4.0": "cc by 4.0",
    "CC-BY-SA-4.0": "cc by-sa 4.0",
    "CC-BY-NC-4.0": "cc by-nc 4.0",
    "CC-BY-ND-4.0": "cc by-nd 4.0",
    "CC-BY-NC-SA-4.0": "cc by-nc-sa 4.0",
    "CC-BY-NC-ND-4.0": "cc by-nc-nd 4.0",
    "CC0-1.0": "waived copyright",
    "BSD-2-Clause": "contributors",
    "BSD-2-Clause OR BSD-3-Clause": "source binary forms",
    "BSD-3-Clause": "neither name",
    "ISC": "fee provided",
    "MPL-2.0": "mozilla 2.0",
    "proprietary": "no without",
}
#: A line with none of these, in lower case, is no candidate.
CUES = (b"licen", b"copyright", b"permission", b"redistribut", b"public domain", b"all rights", b"free software")
#: Words of a candidate block; longer lines are cut into overlapping blocks.
BLOCK_WORDS, OVERLAP = 300, 100
#: A winner is confirmed if it lacks at most this share of the template's words, in order, none of them required, and
#: has no other words between them.
MOST_MISSING = 0.2
#: Words that deny a notice, and how far before it.
DENIALS = frozenset(("not", "never", "neither", "nor", "isn", "aren", "no", "without", "cannot"))
DENIED_WORDS = 3

SCHEMA = (
    "doc_id long, line int, block int, license string, plain_size int, conditional_size int, reduction int, "
    "n_missing int, n_added int, missing string, confirmed boolean"
)
_FIELDS = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower().replace("https://", "http://"))


def aligned(wanted: list[str], words: list[str], after: int = 0) -> tuple[list[int], int, int, int]:
    """The place in ``words`` that differs least from ``wanted`` and ends behind ``after``: the wanted words that are
    missing, by number, how many others lie between those found, and where these start and end."""
    places, at = np.array(words, object), np.arange(len(words) + 1) * 101
    rows = [np.zeros(len(words) + 1, np.int64)]
    for word in wanted:
        row = rows[-1] + 100
        row[1:] = np.where(places == word, np.minimum(row[1:], rows[-1][:-1]), row[1:])
        rows.append(np.minimum.accumulate(row - at) + at)
    first = min(after + 1, len(words))
    i, j = len(wanted), first + int(rows[-1][first:].argmin())
    missing, added, start, end = [], 0, j, None
    while i:
        if j and wanted[i - 1] == words[j - 1] and rows[i][j] == rows[i - 1][j - 1]:
            i, j = i - 1, j - 1
            start, end = j, end or j + 1
        elif rows[i][j] == rows[i - 1][j] + 100:
            i -= 1
            missing.append(i)
        else:
            j, added = j - 1, added + 1
    return missing[::-1], added, start, end or start


class Scanner:
    """Compressors with each template as raw dictionary."""

    def __init__(self, templates: Mapping[str, str], level: int = 19):
        self.plain = zstandard.ZstdCompressor(level=level)
        self.words = {name: _words(text) for name, text in sorted(templates.items())}
        self.required = {n: self._needed(n) for n in templates}
        self.longest = max(map(len, self.words.values()), default=0)
        self.given = {}
        for name, text in sorted(templates.items()):
            raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(level=level, dict_data=raw)
        self.known: dict[tuple[bytes, int], tuple] = {}

    def _needed(self, name: str) -> set[str]:
        own = license_of(name)
        if name in REQUIRED or name.removesuffix("-header") == own:
            return set(REQUIRED.get(name, REQUIRED.get(own, "")).split())
        # the words of the other wordings that are the license's own
        return set(self.words[name]).difference(*(_words(t.format(id="", name="")) for t in _WORDINGS.values()))

    def best(self, block: bytes, after: int = 0) -> tuple[tuple, int, int]:
        """The template that saves most, both sizes, and the words of it that are missing or added in the block; and
        where its words start and end. They end behind the word number ``after``.

        Templates are ranked by the bytes they save, and all that save any are compared with the block by their wording:
        the one with the fewest differences wins, so that a longer notice that holds a shorter one is told from it, and
        one that comes late in the ranking is not missed. A notice behind a word that denies it is not confirmed.
        """
        if (block, after) in self.known:
            return self.known[block, after]
        size = len(self.plain.compress(block))
        ranked = sorted((len(c.compress(block)), name) for name, c in self.given.items())
        ranked = [r for r in ranked if r[0] < size] or ranked[:1]
        words = _words(block.decode())
        found = []
        for conditional, name in ranked:
            wanted = self.words[name]
            missing, added, start, end = aligned(wanted, words, after)
            share = len(missing) / max(len(wanted), 1)
            bare = self.required[name].intersection(wanted[i] for i in missing)
            denied = start is not None and not DENIALS.isdisjoint(words[max(0, start - DENIED_WORDS) : start])
            sure = share <= MOST_MISSING and conditional < size and not added and not bare and not denied
            outside = len(words) - len(wanted) + len(missing)
            found.append((not sure, share, outside, conditional, name, missing, added, start, end))
        unsure, _, _, conditional, name, missing, added, start, end = min(found)
        lacks = " ".join(self.words[name][i] for i in missing)
        row = (name, size, conditional, size - conditional, len(missing), added, lacks, not unsure)
        if len(self.known) > 50_000:
            self.known.clear()
        self.known[block, after] = row, start, end
        return self.known[block, after]

    def scan(self, text: bytes) -> Iterator[tuple]:
        """For each cue line of a text, or block of a long one, the notice it is part of: its line, the number of the
        block and what ``best`` tells. A notice over several lines is reported once, by the line it starts in."""
        low = text.lower()
        if not any(cue in low for cue in CUES):
            return
        raw = [(number, word) for number, line in enumerate(text.split(b"\n")) for word in line.split()]
        # words as they are compared, without comment marks, and the raw word each is of
        split = [_words(word.decode()) for _, word in raw]
        firsts = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(int)
        owners = np.repeat(np.arange(len(raw)), np.diff(firsts))
        told: tuple[str, int, int] = "", 0, 0
        for number, at, lo, hi in cue_blocks(raw):
            if told[1] <= firsts[lo] and firsts[hi] <= told[2]:
                continue
            block = b" ".join(word for _, word in raw[lo:hi])
            row, start, end = self.best(block)
            start, end, line = firsts[lo] + start, firsts[lo] + end, number
            left, right = max(firsts[lo] - 2 * self.longest, 0), min(firsts[hi] + 2 * self.longest, firsts[-1])
            if right > left:
                window = b" ".join(raw[i][1] for i in np.unique(owners[left:right]))
                left = firsts[owners[left]]
                wide, begin, stop = self.best(window, int(firsts[lo] - left))
                begin, stop = left + begin, left + stop
                longer = not row[-1] or stop - begin > end - start
                if wide[-1] and longer and begin < firsts[hi] and stop > firsts[lo]:
                    if (wide[0], begin, stop) != told:
                        row, start, end, line = wide, begin, stop, raw[owners[begin]][0]
                    else:
                        rest = b" ".join(raw[i][1] for i in range(lo, hi) if firsts[i] < begin or firsts[i + 1] > stop)
                        if not any(cue in rest.lower() for cue in CUES):
                            continue
            if row[-1]:
                told = row[0], start, end
            yield line, at, *row


def cue_blocks(raw: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """Lines with a cue, long ones in overlapping blocks of words that have one: line, block, first and last word."""
    lo = 0
    while lo < len(raw):
        number, hi = raw[lo][0], lo
        while hi < len(raw) and raw[hi][0] == number:
            hi += 1
        for at, start in enumerate(range(lo, max(hi - OVERLAP, lo + 1), BLOCK_WORDS - OVERLAP)):
            end = min(start + BLOCK_WORDS, hi)
            block = b" ".join(word for _, word in raw[start:end]).lower()
            if any(cue in block for cue in CUES):
                yield number, at, start, end
        lo = hi


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each candidate block of each row of ``docs``, with the template that explains it best.

    A block is a line that holds a cue word, and the words around it, over lines and comment marks, by twice the
    longest template. A notice over several lines is one row, with the line it starts in. A block is compressed by zstandard alone and with each template as raw
    dictionary; templates are ranked by the reduction of the size. The winner is compared word by word, in lower case
    and in order: ``n_missing`` words of the template are not in the block, ``n_added`` of the block lie between
    those that are and are not in the template. It is ``confirmed`` if at most a fifth of its words are
    missing, none of ``REQUIRED`` among them, and none added. Lines are numbered from 0.

    Null and empty texts, and texts without a cue, give no rows; null ids stay null; repeated rows and lines are
    reported each; very long lines are cut into blocks of 300 words that overlap by 100. Templates are held by every
    task; they are a fixed list of notices. An empty table gives no rows; other columns are ignored.
    """
    given = dict(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given)
        for batch in batches:
            for part in slices(batch, 1):
                keys, texts = part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()
                rows = [
                    dict(zip(_FIELDS, (key, *row), strict=True))
                    for key, value in zip(keys, texts, strict=True)
                    for row in scanner.scan(value or b"")
                ]
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    columns = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(scan, SCHEMA)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in (part.strip().split(" ") for part in SCHEMA.split(","))])
