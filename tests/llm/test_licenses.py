"""License scans: wordings, denials, and the winner against all templates compared in full."""

import random

import pytest
import zstandard

from metaloom.llm.license_scan import MOST_MISSING, TEMPLATES, Scanner, _words, license_of, scan_licenses


@pytest.fixture(scope="module")
def scanner():
    return Scanner(TEMPLATES)


def confirmed(scanner, text):
    return [license_of(r[2]).removesuffix("-notice") for r in scanner.scan(text.encode()) if r[-1]]


@pytest.mark.parametrize(
    "text, license",
    [
        ("This file is licensed under the MIT License.", "MIT"),
        ("// SPDX-License-Identifier: MIT", "MIT"),
        ("License: Apache-2.0", "Apache-2.0"),
        ("Distributed under the terms of the BSD 3-Clause License.", "BSD-3-Clause"),
        ("# Released under the MIT License.", "MIT"),
        ("SPDX-License-Identifier: GPL-3.0", "GPL-3.0"),
        ("This file is licensed under the Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ],
)
def test_wordings(scanner, text, license):
    assert confirmed(scanner, text) == [license]
    assert confirmed(scanner, f"some words before\n{text}\nand after") == [license]


@pytest.mark.parametrize(
    "text",
    [
        "Not released under the MIT License.",
        "This is not licensed under the Apache License, Version 2.0.",
        "Released under the BSD License.",
        "Released under the GPL License.",
        "Licensed under the Apache License, Version 1.1.",
        "License: unknown",
        "SPDX-License-Identifier: LicenseRef-Mine",
        "a licence to sing, and permission to dance",
    ],
)
def test_not_confirmed(scanner, text):
    assert confirmed(scanner, text) == []


def fewest_missing(wanted, words):
    """Words of a template that are not in a block, in order: the longest common subsequence, plainly."""
    rows = [0] * (len(words) + 1)
    for word in wanted:
        before = 0
        for j, own in enumerate(words):
            before, rows[j + 1] = rows[j + 1], max(rows[j + 1], rows[j], before + (own == word))
    return len(wanted) - rows[-1]


def test_every_template_that_saves_bytes_is_compared(scanner):
    """A notice in a block of its own wins over all templates, whatever their rank by size."""
    rng = random.Random(4)
    for name, text in TEMPLATES.items():
        filler = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randrange(12)))
        block = f"{filler} {text}".encode()
        row = scanner.best(block)[0]
        words = _words(block.decode())
        size = len(scanner.plain.compress(block))
        assert row[1] == size and row[2] == len(
            zstandard.ZstdCompressor(
                level=19, dict_data=zstandard.ZstdCompressionDict(TEMPLATES[row[0]].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            ).compress(block)
        )
        assert row[-1] and fewest_missing(_words(TEMPLATES[row[0]]), words) == row[4] == 0
        assert set(_words(text)) >= set(_words(TEMPLATES[row[0]])) and row[4] <= MOST_MISSING * len(_words(text))


def test_edges(spark):
    rows = [(None, "License: MIT", 1), (1, None, 2), (2, "", 3), (3, "License: MIT\nLicense: MIT", 4), (3, "License: MIT", 4)]
    rows += [(4, "word " * 100_000 + "\nLicense: ISC\n" + "x" * 1_000_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = sorted((r.doc_id or 0, r.line, r.license) for r in scan_licenses(df).collect() if r.confirmed)
    assert got == [(0, 0, "MIT-field"), (3, 0, "MIT-field"), (3, 0, "MIT-field"), (3, 1, "MIT-field"), (4, 1, "ISC-field")]
