"""License scan by conditional compression.

Lines with a word that license statements use are candidates; neighbouring candidate lines
make a block. A block is compressed alone and with each license template as raw zstandard
dictionary. The templates that save most are the winners of the block, and each winner is
confirmed, or not, by the exact differences of its wording from the block's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common

WINNERS = 4  # templates confirmed by wording
LEAST_SAVED = 0.2  # share of the block's own size that a winner must save
MAX_CHANGED = 0.15  # words of a template that may be missing or changed
MAX_BLOCK = 4_000  # words compared at once; longer blocks are compared in overlapping pieces

# Words of which a license statement has at least one.
CUES = "licen[sc]|copyright|copyleft|\\(c\\)|©|spdx|creative commons|public domain|all rights reserved|permission is hereby|redistribution|warrant(y|ies)|mozilla|apache|gnu "

# Wordings of licenses, by identifier.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
        "SPDX-License-Identifier: MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied.""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version.""",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer.""",
    ],
    "MPL-2.0": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has dedicated all copyright to the public domain worldwide under CC0 1.0."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this work may be reproduced without permission."],
}

_CUE = re.compile(CUES, re.IGNORECASE)
_WORD = re.compile(r"[\w.+-]*\w")
Found = tuple[str, int, int, float, str]


def wording(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Templates:
    """All wordings with their words and compressors; made once per task."""

    def __init__(self, templates: dict[str, list[str]]):
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.known = []
        for name, texts in templates.items():
            for text in texts:
                flat = " ".join(text.lower().split())
                d = zstandard.ZstdCompressionDict(flat.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                z = zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False)
                self.known.append((name, wording(text), z))

    def ranked(self, block: str) -> list[tuple[float, str, list[str]]]:
        """``share saved, license, words`` of the templates that save most on ``block``."""
        data = " ".join(block.lower().split()).encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(data))
        saved = [((alone - len(z.compress(data))) / alone, name, w) for name, w, z in self.known]
        best = sorted(saved, key=lambda x: (-x[0], x[1], len(x[2])))
        return [x for x in best[:WINNERS] if x[0] >= LEAST_SAVED]


def differences(template: list[str], block: list[str]) -> tuple[int, list[str]]:
    """Words of the template that the block lacks or changes, and the differences within
    the part of the block that the template covers."""
    ops = SequenceMatcher(None, template, block, autojunk=False).get_opcodes()
    same = [k for k, op in enumerate(ops) if op[0] == "equal"]
    if not same:
        return len(template), []
    lost, words = 0, []
    for k, (op, a, b, c, d) in enumerate(ops):
        if op == "equal":
            continue
        lost += b - a
        inner = same[0] < k < same[-1]
        words += [f"-{x}" for x in template[a:b]] + ([f"+{x}" for x in block[c:d]] if inner else [])
    return lost, words


def _pieces(words: list[str]) -> Iterator[list[str]]:
    if len(words) <= MAX_BLOCK:
        yield words
        return
    for at in range(0, len(words), MAX_BLOCK // 2):
        yield words[at : at + MAX_BLOCK]


def scan_block(block: str, templates: Templates) -> tuple[str, float, str] | None:
    """``license, share saved, differences`` of the winner whose wording differs least."""
    own = wording(block)
    best = None
    for saved, name, words in templates.ranked(block):
        for piece in _pieces(own):
            lost, diff = differences(words, piece)
            inside = sum(x[0] == "+" for x in diff)
            rank = (lost + inside, -len(words), name)
            if lost <= MAX_CHANGED * len(words) and inside <= max(1, MAX_CHANGED * len(words)) and (best is None or rank < best[0]):
                best = (rank, (name, saved, " ".join(diff)))
    return best and best[1]


def blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """``first line, last line, block``: runs of lines with a cue; long lines stay whole."""
    held, first = [], 0
    lines = text.split("\n")
    for k, line in enumerate([*lines, ""]):
        if k < len(lines) and _CUE.search(line):
            if not held:
                first = k
            held.append(line)
        elif held:
            # Each line of a block can be a statement of its own.
            yield first, k - 1, "\n".join(held)
            held = []


def scan(text: str, templates: Templates) -> tuple[int, list[Found]]:
    """Number of candidate blocks, and for each confirmed one ``license, first line, last
    line, share saved, differences``. A block that fits no wording as a whole is scanned
    line by line."""
    n, found = 0, []
    for first, last, block in blocks(text):
        n += 1
        whole = scan_block(block, templates)
        lines = [(first, last, block)] if whole or first == last else [(first + k, first + k, x) for k, x in enumerate(block.split("\n"))]
        if last > first and whole and len(wording(block)) > 2 * len(wording(" ".join(block.split("\n")[:1]))):
            # Several statements under one winner: each line is heard, too.
            single = [(first + k, scan_block(x, templates)) for k, x in enumerate(block.split("\n"))]
            if len({x[0] for _, x in single if x}) > 1:
                lines, whole = [(k, k, block.split("\n")[k - first]) for k, _ in single], None
        for a, b, part in lines:
            hit = whole or scan_block(part, templates)
            if hit:
                found.append((hit[0], a, b, hit[1], hit[2]))
    return n, found


_OUT = "doc_id long, n_blocks long, licenses string, details string"


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    templates = _made()
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            n, found = scan(text, templates) if text else (0, [])
            details = "; ".join(f"{a}-{b} {name} {saved:.2f} [{diff}]" for name, a, b, saved, diff in found)
            rows.append((n, ",".join(sorted({x[0] for x in found})), details))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([r[2] for r in rows], pa.string()),
            ],
            names=["doc_id", "n_blocks", "licenses", "details"],
        )


@cache
def _made() -> Templates:
    return Templates(TEMPLATES)


def scan_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_blocks, licenses, details`` per row of ``docs (doc_id, text)``.

    ``licenses`` lists the confirmed licenses in order, comma-joined; ``details`` has lines,
    share saved and the wording differences of each. Null texts and texts without a cue
    have no block. Repeated rows get equal results; an empty table gives an empty table;
    other columns are ignored.
    """
    # Texts without a cue are settled in the JVM and never reach Python.
    cued = F.when(F.col("text").rlike("(?i)" + CUES), F.col("text"))
    return docs.select("doc_id", cued.alias("text")).mapInArrow(_run, _OUT)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(common.table(spark, sf_dir, "documents"))
