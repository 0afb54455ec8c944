"""Licence scans by conditional compression.

Candidate blocks are the lines that hold a cue, with as many words before and after them as the longest template may
take, so that notices wrapped over lines are whole; marks, as of comments, and line ends count for nothing, and blocks that
meet are one. Cues come from the templates: a passage may lack a fixed number of a template's words, so one more than that of them,
the longest, are its cues, and no passage is without one. A block is judged in overlapping windows of words, sized to the templates:
each window is compressed alone and with every template of its size as a zstandard raw-content dictionary, and templates are
ranked by the bytes that knowing them saves. In that order a passage is confirmed by its exact wording: the template's words that it
lacks, and the words that it puts among them, may be at most `max_changed` of the template's. No template is dropped for its rank, as
no least saving can be proved; a passage is compressed once more by itself, and where passages overlap, the one that knowing its template
makes smallest by the most bytes wins.

Defined results: null and empty texts, and blocks that no template wins, give no row; a line gives one row for each licence
that starts on it; equal savings go to the alphabetically first licence; repeated rows are each scanned; a null doc_id is kept; extra
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, model

#: Usual wordings of licence notices.
TEMPLATES = {
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "This work is licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Released under the BSD 3-Clause License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Dedicated to the public domain under CC0 1.0."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "This work is licensed under the GNU General Public License, version 2.", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This work is licensed under the GNU General Public License, version 3.", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is MIT licensed.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["All rights reserved.", "Unauthorized copying of this file, via any medium is strictly prohibited."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
#: How source files name their licence, one more template for each of the names above; names that tell whether later
#: versions may be taken are licences of their own.
SPDX = "SPDX-License-Identifier: {}"
SPDX_VERSIONS = {name: ("only", "or-later") for name in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0")}
_WORD = re.compile(r"\w+(?:\.\w+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def with_identifiers(templates: dict[str, list[str]]) -> dict[str, list[str]]:
    named = {name: [*texts, SPDX.format(name)] for name, texts in templates.items()}
    return named | {f"{name}-{kind}": [SPDX.format(f"{name}-{kind}")] for name, kinds in SPDX_VERSIONS.items() if name in templates for kind in kinds}


def allowed(own: list[str], max_changed: float) -> int:
    """How many words of a template may be missing or put in."""
    return int(max_changed * len(own) + 1e-9)


def cues(templates: dict[str, list[str]], max_changed: float) -> str:
    """A pattern that every confirmed passage holds: of each template the longest words, one more than may be missing."""
    found = set()
    for texts in templates.values():
        for own in map(words, texts):
            found.update(sorted(set(own), key=lambda w: (-len(w), w))[: allowed(own, max_changed) + 1])
    return r"(?iu)(?<!\w)(?:" + "|".join(re.escape(w) for w in sorted(found, key=lambda w: (-len(w), w))) + r")(?!\w)"


def wording(template: list[str], block: list[str]) -> tuple[int, int, list[str], list[str]]:
    """The passage of the block that is nearest to the template: start, end, words of the template that it lacks, and words
    that it has among them. Fewest of both; the first such passage."""
    n, m = len(template), len(block)
    cost = [[0] * (m + 1)]
    for i, word in enumerate(template, 1):
        above, row = cost[-1], [i]
        for j in range(1, m + 1):
            best = min(above[j], row[j - 1]) + 1
            row.append(min(best, above[j - 1]) if block[j - 1] == word else best)
        cost.append(row)
    i, j = n, min(range(m + 1), key=cost[n].__getitem__)
    end, missing, added = j, [], []
    while i:
        if j and template[i - 1] == block[j - 1] and cost[i][j] == cost[i - 1][j - 1]:
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            missing.append(template[i])
        else:
            j -= 1
            added.append(block[j])
    return j, end, missing[::-1], added[::-1]


class Scanner:
    def __init__(self, templates: dict[str, list[str]], max_changed: float, level: int = 9):
        self.classes = defaultdict(list)  # by the words that a passage may have, rounded up to a power of two
        for name, texts in sorted(templates.items()):
            for text in texts:
                own = words(text)
                spare = allowed(own, max_changed)
                data = " ".join(own).encode()
                self.classes[1 << (len(own) + spare - 1).bit_length()].append((name, own, spare, self._tool(level, data)))
        self.alone = self._tool(level)
        self.reach = max(self.classes, default=0)
        self.cue = re.compile(cues(templates, max_changed))

    @staticmethod
    def _tool(level: int, data: bytes | None = None) -> zstandard.ZstdCompressor:
        """A compressor with tables sized to short texts, so that what a call costs is the text's."""
        settings = zstandard.ZstdCompressionParameters.from_level(level, source_size=1024, dict_size=len(data or b""), write_content_size=False, write_checksum=False, write_dict_id=False)
        if data is None:
            return zstandard.ZstdCompressor(compression_params=settings)
        known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)

    def reductions(self, block: list[str], tools: list[zstandard.ZstdCompressor]) -> list[tuple[int, float]]:
        """The bytes by which knowing each template makes the block smaller, and their share."""
        data = " ".join(block).encode("utf-8", "surrogatepass")
        plain = len(self.alone.compress(data))
        return [(saved := plain - len(tool.compress(data)), saved / plain) for tool in tools]

    def confirmed(self, template: list[str], block: list[str], spare: int, at: int) -> Iterator[tuple]:
        """Passages of the block, which starts at word `at`, that keep the template's wording."""
        have = set(block)
        if sum(w in have for w in template) < len(template) - spare:
            return
        start, end, missing, added = wording(template, block)
        if len(missing) + len(added) <= spare:
            yield at + start, at + end, missing, added
            yield from self.confirmed(template, block[:start], spare, at)
            yield from self.confirmed(template, block[end:], spare, at + end)

    def judge(self, own: list[str]) -> list[tuple]:
        """(start, end, licence, saved, changed, missing, added) of the passages that win, best first; places are in words."""
        found = []
        for size, entries in self.classes.items():
            for at in range(0, max(1, len(own) - size), size):  # any passage of `size` words lies in one window
                window = own[at : at + 2 * size]
                ranked = sorted(zip(self.reductions(window, [e[3] for e in entries]), entries, strict=True), key=lambda x: (-x[0][0], x[1][0]))
                for _, (name, template, spare, tool) in ranked:
                    for start, end, missing, added in self.confirmed(template, window, spare, at):
                        saved, share = self.reductions(own[start:end], [tool])[0]
                        found.append((-saved, name, start, end, (len(missing) + len(added)) / len(template), share, missing, added))
        taken, won = bytearray(len(own)), []
        for _, name, start, end, changed, share, missing, added in sorted(found, key=lambda x: x[:5]):
            if not any(taken[start:end]):
                taken[start:end] = b"\1" * (end - start)
                won.append((start, end, name, share, changed, missing, added))
        return won


def passages(text: str, scanner: Scanner) -> list[tuple]:
    """(line_no, licence, saved, changed, missing, added, passage as it stands in the text); line_no is where it starts."""
    places = [m.span() for m in _WORD.finditer(text)]
    starts = [a for a, _ in places]
    ends = [m.start() for m in re.finditer("\n", text)]
    blocks, after = [], 0
    for cue in scanner.cue.finditer(text):
        if cue.start() < after:
            continue  # on the lines of the cue before
        first, last = bisect_left(ends, cue.start()), bisect_left(ends, cue.end())
        after = ends[last] if last < len(ends) else len(text)
        a = max(0, bisect_left(starts, ends[first - 1] if first else 0) - scanner.reach)
        b = bisect_left(starts, after) + scanner.reach
        if blocks and a <= blocks[-1][1]:
            blocks[-1][1] = b
        else:
            blocks.append([a, b])
    rows = {}
    for a, b in blocks:
        near = places[a:b]
        for start, end, name, *rest in scanner.judge([text[x:y].lower() for x, y in near]):
            x, y = near[start][0], near[end - 1][1]
            line_no = bisect_left(ends, x)
            rows.setdefault((line_no, name), (line_no, name, *rest, text[x:y]))
    return list(rows.values())


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, max_changed: float = 0.15) -> DataFrame:
    """(doc_id, line_no, license, saved, changed, missing, added, block): per line and licence that starts on it."""
    templates = with_identifiers(TEMPLATES) if templates is None else templates
    bound_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").rlike(cues(templates, max_changed)))
    types = (pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string())
    names = ["doc_id", "line_no", "license", "saved", "changed", "missing", "added", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model(("licences", hash(str(templates)), max_changed), lambda: Scanner(templates, max_changed))
        for batch in batches:
            rows = [(n, *row) for n, text in enumerate(batch.column(1).to_pylist()) for row in passages(text, scanner)]
            ids, *columns = zip(*rows, strict=True) if rows else [()] * len(names)
            made = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int32())), *made], names)

    return texts.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, line_no int, license string, saved double, changed double, missing array<string>, added array<string>, block string")
