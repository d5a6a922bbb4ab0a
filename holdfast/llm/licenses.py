"""Licence notices in documents, found by conditional compression.

1. Cues (words that every template has one of) mark candidate places; a text without a cue never
   leaves the JVM.  A block is a window around cues, wide enough for the longest template.
2. Each block is compressed with Zstandard alone and with every template, whose words it could hold, as raw
   dictionary.  What a template saves, as a share of what it saves on itself, is its gain; templates are ranked by
   the bytes that they save, and those of next to no gain are no candidates.
3. Candidates are confirmed by exact wording: the template's longest common run of words with the block
   anchors it, and the words missing, added or changed around the anchor are counted.
4. Confirmed stretches are taken out and the rest of the block is compressed again, until no template gains and
   is confirmed.  So a notice beside alike ones, which says nothing new while they are there, gains once they are gone.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The public wording of licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    ("BSD", "Released under the BSD License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Proprietary", "All rights reserved."),
)
CUES = ("licen", "copyright", "rights reserved", "public domain", "permission")

LEVEL = 9
LEAST_GAIN = 0.1
COVERAGE = 0.85
WINDOW = 4096
WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")


@dataclass
class Template:
    name: str
    number: int
    words: list[str]
    counts: Counter[str]
    compressor: zstandard.ZstdCompressor
    own_size: int


def prepare(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    out = []
    for number, (name, text) in enumerate(templates):
        words = [w.lower() for w in WORD.findall(text)]
        body = " ".join(words).encode()
        raw = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        with_dictionary = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
        saved = len(plain.compress(body)) - len(with_dictionary.compress(body))
        out.append(Template(name, number, words, Counter(words), with_dictionary, max(1, saved)))
    return out


def blocks(text: str, cues: re.Pattern, reach: int) -> list[tuple[int, int]]:
    """Windows of at most WINDOW characters (or 4 * reach) around the cues, overlapping by 2 * reach where a stretch is longer."""
    stretches: list[list[int]] = []
    for found in cues.finditer(text):
        low, high = max(0, found.start() - reach), min(len(text), found.end() + reach)
        if stretches and low <= stretches[-1][1]:
            stretches[-1][1] = high
        else:
            stretches.append([low, high])
    most, out = max(WINDOW, 4 * reach), []
    for low, high in stretches:
        while high - low > most:
            out.append((low, low + most))
            low += most - 2 * reach
        out.append((low, high))
    return out


def differences(template: list[str], block: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(first word, last word, matched, missing, added) of every place where the block repeats the template.

    A place is anchored by the longest common run; then the search goes on in the rest of the block.
    """
    out, todo = [], [(0, len(block))]
    while todo:
        low, high = todo.pop()
        matcher = SequenceMatcher(None, template, block[low:high], autojunk=False)
        anchor = matcher.find_longest_match()
        if anchor.size < max(1, min(len(template), 3)):
            continue
        slack = len(template) // 4
        begin = max(low, low + anchor.b - anchor.a - slack)
        end = min(high, low + anchor.b + len(template) - anchor.a + slack)
        runs = [r for r in SequenceMatcher(None, template, block[begin:end], autojunk=False).get_matching_blocks() if r.size]
        matched = sum(r.size for r in runs)
        first, last = begin + runs[0].b, begin + runs[-1].b + runs[-1].size
        if matched >= COVERAGE * len(template):
            out.append((first, last, matched, len(template) - matched, last - first - matched))
            todo += [(low, first), (last, high)]
        else:
            todo += [(low, low + anchor.b), (low + anchor.b + anchor.size, high)]
    return out


def ranked_by_gain(words: list[str], templates: list[Template], plain: zstandard.ZstdCompressor) -> list[tuple[float, Template]]:
    """(gain, template) of the templates that save enough on these words, most bytes first."""
    counts = Counter(words)
    held = [t for t in templates if (t.counts & counts).total() >= COVERAGE * len(t.words)]
    if not held:
        return []
    body = " ".join(words).encode("utf-8", "replace")
    alone = len(plain.compress(body))
    saved = [(alone - len(t.compressor.compress(body)), t) for t in held]
    gains = [(bytes_saved, bytes_saved / t.own_size, t) for bytes_saved, t in saved]
    return [(gain, t) for _, gain, t in sorted(gains, key=lambda g: (-g[0], g[2].number)) if gain >= LEAST_GAIN]


def notices(words: list[str], templates: list[Template], plain: zstandard.ZstdCompressor) -> list[tuple[int, int, int, int, int, float, Template]]:
    """(first word, last word, matched, missing, added, gain, template) of a block, by rounds of compression."""
    out, open_parts = [], [(0, len(words))]
    while open_parts:
        left = [word for low, high in open_parts for word in words[low:high]]
        places = [
            (low + first, low + last, matched, missing, added, gain, template)
            for gain, template in ranked_by_gain(left, templates, plain)
            for low, high in open_parts
            for first, last, matched, missing, added in differences(template.words, words[low:high])
        ]
        taken: list[tuple] = []
        # Of overlapping ones the one with most words, then that of the closest wording, then of the better rank.
        for place in sorted(places, key=lambda p: (-p[2], p[3] + p[4])):
            if all(place[1] <= other[0] or place[0] >= other[1] for other in taken):
                taken.append(place)
        if not taken:
            break
        out += taken
        cuts = sorted((place[0], place[1]) for place in taken)
        parts = []
        for low, high in open_parts:
            for first, last in (cut for cut in cuts if low <= cut[0] and cut[1] <= high):
                parts.append((low, first))
                low = last
            parts.append((low, high))
        open_parts = [(low, high) for low, high in parts if high > low]
    return out


def scan_text(text: str, templates: list[Template], cues: re.Pattern, plain: zstandard.ZstdCompressor, reach: int) -> list[dict]:
    """The licence notices of one text, by place; of overlapping ones the one with most words stays."""
    found: dict[tuple[int, int, int], dict] = {}
    for low, high in blocks(text, cues, reach):
        spans = [(m.start() + low, m.end() + low) for m in WORD.finditer(text[low:high])]
        words = [text[a:b].lower() for a, b in spans]
        for first, last, matched, missing, added, gain, template in notices(words, templates, plain):
            row = {"license": template.name, "template": template.number, "begin": spans[first][0], "end": spans[last - 1][1]}
            row |= {"matched_words": matched, "missing_words": missing, "added_words": added, "gain": round(gain, 6)}
            at = (template.number, row["begin"], row["end"])
            if at not in found or found[at]["gain"] < row["gain"]:
                found[at] = row
    taken: list[dict] = []
    for row in sorted(found.values(), key=lambda r: (-r["matched_words"], r["missing_words"] + r["added_words"], r["begin"], r["template"])):
        if all(row["end"] <= other["begin"] or row["begin"] >= other["end"] for other in taken):
            taken.append(row)
    return sorted(taken, key=lambda r: r["begin"])


ROW = "license string, template int, begin int, end int, matched_words int, missing_words int, added_words int, gain double"


def find_licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, cues: tuple[str, ...] = CUES
) -> DataFrame:
    """(doc_id, license, template, begin, end, matched_words, missing_words, added_words, gain), a row per notice.

    begin and end are code points; template is the number in `templates`, each of which must hold a
    cue.  A notice must repeat 85 % of the template's words.  Texts of any length are scanned whole.
    Null or empty texts, texts without a notice and empty tables give no rows; null ids and repeated
    rows are scanned like others.  Only the two named columns are read.
    """
    # Cues are looked for in a JVM filter and again in Python: ASCII letters of either case.
    pattern = "(?i)" + "|".join(re.escape(cue).replace(r"\\ ", r"\\s+").replace("\\ ", r"\s+") for cue in cues)
    for _, text in templates:
        if not re.search(pattern, text):
            raise ValueError(f"no cue in template: {text[:60]}")
    reach = max(len(text) for _, text in templates) * 5 // 4
    kinds = pa.schema(
        [("license", pa.string()), *((n, pa.int32()) for n in ("template", "begin", "end", "matched_words", "missing_words", "added_words")), ("gain", pa.float64())]
    )

    def run(batches):
        ready, cue = prepare(templates), re.compile(pattern)
        plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        for batch in batches:
            ids, rows = [], []
            for key, text in zip(batch.column(0), batch.column(1)):
                own = scan_text(text.as_py(), ready, cue, plain, reach)
                ids += [key] * len(own)
                rows += own
            table = pa.RecordBatch.from_pylist(rows, kinds)
            yield pa.RecordBatch.from_arrays([pa.array([k.as_py() for k in ids], batch.schema.field(0).type), *table.columns], names=["doc_id", *kinds.names])

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return rows.where(F.col("text").rlike(pattern)).mapInArrow(run, f"doc_id bigint, {ROW}")
