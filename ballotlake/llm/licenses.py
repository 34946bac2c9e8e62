"""Operator 2: license scans by conditional compression and wording.

A statement is a sentence or line that reads like a template, or a passage
of any lines that holds one: comment marks are taken off, wrapped lines are
read as one sequence of words, and a template is aligned with the best part
of the words around each license word. Every candidate is compressed with
each template as zstandard raw dictionary, the templates are ranked by the
reduction in size, and the exact differences in wording confirm them in that
order. The ranking cuts nothing: only lengths and distinct words, which
bound the differences from below, rule a template out.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Common license statements (license, statement).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("proprietary", "All rights reserved."),
    # Titles.
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("ISC", "ISC License"),
    # Paragraphs of whole texts and file headers.
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:"""),
    ("MIT", """The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software."""),
    ("MIT", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    *[(name, f"""{what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU
{kind} Public License as published by the Free Software Foundation{mark2} either version {v} of the License, or (at your
option) any later version. {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more
details.""") for name, what, kind, v, mark, mark2 in [
        ("GPL-3.0", "This program", "General", "3", ":", ","), ("GPL-2.0", "This program", "General", "2", ";", ";"),
        ("LGPL-3.0", "This library", "Lesser General", "3", ":", ","),
        ("AGPL-3.0", "This program", "Affero General", "3", ":", ",")]],
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
]

CUE = r"(?i)licen[cs]e|copyright|rights reserved|creative commons|permission is|redistribut"
#: Blocks end at line ends and between a sentence and a capital letter.
SENTENCE = re.compile(r"\n+|(?<=[.!?])[ \t]+(?=[^\W\d_])")
_CUE = re.compile(CUE)
_WORD = re.compile(r"[\w.+-]*\w")
#: Comment marks at line starts and ends.
_MARK = re.compile(r"^[ \t]*(?:/\*+|\*+/|\*+|//+!?|#+|;+|--+|<!--+|%+|!+|dnl\b|rem\b)[ \t]*|[ \t]*(?:\*+/|--+>|\*+)[ \t]*$",
                   re.M | re.I)
#: Templates of this many words are also looked for inside longer and
#: wrapped passages.
PASSAGE_WORDS = 12
#: Scores of this many distinct blocks are held in a task.
HELD = 50_000


def wording(template: str, block: str) -> tuple[int, int]:
    """(words inserted, deleted or replaced; words of the longer side)."""
    a, b = _WORD.findall(template.lower()), _WORD.findall(block.lower())
    ops = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    return sum(max(j - i, n - m) for tag, i, j, m, n in ops if tag != "equal"), max(len(a), len(b))


def blocks_of(text: str) -> list[tuple[int, int]]:
    """(start, end) of the blocks: lines, and sentences that a capital
    letter follows."""
    out, at = [], 0
    for m in SENTENCE.finditer(text):
        if m.group()[0] != "\n" and not text[m.end()].isupper():
            continue
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, len(text))]


def aligned(template: list[str], text: list[str]) -> tuple[int, int, int, int] | None:
    """(words that differ, words of the longer side, start, end) of the part
    of ``text`` that reads most like ``template``; words before and after
    that part are free."""
    m = difflib.SequenceMatcher(None, template, text, autojunk=False)
    hit = m.find_longest_match()
    if not hit.size:
        return None
    # The part lies around the longest match; text further off is of no use.
    room = len(template) // 2
    lo, hi = max(0, hit.b - hit.a - room), min(len(text), hit.b - hit.a + len(template) + room)
    part = text[lo:hi]
    ops = difflib.SequenceMatcher(None, template, part, autojunk=False).get_opcodes()
    same = [o for o in ops if o[0] == "equal"]
    if not same:
        return None
    # Pieces of the ends that agree by chance only widen the part.
    best = None
    for x in range(min(4, len(same))):
        for y in range(max(x, len(same) - 4), len(same)):
            first, last = same[x], same[y]
            diff = first[1] + len(template) - last[2]
            diff += sum(max(j - i, n - k) for tag, i, j, k, n in ops if tag != "equal" and i >= first[2] and j <= last[1])
            longer = max(len(template), last[4] - first[3])
            found = (diff / longer, diff, longer, lo + first[3], lo + last[4])
            best = min(best, found) if best else found
    return best[1:]


class _Scan:
    """The license statements of texts."""

    def __init__(self, templates: list[tuple[str, str]], most: float):
        self.templates, self.most = templates, most
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.primed = [zstandard.ZstdCompressor(level=3, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
            t.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, t in templates]
        self.words = [_WORD.findall(t.lower()) for _, t in templates]
        self.sets = [set(w) for w in self.words]
        self.long = [i for i, w in enumerate(self.words) if len(w) >= PASSAGE_WORDS]
        self.held: dict = {}

    def ranked(self, block: str, among: Iterable[int]) -> list[tuple[float, int]]:
        """(reduction, template) of the block under each template, the
        largest reduction first, ties by order."""
        raw = block.lower().encode()
        alone = len(self.plain.compress(raw))
        return sorted(((1 - len(self.primed[i].compress(raw)) / alone, i) for i in among), key=lambda r: (-r[0], r[1]))

    def block(self, block: str):
        """(share, -reduction, template, differences, words) of the template
        the whole block reads most like, of those that reduce it."""
        if block not in self.held:
            if len(self.held) >= HELD:
                self.held.clear()
            w = _WORD.findall(block.lower())
            n, own, best = len(w), set(w), None
            for gain, i in self.ranked(block, range(len(self.templates))):
                if gain <= 0:
                    break
                t = self.words[i]
                longer = max(n, len(t))
                # Lengths or distinct words alone may rule the wording out, or leave no way to read more alike.
                least = max(abs(n - len(t)), len(self.sets[i] - own))
                if least > self.most * longer or best and least / longer >= best[0]:
                    continue
                diff, longer = wording(self.templates[i][1], block)
                if diff <= self.most * longer and (not best or diff / longer < best[0]):
                    best = (diff / longer, -gain, i, diff, longer)
            self.held[block] = best
        return self.held[block]

    def passages(self, words: list[str], cues: list[int]):
        """(template, differences, words, start, end) of templates inside
        ``words`` near the words ``cues``: the words around a cue are
        compressed with each template, then aligned in order of reduction."""
        reach = {i: int(len(self.words[i]) / (1 - self.most)) + 1 for i in self.long}
        done = dict.fromkeys(self.long, 0)
        for c in cues:
            among = [i for i in self.long if c >= done[i]]
            far = max((reach[i] for i in among), default=0)
            for _, i in self.ranked(" ".join(words[max(0, c - far):c + far + 1]), among):
                todo = [(max(done[i], c - reach[i]), min(len(words), c + reach[i] + 1))]
                while todo:
                    lo, hi = todo.pop()
                    part = words[lo:hi]
                    if len(self.sets[i].difference(part)) > self.most * reach[i]:
                        continue
                    found = aligned(self.words[i], part)
                    if found and found[0] <= self.most * found[1]:
                        diff, longer, x, y = found
                        yield i, diff, longer, lo + x, lo + y
                        done[i] = max(done[i], lo + y)
                        todo += [(lo, lo + x), (lo + y, hi)]

    def statements(self, text: str) -> list[tuple]:
        """(block_no, license, reduction, n_diff, n_words), one per block."""
        blocks = blocks_of(text)
        clean = _MARK.sub(lambda m: " " * len(m.group()), text)
        at = list(_WORD.finditer(clean.lower() if len(clean.lower()) == len(clean) else clean))
        words = [m.group().lower() for m in at]
        starts = [m.start() for m in at]
        found = []  # (words that agree, -share, reduction, -template, first word, end word, ...)
        for no, (x, y) in enumerate(blocks):
            if _CUE.search(text, x, y) and (hit := self.block(clean[x:y].strip())):
                share, less, i, diff, longer = hit
                found.append((longer - diff, -share, -less, -i, bisect_left(starts, x), bisect_left(starts, y), no, diff, longer))
        cues = sorted({max(0, bisect_right(starts, m.start()) - 1) for m in _CUE.finditer(clean)}) if words else []
        for i, diff, longer, x, y in self.passages(words, cues):
            no = bisect_right(blocks, (starts[x], len(text))) - 1
            gain = self.ranked(" ".join(words[x:y]), [i])[0][0]
            if gain > 0:
                found.append((longer - diff, -diff / longer, gain, -i, x, y, no, diff, longer))
        # Of statements that overlap the one with most words in common stays, and one per block.
        out, taken, used = [], [], set()
        for _, _, gain, i, x, y, no, diff, longer in sorted(found, reverse=True):
            k = bisect_left(taken, (x, y))
            if no in used or (k and taken[k - 1][1] > x) or (k < len(taken) and taken[k][0] < y):
                continue
            taken.insert(k, (x, y))
            used.add(no)
            out.append((no, self.templates[-i][0], gain, diff, longer))
        return out


def _scan(templates: list[tuple[str, str]], most: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = _Scan(templates, most)
        for pdf in batches:
            rows = [(i, *hit) for i, t in zip(pdf["doc_id"].tolist(), pdf["text"]) for hit in scan.statements(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "block_no", "license", "reduction", "n_diff", "n_words"], dtype=object)

    return run


def license_blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   templates: list[tuple[str, str]] | None = None, most_different: float = 0.25) -> DataFrame:
    """``doc_id, block_no, license, reduction, n_diff, n_words, exact`` of
    every statement of a license, at most one row per block.

    A block is a sentence (cut at line ends too). A statement is a block
    with a license word of whose words, against a template that reduces its
    compressed size, at most ``most_different`` differ (templates are
    confirmed by falling reduction; the least different wins, ties by
    reduction, then by order), or a passage that a template of
    ``PASSAGE_WORDS`` words or more is aligned with in the same measure; it
    may run over many lines, start inside one and go on after it, and
    belongs to the block it starts in. Of statements that overlap or start
    in one block, the one with most words in common is reported.

    Null, empty or plain texts: no rows. Repeated rows: rows of their own.
    Null ids are kept. No rows: none. Extra columns are ignored and may have
    any name. Whole texts are read; blocks of any length are scored. No
    shuffle.
    """
    some = docs.where(F.col(text).rlike(CUE)).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([some.schema["doc_id"], *(T.StructField(c, t) for c, t in [
        ("block_no", T.LongType()), ("license", T.StringType()), ("reduction", T.DoubleType()), ("n_diff", T.LongType()),
        ("n_words", T.LongType())])])
    # Ids go through Python as text, so that nulls don't turn them into floats.
    out = some.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        _scan(templates or TEMPLATES, most_different), T.StructType([T.StructField("doc_id", T.StringType()), *schema[1:]]))
    return out.select(F.col("doc_id").cast(schema["doc_id"].dataType).alias("doc_id"), "block_no", "license", "reduction",
                      "n_diff", "n_words", (F.col("n_diff") == 0).alias("exact"))
