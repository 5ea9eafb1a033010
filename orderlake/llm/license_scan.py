"""License scan: winnowed fingerprints find candidates, banded alignment measures them.

Texts and templates are read as words (runs of ASCII letters, digits and bytes above 127, lower case). Hashes of three
words in a row are winnowed: of each two neighbours the smaller one counts. An inverted index of the templates'
fingerprints picks, per text, the template and the diagonal to align. The alignment runs in a band around the
diagonal and reports how much of the template is matched, and where.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import _arrays
from orderlake.llm._arrays import U64, lower_ascii, rolling, row_slices, text_buffer, word_hashes

GRAM, WINNOW = 3, 2
class Exact(str):
    """A notice that a word between its own turns into another license's."""


# ---------------------------------------------------------------------------
# Wording of widely used licenses and of their notices.
# ---------------------------------------------------------------------------
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
    'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
    "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
    "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
    "the License for the specific language governing permissions and limitations under the License."
)
_GNU = (
    "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} as published by the Free Software "
    "Foundation{3} either version {4} of the License, or (at your option) any later version. This {0} is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {2} for "
    "more details."
)
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
    "You can obtain one at http://mozilla.org/MPL/2.0/."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
    "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software "
    "to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We "
    "intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
)
_WORDINGS = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", _MIT),
    "ISC": ("Released under the ISC License.", "Licensed under the ISC License.", _ISC),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", _APACHE),
    "GPL-3.0": (f"This work is licensed under the GNU {_GPL}, version 3.", _GNU.format("program", ":", _GPL, ",", 3)),
    "GPL-2.0": (f"This work is licensed under the GNU {_GPL}, version 2.", _GNU.format("program", ";", _GPL, ";", 2)),
    "LGPL-3.0": (f"This work is licensed under the GNU {_LGPL}, version 3.", _GNU.format("library", ":", _LGPL, ",", 3)),
    "LGPL-2.1": (f"This work is licensed under the GNU {_LGPL}, version 2.1.", _GNU.format("library", ";", _LGPL, ";", 2.1)),
    "AGPL-3.0": (f"This work is licensed under the GNU {_AGPL}, version 3.", _GNU.format("program", ":", _AGPL, ",", 3)),
    "BSD-2-Clause": (f"{_BSD_TERMS} {_BSD_WARRANTY}",),
    "BSD-3-Clause": (f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_WARRANTY}", _BSD_NAMES.removeprefix("3. ")),
    "MPL-2.0": (_MPL, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Unlicense": (_UNLICENSE, "This is free and unencumbered software released into the public domain."),
    "CC-BY-4.0": (Exact("Licensed under CC BY 4.0."), "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": (Exact("Licensed under CC BY-SA 4.0."), "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": (Exact("Licensed under CC BY-NC 4.0."), "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
}
#: Each license with its identifier line.
TEMPLATES = {name: (*texts, Exact(f"SPDX-License-Identifier: {name}")) for name, texts in _WORDINGS.items()}
#: A shorter template tells licenses apart by single words: all of its words must match.
WHOLE_BELOW = 16
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def scan_words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, row and hash of each word; ``raw`` is lower case."""
    solid = np.where(_BREAK[raw], np.uint8(32), np.uint8(65)) if len(raw) else raw
    start, end, row = _arrays.words_of(solid, offs)
    return start, end, row, word_hashes(raw, start, end)


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the smaller of each WINNOW neighbours, the last of equals."""
    n = len(grams)
    if n < WINNOW:
        return np.arange(n)
    rows = np.lib.stride_tricks.sliding_window_view(grams, WINNOW)
    return np.unique(np.arange(n - WINNOW + 1) + WINNOW - 1 - np.argmin(rows[:, ::-1], axis=1))


@dataclass
class Index:
    """Inverted index of template fingerprints: sorted hashes with template and place."""

    names: list[str]
    words: list[np.ndarray]
    exact: list[bool]
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray


def build_index(templates: dict[str, tuple[str, ...]]) -> Index:
    names, words, exact, prints, owner, place = [], [], [], [], [], []
    for name, texts in templates.items():
        for text in texts:
            raw, offs = text_buffer(pa.array([text]))
            h = scan_words(lower_ascii(raw), offs)[3]
            if len(h) < GRAM:
                raise ValueError(f"a template needs at least {GRAM} words: {text!r}")
            grams = rolling(h, GRAM)
            at = winnow(grams)
            prints.append(grams[at])
            owner.append(np.full(len(at), len(names)))
            place.append(at)
            names.append(name)
            words.append(h)
            exact.append(isinstance(text, Exact))
    p, t, a = np.concatenate(prints), np.concatenate(owner), np.concatenate(place)
    o = np.argsort(p, kind="stable")
    return Index(names, words, exact, p[o], t[o], a[o])


def _common(text: np.ndarray, template: np.ndarray, offset: np.ndarray, band: int) -> tuple[int, int, int]:
    """Longest common subsequence inside the band: its length, and the first and last place of one that ends first."""
    m, n = len(template), len(text)
    best = np.zeros((m + 1, n + 1), np.int32)
    for i, word in enumerate(template):
        hit = (text == word) & (np.abs(offset - i) <= band)
        np.maximum.accumulate(np.maximum(best[i, 1:], np.where(hit, best[i, :-1] + 1, 0)), out=best[i + 1, 1:])
    matched = int(best[m, n])
    i, j, places = m, n, []
    while best[i, j]:
        if best[i, j] == best[i, j - 1]:
            j -= 1
        elif best[i, j] == best[i - 1, j]:
            i -= 1
        else:
            i, j = i - 1, j - 1
            places.append(j)
    return matched, places[-1] if places else 0, places[0] if places else 0


def align(text: np.ndarray, template: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Banded longest common subsequence: matched words, and the first and last matched place in the text.

    A text place minus its template place stays within ``band`` of ``diagonal``. Of equally long
    matches those that end first count, and of these the one that begins last.
    """
    m = len(template)
    base = max(0, diagonal - band)
    window = text[base : max(base, diagonal + m + band)]
    offset = np.arange(len(window)) + base - diagonal
    matched, _, last = _common(window, template, offset, band)
    if not matched:
        return 0, 0, 0
    # Backwards from that end, the match that ends first is the one that begins last.
    back, _, first = _common(window[last::-1], template[::-1], (m - 1 - offset)[last::-1], band)
    return matched, base + last - (first if back == matched else last), base + last


def scan_text(h: np.ndarray, index: Index, least: float) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first and last text word) of the matches in a text, none overlapping."""
    if len(h) < GRAM:
        return []
    grams = rolling(h, GRAM)
    at = winnow(grams)
    lo, hi = (np.searchsorted(index.prints, grams[at], side) for side in ("left", "right"))
    hits = sorted({(int(index.template[k]), int(p - index.place[k])) for p, x, y in zip(at, lo, hi) if y > x for k in range(x, y)})
    found = []
    before: tuple[int, int] | None = None
    for template, diagonal in hits:
        words = index.words[template]
        band = max(2, len(words) // 8)
        # Hits on near diagonals belong to one alignment.
        if before is not None and before[0] == template and diagonal - before[1] <= band // 2:
            continue
        before = (template, diagonal)
        matched, first, last = align(h, words, diagonal, band)
        share = matched / max(len(words), last - first + 1)
        if share < (1 if index.exact[template] else least):
            continue
        if matched == len(words) or len(words) >= WHOLE_BELOW:
            found.append((-share * matched, -share, first, last, matched, template))
    taken: list[tuple[int, int]] = []
    out = []
    for _, _, first, last, matched, template in sorted(found):
        k = bisect_left(taken, (first, last))
        if (k and taken[k - 1][1] >= first) or (k < len(taken) and taken[k][0] <= last):
            continue
        taken.insert(k, (first, last))
        out.append((template, matched, first, last))
    return sorted(out, key=lambda x: x[2])


_FOUND = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("template", pa.int32()), ("matched_words", pa.int32()), ("template_words", pa.int32()),
                    ("span_words", pa.int32()), ("start_byte", pa.int64()), ("end_byte", pa.int64())])


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """License notices in whole texts: a row per match.

    Returns doc_id, license, template (its number), matched_words, template_words, span_words, coverage (matched share of the
    template) and the matched UTF-8 byte range (end exclusive). A match counts if its words are at least ``least`` of the longer of
    template and span; a template of fewer than WHOLE_BELOW words must match with all of them,
    an exact one without others between. Of overlapping matches the one with more matched words, weighed by their share, is reported; of equal
    ones that with the larger share, then the earlier. Null, empty and other texts without a notice give no row, nor does an empty table. Texts of
    any length are read whole. Rows with a null or repeated doc_id are scanned each for itself. Other columns are ignored.
    """
    index = build_index(templates)

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows, base = [], 0
            for texts in row_slices(part["text"]):
                raw, offs = text_buffer(texts)
                start, end, row, h = scan_words(lower_ascii(raw), offs)
                cuts = np.searchsorted(row, np.arange(len(texts) + 1))
                # Only texts with an indexed fingerprint are looked at one by one.
                if len(h) >= GRAM:
                    grams = rolling(h, GRAM)
                    near = np.minimum(np.searchsorted(index.prints, grams), len(index.prints) - 1)
                    for i in np.unique(row[np.flatnonzero(index.prints[near] == grams)]).tolist():
                        a, b = cuts[i], cuts[i + 1]
                        for t, matched, first, last in scan_text(h[a:b], index, least):
                            rows.append((part["doc_id"][base + i].as_py(), index.names[t], t, matched, len(index.words[t]), last - first + 1,
                                         int(start[a + first] - offs[i]), int(end[a + last] - offs[i])))
                base += len(texts)
            columns = list(zip(*rows)) or [()] * len(_FOUND)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    keyed = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "COALESCE(text, '') AS text")
    return keyed.mapInArrow(
        apply,
        "doc_id long, license string, template int, matched_words int, template_words int, span_words int, start_byte long, end_byte long",
    ).withColumn("coverage", F.col("matched_words") / F.col("template_words"))
