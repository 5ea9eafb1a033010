"""License templates: verbatim, damaged, look-alikes; banded alignment against an unbanded one."""

import random
from collections import Counter

import numpy as np
import pytest

from orderlake.llm import license_scan as L


def _lcs(text, template):
    """Words in common, the first end of such a match, and the last start for that end, by trying all spans."""
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    best = length(text, template)
    end = next((e for e in range(len(text) + 1) if length(text[:e], template) == best), 0)
    start = max((s for s in range(end) if length(text[s:end], template) == best), default=0)
    return best, start, end - 1


def test_alignment_equals_an_unbanded_one():
    rng = random.Random(1)
    for _ in range(400):
        template = [rng.randrange(6) for _ in range(rng.randint(3, 9))]
        text = [rng.randrange(7) for _ in range(rng.randint(0, 4))]
        text += [w for w in template if rng.random() > 0.2 for _ in range(1 + (rng.random() < 0.1))] + [rng.randrange(7) for _ in range(3)]
        got = L.align(np.array(text), np.array(template), 0, len(text) + len(template))
        want = _lcs(text, template)
        assert got[0] == want[0] and (not want[0] or got[1:] == want[1:]), (text, template)


def _found(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return L.scan(frame).collect()


def test_every_template_is_found_verbatim_and_names_its_license(spark):
    cases = [(name, t) for name, texts in L.TEMPLATES.items() for t in texts]
    got = _found(spark, [f"Erinand thouti. {t} Onheorre thin." for _, t in cases])
    best = {r.doc_id: r for r in got}
    assert len(got) == len(cases)
    for i, (name, t) in enumerate(cases):
        r = best[i]
        assert (r.license, r.coverage) == (name, 1.0), t[:60]
        words = f"Erinand thouti. {t} Onheorre thin.".encode()[r.start_byte : r.end_byte].decode()
        assert words.rstrip(".") == t.rstrip("./").replace("/.", "") or words in t


def test_long_templates_survive_changes_and_short_ones_need_all_words(spark):
    rng = random.Random(2)
    damaged = []
    for text in (L._MIT, L._ISC, L._APACHE, L._UNLICENSE):
        words = text.split()
        for at in rng.sample(range(5, len(words) - 5), len(words) // 12):
            words[at] = rng.choice(["thing", "other", ""])
        damaged.append(" ".join(words))
    got = _found(spark, damaged)
    assert [r.license for r in sorted(got, key=lambda r: r.doc_id)] == ["MIT", "ISC", "Apache-2.0", "Unlicense"]
    assert all(0.8 <= r.coverage < 1 for r in got)
    # Other licenses that differ in a word, or in a version.
    assert _found(spark, ["SPDX-License-Identifier: CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0", "Licensed under the Apache License, Version 3.0", "under the GNU General"]) == []
    half = L._MIT[: len(L._MIT) // 2]
    assert _found(spark, [half]) == []


def test_relatives_are_told_apart(spark):
    lines = [f"This work is licensed under the GNU {kind}General Public License, version {v}." for kind in ("", "Lesser ", "Affero ") for v in ("3",)]
    assert Counter(r.license for r in _found(spark, lines)) == Counter(["GPL-3.0", "LGPL-3.0", "AGPL-3.0"])
    two, three = L._WORDINGS["BSD-2-Clause"][0], L._WORDINGS["BSD-3-Clause"][0]
    assert {r.doc_id: r.license for r in _found(spark, [two, three])} == {0: "BSD-2-Clause", 1: "BSD-3-Clause"}


@pytest.mark.parametrize("before", ["licensed x ", "licensed licensed ", "the the licensed under ", ""])
def test_words_in_front_dont_hide_a_notice(spark, before):
    text = f"{before}licensed under CC BY 4.0 and more"
    (r,) = _found(spark, [text])
    assert (r.license, text[r.start_byte : r.end_byte]) == ("CC-BY-4.0", "licensed under CC BY 4.0")


def test_empty_tables_long_texts_and_several_notices(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, license string")
    assert L.scan(frame).count() == 0
    filler = "erinand thouti onheorre " * 50_000
    got = _found(spark, [f"{filler} Released under the MIT License. {filler} Licensed under CC BY-SA 4.0. {filler}", None, ""])
    assert [(r.doc_id, r.license) for r in sorted(got, key=lambda r: r.start_byte)] == [(0, "MIT"), (0, "CC-BY-SA-4.0")]
