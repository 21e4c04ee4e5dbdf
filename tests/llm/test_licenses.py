import math

import pytest

from aerostat.llm import licenses as lc
from aerostat.llm.shingles import text_shingles, shingles, words
from tests.llm.conftest import MESSY, frame, prose

GPL, MIT = lc.TEMPLATES["GPL-3.0-or-later"], lc.TEMPLATES["MIT"]


def brute(text, template, k=5):
    def grams(t):
        w = (lc.plain(t) or "").lower().split()
        return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])
    own, have = set(grams(template)), grams(text)
    run = math.ceil(lc.SLACK * len(own))
    return max((len(own & set(have[i:i + run])) for i in range(max(1, len(have)))), default=0) / len(own)


def edited(text, every):
    w = text.split()
    return " ".join(x + "q" if i % every == every - 1 else x for i, x in enumerate(w))


TEXTS = [t for _, t in MESSY if t is None or len(t) < 4000] + [
    prose(8, 300) + "\n" + MIT + "\n" + prose(9, 100), GPL.upper(), GPL.replace(",", " ,"), edited(GPL, 30), edited(GPL, 6), " ".join(MIT.split()[10:]), " ".join(MIT.split()[:20]),
    "Released under the MIT License. " + prose(3, 50), "released UNDER the mit-license", "Licensed under CC BY-NC 4.0.", MIT + " " + GPL, "\n".join(lc.TEMPLATES.values())]


def test_scan_matches_brute_force(spark, files):
    docs = files(frame(spark, list(enumerate(TEXTS)), 2))
    got = {(r.id, r.license): r.containment for r in lc.scan_licenses(docs, "doc_id", "text").collect()}
    want = {(i, n): c for i, t in enumerate(TEXTS) for n, s in lc.TEMPLATES.items() if (c := brute(t, s)) >= lc.CONTAINED}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and len(want) > 20


def test_spans_point_at_the_notice(spark):
    text = "one two three. Released under the MIT License. four five"
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "id long, text string")
    assert [(r.license, r.first_word, r.last_word) for r in lc.scan_licenses(df, "id", "text").collect()] == [("MIT (short)", 3, 7)] * 3


def test_results_do_not_depend_on_neighbours():
    scanner = lc.Scanner(lc.TEMPLATES)
    together = scanner.scan(TEXTS)
    assert together == sorted((i, *r[1:]) for i, t in enumerate(TEXTS) for r in scanner.scan([t]))


def test_windows_hold_every_run():
    s = lc.Scanner(lc.TEMPLATES)
    assert all(h >= r and (h == 1 or h < 2 * r) for h, r in zip(s.half, s.run))
    assert [len(x) for x in s.sets] == [len(x) for x in text_shingles([lc.plain(t) for t in lc.TEMPLATES.values()])]


def test_own_templates_and_empty(spark, empty):
    df = spark.createDataFrame([(1, "all rights reserved"), (2, "some rights reserved"), (3, None)], "id long, text string")
    assert [(r.id, r.license) for r in lc.scan_licenses(df, "id", "text", {"ARR": "All rights reserved."}).collect()] == [(1, "ARR")]
    assert lc.scan_licenses(empty, "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        lc.Scanner({"none": " . "})
    assert len(shingles(*words([]))[0]) == 0


@pytest.mark.parametrize("text, want", [
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Released under the BSD License.", "BSD"), ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("SPDX-License-Identifier: EPL-2.0", "EPL-2.0"), (lc.TEMPLATES["BSD-3-Clause"], "BSD-3-Clause"),
    (lc.TEMPLATES["BSD-2-Clause"], "BSD-2-Clause"), ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"),
    (lc.TEMPLATES["LGPL-3.0-or-later"], "LGPL-3.0-or-later"), (lc.TEMPLATES["GPL-3.0 (body)"], "GPL-3.0"), (lc.TEMPLATES["Apache-2.0"], "Apache-2.0")])
def test_every_licence_by_its_own_name(text, want):
    got = lc.Scanner(lc.TEMPLATES).scan([prose(5, 50) + " " + text + " " + prose(6, 50)], specific=True)
    assert [r[1].split(" (")[0] for r in got] == [want]


def test_what_a_larger_match_covers_is_found_elsewhere():
    text = f"{lc.TEMPLATES['BSD-3-Clause']} {prose(5, 50)} {lc.TEMPLATES['BSD-2-Clause']} {prose(6, 50)} Released under the MIT License."
    assert sorted(r[1] for r in lc.Scanner(lc.TEMPLATES).scan([text], specific=True)) == ["BSD-2-Clause", "BSD-3-Clause", "MIT (short)"]
