"""License rules against a brute-force reading of the words."""

import random
import re

from tabscore.llm import license_scan as ls
from tabscore.llm.license_rules import BASE, FAMILIES, rules

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    hits = [(i, label) for phrase, label in BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(hits), min([i for i, _ in hits], default=None), max([i for i, _ in hits], default=None),
            ",".join(sorted({x for _, x in hits})))


def test_base_columns_equal_brute_force():
    rng = random.Random(2)
    bits = ["MIT", "license", "Licence", "apache", "general", "public", "é", "K", "x1", "the", "mit-license", "GENERAL\npublic.license", "", "\x7f", " "]
    for _ in range(1500):
        text = rng.choice([" ", "-", "\n"]).join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert ls.scan_text(text)[:5] == brute(text), text


def test_every_rule_is_gated_by_a_literal_of_its_own():
    assert len(rules()) > 300 and len({r[3] for r in rules()}) > 300
    for label, _, keyword, regex in rules():
        assert len(keyword) >= 3, (label, regex)


def test_every_family_name_is_found():
    for label, spdx, names in FAMILIES:
        for name in [*names, f"spdx license identifier {spdx}"]:
            plain = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", name)
            plain = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", plain).replace("licen[sc]e", "license").replace(" ?V", " version ").replace("V", "version ").replace("[a-z]*", "x")
            plain = re.sub(r"(.)\?", r"\1", plain)
            assert ls.scan_text(f"x {plain} y")[7], (label, plain)


def test_priority_and_containment():
    out = ls.scan_text("Licensed under the GNU Lesser General Public License, version 2.1.")
    assert [d["label"] for d in out[7]] == ["lgpl-2.1"] and out[5] == "gpl,lgpl-2.1" and out[6] == 0.8
    assert out[1:5] == (1, 5, 5, "gpl")
    out = ls.scan_text("SPDX-License-Identifier: GPL-2.0-or-later")
    assert out[5] == "gpl-2.0" and out[6] == 0.95 and out[1] == 0
    assert ls.scan_text("a plain text about mit and license")[5] == ""
    many = ls.scan_text("mit license " * 5000)
    assert many[1] == 5000 and many[5] == "mit" and len(many[7]) == 5000


def test_suppress_equals_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        found = [(rng.choice([40, 60, 80]), s := rng.randint(0, 20), s + rng.randint(1, 8), rng.choice("ab")) for _ in range(rng.randint(0, 12))]
        want = {x for x in found if not any((y[0] > x[0] and y[1] <= x[1] and y[2] >= x[2]) or
                                            (y[0] == x[0] and y[1] <= x[1] and y[2] >= x[2] and y[1:3] != x[1:3]) for y in _kept(found, x[0]))}
        assert set(ls.suppress(found)) == want


def _kept(found, level):
    """Accepted detections of priority ``level`` or more, by definition."""
    out = []
    for p in sorted({x[0] for x in found if x[0] >= level}, reverse=True):
        same = {x for x in found if x[0] == p}
        higher = list(out)
        free = [x for x in same if not any(y[1] <= x[1] and y[2] >= x[2] for y in higher)]
        out += [x for x in free if not any(y[1] <= x[1] and y[2] >= x[2] and y[1:3] != x[1:3] for y in free)]
    return out


def test_frame_edges(spark):
    df = spark.createDataFrame([(1, "MIT License", "z"), (None, None, None), (2, "", "z"), (2, "", "z")], "doc_id long, text string, labels string")
    out = sorted(ls.scan(df).collect(), key=str)
    assert len(out) == 4 and {r.labels for r in out} == {"", "mit"} and ls.scan(df.limit(0)).count() == 0
