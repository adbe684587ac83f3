"""Forms of license statements, and the base places against a naive scan."""

from __future__ import annotations

import random
import re

import pytest

pytest.importorskip("visitlens.llm")
from visitlens.llm import license_scan
from visitlens.llm.queries import LICENSE_PHRASES


@pytest.fixture(scope="module")
def scanner():
    return license_scan.Scanner(LICENSE_PHRASES)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under GPL-3.0", "gpl"), ("BSD 3-Clause License", "bsd-3-clause"), ("License: MIT", "mit"), ("under Apache-2.0.", "apache"),
    ("GPL-2.0-or-later", "gpl"), ("MPL 2.0", "mpl"), ("the EUPL-1.2", "eupl"), ('license = "MIT"', "mit"), ("BSD-licensed code", "bsd"),
    ("GPL version 3", "gpl"), ("WTFPL", "wtfpl"), ("SIL OFL 1.1", "ofl"), ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache,mit"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl"), ('"license": "Apache-2.0"', "apache"), ("Licence: LGPL", "lgpl"),
    ("LGPLv2.1+", "lgpl"), ("GNU AGPLv3", "agpl"), ("licensed under the MPL-2.0", "mpl"), ("license: bsd-2-clause", "bsd-2-clause"),
    ("end-user license agreement", "proprietary"), ("0BSD", "bsd"), ("CC Zero", "cc0"), ("MIT-licensed", "mit"), ("MIT/X11", "mit"), ("licences' = 'isc'", "isc"),
    ("license: CC-BY-SA-4.0", "cc-by-sa"), ("SPDX-License-Identifier: MIT", "mit"), ("license: unlicensed", "proprietary"),
])
def test_forms(scanner, text, labels):
    found = scanner.detections(text)
    assert ",".join(sorted({r.label for _, _, r in found})) == labels, found


@pytest.mark.parametrize("text", [
    "submit a permit", "the licenses of drivers: mitigate", "gplx", "license: see below", "a mitten, an apache helicopter, the bsdx", "please sign 2.0", "mpls 20", "",
])
def test_plain_words_have_no_label(scanner, text):
    assert scanner.detections(text) == []


def test_priority_decides_between_overlapping_detections():
    rules = (
        license_scan.Rule("long", 20, 0.5, ("aa",), "aa bb cc"), license_scan.Rule("inner", 10, 0.5, ("bb",), "bb"),
        license_scan.Rule("beside", 30, 0.5, ("cc",), "cc dd"), license_scan.Rule("equal", 10, 0.9, ("bb",), "bb"), license_scan.Rule("far", 30, 0.5, ("dd",), "dd"),
    )
    scanner = license_scan.Scanner({}, rules)
    # of equal extent and priority the surer one; it keeps the longer, weaker one out
    assert [(a, b, r.label) for a, b, r in scanner.detections("aa bb cc dd")] == [(3, 5, "equal"), (6, 11, "beside")]
    assert [r.label for _, _, r in scanner.detections("aa cc dd")] == ["beside"]


def test_hundreds_of_rules():
    assert len(license_scan.rules()) > 400


def test_base_places_equal_a_naive_scan(scanner):
    rnd = random.Random(4)
    words = ["GNU", "general", "public", "license", "MIT", "mit", "CC", "by", "apache", "x", "é", "licensE"]
    gaps = [" ", "-", "\n", " * ", ", "]
    for _ in range(400):
        text = "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randrange(40)))
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places, labels = [], set()
        for phrase, label in LICENSE_PHRASES.items():
            want = phrase.split()
            hits = [i for i in range(len(found)) if found[i : i + len(want)] == want]
            places += hits
            labels |= {label} if hits else set()
        got = scanner.scan(text)
        assert got[:5] == (len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(got[5].split(",")) and 0 <= got[6] <= 1
