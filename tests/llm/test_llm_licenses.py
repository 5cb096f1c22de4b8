import random
import re
from re import _constants as kinds, _parser as parser

from chronoctx.llm import licenses
from chronoctx.llm.license_rules import RULES
from llm_cases import empty, hostile

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for label, phrase in licenses.PHRASES:
        own = phrase.decode().split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(own)] == own]
    return len(words), sorted(places)


def test_hundreds_of_rules_by_priority():
    assert len(RULES) > 200 and all(0 < r.priority <= 100 for r in RULES)


def test_base_places_match_brute_force(spark):
    for text in [r.text for r in hostile(spark).collect()] + [
        "GNU General, Public-License gnu general public license cc by cc by-nc", "CC BY mit license.MIT LICENSE apache\nlicense",
        "xgnu general public license gnu general public licenses éapache license",
    ]:
        n, base, _ = licenses.scan(text or "")
        assert (n, sorted(base)) == brute(text)


def test_stronger_rule_suppresses_what_it_contains():
    labels = lambda text: {RULES[i].label for _, _, i in licenses.scan(text)[2]}
    assert labels("SPDX-License-Identifier: GPL-3.0-or-later") == {"gpl-3.0-or-later"}
    assert labels("Licensed under CC BY-NC-SA 4.0") == {"cc-by-nc-sa-4.0"}
    assert labels("the GNU Lesser General Public License version 2.1 or any later version") == {"lgpl-2.1-or-later"}
    assert labels("BSD 3-Clause and Apache License, Version 2.0") == {"bsd-3-clause", "apache-2.0"}
    assert labels("no rights here") == set()


def test_suppression_matches_brute_force():
    chance = random.Random(2)
    for _ in range(500):
        found = [(a, a + chance.randrange(1, 6), chance.randrange(len(RULES))) for a in (chance.randrange(20) for _ in range(8))]
        kept = []
        for d in sorted(set(found), key=lambda d: (-RULES[d[2]].priority, d[0] - d[1], d[0], d[2])):
            if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
                kept.append(d)
        assert licenses.kept_detections(found) == sorted(kept)


def test_documents(spark):
    rows = licenses.scan_licenses(hostile(spark)).collect()
    assert len(rows) == hostile(spark).count()
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_words, by_id[1].first_word, by_id[1].labels, by_id[1].score) == (0, None, "", 0.0)
    assert by_id[20].base_labels == "gpl,mit" and by_id[20].labels == "gpl,gpl-3.0,mit"
    assert (by_id[20].n_base, by_id[20].first_word, by_id[20].last_word) == (2, 3, 6)
    assert licenses.scan_licenses(empty(spark)).collect() == []


def forms(parsed):
    """Texts that a pattern matches: every branch, with and without each option."""
    out = [""]
    for kind, value in parsed:
        if kind is kinds.LITERAL:
            ends = [chr(value)]
        elif kind is kinds.IN:
            ends = ["7" if v is kinds.CATEGORY_DIGIT else "w" if k is kinds.CATEGORY else chr(v) for k, v in value]
        elif kind is kinds.SUBPATTERN:
            ends = forms(value[3])
        elif kind is kinds.BRANCH:
            ends = [f for branch in value[1] for f in forms(branch)]
        elif kind is kinds.MAX_REPEAT:
            least, most, inner = value
            ends = [f * n for f in forms(inner) for n in range(least, min(most, least + 1) + 1)]
        else:
            assert kind in (kinds.ASSERT, kinds.ASSERT_NOT)
            ends = [""]
        out = [start + end for start in out for end in ends]
    return out


def test_keywords_lose_no_form_of_any_rule():
    for rule in RULES:
        for form in forms(parser.parse(rule.pattern.pattern)):
            for text in (form, f"see {form} here"):
                normal = b" ".join(licenses.words_of(text))
                ungated = [(m.start(), m.end(), i) for i, r in enumerate(RULES) for m in r.pattern.finditer(normal)]
                assert licenses.scan(text)[2] == licenses.kept_detections(ungated), text
    labels = lambda text: {RULES[i].label for _, _, i in licenses.scan(text)[2]}
    assert labels("distributed under the Q Public License version 1.0") == {"qpl-1.0"}
    assert labels("This is free and unencumbered software released into the public domain.") >= {"unlicense"}
    assert labels("GPL3") == {"gpl-3.0"} and labels("LGPL2.1") == {"lgpl-2.1"} and labels("PSF license") == {"psf-2.0"}
    assert labels("Licence Ouverte 2.0") == {"etalab-2.0"} and labels("MPLv2") == {"mpl-2.0"} and labels("EUPL1.2") == {"eupl-1.2"}
