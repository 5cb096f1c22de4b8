"""Licence scans by ordered signature rules.

A text is normalised to words. Its set of words picks the rules worth trying;
those propose intervals of words; an interval inside one of higher priority (or
of equal priority and an earlier rule) is suppressed. Four phrases are looked
for in every text and their labels always stay.

A null or empty text has no words, no labels and score 0. Texts are scanned
whole; rows stand alone, so repeats, ties and clashing extra columns do not
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict

from pyspark.sql import DataFrame

from chronoctx.llm.common import map_rows, text_of
from chronoctx.llm.license_rules import RULES

PHRASES = (
    ("gpl", b"gnu general public license"),
    ("apache", b"apache license"),
    ("cc-by", b"cc by"),
    ("mit", b"mit license"),
)
#: What a phrase alone is worth.
PHRASE_SCORE = 60

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Lower-cases A to Z and turns all that is in no word into a space.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256)
)
_BASE = [(label, phrase.split()[0], re.compile(rb"(?<![^ ])" + phrase + rb"(?![^ ])")) for label, phrase in PHRASES]
_BY_KEYWORD: dict[bytes, list[int]] = defaultdict(list)
for _i, _r in enumerate(RULES):
    for _k in _r.keywords:
        _BY_KEYWORD[_k].append(_i)
_KEYWORDS = frozenset(_BY_KEYWORD) | {keyword for _, keyword, _ in _BASE}


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def kept_detections(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of ``(start, end, rule)`` those that no stronger one contains. Stronger
    ones come first; a contained interval has an accepted one that starts at or
    before it and reaches at least as far."""
    kept: list[tuple[int, int, int]] = []
    starts: list[int] = []
    reach: list[int] = []
    for start, end, rule in sorted(set(found), key=lambda d: (-RULES[d[2]].priority, d[0] - d[1], d[0], d[2])):
        i = bisect_right(starts, start)
        if i and reach[i - 1] >= end:
            continue
        kept.append((start, end, rule))
        # The frontier holds accepted intervals none of which lies in another.
        j = i
        while j < len(starts) and reach[j] <= end:
            j += 1
        k = i - 1 if i and starts[i - 1] == start else i
        starts[k:j] = [start]
        reach[k:j] = [end]
    return sorted(kept)


def scan(text: str) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, int]]]:
    """Number of words, base places as ``(word, label)``, kept detections as
    ``(first byte, end byte, rule)`` of the normalised text."""
    words = words_of(text)
    hits = _KEYWORDS.intersection(words)
    if not hits:
        return len(words), [], []
    normal = b" ".join(words)
    places = [(m.start(), label) for label, keyword, pattern in _BASE if keyword in hits for m in pattern.finditer(normal)]
    base, word, at = [], 0, 0
    for start, label in sorted(places):
        word += normal.count(b" ", at, start)
        at = start
        base.append((word, label))
    rules = sorted({i for keyword in hits for i in _BY_KEYWORD.get(keyword, ())})
    found = [(m.start(), m.end(), i) for i in rules for m in RULES[i].pattern.finditer(normal)]
    return len(words), base, kept_detections(found)


def _row(doc_id: int | None, text: str) -> tuple:
    n_words, base, detected = scan(text)
    base_labels = {label for _, label in base}
    labels = base_labels | {RULES[i].label for _, _, i in detected}
    score = max([PHRASE_SCORE * bool(base), *(RULES[i].priority for _, _, i in detected)]) / 100
    first, last = (base[0][0], base[-1][0]) if base else (None, None)
    return doc_id, n_words, len(base), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document with counts, places, labels and a score."""
    return map_rows(
        docs.select("doc_id", text_of("text").alias("text")), lambda c: (_row(i, t) for i, t in zip(*c)),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double")
