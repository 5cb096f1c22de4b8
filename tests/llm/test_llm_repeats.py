import hashlib
import random

import numpy as np

from chronoctx.llm import repeats
from llm_cases import PASSAGE, TEXTS, empty, hostile


def brute(docs):
    first = {}
    for doc_id, data in docs:
        own = repeats.NO_ID if doc_id is None else doc_id
        for p in range(len(data) - 49):
            window = data[p:p + 50]
            first[window] = min(own, first.get(window, own))
    out = []
    for doc_id, data in docs:
        own, gone = repeats.NO_ID if doc_id is None else doc_id, bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < own:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), sum(map(bool, bytes(gone).split(b"\0"))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    got = sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in repeats.digest(docs).collect()), key=repr)
    assert got == brute(rows)


def test_hostile_documents_match_brute_force(spark):
    short = [t if t is None or len(t) < 50_000 else t[:4_000] for t in TEXTS]
    chance = random.Random(8)
    cuts = [PASSAGE[a:b] for a, b in ((chance.randrange(20), chance.randrange(60, 110)) for _ in range(10))]
    check(hostile(spark, [*short, *cuts, "a" * 200, "a" * 120 + "b" * 60, "ab" * 100, "b" * 49, "b" * 50, "x" * 30 + "ab" * 40 + "y" * 10, *cuts]))


def test_table_matches_brute_force(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 64)
    data = random.Random(1).randbytes(1000)
    found = repeats.parse(data)
    monkeypatch.setattr(repeats, "PIECE", 1 << 18)
    whole = repeats.parse(data)
    assert set(whole[1]) == set(found[1])
    for hashes, places, firsts, lasts in (found, whole):
        assert firsts[0] == 0 and lasts[-1] == 950 and (firsts[1:] == lasts[:-1] + 1).all()
        assert (places >= lasts).all() and (places + repeats.GRAM <= firsts + repeats.LENGTH).all()
    (row,) = repeats.remove_repeats(hostile(spark, ["z" * 3_000_000], extra=False).where("doc_id = 0").limit(1)).collect()
    assert (row.n_removed, row.kept) == (0, b"z" * 3_000_000)


def test_suffixes_sort_by_content():
    text = np.frombuffer(b"banana" * 20, np.uint8)
    starts = np.arange(60)
    assert suffixes(text, repeats.suffix_order(text, starts)) == sorted(suffixes(text, starts))


def suffixes(text, starts):
    return [text[i:i + 50].tobytes() for i in starts.tolist()]


def test_empty_table(spark):
    assert repeats.digest(empty(spark)).collect() == []
