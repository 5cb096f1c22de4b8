import hashlib

from chronoctx.llm import fingerprints as prints
from llm_cases import BODY, empty, hostile


def test_against_brute_force(spark):
    docs = hostile(spark)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints.digest(text), prints.digest(changed),
                     prints.likeness(prints.digest(text), prints.digest(changed)), prints.likeness(prints.digest(text), prints.digest(following))))
    assert sorted(map(tuple, prints.compared_with_next(docs).collect()), key=repr) == sorted(want, key=repr)


def test_scores_are_bounded_and_symmetric():
    texts = ["", "a", "abcde" * 10, BODY, BODY[100:], BODY.upper(), "é" * 1000]
    for one in texts:
        for other in texts:
            a, b = prints.digest(one), prints.digest(other)
            assert prints.difference(a, b) == prints.difference(b, a) and 0 <= prints.likeness(a, b) <= 1
        assert prints.likeness(prints.digest(one), prints.digest(one)) == 1
    near, far = prints.digest(BODY[100:]), prints.digest(BODY.upper())
    assert prints.likeness(prints.digest(BODY), near) > prints.likeness(prints.digest(BODY), far)


def test_pieces_change_nothing(monkeypatch):
    whole = prints.digest(BODY)
    monkeypatch.setattr(prints, "PIECE", 100)
    assert prints.digest(BODY) == whole


def test_single_document_and_none(spark):
    (row,) = prints.compared_with_next(hostile(spark, ["lonely text"], extra=False).where("doc_id = 0").limit(1)).collect()
    assert (row.near_next, row.n_chars) == (1.0, 11)
    assert prints.compared_with_next(empty(spark)).collect() == []
    assert prints.fingerprints(empty(spark)).collect() == []
