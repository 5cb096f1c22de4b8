import random
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chronoctx.llm import packing
from llm_cases import empty, hostile

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


def test_ids_are_those_of_the_tokenizer(tokenizer):
    tokens, chance = packing.Tokens(PATH), random.Random(3)
    some = ["'s 'll's", "İΣς ", "é", "<|endoftext|>", " ", "\x1c", "12²", "　", "!!.", "Ünï-cödé"]
    texts = ["".join(chance.choice([chr(chance.randrange(1, 256)), chr(chance.randrange(32, 127)), *some]) for _ in range(12)) for _ in range(1500)]
    for text, ids in zip(texts, tokens.encode(texts)):
        assert array("I", ids).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_token_is_placed_once_and_without_gaps(spark, tokenizer):
    docs = hostile(spark)
    rows = packing.packed_documents(docs, PATH).collect()
    want, sequences = [], {}
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            want.append((r.doc_id, k, start, len(part), zlib.crc32(array("I", part).tobytes())))
    key = lambda x: (x[0] is not None, x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(w[3] for w in want) // 2048) + 1
    assert packing.packed_documents(empty(spark), PATH).collect() == []


def test_evolution_keeps_every_piece_and_never_gets_worse():
    chance = random.Random(5)
    lengths = [chance.choice([700, 690, 650, 1300, 1350, 30, 500]) + chance.randrange(40) for _ in range(400)]
    start = packing.first_population(lengths, chance)
    best = packing.evolve(start, lengths, chance, 10)
    for packed in best:
        assert sorted(i for _, group in packed for i in group) == list(range(400))
        assert all(fill == sum(lengths[i] for i in group) <= 2048 for fill, group in packed)
    assert packing.fitness(best[0]) >= max(map(packing.fitness, start))
    child = packing.crossover(start[0], start[1], lengths, chance)
    assert sorted(i for _, group in child for i in group) == list(range(400))
    assert packing._from_bytes(packing._to_bytes(child, 400), lengths) != [] and packing.evolve([[]], [], chance) == [[]]


def test_added_tokens_in_a_text_have_their_own_ids(spark):
    plain, chance = Tokenizer.from_file(PATH), random.Random(4)
    some = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "|>", " ", "a", "é", "\u0301", "漢", "'s", "7", "\x1c"]
    texts = ["".join(chance.choice(some) for _ in range(chance.randrange(12))) for _ in range(2000)]
    texts += ["one <|endoftext|> two<|startoftext|>x", "<|endoftext|>" * 3000]
    tokens = packing.Tokens(PATH, added=True)
    for text, ids in zip(texts, tokens.encode(texts)):
        assert array("I", ids).tolist() == plain.encode(text, add_special_tokens=False).ids, text
    rows = packing.pieces(hostile(spark, texts[-12:], extra=False).where("doc_id is not null").distinct(), PATH).collect()
    want = []
    for i, text in enumerate(texts[-12:]):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        want += [(i, k, s, len(ids[s:s + 2048]), zlib.crc32(array("I", ids[s:s + 2048]).tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    assert sorted(map(tuple, rows)) == sorted(want)
    assert [r.length for r in rows if r.doc_id == 10] == [6]
