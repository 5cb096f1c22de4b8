import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from chronoctx.llm import bpe
from llm_cases import empty, hostile

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.merges.ranks, special_tokens={})


def some_texts(codec, n):
    chance = random.Random(4)
    for i in range(n):
        size = chance.randrange(1, 25)
        if i % 3 == 0:
            yield "".join(chr(chance.choice([chance.randrange(32, 127), chance.randrange(0xA0, 0xD7FF), 0x1F600 + size, 10, 32, 0x1C])) for _ in range(size))
        elif i % 3 == 1:
            yield b"".join(chance.choice(codec.merges.bytes_of) for _ in range(size)).decode("utf-8", "ignore")
        else:
            yield "".join(chance.choice("aab  \n\n!!..--==01'st") for _ in range(3 * size))


def test_ids_are_those_of_the_ranks(codec, reference):
    for text in some_texts(codec, 3000):
        ids = codec.encode(text)
        assert ids.tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text


def test_small_tables_change_nothing(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_PIECES", 20)
    own = bpe.Codec(codec.merges.ranks, public_tokenizers.PATTERN)
    for text in some_texts(codec, 300):
        assert own.encode(text).tolist() == reference.encode_ordinary(text)


def test_streaming_decoder_waits_for_whole_characters(codec):
    text = "naïve 漢字 😀"
    decoder, ids = codec.decoder(), [codec.merges.ranks[bytes([b])] for b in text.encode()]
    assert "".join(decoder.feed([i]) for i in ids) + decoder.close() == text
    broken = [codec.merges.ranks[bytes([b])] for b in b"\xe6\xbc\xff a\xf0\x9f"]
    assert codec.decode(broken) == b"\xe6\xbc\xff a\xf0\x9f".decode("utf-8", "replace")


def test_hostile_documents(spark, reference):
    docs = hostile(spark)
    for row, (doc_id, text) in zip(
        bpe.round_trip(docs.orderBy("doc_id", "text"), PATH, public_tokenizers.PATTERN).orderBy("doc_id").collect(),
        [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id", "text").collect()],
    ):
        ids = array("I", reference.encode_ordinary(text))
        assert (row.doc_id, row.n_tokens, row.ids_sha256) == (doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(empty(spark), PATH, public_tokenizers.PATTERN).collect() == []


def test_encode_and_decode_documents(spark):
    docs = hostile(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text or "" for r in docs.collect()}
