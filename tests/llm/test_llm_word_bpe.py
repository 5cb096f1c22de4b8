import hashlib
import random
import unicodedata
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from chronoctx.llm import queries, word_bpe
from llm_cases import empty, hostile

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return TOKENIZER


def same(texts, tokenizer):
    coder = word_bpe.coder(PATH)
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        runs = list(coder.encode_stream(text))
        assert array("I", b"".join(ids for ids, _ in runs)).tolist() == want.ids, text[:200]
        assert " ".join(t for _, t in runs) == tokenizer.decode(want.ids, skip_special_tokens=False) == coder.vocabulary.decode(want.ids)


def test_every_character_beside_others(tokenizer):
    chance = random.Random(1)
    known, unknown = [], []
    for c in [*range(0xD800), *range(0xE000, 0x110000)]:
        (unknown if unicodedata.category(chr(c)) in ("Cn", "Co") else known).append(chr(c))
    for every in (known, chance.sample(unknown, 2000)):
        beside = chance.sample(every, len(every))
        same([" ".join(f"a{c}1{c}!{d}" for c, d in zip(every[i:i + 97], beside[i:i + 97])) for i in range(0, len(every), 97)], tokenizer)


def test_awkward_words_and_texts(tokenizer):
    chance = random.Random(2)
    vocabulary = [t.removesuffix("</w>") for t in tokenizer.get_vocab()]
    some = ["'s", "'ll", "İΣς", "é", "<|endoftext|>", "<|startoftext|>", "<|endof", " ", "\x1c", "12²", "　", "!!.", "漢字", "😀",
            "ΑΣ", "ẞ", "ﬁ", "Ⅷ", "\u0085", "᠎", "가", "՘", "\U00010d50"]
    texts = ["".join(chance.choice("ab") for _ in range(chance.randrange(1, 60))) for _ in range(2000)]
    texts += ["".join(chance.choice(vocabulary) for _ in range(chance.randrange(1, 6))) for _ in range(5000)]
    texts += ["".join(chance.choice([*some, chr(chance.randrange(1, 0x3000))]) for _ in range(chance.randrange(14))) for _ in range(5000)]
    same([*texts, "y" * 300_000, "ab" * 100_000, "", "e" + "́" * 5000, "<|endoftext|>" * 3000], tokenizer)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=40))
def test_any_text(text):
    same([text], TOKENIZER)


def test_last_tokens_are_those_of_the_prefixes(tokenizer):
    vocabulary = word_bpe.coder(PATH).vocabulary
    for word in ("internationalization", "aaaaaaaaabab", "xyzzyqwerty"):
        last, lengths = vocabulary.last_tokens(word), vocabulary.lengths
        for end in range(1, len(word)):
            ids, i = [], end - 1
            while i >= 0:
                ids.insert(0, last[i])
                i -= lengths[last[i]]
            assert ids == merged(vocabulary, word[:end])


def merged(vocabulary, text):
    """The merges one by one, lowest rank first, leftmost of equals."""
    single = {s: i for s, i in ((vocabulary.spelled[i], i) for i in range(256))}
    ids, merges = [single[c] for c in text], vocabulary.merges
    token_of = {pair: t for t, pair in enumerate(merges.halves) if pair}
    while True:
        ranked = [(merges.pairs[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in merges.pairs]
        if not ranked:
            return ids
        k = min(ranked)[1]
        ids[k:k + 2] = [token_of[ids[k], ids[k + 1]]]


def test_unreachable_tokens_are_left_out():
    # Tokens 0 a, 1 b, 2 c; bc merges first, so ab stays whole before no c and abc by (ab, c) is never made.
    merges = word_bpe.Merges([None, None, None, (1, 2), (0, 1), (4, 2)], [-1, -1, -1, 0, 1, 2])
    assert merges.reached == [True, True, True, True, True, False]
    assert not merges.stand(4, 2) and merges.stand(0, 3) and not merges.stand(0, 1)
    with pytest.raises(ValueError):
        word_bpe.Merges([None, (2, 2), (0, 0)], [-1, 0, 1])


def test_full_tables_start_anew(monkeypatch, tokenizer):
    monkeypatch.setattr(word_bpe, "MAX_WORDS", 3)
    monkeypatch.setattr(word_bpe, "MAX_PAIRS", 3)
    monkeypatch.setattr(word_bpe, "RUN", 2)
    same(["one two three four five six one two", "seven eight"], tokenizer)


def test_documents(spark, sf_dir, tokenizer):
    for docs in (hostile(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
            decoded = tokenizer.decode(ids, skip_special_tokens=False)
            want.append((r.doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        assert sorted(map(tuple, word_bpe.round_trip(docs, PATH).collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, queries.op12_word_bpe(spark, sf_dir).collect()), key=repr) == sorted(want, key=repr)
    texts = {r.doc_id: r.text for r in word_bpe.decode_documents(word_bpe.encode_documents(hostile(spark), PATH), PATH).collect()}
    assert texts[2] == "short</w>" and texts[0] == texts[1] == ""
    assert word_bpe.round_trip(empty(spark), PATH).collect() == []
