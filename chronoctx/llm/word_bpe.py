"""Word-level byte-pair encoding by dynamic programming over prefixes, and back.

A word is a string of symbols, its UTF-8 bytes, the last one marked as a word's
end. The encodings of a word's prefixes differ in their last token alone: each
prefix has exactly one last token, and without it the prefix before it is encoded
as that one is by itself. So the last tokens of all prefixes, one number each, are
all encodings. For each prefix the automaton of the vocabulary's suffixes gives
the tokens that end there, longest first; the one that begins the word, or that
may stand behind the last token of the prefix before it, is stored. Following the
stored tokens back from the end gives the ids.

Two tokens may stand side by side if no merge across their border would have come
first. That is looked up backwards in time: the later of the merges that made the
two is undone, which lays bare an older neighbour, as long as a side has halves. A
pair that merges at a lower rank than the merge just undone forbids the two.
Tokens that their own merges never reach are left out the same way.

Texts are cut at the vocabulary's added tokens first, then normalised (NFC, lower
case) and split into words as the vocabulary's file prescribes. Where a text holds
characters that this Python's Unicode tables have no entry for, the file's own
normaliser and splitter cut it; merges are never left to them.

Decoding joins the vocabulary's own spelling of the tokens with blanks, as a file
without a decoder has it.

A null text counts as empty and has no tokens. Very long words take a number per
symbol, long texts are encoded in runs of words. Tables of words and pairs have a
fixed number of entries and start anew when it is reached. Rows stand alone, so
repeats, ties and extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame

from chronoctx.llm.bpe import explicit
from chronoctx.llm.common import map_rows, text_of

#: Words and token pairs that a worker remembers.
MAX_WORDS, MAX_PAIRS = 1 << 19, 1 << 21
#: Arcs that the automaton gets beyond those of its tokens.
MAX_ARCS = 1 << 21
#: Parts that are encoded between two looks at the size of the tables.
RUN = 1 << 15
#: What the symbol of a byte is raised by at a word's end.
END = 256
FOREVER = float("inf")
#: White space to Python, but not to the vocabulary's patterns.
_NO_SPACE = frozenset("\x1c\x1d\x1e\x1f")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a vocabulary's file:
    printable bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    others = iter(range(0x100, 0x200))
    return [letters[b] if b in letters else chr(next(others)) for b in range(256)]


class Merges:
    """The ranks of merges, the halves of tokens and who may stand beside whom."""

    def __init__(self, halves: list[tuple[int, int] | None], ranks: list[int]):
        #: Per token: what it was merged from and when; symbols have rank -1.
        self.halves, self.ranks = halves, ranks
        self.pairs = {pair: ranks[token] for token, pair in enumerate(halves) if pair}
        #: What was found before, by both tokens in one number.
        self.known: dict[int, bool] = {}
        for token, pair in enumerate(halves):
            if pair and max(ranks[pair[0]], ranks[pair[1]]) >= ranks[token]:
                raise ValueError("a token is merged before its halves are")
        self.reached = [True] * len(halves)
        for token in sorted((t for t, pair in enumerate(halves) if pair), key=ranks.__getitem__):
            left, right = halves[token]
            self.reached[token] = self.reached[left] and self.reached[right] and self._stand(left, right, ranks[token])

    def _stand(self, left: int, right: int, bound: float = FOREVER) -> bool:
        halves, ranks, pairs = self.halves, self.ranks, self.pairs
        while pairs.get((left, right), FOREVER) >= bound:
            # Of merges with one rank those further left come first, so go last here.
            if ranks[left] > ranks[right]:
                bound, left = ranks[left], halves[left][1]
            elif ranks[right] >= 0:
                bound, right = ranks[right] + 1, halves[right][0]
            else:
                return True
        return False

    def stand(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' joined symbols gives these two."""
        if len(self.known) >= MAX_PAIRS:
            self.known.clear()
        found = self.known[left << 32 | right] = self._stand(left, right)
        return found


class Suffixes:
    """An automaton over symbols. Its state is the longest suffix read that begins
    some token; from it a chain leads through the tokens that end here."""

    def __init__(self, tokens: list[tuple[str, int]]):
        self.arcs: list[dict[str, int]] = [{}]
        self.token: list[int] = [-1]
        self.depth: list[int] = [0]
        for symbols, number in tokens:
            node = 0
            for symbol in symbols:
                following = self.arcs[node].get(symbol)
                if following is None:
                    following = len(self.arcs)
                    self.arcs.append({})
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.arcs[node][symbol] = following
                node = following
            self.token[node] = number
        self.link = [0] * len(self.arcs)
        self.room = 0
        #: The nearest node on the way through the links, itself included, where a token ends.
        self.ends = [0] * len(self.arcs)
        queue = deque(self.arcs[0].values())
        while queue:
            node = queue.popleft()
            self.ends[node] = node if self.token[node] >= 0 else self.ends[self.link[node]]
            for symbol, child in self.arcs[node].items():
                self.link[child] = self.step(self.link[node], symbol)
                queue.append(child)
        self.room = MAX_ARCS
        self.chains: list[tuple[tuple[int, int], ...] | None] = [None] * len(self.arcs)

    def step(self, node: int, symbol: str) -> int:
        """Where a symbol leads; an arc over the links is added when it is first taken."""
        arcs, link, start = self.arcs, self.link, node
        while node and symbol not in arcs[node]:
            node = link[node]
        target = arcs[node].get(symbol, 0)
        if self.room:
            self.room -= 1
            arcs[start][symbol] = target
        return target

    def chain(self, node: int) -> tuple[tuple[int, int], ...]:
        """The tokens that end at a node, longest first, with their lengths; found once."""
        found, place = [], self.ends[node]
        while place:
            found.append((self.token[place], self.depth[place]))
            place = self.ends[self.link[place]]
        self.chains[node] = tuple(found)
        return self.chains[node]


class Vocabulary:
    """Tokens and merges of a file, with its way to split texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, suffix = content["model"], content["model"]["end_of_word_suffix"]
        if content["decoder"] is not None or not suffix or model["byte_fallback"] or model["dropout"]:
            raise ValueError("only vocabularies with marked word ends and without a decoder are supported")
        ids: dict[str, int] = model["vocab"]
        self.path, self.spelled = path, {i: token for token, i in ids.items()}
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        halves: list[tuple[int, int] | None] = [None] * (max(ids.values()) + 1)
        ranks = [-1] * len(halves)
        for rank, (left, right) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]):
            token = ids[left + right]
            if halves[token] is not None:
                raise ValueError("two merges make one token")
            halves[token], ranks[token] = (ids[left], ids[right]), rank
        self.merges = Merges(halves, ranks)

        def symbols(token: str) -> str:
            plain = token.removesuffix(suffix)
            data = [byte_of[c] for c in plain]
            if plain != token:
                data[-1] += END
            return "".join(map(chr, data))

        usable = [(symbols(token), i) for token, i in ids.items() if self.merges.reached[i] and (halves[i] or len(token.removesuffix(suffix)) == 1)]
        self.lengths = {i: len(s) for s, i in usable}
        self.suffixes = Suffixes(usable)
        if any(chr(s) not in self.suffixes.arcs[0] for s in range(2 * END)):
            raise ValueError("every byte has to be a token, with and without a word's end")
        added = content["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that depend on the text around them are not supported")
        self.added = {t["content"]: t["id"] for t in added}
        self.spelled |= {i: token for token, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        splits = [p for p in content["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        if len(splits) != 1 or [n["type"] for n in content["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("this way to normalise or split texts is not supported")
        self.pattern = explicit(splits[0]["pattern"]["Regex"])
        #: Characters seen that Python's tables have an entry for.
        self.settled: set[str] = set()
        self._own = None

    def last_tokens(self, word: str) -> list[int]:
        """For each prefix of a word, its last token; the word's own at the end."""
        data = word.encode("utf-8", "surrogatepass").decode("latin-1")
        arcs, step, chains, chain_of = self.suffixes.arcs, self.suffixes.step, self.suffixes.chains, self.suffixes.chain
        seen, stand = self.merges.known.get, self.merges.stand
        last: list[int] = []
        node = 0
        for i, symbol in enumerate(data[:-1] + chr(ord(data[-1]) + END)):
            following = arcs[node].get(symbol)
            node = step(node, symbol) if following is None else following
            for token, length in chains[node] or chain_of(node):
                if i < length:
                    break
                left = last[i - length]
                fits = seen(left << 32 | token)
                if stand(left, token) if fits is None else fits:
                    break
            last.append(token)
        return last

    def encode_word(self, word: str) -> list[int]:
        last, out = self.last_tokens(word), []
        i = len(last) - 1
        while i >= 0:
            out.append(last[i])
            i -= self.lengths[last[i]]
        return out[::-1]

    def parts(self, text: str) -> Iterator[str | tuple[str]]:
        """A text between white space, normalised; a word by itself in a tuple
        where the text holds characters that are not settled."""
        chars = set(text)
        for char in chars - self.settled:
            if unicodedata.category(char) == "Cn":
                yield from self._words_by_file(text)
                return
            self.settled.add(char)
        if not text.isascii():
            # A lower-case sigma is the same everywhere in a word, unlike in str.lower.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if chars.isdisjoint(_NO_SPACE):
            yield from text.split()
        else:
            yield from (m[0] for m in self.pattern.finditer(text))

    def _words_by_file(self, text: str) -> Iterator[tuple[str]]:
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_file(self.path), {letter: b for b, letter in enumerate(byte_letters())}
        rules, byte_of = self._own
        for piece, _ in rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(text)):
            yield (bytes(map(byte_of.__getitem__, piece)).decode(),)

    def cut_up(self, text: str) -> Iterator[str | tuple[str] | int]:
        """The parts of a text; added tokens that stand in it as their ids."""
        if self.cut is None or not any(token in text for token in self.added):
            yield from self.parts(text)
            return
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                yield self.added[part]
            else:
                yield from self.parts(part)

    def decode(self, ids) -> str:
        return " ".join(map(self.spelled.__getitem__, ids))


class Coder(dict):
    """Packed ids and their decoded text by part, for parts seen before."""

    def __init__(self, path: str):
        super().__init__()
        self.vocabulary = Vocabulary(path)
        self.words: dict[str, tuple[int, ...]] = {}

    def __missing__(self, part: str | tuple[str] | int) -> tuple[bytes, str]:
        if isinstance(part, int):
            ids = [part]
        else:
            ids = []
            # Letters alone are one word.
            for word in part if isinstance(part, tuple) else (part,) if part.isalpha() else self.vocabulary.pattern.findall(part):
                known = self.words.get(word)
                if known is None:
                    known = self.words[word] = tuple(self.vocabulary.encode_word(word))
                ids += known
        found = self[part] = array("I", ids).tobytes(), self.vocabulary.decode(ids)
        return found

    def encode_stream(self, text: str) -> Iterator[tuple[bytes, str]]:
        """Packed ids and decoded text, in runs of parts."""
        parts = self.vocabulary.cut_up(text)
        while True:
            for table in (self, self.words):
                if len(table) > MAX_WORDS:
                    table.clear()
            run = list(map(self.__getitem__, islice(parts, RUN)))
            if not run:
                return
            ids, texts = zip(*run)
            yield b"".join(ids), " ".join(texts)

    def encode(self, text: str) -> list[int]:
        ids = array("I")
        for packed, _ in self.encode_stream(text):
            ids.frombytes(packed)
        return ids.tolist()


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The coder of a vocabulary's file, made once per worker."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` with the ids packed as little-endian 32-bit integers."""
    def run(columns):
        tool = coder(path)
        return ((i, b"".join(ids for ids, _ in tool.encode_stream(t))) for i, t in zip(*columns))

    return map_rows(docs.select("doc_id", text_of("text").alias("text")), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from packed ids."""
    def run(columns):
        tool = coder(path).vocabulary
        return ((i, tool.decode(array("I", ids or b""))) for i, ids in zip(*columns))

    return map_rows(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Counts and hashes of the ids and of what they decode to, in one pass: runs
    are hashed as they are made and never kept whole."""
    def run(columns):
        tool = coder(path)
        for doc_id, text in zip(*columns):
            n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
            for packed, decoded in tool.encode_stream(text):
                text_hash.update((" " + decoded if n else decoded).encode())
                ids_hash.update(packed)
                n += len(packed) // 4
            yield doc_id, n, ids_hash.hexdigest(), text_hash.hexdigest()

    return map_rows(
        docs.select("doc_id", text_of("text").alias("text")), run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
