"""Byte-level byte-pair encoding as a finite-state transducer, and back.

Encoding. A sequence of tokens is what the merges give for its bytes exactly
when each neighbouring pair is: merging across a boundary depends on the two
tokens beside it alone. So every prefix of a text has one encoding, and the
encodings of a prefix and of a longer one differ near the end only. The
nondeterministic transducer reads bytes along the trie of the vocabulary and may
close a token where one ends, if it agrees with the token before it. Its subset
construction holds every open hypothesis with the tokens that it would still
have to write; what all of them share is written at once. A hypothesis begins at
most one token length back, so the lookahead is bounded. States and arcs are made
when a text first needs them.

Decoding. Tokens need not end at character borders. The decoder keeps the state
of a UTF-8 machine and the bytes of an unfinished character; arcs from a state
over a whole token are made when first needed.

Tables have a fixed number of entries and start anew when it is reached. A null
text counts as empty and has no tokens; rows stand alone, so repeats, ties and
extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import regex
from pyspark.sql import DataFrame

from chronoctx.llm.common import map_rows, text_of

#: States of the transducer, and pieces of text, that a worker remembers.
MAX_STATES = 1 << 18
MAX_PIECES = 1 << 19
#: Pieces that are encoded between two looks at the size of the tables.
RUN = 1 << 15


class Merges:
    """The compiled ranks: trie arcs, and whether two tokens agree.

    Two tokens agree if merging their joined bytes ends with just these two. The
    token beside the boundary on the left runs, merge by merge, up the right edge
    of the left token's tree, the one on the right up the left edge of the right
    token's tree. A merge across the boundary happens if some pair of tokens that
    stand there at the same time merges before either is taken up by its own tree;
    of equal ranks the leftmost goes first.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.arcs: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            node = 0
            for byte in token:
                following = self.arcs[node].get(byte)
                if following is None:
                    following = len(self.arcs)
                    self.arcs.append({})
                    self.token_at.append(-1)
                    self.arcs[node][byte] = following
                node = following
            self.token_at[node] = rank
        self._edges: dict[tuple[int, bool], list[tuple[int, float, float]]] = {}
        self._agree: dict[tuple[int, int], bool] = {}

    def parts(self, data: bytes, below: float = float("inf")) -> list[int]:
        """The ranks' own merging of ``data``, lowest rank first, leftmost of
        equals, with ranks under ``below`` only."""
        pieces = [data[i:i + 1] for i in range(len(data))]
        while len(pieces) > 1:
            pairs = [self.ranks.get(a + b, below) for a, b in zip(pieces, pieces[1:])]
            best = min(pairs)
            if best >= below:
                break
            i = pairs.index(best)
            pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]
        return [self.ranks[p] for p in pieces]

    def edge(self, token: int, right: bool) -> list[tuple[int, float, float]]:
        """The tokens on one edge of a token's merge tree, outermost last, with
        the ranks at which each is made and taken up."""
        known = self._edges.get((token, right))
        if known is None:
            halves = self.parts(self.bytes_of[token], token)
            if len(self.bytes_of[token]) == 1 or len(halves) != 2:
                known = [(token, -1.0, float("inf"))]
            else:
                inner = self.edge(halves[1 if right else 0], right)
                known = [*inner[:-1], (inner[-1][0], inner[-1][1], float(token)), (token, float(token), float("inf"))]
            self._edges[token, right] = known
        return known

    def agree(self, left: int, right: int) -> bool:
        known = self._agree.get((left, right))
        if known is None:
            if len(self._agree) >= 8 * MAX_STATES:
                self._agree.clear()
            known = self._agree[left, right] = self._judge(left, right)
        return known

    def _judge(self, left: int, right: int) -> bool:
        ranks, bytes_of = self.ranks, self.bytes_of
        for a, made_a, gone_a in self.edge(left, True):
            for b, made_b, gone_b in self.edge(right, False):
                rank = ranks.get(bytes_of[a] + bytes_of[b])
                if rank is not None:
                    when = max(rank, made_a, made_b)
                    if when < gone_a and when <= gone_b:
                        return False
        return True


class Encoder:
    """The determinised transducer. A state is a tuple of hypotheses ``(last
    token, trie node, tokens not yet written)``; the last of them is the one that
    ends a token here, and every state has one, as each byte is a token."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self._reset()

    def _reset(self) -> None:
        start = ((-1, 0, ()),)
        self.numbers = {start: 0}
        self.states = [start]
        self.ends: list[bytes | None] = [None]
        #: By state number and byte: the next state's number, shifted for the byte, and packed ids.
        self.arcs: dict[int, tuple[int, bytes]] = {}

    def _arc(self, key: int) -> tuple[int, bytes]:
        merges, byte = self.merges, key & 255
        moved, closed = [], None
        for last, node, pending in self.states[key >> 8]:
            following = merges.arcs[node].get(byte)
            if following is None:
                continue
            token = merges.token_at[following]
            if closed is None and token >= 0 and (last < 0 or merges.agree(last, token)):
                closed = (token, 0, (*pending, token))
            if merges.arcs[following]:
                moved.append((last, following, pending))
        moved.append(closed)
        shared = 0
        for tokens in zip(*(h[2] for h in moved)):
            if tokens.count(tokens[0]) != len(tokens):
                break
            shared += 1
        written = array("I", closed[2][:shared]).tobytes()
        target = tuple((last, node, pending[shared:]) for last, node, pending in moved) if shared else tuple(moved)
        number = self.numbers.get(target)
        if number is None:
            number = self.numbers[target] = len(self.states)
            self.states.append(target)
            self.ends.append(None)
        arc = self.arcs[key] = (number << 8, written)
        return arc

    def encode(self, data: bytes) -> bytes:
        """The ids of one piece as little-endian unsigned 32-bit integers."""
        if len(self.states) > MAX_STATES:
            self._reset()
        state, written, known = 0, [], self.arcs.get
        for byte in data:
            state, ids = known(state | byte) or self._arc(state | byte)
            if ids:
                written.append(ids)
        state >>= 8
        rest = self.ends[state]
        if rest is None:
            rest = self.ends[state] = array("I", self.states[state][-1][2]).tobytes()
        written.append(rest)
        return b"".join(written)


class Pieces(dict):
    """Ids of pieces that were seen before; others go through the transducer."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.encoder.encode(piece.encode("utf-8", "surrogatepass"))
        return ids


#: The steps of UTF-8 by state. State 0 is between characters; a lead byte opens
#: states that count the bytes to come and know which ones may follow it.
_FOLLOWS = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1),
            6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}
_LEADS = ((0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2),
          (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7))
_LEAD_STATE = [next((s for low, high, s in _LEADS if low <= byte <= high), None) for byte in range(256)]


def utf8_step(state: int, byte: int) -> int | None:
    """The state after one more byte; None if it cannot stand here."""
    if state == 0:
        return _LEAD_STATE[byte]
    low, high, following = _FOLLOWS[state]
    return following if low <= byte <= high else None


class Decoder:
    """Turns ids into text as they come. ``feed`` gives the characters that are
    complete; ``close`` ends the stream. Bytes that are not UTF-8 become U+FFFD,
    one for each longest broken start."""

    def __init__(self, bytes_of: list[bytes], arcs: dict[tuple[bytes, int], tuple[bytes, str]]):
        self.bytes_of, self.arcs, self.held = bytes_of, arcs, b""

    def _arc(self, held: bytes, token: int) -> tuple[bytes, str]:
        out, state, begin, data = [], 0, 0, held + self.bytes_of[token]
        i = 0
        while i < len(data):
            following = utf8_step(state, data[i])
            if following is None:
                out.append("�")
                i = i if state else i + 1
                begin, state = i, 0
                continue
            i, state = i + 1, following
            if state == 0:
                out.append(data[begin:i].decode())
                begin = i
        if len(self.arcs) >= MAX_STATES:
            self.arcs.clear()
        arc = self.arcs[held, token] = (data[begin:], "".join(out))
        return arc

    def feed(self, ids) -> str:
        held, arcs, out = self.held, self.arcs, []
        for token in ids:
            held, text = arcs.get((held, token)) or self._arc(held, token)
            out.append(text)
        self.held = held
        return "".join(out)

    def close(self) -> str:
        held, self.held = self.held, b""
        return "�" if held else ""


def explicit(pattern: str) -> re.Pattern:
    """A split pattern with its Unicode classes written out as ranges, which the
    standard engine matches several times faster."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def ranges(name: str) -> str:
        runs = regex.findall(f"[{name}]+", every)
        spans = [(run[0], run[-1]) for run in runs if ord(run[-1]) - ord(run[0]) == len(run) - 1]
        spans += [(c, c) for run in runs if ord(run[-1]) - ord(run[0]) != len(run) - 1 for c in run]
        return "".join(f"\\U{ord(a):08x}-\\U{ord(b):08x}" for a, b in spans)

    classes = {name: ranges(name) for name in set(re.findall(r"\\p\{\w+\}|\\s", pattern + r"\s"))}
    inside = re.sub(r"\[[^\]]*\]", lambda m: re.sub(r"\\p\{\w+\}|\\s", lambda x: classes[x[0]], m[0]), pattern)
    outside = re.sub(r"\\p\{\w+\}|\\s", lambda x: f"[{classes[x[0]]}]", inside)
    return re.compile(outside.replace(r"\S", f"[^{classes[chr(92) + 's']}]"))


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges = Merges(ranks)
        self.pattern = explicit(pattern)
        self.pieces = Pieces(Encoder(self.merges))
        self.decoding: dict[tuple[bytes, int], tuple[bytes, str]] = {}

    def encode_stream(self, text: str) -> Iterator[bytes]:
        """Packed ids in runs; a run is all that is held at a time."""
        found = (m[0] for m in self.pattern.finditer(text)) if len(text) > 1 << 20 else iter(self.pattern.findall(text))
        while True:
            if len(self.pieces) > MAX_PIECES:
                self.pieces.clear()
            run = b"".join(map(self.pieces.__getitem__, islice(found, RUN)))
            if not run:
                return
            yield run

    def encode(self, text: str) -> array:
        ids = array("I")
        for run in self.encode_stream(text):
            ids.frombytes(run)
        return ids

    def decoder(self) -> Decoder:
        return Decoder(self.merges.bytes_of, self.decoding)

    def decode(self, ids) -> str:
        decoder = self.decoder()
        return decoder.feed(ids) + decoder.close()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, made once per worker."""
    if (path, pattern) not in _CODECS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _CODECS[path, pattern] = Codec(ranks, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` with the ids packed as little-endian 32-bit integers."""
    def run(columns):
        tool = codec(path, pattern)
        return ((i, b"".join(tool.encode_stream(t))) for i, t in zip(*columns))

    return map_rows(docs.select("doc_id", text_of("text").alias("text")), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text`` from packed ids."""
    def run(columns):
        tool = codec(path, pattern)
        return ((i, tool.decode(array("I", ids or b""))) for i, ids in zip(*columns))

    return map_rows(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Counts and hashes of the ids and of what they decode to, in one pass: ids
    are hashed and decoded as they are made and never kept whole."""
    def run(columns):
        tool = codec(path, pattern)
        for doc_id, text in zip(*columns):
            n, ids_hash, text_hash, decoder = 0, hashlib.sha256(), hashlib.sha256(), tool.decoder()
            for packed in tool.encode_stream(text):
                ids = array("I", packed)
                n += len(ids)
                ids_hash.update(packed)
                text_hash.update(decoder.feed(ids).encode())
            text_hash.update(decoder.close().encode())
            yield doc_id, n, ids_hash.hexdigest(), text_hash.hexdigest()

    return map_rows(
        docs.select("doc_id", text_of("text").alias("text")), run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
