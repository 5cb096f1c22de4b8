"""Suffix-array dedup of repeated passages by prefix-free parsing.

A text is parsed at triggers: places whose rolling hash over 20 bytes is the
least among the 31 such places of some 50-byte window. What a trigger decides is
the content around it alone, so equal windows hold the same trigger at the same
place, and every window belongs to the phrase of its first least trigger. A
phrase is the text of all windows of one trigger. The distinct phrases are the
dictionary, the documents' sequences of phrases the parse.

Two windows can only be equal if they stand in phrases of the same trigger, and a
phrase found twice is equal in all its windows. So the order of the corpus comes
from the suffixes of the dictionary, sorted to a depth of 50 bytes, and from the
smallest document in whose parse each phrase stands:

1. Blocks of documents send the hashes of their triggers to shards, each once;
   shards answer which ones more than one document has.
2. Blocks send the phrases of those triggers, each once with its smallest
   document. Where all phrases of a trigger are equal, the phrase's smallest
   document holds for its windows; else the shard sorts the suffixes of its
   dictionary and windows that share 50 bytes share their smallest document.
3. Blocks mark every byte of a window that a smaller document has.

A passage in any number of documents is sent once per block. Texts are shuffled
once and reused by the three steps.

A null text counts as empty. Texts under 50 bytes keep all. Rows with equal ids
do not remove each other's bytes; null ids count as smaller than all others.
Very long texts are parsed in pieces. Extra columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from chronoctx.llm.common import partitions, text_of

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1
#: Windows that are parsed at a time; places within fit the low bits of a key.
PIECE = 1 << 18
PLACE_BITS = 20
BLOCK_BYTES = 1 << 22
NO_ID = -(1 << 63)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 20 bytes from every place on."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    eight = np.ascontiguousarray(words).view("<u8").ravel()
    n = len(data) - GRAM + 1
    h = _mixed(eight[:n] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    h = _mixed(h + eight[8:8 + n] * np.uint64(0xC2B2AE3D27D4EB4F))
    return _mixed(h + (eight[12:12 + n] >> np.uint64(32)) * np.uint64(0x165667B19E3779F9))


def parse(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The phrases of a text: hash and place of the trigger, first and last window."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty, empty, empty
    hashes, places, firsts, lasts = [], [], [], []
    whole = np.frombuffer(data, np.uint8)
    for start in range(0, n, PIECE):
        count = min(PIECE, n - start)
        h = gram_hashes(whole[start:start + count + LENGTH - 1])
        key = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width * 2 <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < SPAN:
            key = np.minimum(key[:-(SPAN - width)], key[SPAN - width:])
        place = (key & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:] - 1, [count - 1]))
        hashes.append(h[place[first]])
        places.append(place[first] + start)
        firsts.append(first + start)
        lasts.append(last + start)
    return tuple(np.concatenate(x) for x in (hashes, places, firsts, lasts))


def _texts(docs: pa.Table):
    for doc_id, text in zip(docs.column("doc_id").to_pylist(), docs.column("text")):
        yield doc_id, text.as_buffer().to_pybytes()


def _by_shard(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``hashes`` by shard, and the shard of each."""
    shard = (hashes >> np.uint64(33)).astype(np.int64) % n
    return np.lexsort((hashes, shard)), shard


def _triggers(n_shards: int):
    """Step 1 in a block: ``shard, block, hashes, several``."""
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        found = [np.unique(parse(data)[0]) for _, data in _texts(docs)]
        hashes, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
        order, shard = _by_shard(hashes, n_shards)
        names, starts = np.unique(shard[order], return_index=True)
        ends = [*starts[1:].tolist(), len(order)]
        rows = [order[a:b] for a, b in zip(starts, ends)]
        return pa.table({
            "shard": pa.array(names, pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
            "hashes": pa.array([hashes[r].tobytes() for r in rows], pa.binary()),
            "several": pa.array([np.packbits(counts[r] > 1).tobytes() for r in rows], pa.binary()),
        })

    return run


def _shared(key: tuple, rows: pa.Table) -> pa.Table:
    """Step 1 in a shard: of each block's hashes those that more documents have."""
    asked = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)).astype(bool)
               for x, a in zip(rows.column("several").to_pylist(), asked)]
    every, inverse, counts = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[inverse[np.concatenate(several)]] = True
    flags, at, out = shared[inverse], 0, []
    for hashes in asked:
        out.append(hashes[flags[at:at + len(hashes)]].tobytes())
        at += len(hashes)
    table = pa.table({"block": rows.column("block"), "hashes": pa.array(out, pa.binary())})
    return table.filter(pa.array([bool(x) for x in out], pa.bool_()))


def _phrases_of(docs: pa.Table, shared: np.ndarray):
    """Documents of a block with those of their phrases whose triggers are shared."""
    for doc_id, data in _texts(docs):
        hashes, places, firsts, lasts = parse(data)
        at = np.searchsorted(shared, hashes)
        keep = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == hashes) if len(shared) else np.zeros(0, np.int64)
        yield doc_id, data, hashes[keep], places[keep], firsts[keep], lasts[keep]


def _hashes_in(answers: pa.Table) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(answers.column("hashes").to_pylist()), np.uint64))


def _name(place: int, phrase: bytes) -> int:
    """What names a phrase: its content, and where its trigger stands."""
    return xxhash.xxh64_intdigest(phrase, place)


#: ``docs`` and ``content`` are compressed; names follow from the content.
_PHRASES = "shard int, block int, triggers binary, places binary, lengths binary, docs binary, content binary"


def _phrases(n_shards: int):
    """Step 2 in a block: the distinct phrases of shared triggers, per shard, with
    their smallest documents."""
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        shared = _hashes_in(answers)
        known: dict[int, list] = {}
        for doc_id, data, hashes, places, firsts, lasts in _phrases_of(docs, shared):
            own = NO_ID if doc_id is None else doc_id
            for trigger, place, first, last in zip(hashes.tolist(), places.tolist(), firsts.tolist(), lasts.tolist()):
                phrase = data[first:last + LENGTH]
                name = _name(place - first, phrase)
                seen = known.get(name)
                if seen is None:
                    known[name] = [trigger, place - first, own, phrase]
                elif own < seen[2]:
                    seen[2] = own
        values, packer = list(known.values()), zstandard.ZstdCompressor(level=3)
        triggers = np.array([v[0] for v in values], np.uint64)
        order, shard = _by_shard(triggers, n_shards)
        shards, starts = np.unique(shard[order], return_index=True)
        out: dict[str, list] = {c.split()[0]: [] for c in _PHRASES.split(", ")}
        for number, a, b in zip(shards.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)]):
            part = order[a:b]
            some = [values[i] for i in part.tolist()]
            for column, value in zip(out, (
                number, key[0].as_py(), triggers[part].tobytes(),
                np.array([v[1] for v in some], np.uint8).tobytes(), np.array([len(v[3]) for v in some], np.uint8).tobytes(),
                packer.compress(np.array([v[2] for v in some], np.int64).tobytes()), packer.compress(b"".join(v[3] for v in some)),
            )):
                out[column].append(value)
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
        return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(out.items(), kinds)})

    return run


def suffix_order(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ``text`` from ``starts`` on, by their first 50
    bytes, and at equal ones as they stand."""
    keys = _prefixes(text, starts)
    return np.lexsort(keys.T[::-1])


def _prefixes(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first 50 bytes from each start on, as numbers that sort like them."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view(">u8").ravel()
    parts = [words[starts + i].astype(np.uint64) for i in range(0, LENGTH - 8, 8)]
    return np.column_stack([*parts, words[starts + LENGTH - 8].astype(np.uint64)])


def smallest_documents(triggers: np.ndarray, places: np.ndarray, lengths: np.ndarray, docs: np.ndarray, content: np.ndarray) -> list[np.ndarray]:
    """For each phrase of the dictionary the smallest document of its windows: one
    number where all windows share it, else one per window."""
    out: list[np.ndarray | None] = [None] * len(triggers)
    begins = np.cumsum(lengths) - lengths
    order = np.argsort(triggers, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], triggers[order][1:] != triggers[order][:-1], [True])))
    several = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a == 1:
            out[order[a]] = docs[order[a]:order[a] + 1]
        else:
            several.append(order[a:b])
    if several:
        phrases = np.concatenate(several)
        counts = lengths[phrases] - LENGTH + 1
        owner = np.repeat(np.arange(len(phrases)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = begins[phrases][owner] + within
        keys = _prefixes(content, starts)
        ranked = np.lexsort(keys.T[::-1])
        new = np.concatenate(([True], (keys[ranked[1:]] != keys[ranked[:-1]]).any(axis=1)))
        least = np.minimum.reduceat(docs[phrases][owner][ranked], np.flatnonzero(new))
        windows = np.empty(len(owner), np.int64)
        windows[ranked] = least[np.cumsum(new) - 1]
        for i, a, n in zip(phrases.tolist(), (np.cumsum(counts) - counts).tolist(), counts.tolist()):
            part = windows[a:a + n]
            out[i] = part[:1] if (part == part[0]).all() else part
    return out


def _resolve(key: tuple, rows: pa.Table) -> pa.Table:
    """Step 2 in a shard: ``block, names, hashes, counts, smallest`` of each
    block's phrases."""
    rows = rows.to_pylist()
    number: dict[int, int] = {}
    parts: list[list] = []
    asked: list[list[int]] = []
    for row in rows:
        at, own = 0, []
        content = zstandard.decompress(row["content"])
        docs = np.frombuffer(zstandard.decompress(row["docs"]), np.int64).tolist()
        for trigger, place, length, doc in zip(np.frombuffer(row["triggers"], np.uint64).tolist(), row["places"], row["lengths"], docs):
            phrase = content[at:at + length]
            at += length
            name = _name(place, phrase)
            own.append(name)
            i = number.get(name)
            if i is None:
                number[name] = len(parts)
                parts.append([trigger, place, length, doc, phrase])
            elif doc < parts[i][3]:
                parts[i][3] = doc
        asked.append(own)
    columns = list(zip(*parts))
    found = smallest_documents(
        np.array(columns[0], np.uint64), np.array(columns[1], np.int64), np.array(columns[2], np.int64),
        np.array(columns[3], np.int64), np.frombuffer(b"".join(columns[4]), np.uint8))
    out: dict[str, list] = {"block": [], "names": [], "hashes": [], "counts": [], "smallest": []}
    for row, own in zip(rows, asked):
        mine = [found[number[name]] for name in own]
        out["block"].append(row["block"])
        out["names"].append(np.array(own, np.uint64).tobytes())
        out["hashes"].append(row["triggers"])
        out["counts"].append(np.array([len(m) for m in mine], np.uint8).tobytes())
        out["smallest"].append(np.concatenate(mine).tobytes())
    return pa.table({c: pa.array(v, pa.int32() if c == "block" else pa.binary()) for c, v in out.items()})


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(with_text: bool):
    """Step 3 in a block: the bytes that stay."""
    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        known: dict[int, np.ndarray] = {}
        for row in answers.select(["names", "counts", "smallest"]).to_pylist():
            counts = np.frombuffer(row["counts"], np.uint8)
            parts = np.split(np.frombuffer(row["smallest"], np.int64), np.cumsum(counts)[:-1])
            known.update(zip(np.frombuffer(row["names"], np.uint64).tolist(), parts))
        out: list[list] = [[] for _ in RESULT.split(", ")]
        for doc_id, data, hashes, places, firsts, lasts in _phrases_of(docs, _hashes_in(answers)):
            edges = np.zeros(len(data) + 1, np.int32)
            own = NO_ID if doc_id is None else doc_id
            for place, first, last in zip(places.tolist(), firsts.tolist(), lasts.tolist()):
                smallest = known.get(_name(place - first, data[first:last + LENGTH]))
                if smallest is None:
                    continue
                if len(smallest) == 1:
                    if smallest[0] < own:
                        edges[first] += 1
                        edges[last + LENGTH] -= 1
                else:
                    for window in np.flatnonzero(smallest < own).tolist():
                        edges[first + window] += 1
                        edges[first + window + LENGTH] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            for column, value in zip(out, (
                doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table({c.split()[0]: pa.array(v, kind) for c, v, kind in zip(RESULT.split(", "), out, kinds)})

    return run


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``; ``kept`` are
    the remaining bytes, null unless asked for."""
    n = partitions(docs.sparkSession)
    rows = docs.select("doc_id", text_of("text").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks, n_shards = max(2 * n, -(-total // BLOCK_BYTES)), max(n, -(-total // BLOCK_BYTES))
    blocks = rows.select(F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(n_blocks)).cast("int").alias("block"), "doc_id", "text")
    grouped = blocks.groupBy("block")
    triggers = grouped.applyInArrow(_triggers(n_shards), "shard int, block int, hashes binary, several binary")
    shared = triggers.groupBy("shard").applyInArrow(_shared, "block int, hashes binary")
    phrases = grouped.cogroup(shared.groupBy("block")).applyInArrow(_phrases(n_shards), _PHRASES)
    resolved = phrases.groupBy("shard").applyInArrow(
        _resolve, "block int, names binary, hashes binary, counts binary, smallest binary")
    return grouped.cogroup(resolved.groupBy("block")).applyInArrow(_cut(with_text), RESULT)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, with_text=False).drop("kept")
