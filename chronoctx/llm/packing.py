"""Best-fit packing by a grouping genetic algorithm.

Documents become tokens and are cut into pieces of at most one sequence; pieces
as long as a sequence fill one. The others are dealt at random into cells of a
few thousand. Each cell evolves on several islands: an individual is a whole
packing of the cell, its genes are the sequences. A crossover takes well-filled
sequences of one parent whole, removes those of the other parent that share a
piece with them, and puts the displaced pieces back by best fit, longest first.
After each epoch every island sends its elite to the next one. A cell's best
packing is its result. A cell leaves at most about one sequence part empty.

A null or empty text is one piece, the end token. Very long texts become many
pieces, which are dealt out like any others. Added tokens that stand in a text
("<|endoftext|>") are those tokens, as the tokenizer has it. Equal rows are pieces of their own.
Ids may be null. Extra columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import random
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoctx.llm.common import free_name, map_rows, text_of
from chronoctx.plans.session import store

CAPACITY = 2048
END_ID = 0
CELL_PIECES = 4096
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
#: A sequence is well filled from this share of its capacity on.
WELL_FILLED = 0.99
MAX_WORDS = 1 << 19

#: White space as the tokenizer's own rules have it.
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_LETTERS = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: The tokenizer's own parts, for texts of the first 256 characters.
_PARTS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+")


def _narrow(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Tokens:
    """A tokenizer that remembers what it made of a part. Parts never span white
    space. Texts of the first 256 characters are lower-cased and split here, and
    unknown parts go to the tokenizer in one text, as each ends with one token
    that marks a part's end. Of other texts it gets every unknown word.

    With ``added``, texts are cut at the tokenizer's added tokens first and those
    get their own ids, as the tokenizer does unless told otherwise; without, they
    are spelled like any other text."""

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        known = self.tokenizer.get_added_tokens_decoder() if added else {}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in known.values()):
            raise ValueError("added tokens that depend on the text around them are not supported")
        self.added = {t.content: array("I", [i]).tobytes() for i, t in known.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _learn_parts(self, parts: list[str]) -> None:
        for i in range(0, len(parts), 4096):
            some = parts[i:i + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            data = ids.tobytes()
            self.known.update(zip(some, map(data.__getitem__, map(slice, [0, *cuts], cuts))))

    def _learn_words(self, words: list[str]) -> None:
        for word, encoded in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self.known[word] = array("I", encoded.ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.added:
            return self._encode(texts)
        cut = [self.cut.split(t) for t in texts]  # every second one is an added token
        plain = iter(self._encode([p for parts in cut for p in parts[::2]]))
        return [b"".join(self.added[p] if i % 2 else next(plain) for i, p in enumerate(parts)) for parts in cut]

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        narrow = [_narrow(t) for t in texts]
        split = [
            _PARTS.findall(t.lower()) if n else _SPACE.split(t) if _ODD_SPACE.search(t) else t.split()
            for t, n in zip(texts, narrow)
        ]
        self._learn_parts(list(set().union(*(s for s, n in zip(split, narrow) if n)).difference(self.known)))
        self._learn_words(list(set().union(*(s for s, n in zip(split, narrow) if not n)).difference(self.known)))
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in split]


_TOKENS: dict[str, Tokens] = {}


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's tokens, cut."""
    end = array("I", [END_ID]).tobytes()

    def run(columns):
        if path not in _TOKENS:
            _TOKENS[path] = Tokens(path, added=True)
        for doc_id, ids in zip(columns[0], _TOKENS[path].encode(columns[1])):
            ids += end
            for piece, start in enumerate(range(0, len(ids) // 4, CAPACITY)):
                part = ids[4 * start:4 * (start + CAPACITY)]
                yield doc_id, piece, start, len(part) // 4, zlib.crc32(part)

    return map_rows(
        docs.select("doc_id", text_of("text").alias("text")), run,
        "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(groups: list[tuple[int, list[int]]], items: list[int], lengths: list[int]) -> list[tuple[int, list[int]]]:
    """``groups`` (fill, items) with ``items`` added, longest first, each where
    the least room is left. A bit per free amount finds that place."""
    by_free: list[list[int]] = [[] for _ in range(CAPACITY + 1)]
    mask, out = 0, [(fill, list(group)) for fill, group in groups]
    for i, (fill, _) in enumerate(out):
        by_free[CAPACITY - fill].append(i)
        mask |= 1 << CAPACITY - fill
    for item in sorted(items, key=lengths.__getitem__, reverse=True):
        size = lengths[item]
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            i = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
            out[i][1].append(item)
        else:
            free, i = CAPACITY, len(out)
            out.append((0, [item]))
        left = free - size
        out[i] = (CAPACITY - left, out[i][1])
        by_free[left].append(i)
        mask |= 1 << left
    return out


def fitness(packing: list[tuple[int, list[int]]]) -> tuple[int, int]:
    """Fewer sequences first, then fuller ones beside emptier ones."""
    return -len(packing), sum(fill * fill for fill, _ in packing)


def crossover(mother, father, lengths: list[int], chance: random.Random):
    """The mother's packing with some of the father's well-filled sequences."""
    whole = [g for g in father if g[0] >= WELL_FILLED * CAPACITY]
    chosen = chance.sample(whole, min(len(whole), 1 + int(len(whole) * chance.uniform(0.1, 0.5)))) if whole else []
    taken = {item for _, group in chosen for item in group}
    kept, displaced = [], []
    # The emptiest sequences are opened too, so their pieces can find better places.
    weak = sorted(fill for fill, _ in mother)[max(1, len(mother) // 50) - 1] if mother else 0
    for fill, group in mother:
        if taken.isdisjoint(group) and fill > weak:
            kept.append((fill, group))
        else:
            displaced += [item for item in group if item not in taken]
    return best_fit(kept + chosen, displaced, lengths)


def first_population(lengths: list[int], chance: random.Random, size: int = POPULATION) -> list:
    """Best fit by falling length, and by lengths that are shaken a little."""
    everything = list(range(len(lengths)))
    out = [best_fit([], everything, lengths)]
    for _ in range(size - 1):
        order = sorted(everything, key=lambda i: -lengths[i] * chance.uniform(0.9, 1.0))
        cut = chance.randrange(len(order) // 2 + 1)
        out.append(best_fit(best_fit([], order[:cut], lengths), order[cut:], lengths))
    return out


def evolve(population: list, lengths: list[int], chance: random.Random, generations: int = GENERATIONS) -> list:
    """Elitist generations: children replace the worst. No packing needs fewer
    sequences than all tokens fill, so a packing of that many ends the search."""
    least = -(-sum(lengths) // CAPACITY)
    size = len(population)
    population = sorted(population, key=fitness, reverse=True)
    for _ in range(generations):
        if len(population[0]) <= least:
            break
        children = [crossover(*chance.sample(population, 2), lengths, chance) for _ in range(size // 2)] if size > 1 else []
        population = sorted(population + children, key=fitness, reverse=True)[:size]
    return population


def _to_bytes(packing, n: int) -> bytes:
    genome = np.zeros(n, dtype=np.int32)
    for number, (_, group) in enumerate(packing):
        genome[group] = number
    return genome.tobytes()


def _from_bytes(data: bytes, lengths: list[int]) -> list[tuple[int, list[int]]]:
    genome = np.frombuffer(data, np.int32)
    groups: list[list[int]] = [[] for _ in range(int(genome.max()) + 1 if len(genome) else 0)]
    for item, number in enumerate(genome.tolist()):
        groups[number].append(item)
    return [(sum(lengths[i] for i in group), group) for group in groups]


_STATE = "cell int, island int, lengths binary, packings array<binary>"
_STATE_FIELDS = pa.schema([
    ("cell", pa.int32()), ("island", pa.int32()), ("lengths", pa.binary()), ("packings", pa.list_(pa.binary()))])


def _epoch(number: int):
    """One epoch of one island: its packings and those that arrived evolve."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        cell, island = (k.as_py() for k in key)
        rows = sorted(rows.to_pylist(), key=lambda r: (r["packings"] is not None, r["packings"]))
        data = rows[0]["lengths"]
        lengths = np.frombuffer(data, np.int32).tolist()
        chance = random.Random(f"{cell}/{island}/{number}")
        packings = [_from_bytes(p, lengths) for r in rows for p in r["packings"] or ()] or first_population(lengths, chance)
        best = evolve(packings, lengths, chance)[:POPULATION]
        out = [_to_bytes(p, len(lengths)) for p in best]
        return pa.Table.from_pylist(
            [{"cell": cell, "island": island, "lengths": data, "packings": out}], schema=_STATE_FIELDS)

    return run


def pack(cut: DataFrame) -> DataFrame:
    """``cut`` (pieces of at most the capacity) with ``sequence_id`` and ``offset``."""
    row, place = free_name(cut, "_row"), free_name(cut, "_cell")
    numbered = store(cut.withColumn(row, F.monotonically_increasing_id()), "pieces")
    n_cells = max(1, -(-numbered.where(F.col("length") < CAPACITY).count() // CELL_PIECES))
    numbered = numbered.withColumn(place, F.pmod(F.xxhash64(row), F.lit(n_cells)).cast("int"))
    lengths = (
        numbered.where(F.col("length") < CAPACITY).groupBy(place)
        .agg(F.array_sort(F.collect_list(F.struct(row, "length"))).alias("rows"))
        .select(F.col(place).alias("cell"), F.transform("rows", lambda r: r["length"].cast("int")).alias("lengths"))
    )

    def start(columns):
        for cell, values in zip(*columns):
            for island in range(ISLANDS):
                yield cell, island, np.array(values, np.int32).tobytes(), None

    state = map_rows(lengths, start, _STATE)
    for number in range(EPOCHS):
        if number:
            elite = F.slice("packings", 1, 1)
            state = state.select("cell", "lengths", F.inline(F.array(
                F.struct("island", F.col("packings").alias("packings")),
                F.struct(((F.col("island") + 1) % ISLANDS).alias("island"), elite.alias("packings")),
            ))).select("cell", "island", "lengths", "packings")
        state = state.groupBy("cell", "island").applyInArrow(_epoch(number), _STATE)

    def rated(columns):
        for cell, data, packings in zip(*columns):
            packing = _from_bytes(packings[0], np.frombuffer(data, np.int32).tolist())
            bins, squares = fitness(packing)
            yield cell, bins, squares, packings[0]

    best = map_rows(
        state.select("cell", "lengths", "packings"), rated, "_cell int, bins long, squares long, packing binary",
    ).groupBy("_cell").agg(F.max_by("packing", F.struct("bins", "squares", "packing")).alias("packing"))
    columns = cut.schema
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)

    def assign(key: tuple, rows: pa.Table, chosen: pa.Table) -> pa.Table:
        rows = rows.sort_by(row)
        size = rows.column("length").to_numpy()
        cell, part = key[0].as_py(), size < CAPACITY
        number = np.empty(len(size), np.int64)
        if chosen.num_rows:
            number[part] = np.frombuffer(chosen.column("packing")[0].as_py(), np.int32)
        used = int(number[part].max()) + 1 if part.any() else 0
        number[~part] = used + np.arange((~part).sum())
        order = np.argsort(number, kind="stable")
        before = np.cumsum(size[order]) - size[order]
        first = np.concatenate(([True], number[order][1:] != number[order][:-1]))
        offset = np.empty(len(size), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        out = rows.select(columns.names)
        return out.append_column("sequence_id", pa.array((cell << 32) + number)).append_column("offset", pa.array(offset))

    return numbered.groupBy(place).cogroup(best.groupBy("_cell")).applyInArrow(
        assign, f"{shape}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str) -> DataFrame:
    return pack(pieces(docs, path))
