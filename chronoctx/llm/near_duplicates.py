"""N-gram Jaccard join with Bayesian pruning.

A document is its set of shingles of five words. Documents with equal sets form
one class; the join runs between classes, and copies are never expanded.

1. Every class gets 128 MinHash values. Bands of four values give buckets; two
   classes at similarity 0.8 share none of 32 bands once in about twenty million.
2. In a bucket members are compared with leaders only. A member near a leader is
   absorbed, others become leaders; by the triangle inequality a wider radius
   around leaders holds every class that is similar to an absorbed one. What lies
   in it becomes one candidate cluster. A bucket gives one edge per member.
3. Within a cluster, in blocks, pairs compare their MinHash values step by step.
   A pair is dropped when the posterior probability that its similarity reaches
   the threshold falls below the tolerance; all others are verified exactly.
   Blocks give out numbers of links, and a forest of links per block, not pairs.
4. The forests' components are the groups of near duplicates.

Words are runs of letters, digits and underscores in lower case. A text of fewer
than five words is one shingle of all it has; texts without words (null and empty
ones too) have equal, empty sets. Rows with equal ids are documents of their own;
ids may be null. Extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chronoctx.llm.common import free_name, map_rows, partitions, row_key, text_of
from chronoctx.llm.components import components
from chronoctx.plans.session import store

WORDS = 5
THRESHOLD = 0.8
HASHES, BAND = 128, 4
#: MinHash values that a pair compares at a time.
STEP = 32
TOLERANCE = 1e-9
BLOCK = 512
MAX_WORDS = 1 << 19
#: A member with so many equal values is absorbed by its leader: its similarity
#: is above 0.68, but for one case in millions. What is similar to it then has at
#: least 0.48 to the leader, and is kept down to ``NEAR_LEADER`` equal values.
ABSORBED = 109
RADIUS = 0.48

_WORD = re.compile(r"\w+")
_SEEDS = np.random.default_rng(20240501)
_A = (_SEEDS.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1))
_B = _SEEDS.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def fewest_equal(n: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values of ``n`` with which the similarity still reaches
    the threshold with a probability of ``tolerance``, from a uniform prior: the
    posterior is a beta distribution, its tail a binomial sum."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


NEAR_LEADER = fewest_equal(HASHES, RADIUS, 1e-6)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_HASHES = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = _WORD.findall(text.lower())
    if len(_HASHES) > MAX_WORDS:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    width = min(WORDS, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(out)])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values; all ones for an empty set."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    low = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(low), 2048):
        least = np.minimum(least, (low[start:start + 2048, None] * _A + _B).min(axis=0))
    return least


def _documents(docs: DataFrame) -> DataFrame:
    """``k, row, doc_id, a, b, signature``: a row's key and number, and 128 bits
    that name its set of shingles."""
    rows = docs.select(
        "doc_id", text_of("text").alias("text"), F.monotonically_increasing_id().alias("row"), row_key("doc_id", "text").alias("k"))

    def run(columns):
        for doc_id, text, row, k in zip(*columns):
            found = shingles(text)
            a, b = (xxhash.xxh64_intdigest(found.tobytes(), seed) - (1 << 63) for seed in (1, 2))
            yield row, k, doc_id, a, b, signature(found).tobytes()

    return map_rows(rows, run, "row long, k struct<a:bigint,b:bigint>, doc_id long, a long, b long, signature binary")


def _bands(columns) -> Iterator[tuple]:
    weights = np.random.default_rng(5).integers(1, 1 << 63, BAND, dtype=np.uint64) | np.uint64(1)
    for rep, data in zip(*columns):
        parts = np.frombuffer(data, np.uint32).reshape(-1, BAND).astype(np.uint64)
        keys = _mixed((parts * weights).sum(axis=1, dtype=np.uint64) + np.arange(len(parts), dtype=np.uint64))
        for key in keys.view(np.int64).tolist():
            yield key, rep


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key those whose key comes up again. A run is not held:
    its first row waits for the second, the others pass."""
    waiting, last, passed = None, None, False
    for batch in batches:
        keys, reps = batch.column("key").to_numpy(), batch.column("rep").to_numpy()
        if not len(keys):
            continue
        if waiting is not None and not passed:
            keys, reps = np.concatenate(([waiting[0]], keys)), np.concatenate(([waiting[1]], reps))
            begun = False
        else:
            begun = waiting is not None and keys[0] == waiting[0]
        same = keys[1:] == keys[:-1]
        take = np.concatenate(([begun], same)) | np.concatenate((same, [False]))
        waiting, passed = (keys[-1], reps[-1]), bool(take[-1])
        yield pa.RecordBatch.from_arrays([pa.array(keys[take]), pa.array(reps[take])], ["key", "rep"])


def _cluster_bucket(rows: pa.Table) -> pa.Table:
    """The components of a bucket's members and leaders, one edge per member."""
    order = np.argsort(rows.column("rep").to_numpy(), kind="stable")
    reps = rows.column("rep").to_numpy()[order]
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)[order]
    left, root = np.arange(len(reps)), np.arange(len(reps))
    while len(left):
        leader, rest = left[0], left[1:]
        # Members absorbed earlier may be near this leader too.
        equal = (sketch == sketch[leader]).sum(axis=1)
        met = np.unique(root[equal >= NEAR_LEADER])
        if len(met) > 1:
            root[np.isin(root, met)] = met[0]
        left = rest[equal[rest] < ABSORBED]
    hung = np.flatnonzero(root != np.arange(len(reps)))
    return pa.table({"u": reps[hung], "v": reps[root[hung]]})


def _sorted_by_key(rows: DataFrame, n: int) -> DataFrame:
    return rows.repartition(n, "key").sortWithinPartitions("key")


def _runs(function: Callable, schema: pa.Schema):
    """``function`` on each run of equal keys of sorted batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.Table | None:
            if not held:
                return None
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            return function(table)

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            out = []
            for start, end in zip(cuts, cuts[1:]):
                if last is not None and keys[start] != last:
                    out.append(close())
                last = keys[start]
                held.append(batch.slice(start, end - start))
            for table in out:
                if table is not None:
                    yield from table.cast(schema).to_batches()
        table = close()
        if table is not None:
            yield from table.cast(schema).to_batches()

    return run


def _survivors(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature matrices that pass every comparison."""
    i, j = np.divmod(np.arange(len(one) * len(other)), len(other))
    equal = np.zeros(len(i), np.int32)
    for at in range(0, HASHES, STEP):
        for start in range(0, len(i), 1 << 16):
            part = slice(start, start + (1 << 16))
            equal[part] += (one[i[part], at:at + STEP] == other[j[part], at:at + STEP]).sum(axis=1, dtype=np.int32)
        keep = equal >= fewest_equal(at + STEP, THRESHOLD, TOLERANCE)
        i, j, equal = i[keep], j[keep], equal[keep]
    return i, j


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets. Many pairs of few sets are
    counted at once, by products of their incidence matrix."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for start in range(0, int(place[-1]) + 1, width):
        low, high = np.searchsorted(place, (start, start + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[low:high], place[low:high] - start] = 1
        total += part @ part.T
    return total[i, j].astype(np.int64)


def _verify(key: tuple, rows: pa.Table) -> pa.Table:
    """Links within clusters, or between two blocks of one."""
    out: dict[str, list] = {"rep": [], "links": [], "u": [], "v": []}
    names = np.column_stack([rows.column(c).to_numpy() for c in ("cluster", "low", "high", "rep")])
    order = np.lexsort(names.T[::-1])
    names = names[order]
    # Repeated rows bring a class more than once.
    first = np.concatenate(([True], (names[1:] != names[:-1]).any(axis=1)))
    rows, names = rows.take(pa.array(order[first])), names[first, :3]
    cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
    for start, end in zip(cuts, cuts[1:]):
        _links(rows.slice(start, end - start).combine_chunks(), out)
    return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})


def _links(part: pa.Table, out: dict[str, list]) -> None:
    reps, copies, block = (part.column(c).to_numpy() for c in ("rep", "copies", "block"))
    signatures = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
    sets = [np.frombuffer(s, np.uint64) for s in part.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    first, second = int(part.column("low")[0].as_py()), int(part.column("high")[0].as_py())
    one, other = np.flatnonzero(block == first), np.flatnonzero(block == second)
    i, j = _survivors(signatures[one], signatures[other])
    i, j = one[i], other[j]
    if first == second:
        i, j = i[i < j], j[i < j]
    common = _common(sets, i, j)
    # In whole numbers, so that no rounding decides a pair at the threshold.
    linked = common * 10 >= (sizes[i] + sizes[j] - common) * round(THRESHOLD * 10)
    i, j = i[linked], j[linked]
    links = np.bincount(i, copies[j], len(reps)) + np.bincount(j, copies[i], len(reps))
    parent = list(range(len(reps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    for k in np.flatnonzero(links).tolist():
        out["rep"].append(int(reps[k]))
        out["links"].append(int(links[k]))
        out["u"].append(int(reps[k]))
        out["v"].append(int(reps[root(k)]))


def _blocks(columns) -> Iterator[tuple]:
    """Every class with its shingles, once for each pair of blocks that has its own."""
    for rep, cluster, blocks, copies, data, text in zip(*columns):
        found, own = shingles(text).tobytes(), rep * 0x9E3779B1 % (1 << 32) % blocks
        for other in range(blocks):
            low, high = min(own, other), max(own, other)
            yield cluster, low, high, blocks, own, rep, copies, data, found


def _members(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents' rows, and what is known about each class of equal sets."""
    n = partitions(docs.sparkSession)
    seen = store(_documents(docs), "signatures")
    classes = store(
        seen.groupBy("a", "b").agg(
            F.min(F.struct("row", "k")).alias("first"), F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("copies"),
            F.first("signature").alias("signature"))
        .select("a", "b", F.col("first.row").alias("rep"), F.col("first.k").alias("k"), "set_id", "copies", "signature"),
        "classes")
    bands = map_rows(classes.select("rep", "signature"), _bands, "key long, rep long")
    shared = _sorted_by_key(bands, 2 * n).mapInArrow(_shared, "key long, rep long")
    sketches = map_rows(classes.select("rep", "signature"), _sketches, "rep long, sketch binary")
    buckets = _sorted_by_key(shared.join(sketches, "rep").select("key", "rep", "sketch"), 2 * n)
    edges = buckets.mapInArrow(_runs(_cluster_bucket, pa.schema([("u", pa.int64()), ("v", pa.int64())])), "u long, v long")
    clusters = store(components(edges), "clusters")
    sized = clusters.join(
        clusters.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "root")
    chosen = sized.select(F.col("node").alias("rep"), F.col("root").alias("cluster"), "blocks").join(classes, "rep").select(
        "k", "rep", "cluster", "blocks", "copies", "signature")
    texts = docs.select(row_key("doc_id", "text").alias("k"), text_of("text").alias("text")).join(chosen.hint("shuffle_hash"), "k")
    blocks = map_rows(
        texts.select("rep", "cluster", "blocks", "copies", "signature", "text"), _blocks,
        "cluster long, low int, high int, blocks int, block int, rep long, copies long, signature binary, shingles binary")
    # Small clusters share a task's group; each pair of blocks of a large one has its own.
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(8 * n))).otherwise(F.xxhash64("cluster", "low", "high"))
    verified = store(
        blocks.withColumn("pack", pack)
        .groupBy("pack").applyInArrow(_verify, "rep long, links long, u long, v long"), "links")
    groups = components(verified.select("u", "v")).select(F.col("node").alias("rep"), "root")
    links = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (
        classes.drop("k", "signature").join(groups, "rep", "left").join(links, "rep", "left")
        .select("a", "b", "set_id", F.coalesce("root", "rep").alias("root"),
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    named = known.groupBy("root").agg(F.min("set_id").alias("class_id"))
    return seen, known.join(named, "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, set_id, n_links``, one row per document: the smallest
    id of its group of near duplicates, the smallest id with just its set of
    shingles, and the number of other documents that it is linked to."""
    seen, known = _members(docs)
    return seen.select("doc_id", "a", "b").join(known, ["a", "b"]).select("doc_id", "class_id", "set_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    seen, known = _members(docs)
    key = free_name(docs, "_near_key")
    kept = (
        seen.select("doc_id", "row", "k", "a", "b").join(known.select("a", "b", "root"), ["a", "b"])
        .groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "k")).alias("first"))
        .select(F.col("first.k").alias(key))
    )
    return (
        docs.withColumn(key, row_key("doc_id", "text")).join(kept.hint("shuffle_hash"), key, "left_semi")
        .dropDuplicates([key]).drop(key)
    )


def _sketches(columns) -> Iterator[tuple]:
    """A byte of each MinHash value."""
    for rep, data in zip(*columns):
        yield rep, (np.frombuffer(data, np.uint32) >> np.uint32(24) ^ np.frombuffer(data, np.uint32)).astype(np.uint8).tobytes()
