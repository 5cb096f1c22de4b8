"""Nearest neighbours by a forest of random-projection trees.

A tree splits space by hyperplanes between random pairs of vectors, at the
median, down to leaves. A search keeps one priority queue for all trees: it opens
leaves in the order of their margins, how far the query lies on the other side of
the splits above them, and ends when the next margin is beyond the forest's
reach. The candidates of the opened leaves are ranked by their exact cosines.

The forest is fitted on at most ``SAMPLE`` vectors, taken by hash, and every
vector is indexed. Its reach is set so that, within the sample, searches find the
share ``AIM`` of the true neighbours; among more vectors neighbours are nearer
and more of them within reach. What rounding alone could have put beyond a split,
or behind the last of the nearest, is looked at too. Equal vectors are indexed once, with the smallest
``k + 1`` of their ids: no others can be among the nearest ``k``. Each leaf holds
more sample vectors than a search has to return, so none ends short.

Null vectors, and those with null or non-finite components or of length zero,
take no part. Shorter vectors count as followed by zeros. Vectors are scaled by a
power of two first, which changes no cosine, so that very long and very short ones
have one. With fewer candidates than ``k`` all are returned. Ties go to the smaller id; rows that
repeat an id and vector count once. Extra columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoctx.plans.session import store

TREES = 8
SAMPLE = 16_384
LEAF = 64
AIM = 0.985
#: Sample vectors that are searched for to set the reach.
TRIALS = 128
#: Rows of a leaf that are compared at a time; larger leaves are split at random.
CHUNK = 4096
QUERY_BLOCK = 256
#: Margins and cosines that differ by less may differ by rounding only.
ROUNDING = 1e-12


class Tree:
    """Splits as arrays: a node's plane and threshold, and its two children; a
    child below zero is the leaf of that number."""

    def __init__(self, vectors: np.ndarray, leaf: int, chance: np.random.Generator):
        self.planes: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(vectors, np.arange(len(vectors)), leaf, chance)
        self.planes = np.array(self.planes).reshape(-1, vectors.shape[1])

    def _grow(self, vectors: np.ndarray, rows: np.ndarray, leaf: int, chance: np.random.Generator) -> int:
        if len(rows) > leaf:
            one, other = vectors[chance.choice(rows, 2, replace=False)]
            plane = one - other
            plane /= max(np.linalg.norm(plane), 1e-12)
            places = vectors[rows] @ plane
            cut = float(np.median(places))
            low, high = rows[places <= cut], rows[places > cut]
            if min(len(low), len(high)) >= leaf // 4:
                node = len(self.cuts)
                self.planes.append(plane)
                self.cuts.append(cut)
                self.children.append([0, 0])
                self.children[node] = [self._grow(vectors, low, leaf, chance), self._grow(vectors, high, leaf, chance)]
                return node
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), dtype=np.int64)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            high = vectors[rows] @ self.planes[node] > self.cuts[node]
            todo += [(child, part) for child, part in zip(self.children[node], (rows[~high], rows[high])) if len(part)]
        return out


class Forest:
    def __init__(self, vectors: np.ndarray, k: int, seed: int = 11):
        chance = np.random.default_rng(seed)
        leaf = max(LEAF, 8 * (k + 1))
        self.trees = [Tree(vectors, leaf, chance) for _ in range(TREES if len(vectors) > leaf else 1)]
        self.reach = float("inf")
        if len(vectors) > leaf:
            self.reach = self._set_reach(vectors, k)

    @property
    def leaves(self) -> int:
        return max(tree.leaves for tree in self.trees)

    def search(self, vector: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Leaves as ``(margin, tree, leaf)``, nearest first, within reach. Every
        tree's own leaf of the query has margin 0."""
        queue = [(0.0, t, tree.root) for t, tree in enumerate(self.trees)]
        places = [tree.planes @ vector for tree in self.trees]
        while queue:
            margin, t, node = heapq.heappop(queue)
            if margin > self.reach:
                return
            tree = self.trees[t]
            while node >= 0:
                beyond = float(places[t][node]) - tree.cuts[node]
                near = 1 if beyond > 0 else 0
                heapq.heappush(queue, (max(margin, abs(beyond)), t, tree.children[node][1 - near]))
                node = tree.children[node][near]
            yield margin, t, -node - 1

    def _set_reach(self, vectors: np.ndarray, k: int) -> float:
        """The margin within which trials find the aimed share of neighbours."""
        trials = vectors[:: max(1, len(vectors) // TRIALS)][:TRIALS]
        likeness = trials @ vectors.T
        homes = [tree.leaf_of(vectors) for tree in self.trees]
        needed = []
        for vector, row in zip(trials, likeness):
            wanted = np.argpartition(-row, k + 1)[: k + 1]
            margins = [np.full(tree.leaves, np.inf) for tree in self.trees]
            for margin, t, leaf in self.search(vector):
                margins[t][leaf] = margin
            needed.append(np.min([m[home[wanted]] for m, home in zip(margins, homes)], axis=0))
        found = np.sort(np.concatenate(needed))
        return max(_rounding(vectors), float(found[min(len(found) - 1, int(np.ceil(AIM * len(found))) - 1)]))


def _rounding(vectors: np.ndarray) -> float:
    """How far two computations of a dot product of unit vectors may differ, at most."""
    return max(ROUNDING, 4 * (vectors.shape[1] + 8) * np.finfo(float).eps)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact cosines, the same wherever a vector stands."""
    dots = (one * others).sum(axis=1)
    return dots / (np.sqrt((one * one).sum()) * np.sqrt((others * others).sum(axis=1)))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _usable(vectors: DataFrame) -> DataFrame:
    """``id, vec`` of the rows that take part, with a 128-bit name ``v`` of the vector."""
    values = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull())
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    sound = values.where(finite).where(largest > 0)
    width = sound.agg(F.max(F.size("vec"))).first()[0] or 0
    # In two steps, as a power for the smallest numbers is beyond a double.
    half = F.pow(F.lit(2.0), F.floor(-F.log2(largest) / 2))
    scaled = F.transform("vec", lambda x: x * half * half)
    sound = sound.select("id", F.concat(scaled, F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vec"))).alias("vec"))
    key = F.struct(F.xxhash64("vec").alias("a"), F.xxhash64(F.lit("vec"), "vec").alias("b"))
    return sound.select("id", "vec", key.alias("v"))


def _index(forest: Forest, chunks: int):
    """Every vector with the bucket of its leaf in each tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, unit = batch.column("rep").to_numpy(), _unit(_matrix(batch.column("vec")))
            chunk = ids % chunks
            for t, tree in enumerate(forest.trees):
                bucket = (t * forest.leaves + tree.leaf_of(unit)) * chunks + chunk
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), batch.column("rep"), batch.column("vec")], ["bucket", "rep", "vec"])

    return run


def _ask(forest: Forest, chunks: int):
    """Every query with the buckets of the leaves that its search opens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, vector in enumerate(_unit(_matrix(batch.column("vec")))):
                leaves = np.array([t * forest.leaves + leaf for _, t, leaf in forest.search(vector)])
                buckets = (leaves[:, None] * chunks + np.arange(chunks)).ravel()
                take = pa.array(np.full(len(buckets), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets), batch.column("rep").take(take), batch.column("vec").take(take)], ["bucket", "rep", "vec"])

    return run


def _rank(k: int):
    """The nearest of a bucket for each query that asks it."""
    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and rows.num_rows:
            asks, have = _matrix(queries.column("vec")), _matrix(rows.column("vec"))
            query_ids, row_ids = queries.column("rep").to_numpy(), rows.column("rep").to_numpy()
            unit, most, bound = _unit(have), min(len(have), k + 1), _rounding(have)
            for start in range(0, len(asks), QUERY_BLOCK):
                block = asks[start:start + QUERY_BLOCK]
                likeness = _unit(block) @ unit.T
                last = np.partition(likeness, -most, axis=1)[:, -most]
                for i in range(len(block)):
                    picked = np.flatnonzero(likeness[i] >= last[i] - bound)
                    scores = cosines(block[i], have[picked])
                    best = np.lexsort((row_ids[picked], -scores))[: k + 1]
                    out.append((np.full(len(best), query_ids[start + i]), row_ids[picked][best], scores[best]))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query", "rep", "score"), columns)))

    return run


def nearest(vectors: DataFrame, queries: Callable[[Column], Column], k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows to each row of
    ``vectors`` whose id ``queries`` holds for."""
    spark = vectors.sparkSession
    rows = _usable(vectors)
    smallest = Window.partitionBy("v").orderBy("id")
    distinct = store(
        rows.dropDuplicates(["v", "id"]).withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec")),
        "vectors")
    total = distinct.count()
    shape = "bucket long, rep long, vec array<double>"
    result = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], result)
    sample = distinct.select("rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).toArrow()
    forest = Forest(_unit(_matrix(sample.column("vec"))), k)
    chunks = -(-total * max(1, LEAF) // (min(total, SAMPLE) * CHUNK))
    asking = store(rows.where(queries(F.col("id"))).select("id", "v").distinct(), "vector-queries")
    asked = distinct.join(asking.select("v").distinct(), "v", "left_semi")
    buckets = distinct.select("rep", "vec").mapInArrow(_index(forest, chunks), shape)
    asks = asked.select("rep", "vec").mapInArrow(_ask(forest, chunks), shape)
    found = asks.groupBy("bucket").cogroup(buckets.groupBy("bucket")).applyInArrow(_rank(k), "query long, rep long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    top = (
        found.groupBy("query", "rep").agg(F.max("score").alias("score"))
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        .join(distinct.select("rep", "ids"), "rep")
        .groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("groups"))
        .join(distinct.select(F.col("rep").alias("query"), "v"), "query").select("v", "groups")
    )
    members = F.flatten(F.transform("groups", lambda g: F.transform(g["ids"], lambda i: F.struct((-g["score"]).alias("away"), i.alias("id")))))
    others = F.slice(F.array_sort(F.filter(members, lambda m: m["id"] != F.col("id"))), 1, k)
    return (
        asking.join(top, "v").select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "m"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("m.id").alias("vec_id"), (-F.col("m.away")).alias("score"))
    )
