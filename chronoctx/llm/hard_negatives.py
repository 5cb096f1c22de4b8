"""Hard negatives by a secondary sort.

Every anchor is scored against every row, block by block: cells of a grid hold a
bounded number of anchors and of rows. A first pass keeps each cell's best
positives and then the best of all cells. A second pass keeps, for each positive's
window of scores, the first negatives of each cell; nothing else can be among the
first of all cells, so nothing is lost and an anchor sends a few pairs per cell,
however many rows there are. The pairs are packed into byte keys (anchor,
falling score, kind, id), dealt by anchor and sorted within the partitions as
they are shuffled. A streaming iterator walks over them: a positive opens its
window, a negative is given to the windows that are open for its score, a full
window closes. It holds the open windows of one anchor, never an anchor's pairs.

Components are scaled and rounded down to integers; scores are exact inner
products. Shorter vectors count as followed by zeros. Scores that a long cannot
hold count as the greatest or least long. Rows without an id, a label or a vector,
or with a null or non-finite component, take no part. A row that is repeated with
its label and integers counts once; other rows that share an id are rows of their
own, in the order of a hash of their content. Ties go to the smaller id. An anchor
without positives, or a positive without negatives in its window, gives no rows;
neither does an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoctx.llm.common import map_rows, partitions
from chronoctx.plans.session import store

#: Numbers that the rows, the anchors and the scores of a cell hold at most.
ROW_NUMBERS, ANCHOR_NUMBERS, SCORES = 1 << 21, 1 << 18, 1 << 22
#: Rows of a cell before one more core is worth a cell of its own.
FEW_ROWS = 2048
#: Integers up to here are exact as doubles.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
#: Keys whose order as bytes is the order of the pairs.
KEY = np.dtype([("anchor", ">u8"), ("anchor_mark", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8"), ("mark", ">u8")])
POSITIVE, NEGATIVE = 0, 1
_SIGN = np.uint64(1 << 63)
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _integers(vectors: DataFrame, scale: float, label: Column) -> DataFrame:
    """``id, mark, label, x``: rows that take part, once each, ``x`` the packed
    integers as doubles and ``mark`` a hash of the content."""
    sound = vectors.select(
        F.col("vec_id").cast("long").alias("id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("vec"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    kind = sound.schema["label"].dataType.simpleString()

    def pack(columns):
        for i, name, vec in zip(*columns):
            with np.errstate(over="ignore"):
                x = np.nan_to_num(np.floor(scale * np.array(vec, float)) + 0.0)
            yield i, name, x.tobytes()

    return map_rows(sound, pack, f"id long, label {kind}, x binary").distinct().withColumn("mark", F.xxhash64("label", "x"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    values = column.to_pylist()
    if all(len(v) == 8 * width for v in values):
        return np.frombuffer(b"".join(values), float).reshape(len(values), width)
    return np.frombuffer(b"".join(v.ljust(8 * width, b"\0") for v in values), float).reshape(len(values), width)


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors as longs."""
    top = (np.abs(anchors).max(initial=0), np.abs(rows).max(initial=0))
    if max(top) < EXACT and top[0] * top[1] * max(1, anchors.shape[1]) < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    exact = [[int(v) for v in row] for row in rows]
    out = np.empty((len(anchors), len(rows)), np.int64)
    for i, anchor in enumerate(anchors):
        whole = [int(v) for v in anchor]
        out[i] = [max(-LONG - 1, min(LONG, sum(map(int.__mul__, whole, row)))) for row in exact]
    return out


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and greatest score with ``low*score <= 100*it <= high*score``."""
    return -(-low * score // 100), high * score // 100


def _first(scores: np.ndarray, ids: np.ndarray, marks: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties to smaller ids."""
    if len(scores) > n:
        places = np.flatnonzero(scores >= np.partition(scores, -n)[-n])
        return places[np.lexsort((marks[places], ids[places], -scores[places].astype(float), -scores[places]))[:n]]
    return np.lexsort((marks, ids, -scores))


def _pack(anchor: int, anchor_mark: int, kind: int, scores: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Keys of one anchor's pairs; the score is turned round, so higher ones come first."""
    keys = np.empty(len(scores), KEY)
    keys["anchor"], keys["anchor_mark"], keys["kind"] = (anchor + (1 << 63)), (anchor_mark + (1 << 63)), kind
    keys["score"] = ~(scores.astype(np.uint64) ^ _SIGN)
    keys["id"], keys["mark"] = ids.astype(np.uint64) ^ _SIGN, marks.astype(np.uint64) ^ _SIGN
    return keys


def _signed(column: np.ndarray) -> np.ndarray:
    return (column.astype(np.uint64) ^ _SIGN).astype(np.int64)


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    """Anchors, their marks, scores, kinds and ids of packed keys."""
    keys = np.frombuffer(data, KEY)
    return (_signed(keys["anchor"]), _signed(keys["anchor_mark"]), _signed(~keys["score"].astype(np.uint64)),
            keys["kind"], _signed(keys["id"]))


def _key_table(found: list[np.ndarray]) -> pa.Table:
    data, n = b"".join(keys.tobytes() for keys in found), sum(map(len, found))
    offsets = pa.py_buffer((np.arange(n + 1, dtype=np.int32) * KEY.itemsize).tobytes())
    return pa.table({"key": pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(data)])})


def _blocks(anchors: pa.Table, rows: pa.Table, width: int) -> Iterator[tuple]:
    """Scores of a cell, a bounded number at a time."""
    if not anchors.num_rows or not rows.num_rows:
        return
    ids, marks = rows.column("id").to_numpy(), rows.column("mark").to_numpy()
    labels, x = rows.column("label").to_numpy(), _matrix(rows.column("x"), width)
    step = max(1, SCORES // max(1, len(ids)))
    for start in range(0, anchors.num_rows, step):
        part = anchors.slice(start, step)
        yield part, part.column("label").to_numpy(), _matrix(part.column("x"), width), ids, marks, labels, x


def _cell_positives(k: int, width: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        for part, wanted, asks, ids, marks, labels, x in _blocks(anchors, rows, width):
            for label in set(wanted.tolist()):
                same, mine = np.flatnonzero(labels == label), np.flatnonzero(wanted == label)
                scores = scores_of(asks[mine], x[same])
                for place, values in zip(mine.tolist(), scores):
                    anchor, mark = part.column("id")[place].as_py(), part.column("mark")[place].as_py()
                    other = (ids[same] != anchor) | (marks[same] != mark)
                    some = same[other]
                    best = _first(values[other], ids[some], marks[some], k)
                    found.append(_pack(anchor, mark, POSITIVE, values[other][best], ids[some][best], marks[some][best]))
        return _key_table(found)

    return run


def _cell_negatives(k: int, low: int, high: int, width: int):
    def run(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        for part, own, asks, ids, marks, labels, x in _blocks(anchors, rows, width):
            for place, values in enumerate(scores_of(asks, x)):
                windows = {window_of(s, low, high) for s in part.column("scores")[place].as_py()}
                least, most = min(w[0] for w in windows), max(w[1] for w in windows)
                near = np.flatnonzero((values >= least) & (values <= most) & (labels != own[place]))
                kept: set[int] = set()
                for bottom, top in windows:
                    some = near[(values[near] >= bottom) & (values[near] <= top)]
                    kept.update(some[_first(values[some], ids[some], marks[some], k)].tolist())
                some = np.array(sorted(kept), np.int64)
                found.append(_pack(
                    part.column("id")[place].as_py(), part.column("mark")[place].as_py(), NEGATIVE, values[some], ids[some], marks[some]))
        return _key_table(found)

    return run


def stream_windows(k: int, low: int, high: int):
    """Sorted keys to rows, one anchor's open windows in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            out = []
            columns = unpack(b"".join(batch.column("key").to_pylist()))
            for anchor, mark, score, kind, i in zip(*(c.tolist() for c in columns)):
                if (anchor, mark) != current:
                    current, windows = (anchor, mark), []
                if kind == POSITIVE:
                    windows.append([i, score, *window_of(score, low, high), 0])
                    continue
                for window in windows:
                    positive, positive_score, bottom, top, given = window
                    if bottom <= score <= top:
                        window[4] = given + 1
                        out.append((anchor, positive, given + 1, i, positive_score, score))
                windows = [w for w in windows if w[4] < k and w[2] <= score]
            values = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int32() if c == 2 else pa.int64()) for c, v in enumerate(values)],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def mine(
    vectors: DataFrame, anchors: Callable[[Column], Column], label: Column | None = None, scale: float = 256.0,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``
    for the rows of ``vectors`` whose id ``anchors`` holds for. A negative's score
    lies between ``low`` and ``high`` hundredths of the positive's."""
    spark = vectors.sparkSession
    rows = store(_integers(vectors, scale, F.col("label") if label is None else label), "integer-vectors")
    asking = rows.where(anchors(F.col("id")))
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.octet_length("x")), F.lit(0)) / 8).first()
    n_anchors, width = asking.count(), int(width)
    if not n_anchors:
        return spark.createDataFrame([], _RESULT)
    cores = spark.sparkContext.defaultParallelism
    slices = max(-(-n * max(1, width) // ROW_NUMBERS), min(cores, -(-n // FEW_ROWS)))
    groups = -(-n_anchors * max(1, width) // ANCHOR_NUMBERS)
    place = [F.pmod(F.xxhash64("id", "mark"), F.lit(slices)).alias("slice"), F.pmod(F.xxhash64("mark", "id"), F.lit(groups)).alias("part")]
    cells = rows.select("id", "mark", "label", "x", place[0], _numbers(groups).alias("part"))

    def per_cell(asks: DataFrame, function) -> DataFrame:
        # Both sides come from one table; renewed columns keep Spark from taking them for each other's.
        spread = asks.select(*[F.col(c).alias(c) for c in asks.columns], place[1], _numbers(slices).alias("slice"))
        return spread.groupBy("part", "slice").cogroup(cells.groupBy("part", "slice")).applyInArrow(function, "key binary")

    # Bytes 0-15 of a key are the anchor, 16-23 the falling score; a key in hand sorts as its pair does.
    anchor_bytes = F.substring("key", 1, 16)
    order = Window.partitionBy(anchor_bytes).orderBy("key")
    best = store(
        per_cell(asking, _cell_positives(positives, width))
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).select("key"), "positives")

    def opened(columns):
        data = b"".join(columns[0])
        yield from zip(*(c.tolist() for c in unpack(data)[:3]))

    scores = map_rows(best, opened, "id long, mark long, score long").groupBy("id", "mark").agg(
        F.array_sort(F.collect_list("score")).alias("scores"))
    pairs = best.unionByName(per_cell(asking.join(scores, ["id", "mark"]), _cell_negatives(negatives, low, high, width)))
    sorted_pairs = pairs.repartition(partitions(spark), anchor_bytes).sortWithinPartitions("key")
    return sorted_pairs.mapInArrow(stream_windows(negatives, low, high), _RESULT)
