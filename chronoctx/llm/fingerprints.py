"""Document fingerprints: quartile bucket digests.

A digest counts byte triplets, hashed into buckets, and keeps for each bucket
only the quartile that its count falls into, beside a code for the length.
Digests compare by a difference score that is bounded, so likeness runs from 0
to 1.

A null text counts as empty. Equal texts have equal digests; a text too short
for a triplet has the digest of no counts. Texts are read in pieces, so a very
long one needs no more memory than itself. Rows with equal ids follow each other
by text, null ids come first. Extra columns are not read. An empty table gives
an empty result, and a single document is its own next one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from chronoctx.llm.common import map_rows, partitions, text_of
from chronoctx.plans.session import store

BUCKETS = 256
#: Places of the three bytes within a window of five.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 4))
PIECE = 1 << 18
#: Two buckets in opposite quartiles differ by this much, not by three.
FAR = 6
#: Lengths differ by at most this much in the score.
LENGTH_CAP = 60
#: The score from which two texts count as not alike at all.
BOUND = 500


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets of ``data`` fall into each bucket."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for start in range(0, max(len(data) - 4, 0), PIECE):
        part = np.frombuffer(data, dtype=np.uint8, count=min(PIECE + 4, len(data) - start), offset=start).astype(np.uint32)
        n = len(part) - 4
        for salt, (i, j, k) in enumerate(TRIPLETS):
            mixed = (part[i:i + n] << 16 | part[j:j + n] << 8 | part[k:k + n]) * np.uint32(2654435761 + 2 * salt)
            counts += np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(text: str) -> str:
    """Length code and 256 quartiles of two bits, in hex."""
    data = text.encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    ranked = np.sort(counts)
    quartiles = ranked[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = np.searchsorted(quartiles, counts, side="left").astype(np.uint8).reshape(-1, 4)
    packed = codes[:, 0] << 6 | codes[:, 1] << 4 | codes[:, 2] << 2 | codes[:, 3]
    length = min(255, int(math.log(len(data) + 1) * 8))
    return f"{length:02x}{packed.astype(np.uint8).tobytes().hex()}"


def difference(one: str, other: str) -> int:
    """The score of two digests; 0 for equal ones, ``BOUND`` at most."""
    first, second = (np.frombuffer(bytes.fromhex(x), dtype=np.uint8).astype(np.int16) for x in (one, other))
    total = min(LENGTH_CAP, abs(int(first[0]) - int(second[0])))
    for shift in (0, 2, 4, 6):
        apart = np.abs((first[1:] >> shift & 3) - (second[1:] >> shift & 3))
        total += int(apart.sum()) + (FAR - 3) * int((apart == 3).sum())
    return min(total, BOUND)


def likeness(one: str, other: str) -> float:
    return 1.0 - difference(one, other) / BOUND


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(doc_id: int | None, text: str, own: str, following: str, its: str) -> tuple:
    changed = edited(text, following)
    fingerprint = own if changed == text else digest(changed)
    return (
        doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, fingerprint,
        likeness(own, fingerprint), likeness(own, its),
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint``, one row per document."""
    rows = docs.select("doc_id", text_of("text").alias("text"))
    return map_rows(rows, lambda c: ((i, len(t), digest(t)) for i, t in zip(*c)), "doc_id long, n_chars long, fingerprint string")


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and against the next document by id.

    Texts are shuffled once, into ranges of ids. A task passes over its range in
    order and finishes all documents but its last, whose next one is the first of
    a later range; it gives out both ends with their texts. The few ends, two per
    range, are matched afterwards. The rows are stored in between, so a repeated
    task cannot deal the ranges out anew.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of("text").alias("text")).repartitionByRange(partitions(spark), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = digest(text)
                out.append(("first", part, text) + (None,) * 7 if last is None else ("done", None, None) + _compared(*last, text, own))
                last = (doc_id, text, own)
            yield _batch(out)
        if last is not None:
            yield _batch([("last", part, last[1], last[0]) + (None,) * 6])

    seen = store(rows.sortWithinPartitions("doc_id", "text").mapInArrow(run, f"end string, part int, text string, {RESULT}"), "fingerprints")
    columns = [c.split()[0] for c in RESULT.split(",")]
    following = (
        seen.where("end = 'first'").select("part", F.col("text").alias("following"))
        .withColumn("before", F.lag("part").over(Window.orderBy("part")))
        .withColumn("before", F.coalesce("before", F.max("part").over(Window.partitionBy())))
    )
    ends = (
        seen.where("end = 'last'").select("doc_id", "text", F.col("part").alias("before"))
        .join(following, "before").select("doc_id", "text", "following")
    )
    closed = map_rows(
        ends, lambda c: (_compared(i, t, digest(t), f, digest(f)) for i, t, f in zip(*c)), RESULT)
    return seen.where("end = 'done'").select(*columns).unionByName(closed)


_FIELDS = pa.schema([
    ("end", pa.string()), ("part", pa.int32()), ("text", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in _FIELDS]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS)
