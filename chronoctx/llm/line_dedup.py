"""Line dedup: lines that many documents share are dropped everywhere.

Lines become 128-bit hashes of their keys. The distinct hashes are counted and
dealt by hash into shards; each shard is a minimal perfect hash with an array of
fingerprints and an array of counts. Documents are dealt into blocks, and a block
sends every shard the hashes that it holds, each once, however many of its
documents have it. So a line that a third of all documents share arrives once per
block. What the arrays say goes back to the block, which marks its lines. Texts
move once, to meet their marks; lines are never joined.

Null and empty texts are one empty line, and stay. Rows with equal id and text
count as documents of their own. Ids may be null. Other columns stay as they are,
whatever their names; an empty table gives an empty result. A text of very many
lines is handled as arrays of numbers, its lines are not multiplied.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chronoctx.llm.common import free_name, partitions, row_key, text_of
from chronoctx.llm.perfect_hash import PerfectHash
from chronoctx.plans.session import store

#: What is stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
#: Shards and blocks per shuffle partition, and distinct lines that a shard holds.
DEAL = 4
SHARD_LINES = 1 << 18
BLOCK_ROWS = 1 << 13


def line_key(line: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.btrim(line, F.lit(BLANKS)), upper, lower)


def _hashes(text: Column) -> Column:
    """Of each line its two hashes; null for a line without a key."""
    keys = F.transform(F.split(text, "\n", -1), line_key)
    return F.transform(keys, lambda k: F.when(F.length(k) > 0, F.struct(
        F.xxhash64(k).alias("a"), F.xxhash64(F.lit("line"), k).alias("b"))))


def line_index(lines: DataFrame, n_shards: int) -> DataFrame:
    """``shard, perfect_hash, fingerprints, counts`` over all distinct lines of
    ``lines`` (an array ``hashes`` per document), by the number of documents."""
    # As text a hash can be told apart in a hash set; structs are compared one by one.
    digits = F.transform(F.array_compact("hashes"), lambda h: F.concat(*[F.lpad(F.hex(h[c]), 16, "0") for c in "ab"]))
    counted = (
        lines.select(F.explode(F.array_distinct(digits)).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        .select(F.conv(F.left("h", F.lit(16)), 16, -10).cast("long").alias("a"),
                F.conv(F.right("h", F.lit(16)), 16, -10).cast("long").alias("b"), "n")
        .withColumn("shard", _shard("a", n_shards))
    )

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        # Two lines with the same first hash share a slot; the other one's rows
        # go into the overflow, which is next to always empty.
        a, b, n = (rows.column(c).to_numpy() for c in ("a", "b", "n"))
        order = np.lexsort((b, a))
        a, b, n = a[order], b[order], n[order]
        first = np.concatenate(([True], a[1:] != a[:-1]))
        table = PerfectHash.build(a[first].view(np.uint64))
        slot = table.slots(a[first].view(np.uint64))
        marks, counts = np.empty(first.sum(), np.int64), np.empty(first.sum(), np.int64)
        marks[slot], counts[slot] = b[first], n[first]
        rest = np.column_stack((a[~first], b[~first], n[~first]))
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "perfect_hash": pa.array([table.to_bytes()], pa.binary()),
            "fingerprints": pa.array([marks.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()),
            "overflow": pa.array([rest.astype(np.int64).tobytes()], pa.binary()),
        })

    return counted.groupBy("shard").applyInArrow(
        build, "shard int, perfect_hash binary, fingerprints binary, counts binary, overflow binary")


def _shard(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def counts_of(index: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many documents each line occurs, by the arrays of its shard; 0 for
    lines that the index does not hold."""
    table = PerfectHash.from_bytes(index["perfect_hash"])
    marks, counts = np.frombuffer(index["fingerprints"], np.int64), np.frombuffer(index["counts"], np.int64)
    slot = table.slots(a.view(np.uint64))
    found = (slot >= 0) & (marks[slot] == b) if len(marks) else np.zeros(len(a), bool)
    out = np.where(found, counts[slot] if len(counts) else 0, 0)
    for x, y, n in np.frombuffer(index["overflow"], np.int64).reshape(-1, 3):
        out[(a == x) & (b == y)] = n
    return out


def _frequent(probes: DataFrame, index: DataFrame, least: int) -> DataFrame:
    """``block, a, b`` of the probed lines that at least ``least`` documents have."""
    def probe(key: tuple, asked: pa.Table, shard: pa.Table) -> pa.Table:
        a, b = (asked.column(c).to_numpy() for c in ("a", "b"))
        many = np.zeros(len(a), bool)
        if shard.num_rows and len(a):
            many = counts_of(shard.to_pylist()[0], a, b) >= least
        return asked.select(["block", "a", "b"]).filter(pa.array(many))

    return probes.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, "block int, a long, b long")


def _marks(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """``k, drop``: for each document which of its lines are frequent."""
    def mark(key: tuple, docs: pa.Table, hits: pa.Table) -> pa.Table:
        hashes = docs.column("hashes").combine_chunks()
        flat = hashes.flatten()
        pairs = np.empty(len(flat), dtype=[("a", np.int64), ("b", np.int64)])
        for name in ("a", "b"):
            pairs[name] = flat.field(name).fill_null(0).to_numpy(zero_copy_only=False)
        known = np.zeros(hits.num_rows, dtype=pairs.dtype)
        for name in ("a", "b"):
            known[name] = hits.column(name).to_numpy()
        drop = np.isin(pairs.view("V16"), known.view("V16")) if len(known) and len(pairs) else np.zeros(len(flat), bool)
        drop &= ~np.asarray(flat.is_null())
        ends = np.cumsum(np.asarray(pa.compute.list_value_length(hashes).fill_null(0)))
        offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
        return pa.table({"k": docs.column("k"), "drop": pa.ListArray.from_arrays(offsets, pa.array(drop))})

    return lines.groupBy("block").cogroup(frequent.groupBy("block")).applyInArrow(
        mark, "k struct<a:bigint,b:bigint>, drop array<boolean>")


def _marked(docs: DataFrame, least: int, drop: str = "_line_drop") -> DataFrame:
    """``docs`` with a column ``drop``: which of its lines at least ``least`` documents have."""
    spark, key = docs.sparkSession, free_name(docs, "_line_key")
    shape = docs.select(row_key("doc_id", "text").alias("k"), _hashes(text_of("text")).alias("hashes"))
    dealt = DEAL * partitions(spark)
    # Written once: the lines are counted, asked for and marked from these rows.
    lines = store(shape, "line-hashes")
    sizes = lines.agg(F.count(F.lit(1)), F.sum(F.size("hashes"))).first()
    n_blocks = max(dealt, -(-sizes[0] // BLOCK_ROWS))
    n_shards = max(dealt, -(-(sizes[1] or 0) // SHARD_LINES))
    lines = lines.withColumn("block", F.pmod(F.xxhash64("k.b"), F.lit(n_blocks)).cast("int"))
    index = store(line_index(lines, n_shards), "line-index")
    probes = (
        lines.select("block", F.explode(F.array_compact("hashes")).alias("h"))
        .select("block", "h.a", "h.b").distinct().withColumn("shard", _shard("a", n_shards))
    )
    marks = (
        _marks(lines.select("block", "k", "hashes"), _frequent(probes, index, least))
        .groupBy("k").agg(F.first("drop").alias("drop"))
        .select(F.struct("k.a", "k.b").alias(key), F.col("drop").alias(drop))
    )
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    return keyed.join(marks.hint("shuffle_hash"), key, "left").drop(key)


def _kept(drop: str = "_line_drop") -> Column:
    return F.array_join(F.filter(
        F.split(text_of("text"), "\n", -1), lambda _, i: ~F.coalesce(F.get(drop, i), F.lit(False))), "\n")


def drop_frequent_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """``docs`` with the columns it has, but ``text`` without the lines that at
    least ``least`` documents have, and ``n_chars``, if there is one, set anew."""
    drop = free_name(docs, "_line_drop")
    out = _marked(docs, least, drop).withColumn("text", _kept(drop)).drop(drop)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def digest(docs: DataFrame, least: int = 10) -> DataFrame:
    """Numbers of lines and of dropped ones, and a hash of what is kept."""
    return _marked(docs.select("doc_id", "text"), least).select(
        "doc_id", F.size("_line_drop").cast("long").alias("n_lines"),
        F.size(F.filter("_line_drop", lambda d: d)).cast("long").alias("n_dropped"), F.sha2(_kept(), 256).alias("kept_sha256"))
