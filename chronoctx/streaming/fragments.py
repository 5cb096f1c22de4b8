"""Streaming assembly of fragmented transactions.

Transactions are dealt into groups by a hash of their identifier, and wait in keyed
state by group. Fragments go to the state and come from it in blocks, which are Arrow
record batches as bytes: a call to the state and a row that passes between Spark and
Python both cost far more than a fragment. A call serves all transactions of a group
and judges them by columns. A batch touches the groups that it has fragments of, and
no others. What is known about the transactions of a group is one table; the fragments
themselves are only read when some of them leave.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from chronoctx.operators.fragments import FAULTS, INVALID, READY, faults, integer
from chronoctx.plans.session import remove
from chronoctx.sinks.files import folders, move, open_folders, write_batch

#: Fragments of one group that are held outside the state at a time, and of one block,
#: and their bytes.
HELD, HELD_BYTES = 1 << 15, 32 << 20
#: Groups that transactions are dealt into. Fixed for a checkpoint.
GROUPS = 4096
#: Fragments that a task deals into blocks at a time, and their bytes.
DEALT, DEALT_BYTES = 1 << 18, 32 << 20
#: Why a transaction is broken; of several reasons the first. Fixed for a checkpoint.
REASONS = (
    *(name for name in FAULTS if name.startswith("count")), "count-inconsistent",
    *(name for name in FAULTS if not name.startswith("count")), "index-duplicate", "timeout",
)
_FAULT = {reason: 1 << i for i, reason in enumerate(REASONS)}
_FIRST = np.array([(found & -found).bit_length() - 1 for found in range(1 << len(REASONS))], np.int8)
_REASON = pa.array(REASONS, pa.string())
_STATUS = pa.array([READY, INVALID], pa.string())
#: Verdicts that are no reason.
_READY, _WAIT = -1, -2
_NONE = np.iinfo(np.int64).min
_SEEN = [pa.field("_total", pa.int32()), pa.field("_place", pa.int32()), pa.field("_faults", pa.int32())]
_SUMMARY = [pa.field("_total", pa.int32()), pa.field("_verdict", pa.int8()), pa.field("_due", pa.int64()), pa.field("_places", pa.list_(pa.int32()))]


def _packed(rows: pa.RecordBatch) -> bytes:
    return rows.serialize().to_pybytes()


def _unpacked(block: bytes, schema: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(block), schema)


def _numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Integers, ``_NONE`` for null."""
    return pc.fill_null(column.cast(pa.int64()), _NONE).to_numpy()


def _codes(columns: list[pa.Array]) -> tuple[list[np.ndarray], pa.Array]:
    """A number for every value, the same one in all columns, and the values by number;
    null is a value."""
    encoded = pa.concat_arrays(columns).dictionary_encode("encode")
    return np.split(encoded.indices.to_numpy(), np.cumsum([len(c) for c in columns])[:-1]), encoded.dictionary


class _Blocks:
    """Blocks in keyed state by number, each read and written alone. The numbers are
    kept elsewhere: to list the keys of a map is to read all of it."""

    def __init__(self, handle, name: str, schema: pa.Schema, beside: str = ""):
        self.state, self.schema = handle.getMapState(name, "number long", f"block binary{beside}"), schema
        self.numbers: list[int] = []

    def read(self, number: int) -> pa.RecordBatch:
        return _unpacked(self.state.getValue((number,))[0], self.schema)

    def append(self, rows: pa.RecordBatch) -> None:
        number = self.numbers[-1] + 1 if self.numbers else 0
        self.state.updateValue((number,), (_packed(rows),))
        self.numbers.append(number)

    def remove(self, number: int) -> None:
        self.state.removeKey((number,))
        self.numbers.remove(number)


class _Run:
    """Blocks that become one when they are enough."""

    def __init__(self, schema: pa.Schema, most: int):
        self.schema, self.most, self.blocks, self.rows, self.size = schema, most, [], 0, 0

    def add(self, rows: pa.RecordBatch, size: int) -> bool:
        """Whether they are enough now."""
        self.blocks.append(rows)
        self.rows, self.size = self.rows + rows.num_rows, self.size + size
        return self.rows >= self.most or self.size >= HELD_BYTES

    def taken(self) -> pa.RecordBatch:
        rows, self.blocks, self.rows, self.size = _batch(self.blocks, self.schema), [], 0, 0
        return rows


class _Seen:
    """What a run of fragments says about their transactions."""

    def __init__(self, rows: pa.RecordBatch, place_of_id: int):
        (self.code,), self.names = _codes([rows.column(place_of_id)])
        # Copies: the rows themselves may be given to the state.
        self.total, self.place, self.found = (np.array(_numbers(c)) for c in rows.columns[-len(_SEEN):])


class Assembler(StatefulProcessor):
    """Gives the fragments of a transaction out when it is complete (READY) or
    broken, or when ``timeout_ms`` have gone by since its last fragment came
    (INVALID, with the reason). Fragments of a broken transaction that come later
    are INVALID as well, until the timeout. Rows are blocks of fragments, each followed
    by its total, place and faults; blocks of fragments, followed by status and reason,
    are given out."""

    def __init__(self, schema: StructType, identifier: str, timeout_ms: int | None, most: int = HELD):
        self.timeout_ms, self.most = timeout_ms, most
        self.width, self.place_of_id = len(schema), schema.fieldNames().index(identifier)
        self.pieces = pieces_schema(schema)
        self.known = pa.schema([*to_arrow_schema(StructType([schema[identifier]])), *_SUMMARY])
        self.given = to_arrow_schema(decided_schema(schema))
        self.row = Row("block")

    def init(self, handle) -> None:
        self.handle = handle
        self.summary = _Blocks(handle, "summary", self.known, ", blocks int, waiting array<long>")
        self.waiting = _Blocks(handle, "waiting", self.pieces)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._load()
        seen, run, n_stored = [], _Run(self.pieces, self.most), 0
        for row in rows:
            if run.add(_unpacked(row[-1], self.pieces), len(row[-1])):
                # Stored before they are judged, so that no more are held.
                held = run.taken()
                seen.append(_Seen(held, self.place_of_id))
                self.waiting.append(held)
                n_stored += held.num_rows
        held = run.taken()
        seen.append(_Seen(held, self.place_of_id))

        (old, *codes), names = _codes([known.column(0), *(s.names for s in seen)])
        code = np.concatenate([own[s.code] for own, s in zip(codes, seen)])
        total, place, found = (np.concatenate([getattr(s, field) for s in seen]) for field in ("total", "place", "found"))
        verdict, total, places, touched, due = self._judged(known, old, len(names), code, total, place, found)
        decided = verdict != _WAIT

        out = verdict[code[n_stored:]]
        if (out != _WAIT).any():
            yield from self._give(held.filter(pa.array(out != _WAIT)), out[out != _WAIT])
        stored = np.zeros(len(names), bool)
        stored[old[_numbers(known.column(2)) == _WAIT]] = True
        stored[code[:n_stored]] = True
        if (stored & decided & touched).any():
            leaving = np.flatnonzero(stored & decided & touched)
            yield from self._leave(names.take(pa.array(leaving)), verdict[leaving])
        if (out == _WAIT).any():
            self.waiting.append(held.filter(pa.array(out == _WAIT)))

        dues = set(_numbers(known.column(3)).tolist())
        if self.timeout_ms is not None:
            # Later fragments of a broken transaction do not put off its end.
            renewed = touched.copy()
            renewed[old[_numbers(known.column(2)) != _WAIT]] = False
            due[renewed] = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
        kept = verdict != _READY
        if len(known) or kept.any():
            staying = np.flatnonzero(kept)
            place_of = np.cumsum(kept) - 1
            of = place_of[places >> 32]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(staying)))])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array((places & 0xFFFFFFFF).astype(np.uint32).view(np.int32)))
            broken = verdict[staying] != _WAIT
            self._save(pa.RecordBatch.from_arrays([
                names.take(pa.array(staying)),
                pa.array(np.where(broken, 0, total[staying]), pa.int32(), mask=broken), pa.array(verdict[staying], pa.int8()),
                pa.array(due[staying], pa.int64(), mask=due[staying] == _NONE), lists,
            ], schema=self.known))
            self._timers(dues, set(due[staying].tolist()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known, now = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        due = _numbers(known.column(3))
        over = (due != _NONE) & (due <= now)
        if over.any():
            late = over & (_numbers(known.column(2)) == _WAIT)
            if late.any():
                timeout = np.full(late.sum(), REASONS.index("timeout"), np.int8)
                yield from self._leave(known.column(0).filter(pa.array(late)), timeout)
            self._save(known.filter(pa.array(~over)))

    def close(self) -> None:
        pass

    def _load(self) -> pa.RecordBatch:
        """What is known about the transactions of the key; its first block has the
        numbers of the others and of those that wait."""
        first = self.summary.state.getValue((0,))
        self.summary.numbers, self.waiting.numbers = (list(range(first[1])), list(first[2])) if first is not None else ([], [])
        others = [self.summary.read(number) for number in self.summary.numbers[1:]]
        return _batch([_unpacked(first[0], self.known), *others] if first is not None else [], self.known)

    def _save(self, known: pa.RecordBatch) -> None:
        blocks = [known.slice(start, self.most) for start in range(0, known.num_rows, self.most)]
        for number, rows in enumerate(blocks):
            self.summary.state.updateValue((number,), (_packed(rows), len(blocks), [] if number else self.waiting.numbers))
        for number in self.summary.numbers[len(blocks):]:
            self.summary.state.removeKey((number,))

    def _judged(self, known, old, n, code, total, place, found):
        """The verdict on each of ``n`` transactions, its total, the (transaction,
        place) of those that wait, which ones the fragments touch and when they are due.
        The rules of ``fragment_status``, in its order."""
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, _NONE)
        count, flaws = np.bincount(code, minlength=n), np.zeros(n, np.int64)
        before, due = np.full(n, _WAIT, np.int8), np.full(n, _NONE)
        before[old], due[old] = _numbers(known.column(2)), _numbers(known.column(3))
        low[old] = high[old] = _numbers(known.column(1))
        low[high == _NONE] = np.iinfo(np.int64).max
        lists = known.column(4)
        n_places = lists.value_lengths().to_numpy()
        # A transaction only waits while every fragment has a place of its own.
        count[old] += n_places
        touched = np.zeros(n, bool)
        touched[code] = True

        counted, placed, flawed = total != _NONE, place != _NONE, found != 0
        np.minimum.at(low, code[counted], total[counted])
        np.maximum.at(high, code[counted], total[counted])
        np.bitwise_or.at(flaws, code[flawed], found[flawed])
        places = np.sort(np.concatenate([
            (np.repeat(old, n_places).astype(np.int64) << 32) | lists.flatten().to_numpy(),
            (code[placed].astype(np.int64) << 32) | (place[placed] & 0xFFFFFFFF)]))
        flaws[places[1:][places[1:] == places[:-1]] >> 32] |= _FAULT["index-duplicate"]
        flaws[(high != _NONE) & (low != high)] |= _FAULT["count-inconsistent"]

        verdict = np.where(flaws != 0, _FIRST[flaws], np.where(count == high, _READY, _WAIT)).astype(np.int8)
        verdict[(count == 1) & (flaws & _FAULT["count-missing"] != 0)] = _READY
        verdict[~touched] = _WAIT
        verdict = np.where(before != _WAIT, before, verdict)
        return verdict, high, places[verdict[places >> 32] == _WAIT], touched, due

    def _give(self, rows: pa.RecordBatch, verdict: np.ndarray) -> Iterator[Row]:
        broken = verdict >= 0
        status = _STATUS.take(pa.array(broken.astype(np.int8)))
        reason = _REASON.take(pa.array(np.where(broken, verdict, 0), mask=~broken))
        given = pa.RecordBatch.from_arrays([*rows.columns[:self.width], status, reason], schema=self.given)
        yield self.row(_packed(given))

    def _leave(self, names: pa.Array, verdict: np.ndarray) -> Iterator[Row]:
        """Gives the stored fragments of these transactions out. Of the others, those
        of blocks that are no longer full are joined."""
        staying = _Run(self.pieces, self.most)
        for number in list(self.waiting.numbers):
            rows = self.waiting.read(number)
            place = pc.index_in(rows.column(self.place_of_id), value_set=names)
            gone = place.is_valid()
            if place.null_count < rows.num_rows:
                yield from self._give(rows.filter(gone), verdict[place.drop_null().to_numpy()])
            elif 2 * rows.num_rows >= self.most or 2 * rows.nbytes >= HELD_BYTES:
                continue
            self.waiting.remove(number)
            rest = rows.filter(pc.invert(gone))
            if rest.num_rows and staying.add(rest, rest.nbytes):
                self.waiting.append(staying.taken())
        if staying.rows:
            self.waiting.append(staying.taken())

    def _timers(self, before: Iterable[int], after: Iterable[int]) -> None:
        """A timer for every time that some transaction is due at, and no others."""
        before, after = ({due for due in dues if due != _NONE} for dues in (before, after))
        for due in before - after:
            self.handle.deleteTimer(due)
        for due in after - before:
            self.handle.registerTimer(due)


def _batch(blocks: list[pa.RecordBatch], schema: pa.Schema) -> pa.RecordBatch:
    """Some blocks as one."""
    if len(blocks) == 1:
        return blocks[0]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(i) for b in blocks]) if blocks else pa.array([], f.type)
                                       for i, f in enumerate(schema)], schema=schema)


def pieces_schema(schema: StructType) -> pa.Schema:
    return pa.schema([*to_arrow_schema(schema), *_SEEN])


def decided_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("status", "string").add("reason", "string")


def dealt(batches: Iterable[pa.RecordBatch], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Rows, their group last, as blocks of one group and ``most`` rows at most, with
    the group; so many rows at a time that a block has many."""
    def blocks() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        group = table.column(table.num_columns - 1).to_numpy()
        order = np.argsort(group, kind="stable")
        rows, group = table.select(range(table.num_columns - 1)), group[order]
        if rows.schema.types != schema.types:
            rows = rows.cast(schema)
        rows = _batch(rows.combine_chunks().to_batches(), schema).take(pa.array(order))
        ends = [*(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        starts = [(at, min(at + most, end)) for start, end in zip([0, *ends], ends) for at in range(start, end, most)]
        return pa.RecordBatch.from_arrays([
            pa.array(group[[start for start, _ in starts]], pa.int64()),
            pa.array([_packed(rows.slice(start, end - start)) for start, end in starts], pa.binary())], ["_group", "_block"])

    held, n, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.nbytes
        if n >= DEALT or size >= DEALT_BYTES:
            yield blocks()
            held, n, size = [], 0, 0
    if held:
        yield blocks()


def assemble(
    pieces: DataFrame, timeout_ms: int | None = None, identifier: str = "fragment_identifier",
    index: str = "fragment_index", count: str = "fragment_count", held: int = HELD, groups: int = GROUPS,
) -> DataFrame:
    """A stream of fragments to a stream of those whose transaction is decided,
    with ``status`` and ``reason``. The others wait in the state of the job; without
    a timeout those that never become complete stay there. Within a batch the
    result is that of ``fragment_status``; over batches a transaction is decided as
    soon as its fragments so far decide it. Identifiers are not null. A batch reads
    what is known of all transactions that wait in the groups it touches, one of
    ``groups`` parts of the state each."""
    schema = pieces.schema
    given = decided_schema(schema)
    flags = faults(F.col(index), F.col(count))
    bits = sum((F.when(flag, _FAULT[name]).otherwise(0) for name, flag in flags.items()), F.lit(0))
    ready = pieces.withColumns({
        "_total": integer(F.col(count)), "_place": integer(F.col(index)), "_faults": bits.cast("int"),
        "_group": F.pmod(F.xxhash64(identifier), F.lit(groups))})
    rows, out = pieces_schema(schema), to_arrow_schema(given)
    packed = ready.mapInArrow(lambda batches: dealt(batches, rows, held), "_group long, _block binary")
    decided = packed.groupBy("_group").transformWithState(
        Assembler(schema, identifier, timeout_ms, held), "block binary", "Append", "None" if timeout_ms is None else "ProcessingTime")
    return decided.mapInArrow(
        lambda batches: (_unpacked(block.as_buffer(), out) for batch in batches for block in batch.column(0)), given)


def fragment_writer(out: str) -> Callable[[DataFrame, int], None]:
    """Batch handler of an assembled stream: complete transactions to
    ``<out>/ready`` (fragments carry their index as the order), broken and late ones
    to ``<out>/invalid``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, both = batch.sparkSession, f"{out}/decided/batch_id={batch_id}"
        # One pass writes both tables: what the state gives can't be had twice.
        with open_folders(spark, 2):
            batch.write.mode("overwrite").partitionBy("status").parquet(both)
        found = folders(spark, both)
        for status, table in ((READY, "ready"), (INVALID, "invalid")):
            target = f"{out}/{table}/batch_id={batch_id}"
            remove(spark, target)
            if f"status={status}" in found:
                move(spark, f"{both}/status={status}", target)
            else:
                write_batch(spark.createDataFrame([], batch.drop("status").schema), f"{out}/{table}", batch_id)
        remove(spark, both)

    write.stateful = True
    return write
