"""Micro-batch handling: triggers, routing and commits."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronoctx.plans.session import remove, scratch, store
from chronoctx.sinks.files import write_batch

SUCCESS, FAILURE, RETRY = "success", "failure", "retry"
#: Times that a batch is tried while its errors may pass by themselves.
ATTEMPTS = 3
#: Rows of a batch that are told apart as failing ones, one by one.
MAX_ISOLATED = 64


def run_batch(
    batch: DataFrame, batch_id: int, write: Callable[[DataFrame, int], None], out: str,
    faults: tuple[type[Exception], ...] = (), transient: tuple[type[Exception], ...] = (),
) -> str:
    """Run one micro-batch to its end and record where it went.

    ``faults`` are the errors that single rows can cause. Such a batch is halved
    until the failing rows are alone (``isolate``); they go to ``<out>/failed`` as
    received, with the error, and the rest of the batch is written. ``transient``
    are errors that may be gone the next time: the batch is tried again, and goes to
    ``<out>/retry`` after that, for ``replay``. Any other error ends the job, which
    starts again with this batch: tasks are repeated by Spark, batches by the job's
    checkpoint. A handler that can foresee which rows fail says so in
    ``write.reason``, a function of a batch to a text column that is null for good
    rows: those are told apart in one pass, however many they are, and only what is
    left is halved. A handler with state (``write.stateful``) cannot do without rows, so
    it allows neither. The commit record is written last: readers that go through
    ``read_committed`` see all of a batch or nothing of it.
    """
    if (faults or transient) and getattr(write, "stateful", False):
        raise ValueError("a job with state cannot leave out a batch")
    route, error = SUCCESS, None
    for attempt in range(ATTEMPTS):
        try:
            write(batch, batch_id)
            break
        except transient as problem:
            if attempt == ATTEMPTS - 1:
                route, error = RETRY, problem
                write_batch(batch, f"{out}/retry", batch_id)
        except faults as problem:
            error = problem
            route = _write_without_failing(batch, batch_id, write, out, faults, problem)
            break
    _record(batch.sparkSession, out, batch_id, route, error)
    return route


def _record(spark: SparkSession, out: str, batch_id: int, route: str, error: Exception | None) -> None:
    record = spark.range(1).select(
        F.lit(route).alias("route"), F.lit(None if error is None else type(error).__name__).cast("string").alias("error"),
    )
    write_batch(record, f"{out}/commits", batch_id)


def _write_without_failing(
    batch: DataFrame, batch_id: int, write: Callable[[DataFrame, int], None], out: str,
    faults: tuple[type[Exception], ...], problem: Exception,
) -> str:
    """The batch without its failing rows; FAILURE if none is left."""
    spark = batch.sparkSession
    with scratch(spark):
        # Stored with a hash, so that every half is the same rows each time, and in
        # its order, so that a half is read without the rest.
        content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns]), {"ignoreNullFields": "false"}))
        name, error = _free("_content", batch), _free("_error", batch)
        reason = getattr(write, "reason", lambda _: F.lit(None).cast("string"))(batch)
        marked = batch.select("*", content.alias(name), reason.alias(error))
        rows = store(marked.repartitionByRange(F.col(name)).sortWithinPartitions(name), "failed-batch")
        failed, good = rows.filter(F.col(error).isNotNull()), rows.filter(F.col(error).isNull())
        foreseen = not failed.isEmpty()
        left = not good.isEmpty()
        if foreseen and left:
            try:
                write(good.drop(name, error), batch_id)
            except faults as other:
                foreseen, problem = False, other
        if left and not foreseen:
            ranges = isolate(good, name, lambda part: write(part.drop(name, error), batch_id), faults, problem)
            within = reduce(lambda a, b: a | b, [F.col(name).between(low, high) for low, high, _ in ranges])
            reason = reduce(lambda value, r: value.when(F.col(name).between(r[0], r[1]), F.lit(r[2])), ranges[1:],
                            F.when(F.col(name).between(*ranges[0][:2]), F.lit(ranges[0][2])))
            failed = failed.unionByName(good.filter(within).withColumn(error, reason))
            good = good.filter(~within)
            left = not good.isEmpty()
            if left:
                write(good.drop(name, error), batch_id)
        write_batch(failed.drop(name).withColumn("error", F.col(error)).drop(error), f"{out}/failed", batch_id)
        return SUCCESS if left else FAILURE


def _free(name: str, batch: DataFrame) -> str:
    """A column name that the batch does not have."""
    while name in batch.columns:
        name += "_"
    return name


def isolate(
    rows: DataFrame, key: str, attempt: Callable[[DataFrame], None], faults: tuple[type[Exception], ...], problem: Exception,
) -> list[tuple[int, int, str]]:
    """Ranges ``(low, high, error)`` of ``key`` whose rows make ``attempt`` fail.

    A failing range is halved while it holds different keys. With k failing rows of
    n that takes about 2k log(n) attempts; ranges that still fail when
    ``MAX_ISOLATED`` have been found are not halved further, and neither is one
    whose halves only fail together.
    """
    found: list[tuple[int, int, str]] = []
    todo = [(-(1 << 63), (1 << 63) - 1, str(problem))]
    while todo:
        low, high, error = todo.pop()
        inside = rows.filter(F.col(key).between(low, high))
        low, high = inside.agg(F.min(key), F.max(key)).first()
        if low is None:
            continue
        if low == high or len(found) >= MAX_ISOLATED:
            found.append((low, high, error))
            continue
        middle, failing = (low + high) // 2, []
        for part in ((low, middle), (middle + 1, high)):
            try:
                attempt(rows.filter(F.col(key).between(*part)))
            except faults as fault:
                failing.append((*part, str(fault)))
        if failing:
            todo += failing
        else:
            found.append((low, high, error))
    return found


def replay(
    spark: SparkSession, out: str, write: Callable[[DataFrame, int], None],
    faults: tuple[type[Exception], ...] = (), transient: tuple[type[Exception], ...] = (),
) -> dict[int, str]:
    """Run the batches of the retry route again, under their ids; says where each
    one went."""
    routes = {}
    for batch_id in batches(spark, f"{out}/retry"):
        path = f"{out}/retry/batch_id={batch_id}"
        with scratch(spark):
            # Copied, as the batch may go back to where it is read from.
            routes[batch_id] = run_batch(store(spark.read.parquet(path), "replayed"), batch_id, write, out, faults, transient)
        if routes[batch_id] != RETRY:
            remove(spark, path)
    return routes


def start(
    stream: DataFrame, write: Callable[[DataFrame, int], None], out: str, checkpoint: str,
    every: str | None = "30 seconds", faults: tuple[type[Exception], ...] = (),
    transient: tuple[type[Exception], ...] = (),
) -> StreamingQuery:
    """Start a job; ``every`` is the accumulation time of a micro-batch, None
    runs what is there now and ends."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: run_batch(batch, batch_id, write, out, faults, transient) and None
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def batches(spark: SparkSession, table: str, column: str = "batch_id") -> list[int]:
    """The numbers of the folders ``<column>=<number>`` of a table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(table)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    found = [name.partition("=") for name in names]
    return sorted(int(number) for name, _, number in found if name == column and number.isdigit())


def remove_batches(spark: SparkSession, table: str, column: str, below: int) -> None:
    """Delete the folders of batches that a later one has replaced."""
    for number in batches(spark, table, column):
        if number < below:
            remove(spark, f"{table}/{column}={number}")


def kept(df: DataFrame) -> DataFrame:
    """A micro-batch intermediate that is used more than once. Lost blocks are
    computed again from the source."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return None
        raise


def read_committed(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table of a job, without batches that did not end well."""
    done = spark.read.parquet(f"{out}/commits").filter(F.col("route") == SUCCESS).select("batch_id")
    return spark.read.parquet(f"{out}/{table}").join(done, "batch_id", "left_semi")
