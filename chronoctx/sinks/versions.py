"""Stored tables with versions.

A store is a folder of tables. Every write puts its files into folders of their
own, lists them with their rows, bytes and range of times, and becomes visible by
one new version, which may hold files of several tables, take files out, or both.
Readers see the files of one version: a writer that dies between two tables has
changed nothing for anybody, and what it left is an orphan.

Layout: ``<root>/data/<table>/commit=<name>/<partitions>/<files>``, the lists in
``<root>/lists/commit=<name>``, and ``<root>/versions/<number>``, a small file that
names a commit and is made by a rename that fails if the version exists.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx.plans.session import remove
from chronoctx.sinks.files import clustered

LIST = "table string, path string, added boolean, n_rows long, n_bytes long, low long, high long"
#: Age from which files that no version names count as left behind.
ORPHAN_MS = 24 * 3_600_000


class Conflict(Exception):
    """Another writer came first with something that this one depends on."""


def _system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, path: str) -> list:
    folder, system = _system(spark, path)
    return list(system.listStatus(folder)) if system.exists(folder) else []


def versions(spark: SparkSession, root: str) -> dict[int, dict]:
    """What each version says, by its number."""
    out = {}
    for entry in _entries(spark, f"{root}/versions"):
        name = entry.getPath().getName()
        if name.isdigit():
            stream = entry.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).open(entry.getPath())
            try:
                out[int(name)] = json.loads(bytes(stream.readAllBytes()))
            finally:
                stream.close()
    return dict(sorted(out.items()))


def _publish(spark: SparkSession, root: str, number: int, record: dict) -> bool:
    """Make a version; False if there is one of that number."""
    jvm = spark._jvm
    temporary, system = _system(spark, f"{root}/versions/.{uuid.uuid4().hex}")
    system.mkdirs(temporary.getParent())
    stream = system.create(temporary, False)
    stream.write(json.dumps(record).encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(temporary, jvm.org.apache.hadoop.fs.Path(f"{root}/versions/{number:020d}"), options)
        return True
    except Exception as error:
        system.delete(temporary, False)
        if "FileAlreadyExists" in str(error) or "already exists" in str(error):
            return False
        raise


def file_list(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The files of a version, by table, as ``LIST`` without ``added``."""
    commits = [r["commit"] for n, r in versions(spark, root).items() if version is None or n <= version]
    if not commits:
        return spark.createDataFrame([], LIST).drop("added")
    listed = spark.read.schema(LIST).parquet(*[f"{root}/lists/commit={c}" for c in commits])
    gone = listed.filter(~F.col("added")).select("path")
    return listed.filter("added").drop("added").join(gone, "path", "left_anti")


def read(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame | None:
    """A table as of a version, the newest by default; None where it has no files."""
    return _read(spark, root, table, file_list(spark, root, version).filter(F.col("table") == table))


def _read(spark: SparkSession, root: str, table: str, listed: DataFrame) -> DataFrame | None:
    # The reader's own index holds these names as well.
    paths = [r.path for r in listed.select("path").collect()]
    if not paths:
        return None
    reader = spark.read.option("basePath", f"{root}/data/{table}").option("mergeSchema", True)
    return reader.parquet(*paths).drop("commit")


def _written(spark: SparkSession, root: str, table: str, name: str, time_ms: str) -> DataFrame:
    """The list of the files that one commit wrote for a table."""
    rows = spark.read.option("basePath", f"{root}/data/{table}").parquet(f"{root}/data/{table}/commit={name}")
    when = F.col(time_ms).cast("long") if time_ms in rows.columns else F.lit(None).cast("long")
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("n_rows"), F.first("_metadata.file_size").alias("n_bytes"), F.min(when).alias("low"), F.max(when).alias("high"),
    ).select(F.lit(table).alias("table"), "path", F.lit(True).alias("added"), "n_rows", "n_bytes", "low", "high")


def commit(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], partitions: tuple[str, ...] = ("dest_db", "recv_day"),
    order: tuple[str, ...] = ("dest_table",), time_ms: str = M.RECV_TIME_TS, token: str | None = None,
    taken_out: DataFrame | None = None, based_on: int | None = None,
) -> int:
    """Add rows to tables, and take files (``table, path``) out, in one version,
    whose number is returned. A table is partitioned and sorted by those of the
    columns that it has. A ``token`` that a version already has is not written
    again: a repeated batch finds its first attempt. With ``based_on`` the version is
    made only if it directly follows that one."""
    known = versions(spark, root)
    if token is not None:
        for number, record in known.items():
            if record.get("token") == token:
                return number
    name, lists = uuid.uuid4().hex, []
    for table, rows in tables.items():
        parts, sort = ([c for c in names if c in rows.columns] for names in (partitions, order))
        writer = clustered(rows, parts, sort).write
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{root}/data/{table}/commit={name}")
        if _has_files(spark, f"{root}/data/{table}/commit={name}"):
            lists.append(_written(spark, root, table, name, time_ms))
    if taken_out is not None:
        nothing = [F.lit(None).cast("long").alias(c) for c in ("n_rows", "n_bytes", "low", "high")]
        lists.append(taken_out.select("table", "path", F.lit(False).alias("added"), *nothing))
    whole = lists[0] if lists else spark.createDataFrame([], LIST)
    for part in lists[1:]:
        whole = whole.unionByName(part)
    whole.write.parquet(f"{root}/lists/commit={name}")
    record = {"commit": name, "token": token, "tables": sorted(tables)}
    if based_on is not None:
        if not _publish(spark, root, based_on + 1, record):
            raise Conflict(f"version {based_on} of {root} is not the newest")
        return based_on + 1
    while not _publish(spark, root, number := max(known, default=0) + 1, record):
        before, known = known, versions(spark, root)
        if token is not None:
            for number in set(known) - set(before):
                if known[number].get("token") == token:
                    return number
        if taken_out is not None:
            lost = taken_out.select("path").join(file_list(spark, root).select("path"), "path", "left_anti")
            if not lost.isEmpty():
                raise Conflict(f"files of {root} were taken out by another writer")
    return number


def _has_files(spark: SparkSession, path: str) -> bool:
    folder, system = _system(spark, path)
    found = system.listFiles(folder, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def rewrite(
    spark: SparkSession, root: str, table: str, touched: DataFrame, keep: Callable[[DataFrame], DataFrame],
    emptied: DataFrame | None = None, **layout,
) -> int | None:
    """One version in which the files ``touched`` (``path``) are replaced by what
    ``keep`` leaves of their rows, and the files ``emptied`` are gone. All other files
    stay as they are. None if there is nothing to do."""
    # Counted and read several times: the names of files, not rows.
    names = sorted({r.path for r in touched.select("path").collect()})
    gone = sorted({r.path for r in emptied.select("path").collect()} - set(names)) if emptied is not None else []
    if not names and not gone:
        return None
    out = spark.createDataFrame([(table, path) for path in names + gone], "table string, path string")
    kept = {}
    if names:
        live = file_list(spark, root).filter(F.col("table") == table)
        kept = {table: keep(_read(spark, root, table, live.join(out, ["table", "path"], "left_semi").filter(F.col("path").isin(names))))}
    return commit(spark, root, kept, taken_out=out, **layout)


def orphans(spark: SparkSession, root: str, older_than_ms: int = ORPHAN_MS, now_ms: int | None = None) -> list[str]:
    """Folders of commits that no version names and that have not been changed
    for a while, such as those of writers that died."""
    now = int(time.time() * 1000) if now_ms is None else now_ms
    named = {r["commit"] for r in versions(spark, root).values()}
    folders = [*_entries(spark, f"{root}/lists"), *(c for t in _entries(spark, f"{root}/data") for c in _entries(spark, t.getPath().toString()))]
    return [
        f.getPath().toString() for f in folders
        if f.getPath().getName().removeprefix("commit=") not in named and now - f.getModificationTime() > older_than_ms
    ]


def remove_orphans(spark: SparkSession, root: str, older_than_ms: int = ORPHAN_MS, now_ms: int | None = None) -> int:
    found = orphans(spark, root, older_than_ms, now_ms)
    for folder in found:
        remove(spark, folder)
    return len(found)
