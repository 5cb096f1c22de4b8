"""Writers.

History goes to one shared table per layout with the destination as columns,
never to one physical table per entity: ``dest_db`` and the day are partition
folders and rows are sorted by ``dest_table`` inside them. The rebalance hint
lets adaptive execution split a partition that a hot destination fills.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoctx import model as M

FORMATS = ("json-row", "json-column", "csv-row", "csv-column")


def with_day(df: DataFrame, ts_ms: str = M.RECV_TIME_TS) -> DataFrame:
    """The UTC day of reception, as a partition column."""
    return df.withColumn("recv_day", F.to_date(F.timestamp_millis(F.col(ts_ms).cast("bigint"))))


def clustered(df: DataFrame, partitions: list[str], order: list[str]) -> DataFrame:
    spread = df.hint("rebalance", *[F.col(c) for c in partitions]) if partitions else df.hint("rebalance")
    return spread.sortWithinPartitions(*partitions, *order) if partitions or order else spread


def append_table(
    df: DataFrame, path: str, partitions: tuple[str, ...] = ("dest_db", "recv_day"),
    order: tuple[str, ...] = ("dest_table",),
) -> None:
    """Append to a shared parquet table; create it when it does not exist."""
    clustered(df, list(partitions), list(order)).write.mode("append").partitionBy(*partitions).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A shared table whose files may differ in width."""
    return spark.read.option("mergeSchema", True).parquet(path)


def destination_view(table: DataFrame, name: str, database: str, dest: str) -> None:
    """One destination of a shared table as a view; both filters prune."""
    table.filter((F.col("dest_db") == database) & (F.col("dest_table") == dest)).createOrReplaceTempView(name)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the output of one micro-batch. A repeated batch replaces what its
    first attempt left, so a retry neither loses nor doubles rows."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


@contextmanager
def open_folders(spark: SparkSession, count: int):
    """Writes inside the block keep up to ``count`` partition folders of a task open,
    so that rows of so few folders need not be sorted by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, count)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of what is in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within one file system."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def append_lines(lines: DataFrame, path: str, partitions: tuple[str, ...] = ("dest_db",)) -> None:
    """Append text lines (column ``line``) below partition folders."""
    kept = lines.select(*partitions, "line")
    clustered(kept, list(partitions), []).write.mode("append").partitionBy(*partitions).text(path)


def append_csv(df: DataFrame, path: str, partitions: tuple[str, ...] = ("dest_db",)) -> None:
    clustered(df, list(partitions), []).write.mode("append").partitionBy(*partitions).csv(path, emptyValue="")


def append_csv_with_metadata(df: DataFrame, path: str, partitions: tuple[str, ...] = ("dest_db",)) -> None:
    """Append CSV rows and the records of their side files (column ``metadata``, an
    array of structs) in one pass: to ``<path>/part=rows`` and ``<path>/part=metadata``,
    below the same partition folders. Both come from the same row, so no link is
    written without its records."""
    quoting = {"emptyValue": "", "timeZone": "UTC"}
    names = [c for c in df.columns if c not in (*partitions, "metadata")]
    row = F.struct(F.lit("rows").alias("part"), F.to_csv(F.struct(*names), quoting).alias("line"))
    side = F.transform("metadata", lambda r: F.struct(F.lit("metadata").alias("part"), F.to_csv(r, quoting).alias("line")))
    lines = df.select(*partitions, F.inline(F.concat(F.array(row), side)))
    clustered(lines, ["part", *partitions], []).write.mode("append").partitionBy("part", *partitions).text(path)


def read_csv_part(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    """Rows or metadata as ``append_csv_with_metadata`` wrote them."""
    return spark.read.schema(schema).csv(f"{path}/part={part}")


def export_by_destination(
    df: DataFrame, path: str, column: str = "dest_folder", fmt: str = "text"
) -> None:
    """One folder per destination, for few destinations: each one makes files of
    its own. The shared layout serves any number of them."""
    clustered(df, [column], []).write.mode("append").partitionBy(column).format(fmt).save(path)


def save_table(df: DataFrame, name: str, partitions: tuple[str, ...] = ()) -> None:
    """Append to a catalog table, created on first use."""
    writer = df.write.mode("append").format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> None:
    """Append the rows of one destination to a relational server."""
    df.write.mode("append").option("batchsize", batch_size).jdbc(url, table, properties=properties)


def external_table(
    spark: SparkSession, name: str, path: str, schema: StructType | str, file_format: str, database: str = "default"
) -> None:
    """A catalog table over a folder of JSON or CSV files; ``database`` is the
    default one or one per tenant."""
    if file_format not in FORMATS:
        raise ValueError(f"file format must be one of {FORMATS}")
    if isinstance(schema, StructType):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    using = file_format.split("-")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({schema}) USING {using} LOCATION '{path}'")
