"""What several text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows of one Arrow batch. Texts can be long, so batches are short.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark wherever it is stored."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Short Arrow batches, and workers that can import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wish: str) -> str:
    """A name that no column of ``df`` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body
    uses it; a lambda variable is the one binding that column expressions have."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str | Column = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def row_key(*columns: str) -> Column:
    """128 bits that name a row by its content. Equal rows share a key, so what
    is computed per key holds for each of them; ids may be null or repeated."""
    values = [F.col(c) for c in columns]
    shape = F.concat(*[F.when(v.isNull(), F.lit("n")).otherwise(F.lit("v")) for v in values])
    return F.struct(
        F.xxhash64(shape, *values).alias("a"), F.xxhash64(F.lit("second"), shape, *values).alias("b"),
    )


def map_rows(
    df: DataFrame, function: Callable[[Iterable], Iterable[tuple]], schema: str,
) -> DataFrame:
    """``function`` turns the column lists of one Arrow batch into row tuples.
    One batch is in memory at a time; Spark deals out the batches."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(function([c.to_pylist() for c in batch.columns]))
            columns = list(zip(*rows)) or [[] for _ in out]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return df.mapInArrow(run, schema)
