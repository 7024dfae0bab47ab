"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_folder, ship_package

#: Rows in one Arrow batch: bounds what a Python worker holds when some texts are very long.
BATCH_ROWS = 500
#: Blanks between words: space and \\x09-\\x0D, which is also what ``bytes.split()`` splits on.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def give_back() -> None:
    """Return freed memory to the system: a worker process lives on, idle, beside the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_stream(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``fn`` over the small pandas frames of each partition.

    Frames come and go through Arrow here, so that integers beside nulls stay integers: pandas would
    make them doubles, which hold ids above 2**53 only roughly.
    """
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batch.to_pandas(integer_object_nulls=True) for batch in batches if batch.num_rows):
            if len(out):
                yield from pa.Table.from_pandas(out, schema=target, preserve_index=False).combine_chunks().to_batches()
        give_back()

    return df.mapInArrow(run, schema)


def map_frames(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` over small pandas frames, inside Spark's own partitions."""
    return map_stream(df, lambda frames: map(fn, frames), schema)


def map_texts(docs: DataFrame, fn: Callable[[list[str | None]], tuple[list[str | None], list[bool] | None]]) -> DataFrame:
    """The documents with new texts; ``fn`` gives the texts and which rows stay (None: all).

    All other columns go through as they are, whatever their types. ``n_chars``, where there is such
    a column, is counted anew.
    """
    ship_package(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = docs.withColumn("text", F.col("text").cast("string"))
    place = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = fn(batch.column(place).to_pylist())
            out = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            yield out if keep is None else out.filter(pa.array(keep, pa.bool_()))
        give_back()

    out = rows.mapInArrow(run, rows.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def fresh_name(wanted: str, taken: Sequence[str]) -> str:
    """``wanted``, with as many underscores in front as keep it apart from the columns there are."""
    while wanted.lower() in {c.lower() for c in taken}:
        wanted = "_" + wanted
    return wanted


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back: lineage is cut, lost executors do no harm."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove the files of a ``stage`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out() -> Column:
    """A fifth of all documents, never used for learning labels."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def bounded_sample(df: DataFrame, key: str, limit: int, columns: Sequence[str]) -> pd.DataFrame:
    """At most ``limit`` rows, the first in hash order of ``key``; a top-k per task, then of those."""
    return (df.withColumn("_order", F.xxhash64(key)).orderBy("_order", key).limit(limit)
            .select(*columns).toPandas())
