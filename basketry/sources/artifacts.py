"""Artefacts on disk: vocabulary, features, vectors, masks, tables, checksums."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.facets import facet_mask
from ..operators.clustering import KMeansResult
from ..operators.frequency import published
from ..session import shuffle_width

# Fixed value: facets of a feature layout.
FACET_BLOCK = 6
_DTYPES = {"float16": "<f2", "float32": "<f4"}


def write_vocabulary(items: DataFrame, variant_map: DataFrame, report: DataFrame, folder: str, version: str) -> None:
    """Item rows in index order, variant map in id order and the collapse report."""
    tag = F.lit(version).alias("catalogue_version")
    items.select("*", tag).orderBy("item_idx").write.json(f"{folder}/vocabulary")
    variant_map.select("*", tag).orderBy("id").write.json(f"{folder}/variants")
    report.select("*", tag).write.json(f"{folder}/report")


def write_features(rows: DataFrame, layout: DataFrame, folder: str) -> None:
    rows.write.parquet(f"{folder}/rows")
    layout.write.parquet(f"{folder}/layout")


def read_features(spark: SparkSession, folder: str, facet_block: str = "inks", facets: int = FACET_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows and layout; the facet block must have its length and every row the same width."""
    rows, layout = spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/layout")
    found = layout.filter(F.col("block") == facet_block).select("length").first()
    if found is None or found["length"] != facets:
        raise ValueError(f"layout has no {facets}-wide block {facet_block}")
    dim = layout.agg(F.sum("length").alias("d")).first()["d"]
    shape = rows.agg(F.min(F.size("features")).alias("low"), F.max(F.size("features")).alias("high")).first()
    if shape["low"] != dim or shape["high"] != dim:
        raise ValueError(f"feature rows are not all {dim} wide")
    return rows, layout


def read_embeddings(spark: SparkSession, path: str, names: Sequence[str] = ("embeddings", "card_embeddings"),
                    index: str = "item_idx") -> DataFrame:
    """``(item_idx, vec)`` as float arrays from the first of ``names`` that the table has."""
    table = spark.read.parquet(path)
    name = next((n for n in names if n in table.columns), None)
    if name is None:
        raise ValueError(f"none of {list(names)} in {table.columns}")
    return table.select(index, F.col(name).cast("array<float>").alias("vec"))


def require_shape(vectors: DataFrame, vocabulary: int) -> int:
    """Check one vector per item plus padding and one width; gives the width."""
    if vocabulary < 1:
        raise ValueError("empty vocabulary")
    row = vectors.agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high")).first()
    if row["n"] != vocabulary + 1:
        raise ValueError(f"{row['n']} vectors for {vocabulary} items and padding")
    if row["low"] != row["high"]:
        raise ValueError("vectors differ in width")
    return row["low"]


def packed_vectors(vectors: DataFrame, dtype: str = "float16", index: str = "item_idx") -> DataFrame:
    """``(item_idx, raw)``: little-endian bytes per row, range partitioned and sorted by index; null stays null.

    A batch is packed as one run of numbers, without an object per row.
    """
    if dtype not in _DTYPES:
        raise ValueError(f"unsupported type: {dtype}")
    code = _DTYPES[dtype]

    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vec in batches:
            numbers = vec.flatten().to_numpy(zero_copy_only=False).astype(code)
            ends = np.cumsum(pc.list_value_length(vec).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64) * numbers.itemsize
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            raw = pa.Array.from_buffers(pa.binary(), len(vec), [None, offsets.buffers()[1], pa.py_buffer(numbers)])
            yield pc.if_else(vec.is_valid(), raw, pa.scalar(None, pa.binary())) if vec.null_count else raw

    ordered = vectors.repartitionByRange(shuffle_width(vectors.sparkSession), index).sortWithinPartitions(index)
    return ordered.select(index, pack("vec").alias("raw"))


def unpacked_vectors(packed: DataFrame, dtype: str = "float16", index: str = "item_idx") -> DataFrame:
    """``(item_idx, vec)`` from the bytes of ``packed_vectors``."""
    if dtype not in _DTYPES:
        raise ValueError(f"unsupported type: {dtype}")
    code = _DTYPES[dtype]

    @F.arrow_udf("array<double>")
    def unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for raw in batches:
            held = raw.cast(pa.binary()).fill_null(b"")
            ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset:held.offset + len(held) + 1] if len(held) else np.zeros(1, np.int32)
            body = held.buffers()[2] if ends[-1] > ends[0] else b""
            numbers = np.frombuffer(body, np.uint8)[ends[0]:ends[-1]].view(code).astype(np.float64)
            offsets = pa.array((ends - ends[0]) // np.dtype(code).itemsize, pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(numbers), mask=raw.is_null() if raw.null_count else None)

    return packed.select(index, unpack("raw").alias("vec"))


def facet_masks(items: DataFrame, order: Sequence[str], item: str = "item_idx") -> DataFrame:
    """Mask per item plus the padding row (0, 0)."""
    pad = items.sparkSession.range(1).select(F.lit(0).cast("long").alias(item), F.lit(0).alias("mask"))
    return items.select(F.col(item).cast("long"), facet_mask(F.col("facets"), order).alias("mask")).unionByName(pad)


def write_facet_masks(masks: DataFrame, order: Sequence[str], folder: str, item: str = "item_idx") -> None:
    """Masks in index order with the facet names beside every row."""
    masks.withColumn("facets", F.array(*[F.lit(f) for f in order])).orderBy(item).write.json(folder)


def frequency_documents(table: DataFrame, key: str = "facet_key", item: str = "item_idx") -> DataFrame:
    """``(facet_key, json)``: one object of item -> truncated probability per key, items in order.

    An object lists the items of the catalogue, so its size follows the catalogue.
    """
    rows = published(table, key, item).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(item, "p"))).alias("e"))
    entries = F.transform("e", lambda x: F.struct(x[item].cast("string").alias("k"), x["p"].alias("v")))
    return rows.select(key, F.to_json(F.map_from_entries(entries)).alias("json")).orderBy(key)


def write_centroids(result: KMeansResult, spark: SparkSession, folder: str) -> None:
    """One JSON row: dim, k, centroids, clusterSizes, iterations, seed."""
    centres = [[float(x) for x in c] for c in result.centroids]
    row = (len(centres[0]), len(centres), centres, [int(n) for n in result.sizes], result.iterations, result.seed)
    spark.createDataFrame(
        [row], "dim int, k int, centroids array<array<double>>, clusterSizes array<long>, iterations int, seed string"
    ).write.json(folder)


def file_checksums(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """``(name, sha256, size)`` of the files under ``path``, read in parallel."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    base = F.regexp_replace("path", "^.*/", "") if root is None else F.substring_index("path", root + "/", -1)
    return files.select(base.alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def audit(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """``(name, status)``: ok, mismatch, missing, or unlisted where the manifest has no entry."""
    want = manifest.select("name", F.col("sha256").alias("w"), F.col("size").alias("ws"))
    joined = want.join(found.select("name", F.col("sha256").alias("g"), F.col("size").alias("gs")), "name", "full_outer")
    same = (F.col("w") == F.col("g")) & (F.col("ws").isNull() | (F.col("ws") == F.col("gs")))
    status = F.when(F.col("g").isNull(), "missing").when(F.col("w").isNull(), "unlisted").when(same, "ok").otherwise("mismatch")
    return joined.select("name", status.alias("status"))


def require_audited(report: DataFrame, sample: int = 20) -> None:
    bad = report.filter(F.col("status").isin("missing", "mismatch")).limit(sample).collect()
    if bad:
        raise ValueError(f"artefacts do not match their manifest: {[tuple(r) for r in bad]}")
