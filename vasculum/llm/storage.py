"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whole numbers that may be broadcast: 16 MB at 16 bytes each.
BROADCAST_IDS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, as in tests, one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def stored(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """`df`, written as Parquet to a new shared folder and read again, in files of `file_rows` rows at most if that is not 0.

    Cuts the lineage: lost executors read the files instead of computing anew, and what is
    not deterministic (row numbers) is fixed. The folder is the caller's to clear after the job.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def picked(df: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of `df` whose `column` is among the distinct values of `ids` (stored), or with left_anti those whose is not.

    Up to BROADCAST_IDS counted values they are broadcast, so wide rows stay where they are; beyond, both sides are shuffled.
    """
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, column, how)


def in_parts(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of the text or binary column each, one row at least: long texts bound memory too.

    What a part has used is given back to the system when the next one is asked for: Python workers live on from stage to stage.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
            gc.collect(0)
            pa.default_memory_pool().release_unused()
