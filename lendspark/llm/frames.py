"""Small helpers that the operators share: inputs, stored intermediate results, text batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.session import scratch_path

#: Rows in an Arrow batch. Whole texts are sent, so the usual 10,000 rows could be many gigabytes.
BATCH_ROWS = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that other columns may have any name. Sets the batch size for texts."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: the lineage ends here, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def returned_memory(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task; then what the task has freed goes back to the system.

    A worker is kept for later tasks, of other stages too. Without this it keeps the most that any of them took,
    beside the memory of the executor's JVM.
    """

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return tidied


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, NULL as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def remainder(mod: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def sha256_text(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
