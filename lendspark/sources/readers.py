"""Readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.schemas import APPLICATION, RAW_FILE

CORRUPT = "_corrupt"


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_FILE) -> DataFrame:
    """Raw CSV with header; a line that does not parse keeps its text in ``_corrupt``.

    A file whose header has other names, or another order, stops the job (``enforceSchema``).
    """
    return (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_applications_csv(spark: SparkSession, path: str, schema: T.StructType = APPLICATION) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_applications_json(
    spark: SparkSession, path: str, schema: T.StructType = APPLICATION, multiline: bool = False
) -> DataFrame:
    """JSON lines, or with ``multiline`` files that hold one JSON array each.

    Array files cannot be divided, so keep each of them at request-batch size.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def explode_batch(df: DataFrame, payload: str, schema: T.StructType = APPLICATION) -> DataFrame:
    """One row per item of a text column that holds a JSON array of applications.

    Fields outside the schema are ignored; ``item`` is the position in the array.
    """
    parsed = F.from_json(F.col(payload), T.ArrayType(schema))
    keep = [c for c in df.columns if c != payload]
    return df.select(*keep, F.posexplode(parsed).alias("item", "_a")).select(*keep, "item", "_a.*")


def encode(c: Column) -> Column:
    return F.to_json(c)


def decode(c: Column | str, schema: T.DataType | str) -> Column:
    return F.from_json(c, schema)
