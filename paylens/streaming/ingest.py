"""File streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FILES_PER_BATCH = 1000


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """New files of a folder, in micro-batches of bounded size.

    A stream never infers its schema: the contract's schema is part of the call.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)
