"""Reading files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header, every column a string; names from the header if not given."""
    reader = spark.read.option("header", True)
    return reader.schema(text_schema(columns)).csv(path) if columns else reader.option("inferSchema", False).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """CSV with a schema; a value that does not fit fails the read, or becomes null."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path)


def read_csv_damaged(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows and corrupt lines of a CSV file that carries foreign lines.

    A line with another number of fields, or with values of the wrong type (such as a
    repeated header), is corrupt.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    rows = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT
    ).csv(path)
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, _corrupt_rows(rows, schema)


def _corrupt_rows(rows: DataFrame, schema: StructType) -> DataFrame:
    """The lines that could not be parsed.

    A text source refuses to read the corrupt-record column alone, so the condition,
    true for every row, mentions the parsed columns as well.
    """
    parsed = F.concat_ws("", *[F.col(c).cast("string") for c in schema.fieldNames()])
    return rows.where(F.col(CORRUPT).isNotNull() & (F.length(parsed) >= 0)).select(CORRUPT)


def read_json_batches(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Records of files that hold an object or an array each, and the unreadable files.

    Empty files give nothing; a broken file gives one row in the second frame instead of
    vanishing.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    rows = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT
    ).json(path)
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, _corrupt_rows(rows, schema)


def read_partition(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """One partition of a partitioned table; the other folders are never listed for data."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(value))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table folder; ``delta`` and the like need their package on the cluster."""
    return spark.read.format(fmt).load(path)


def read_or_skip(spark: SparkSession, path: str) -> tuple[DataFrame | None, str]:
    """The table, or None and a warning if the source does not exist."""
    try:
        return spark.read.parquet(path), "loaded"
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem.getCondition()):
            return None, "source_missing"
        raise


def with_ingestion_metadata(df: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Add load time, source file and run id to rows read from files."""
    return df.select(
        "*",
        (at if at is not None else F.current_timestamp()).alias("ingestion_timestamp"),
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+\.[a-z]+)(/|$)", 1).alias("source_file"),
        F.lit(run_id).alias("pipeline_run_id"),
    )


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder with size and time; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", "modificationTime")


def folder_inventory(objects: DataFrame) -> DataFrame:
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    return objects.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def latest_object(objects: DataFrame) -> DataFrame:
    return objects.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
