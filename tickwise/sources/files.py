"""File and catalog readers: metadata CSV, Parquet folders, catalog tables, replayed files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickwise.operators.joins import check_size
from tickwise.schemas import ENRICHED, METADATA, METADATA_FIELDS
from tickwise.sources.fs import path_exists
from tickwise.sources.versions import content_mark, read_version, stored_version


def read_metadata(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """Header CSV of ``symbol, coin_name, category``, all text. A missing file gives an empty frame."""
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], METADATA)
    header = spark.read.option("header", True).csv(path)  # column order is the file's own
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header.columns])
    return spark.read.option("header", True).schema(schema).csv(path).select(*METADATA_FIELDS)


def pin_metadata(spark: SparkSession, path: str, target: str, max_rows: int, max_bytes: int) -> tuple[DataFrame, bool]:
    """A checked, unchanging version of the metadata file for a stream: (rows, whether they may be broadcast).

    A stream's static side is read again in every micro-batch, so a file changed meanwhile would enter unchecked.
    The file's keys are proven unique, then it is copied to ``target`` as a version named by its content; the
    version's rows are compared with that name whenever it is taken up, so a half-written or damaged copy is
    never joined. A restarted stream takes up, and checks, the file as it is then.
    """
    rows, target = read_metadata(spark, path), target.rstrip("/")
    mark = content_mark(rows)
    if not path_exists(spark, f"{target}/version={mark}"):
        mark = stored_version(spark, rows, target, "symbol")
    pinned = read_version(spark, target, mark)
    return pinned, check_size(pinned, max_rows, max_bytes).bounded


def read_parquet_folder(spark: SparkSession, path: str,
                        schema: T.StructType = ENRICHED) -> DataFrame:
    """Parquet folder with a fixed schema; a missing folder gives an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, name: str, refresh: bool = True) -> DataFrame:
    """Catalog table; refreshed first so files added or removed behind the catalog are seen, and for a
    partitioned table partitions written since registration are registered first."""
    if refresh:
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
    return spark.table(name)


def replay_stream(spark: SparkSession, path: str, fmt: str = "text",
                  schema: T.StructType | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Files dropped into ``path`` as a stream, oldest modification time first.

    ``text`` yields one ``value`` column per line; rename it to ``json`` for the tick parser.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
