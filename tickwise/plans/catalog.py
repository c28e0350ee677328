"""Catalog management for the stored tick table: external Parquet tables over a folder.

``CREATE TABLE ... USING PARQUET LOCATION`` makes an external table: dropping it leaves the files, and a
new table over the same folder sees them again. Spark caches a table's file list, so every write or
deletion behind the catalog is followed by ``refreshTable``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.schemas import ENRICHED_DDL
from tickwise.sources.fs import delete_children, delete_path, path_exists, qualified

@dataclass(frozen=True)
class TableRef:
    """A table by database and name; ``sql`` is its quoted form for statements."""

    database: str
    table: str

    @staticmethod
    def part(name: str) -> str:
        return f"`{name.replace('`', '``')}`"

    @property
    def sql(self) -> str:
        return ".".join(map(self.part, (self.database, self.table)))


def sql_string(value: str) -> str:
    """A single-quoted SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {TableRef.part(database)}")


def register_table(spark: SparkSession, database: str, table: str, path: str,
                   replace: bool = True, columns_ddl: str = ENRICHED_DDL,
                   partition_by_day: bool = False) -> str:
    """Create the database and an external Parquet table over ``path``; returns the quoted name.

    ``replace`` drops an existing definition first (the data files stay); otherwise an existing table is
    kept as it is (``IF NOT EXISTS``). ``partition_by_day`` declares the ``day`` partition column written
    by the day-partitioned storage layout and registers the partitions already present.
    """
    create_database(spark, database)
    name = TableRef(database, table).sql
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    guard = "" if replace else "IF NOT EXISTS "
    columns, partitioning = columns_ddl, ""
    if partition_by_day:
        columns, partitioning = f"{columns_ddl}, `day` DATE", "PARTITIONED BY (`day`) "
    spark.sql(f"CREATE TABLE {guard}{name} ({columns}) USING PARQUET {partitioning}"
              f"LOCATION {sql_string(path)}")
    # A folder written by the streaming file sink is described by its metadata log: Spark then keeps no
    # partition list in the catalog and reads prune through the log, so there is nothing to recover.
    if partition_by_day and any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def show_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def show_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {TableRef.part(database)}")


def schema_report(df: DataFrame) -> DataFrame:
    """The schema as rows: ``position, column, type, nullable``."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def data_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """The ``.parquet`` files directly in ``path`` (with ``recursive``, also in partition sub-folders),
    with size and modification time.

    Spark's ``binaryFile`` source lists in parallel for large folders; the file content is never read
    because only metadata columns are selected. A missing folder gives no rows.
    """
    schema = "path string, modificationTime timestamp, length long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
               .option("recursiveFileLookup", str(recursive).lower()).load(path))
    if recursive:
        return listing.select("path", "modificationTime", "length")
    top = qualified(spark, path)
    # Only files whose parent is the folder itself; partition sub-folders are not counted.
    parent = F.regexp_replace(F.col("path"), "/[^/]*$", "")
    return listing.select("path", "modificationTime", "length").filter(parent == F.lit(top))


def count_data_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    return data_files(spark, path, recursive).agg(F.count(F.lit(1)).alias("file_count"))


def clear_location(spark: SparkSession, path: str, table: str | None = None,
                   checkpoint: str | None = None) -> int:
    """Delete everything inside a table folder, then refresh the table. Destructive, explicit only.

    For a folder written by Spark's streaming file sink pass the writing query's ``checkpoint`` as well (the
    query must be stopped): it is deleted too, so a restarted query starts a fresh log instead of resuming
    offsets whose files are gone.
    """
    if checkpoint:
        delete_path(spark, checkpoint)
    deleted = delete_children(spark, path)
    if table:
        spark.catalog.refreshTable(table)
    return deleted


def compact(spark: SparkSession, source_path: str, target_path: str, rows_per_file: int = 5_000_000,
            sort_by: str = "timestamp", partition_by_day: bool = False) -> DataFrame:
    """Rewrite a folder of many small micro-batch files into large, time-ordered files in a new folder.

    Streaming appends leave one small file per task and trigger. The rewrite range-partitions by event
    time (sampled boundaries, no single-task sort) so each output file covers a contiguous time range,
    which makes row-group pruning on time effective; with ``partition_by_day`` the ``day`` folders of that
    layout are kept. A random number after the time key lets equal rows spread over files as well (which
    file a row is in does not change the table). The target must be a different folder: a folder written by
    the streaming file sink is governed by its metadata log. Returns the compacted table.
    """
    if source_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("compaction writes to a different folder")
    df = spark.read.parquet(source_path)
    if partition_by_day and "day" not in df.columns:
        df = df.withColumn("day", F.to_date(F.col(sort_by)))
    files = max(1, -(-df.count() // rows_per_file))
    lead = ["day"] if partition_by_day else []
    out = (df.withColumn("_spread", F.rand(17)).repartitionByRange(files, *lead, F.col(sort_by), F.col("_spread"))
           .sortWithinPartitions(*lead, sort_by).drop("_spread")
           .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file))
    (out.partitionBy("day") if partition_by_day else out).parquet(target_path)
    return spark.read.parquet(target_path)
