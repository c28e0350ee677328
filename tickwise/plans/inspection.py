"""Inspection report of the stored tick table.

Sequence: data files in the folder -> (stop when none) -> register the external table if absent -> tables
of the database -> schema -> row count -> event-time range -> rows per (symbol, name, category), largest
first -> newest rows. Row count, range and rows-per-key come from one grouped scan of the table; the
grouped result (one row per key combination) is written once, the newest rows are a separate top-k.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.config import Settings, written
from tickwise.operators.summary import key_profile, newest
from tickwise.plans import catalog
from tickwise.sources.files import read_table

KEYS = ("symbol", "coin_name", "category")


@dataclass
class InspectionReport:
    table: str
    path: str
    file_count: int
    frames: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def empty(self) -> bool:
        return self.file_count == 0


def inspect(spark: SparkSession, settings: Settings = Settings(),
            order: tuple[str, ...] = ("timestamp",)) -> InspectionReport:
    """Build the report; DataFrames stay lazy except the file count and the written key profile.

    The newest rows are ordered by ``order`` and then by every other column, so that ties are always broken
    the same way.
    """
    database, table, path = settings.database, settings.table, settings.output_path
    catalog.create_database(spark, database)
    files = catalog.count_data_files(spark, path, settings.partition_by_day).first()["file_count"]
    name = catalog.TableRef(database, table).sql
    report = InspectionReport(name, path, int(files))
    report.frames["tables_before"] = catalog.show_tables(spark, database)
    if report.empty:
        return report
    catalog.register_table(spark, database, table, path, replace=False,
                           partition_by_day=settings.partition_by_day)
    df = read_table(spark, name)
    profile = written(key_profile(df, KEYS), "key_profile")  # one row per key combination
    report.frames.update({
        "tables": catalog.show_tables(spark, database),
        "schema": catalog.schema_report(df),
        "row_count": profile.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("record_count")),
        "time_range": profile.agg(F.min("first_event_timestamp").alias("first_event_timestamp"),
                                  F.max("latest_event_timestamp").alias("latest_event_timestamp")),
        "rows_by_symbol": profile.select(*KEYS, "count").orderBy(F.desc("count"), *KEYS),
        "recent_sample": newest(df, settings.sample_size, (*order, *(c for c in df.columns if c not in order))),
    })
    return report


def print_report(report: InspectionReport) -> None:
    """Console rendering; every result is printed whole, row by row."""
    print(f"\n--- folder\n{report.path}")
    if report.empty:
        print("The folder holds no data files yet; start the stream command to fill it.")
        return
    for title, key in (("tables of the database", "tables"), ("columns", "schema"), ("stored ticks", "row_count"),
                       ("first and last event", "time_range"), ("ticks by symbol, name and category", "rows_by_symbol"),
                       ("newest ticks", "recent_sample")):
        print_rows(title, report.frames[key])
    print(f"\n--- data files\n{report.file_count}")


def print_rows(title: str, df: DataFrame) -> None:
    """All rows of a result, tab-separated under a heading; fetched partition by partition."""
    print(f"\n--- {title}")
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))
