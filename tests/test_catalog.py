"""External table registration, refresh, clearing, file counting and the inspection report."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tickwise.config import Settings
from tickwise.plans import catalog
from tickwise.plans.inspection import inspect

ROWS = [("BTC", "Bitcoin", "Store of Value", 100.0, dt.datetime(2026, 5, 7, 12, 0, 0)),
        ("BTC", "Bitcoin", "Store of Value", 120.0, dt.datetime(2026, 5, 7, 12, 0, 10)),
        ("ETH", "Ethereum", "Smart Contracts", 50.0, dt.datetime(2026, 5, 7, 12, 0, 20))]
SCHEMA = "symbol string, coin_name string, category string, price double, timestamp timestamp"


def _write(spark, path, rows=ROWS):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_identifiers():
    assert catalog.TableRef("d`b", "t").sql == "`d``b`.`t`"
    assert catalog.sql_string("it's") == "'it\\'s'"


def test_external_table_lifecycle(spark, workdir):
    path = os.path.join(workdir, "tbl")
    _write(spark, path)
    name = catalog.register_table(spark, "tw_test", "ticks", path)
    assert spark.table(name).count() == 3
    kind = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Type'").first()["data_type"]
    assert kind == "EXTERNAL"
    # Files written behind the catalog are seen after a refresh.
    _write(spark, path)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 6
    # Dropping an external table keeps its files; a new definition sees them again.
    spark.sql(f"DROP TABLE {name}")
    assert os.listdir(path)
    catalog.register_table(spark, "tw_test", "ticks", path, replace=False)
    assert spark.table(name).count() == 6
    assert "ticks" in [r["tableName"] for r in catalog.show_tables(spark, "tw_test").collect()]
    assert "tw_test" in [r[0] for r in catalog.show_databases(spark).collect()]
    # Clearing the folder empties the table.
    assert catalog.clear_location(spark, path, name) >= 2
    assert spark.table(name).count() == 0


def test_file_count(spark, workdir):
    path = os.path.join(workdir, "files")
    assert catalog.count_data_files(spark, path).first()["file_count"] == 0
    _write(spark, path)
    _write(spark, path)
    os.makedirs(os.path.join(path, "nested"))
    with open(os.path.join(path, "notes.txt"), "w") as fh:
        fh.write("x")
    assert catalog.count_data_files(spark, path).first()["file_count"] == 2


def test_schema_report(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = catalog.schema_report(df).orderBy("position").collect()
    assert [(r["column"], r["type"]) for r in rows][-1] == ("timestamp", "timestamp")


def test_inspection_report(spark, workdir):
    empty = inspect(spark, Settings(database="tw_inspect", table="none", output_path=os.path.join(workdir, "x")))
    assert empty.empty and "tables" not in empty.frames
    path = os.path.join(workdir, "stored")
    _write(spark, path)
    report = inspect(spark, Settings(database="tw_inspect", table="stored", output_path=path, sample_size=2))
    assert report.file_count == 1
    f = report.frames
    assert f["row_count"].first()["record_count"] == 3
    assert f["time_range"].first()["latest_event_timestamp"] == dt.datetime(2026, 5, 7, 12, 0, 20)
    assert [(r["symbol"], r["count"]) for r in f["rows_by_symbol"].collect()] == [("BTC", 2), ("ETH", 1)]
    assert [r["price"] for r in f["recent_sample"].collect()] == [50.0, 120.0]


def test_inspection_of_day_partitioned_table(spark, workdir):
    path = os.path.join(workdir, "by_day")
    (spark.createDataFrame(ROWS, SCHEMA).withColumn("day", F.to_date("timestamp"))
     .write.partitionBy("day").parquet(path))
    settings = Settings(database="tw_inspect_days", table="t", output_path=path, partition_by_day=True)
    report = inspect(spark, settings)
    assert report.file_count >= 1
    assert report.frames["row_count"].first()["record_count"] == 3
    assert catalog.count_data_files(spark, path).first()["file_count"] == 0  # nothing at the top level


def test_compaction_keeps_day_folders(spark, workdir):
    src, dst = os.path.join(workdir, "src"), os.path.join(workdir, "dst")
    spark.range(0, 300).selectExpr("cast(id as double) as price", "timestamp_seconds(id * 1000) as timestamp",
                                   "date(timestamp_seconds(id * 1000)) as day").write.partitionBy("day").parquet(src)
    out = catalog.compact(spark, src, dst, partition_by_day=True)
    assert out.count() == 300 and [d for d in os.listdir(dst) if d.startswith("day=")]
