"""Settings, session construction and the shared scratch location.

One frozen dataclass carries every knob of the price-tick jobs. Values are read from the environment
the same way the original streaming job did: a blank variable counts as unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

# Defaults of the original deployment (environment names and their fall-backs).
DEFAULT_BOOTSTRAP_SERVERS = "kafka:29092"
DEFAULT_TOPIC = "crypto-topic"
DEFAULT_METADATA_PATH = "/opt/spark-app/metadata/crypto_metadata.csv"
DEFAULT_OUTPUT_PATH = "/opt/spark-app/storage/crypto_analytics.db"
DEFAULT_CHECKPOINT_PATH = "/opt/spark-app/storage/checkpoints"
DEFAULT_WAREHOUSE_PATH = "/opt/spark-app/storage"
DEFAULT_DATABASE = "crypto_analytics"
DEFAULT_TABLE = "crypto_info"


def read_setting(name: str, default: str) -> str:
    """Environment lookup where an empty or blank value means "use the default"."""
    value = os.environ.get(name)
    return default if value is None or not value.strip() else value


@dataclass(frozen=True)
class Settings:
    bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS
    topic: str = DEFAULT_TOPIC
    metadata_path: str = DEFAULT_METADATA_PATH
    output_path: str = DEFAULT_OUTPUT_PATH
    checkpoint_path: str = DEFAULT_CHECKPOINT_PATH
    warehouse_dir: str = DEFAULT_WAREHOUSE_PATH
    database: str = DEFAULT_DATABASE
    table: str = DEFAULT_TABLE
    # Event-time parameters that were hard-coded in the original job and dashboard.
    window_width: str = "2 seconds"
    watermark_delay: str = "2 seconds"
    trend_bucket_seconds: int = 40
    trend_history_minutes: int = 10
    trend_lookahead_seconds: int = 60
    sample_size: int = 20
    # Stored table layout: flat folder (original) or day=YYYY-MM-DD partitions for time pruning.
    partition_by_day: bool = False
    # Where table definitions live: in this session ("in-memory") or in a shared Hive metastore ("hive").
    catalog: str = "in-memory"
    # Upper bound on the number of dimension rows shipped to every executor.
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 64 * 1024 * 1024
    kafka_options: dict = field(default_factory=dict)

    @classmethod
    def from_env(cls, **overrides) -> "Settings":
        base = cls(
            bootstrap_servers=read_setting("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BOOTSTRAP_SERVERS),
            topic=read_setting("KAFKA_TOPIC", DEFAULT_TOPIC),
            metadata_path=read_setting("CRYPTO_METADATA_PATH", DEFAULT_METADATA_PATH),
            output_path=read_setting("SPARK_PARQUET_OUTPUT_PATH", DEFAULT_OUTPUT_PATH),
            checkpoint_path=read_setting("SPARK_CHECKPOINT_PATH", DEFAULT_CHECKPOINT_PATH),
            warehouse_dir=read_setting("SPARK_WAREHOUSE_DIR", DEFAULT_WAREHOUSE_PATH),
        )
        return replace(base, **overrides)


# Session options every job relies on. Event time is interpreted in UTC; the committer and Parquet
# summary switches keep a written table folder to data files only (no _SUCCESS marker, no summary files),
# which the storage contract asks for.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    "spark.hadoop.parquet.summary.metadata.level": "NONE",
    # State of windowed aggregations lives in RocksDB (off-heap, scales past executor memory); changelog
    # checkpointing uploads only the changes of each micro-batch instead of a full snapshot.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tickwise", master: str | None = None,
                  settings: Settings | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the options above.

    With ``settings.catalog == "hive"`` tables registered by one process are known to the next, through the
    metastore that the cluster's Hive configuration names.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if settings is not None:
        conf["spark.sql.warehouse.dir"] = settings.warehouse_dir
        conf["spark.sql.catalogImplementation"] = settings.catalog
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event-time results are defined in UTC; pin the session if a caller built it otherwise."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system every executor can reach; without one this fails. Only a
    local session (unit tests, a laptop) gets a folder of its own, registered as its checkpoint directory.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"no shared scratch folder: set spark.checkpoint.dir to one that all executors of "
                           f"{master} can reach")
    local = tempfile.mkdtemp(prefix="tickwise-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_root(spark: SparkSession) -> str:
    """This application's own part of the shared scratch folder."""
    return f"{shared_dir(spark)}/tickwise/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder below the application's scratch folder."""
    return f"{scratch_root(spark)}/{purpose}/{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the scratch folder: computed once, lineage cut, no executor holds them."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete everything this application left in the scratch folder, with the tables registered over it.

    Call it when no result of the application is needed any more: results read from there.
    """
    root = scratch_root(spark)
    app = spark.sparkContext.applicationId
    for db in [d.name for d in spark.catalog.listDatabases()]:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            where = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{t.name}`").collect()
                     if r["col_name"] == "Location"]
            if where and f"/tickwise/{app}/" in where[0]:
                spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{t.name}`")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
