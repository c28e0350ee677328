"""Settings from the environment and connector option builders."""

import os

import pytest
from pyspark.sql.datasource import DataSource

from tickwise.functions.encode import kafka_records
from tickwise.functions.parse import parse_ticks
from tickwise.sources.files import replay_stream
from tickwise.streaming.queries import kafka_sink_query

from tickwise.config import Settings, scratch_path, shared_dir
from tickwise.plans import dashboard
from tickwise.sources import kafka


def test_blank_environment_value_means_default(monkeypatch):
    monkeypatch.setenv("KAFKA_TOPIC", "   ")
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:9092")
    s = Settings.from_env()
    assert s.topic == "crypto-topic" and s.bootstrap_servers == "broker:9092"
    assert Settings.from_env(window_width="1 minute").window_width == "1 minute"


def test_kafka_stream_options():
    opts = kafka.stream_options(Settings(), max_offsets_per_trigger=1000)
    assert opts == {"kafka.bootstrap.servers": "kafka:29092", "subscribe": "crypto-topic",
                    "startingOffsets": "latest", "failOnDataLoss": "false",
                    "maxOffsetsPerTrigger": "1000"}
    bounded = kafka.bounded_options(Settings(kafka_options={"kafka.security.protocol": "SSL"}))
    assert bounded["startingOffsets"] == "earliest" and bounded["endingOffsets"] == "latest"
    assert bounded["kafka.security.protocol"] == "SSL"
    assert kafka.sink_options(Settings())["kafka.acks"] == "all"


def test_scratch_folders_are_fresh_and_shared(spark):
    base = shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base)


def test_kafka_sink_query_is_wired(spark, workdir):
    """The sink asks Spark for the kafka data source; without the connector Spark says it is missing."""
    os.makedirs(os.path.join(workdir, "in"))
    ticks = parse_ticks(replay_stream(spark, os.path.join(workdir, "in")).withColumnRenamed("value", "json"))
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND|Failed to find data source: kafka"):
        kafka_sink_query(kafka_records(ticks), kafka.sink_options(Settings()), os.path.join(workdir, "c"),
                         trigger={"availableNow": True}).awaitTermination()


def test_no_scratch_on_a_cluster_without_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_missing_topic_is_empty_and_settings_reach_the_dashboard(spark, workdir):
    class Missing(DataSource):
        @classmethod
        def name(cls):
            return "absent_topic"

        def schema(self):
            return "value binary"

        def reader(self, schema):
            raise RuntimeError("UnknownTopicOrPartitionException: no such topic")

    spark.dataSource.register(Missing)
    settings = Settings(metadata_path=os.path.join(workdir, "none.csv"), window_width="1 hour", trend_bucket_seconds=10)
    frames = dashboard.from_topic(spark, settings, source="absent_topic")
    assert frames.latest.count() == 0
    messages = spark.createDataFrame(
        [('{"symbol":"BTC","price":"1.5","timestamp":"2026-05-07T12:00:00Z"}',),
         ('{"symbol":"BTC","price":2,"timestamp":"2026-05-07T12:30:00Z"}',), ("garbage",)], "json string")
    frames = dashboard.from_messages(messages, settings=settings)
    assert [(r["average_price"], r["event_count"]) for r in frames.analytics.collect()] == [(1.75, 2)]
    assert frames.trends.count() == 2
    assert frames.grid.agg({"time_bucket": "count"}).first()[0] == 60 + 7
