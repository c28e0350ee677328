"""Kafka source and sink builders.

The Kafka connector is a separate Spark package (``spark-sql-kafka``); these builders only assemble the
reader/writer with the right options. Where the connector is absent, ``load()`` raises Spark's
"data source not found" error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickwise.config import Settings
from tickwise.functions.parse import bytes_to_text


def stream_options(settings: Settings, starting_offsets: str = "latest",
                   fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None,
                   min_partitions: int | None = None) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(settings.kafka_options)
    return opts


def bounded_options(settings: Settings) -> dict[str, str]:
    """Whole topic as it stands: earliest offsets up to the end offsets taken at start, all partitions."""
    opts = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    opts.update(settings.kafka_options)
    return opts


def read_stream(spark: SparkSession, settings: Settings, **kw) -> DataFrame:
    """Streaming read of the tick topic; one ``json`` text column."""
    raw = spark.readStream.format("kafka").options(**stream_options(settings, **kw)).load()
    return bytes_to_text(raw)


def read_topic(spark: SparkSession, settings: Settings, source: str = "kafka") -> DataFrame:
    """Bounded batch read of the whole topic; one ``json`` text column. A topic that does not exist is empty.

    ``source`` names the data source, so another one with the same record layout can stand in.
    """
    empty = spark.createDataFrame([], "json string")
    try:
        raw = spark.read.format(source).options(**bounded_options(settings)).load()
        raw.isEmpty()  # the connector asks for the topic's partitions when it plans the read
    except Exception as error:  # noqa: BLE001 - only the missing topic is handled, everything else is raised
        if "UnknownTopicOrPartition" in str(error) or "UNKNOWN_TOPIC" in str(error):
            return empty
        raise
    return bytes_to_text(raw)


def sink_options(settings: Settings, acks: str = "all") -> dict[str, str]:
    return {"kafka.bootstrap.servers": settings.bootstrap_servers, "topic": settings.topic,
            "kafka.acks": acks}


def write_records(records: DataFrame, settings: Settings) -> None:
    """Batch write of ``key, value`` rows (see ``functions.encode.kafka_records``)."""
    records.select("key", "value").write.format("kafka").options(**sink_options(settings)).save()
