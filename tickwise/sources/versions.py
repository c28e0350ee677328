"""Checked, unchanging copies of a lookup relation, named by their content."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.joins import assert_unique_keys
from tickwise.sources.fs import delete_path, move


def content_mark(rows: DataFrame) -> str:
    """A name for the content: number of rows and the sum of their hashes, in any order."""
    mark = rows.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{mark['n']}-{mark['h'] or 0}"


def stored_version(spark: SparkSession, rows: DataFrame, folder: str, key: str) -> str:
    """Check ``rows``, store them below ``folder`` as a version and return its mark.

    Keys are proven unique first. The copy is compared with the rows and renamed into place last, so a folder that
    bears a mark is whole.
    """
    assert_unique_keys(rows, key)
    proven, temporary = content_mark(rows), f"{folder}/_new-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(temporary)
        copied = spark.read.schema(rows.schema).parquet(temporary)
        mark = content_mark(copied)
        if mark != proven:  # the source changed while it was read
            assert_unique_keys(copied, key)
        move(spark, temporary, f"{folder}/version={mark}")
    finally:
        delete_path(spark, temporary)
    return mark


def read_version(spark: SparkSession, folder: str, mark: str) -> DataFrame:
    """The rows of a version; raises when they are not what its mark says."""
    rows = spark.read.parquet(f"{folder}/version={mark}")
    found = content_mark(rows)
    if found != mark:
        raise ValueError(f"dimension version {mark} in {folder} is damaged: its content is {found}")
    return rows
