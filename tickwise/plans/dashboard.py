"""The dashboard's queries as one Spark plan over the whole stored table or topic.

Source (Parquet folder or a bounded topic read) -> lenient normalisation -> left enrichment with the
metadata file -> latest tick per symbol, bucketed statistics, last price per trend bucket, dense trend grid
and the symbol list. Every result is a DataFrame; nothing is gathered on the driver, and the charting
layer only reads the small results.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.config import Settings, use_utc, written
from tickwise.functions.parse import loose_messages, normalize_prices
from tickwise.operators.enrich import enrich
from tickwise.operators.grid import dense_trend_grid
from tickwise.operators.latest import last_in_bucket, latest_per_key
from tickwise.operators.summary import distinct_values
from tickwise.operators.windows import bucket_stats
from tickwise.sources.files import read_metadata, read_parquet_folder
from tickwise.sources.kafka import read_topic


class DashboardFrames:
    """The dashboard's results over one cleaned price table, each built on first access (the trend grid
    runs a small preparatory job, so it is only prepared when asked for)."""

    def __init__(self, prices: DataFrame, settings: Settings, tie_breakers: tuple[str, ...] = ()):
        self.prices = prices
        self.settings = settings
        self.tie_breakers = tie_breakers

    @cached_property
    def latest(self) -> DataFrame:
        order = ("timestamp", *self.tie_breakers)
        return (latest_per_key(self.prices, "symbol", order,
                               columns=["coin_name", "category", "price", "timestamp"]).orderBy("symbol"))

    @cached_property
    def analytics(self) -> DataFrame:
        return bucket_stats(self.prices, self.settings.window_width).orderBy("symbol", "time_bucket")

    @cached_property
    def trends(self) -> DataFrame:
        bucket = f"{self.settings.trend_bucket_seconds} seconds"
        return (last_in_bucket(self.prices, bucket, "symbol", "price", tie_breakers=self.tie_breakers)
                .orderBy("symbol", "time_bucket"))

    @cached_property
    def grid(self) -> DataFrame:
        s = self.settings
        # The grid reads its ticks twice: the cleaned feed is written once, so nothing is parsed again.
        prices = written(self.prices.select("symbol", "timestamp", "price", *self.tie_breakers), "dashboard_prices")
        return dense_trend_grid(prices, "symbol", tie_breakers=self.tie_breakers,
                                bucket_seconds=s.trend_bucket_seconds,
                                history_minutes=s.trend_history_minutes,
                                lookahead_seconds=s.trend_lookahead_seconds)

    @cached_property
    def symbols(self) -> DataFrame:
        return distinct_values(self.prices, "symbol")


def enrich_with_metadata(prices: DataFrame, metadata: DataFrame) -> DataFrame:
    """Replace name/category from the metadata; an empty metadata table leaves the prices unchanged."""
    if metadata.isEmpty():
        return prices
    return normalize_prices(enrich(prices, metadata, key="symbol"))


def build(prices: DataFrame, metadata: DataFrame | None = None, settings: Settings = Settings(),
          tie_breakers: tuple[str, ...] = ()) -> DashboardFrames:
    """All dashboard results from a price table with ``symbol, price, timestamp`` (any loose typing)."""
    use_utc(prices.sparkSession)
    clean = normalize_prices(prices)
    if metadata is not None:
        clean = enrich_with_metadata(clean, metadata)
    return DashboardFrames(clean, settings, tie_breakers)


def from_parquet(spark: SparkSession, settings: Settings, tie_breakers: tuple[str, ...] = ()) -> DashboardFrames:
    """Dashboard over the stored folder (missing folder -> empty results)."""
    return build(read_parquet_folder(spark, settings.output_path), settings=settings, tie_breakers=tie_breakers)


def from_messages(messages: DataFrame, metadata: DataFrame | None = None, settings: Settings = Settings(),
                  tie_breakers: tuple[str, ...] = ()) -> DashboardFrames:
    """Dashboard over JSON messages (``json`` text, with any tie-breaker columns). Messages are read
    leniently, numbers in quotes included; undecodable ones are dropped, not fatal."""
    return build(loose_messages(messages, keep=tie_breakers), metadata, settings, tie_breakers)


def from_topic(spark: SparkSession, settings: Settings, source: str = "kafka") -> DashboardFrames:
    """Dashboard over the whole topic; a missing topic gives empty results."""
    return from_messages(read_topic(spark, settings, source), read_metadata(spark, settings.metadata_path), settings)


def symbol_grid(frames: DashboardFrames, symbol: str) -> DataFrame:
    """One symbol's chart points (grid points with a price)."""
    return frames.grid.filter((F.col("symbol") == symbol) & F.col("price").isNotNull())
