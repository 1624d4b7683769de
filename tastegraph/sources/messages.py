"""The live rating feed: `uid|pid|score|ts` text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tastegraph.functions import delimited
from tastegraph.schemas import MESSAGE, RATING


def parse_rating_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed ratings from message text, batch or stream, and apart the messages
    that could not be read as they came. A score that is no number cannot be
    read. Other columns of `messages` are kept."""
    field = F.split("value", r"\|")
    columns = {f.name: F.trim(F.try_element_at(field, F.lit(i + 1))).try_cast(f.dataType)
               for i, f in enumerate(RATING.fields)}
    parsed = messages.withColumns(columns)
    good = ~F.isnan("score")
    for name in columns:
        good &= F.col(name).isNotNull()
    good = F.coalesce(good, F.lit(False))
    return parsed.where(good).drop("value"), parsed.where(~good).select(messages.columns)


def format_messages(ratings: DataFrame) -> DataFrame:
    """The inverse, for replaying stored ratings as a feed."""
    text = delimited("|", "user_id", "product_id", "score", "ts")
    return ratings.select(F.col("event_id").cast("long").alias("seq"), text.alias("value"))


#: Partitions of a topic that a place in the feed can tell apart.
MOST_PARTITIONS = 1 << 16


def feed_place(partition: Column, offset: Column) -> Column:
    """One number per message of a topic, by offset and then by partition: no two
    messages share it, and a message delivered again has it again."""
    return offset.cast("long") * MOST_PARTITIONS + partition.cast("long")


def read_rating_stream(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                       files_per_batch: int | None = None) -> DataFrame:
    """A stream of (seq, value). `kafka` holds the broker options of Spark's
    Kafka source (bootstrap servers, topic), whose connector the cluster has to
    provide; `path` replays parquet files of messages."""
    if kafka is not None:
        feed = spark.readStream.format("kafka").options(**{"startingOffsets": "latest", **kafka}).load()
        # One user's messages share a partition when the producer keys by user.
        return feed.select(feed_place(F.col("partition"), F.col("offset")).alias("seq"), F.col("value").cast("string").alias("value"))
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
