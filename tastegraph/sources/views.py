"""Ratings and products derived from the order, event and part tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _epoch(ts: str) -> Column:
    """Epoch seconds of a zone-less timestamp, whatever the session zone."""
    return (F.unix_date(F.to_date(ts)).cast("long") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines read as ratings: the customer rates the part."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return (line.join(order, line.l_orderkey == order.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("user_id"),
                    F.col("l_partkey").cast("int").alias("product_id"),
                    ((F.col("l_quantity").cast("int") - 1) % 5 + 1).cast("double").alias("score"),
                    _epoch("o_orderdate").alias("ts")))


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as ratings: the kind of event is the score."""
    kind = F.col("event_type")
    score = (F.when(kind == "purchase", 5).when(kind == "signup", 4)
             .when(kind == "click", 3).when(kind == "view", 2).otherwise(1))
    return (spark.read.parquet(f"{sf_dir}/events.parquet")
            .select("event_id",
                    F.col("user_id").cast("int").alias("user_id"),
                    F.get_json_object("props", "$.k").cast("int").alias("product_id"),
                    score.cast("double").alias("score"),
                    _epoch("ts").alias("ts")))


def events_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """History and live part of the event ratings: the first four fifths of the
    event ids, and the rest."""
    events = event_ratings(spark, sf_dir)
    last = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id")).first()[0]
    return events.where(F.col("event_id") <= 0.8 * last), events.where(F.col("event_id") > 0.8 * last)


def products(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Parts read as products; the words of name, brand and type are the tags.
    `extra` columns of the part table are kept."""
    tags = F.replace(F.concat_ws("|", "p_name", "p_brand", "p_type"), F.lit(" "), F.lit("|"))
    return (spark.read.parquet(f"{sf_dir}/part.parquet")
            .select(F.col("p_partkey").cast("int").alias("product_id"),
                    F.col("p_name").alias("name"),
                    F.col("p_type").alias("categories"),
                    F.concat(F.lit("img/"), F.col("p_partkey")).alias("image_url"),
                    tags.alias("tags"), *extra))
