"""Rating statistics per product. Each is one aggregation with map-side partial
results, so a product with a large share of the ratings is no hot spot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tastegraph.functions import year_month


def rate_more_products(ratings: DataFrame) -> DataFrame:
    """Number of ratings of each product."""
    return ratings.groupBy("product_id").agg(F.count("*").alias("count"))


def rate_more_recently_products(ratings: DataFrame) -> DataFrame:
    """Number of ratings of each product in each month (yyyyMM)."""
    return (ratings.groupBy("product_id", year_month("ts").alias("yearmonth"))
            .agg(F.count("*").alias("count"))
            .select("product_id", "count", "yearmonth"))


def average_products(ratings: DataFrame) -> DataFrame:
    """Mean score of each product, best first."""
    return (ratings.groupBy("product_id").agg(F.avg("score").alias("avg"))
            .orderBy(F.desc("avg"), "product_id"))
