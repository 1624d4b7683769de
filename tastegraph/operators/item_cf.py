"""Item similarity from co-ratings: users who rate one product rate the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tastegraph.functions import as_lists
from tastegraph.operators.sparse_pairs import related_items
from tastegraph.workspace import materialize


def item_cf_sims(ratings: DataFrame, k: int | None = 5) -> DataFrame:
    """The k products most often rated by the same users, as (product_id, rid,
    r, rank), with r = n_ab / sqrt(n_a * n_b). Ratings without a user or product
    count for nothing.

    Counts are of rating rows, so a product rated twice by a user counts twice.
    Repeats are folded into one weighted entry first, which leaves the counts as
    they are and bounds a user's entries by the catalogue. k=None returns all
    related pairs, unranked.
    """
    entries = materialize(
        ratings.where("user_id is not null and product_id is not null").groupBy("user_id", "product_id").agg(F.count("*").alias("n"))
        .select(F.col("user_id").cast("long").alias("key"), F.col("product_id").alias("item"),
                F.col("n").cast("double").alias("weight")),
        "co-ratings")
    norms = entries.groupBy("item").agg(F.sum("weight").alias("norm"))
    return related_items(entries, norms, k)


def item_cf_lists(ratings: DataFrame, k: int = 5) -> DataFrame:
    """The same, one row per rated product with its list; a product without
    neighbours keeps an empty list."""
    return as_lists(item_cf_sims(ratings, k), ratings, "product_id", ["rid", "r"])
