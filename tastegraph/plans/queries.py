"""The registered queries: each maps (spark, sf_dir) to a flat result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tastegraph.functions import delimited, year_month
from tastegraph.operators import content, item_cf, latent, online, popularity
from tastegraph.operators.co_ratings import CoRatings
from tastegraph.operators.dense_pairs import best_matches
from tastegraph.operators.norm_blocks import best_dots
from tastegraph.operators.pair_index import PairIndex
from tastegraph.operators.pivot_blocks import cosine_links
from tastegraph.sources import messages, text, views
from tastegraph.sources.snapshots import Snapshots
from tastegraph.streaming import recommender
from tastegraph.workspace import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]

OUTPUT_DECIMALS = 6


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, OUTPUT_DECIMALS) for c in columns})


def _all_read(spark: SparkSession, load: Callable, path: str) -> DataFrame:
    """The rows of lines that were written here and so must all be good; the file
    is read once."""
    counts = Observation("lines")
    rows = materialize(load(spark, path, counts)[0], "loaded")
    if counts.get["unread"]:
        raise ValueError(f"{counts.get['unread']} lines of {path} can't be read")
    return rows


def load_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products written as caret-separated lines and loaded from them."""
    lines = views.products(spark, sf_dir, "p_size", "p_brand").select(
        delimited("^", "product_id", "name", "p_size", "p_brand", "image_url", "categories", "tags"))
    path = new_path(spark, "product-lines")
    lines.write.text(path)
    return _all_read(spark, text.load_products, path)


def load_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings written as comma-separated lines and loaded from them."""
    path = new_path(spark, "rating-lines")
    views.ratings(spark, sf_dir).select(delimited(",", "user_id", "product_id", "score", "ts")).write.text(path)
    return _all_read(spark, text.load_ratings, path)


def rate_more_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity.rate_more_products(views.ratings(spark, sf_dir))


def rate_more_recently_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity.rate_more_recently_products(views.ratings(spark, sf_dir))


def average_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity.average_products(views.ratings(spark, sf_dir))


def _written_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALS passes over its input many times."""
    return materialize(views.ratings(spark, sf_dir), "ratings")


def als_user_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = latent.train_als(_written_ratings(spark, sf_dir))
    return latent.als_user_recs(model, views.products(spark, sf_dir))


def als_product_sims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of products above 0, both ways round."""
    return latent.als_product_sims(latent.train_als(_written_ratings(spark, sf_dir)))


def als_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.als_grid_search(views.ratings(spark, sf_dir))


def rating_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _written_ratings(spark, sf_dir)
    return _rounded(latent.rating_rmse(rows, latent.product_mean_predictions(rows)), "rmse")


def dense_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (spark.read.parquet(f"{sf_dir}/embeddings.parquet")
               .select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))
    return best_matches(vectors, vectors, 5, same=True, decimals=OUTPUT_DECIMALS).withColumnRenamed("id", "vec_id")


def dense_dot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of a catalogue, here those with a label, with the highest
    dot product with each vector: what `als_user_recs` does with its factors."""
    vectors = (spark.read.parquet(f"{sf_dir}/embeddings.parquet")
               .select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")))
    catalogue = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id")).distinct()
    found = best_matches(vectors, materialize(vectors.join(catalogue, "id", "left_semi"), "catalogue"), 20, "dot",
                         decimals=OUTPUT_DECIMALS)
    return found.withColumnRenamed("id", "vec_id")


def part_score_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each customer the 20 parts with the highest dot product of what is
    known of both: what `als_user_recs` does, with vectors of very unlike length
    in blocks of 16 KB."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("id"),
        _doubles(F.sqrt(F.col("c_acctbal").cast("double") + 1000) / 10, F.col("c_nationkey") / 10, F.lit(1)))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("id"),
        _doubles(F.col("p_size") * F.sqrt("p_size") / 100, F.sqrt(F.col("p_retailprice").cast("double")) / 100, F.col("p_size") % 3))
    found = best_dots(materialize(customers, "customers"), materialize(parts, "parts"), 20, OUTPUT_DECIMALS, block_bytes=16 << 10)
    return found.select(F.col("id").alias("c_custkey"), F.col("rid").alias("p_partkey"), "r", "rank")


def season_sims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose ratings are spread over the months of the year much alike:
    all pairs with a cosine of 0.95 or more, between the smallest ids of products
    with the same counts; `copies` and `r_copies` say how many these stand for."""
    month = F.month(F.timestamp_seconds("ts"))
    counts = F.array(*(F.count_if(month == m).cast("double") for m in range(1, 13)))
    vectors = views.ratings(spark, sf_dir).groupBy(F.col("product_id").alias("id")).agg(counts.alias("vector"))
    links, _ = cosine_links(vectors, 0.95, OUTPUT_DECIMALS, copies=True)
    return (links.select(F.col("id").cast("int").alias("product_id"), F.col("rid").cast("int"), "r", "copies", "r_copies"))


def _doubles(*values: Column) -> Column:
    return F.array(*(v.cast("double") for v in values)).alias("vector")


def item_cf_sims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(item_cf.item_cf_sims(views.ratings(spark, sf_dir)), "r")


def item_cf_sims_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`item_cf_sims` with the ratings counted in year by year."""
    ratings = _written_ratings(spark, sf_dir).withColumn("year", F.floor(year_month("ts") / 100))
    kept = CoRatings(spark, new_path(spark, "co-ratings"), logs=3)
    years = [r[0] for r in ratings.select("year").distinct().sort("year").collect()]
    for increment, year in enumerate(years):
        kept.add(ratings.where(F.col("year") == year), increment)
    return _rounded(kept.sims(), "r")


def content_sims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.content_sims(views.products(spark, sf_dir))


def content_sims_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.content_sims_hashed(views.products(spark, sf_dir))


def parse_rating_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ratings written as messages and parsed back; an event without a
    product is no rating."""
    feed = materialize(messages.format_messages(views.event_ratings(spark, sf_dir)), "feed")
    return messages.parse_rating_messages(feed)[0]


def user_recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online.user_recent_ratings(views.event_ratings(spark, sf_dir))


def _live_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, PairIndex]:
    """History, live ratings, the most similar products of each product by the
    history, and the index of its pairs."""
    history, live = (materialize(df, name) for df, name in
                     zip(views.events_split(spark, sf_dir), ("history", "live")))
    lists = materialize(online.top_lists(item_cf.item_cf_sims(history, k=online.LIST_DEPTH)), "similar")
    return history, live, lists, PairIndex.build(history, new_path(spark, "pair-index"))


def top_similar_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every live rating."""
    history, live, similar, index = _live_tables(spark, sf_dir)
    return _rounded(online.top_similar_unrated_deep(live, similar, online.LIST_DEPTH, history, index), "r")


def stream_priority_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the state after all live ratings, computed as one batch."""
    history, live, similar, index = _live_tables(spark, sf_dir)
    recent = materialize(online.user_recent_ratings(live), "recent")
    candidates = materialize(online.top_similar_unrated_deep(
        recent.where("rank = 1"), similar, online.LIST_DEPTH, history, index), "candidates")
    pairs = index.similarities(online.needed_pairs(candidates, recent))
    return _rounded(online.stream_priority_score(candidates, recent, pairs), "score")


def _replayed(spark: SparkSession, sf_dir: str, live_rated: bool, store: Snapshots | None = None) -> DataFrame:
    history, live, similar, index = _live_tables(spark, sf_dir)
    feed, rated, lists, log = (new_path(spark, name) for name in ("feed", "rated", "similar-lists", "stream-recs"))
    messages.format_messages(live).repartition(4).write.parquet(feed)
    recommender.save_rated(history, rated)
    recommender.save_similar(similar, lists)
    query = recommender.start_recommender(
        messages.read_rating_stream(spark, feed, files_per_batch=2), spark.read.parquet(lists), spark.read.parquet(rated),
        store or log, new_path(spark, "stream-checkpoint"), interval=None,
        state_partitions=spark.sparkContext.defaultParallelism, index=index, live_rated=live_rated)
    query.awaitTermination()
    flat = recommender.flat_recs(recommender.stored_recs(store) if store else recommender.latest_recs(spark, log))
    return online.ranked_recs(flat, OUTPUT_DECIMALS)


def stream_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table after the live ratings went through the stream."""
    return _replayed(spark, sf_dir, live_rated=False)


def stream_recs_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without what the user has rated in the stream itself, kept in versions."""
    store = recommender.rec_store(spark, new_path(spark, "rec-store"), most_folders=2)
    return _replayed(spark, sf_dir, live_rated=True, store=store)


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    load_products, load_ratings, rate_more_products, rate_more_recently_products, average_products,
    als_user_recs, als_product_sims, dense_cosine_topk, dense_dot_topk, part_score_topk, season_sims,
    item_cf_sims, item_cf_sims_increments, content_sims_hashed, content_sims,
    als_grid_search, rating_rmse, parse_rating_messages, user_recent_ratings, top_similar_unrated,
    stream_priority_score, stream_recs, stream_recs_unrated)}
