"""The steps of the live recommender, as joins that serve a batch and a stream.

similar: (product_id, rid, r, place) as `rank_similar` gives it; rated: (user_id, product_id); requests: the
(user_id, product_id) a user has just rated; recent: a user's newest ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tastegraph.functions import as_lists, priority, top_per_group
from tastegraph.operators.pair_index import PairIndex
from tastegraph.workspace import materialize

RECENT = 20
CANDIDATES = 20
#: Similar products kept per product; more are worked out where a user needs them.
LIST_DEPTH = 100


def user_recent_ratings(ratings: DataFrame, n: int = RECENT, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The n newest ratings of each user, newest first: the rating and `rank`."""
    return top_per_group(ratings, ["user_id"], [F.desc(c) for c in order], n)


def rank_similar(similar: DataFrame) -> DataFrame:
    """Number each product's similar ones from the most similar down. Done once
    and written out, it serves every batch of the stream."""
    return top_per_group(similar.select("product_id", "rid", "r"), ["product_id"],
                         [F.desc("r"), F.asc("rid")], None).withColumnRenamed("rank", "place")


def top_similar_unrated(requests: DataFrame, similar: DataFrame, rated: DataFrame,
                        k: int = CANDIDATES) -> DataFrame:
    """For each requested user and product, the k products most similar to it
    that the user has not rated: (user_id, product_id, rid, r, rank). A product
    without similar ones has no candidates.

    A user who has rated n products finds the k best unrated among the n + k
    most similar, so no more of the list than that is joined.
    """
    requests = requests.select("user_id", "product_id").distinct()
    # Repeats are dropped before any join, so a user's share is at most the catalogue.
    known = rated.select("user_id", F.col("product_id").alias("rid")).distinct()
    reach = known.groupBy("user_id").agg(F.count("*").alias("n"))
    wanted = requests.join(reach, "user_id", "left").withColumn("reach", F.coalesce("n", F.lit(0)) + k)
    candidates = (wanted.join(similar, "product_id").where("place <= reach")
                  .select("user_id", "product_id", "rid", "r")
                  .join(known, ["user_id", "rid"], "left_anti"))
    return (top_per_group(candidates, ["user_id", "product_id"], [F.desc("r"), F.asc("rid")], k)
            .select("user_id", "product_id", "rid", "r", "rank"))


def top_lists(similar: DataFrame) -> DataFrame:
    """Ranked lists as `item_cf_sims` gives them, cut at some depth, in the form
    `top_similar_unrated` reads."""
    return similar.select("product_id", "rid", "r", F.col("rank").alias("place"))


def top_similar_unrated_deep(requests: DataFrame, lists: DataFrame, depth: int, rated: DataFrame, index: PairIndex,
                             k: int = CANDIDATES) -> DataFrame:
    """`top_similar_unrated` from lists cut at `depth`. Where a user has rated so
    much of a cut list that fewer than k are left, the product's whole row is
    worked out from the index: the result is that of complete lists."""
    requests = materialize(requests.select("user_id", "product_id").distinct(), "requests")
    keys = ["user_id", "product_id"]
    first = materialize(top_similar_unrated(requests, lists.where(F.col("place") <= depth), rated, k), "candidates")
    full = lists.where(F.col("place") == depth).select("product_id").distinct()
    enough = first.where(F.col("rank") == k).select(*keys)
    short = materialize(requests.join(full, "product_id", "left_semi").join(enough, keys, "left_anti"), "short")
    if short.isEmpty():
        return first
    rows = materialize(rank_similar(index.rows(short)), "rows")
    return first.join(short, keys, "left_anti").unionByName(top_similar_unrated(short, rows, rated, k))


def needed_pairs(candidates: DataFrame, recent: DataFrame) -> DataFrame:
    """(left, right): the pairs whose similarity the scores of these candidates need."""
    return (candidates.select("user_id", F.col("rid").alias("left"))
            .join(recent.select("user_id", F.col("product_id").alias("right")), "user_id")
            .select("left", "right").distinct())


def stream_priority_score(candidates: DataFrame, recent: DataFrame, similar: DataFrame) -> DataFrame:
    """Priority of each candidate: (user_id, product_id, score).

    `candidates` (user_id, rid) and `recent` (user_id, product_id, score) both
    hold a bounded number of rows per user. Every recent rating r with
    sim(candidate, r) > 0 adds sim * rating to the mean; ratings above 3 raise
    the result by log2 of their number, the others lower it. Candidates without
    a positive similarity are left out.
    """
    sims = similar.where("r > 0").select(F.col("product_id").alias("rid"),
                                         F.col("rid").alias("seen"), F.col("r").alias("sim"))
    pairs = (candidates.select("user_id", "rid")
             .join(recent.select("user_id", F.col("product_id").alias("seen"), F.col("score").alias("rating")),
                   "user_id"))
    return (pairs.join(sims, ["rid", "seen"])
            .groupBy("user_id", F.col("rid").alias("product_id"))
            .agg(priority("sim", "rating").alias("score")))


def ranked_recs(scores: DataFrame, decimals: int | None = None) -> DataFrame:
    """Scores with their rank per user, best first, ties to the smaller id."""
    if decimals is not None:
        scores = scores.withColumn("score", F.round("score", decimals))
    return top_per_group(scores, ["user_id"], [F.desc("score"), F.asc("product_id")], None)


def rec_lists(scores: DataFrame, users: DataFrame) -> DataFrame:
    """One row per user with the ranked list; users without any keep an empty one."""
    return as_lists(ranked_recs(scores), users, "user_id", ["product_id", "score"])
