"""The live recommender: each rating replaces its user's recommendations.

A batch of the stream appends the new lists of the users it touched to a log,
in a folder of its own batch number. A batch that is run again overwrites its
folder, so its effect is the same however often it runs, and no batch rewrites
what other users have. Readers take each user's newest list. Kept in a store of
versions instead, the batches are folded up as they come and a reader stays with
the version it began with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tastegraph.operators.online import (CANDIDATES, LIST_DEPTH, RECENT, needed_pairs, rec_lists,
                                         stream_priority_score, top_similar_unrated, top_similar_unrated_deep)
from tastegraph.operators.pair_index import PairIndex
from tastegraph.schemas import STREAM_RECS
from tastegraph.sources.messages import parse_rating_messages
from tastegraph.sources.snapshots import Snapshots
from tastegraph.streaming.recents import recent_ratings_stream, state_settings
from tastegraph.workspace import materialize

RATED_BUCKETS = 32
SIMILAR_BUCKETS = 64

_LOG = T.StructType([*STREAM_RECS.fields, T.StructField("batch_id", T.LongType())])


def _bucket(buckets: int, column: str = "user_id") -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def save_similar(similar: DataFrame, path: str, buckets: int = SIMILAR_BUCKETS) -> None:
    """The similar products (product_id, rid, r, place), in one folder per bucket
    of products, so that a batch reads the lists of its own products only. With a
    pair index beside it the lists may be cut at a depth; without one all pairs
    are needed, since a score may need any pair of a candidate and a recent one."""
    (similar.withColumn("bucket", _bucket(buckets, "product_id")).repartition(buckets, "bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def lists_of(similar: DataFrame, products: DataFrame, buckets: int) -> DataFrame:
    """The part of a table of `save_similar` that may hold these products. Their
    buckets, at most `buckets` numbers, are looked up first, so that the scan is
    pruned to their folders."""
    wanted = [r[0] for r in products.select(_bucket(buckets, "product_id")).distinct().collect()]
    return similar.where(F.col("bucket").isin(wanted)).drop("bucket")


def save_rated(ratings: DataFrame, path: str, buckets: int = RATED_BUCKETS) -> None:
    """Who has rated what, in one folder per bucket of users, so that a batch
    reads the buckets of its own users only. Choose `buckets` so that one holds
    some 100 MB."""
    (ratings.select("user_id", "product_id").distinct().withColumn("bucket", _bucket(buckets))
     .repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path))


def _newest_lists(lists: DataFrame) -> DataFrame:
    return lists.groupBy("user_id").agg(F.max_by("recs", "batch_id").alias("recs"), F.max("batch_id").alias("batch_id"))


def rec_store(spark: SparkSession, path: str, most_folders: int = 16) -> Snapshots:
    """Every user's newest list, as versions to which each batch adds one. A
    version reads from at most `most_folders` + 1 folders."""
    return Snapshots(spark, path, "user_id int, recs array<struct<product_id:int,score:double>>, batch_id bigint",
                     most_folders, fold=_newest_lists)


def stored_recs(store: Snapshots, version: int | None = None) -> DataFrame:
    """(user_id, recs, batch_id) of a version, by default the newest."""
    return store.fold(store.read(version))


def start_recommender(messages: DataFrame, similar: DataFrame, rated: DataFrame, log_path: str | Snapshots,
                      checkpoint_path: str, n: int = RECENT, k: int = CANDIDATES,
                      interval: str | None = "2 seconds", buckets: int = RATED_BUCKETS,
                      similar_buckets: int = SIMILAR_BUCKETS,
                      state_partitions: int | None = None, rejected_path: str | None = None,
                      index: PairIndex | None = None, depth: int = LIST_DEPTH,
                      live_rated: bool = False) -> StreamingQuery:
    """Run over a stream of (seq, value) messages. The lists go to the log under
    `log_path`, or to the store given in its place.

    Messages that can't be read go to `rejected_path`, in a folder per batch, by
    the same query: it stops if either can't be written. Its progress has the numbers of
    messages read and not, as the observed metrics `read` and, with such a path,
    `unread`. A message delivered again, with the place in the feed it had, changes nothing.

    `similar` is a table made by `save_similar`, `rated` one made by `save_rated`,
    with the same numbers of buckets. With interval=None the query works off what is there and
    stops. `state_partitions` is the number of parts of the users' state, by
    default the session's shuffle partitions. With an `index` of the ratings,
    `similar` holds lists cut at `depth`. With `live_rated`, what a user rates in
    the stream is no longer recommended; else only what `rated` holds counts.
    """

    def recommend(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if rejected_path:
                unread = batch.where("unread").select(messages.columns)
                unread.write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
            recents = batch.where("not unread") if rejected_path else batch
            lists = batch_recommendations(recents, similar, rated, k, buckets, similar_buckets, index, depth, live_rated)
            if isinstance(log_path, Snapshots):
                log_path.append(lists.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id)
            else:
                lists.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    good, rejected = parse_rating_messages(messages)
    out = recent_ratings_stream(good.observe("read", F.count("*").alias("n")), n)
    if rejected_path:
        counted = rejected.observe("unread", F.count("*").alias("n")).withColumn("unread", F.lit(True))
        out = out.withColumn("unread", F.lit(False)).unionByName(counted, allowMissingColumns=True)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with state_settings(messages.sparkSession, state_partitions):
        return (out.writeStream.outputMode("update").foreachBatch(recommend)
                .option("checkpointLocation", checkpoint_path).trigger(**trigger).start())


def batch_recommendations(recents: DataFrame, similar: DataFrame, rated: DataFrame,
                          k: int = CANDIDATES, buckets: int = RATED_BUCKETS,
                          similar_buckets: int = SIMILAR_BUCKETS, index: PairIndex | None = None,
                          depth: int = LIST_DEPTH, live_rated: bool = False) -> DataFrame:
    """(user_id, recs) for the users in `recents`: candidates are like the newest
    rating, scores come from all recent ones."""
    requests = recents.where("rank = 1").select("user_id", "product_id")
    users = requests.select("user_id").withColumn("bucket", _bucket(buckets))
    known = rated.join(users, ["bucket", "user_id"], "left_semi").select("user_id", "product_id")
    if live_rated:
        known = known.union(recents.where("rank = 1").select("user_id", F.explode("rated").alias("product_id")))
    known = materialize(known, "known")
    near = lists_of(similar, requests, similar_buckets)
    if index is not None:
        candidates = materialize(top_similar_unrated_deep(requests, near, depth, known, index, k), "candidates")
        scored = index.similarities(needed_pairs(candidates, recents))
        return rec_lists(stream_priority_score(candidates, recents, scored), requests)
    candidates = materialize(top_similar_unrated(requests, near, known, k), "candidates")
    scored = lists_of(similar, candidates.select(F.col("rid").alias("product_id")), similar_buckets)
    return rec_lists(stream_priority_score(candidates, recents, scored), requests)


def latest_recs(spark: SparkSession, *log_paths: str) -> DataFrame:
    """(user_id, recs, batch_id): each user's newest list in the logs."""
    log = spark.read.schema(_LOG).parquet(log_paths[0])
    for path in log_paths[1:]:
        log = log.unionByName(spark.read.schema(_LOG).parquet(path))
    return _newest_lists(log)


def compact_recs(spark: SparkSession, compacted_path: str, *log_paths: str) -> None:
    """Write the newest lists to a new log; reading it together with the folders
    that came later gives the same lists from fewer rows."""
    latest_recs(spark, *log_paths).write.partitionBy("batch_id").parquet(compacted_path)


def flat_recs(lists: DataFrame) -> DataFrame:
    return lists.select("user_id", F.explode("recs").alias("rec")).select("user_id", "rec.product_id", "rec.score")
