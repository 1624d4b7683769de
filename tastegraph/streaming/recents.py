"""The newest ratings of every user, and what they have rated, kept as state of the stream."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tastegraph.session import STATE_STORE

_RATING = "product_id int, score double, ts long, seq long"
_COLUMNS = ["product_id", "score", "ts", "seq"]


def recent_ratings_stream(ratings: DataFrame, n: int) -> DataFrame:
    """For each user with new ratings in a batch, the n newest seen so far:
    (user_id, rank, product_id, score, ts, seq, rated), rank 1 the newest by (ts,
    seq). Its row also has all products the user has rated in the stream so far;
    the others' `rated` is null. A rating that comes again with the same `seq` counts
    once, however late: what n newer ones have pushed out stays out.
    """
    def newest_per_user(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            newest_first = frame.drop_duplicates(["user_id", "seq"]).sort_values(["ts", "seq"], ascending=False)
            newest = newest_first.groupby("user_id").cumcount() < n
            yield newest_first[newest | ~newest_first.duplicated(["user_id", "product_id"])]

    ratings = ratings.select("user_id", *_COLUMNS)
    # Of ratings older than a user's n newest only the product can matter, so
    # repeats are dropped before the shuffle: a very busy user sends n rows and
    # one per product of a batch of rows.
    return (ratings.mapInPandas(newest_per_user, f"user_id int, {_RATING}")
            .groupBy("user_id")
            .transformWithState(
                statefulProcessor=_RecentRatings(n),
                outputStructType=f"user_id int, rank int, {_RATING}, rated array<int>",
                outputMode="Update", timeMode="None"))


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stream takes over when it starts: list state needs the RocksDB
    store, and its number of partitions stays fixed for the checkpoint's life."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class _RecentRatings(StatefulProcessor):
    """Holds a user's newest ratings and the products rated; a call sees one
    user's few new ratings. Only products not seen before are written."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", _RATING)
        self.rated = handle.getMapState("rated", "product_id int", "known boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r.product_id, r.score, r.ts, r.seq) for r in rows]
        products = {k[0] for k in self.rated.keys()} if self.rated.exists() else set()
        for product in {r[0] for r in new} - products:
            self.rated.updateValue((product,), (True,))
            products.add(product)
        by_seq = {r[3]: tuple(r) for r in chain(self.recent.get(), new)}
        kept = heapq.nlargest(self.n, by_seq.values(), key=lambda r: (r[2], r[3]))
        self.recent.put(kept)
        for rank, rating in enumerate(kept, 1):
            yield Row(user_id=key[0], rank=rank, **dict(zip(_COLUMNS, rating)),
                      rated=sorted(products) if rank == 1 else None)

    def close(self) -> None:
        pass
