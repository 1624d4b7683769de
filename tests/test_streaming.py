"""The live recommender replayed in one batch, in many, and out of order."""

import random
import re

import pytest

from tests.conftest import rows
from tastegraph.operators.item_cf import item_cf_sims
from tastegraph.operators.online import rank_similar
from tastegraph.operators.pair_index import PairIndex
from tastegraph.sources import read_rating_stream
from tastegraph.streaming.recommender import (SIMILAR_BUCKETS, compact_recs, flat_recs, latest_recs, lists_of, rec_store,
                                              save_rated, save_similar, start_recommender, stored_recs)


def past():
    chance = random.Random(11)
    return [(u, chance.randrange(60)) for u in range(25) for _ in range(12)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    chance = random.Random(9)
    history = [(u, p, float(chance.randint(1, 5)), 0) for u, p in past()]
    rated = spark.createDataFrame(history, "user_id int, product_id int, score double, ts long")
    lists = str(tmp_path_factory.mktemp("similar") / "table")
    save_similar(rank_similar(item_cf_sims(rated, k=None)), lists)
    similar = spark.read.parquet(lists)
    path = str(tmp_path_factory.mktemp("rated") / "table")
    save_rated(rated, path, buckets=4)
    # One user sends a third of the feed; several ratings share a second.
    live = [(i, 0 if i % 3 == 0 else chance.randrange(25), chance.randrange(60), chance.randint(1, 5), i // 4)
            for i in range(240)]
    live.append((240, 77, 9999, 5, 61))     # unknown product: no candidates
    return similar, spark.read.parquet(path), live


def _replay(spark, tables, folder, batches, **settings):
    similar, rated, _ = tables
    for n, batch in enumerate(batches):
        messages = [(seq, f"{u}|{p}|{s}|{t}") for seq, u, p, s, t in batch]
        spark.createDataFrame(messages, "seq long, value string").coalesce(1).write.parquet(f"{folder}/feed/{n}")
    log = f"{folder}/log"
    feed = read_rating_stream(spark, f"{folder}/feed/*", files_per_batch=1)
    query = start_recommender(feed, similar, rated, log, f"{folder}/checkpoint", interval=None, buckets=4, **settings)
    query.awaitTermination()
    assert query.exception() is None
    return log


def _final(spark, *logs):
    return {r.user_id: [(e.product_id, round(e.score, 9)) for e in r.recs] for r in latest_recs(spark, *logs).collect()}


def test_batches_and_their_order_do_not_matter(spark, tables, tmp_path):
    live = tables[2]
    shuffled = live[:]
    random.Random(1).shuffle(shuffled)
    third = len(live) // 3
    one = _replay(spark, tables, str(tmp_path / "one"), [live])
    many = _replay(spark, tables, str(tmp_path / "many"), [live[i:i + third] for i in range(0, len(live), third)])
    mixed = _replay(spark, tables, str(tmp_path / "mixed"), [shuffled[:third], shuffled[third:]])
    result = _final(spark, one)
    assert result == _final(spark, many) == _final(spark, mixed)
    assert result[77] == [] and len(result) == len({u for _, u, *_ in live})
    assert all(0 < len(recs) <= 20 for user, recs in result.items() if user != 77)

    compact_recs(spark, str(tmp_path / "compact"), many)
    assert _final(spark, str(tmp_path / "compact")) == result
    assert rows(flat_recs(latest_recs(spark, one)).select("user_id").distinct()) == sorted(
        (u,) for u in result if u != 77)


def test_rejected_messages_are_kept(spark, tables, tmp_path):
    similar, rated, _ = tables
    lines = [(1, "1|5|4|10"), (2, "no rating"), (3, "1|6|NaN|11"), (4, "2|7|3|12")]
    spark.createDataFrame(lines, "seq long, value string").coalesce(1).write.parquet(f"{tmp_path}/feed/0")
    feed = read_rating_stream(spark, f"{tmp_path}/feed/*", files_per_batch=1)
    query = start_recommender(feed, similar, rated, f"{tmp_path}/log", f"{tmp_path}/checkpoint", interval=None, buckets=4,
                              rejected_path=f"{tmp_path}/rejected")
    query.awaitTermination()
    seen = [p.observedMetrics for p in query.recentProgress]
    assert sum(m["read"].n for m in seen) == 2 and sum(m["unread"].n for m in seen) == 2
    assert rows(spark.read.parquet(f"{tmp_path}/rejected").select("seq", "value")) == [(2, "no rating"), (3, "1|6|NaN|11")]
    assert {r.user_id for r in latest_recs(spark, f"{tmp_path}/log").collect()} == {1, 2}


def test_a_message_delivered_again_changes_nothing(spark, tables, tmp_path):
    """In the same batch, in a later one, and long after it has been pushed out."""
    live = tables[2]
    third = len(live) // 3
    clean = _final(spark, _replay(spark, tables, str(tmp_path / "clean"), [live]))
    again = [live[:third] + live[:third:2], live[third // 2:2 * third], live[2 * third:] + live[::5]]
    assert _final(spark, _replay(spark, tables, str(tmp_path / "again"), again)) == clean


def test_a_running_stream_takes_up_what_comes(spark, tables, tmp_path):
    """On a trigger, with the feed growing while the query runs."""
    similar, rated, live = tables
    live = live[:120]
    whole = _final(spark, _replay(spark, tables, str(tmp_path / "whole"), [live]))

    def deliver(batch):
        lines = [(seq, f"{u}|{p}|{s}|{t}") for seq, u, p, s, t in batch]
        spark.createDataFrame(lines, "seq long, value string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")

    deliver(live[:60])
    query = start_recommender(read_rating_stream(spark, f"{tmp_path}/feed"), similar, rated, f"{tmp_path}/log",
                              f"{tmp_path}/checkpoint", interval="2 seconds", buckets=4, rejected_path=f"{tmp_path}/rejected")
    try:
        query.processAllAvailable()
        deliver(live[60:])
        query.processAllAvailable()
        assert query.isActive and sum(p.observedMetrics["read"].n for p in query.recentProgress if p.numInputRows) == len(live)
    finally:
        query.stop()
    assert _final(spark, f"{tmp_path}/log") == whole


def test_a_restart_goes_on_where_it_stopped(spark, tables, tmp_path):
    similar, rated, live = tables
    half = len(live) // 2
    whole = _final(spark, _replay(spark, tables, str(tmp_path / "whole"), [live[:half], live[half:]]))
    folder = str(tmp_path / "parts")
    for part, batch in enumerate((live[:half], live[half:])):
        messages = [(seq, f"{u}|{p}|{s}|{t}") for seq, u, p, s, t in batch]
        spark.createDataFrame(messages, "seq long, value string").coalesce(1).write.parquet(f"{folder}/feed/{part}")
        feed = read_rating_stream(spark, f"{folder}/feed/*", files_per_batch=1)
        start_recommender(feed, similar, rated, f"{folder}/log", f"{folder}/checkpoint", interval=None,
                          buckets=4).awaitTermination()
    assert _final(spark, f"{folder}/log") == whole


def test_a_batch_reads_the_lists_of_its_own_products(spark, tables):
    similar = tables[0]
    products = spark.createDataFrame([(3,), (17,)], "product_id int")
    part = lists_of(similar, products, SIMILAR_BUCKETS)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ IN \(\d+,\d+\)", plan)
    both = [df.where("product_id in (3, 17)") for df in (part, similar)]
    assert rows(both[0], "product_id", "rid", "r", "place") == rows(both[1], "product_id", "rid", "r", "place") != []


def test_what_is_rated_in_the_stream_is_not_recommended(spark, tables, tmp_path):
    """With cut lists and an index; in one batch, and in three out of order."""
    similar, rated, live = tables
    ratings = rated.select("user_id", "product_id")
    index = PairIndex.build(spark.createDataFrame(past(), "user_id int, product_id int"), str(tmp_path / "index"))
    lists = str(tmp_path / "similar")
    save_similar(similar.where("place <= 5").select("product_id", "rid", "r", "place"), lists)
    cut = spark.read.parquet(lists), rated, live
    shuffled = live[:]
    random.Random(4).shuffle(shuffled)
    settings = {"index": index, "depth": 5, "live_rated": True}
    one = _final(spark, _replay(spark, cut, str(tmp_path / "one"), [live], **settings))
    many = _final(spark, _replay(spark, cut, str(tmp_path / "many"), [shuffled[:80], shuffled[80:160], shuffled[160:]], **settings))
    assert one == many
    known = {(r.user_id, r.product_id) for r in ratings.collect()} | {(u, p) for _, u, p, *_ in live}
    assert all((u, p) not in known for u, recs in one.items() for p, _ in recs) and any(one.values())
    store = rec_store(spark, str(tmp_path / "store"), most_folders=1)
    parts = [live[i:i + 81] for i in range(0, len(live), 81)]
    for n, batch in enumerate(parts):
        messages = [(seq, f"{u}|{p}|{s}|{t}") for seq, u, p, s, t in batch]
        spark.createDataFrame(messages, "seq long, value string").coalesce(1).write.parquet(f"{tmp_path}/stored/feed/{n}")
    feed = read_rating_stream(spark, f"{tmp_path}/stored/feed/*", files_per_batch=1)
    start_recommender(feed, cut[0], rated, store, f"{tmp_path}/stored/checkpoint", interval=None, buckets=4,
                      **settings).awaitTermination()
    kept = stored_recs(store).collect()
    assert {r.user_id: [(e.product_id, round(e.score, 9)) for e in r.recs] for r in kept} == one
    assert len(store.folders()) == 2 and len(store.versions()) == 3 and {r.batch_id for r in kept} <= set(range(len(parts)))
    frozen = _final(spark, _replay(spark, cut, str(tmp_path / "frozen"), [live], index=index, depth=5))
    assert frozen == _final(spark, _replay(spark, tables, str(tmp_path / "whole"), [live]))
    assert any((u, p) in known for u, recs in frozen.items() for p, _ in recs)
