import pytest

from tests.conftest import rows
from tastegraph.operators.online import (rank_similar, rec_lists, stream_priority_score, top_similar_unrated,
                                         user_recent_ratings)


@pytest.fixture
def similar(spark):
    def make(triples):
        return rank_similar(spark.createDataFrame(triples, "product_id int, rid int, r double"))
    return make


def test_recent_ratings_are_the_newest_twenty(spark):
    events = [(i, 1, i, 5.0, 100 + i // 2) for i in range(25)] + [(99, 2, 7, 1.0, 5)]
    table = spark.createDataFrame(events, "event_id long, user_id int, product_id int, score double, ts long")
    found = user_recent_ratings(table)
    assert rows(found.where("user_id = 1"), "rank", "event_id") == [(n, 25 - n) for n in range(1, 21)]
    assert rows(found.where("user_id = 2"), "rank", "product_id") == [(1, 7)]


def test_candidates_skip_rated_products_and_reach_past_them(ratings, similar):
    sims = similar([(1, b, 1.0 / b) for b in range(2, 60)] + [(2, 3, 0.5), (2, 4, 0.5)])
    rated = ratings([(10, b) for b in range(2, 30)] + [(10, 2), (11, 99)])
    found = top_similar_unrated(ratings([(10, 1), (10, 1), (11, 2), (11, 777)]), sims, rated, 3)
    assert rows(found, "user_id", "product_id", "rid", "rank") == [
        (10, 1, 30, 1), (10, 1, 31, 2), (10, 1, 32, 3), (11, 2, 3, 1), (11, 2, 4, 2)]


@pytest.mark.parametrize("recent,expected", [
    ([(0.5, 4), (0.4, 2)], 1.4),
    ([(0.5, 5), (0.5, 4), (0.5, 2)], 2.833333),
    ([(0.5, 3), (0.5, 3), (0.5, 3), (0.5, 3)], 1.5 - 2),
    ([(-0.5, 3), (0.0, 5)], None),
    ([], None),
])
def test_priority_by_hand(spark, ratings, recent, expected):
    sims = spark.createDataFrame([(50, n, float(s)) for n, (s, _) in enumerate(recent)],
                                 "product_id int, rid int, r double")
    newest = ratings([(1, n, score) for n, (_, score) in enumerate(recent)] + [(1, 77, 5)])
    candidates = spark.createDataFrame([(1, 50)], "user_id int, rid int")
    found = rows(stream_priority_score(candidates, newest, sims))
    if expected is None:
        assert found == []
    else:
        assert found == [(1, 50, pytest.approx(expected, abs=1e-6))]


def test_similarity_is_looked_up_from_the_candidate(spark, ratings):
    sims = spark.createDataFrame([(50, 1, 0.5), (1, 60, 0.9)], "product_id int, rid int, r double")
    candidates = spark.createDataFrame([(1, 50), (1, 60)], "user_id int, rid int")
    assert rows(stream_priority_score(candidates, ratings([(1, 1, 4)]), sims)) == [(1, 50, 2.0)]


def test_lists_are_ordered_and_users_without_any_stay(spark):
    scores = spark.createDataFrame([(1, 7, 0.5), (1, 8, 2.0), (1, 6, 0.5)], "user_id int, product_id int, score double")
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    lists = {r.user_id: [e.product_id for e in r.recs] for r in rec_lists(scores, users).collect()}
    assert lists == {1: [8, 6, 7], 2: []}
