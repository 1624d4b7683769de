"""Ranked search against scores worked out one by one."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, EDGES
from tastegraph.llm import ranked

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERMS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _brute(docs, items, k=20):
    """{item row: [(rank, doc_id, score)]}"""
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    documents, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 75 + 25 * c.total() * documents // length
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in _terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    """Words of very uneven frequency; a third of the rows are copies."""
    chance = random.Random(3)
    words = [f"w{n}" for n in range(300)] + ["été", "漢字", "Ab1"]
    weights = [1 / (n + 1) for n in range(len(words))]
    texts = [" ".join(chance.choices(words, weights, k=chance.choice((1, 5, 30, 200)))) for _ in range(400)]
    texts += [texts[7]] * 150 + [None, "", "?!"] + [texts[9] + " w250 w251 w252"] * 3
    items = [" ".join(chance.choices(words, k=12)) for _ in range(25)] + [texts[9], texts[7], "nothing here", None, "", "w0 w0 w1"]
    return list(enumerate(texts)), list(enumerate(items))


@pytest.mark.parametrize("settings", [{}, {"CHUNK_ENTRIES": 200, "FOCUS": 2}, {"BLOCK_TERMS": 60}, {"FOCUS": 0}])
def test_equals_brute_force(spark, monkeypatch, corpus, settings):
    for name, value in settings.items():
        monkeypatch.setattr(ranked, name, value)
    docs, items = corpus
    found = ranked.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                                 spark.createDataFrame(items, "item_id long, text string"))
    assert _found(found) == _brute(docs, items)


def test_bounds_prune(corpus):
    """Of a chunk of short vectors, none is looked at once a better score is known."""
    import numpy as np
    import pyarrow as pa
    weights = np.array([5000, 4000, 10], dtype=np.int64)
    chunk = ranked._Chunk(pa.array([1, 2]), np.array([0, 1, 2]), np.array([0, 2]), np.array([900, 100]),
                          np.sqrt(np.array([5000 * 900. ** 2, 10 * 100. ** 2])), weights)
    looked_at = []
    query = ranked._Query(np.array([0, 2]), np.array([1, 1]), weights, 4_000_000)
    query.add = lambda scores, ids, k: looked_at.append((scores.tolist(), ids.to_pylist()))
    chunk.search(query, np.zeros(3, dtype=np.int64), 5)
    assert looked_at == [([4_500_000], [1])]
    query.least = 4_600_000
    chunk.search(query, np.zeros(3, dtype=np.int64), 5)
    assert len(looked_at) == 1


def test_edges(spark, edges, clashing, no_docs):
    items = [(1, "one text"), (1, "one text"), (None, "漢字かな word1"), (3, None), (4, "é" * 50_000), (5, "  ")]
    queries = spark.createDataFrame(items, "item_id long, text string")
    expected = _brute([(r[0], r[1]) for r in EDGES], items)
    assert _found(ranked.ranked_search(edges, queries)) == expected
    extra = queries.select("*", *(F.lit("x").alias(c) for c in CLASHING))
    assert _found(ranked.ranked_search(clashing, extra)) == expected
    assert _found(ranked.ranked_search(no_docs, queries)) == [] == _found(ranked.ranked_search(edges, queries.limit(0)))


def test_ids_may_be_text(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "X")], "item_id string, text string")
    found = ranked.ranked_search(docs, items, k=3).sort("rank").collect()
    assert [r.doc_id for r in found] == ["a", "b", None] and len({r.score for r in found}) == 1
