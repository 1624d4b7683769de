import math
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import HashingTF

from tests.conftest import rows
from tastegraph.operators.content import content_sim_lists, content_sims, content_sims_hashed


@pytest.fixture
def products(spark):
    def make(tags):
        return spark.createDataFrame([(i, "n", "c", "u", t) for i, t in tags.items()],
                                     "product_id int, name string, categories string, image_url string, tags string")
    return make


def _lists(tags, k, feature=lambda word: word, keep_empty=False, fill=False):
    """TF-IDF cosine by definition."""
    bags = {i: Counter(feature(w) for w in t.replace("|", " ").lower().split(" ") if w or keep_empty)
            for i, t in tags.items()}
    df = Counter(w for bag in bags.values() for w in bag)
    vector = {i: {w: n * math.log((len(tags) + 1) / (df[w] + 1)) for w, n in bag.items()} for i, bag in bags.items()}
    length = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vector.items()}
    result = []
    for a in tags:
        near = []
        for b in tags:
            if a == b or not length[a] or not length[b]:
                continue
            dot = sum(x * vector[b].get(w, 0.0) for w, x in vector[a].items())
            if dot > 0 or fill:
                near.append((-round(dot / (length[a] * length[b]), 6), b))
        result += [(a, b, -r, rank) for rank, (r, b) in enumerate(sorted(near)[:k], 1)]
    return sorted(result)


WORDS = "red blue green steel wood glass fast slow big small round flat".split()


def _catalogue(n=120):
    """Every third product is a copy of one another, some share words, some none."""
    tags = {}
    for i in range(n):
        if i % 3 == 0:
            tags[i] = "common|red|Steel|fast"
        else:
            tags[i] = "|".join(["common"] + [WORDS[(i * step) % 12] for step in (1, 5, 7)])
    tags[n] = "common"                  # its only word weighs nothing
    tags[n + 1] = "common|unique"
    tags[n + 2] = "fast|common|red|steel"    # the copied bag in another order
    tags[n + 3] = "red|red|common"
    return {i: t if "common" in t else t + "|common" for i, t in tags.items()}


def _same(found, expected):
    assert [(a, b, n) for a, b, _, n in found] == [(a, b, n) for a, b, _, n in expected]
    assert [r for _, _, r, _ in found] == pytest.approx([r for _, _, r, _ in expected], abs=2e-6)


def test_lists_equal_the_definition(products):
    tags = _catalogue()
    found = rows(content_sims(products(tags), 5))
    _same(found, _lists(tags, 5))
    assert not [r for r in found if 120 in r[:2]]


def test_large_groups_of_copies_are_joined_as_any(products):
    tags = _catalogue() | {n: "fast|steel|red|common" for n in range(200, 400)}
    _same(rows(content_sims(products(tags), 5)), _lists(tags, 5))


def test_products_alone_of_their_kind_keep_an_empty_list(products):
    tags = {1: "a|b", 2: "a|c", 3: "z", 4: "", 5: "a|b"}
    nested = {r.product_id: [e.rid for e in r.recs] for r in content_sim_lists(products(tags), 2).collect()}
    assert nested == {1: [5, 2], 2: [1, 5], 3: [], 4: [], 5: [1, 2]}


def test_hashed_lists_equal_the_definition_on_buckets(spark, products):
    hashing = HashingTF(numFeatures=7)
    tags = {i: t for i, t in enumerate(["a|b", "b|c", "c d", "E|f", "f", "g|h|i", "a|b", "x", "", "a||b", "q|r|s"])}
    found = rows(content_sims_hashed(products(tags), 3, buckets=7))
    _same(found, _lists(tags, 3, feature=hashing.indexOf, keep_empty=True, fill=True))


def test_hashed_lists_of_a_larger_catalogue_are_full(products):
    tags = _catalogue()
    found = rows(content_sims_hashed(products(tags), 5))
    hashing = HashingTF(numFeatures=189)
    _same(found, _lists(tags, 5, feature=hashing.indexOf, keep_empty=True, fill=True))
    per_product = Counter(a for a, *_ in found)
    assert set(per_product.values()) == {5}


def test_similarities_that_round_to_zero_rank_by_id(products):
    """A word nearly all products have weighs next to nothing."""
    tags = {i: "|".join(["common"] * (i > 0) + [f"own{i}x{n}" for n in range(4)]) for i in range(300)}
    hashing = HashingTF(numFeatures=1 << 16)
    found = rows(content_sims_hashed(products(tags), 5, buckets=1 << 16))
    _same(found, _lists(tags, 5, feature=hashing.indexOf, keep_empty=True, fill=True))
    assert [b for a, b, *_ in sorted(found, key=lambda r: (r[0], r[3])) if a == 50] == [0, 1, 2, 3, 4]


def test_products_that_all_are_alike_have_no_lists(products):
    for tags in ({7: "a|b"}, {1: "a|b", 2: "b|a", 3: "a|b"}):
        assert rows(content_sims_hashed(products(tags), 3)) == rows(content_sims(products(tags), 3)) == []
