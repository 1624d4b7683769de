"""Highest dot products of vectors with few components against all pairs."""

import numpy as np
import pytest

from tests.conftest import rows
from tastegraph.operators import box_blocks
from tastegraph.operators.kernels import rounded
from tastegraph.operators.norm_blocks import best_dots


def _table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "id long, vector array<double>")


def _all_pairs(left, right, k, decimals, ids=None):
    """By definition; `ids` are those of the right vectors."""
    ids, found = np.arange(len(right)) if ids is None else ids, []
    for i, u in enumerate(left):
        with np.errstate(over="ignore", invalid="ignore"):
            exact = u[0] * right[:, 0]
            for j in range(1, len(u)):
                exact = exact + u[j] * right[:, j]
            score = rounded(exact, decimals)
        some = np.flatnonzero(exact > 0)
        best = some[np.lexsort((ids[some], -score[some]))][:k]
        found += [(i, int(ids[b]), float(score[b]), n) for n, b in enumerate(best, 1)]
    return sorted(found)


def _unit(random, n, width):
    vectors = random.normal(size=(n, width))
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


@pytest.mark.parametrize("cell_pairs", [box_blocks.CELL_PAIRS, 3000])
def test_vectors_of_one_length_meet_few_blocks(spark, monkeypatch, cell_pairs):
    monkeypatch.setattr(box_blocks, "GROUP_ROWS", 8)
    monkeypatch.setattr(box_blocks, "CELL_PAIRS", cell_pairs)       # the smaller one: bundles in several slices
    random = np.random.default_rng(3)
    left, right = _unit(random, 600, 3), _unit(random, 3000, 3)
    right[1000:1600] = right[7]     # copies
    left[5], right[9] = 0, 0
    met = []
    found = best_dots(_table(spark, left), _table(spark, right), 6, 6, block_bytes=24 * 30, rounds=met)
    assert rows(found) == _all_pairs(left, right, 6, 6)
    assert sum(pairs for *_, pairs in met) < 600 * 100 * 0.25       # by their lengths they meet all 100 blocks


def test_of_equal_scores_only_blocks_with_small_ids_are_met(spark, monkeypatch):
    monkeypatch.setattr(box_blocks, "GROUP_ROWS", 8)
    random = np.random.default_rng(4)
    left = np.column_stack([random.random(200) + 1, np.zeros(200)])
    right, ids = np.column_stack([np.full(2000, 3.0), random.random(2000)]), random.permutation(2000) * 3
    right[:1000, 1] = 0.5
    met = []
    found = best_dots(_table(spark, left), _table(spark, right, ids), 5, 6, block_bytes=16 * 20, rounds=met)
    assert rows(found) == _all_pairs(left, right, 5, 6, ids)
    assert sum(pairs for *_, pairs in met) < 200 * 100 * 0.25


@pytest.mark.parametrize("width,k,decimals", [(1, 3, None), (2, 20, 6), (3, 4, 1), (4, 9, None)])
def test_odd_values_are_those_of_all_pairs(spark, monkeypatch, width, k, decimals):
    monkeypatch.setattr(box_blocks, "GROUP_ROWS", 5)
    random = np.random.default_rng(width)
    left, right = random.normal(size=(80, width)), random.normal(size=(400, width)) * np.exp(3 * random.normal(size=(400, 1)))
    left[:10] = np.round(left[:10])
    right[:100] = np.round(right[:100], 1)
    left[11], left[12], left[13, 0], left[14] = -1e200, 1e-200, np.inf, left[15]
    right[200], right[201], right[202, 0], right[203, -1], right[204] = 1e200, 1e-200, np.inf, -np.inf, 0
    found = best_dots(_table(spark, left), _table(spark, right), k, decimals, block_bytes=8 * width * 10)
    assert rows(found) == _all_pairs(left, right, k, decimals)


def test_left_vectors_of_one_id_share_a_list(spark, monkeypatch):
    monkeypatch.setattr(box_blocks, "GROUP_ROWS", 1)
    left, right = np.array([[1.0, 0], [0, 1]]), np.array([[1.0, 0], [2, 0], [0, 3], [0, 4]])
    found = best_dots(_table(spark, left, [7, 7]), _table(spark, right), 3, 6, block_bytes=16)
    assert rows(found) == [(7, 1, 2.0, 3), (7, 2, 3.0, 2), (7, 3, 4.0, 1)]
