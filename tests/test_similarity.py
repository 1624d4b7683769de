"""The pair operators against plain arithmetic, also where hot keys are split."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tastegraph.operators import sparse_pairs
from tastegraph.operators.dense_pairs import best_matches
from tastegraph.operators.norm_blocks import best_dots
from tastegraph.operators.item_cf import item_cf_lists, item_cf_sims


def _co_ratings(table):
    """All pairs by definition: n_ab / sqrt(n_a * n_b)."""
    by_user, count = defaultdict(Counter), Counter()
    for user, product, *_ in table:
        by_user[user][product] += 1
        count[product] += 1
    pair = Counter()
    for products in by_user.values():
        for a in products:
            for b in products:
                if a != b:
                    pair[a, b] += products[a] * products[b]
    return {(a, b): n / math.sqrt(count[a] * count[b]) for (a, b), n in pair.items()}


def _top(sims, k):
    lists = defaultdict(list)
    for (a, b), r in sims.items():
        lists[a].append((-r, b))
    return sorted((a, b, -r, rank) for a, near in lists.items()
                  for rank, (r, b) in enumerate(sorted(near)[:k], 1))


@pytest.fixture(scope="module")
def skewed():
    """Ratings with one user holding a third of the rows, one product rated by
    most users, repeats, and users of a single product."""
    random = np.random.default_rng(7)
    table = [(u, int(p)) for u in range(150) for p in random.integers(0, 300, 8)]
    table += [(1000, p) for p in range(300)] + [(1000, int(p)) for p in random.integers(0, 300, 300)]
    table += [(u, 5) for u in range(0, 150, 2)] + [(2000 + p, p) for p in range(20)]
    return table


def test_known_values(ratings):
    table = ratings([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 9)])
    found = rows(item_cf_sims(table))
    assert [(a, b, rank) for a, b, _, rank in found] == [(1, 2, 1), (2, 1, 1)]
    assert found[0][2] == pytest.approx(0.816497, abs=1e-6)
    nested = {r.product_id: [tuple(e) for e in r.recs] for r in item_cf_lists(table).collect()}
    assert nested[9] == [] and [b for b, _ in nested[1]] == [2]


def test_top_lists_equal_the_definition(ratings, skewed):
    assert rows(item_cf_sims(ratings(skewed), 5)) == _top(_co_ratings(skewed), 5)


def test_all_pairs_equal_the_definition_and_are_symmetric(ratings, skewed):
    found = {(a, b): r for a, b, r in rows(item_cf_sims(ratings(skewed), None))}
    assert found == _co_ratings(skewed)
    assert all(found[b, a] == r for (a, b), r in found.items())


@pytest.mark.parametrize("cell_entries,block_items,chunk", [(500, 4096, 50), (500, 40, 10_000), (200_000, 20, 7)])
def test_split_cells_and_small_chunks_change_nothing(ratings, skewed, monkeypatch, cell_entries, block_items, chunk):
    monkeypatch.setattr(sparse_pairs, "CELL_ENTRIES", cell_entries)
    monkeypatch.setattr(sparse_pairs, "BLOCK_ITEMS", block_items)
    monkeypatch.setattr(sparse_pairs, "CHUNK_ENTRIES", chunk)
    monkeypatch.setattr(sparse_pairs, "CHUNK_PAIRS", 4 * chunk)
    assert rows(item_cf_sims(ratings(skewed), 5)) == _top(_co_ratings(skewed), 5)


def test_few_pairs_are_added_by_sorting(ratings):
    random = np.random.default_rng(3)
    table = [(u, int(p)) for u in range(200) for p in random.integers(0, 3000, 3)]
    assert rows(item_cf_sims(ratings(table), 3)) == _top(_co_ratings(table), 3)


def test_no_cross_join_and_one_sort_per_cell(ratings, skewed):
    plan = item_cf_sims(ratings(skewed))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan


def _vectors(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)],
                                 "id long, vector array<double>")


def _best(left, right, k, same):
    def unit(m):
        length = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, length, out=np.full_like(m, np.nan), where=length > 0)
    score = np.round(unit(left) @ unit(right).T, 6)
    result = []
    for i, row in enumerate(score):
        near = sorted((-r, j) for j, r in enumerate(row) if r > 0 and not (same and i == j))
        result += [(i, j, -r, rank) for rank, (r, j) in enumerate(near[:k], 1)]
    return sorted(result)


@pytest.mark.parametrize("block_bytes", [32 << 20, 2000])
def test_dense_matches_with_copies_and_zero_vectors(spark, monkeypatch, block_bytes):
    from tastegraph.operators import dense_pairs
    monkeypatch.setattr(dense_pairs, "BLOCK_BYTES", block_bytes)
    random = np.random.default_rng(11)
    matrix = random.normal(size=(200, 6))
    matrix[50:120] = matrix[3]      # a third are copies
    matrix[10] = 0
    table = _vectors(spark, matrix)
    found = rows(best_matches(table, table, 5, same=True, decimals=6))
    expected = _best(matrix, matrix, 5, True)
    assert [(a, b, n) for a, b, _, n in found] == [(a, b, n) for a, b, _, n in expected]
    assert np.allclose([r for _, _, r, _ in found], [r for _, _, r, _ in expected], atol=1e-9)


def test_dense_without_k_gives_every_positive_pair(spark):
    random = np.random.default_rng(2)
    left, right = random.normal(size=(30, 4)), random.normal(size=(40, 4))
    found = {(a, b) for a, b, _ in rows(best_matches(_vectors(spark, left), _vectors(spark, right), None, "dot"))}
    assert found == {(i, j) for i in range(30) for j in range(40) if left[i] @ right[j] > 0}


def test_dots_by_length_are_those_of_all_pairs(spark):
    random = np.random.default_rng(5)
    left, right = random.normal(size=(120, 6)), random.normal(size=(900, 6)) * np.exp(2 * random.normal(size=(900, 1)))
    right[100:400] = right[7]       # a third are copies, one length over several blocks
    left[3], right[11], right[12], left[5] = 0, 0, 1e-200, -1e200
    expected = best_matches(_vectors(spark, left), _vectors(spark, right), 7, "dot", decimals=6)
    rounds = []
    found = best_dots(_vectors(spark, left), _vectors(spark, right), 7, 6, block_bytes=6 * 8 * 30, rounds=rounds)
    assert rows(found) == rows(expected)
    assert [(first, n) for first, n, _ in rounds][:3] == [(0, 1), (1, 1), (2, 2)]
    assert sum(pairs for *_, pairs in rounds) < 119 * 30 * 0.6      # of 30 blocks for every vector but the zero one
    assert rows(best_dots(_vectors(spark, left), _vectors(spark, right), 7, 6)) == rows(expected)     # one block


def test_dots_by_length_of_few_short_or_no_vectors(spark):
    left, right = np.array([[1.0, 0], [0, 0], [-1, 0]]), np.array([[2.0, 0], [1, 1], [0.5, 0], [0, 3]])
    assert rows(best_dots(_vectors(spark, left), _vectors(spark, right), 5, block_bytes=16)) == [
        (0, 0, 2.0, 1), (0, 1, 1.0, 2), (0, 2, 0.5, 3)]      # fewer than 5: every block has been met
    none = _vectors(spark, left).where("id < 0")
    assert rows(best_dots(none, _vectors(spark, right), 5)) == rows(best_dots(_vectors(spark, left), none, 5)) == []
    odd = spark.createDataFrame([(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (None, [1.0, 1.0]), (4, [1.0, 1.0])],
                                "id long, vector array<double>")
    assert rows(best_dots(odd, odd, 5, block_bytes=16)) == [(4, 4, 2.0, 1)]
    with pytest.raises(ValueError, match="different lengths"):
        best_dots(odd, _vectors(spark, np.ones((2, 3))), 5)


def test_ratings_without_a_product_count_for_nothing(ratings):
    table = [(1, 1), (1, 2), (1, None), (2, 1), (2, None), (3, None)]
    assert rows(item_cf_sims(ratings(table))) == rows(item_cf_sims(ratings([r for r in table if r[1] is not None])))


def test_vectors_of_different_lengths_are_named(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0]), (3, [1.0, 0.0])],
                                    "id long, vector array<double>")
    with pytest.raises(ValueError, match="lengths"):
        best_matches(vectors, vectors, 2, same=True)


def test_vectors_that_cannot_be_compared_match_nothing(spark):
    good = [(i, [float(i), 1.0]) for i in range(5)]
    bad = [(10, None), (11, [float("nan"), 1.0]), (12, [None, 1.0]), (13, [0.0, 0.0]), (None, [1.0, 1.0])]
    schema = "id long, vector array<double>"
    both, only = spark.createDataFrame(good + bad, schema), spark.createDataFrame(good, schema)
    assert rows(best_matches(both, both, 3, same=True)) == rows(best_matches(only, only, 3, same=True))
    nothing = spark.createDataFrame([], schema)
    assert rows(best_matches(nothing, nothing, 3, same=True)) == []


def test_one_rounding_in_tasks_and_in_sql(spark):
    """Also at half a unit, where other ways to round differ."""
    import duckdb
    from tastegraph.functions import half_up
    from tastegraph.operators.kernels import rounded
    values = [(n + 0.5) / 1e6 for n in range(0, 1_000_000, 37)]
    in_tasks = rounded(np.array(values), 6).tolist()
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in frame.select(half_up(frame["x"], 6)).collect()] == in_tasks
    assert [r[0] for r in duckdb.execute("select floor(x * 1e6 + 0.5) / 1e6 from (select unnest($1) as x)", [values]).fetchall()] == in_tasks


def test_cells_of_many_vectors_share_tasks():
    from tastegraph.operators.dense_pairs import BLOCK_BYTES, PART_ROWS, TASKS_PER_CORE, _width
    cells = -(-10**9 // PART_ROWS) * -(-10**9 * 8 * 64 // BLOCK_BYTES)
    assert cells > 10**6 and _width(cells, 4000) == TASKS_PER_CORE * 4000


@pytest.mark.parametrize("chunk", [1024, 3])
def test_a_basket_is_sent_once_for_each_block_it_touches(ratings, monkeypatch, chunk):
    """Not once for each pair of blocks: entries sent stay below the square of the baskets."""
    monkeypatch.setattr(sparse_pairs, "BLOCK_ITEMS", 8)
    monkeypatch.setattr(sparse_pairs, "CHUNK_ENTRIES", chunk)
    sent = []
    routed = sparse_pairs._routed

    def counted(*given):
        found = routed(*given)
        sent.append(tuple(found.selectExpr("count(*)", "sum(size(items))").first()))
        return found

    monkeypatch.setattr(sparse_pairs, "_routed", counted)
    random = np.random.default_rng(5)
    table = [(u, int(p)) for u in range(100) for p in random.choice(2000, 6, replace=False)]
    assert rows(item_cf_sims(ratings(table), 5)) == _top(_co_ratings(table), 5)
    if chunk == 1024:
        assert sent[0][0] <= 100 * 6 and sent[0][1] <= 100 * 6 * 6


@pytest.mark.parametrize("cell_entries", [4_000_000, 300])
def test_baskets_are_sent_in_rounds_and_partial_sums_are_not_kept(ratings, skewed, monkeypatch, cell_entries):
    """Written sums are those of whole pairs, the k best of a cell, also where cells are split."""
    for name, value in (("BLOCK_ITEMS", 30), ("ROUND_ENTRIES", 1500), ("ROUND_SHARE", 0), ("CELL_ENTRIES", cell_entries)):
        monkeypatch.setattr(sparse_pairs, name, value)
    written, real = [], sparse_pairs.materialize

    def kept(df, name):
        table = real(df, name)
        if name == "pair-sums":
            written.append(table)
        return table

    monkeypatch.setattr(sparse_pairs, "materialize", kept)
    assert rows(item_cf_sims(ratings(skewed), 5)) == _top(_co_ratings(skewed), 5)
    assert len(written) > 3
    for table in written:
        assert table.columns == ["product_id", "rid", "dot", "left_norm", "right_norm"]
    pairs = [(r.product_id, r.rid) for table in written for r in table.collect()]
    assert len(pairs) == len(set(pairs)) < len(_co_ratings(skewed)) / 3


def test_cells_of_an_even_table_need_no_splits(spark):
    """900 thousand baskets of 40 out of 1.2 million items: more cells, not split ones."""
    sizes = spark.range(900).select(F.col("id").alias("key"), F.lit(40).alias("n"))
    sizes = sizes.crossJoin(spark.range(1000).select(F.lit(1))).select("key", "n")
    blocks, stripes = sparse_pairs._grid(sizes, 1_200_000)
    sent = 36e6 * (min(40, blocks) + min(40, stripes))
    assert (sent + 900e3 * 1600 / sparse_pairs.PAIRS_PER_ENTRY) / (blocks * stripes) < 0.6 * sparse_pairs.CELL_ENTRIES


def test_shuffle_files_go_once_a_table_is_written(spark):
    from tastegraph.workspace import SHUFFLE_CLEANUP, materialize
    seen = []

    class Table:
        sparkSession = spark
        schema = spark.range(1).schema

        class write:
            parquet = staticmethod(lambda path: (seen.append(spark.conf.get(SHUFFLE_CLEANUP)), spark.range(1).write.parquet(path)))

    assert materialize(Table, "written").count() == 1
    assert seen == ["true"] and spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"


def test_a_task_has_a_bounded_number_of_scores(spark, monkeypatch):
    from tastegraph.operators import dense_pairs
    monkeypatch.setattr(dense_pairs, "CELL_PAIRS", 500)
    matrix = np.random.default_rng(12).normal(size=(200, 6))
    cells = []
    monkeypatch.setattr(dense_pairs, "_width", lambda n, parallelism: cells.append(n) or 4)
    table = _vectors(spark, matrix)
    found = rows(best_matches(table, table, 5, same=True, decimals=6))
    assert cells == [200 * 200 // 500]
    assert [(a, b, n) for a, b, _, n in found] == [(a, b, n) for a, b, _, n in _best(matrix, matrix, 5, True)]


def test_every_task_has_as_many_cells(spark):
    """Cells dealt by a hash would leave some tasks without one."""
    from tastegraph.operators.dense_pairs import matched
    parts, blocks = 4, 2
    cells = spark.createDataFrame([(p, b, side, 10 * p + side, [1.0]) for p in range(parts) for b in range(blocks) for side in (0, 1)],
                                  "part int, block int, side int, id long, vector array<double>")
    found = matched(cells, parts, blocks, 1, "dot")
    per_task = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert sorted(r["count"] for r in per_task) == [1] * (parts * blocks)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
