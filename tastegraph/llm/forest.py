"""Near duplicates among vectors, through a forest of random projection trees.

Equal vectors are folded first. In every tree a vector descends by random
splits: each node draws one of the tree's random directions and a threshold
around the middle of how a sample projects on it, and a vector within `spill`
of the threshold goes both ways. Depth follows from the number of vectors, so
leaves stay small; a large leaf is cut into parts and every pair of parts
compared in a task of its own. Within leaves all cosines are computed in double
precision. A pair that meets in several leaves counts in the least of them,
which both sides know from their lists of leaves, so links are counted
without ever being listed; for the components, a chain stands for the links
found in one task. Vectors travel in rounds, some leaves at a time.

The directions need nothing from the data, the thresholds a sample of at most
`SAMPLE` vectors; every vector is indexed. Depth grows with the number of
vectors, leaves do not, and the deeper a tree, the more pairs it parts: trees
are added until `RECALL` of modelled pairs meet in some leaf, each a sampled
vector and one at the least cosine from it, turned towards another of the
sample. Without a split one tree compares every pair.

Defined results: vectors that are null, zero or hold null or non-finite
components link with nothing and are their own component; so are vectors
without another of their length. Repeated rows are linked like equal vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from tastegraph.llm.components import components
from tastegraph.llm.simhash import fold
from tastegraph.llm.tables import map_batches, numbered, sorted_groups, written

#: Trees where anything is split, at least and at most.
TREES = 8
MOST_TREES = 256
#: Share of the modelled pairs at the least cosine that meet in some leaf.
RECALL = 0.999
LEAF_ROWS = 1024
#: Rows of a leaf compared in one task at most, twice that for two parts.
PART_ROWS = 1024
#: A vector travels once for each of its leaves, some leaves at a time: bytes sent
#: in one round, or this many times those of the vectors, where that is more.
ROUND_BYTES = 1 << 30
ROUND_SHARE = 4
#: Directions of a tree, and the sample that shows how vectors project on them.
DIRECTIONS = 32
SAMPLE = 4096
#: A vector this near a threshold goes both ways, in units of the spread of a
#: random projection of a unit vector.
SPILL = 0.25
#: Thresholds are drawn from this middle part of the sample's projections.
MIDDLE = (0.35, 0.65)
SEED = 42
STEPS = 16


def _matrix(vectors: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _units(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _directions(size: int, tree: int) -> np.ndarray:
    """For vectors of `size`: a column for each direction of a tree."""
    found = np.random.default_rng([SEED, size, tree]).standard_normal((size, DIRECTIONS))
    return found / np.linalg.norm(found, axis=0)


def _drawn(path: np.ndarray) -> np.ndarray:
    """Random bits of a node."""
    mixed = path.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _descend(units: np.ndarray, tree: int, depth: int, cuts: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """For unit vectors of one length: rows and their leaves in a tree."""
    size = units.shape[1]
    projected = units @ _directions(size, tree)
    margin = spill / np.sqrt(size)
    row = np.arange(len(units))
    path = np.full(len(units), (tree << 48) | 1, dtype=np.int64)
    for _ in range(depth):
        bits = _drawn(path)
        column = (bits % np.uint64(DIRECTIONS)).astype(np.int64)
        away = projected[row, column] - cuts[column, (bits >> np.uint64(40)).astype(np.int64) % STEPS]
        right, left = away >= -margin, away < margin
        following = (path & ((1 << 48) - 1)) << 1 | (tree << 48)
        row = np.concatenate([row[left], row[right]])
        path = np.concatenate([following[left], following[right] | 1])
    return row, path


def leaves(units: np.ndarray, trees: int, depth: int, known: dict[int, list[np.ndarray]], spill: float) -> list[list[int]]:
    """For unit vectors of one length: the leaves of each, in order. A leaf is
    the tree's number and the path from its root."""
    cuts = known.get(units.shape[1], [np.zeros((DIRECTIONS, STEPS))] * trees)
    row, path = map(np.concatenate, zip(*(_descend(units, tree, depth, cuts[tree], spill) for tree in range(trees))))
    order = np.lexsort((path, row))
    cut = np.searchsorted(row[order], np.arange(1, len(units)))
    return [p.tolist() for p in np.split(path[order], cut)]


def _partners(units: np.ndarray, cosine: float) -> np.ndarray:
    """For each unit vector one at this cosine, turned towards another of them
    or, where all are alike, anywhere."""
    chance = np.random.default_rng([SEED, len(units)])
    aside = np.zeros_like(units)
    for other in (np.roll(units, 1, axis=0), chance.standard_normal(units.shape)):
        other = other - (other * units).sum(axis=1, keepdims=True) * units
        length = np.linalg.norm(other, axis=1, keepdims=True)
        aside = np.where(~aside.any(axis=1, keepdims=True) & (length > 1e-6), other / np.maximum(length, 1e-6), aside)
    return cosine * units + np.sqrt(max(0.0, 1 - cosine * cosine)) * aside


def _meet(both: np.ndarray, tree: int, depth: int, cuts: np.ndarray, spill: float) -> np.ndarray:
    """Which vectors of the first half share a leaf of the tree with their
    counterparts in the second."""
    pairs = len(both) // 2
    row, path = _descend(both, tree, depth, cuts, spill)
    pair = row % pairs
    order = np.lexsort((path, pair))
    pair, path = pair[order], path[order]
    met = np.zeros(pairs, dtype=bool)
    met[pair[1:][(pair[1:] == pair[:-1]) & (path[1:] == path[:-1])]] = True
    return met


def grow(sample: list, least: float, depth: int, trees: int = TREES, spill: float = SPILL,
         recall: float = RECALL) -> tuple[int, dict[int, list[np.ndarray]]]:
    """How many trees it takes, `trees` or more where anything is split, and for
    each length of vectors in the sample a table for each tree: a row for each
    direction, of `STEPS` thresholds in the sample's middle."""
    by_size: dict[int, list] = {}
    for vector in sample:
        by_size.setdefault(len(vector), []).append(vector)
    units = {n: _units(np.array(v)) for n, v in by_size.items()}
    both = {n: np.concatenate([u, _partners(u, least)]) for n, u in units.items() if n > 1}
    met = {n: np.zeros(len(b) // 2, dtype=bool) for n, b in both.items()}
    known: dict[int, list[np.ndarray]] = {n: [] for n in units}
    for tree in range(MOST_TREES):
        for n, own in units.items():
            known[n].append(np.quantile(own @ _directions(n, tree), np.linspace(*MIDDLE, STEPS), axis=0).T)
        for n, pairs in both.items():
            met[n] |= _meet(pairs, tree, depth, known[n][tree], spill)
        if tree + 1 >= (trees if depth else 1) and all(m.mean() >= recall for m in met.values()):
            return tree + 1, known
    raise ValueError(f"{MOST_TREES} trees with a spill of {spill} don't find {recall} of the pairs at {least}")


def _first_meeting(lists: list[list[int]], leaf: int) -> np.ndarray:
    """Which pairs of rows share no leaf before this one."""
    found = [(i, k) for i, row in enumerate(lists) for k in row if k < leaf]
    if not found:
        return np.ones((len(lists), len(lists)), dtype=bool)
    row, key = np.array(found).T
    _, column = np.unique(key, return_inverse=True)
    shared = np.zeros((len(lists), len(lists)), dtype=np.float32)
    for start in range(0, int(column.max()) + 1, 2048):
        here = (column >= start) & (column < start + 2048)
        member = np.zeros((len(lists), 2048), dtype=np.float32)
        member[row[here], column[here] - start] = 1
        shared += member @ member.T
    return shared == 0


def _compare(least: float):
    """Sorted (leaf, size, low, high, part, node, copies, unit, leaves) to
    (node, other, links): the smallest node it is chained to, and how many rows
    it meets here first."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, 4):
            keys = [table.column(k).to_numpy() for k in range(4)]
            cuts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0), True])
            for start, stop in zip(cuts[:-1], cuts[1:]):
                group = table.slice(start, stop - start)
                part, node, copies = (group.column(k).to_numpy() for k in (4, 5, 6))
                units = _matrix(group.column(7), len(group))
                near = units @ units.T >= least
                np.fill_diagonal(near, False)
                if keys[2][start] != keys[3][start]:
                    near &= part[:, None] != part[None, :]
                some = np.flatnonzero(near.any(axis=1))
                if not len(some):
                    continue
                near = near[np.ix_(some, some)]
                node, copies = node[some], copies[some]
                lists = group.column(8).take(pa.array(some)).to_pylist()
                first = near & _first_meeting(lists, int(keys[0][start]))
                left, right = np.nonzero(np.triu(near))
                root = fold(len(some), left, right)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root]), pa.array((first @ copies.astype(np.float64)).astype(np.int64))],
                                                 names=["node", "other", "links"])
    return over


def _rounds(indexed: DataFrame, counts: DataFrame) -> list[tuple[int, int, int, int]]:
    """(round, share, rounds, shares): leaves are dealt to rounds, and the pairs of
    parts of a leaf to shares where one leaf alone is too much for a round."""
    own = 8 * F.size("unit") + 64
    bytes_, row = indexed.agg(F.coalesce(F.sum(own), F.lit(0)), F.coalesce(F.avg(own + 4 * F.size("leaves")), F.lit(0.0))).first()
    sent = F.col("count") * F.col("parts")
    total, most = counts.agg(F.coalesce(F.sum(sent), F.lit(0)), F.coalesce(F.max(sent), F.lit(0))).first()
    room = max(ROUND_BYTES, ROUND_SHARE * bytes_)
    rounds, shares = (max(1, int(-(-n * row // room))) for n in (total, most))
    rounds = max(1, -(-rounds // shares))
    return [(i, j, rounds, shares) for i in range(rounds) for j in range(shares)]


def near_vectors(vectors: DataFrame, least: float, id_col: str = "vec_id", vector_col: str = "embedding",
                 trees: int = TREES, leaf_rows: int = LEAF_ROWS, part_rows: int = PART_ROWS,
                 spill: float = SPILL, recall: float = RECALL) -> DataFrame:
    """One row per row of `vectors`: the id, `n_links` (other rows at a cosine
    of `least` or more that were found), `component_id` (the smallest id
    reachable) and `kept` (whether that is its own)."""
    values = F.col(vector_col).cast("array<double>")
    usable = (F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(values, lambda x: x != 0))
    rows = numbered(vectors.select(F.col(id_col).alias("id"), F.when(usable, values).alias("vector")), "vectors")
    classes = numbered(rows.where("vector is not null").groupBy("vector").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")), "classes", "node")
    count = classes.count()
    # each level leaves (1 + spilled) / 2 of a node's vectors in each half
    spilled = 2 * spill / np.sqrt(2 * np.pi)
    depth = max(0, int(np.ceil(np.log(max(count, 1) / leaf_rows) / np.log(2 / (1 + spilled)))))
    sample = classes.orderBy(F.xxhash64("vector"), "node").limit(SAMPLE).select("vector").collect()
    trees, known = grow([r["vector"] for r in sample], least, depth, trees, spill, recall)

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = pa.compute.list_value_length(batch.column(2)).to_numpy()
        out: list = [None] * len(sizes)
        units: list = [None] * len(sizes)
        for size in np.unique(sizes):
            here = np.flatnonzero(sizes == size)
            found = _units(_matrix(batch.column(2).take(pa.array(here)), len(here)))
            for i, unit, own in zip(here, found, leaves(found, trees, depth, known, spill)):
                units[i], out[i] = unit, own
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(units, pa.list_(pa.float64())), pa.array(out, pa.list_(pa.int64()))],
            names=["node", "copies", "unit", "leaves"])

    indexed = written(map_batches(classes.select("node", "copies", "vector"), index,
                                  "node long, copies long, unit array<double>, leaves array<long>"), "indexed")
    counts = written(indexed.select(F.explode("leaves").alias("leaf"), F.size("unit").alias("size"))
                     .groupBy("leaf", "size").count().where("count > 1").withColumn("parts", F.ceil(F.col("count") / part_rows)), "leaf-counts")
    keys = ["leaf", "size", "low", "high"]
    tables = []
    for round_, part, rounds, shares in _rounds(indexed, counts):
        # a vector travels once for each of its leaves of the round, and its leaves before that with it
        here = F.transform("leaves", lambda leaf, before: F.struct(before.alias("before"), leaf.alias("leaf")))
        if rounds > 1:
            here = F.filter(here, lambda at: F.pmod(F.xxhash64(at["leaf"]), F.lit(rounds)) == round_)
        placed = (indexed.select(F.explode(here).alias("at"), F.size("unit").alias("size"), "node", "copies", "unit", "leaves")
                  .select("at.leaf", "size", "node", "copies", "unit", F.slice("leaves", F.lit(1), F.col("at.before")).alias("leaves")))
        spread = (placed.join(counts.where(F.pmod(F.xxhash64("leaf"), F.lit(rounds)) == round_), ["leaf", "size"])
                  .withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
                  .select("leaf", "size", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                          "part", "node", "copies", "unit", "leaves"))
        if shares > 1:
            spread = spread.where(F.pmod(F.col("low") + F.col("high"), F.lit(shares)) == part)
        tables.append(written(spread.repartition(*keys).sortWithinPartitions(*keys, "part").mapInArrow(
            _compare(least), "node long, other long, links long"), "found"))
    found = reduce(DataFrame.unionByName, tables)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "other")
    joined = classes.select("node", "vector", "first", "copies").join(links, "node", "left").join(roots, "node", "left")
    graded = written(joined.select("vector", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                   F.coalesce("root", "node").alias("root")), "graded")
    least_id = written(graded.groupBy("root").agg(F.min("first").alias("component_id")), "least-ids")
    result = written(graded.join(least_id, "root").drop("root", "first"), "classes-done")
    own = F.col("vector").isNull()
    done = rows.join(result, "vector", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(own, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return done.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
