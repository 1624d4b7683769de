"""The largest dot products of vectors with few components, without meeting all pairs.

Right vectors lie in compact blocks and left vectors in compact groups. Both are
cut by a tree that halves the component that is widest, as a sample of rows shows
it, and the ids where vectors are equal. Each group's centre is compared with all
right vectors; its k best are the group's leaders. A block in which no vector can
come before one of the leaders, for any left vector within the group's bounds, is
left out: either its scores are lower, or none is higher and its ids are greater.
The other blocks are sent to the bundles of groups that need them. There each left
vector begins with the scores of the leaders and meets a block only if the block's
bounds can still give one of its k best.

The sample and the leaders decide only what is left out safely; results are those
of all pairs. Scores are added up in order of components, in doubles. Sums and
products of doubles keep their order under rounding, so that bounds worked out the
same way hold to the last bit, and equal vectors have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.functions import top_per_group
from tastegraph.operators.dense_pairs import _width, CELL_PAIRS, PART_ROWS
from tastegraph.operators.kernels import TILE_SCORES, rounded
from tastegraph.workspace import materialize

GROUP_ROWS = 256            # left vectors of a group, while there are not too many groups
MOST_GROUPS = 1 << 12       # so many centres meet all right vectors
MOST_BLOCKS = 1 << 14       # beyond that, blocks grow
SAMPLE_ROWS = 24            # for each group or block, to cut the tree by
CENTRE_ROWS = 1 << 17       # right vectors that pass the centres at once
SENT = 4                    # right vectors sent to bundles, as a multiple of both tables
TILE_ROWS = 1 << 10         # left vectors that meet a block at once
OUT_ROWS = 1 << 17          # of the result, in one batch
NOISE = 1e-14               # more than a dot product of few doubles can be off, as a share of its terms

_LAST = np.iinfo("int64").max


def best_dots_in_boxes(left: DataFrame, right: DataFrame, k: int, decimals: int | None, block_bytes: int,
                       sizes: tuple[int, int, int], rounds: list[tuple[int, int, int]] | None) -> DataFrame:
    """`best_dots` for usable vectors, of which there are so many on both sides and
    of so many components, by `sizes`. `rounds` gets one round with all blocks."""
    n_left, n_right, width = sizes
    spark, parallelism = left.sparkSession, left.sparkSession.sparkContext.defaultParallelism
    if not n_left or not n_right or not width:
        return spark.createDataFrame([], "id long, rid long, r double, rank int")
    columns = F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")
    left, right = left.select(*columns), right.select(*columns)
    n_groups = min(MOST_GROUPS, max(1, n_left // GROUP_ROWS))
    n_blocks = min(MOST_BLOCKS, -(-n_right * 8 * width // block_bytes))
    left_points, right_points = _sample(left, n_left, n_groups, width), _sample(right, n_right, n_blocks, width)
    # A component counts by what it does to a score.
    laid = _laid(right, _tree(right_points, _most(np.abs(left_points)), n_blocks), "block")
    going = _laid(left, _tree(left_points, _most(right_points) - _least(right_points), n_groups), "group")

    blocks = _bounds(laid, "block", width)
    groups = _bounds(going, "group", width)
    with np.errstate(over="ignore", invalid="ignore"):
        centres = groups.low / 2 + groups.high / 2
    leaders = materialize(
        laid.join(F.broadcast(top_per_group(laid.mapInArrow(_led(groups.number, centres, k, decimals), "group int, id long, r double"),
                                            ["group"], [F.desc("r"), F.asc("id")], k).select("group", "id")), "id"), "leaders")
    led = (leaders.groupBy("group").agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("vector")).alias("vectors")))
    wanted = materialize(
        going.select("group").distinct().join(led, "group", "left").repartition(parallelism * 2, "group")
        .mapInArrow(_wanted(groups, blocks, k, decimals), "group int, block int, pairs long"), "wanted-blocks")
    load = {r.group: (r.blocks, r.pairs) for r in wanted.groupBy("group").agg(
        F.count("*").alias("blocks"), F.sum("pairs").alias("pairs")).collect()}
    if rounds is not None:
        rounds.append((0, len(blocks.number), sum(groups.rows[np.searchsorted(groups.number, g)].item() * n for g, (n, _) in load.items())))

    # As many bundles as the right vectors to be sent allow, of neighbouring groups.
    pairs = sum(n for _, n in load.values())
    sent = max(1, pairs // n_left)      # to a bundle, about
    bundles = min(n_groups, max(parallelism, -(-n_left // PART_ROWS), SENT * (n_left + n_right) // sent))
    span = -(-n_groups // bundles)
    heavy: dict[int, int] = {}
    for group, (_, n) in load.items():
        heavy[group // span] = heavy.get(group // span, 0) + n
    slices = {bundle: -(-n // CELL_PAIRS) for bundle, n in heavy.items()}
    if not slices:
        return spark.createDataFrame([], "id long, rid long, r double, rank int")
    dealt = F.broadcast(spark.createDataFrame(list(slices.items()), "bundle int, slices int"))

    def bundle_of(df: DataFrame) -> DataFrame:
        return df.withColumn("bundle", F.floor(F.col("group") / span).cast("int")).join(dealt, "bundle")

    def cell(side: int, block: Column, slice_: Column) -> list[Column]:
        return [F.col("bundle"), slice_.alias("slice"), F.lit(side).alias("side"), block.alias("block"), F.col("id"), F.col("vector")]

    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    met = (bundle_of(wanted).select("bundle", "slices", "block").distinct().join(laid, "block"))
    cells = (bundle_of(going).select(*cell(0, F.lit(0), every))
             .unionByName(bundle_of(leaders).select("bundle", "slices", "id", "vector").distinct().select(*cell(1, F.lit(0), every)))
             .unionByName(met.select(*cell(2, F.col("block"), F.pmod(F.xxhash64("block"), F.col("slices")).cast("int")))))
    found = (cells.repartition(_width(sum(slices.values()), parallelism), "bundle", "slice")
             .sortWithinPartitions("bundle", "slice", "side", "block", "id")
             .groupBy("bundle", "slice").applyInArrow(_searched(k, decimals, width), "id long, rid long, r double, rank int"))
    if max(slices.values()) == 1 and going.select("id").distinct().count() == n_left:
        return found        # a left vector has been in one task only
    return top_per_group(found.drop("rank"), ["id"], [F.desc("r"), F.asc("rid")], k)


class _Tree(NamedTuple):
    column: np.ndarray      # that is split; -1 for a cell
    split: np.ndarray       # the greatest value of the low child
    child: np.ndarray       # low child, followed by the high one
    cell: np.ndarray        # numbered so that neighbours are near


class _Bounds(NamedTuple):
    number: np.ndarray
    rows: np.ndarray
    first: np.ndarray       # least id
    low: np.ndarray
    high: np.ndarray


def _most(points: np.ndarray) -> np.ndarray:
    return points[:, :-1].max(axis=0, initial=-np.inf)


def _least(points: np.ndarray) -> np.ndarray:
    return points[:, :-1].min(axis=0, initial=np.inf)


def _vectors(batch: pa.RecordBatch | pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    flat = batch.column("vector").combine_chunks() if isinstance(batch, pa.Table) else batch.column("vector")
    return batch.column("id").to_numpy(), flat.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _sample(vectors: DataFrame, n: int, cells: int, width: int) -> np.ndarray:
    """Components and ids, as doubles, of some rows for each cell, by a hash of their ids."""
    share = min(1.0, cells * SAMPLE_ROWS / n)
    ids, points = _vectors(vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).toArrow(), width)
    limit = np.finfo("float64").max / 4
    return np.column_stack([np.clip(points, -limit, limit), ids.astype("float64")])


def _tree(points: np.ndarray, weight: np.ndarray, cells: int) -> _Tree:
    column, split, child, cell, found = [-1], [0.0], [0], [0], 0

    def cut(node: int, points: np.ndarray, cells: int) -> None:
        nonlocal found
        at = None
        if cells > 1 and len(points) > 1:
            with np.errstate(over="ignore", invalid="ignore"):
                spread = np.nan_to_num((points[:, :-1].max(axis=0) - points[:, :-1].min(axis=0)) * weight)
            at = int(spread.argmax()) if spread.max() > 0 else points.shape[1] - 1
            values = np.sort(points[:, at])
            middle = values[(len(values) - 1) // 2]
            # All of one value go to the same side, the middle one to that which stays nearer to half.
            below, upto = np.searchsorted(values, middle), np.searchsorted(values, middle, "right")
            if upto == len(values) or (below and len(values) - 2 * below < 2 * upto - len(values)):
                upto = below
            if not upto:
                at = None
        if at is None:
            cell[node], found = found, found + 1
            return
        column[node], split[node], child[node] = at, values[upto - 1], len(column)
        for values_of in (column, split, child, cell):
            values_of.extend([-1, -1])
        low = points[:, at] <= split[node]
        share = min(max(round(cells * upto / len(values)), 1), cells - 1)
        cut(child[node], points[low], share)
        cut(child[node] + 1, points[~low], cells - share)

    cut(0, points, cells)
    return _Tree(np.array(column), np.array(split, "float64"), np.array(child), np.array(cell))


def _placed(points: np.ndarray, tree: _Tree) -> np.ndarray:
    """The cell of each point."""
    node, each = np.zeros(len(points), "int64"), np.arange(len(points))
    while (inner := tree.column[node] >= 0).any():
        node = np.where(inner, tree.child[node] + (points[each, tree.column[node]] > tree.split[node]), node)
    return tree.cell[node].astype("int32")


def _laid(vectors: DataFrame, tree: _Tree, name: str) -> DataFrame:
    """The vectors with the numbers of their cells, written."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, points = _vectors(batch, -1)
                yield batch.append_column(name, pa.array(_placed(np.column_stack([points, ids.astype("float64")]), tree)))

    return materialize(vectors.mapInArrow(place, f"id long, vector array<double>, {name} int"), f"laid-by-{name}")


def _bounds(laid: DataFrame, name: str, width: int) -> _Bounds:
    """Of each cell, in order of its number: rows, least id and box."""
    found = laid.groupBy(name).agg(
        F.count("*").alias("rows"), F.min("id").alias("first"),
        *(f(F.col("vector")[j]).alias(f"{side}{j}") for side, f in (("low", F.min), ("high", F.max)) for j in range(width))).orderBy(name).toArrow()
    low, high = (np.column_stack([found.column(f"{side}{j}").to_numpy() for j in range(width)]) for side in ("low", "high"))
    return _Bounds(*(found.column(c).to_numpy() for c in (name, "rows", "first")), low, high)


def _led(numbers: np.ndarray, centres: np.ndarray, k: int, decimals: int | None):
    """The k best right vectors for each centre, of those in a task."""
    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, ids, vectors = _Best(centres, k, decimals), [], []

        def passed() -> None:
            order = np.argsort(every := np.concatenate(ids), kind="stable")
            best.meet(np.arange(len(centres)), every[order], np.concatenate(vectors)[order])
            ids.clear(), vectors.clear()

        for batch in batches:
            if batch.num_rows:
                for held, new in zip((ids, vectors), _vectors(batch, centres.shape[1])):
                    held.append(new)
                if sum(map(len, ids)) >= CENTRE_ROWS:
                    passed()
        if ids:
            passed()
        row, place = np.nonzero(best.score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(numbers[row].astype("int32")), pa.array(best.id[row, place]), pa.array(best.score[row, place])],
                                         names=["group", "id", "r"])
    return lead


def _wanted(groups: _Bounds, blocks: _Bounds, k: int, decimals: int | None):
    """The blocks that may hold one of the k best of some vector of a group."""
    unit = 0.0 if decimals is None else 10.0 ** -decimals

    def greatest(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        most = np.maximum(np.maximum(a * low, a * high), np.maximum(b * low, b * high))
        return _added(most[:, j] for j in range(most.shape[1]))

    def blocks_of(at: int, ids: list[int], leaders: np.ndarray) -> np.ndarray:
        a, b = groups.low[at], groups.high[at]
        beaten = np.flatnonzero(~(greatest(a, b, blocks.low, blocks.high) <= 0))
        if len(ids) < k:
            return beaten
        kept = []
        for leader, vector in zip(ids, leaders):
            low, high = blocks.low[beaten], blocks.high[beaten]
            size = (np.maximum(np.abs(a), np.abs(b)) * (np.maximum(np.abs(low), np.abs(high)) + np.abs(vector))).sum(axis=1)
            low, high = low - vector, high - vector
            more = greatest(a, b, low, high)
            # No component can add more than the leader's does.
            none = ~(((b > 0) & (high > 0)) | ((a < 0) & (low < 0))).any(axis=1)
            later = (none | (more < -NOISE * size)) & (blocks.first[beaten] > leader)
            lower = more < -unit - NOISE * size
            behind = np.isfinite(size) & (later | lower)
            kept.append(beaten[~behind])
            beaten = beaten[behind]
        return np.concatenate(kept)

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore", invalid="ignore"):
            for batch in batches:
                for row in batch.to_pylist():
                    at = int(np.searchsorted(groups.number, row["group"]))
                    found = blocks_of(at, row["ids"] or [], np.array(row["vectors"] or [], "float64").reshape(-1, blocks.low.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), row["group"], "int32")), pa.array(blocks.number[found].astype("int32")),
                         pa.array(blocks.rows[found] * groups.rows[at])], names=["group", "block", "pairs"])
    return want


def _added(terms: Iterator[np.ndarray]) -> np.ndarray:
    """Their sum in this order."""
    total = next(terms)
    for term in terms:
        total = total + term
    return total


class _Best:
    """The k best right vectors so far for each left vector."""

    def __init__(self, left: np.ndarray, k: int, decimals: int | None) -> None:
        self.left, self.k, self.decimals = left, k, decimals
        self.unit = 0.0 if decimals is None else 10.0 ** -decimals
        self.score, self.id = np.full((len(left), k), -np.inf), np.full((len(left), k), _LAST)
        # What comes in has a score above `least`, or equal to it and an id up to `last`.
        self.least, self.last = np.zeros(len(left)), np.full(len(left), _LAST)

    def begin(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Nothing comes in that is behind the k best of these; they are not
        in the lists until they are met. Their ids are in order."""
        if len(ids) < self.k:
            return
        step = max(1, TILE_SCORES // len(ids))
        for start in range(0, len(self.left), step):
            part = slice(start, start + step)
            exact = _added(np.multiply.outer(self.left[part, j], vectors[:, j]) for j in range(vectors.shape[1]))
            score = np.where(exact > 0, rounded(exact, self.decimals), -np.inf)
            least = np.partition(score, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            tied, places = score == least[:, None], self.k - (score > least[:, None]).sum(axis=1)
            last = ids[np.argmax(np.cumsum(tied, axis=1) == places[:, None], axis=1)]
            full = least > -np.inf
            self.least[part], self.last[part] = np.where(full, least, 0.0), np.where(full, last, _LAST)

    def reached(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """The left vectors for which one of a block's vectors may come in."""
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        bound = _added(np.maximum(self.left[:, j] * low[j], self.left[:, j] * high[j]) for j in range(len(low)))
        top = rounded(bound, self.decimals)
        return np.flatnonzero(~((bound <= 0) | (top < self.least) | ((top == self.least) & (self.last < ids[0]))))

    def meet(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """The ids are in order."""
        for start in range(0, len(rows), TILE_ROWS):
            part = rows[start:start + TILE_ROWS]
            step = max(1, TILE_SCORES // len(part))
            for first in range(0, len(ids), step):
                self._meet(part, ids[first:first + step], vectors[first:first + step])

    def _meet(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        left = self.left[rows]
        noise = NOISE * (np.abs(left) @ np.abs(vectors).max(axis=0))
        # All ids are later than the last: only higher scores come in.
        limit = self.least[rows] + np.where(self.last[rows] < ids[0], 0.4, -0.6) * self.unit - noise
        limit = np.maximum(limit, -noise)
        limit[np.isnan(limit)] = -np.inf
        row, column = np.divmod(np.flatnonzero(left @ vectors.T > limit[:, None]), len(ids))
        exact = _added(left[row, j] * vectors[column, j] for j in range(vectors.shape[1]))
        score, id_, row = rounded(exact, self.decimals), ids[column], rows[row]
        least = self.least[row]
        comes = (exact > 0) & ((score > least) | ((score == least) & (id_ <= self.last[row])))
        if not comes.any():
            return
        some, at = np.unique(row[comes], return_inverse=True)
        at = np.concatenate([np.repeat(np.arange(len(some)), self.k), at])
        score = np.concatenate([self.score[some].ravel(), score[comes]])
        id_ = np.concatenate([self.id[some].ravel(), id_[comes]])
        order = np.lexsort((id_, -score, at))
        count = np.bincount(at)
        kept = order[np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) < self.k]
        self.score[some], self.id[some] = score[kept].reshape(-1, self.k), id_[kept].reshape(-1, self.k)
        score, id_ = self.score[some, -1], self.id[some, -1]
        nearer = (score > self.least[some]) | ((score == self.least[some]) & (id_ < self.last[some]))
        self.least[some[nearer]], self.last[some[nearer]] = score[nearer], id_[nearer]


def _searched(k: int, decimals: int | None, width: int):
    """A bundle's left vectors (side 0), its leaders (1) and the blocks it needs (2)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        best, now = None, (0, 0)        # side and block of what is held

        def taken() -> tuple[np.ndarray, np.ndarray]:
            out = np.concatenate(held[0]), np.concatenate(held[1])
            held[0].clear(), held[1].clear()
            return out

        def done() -> None:
            nonlocal best, left
            if not held[0]:
                return
            ids, vectors = taken()
            if now[0] == 0:
                left, best = ids, _Best(vectors, k, decimals)
            elif best is not None and now[0] == 1:
                best.begin(ids, vectors)
            elif best is not None:
                best.meet(best.reached(ids, vectors), ids, vectors)

        left = np.empty(0, "int64")
        with np.errstate(over="ignore", invalid="ignore"):
            for batch in batches:
                if not batch.num_rows:
                    continue
                side, block = batch.column("side").to_numpy(), batch.column("block").to_numpy()
                ids, vectors = _vectors(batch, width)
                starts = np.flatnonzero(np.r_[True, (side[1:] != side[:-1]) | (block[1:] != block[:-1])])
                for start, end in zip(starts, np.r_[starts[1:], len(ids)]):
                    at = int(side[start]), int(block[start])
                    if at < now:
                        raise RuntimeError("cell rows are not sorted by side and block")
                    if at > now:
                        done()
                        now = at
                    held[0].append(ids[start:end])
                    held[1].append(vectors[start:end])
            done()
        for start in range(0, len(left), step := max(1, OUT_ROWS // k)):
            part = best.score[start:start + step]
            row, place = np.nonzero(part > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left[start + row]), pa.array(best.id[start + row, place]), pa.array(part[row, place]), pa.array((place + 1).astype("int32"))],
                names=["id", "rid", "r", "rank"])
    return search
