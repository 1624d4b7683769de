"""Item-item sums over shared keys: the pairs table of co-ratings and shared terms.

For entries (key, item, weight) the operator computes, for items a and b,

    dot(a, b) = sum over keys of weight(key, a) * weight(key, b)

A self join on the key would emit the square of every key's items, which one
busy user or one common term turns into the whole cost of the job. Here items
are hashed into row blocks and column stripes and the pairs table into cells, one
per block and stripe. A key sends a row to each cell it touches, with its items
of the block and of the stripe. A cell adds its pairs up in place and emits sums
only; a complete cell emits just the k best per item. Every cell is split by row
into as many parts as its load needs, and the partial sums are added by a plain
aggregation.

There are as many cells as the pairs need that can be different, at most all
that meet and at most all there are, and more where that keeps cells from being
split. Their shape is the one that sends least. With few items per key that is one
stripe: a key sends its whole basket once for each block it touches, at most the
square of its items, however many cells there are. With many it is a square: a key
with n items sends n * (blocks + stripes) entries. Entries carry the norm of their
item, in the smallest type that holds it.

What is sent is a multiple of the entries, so it is sent in rounds, some blocks at
a time; a round's pairs are added up and cut to the k best before the next one
begins, and its shuffle files go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.functions import association, half_up, top_per_group
from tastegraph.operators.dense_pairs import TASKS_PER_CORE
from tastegraph.operators.kernels import added_up, best_per_run, pair_code, pair_items
from tastegraph.workspace import materialize

BLOCK_ITEMS = 2048          # a cell holds at most some BLOCK_ITEMS ** 2 sums
CELL_ENTRIES = 4_000_000    # entries one task may stream
CHUNK_ENTRIES = 1024        # entries of a key in one row
CHUNK_PAIRS = 2_000_000     # pairs expanded at a time inside a task
PAIRS_PER_ENTRY = 16        # pairs that cost a task what one entry does
ROW_ENTRIES = 8             # entries that take the room of a row without any
SUM_ENTRIES = 6             # entries that take the room of a pair's sum
ROUND_ENTRIES = 64_000_000  # entries sent in one round, or
ROUND_SHARE = 4             # this many times all of them, where that is more

_SUMS = "product_id int, rid int, dot double, left_norm double, right_norm double"
_CELL = ["block", "stripe"]


def related_items(entries: DataFrame, norms: DataFrame, k: int | None,
                  decimals: int | None = None) -> DataFrame:
    """The k items most related to each item: (product_id, rid, r, rank).

    `entries` (key long, item int, weight double) must be unique per key and
    item and cheap to read twice (a written table). `norms` (item int, norm
    double) holds what the pair sum is scaled by: r = dot / sqrt(norm * norm).
    Items are ranked by r, rounded first if `decimals` is given, then by id.
    With k=None every related pair is returned, unranked.
    """
    scored = _scored(pair_sums(entries, norms, k, decimals), decimals).select("product_id", "rid", "r")
    if k is None:
        return scored
    return top_per_group(scored, ["product_id"], [F.desc("r"), F.asc("rid")], k)


def _scored(sums: DataFrame, decimals: int | None) -> DataFrame:
    r = association("dot", "left_norm", "right_norm")
    return sums.withColumn("r", r if decimals is None else half_up(r, decimals))


def pair_sums(entries: DataFrame, norms: DataFrame, k: int | None, decimals: int | None) -> DataFrame:
    """Sums of all related pairs, both ways round, or at least those that can be
    among the k best of their first item."""
    parallelism = entries.sparkSession.sparkContext.defaultParallelism
    norms = materialize(norms, "norms")
    sizes = materialize(entries.groupBy("key").agg(F.count("*").alias("n")), "key-sizes")
    blocks, stripes = _grid(sizes, norms.count())
    entries = materialize(
        entries.join(norms, "item").select("key", "item", F.col("weight").cast(_narrowest(entries, "weight")).alias("weight"),
                                           F.col("norm").cast(_narrowest(norms, "norm")).alias("norm")), "normed")

    tables = _laid(entries, sizes, blocks, stripes)
    load = F.col("sent") + F.col("pairs") / PAIRS_PER_ENTRY
    cells = materialize(
        _routed(*tables).groupBy(*_CELL).agg(F.sum(F.size("items")).alias("sent"), F.sum(F.col("left_n") * F.col("right_n")).alias("pairs"))
        .withColumn("splits", F.ceil(load / CELL_ENTRIES).cast("int")), "cells")
    # Partial sums are sent as well.
    room = F.col("sent") + F.when(F.col("splits") > 1, SUM_ENTRIES * F.col("pairs")).otherwise(0)
    sent = (cells.groupBy("block").agg(F.sum(room).alias("room"), F.sum("splits").alias("tasks"), F.max("splits").alias("splits"))
            .sort("block").collect())   # as many as the pairs over those of a cell, or the root of it
    most = max(ROUND_ENTRIES, ROUND_SHARE * (sizes.agg(F.sum("n")).first()[0] or 0))
    found = []
    for some in _rounds([(b.block, b.room) for b in sent], most):
        first, last = some[0], some[-1]
        here = [b for b in sent if first <= b.block <= last]
        width = max(1, min(sum(b.tasks for b in here), TASKS_PER_CORE * parallelism))
        routed = _routed(*tables, first, last)
        if max(b.splits for b in here) == 1:
            sums = _added(routed, _CELL, width, k, decimals)
        else:
            # One row for each cell with more than a task's load, so few.
            large = F.broadcast(cells.where(F.col("block").between(first, last) & (F.col("splits") > 1)).select(*_CELL, "splits"))
            split = routed.join(large, _CELL).withColumn("split", F.pmod(F.xxhash64("key", "piece"), F.col("splits")).cast("int"))
            parts = (_added(split.drop("splits"), [*_CELL, "split"], width, None, None).groupBy("product_id", "rid")
                     .agg(F.sum("dot").alias("dot"), F.first("left_norm").alias("left_norm"), F.first("right_norm").alias("right_norm")))
            if k is not None:
                parts = top_per_group(_scored(parts, decimals), ["product_id"], [F.desc("r"), F.asc("rid")], k).drop("r", "rank")
            sums = _added(routed.join(large, _CELL, "left_anti"), _CELL, width, k, decimals).unionByName(parts)
        found.append(materialize(sums, "pair-sums"))
    return reduce(DataFrame.unionByName, found) if found else entries.sparkSession.createDataFrame([], _SUMS)


def _added(routed: DataFrame, cell: list[str], width: int, k: int | None, decimals: int | None) -> DataFrame:
    return routed.drop("key", "piece").repartition(width, *cell).groupBy(*cell).applyInArrow(_cell_adder(k, decimals), _SUMS)


def _rounds(room: list[tuple[int, float]], most: float) -> list[list[int]]:
    """Blocks that follow one another, with room for `most` at most or one block."""
    rounds, filled = [], 0.0
    for block, own in room:
        if not rounds or filled + own > most:
            rounds.append([])
            filled = 0.0
        rounds[-1].append(block)
        filled += own
    return rounds


def _grid(sizes: DataFrame, items: int) -> tuple[int, int]:
    """Blocks and stripes: cells enough for the sums, in the number and shape that sends least."""
    n = F.col("n").cast("double")
    pairs = sizes.agg(F.sum(n * n)).first()[0] or 0.0
    least = max(1, int(-(-min(pairs, float(items) ** 2) // BLOCK_ITEMS ** 2)))
    shapes = [(-(-cells // s), s) for cells in (least, 2 * least, 4 * least, 8 * least)
              for s in (1 << p for p in range(cells.bit_length())) if s == 1 or s * s <= cells]

    def sent(blocks: int, stripes: int) -> tuple[Column, Column]:
        b, s = F.least(n, F.lit(float(blocks))), F.least(n, F.lit(float(stripes)))
        return F.coalesce(F.sum(n * (b + s)), F.lit(0.0)), F.coalesce(F.sum(ROW_ENTRIES * b * s), F.lit(0.0))

    sums = sizes.agg(*(c.alias(f"{name}{i}") for i, shape in enumerate(shapes) for c, name in zip(sent(*shape), ("sent", "rows")))).first()

    def cost(i: int) -> float:
        load = (sums[f"sent{i}"] + pairs / PAIRS_PER_ENTRY) / (shapes[i][0] * shapes[i][1])
        splits = -(-load // (CELL_ENTRIES / 2))     # cells are not alike
        parts = min(pairs, float(items) ** 2 * splits) if splits > 1 else 0.0
        return sums[f"sent{i}"] + sums[f"rows{i}"] + SUM_ENTRIES * parts

    return shapes[min(range(len(shapes)), key=cost)]


def _narrowest(df: DataFrame, column: str) -> str:
    """The smallest type that holds the column's values as they are."""
    value = F.col(column)
    whole, least, most = df.agg(F.bool_and(value == F.floor(value)), F.min(value), F.max(value)).first()
    if whole:
        for name, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
            if -(1 << bits) <= least and most < 1 << bits:
                return name
    return "double"


def _laid(entries: DataFrame, sizes: DataFrame, blocks: int, stripes: int) -> tuple[DataFrame | None, tuple[DataFrame, DataFrame] | None]:
    """Written tables: the baskets that are sent whole, and the entries of the other
    keys by block and by stripe."""
    def hashed(column: Column, parts: int) -> Column:
        return F.pmod(column, F.lit(parts)).cast("int")

    entries = entries.withColumn("block", hashed(F.xxhash64("item"), blocks))
    busy = sizes.where(F.col("n") > CHUNK_ENTRIES).select("key", F.ceil(F.col("n") / CHUNK_ENTRIES).cast("int").alias("pieces"))
    some_busy = not busy.isEmpty()

    def listed(rows: DataFrame, *group: str) -> DataFrame:
        return rows.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("block", "item", "weight", "norm"))).alias("p"))

    light = None
    if stripes == 1:
        # A block's items lie together.
        light = materialize(
            listed(entries.join(busy, "key", "left_anti") if some_busy else entries, "key")
            .select("key", F.col("p.block").alias("blocks"), F.col("p.item").alias("items"), F.col("p.weight").alias("weights"),
                    F.col("p.norm").alias("norms")), "baskets")
        if not some_busy:
            return light, None
        entries = entries.join(busy, "key")
    else:
        entries = entries.join(busy, "key", "left")
    entries = entries.withColumns({
        "stripe": hashed(F.xxhash64("item", F.lit(1)), stripes),
        "piece": hashed(F.xxhash64("item", F.lit(2)), 1 << 30) % F.coalesce("pieces", F.lit(1))})
    # Written, so that the join of a key's pieces can be split where a key is busy.
    left, right = (materialize(listed(entries, "key", *group), "packets").withColumnRenamed("p", name)
                   for name, group in (("left", ["block"]), ("right", ["stripe", "piece"])))
    return light, (left, right)


def _routed(light: DataFrame | None, packets: tuple[DataFrame, DataFrame] | None, first: int | None = None,
            last: int | None = None) -> DataFrame:
    """A row per key and cell, of all blocks or those from `first` to `last`: (block, stripe,
    key, piece, left_from, left_n, right_from, right_n, items, weights, norms), the key's entries
    of the block and of the stripe as ranges of one list. A busy key has several."""
    def wanted(block: Column) -> Column:
        return F.lit(True) if first is None else block.between(first, last)

    routed = []
    if light is not None:
        # The whole basket for each block it touches.
        routed.append(light.withColumn("block", F.explode(F.filter(F.array_distinct("blocks"), wanted))).select(
            "block", F.lit(0).alias("stripe"), "key", F.lit(0).alias("piece"),
            F.size(F.filter("blocks", lambda b: b < F.col("block"))).alias("left_from"),
            F.size(F.filter("blocks", lambda b: b == F.col("block"))).alias("left_n"),
            F.lit(0).alias("right_from"), F.size("items").alias("right_n"), "items", "weights", "norms"))
    if packets is not None:
        both = packets[0].where(wanted(F.col("block"))).join(packets[1], "key").withColumn("p", F.concat("left", "right"))
        routed.append(both.select(
            "block", "stripe", "key", "piece", F.lit(0).alias("left_from"), F.size("left").alias("left_n"),
            F.size("left").alias("right_from"), F.size("right").alias("right_n"),
            F.col("p.item").alias("items"), F.col("p.weight").alias("weights"), F.col("p.norm").alias("norms")))
    return reduce(DataFrame.unionByName, routed)


def _cell_adder(k: int | None, decimals: int | None):
    def add_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None
        for batch in batches:
            if batch.num_rows:
                cell = cell or _Cell()
                cell.add(batch)
        for columns in cell.results(k, decimals) if cell else ():
            for start in range(0, len(columns[0]), 100_000):
                product, rid, dot, left, right = (c[start:start + 100_000] for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(product, pa.int32()), pa.array(rid, pa.int32()),
                     pa.array(dot), pa.array(left), pa.array(right)],
                    names=["product_id", "rid", "dot", "left_norm", "right_norm"])
    return add_cell


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from `first` on, `length` of them, range after range."""
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


class _Cell:
    """Running pair sums of one cell of the pairs table."""

    def __init__(self):
        self.codes, self.sums, self.loose, self.folded = [], [], 0, 0
        self.items, self.norms, self.known = [], [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        lists = batch.column("items")
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("int64"))
        start = np.r_[0, ends[:-1]]
        item = lists.flatten().to_numpy(zero_copy_only=False).astype("int64")
        weight, norm = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype("float64") for c in ("weights", "norms"))
        self._know(item, norm)
        left, left_n, right, right_n = (batch.column(c).to_numpy(zero_copy_only=False).astype("int64")
                                        for c in ("left_from", "left_n", "right_from", "right_n"))
        # Each item of the block with the range of those it meets.
        a = _ranges(start + left, left_n)
        first, n = np.repeat(start + right, left_n), np.repeat(right_n, left_n)
        done = np.cumsum(n)
        at = 0
        while at < len(a):
            base = done[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(done, base + CHUNK_PAIRS, side="right")))
            b = _ranges(first[at:stop], n[at:stop])
            one, other = np.repeat(item[a[at:stop]], n[at:stop]), item[b]
            product = np.repeat(weight[a[at:stop]], n[at:stop]) * weight[b]
            kept = one != other
            self._collect(pair_code(one, other)[kept], product[kept])
            at = stop

    def _know(self, item: np.ndarray, norm: np.ndarray) -> None:
        item, at = np.unique(item, return_index=True)
        self.items.append(item)
        self.norms.append(norm[at])
        self.known += len(item)
        if self.known >= CHUNK_PAIRS and len(self.items) > 1:
            self._fold_norms()

    def _fold_norms(self) -> None:
        item, at = np.unique(np.concatenate(self.items), return_index=True)
        self.items, self.norms, self.known = [item], [np.concatenate(self.norms)[at]], 0

    def _collect(self, code: np.ndarray, product: np.ndarray) -> None:
        self.codes.append(code)
        self.sums.append(product)
        self.loose += len(code)
        if self.loose >= max(CHUNK_PAIRS, self.folded // 2):
            self._fold()

    def _fold(self) -> None:
        code, value = np.concatenate(self.codes), np.concatenate(self.sums)
        self.codes, self.sums, self.loose = [], [], 0
        code, value = added_up(code, value)
        self.codes, self.sums, self.folded = [code], [value], len(code)

    def results(self, k: int | None, decimals: int | None):
        """Columns of the pairs to emit."""
        if not self.codes:
            return
        self._fold()
        self._fold_norms()
        code, dot = self.codes[0], self.sums[0]
        if not (positive := dot > 0).all():
            code, dot = code[positive], dot[positive]
        items, norms = self.items[0], self.norms[0]
        row, column = pair_items(code)
        left, right = norms[np.searchsorted(items, row)], norms[np.searchsorted(items, column)]
        if k is not None:
            kept = best_per_run(row, dot / np.sqrt(left * right), k, decimals)
            row, column, dot, left, right = (c[kept] for c in (row, column, dot, left, right))
        yield row, column, dot, left, right
