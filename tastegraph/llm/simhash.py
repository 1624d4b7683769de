"""Near duplicates by SimHash fingerprints, compared in bit slices.

Of a text's word shingles, every bit of the fingerprint is the majority of
their hashes' bits. Equal fingerprints are folded first. Fingerprints at most
`radius` bits apart agree in at least two of radius + 2 parts, so each goes to
one bucket for every two parts. A bucket is compared in blocks of 64: the block
keeps one word per bit position, a query bit flips or keeps that word, and
carry-save counters add up 64 distances at once. A block is abandoned once all
its distances exceed the radius. Large buckets are cut into parts, and every
pair of parts is compared in a task of its own.

Defined results: a text without words, also a null one, has fingerprint zero
and links like any other; fewer words than a shingle are one shingle; rows with
a null id take part, and a component of only such rows has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tastegraph.llm.components import components
from tastegraph.llm.tables import group_numbers, keep_rows, map_batches, numbered, sorted_groups, text_hash
from tastegraph.workspace import materialize

BITS = 64
#: Rows of a bucket compared in one task at most, twice that for two parts.
PART_ROWS = 4096
#: Pairs of a row and a block compared at once.
AT_ONCE = 1 << 15
#: Bit positions after which blocks are looked at for abandoning.
LOOK_AFTER = 8
SEED = 42

#: For every byte, its eight bits as the lowest bits of eight bytes.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view("<u8")[:, 0]


def shingle_hashes(text: str | None, words: int, seed: int = SEED) -> list[int]:
    """Of the shingles of the text with A-Z in lower case."""
    found = (text or "").encode().lower().split()  # of bytes: ASCII letters, ASCII white space
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = list(accumulate(len(w) + 1 for w in found))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[start:end - 1], seed) for start, end in zip([0, *ends], ends[words - 1:])]


def fingerprints(hashes: list[list[int]]) -> np.ndarray:
    """A bit is set where more than half of the hashes have it. Counts are
    added eight to a word, over runs short enough for one byte each."""
    sizes = np.array([len(h) for h in hashes])
    out = np.zeros(len(hashes), dtype=np.uint64)
    if not sizes.sum():
        return out
    spread = _SPREAD[np.fromiter((x for h in hashes for x in h), np.uint64, sizes.sum()).view(np.uint8)]
    starts, runs = np.cumsum(sizes) - sizes, -(-sizes // 255)
    owner = np.repeat(np.arange(len(sizes)), runs)
    at = starts[owner] + 255 * (np.arange(len(owner)) - (np.cumsum(runs) - runs)[owner])
    partial = np.add.reduceat(spread.reshape(-1, 8), at, axis=0).view(np.uint8)
    full = np.flatnonzero(sizes)
    counts = np.add.reduceat(partial, np.searchsorted(owner, full), axis=0, dtype=np.int64)
    out[full] = np.packbits(2 * counts > sizes[full, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _planes(prints: np.ndarray) -> np.ndarray:
    """Of blocks of 64 fingerprints: for each bit position, one word a block."""
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8")[:, :, 0].T)


def near_in_blocks(planes: np.ndarray, block: np.ndarray, query: np.ndarray, lanes: np.ndarray,
                   radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a block and a query, which of the block's `lanes` are at
    most `radius` bits from the query: the pairs that have any, and the lanes."""
    alive = np.arange(len(block))
    counters = [np.zeros(len(block), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(block), np.uint64)
    one = np.uint64(1)
    for bit in range(0, BITS, 2):
        first, second = (planes[b][block] ^ (np.uint64(0) - ((query >> np.uint64(b)) & one)) for b in (bit, bit + 1))
        # the lowest counter takes both words at once
        half = counters[0] ^ first
        carry = (counters[0] & first) | (half & second)
        counters[0] = half ^ second
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if (bit + 2) % LOOK_AFTER == 0:
            beyond, equal = over.copy(), ~np.uint64(0)
            for k in reversed(range(len(counters))):  # counter > radius, from the highest bit
                if radius >> k & 1:
                    equal = equal & counters[k]
                else:
                    beyond |= equal & counters[k]
                    equal = equal & ~counters[k]
            left = lanes & ~beyond
            keep = left != 0
            if not keep.all():
                alive, block, query, lanes, over = (x[keep] for x in (alive, block, query, lanes, over))
                counters, left = [c[keep] for c in counters], left[keep]
            if not len(alive):
                return alive, lanes
            lanes = left
    return alive, lanes


def near_pairs(prints: np.ndarray, group: np.ndarray, part: np.ndarray, low: np.ndarray, high: np.ndarray,
               radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the same group at most `radius` bits apart. Rows are sorted by
    group and part; in a group of two parts, only rows of different parts meet."""
    unit = group_numbers(group, part)
    begins = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    sizes = np.diff(np.r_[begins, len(prints)])
    blocks = -(-sizes // 64)
    offset = np.cumsum(blocks) - blocks
    place = np.arange(len(prints)) - begins[unit]
    slot = offset[unit] * 64 + place
    padded = np.zeros(blocks.sum() * 64, np.uint64)
    padded[slot] = prints
    row_of = np.full(len(padded), -1)
    row_of[slot] = np.arange(len(prints))
    filled = np.packbits((row_of >= 0).reshape(-1, 64), axis=1, bitorder="little").view("<u8")[:, 0]
    planes = np.concatenate([_planes(padded[i:i + 64 * 4096]) for i in range(0, len(padded), 64 * 4096)], axis=1)
    # a row meets the blocks of its own unit from its own on, or all those of the other part
    alone = low == high
    partner = np.where(alone, unit, unit + 1)
    active = alone | (part == low)
    partner = np.minimum(partner, len(begins) - 1)
    active &= alone | (group[begins[partner]] == group)
    from_block = np.where(alone, place // 64, 0)
    meets = np.where(active, blocks[partner] - from_block, 0)
    lefts, rights = [], []
    total = np.cumsum(meets)
    start = 0
    while start < len(prints):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + AT_ONCE, "right")))
        count = meets[start:stop]
        rows = np.repeat(np.arange(start, stop), count)
        if len(rows):
            block = (offset[partner] + from_block)[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            lanes = filled[block].copy()
            own = alone[rows] & (block == slot[rows] // 64)
            later = ~np.uint64(0) << (place[rows] % 64).astype(np.uint64) << np.uint64(1)
            lanes[own] &= later[own]
            some = np.flatnonzero(lanes)
            hit, near = near_in_blocks(planes, block[some], prints[rows[some]], lanes[some], radius)
            which, lane = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            lefts.append(rows[some][hit][which])
            rights.append(row_of[block[some][hit][which] * 64 + lane])
        start = stop
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (np.zeros(0, int), np.zeros(0, int))


def fold(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row each of n rows is linked to, directly or not."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, root[left], least)
        np.minimum.at(root, root[right], least)
        while not np.array_equal(root, next_root := root[root]):
            root = next_root
        if np.array_equal(before, root):
            return root


def _links(radius: int):
    """Links of sorted buckets, folded: each row to the smallest it reaches."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, 4):
            columns = [c.to_numpy() for c in table.columns]
            keys, part, prints = columns[:4], columns[4], columns[5]
            left, right = near_pairs(prints.view(np.uint64), group_numbers(*keys), part, keys[2], keys[3], radius)
            if len(left):
                root = fold(len(prints), left, right)
                linked = np.flatnonzero(root != np.arange(len(root)))
                yield pa.RecordBatch.from_arrays([pa.array(prints[linked]), pa.array(prints[root[linked]])],
                                                 names=["a", "b"])
    return over


def near_links(prints: DataFrame, radius: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct `fp` at most `radius` bits apart,
    and no others: within a task, a chain of them stands for all."""
    parts = radius + 2
    bounds = [BITS * i // parts for i in range(parts + 1)]
    masks = [sum(((1 << bounds[i + 1]) - (1 << bounds[i])) for i in two) for two in combinations(range(parts), 2)]
    keys = F.array(*(F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(F.lit(np.uint64(m).astype(np.int64).item()))
                              .alias("key")) for n, m in enumerate(masks)))
    keyed = prints.select("fp", F.inline(keys))
    sizes = materialize(keyed.groupBy("t", "key").count().where("count > 1"), "buckets")
    n = F.ceil(F.col("count") / part_rows)
    spread = (keyed.join(sizes, ["t", "key"])
              .withColumn("n", n).withColumn("part", F.pmod(F.xxhash64("fp"), "n"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
              .select("t", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                      "part", "fp"))
    dealt = spread.repartition("t", "key", "low", "high").sortWithinPartitions("t", "key", "low", "high", "part")
    return dealt.mapInArrow(_links(radius), "a long, b long")


def simhash_groups(docs: DataFrame, words: int, radius: int, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, `fingerprint` (16 hex digits),
    `component_id` (the smallest id reachable over links), `kept` (true for one
    row of each component, that with the smallest id) and `text_sha256`."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = fingerprints([shingle_hashes(t, words) for t in rows.column(2).to_pylist()])
        return pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(found.view(np.int64))],
                                          names=["id", "text_sha256", "fp"])

    picked = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_sha256"), F.col(text_col))
    printed = numbered(map_batches(picked, batch, f"id {id_type}, text_sha256 string, fp long"), "prints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row_id")
    prints = materialize(printed.groupBy("fp").agg(F.min(order).alias("first")), "distinct-prints")
    roots = components(near_links(prints, radius), "a", "b")
    grouped = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    grouped = materialize(grouped, "grouped")
    best = materialize(grouped.groupBy("root").agg(F.min("first").alias("best")), "best")
    placed = materialize(grouped.join(best, "root").select("fp", "best"), "placed")
    return printed.join(placed, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.id").alias("component_id"), (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256")


def drop_near_duplicates(docs: DataFrame, words: int, radius: int, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, one of each component, all columns."""
    kept = simhash_groups(docs, words, radius, id_col, text_col).where("kept")
    return keep_rows(docs, kept, id_col, text_hash(F.col(text_col)), id_col, "text_sha256")
