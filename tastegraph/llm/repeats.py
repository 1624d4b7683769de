"""Removal of passages that occur earlier, by suffix sorting.

Every string of `length` bytes that also starts earlier is covered and removed.
Equal strings have equal minimizers: the least hash among their `gram`-byte
pieces, the leftmost if it repeats. A text is therefore cut into segments, the
strings around one minimizer, and only segments with the same minimizer need
to meet. Segments whose minimizer is nowhere else are dropped, equal segments
are folded to the earliest, and what is left, different segments around one
minimizer, is suffix-sorted in small collections.

There the Burrows-Wheeler transform is expanded breadth first: from an
interval of suffixes with a common prefix, the intervals of all prefixes with
one more symbol in front follow from the symbols before them. An interval of
length l that ends at a new place shows a common prefix of l - 1 there, so
common prefixes appear by increasing value and the search ends at `length`:
neighbours without a value by then share a string.

Minimizers with more segments than `group_segments` are not sorted together in
one task; their strings are grouped by 128-bit hashes instead, which finds the
same. Segments count as equal by minimizer and 64-bit hash, twice 64 bits.

Defined results: a null text is empty; null ids come last; rows with the same
id and text count as one document and get the same result; texts with the same
id are ordered by hash; strings are judged on the input, and overlaps count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.llm.tables import map_batches, small_batches, sorted_groups, written

LENGTH = 100
GRAM = 32
#: Bytes hashed at once, and bytes of segments sorted at once.
BLOCK_BYTES = 1 << 20
SORT_BYTES = 1 << 20
#: Segments around one minimizer that are sorted together at most.
GROUP_SEGMENTS = 2048
#: Symbols packed into one sort key: 7 x 9 bits.
PACKED = 7
LAST_ID = (1 << 63) - 1

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each run of `gram` bytes, from hashes of halves."""
    hashes = (data.astype(np.uint64) + np.uint64(1)) * _MIX[1]
    size = 1
    while size < gram:
        step = min(size, gram - size)
        left, right = hashes[:len(hashes) - step], hashes[step:]
        mixed = right >> np.uint64(29)
        mixed ^= right
        mixed *= _MIX[2]
        hashes = left * _MIX[0]
        hashes += mixed
        size += step
    hashes ^= hashes >> np.uint64(32)
    return hashes * _MIX[1]


def segments(data: np.ndarray, owner: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts in one array: start and number of strings of each segment, and
    the hash of its minimizer. `owner` has the text of each byte."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, np.zeros(0, np.uint64)
    hashes = gram_hashes(data, gram)
    best = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, size = length - gram + 1, 1
    while size < width:
        step = min(size, width - size)
        best = np.minimum(best[:len(best) - step], best[step:])
        size += step
    place = (best & _PLACE).astype(np.int64)
    whole = owner[:len(place)] == owner[length - 1:]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1]) | (owner[1:len(place)] != owner[:len(place) - 1])
    start = np.flatnonzero(new)
    count = np.diff(np.r_[start, len(place)])
    keep = whole[start]
    return start[keep], count[keep], hashes[place[start[keep]]]


def _scan(length: int, gram: int, folded: bool):
    """Arrow batches of (id, tag, text) to segments; with their own hashes if `folded`."""
    def blocks(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Texts side by side, cut with an overlap if long: bytes, row, place in the text."""
        held, size = [], 0
        for row, text in enumerate(rows.column(2).to_pylist()):
            data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            for at in range(0, max(1, len(data) - length + 1), BLOCK_BYTES):
                part = data[at:at + BLOCK_BYTES + length - 1]
                held.append((row, at, part))
                size += len(part)
                if size >= BLOCK_BYTES:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def over(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, tags = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        for held in blocks(rows):
            sizes = np.array([len(part) for _, _, part in held])
            data = np.concatenate([part for _, _, part in held])
            owner = np.repeat(np.arange(len(held)), sizes)
            start, count, minimizer = segments(data, owner, length, gram)
            if not len(start):
                continue
            of = owner[start]
            row = np.array([r for r, _, _ in held])[of]
            begin = np.array([a for _, a, _ in held])[of] + start - (np.cumsum(sizes) - sizes)[of]
            columns = [pa.array(minimizer.view(np.int64))]
            if folded:
                raw, digest = data.tobytes(), xxhash.xxh64_intdigest
                own = [digest(raw[s:e]) for s, e in zip(start.tolist(), (start + count + length - 1).tolist())]
                columns += [pa.array(np.array(own, np.uint64).view(np.int64)), pa.array(ids[row]), pa.array(tags[row]),
                            pa.array(begin << 8 | count)]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "c", "id", "tag", "pos"])
            else:
                yield pa.RecordBatch.from_arrays(columns, names=["h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield from over(rows)
    return run


def shared_prefixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of `symbols` (0 to 511) in the order of their first `length`
    symbols, and which of them share these with the one before. `length` is
    over `PACKED`."""
    n = len(symbols)
    wide = np.r_[symbols, np.zeros(PACKED, np.int64)]
    packed = np.zeros(n, np.int64)
    for k in range(PACKED):
        packed = packed << 9 | wide[k:k + n]
    order = np.argsort(packed)
    new = np.r_[True, packed[order][1:] != packed[order][:-1]]
    known = np.r_[new, True]
    # A suffix's rank is the place of the first that is like it so far, from 1; only
    # those that are like another are sorted further.
    ranks = np.empty(n, np.int64)
    ranks[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
    tied = np.flatnonzero(~(new & known[1:]))
    size = PACKED
    while size < length and len(tied):
        step = min(size, length - size)
        at = order[tied]
        behind = np.where(at < n - step, ranks[np.minimum(at + step, n - 1)], 0)
        key = ranks[at] * (n + 1) + behind
        by_key = np.argsort(key)
        at, key = at[by_key], key[by_key]
        order[tied] = at
        new = np.r_[True, key[1:] != key[:-1]]
        ranks[at] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        tied = tied[~(new & np.r_[new[1:], True])]
        size += step
    before = symbols[order - 1]  # of the first symbol, the last: a separator
    by_symbol = np.argsort(before.astype(np.int16), kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)
    low = np.flatnonzero(known[:n])
    high = np.r_[low[1:], n] - 1
    for _ in range(PACKED, length):
        sizes = high - low + 1
        interval = np.repeat(np.arange(len(low)), sizes)
        place = np.arange(len(interval)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[interval]
        key = interval * 512 + before[place]
        by_key = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(key[by_key]) != 0])
        last = np.r_[first[1:], len(key)] - 1
        low, high = lf[place[by_key[first]]], lf[place[by_key[last]]]
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
        if not len(low):
            break
    return order, ~known[:n]


def later_strings(parts: list[bytes], order_of: list[np.ndarray], start: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """Of different segments, the runs of strings that an earlier segment has:
    segment, first string, and behind the last one. `order_of` are the columns
    by which documents are ordered, `start` the places of the segments."""
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes + 1)
    symbols = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int64) + 1
    symbols[ends - 1] = 0
    order, shares = shared_prefixes(symbols, length)
    segment = np.repeat(np.arange(len(parts)), sizes + 1)
    offset = np.arange(len(symbols)) - (ends - sizes - 1)[segment]
    shared = shares.copy()
    shared[:-1] |= shares[1:]
    group = np.cumsum(~shares)[shared]
    at = order[shared]
    string = offset[at] <= sizes[segment[at]] - length
    group, at = group[string], at[string]
    of = segment[at]
    sort = np.lexsort((start[of] + offset[at], *(c[of] for c in reversed(order_of)), group))
    group, at = group[sort], at[sort]
    later = np.sort(at[1:][group[1:] == group[:-1]])
    if len(later):
        cut = np.r_[True, np.diff(later) != 1]
        for a, b in zip(later[cut], later[np.r_[cut[1:], True]]):
            yield int(segment[a]), int(offset[a]), int(offset[b]) + 1


def _sorted_segments(length: int):
    """Sorted (h, id, tag, start, part) to runs of bytes to remove."""
    def collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, size = [], 0
        for table in sorted_groups(batches, 1):
            held.append(table)
            size += table.nbytes
            if size >= SORT_BYTES:
                yield pa.concat_tables(held)
                held, size = [], 0
        if held:
            yield pa.concat_tables(held)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in collections(batches):
            ids, tags, start = (table.column(k).to_numpy() for k in (1, 2, 3))
            runs = list(later_strings(table.column(4).to_pylist(), [ids, tags], start, length))
            if runs:
                of, first, behind = np.array(runs).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[of]), pa.array(tags[of]), pa.array(start[of] + first),
                     pa.array(start[of] + behind + length - 1)], names=["id", "tag", "start", "stop"])
    return over


RUN = "id long, tag long, start long, stop long"


def _hashed_strings(parts: DataFrame, length: int) -> DataFrame:
    """The same for minimizers of very many segments: strings meet by hash."""
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [(xxhash.xxh3_128_digest(p[k:k + length]), i, t, s + k)
                 for i, t, s, p in zip(*(rows.column(c).to_pylist() for c in (1, 2, 3, 4)))
                 for k in range(len(p) - length + 1)]
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                          names=["string", "id", "tag", "start"])

    strings = written(map_batches(parts, batch, "string binary, id long, tag long, start long"), "strings")
    first = written(strings.groupBy("string").agg(F.min(F.struct("id", "tag", "start")).alias("first"),
                                                  F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first-strings")
    return (strings.join(first, "string").where(F.struct("id", "tag", "start") != F.col("first"))
            .select("id", "tag", "start", (F.col("start") + length).alias("stop")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"), F.xxhash64(text).alias("_tag"),
            text.alias("_text")]


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                  gram: int = GRAM, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """Runs of bytes that earlier text has: (id, tag, start, stop), which may
    overlap. `tag` is the hash of the text."""
    small_batches(docs)
    texts = docs.select(*_keyed(docs, id_col, text_col)).where(F.octet_length("_text") >= length)
    minimizers = texts.mapInArrow(_scan(length, gram, False), "h long")
    repeated = written(minimizers.groupBy("h").count().where("count > 1").select("h"), "repeated")
    found = texts.mapInArrow(_scan(length, gram, True), "h long, c long, id long, tag long, pos long")
    candidates = written(found.join(repeated, "h", "left_semi"), "candidates")
    first = written(candidates.groupBy("h", "c").agg(F.min(F.struct("id", "tag", "pos")).alias("first")), "segments")
    start, count = F.shiftright("pos", 8), F.col("pos").bitwiseAND(255)
    copies = (candidates.join(first, ["h", "c"]).where(F.struct("id", "tag", "pos") != F.col("first"))
              .select("id", "tag", start.alias("start"), (start + count + (length - 1)).alias("stop")))
    crowds = written(first.groupBy("h").count().where("count > 1"), "crowds")
    wanted = (first.join(crowds, "h").select("first.id", "first.tag", F.struct(
                  "h", F.shiftright("first.pos", 8).alias("start"),
                  (F.col("first.pos").bitwiseAND(255) + (length - 1)).alias("size"),
                  (F.col("count") > group_segments).alias("crowded")).alias("segment"))
              .groupBy("id", "tag").agg(F.collect_list("segment").alias("wanted")))

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i, t, text, wanted_here in zip(*(rows.column(k).to_pylist() for k in range(4))):
            data = text.encode("utf-8", "surrogatepass")
            out += [(w["h"], i, t, w["start"], data[w["start"]:w["start"] + w["size"]], w["crowded"]) for w in wanted_here]
        h, i, t, s, p, c = zip(*out)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in (h, i, t, s)), pa.array(p, pa.binary()), pa.array(c)],
            names=["h", "id", "tag", "start", "part", "crowded"])

    meet = texts.join(wanted, (F.col("_id") == F.col("id")) & (F.col("_tag") == F.col("tag")))
    parts = written(map_batches(meet.dropDuplicates(["_id", "_tag"]).select("_id", "_tag", "_text", "wanted"), cut,
                                "h long, id long, tag long, start long, part binary, crowded boolean"), "parts")
    columns = ["h", "id", "tag", "start", "part"]
    sorted_parts = parts.where(~F.col("crowded")).select(columns).repartition("h").sortWithinPartitions("h", "id", "tag", "start")
    return (copies.unionByName(sorted_parts.mapInArrow(_sorted_segments(length), RUN))
            .unionByName(_hashed_strings(parts.where("crowded").select(columns), length)))


def _united(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs that touch or overlap made one, in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    return starts[new], reach[np.r_[new[1:], True]]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """One row per row of `docs`: the id, `n_bytes`, `removed` (runs of bytes,
    start and stop) and `kept`, the bytes that are left."""
    runs = written(repeated_runs(docs, id_col, text_col, length, gram, group_segments)
                   .groupBy("id", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("runs")), "runs")
    texts = docs.select(F.col(id_col).alias("own_id"), *_keyed(docs, id_col, text_col))
    id_type = docs.schema[id_col].dataType.simpleString()

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, kept = [], [], []
        for text, found in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            sizes.append(len(data))
            united = []
            if found:
                starts, stops = _united(*np.array([(r["start"], r["stop"]) for r in found]).T)
                united = list(zip(starts.tolist(), stops.tolist()))
                data = b"".join(data[a:b] for a, b in zip([0, *stops.tolist()], [*starts.tolist(), len(data)]))
            removed.append([{"start": a, "stop": b} for a, b in united])
            kept.append(data)
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(sizes, pa.int64()), pa.array(removed, span),
                                           pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "removed", "kept"])

    joined = texts.join(runs, (F.col("_id") == F.col("id")) & (F.col("_tag") == F.col("tag")), "left")
    return map_batches(joined.select("own_id", "_text", "runs"), batch,
                       f"`{id_col}` {id_type}, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary")


def digest(cleaned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of bytes and runs, and the hash of what is left."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return cleaned.select(id_col, "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
