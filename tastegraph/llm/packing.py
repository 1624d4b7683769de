"""Packing documents into fixed sequences: concatenate and cut.

All documents, each ended by one id, make one long row of ids, which is cut
every `width` ids. Where a document lies in it follows from two passes of prefix
sums: the first pass turns texts into ids, counts them up within each partition
and writes both; the partitions' totals, a row each, are summed up by levels of
1,024, which gives the offset of every partition. The second pass reads the ids
where they lie and cuts them: no id moves between machines. Only the window that
a partition shares with its neighbours is put together from boundary records.

Defined results: a null or empty text is its end id alone; rows are packed as
they come, repeats and null ids included; all sequences are full but the last,
which is padded. Nothing is lost or cut off: a document longer than a sequence
goes on in the next ones.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from tastegraph.llm import bpe
from tastegraph.llm.tables import map_batches, small_batches, unused, written
from tastegraph.workspace import new_path

#: Totals summed up in one window.
LEVEL = 1024
#: In texts longer than this, runs are looked for that the library's pattern can't take.
PLAIN_TEXT, LONG_RUN = 10_000, 4_000

#: Fixed value: the byte-level word pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUNS = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")


@lru_cache
def text_encoder(path: str) -> Callable[[str | None], bytes]:
    """Packed ids of a text. The merge list goes to the library that merges by
    the rank of the merged token, which is the same where tokens are numbered in
    the order of their merges; that is checked. Texts with very long runs go
    through the streaming transducer instead, whose memory they don't fill."""
    spec = bpe._read(path)
    bpe_model, pre = spec["model"], spec["pre_tokenizer"] or {}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    plain = (spec["normalizer"] is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and bpe_model["type"] == "BPE"
             and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
             and not any(bpe_model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix",
                                                    "end_of_word_suffix")))
    if not plain:
        raise ValueError(f"{path} is no plain byte-level merge list")
    vocab = bpe_model["vocab"]
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in bpe_model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError(f"the tokens of {path} are not numbered in the order of their merges")
    ranks = {t: i for i, t in bpe.token_bytes(spec).items() if i not in added.values()}
    library = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    transducer = lru_cache(lambda: bpe.Words(bpe.Vocabulary(path)))

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) > PLAIN_TEXT and RUNS.search(text):
            return bpe.encode_text(transducer(), text)
        return library.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

    return encode


def encode_in_place(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass: (id, ids, n_tokens, part, before), a written table. `ids` are
    little-endian unsigned 32-bit integers ending in `end_id`; `before` counts the
    ids that come earlier in the same part."""
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, reached = text_encoder(path), 0
        for batch in batches:
            ids = [encode(t) + end for t in batch.column(1).to_pylist()]
            n = np.array([len(i) // 4 for i in ids], dtype=np.int64)
            before = reached + np.cumsum(n) - n
            reached += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(n), pa.array(before)],
                names=["id", "ids", "n_tokens", "before"])

    small_batches(docs)
    found = (docs.select(F.col(id_col).alias("id"), text_col)
             .mapInArrow(over, f"id {kind}, ids binary, n_tokens long, before long")
             .withColumn("part", F.spark_partition_id()))
    table = new_path(docs.sparkSession, "token-rows")
    found.write.option("compression", "zstd").parquet(table)
    return docs.sparkSession.read.schema(found.schema).parquet(table)


def prefix_sums(totals: DataFrame, key: str, n: str) -> DataFrame:
    """(key, base): the sum of `n` over all smaller keys. `key` counts from 0 and
    is unique. Windows hold 1,024 rows at most; their sums are summed up in turn."""
    levels = [totals.select(F.col(key).cast("long").alias("k0"), F.col(n).cast("long").alias("n"))]
    depth, width = 0, totals.agg(F.max(key)).first()[0] or 0
    while width >= LEVEL:
        depth, width = depth + 1, width // LEVEL
        levels.append(levels[-1].groupBy(F.expr(f"k{depth - 1} div {LEVEL}").alias(f"k{depth}")).agg(F.sum("n").alias("n")))
    base = None
    for at in range(depth, -1, -1):
        group = F.expr(f"k{at} div {LEVEL}")
        earlier = Window.partitionBy(group).orderBy(f"k{at}").rowsBetween(Window.unboundedPreceding, -1)
        here = levels[at].select(f"k{at}", group.alias(f"k{at + 1}"),
                                 F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("here"))
        if base is not None:
            here = here.join(base, f"k{at + 1}").withColumn("here", F.col("here") + F.col("base"))
        base = written(here.select(f"k{at}", F.col("here").alias("base")), "bases")
    return base.withColumnRenamed("k0", key)


def placed(encoded: DataFrame) -> DataFrame:
    """`encoded` with `position`, where each row begins in the whole. The bases
    have a row per task of the first pass; Spark broadcasts them while they are
    under its threshold and else joins by part."""
    totals = written(encoded.groupBy("part").agg(F.sum("n_tokens").alias("n")), "totals")
    return (encoded.join(prefix_sums(totals, "part", "n").withColumn("part", F.col("part").cast("int")), "part")
            .withColumn("position", F.col("base") + F.col("before")).select("id", "ids", "n_tokens", "position"))


def _cuts(position: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Of rows: the row, start, length, window and offset of every piece."""
    first, last = position // width, (position + n - 1) // width
    pieces = last - first + 1
    row = np.repeat(np.arange(len(n)), pieces)
    window = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + first[row]
    begin = np.maximum(window * width, position[row])
    end = np.minimum((window + 1) * width, position[row] + n[row])
    return row, begin - position[row], end - begin, window, begin - window * width


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def pieces(rows: DataFrame, width: int) -> DataFrame:
    """Second pass: one row per piece of a document in a sequence: id, start and
    length in the document, CRC-32 of its ids, the document's ids in all, the
    sequence and the offset in it."""
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = _numbers(rows, "n_tokens")
        row, start, length, window, offset = _cuts(_numbers(rows, "position"), n, width)
        ids = [memoryview(i) for i in rows.column("ids").to_pylist()]
        crc = [zlib.crc32(ids[r][4 * s:4 * (s + k)]) for r, s, k in zip(row.tolist(), start.tolist(), length.tolist())]
        return pa.RecordBatch.from_arrays(
            [rows.column("id").take(pa.array(row)), *map(pa.array, (start, length)), pa.array(crc, pa.int64()),
             *map(pa.array, (n[row], window, offset))],
            names=["id", "start", "length", "ids_crc32", "tokens", "sequence_id", "offset"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, batch, f"id {kind}, start long, length long, ids_crc32 long, tokens long, "
                                    "sequence_id long, offset long")


def sequences(rows: DataFrame, width: int, pad_id: int) -> DataFrame:
    """(sequence_id, ids, n_tokens): the sequences themselves, `width` ids each,
    of which n_tokens are no padding. Windows that lie within a task's rows come
    out whole; the others are boundary records, at most two for every run of
    rows, and are put together by sequence, whose size bounds what meets."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], 0   # ids of the window at hand, and where its next id belongs

        def flush(out: list) -> None:
            if held:
                ids = b"".join(held)
                begin = at - len(ids) // 4
                out.append((begin // width, begin % width, ids, len(ids) == 4 * width))
                held.clear()

        for batch in batches:
            out: list = []
            for ids, position in zip(batch.column("ids").to_pylist(), _numbers(batch, "position").tolist()):
                if position != at:
                    flush(out)
                    at = position
                taken = 0
                while taken < len(ids):
                    part = ids[taken:taken + 4 * (width - at % width)]
                    held.append(part)
                    taken, at = taken + len(part), at + len(part) // 4
                    if at % width == 0:
                        flush(out)
            if out:
                yield _records(out)
        out = []
        flush(out)
        if out:
            yield _records(out)

    small_batches(rows)
    found = written(rows.select("ids", "position").mapInArrow(
        over, "sequence_id long, offset long, ids binary, whole boolean"), "windows")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = found.where("not whole").groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"))
    whole = found.where("whole").select("sequence_id", "ids").unionByName(joined)
    n = F.expr("length(ids) div 4")
    padding = F.lit(np.full(width, pad_id, dtype="<u4").tobytes())
    return whole.select("sequence_id", F.substring(F.concat("ids", padding), 1, 4 * width).alias("ids"),
                        n.cast("long").alias("n_tokens"))


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["sequence_id", "offset", "ids", "whole"])


def pack(docs: DataFrame, path: str, end_id: int, width: int = 2048, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The pieces of all documents, with the id under its own name, which takes
    precedence over a result's, and the document's ids as `doc_tokens`."""
    total, = unused(docs.select(id_col), "doc_tokens")
    found = pieces(placed(encode_in_place(docs, path, end_id, id_col, text_col)), width)
    return found.withColumnRenamed("tokens", total).withColumnRenamed("id", id_col)
