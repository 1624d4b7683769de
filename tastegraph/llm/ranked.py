"""Ranked lexical search: norm buckets with bounds, exact integer scores.

Every document is an impact vector over the terms of the query set. The vectors
are dealt out by range of their length, longest first, so that each part is a
norm bucket. The first bucket is searched first and gives every query a score
that its k-th best document has at least. Then, in all other buckets at once:

- Cauchy-Schwarz: where a query's length times a bucket's greatest length is
  under its score so far, no document of the bucket is looked at;
- coordinates: a query's few heaviest terms are added up from the bucket's
  postings; what the others can add is at most the product of what is left of
  both lengths, and documents under the score so far go;
- the rest are scored again in 64-bit integers, which alone decide.

Weights are split evenly between query and document for the bounds, so their
dot product is the score. Queries are worked off in blocks of some 100,000
terms, each a pass over the documents: what a task holds of them is bounded.

Defined results: a null text, or one without a term, has no documents and is
none; items and documents that repeat are each ranked for themselves; equal
scores go by the smaller id, null ids last.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tastegraph.llm.tables import map_batches, numbered, small_batches, written

#: Terms of the queries of one block; an item with more is a block's only one.
BLOCK_TERMS = 100_000
#: Entries of vectors that are indexed at a time within a task.
CHUNK_ENTRIES = 1_000_000
#: Heaviest terms of a query that are looked up before the others are bounded.
FOCUS = 8
#: Bounds are sums of doubles and may be this much too small.
SLACK = 1 - 1e-9

#: Of each byte of UTF-8: blank if it is ASCII and neither letter nor digit; A-Z as a-z.
_SPLIT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_list(text: bytes | None) -> list[bytes]:
    """The terms of a text, repeats included."""
    return text.translate(_SPLIT).split() if text else []


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _lists(rows: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms, counts): written, a number for each item with terms."""
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [Counter(term_list(t)) for t in _texts(rows, 2)]
        return pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), _lists([list(c) for c in found], pa.binary()),
             _lists([list(c.values()) for c in found], pa.int64())], names=["item", "item_id", "terms", "counts"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = numbered(items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")), "items", "item")
    return written(map_batches(rows.select("item", "item_id", "text"), batch,
                               f"item long, item_id {kind}, terms array<binary>, counts array<long>")
                   .where(F.size("terms") > 0), "queries")


def _blocks(queries: DataFrame) -> Iterator[tuple[list[int], list[dict[bytes, int]]]]:
    """Item numbers and their terms, block by block."""
    total = queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_TERMS))
    mine = F.when(F.size("terms") > BLOCK_TERMS, F.col("item") + blocks).otherwise(
        F.pmod(F.xxhash64("item"), F.lit(blocks)))
    dealt = queries.withColumn("block", mine)
    for (block,) in dealt.select("block").distinct().sort("block").toLocalIterator():
        rows = dealt.where(F.col("block") == block).sort("item").collect()
        yield [r.item for r in rows], [dict(zip(map(bytes, r.terms), r.counts)) for r in rows]


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf): n terms in all, and how often those of the vocabulary occur."""
    known = vocabulary.keys()

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        lengths, terms, tf = [], [], []
        for text in _texts(rows, 1):
            words = term_list(text)
            counts = Counter(words)
            shared = [t for t in counts if t in known]
            lengths.append(len(words))
            terms.append([vocabulary[t] for t in shared])
            tf.append([counts[t] for t in shared])
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(lengths, pa.int64()), _lists(terms, pa.int32()), _lists(tf, pa.int64())],
            names=["id", "n", "terms", "tf"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col).alias("id"), text_col), batch,
                       f"id {kind}, n long, terms array<int>, tf array<long>")


def term_weights(counted: DataFrame, documents: int, size: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of every term of the vocabulary;
    there are no more than a block of queries has."""
    frequency = np.zeros(size, dtype=np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = df
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency],
                    dtype=np.int64)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _starts(column: pa.Array) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))]).astype(np.int64)


def impact_vectors(counted: DataFrame, documents: int, terms: int, weights: np.ndarray) -> DataFrame:
    """(id, terms, impacts, norm, bucket), written: documents with a weighted
    term, dealt out by length and, where lengths tie, by their number."""
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        n = rows.column("n").to_numpy(zero_copy_only=False)
        per_row = np.diff(_starts(rows.column("terms")))
        term, tf = _flat(rows.column("terms")), _flat(rows.column("tf"))
        m = np.repeat(100 - 25 + (25 * n * documents) // max(terms, 1), per_row)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
        row = np.repeat(np.arange(len(n)), per_row)
        used = (weights[term] > 0) & (impact > 0)
        term, impact, row = term[used], impact[used], row[used]
        norm = np.sqrt(np.bincount(row, weights=weights[term] * impact.astype(float) ** 2, minlength=len(n)))
        kept = np.flatnonzero(norm > 0)
        if not len(kept):
            return None
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n))[kept])]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [rows.column("id").take(pa.array(kept)), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
             pa.ListArray.from_arrays(ends, pa.array(impact, pa.int64())), pa.array(norm[kept])],
            names=["id", "terms", "impacts", "norm"])

    kind = counted.schema["id"].dataType.simpleString()
    vectors = (map_batches(counted, batch, f"id {kind}, terms array<int>, impacts array<long>, norm double")
               .withColumn("number", F.monotonically_increasing_id()))
    # Written first: ranges are drawn from a sample, for which all would be worked out twice.
    vectors = written(vectors, "impacts")
    dealt = vectors.repartitionByRange(F.desc("norm"), F.xxhash64("number")).sortWithinPartitions(F.desc("norm"))
    return written(dealt.withColumn("bucket", F.spark_partition_id()).drop("number"), "norm-buckets")


class _Query:
    """Of one query: its terms, integer weights, halves of the bound, and the best so far."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, least: int):
        used = weights[terms] > 0
        self.terms, self.exact = terms[used], (weights[terms] * counts)[used]
        half = np.sqrt(weights[self.terms]) * counts[used]
        order = np.argsort(-half, kind="stable")
        self.terms, self.exact, half = self.terms[order], self.exact[order], half[order]
        self.norm = float(np.sqrt((half ** 2).sum()))
        self.focus = list(zip(self.terms[:FOCUS].tolist(), half[:FOCUS].tolist()))
        self.rest = float(np.sqrt((half[FOCUS:] ** 2).sum()))
        self.least = least
        self.best: pa.Table | None = None

    def add(self, scores: np.ndarray, ids: pa.Array, k: int) -> None:
        """Keep the k best of what is held and these."""
        good = np.flatnonzero(scores >= self.least)
        if len(good) > k:
            good = good[scores[good] >= np.partition(scores[good], -k)[-k]]
        if not len(good):
            return
        new = pa.table({"score": scores[good], "id": ids.take(pa.array(good))})
        both = pa.concat_tables([self.best, new]) if self.best is not None else new
        order = pc.sort_indices(both, [("score", "descending"), ("id", "ascending")], null_placement="at_end")
        self.best = both.take(order[:k]).combine_chunks()
        if len(self.best) == k:
            self.least = max(self.least, self.best.column("score")[k - 1].as_py())


class _Chunk:
    """Vectors of one bucket: by row for scores, by term for the focus."""

    def __init__(self, ids: pa.Array, starts: np.ndarray, term: np.ndarray, impact: np.ndarray, norm: np.ndarray,
                 weights: np.ndarray):
        self.ids, self.starts, self.term, self.impact, self.norm = ids, starts, term, impact, norm
        self.square = norm ** 2
        row = np.repeat(np.arange(len(norm)), np.diff(starts))
        order = np.argsort(term, kind="stable")
        self.by_term, self.posted_row = term[order], row[order]
        self.posted = impact[order] * np.sqrt(weights[self.by_term])

    def search(self, query: _Query, table: np.ndarray, k: int) -> None:
        if query.norm * self.norm.max() < query.least * SLACK:
            return
        dot, square = np.zeros(len(self.norm)), self.square.copy()
        for term, half in query.focus:
            part = slice(*np.searchsorted(self.by_term, (term, term + 1)))
            row, value = self.posted_row[part], self.posted[part]
            dot[row] += half * value
            square[row] -= value ** 2
        # Where all is taken off, rounding can leave a little less or more than nothing.
        bound = dot + query.rest * np.sqrt(np.maximum(square, 0) + 1e-9 * self.square)
        kept = np.flatnonzero(bound >= query.least * SLACK)
        if not len(kept):
            return
        table[query.terms] = query.exact
        length = self.starts[kept + 1] - self.starts[kept]
        first = np.cumsum(length) - length
        at = np.arange(length.sum()) - np.repeat(first - self.starts[kept], length)
        scores = np.add.reduceat(table[self.term[at]] * self.impact[at], first)
        table[query.terms] = 0
        found = scores > 0
        query.add(scores[found], self.ids.take(pa.array(kept[found])), k)


def search_buckets(vectors: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray,
                   least: np.ndarray, k: int) -> DataFrame:
    """(query, id, score): of every task the k best documents of each query with
    a score of at least `least`."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [_Query(terms, counts, weights, int(score)) for (terms, counts), score in zip(queries, least)]
        table = np.zeros(len(weights), dtype=np.int64)
        held, entries = [], 0

        def work_off() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            terms, impacts = (rows.column(c).combine_chunks() for c in ("terms", "impacts"))
            chunk = _Chunk(rows.column("id").combine_chunks(), _starts(terms), _flat(terms), _flat(impacts),
                           rows.column("norm").to_numpy(), weights)
            for query in mine:
                chunk.search(query, table, k)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                entries += len(_flat(batch.column("terms")))
            if entries >= CHUNK_ENTRIES:
                work_off()
                held, entries = [], 0
        if held:
            work_off()
        for number, query in enumerate(mine):
            if query.best is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(query.best), number), pa.int32()), query.best.column("id").combine_chunks(),
                     query.best.column("score").combine_chunks()], names=["query", "id", "score"])

    small_batches(vectors)
    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "terms", "impacts", "norm").mapInArrow(over, f"query int, id {kind}, score long")


def _best(found: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, queries: list[dict[bytes, int]], k: int, id_col: str, text_col: str) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    for terms in queries:
        for term in terms:
            vocabulary.setdefault(term, len(vocabulary))
    counted = written(document_terms(docs, vocabulary, id_col, text_col), "document-terms")
    documents, terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = term_weights(counted, documents, len(vocabulary))
    vectors = impact_vectors(counted, documents, terms, weights)
    sparse = [(np.array([vocabulary[t] for t in q]), np.array(list(q.values()), dtype=np.int64)) for q in queries]

    least = np.ones(len(queries), dtype=np.int64)
    first = written(_best(search_buckets(vectors.where("bucket = 0"), sparse, weights, least, k), "query", k), "first-bucket")
    for query, score in first.where(F.col("rank") == k).select("query", "score").toLocalIterator():
        least[query] = score
    norms = np.array([_Query(t, c, weights, 1).norm for t, c in sparse])
    # Vectors too short for any query are not even read.
    shortest = float(np.min(least * SLACK / np.maximum(norms, 1e-300))) if len(queries) else 0.0
    others = vectors.where((F.col("bucket") > 0) & (F.col("norm") >= shortest * SLACK))
    return _best(first.drop("rank").unionByName(search_buckets(others, sparse, weights, least, k)), "query", k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", doc_text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k documents with the highest scores above 0 for every item: its id,
    `rank`, the document's id, `score`. An id column named like another result
    column is for the caller to rename."""
    queries = query_terms(items, item_id, item_text)
    found = []
    for numbers, block in _blocks(queries):
        item = F.element_at(F.lit(np.array(numbers, dtype=np.int64)), F.col("query") + 1)
        found.append(written(_search_block(docs, block, k, doc_id, doc_text).withColumn("item", item).drop("query"), "ranked"))
    if not found:
        kind = docs.schema[doc_id].dataType.simpleString()
        found = [docs.sparkSession.createDataFrame([], f"id {kind}, score long, rank int, item long")]
    ranked = reduce(DataFrame.unionByName, found)
    return ranked.join(queries.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_id), "rank", F.col("id").alias(doc_id), "score")
