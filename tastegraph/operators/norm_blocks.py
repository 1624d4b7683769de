"""The largest dot products without meeting every vector.

A dot product is at most the product of both lengths. So the right vectors are
laid out in blocks from the longest to the shortest, and a left vector goes from
block to block only while its length times the block's greatest could still give
one of its k best. Blocks are taken in rounds, one, then one more, two, four and
so on; after each round the k best so far are written and those left vectors go
on whose bound for the next block is no less than their k-th score. Within a
round the work is cut into cells as in `dense_pairs`.

Vectors of few components have a tighter bound, by the least and greatest values
of a block's components: they go by `box_blocks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.functions import top_per_group
from tastegraph.operators.box_blocks import best_dots_in_boxes
from tastegraph.operators.dense_pairs import BLOCK_BYTES, PART_ROWS, counted, matched, usable
from tastegraph.workspace import materialize

#: More than a sum of products in doubles can be off, as a share of the lengths.
SLACK = 1e-9
#: Components up to which blocks can be cut small in all of them.
BOX_WIDTH = 4


def _length(vector: str) -> Column:
    """Scaled by the largest component, so that squares neither vanish nor overflow."""
    most = F.array_max(F.transform(vector, F.abs))
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (x / most) * (x / most))
    return F.when(most > 0, F.when(most == float("inf"), most).otherwise(most * F.sqrt(squares))).otherwise(0.0)


def best_dots(left: DataFrame, right: DataFrame, k: int, decimals: int | None = None,
              block_bytes: int = BLOCK_BYTES, rounds: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """The rows of `best_matches(left, right, k, "dot")`: (id, rid, r, rank) of the
    k highest positive dot products of each left vector, ties to the smaller rid.

    Both tables are (id long, vector array); null vectors and those with null or
    NaN components match nothing, vectors of different lengths raise ValueError.
    A block holds about `block_bytes` of right vectors. `rounds`, if given, gets
    (first block, blocks, pairs of a left vector and a block) of every round.
    """
    spark, parallelism = left.sparkSession, left.sparkSession.sparkContext.defaultParallelism
    left, right = usable(left), usable(right)
    n_left, n_right, width = counted(left, right)
    if width <= BOX_WIDTH:
        return best_dots_in_boxes(left, right, k, decimals, block_bytes, (n_left, n_right, width), rounds)
    blocks = max(1, -(-n_right * 8 * max(width, 1) // block_bytes))
    columns = F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector")
    # Sorted by length and then by a hash, so that vectors of one length fill many blocks.
    laid = materialize(
        right.select(*columns).withColumn("length", _length("vector"))
        .repartitionByRange(blocks, F.desc("length"), F.xxhash64("id")).withColumn("block", F.spark_partition_id()), "norm-blocks")
    longest = {r.block: r.most for r in laid.groupBy("block").agg(F.max("length").alias("most")).collect()}
    reach = F.array(*(F.lit(longest.get(block, 0.0)) for block in range(blocks)))
    going = materialize(left.select(*columns).withColumn("length", _length("vector")).withColumn("least", F.lit(0.0)), "left-vectors")
    best = spark.createDataFrame([], "id long, rid long, r double, rank int")
    tolerance = 0.0 if decimals is None else 10.0 ** -decimals

    first, step = 0, 1
    while first < blocks:
        n = min(step, blocks - first)

        def worth(length: Column) -> Column:
            bound = F.col("length") * length
            return (bound > 0) & (bound * (1 + SLACK) + tolerance >= F.col("least"))

        near = F.filter(F.sequence(F.lit(first), F.lit(first + n - 1)), lambda block: worth(F.get(reach, block)))
        passing = materialize(going.withColumn("blocks", near).where(F.size("blocks") > 0), "going")
        met = passing.agg(F.sum(F.size("blocks")).alias("pairs"), F.count("*").alias("rows")).first()
        if not met.rows:
            break
        if rounds is not None:
            rounds.append((first, n, met.pairs))
        parts = max(-(-met.rows // PART_ROWS), min(-(-parallelism // n), -(-met.rows // 64)), 1)
        held = laid.where(F.col("block").between(first, first + n - 1)).select(
            F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "block", F.lit(0).alias("side"), "id", "vector")
        reached = passing.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"),
                                 F.explode("blocks").alias("block"), F.lit(1).alias("side"), "id", "vector")
        found = matched(held.unionByName(reached), parts, n, k, "dot", decimals=decimals)
        best = materialize(top_per_group(best.drop("rank").unionByName(found), ["id"], [F.desc("r"), F.asc("rid")], k), "best-dots")
        # Whoever has k scores needs no block that can't reach the least of them.
        full = best.where(F.col("rank") == k).select("id", F.col("r").alias("kth"))
        going = (passing.drop("blocks").join(full, "id", "left")
                 .withColumn("least", F.coalesce("kth", F.lit(0.0))).drop("kth"))
        first, step = first + n, first + n
    return best
