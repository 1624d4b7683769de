"""Mixing sources by temperature.

A source's share of the tokens, to the power of an exponent from 0 (all equal)
to 1 (as they are), is its weight. The exponent is found by bisection: the
largest that reaches a target entropy, raised if a source would repeat more
often than allowed. With a limit alone, weights are as equal as it allows, and
with neither they stay as they are. Each pass over the sources tries many exponents at once and
only sums come back, so the sources may be many.

Weights become budgets of whole tokens. A source is taken whole as often as its budget
allows; in every epoch its rows are dealt into blocks by a hash of seed and
epoch, which is a permutation cut into blocks of bounded size. The last epoch
stops where the budget ends: whole blocks by their running sums, and one block
row by row, so that no task ever orders a whole source.

Defined results: a null source is a source of its own; a null or empty text has
no tokens; a source without tokens has weight 0 and its rows are taken once;
rows may repeat and each is taken for itself; the row that the budget ends in
is still taken.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tastegraph.llm.tables import numbered, text_hash, unused
from tastegraph.workspace import materialize

#: Rows of a block, about.
BLOCK_ROWS = 1024
#: Exponents tried in one pass, which narrows the bracket to one of these steps.
STEPS = 32
PASSES = 6


def word_count(text: Column) -> Column:
    """Tokens, if no other count is given: words between white space."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\S+"), F.lit(0)))


@dataclass
class Temperature:
    """The exponent found, what its weights are to be divided by, and the
    budget in tokens."""
    exponent: float
    total: float
    norm: float
    budget: float


def _passes(shares: DataFrame, exponents: list[float]) -> dict[str, list[float]]:
    """For each exponent: the sum of weights, and that of weight times log share."""
    found = shares.agg(
        *(F.sum(F.pow("share", F.lit(a))).alias(f"z{i}") for i, a in enumerate(exponents)),
        *(F.sum(F.pow("share", F.lit(a)) * F.log("share")).alias(f"l{i}") for i, a in enumerate(exponents))).first()
    return {k: [found[f"{k}{i}"] for i in range(len(exponents))] for k in "zl"}


def find_temperature(sources: DataFrame, entropy: float | None, max_repeats: float | None,
                     budget: float | None) -> Temperature:
    """`sources` has `tokens` for each source. `entropy` is a fraction of that of
    equal weights. Without a budget it is such that each row comes at least once."""
    total, low, high = sources.where("tokens > 0").agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    if not total:
        return Temperature(1.0, 0.0, 1.0, 0.0)
    shares = materialize(sources.where("tokens > 0").select((F.col("tokens") / F.lit(float(total))).alias("share")), "shares")
    n = shares.count()
    least, most = low / total, high / total

    def repeats(exponent: float, z: float) -> float:
        """Of the smallest source; the largest one repeats least."""
        if budget is None:
            return (most / least) ** (1 - exponent)
        return least ** (exponent - 1) / z * budget / total

    def fits(exponent: float, z: float, l: float) -> tuple[bool, bool]:
        found = math.log(z) - exponent * l / z
        return (entropy is None or n == 1 or found >= entropy * math.log(n) - 1e-12,
                max_repeats is None or repeats(exponent, z) <= max_repeats + 1e-12)

    # Entropy falls and repeats fall as the exponent rises: two brackets, one each.
    entropy_at, repeat_at = (0.0, 1.0), (0.0, 1.0)
    for _ in range(PASSES):
        grids = [[lo + (hi - lo) * i / STEPS for i in range(STEPS + 1)] for lo, hi in (entropy_at, repeat_at)]
        sums = _passes(shares, [*grids[0], *grids[1]])
        good = [fits(a, z, l) for a, z, l in zip([*grids[0], *grids[1]], sums["z"], sums["l"])]
        reached = max((i for i in range(STEPS + 1) if good[i][0]), default=0)
        entropy_at = (grids[0][reached], grids[0][min(reached + 1, STEPS)])
        allowed = min((i for i in range(STEPS + 1) if good[STEPS + 1 + i][1]), default=STEPS)
        repeat_at = (grids[1][max(allowed - 1, 0)], grids[1][allowed])
    wanted = entropy_at[0] if entropy is not None else float(max_repeats is None)
    exponent = max(wanted, repeat_at[1] if repeat_at[1] > 1e-9 else 0.0)
    norm = _passes(shares, [exponent])["z"][0]
    if budget is None:
        budget = total * norm * most ** (1 - exponent)
    return Temperature(exponent, float(total), norm, float(budget))


def mix(docs: DataFrame, tokens: Column, entropy: float | None = None, max_repeats: float | None = None,
        budget: float | None = None, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each time a row of `docs` is taken: the id, `source`, `tokens`,
    `weight` of the source, `epoch`, and `block` and `slot`, which order the
    epoch; `text_sha256` tells rows with one id apart."""
    sized = numbered(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                 F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"),
                                 text_hash(F.col(text_col)).alias("hash")), "sized")
    sources = materialize(sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")),
                          "sources")
    found = find_temperature(sources, entropy, max_repeats, budget)
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(found.total or 1.0), F.lit(found.exponent))
                    / F.lit(found.norm)).otherwise(0.0)
    due = F.round(F.col("weight") * F.lit(found.budget)).cast("long")
    whole = F.when(F.col("source_tokens") > 0, F.expr("due div source_tokens")).otherwise(1)
    plan = materialize(
        sources.withColumn("weight", weight).withColumnRenamed("tokens", "source_tokens")
        .withColumn("due", due).withColumn("whole", whole)
        .withColumn("rest", F.col("due") - F.col("whole") * F.col("source_tokens"))
        .withColumn("blocks", F.ceil(F.col("rows") / block_rows))
        .select(F.col("source").alias("of"), "weight", "whole", "rest", "blocks"), "plan")
    mixed = F.xxhash64(F.lit(seed), F.col("epoch"), F.col("id"), F.col("hash"))
    dealt = (sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
             .withColumn("slot", mixed)
             .withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "slot"), "blocks")))
    full = dealt.where("epoch < whole")
    last = materialize(dealt.where("epoch = whole and rest > 0"), "last-epoch")
    sums = materialize(last.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("block_tokens")), "block-sums")
    before = F.sum("block_tokens").over(Window.partitionBy("source").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1))
    open_blocks = materialize(
        sums.withColumn("before", F.coalesce(before, F.lit(0))).where("before < rest")
        .select(F.col("source").alias("of"), F.col("block").alias("nr"), "before", "block_tokens"), "open-blocks")
    inside = last.join(open_blocks, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("nr")))
    running = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("slot", "row_id").rowsBetween(
        Window.unboundedPreceding, -1))
    ends = F.col("before") + F.col("block_tokens") > F.col("rest")
    cut = (inside.where(ends).withColumn("running", F.coalesce(running, F.lit(0)))
           .where(F.col("before") + F.col("running") < F.col("rest")))
    columns = [F.col("id").alias(id_col), "source", "tokens", "weight", "epoch", "block", "slot",
               F.col("hash").alias("text_sha256")]
    return full.select(columns).unionByName(inside.where(~ends).select(columns)).unionByName(cut.select(columns))


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """The rows of `docs`, all columns, each as often as it was taken. Rows with
    one id, source and text are taken together, in the columns of one of them."""
    own, of_id, of_source, of_hash, copies, copy = unused(
        docs, "_hash", "_taken_id", "_taken_source", "_taken_hash", "_copies", "_copy")
    taken = (mixed.groupBy(F.col(id_col).alias(of_id), F.col("source").alias(of_source), F.col("text_sha256").alias(of_hash))
             .agg(F.count(F.lit(1)).alias(copies)))
    same = (F.col(id_col).eqNullSafe(F.col(of_id)) & F.col(source_col).cast("string").eqNullSafe(F.col(of_source))
            & (F.col(own) == F.col(of_hash)))
    return (docs.withColumn(own, text_hash(F.col(text_col))).join(taken, same).dropDuplicates([id_col, source_col, own])
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(docs.columns))
