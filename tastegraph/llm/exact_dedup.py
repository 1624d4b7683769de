"""Exact duplicates by content-defined chunk recipes, with SQL functions only.

A text is cut where its own characters say so, so equal texts are cut alike.
Every chunk gets an identifier; one pass over the distinct chunks verifies that
no two of them share one (else the wider identifier is used and verified).
After that, two texts are equal exactly if their ordered lists of identifiers
are, and only these lists are grouped and joined: the long texts stay put.

Defined results: a null text counts as empty; an empty text has an empty list;
of rows with the same id and text one stays; rows with a null id rank lowest;
columns other than the named ones are never looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.llm.tables import keep_rows, numbered, text_hash, written

MIN_CHUNK = 512
MAX_CHUNK = 8192
#: Characters in a row that must fall in fixed classes for a cut after them.
CUT_WINDOW = 4


def cut_pattern(low: int = MIN_CHUNK, high: int = MAX_CHUNK, window: int = CUT_WINDOW) -> str:
    """Chunks of `low` to `high` characters, up to the first window of which
    the character at place i has a code that leaves i when divided by 4."""
    classes = []
    for place in range(window):
        members = "".join(f"\\x{code:02x}" for code in range(32, 127) if code % 4 == place % 4)
        classes.append(f"[{members}]")
    return f"(?s).{{{low},{high - window}}}?{''.join(classes)}|.{{1,{high}}}"


def normalised(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null is empty. `lower` would
    do more to other letters, so only pure ASCII goes through it."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def _identifier(chunk: Column, wide: bool) -> Column:
    """128 bits from two seeds, or all of SHA-256."""
    return F.sha2(chunk.cast("binary"), 256) if wide else F.struct(
        F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk).alias("b"))


def _collides(chunks: DataFrame, wide: bool) -> bool:
    """Whether two different chunks share an identifier. Repeats fold within
    each task first; every distinct chunk moves once."""
    distinct = chunks.select(_identifier(F.col("chunk"), wide).alias("id"), "chunk").distinct()
    return not distinct.groupBy("id").count().where("count > 1").isEmpty()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, `keep_id` (the largest id with the
    same text), `group_size`, `kept` and `text_sha256` of the normalised text."""
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    cut = texts.withColumn("chunks", F.regexp_extract_all("norm", F.lit(cut_pattern()), F.lit(0)))
    chunks = cut.select(F.explode("chunks").alias("chunk"))
    wide = _collides(chunks, False)
    if wide and _collides(chunks, True):
        raise ValueError("two different chunks have one SHA-256")
    recipes = numbered(cut.select(
        "id", F.transform("chunks", lambda c: _identifier(c, wide)).alias("recipe"),
        text_hash(F.col("norm")).alias("text_sha256")), "recipes")
    groups = written(recipes.groupBy("recipe").agg(F.max(F.struct("id", "row_id")).alias("best"),
                                                   F.count(F.lit(1)).alias("group_size")), "recipe-groups")
    return recipes.join(groups, "recipe").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns; of rows that also share their
    id, any one."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept")
    return keep_rows(docs, kept, id_col, text_hash(normalised(F.col(text_col))), id_col, "text_sha256")
