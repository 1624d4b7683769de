"""What the operators share: written tables with row numbers, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.workspace import materialize

#: Rows handed to a Python worker at once: texts of a few KB, so about a MB.
BATCH_ROWS = 256


def small_batches(df: DataFrame, rows: int = BATCH_ROWS) -> None:
    """Hands texts to Python in small batches, whatever the session says."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def numbered(df: DataFrame, name: str, column: str = "row_id") -> DataFrame:
    """`df` written out with a number per row, which stays as written however
    often the table is read. Rows may repeat and their ids may be null."""
    return materialize(df.withColumn(column, F.monotonically_increasing_id()), name)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """`function` on every Arrow batch; a batch may give nothing."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (found := function(batch)) is not None:
                yield found

    small_batches(df)
    return df.mapInArrow(over, schema)


def text_hash(text: Column) -> Column:
    """SHA-256 of a text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, made longer where `df` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (name + "_" * k for k in count()) if n.lower() not in taken) for name in names]


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, hashed: Column, kept_id: str, kept_hash: str) -> DataFrame:
    """The rows of `docs` whose id and hash are in `kept`, one of each."""
    own, of_id, of_hash = unused(docs, "_hash", "_kept_id", "_kept_hash")
    wanted = kept.select(F.col(kept_id).alias(of_id), F.col(kept_hash).alias(of_hash))
    same = F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_hash))
    return docs.withColumn(own, hashed).join(wanted, same, "left_semi").dropDuplicates([id_col, own]).drop(own)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Of batches sorted by their first `keys` columns: tables in which every
    group is whole. Only the group at a batch's end is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in range(keys)]
        same = np.ones(batch.num_rows, dtype=bool)
        for k, value in enumerate(last):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == value.as_py()
        first = int(np.argmax(same))
        if first:
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
            held = [batch.slice(first)]
        elif held and any(held[-1].column(k)[held[-1].num_rows - 1] != last[k] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_numbers(*keys: np.ndarray) -> np.ndarray:
    """0 for the rows of the first group, 1 for those of the next, and so on."""
    new = np.zeros(len(keys[0]), dtype=bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """`materialize`, after which the shuffle files behind the table may go."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
