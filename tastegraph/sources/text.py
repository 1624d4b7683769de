"""Products and ratings from delimited text.

Both loaders return the good rows and, apart, the lines that could not be read,
so a broken line neither stops the load nor vanishes. An `Observation`, if given,
counts both (`read`, `unread`) in the pass that uses the good rows, so that a job
need not read its file again to know. Splitting and casting are column
expressions; no line passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tastegraph.schemas import PRODUCT, RATING


def load_products(spark: SparkSession, path: str, counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Caret-separated product lines: id, name, category ids, external code,
    image url, categories, tags. Category ids and external code are dropped."""
    field = F.split("value", r"\^")
    # position in the line of each kept column
    position = {"product_id": 1, "name": 2, "categories": 6, "image_url": 5, "tags": 7}
    columns = {name: F.trim(F.try_element_at(field, F.lit(at))) for name, at in position.items()}
    columns["product_id"] = columns["product_id"].try_cast("int")
    return _accept(spark.read.text(path), columns, PRODUCT.fieldNames(),
                   (F.size(field) >= 7) & F.col("product_id").isNotNull(), counts)


def load_ratings(spark: SparkSession, path: str, counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Comma-separated rating lines: user, product, score, epoch seconds. A score
    that is no number cannot be read."""
    field = F.split("value", ",")
    columns = {f.name: F.trim(F.try_element_at(field, F.lit(i + 1))).try_cast(f.dataType)
               for i, f in enumerate(RATING.fields)}
    good = ~F.isnan("score")
    for name in columns:
        good &= F.col(name).isNotNull()
    return _accept(spark.read.text(path), columns, RATING.fieldNames(), F.coalesce(good, F.lit(False)), counts)


def _accept(lines: DataFrame, columns: dict, order: list[str], good: Column,
            counts: Observation | None) -> tuple[DataFrame, DataFrame]:
    parsed = lines.withColumns(columns)
    seen = parsed if counts is None else parsed.observe(
        counts, F.count_if(good).alias("read"), F.count_if(~good).alias("unread"))
    return seen.where(good).select(*order), parsed.where(~good).select("value")
