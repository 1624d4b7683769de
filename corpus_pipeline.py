"""The corpus pipeline: stages over `documents`, each one of the operators.

Every stage gets what its predecessor kept, and its result is written and read
back before the next one starts. All but the last return the columns of
`documents`, whatever these are called; the last adds the tokens and puts in
their text. Nulls, empty texts, ties and repeated rows are the operators'
business; an empty table stays one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tastegraph.llm import bpe, language, mixing
from tastegraph.llm.exact_dedup import drop_exact_duplicates
from tastegraph.llm.simhash import drop_near_duplicates
from tastegraph.llm.tables import unused
from tastegraph.workspace import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or in no learned language, go."""
    model = language.fit(language.labelled_sample(docs))
    names = tuple(unused(docs, "_language", "_score", "_phrase_symbols"))
    found = language.identify(docs, model, carry=tuple(c for c in docs.columns if c != "doc_id"), names=names)
    return found.where(~language.rejected(F.col(names[0]), F.col(names[2]))).select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, that with the largest id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return drop_near_duplicates(docs, words=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources repeat towards equal weights; every document comes at least once."""
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")), entropy=0.97, max_repeats=4.0)
    return mixing.take(docs, mixed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with `n_tokens` and `ids`, and as text what the ids decode
    to. Columns that had these two names give way to the result."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_tokens", "ids")]
    own, = unused(docs, "_ids")
    encoded = bpe.encode(docs, path, carry=tuple(others)).withColumn(own, F.col("ids"))
    return bpe.decode(encoded, path, ids_col=own, to="text").select("doc_id", "text", *others, "n_tokens", "ids")


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash_near_dedup", near_dedup),
          ("mixing", mix_sources), ("bpe", encode)]

#: SQL can't express all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
