"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tastegraph.llm import bpe, language, licences, mixing, packing, repeats, secrets, spelling, surrogates
from tastegraph.llm.exact_dedup import exact_duplicates
from tastegraph.llm.forest import near_vectors
from tastegraph.llm.ranked import ranked_search
from tastegraph.llm.simhash import simhash_groups

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Of a real run, a secret of its owner.
SURROGATE_KEY = b"an example key"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with surrogates in their texts, and what was replaced."""
    replaced = surrogates.replace_entities(_documents(spark, sf_dir), SURROGATE_KEY)
    return replaced.select("doc_id", "text", "n_entities", F.concat_ws(",", F.transform("entities", lambda e: F.concat_ws(
        ":", e["kind"], e["start"], e["stop"]))).alias("spans"))


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document stands for one repository, its source for the owner."""
    return secrets.digest(secrets.find_secrets(_documents(spark, sf_dir)))


def op3_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language.fit(language.labelled_sample(docs))
    return language.identify(docs, model).withColumn("held_out", language.held_out())


def op4_simhash_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_documents(spark, sf_dir), words=3, radius=2)


def op5_licence_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents have no paths: a source stands for a repository, a
    language for a directory in it, a document for a file."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    found = licences.detect(_documents(spark, sf_dir).withColumn("path", path))
    return found.select("doc_id", "path", "licence", F.round("cosine", 6).alias("cosine"), "origin", "from_dir",
                        F.size("headers").cast("long").alias("n_headers"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_documents(spark, sf_dir))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Towards equal sources: 97 % of the most entropy, at most four repeats,
    so many tokens that every row is taken at least once."""
    docs = _documents(spark, sf_dir)
    tokens = mixing.word_count(F.col("text"))
    return mixing.mix(docs, tokens, entropy=0.97, max_repeats=4.0)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(_documents(spark, sf_dir), length=100))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = (bpe.encode(_documents(spark, sf_dir), path, words=50_000, spaced=400_000)
               .withColumn("ids_sha256", F.sha2("ids", 256)))
    return bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.9)


def op11_variable_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.corpus_words(_documents(spark, sf_dir)))


def op12_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every item."""
    return ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=20)


def op13_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 ids, id 1 at the end of every document."""
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, width=2048)


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_pii_surrogates, op2_secret_ownership, op3_cross_parsing, op4_simhash_bitslice, op5_licence_inheritance,
    op6_exact_dedup, op7_temperature_mixing,
    op8_suffix_dedup, op9_bpe_round_trip, op10_projection_forest, op11_variable_grams,
    op12_norm_buckets, op13_concat_and_cut)}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        with norm as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id,
               count(*) over (partition by t) as group_size,
               doc_id = max(doc_id) over (partition by t) as kept,
               sha256(t) as text_sha256
        from norm""",
    # Every pair, and components by walking the links; all vectors given are usable.
    "op10_projection_forest": """
        with recursive vectors as (select vec_id, cast(embedding as double[]) as v from embeddings),
        links as (
            select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.vec_id <> b.vec_id
            where list_cosine_similarity(a.v, b.v) >= 0.9),
        reached as (
            select vec_id as a, vec_id as b from vectors
            union
            select r.a, l.b from reached r join links l on l.a = r.b),
        least as (select a as vec_id, min(b) as component_id from reached group by 1),
        counted as (select a as vec_id, count(*) as n_links from links group by 1)
        select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
        from least left join counted using (vec_id)""",
    "op12_norm_buckets": r"""
        with words as (
            select 'd' as kind, doc_id as id, text from documents union all select 'i', item_id, text from benchmark),
        terms as (
            select kind, id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from words),
        tf as (select id as doc_id, term, count(*) as tf from terms where kind = 'd' group by 1, 2),
        lengths as (select doc_id, cast(sum(tf) as bigint) as n from tf group by 1),
        totals as (select count(*) as docs, cast(sum(n) as bigint) as all_terms from lengths),
        weights as (
            select term, cast(floor(1000 * ln((2.0::double * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w
            from tf cross join totals group by 1),
        sizes as (select doc_id, 100 - 25 + ((25 * n * docs) // all_terms) as m from lengths cross join totals),
        scores as (
            select t.id as item_id, f.doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
            from terms t join tf f on f.term = t.term join weights g on g.term = t.term join sizes s on s.doc_id = f.doc_id
            where t.kind = 'i' group by 1, 2),
        ranked as (
            select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank
            from scores where score > 0)
        select item_id, rank, doc_id, score from ranked where rank <= 20""",
}
