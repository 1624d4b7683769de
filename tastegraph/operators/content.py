"""Item similarity from tags: TF-IDF vectors compared by cosine.

Products with the same bag of words have the same vector. They are folded into
one representative (the smallest id), the similarities are computed between
representatives, and the lists are handed back to all members, which is exact:
members of a group rank by id alone, so its k + 1 smallest ids are all that can
appear in a list of k.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import DataFrame, functions as F

from tastegraph.functions import as_lists, tokens, top_per_group
from tastegraph.operators.sparse_pairs import related_items
from tastegraph.workspace import materialize

DECIMALS = 6
HASH_BUCKETS = 189


def content_sims(products: DataFrame, k: int = 5) -> DataFrame:
    """The k products with the most similar tags: (product_id, rid, r, rank).

    Every distinct word is a term, weighted tf * ln((m + 1) / (df + 1)) over the
    m products. Only products sharing a weighted term are listed. The cosine is
    rounded to 6 decimals before ranking, ties go to the smaller id.
    """
    bags = _bags(products.select("product_id", tokens("tags").alias("words")))
    groups = _groups(bags, k)
    m = bags.count()
    counted = (groups.select("gid", "members", F.explode("words").alias("term"))
               .groupBy("gid", "members", "term").agg(F.count("*").alias("tf")))
    # Written out, so that the numbers given to the terms stay as they are.
    vocabulary = materialize(counted.groupBy("term").agg(F.sum("members").alias("df"))
                             .withColumn("key", F.monotonically_increasing_id()), "vocabulary")
    weight = F.col("tf") * F.log(F.lit(m + 1.0) / (F.col("df") + 1))
    entries = materialize(
        counted.join(vocabulary, "term").select("key", F.col("gid").alias("item"), weight.alias("weight"))
        .where("weight > 0"), "term-weights")
    return _to_members(bags, groups, _group_lists(entries, groups, k), k)


def content_sims_hashed(products: DataFrame, k: int = 5, buckets: int = HASH_BUCKETS) -> DataFrame:
    """The same with words hashed into `buckets` features, where words that share
    a bucket make products look alike. Lists are filled up to k with products of
    similarity 0, smallest ids first."""
    words = Tokenizer(inputCol="text", outputCol="words").transform(
        products.select("product_id", F.translate(F.coalesce("tags", F.lit("")), "|", " ").alias("text")))
    bags = _bags(words.select("product_id", "words"))
    groups = _groups(bags, k)
    counts = HashingTF(inputCol="words", outputCol="counts", numFeatures=buckets)
    idf = IDF(inputCol="counts", outputCol="features").fit(counts.transform(bags))
    vectors = idf.transform(counts.transform(groups)).select("gid", F.unwrap_udt("features").alias("v"))
    entries = materialize(
        vectors.select("gid", F.explode(F.arrays_zip("v.indices", "v.values")).alias("e"))
        .select(F.col("e.indices").cast("long").alias("key"), F.col("gid").alias("item"),
                F.col("e.values").alias("weight"))
        .where("weight > 0"), "bucket-weights")

    # A list lacks at most k + 1 entries and holds at most k of the fillers, so
    # the 2k + 2 smallest ids with a vector serve all lists.
    with_vector = groups.join(entries.select(F.col("item").alias("gid")).distinct(), "gid", "left_semi")
    smallest = with_vector.select(F.explode("ids").alias("id")).orderBy("id").limit(2 * k + 2)
    fillers = F.array(*[F.struct(F.lit(row.id).alias("rid"), F.lit(0.0).alias("r"))
                        for row in smallest.collect()]).cast("array<struct<rid:int,r:double>>")
    listed = F.transform("recs", lambda e: e.rid)
    missing = F.filter(fillers, lambda e: ~F.array_contains(listed, e.rid))
    # A similarity that rounds to 0 is worth no more than a filler.
    ranked = F.array_sort(F.transform(F.concat("recs", missing), lambda e: F.struct((-e.r).alias("minus"), e.rid.alias("rid"))))
    lists = (_group_lists(entries, groups, k)
             .withColumn("recs", F.transform(F.slice(ranked, 1, k + 1), lambda e: F.struct(
                 e.rid.alias("rid"), (F.lit(0.0) - e.minus).alias("r")))))
    return _to_members(bags, groups, lists, k)


def content_sim_lists(products: DataFrame, k: int = 5, hashed: bool = False) -> DataFrame:
    """One row per product with its list; a product like no other keeps an empty
    one."""
    flat = (content_sims_hashed if hashed else content_sims)(products, k)
    return as_lists(flat, products, "product_id", ["rid", "r"])


def _bags(words: DataFrame) -> DataFrame:
    """(product_id, words, bag): `bag` identifies the words with their repeats."""
    ordered = words.withColumn("words", F.array_sort("words"))
    return materialize(ordered.withColumn("bag", F.sha2(F.array_join("words", " "), 256)), "bags")


def _groups(bags: DataFrame, k: int) -> DataFrame:
    """One row per distinct bag: its words, size and k + 1 smallest ids, the
    first of which, gid, stands for the group."""
    sizes = bags.groupBy("bag").agg(F.first("words").alias("words"), F.count("*").alias("members"))
    smallest = (top_per_group(bags.select("bag", "product_id"), ["bag"], [F.asc("product_id")], k + 1)
                .groupBy("bag").agg(F.array_sort(F.collect_list("product_id")).alias("ids")))
    return materialize(sizes.join(smallest, "bag").withColumn("gid", F.col("ids")[0]), "groups")


def _group_lists(entries: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """(gid, recs): the k + 1 products most similar to the group's vector, its
    own members among them."""
    norms = entries.groupBy("item").agg(F.sum(F.col("weight") * F.col("weight")).alias("norm"))
    near = (related_items(entries, norms, k, DECIMALS)
            .select(F.col("product_id").alias("gid"), F.col("rid").alias("other"), "r"))
    own = norms.select(F.col("item").alias("gid"), F.col("item").alias("other"), F.lit(1.0).alias("r"))
    members = groups.select(F.col("gid").alias("other"), F.explode("ids").alias("rid"))
    best = top_per_group(near.unionByName(own).join(members, "other").select("gid", "rid", "r"),
                         ["gid"], [F.desc("r"), F.asc("rid")], k + 1)
    entry = F.struct("rank", "rid", "r")
    lists = best.groupBy("gid").agg(F.array_sort(F.collect_list(entry)).alias("recs"))
    return lists.select("gid", F.transform("recs", lambda e: F.struct(e.rid.alias("rid"), e.r.alias("r")))
                        .alias("recs"))


def _to_members(bags: DataFrame, groups: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """Hand each group's list to its members, each without itself. Both sides are
    written, so that adaptive execution can split the members of a large group."""
    lists = materialize(groups.select("gid", "bag").join(lists, "gid").select("bag", "recs"), "group-lists")
    others = F.slice(F.filter("recs", lambda e: e.rid != F.col("product_id")), 1, k)
    return (bags.select("product_id", "bag").join(lists, "bag")
            .select("product_id", F.posexplode(others).alias("at", "rec"))
            .select("product_id", "rec.rid", "rec.r", (F.col("at") + 1).alias("rank")))
