"""The stages on a small corpus, step by step."""

import re
from collections import Counter

from tastegraph.llm import mixing
from tests.llm.test_operators import SF_DIR, Sets, _fingerprint, needs_tables

import corpus_pipeline
from pyspark.sql import functions as F


@needs_tables
def test_stages(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame([(90001, "12345 --- !!!", "en", "src1", 13), (90002, None, "en", "src1", 0)], documents.schema)
    docs = documents.union(extra)
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == columns
        after = {r.doc_id: r for r in kept.collect()}
        assert all(after[i] == before[i] for i in after)
        if name == "language_id":
            assert set(before) - set(after) == {90001, 90002}
        elif name == "exact_dedup":
            best = {}
            for i, r in before.items():
                key = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
                best[key] = max(best.get(key, -1), i)
            assert set(after) == set(best.values())
        elif name == "simhash_near_dedup":
            prints, sets = {i: _fingerprint(r.text) for i, r in before.items()}, Sets(before)
            for a in before:
                for b in before:
                    if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                        sets.join(a, b)
            assert set(after) == {sets.find(i) for i in before}
        else:
            assert set(after) == set(before)
        before = after
    tokens = corpus_pipeline.encode(spark, kept, SF_DIR)
    assert tokens.columns == [*sorted(columns, key=["doc_id", "text", *columns].index), "n_tokens", "ids"]
    rows = tokens.collect()
    assert len(rows) == kept.count() and all(r.text == before[r.doc_id].text and len(r.ids) == 4 * r.n_tokens > 0 for r in rows)


@needs_tables
def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.count() > 150 and found.where(F.col("n_tokens") > 0).count() == found.count()


def test_columns_named_like_the_stages_own(spark, clashing):
    """Extra columns come through every stage; of the results' names, only those
    of the last stage are taken."""
    own = ["_language", "_score", "_phrase_symbols", "_ids", "_hash", "_kept_id", "_taken_source", "_copies"]
    docs = clashing.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in own})
    before = {r.doc_id: r for r in docs.where("doc_id not in (4, 5)").collect()}
    kept = corpus_pipeline.language_id(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert all(r == before[r.doc_id] for r in kept.where("doc_id not in (4, 5)").collect())
    tokens = corpus_pipeline.encode(spark, docs, SF_DIR)
    others = [c for c in docs.columns if c not in ("text", "n_tokens", "ids")]
    for r in tokens.where("doc_id not in (4, 5)").collect():
        assert all(r[c] == before[r.doc_id][c] for c in others) and r.text == (before[r.doc_id].text or "")
        assert len(r.ids) == 4 * r.n_tokens


def test_taken_rows_keep_their_source(spark):
    rows = [(1, "one text", "s1", "en"), (1, "one text", "s2", "fr"), (2, "two words more", "s1", "en"), (3, "x", None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")), entropy=0.9, max_repeats=3.0)
    found = Counter((r.doc_id, r.source) for r in mixing.take(docs, mixed).collect())
    assert found == Counter((r.doc_id, r.source) for r in mixed.collect()) and set(found) == {(r[0], r[2]) for r in rows}
    assert {(r.source, r.lang) for r in mixing.take(docs, mixed).collect()} == {(r[2], r[3]) for r in rows}
