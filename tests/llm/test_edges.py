"""Nulls, empty and long texts, repeats, empty tables, clashing names: every
operator gives one defined row per row and is not moved by other columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import bpe, language, licences, mixing, repeats, secrets, surrogates
from tastegraph.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from tastegraph.llm.simhash import drop_near_duplicates, simhash_groups

from tests.llm.conftest import EDGES, by_row

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _language(docs):
    return language.identify(docs, language.fit(language.labelled_sample(docs)))


def _licences(docs):
    return licences.detect(docs.withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))))


def _mixed(docs):
    return mixing.mix(docs, mixing.word_count(F.col("text")), entropy=0.9, max_repeats=3.0).select("doc_id", "source", "epoch")


OPERATORS = {
    "surrogates": lambda d: surrogates.replace_entities(d, b"key").select("doc_id", "text", "n_entities"),
    "secrets": lambda d: secrets.digest(secrets.find_secrets(d)),
    "language": _language,
    "simhash": lambda d: simhash_groups(d, 3, 2).select("doc_id", "fingerprint", "component_id", "text_sha256"),
    "licences": _licences,
    "exact": lambda d: exact_duplicates(d).select("doc_id", "keep_id", "group_size", "text_sha256"),
    "mixing": _mixed,
    "repeats": lambda d: repeats.digest(repeats.remove_repeats(d)),
    "bpe": lambda d: bpe.decode(bpe.encode(d, TOKENIZER), TOKENIZER),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(edges, clashing, no_docs, name):
    plain = OPERATORS[name](edges)
    rows = by_row(plain, *plain.columns)
    assert len(rows) >= len(EDGES) if name == "mixing" else len(rows) == len(EDGES)
    other = OPERATORS[name](clashing)
    assert by_row(other, *plain.columns) == rows
    nothing = OPERATORS[name](no_docs)
    assert nothing.columns == plain.columns and nothing.count() == 0


def test_stages_keep_columns(clashing, no_docs):
    for keep in (drop_exact_duplicates, lambda d: drop_near_duplicates(d, 3, 2),
                 lambda d: mixing.take(d, mixing.mix(d, mixing.word_count(F.col("text"))))):
        kept = keep(clashing)
        assert kept.columns == clashing.columns and 0 < kept.count() <= len(EDGES)
        assert keep(no_docs).count() == 0


def test_defined_results(edges):
    exact = {r.doc_id: r for r in exact_duplicates(edges).collect() if r.doc_id is not None}
    assert exact[5].keep_id == 5 and exact[5].group_size == 4 and exact[1].keep_id == 3
    assert exact_duplicates(edges).where("kept").count() == len({(r[1] or "").lower() for r in EDGES})
    prints = {r.doc_id: r for r in simhash_groups(edges, 3, 2).collect() if r.doc_id is not None}
    assert prints[1].fingerprint == "0" * 16 and {prints[i].component_id for i in (1, 2, 3, 9)} == {1}
    assert prints[7].component_id == 6 and sum(r.kept for r in simhash_groups(edges, 3, 2).collect()) == 8
    found = _language(edges).collect()
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 3, 8, 9)} == {"und"}
    assert all(0 <= r.score <= 1 for r in found)
    spans = {r.doc_id: r for r in secrets.digest(secrets.find_secrets(edges)).collect()}
    assert spans[1].spans == "" and spans[1].n_hex == 0
    cleaned = {r.doc_id: r for r in repeats.digest(repeats.remove_repeats(edges)).collect()}
    assert cleaned[7].n_removed == cleaned[7].n_bytes and cleaned[7].n_spans == 1 and cleaned[1].n_bytes == 0
    assert cleaned[10].n_removed == 100_000 - 2  # all but its first string, which is even, and an odd start
    tokens = {r.doc_id: r for r in bpe.decode(bpe.encode(edges, TOKENIZER), TOKENIZER).collect()}
    assert tokens[1].n_tokens == 0 and tokens[1].decoded == "" and tokens[11].decoded == EDGES[13][1]
