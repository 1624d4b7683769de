"""Packing against the tokenizers library and a plain concatenation."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import EDGES
from tests.llm.test_operators import SF_DIR, needs_tables
from tastegraph.llm import packing
from tastegraph.llm.queries import op13_concat_and_cut

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def _packed(ids):
    return np.asarray(ids, dtype="<u4").tobytes()


def _check(pieces, expected, width):
    """`expected`: (doc_id, ids) of every row, repeats included."""
    ends, used = {}, {}
    for p in pieces:
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
        ends.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    assert sorted(used) == list(range(len(used)))
    for sequence, parts in used.items():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        full = sum(n for _, n in parts)
        assert full == width or sequence == len(used) - 1 and 0 < full < width
    wanted = {}
    for doc_id, ids in expected:
        wanted.setdefault(doc_id, []).append(ids)
    assert set(ends) == set(wanted)
    for doc_id, copies in wanted.items():
        assert sum(n for _, n, _, _ in ends[doc_id]) == sum(map(len, copies))
        for start, n, crc, total in ends[doc_id]:
            assert any(len(ids) == total and zlib.crc32(_packed(ids[start:start + n])) == crc for ids in copies)


@needs_tables
def test_query_lays_every_id_once(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    _check(op13_concat_and_cut(spark, SF_DIR).collect(), [(r.doc_id, library(r.text)) for r in docs.collect()], 2048)


@pytest.mark.parametrize("width", [1, 7, 2048])
def test_edges(spark, edges, clashing, no_docs, library, width):
    expected = [(r[0], library(r[1])) for r in EDGES if width > 1 or len(r[1] or "") < 1000]
    short = F.lit(True) if width > 1 else F.length(F.coalesce("text", F.lit(""))) < 1000
    for docs in (edges, clashing):
        found = packing.pack(docs.where(short).repartition(3), TOKENIZER, 1, width)
        _check(found.collect(), expected, width)
    assert packing.pack(no_docs, TOKENIZER, 1, width).collect() == []


def test_sequences_hold_the_ids(spark, edges, library):
    rows = packing.placed(packing.encode_in_place(edges.repartition(5), TOKENIZER, 1))
    rows = packing.written(rows, "placed")
    found = {r.sequence_id: r for r in packing.sequences(rows, 64, 9).collect()}
    whole = b"".join(bytes(r.ids) for r in sorted(rows.collect(), key=lambda r: r.position))
    assert sorted(found) == list(range(-(-len(whole) // 256)))
    assert all(len(r.ids) == 256 for r in found.values())
    assert b"".join(bytes(found[i].ids[:4 * found[i].n_tokens]) for i in sorted(found)) == whole
    last = found[len(found) - 1]
    assert set(np.frombuffer(last.ids, "<u4")[last.n_tokens:].tolist()) <= {9}
    assert len(whole) == 4 * sum(len(library(r[1])) for r in EDGES)


def test_ids_equal_the_library(library):
    encode = packing.text_encoder(TOKENIZER)
    texts = ["<|endoftext|> a<|endoftext|>", "don't  stop\n\n now", " \t\n", "漢字 ŕ x", "a" * 30_000, " " * 30_000 + "x",
             "x " * 9000 + "é" * 5000, "   x　", "'S 's'll", "1234567890 ½ ²"]
    for text in texts:
        assert encode(text) == _packed(library(text)[:-1]), text[:20]


def test_prefix_sums_over_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEVEL", 3)
    totals = spark.range(0, 40, 2).select(F.col("id").alias("part"), (F.col("id") + 1).alias("n"))
    found = {r.part: r.base for r in packing.prefix_sums(totals, "part", "n").collect()}
    assert found == {k: sum(j + 1 for j in range(0, k, 2)) for k in range(0, 40, 2)}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        packing.text_encoder(public_tokenizers.path("word_bpe_49k.json"))
