"""How much a worker remembers of words can be chosen."""

import public_tokenizers

from tastegraph.llm import bpe


def test_the_memories_have_the_sizes_asked_for():
    words = bpe._words(public_tokenizers.path("byte_bpe_50k.json"), 10, 4)
    assert (words.words.limit, words.spaced.limit) == (5, 2)
    text = "ein kleiner Satz mit vielen kleinen Worten, ein Satz mit Worten " * 3
    large = bpe._words(public_tokenizers.path("byte_bpe_50k.json"), 1000, 1000)
    assert bpe.encode_text(words, text) == bpe.encode_text(large, text)
    assert len(words.spaced) + len(words.spaced.old) <= 4
