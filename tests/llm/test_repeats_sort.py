"""Suffix sorting of the segments that meet."""

import numpy as np

from tastegraph.llm import repeats


def _by_definition(symbols, length):
    keys = [tuple(symbols[i:i + length]) for i in range(len(symbols))]
    order = sorted(range(len(symbols)), key=lambda i: keys[i])
    return [keys[i] for i in order], [n > 0 and keys[order[n - 1]] == keys[i] for n, i in enumerate(order)]


def test_order_and_shared_prefixes():
    chance = np.random.default_rng(5)
    passage = chance.integers(1, 4, 60)
    parts = [passage, chance.integers(1, 4, 30), passage[10:], np.full(40, 2), passage, np.full(45, 2)]
    symbols = np.concatenate([np.r_[p, 0] for p in parts])
    for length in (8, 20, 33):
        order, shares = repeats.shared_prefixes(symbols, length)
        keys, expected = _by_definition(symbols.tolist(), length)
        assert [tuple(symbols[i:i + length].tolist()) for i in order] == keys
        # Strings across a separator may count as shared or not: no caller looks at them.
        inside = [0 not in key and len(key) == length for key in keys]
        assert [s for s, own in zip(shares.tolist(), inside) if own] == [s for s, own in zip(expected, inside) if own]


def test_suffixes_unlike_all_others_are_sorted_once(monkeypatch):
    symbols = np.r_[np.random.default_rng(6).integers(1, 200, 20_000), 0]
    sorted_keys, argsort = [], np.argsort

    def counted(keys, *args, **more):
        sorted_keys.append(len(keys))
        return argsort(keys, *args, **more)

    monkeypatch.setattr(np, "argsort", counted)
    _, shares = repeats.shared_prefixes(symbols, 100)
    assert not shares.any() and sum(sorted_keys) < 4 * len(symbols)
