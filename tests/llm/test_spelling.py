"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest


from tests.llm.conftest import EDGES
from tests.llm.test_operators import SF_DIR, needs_tables
from tastegraph.llm import spelling
from tastegraph.llm.queries import op11_variable_grams

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _words(docs, shortest=5, least=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def _expected(words):
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    rows = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(rows, key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def _syllables(seed, count, parts):
    chance = random.Random(seed)
    words = set()
    while len(words) < count:
        words.add("".join(chance.choices(parts, k=chance.randint(1, 5))))
    for word in list(words):  # and their variants
        if chance.random() < 0.4:
            at, letter = chance.randrange(len(word)), chance.choice("aeiouéz")
            words.add(chance.choice((word[:at] + word[at + 1:], word[:at] + letter + word[at:],
                                     word[:at] + letter + word[at + 1:])))
    return {w: chance.randint(3, 40) for w in words if len(w) >= 2}


CORPORA = {
    "syllables": _syllables(1, 500, ["tion", "ent", "re", "on", "th", "é", "ara"]),
    "two letters": _syllables(2, 400, ["a", "b", "ab", "ba"]),
    "one letter": {"a" * n: 3 + 2 ** min(n, 20) for n in range(2, 90)},
    "long": {w: n for n, w in enumerate(["x" * 300 + "abc" * 30, "x" * 300 + "abc" * 29 + "abd", "x" * 301 + "abc" * 30,
                                         "y" + "x" * 300 + "abc" * 30, "x" * 63, "x" * 64, "x" * 65, "x" * 66], 3)},
    "none": {},
}


@pytest.mark.parametrize("corpus", CORPORA)
@pytest.mark.parametrize("settings", [{}, {"LEAST_FREQUENT": 2, "LIST_WORDS": 7, "CHUNK_PAIRS": 50},
                                      {"LEAST_FREQUENT": 5, "SHORTEST": 3, "LONGEST": 6, "WORD_ROWS": 40}])
def test_equals_all_pairs(spark, monkeypatch, corpus, settings):
    for name, value in settings.items():
        monkeypatch.setattr(spelling, name, value)
    words = CORPORA[corpus]
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert _found(spelling.spelling_variants(table)) == _expected(words)


def test_an_edit_changes_no_more_grams_than_the_bound():
    """For every edit of random words, those grams stay that the bound promises,
    with all that stands on their other side."""
    chance = random.Random(5)
    alphabet = b"abc"
    for shortest, longest in ((2, 3), (2, 4), (3, 6)):
        spelling.SHORTEST, spelling.LONGEST = shortest, longest
        try:
            words = [bytes(chance.choices(alphabet, (6, 3, 1), k=chance.randint(3, 12))) for _ in range(150)]
            counts = Counter(m[k:k + q] for m in (b"\1" + w + b"\2" for w in words)
                             for q in range(shortest, longest + 1) for k in range(len(m) - q + 1))
            grams = spelling.Grams({g: n for g, n in counts.items() if n > 12})
            for word in words:
                marked = b"\1" + word + b"\2"
                own = grams.cut(marked)
                least = len(own) - grams.bound(marked, own)
                edits = {word[:k] + word[k + 1:] for k in range(len(word))}
                edits |= {word[:k] + bytes([c]) + word[k + d:] for k in range(len(word) + 1) for c in alphabet for d in (0, 1)}
                for other in edits - {word}:
                    there = b"\1" + other + b"\2"
                    prefixes = {(there[s:e], there[:e]) for s, e in grams.cut(there)}
                    suffixes = {(there[s:e], there[s:]) for s, e in grams.cut(there)}
                    kept = sum((marked[s:e], marked[:e]) in prefixes or (marked[s:e], marked[s:]) in suffixes for s, e in own)
                    assert kept >= least
                    if least > 0:
                        assert grams.keys(word) & grams.keys(other)
        finally:
            spelling.SHORTEST, spelling.LONGEST = 2, 4


@needs_tables
def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = _found(op11_variable_grams(spark, SF_DIR))
    assert found == _expected(_words(docs)) and sum(r[4] > 0 for r in found) > 10 and any(r[1] for r in found)


def test_edges(spark, edges, clashing, no_docs):
    expected = _expected(_words([(r[0], r[1]) for r in EDGES], shortest=2, least=1))
    for docs in (edges, clashing):
        assert _found(spelling.spelling_variants(spelling.corpus_words(docs, 2, 1))) == expected
    nothing = spelling.spelling_variants(spelling.corpus_words(no_docs))
    assert nothing.columns == ["word", "form", "root", "n", "n_near", "form_n"] and nothing.count() == 0
    assert [t for _, t in nothing.dtypes] == ["string"] * 3 + ["bigint"] * 3


def test_words_are_the_runs_of_the_pattern(spark):
    texts = [(1, "×÷Üß aāb ÀBC-d e\u0085f g_h 1i"), (2, "漢abcÿZ")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.word: r.n for r in spelling.count_words(docs, 10**9).collect()}
    assert found == Counter(re.sub("[A-Z]", lambda m: m[0].lower(), w) for _, t in texts for w in RUN.findall(t))


def test_chains_of_forms_lead_to_their_end(spark):
    words = {"a" * 5 + "b" * k: 3 * 2 ** k for k in range(24)}
    found = {r.word: r for r in spelling.spelling_variants(
        spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    last = "a" * 5 + "b" * 23
    assert all(r.root == last for r in found.values()) and found[last].form is None

