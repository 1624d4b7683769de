"""Spelling variants: words one edit apart, found by a variable-length gram index.

The gram dictionary starts from all grams of two letters and grows a gram by a
letter only while it is frequent, up to four, so that lists stay short: a gram
of the dictionary is rare, or as long as they get. A word, with a mark at either
end, is cut into the longest grams of the dictionary at every place, without
those that lie within another. From the dictionary follows, for every place of
an edit, which of the word's grams it can change: those across the place, those
to the left that end in what a longer gram might begin with, those to the right
that begin with what a longer gram might end in. The most at any place is the
word's bound: so many grams at most are not found again in a near word.

So two near words share a gram among the bound + 1 rarest of either, and only
these are indexed. An edit lies wholly to the left or to the right of a gram
that it leaves alone, so all on the gram's other side is shared as well, and a
gram's list is split by that. Lists too long for one task are cut into blocks
that meet pair by pair. What meets is filtered by the letters two words have and
verified letter by letter. Words with no more grams than their bound, which are
short, keep all their grams; for two of these the index promises nothing, and
they also meet by what one deletion leaves of them.

Defined results: a null text has no words; a null id is empty text in front of
the colon; rows that repeat count each time.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tastegraph.llm.tables import group_numbers, map_batches, numbered, small_batches, sorted_groups, written

#: Lengths of grams.
SHORTEST, LONGEST = 2, 4
#: A gram is frequent, and so grows, above this share of all places of grams.
#: So there are at most 1 / SHARE frequent grams of each length.
SHARE, LEAST_FREQUENT = 1 / 20_000, 20
#: Words of one list that meet in one task.
LIST_WORDS = 4_096
#: Pairs compared at a time, and distinct words counted up before they are handed on.
CHUNK_PAIRS, COUNTED_WORDS = 1_000_000, 300_000
#: Rows of lists handed to a Python worker at once: they are short.
WORD_ROWS = 16_384
#: Longer words are compared one by one.
WIDE = 64

#: Of each byte of Latin-1: itself if it is one of A-Z, a-z, U+00C0 to U+00FF, A-Z as a-z; else blank.
_RUNS = bytes(b if b >= 0xC0 or chr(b).isalpha() and b < 0x80 else 0x20 for b in range(256)).lower()
_FIRST, _LAST = b"\x01", b"\x02"


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def text_runs(text: str | None) -> list[bytes]:
    """The runs of a text, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_RUNS).split() if text else []


def count_words(docs: DataFrame, modulus: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all documents; a run whose checksum with its document's id
    is divisible by `modulus` counts without one of its letters."""
    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = text_runs(text)
                counts.update(runs)
                base = zlib.crc32(f"{name or ''}:".encode())
                for run in set(runs):
                    h = zlib.crc32(run if run.isascii() else _utf8(run), base)
                    if h % modulus == 0:
                        times, at = runs.count(run), h % len(run)
                        counts[run] -= times
                        counts[run[:at] + run[at + 1:]] += times
            if len(counts) >= COUNTED_WORDS:
                yield emit(counts)
                counts = Counter()
        if counts:
            yield emit(counts)

    small_batches(docs)
    counted = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(over, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Grams:
    """The gram dictionary: its frequent grams, which tell all else."""

    def __init__(self, frequent: dict[bytes, int]):
        self.frequency = frequent
        self.growing = {g for g in frequent if len(g) < LONGEST}
        self.ends = {g[k:] for g in self.growing for k in range(1, len(g))}

    def cut(self, word: bytes) -> list[tuple[int, int]]:
        """Start and end of the grams of a marked word."""
        found, reached, size = [], 0, len(word)
        for start in range(size - SHORTEST + 1):
            end = start + SHORTEST
            while end < size and end - start < LONGEST and word[start:end] in self.growing:
                end += 1
            if end > reached:
                found.append((start, end))
                reached = end
        return found

    def bound(self, word: bytes, grams: list[tuple[int, int]]) -> int:
        """The most grams that one edit of the word can change."""
        size, most = len(word), 0
        # From where on grams left of a place can change, up to where right of it.
        from_left, to_right = list(range(size + 1)), list(range(size + 1))
        for at in range(1, size):
            for start in range(max(0, at - LONGEST + 1), at):
                if at - start < SHORTEST or word[start:at] in self.growing:
                    from_left[at] = start
                    break
            for end in range(min(size, at + LONGEST - 1), at, -1):
                if end - at < SHORTEST or word[at:end - 1] in self.ends:
                    to_right[at] = end
                    break
        starts, ends = [g[0] for g in grams], [g[1] for g in grams]
        for at in range(1, size):  # before the letter at `at`, or that letter itself
            first = min(bisect_left(starts, from_left[at]), bisect_right(ends, at))
            for right in (at, at + 1) if at < size - 1 else (at,):
                last = max(bisect_right(ends, to_right[right]), bisect_left(starts, right))
                most = max(most, last - first)
        return most

    def keys(self, word: bytes) -> set[int]:
        """Hashes of what the word is indexed under."""
        marked = _FIRST + word + _LAST
        grams = self.cut(marked)
        bound = self.bound(marked, grams)
        if bound < len(grams):
            rank = self.frequency.get
            # Of the rarest grams that two words share and no edit changed, the first from the left has
            # only changed ones before it in either word: so it is among the first bound + 1 of both.
            grams = sorted(grams, key=lambda g: (rank(marked[g[0]:g[1]], 0), marked[g[0]:g[1]], g))[:bound + 1]
            found = set()
        else:
            found = {xxhash.xxh64_intdigest(b"\x00" + v) for v in
                     {word, *(word[:k] + word[k + 1:] for k in range(len(word)))}}
        for start, end in grams:
            found.add(xxhash.xxh64_intdigest(marked[:end]))
            found.add(xxhash.xxh64_intdigest(marked[start:]))
        return found


def frequent_grams(words: DataFrame) -> Grams:
    """Counted over distinct words; few enough for every task by SHARE."""
    places = words.agg(F.coalesce(F.sum(F.length("word") + 2), F.lit(0))).first()[0]

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for word in rows.column(0).to_pylist():
            marked = _FIRST + word.encode("latin-1") + _LAST
            counts.update({marked[k:k + size] for size in range(SHORTEST, LONGEST + 1)
                           for k in range(len(marked) - size + 1)})
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                          names=["gram", "n"])

    counted = (map_batches(words.select("word"), batch, "gram binary, n long").groupBy("gram").agg(F.sum("n").alias("n"))
               .where(F.col("n") > max(LEAST_FREQUENT, int(places * SHARE))))
    return Grams({bytes(r.gram): r.n for r in counted.toLocalIterator()})


def _index(words: DataFrame, grams: Grams) -> DataFrame:
    """(key, id, word, n): every word under each of its keys."""
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        keys = [grams.keys(w.encode("latin-1")) for w in rows.column(1).to_pylist()]
        row = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
        flat = np.array([k for some in keys for k in some], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(flat), *(rows.column(c).take(row) for c in range(3))],
                                          names=["key", "id", "word", "n"])

    return written(map_batches(words.select("id", "word", "n"), batch, "key long, id long, word string, n long"), "grams")


def _lists(index: DataFrame) -> DataFrame:
    """The index without words that are alone under a key, sorted by list; of a
    long list, every pair of its blocks is a list of its own (`cell`)."""
    shared = written(index.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                     .select("key", F.ceil(F.col("m") / LIST_WORDS).cast("int").alias("blocks")), "lists")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: (
        F.least("block", other) * F.col("blocks") + F.greatest("block", other)))
    dealt = (index.join(shared, "key").withColumn("block", block).withColumn("cell", F.explode(cells))
             .select("key", "cell", "block", "id", "word", "n"))
    return dealt.repartition("key", "cell").sortWithinPartitions("key", "cell", "block")


def _one_edit(a: bytes, b: bytes) -> bool:
    if len(a) > len(b):
        a, b = b, a
    same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and len(b) - len(a) <= 1 and a[same + (len(a) == len(b)):] == b[same + 1:]


class _Words:
    """Words of some lists, letters as a matrix."""

    def __init__(self, words: list[str]):
        self.bytes = [w.encode("latin-1") for w in words]
        self.size = np.array([len(w) for w in words], dtype=np.int32)
        width = min(WIDE, int(self.size.max())) + 2
        cells = np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in self.bytes), dtype=np.uint8)
        self.letters = cells.reshape(-1, width)
        present = np.uint64(1) << (self.letters & 63).astype(np.uint64)
        self.bag = np.bitwise_or.reduce(np.where(self.letters == 0, np.uint64(0), present), axis=1)
        long = self.size > WIDE  # bags of the letters compared here only
        self.bag[long] = 0
        self.long = long

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs are one edit apart."""
        likely = (np.abs(self.size[a] - self.size[b]) <= 1)
        likely &= (np.bitwise_count(self.bag[a] ^ self.bag[b]) <= 2) | self.long[a] | self.long[b]
        at = np.flatnonzero(likely)
        a, b = a[at], b[at]
        swap = self.size[a] > self.size[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        short, tall = self.letters[a], self.letters[b]
        differs = short != tall
        equal = self.size[a] == self.size[b]
        good = equal & (np.count_nonzero(differs, axis=1) == 1)
        longer = np.flatnonzero(~equal)
        first = np.argmax(differs[longer], axis=1)[:, None]
        shifted = short[longer][:, :-1] == tall[longer][:, 1:]
        good[longer] = (shifted | (np.arange(shifted.shape[1]) < first)).all(axis=1)
        for k in np.flatnonzero(self.long[a] | self.long[b]):
            good[k] = _one_edit(self.bytes[a[k]], self.bytes[b[k]])
        return at[good]


def _pairs(group: np.ndarray, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs that meet, some at a time. Rows are sorted by group
    and block: in a group of one block every row meets those after it, in one of
    two blocks the rows of the first meet those of the second."""
    place = np.arange(len(group))
    end = np.searchsorted(group, group, side="right")
    # Where the block of the group's last row begins; the group itself, if it has one block.
    last = np.maximum.accumulate(np.where(np.concatenate([[True], (group[1:] != group[:-1]) | (block[1:] != block[:-1])]),
                                          place, 0))[end - 1]
    single = last == np.searchsorted(group, group, side="left")
    first = np.where(single, place + 1, np.maximum(last, place))
    partners = np.where(single | (place < last), end - first, 0)
    done = np.cumsum(partners)
    begin = 0
    while begin < len(group):
        base = done[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(done, base + CHUNK_PAIRS, side="right")))
        n = partners[begin:stop]
        if n.sum():
            a = np.repeat(place[begin:stop], n)
            yield a, first[a] + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        begin = stop


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lists in sorted_groups(iter(batches), 2):
        key, cell, block, ids, n = (lists.column(c).to_numpy() for c in ("key", "cell", "block", "id", "n"))
        words = lists.column("word")
        table = _Words(words.to_pylist())
        for a, b in _pairs(group_numbers(key, cell), block):
            found = table.near(a, b)
            a, b = a[found], b[found]
            if not len(a):
                continue
            left, right = np.concatenate([a, b]), np.concatenate([b, a])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[left]), pa.array(ids[right]), pa.array(n[right]),
                 words.take(pa.array(right)).combine_chunks()], names=["id", "near_id", "near_n", "near_word"])


def near_words(words: DataFrame, grams: Grams) -> DataFrame:
    """(id, near_id, near_n, near_word): all pairs one edit apart, both ways."""
    lists = _lists(_index(words, grams))
    small_batches(words, WORD_ROWS)
    found = lists.mapInArrow(_links, "id long, near_id long, near_n long, near_word string")
    # Words that meet under several keys.
    return found.groupBy("id", "near_id").agg(F.first("near_n").alias("near_n"), F.first("near_word").alias("near_word"))


def _last_forms(forms: DataFrame) -> DataFrame:
    """(id, last): where following forms ends, by doubling the way known. Every
    form is at least twice as frequent, so ways are short."""
    while True:
        ahead = forms.select(F.col("id").alias("last"), F.col("last").alias("further"))
        step = written(forms.join(ahead, "last", "left"), "forms")
        if step.where(F.col("further").isNotNull()).isEmpty():
            return step.select("id", "last")
        forms = step.select("id", F.coalesce("further", "last").alias("last"))


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, form, root, n_near, form_n) for a table (word, n) of distinct
    words in letters of Latin-1. `form`: the most frequent near word, of several
    the smallest, if it is `ratio` times as frequent at least."""
    words = numbered(words.select("word", "n"), "words", "id")
    near = near_words(words, frequent_grams(words))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word", "near_id")).alias("best")
    counted = written(words.join(near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best), "id", "left")
                      .withColumn("best", F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best"))), "near")
    forms = counted.where("best is not null").select("id", F.col("best.near_id").alias("last"))
    last = _last_forms(written(forms, "forms")).join(
        words.select(F.col("id").alias("last"), F.col("word").alias("last_word")), "last").select("id", "last_word")
    return counted.join(last, "id", "left").select(
        "word", F.col("best.near_word").alias("form"), F.coalesce("last_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.less")).alias("form_n"))


def corpus_words(docs: DataFrame, shortest: int = 5, least: int = 3, modulus: int = 97, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The words of the documents that are long and frequent enough."""
    counted = count_words(docs, modulus, id_col, text_col)
    return written(counted.where((F.length("word") >= shortest) & (F.col("n") >= least)), "corpus-words")
