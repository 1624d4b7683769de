"""Byte-pair encoding and decoding as streaming transducers.

Encoding reads a text piece by piece. Words are cut by the byte-level pattern
and each goes through a window: from the merge list follows how many bytes
behind a token boundary can still change it (the sufficient lookahead), so
tokens further left than that are emitted and forgotten, and a word that ends
within the lookahead is stable at once. Decoding turns ids back into bytes and keeps at most the three bytes
of an unfinished character. Memory depends on the vocabulary, not on the text.

Sufficient lookahead. Let more text arrive on the right. At every step of the
merging, there is a front left of which the pieces are the same with and
without it. The front passes a piece S only when S merges with its right
neighbour in one of the two runs and not in the other, by a rule (S, Y) where
Y is what the last passed piece T is in that run: Y begins with T, or is T. The
two rules are applied in the order of the merge list, so ranks rise along such
a chain. The longest chain in bytes bounds how far the front can come.

Defined results: a null or empty text has no ids and decodes to empty text;
bytes that are no UTF-8 decode to U+FFFD; ids outside the vocabulary raise.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tastegraph.llm.tables import map_batches

#: Characters of a text taken in at once.
SLICE = 1 << 16
#: Words, and pieces between spaces, remembered by a worker; of more, the older half is forgotten.
CACHE_WORDS = 25_000
CACHE_SPACED = 250_000
#: Words longer than this are not remembered.
LONG_WORD = 256

#: The byte-level word pattern.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                      r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: How a run of each kind goes on; of white space, the last one may belong to the next word.
RUNS = [regex.compile(p) for p in (r"\p{L}*", r"\p{N}*", r"[^\p{White_Space}\p{L}\p{N}]*",
                                   r"(?:\p{White_Space}+(?=\p{White_Space}))?")]
LETTERS, NUMBERS, OTHERS, SPACES = range(4)
#: White space that is neither space nor line end.
UNEVEN = re.compile(r"[^\S \n]")
#: Words whose cut may change when more text follows: an apostrophe and two letters.
OPEN_WORDS = 3


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself
    if printable in Latin-1, else the next free letter from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


#: Rank of a pair without a rule.
NO_RULE = 1 << 60


def token_bytes(spec: dict) -> dict[int, bytes]:
    """What each id stands for; all that decoding needs."""
    letters = byte_letters()
    tokens = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    return {t["id"]: t["content"].encode() for t in spec["added_tokens"]} | tokens


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


class Vocabulary:
    """A byte-level merge list from a tokenizer file, and its lookahead."""

    def __init__(self, path: str):
        spec = _read(path)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = token_bytes(spec)
        self.bytes = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.ranks, self.merged, born = {}, {}, {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            parts = merge.split(" ") if isinstance(merge, str) else merge
            left, right = (ids[t] for t in parts)
            if max(born.get(left, -1), born.get(right, -1)) >= rank:
                raise ValueError("a merge comes before the merges that make its parts")
            whole = ids["".join(parts)]
            self.ranks[left, right] = rank
            self.merged[rank] = whole
            self.parts.setdefault(whole, (left, right))
            born.setdefault(whole, rank)
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        reach: dict[int, int] = {}
        longest = max(map(len, self.tokens.values()))
        most = 0
        for left, right in self.ranks:  # in order
            piece, behind = right, len(self.tokens[right])
            while True:
                behind = max(behind, reach.get(piece, 0))
                if piece not in self.parts:
                    break
                piece = self.parts[piece][0]
            here = behind + len(self.tokens[left])
            reach[left] = max(reach.get(left, 0), here)
            most = max(most, here)
        return most + longest

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the first rule of the list that applies is
        applied where it does first from the left, and so on."""
        letters, rank, merged = self.bytes, self.ranks.get, self.merged
        ids = [letters[b] for b in word]
        ranks = [rank(pair, NO_RULE) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NO_RULE:
            at, whole = ranks.index(best), merged[best]
            ids[at:at + 2] = [whole]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((whole, ids[at + 1]), NO_RULE)
            if at:
                ranks[at - 1] = rank((ids[at - 1], whole), NO_RULE)
        return ids


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Window:
    """The transducer of one long run: takes bytes, gives ids once stable."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.waiting = vocabulary, b""

    def feed(self, data: bytes, last: bool = False) -> list[int]:
        out: list[int] = []
        reach = self.vocabulary.lookahead
        self.waiting += data
        if last and len(self.waiting) <= 2 * reach:
            rest, self.waiting = self.waiting, b""
            return self.vocabulary.merge(rest)
        while len(self.waiting) > 2 * reach or last and self.waiting:
            part = self.waiting[:4 * reach]
            whole = last and len(part) == len(self.waiting)
            done = 0
            for token in self.vocabulary.merge(part):
                end = done + len(self.vocabulary.tokens[token])
                if not whole and end > len(part) - reach:
                    break
                out.append(token)
                done = end
            self.waiting = self.waiting[done:]
        return out


class _Memory(dict):
    """What was worked out for the latest `limit` keys or so."""

    def __init__(self, work_out: Callable[[str], bytes], limit: int):
        super().__init__()
        self.work_out, self.limit, self.old = work_out, limit // 2, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.work_out(key)
        if len(key) <= LONG_WORD:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class Words:
    """Packed ids of words, and of what stands between two single spaces."""

    def __init__(self, vocabulary: Vocabulary, words: int = CACHE_WORDS, spaced: int = CACHE_SPACED):
        self.vocabulary = vocabulary
        self.words = _Memory(self._word, words)
        self.spaced = _Memory(self._spaced, spaced)

    def _word(self, word: str) -> bytes:
        return packed(_Window(self.vocabulary).feed(word.encode(), last=True))

    def _spaced(self, piece: str) -> bytes:
        if piece.isalpha():  # with its space, one word
            return self._word(" " + piece)
        return self.closed(piece if piece[0] == "\n" else " " + piece)

    def closed(self, text: str) -> bytes:
        """Of a text at whose ends no word goes on."""
        return b"".join(map(self.words.__getitem__, WORDS.findall(text)))

    def whole(self, text: str) -> bytes:
        """Of a text that is complete. Where single spaces and line ends are
        its only white space, and none at its ends, no word goes over them."""
        if (UNEVEN.search(text) or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
                or text[:1] in " \n" or text[-1] in " \n"):
            return self.closed(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.closed(first) + b"".join(map(self.spaced.__getitem__, rest))


class Encoder:
    """Takes a text in pieces, gives packed ids as soon as they are stable."""

    def __init__(self, words: Words):
        self.words = words
        self.special = words.vocabulary.special
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                   if self.special else r"(?!)")
        self.tail, self.run, self.window = "", None, None

    def feed(self, piece: str, last: bool = False) -> bytes:
        text, out, at = self.tail + piece, [], 0
        self.tail = ""
        for mark in self.marks.finditer(text):
            out += [self._segment(text[at:mark.start()], True), packed([self.special[mark.group()]])]
            at = mark.end()
        rest = text[at:] if at else text
        held = 0 if last else next((n for n in range(min(len(rest), max(map(len, self.special), default=1) - 1), 0, -1)
                                    if any(s.startswith(rest[-n:]) for s in self.special)), 0)
        out.append(self._segment(rest[:len(rest) - held] if held else rest, last))
        self.tail += rest[len(rest) - held:] if held else ""
        return b"".join(out)

    def _segment(self, text: str, last: bool) -> bytes:
        out = b""
        if self.run is not None:
            end = RUNS[self.run].match(text).end()
            if last and self.run == SPACES and end == len(text) - 1 and text.isspace():
                end = len(text)
            over = last or end < len(text) - (self.run == SPACES)
            out = packed(self.window.feed(text[:end].encode(), last=over))
            text = text[end:]
            if not over:
                self.tail = text
                return out
            self.run = self.window = None
        if last:
            return out + (self.words.whole(text) if text else b"")
        words = WORDS.findall(text)
        closed, kept = words[:-OPEN_WORDS], words[-OPEN_WORDS:]
        out += b"".join(map(self.words.words.__getitem__, closed))
        if kept and len(kept[-1]) > SLICE // 2:
            *closed, run = kept
            out += b"".join(map(self.words.words.__getitem__, closed))
            self.run = (SPACES if run.isspace() else LETTERS if regex.match(r" ?\p{L}", run)
                        else NUMBERS if regex.match(r" ?\p{N}", run) else OTHERS)
            taken = run[:-1] if self.run == SPACES else run
            self.window = _Window(self.words.vocabulary)
            self.tail = run[len(taken):]
            return out + packed(self.window.feed(taken.encode()))
        self.tail = "".join(kept)
        return out


def encode_text(words: Words, text: str) -> bytes:
    encoder = Encoder(words)
    return b"".join(encoder.feed(text[i:i + SLICE], last=i + SLICE >= len(text)) for i in range(0, len(text), SLICE))


class Decoder:
    """Takes ids in pieces, gives text; holds back an unfinished character."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.waiting = tokens, b""

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        data = self.waiting + b"".join(map(self.tokens.__getitem__, ids))
        cut = len(data)
        if not last:
            for back in range(1, min(3, len(data)) + 1):
                lead = data[-back]
                if lead >= 0xC0:  # needs 2, 3 or 4 bytes
                    if back < 2 + (lead >= 0xE0) + (lead >= 0xF0):
                        cut -= back
                    break
                if lead < 0x80:
                    break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")


def decode_ids(tokens: dict[int, bytes], ids: bytes) -> str:
    numbers, decoder = np.frombuffer(ids, dtype="<u4"), Decoder(tokens)
    if len(numbers) <= SLICE:
        return decoder.feed(numbers.tolist(), last=True)
    return "".join(decoder.feed(numbers[i:i + SLICE].tolist(), last=i + SLICE >= len(numbers))
                   for i in range(0, len(numbers), SLICE))


@lru_cache
def _words(path: str, words: int, spaced: int) -> Words:
    """One vocabulary and one memory of words for a worker process."""
    return Words(Vocabulary(path), words, spaced)


@lru_cache
def _tokens(path: str) -> dict[int, bytes]:
    """A worker that only decodes holds no merges and no words."""
    return token_bytes(_read(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = (), words: int = CACHE_WORDS, spaced: int = CACHE_SPACED) -> DataFrame:
    """One row per row of `docs`: the id, the columns to carry, `n_tokens` and
    `ids`, the ids as little-endian unsigned 32-bit integers. `path` is the
    tokenizer file on every machine; strings of special tokens in a text become
    these tokens. Carried columns named like a result give way to it. `words` and
    `spaced` say how much a worker remembers: more is quicker and takes memory."""
    kept = [id_col, *(c for c in carry if c not in ("n_tokens", "ids"))]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        known = _words(path, words, spaced)
        ids = [encode_text(known, t) if t else b"" for t in rows.column(len(kept)).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*rows.columns[:-1], pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
            names=[*kept, "n_tokens", "ids"])

    return map_batches(docs.select(*kept, text_col), batch, f"{schema}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """`encoded` with its ids turned back into text, in place of `ids_col`."""
    kept = [c for c in encoded.columns if c not in (ids_col, to)]
    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        tokens = _tokens(path)
        texts = [decode_ids(tokens, i) if i else "" for i in rows.column(len(kept)).to_pylist()]
        return pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(texts, pa.string())], names=[*kept, to])

    return map_batches(encoded.select(*kept, ids_col), batch, f"{schema}, `{to}` string")
