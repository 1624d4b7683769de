"""Language of a text by cross-parsing entropy.

For every language, a suffix automaton of labelled text recognises all its
substrings. A text is parsed greedily against each automaton: a phrase is the
longest match from where the last one ended. Phrases times the bits to point
into the reference, per symbol, estimate the cross entropy; the language with
the least wins. Texts are cut into segments and all segments of a batch step
through all automata together, one symbol at a time.

The model is fitted on a bounded sample of labelled rows (`sample_docs` of each
language, and of these `reference_chars` symbols at most) and broadcast; its size is
languages x reference_chars x 2 states x 64 symbols x 4 bytes at most.

Defined results: a null text or one without a letter is `und` with score 0;
ties go to the smaller language name; rows are judged one by one, repeats too;
null labels and ids teach nothing; without labelled rows all texts are `und`.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.llm.tables import map_batches

#: Labelled rows of each language in the sample, at most.
SAMPLE_DOCS = 64
#: Symbols of each language's reference, at most; of one row, a sixteenth at most.
REFERENCE_CHARS = 40_000
#: Symbols after which parsing starts anew.
SEGMENT = 1024
#: Symbols: space, a letter no reference has, frequent letters, and shared ones.
SPACE, UNKNOWN, OWN, SHARED = 0, 1, 44, 18
SYMBOLS = 2 + OWN + SHARED
UNDETERMINED = "und"
#: Phrases of fewer symbols on average show that no learned language fits.
LEAST_PHRASE = 2.0
RESULT = ("lang_pred", "score", "phrase_symbols")


def suffix_automaton(symbols: list[int]) -> np.ndarray:
    """Transitions of the smallest automaton of all substrings, a row a state
    and a column a symbol; -1 where there is none. State 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        state = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in nexts[at]:
            nexts[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = nexts[at][symbol]
            if length[target] != length[at] + 1:
                copy = len(nexts)
                nexts.append(dict(nexts[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and nexts[at].get(symbol) == target:
                    nexts[at][symbol] = copy
                    at = link[at]
                link[target] = target = copy
            link[state] = target
        last = state
    table = np.full((len(nexts), SYMBOLS), -1, dtype=np.int32)
    for state, out in enumerate(nexts):
        table[state, list(out.keys())] = list(out.values())
    return table


@dataclass
class Model:
    """All automata in one table; `starts` are their first states, `bits` what
    it takes to point into each reference."""
    languages: list[str]
    symbol_of: np.ndarray
    table: np.ndarray
    starts: np.ndarray
    bits: np.ndarray


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _squeezed(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which symbols stay: of a run of spaces one, at the start of a text none."""
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[first] = SPACE
    return (symbols != SPACE) | (before != SPACE)


def fit(sample: list[tuple[str, str]], reference_chars: int = REFERENCE_CHARS) -> Model:
    """From (language, text) rows, in this order."""
    counts: Counter = Counter()
    for _, text in sample:
        counts.update(c for c in text.lower() if c.isalpha())
    symbol_of = np.zeros(0x110000, dtype=np.uint8)
    symbol_of[[c for c in range(0x110000) if chr(c).isalpha()]] = UNKNOWN
    for rank, (letter, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))):
        symbol_of[ord(letter)] = 2 + (rank if rank < OWN else OWN + ord(letter) % SHARED)
    languages, tables, starts, bits, states = sorted({lang for lang, _ in sample}), [], [], [], 0
    for language in languages:
        reference: list[int] = []
        for lang, text in sample:
            if lang == language and len(reference) < reference_chars:
                symbols = symbol_of[_codes(text)]
                symbols = symbols[_squeezed(symbols, np.zeros(min(1, len(symbols)), int))].tolist()
                reference += symbols[:min(reference_chars // 16, reference_chars - len(reference))] + [SPACE]
        table = suffix_automaton(reference)
        table[table >= 0] += states
        tables.append(table)
        starts.append(states)
        bits.append(np.log2(len(reference) + 1))
        states += len(table)
    return Model(languages, symbol_of, np.concatenate(tables) if tables else np.zeros((0, SYMBOLS), np.int32),
                 np.array(starts, np.int32), np.array(bits))


def phrases(model: Model, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of each segment in each language (languages x segments)."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    table = model.table.reshape(-1)
    again = model.table[model.starts]  # where a phrase that starts with a symbol leads
    again = np.where(again < 0, model.starts[:, None], again)
    state = np.repeat(model.starts[:, None], len(starts), axis=1)
    count = np.zeros(state.shape, dtype=np.int32)
    for step, n in enumerate(active):
        symbol = symbols[starts[:n] + step]
        following = table[state[:, :n] * np.int64(SYMBOLS) + symbol]
        ended = following < 0
        count[:, :n] += ended
        state[:, :n] = np.where(ended, again[:, symbol], following)
    count += state != model.starts[:, None]
    out = np.empty_like(count)
    out[:, order] = count
    return out


def judge(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
    """Language, score and mean symbols in a phrase for each text. The score
    is how much the best entropy undercuts the second, from 0 to 1."""
    codes = [_codes(t) if t else np.zeros(0, np.uint32) for t in texts]
    sizes = np.array([len(c) for c in codes])
    symbols = model.symbol_of[np.concatenate(codes)] if len(codes) else np.zeros(0, np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    letters = np.bincount(owner, weights=symbols != SPACE, minlength=len(texts))
    stay = _squeezed(symbols, (np.cumsum(sizes) - sizes)[sizes > 0])
    symbols, sizes = symbols[stay], np.bincount(owner[stay], minlength=len(texts))
    parts = -(-sizes // SEGMENT)
    text_of = np.repeat(np.arange(len(texts)), parts)
    place = np.arange(len(text_of)) - (np.cumsum(parts) - parts)[text_of]
    starts = (np.cumsum(sizes) - sizes)[text_of] + SEGMENT * place
    lengths = np.minimum(SEGMENT, sizes[text_of] - SEGMENT * place)
    sums = np.zeros((len(model.languages), len(texts)))
    if len(text_of) and model.languages:
        for row, found in zip(sums, phrases(model, symbols, starts, lengths)):
            row += np.bincount(text_of, weights=found, minlength=len(texts))
    languages, scores, means = [], [], []
    entropy = sums * model.bits[:, None] / np.maximum(sizes, 1)
    for i in range(len(texts)):
        if not letters[i] or not model.languages:
            languages.append(UNDETERMINED), scores.append(0.0), means.append(0.0)
            continue
        best = int(np.argmin(entropy[:, i]))
        rest = np.delete(entropy[:, i], best)
        languages.append(model.languages[best])
        scores.append(float(1 - entropy[best, i] / rest.min()) if len(rest) and rest.min() else float(not len(rest)))
        means.append(float(sizes[i] / sums[best, i]))
    return languages, scores, means


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that teach nothing; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """For each language, the row with the least hash in each of `sample_docs`
    buckets of rows: bounded, spread over the table, the same in every run."""
    mixed = F.xxhash64(F.lit("sample"), F.col(id_col))
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
                       & ~held_out(id_col))
            .select(F.col(lang_col).cast("string").alias("lang"), F.pmod(mixed, F.lit(sample_docs)).alias("bucket"),
                    F.struct(mixed.alias("hash"), F.col(id_col).alias("id")).alias("order"),
                    F.substring(F.col(text_col), 1, REFERENCE_CHARS).alias("text"))
            .groupBy("lang", "bucket").agg(F.min(F.struct("order", "text")).alias("first")).collect())
    return sorted(((r["lang"], r["first"]["text"]) for r in sorted(rows, key=lambda r: (r["lang"], r["bucket"]))),
                  key=lambda x: x[0])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = (), names: tuple[str, str, str] = RESULT) -> DataFrame:
    """One row per row of `docs`: the id, the columns to carry, and under
    `names` the language, the score and the mean length of a phrase. Carried
    columns named like a result give way to it."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    kept = [id_col, *(c for c in carry if c not in names)]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(known.value, rows.column(columns.index(text_col)).to_pylist())
        return pa.RecordBatch.from_arrays(
            [*rows.columns[:len(kept)], pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()),
             pa.array(found[2], pa.float64())], names=[*kept, *names])

    columns = kept if text_col in kept else [*kept, text_col]  # the text travels once
    return map_batches(docs.select(*columns), batch,
                       f"{schema}, `{names[0]}` string, `{names[1]}` double, `{names[2]}` double")


def rejected(identified: Column, phrase_symbols: Column) -> Column:
    """Whether a text is in no learned language."""
    return (identified == UNDETERMINED) | (phrase_symbols < LEAST_PHRASE)
