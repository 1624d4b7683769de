"""Personal data replaced by keyed surrogates.

A scan finds entities: e-mail addresses, telephone, card, account, social
security and network numbers, and names after a title, which are then found
without one in the same text too. Each distinct entity of the corpus gets one
surrogate of its own type, drawn from a keyed hash: digits stand for digits,
letters for letters of the same script, given names keep their gender, a card
number its check digit, a telephone number its country code. So the same entity
is replaced alike wherever it occurs, and however it is written there; a name is
one entity as a given name, a surname or alone. No two entities may share a
surrogate and no surrogate may be a real entity of the corpus: what collides is
drawn again, in rounds over the table of distinct entities, until nothing does;
a corpus with over half of all numbers of a type leaves no room and raises. The
surrogates then go back into the texts in the format found.

Defined results: null and empty texts stay as they are and have no entities;
rows with the same id and text are treated alike; a match within another is
part of it, matches that overlap otherwise become one run of characters, so that
no end of one stays; all other columns are kept.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tastegraph.llm.tables import map_batches, unused, written

#: Titles by the gender they tell.
TITLES = {"m": "Mr Mister Sir Herr Señor Sr Monsieur Господин".split(),
          "f": "Mrs Ms Miss Madam Lady Frau Fräulein Señora Señorita Sra Madame Mme Mademoiselle Госпожа".split(),
          "n": "Dr Prof Professor Доктор".split()}
GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
_TITLE = "|".join(sorted(GENDER, key=len, reverse=True))
_WORD = r"[^\W\d_][^\W\d_'’-]*(?:['’-][^\W\d_]+)*"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_LOCAL = re.compile(r"[\w.%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
#: In the order in which matches of one place and length are preferred; e-mail addresses go before them.
_PLAIN = {
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<!\w)[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?!\w)",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9])",
    "ipv6": r"(?<![\w:.])(?=[0-9A-Fa-f:]{5,39}(?![\w:]))[0-9A-Fa-f]{1,4}:[0-9A-Fa-f:]+",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<!\w)(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w)"
             r"|(?<!\w)\+[0-9]{1,3}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})){2,6}(?!\w)"
             r"|(?<![\w+.-])0[0-9]{1,4}(?P<gap>[ .-])[0-9]{2,4}(?:(?P=gap)[0-9]{2,4}){1,3}(?![\w-])"
             r"|(?<![\w-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-])",
}
#: From every place, so that an entity is found although another seems to begin before it.
PATTERNS = {kind: re.compile(f"(?=({plain}))") for kind, plain in _PLAIN.items()}
#: Fewest and most digits of a telephone number, where its pattern leaves them open.
PHONE_DIGITS = 9, 15
LEAST_GROUPS = 3  # of a shortened network number, since "a::b" stands in programs too
TITLED = re.compile(rf"\b({_TITLE})\b\.?(?=[ \t])")
NEXT_WORD = re.compile(rf"[ \t]+({_WORD})")
MOST_WORDS = 3  # of a name
NAME_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?:['’-][^\W\d_]+)*(?!\w)")
NAME_PART = re.compile(r"[^\W\d_]+")
#: Country codes of two digits; 1 and 7 have one, all others three.
TWO_DIGITS = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Only texts with one of these can hold an entity. Most letters begin none of them, which is seen at once.
POSSIBLE = rf"(?=[0-9@:{''.join(sorted({t[0] for t in GENDER}))}])(?:[0-9@]|::|{_TITLE})"
#: Letters of surrogate names by script: consonants, vowels, endings of given names.
SCRIPTS = {"LATIN": ("bdfglmnprstv", "aeiou", {"f": "a", "m": "o", "n": "e"}),
           "CYRILLIC": ("бвгдзклмнпрст", "аеиоу", {"f": "а", "m": "н", "n": "й"}),
           "GREEK": ("βγδζκλμνπρστ", "αεηιο", {"f": "α", "m": "ς", "n": "ι"})}
SHORT_NAME = 3
OCCURRENCE = "id string, tag long, start int, stop int, kind string, norm string, gender string"
MOST_ROUNDS = 64


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "").split(" ")[0]
    return name if name in SCRIPTS else "LATIN"


def _normal(kind: str, found: str) -> str:
    if kind in ("email", "name"):
        return found.lower()
    if kind == "ip":
        return found
    if kind == "ipv6":
        return ipaddress.IPv6Address(found).exploded
    return "+" * found.startswith("+") + "".join(c for c in found if c.isalnum())


def _emails(text: str) -> list[tuple[int, int]]:
    """From every @ to both sides, so that long runs without one cost nothing."""
    found, at, left = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > left and _LOCAL.match(text, start - 1):
            start -= 1
        while start < at and not (text[start].isalnum() or text[start] == "_"):
            start += 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            found.append((start, domain.end()))
        left = domain.end() if domain else at + 1
        at = text.find("@", left)
    return found


def _is_real(kind: str, found: str) -> bool:
    """What a pattern alone does not tell."""
    if kind == "phone":
        digits = sum(c.isdigit() for c in found)
        return found[0] not in "+0" or PHONE_DIGITS[0] - (found[0] == "+") <= digits <= PHONE_DIGITS[1]
    if kind == "ipv6":
        try:
            ipaddress.IPv6Address(found)
        except ValueError:
            return False
        return sum(map(bool, found.split(":"))) >= LEAST_GROUPS
    return True


def _titled_names(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, gender) of the words of names after a title: words with a
    capital, up to the next title. All but the last are given names, which have
    the title's gender."""
    found = []
    for title in TITLED.finditer(text):
        words, at = [], title.end()
        while len(words) < MOST_WORDS and (m := NEXT_WORD.match(text, at)) and m[1][0].isupper() and m[1] not in GENDER:
            words.append((m.start(1), m.end(1)))
            at = m.end()
        found += [(a, b, GENDER[title[1]] if n < len(words) - 1 else "") for n, (a, b) in enumerate(words)]
    return found


def find_entities(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, stop, kind, normal form, gender) without overlaps, in order. A
    name is found after its title, then wherever the same word stands."""
    found = [(start, stop, "email", "") for start, stop in _emails(text)]
    found += [(*m.span(1), kind, "") for kind, p in PATTERNS.items() for m in p.finditer(text) if _is_real(kind, m[1])]
    titled = _titled_names(text)
    found += [(start, stop, "name", gender) for start, stop, gender in titled]
    names = {text[start:stop] for start, stop, _ in titled if stop - start >= SHORT_NAME}
    if names:
        for word in NAME_WORD.finditer(text):
            if word[0] in names:
                found.append((word.start(), word.end(), "name", ""))
            else:
                found += [(m.start(), m.end(), "name", "") for m in NAME_PART.finditer(text, *word.span()) if m[0] in names]
    order = {kind: n for n, kind in enumerate(["email", *PATTERNS, "name"])}
    out: list[tuple[int, int, str, str, str]] = []
    for start, stop, kind, gender in sorted(set(found), key=lambda f: (f[0], -f[1], order[f[2]], -ord(f[3] or "\0"))):
        if not out or start >= out[-1][1]:
            out.append((start, stop, kind, _normal(kind, text[start:stop]), gender))
        elif stop > out[-1][1]:
            start = out.pop()[0]
            out.append((start, stop, "run", _normal("run", text[start:stop]), ""))
    return out


class _Drawn:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *what: str):
        self.key, self.what, self.block, self.left = key, "\0".join(what).encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.block.to_bytes(4, "big") + self.what, hashlib.sha256).digest()
            self.block += 1
        number, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return number % n

    def of(self, choices: str) -> str:
        return choices[self.below(len(choices))]


def _like(char: str, drawn: _Drawn) -> str:
    if char.isdigit():
        return drawn.of("0123456789")
    if char.isalpha():
        low = drawn.of("".join(SCRIPTS[_script(char)][:2]))
        return low.upper() if char.isupper() else low
    return char


def _luhn(digits: str) -> int:
    """What the last digit must add for the check sum to be a multiple of ten."""
    total = sum(d if i % 2 else (2 * d - 9 * (d > 4)) for i, d in enumerate(int(c) for c in reversed(digits)))
    return -total % 10


def _code_length(digits: str) -> int:
    return 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGITS else 3


def surrogate(key: bytes, kind: str, norm: str, gender: str, attempt: int) -> str:
    """The attempt-th surrogate of an entity, in normal form. Later attempts
    may be longer where the type allows it, so room never runs out."""
    drawn = _Drawn(key, kind, norm, str(attempt))
    grown = attempt // 4
    if kind == "email":
        local, domain = norm.split("@", 1)
        labels = domain.split(".")
        local = "".join(_like(c, drawn) for c in local) + "".join(drawn.of("bdfglmnprstv") for _ in range(grown))
        return local + "@" + ".".join(["".join(_like(c, drawn) for c in label) for label in labels[:-1]] + labels[-1:])
    if kind == "name":
        consonants, vowels, endings = SCRIPTS[_script(norm)]
        syllables = max(2, len(norm) // 2) + grown
        name = "".join(drawn.of(consonants) + drawn.of(vowels) for _ in range(syllables))
        return name[:-1] + endings[gender] if gender else name + drawn.of(consonants)
    if kind == "ip":
        octets = norm.split(".")
        kept = {"10": 1, "127": 1, "172": 2 if 16 <= int(octets[1]) < 32 else 0, "192": 2 if octets[1] == "168" else 0}
        n = kept.get(octets[0], 0) if attempt < 8 else 0
        return ".".join(octets[:n] + [str(1 + drawn.below(254)) for _ in octets[n:]])
    if kind == "ipv6":  # the first group and groups of zeros stay
        first, *groups = norm.split(":")
        return ":".join([first] + [g if g == "0000" else f"{1 + drawn.below(0xFFFF):04x}" for g in groups])
    if kind == "card":
        body = norm[0] + "".join(drawn.of("0123456789") for _ in norm[1:-1])
        valid = _luhn(norm[:-1]) == int(norm[-1])
        return body + (str(_luhn(body)) if valid else str((_luhn(body) + 1 + drawn.below(9)) % 10))
    if kind == "iban":
        body = "".join(_like(c, drawn) for c in norm[4:])
        checked = int("".join(str(int(c, 36)) for c in body + norm[:2])) * 100
        return f"{norm[:2]}{98 - checked % 97:02d}{body}"
    if kind == "phone":  # the country code stays, or the zero in front
        n = 1 + _code_length(norm[1:]) if norm[0] == "+" else int(norm[0] == "0")
        return norm[:n] + "".join(drawn.of("0123456789") for _ in norm[n:])
    return "".join(_like(c, drawn) for c in norm)


def rendered(kind: str, found: str, norm: str) -> str:
    """A surrogate in the format in which the entity was found."""
    if kind in ("email", "name"):
        if found.isupper():
            return norm.upper()
        return norm[:1].upper() + norm[1:] if found[:1].isupper() else norm
    if kind == "ip":
        return norm
    if kind == "ipv6":
        made = ipaddress.IPv6Address(norm).compressed if "::" in found else norm if len(found) == len(norm) else ":".join(
            f"{int(g, 16):x}" for g in norm.split(":"))
        return made.upper() if any(c.isupper() for c in found) else made
    letters = (c for c in norm if c.isalnum())
    return "".join(next(letters, "") if c.isalnum() else c for c in found)


def _drawn_table(entities: DataFrame, key: bytes) -> DataFrame:
    """`entities` (kind, norm, gender, attempt) with their surrogates."""
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        made = [surrogate(key, *r) for r in zip(*(c.to_pylist() for c in rows.columns))]
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(made, pa.string())],
                                          names=["kind", "norm", "gender", "attempt", "made"])

    return map_batches(entities.select("kind", "norm", "gender", "attempt"), batch,
                       "kind string, norm string, gender string, attempt int, made string")


def distinct_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, norm, made) for distinct (kind, norm, gender): no `made` twice in
    a kind, none that is a `norm`. Of those that collide, the one with the least
    hash keeps it; kept surrogates are never taken back."""
    kept: list[DataFrame] = []
    entities = written(entities, "entities")
    left = entities.withColumn("attempt", F.lit(0))
    real = entities.select("kind", F.col("norm").alias("made"))
    for _ in range(MOST_ROUNDS):
        drawn = written(_drawn_table(left, key), "drawn")
        taken = reduce(DataFrame.unionByName, [real, *(k.select("kind", "made") for k in kept)])
        first = drawn.groupBy("kind", "made").agg(F.min(F.struct(F.xxhash64("norm").alias("hash"), "norm")).alias("first"))
        free = written(first.join(taken, ["kind", "made"], "left_anti")
                       .select("kind", "made", F.col("first.norm").alias("norm")), "free")
        kept.append(free)
        left = written(drawn.join(free, ["kind", "norm"], "left_anti").withColumn("attempt", F.col("attempt") + 1), "left")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, kept)
    raise ValueError(f"no distinct surrogates in {MOST_ROUNDS} rounds")


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with surrogates in its texts, and `n_entities` and `entities`
    (start, stop in the old text, and kind) in place of columns so named."""
    docs = docs.drop("entities", "n_entities")
    possible = F.coalesce(F.col(text_col).rlike(POSSIBLE), F.lit(False))
    own_id, tag = F.col(id_col).cast("string"), F.xxhash64(text_col)
    candidates = docs.where(possible)
    found_id, found_tag, put_in = unused(docs, "_found_id", "_found_tag", "_spans")

    def scan(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        out = [(i, t, *e) for i, t, text in zip(*(c.to_pylist() for c in rows.columns)) for e in find_entities(text)]
        if not out:
            return None
        types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                          names=["id", "tag", "start", "stop", "kind", "norm", "gender"])

    found = written(map_batches(candidates.select(own_id.alias("id"), tag.alias("tag"), text_col), scan, OCCURRENCE)
                    .distinct(), "entities-found")
    has = {g: F.max(F.when(F.col("gender") == g, g)) for g in "fmn"}
    gender = F.when(has["f"].isNotNull() & has["m"].isNotNull(), "n").otherwise(F.coalesce(has["f"], has["m"], has["n"], F.lit("")))
    entities = found.groupBy("kind", "norm").agg(gender.alias("gender"))
    made = written(distinct_surrogates(entities, key), "surrogates")
    spans = written(found.join(made, ["kind", "norm"]).groupBy("id", "tag").agg(F.array_sort(F.collect_list(
        F.struct("start", "stop", "kind", "made"))).alias("spans")), "spans").toDF(found_id, found_tag, put_in)
    hit = candidates.join(spans, own_id.eqNullSafe(F.col(found_id)) & (tag == F.col(found_tag)), "left")
    kept = [c for c in docs.columns if c != text_col]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    span = "array<struct<start:int,stop:int,kind:string>>"

    def put(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts, entities = [], []
        for text, spans_here in zip(*(rows.column(k).to_pylist() for k in (-2, -1))):
            out, at = [], 0
            for s in spans_here or ():
                out += [text[at:s["start"]], rendered(s["kind"], text[s["start"]:s["stop"]], s["made"])]
                at = s["stop"]
            texts.append("".join(out) + text[at:])
            entities.append([{k: s[k] for k in ("start", "stop", "kind")} for s in spans_here or ()])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]))
        return pa.RecordBatch.from_arrays([*rows.columns[:-2], pa.array(texts, pa.string()), pa.array(entities, kind)],
                                          names=[*kept, text_col, "entities"])

    changed = map_batches(hit.select(*kept, text_col, put_in), put, f"{schema}{', ' if kept else ''}`{text_col}` string, entities {span}")
    rest = docs.where(~possible).select(*kept, text_col, F.array().cast(span).alias("entities"))
    return changed.unionByName(rest).withColumn("n_entities", F.size("entities").cast("long"))
