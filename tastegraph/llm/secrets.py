"""Secrets in texts, judged by how many repositories and owners share them.

A scan finds what looks like a secret: values assigned to a telling name,
access key ids, long runs of hex digits, and, as mere candidates, other long
mixed tokens. Only hashes of the values leave it. A hash's frequency over the
whole corpus, counted in distinct owners and repositories, tells a credential
from what everyone copies: an example key or a placeholder has many owners,
or very many repositories, a live one has its own. Mere candidates become
findings if one owner has them in few repositories.

Defined results: a null text counts as empty and has no spans; rows are judged
one by one, also if their id is null or repeats; a null owner or repository is
one like any other; repeats of a row add to no distinct count.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tastegraph.llm.tables import map_batches, numbered
from tastegraph.workspace import materialize

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN, ACCESS, HEX, OWNED = range(4)
#: The patterns, as they are matched from the left without overlap.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGNED = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                      re.IGNORECASE | re.ASCII)
#: A shorter run holds no longer one, so the least length can be in the pattern.
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX_RUN = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12
#: Other tokens: so long, of so many different characters, letters and digits mixed.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
LEAST_DIFFERENT = 10
#: From so many owners on, a value is a copied example.
EXAMPLE_OWNERS = 3
#: So it is from so many repositories on, even if one owner has them all.
EXAMPLE_REPOS = 100

FOUND = "array<struct<start:int,kind:int,stop:int,value:binary>>"


def _hash(value: str) -> bytes:
    return hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def scan_text(text: str) -> list[dict]:
    """Spans of all kinds in one text, in code points, end exclusive."""
    found: list[tuple[int, int, int, str]] = []
    lower = text.lower()
    if (":" in text or "=" in text) and any(name in lower for name in NAMES):
        found += [(m.start(), ASSIGN, m.end(), m[2]) for m in ASSIGNED.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), ACCESS, m.end(), m[0]) for m in ACCESS_KEY.finditer(text)]
    found += [(m.start(), HEX, m.end(), m[0]) for m in HEX_RUN.finditer(text)]
    sure = sorted((start, stop) for start, _, stop, _ in found)
    for m in TOKEN.finditer(text):
        token = m[0]
        if (len(set(token)) >= LEAST_DIFFERENT and any(c.isdigit() for c in token) and any(c.isalpha() for c in token)
                and not any(start < m.end() and m.start() < stop for start, stop in sure)):
            found.append((m.start(), OWNED, m.end(), token))
    return [{"start": s, "kind": k, "stop": e, "value": _hash(v)} for s, k, e, v in sorted(found)]


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"], s["stop"])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 repo_col: str = "doc_id", owner_col: str = "source",
                 example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """One row per row of `docs`: the id, `base` and `spans` (arrays of start,
    kind, stop; `base` by pattern alone, `spans` with the candidates that one
    owner has in few repositories), `judged` (start, kind, stop, repos, owners,
    verdict) where the verdict is example (`example_owners` or `example_repos` and
    more), live (one owner) or shared."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan_text(t) if t else [] for t in rows.column(3).to_pylist()]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()),
                                   ("value", pa.binary())]))
        return pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(found, kind)],
                                          names=["id", "repo", "owner", "found"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(repo_col).cast("string").alias("repo"),
                         F.col(owner_col).cast("string").alias("owner"), F.col(text_col))
    scanned = numbered(map_batches(picked, batch, f"id {id_type}, repo string, owner string, found {FOUND}"), "scanned")
    spans = scanned.select("row_id", "repo", "owner", F.inline("found"))
    frequency = materialize(
        spans.select("value", "owner", "repo").distinct()
        .groupBy("value", "owner").count()
        .groupBy("value").agg(F.sum("count").alias("repos"), F.count(F.lit(1)).alias("owners")), "frequency")
    copied = (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)
    verdict = F.when(copied, "example").when(F.col("owners") == 1, "live").otherwise("shared")
    judged = (spans.join(frequency, "value").withColumn("verdict", verdict)
              .where((F.col("kind") != OWNED) | (F.col("verdict") == "live"))
              .groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct(
                  "start", "kind", "stop", "repos", "owners", "verdict"))).alias("judged")))
    bare = lambda s: F.struct(s["start"], s["kind"], s["stop"])
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,repos:bigint,owners:bigint,verdict:string>>")
    return (scanned.select("row_id", "id", F.filter("found", lambda s: s["kind"] != OWNED).alias("base"))
            .join(judged, "row_id", "left")
            .select(F.col("id").alias(id_col), F.transform("base", bare).alias("base"),
                    F.transform(F.coalesce("judged", none), bare).alias("spans"),
                    F.coalesce("judged", none).alias("judged")))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, hash and list of spans, counts of verdicts, and how many owners and
    repositories the row's most widely copied value has, 0 without one."""
    def of(column: str, field: str, value: int | str) -> Column:
        return F.size(F.filter(column, lambda s: s[field] == value)).cast("long")

    return found.select(
        id_col,
        *(of("base", "kind", k).alias(f"n_{KINDS[k]}") for k in (ASSIGN, ACCESS, HEX)),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        of("judged", "kind", OWNED).alias("n_owned"),
        *(of("judged", "verdict", v).alias(f"n_{v}") for v in ("live", "shared", "example")),
        *(F.coalesce(F.array_max(F.transform("judged", lambda s: s[c])), F.lit(0)).cast("long").alias(f"most_{c}")
          for c in ("owners", "repos")))
