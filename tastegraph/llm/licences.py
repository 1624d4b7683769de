"""Licences of files, from headers and by directory.

A first scan counts in how many texts of the corpus each word occurs. A second
cuts out header blocks: runs of lines that each hold at least two of the terms
of the notices; the whole text is one more block. Weights of all words but the
commonest are tf times ln((1 + texts) / (1 + texts with the word)) + 1. Templates
are notices and full texts of licences and span a small vocabulary, whose weights the scan knows; as no word weighs less
than 1, it also knows what cosine a block can have at most. The other words of
the blocks that may be like a template are joined with their counts for the
norm. A file whose whole text is like a template
licenses its directory, whatever its name, and is itself under the licence whose
full text it holds; files without a header
of their own inherit from the nearest directory above. A line with an SPDX tag is a
header that is its own template, at cosine 1, for each licence its expression
names, in any of the forms "-only", "-or-later" and "+"; it belongs to no block of
lines, and one that names no known licence says nothing.

Defined results: null and empty texts have no header and inherit; a null path
has no directory; ties go to the higher cosine, then to the licence first in
the alphabet; rows are judged one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from importlib.resources import files
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tastegraph.llm.tables import map_batches, numbered, written

#: What the statements of licences say.
TEMPLATES = {
    "AGPL-3.0": ["licensed under the GNU Affero General Public License, version 3",
                 "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "Released under the Simplified BSD License"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal", "dedicated to the public domain under CC0 1.0"],
    "GPL-2.0": ["licensed under the GNU General Public License, version 2",
                "under the terms of the GNU General Public License as published by the Free Software Foundation; version 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 3 of the License"],
    "ISC": ["Licensed under the ISC License",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"],
    "LGPL-3.0": ["licensed under the GNU Lesser General Public License, version 3"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
#: The full texts, one for each licence.
FULL_TEXTS = {licence: (files("tastegraph.llm") / "licence_texts" / f"{licence}.txt").read_text("utf-8") for licence in TEMPLATES}
#: Words that say nothing of a licence.
COMMON = set("a an and any are as at by can form file files for from in is it may not of or other that the this to use "
             "with without work you your code copy met either following all no on be".split())
WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: The tag and the forms of its identifiers.
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
SPDX_ID = re.compile(r"(?:(WITH)[\s()]+)?([a-z0-9][a-z0-9.-]*)", re.IGNORECASE)
SPDX_FORM = re.compile(r"(?:-only|-or-later)$")
LEAST_TERMS = 2
HEADER_COSINE = 0.6
FILE_COSINE = 0.6
BLOCKS = ("array<struct<kind:int,start:int,stop:int,licence:string,dot:double,square:double,"
          "others:array<struct<term:string,tf:int>>>>")
#: A header, a whole text most like a notice, a whole text most like a full text.
HEADER, WHOLE, FULL = range(3)


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


#: The terms of the notices, and those of all templates.
VOCABULARY = frozenset(w for texts in TEMPLATES.values() for t in texts for w in words(t)) - COMMON
TERMS = VOCABULARY.union(*(words(t) for t in FULL_TEXTS.values())) - COMMON


class Templates(NamedTuple):
    """A row of `weights` for each term, a column of length 1 for each template;
    templates in the order of their licences."""
    licences: list[str]
    full: list[bool]
    rows: dict[str, int]
    idf: np.ndarray
    weights: np.ndarray


def templates(idf: dict[str, float]) -> Templates:
    """With these weights of the terms. Fixed size."""
    found = [(licence, full, Counter(words(t))) for licence, texts in sorted(TEMPLATES.items())
             for full, t in [*((False, t) for t in texts), (True, FULL_TEXTS[licence])]]
    rows = {term: n for n, term in enumerate(sorted(idf))}
    known = np.array([idf[term] for term in rows])
    weights = np.array([[tf[term] for *_, tf in found] for term in rows]) * known[:, None]
    return Templates([licence for licence, *_ in found], [full for _, full, _ in found], rows, known, weights / np.linalg.norm(weights, axis=0))


def spdx_licences(line: str) -> list[str] | None:
    """The known licences that a line's SPDX tag names, in order; None without a
    tag. What follows WITH is an exception, no licence."""
    tag = SPDX.search(line)
    if not tag:
        return None
    known = {licence.lower(): licence for licence in TEMPLATES}
    named = [SPDX_FORM.sub("", m[2].lower()) for m in SPDX_ID.finditer(tag[1]) if not m[1]]
    return list(dict.fromkeys(known[n] for n in named if n in known))


def _block(text: str, start: int, stop: int, kind: int, like: Templates, least: float) -> dict | None:
    """None if its cosine can't be 0 < `least` or more. `square` is the square
    of the length that the terms of templates give, `others` the other words."""
    counts = Counter(w for w in words(text[start:stop]) if w not in COMMON)
    terms = [(like.rows[w], n) for w, n in sorted(counts.items()) if w in like.rows]
    row, tf = np.array(terms).reshape(-1, 2).T.astype(int)
    x = tf * like.idf[row]
    dots = np.round(x @ like.weights[row], 12)
    best, square = int(np.argmax(dots)), float(x @ x)
    others = [(w, n) for w, n in sorted(counts.items()) if w not in like.rows]
    at_most = dots[best] / np.sqrt(max(square + sum(n * n for _, n in others), 1e-9))
    if at_most <= 0 or at_most < least - 1e-6:
        return None
    if kind == WHOLE and like.full[best]:
        kind = FULL
    return {"kind": kind, "start": start, "stop": stop, "licence": like.licences[best], "dot": float(dots[best]),
            "square": square, "others": [{"term": w, "tf": n} for w, n in others]}


def scan_text(text: str, like: Templates, header_cosine: float, file_cosine: float) -> list[dict]:
    """The text's blocks that may be like a template: headers, in code points,
    and last the whole text."""
    if VOCABULARY.isdisjoint(words(text)):   # the tag of SPDX holds one of them
        return []
    blocks = []
    start = at = 0
    inside = False
    tagged = SPDX.search(text) is not None
    for line in text.splitlines(keepends=True):
        named = spdx_licences(line) if tagged else None
        blocks += [{"kind": HEADER, "start": at, "stop": at + len(line), "licence": licence, "dot": 1.0, "square": 1.0, "others": []}
                   for licence in named or ()]
        telling = named is None and len(VOCABULARY.intersection(words(line))) >= LEAST_TERMS
        if telling and not inside:
            start = at
        elif inside and not telling:
            blocks.append(_block(text, start, at, HEADER, like, header_cosine))
        inside = telling
        at += len(line)
    if inside:
        blocks.append(_block(text, start, at, HEADER, like, header_cosine))
    blocks.append(_block(text, 0, len(text), WHOLE, like, file_cosine))
    return [b for b in blocks if b]


def document_frequency(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, texts): in how many texts each word but the commonest occurs; how
    many texts there are, with a null term."""
    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        seen = Counter(w for t in rows.column(0).to_pylist() if t for w in set(words(t)) - COMMON)
        return pa.RecordBatch.from_arrays([pa.array([None, *seen], pa.string()), pa.array([rows.num_rows, *seen.values()], pa.int64())],
                                          names=["term", "texts"])

    return written(map_batches(docs.select(text_col), batch, "term string, texts long")
                   .groupBy("term").agg(F.sum("texts").alias("texts")), "document-frequency")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path",
           header_cosine: float = HEADER_COSINE, file_cosine: float = FILE_COSINE) -> DataFrame:
    """One row per row of `docs`: the id, the path, `licence`, `cosine`, `origin`
    (header, inherited or none), `from_dir` where inherited, and `headers`, all
    header blocks like a template (start, stop, licence, cosine)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    spark, frequency = docs.sparkSession, document_frequency(docs, text_col)
    texts = sum(r["texts"] for r in frequency.where("term is null").collect())
    idf = F.log(F.lit(1.0 + texts) / (1 + F.coalesce("texts", F.lit(0)))) + 1
    vocabulary = spark.createDataFrame([(w,) for w in sorted(TERMS)], "term string")
    counted = frequency.join(F.broadcast(vocabulary), "term", "left_semi")   # a fixed list of words
    like = templates({r["term"]: r["idf"] for r in
                      vocabulary.join(counted, "term", "left").select("term", idf.alias("idf")).collect()})

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        blocks = [scan_text(t, like, header_cosine, file_cosine) if t else [] for t in rows.column(2).to_pylist()]
        term = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int32())]))
        block = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("licence", pa.string()),
                                    ("dot", pa.float64()), ("square", pa.float64()), ("others", term)]))
        return pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(blocks, block)], names=["id", "path", "blocks"])

    scanned = numbered(map_batches(docs.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), text_col),
                                   batch, f"id {id_type}, path string, blocks {BLOCKS}"), "licence-scan")
    key = ["row_id", "block"]
    blocks = scanned.select("row_id", F.posexplode("blocks").alias("block", "b")).select(*key, "b.*")
    norms = (blocks.select(*key, F.inline("others")).join(frequency, "term", "left")
             .groupBy(key).agg(F.sum((F.col("tf") * idf) ** 2).alias("others")))
    cosine = F.round(F.col("dot") / F.sqrt(F.col("square") + F.coalesce(norms["others"], F.lit(0.0))), 9).alias("cosine")
    best = written(blocks.drop("others").join(norms, key, "left").select(*key, "kind", "start", "stop", "licence", cosine), "blocks")
    order = F.struct((-F.col("cosine")).alias("minus"), "licence")
    headers = (best.where((F.col("kind") == HEADER) & (F.col("cosine") >= header_cosine)).groupBy("row_id").agg(
        F.min(order).alias("header"), F.array_sort(F.collect_list(F.struct("start", "stop", "licence", "cosine"))).alias("headers")))
    whole = best.where((F.col("kind") != HEADER) & (F.col("cosine") >= file_cosine)).select(
        "row_id", F.col("licence").alias("file_licence"), F.col("cosine").alias("file_cosine"),
        F.when(F.col("kind") == FULL, order).alias("full"))
    directory = F.regexp_replace("path", r"/?[^/]*$", "")
    judged = written(
        scanned.select("row_id", "id", "path", directory.alias("dir")).join(headers, "row_id", "left")
        .join(whole, "row_id", "left").withColumn("header", F.coalesce("full", "header")).drop("full"), "judged")
    dirs = written(judged.where(F.col("file_licence").isNotNull() & F.col("dir").isNotNull()).groupBy(F.col("dir").alias("from_dir")).agg(
        F.min(F.struct((-F.col("file_cosine")).alias("minus"), F.col("file_licence").alias("licence"))).alias("given")), "dirs")
    # every directory with those above it, down from itself to the root, ""
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("from_dir")))
    inherited = written(
        judged.select("dir").where("dir is not null").distinct().withColumn("up", F.explode(above))
        .select("dir", "up.depth", "up.from_dir").join(dirs, "from_dir")
        .groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "given")).alias("nearest")), "inherited")
    own, nearest = F.col("header").isNotNull(), F.col("nearest.given")
    none = F.array().cast("array<struct<start:int,stop:int,licence:string,cosine:double>>")
    return judged.join(inherited, "dir", "left").select(
        F.col("id").alias(id_col), F.col("path").alias(path_col),
        F.when(own, F.col("header.licence")).otherwise(nearest["licence"]).alias("licence"),
        F.when(own, -F.col("header.minus")).otherwise(-nearest["minus"]).alias("cosine"),
        F.when(own, "header").when(nearest.isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~own, F.col("nearest.from_dir")).alias("from_dir"), F.coalesce("headers", none).alias("headers"))
