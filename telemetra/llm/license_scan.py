"""License scan: exact set-similarity join of text blocks with license templates.

A template is a set of words with a containment threshold t: a block matches if it holds at least a = ceil(t * n) of
the template's n words. Blocks of a template are runs of B words that start every B / 2 words, B being the power of
two from twice the template's length up, so every run of B / 2 words lies inside a block.

1. One pass counts how often each template word stands in the whole corpus; this orders the words, rarest first.
2. Prefix filter: a matching block holds one of the n - a + 1 rarest words of the template, so only blocks around
   those words are looked at.
3. Length and positional filters bound the overlap from the block's size and from the places that the shared word
   has in both ordered sets.
4. What is left is verified: on the sets, and for phrases (t = 1) on consecutive places.

The templates are a small fixed table, so the join needs no shuffle: every task holds them, and every block that
meets a threshold is found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.textcols import row_slices, word_hashes

CONTAINMENT = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = CONTAINMENT
    phrase: bool = False  # its words must stand consecutively


# The base phrases, then opening passages of public license texts.
TEMPLATES = (
    Template("mit", "mit license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
    Template("mit", "released under the terms of the mit license"),
    Template("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the software), to deal in the software without restriction"),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or "
             "substantial portions of the software"),
    Template("apache", "licensed under the apache license, version 2.0 (the license); you may not use this file "
             "except in compliance with the license"),
    Template("apache", "unless required by applicable law or agreed to in writing, software distributed under the "
             "license is distributed on an as is basis, without warranties or conditions of any kind"),
    Template("gpl", "this program is free software: you can redistribute it and/or modify it under the terms of the "
             "gnu general public license as published by the free software foundation"),
    Template("gpl", "this work is licensed under the gnu general public license, version 3"),
    Template("lgpl", "this library is free software; you can redistribute it and/or modify it under the terms of the "
             "gnu lesser general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("isc", "permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license, v. 2.0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


@dataclass
class _Compiled:
    label: str
    words: np.ndarray    # in order of the text
    tokens: list[int]    # distinct words as ranks, rarest first
    need: int
    block: int
    phrase: bool


def _template_words(templates) -> list[np.ndarray]:
    return [word_hashes(pa.array([t.text]))[0] for t in templates]


def template_frequencies(source: DataFrame, templates) -> dict[int, int]:
    """How often each template word stands in the corpus: at most as many rows as the templates have words."""
    vocabulary = np.unique(np.concatenate(_template_words(templates)))

    def run(batches):
        total = np.zeros(len(vocabulary), np.int64)
        for batch in row_slices(batches):
            h = word_hashes(batch.column("text"))[0]
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(vocabulary[some].view(np.int64)), pa.array(total[some])], names=["word", "n"])

    counted = source.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    known = {r["word"]: r["n"] for r in counted}
    return {int(w): known.get(int(w.view(np.int64)), 0) for w in vocabulary}


def compile_templates(templates, frequency: dict[int, int]) -> tuple[np.ndarray, np.ndarray, list[_Compiled]]:
    """(sorted word hashes, their ranks in the global order, templates)."""
    order = sorted(frequency, key=lambda w: (frequency[w], w))
    rank = {w: i for i, w in enumerate(order)}
    out = []
    for t, words in zip(templates, _template_words(templates)):
        tokens = sorted({rank[int(w)] for w in words})
        block = 1 << max(3, math.ceil(math.log2(2 * len(words))))
        out.append(_Compiled(t.label, words, tokens, math.ceil(t.threshold * len(tokens) - 1e-9), block, t.phrase))
    vocabulary = np.array(sorted(rank), np.uint64)
    return vocabulary, np.array([rank[int(w)] for w in vocabulary], np.int64), out


def _places(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    n = len(h) - len(words) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    same = np.ones(n, bool)
    for k, w in enumerate(words):
        same &= h[k:k + n] == w
    return np.flatnonzero(same)


def join_blocks(h: np.ndarray, first: np.ndarray, vocabulary: np.ndarray, ranks: np.ndarray, templates: list[_Compiled]):
    """Yield (row, label, start, end, containment, phrase) for every phrase place and every matching block."""
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    token = np.where(vocabulary[at] == h, ranks[at], -1)
    where: dict[int, list[int]] = {}
    wanted = {k for t in templates for k in t.tokens[:len(t.tokens) - t.need + 1]}
    rare = np.zeros(len(vocabulary) + 1, bool)
    rare[list(wanted)] = True
    for p in np.flatnonzero(rare[token]).tolist():
        where.setdefault(int(token[p]), []).append(p)
    sets: dict[tuple[int, int], np.ndarray] = {}
    for t in templates:
        step = t.block // 2
        blocks = set()
        for k in t.tokens[:len(t.tokens) - t.need + 1]:
            if k in where:
                p = np.array(where[k])
                row = np.searchsorted(first, p, side="right") - 1
                begin = first[row] + (p - first[row]) // step * step
                blocks.update(zip(row.tolist(), begin.tolist()))
                before = begin > first[row]
                blocks.update(zip(row[before].tolist(), (begin[before] - step).tolist()))
        seen = set()
        for row, begin in sorted(blocks):
            end = min(begin + t.block, int(first[row + 1]))
            key = (begin, end)
            if key not in sets:
                inside = token[begin:end]
                sets[key] = np.unique(inside[inside >= 0])
            have = sets[key]
            if len(have) < t.need:  # length filter
                continue
            met = _overlap(t, have)
            if met < t.need:
                continue
            if t.phrase:
                for start in _places(h[begin:end], t.words).tolist():
                    if begin + start not in seen:
                        seen.add(begin + start)
                        at_word = begin + start - int(first[row])
                        yield row, t.label, at_word, at_word + len(t.words), 1.0, True
            else:
                yield row, t.label, begin - int(first[row]), end - int(first[row]), met / len(t.tokens), False


def _overlap(t: _Compiled, have: np.ndarray) -> int:
    """Words shared by template and block, or 0 once the positional filter shows that too few can be."""
    place = np.searchsorted(have, t.tokens)
    place_ok = np.minimum(place, len(have) - 1)
    shared = have[place_ok] == t.tokens
    i = int(np.argmax(shared))  # first shared word in the common order
    if not shared[i] or 1 + min(len(t.tokens) - i - 1, len(have) - int(place[i]) - 1) < t.need:
        return 0
    return int(shared.sum())


_MATCH = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64()),
                    ("phrase", pa.bool_())])


def _scan(vocabulary, ranks, compiled):
    def run(batches):
        for batch in row_slices(batches):
            h, first = word_hashes(batch.column("text"))
            matches: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            if len(h):
                for row, label, start, end, part, phrase in join_blocks(h, first, vocabulary, ranks, compiled):
                    matches[row].append(
                        {"label": label, "start": start, "end": end, "containment": part, "phrase": phrase})
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(first)), pa.array(matches, pa.list_(_MATCH))],
                names=["id", "n_words", "matches"])
    return run


def license_scan(docs: DataFrame, id: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """(id, n_words, matches array<struct<label, start, end, containment, phrase>>), one row per row of ``docs``.

    Places are word numbers from 0, ends exclusive. A null text counts as empty and matches nothing; repeated rows and
    null ids keep their rows; equal frequencies are ordered by the word's hash; an empty table gives an empty one;
    further columns are ignored; texts of any length are scanned whole.
    """
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    compiled = compile_templates(templates, template_frequencies(source, templates))
    return source.mapInArrow(_scan(*compiled), "id long, n_words long, matches array<struct<"
                             "label: string, start: long, end: long, containment: double, phrase: boolean>>") \
        .withColumnRenamed("id", id)


def license_digest(docs: DataFrame) -> DataFrame:
    """Counts and places of the base phrases, labels of phrases and of all matches, and the best containment."""
    found = license_scan(docs).withColumn("base", F.filter("matches", lambda m: m["phrase"]))

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    starts = F.transform("base", lambda m: m["start"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(F.col("base")).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"))
