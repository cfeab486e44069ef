"""Spelling variants by reduced-alphabet neighbourhoods.

1. Words and their numbers of occurrences are counted, per task first.
2. Every letter is hashed to one of a few symbols. The alphabet has so many symbols that words of the least length have
   about as many reduced forms as the vocabulary has words, so a reduced form stands for few words whatever its size.
3. Of every distinct reduced word the full one-edit neighbourhood (itself, deletions, replacements, insertions) is
   generated as 64-bit keys. A Bloom filter of fixed size, made from the reduced vocabulary, drops most keys that meet
   nothing; the others are joined to the reduced vocabulary.
4. The words behind two joined reduced words are verified on the original strings: exactly one edit.
5. A word's form is its most frequent near word, if that is frequent enough; roots follow by pointer doubling.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.bloom import bloom_filter, bloom_hits
from telemetra.llm.staging import stage
from telemetra.llm.textcols import row_slices

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
DELETE_EVERY = 199
HELD = 1 << 24          # characters of distinct words a task holds before it hands its counts on
SYMBOLS = (4, 26)       # least and largest size of the reduced alphabet
LETTERS = 1 << 18       # letters of reduced words expanded at a time

_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PART = 1 << 20


def runs(text: str):
    """Maximal runs of letters with ``LEAST_LENGTH`` letters or more, a part of a long text at a time."""
    if len(text) <= _PART:
        yield from _RUN.findall(text)
        return
    for m in _RUN.finditer(text):
        yield m[0]


def _count(batches):
    def rows():
        words, n = list(held), list(held.values())
        for at in range(0, len(words), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(words[at:at + (1 << 16)], pa.string()),
                                              pa.array(n[at:at + (1 << 16)], pa.int64())], names=["word", "n"])

    held: dict[str, int] = {}
    size = 0
    for batch in row_slices(batches):
        ids = batch.column("id").to_pylist()
        for id, text in zip(ids, batch.column("text").cast(pa.binary()).to_pylist()):
            if not text:
                continue
            begin = zlib.crc32(b"%s:" % (b"" if id is None else b"%d" % id))
            for run in runs(text.translate(_LOWER).decode()):
                h = zlib.crc32(run.encode(), begin)
                if h % DELETE_EVERY == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1:]
                    if len(run) < LEAST_LENGTH:
                        continue
                if run in held:
                    held[run] += 1
                else:
                    held[run] = 1
                    size += len(run) + 64
            if size > HELD:
                yield from rows()
                held.clear()
                size = 0
    if held:
        yield from rows()


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged (word, n): words of at least ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences."""
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    counted = source.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stage(counted.filter(F.col("n") >= LEAST_COUNT), "spelling-words")


_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)


def symbol_table(symbols: int) -> np.ndarray:
    """Symbol (from 1) of every Latin-1 letter: letters are dealt by the low bits of a multiplicative hash."""
    code = np.arange(256, dtype=np.uint64)
    return (1 + (code * np.uint64(0x2545F4914F6CDD1D) >> np.uint64(40)) % np.uint64(symbols)).astype(np.uint64)


class Reduced:
    """Hashes of the reduced forms of a batch of words: a form s has the key sum(s[i] * BASE ** i)."""

    def __init__(self, words: pa.Array, table: np.ndarray):
        texts = words.to_pylist()
        self.sizes = np.array(list(map(len, texts)), np.int64)
        self.symbol = table[np.frombuffer("".join(texts).encode("latin-1"), np.uint8)]
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.place = np.arange(len(self.symbol)) - np.repeat(self.first[:-1], self.sizes)
        longest = int(self.sizes.max(initial=0))
        self.power = np.cumprod(np.append(np.uint64(1), np.full(longest + 1, _BASE, np.uint64)))
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.symbol * self.power[self.place])])
        self.key = running[self.first[1:]] - running[self.first[:-1]]
        self.before = running[:-1] - np.repeat(running[self.first[:-1]], self.sizes)  # key of the letters before each place

    def neighbourhood(self, symbols: int):
        """(word number, key) of every word with its form itself and all forms one edit away, each once."""
        word = np.repeat(np.arange(len(self.sizes)), self.sizes)
        s, p, before = self.symbol, self.power[self.place], self.before
        through = before + s * p
        rest = self.key[word] - through
        previous = np.append(np.uint64(0), s[:-1])
        previous[self.first[:-1]] = 0
        yield np.arange(len(self.sizes)), self.key
        once = s != previous            # deleting either letter of a double gives the same form
        yield word[once], (before + rest * np.uint64(_BACK))[once]
        end = self.power[self.sizes]
        for t in range(1, symbols + 1):
            t = np.uint64(t)
            other = s != t
            yield word[other], (before + t * p + rest)[other]
            here = previous != t        # inserting a letter on either side of its like gives the same form
            yield word[here], (before + t * p + (self.key[word] - before) * np.uint64(_BASE))[here]
            behind = s[self.first[1:] - 1] != t
            yield np.flatnonzero(behind), (self.key + t * end)[behind]


def _reduce(symbols: int):
    table = symbol_table(symbols)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                key = Reduced(batch.column("word"), table).key
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(key.view(np.int64))],
                                                 names=["word", "n", "key"])
    return run


def _neighbours(symbols: int, bloom):
    table = symbol_table(symbols)

    def run(batches):
        bits = np.frombuffer(bloom.value, np.uint64)
        for batch in row_slices(batches, "word", LETTERS):
            reduced = Reduced(batch.column("word"), table)
            for word, key in reduced.neighbourhood(symbols):
                hit = bloom_hits(bits, key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[hit].view(np.int64)), pa.array(reduced.key[word[hit]].view(np.int64))],
                    names=["near_key", "key"])
    return run


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, near, near_n) for all ordered pairs of ``words`` (word, n) that differ by exactly one edit."""
    if symbols is None:
        least, most = SYMBOLS
        symbols = min(max(math.ceil(words.count() ** (1 / LEAST_LENGTH)), least), most)
    reduced = stage(words.mapInArrow(_reduce(symbols), "word string, n long, key long"), "spelling-reduced")
    forms = stage(reduced.groupBy("key").agg(F.min("word").alias("word")), "spelling-forms")  # any word of a form shows it
    bloom = words.sparkSession.sparkContext.broadcast(bloom_filter(forms))
    keys = forms.mapInArrow(_neighbours(symbols, bloom), "near_key long, key long")
    met = keys.join(forms.select(F.col("key").alias("near_key")), "near_key")
    ours = reduced.select("key", "word", "n")
    theirs = reduced.select(F.col("key").alias("near_key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return (met.join(ours, "key").join(theirs, "near_key")
            .filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n"))


def roots(parents: DataFrame) -> DataFrame:
    """(word, root) for every word of ``parents`` (word, form): the last word of its chain, by pointer doubling.

    A form is at least ``RATIO`` times as frequent as its word, so chains are short and have no cycle.
    """
    current = stage(parents.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not current.filter("moved").isEmpty():
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        current = stage(current.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return current.select("word", "root")


def spelling_variants(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the corpus.

    Words are the maximal runs of ``A-Z a-z U+00C0-U+00FF`` after lower-casing A-Z; where the unsigned CRC-32 h of
    ``<id>:<run>`` is divisible by ``DELETE_EVERY``, the letter h mod length is deleted first. Only words of
    ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences count. Null and empty texts have no words; a null id counts
    as an empty text in h; repeated rows count each; an empty table gives an empty one; further columns are ignored.
    Runs may be of any length. Ties for the most frequent near word go to the smallest in code-point order.
    """
    words = vocabulary(docs, id, text)
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.m") >= RATIO * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.m")).alias("n"))).alias("f"))
    formed = stage(joined.select("word", F.col("f.form").alias("form"), "n", "n_near", F.col("f.n").alias("form_n")), "spelling-formed")
    last = roots(formed.filter("form IS NOT NULL"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
