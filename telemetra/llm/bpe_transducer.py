"""Byte-pair encoding and decoding of whole texts through a compiled lexicon.

1. The corpus frequency of every word (pre-token after the tokenizer's own normaliser) is counted by Spark.
2. The frequent words, at most ``LEXICON`` of them, are encoded once and compiled into a minimal acyclic transducer:
   words with equal endings share states, and the numbers on a path's arcs add up to the word's place in a table of
   ids. It is one file of flat arrays in the shared folder; every executor fetches it once and its tasks memory-map it.
3. Tasks walk all distinct words of a slice through the arcs together. Words that the lexicon does not hold are merged
   exactly, pair by pair in rank order.

Texts are cut at ASCII white space, which the tokenizer drops, so its normaliser and pre-tokenizer see single chunks.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.staging import publish, stage
from telemetra.llm.textcols import row_slices

LEXICON = 1 << 17
WORD_BYTES = 48     # longest word of the lexicon
MEMO = 1 << 18      # distinct chunks of one generation of a task's memory

# Text that the normaliser only lower-cases (printable ASCII and the letters of Latin-1), and its words.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
_PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: bytes that are printable in
    Latin-1 stand for themselves, the others take the characters from 256 on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class Merges:
    """Exact merging of one word, and the tokenizer's own normaliser, pre-tokenizer and special strings."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer_json)
        self.model = self.library.model
        self.char_of = dict(enumerate(byte_chars()))
        self.byte_of = {c: b for b, c in self.char_of.items()}
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.text_of = {i: t for t, i in self.library.get_vocab().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.lead = os.path.commonprefix(list(self.special))

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word by the merges in rank order."""
        text = word.decode() if word.isascii() and word.isalnum() else word.decode("latin-1").translate(self.char_of)
        return [t.id for t in self.model.tokenize(text)]

    def words(self, chunk: bytes) -> list[bytes | int]:
        """The words of a chunk in order, as bytes; an int is a special string's id."""
        text = chunk.decode()
        if self.special and self.lead in text and self.cut.search(text):
            return [w for part in self.cut.split(text) if part
                    for w in ([self.special[part]] if part in self.special else self.words(part.encode()))]
        if _PLAIN.fullmatch(text):
            return [w.encode() for w in _PLAIN_WORD.findall(text.lower())]
        plain = self.library.normalizer.normalize_str(text)
        byte_of = self.byte_of
        return [bytes([byte_of[c] for c in w]) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]


def _word_counts(tokenizer):
    def run(batches):
        merges = Merges(tokenizer.value)
        counts: Counter = Counter()

        def rows():
            total: Counter = Counter()
            for chunk, n in counts.items():
                for w in merges.words(chunk):
                    if isinstance(w, bytes) and len(w) <= WORD_BYTES:
                        total[w] += n
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in row_slices(batches):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                counts.update((text or b"").split())
            if len(counts) > 4 * MEMO:
                yield rows()
        if counts:
            yield rows()
    return run


def frequent_words(docs: DataFrame, tokenizer, most: int = LEXICON) -> list[bytes]:
    """The most frequent words of all texts, at most ``most``, cut where a frequency level fits as a whole."""
    counted = stage(docs.select("text").mapInArrow(_word_counts(tokenizer), "word binary, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")
    levels = sorted(((r["s"], r["c"], r["least"]) for r in counted.groupBy(F.floor(8 * F.log2("n")).alias("s")).agg(
        F.count("*").alias("c"), F.min("n").alias("least")).collect()), reverse=True)
    total, least = 0, None
    for _, count, low in levels:
        if total + count > most:
            break
        total, least = total + count, low
    if least is None:
        return []
    return counted.filter(F.col("n") >= least).select("word").toArrow()["word"].to_pylist()


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The transducer's file: a header of four sizes, then arc keys (state * 256 + byte, ascending), arc targets, arc
    outputs, end marks of the states, offsets into the ids, and the ids in word order. ``words`` are ascending.

    Built word by word: states below the part that the next word shares are final and are replaced by an equal state
    that already exists, so the automaton is never larger than the minimal one plus one word.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # (accepts, ((byte, state), ...))
    open_: list[list] = [[False, []]]      # the last word's path: [accepts, finished arcs]
    path = b""

    def close(depth: int) -> None:
        while len(open_) > depth + 1:
            accepts, arcs = open_.pop()
            key = (accepts, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            open_[-1][1].append((path[len(open_) - 1], register[key]))

    for word in words:
        common = len(os.path.commonprefix([word, path]))
        close(common)
        open_ += [[False, []] for _ in word[common:]]
        open_[-1][0] = True
        path = word
    close(0)
    states.append((open_[0][0], tuple(open_[0][1])))
    below = np.zeros(len(states), np.int64)  # words that a state accepts
    keys, targets, outputs = [], [], []
    for s, (accepts, arcs) in enumerate(states):  # targets come before their sources
        before = int(accepts)
        for byte, target in arcs:
            keys.append((s << 8) + byte)
            targets.append(target)
            outputs.append(before)
            before += below[target]
        below[s] = before
    flat = np.array([i for x in ids for i in x], "<u4")
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<u4")
    ends = np.array([a for a, _ in states], np.uint8)
    head = np.array([len(keys), len(states), len(ids), len(flat)], "<i8")
    return b"".join(x.tobytes() for x in (
        head, np.array(keys, "<i8"), np.array(targets, "<u4"), np.array(outputs, "<u4"), offsets, flat, ends))


class Lexicon:
    """The memory-mapped transducer."""

    def __init__(self, path: str):
        n_arcs, n_states, n_words, n_ids = np.fromfile(path, "<i8", 4)
        at = 32
        parts = []
        for kind, n in (("<i8", n_arcs), ("<u4", n_arcs), ("<u4", n_arcs), ("<u4", n_words + 1), ("<u4", n_ids), ("u1", n_states)):
            parts.append(np.memmap(path, kind, "r", at, (int(n),)) if n else np.empty(0, kind))
            at += int(n) * np.dtype(kind).itemsize
        self.keys, self.targets, self.outputs, self.offsets, self.ids, self.ends = parts
        self.root = int(n_states) - 1

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The place of every word in the lexicon, -1 for words it does not hold; all walk together, byte by byte."""
        length = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(length) - length
        data = np.frombuffer(b"".join(words), np.uint8)
        state = np.full(len(words), self.root, np.int64)
        number = np.zeros(len(words), np.int64)
        alive = np.flatnonzero((length <= WORD_BYTES) & (length > 0)) if len(self.keys) else np.empty(0, np.int64)
        held = np.full(len(words), -1, np.int64)
        for k in range(WORD_BYTES + 1):
            done = alive[length[alive] == k]
            done = done[self.ends[state[done]] == 1]
            held[done] = number[done]
            alive = alive[length[alive] > k]
            if not len(alive):
                break
            want = (state[alive] << 8) + data[start[alive] + k]
            arc = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            met = self.keys[arc] == want
            alive, arc = alive[met], arc[met]
            state[alive] = self.targets[arc]
            number[alive] += self.outputs[arc]
        return held

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tolist()


def _encode(tokenizer, file: str):
    def run(batches):
        merges, lexicon = Merges(tokenizer.value), Lexicon(SparkFiles.get(file))
        text_of = {i: t.encode() for i, t in merges.text_of.items()}
        memo: dict[bytes, tuple[bytes, bytes]] = {}
        older: dict[bytes, tuple[bytes, bytes]] = {}
        for batch in row_slices(batches):
            split = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            if len(memo) > MEMO:
                memo, older = {}, memo
            met = {c for chunks in split for c in chunks}.difference(memo)
            memo.update((c, older[c]) for c in met if c in older)
            new = {c: merges.words(c) for c in met if c not in memo}
            words = list({w for ws in new.values() for w in ws if isinstance(w, bytes)})
            coded = {w: lexicon.ids_of(n) if n >= 0 else merges.merge(w)
                     for w, n in zip(words, lexicon.numbers(words).tolist())}
            for chunk, ws in new.items():
                ids = [i for w in ws for i in (coded[w] if isinstance(w, bytes) else [w])]
                memo[chunk] = array("I", ids).tobytes(), b" ".join([text_of[i] for i in ids])
            ids = [b"".join([memo[c][0] for c in chunks]) for chunks in split]
            decoded = [b" ".join([d for c in chunks if (d := memo[c][1])]) for chunks in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(decoded, pa.binary()).cast(pa.string())], names=["id", "n_tokens", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) for every row of ``docs``: ids as little-endian unsigned 32-bit integers, decoded
    as the tokenizer without a decoder does it, its pieces joined by blanks.

    Null and empty texts have no ids and decode to an empty text; repeated rows and null ids are encoded each; an
    empty table gives an empty one; further columns are ignored; special strings in texts become their ids.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # on the driver: the file reaches the tasks as a broadcast
        tokenizer = spark.sparkContext.broadcast(f.read())
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    merges = Merges(tokenizer.value)
    words = sorted(frequent_words(source, tokenizer))
    file = publish(spark, "bpe-lexicon", compile_lexicon(words, [merges.merge(w) for w in words]))
    return source.mapInArrow(_encode(tokenizer, file), "id long, n_tokens long, ids binary, decoded string") \
        .withColumnRenamed("id", id)


def encode_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of the ids and of the decoded text, one row per document."""
    return encode_decode(docs, tokenizer_path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
