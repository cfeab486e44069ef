"""Token counts per text without token ids.

1. Every text is split into pre-tokens; their corpus frequencies are summed (per task first, then by Spark).
2. The pieces of each distinct pre-token are counted once, by the tokenizers library.
3. Every text's pre-token frequencies are joined to these counts and summed. The pre-tokens above a frequency that
   leaves at most ``HEAD`` of them form a broadcast table (keys of at most ``HEAD_BYTES`` bytes, so its size is
   bounded); a task resolves them on the spot and writes only the rarer ones, which a shuffle join resolves. So a
   frequent pre-token is never a shuffle key, and every pre-token counts.

Splitting. A long text is walked in parts that end before a single blank between two printable ASCII characters, where
the pre-tokenizer's pattern never matches across. A part is cut before each blank; if no blank stands beside other
white space, the pattern never matches across such a cut either, so it runs once per distinct chunk. Other parts take
it over their whole length. The pattern itself is used on characters below U+0250 only, whose classes no Unicode
version changes; chunks with others are split by the tokenizers library. The special string of the vocabulary counts
one token wherever it stands.

Everything a task holds between rows is bounded in bytes (``HELD``), whatever the length of its words.
"""

from __future__ import annotations

import os
import re
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.staging import stage
from telemetra.llm.textcols import row_slices

LIMIT = 512
HEAD = 1 << 18
HEAD_BYTES = 48
HELD = 24 << 20     # bytes of distinct chunks or pre-tokens that a task holds, with ENTRY more for each
ENTRY = 120
PART = 1 << 21      # bytes of a long text that are split at a time
ROWS = 1 << 15      # entries handed on at a time
SPECIAL = b"<|endoftext|>"

# Fixed value: the pre-tokenizer's pattern, with white space as the Unicode property.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_SPLIT = regex.compile(PATTERN)
_BESIDE = regex.compile(r" \p{White_Space}|\p{White_Space} ")
_SIGNS = (b".", b",", b";", b":", b"!", b"?")
_OTHER = re.compile("[^\x00-\u024f]")
_CUT = re.compile(rb"(?<=[!-~]) (?=[!-~])")


class Splitter:
    """Pre-tokens of a text, as the tokenizers library splits it."""

    def __init__(self):
        from tokenizers import pre_tokenizers
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def pre_tokens(self, chunk: bytes) -> list[bytes]:
        # The common chunks need no pattern: ASCII letters behind a blank or not, and one sign behind them.
        word = chunk[1:] if chunk[:1] == b" " else chunk
        if word.isalpha():
            return [chunk]
        if word[-1:] in _SIGNS and word[:-1].isalpha():
            return [chunk[:-1], chunk[-1:]]
        if chunk.isascii():
            return [p.encode() for p in _SPLIT.findall(chunk.decode())]
        text = chunk.decode()
        if _OTHER.search(text):
            return [text[a:b].encode() for _, (a, b) in self.library.pre_tokenize_str(text)]
        return [p.encode() for p in _SPLIT.findall(text)]

    def chunks(self, text: bytes) -> tuple[list[bytes], int]:
        """Parts of a text that can be split into pre-tokens one by one, and the number of special strings between."""
        parts = text.split(SPECIAL)
        out: list[bytes] = []
        for part in parts:
            if b"\0" in part or _BESIDE.search(part.decode()):
                out += self.pre_tokens(part)
            elif part:
                out += part.replace(b" ", b"\0 ").split(b"\0")
        return out, len(parts) - 1


def text_parts(text: bytes):
    """A text, or parts of a long one, each but the first with the blank it was cut before."""
    at = 0
    while len(text) - at > PART and (cut := _CUT.search(text, at + PART)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _frequencies(batches):
    split = Splitter()

    def rows():
        # Entries leave one table before they enter the next, so the two together stay within the bound.
        total: dict[bytes, int] = {}
        pre_tokens, take = split.pre_tokens, counts.popitem
        while counts:
            chunk, n = take()
            for p in pre_tokens(chunk):
                total[p] = total.get(p, 0) + n
        while total:
            some = [total.popitem() for _ in range(min(ROWS, len(total)))]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())],
                                             names=["pre", "n"])

    counts: Counter = Counter()
    added = 0
    for batch in row_slices(batches, limit=PART):
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            for part in text_parts(text or b""):
                counts.update(split.chunks(part)[0])
                added += len(part)
                if added > PART:
                    added = 0
                    if ENTRY * len(counts) + sum(map(len, counts)) > HELD:
                        yield from rows()
    yield from rows()


def _pieces(tokenizer):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(tokenizer.value)
        library.no_truncation()
        library.no_padding()
        for batch in row_slices(batches, "pre", PART):
            words = [p.decode() for p in batch.column("pre").to_pylist()]
            coded = library.encode_batch_fast(words, add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("pre"), batch.column("n"), pa.array([len(e.ids) for e in coded], pa.int64())],
                names=["pre", "n", "pieces"])
    return run


def piece_table(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """(pre, n, pieces): every distinct pre-token, its corpus frequency and its number of pieces."""
    counted = docs.select("text").mapInArrow(_frequencies, "pre binary, n long").groupBy("pre").agg(F.sum("n").alias("n"))
    tokenizer = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    return stage(counted.mapInArrow(_pieces(tokenizer), "pre binary, n long, pieces long"), "token-pieces")


def head_table(pieces: DataFrame, most: int = HEAD) -> tuple[bytes, int]:
    """The pieces of the most frequent short pre-tokens, at most ``most``, as an Arrow stream, and the least frequency
    among them."""
    short = pieces.filter(F.octet_length("pre") <= HEAD_BYTES)
    # Frequencies are few: the tail of a histogram over powers of 2 ** (1 / 8) says where to cut.
    step = F.floor(8 * F.log2(F.col("n")))
    levels = sorted(((r["s"], r["c"], r["least"]) for r in short.groupBy(step.alias("s")).agg(
        F.count("*").alias("c"), F.min("n").alias("least")).collect()), reverse=True)
    total, least = 0, None
    for _, count, low in levels:
        if total + count > most:
            break
        total, least = total + count, low
    least = 1 << 62 if least is None else least
    head = short.filter(F.col("n") >= least).select("pre", "pieces").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, head.schema) as writer:
        writer.write_table(head)
    return sink.getvalue().to_pybytes(), least


def _resolve(head):
    def run(batches):
        split = Splitter()
        table = pa.ipc.open_stream(head.value).read_all()
        known = dict(zip(table["pre"].to_pylist(), table["pieces"].to_pylist()))
        del table
        memo: dict[bytes, int | tuple] = {}     # the young generation of chunks, and the one before
        old: dict[bytes, int | tuple] = {}
        held = 0

        def look(chunk):
            total, rare = 0, []
            for p in split.pre_tokens(chunk):
                if p in known:
                    total += known[p]
                else:
                    rare.append(p)
            return (total, rare) if rare else total

        for batch in row_slices(batches, limit=PART):
            totals, rare, sizes = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                total, tail, folded = 0, [], Counter()
                for part in text_parts(text or b""):
                    parts, special = split.chunks(part)
                    total += special
                    for chunk in parts:
                        got = memo.get(chunk)
                        if got is None:
                            got = old.get(chunk) or look(chunk)
                            if len(chunk) < 256:  # a longer one hardly comes twice
                                memo[chunk] = got
                                held += ENTRY + len(chunk)
                        if got.__class__ is int:
                            total += got
                        else:
                            total += got[0]
                            tail += got[1]
                    if held > HELD // 2:
                        memo, old, held = {}, memo, 0
                    if len(tail) > ROWS:
                        folded.update(tail)
                        tail = []
                folded.update(tail)
                totals.append(total)
                sizes.append(len(text or b""))
                rare.append([{"pre": p, "n": n} for p, n in folded.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
                 pa.array(rare, pa.list_(pa.struct([("pre", pa.binary()), ("n", pa.int64())])))],
                names=["row", "id", "n_bytes", "n_tokens", "rare"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    Null and empty texts have no bytes and no tokens; repeated rows and null ids are counted each; an empty table
    gives an empty one; further columns are ignored; texts of any length are counted whole.
    """
    with open(tokenizer_path, encoding="utf-8") as f:  # on the driver: the file reaches the tasks as a broadcast
        tokenizer_json = f.read()
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("id"),
                         F.col(text).alias("text"))
    pieces = piece_table(source, tokenizer_json)
    head, least = head_table(pieces)
    known = docs.sparkSession.sparkContext.broadcast(head)
    counted = stage(source.mapInArrow(
        _resolve(known), "row long, id long, n_bytes long, n_tokens long, rare array<struct<pre: binary, n: long>>"),
        "token-counts")
    rare = counted.select("row", F.explode("rare").alias("r")).select("row", "r.pre", "r.n")
    tail = pieces.filter((F.col("n") < least) | (F.octet_length("pre") > HEAD_BYTES)).select("pre", "pieces")
    added = rare.join(tail, "pre").select("row", (F.col("n") * F.col("pieces")).alias("n_tokens"))
    total = (counted.select("row", "id", "n_bytes", "n_tokens")
             .unionByName(added, allowMissingColumns=True).groupBy("row")
             .agg(F.max("id").alias("id"), F.max("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens")))
    return total.select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
