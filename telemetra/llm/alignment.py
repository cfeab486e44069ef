"""Cross-tokenizer alignment over inverted pair bitmaps.

Two tokenizers A and B cut the same bytes. Every place where both have a token end closes a group; an A and a B
token whose byte ranges overlap are linked. Postings are kept per pair of ids:

1. A task encodes its rows, each distinct piece between two blanks once, and writes, per pair and block of ``BLOCK``
   consecutive rows, compressed bitmaps of the rows that hold the pair: plane k holds the rows whose number of links of
   the pair has bit k. A bitmap is a list of 16-bit places, or 8192 bytes where that is shorter. The planes OR-merged and
   popcounted give the documents, each plane popcounted and weighted by 2 ** k the links.
2. Documents and links of a pair are summed over its blocks.
3. The postings carry the pair's score back: every row sums the counts of its links, a block at a time.

No pair, however frequent, meets in one task: counting goes by partial sums, a pair's postings are joined to its score
by a sort-merge join whose skewed partitions adaptive execution splits (scores have no size bound, so they are never
broadcast), and the sums of a block are dense arrays of its rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.staging import stage
from telemetra.llm.textcols import row_slices

BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS
LINKS = 2_000_000       # links a task holds before it writes their bitmaps
LONG_TEXT = 1 << 20     # longer texts are walked in parts of this many characters or a little more
KNOWN = 6 << 20         # bytes of pieces whose alignment a task remembers
ENCODED = 1 << 13       # pieces encoded at a time
B_BITS = 16             # a pair is a * 2 ** B_BITS + b

_BITMAP = BLOCK // 8
# A single blank between two of these characters begins a token in both tokenizers: no white space, whatever the
# Unicode version, and no sign that sentencepiece maps to a blank.
_PLAIN = "[!-~\u00a1-\u024f\u0370-\u167f\u1681-\u180d\u180f-\u1fff\u3001-\ud7ff]"
_CUT = re.compile(f"(?<={_PLAIN}) (?={_PLAIN})")

_FOUND = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups", pa.string()), ("pair", pa.int64()), ("block", pa.int64()),
    ("planes", pa.list_(pa.binary())), ("docs", pa.int64())])
_DDL = ("row long, id long, n_a long, n_b long, n_groups long, n_links long, groups string, pair long, block long, "
        "planes array<binary>, docs long")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, and the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers of a task, the bytes of their tokens, and the alignments of the pieces last seen.

    A text is cut before single blanks, where both have a token end: A's pre-tokens never hold a blank behind another
    character, and neither does a piece of B (``cut`` checks its vocabulary). So each piece between two cuts is encoded
    and aligned by itself, once for all its places.
    """

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(letters.__getitem__, entry)) if all(c in letters for c in entry) else entry.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.cut = not any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces)
        self.len_a = np.array(list(map(len, self.a_bytes)), np.int64)
        self.len_b = np.array(list(map(len, self.b_bytes)), np.int64)
        self.shown = shown_ids(max(len(pieces), len(self.a_bytes)))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0
        self.groups: list[str] = []
        # A row a piece: tokens of A and of B, groups, links, whether the tokens spell it, place of its links.
        self.facts = np.empty((0, 6), np.int64)
        self.pairs = np.empty(0, np.int64)

    def parts(self, text: str) -> list[str]:
        """A text, or parts of a long one."""
        out, at = [], 0
        while self.cut and len(text) - at > LONG_TEXT:
            place = _CUT.search(text, at + LONG_TEXT)
            if place is None:
                break
            out.append(text[at:place.start()])
            at = place.end()
        return [*out, text[at:]]

    def _learn(self, pieces: list[str]) -> None:
        ids_a = []
        for at in range(0, len(pieces), ENCODED):  # the library's encodings weigh far more than their ids
            some = [" " + p for p in pieces[at:at + ENCODED]]
            ids_a += [x.ids for x in self.a.encode_batch_fast(some, add_special_tokens=False)]
        ids_b = self.b.encode(pieces, num_threads=1)
        bodies = [b" " + p.encode() for p in pieces]
        spelt = self._spell(ids_a, ids_b, bodies)
        if not spelt.all():
            ids_a, ids_b, bodies = ([x if good else x[:0] for x, good in zip(side, spelt)] for side in (ids_a, ids_b, bodies))
        n_a, n_b, sizes = (np.array(list(map(len, side)), np.int64) for side in (ids_a, ids_b, bodies))
        groups, n_groups, piece, pairs = align(ids_a, ids_b, n_a + n_b, sizes, self.len_a, self.len_b, self.shown)
        links = np.bincount(piece, minlength=len(pieces))
        self.known.update(zip(pieces, range(len(self.groups), len(self.groups) + len(pieces))))
        self.size += int(sizes.sum())
        self.groups += groups
        self.facts = np.concatenate([self.facts, np.column_stack(
            [n_a, n_b, n_groups, links, spelt, len(self.pairs) + np.cumsum(links) - links])])
        self.pairs = np.concatenate([self.pairs, pairs])

    def _spell(self, ids_a: list[list[int]], ids_b: list[list[int]], bodies: list[bytes]) -> np.ndarray:
        """Whether the tokens of A and the tokens of B spell each piece."""
        good = np.ones(len(bodies), bool)
        for ids, table in ((ids_a, self.a_bytes), (ids_b, self.b_bytes)):
            spelt = list(map(b"".join, (map(table.__getitem__, x) for x in ids)))
            if spelt != bodies:
                good &= [x == y for x, y in zip(spelt, bodies)]
        return good

    def measure(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text (tokens of A, of B, groups, links, spelt) and its group list; then text and pair of every link.
        A text that its tokens do not spell has none of them."""
        if self.size > KNOWN:
            self.forget()
        cut = [(_CUT.split(t) if self.cut else [t]) if t else [] for t in texts]
        new = list(dict.fromkeys(p for pieces in cut for p in pieces if p not in self.known))
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64)
        text = np.repeat(np.arange(len(texts)), list(map(len, cut)))
        facts = np.zeros((len(texts), 5), np.int64)
        np.add.at(facts, text, self.facts[at, :5])
        facts[:, 4] = facts[:, 4] == list(map(len, cut))
        facts[facts[:, 4] == 0, :4] = 0
        good = facts[text, 4] == 1
        at, text = at[good], text[good]
        links, place = self.facts[at, 3], self.facts[at, 5]
        pairs = self.pairs[np.repeat(place - np.cumsum(links) + links, links) + np.arange(links.sum())]
        first = [0, *np.cumsum(np.bincount(text, minlength=len(texts))).tolist()]
        listed = list(map(self.groups.__getitem__, at.tolist()))
        groups = [";".join(listed[s:e]) for s, e in zip(first, first[1:])]
        return facts, groups, np.repeat(text, links), pairs


def shown_ids(n: int) -> np.ndarray:
    """Decimal ids followed by a comma, a bar or a semicolon: entry ``sign * n + id``."""
    return np.array([f"{i}{sign}" for sign in ",|;" for i in range(n)], dtype=object)


def align(ids_a: list[list[int]], ids_b: list[list[int]], counts: np.ndarray, sizes: np.ndarray, len_a: np.ndarray,
          len_b: np.ndarray, shown: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of each text its group list and number of groups; then text and pair of every link. ``counts`` are the texts'
    tokens of both kinds together, ``sizes`` their bytes, 0 for a text without tokens. Texts stand behind one another
    in one run of bytes: their ends are ends in both tokenizers, so no group or link crosses them."""
    a = np.fromiter(chain.from_iterable(ids_a), np.int64)
    b = np.fromiter(chain.from_iterable(ids_b), np.int64)
    if not len(a):
        none = np.empty(0, np.int64)
        return [""] * len(sizes), np.zeros(len(sizes), np.int64), none, none
    end_a, end_b, ends = np.cumsum(len_a[a]), np.cumsum(len_b[b]), np.cumsum(sizes)
    cuts = end_b[end_a[np.minimum(np.searchsorted(end_a, end_b), len(end_a) - 1)] == end_b]
    # Between two neighbouring ends of either kind lies the overlap of exactly one A and one B token.
    every = np.union1d(end_a, end_b)
    pairs = (a[np.searchsorted(end_a, every)] << B_BITS) | b[np.searchsorted(end_b, every)]
    side = np.concatenate([2 * np.searchsorted(cuts, end_a), 2 * np.searchsorted(cuts, end_b) + 1])
    order = np.argsort(side, kind="stable")
    side = side[order]
    last = np.append(side[1:] != side[:-1], True)
    sign = np.where(last, 1 + (side & 1), 0)
    listed = shown[sign * (len(shown) // 3) + np.concatenate([a, b])[order]].tolist()
    first = [0, *np.cumsum(counts).tolist()]
    groups = ["".join(listed[s:e])[:-1] for s, e in zip(first, first[1:])]
    n_groups = np.bincount(np.searchsorted(ends, cuts), minlength=len(sizes))
    return groups, n_groups, np.searchsorted(ends, every), pairs


def pack_bits(places: np.ndarray) -> bytes:
    """A bitmap over a block: ascending 16-bit places, or all bits of the block if that is no longer."""
    if 2 * len(places) < _BITMAP:
        return places.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack_bits(bits: bytes) -> np.ndarray:
    if len(bits) < _BITMAP:
        return np.frombuffer(bits, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


def postings(keys: np.ndarray, links: np.ndarray, block: int):
    """Bitmap rows of one block from distinct ascending keys pair * BLOCK + place and their numbers of links."""
    pairs, places = keys >> BLOCK_BITS, (keys & (BLOCK - 1)).astype("<u2")
    heads = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    for at in range(0, len(heads), 1 << 16):
        first = heads[at:at + (1 << 16)]
        low, high = first[0], heads[at + len(first)] if at + len(first) < len(heads) else len(keys)
        here, times = places[low:high], links[low:high]
        pair = np.repeat(np.arange(len(first)), np.diff(np.append(first, high)))  # so many as the OR of its planes has bits
        depth = np.floor(np.log2(np.maximum.reduceat(times, first - low))).astype(np.int64) + 1
        starts = np.append(0, np.cumsum(depth))     # planes of each pair
        # Entries by pair, plane and place: one entry for every set bit.
        bit = np.arange(int(depth.max()))[:, None]
        plane, entry = np.nonzero((times >> bit) & 1)
        slot = starts[pair[entry]] + plane
        order = np.argsort(slot, kind="stable")
        body = here[entry[order]]
        bounds = np.searchsorted(slot[order], np.arange(starts[-1] + 1))
        if 2 * np.diff(bounds).max() < _BITMAP:     # place lists alone: the buffer as it is
            bits = pa.Array.from_buffers(pa.binary(), int(starts[-1]), [
                None, pa.py_buffer((2 * bounds).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])
        else:
            bits = pa.array([pack_bits(body[s:e]) for s, e in zip(bounds[:-1], bounds[1:])], pa.binary())
        yield _rows(len(first), pair=pa.array(pairs[first]), block=pa.array(np.full(len(first), block, np.int64)),
                    planes=pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), bits),
                    docs=pa.array(np.bincount(pair, minlength=len(first))))


def _rows(n: int, **given: pa.Array) -> pa.RecordBatch:
    """Rows of the scan's table; columns not given are null."""
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in _FOUND], schema=_FOUND)


class _Held:
    """Links of rows of one block, equal ones added up. A row's links always leave together, so that the bitmaps of two
    fragments never hold the same row."""

    def __init__(self):
        self.block, self.parts, self.size = None, [], 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append((keys, np.ones(len(keys), np.int64)))
        self.size += len(keys)
        if self.size > 2 * LINKS:
            self.parts = [self.summed()]
            self.size = len(self.parts[0][0])

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        keys, links = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[heads], np.add.reduceat(links[order], heads)

    def leave(self):
        if self.size:
            yield from postings(*self.summed(), self.block)
        self.parts, self.size = [], 0


def _scan(a_json, b_model):
    def run(batches):
        pair, held = Pair(a_json.value, b_model.value), _Held()
        for batch in row_slices(batches):
            rows, texts = batch.column("row").to_numpy(), batch.column("text").to_pylist()
            long = len(texts) == 1 and len(texts[0] or "") > LONG_TEXT
            parts = pair.parts(texts[0]) if long else []
            if long and not all(pair.measure([p])[0][0, 4] for p in parts):
                parts, texts = [], [None]
            facts, digests = np.zeros((len(texts), 5), np.int64), [hashlib.sha256() for _ in texts]
            for k, step in enumerate([p] for p in parts) if len(parts) > 1 else [(0, texts)]:
                found, groups, text, pairs = pair.measure(step)
                facts += found
                for digest, g in zip(digests, groups):
                    digest.update((";" + g if k else g).encode())
                row = rows[text]
                cuts = np.append(0, np.flatnonzero(row[1:] >> BLOCK_BITS != row[:-1] >> BLOCK_BITS) + 1) if len(row) else []
                for s, e in zip(cuts, [*cuts[1:], len(row)]):
                    if held.block != row[s] >> BLOCK_BITS or (k == 0 and held.size > LINKS):
                        yield from held.leave()
                    held.block = int(row[s] >> BLOCK_BITS)
                    held.add((pairs[s:e] << BLOCK_BITS) | (row[s:e] & (BLOCK - 1)))
            counts = dict(zip(("n_a", "n_b", "n_groups", "n_links"), map(pa.array, facts[:, :4].T.copy())))
            yield _rows(len(texts), row=batch.column("row"), id=batch.column("id"), **counts,
                        groups=pa.array([d.hexdigest() if n else "" for d, n in zip(digests, facts[:, 2])], pa.string()))
        yield from held.leave()
    return run


def _returned(batches):
    """Sums of a block's rows from its scored bitmaps, which stand behind one another."""
    sums = np.zeros((2, BLOCK), np.int64)
    block = None

    def rows():
        at = np.flatnonzero(sums[0])
        return pa.RecordBatch.from_arrays([pa.array((block << BLOCK_BITS) + at), pa.array(sums[1][at]), pa.array(sums[0][at])],
                                          names=["row", "n_best", "count_sum"])

    for batch in batches:
        cols = (batch.column(c) for c in ("block", "planes", "n_links", "best"))
        for k, planes, links, best in zip(*(c.to_pylist() for c in cols)):
            if k != block:
                if block is not None:
                    yield rows()
                    sums[:] = 0
                block = k
            for plane, bits in enumerate(planes):
                places = unpack_bits(bits)
                sums[0, places] += links << plane
                if best:
                    sums[1, places] += 1 << plane
    if block is not None:
        yield rows()


def pair_index(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Staged: one row per row of ``docs`` (row, id, n_a, n_b, n_groups, n_links, groups), and the inverted bitmaps
    (pair, block, planes, docs). A block of very long texts may have several rows of a pair, of different texts.
    Tokenizer files travel as broadcasts (1 to 2 MB each)."""
    context = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        files = context.broadcast(f.read()), context.broadcast(g.read())
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("id"),
                         F.col(text).alias("text"))
    found = stage(source.mapInArrow(_scan(*files), _DDL), "alignment")
    # Two streams of one table: rows of texts have no pair, bitmaps have no row.
    return (found.filter("pair IS NULL").select("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups"),
            found.filter("pair IS NOT NULL").select("pair", "block", "planes", "docs"))


def bit_count(bits: Column) -> Column:
    """Rows of one bitmap: a whole block's bits, or two bytes a row."""
    return F.when(F.octet_length(bits) == _BITMAP, F.bitmap_count(bits)).otherwise(F.octet_length(bits) / 2).cast("long")


def pair_counts(index: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best): documents and links of every pair of ids; ``best`` marks the pairs with the
    most links of their B id, ties included."""
    links = F.aggregate(F.transform("planes", lambda p, k: bit_count(p) * F.pow(F.lit(2), k).cast("long")),
                        F.lit(0).cast("long"), lambda x, y: x + y)
    counts = index.select("pair", "docs", links.alias("links")).groupBy("pair").agg(
        F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links"))
    counts = counts.select("pair", F.shiftright("pair", B_BITS).cast("int").alias("a"),
                           F.col("pair").bitwiseAND((1 << B_BITS) - 1).cast("int").alias("b"), "n_docs", "n_links")
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def cross_alignment(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(per text, per pair) of two tokenizers: A a byte-level BPE of the tokenizers library, B a sentencepiece model.

    Per text: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256). Per pair: see ``pair_counts``.
    Null and empty texts, and texts that the tokens of A or B do not spell, have no tokens: zeros and an empty digest.
    Repeated rows and null ids count each; an empty table gives empty ones; further columns are ignored. Texts over
    ``LONG_TEXT`` characters are walked in parts; a stretch without a blank to cut at is encoded in one piece.
    """
    texts, index = pair_index(docs, a_path, b_path, id, text)
    pairs = stage(pair_counts(index), "alignment-pairs")
    scores = pairs.select("pair", "n_links", "best").hint("merge")
    scored = index.select("pair", "block", "planes").join(scores, "pair").select("block", "planes", "n_links", "best")
    sums = scored.repartition("block").sortWithinPartitions("block").mapInArrow(_returned, "row long, n_best long, count_sum long")
    total = (texts.unionByName(sums, allowMissingColumns=True).groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links", "groups")],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]))
    return total.select(F.col("id").alias(id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.col("groups").alias("groups_sha256")), pairs
