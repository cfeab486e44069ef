"""Best-fit packing of whole token sequences by bin completion.

Only lengths decide a packing, and there are at most ``capacity`` of them: the driver gets a histogram of lengths,
never the documents, and plans patterns (a multiset of lengths that share a sequence) with multiplicities.

* Best-fit decreasing over the histogram is the first incumbent.
* Bin completion takes the largest length left, searches the undominated fillings of the rest of the sequence
  depth first, larger lengths first, pruning by the waste of the best filling so far (the best-fit filling at the
  start), and uses the filling as often as the counts allow. Branches follow, fewest deviations first: where a descent
  first wastes, and up to ``BACK`` steps before, each of up to ``WIDTH`` fillings is taken. They end when the bound
  ceil(tokens / capacity) is met or ``BRANCH_NODES`` search nodes or ``BRANCHES`` descents are spent; the best solution stays.

The documents then find their place by their rank among the pieces of the same length. Ranks are counted in hash
buckets, so a length that a third of all pieces share is ranked by many tasks.
"""

from __future__ import annotations

import bisect
import heapq
import math
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.bpe_transducer import Merges
from telemetra.llm.staging import stage
from telemetra.llm.textcols import row_slices

CAPACITY = 4096
END_ID = 1
NODES = 3000        # search nodes for one filling
BRANCH_NODES = 4_000_000  # search nodes for all descents after the first
BRANCHES = 2000     # most descents after the first, which bounds the driver's memory
WIDTH = 4           # most fillings tried at one step
BACK = 4            # steps before the first waste that are branched at
BUCKET_ROWS = 100_000
MEMO = 1 << 18      # chunks, and words, of one generation of a task's memory


class ChunkEncoder:
    """Ids of whole texts. The tokenizer drops white space before it merges, so a text is encoded chunk by chunk
    (maximal runs without ASCII white space) and word by word; a task remembers the chunks and words it has met
    lately, in two generations, so that common ones are never forgotten."""

    def __init__(self, tokenizer_json: str):
        self.merges = Merges(tokenizer_json)
        self.chunks: tuple[dict[bytes, bytes], dict[bytes, bytes]] = {}, {}
        self.words: tuple[dict[bytes, bytes], dict[bytes, bytes]] = {}, {}

    def _word(self, word: bytes | int) -> bytes:
        if isinstance(word, int):
            return array("I", [word]).tobytes()
        young, old = self.words
        ids = young.get(word)
        if ids is None:
            ids = young[word] = old.get(word) or array("I", self.merges.merge(word)).tobytes()
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        for name in ("chunks", "words"):
            if len(getattr(self, name)[0]) > MEMO:
                setattr(self, name, ({}, getattr(self, name)[0]))
        young, old = self.chunks
        out = []
        for text in texts:
            chunks = text.split()
            for chunk in set(chunks).difference(young):
                ids = old.get(chunk)
                young[chunk] = b"".join(map(self._word, self.merges.words(chunk))) if ids is None else ids
            out.append(b"".join([young[c] for c in chunks]))
        return out


def _pieces(tokenizer, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = ChunkEncoder(tokenizer.value)
        for batch in row_slices(batches):
            coded = encoder.encode([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()])
            out = []
            for id, ids in zip(batch.column("id").to_pylist(), coded):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of every text and an end id, cut into pieces of at most
    ``capacity``. A null text counts as empty and is one piece of the end id."""
    with open(tokenizer_path, encoding="utf-8") as f:  # on the driver: the file reaches the tasks as a broadcast
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, end_id),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = list[tuple[int, int]]  # (length, how often in a sequence), in order of placement


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: equal sequences move as one group."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}  # rest -> groups
    rests: list[int] = []

    def put(rest: int, pattern: Pattern, n: int) -> None:
        if rest not in open_:
            open_[rest] = []
            bisect.insort(rests, rest)
        open_[rest].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rests, length)
            if at == len(rests):
                rest, pattern, n = capacity, [], left
            else:
                rest = rests[at]
                pattern, n = open_[rest].pop()
                if not open_[rest]:
                    del open_[rest], rests[at]
            fit = min(rest // length, left)
            full = min(n, left // fit)
            put(rest - fit * length, [*pattern, (length, fit)], full)
            left -= fit * full
            if full < n and pattern:
                put(rest, pattern, n - full)
    return [g for groups in open_.values() for g in groups]


def fillings(counts: dict[int, int], lengths: list[int], rest: int, nodes: int, want: int,
             spent: list[int] | None = None) -> list[tuple[int, Pattern]]:
    """Up to ``want`` undominated fillings of ``rest``, least waste first, by depth-first search with larger lengths
    first. ``lengths`` are ascending. Taking b after passing over a longer a is dominated unless the waste ends below
    a - b, since a would fit in b's place. The nodes used are added to ``spent``."""
    best: list[tuple[int, Pattern]] = []
    budget = [nodes]

    def search(room: int, top: int, bound: int, taken: Pattern) -> None:
        at = bisect.bisect_right(lengths, room, 0, top) - 1
        passed = None
        while at >= 0 and budget[0] > 0:
            length = lengths[at]
            if passed is not None:
                bound = min(bound, passed - length)
            most = min(counts[length], room // length)
            if most:
                budget[0] -= 1
                for k in range(most, 0, -1):
                    search(room - k * length, at, bound if k == most else min(bound, length), [*taken, (length, k)])
                    if best and (best[0][0] == 0 and len(best) >= want or budget[0] <= 0):
                        return
                passed = length
            at -= 1
        if room < bound and (len(best) < want or room < best[-1][0]):
            if all(room != w or taken != p for w, p in best):
                best.append((room, taken))
                best.sort(key=lambda b: b[0])
                del best[want:]

    search(rest, len(lengths), rest + 1, [])
    if spent is not None:
        spent[0] += nodes - budget[0]
    return best


def _waste(pattern: Pattern, capacity: int) -> int:
    return capacity - sum(length * k for length, k in pattern)


def descend(counts: dict[int, int], capacity: int, prefix: list[tuple[Pattern, int]], choice: int, most: int | None,
            nodes: int, spent: list[int], limit: float = math.inf) -> tuple[list[tuple[Pattern, int]], bool]:
    """One descent of bin completion that starts with ``prefix`` and takes the ``choice``-th filling next: the plan, and
    whether it is whole. It is cut short if the choice does not exist, if the waste shows that no fewer than ``most``
    sequences come out, or if ``spent`` reaches ``limit``."""
    left, plan = dict(counts), list(prefix)
    tokens = sum(k * v for k, v in left.items())
    allowed = math.inf if most is None else (most - 1) * capacity - tokens
    for pattern, times in prefix:
        allowed -= _waste(pattern, capacity) * times
        for length, k in pattern:
            left[length] -= k * times
    lengths = sorted(length for length, n in left.items() if n)
    while lengths:
        if spent[0] >= limit:
            return plan, False
        top = lengths[-1]
        left[top] -= 1
        found = fillings(left, lengths, capacity - top, nodes, choice + 1, spent) or [(capacity - top, [])]
        left[top] += 1
        if choice >= len(found):
            return plan, False
        waste, taken = found[choice]
        choice = 0
        use: dict[int, int] = {top: 1}
        for length, k in taken:
            use[length] = use.get(length, 0) + k
        times = min(left[length] // k for length, k in use.items())
        plan.append((list(use.items()), times))
        allowed -= waste * times
        if allowed < 0:
            return plan, False
        for length, k in use.items():
            left[length] -= k * times
            if not left[length]:
                del lengths[bisect.bisect_left(lengths, length)]
    return plan, True


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """The first descent of bin completion."""
    return descend(counts, capacity, [], 0, None, nodes, [0])[0]


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = BRANCH_NODES) -> list[tuple[Pattern, int]]:
    """Patterns with multiplicities that use every counted length."""
    size = lambda plan: sum(n for _, n in plan)
    bound = math.ceil(sum(k * v for k, v in counts.items()) / capacity)
    best = best_fit_decreasing(counts, capacity)
    branches: list[tuple[int, int, list[tuple[Pattern, int]], int, int]] = [(0, 0, [], 0, 0)]
    spent, made, descents = [0], 0, 0
    while branches and size(best) > bound and spent[0] < nodes and descents <= BRANCHES:
        descents += 1
        deviations, _, prefix, step, choice = heapq.heappop(branches)
        prefix = prefix[:step]
        limit = nodes if deviations else math.inf
        plan, whole = descend(counts, capacity, prefix, choice, size(best) if deviations else None, NODES, spent, limit)
        if not deviations:
            spent[0] = 0
        if whole and size(plan) < size(best):
            best = plan
        start = len(prefix) + (deviations > 0)  # the other choices at this step wait in the queue already
        first = next((k for k in range(start, len(plan)) if _waste(plan[k][0], capacity)), start - 1)
        for step in range(first, max(start, first - BACK) - 1, -1):
            for other in range(1, WIDTH):
                made += 1
                heapq.heappush(branches, (deviations + 1, made, plan, step, other))
    return best


def _runs(plan: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Where the ranks of each length go: sorted key (length, first rank) and the run's place."""
    rows, used, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length, k in pattern:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, k, offset))
            used[length] = rank + k * times
            offset += k * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 44) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2],
            "per": table[:, 3], "offset": table[:, 4]}


def _place(runs):
    def run(batches):
        r = runs.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(r["key"], (length << 44) + rank, side="right") - 1
            into = rank - r["rank"][at]
            sequence = r["sequence"][at] + into // r["per"][at]
            offset = r["offset"][at] + into % r["per"][at] * length
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[
                "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are pieces of one id; repeated rows and null ids are packed each; equal lengths are placed
    in a fixed order; an empty table gives an empty one; further columns are ignored.
    """
    spark = docs.sparkSession
    pieces = stage(token_pieces(docs, tokenizer_path, id, text, capacity, end_id), "packing-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(_runs(plan_packing(histogram, capacity)))
    buckets = max(1, math.ceil(sum(histogram.values()) / BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("inside", F.row_number().over(inside)).join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("inside") - 1)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        _place(runs), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
