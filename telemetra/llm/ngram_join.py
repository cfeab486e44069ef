"""N-gram Jaccard self-join: MinHash banding proposes, full n-gram sets decide.

1. Every text becomes its word 5-grams; texts with the same word sequence are one class with a number of copies. A
   class goes by a number of its own, since ids need not be unique.
2. ``bands`` x ``rows`` MinHash values per class, counted from the wanted recall at the threshold; band hashes are
   shuffled and only the smallest class of a bucket is handed back, so a bucket of any size costs its own length.
3. Classes tied by buckets form a candidate group. Its n-gram sets meet in tiles of bounded size; inside a tile the
   pairs that share a band are verified on the full sets, counted, and reduced to a spanning forest. Pairs are never
   written out, so thousands of near copies cost rows in proportion to the texts, not to the pairs.
   A group of more tiles a side than there are bands (a chain of buckets) would compare mostly texts that share none, so
   its texts meet bucket by bucket instead, and a pair counts in the first band it shares. So a text travels as often as
   there are bands, or as its buckets have tiles, however long the chain is.
4. Components over the verified links give the class ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from telemetra.llm.bloom import bloom_filter, bloom_hits
from telemetra.llm.graph import connected_components
from telemetra.llm.staging import stage
from telemetra.llm.textcols import mix, row_slices, shingles, word_hashes

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
TILE_DOCS = 1024
TILE_GRAMS = 1 << 21


def banding(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """(bands, rows) so that a pair at the threshold shares a band with at least the wanted probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)), rows


def band_hashes(grams: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts x bands) band hashes; every text must have at least one n-gram."""
    rng = np.random.default_rng(7)
    out = np.empty((len(offsets) - 1, bands), np.uint64)
    for b in range(bands):
        key = np.full(len(offsets) - 1, b + 1, np.uint64)
        for _ in range(rows):
            mask, odd = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
            key = mix(key * np.uint64(0x2545F4914F6CDD1D)
                      + np.minimum.reduceat((grams ^ mask) * (odd | np.uint64(1)), offsets[:-1]))
        out[:, b] = key
    return out


KEY = ["k1", "k2", "n_words"]  # of a word sequence; null without words


def _keys(h: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    """The columns ``KEY`` of the rows whose words are ``word_hashes`` (h, first)."""
    sizes = np.diff(first)
    some = np.flatnonzero(sizes)
    keys = np.zeros((3, len(sizes)), np.int64)
    if len(some):
        place = np.arange(len(h), dtype=np.uint64) - np.repeat(first[:-1], sizes).astype(np.uint64)
        parts = (mix(h + place * np.uint64(0x9E3779B97F4A7C15)),
                 mix((h ^ np.uint64(0x5DEECE66D)) * (place * np.uint64(2) + np.uint64(3))))
        for key, part in zip(keys, parts):
            key[some] = np.add.reduceat(part, first[some]).view(np.int64)
        keys[2] = sizes
    return [pa.array(key, mask=sizes == 0) for key in keys]


def _keyed(batches):
    for batch in row_slices(batches):
        yield pa.RecordBatch.from_arrays([*batch.columns, *_keys(*word_hashes(batch.column("text")))],
                                         names=[*batch.schema.names, *KEY])


def _chosen(bloom):
    """Like ``_keyed``, without the rows whose id and words no class in the filter has."""
    def run(batches):
        bits = np.frombuffer(bloom.value, np.uint64)
        for batch in _keyed(batches):
            batch = batch.filter(pc.is_valid(batch.column("k1")))
            key = batch.column("k1").to_numpy() ^ batch.column("id").to_numpy()
            yield batch.filter(pa.array(bloom_hits(bits, key.view(np.uint64))))
    return run


def _signatures(n: int, bands: int, rows: int):
    def run(batches):
        for batch in row_slices(batches):
            h, first = word_hashes(batch.column("text"))
            grams, offsets = shingles(h, first, n)
            has = np.diff(offsets) > 0
            sig = np.empty(0, np.int64)
            if has.any():
                sig = band_hashes(grams, np.append(offsets[:-1][has], offsets[-1]), bands, rows).view(np.int64).ravel()
            ends = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *_keys(h, first), pa.ListArray.from_arrays(pa.array(ends), pa.array(sig))],
                names=["id", *KEY, "sig"])
    return run


def _gram_sets(n: int):
    def run(batches):
        for batch in row_slices(batches):
            grams, offsets = shingles(*word_hashes(batch.column("text")), n)
            sets = [np.unique(grams[offsets[i]:offsets[i + 1]]).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("class", "n_words", "copies", "sig", "component", "parts")] + [pa.array(sets, pa.binary())],
                names=["class", "n_words", "copies", "sig", "component", "parts", "grams"])
    return run


def common_grams(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs of sorted sets, by the cheaper of two exact ways."""
    sizes = np.array([len(s) for s in sets])
    columns, inverse, met = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = int((met > 1).sum())
    if len(left) * (4000 + 12 * sizes.mean()) < 0.05 * len(sets) ** 2 * shared:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    number = np.where(met > 1, np.cumsum(met > 1) - 1, -1)[inverse]
    owner, number = owner[number >= 0], number[number >= 0]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, shared, 4096):
        a, b = np.searchsorted(number, (at, at + 4096))
        block = np.zeros((len(sets), min(4096, shared - at)), np.float32)
        block[owner[a:b], number[a:b] - at] = 1
        total += block @ block.T
    return total[left, right].astype(np.int64)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indices over the given links."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, left, root[right])
        np.minimum.at(low, right, root[left])
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low


def _verify(threshold: float):
    def run(key, table):
        table = table.sort_by("class")
        rep = table.column("class").to_numpy()
        copies = table.column("copies").to_numpy()
        side = table.column("side").to_numpy()
        sig = np.array(table.column("sig").to_pylist())
        sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        band, i, j = (key[c].as_py() for c in (1, 2, 3))
        likely = np.zeros((len(rep), len(rep)), bool)
        for b in range(sig.shape[1] if band < 0 else band):
            likely |= sig[:, b, None] == sig[None, :, b]
        if band >= 0:  # a tile of one bucket: pairs with an earlier band in common met there
            likely = ~likely
        likely &= np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes) - 1e-9
        if i != j:
            likely &= side[:, None] != side[None, :]
        left, right = np.nonzero(np.triu(likely, 1))
        if len(left):
            common = common_grams(sets, left, right)
            true = common >= threshold * (sizes[left] + sizes[right] - common) - 1e-9
            left, right = left[true], right[true]
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        root = forest(len(rep), left, right)
        some = np.flatnonzero(links)
        return pa.table({"a": rep[some], "b": rep[root[some]], "links": links[some]})
    return run


def tiled(sets: DataFrame, bands: int) -> DataFrame:
    """The classes of ``sets`` (repeated rows once) once for every tile they belong to: (at, band, i, j) names the tile, of a group as long as it has
    at most ``bands`` parts (band -1), of a bucket of band ``band`` in longer groups."""
    small, long = (sets.filter(which).dropDuplicates(["class"]) for which in (F.col("parts") <= bands, F.col("parts") > bands))
    small = small.select("*", F.col("component").alias("at"), F.lit(-1).alias("band")).drop("component")
    # The buckets are measured without the n-gram sets.
    placed = long.select("n_words", F.posexplode("sig").alias("band", "at"))
    size = placed.groupBy("band", "at").agg(F.count("*").alias("n"), tile_sides("n_words").alias("parts"))
    size = size.filter("n > 1").drop("n")
    long = long.drop("component", "parts").select("*", F.posexplode("sig").alias("band", "at")).join(size, ["band", "at"])
    both = small.unionByName(long)
    side = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    tiles = both.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return tiles.select("at", "band", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
                        "class", "copies", "side", "sig", "grams")


def tile_sides(words: str):
    """Aggregate: into how many parts texts of so many words are dealt, so that a tile is bounded."""
    return F.greatest(F.ceil(F.count("*") / TILE_DOCS), F.ceil(F.sum(words) / TILE_GRAMS)).cast("int")


def _numbered(classes: DataFrame) -> DataFrame:
    """``classes`` with a column ``class``, counted from 0 without gaps. Its column ``n`` holds staged values of
    ``monotonically_increasing_id``: task number and place in the task. So the driver sees one count a task."""
    task, before, starts = F.shiftright("n", 33).cast("int"), 0, []
    for r in sorted(classes.groupBy(task.alias("task")).agg(F.count("*").alias("rows")).collect()):
        starts.append((r["task"], before))
        before += r["rows"]
    starts = classes.sparkSession.createDataFrame(starts, "task int, start long")
    place = F.col("n").bitwiseAND(F.lit((1 << 33) - 1))
    return classes.withColumn("task", task).join(F.broadcast(starts), "task").withColumn(
        "class", F.col("start") + place).drop("task", "start", "n")


def linked_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS,
                threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: (id, k1, k2, n_words, component, class_id, n_links), the last six null for rows
    that are not compared. ``component`` tells apart groups whose smallest ids are equal."""
    bands, rows = banding(threshold, recall)
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    # A row without an id is not compared: it is left without words here.
    signed = stage(source.select("id", F.when(F.col("id").isNotNull(), F.col("text")).alias("text")).mapInArrow(
        _signatures(n, bands, rows), "id long, k1 long, k2 long, n_words long, sig array<long>"), "ngram-signatures")
    worded = signed.filter("n_words is not null")
    classes = _numbered(stage(worded.groupBy(*KEY).agg(
        F.min("id").alias("low_id"), F.count("*").alias("copies"), F.first("sig").alias("sig")).withColumn(
        "n", F.monotonically_increasing_id()), "ngram-classes"))

    buckets = classes.select("class", F.explode("sig").alias("bucket"))
    low = buckets.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    edges = buckets.join(low, "bucket").filter("class <> low").select(F.col("class").alias("a"), F.col("low").alias("b"))
    groups = stage(connected_components(edges).withColumnRenamed("id", "class").join(classes, "class")
                   .select("class", "component", *KEY, "low_id", "copies", "sig"), "ngram-groups")

    size = groups.groupBy("component").agg(tile_sides("n_words").alias("parts"))
    listed = groups.join(size, "component").withColumnRenamed("low_id", "id")
    # Several texts may share the class's smallest id, so the words are compared too; any row that agrees will do.
    # Only the texts of these rows travel: a filter of fixed size over id and words keeps the others back.
    chosen = docs.sparkSession.sparkContext.broadcast(bloom_filter(listed.select(F.col("k1").bitwiseXOR(F.col("id")).alias("key"))))
    sets = source.filter("id is not null").mapInArrow(
        _chosen(chosen), "id long, text string, k1 long, k2 long, n_words long")
    sets = sets.join(listed, ["id", *KEY]).drop("id", "k1", "k2").mapInArrow(
        _gram_sets(n), "class long, n_words long, copies long, sig array<long>, component long, parts int, grams binary")
    sets = stage(sets, "ngram-sets")
    found = stage(tiled(sets, bands).groupBy("at", "band", "i", "j").applyInArrow(
        _verify(threshold), "a long, b long, links long"), "ngram-links")

    linked = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    ties = connected_components(found.select("a", "b")).withColumnRenamed("id", "class")
    final = classes.drop("sig").join(linked, "class", "left").join(ties, "class", "left").select(
        *KEY, F.coalesce("component", "class").alias("component"), "low_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    final = stage(final, "ngram-final")
    names = final.groupBy("component").agg(F.min("low_id").alias("class_id"))
    final = final.join(names, "component").select(*KEY, "component", "class_id", "n_links")
    columns = ["id", *KEY, "component", "class_id", "n_links"]
    rest = signed.filter("n_words is null").drop("sig")
    for c in columns[4:]:
        rest = rest.withColumn(c, F.lit(None).cast("long"))
    return worded.drop("sig").join(final, KEY).select(*columns).unionByName(rest)


def ngram_join(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS,
               threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: (id, class_id, n_links, kept).

    Two texts are linked if the Jaccard similarity of their sets of word n-grams reaches the threshold. ``n_links``
    counts the other rows linked directly, ``class_id`` is the smallest id reachable, ``kept`` marks it. A text of
    fewer than ``n`` words is one gram of all its words; texts without words (null, empty, punctuation) link with
    nothing. Repeated rows are copies of each other; different texts under one id are compared as any others, so
    groups that do not touch may have equal smallest ids. Rows with a null id are not compared and come back with a
    null class, no links and kept. An empty table gives an empty one; further columns are ignored.
    """
    return linked_rows(docs, id, text, n, threshold, recall).select(
        F.col("id").alias(id), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("class_id") == F.col("id"), F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their class, with the same columns: of every class one row with its smallest
    id stays, whatever other rows share that id. Rows that are not compared (null id, no words) stay."""
    rows = stage(linked_rows(docs, id, text), "ngram-classes-of-rows")
    repeated = stage(rows.filter("id is not null").groupBy("id").count().filter("count > 1").select("id"), "ngram-repeated")
    going = rows.filter("class_id <> id").select("id").distinct()
    own = docs[id].cast("long")
    if repeated.isEmpty():  # ids are a key: no need to look at the texts once more
        return docs.join(going, own == going["id"], "left_anti").select(*docs.columns)
    elsewhere = going.union(repeated).distinct()
    single = docs.join(elsewhere, own == elsewhere["id"], "left_anti")
    # An id on several rows does not tell them apart, but id and words do, up to copies.
    stays = rows.filter("class_id = id").join(repeated, "id", "left_semi").groupBy("component").agg(
        F.min(F.struct("id", *KEY)).alias("key")).select("key.*")
    packed = docs.select(F.struct(*docs.columns).alias("row"), own.alias("id"), F.col(text).alias("text"))
    packed = packed.join(repeated, "id", "left_semi").select("row", "id", "text")
    shape = StructType([*packed.schema.fields, *(StructField(c, LongType()) for c in KEY)])
    packed = stage(packed.mapInArrow(_keyed, shape), "ngram-repeated-rows")
    once = packed.join(stays, ["id", *KEY], "left_semi").dropDuplicates(["id", *KEY])
    wordless = packed.filter("n_words is null")
    return single.select(*docs.columns).unionByName(once.unionByName(wordless).select("row.*"))
