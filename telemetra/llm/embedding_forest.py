"""Embedding near-duplicates by a forest of random-projection trees.

1. Equal vectors of a label are one class with a number of copies.
2. Trees are fitted on a bounded sample (``SAMPLE`` rows, chosen by a hash of the id): every level of a tree has one
   random direction, every node splits at the median of its sample's projections. Vectors within a margin of a split
   go to both sides; the margin is ``SPILL`` standard deviations of the projected distance of a pair at the
   threshold, so such a pair is rarely parted, and then by other splits in every tree. A node that its split can no
   longer shrink (a dense group) stays a leaf.
3. Every vector is routed through all trees; vectors of one label compare within leaves, in double precision. Leaves
   of more than ``TILE`` vectors are compared tile by tile in separate tasks.
4. A pair that meets in several leaves counts only in the first leaf the two have in common, which both carry, so
   links are counted and reduced to a spanning forest inside the task and pairs are never written out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.graph import connected_components
from telemetra.llm.ngram_join import forest
from telemetra.llm.staging import stage

THRESHOLD = 0.98
TREES = 8
SAMPLE = 20_000
LEAF = 512
SPILL = 0.8
TILE = 1024
MAX_DEPTH = 24


def _unit(batches):
    for batch in batches:
        rows = batch.column("vector").to_pylist()
        out = []
        for id, label, values in zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), rows):
            if id is None or label is None or not values or None in values:
                continue
            v = np.array(values, np.float64) + 0.0  # -0.0 becomes 0.0
            if not np.isfinite(v).all() or not v.any():
                continue
            key = hashlib.blake2b(v.tobytes(), digest_size=16).digest()
            v = v / np.abs(v).max()  # no overflow in the norm
            out.append((id, label, len(v), key, (v / np.sqrt(v @ v)).tobytes()))
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
            names=["id", "label", "dim", "key", "unit"])


def fit_forest(sample: np.ndarray, total: int, margin: float, trees: int = TREES, leaf: int = LEAF) -> dict:
    """Directions (tree, level, dim) and per tree the nodes: split, left, right; right < 0 marks leaf -right - 1 of
    the whole forest. ``total`` is the number of rows the sample stands for."""
    rng = np.random.default_rng(11)
    directions = rng.standard_normal((trees, MAX_DEPTH, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    small = max(4, int(leaf * len(sample) / max(total, 1)))
    nodes, leaves = [], 0
    for t in range(trees):
        projected = sample @ directions[t].T
        split, left, right = [], [], []
        queue = [(np.arange(len(sample)), 0, None)]
        while queue:
            rows, level, parent = queue.pop()
            me = len(split)
            split.append(0.0)
            left.append(-1)
            right.append(0)
            if parent is not None:
                (left if parent[1] else right)[parent[0]] = me
            if len(rows) > small and level < MAX_DEPTH:
                p = projected[rows, level]
                at = float(np.median(p))
                sides = rows[p <= at + margin], rows[p >= at - margin]
                if max(map(len, sides)) <= 0.9 * len(rows):
                    split[me] = at
                    queue += [(sides[0], level + 1, (me, True)), (sides[1], level + 1, (me, False))]
                    continue
            leaves += 1
            right[me] = -leaves
        nodes.append((np.array(split), np.array(left), np.array(right)))
    return {"directions": directions, "nodes": nodes, "margin": margin}


def route(units: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) pairs of all trees, by row and then leaf; leaf numbers are unique in the forest."""
    rows_out, leaves_out = [], []
    for directions, (split, left, right) in zip(model["directions"], model["nodes"]):
        projected = units @ directions.T
        rows, node, level = np.arange(len(units)), np.zeros(len(units), np.int64), 0
        while len(rows):
            done = right[node] < 0
            rows_out.append(rows[done])
            leaves_out.append(-right[node[done]])
            rows, node = rows[~done], node[~done]
            if not len(rows):
                break
            p, s = projected[rows, level], split[node]
            low, high = p <= s + model["margin"], p >= s - model["margin"]
            rows, node = np.concatenate([rows[low], rows[high]]), np.concatenate([left[node[low]], right[node[high]]])
            level += 1
    rows, leaves = np.concatenate(rows_out), np.concatenate(leaves_out)
    order = np.lexsort((leaves, rows))
    return rows[order], leaves[order]


def _route(model):
    def run(batches):
        forest_ = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                units = np.stack([np.frombuffer(u) for u in part.column("unit").to_pylist()])
                rows, leaves = route(units, forest_)
                offsets = np.searchsorted(rows, np.arange(len(units) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(leaves.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "leaves"])
    return run


def _compare(threshold: float):
    def run(key, table):
        leaf, i, j = (k.as_py() for k in key[2:5])
        rep, copies, side = (table.column(c).to_numpy() for c in ("rep", "copies", "side"))
        units = np.stack([np.frombuffer(u) for u in table.column("unit").to_pylist()])
        near = np.triu(units @ units.T >= threshold, 1)
        if i != j:
            near &= side[:, None] != side[None, :]
        some = np.flatnonzero(near.any(0) | near.any(1))
        rep, copies, near = rep[some], copies[some], near[np.ix_(some, some)]
        lists = table.column("leaves").take(pa.array(some)).to_pylist()
        owner = np.repeat(np.arange(len(some)), [len(x) for x in lists])
        leaves = np.array([x for one in lists for x in one], np.int64)
        owner, leaves = owner[leaves < leaf], leaves[leaves < leaf]
        names, column, met = np.unique(leaves, return_inverse=True, return_counts=True)
        earlier = np.zeros((len(some), len(names)), np.float32)
        earlier[owner, column] = 1
        earlier = earlier[:, met > 1]
        left, right = np.nonzero(near & (earlier @ earlier.T == 0))
        links = np.zeros(len(some), np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        root = forest(len(some), left, right)
        low = np.full(len(some), np.iinfo(np.int64).max)
        np.minimum.at(low, root, rep)
        linked = np.flatnonzero(links)
        return pa.table({"a": rep[linked], "b": low[root[linked]], "links": links[linked]})
    return run


def _links(classes: DataFrame, dim: int, total: int, threshold: float) -> DataFrame:
    """(a, b, links): spanning links and link counts among the classes of one dimension."""
    spark = classes.sparkSession
    mine = classes.filter(F.col("dim") == dim).select("rep", "label", "copies", "unit")
    share = min(1 << 30, (SAMPLE << 30) // max(total, 1))
    picked = mine.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < share).orderBy("rep").select("unit").collect()
    sample = np.array([np.frombuffer(r["unit"]) for r in picked]).reshape(-1, dim)
    if not len(sample):
        sample = np.zeros((1, dim))
    margin = SPILL * float(np.sqrt((2 - 2 * threshold) / dim))
    model = spark.sparkContext.broadcast(fit_forest(sample, total, margin))
    routed = stage(mine.mapInArrow(_route(model), "rep long, label long, copies long, unit binary, leaves array<int>"),
                   "forest-routed")
    placed = routed.withColumn("leaf", F.explode("leaves"))
    size = placed.groupBy("label", "leaf").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"),
                                               F.count("*").alias("n")).filter("n > 1").drop("n")
    side = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    tiles = placed.join(size, ["label", "leaf"]).withColumn("side", side).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = tiles.select(F.lit(dim).alias("dim"), "label", "leaf", F.least("side", "other").alias("i"),
                         F.greatest("side", "other").alias("j"), "rep", "copies", "side", "unit", "leaves")
    return stage(tiles.groupBy("dim", "label", "leaf", "i", "j").applyInArrow(
        _compare(threshold), "a long, b long, links long"), "forest-links")


def embedding_forest(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
                     threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors link if their labels are equal and not null and their cosine reaches the threshold; null, empty and zero
    vectors and those with null or non-finite components link with nothing, nor do vectors of different lengths.
    Repeated rows are copies of each other. A row with a null id is not compared and comes back with a null component,
    no links and kept. An empty table gives an empty one; further columns are ignored.
    """
    source = vectors.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                            F.col(vector).cast("array<double>").alias("vector"))
    valid = stage(source.mapInArrow(_unit, "id long, label long, dim int, key binary, unit binary"), "forest-units")
    classes = stage(valid.groupBy("label", "dim", "key").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("unit").alias("unit")), "forest-classes")
    found = None
    for r in classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect():
        links = _links(classes, r["dim"], r["n"], threshold)
        found = links if found is None else found.union(links)
    base = source.select("id")
    if found is None:
        known = valid.select("id", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    else:
        linked = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
        ties = connected_components(found.select("a", "b")).withColumnRenamed("id", "rep")
        final = classes.drop("unit").join(linked, "rep", "left").join(ties, "rep", "left").select(
            "label", "dim", "key", F.coalesce("component", "rep").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        known = valid.drop("unit").join(final, ["label", "dim", "key"])
    known = known.groupBy("id").agg(F.min("component_id").alias("component_id"), F.max("n_links").alias("n_links"))
    return base.join(known, "id", "left").select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
