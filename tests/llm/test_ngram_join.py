import random
import re

import pytest

from telemetra.llm import ngram_join as nj

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def grams(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [(i, grams(t)) for i, t in rows if i is not None]
    links = [0] * len(sets)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(sets[a][1] & sets[b][1])
            if both and both >= 0.8 * len(sets[a][1] | sets[b][1]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[find(k)] = min(low.get(find(k), i), i)
    return {i: (low[find(k)], links[k]) for k, (i, _) in enumerate(sets)}


def corpus():
    rng = random.Random(5)
    vocabulary = ["w%d" % k for k in range(400)] + ["é", "ñandú"]
    rows, n = [], 0
    for group in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 40, 120]))]
        for _ in range(rng.choice([1, 2, 5, 12])):
            changed = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((n, (" " if rng.random() < 0.5 else ". ").join(changed).title()))
            n += 1
    return rows + [(n, None), (n + 1, ""), (n + 2, "  ... "), (n + 3, "one two"), (n + 4, "One, TWO!")]


@pytest.mark.parametrize("tile", [1024, 3])
def test_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(nj, "TILE_DOCS", tile)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, rep string, component int")
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.ngram_join(docs).collect()}
    assert got == brute(rows)


def test_long_chain_meets_bucket_by_bucket(spark, monkeypatch):
    monkeypatch.setattr(nj, "TILE_DOCS", 3)
    words = [f"w{k}" for k in range(260)]
    rows = [(k, " ".join(words[2 * k:2 * k + 60])) for k in range(90)]  # neighbours are near, ends share nothing
    rows += [(100 + k, " ".join(words[:60] + [f"tail{k}"])) for k in range(12)] + corpus_rows(200)
    seen = []
    tiled = nj.tiled
    monkeypatch.setattr(nj, "tiled", lambda sets, bands: seen.append(tiled(sets, bands)) or seen[-1])
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    kinds = {r["band"] for r in seen[0].select("band").distinct().collect()}
    assert -1 in kinds and len(kinds) > 10
    # A text is in at most three tiles of a bucket side here, never in as many as its chain has parts in every band.
    assert seen[0].filter("band >= 0").groupBy("class", "band").count().agg({"count": "max"}).first()[0] <= 8


def corpus_rows(first):
    return [(first + i, t) for i, t in corpus()]


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id, r.n_links, r.kept) for r in nj.ngram_join(docs).collect())
    assert got == [(0, None, 0, True), (1, 1, 2, True), (1, 1, 2, True), (2, 1, 2, False)]
    assert sorted((r.doc_id or 0) for r in nj.drop_near_copies(docs).collect()) == [0, 1]
    assert nj.ngram_join(docs.limit(0)).count() == 0


def test_different_texts_share_an_id(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    near = [(2, a + " tail"), (3, b + " tail")]
    alone = [(5, " ".join(f"c{k}" for k in range(60))), (5, " ".join(f"d{k}" for k in range(60))), (6, ""), (6, "")]
    rows = [(1, a), (1, b), (1, a.upper()), *near, *alone]
    docs = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, k1 string, component long").repartition(3)
    got = sorted((r.doc_id, r.class_id, r.n_links, r.kept) for r in nj.ngram_join(docs).collect())
    assert got == [(1, 1, 1, True), (1, 1, 2, True), (1, 1, 2, True), (2, 1, 2, False), (3, 1, 1, False),
                   (5, 5, 0, True), (5, 5, 0, True), (6, 6, 0, True), (6, 6, 0, True)]
    kept = nj.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, (r.text or "").lower()) for r in kept.collect()) == sorted([(1, a), (1, b), *alone])


def test_a_hot_id_equals_brute_force(spark):
    rows = [(7 if i % 3 else i, t) for i, t in corpus()]
    want = brute([(k, t) for k, (_, t) in enumerate(rows)])
    low = {}
    for k, (group, _) in want.items():
        low[group] = min(low.get(group, rows[k][0]), rows[k][0])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in nj.ngram_join(docs).collect())
    assert got == sorted((rows[k][0], low[group], links) for k, (group, links) in want.items())
    assert nj.drop_near_copies(docs).count() == len(low)


def test_banding_meets_recall():
    bands, rows = nj.banding(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995
