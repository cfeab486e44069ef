import base64
import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from telemetra.llm import license_scan, quality, secret_scan, sharding, textcols, toxicity

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark, texts, schema="doc_id long, text string, spans string, shard int, _n long"):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], schema)


# quality

def test_quality_counts(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "a b a b a b a b", "x\n x\nx\n\n\n", "é ü\n#* <|>\né ü", "w " * 60]
    texts += ["".join(rng.choice(["a ", "b ", "c", "\n", "# ", "é ", "the "]) for _ in range(rng.randint(1, 200))) for _ in range(60)]
    got = {r.doc_id: r for r in quality.quality_digest(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at: dict = {}
        for k in range(len(words) - 2):
            at.setdefault(tuple(words[k:k + 3]), []).append(k)
        repeat = {k + d for places in at.values() if len(places) > 1 for k in places for d in range(3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeat))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(t)
        assert r.base_failed == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality.quality_digest(table(spark, []).limit(0)).count() == 0


def test_quality_filter_keeps_columns_and_clean_rows(spark):
    clean = " ".join(f"word{k} of the" for k in range(40))
    docs = table(spark, [clean, clean, None, clean.replace("word", "###"), "short"])
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1]


def test_quality_plan_is_native(spark):
    plan = quality.quality_digest(table(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# words

def test_words_longer_than_slices(monkeypatch):
    rng = random.Random(8)
    texts = [None, "", "a" * 700, "ab " * 90, "é" * 333 + " x", "end"] + [
        "".join(rng.choice("abcé 0") for _ in range(rng.randint(0, 400))) for _ in range(40)] + ["b" * 500, "b" * 500 + "c"]
    whole = textcols.word_hashes(pa.array(texts, pa.string()), (2, 100))
    for size in (16, 64, 100):
        monkeypatch.setattr(textcols, "SLICE", size)
        parts = textcols.word_hashes(pa.array(texts, pa.string()), (2, 100))
        assert all((x == y).all() for x, y in zip(whole, parts))
    assert len(whole[0]) == sum(len(re.findall("[0-9a-z\x80-\U0010ffff]+", t or "")) for t in texts)


# secrets

BASE = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def test_deep_headers_and_long_runs_are_harmless(spark):
    deep = base64.urlsafe_b64encode(b'{"a":' + b"[" * 10_000).rstrip(b"=").decode()
    good = base64.urlsafe_b64encode(b'{"alg":"HS256"}').rstrip(b"=").decode()
    word = base64.urlsafe_b64encode(b'"algorithm"').rstrip(b"=").decode()
    texts = [f"{deep}.x.y", f"{good}.x.y {deep}.x.y", "eyJ" * 350_000, "eyJ" * 1000 + f".a {good}.b.c", f"eyJ{word}.a.b", "eyJ.eyJ." * 100_000]
    automaton = secret_scan.build_automaton()
    began = time.monotonic()
    found = [[s for s in secret_scan.find_secrets(t.encode(), automaton) if s[0] == "jwt"] for t in texts]
    assert time.monotonic() - began < 2
    end = len(good) + 4
    assert found[:5] == [[], [("jwt", 0, end)], [], [("jwt", 3003, 3003 + end)], []]
    docs = table(spark, texts)
    assert secret_scan.secret_digest(docs).count() == len(texts)
    kept = {r.doc_id: r.text for r in secret_scan.redact_secrets(docs).collect()}
    assert kept[0] == texts[0] and kept[1] == f"[SECRET] {deep}.x.y"


def base_spans(text):
    found = [(m.start(), list(BASE).index(kind), f"{kind}:{m.start()}:{m.end()}") for kind, p in BASE.items()
             for m in p.finditer(text) if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]]
    return [s for *_, s in sorted(found)]


def test_secrets_equal_plain_patterns(spark):
    rng = random.Random(4)
    bits = ["password", "Token", "API_KEY", "apikey", "secret", "passwd", '"', "'", " ", "=", ":", "é", "ſecret=abcdefgh", "AKIA",
            "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "xyz123", "\n", "tokentoken=", "AKIAAKIA"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, "", "a" * 30000]
    got = {r.doc_id: r for r in secret_scan.secret_digest(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        spans = base_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), repr(t)
        assert [getattr(got[i], f"n_{k}") for k in BASE] == [sum(s.startswith(k) for s in spans) for k in BASE]
        assert set(spans) <= set(got[i].spans.split(",")) | {""}


def test_checksums_decide(spark):
    body = b"Ab0" * 10
    good = (b"ghp_" + body + secret_scan.crc_base62(body)).decode()
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    web = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc"
    r = {x.doc_id: x.spans for x in secret_scan.secret_digest(table(spark, [f"é {good}", bad, web, "eyJxx.a.b"])).collect()}
    assert r == {0: "github:2:42", 1: "", 2: f"jwt:0:{len(web)}", 3: ""}


def test_redaction_keeps_rows_and_other_text(spark):
    texts = ["é password=abcdef123 é", "nothing", None, "token: 0123456789abcdef0123456789 end"]
    docs = table(spark, texts).withColumnRenamed("_n", "n_chars")
    out = {r.doc_id: r for r in secret_scan.redact_secrets(docs).collect()}
    assert [out[i].text for i in range(4)] == ["é [SECRET] é", "nothing", None, "[SECRET] end"]
    assert [out[i].n_chars for i in range(4)] == [12, 2, 2, 12]


# licenses

def test_licenses_equal_brute_force(spark):
    rng = random.Random(6)
    bits = ["MIT", "license", "Apache", "general", "public", "GNU", "the", "under", "licensed", "version", "é", "x"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    for t in license_scan.TEMPLATES:
        words = t.text.split()
        texts += ["q " * rng.randint(0, 90) + " ".join(w for w in words if rng.random() < p) + " z" * rng.randint(0, 90)
                  for p in (1.0, 0.9, 0.75)]
    texts += [None, "", "mit-License" * 2]
    got = {r.doc_id: r for r in license_scan.license_digest(table(spark, texts)).collect()}
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    for i, t in enumerate(texts):
        words = find((t or "").translate(ASCII_LOWER))
        places, labels, best = [], set(), 0.0
        for x in license_scan.TEMPLATES:
            w = find(x.text.translate(ASCII_LOWER))
            if x.phrase:
                places += [(k, x.label) for k in range(len(words) - len(w) + 1) if words[k:k + len(w)] == w]
                continue
            need, size = math.ceil(x.threshold * len(set(w)) - 1e-9), 1 << max(3, math.ceil(math.log2(2 * len(w))))
            for b in range(0, len(words), size // 2):
                met = len(set(w) & set(words[b:b + size]))
                if met >= need:
                    labels.add(x.label)
                    best = max(best, met / len(set(w)))
        base = {x for _, x in places}
        starts = [k for k, _ in places]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (
            len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels))), repr(t)
        assert r.score == pytest.approx(1.0 if places else best)


# sharding

def test_shards_are_balanced_whole_and_gapless(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    rng = random.Random(8)
    texts = ["w" * int(rng.lognormvariate(5, 1)) + f" {k}" for k in range(1500)] + ["copy text"] * 700 + ["other copy"] * 30 + [None, "", "é"]
    rows = sharding.shard_digest(table(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    slots, load, homes = {}, np.zeros(24), {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] += r.size
        homes.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert load.max() - load.min() <= 0.01 * load.mean()
    assert [t for t, where in homes.items() if len(where) > 1] == ["copy text"]  # seven times a shard's rows
    assert sharding.shard_digest(table(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("hot", [None, 5])
def test_copies_under_one_id_are_dealt_over_shards(spark, hot):
    rows = [(hot, "copy text")] * 3000 + [(k, f"text number {k}") for k in range(100, 2100)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    load, slots = np.zeros(24), {}
    for r in got:
        load[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert load.max() - load.min() <= 0.02 * load.mean()
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# toxicity

def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 500 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    hits = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hits >= 0.95 * sum(r.predicted for r in rows) and hits >= 0.8 * sum(r.toxic for r in rows)


def test_label_model_learns_from_votes_without_labels():
    rng = np.random.default_rng(5)
    truth = rng.random(6000) < 0.15
    marks = [np.where(rng.random(6000) < np.where(truth, hit, miss), 1, -1)
             for hit, miss in ((0.7, 0.02), (0.6, 0.02), (0.5, 0.03), (0.6, 0.01))]
    marks += [marks[0]] * 3  # one voter that repeats another
    marks.append(np.where(rng.random(6000) < 0.05, 1, -1))  # one that knows nothing
    gold = np.full(6000, -1)
    gold[:300] = truth[:300]
    votes = np.column_stack(marks)
    posterior, weight = toxicity.label_model(votes, gold)
    assert ((posterior >= 0.5) == truth).mean() > 0.95
    assert weight[0] < 0.3 and weight[1] > 0.7
    # The labels only name the classes: a wrong one on a row does not move that row.
    wrong = gold.copy()
    wrong[:3] = 1 - wrong[:3]
    again, _ = toxicity.label_model(votes, wrong)
    assert np.abs(again - posterior).max() < 0.05


def test_label_model_keeps_toxic_texts_of_every_language():
    rng = np.random.default_rng(8)
    truth = rng.choice([0, 1, 2], 6000, p=[0.88, 0.09, 0.03])  # clean, toxic in a frequent and in a rarer language
    marks = [np.where(rng.random(6000) < np.where(truth == kind, 0.45, 0.001), 1, -1) for kind in (1, 2) for _ in range(16)]
    votes = np.column_stack([*marks, np.where((np.stack(marks) == 1).any(0), -1, 0)])
    gold = np.where(np.arange(6000) < 2000, truth > 0, -1)
    posterior, _ = toxicity.label_model(votes, gold)
    for kind in (1, 2):
        assert (posterior[truth == kind] >= 0.5).mean() > 0.97
    assert (posterior[truth == 0] < 0.5).mean() > 0.99


def test_kinds_are_rows_of_voters_that_meet():
    marks = np.zeros((60, 6), bool)
    marks[:40, :2], marks[40:58, 2:4] = True, True
    marks[:2, 4], marks[57, 5] = True, True
    assert toxicity.toxic_kinds(marks).tolist() == [0] * 40 + [1] * 18 + [-1] * 2
    few = np.eye(4, dtype=bool)  # four kinds of one row are too few
    assert toxicity.toxic_kinds(few).tolist() == [0] * 4
    assert toxicity.toxic_kinds(few[:0]).tolist() == [] and toxicity.toxic_kinds(few[:, :0]).tolist() == [-1] * 4


def test_toxic_texts_of_a_rarer_language_go(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        rare, bad = i % 4 == 0, i % 5 == 0
        words = [f"{'yk' if rare else 'we'}{rng.randrange(400):03d}" for _ in range(40)]
        if bad:
            words += rng.sample([f"{'zum' if rare else 'bad'}{k}x" for k in range(24)], 8)
        rows.append((i, " ".join(words), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    kept = toxicity.drop_toxic(docs.drop("toxic"), docs.filter("doc_id < 1000").select("doc_id", "toxic"))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, bad in rows if not bad]


def test_mined_voters_are_precise_and_different():
    toxic = np.arange(200) < 40
    first, other = np.arange(200) < 20, (np.arange(200) >= 20) & (np.arange(200) < 38)
    nearly, vague = np.arange(200) < 19, np.arange(200) % 2 == 0
    assert toxicity.mine_voters(np.column_stack([first, nearly, vague, other]), toxic, [0, 1, 2, 3]) == [0, 3]


def test_fit_sample_is_bounded_for_one_hot_id(spark):
    docs = spark.createDataFrame([(1 if i % 2 else i, f"text number {i} of all") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in (1, 2, 4)], "doc_id long, toxic int")
    rows = toxicity.fit_sample(docs, labels, rows=5, texts=10).collect()
    assert 10 <= len(rows) <= 13 and len({r.id for r in rows}) == len(rows)
    assert {r.id: r.toxic for r in rows if r.toxic is not None} == {1: 1, 2: 0, 4: 0}


def test_every_row_goes_by_its_own_score(spark):
    words = ["fine day", "you idiot"]
    rows = [(i, f"{words[i % 2]} number{i}", i) for i in range(200)]
    rows += [(None, "you idiot again", 200), (None, "fine day again", 202), (1, "fine day here", 204), (0, "you idiot here", 205)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long")
    kept = toxicity.drop_toxic(docs, spark.createDataFrame([(i, i % 2) for i in range(2, 200)], "doc_id long, toxic int"))
    assert kept.columns == docs.columns
    assert sorted(r.id for r in kept.collect()) == [*range(0, 200, 2), 202, 204]


def test_toxicity_never_reads_held_out_labels(spark):
    words = ["fine day", "you idiot"]
    docs = spark.createDataFrame([(i, f"{words[i % 2]} number{i}", None) for i in range(200)] + [(None, "x", 1), (7, None, 1)],
                                 "doc_id long, text string, score int")
    labels = [(i, i % 2) for i in range(200)]
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    schema = "doc_id long, toxic int"
    first, second = (sorted(toxicity.toxicity(docs, spark.createDataFrame(x, schema)).collect(), key=str) for x in (labels, flipped))
    assert first == second and len(first) == 202
    assert all(r.predicted == r.doc_id % 2 for r in first if r.doc_id not in (None, 7))
    alone = toxicity.toxicity(docs, spark.createDataFrame([], schema)).collect()
    assert len({r.score for r in alone}) == 1 and len(alone) == 202
