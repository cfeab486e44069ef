import hashlib
import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from telemetra.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def expected(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(BASE.items())
             for m in re.finditer(p, text or "") if valid(kind, m.group())]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, code int")


def corpus():
    rng = random.Random(5)
    card = "4111 1111 1111 1111"
    texts = [None, "", "a@b.c-d@e.f", "a@b.com_x@y.z", "x@y@z.com", "a@b..c a@b.c.", "1.2.3.4.5.6.7.8", "256.1.1.1 000255.0.0.1", card + card,
             "+1 (614) 555-8001.", "+12345678", "+1+1 234 567 890 1", "\x01\x02 a@b.c \x01 é👩 +49 30 1234567", "9" * 40, "-" * 30 + "1 2-3",
             "12.13.14.15@h.com", "a" * 2000 + "@b.c", "1" * 2000, "1." * 2000, "+" + "." * 2000, "a@" * 2000, "a@b.c " * 3000]
    pieces = ["a", "@", ".", "b.c", "1", "22", "255", "-", " ", "+", "(", ")", "4111111111111111", "é", "\n", "%", "_", "x@y.zz", "10.0.0.1"]
    return texts + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))) for _ in range(600)]


def test_base_spans_equal_the_plain_patterns(spark):
    texts = corpus()
    rows = {r.doc_id: r for r in pii.pii_digest(table(spark, texts).repartition(4)).collect()}
    for i, t in enumerate(texts):
        want = expected(t)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        r = rows[i]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (t or "")[:200]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, *_ in want) for x in BASE)
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in BASE] == (listed.split(",") if listed else [])


def test_hostile_texts_take_linear_time(spark):
    long = ["a" * 3_000_000, "1" * 1_000_000, "1." * 300_000, "+" + "." * 1_000_000, "a@" * 200_000, "a@b.c " * 40_000, "1 " * 500_000,
            "1.2.3.4 " * 20_000, "+1 2345678 " * 20_000]
    began = time.monotonic()
    rows = {r.doc_id: r for r in pii.pii_digest(table(spark, long)).collect()}
    assert time.monotonic() - began < 60
    assert rows[5].n_email == 40_000 and rows[7].n_ip == 20_000 and rows[2].n_ip == 75_000
    assert rows[5].spans.endswith(",email:239994:239999")


MORE = ["My ssn: 536-22-1234.", "write to jane.doe [at] example [dot] com today", "IBAN: DE89370400440532013000, thanks", "call 614-555-8001",
        "mac 00:1a:2B:3c:4d:5e.", "Patient: Mrs. Maria Lopez, born", "She lives at 12 Oak Hill Street, near"]


def test_further_kinds_are_found_and_clean_texts_left_alone(spark):
    texts = MORE * 20 + ["plain words only", "version 614-555-8001x", "ref DE89370400440532013001"] * 20 + [
        "mail ann@example.com or call +1 614 555 8001", "ip 8.8.4.4 card 4111 1111 1111 1111"] * 50
    docs = table(spark, texts)
    rows = {r.doc_id: r for r in pii.pii_scan(docs).collect()}
    kinds = ["ssn", "hidden_email", "iban", "local_phone", "mac", "name", "address"]
    for i, t in enumerate(texts):
        spans = rows[i].spans
        assert all(t[s.start:s.end] == s.value and 0 <= s.score <= 1 for s in spans)
        if t in MORE:
            assert kinds[MORE.index(t)] in [s.kind for s in spans], t
        if t in texts[140:143]:
            assert not spans, t


def test_label_model_finds_the_reliability_of_voters():
    rng = np.random.default_rng(1)
    true = rng.random(40_000) < 0.5
    wanted = {"shape": 0.95, "gazetteer": 0.8, "context": 0.7, "against": 0.65, "edges": 0.9, "crowd": 0.6}
    code = np.zeros(len(true), np.int64)
    for name in pii.LABELERS:
        right = rng.random(len(true)) < wanted[name]
        vote = np.where(rng.random(len(true)) < 0.7, np.where(right, true, ~true) * 2 - 1, 0)
        code = code * 3 + vote + 1
    codes, at, n = np.unique(code * len(pii.KINDS), return_inverse=True, return_counts=True)
    posterior, accuracy = pii.label_model(codes, n.astype(float))
    assert all(abs(accuracy[k] - wanted[k]) < 0.02 for k in wanted)
    weights = pii.train_classifier(codes, n.astype(float), posterior)
    assert ((posterior[at] > 0.5) == true).mean() > 0.93
    score = 1 / (1 + np.exp(-pii._features(codes) @ weights))
    assert ((score[at] > 0.5) == true).mean() > 0.93


def test_score_expression_is_the_model(spark):
    weights = np.linspace(-2, 2, 2 * len(pii.LABELERS) + len(pii.KINDS) + pii.LENGTHS)
    codes = np.arange(0, len(pii.KINDS) * 3 ** len(pii.LABELERS) * pii.LENGTHS, 37)
    got = [r.s for r in spark.createDataFrame([(int(c),) for c in codes], "c int").select(
        "c", pii.score_expression(F.col("c"), weights).alias("s")).sort("c").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-pii._features(codes) @ weights)))


def test_plan_is_native_and_empty_table_works(spark):
    docs = table(spark, ["a"])
    plan = docs.select(pii.candidates(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert pii.pii_digest(docs.limit(0)).count() == 0
    null_ids = pii.pii_digest(spark.createDataFrame([(None, "a@b.cc"), (None, "a@b.cc"), (7, None)], "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.n_email) for r in null_ids.collect()) == [(0, 1), (0, 1), (7, 0)]
