import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from telemetra.llm import spelling


def count(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows):
    n = count(rows)
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def corpus():
    rng = random.Random(11)
    base = ["".join(rng.choice("abeéÀß") for _ in range(rng.randint(6, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "abababab", "bababa"]
    rows = []
    for i in range(260):
        words = []
        for _ in range(60):
            w = base[int(rng.random() ** 3 * len(base))]
            for _ in range(rng.random() < 0.25 and 1 + (rng.random() < 0.3)):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abx") + w[k:], w[:k] + rng.choice("abx") + w[k + 1:]])
            words.append(rng.choice([w, w.upper() if w.isascii() else w, w]))
        rows.append((None if i % 50 == 0 else i // 2, rng.choice([" ", "7", "\n- "]).join(words)))
    return rows + [(1, None), (2, ""), (3, "x" * 3000 + " y"), (3, "×÷ Øresund")] * 5


@pytest.mark.parametrize("symbols", [None, (2, 2)])
def test_equals_brute_force(spark, monkeypatch, symbols):
    if symbols:
        monkeypatch.setattr(spelling, "SYMBOLS", symbols)
        monkeypatch.setattr(spelling, "LETTERS", 50)
        monkeypatch.setattr(spelling, "HELD", 1000)
        monkeypatch.setattr(spelling, "_PART", 100)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, word string, n int")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(docs).collect()}
    want = expected(rows)
    assert got == want
    assert any(f and want[f][0] for f, *_ in want.values())      # a chain of two
    assert "x" * 3000 in want or symbols is None


def test_chains_ties_and_empty_table(spark):
    # 625 > 125 > 25 > 5 occurrences, each one edit from the next; two candidates tie for the last word.
    ladder = [("aaaaaa", 625), ("aaaaab", 125), ("aaaabb", 25), ("aaabbb", 5), ("cccccc", 5), ("ccccca", 30), ("cccccb", 30)]
    words = spark.createDataFrame(ladder, "word string, n long")
    near = {(r.word, r.near) for r in spelling.near_words(words, 3).collect()}
    assert near == {(a, b) for a, _ in ladder for b, _ in ladder if one_edit(a, b)}
    docs = spark.createDataFrame([(None, " ".join([w] * n)) for w, n in ladder], "doc_id long, text string")
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(docs).collect()}
    assert got == {w: v[:2] for w, v in expected([(None, " ".join([w] * n)) for w, n in ladder]).items()}
    assert got["cccccc"][0] == "ccccca"
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_neighbourhood_holds_every_edit_once():
    table = spelling.symbol_table(3)
    words = ["abcabc", "aaaaaa", "éßéß", "zz"]
    reduced = spelling.Reduced(pa.array(words), table)
    got: dict = {k: [] for k in range(len(words))}
    for word, key in reduced.neighbourhood(3):
        for w, k in zip(word.tolist(), key.tolist()):
            got[w].append(k)
    letters = {}
    for c in "abcdefghijklmnopqrstuvwxyz":
        letters.setdefault(int(table[ord(c)]), c)
    assert len(letters) == 3
    for k, w in enumerate(words):
        s = "".join(letters[int(table[ord(c)])] for c in w)
        forms = {s} | {s[:i] + s[i + 1:] for i in range(len(s))}
        forms |= {s[:i] + c + s[i + d:] for i in range(len(s) + 1) for d in (0, 1) for c in letters.values() if i + d <= len(s)}
        want = sorted(spelling.Reduced(pa.array(sorted(forms)), table).key.tolist())
        assert sorted(got[k]) == want
