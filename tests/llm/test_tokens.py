import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from telemetra.llm import bpe_transducer, packing, token_counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = list("abcXYZ  \n\t'0189.,!?éÉüßñÄÖ̸́ΣςσİıK\x1c\x1f\x85\xa0 中文😀ǅﬁ가​﻿\x00") + [
    "<|endoftext|>", "<|startoftext|>", " \n", "\n ", "'ll", "'s", "  ", "hello ", "the ", "Thing "]


def texts(n=300, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return out + ["", None, None, "the the the", "the the the", "hello " * 9000, "x" * 20000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 7) for i, t in enumerate(texts())] + [(None, "hello there", "x", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, n long").repartition(3)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("lexicon", [0, 40, bpe_transducer.LEXICON])
def test_encoding_and_decoding(docs, monkeypatch, lexicon):
    monkeypatch.setattr(bpe_transducer.frequent_words, "__defaults__", (lexicon,))
    library = Tokenizer.from_file(WORD_BPE)
    got = by_id(bpe_transducer.encode_digest(docs, WORD_BPE))
    assert len(got) == docs.count()
    for i, t in enumerate(texts()):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest()), repr(t)[:80]


def test_transducer_holds_exactly_its_words(tmp_path):
    rng = random.Random(2)
    words = sorted({bytes(rng.choice(b"abc\xc3\xa9") for _ in range(rng.randint(1, 9))) for _ in range(800)})
    held = words[::2]
    ids = [[k, 2 * k, 3 * k][:1 + k % 3] for k in range(len(held))]
    path = tmp_path / "lexicon"
    path.write_bytes(bpe_transducer.compile_lexicon(held, ids))
    lexicon = bpe_transducer.Lexicon(str(path))
    assert lexicon.numbers(words).tolist() == [held.index(w) if w in set(held) else -1 for w in words]
    assert [lexicon.ids_of(k) for k in range(len(held))] == ids
    path.write_bytes(bpe_transducer.compile_lexicon([], []))
    assert bpe_transducer.Lexicon(str(path)).numbers([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("head", [0, 30, token_counts.HEAD])
def test_token_counts(docs, monkeypatch, head):
    monkeypatch.setattr(token_counts.head_table, "__defaults__", (head,))
    library = Tokenizer.from_file(BYTE_BPE)
    got = by_id(token_counts.token_counts(docs, BYTE_BPE))
    assert len(got) == docs.count()
    for i, t in enumerate(texts()):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512), repr(t)[:80]


def test_pre_tokens_of_every_character():
    """Letters and digits are told apart as the library does, whatever Unicode version it knows."""
    library = Tokenizer.from_file(BYTE_BPE)
    split = token_counts.Splitter()
    wrong = []
    for c in map(chr, range(1, 0x30000)):
        if "\ud800" <= c <= "\udfff":
            continue
        text = f"{c}'s a{c}1 {c}b {c} {c}{c}  {c}\n"
        want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        got = [p.decode() for chunk in split.chunks(text.encode())[0] for p in split.pre_tokens(chunk)]
        if got != want:
            wrong.append(hex(ord(c)))
    assert not wrong


def test_token_counts_with_small_bounds(spark, monkeypatch):
    for name, value in {"HELD": 2000, "PART": 64, "ROWS": 3}.items():
        monkeypatch.setattr(token_counts, name, value)
    library = Tokenizer.from_file(BYTE_BPE)
    rows = texts(80, seed=4) + ["౜'s", "word " * 500 + "中文 \u3000 x<|endoftext|> y z" * 30, "a" * 5000]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = by_id(token_counts.token_counts(docs, BYTE_BPE))
    assert [got[i].n_tokens for i in range(len(rows))] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in rows]


def test_packing_places_every_piece(docs):
    library = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs, WORD_BPE).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(by_doc) == docs.count()
    for i, t in enumerate(texts()):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want = [(k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes()))
                for k, s in enumerate(range(0, len(ids), 4096))]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in sorted(by_doc[i], key=lambda r: r.piece)] == want
    total = sum(r.length for r in rows)
    assert len(by_sequence) == -(-total // packing.CAPACITY)


def test_ranks_in_several_buckets(docs, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 40)
    rows = packing.pack(docs, WORD_BPE).collect()
    assert max(Counter((r.sequence_id, r.offset) for r in rows).values()) == 1


def test_empty_tables(docs):
    none = docs.limit(0)
    assert packing.pack(none, WORD_BPE).count() == 0
    assert token_counts.token_counts(none, BYTE_BPE).count() == 0
    assert bpe_transducer.encode_digest(none, WORD_BPE).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_bin_completion_uses_all_lengths(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 60, 300), rng.integers(20, 70, 80), rng.choice([34, 33, 50, 17], 90), rng.integers(60, 101, 40)][seed]
    counts = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
    first = packing.best_fit_decreasing(counts, 100)
    for plan in (first, packing.bin_completion(counts, 100), packing.plan_packing(counts, 100)):
        used: Counter = Counter()
        for pattern, times in plan:
            assert sum(a * k for a, k in pattern) <= 100
            for a, k in pattern:
                used[a] += k * times
        assert used == counts
    assert sum(n for _, n in plan) <= sum(n for _, n in first)


def test_branching_reaches_the_bound():
    counts = {13: 1, 15: 3, 18: 2, 19: 1, 20: 1, 24: 1, 26: 1, 28: 1, 32: 3, 33: 2, 34: 2, 35: 1, 38: 1, 41: 1, 45: 1}
    assert sum(n for _, n in packing.best_fit_decreasing(counts, 100)) == 7
    plan = packing.plan_packing(counts, 100)
    assert sum(n for _, n in plan) == 6 == sum(k * v for k, v in counts.items()) / 100
    used: Counter = Counter()
    for pattern, times in plan:
        for a, k in pattern:
            used[a] += k * times
    assert used == counts


def test_bin_completion_beats_best_fit():
    counts = {44: 2, 36: 2, 30: 2, 26: 2, 24: 2, 20: 2, 10: 2, 6: 2, 4: 2}  # two full bins of 100 exist twice over
    assert sum(n for _, n in packing.plan_packing(counts, 100)) == 4
