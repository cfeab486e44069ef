import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from telemetra.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def expected(texts):
    """Every link by comparing byte ranges, token by token."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_alphabet()

    def spans(tokens):
        at, out = 0, []
        for i, body in tokens:
            out.append((i, at, at + len(body)))
            at += len(body)
        return out

    rows = []
    for t in texts:
        body = b" " + (t or "").encode()
        in_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + (t or ""), add_special_tokens=False).ids]
        in_b = []
        for i in b.encode(t or ""):
            p = b.id_to_piece(i)
            in_b.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        if not t or b"".join(x for _, x in in_a) != body or b"".join(x for _, x in in_b) != body:
            rows.append(([], [], 0, ""))
            continue
        in_a, in_b = spans(in_a), spans(in_b)
        links = [(x, y) for x, s, e in in_a for y, u, v in in_b if s < v and u < e]
        cuts = sorted({e for _, _, e in in_a} & {e for _, _, e in in_b})
        shown, low = [], 0
        for c in cuts:
            shown.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < c) for side in (in_a, in_b)))
            low = c
        rows.append((in_a, in_b, len(cuts), ";".join(shown), links))
    total = Counter(p for r in rows if len(r) == 5 for p in r[4])
    most = {}
    for (_, y), n in total.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for r in rows:
        links = r[4] if len(r) == 5 else []
        out.append((len(r[0]), len(r[1]), r[2], len(links), sum(total[p] == most[p[1]] for p in links),
                    sum(total[p] for p in links), hashlib.sha256(r[3].encode()).hexdigest() if r[3] else ""))
    return out, total


TEXTS = [None, "", " ", "a", "the cat, the cat; the  cats\n\n\tof Zürich 12345", "<|endoftext|> <s> </s> <unk>", "a▁b", "\0x\r\n",
         "日本語 👩‍👩‍👧 é ﬁ", "the the the the the the the " * 9, "  leading", "trailing  ", "'s 've n't It's", "the cat, the cat; the  cats"]


@pytest.mark.parametrize("limits", [{}, {"LONG_TEXT": 8, "LINKS": 1, "KNOWN": 40}])
def test_equals_comparing_all_ranges(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)
    # With two rows a batch and one link held, a block comes as many fragments that must be merged.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2 if limits else 10000)
    docs = spark.createDataFrame([(i % 11 if i else None, t, 7, "x") for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, row long, pair string").repartition(1)
    texts = [r.text for r in docs.collect()]
    want, total = expected(texts)
    per_text, pairs = alignment.cross_alignment(docs, A, B)
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(tuple(r[c] for c in cols) for r in per_text.collect()) == sorted(want)
    assert {(r.a, r.b): r.n_links for r in pairs.collect()} == dict(total)
    docs_of = Counter(p for t in texts for p in set(expected([t])[1]))
    assert {(r.a, r.b): r.n_docs for r in pairs.collect()} == dict(docs_of)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    per_text, pairs = alignment.cross_alignment(docs, A, B)
    assert per_text.count() == 0 and pairs.count() == 0


def test_bitmaps_of_many_rows_and_fragments(spark):
    places = list(range(0, 65536, 3))
    assert len(alignment.pack_bits(np.array(places))) == 8192
    assert alignment.unpack_bits(alignment.pack_bits(np.array(places))).tolist() == places
    docs = spark.range(9000).selectExpr("id AS doc_id", "'to be or not to be' AS text").repartition(1)
    per_text, pairs = alignment.cross_alignment(docs, A, B)
    assert per_text.count() == 9000
    assert all(r.n_docs == 9000 and r.n_links % 9000 == 0 for r in pairs.collect())
    assert {r.count_sum for r in per_text.select("count_sum").distinct().collect()} == {
        expected(["to be or not to be"])[0][0][5] * 9000}
