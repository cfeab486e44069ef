"""Toxicity by weak supervision.

1. Two bounded samples are read: labelled rows (``SAMPLE_ROWS`` per class; rows whose crc32(id) mod 5 is 0 are never
   looked up) and rows of the whole table (``SAMPLE_TEXTS``, whose labels are not looked at), both chosen by a hash of
   the id. They become word and word-prefix features, one text per group of near copies. Features whose frequency
   differs significantly between the labelled classes stay.
2. Many voters look at a text: stated word lists, precise mined words and stems, and patterns of shouting. Each says toxic,
   clean or nothing.
3. A generative label model (expectation maximisation over the hidden class: clean or one of the kinds of toxic, as in
   several languages) estimates each voter's accuracy, the shares of the classes and the correlations left inside a class
   from the votes on both samples. Correlated voters share their weight. The labels are no voter: they only anchor the
   classes, by the vote tables that the first step starts from and that stay as a prior.
4. A logistic model over the features is fitted to the posteriors of both samples and scores every whole text in one
   pass.

Scores depend on nothing but the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.staging import stage
from telemetra.llm.textcols import hash_word, row_slices, shingles, text_bytes, word_hashes

SAMPLE_ROWS = 6000   # labelled rows per class in the fit
SAMPLE_TEXTS = 8000  # rows of the whole table in the fit
FEATURES = 4096      # most features kept
STEMS = (4, 5)       # bytes of a word prefix
MIN_Z = 5.0          # least significance of a feature: hardly any of 10**6 words by chance
VOTERS = 96          # mined voters
PRECISION = 0.9      # least share of toxic rows among the labelled rows that a mined voter marks
OVERLAP = 0.5        # most Jaccard similarity of the rows two mined voters mark
ANCHOR = 1.0         # weight of a labelled row in the prior of the vote tables
KIND_ROWS = 10       # least labelled rows of a kind of toxic texts,
KIND_SHARE = 0.02    # and their least share of the toxic ones
TOXIC = 0.5          # least score predicted toxic

# Stated word lists, one voter each.
LEXICON = {
    "stupidity": ("idiot", "moron", "stupid", "dumb", "imbecile", "fool"),
    "contempt": ("loser", "pathetic", "worthless", "clown", "useless"),
    "disgust": ("scum", "trash", "disgusting", "garbage", "filth", "vermin"),
    "hate": ("hateful", "despise", "despicable", "vile"),
}


def _features(batch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature hash) pairs of a batch."""
    whole, first, *stems = word_hashes(batch.column("text"), STEMS)
    row = np.repeat(np.arange(batch.num_rows), np.diff(first))
    rows, hashes = np.tile(row, 1 + len(stems)), np.concatenate([whole, *stems])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _shouting(batch) -> np.ndarray:
    """(rows x 2): share of upper-case letters among ASCII letters, exclamation marks per 100 bytes."""
    data, offsets = text_bytes(batch.column("text"))
    if not len(data):
        return np.zeros((batch.num_rows, 2))
    total = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[offsets])
    upper = total((data >= 65) & (data <= 90))
    letters = upper + total((data >= 97) & (data <= 122))
    return np.stack([upper / np.maximum(letters, 1), 100 * total(data == 33) / np.maximum(np.diff(offsets), 1)], 1)


def _describe(batches):
    for batch in row_slices(batches):
        rows, hashes = _features(batch)
        offsets = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
        grams, cut = shingles(*word_hashes(batch.column("text")), 5)
        some = np.flatnonzero(np.diff(cut))
        low = np.zeros(batch.num_rows, np.uint64)
        if len(some):
            low[some] = np.minimum.reduceat(grams, cut[some])
        shout = _shouting(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("toxic"), pa.array(low.view(np.int64)), pa.array(shout[:, 0]),
             pa.array(shout[:, 1]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))],
            names=["id", "toxic", "low", "upper", "bangs", "features"])


def held_out(id):
    """True for the rows whose labels are never learned from."""
    return F.crc32(id.cast("string").cast("binary")) % 5 == 0


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """(id, toxic, low, upper, bangs, features) of at most ``rows`` labelled rows per class and ``texts`` rows of the
    whole table, whose ``toxic`` is null; copies once, and one text of an id, however many rows have it."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.filter(F.col("toxic") == c).orderBy(*order).limit(rows) for c in (0, 1)]
    anyone = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    anyone = anyone.orderBy(*order).limit(texts).withColumn("toxic", F.lit(None).cast("int"))
    chosen = picked[0].union(picked[1]).union(anyone).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    source = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    seen = source.join(F.broadcast(chosen), "id").select("id", "toxic", "text").mapInArrow(
        _describe, "id long, toxic int, low long, upper double, bangs double, features array<long>")
    values = ["low", "toxic", "upper", "bangs", "features"]
    once = stage(seen, "toxicity-sample").groupBy("id").agg(F.min(F.struct(*values)).alias("v")).select("id", "v.*")
    return stage(once.dropDuplicates(["low", "toxic"]), "toxicity-fit")


def select_features(sample: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[int, float]]:
    """The significant (hash, z) pairs, strongest first. ``z`` is the signed root of the likelihood ratio: a word that no
    clean row has is judged by its toxic rows, however few they are beside another language's."""
    counts = sample.select("toxic", F.explode("features").alias("h")).groupBy("h").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).filter("a + b >= 3")
    a, b, total = F.col("a"), F.col("b"), float(n_toxic + n_clean)
    cells = [(a, (a + b) * (n_toxic / total)), (b, (a + b) * (n_clean / total)),
             (n_toxic - a, (total - a - b) * (n_toxic / total)), (n_clean - b, (total - a - b) * (n_clean / total))]
    ratio = sum((F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells), F.lit(0.0))
    z = F.signum(a / n_toxic - b / n_clean) * F.sqrt(2 * F.greatest(ratio, F.lit(0.0)))
    best = counts.withColumn("z", z).filter(F.abs("z") >= MIN_Z).orderBy(F.abs("z").desc(), "h").limit(FEATURES)
    return [(r["h"], r["z"]) for r in best.select("h", "z").collect()]


def mine_voters(has: np.ndarray, toxic: np.ndarray, ranked: list[int]) -> list[int]:
    """The first ``VOTERS`` of the ``ranked`` columns that are precise on the labelled rows and mark other rows than
    those before them, so that a few words with many stems do not take all places."""
    picked, marks = [], []
    for column in ranked:
        mark = has[:, column]
        if ((mark & toxic).sum() + 0.5) / (mark.sum() + 1) < PRECISION:
            continue
        if any((mark & other).sum() > OVERLAP * (mark | other).sum() for other in marks):
            continue
        picked.append(column)
        marks.append(mark)
        if len(picked) == VOTERS:
            break
    return picked


def toxic_kinds(marks: np.ndarray) -> np.ndarray:
    """The kind (0, 1, ...; -1 none) of every toxic row of ``marks`` (rows x voters, True: says toxic).

    Voters that mark the same rows make a kind, as the words of one language do: the most frequent voter left, with all that
    mark its rows at least half as often as independent ones would. A row is of the kind most of its marks are of. Kinds of
    fewer rows than ``KIND_ROWS`` and ``KIND_SHARE`` ask for are merged, smallest first.
    """
    marks = marks.astype(float)
    both = marks.T @ marks
    count = np.diag(both)
    near = (both > 0) & (both >= 0.5 * np.outer(count, count) / max(len(marks), 1))
    left, families = count > 0, []
    while left.any():
        seed = np.argmax(np.where(left, count, 0))
        families.append(left & near[seed])
        left &= ~near[seed]
    hits = [marks[:, family].sum(1) for family in families]
    while True:
        most = np.stack([np.zeros(len(marks)), *hits], 1)
        kind = np.where(most.max(1) > 0, most[:, 1:].argmax(1) if hits else 0, -1)
        rows = np.bincount(kind[kind >= 0], minlength=len(hits))
        if len(hits) < 2 or rows.min() >= max(KIND_ROWS, KIND_SHARE * len(marks)):
            return kind
        one, other = sorted(np.argsort(rows, kind="stable")[:2])
        hits[one] = hits[one] + hits.pop(other)


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of toxic for every row of ``votes`` (-1 none, 0 clean, 1 toxic), and the voters' weights.

    The hidden class is clean or one of several kinds of toxic: voters that never meet, as words of two languages, would
    speak against each other inside a single toxic class. Tables P(vote | class) and the class shares are estimated by EM
    over all rows. ``gold`` (-1 not known) gives the kinds and the tables that EM starts from, which stay as a prior of the
    tables (weight ``ANCHOR``), so that rows marked by mistake cannot pull a kind away; no row is held to its label. A
    voter's weight is 1 / (1 + sum of its positive correlations inside the classes), so voters that repeat each other count
    about once.
    """
    said = np.stack([votes == v for v in (-1, 0, 1)]).astype(float)  # vote x row x voter

    def counts(post):
        return np.stack([p @ vote for p in post.T for vote in said]).reshape(post.shape[1], 3, -1)  # class x vote x voter

    def tables(post):
        table = counts(post) + ANCHOR * anchor + 0.5
        return table / table.sum(1, keepdims=True)

    def posterior(table, share, weight):
        logit = np.log(share) + sum(vote @ (np.log(table[:, v]) * weight).T for v, vote in enumerate(said))
        odds = np.exp(logit - logit.max(1, keepdims=True))
        return odds / odds.sum(1, keepdims=True)  # row x class, clean first

    def shared(table, post):
        residual = said[2] - post @ table[:, 2]
        scale = np.sqrt((residual ** 2).mean(0)) + 1e-9
        correlation = (residual.T @ residual) / len(post) / np.outer(scale, scale)
        np.fill_diagonal(correlation, 0)
        return 1 / (1 + np.where(correlation > 0.1, correlation, 0).sum(1))

    kind = toxic_kinds(votes[gold == 1] == 1)
    post = np.zeros((len(gold), 2 + max(kind.max(initial=0), 0)))
    post[gold == 0, 0] = 1
    post[np.flatnonzero(gold == 1)[kind >= 0], 1 + kind[kind >= 0]] = 1
    anchor = counts(post)
    table, share, weight = tables(post), (post.sum(0) + 0.5) / (post + 0.5 / len(post)).sum(), np.ones(votes.shape[1])
    post = posterior(table, share, weight)
    for _ in range(rounds):
        table, share = tables(post), np.maximum(post.mean(0), 1e-9)
        weight = shared(table, post)
        new = posterior(table, share, weight)
        done = np.abs(new - post).max() < 1e-4
        post = new
        if done:
            break
    return np.clip(1 - post[:, 0], 1e-6, 1 - 1e-6), weight


def fit_logistic(rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, target: np.ndarray, width: int,
                 l2: float = 0.05, rounds: int = 600) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, sparse and dense weights of a ridge logistic model on soft targets, by Adam over all rows."""
    theta = np.zeros(1 + width + dense.shape[1])
    theta[0] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = theta[0] + np.bincount(rows, theta[1 + cols], len(target)) + dense @ theta[1 + width:]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        grad = np.concatenate([[g.sum()], np.bincount(cols, g[rows], width), dense.T @ g])
        grad[1:] += l2 * theta[1:]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return theta[0], theta[1:1 + width], theta[1 + width:]


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Voters, label model and classifier: a dictionary of small arrays (at most ``FEATURES`` weights)."""
    sample = fit_sample(docs, labels)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    empty = {"hashes": np.empty(0, np.uint64), "weights": np.empty(0), "dense": np.zeros(2), "bias": -3.0}
    if not sizes.get(1) or not sizes.get(0):
        return empty
    chosen = select_features(sample.filter("toxic is not null"), sizes[1], sizes[0])
    stated = {name: [np.uint64(hash_word(w)) for w in words] for name, words in LEXICON.items()}
    hashes = np.unique(np.concatenate([np.array([h for h, _ in chosen], np.int64).view(np.uint64),
                                       np.array([h for words in stated.values() for h in words], np.uint64)]))
    wanted = F.array(*[F.lit(int(h)) for h in hashes.view(np.int64)])
    rows = sample.select(F.coalesce("toxic", F.lit(-1)).alias("toxic"), "upper", "bangs",
                         F.array_intersect("features", wanted).alias("hits"), "id", "low") \
        .orderBy("id", "low", "toxic").toArrow().combine_chunks()
    gold = rows.column("toxic").to_numpy()
    dense = np.stack([rows.column(c).to_numpy() for c in ("upper", "bangs")], 1)
    lists = rows.column("hits").combine_chunks()
    at = np.repeat(np.arange(len(gold)), lists.value_lengths().to_numpy())
    cols = np.searchsorted(hashes, lists.flatten().to_numpy().view(np.uint64))

    has = np.zeros((len(gold), len(hashes)), bool)
    has[at, cols] = True
    column = {int(h): i for i, h in enumerate(hashes)}
    votes = [np.where(has[:, [column[int(h)] for h in words]].any(1), 1, -1) for words in stated.values()]
    mined = mine_voters(has[gold >= 0], gold[gold >= 0] == 1, [column[int(np.int64(h).view(np.uint64))] for h, z in chosen if z > 0])
    clean = [h for h, z in chosen if z < 0][:VOTERS // 4]
    votes += [np.where(has[:, i], 1, -1) for i in mined]
    votes += [np.where(has[:, column[int(np.int64(h).view(np.uint64))]], 0, -1) for h in clean]
    votes.append(np.where(has[:, mined].any(1), -1, 0) if mined else np.full(len(gold), -1))
    votes += [np.where(dense[:, 0] > 0.6, 1, -1), np.where(dense[:, 1] > 2, 1, -1)]
    posterior, _ = label_model(np.column_stack(votes), gold)
    bias, weights, extra = fit_logistic(at, cols, dense, posterior, len(hashes))
    return {"hashes": hashes, "weights": weights, "dense": extra, "bias": bias}


def _scored(model: dict):
    """Function of record batches: pairs of a slice and its rows' scores."""
    hashes, weights = model["hashes"], model["weights"]
    maybe = np.zeros(1 << 20, bool)
    maybe[hashes >> np.uint64(44)] = True

    def run(batches):
        for batch in row_slices(batches):
            whole, first, *stems = word_hashes(batch.column("text"), STEMS)
            total = model["bias"] + _shouting(batch) @ model["dense"]
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            met = []
            for h in (whole, *stems):
                near = np.flatnonzero(maybe[h >> np.uint64(44)])
                col = np.minimum(np.searchsorted(hashes, h[near]), max(len(hashes) - 1, 0))
                true = hashes[col] == h[near] if len(hashes) else np.zeros(0, bool)
                met.append(row[near][true] * np.int64(len(hashes)) + col[true])
            pair = np.unique(np.concatenate(met))
            if len(pair):
                total += np.bincount(pair // len(hashes), weights[pair % len(hashes)], batch.num_rows)
            yield batch, 1 / (1 + np.exp(-np.clip(total, -30, 30)))
    return run


def _score(model: dict):
    scored = _scored(model)

    def run(batches):
        for batch, score in scored(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], names=["id", "score"])
    return run


def _keep_clean(model: dict):
    scored = _scored(model)

    def run(batches):
        for batch, score in scored(batches):
            yield batch.filter(pa.array(score < TOXIC))
    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    A null text scores as an empty one; equal texts get equal scores; repeated rows are scored each; a null id is
    held out and keeps its row; without labelled rows of both classes every text gets the same low score; an empty
    table gives an empty one; further columns are ignored.
    """
    model = fit(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(_score(model), "id long, score double")
    return scored.select(
        F.col("id").alias("doc_id"), F.coalesce(held_out(F.col("id")), F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` not predicted toxic, with the same columns. Every row goes or stays by its own score,
    whatever its id."""
    return docs.mapInArrow(_keep_clean(fit(docs, labels)), docs.schema)
