"""Personal data by weak supervision, in DataFrame functions only.

1. Candidate spans. Four base kinds (email, ip, card, phone) and, found by one more pass, further kinds. A pass marks
   all matches of a pattern, splits the text at the marks and adds up the lengths, so a text is read once a pattern.
2. Labelers vote on every candidate: +1 personal data, -1 not, 0 no opinion. ``shape`` and ``edges`` are regular
   expressions, ``gazetteer`` looks its parts up in word lists, ``context`` and ``against`` look for words before it and
   ``crowd`` for other numbers around it.
3. The votes of all candidates of the corpus are counted by Spark; there are at most kinds * 3 ** labelers * LENGTHS
   different ones. Expectation-maximisation over this table estimates how reliable each labeler is, without labels.
4. A logistic span classifier is trained on the posteriors, from votes, kind and length. It scores every candidate as one
   expression; candidates of the further kinds with a score of at least 0.5 are kept. Base spans always stay.

Spans are in code points, end exclusive. Spans of different kinds may overlap.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.staging import stage

MARK = "\x01"       # stands around matches; the same character in a text becomes \x02, which no pattern holds
SUM_BLOCK = 256     # parts of a text whose lengths are added up in one go
BEFORE, AFTER = 48, 24

# The base patterns. A match begins at the start of a run or right behind the match before, so a run of
# letters or digits is read once; all quantifiers but the phone's cannot give back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# The further kinds, leftmost among all of them.
MORE = {
    "hidden_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({] ?(?:at|AT) ?[\])}] ?[A-Za-z0-9-]{1,63}+"
                    r"(?:(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?)[A-Za-z0-9-]{1,63}+){1,4}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "mac": r"(?<![0-9A-Za-z:-])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![0-9A-Za-z:-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "local_phone": r"(?<![0-9+] )(?<![0-9A-Za-z+()._-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    "address": r"(?<![0-9A-Za-z.,])[0-9]{1,5}(?: [A-Z][a-z]{1,20}+){1,3} (?:St|Street|Ave|Avenue|Rd|Road|Blvd|Boulevard|Ln|Lane|Dr|Drive)\b",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,20}+(?: [A-Z][a-z]{1,20}+)?",
}
KINDS = (*BASE, *MORE)

# Gazetteers.
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at", "be", "us")
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27,
                "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
FIRST_NAMES = ("James", "Mary", "John", "Anna", "Robert", "Maria", "Michael", "Laura", "David", "Sarah", "Thomas", "Julia", "Peter",
               "Marie", "Paul", "Sofia", "Hans", "Claire", "Jean", "Carmen", "Pierre", "Lucia", "Karl", "Elena", "Jose", "Emma")
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30|36)"
RESERVED_IP = r"^(?:0|10|127|169\.254|192\.168|192\.0\.2|198\.51\.100|203\.0\.113|2[4-5][0-9])\."
TRIGGERS = {
    "email": "mail|contact|write|courriel|correo|kontakt", "ip": r"\bip\b|address|host|server|client|login|adresse",
    "card": "card|visa|mastercard|credit|carte|karte|tarjeta|payment|paid", "phone": "phone|tel|call|mobile|fax|cell|telefon|llam",
    "hidden_email": "mail|contact|write|courriel|correo|kontakt", "iban": "iban|account|bank|konto|compte|cuenta|transfer",
    "mac": r"\bmac\b|device|adapter|wlan|ethernet", "ssn": r"\bssn\b|social|security|tax", "local_phone": "phone|tel|call|mobile|fax|cell",
    "address": "live|lives|address|home|resid|ship|deliver|wohn|adresse", "name": "name|patient|dear|from|contact|regards",
}
AGAINST = r"version|\bv$|isbn|issn|order|invoice|serial|section|figure|table|chapter|part no|build|release|sha|hash|hex|token|\bid\b|https?:|www\."

LABELERS = ("shape", "gazetteer", "context", "against", "edges", "crowd")
LENGTHS = 4         # classes of length the classifier tells apart
EM_ROUNDS = 200
START = 0.8         # accuracy of every labeler before the first round
PRIOR = 4.0         # pseudo-votes that hold each estimate near its start

_SPAN = "struct<kind: string, start: long, end: long, value: string, code: int>"


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(lengths: Column) -> Column:
    """Sum of all entries before each entry. Blocks of ``SUM_BLOCK`` entries are summed apart, then shifted, so the work
    does not grow with the square of a text's matches."""
    zero = F.array(F.lit(0).cast("long"))

    def summed(lengths: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(lengths), F.lit(SUM_BLOCK))
        return F.transform(places, lambda p: F.aggregate(
            F.slice(lengths, p, F.lit(SUM_BLOCK)), zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))))

    def shifted(blocks: Column) -> Column:
        bases = F.aggregate(blocks, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.element_at(x, -1))))
        return let(bases, lambda base: F.flatten(F.transform(
            blocks, lambda x, i: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda y: y + F.get(base, i)))))

    return let(let(lengths, summed), shifted)


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern: array<struct<value, start, end, before, after>>. ``text`` holds no ``MARK``."""
    parts = F.split(F.regexp_replace(text, F.lit(f"(?:{pattern})"), F.lit(f"{MARK}$0{MARK}")), MARK, -1)

    def cut(parts: Column) -> Column:
        def at(starts: Column) -> Column:
            found = F.transform(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), lambda i: F.struct(
                F.get(parts, i).alias("value"), F.get(starts, i).alias("start"), F.get(starts, i + 1).alias("end"),
                F.right(F.get(parts, i - 1), F.lit(BEFORE)).alias("before"), F.left(F.get(parts, i + 1), F.lit(AFTER)).alias("after")))
            return F.when(F.size(parts) > 1, found)

        return let(running_sums(F.transform(parts, lambda p: F.char_length(p).cast("long"))), at)

    return let(parts, cut)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True for digits whose Luhn sum is divisible by ten."""
    def weighed(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, F.lit(2)).otherwise(F.lit(1))
        return F.when(d > 9, d - 9).otherwise(d)

    places = F.transform(F.split(F.reverse(number), ""), weighed)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def iban_checks(value: Column) -> Column:
    """True for an account number whose remainder by 97 is one."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        d = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (acc * F.when(d > 9, F.lit(100)).otherwise(F.lit(10)) + d) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def base_valid(kind: str, value: Column) -> Column:
    """Whether a match of a base pattern is a span."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "email":
        return F.lit(True)
    low, high = (12, 19) if kind == "card" else (9, 15)
    inside = let(digits(value), lambda d: F.when(F.char_length(d).between(low, high), luhn(d) if kind == "card" else F.lit(True)))
    return F.coalesce(inside, F.lit(False))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, F.lit(-1)).when(yes, F.lit(1)).otherwise(F.lit(0))


def _shape(kind: str, v: Column) -> Column:
    never = F.lit(False)
    return {
        "email": lambda: _vote(v.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,62}[A-Za-z0-9]?@.*\.[A-Za-z]{2,10}$"), v.rlike(r"\.\.|\.[0-9]+$")),
        "ip": lambda: _vote(F.lit(True), v.rlike(r"(?:^|\.)0[0-9]")),
        "card": lambda: _vote(v.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})$"), v.rlike("^[0-9]$")),
        "phone": lambda: _vote(v.rlike(r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9])"), v.rlike(r"[().-]{3}")),
        "hidden_email": lambda: _vote(v.rlike(r"(?i)dot|\.[a-z]{2,10}$"), v.rlike(r"[0-9]$")),
        "iban": lambda: _vote(iban_checks(v), ~iban_checks(v)),
        "mac": lambda: _vote(v.rlike("^(?:..:){5}..$|^(?:..-){5}..$"), v.rlike(r"^(?i:(..)[:-]?(?:\1[:-]?){5})$")),
        "ssn": lambda: _vote(F.lit(True), v.rlike("^(?:000|666|9..)|-00-|0000$")),
        "local_phone": lambda: _vote(v.rlike(r"^(?:\([2-9]|[2-9]).{3,5}[2-9]"), v.rlike(r"^\(?[01]")),
        "address": lambda: _vote(F.lit(True), never), "name": lambda: _vote(v.rlike(r"^\w+\. \w+ \w+"), never),
    }[kind]()


def _gazetteer(kind: str, v: Column) -> Column:
    never = F.lit(False)
    if kind in ("email", "hidden_email"):
        return _vote(F.lower(F.regexp_extract(v, "([A-Za-z]+)$", 1)).isin(*TOP_DOMAINS), never)
    if kind == "ip":
        return _vote(never, v.rlike(RESERVED_IP))
    if kind == "card":
        return let(digits(v), lambda d: _vote(d.rlike(CARD_PREFIX), ~d.rlike(CARD_PREFIX)))
    if kind == "iban":
        lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
        size = F.char_length(F.replace(v, F.lit(" "), F.lit("")))
        known = F.try_element_at(lengths, F.left(v, F.lit(2)))
        return _vote(F.coalesce(known == size, F.lit(False)), F.coalesce(known != size, F.lit(True)))
    if kind == "ssn":
        return _vote(never, v.isin("078-05-1120", "219-09-9999", "123-45-6789"))
    if kind == "name":
        return _vote(F.regexp_extract(v, r"^\w+\.? (\w+)", 1).isin(*FIRST_NAMES), never)
    return _vote(F.lit(kind == "address"), never)


def _code(kind: str, m: Column) -> Column:
    """Votes of all labelers and class of length as one number; the kind comes in by its place in ``KINDS``."""
    v, before, after = m["value"], m["before"], m["after"]
    votes = [
        _shape(kind, v), _gazetteer(kind, v), _vote(before.rlike(f"(?i)(?:{TRIGGERS[kind]})"), F.lit(False)),
        _vote(F.lit(False), before.rlike(f"(?i)(?:{AGAINST})[^a-z]{{0,4}}$")),
        _vote(before.rlike(r"(?:^|[\s(\[\"'<:,;.])$") & after.rlike(r"^(?:$|[\s)\]\"'>:,;.!?])"),
              before.rlike("[0-9A-Za-z_/=]$") | after.rlike("^[0-9A-Za-z_/=]")),
        _vote(F.lit(False), F.regexp_count(F.concat(before, after), F.lit("[0-9]")) >= 16),
    ]
    code = F.least(F.floor(F.char_length(v) / 10), F.lit(LENGTHS - 1)).cast("int")
    for vote in votes:
        code = code * 3 + vote + 1
    return (code * len(KINDS) + KINDS.index(kind)).cast("int")


def _span(kind: str, m: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
                    _code(kind, m).alias("code"))


def _base_spans(kind: str, pattern: str, body: Column) -> Column:
    valid = F.filter(matches(body, pattern), lambda m: base_valid(kind, m["value"]))
    return F.transform(valid, lambda m: _span(kind, m))


# A pattern can match only where the text holds one of these.
_NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "more": r"[0-9]|(?i:[\[({] ?at ?[\])}])|(?:Mr|Ms|Mrs|Dr|Prof)\.? "}


def candidates(text: Column) -> Column:
    """Every candidate span of a text with its votes, by start, then kind."""
    clean = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit("\x02"))

    def found(body: Column) -> Column:
        none = F.array().cast(f"array<{_SPAN}>")
        lists = []
        for kind, pattern in BASE.items():
            lists.append(F.when(body.rlike(_NEEDS[kind]), F.coalesce(_base_spans(kind, pattern, body), none)).otherwise(none))
        any_more = "|".join(MORE.values())

        def kinded(m: Column) -> Column:
            # The alternatives begin alike nowhere: the first that fits the whole value is the one that matched.
            out = None
            for kind, pattern in reversed(MORE.items()):
                fits = m["value"].rlike(f"^(?:{pattern})$")
                out = _span(kind, m) if out is None else F.when(fits, _span(kind, m)).otherwise(out)
            return out

        spans = F.transform(matches(body, any_more), kinded)
        lists.append(F.when(body.rlike(_NEEDS["more"]), F.coalesce(spans, none)).otherwise(none))
        return F.array_sort(F.concat(*lists), lambda x, y: _order(x, y))

    return let(clean, found)


def _order(x: Column, y: Column) -> Column:
    a, b = (F.struct(s["start"], s["code"] % len(KINDS), s["end"]) for s in (x, y))
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def _decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, votes (-1, 0, 1) and class of length of code numbers."""
    kind, rest = codes % len(KINDS), codes // len(KINDS)
    votes = np.empty((len(codes), len(LABELERS)), np.int64)
    for j in reversed(range(len(LABELERS))):
        votes[:, j] = rest % 3 - 1
        rest = rest // 3
    return kind, votes, rest


def label_model(codes: np.ndarray, n: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, dict[str, float]]:
    """Posterior of every vote pattern and the estimated accuracy of every labeler, by expectation-maximisation.

    Two classes; votes are independent given the class; the share of personal data is estimated by kind, the chances
    of a vote by labeler over all kinds. A labeler starts with accuracy ``START`` and ``PRIOR`` pseudo-votes.
    """
    kind, votes, _ = _decode(codes)
    start = np.array([[START, 0.5, 1 - START], [1 - START, 0.5, START]])         # class x (vote -1, 0, 1)
    start = start / start.sum(axis=1, keepdims=True)
    chance = np.repeat(start[None], len(LABELERS), axis=0)                        # labeler x class x vote
    share = np.full(len(KINDS), 0.5)
    post = np.full(len(codes), 0.5)
    for _ in range(rounds):
        logs = np.log(chance)
        side = [sum(logs[j, c][votes[:, j] + 1] for j in range(len(LABELERS))) for c in (0, 1)]
        gap = np.clip(np.log(share[kind]) + side[1] - np.log(1 - share[kind]) - side[0], -30, 30)
        new = 1 / (1 + np.exp(-gap))
        total, hits = np.bincount(kind, n, len(KINDS)), np.bincount(kind, n * new, len(KINDS))
        share = (hits + PRIOR / 2) / (total + PRIOR)
        for j in range(len(LABELERS)):
            for c, weight in ((0, n * (1 - new)), (1, n * new)):
                seen = np.bincount(votes[:, j] + 1, weight, 3) + PRIOR * start[c]
                chance[j, c] = seen / seen.sum()
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    cast = np.abs(votes) == 1
    right = np.where(votes == 1, new[:, None], 1 - new[:, None]) if len(codes) else np.zeros((0, len(LABELERS)))
    weight = (cast * n[:, None]).sum(axis=0)
    accuracy = ((cast * right * n[:, None]).sum(axis=0) + START * PRIOR) / (weight + PRIOR)
    return (new if len(codes) else post), dict(zip(LABELERS, accuracy.tolist()))


def _features(codes: np.ndarray) -> np.ndarray:
    kind, votes, length = _decode(codes)
    return np.column_stack([votes == 1, votes == -1, kind[:, None] == np.arange(len(KINDS)),
                            length[:, None] == np.arange(LENGTHS)]).astype(np.float64)


def train_classifier(codes: np.ndarray, n: np.ndarray, posterior: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic model of the posteriors over votes, kind and length (Newton steps)."""
    x = _features(codes)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - posterior)) + ridge * w
        hessian = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_expression(code: Column, weights: np.ndarray) -> Column:
    """The classifier as one expression over a candidate's code."""
    m, w = len(LABELERS), [float(v) for v in weights]
    kind, rest = code % len(KINDS), F.floor(code / len(KINDS)).cast("int")
    total = F.get(F.array(*map(F.lit, w[2 * m:2 * m + len(KINDS)])), kind)
    for j in reversed(range(m)):
        by_vote = F.array(F.lit(w[m + j]), F.lit(0.0), F.lit(w[j]))
        total = total + F.get(by_vote, F.floor(rest / 3 ** (m - 1 - j)).cast("int") % 3)
    total = total + F.get(F.array(*map(F.lit, w[2 * m + len(KINDS):])), F.floor(rest / 3 ** m).cast("int"))
    return 1 / (1 + F.exp(-total))


def fit(found: DataFrame) -> tuple[np.ndarray, dict[str, float]]:
    """Classifier weights and labeler accuracies from staged candidates (column ``spans``) of the whole corpus. Only the
    counts of vote patterns reach the driver: at most kinds * 3 ** labelers * LENGTHS = 32,076 rows."""
    counts = found.select(F.explode("spans.code").alias("code")).groupBy("code").agg(F.count("*").alias("n")).collect()
    codes = np.array([r["code"] for r in counts], np.int64)
    n = np.array([r["n"] for r in counts], np.float64)
    posterior, accuracy = label_model(codes, n)
    return train_classifier(codes, n, posterior), accuracy


def pii_scan(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, spans array<struct<kind, start, end, value, score>>), one row per row of ``docs``, spans by start, then kind.

    Null and empty texts have no spans; repeated rows and null ids keep their rows; an empty table gives an empty one;
    further columns are ignored. Texts are read whole, runs of letters or digits of any length once per pattern.
    """
    found = stage(docs.select(F.col(id).cast("long").alias("id"), candidates(F.col(text)).alias("spans")), "pii-candidates")
    weights, _ = fit(found)
    scored = F.transform("spans", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        score_expression(s["code"], weights).alias("score")))
    kept = F.filter(scored, lambda s: s["kind"].isin(*BASE) | (s["score"] >= threshold))
    return found.select(F.col("id").alias(id), kept.alias("spans"))


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and the list of all spans."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in BASE]
    return pii_scan(docs).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
