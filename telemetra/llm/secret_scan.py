"""Secret scan in three steps: one Aho-Corasick pass over the whole text finds keywords, anchored regular
expressions run only at those places, and tokens that carry a checksum are kept if it is right.

Kinds. ``assign``, ``access`` and ``hex`` are the base; ``github`` and ``npm`` tokens end in the base-62 CRC-32 of
their body, ``jwt`` is a JSON web token whose header decodes to an object naming its algorithm. Hex runs have no
keyword of their own: their text is seen through a table that maps every hex digit to one letter, so that 24 of this
letter are the keyword. Matching is on the UTF-8 bytes (all patterns are ASCII); spans are in code points, end
exclusive, and cover the whole match.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.llm.textcols import row_slices

# Keyword -> kind, in the order kinds are listed for equal starts.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github",
    "ghr_": "github", "npm_": "npm", "eyj": "jwt",
}
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"),
}
# Where a match fails, so it does at every later place of the same run: each run is read once by its first place.
_RUN = {"jwt": re.compile(rb"[A-Za-z0-9_-]++")}
_HEX = bytes(ord("h") if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(body: bytes, width: int = 6) -> bytes:
    """CRC-32 of ``body`` as base-62 digits, padded with zeros."""
    value, out = zlib.crc32(body), bytearray()
    while value:
        value, digit = divmod(value, 62)
        out.append(_BASE62[digit])
    return bytes(out[::-1]).rjust(width, b"0")


def _valid(kind: str, match: re.Match) -> bool:
    token = match[0]
    if kind == "assign":
        return len(match[2]) >= 6
    if kind in ("access", "hex"):
        return len(token) >= (20 if kind == "access" else 24)
    if kind == "jwt":
        head = token.split(b".")[0]
        try:
            header = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
        except (ValueError, RecursionError):  # no JSON, or nested deeper than any header
            return False
        return isinstance(header, dict) and "alg" in header
    body = token[4:]
    return crc_base62(body[:-6]) == body[-6:]


def build_automaton(keywords: dict[str, str] = KEYWORDS) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in keywords.items():
        automaton.add_word(word, (len(word), kind))
    automaton.make_automaton()
    return automaton


def _starts(text: bytes, automaton) -> dict[str, list[int]]:
    """Places where a match of a kind may begin, ascending."""
    places: dict[str, list[int]] = {}
    for end, (size, kind) in automaton.iter(text.lower().decode("latin-1")):
        places.setdefault(kind, []).append(end - size + 1)
    mapped, at = text.translate(_HEX), 0
    while (at := mapped.find(b"h" * 24, at)) >= 0:
        places.setdefault("hex", []).append(at)
        gap = mapped.find(b" ", at)
        if gap < 0:
            break
        at = gap
    return places


def find_secrets(text: bytes, automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes: per kind the leftmost non-overlapping matches that are valid."""
    found = []
    for kind, starts in _starts(text, automaton).items():
        done, pattern = 0, PATTERNS[kind]
        for start in sorted(starts):
            if start < done:
                continue
            if match := pattern.match(text, start):
                done = match.end()
                if _valid(kind, match):
                    found.append((kind, start, done))
            elif kind in _RUN:
                done = _RUN[kind].match(text, start).end()
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _code_points(text: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if not spans or text.isascii():
        return spans
    bytes_ = np.frombuffer(text, np.uint8)
    before = np.concatenate([[0], np.cumsum((bytes_ & 0xC0) != 0x80)])
    return [(kind, int(before[a]), int(before[b])) for kind, a, b in spans]


def _scan(batches):
    automaton = build_automaton()
    for batch in row_slices(batches, limit=1 << 22):
        out = []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            text = text or b""
            out.append([{"kind": k, "start": a, "end": b}
                        for k, a, b in _code_points(text, find_secrets(text, automaton))])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, _SPANS)], names=["id", "spans"])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def secret_scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>), one row per row of ``docs``, spans by start, then kind as listed.

    Null and empty texts have no spans; repeated rows and null ids keep their rows; an empty table gives an empty
    one; further columns are ignored. Texts and tokens of any length are scanned whole, in linear time; a token whose
    header is nested too deep to be read is no token.
    """
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        _scan, "id long, spans array<struct<kind: string, start: long, end: long>>").withColumnRenamed("id", id)


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and the list of all spans."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = secret_scan(docs)
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(text: str | None, automaton, mark: str = "[SECRET]") -> str | None:
    """The text with every maximal run of overlapping spans replaced by ``mark``."""
    raw = (text or "").encode()
    spans = find_secrets(raw, automaton)
    if not spans:
        return text
    out, at, end = [], 0, 0
    for _, a, b in spans:
        if a >= end:
            out += [raw[at:a], mark.encode()]
        at = end = max(end, b)
    return (b"".join(out) + raw[at:]).decode()


def redact_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by a mark, and its length column, if any, brought up to date. No row goes;
    rows without secrets are untouched, nulls too; other columns pass through unread."""
    def run(batches):
        automaton = build_automaton()
        for batch in row_slices(batches, text, 1 << 22):
            clean = [redact(x, automaton) for x in batch.column(text).to_pylist()]
            yield batch.set_column(batch.schema.get_field_index(text), text, pa.array(clean, pa.string()))

    cleaned = docs.mapInArrow(run, docs.schema)
    if length not in docs.columns:
        return cleaned
    same = F.col(length).isNull() | ~F.contains(F.coalesce(F.col(text), F.lit("")), F.lit("[SECRET]"))
    return cleaned.withColumn(length, F.when(same, F.col(length)).otherwise(F.char_length(text).cast("long")))
