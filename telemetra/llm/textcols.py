"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

A word is a maximal run of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z. Texts are walked in
slices of a few megabytes that end between words, so one very long text needs no more memory than many short ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 21  # bytes hashed at a time

_rng = np.random.default_rng(20240501)
_POSITION = _rng.integers(0, 1 << 63, size=(64, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[ord("0"):ord("9") + 1] = _IS_WORD[ord("a"):ord("z") + 1] = _IS_WORD[0x80:] = True
_LOWER[~_IS_WORD[_LOWER]] = 0


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def _slice_words(lower: np.ndarray, breaks: np.ndarray, prefixes: tuple[int, ...], before: int) -> tuple[np.ndarray, ...]:
    """Starts, lengths, sums and prefix sums of the words of one slice; ``breaks`` are row starts inside it. The slice's
    first word has ``before`` bytes in slices before; its length counts them, its sums do not."""
    inside = lower != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[breaks] = inside[breaks]
    body = np.flatnonzero(inside)
    if not len(body):
        return np.empty(0, np.int64), np.empty(0, np.int64), *(np.empty(0, np.uint64) for _ in (0, *prefixes))
    heads = np.flatnonzero(first[body])
    lengths = np.diff(np.append(heads, len(body)))
    place = np.arange(len(body)) - np.repeat(heads, lengths)
    if before:
        place[:lengths[0]] += before
        lengths[0] += before
    far = place >> 6
    parts = _POSITION[place & 63, lower[body]]
    if lengths.max() > 64:
        parts = parts * (2 * far + 1).astype(np.uint64)
    begins = [np.add.reduceat(np.where(place < p, parts, np.uint64(0)), heads) for p in prefixes]
    return body[heads], lengths, np.add.reduceat(parts, heads), *begins


def word_hashes(texts: pa.Array, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """All words of the column in order: (hash of every word, index of each row's first word and one more at the
    end), then for each of ``prefixes`` the hash of every word's first so many bytes.

    A word's hash is made from a sum over its bytes, so a word longer than a slice is summed slice by slice.
    """
    data, offsets = text_bytes(texts)
    found, at, open_word = [], 0, None
    while at < len(data):
        to = min(at + SLICE, len(data))
        while to < len(data) and _LOWER[data[to - 1]] and to - at < 2 * SLICE:
            gap = np.flatnonzero(_LOWER[data[to:to + 4096]] == 0)
            to = to + int(gap[0]) + 1 if len(gap) else min(to + 4096, len(data))
        row = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, to)] - at
        starts, lengths, *sums = _slice_words(_LOWER[data[at:to]], row, prefixes, int(open_word[1]) if open_word else 0)
        starts += at
        if open_word:
            starts[0] = open_word[0]
            for s, more in zip(sums, open_word[2]):
                s[0] += more
        # A word that runs on behind the slice, inside its row, waits for the rest.
        runs_on = to < len(data) and _LOWER[data[to - 1]] and _LOWER[data[to]] and offsets[np.searchsorted(offsets, to)] != to
        open_word = (starts[-1], lengths[-1], [s[-1] for s in sums]) if runs_on else None
        n = len(starts) - 1 if runs_on else len(starts)
        found.append((starts[:n], lengths[:n], *(s[:n] for s in sums)))
        at = to
    if not found:
        return (np.empty(0, np.uint64), np.zeros(len(offsets), np.int64), *(np.empty(0, np.uint64) for _ in prefixes))
    starts, lengths, whole, *begins = (np.concatenate(x) for x in zip(*found))
    begins = [mix(b + np.uint64((p << 40) + 1)) for p, b in zip(prefixes, begins)]
    return mix(whole + lengths.astype(np.uint64)), np.searchsorted(starts, offsets), *begins


def hash_word(word: str) -> int:
    """The hash that ``word_hashes`` gives to this one word."""
    h = word_hashes(pa.array([word]))[0]
    if len(h) != 1:
        raise ValueError(f"not one word: {word!r}")
    return int(h[0])


def shingles(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows inside rows: (windows, row offsets). A row of 1 to n-1 words gives one window
    over all of them, a row without words none."""
    counts = np.diff(first)
    if not len(h):
        return np.empty(0, np.uint64), np.zeros(len(first), np.int64)
    padded = np.concatenate([h, np.zeros(n, np.uint64)])
    row_end = np.repeat(first[1:], counts)
    at = np.arange(len(h))
    total = np.zeros(len(h), np.uint64)
    for k in range(n):
        use = at + k < row_end
        total = np.where(use, mix(total * np.uint64(0x2545F4914F6CDD1D) + padded[k:k + len(h)] + np.uint64(k + 1)), total)
    keep = (at + n <= row_end) | ((at == np.repeat(first[:-1], counts)) & (np.repeat(counts, counts) < n))
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    return total[keep], np.concatenate([[0], np.cumsum(sizes)])


def row_slices(batches, text: str = "text", limit: int = SLICE):
    """Cut record batches so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
