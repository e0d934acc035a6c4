"""Sets of word shingles as sorted arrays of 64-bit hashes, computed a slab of documents at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Bytes hashed at once; a longer document is a slab of its own, hashed in parts.
SLAB = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32
_LOWER[_SPACE] = 0


def word_table(texts: list[bytes], marks: bool = False) -> tuple[np.ndarray, ...]:
    """(hash of every word `[^\\x20\\x09-\\x0D]+` of all texts in order, number of words of each text).

    With marks also, of each word, the place of its first byte in the joined texts,
    its last byte, and the sum of its bytes with A-Z lower-cased.
    """
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.zeros(len(texts), np.int64)
    none = np.zeros(0, np.int64)
    void = (np.zeros(0, np.uint64), counts, none, none, none)
    if not len(data):
        return void if marks else void[:2]
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = ends[:-1][ends[:-1] < len(data)]
    first[edge] = inside[edge]
    starts = np.flatnonzero(first)
    if not len(starts):
        return void if marks else void[:2]
    number = np.cumsum(first) - 1
    at = np.arange(len(data)) - starts[np.maximum(number, 0)]
    at[~inside] = 0
    value = _BYTE[data] * powers(_STEP, int(at.max()) + 1)[at]
    value[~inside] = 0
    hashes = mixed(np.add.reduceat(value, starts))
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
    if not marks:
        return hashes, counts
    final = inside.copy()
    final[:-1] &= ~inside[1:] | first[1:]
    return hashes, counts, starts, data[final].astype(np.int64), np.add.reduceat(_LOWER[data], starts)


def pieces(text: bytes, size: int = 0) -> Iterator[bytes]:
    """The text in parts of about `size` bytes (SLAB by default), cut after white space only; a longer word is one part."""
    size, start = size or SLAB, 0
    while start < len(text):
        end = min(start + size, len(text))
        while end < len(text) and not _SPACE[text[end - 1]]:
            end += 1
        yield text[start:end]
        start = end


def all_words(texts: list[bytes], marks: bool = False) -> tuple[np.ndarray, ...]:
    """word_table, with a long text taken in parts, so that memory doesn't grow with it but for what is returned."""
    if len(texts) > 1 or not texts or len(texts[0]) <= SLAB:
        return word_table(texts, marks)
    found, at = [], 0
    for x in pieces(texts[0]):
        hashes, _, *rest = word_table([x], marks)
        if marks:
            rest[0] = rest[0] + at
        found.append((hashes, *rest))
        at += len(x)
    hashes, *rest = (np.concatenate(x) for x in zip(*found, strict=True))
    return hashes, np.array([len(hashes)]), *rest


def shingle_sets(texts: list[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, ascending; a text of fewer words has its whole sequence as one, an empty one none."""
    hashes, counts = all_words(texts)
    n = len(hashes)
    with np.errstate(over="ignore"):
        spread = hashes * _NEXT
        runs = np.zeros(max(n - words + 1, 0), np.uint64)
        for k in range(words):
            runs = runs * _NEXT + spread[k : k + len(runs)]
        runs = mixed(runs)
        start = 0
        for c in counts.tolist():
            if c >= words:
                yield np.unique(runs[start : start + c - words + 1])
            elif c:
                one = np.uint64(c)
                for h in spread[start : start + c]:
                    one = one * _NEXT + h
                yield mixed(np.array([one], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
            start += c


def slabs(texts: Iterator[bytes], size: int = SLAB) -> Iterator[list[bytes]]:
    held, total = [], 0
    for t in texts:
        if held and total + len(t) > size:
            yield held
            held, total = [], 0
        held.append(t)
        total += len(t)
    if held:
        yield held


def all_sets(texts: Iterator[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    for slab in slabs(texts):
        yield from shingle_sets(slab, words)
