"""Hashes of words and of word shingles, for many texts at once."""

from __future__ import annotations

import numpy as np

#: Bytes of text that one pass over the arrays takes.
SLICE = 1 << 20
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_seeded = np.random.default_rng(20240229)
BYTES = _seeded.integers(0, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be inverted
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
WIDTH = 5
FACTORS = _seeded.integers(0, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _slice_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a buffer; words are runs of bytes that aren't white space."""
    space = SPACES[buf]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    starts, ends = edge[0::2], edge[1::2]
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(BYTES[LOWER[buf]] * powers(BASE, len(buf)), out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(buf) + 1)[starts])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) of all texts in a row, and where each text's words begin."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    hashes, owners, group, size, first = [], [], [], 0, 0

    def flush() -> None:
        nonlocal group, size, first
        if group:
            data = b"\n".join(group)
            at = np.cumsum([0, *(len(r) + 1 for r in group)])
            lo = 0
            while lo < len(data):
                hi = min(lo + SLICE, len(data))
                if hi < len(data):  # a slice ends at white space
                    cut = max(data.rfind(b" ", lo, hi), data.rfind(b"\n", lo, hi))
                    if cut > lo:
                        hi = cut + 1
                    else:
                        ahead = [x for x in (data.find(b" ", hi), data.find(b"\n", hi)) if x >= 0]
                        hi = min(ahead) + 1 if ahead else len(data)
                starts, h = _slice_words(np.frombuffer(data, dtype=np.uint8, count=hi - lo, offset=lo))
                hashes.append(h)
                owners.append(np.searchsorted(at, starts + lo, side="right") - 1 + first)
                lo = hi
        first, group, size = first + len(group), [], 0

    for r in raw:
        group.append(r)
        size += len(r)
        if size >= SLICE:
            flush()
    flush()
    words = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
    return words, np.searchsorted(owner, np.arange(len(texts) + 1))


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of all runs of `width` words of one text; of the whole text, if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        return mixed((words * FACTORS[:n]).sum(keepdims=True) + np.uint64(n))
    out = words[: n - width + 1] * FACTORS[0]
    for k in range(1, width):
        out = out + words[k : n - width + 1 + k] * FACTORS[k]
    return mixed(out)


def text_shingles(texts: list[str | None]) -> list[np.ndarray]:
    words, at = word_hashes(texts)
    return [shingle_hashes(words[i:j]) for i, j in zip(at[:-1], at[1:])]
