"""Vectorised text arrays for the operators that work on Arrow batches inside tasks.

Everything is plain numpy on one block of documents: words, their hashes, and
hashes of all windows of a width. Hashes are 64-bit polynomials modulo 2**64
over random symbol values with a final mix, so equal sequences have equal
hashes in every process and on every machine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def powers(base):
        out = np.full(SEGMENT + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return powers(_BASE), powers(_INVERSE)


@lru_cache(maxsize=1)
def byte_symbols() -> np.ndarray:
    """A fixed random value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def window_hashes(symbols: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """The hash of each run of `width` symbols, by its start; of those at the ascending starts `at` only, if given."""
    n = max(0, len(symbols) - width + 1)
    power, inverse = _powers()
    out = np.empty(n if at is None else len(at), np.uint64)
    step = SEGMENT - width
    if step <= 0:
        raise ValueError(f"width must be under {SEGMENT}")
    for start in range(0, n, step):
        stop = min(start + step, n)
        part = symbols[start : stop + width - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[: len(part)], out=sums[1:])
        if at is None:
            out[start:stop] = (sums[width:] - sums[:-width]) * inverse[: stop - start]
        else:
            a, b = np.searchsorted(at, (start, stop))
            own = at[a:b] - start
            out[a:b] = (sums[own + width] - sums[own]) * inverse[own]
    return mix(out)


def spread(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each run."""
    return np.repeat(begin - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


# The bytes that separate words, \x20 and \x09 to \x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def word_bounds(data: np.ndarray, doc_starts: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in concatenated documents, by the table of bytes that separate words; no word spans two documents."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~between[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    first = doc_starts[doc_starts < len(data)]
    fresh = before.copy()
    fresh[first] = False
    starts = np.flatnonzero(inside & ~fresh)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[first[first > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash for each word, of its bytes, with A-Z lower-cased on request."""
    out = np.empty(len(starts), np.uint64)
    power, inverse = _powers()
    values = byte_symbols()[_LOWER] if lower else byte_symbols()
    word = 0
    while word < len(starts):
        base = starts[word]
        stop = max(word + 1, int(np.searchsorted(ends, base + SEGMENT, side="right")))
        part = data[base : ends[stop - 1]]
        if len(part) > SEGMENT:  # one word longer than a segment: fold the hashes of its pieces
            h = np.uint64(len(part))
            for at in range(0, len(part), SEGMENT):
                piece = values[part[at : at + SEGMENT]]
                h = mix(np.array([h + (piece * power[: len(piece)]).sum(dtype=np.uint64)]))[0]
            out[word] = h
        else:
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values[part] * power[: len(part)], out=sums[1:])
            a, b = starts[word:stop] - base, ends[word:stop] - base
            out[word:stop] = (sums[b] - sums[a]) * inverse[a]
        word = stop
    return mix(out)


def concat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offset at which each begins, then the total."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n units lie in a window of `width` that begins at one of the ascending, distinct `starts`."""
    out = np.zeros(n, bool)
    many = np.minimum(np.diff(starts, append=n + width), width)
    out[spread(starts, many)] = True
    return out
