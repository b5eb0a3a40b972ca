"""Sets of word shingles as sorted 64-bit hashes, for whole batches of texts at once.

Words are runs of bytes other than space and 0x09 to 0x0D, with A to Z lower-cased. A word's hash is a polynomial over
its bytes, which a running sum over the batch yields for all words together; a shingle's hash mixes those of its words.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
# Code points that are worked on at once, longer texts alone: bounds the memory of the running sums.
CHUNK = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS[65:91] = _LETTERS[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# One odd factor for each place in a shingle.
_PLACES = [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD]
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _series(factor: int, size: int) -> np.ndarray:
    out = np.full(size, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those of the usual size are kept."""
    global _powers, _inverses
    if size > 4 * CHUNK:
        return _series(_BASE, size), _series(_INVERSE, size)
    if len(_powers) < size:
        _powers, _inverses = _series(_BASE, 4 * CHUNK), _series(_INVERSE, 4 * CHUNK)
    return _powers[:size], _inverses[:size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where the words of each text end."""
    coded = [(t or "").encode("utf-8") + b" " for t in texts]
    data = np.frombuffer(b"".join(coded), np.uint8)
    ends = np.cumsum([len(c) for c in coded])
    space = _IS_SPACE[data]
    powers, inverses = _tables(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * powers[:-1], out=running[1:])
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    stops = np.flatnonzero(space & ~before)
    hashed = (running[stops] - running[starts]) * inverses[starts]
    return _mix(hashed + (stops - starts).astype(np.uint64)), np.searchsorted(starts, ends)


def shingle_sets(texts: list[str | None], width: int = WORDS) -> list[np.ndarray]:
    """The set of each text, sorted: its runs of `width` words (five at most), or all its words as one run if it has fewer."""
    sets, group, size = [], [], 0
    for text in texts:
        if group and size + len(text or "") > CHUNK:
            sets += _sets(group, width)
            group, size = [], 0
        group.append(text)
        size += len(text or "")
    return sets + _sets(group, width) if group else sets


def _sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    words, ends = word_hashes(texts)
    places = [np.uint64(p) for p in _PLACES[:width]]
    runs = max(0, len(words) - width + 1)
    mixed = np.zeros(runs, np.uint64)
    for k, place in enumerate(places):
        mixed += words[k : k + runs] * place
    mixed = _mix(mixed)
    sets, start = [], 0
    for end in ends.tolist():
        if end - start >= width:
            own = np.sort(mixed[start : end - width + 1])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            sets.append(own[new])
        elif end > start:
            total = np.uint64((end - start) * _BASE & (1 << 64) - 1)
            few = sum((words[start + k : start + k + 1] * places[k] for k in range(end - start)), np.zeros(1, np.uint64))
            sets.append(_mix(few + total))
        else:
            sets.append(np.empty(0, np.uint64))
        start = end
    return sets
