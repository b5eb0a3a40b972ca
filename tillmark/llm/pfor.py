"""Patched frame of reference: blocks of integers packed at a width that most of them fit.

A block of 128 values is stored as its minimum and, packed at one width, what each value exceeds it by. The width is
the bits of a percentile of those excesses; a value that needs more is an exception, listed with its place in the block
and its upper bits. Where each block starts is indexed, so any block decodes alone.

Image of a segment, all little endian:
  header      magic u32, documents u32, values u64, exceptions u64, words u64
  documents   doc_id i64 each, whether it is null u8 each, end of the document's values u64 each
  blocks      first word u64 each, first exception u64 each, minimum u32 each, width u8 each
  packed      words u64, blocks in order; value i of a block starts at bit i * width
  exceptions  place in the block u8 each, upper bits u32 each
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 128
MAGIC = 0x324F4650
_HEADER = struct.Struct("<IIQQQ")


def _widths(excess: np.ndarray, percentile: float) -> np.ndarray:
    """Bits of each block's percentile excess."""
    at = min(BLOCK - 1, int(np.ceil(percentile / 100 * BLOCK)) - 1)
    bound = np.partition(excess, at, axis=1)[:, at]
    widths = np.zeros(len(bound), np.uint8)
    for bit in range(32):
        widths[bound >= (1 << bit)] = bit + 1
    return widths


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of 2 * width words."""
    words = np.zeros((2 * width, len(values)), np.uint64)
    columns = np.ascontiguousarray(values.T).astype(np.uint64)
    for i in range(BLOCK):
        word, bit = divmod(i * width, 64)
        words[word] |= columns[i] << np.uint64(bit)
        if bit + width > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - bit)
    return words.T


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T)
    values = np.empty((BLOCK, words.shape[0]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, bit = divmod(i * width, 64)
        value = columns[word] >> np.uint64(bit)
        if bit + width > 64:
            value |= columns[word + 1] << np.uint64(64 - bit)
        values[i] = value & mask
    return values.T


def encode(
    doc_ids: np.ndarray,
    ends: np.ndarray,
    values: np.ndarray,
    percentile: float = 90,
    nulls: np.ndarray | None = None,
) -> bytes:
    """Image of the values of some documents; ends[i] is where the values of doc_ids[i] end.

    `nulls` tells which documents have no id, whatever stands for it in doc_ids; without it all have one.
    """
    nulls = np.zeros(len(doc_ids), np.uint8) if nulls is None else nulls
    count = len(values)
    blocks = -(-count // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[:count] = values
    padded[count:] = values[-1] if count else 0
    padded = padded.reshape(blocks, BLOCK)
    minimum = padded.min(axis=1) if blocks else np.empty(0, np.uint32)
    excess = padded - minimum[:, None]
    widths = _widths(excess, percentile) if blocks else np.empty(0, np.uint8)
    first_word = np.concatenate([[0], np.cumsum(2 * widths.astype(np.uint64))]).astype(np.uint64)
    packed = np.empty(int(first_word[-1]), np.uint64)
    limit = np.uint64(1) << widths.astype(np.uint64)
    row, place = np.nonzero(excess >= limit[:, None])
    first_exception = np.searchsorted(row, np.arange(blocks)).astype(np.uint64)
    upper = excess[row, place] >> widths[row].astype(np.uint32)
    for width in np.unique(widths):
        w = int(width)
        if not w:
            continue
        rows = np.flatnonzero(widths == width)
        low = excess[rows] & np.uint32((1 << w) - 1)
        packed[(first_word[rows][:, None] + np.arange(2 * w, dtype=np.uint64)).astype(np.int64)] = _pack(low, w)
    return b"".join(
        [
            _HEADER.pack(MAGIC, len(doc_ids), count, len(row), len(packed)),
            np.asarray(doc_ids, "<i8").tobytes(),
            np.asarray(nulls, "u1").tobytes(),
            np.asarray(ends, "<u8").tobytes(),
            first_word[:-1].tobytes(),
            first_exception.tobytes(),
            minimum.tobytes(),
            widths.tobytes(),
            packed.tobytes(),
            place.astype(np.uint8).tobytes(),
            upper.astype(np.uint32).tobytes(),
        ]
    )


class Segment:
    """An image opened for reading."""

    def __init__(self, image: bytes):
        magic, docs, self.count, exceptions, words = _HEADER.unpack_from(image)
        if magic != MAGIC:
            raise ValueError("not a segment of packed token ids")
        self.blocks = -(-self.count // BLOCK)
        at = _HEADER.size

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(image, kind, n, at)
            at += found.nbytes
            return found

        self.doc_ids, self.nulls, self.ends = part("<i8", docs), part("u1", docs).astype(bool), part("<u8", docs)
        self.first_word, self.first_exception = part("<u8", self.blocks), part("<u8", self.blocks)
        self.minimum, self.widths = part("<u4", self.blocks), part("u1", self.blocks)
        self.packed = part("<u8", words)
        self.place, self.upper = part("u1", exceptions), part("<u4", exceptions)

    def values(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Values start to end, decoding only the blocks that hold them."""
        end = self.count if end is None else min(end, self.count)
        if start >= end:
            return np.empty(0, np.uint32)
        lo, hi = start // BLOCK, -(-end // BLOCK)
        widths = self.widths[lo:hi]
        out = np.zeros((hi - lo, BLOCK), np.uint32)
        for width in np.unique(widths):
            w = int(width)
            if not w:
                continue
            rows = np.flatnonzero(widths == width)
            at = (self.first_word[lo + rows][:, None] + np.arange(2 * w, dtype=np.uint64)).astype(np.int64)
            out[rows] = _unpack(self.packed[at], w)
        first = int(self.first_exception[lo])
        last = int(self.first_exception[hi]) if hi < self.blocks else len(self.place)
        each = np.diff(np.append(self.first_exception[lo:hi], last).astype(np.int64))
        rows = np.repeat(np.arange(hi - lo), each)
        out[rows, self.place[first:last]] |= self.upper[first:last] << widths[rows].astype(np.uint32)
        out += self.minimum[lo:hi, None]
        return out.reshape(-1)[start - lo * BLOCK : end - lo * BLOCK]
