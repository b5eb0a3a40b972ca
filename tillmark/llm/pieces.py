"""Token ids of batches of texts through the tokenizers library, each distinct piece of text encoded once.

A tokenizer first cuts a text into words, and its merges never cross a cut. So a text may be cut beforehand wherever the
tokenizer cuts anyway (here at spaces and line breaks, and between a word and its marks), and the ids of a piece depend on
nothing else. Numpy finds the cuts in the bytes of a batch and Arrow numbers the different pieces; those that are new are
encoded together, and numpy puts the ids of the texts together from theirs. No step of Python is taken for a piece that
comes again. A worker keeps short pieces for its next batches, within a budget of bytes that all its encoders share; what is
kept changes the time taken but no result.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import compress, pairwise
from operator import not_

import numpy as np
import pyarrow as pa

# Spark's tasks are what runs in parallel.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not every C library has it
    _TRIM = None

# Bytes of pieces that a worker keeps, and the longest piece kept.
BUDGET, LONGEST = 128 << 20, 64
# What an entry of a dict costs besides its characters and ids.
_ENTRY = 200
# Kinds of bytes. Letters are those that lower-casing and composition map to one letter, marks are without an apostrophe.
_OTHER, _LETTER, _MARK, _GAP = range(4)
_KINDS = np.zeros(256, np.uint8)
_KINDS[[c for c in range(128) if chr(c).isalpha()] + [0xC3]] = _LETTER
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = _MARK
_KINDS[[ord(" "), ord("\n")]] = _GAP
# White space and what may be taken for it: single bytes, and characters of several bytes by their first.
_SOLID = np.array([32 < c != 127 for c in range(256)])
_WHITE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 stays, the rest moves up."""
    stay = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in set(stay)]
    return {b: chr(b) for b in stay} | {b: chr(256 + i) for i, b in enumerate(moved)}


_SPELLING = byte_letters()


def as_bytes(ids: Iterable[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    return packed.tobytes()


def solid(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 begin or end a character that is surely not white; those inside of one don't matter."""
    found = _SOLID[data]
    for lead in sorted({w[0] for w in _WHITE}):
        at = np.flatnonzero(data == lead)
        for white in [w for w in _WHITE if w[0] == lead] if len(at) else ():
            own = at[np.logical_and.reduce([data[at + k] == c for k, c in enumerate(white)])]
            found[own] = found[own + len(white) - 1] = False
    return found


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8."""
    found = _KINDS[data]
    lead = np.flatnonzero(data == 0xC3)
    # Multiplication and division signs stand among the letters.
    no = np.isin(data[lead + 1], [0x97, 0xB7])
    found[lead[~no] + 1], found[lead[no]] = _LETTER, _OTHER
    return found


def before_marks(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where marks begin that end a piece which is a word apart from them. `first` says where texts begin."""
    kind = kinds(data)
    new = first.copy()
    new[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(new)
    # A run of bytes of one kind never goes on into the next text.
    run, begins = kind[starts], first[starts]
    gap = run == _GAP
    opens, closes = begins | np.append(True, gap[:-1]), np.append(begins[1:] | gap[1:], True)
    marks = (run == _MARK) & ~begins & closes
    marks[1:] &= (run[:-1] == _LETTER) & opens[:-1]
    return starts[marks]


def numbered(data: np.ndarray, ends: np.ndarray, cuts: np.ndarray, gone: np.ndarray | None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different pieces of texts, the number of each piece in turn, and how many pieces each text has.

    `cuts` says at which bytes pieces begin, `gone` which bytes belong to none, `ends` where texts end.
    """
    at = np.flatnonzero(cuts)
    sizes = np.diff(np.searchsorted(at, ends), prepend=0)
    if gone is not None:
        left = np.cumsum(~gone) - ~gone
        at, data = left[at], data[~gone]
    offsets = np.append(at, len(data)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), sizes


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The integers from each start on, as many as its size says."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def gathered(coded: list[bytes], kind: str, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of pieces in turn, and where those of each text end. `coded` has the values of each different piece."""
    values = np.frombuffer(b"".join(coded), kind)
    own = np.fromiter(map(len, coded), np.int64, len(coded)) // values.itemsize
    each = own[numbers]
    return values[ranges((np.cumsum(own) - own)[numbers], each)], np.append(0, np.cumsum(each))[np.cumsum(sizes)]


def together(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, where each ends, and which bytes begin a text."""
    joined = pa.array(texts, pa.large_string())
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(texts) + 1)
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8, int(offsets[-1]))
    # An empty text at the end would begin behind the last byte.
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    return data, offsets[1:], first[:-1]


class Kept:
    """Ids of pieces by encoder, within one budget of bytes: emptied when a batch has spent it. Long pieces are kept for
    their batch only."""

    def __init__(self, budget: int):
        self.budget, self.spent, self.known, self.long = budget, 0, {}, []

    def of(self, owner: str) -> dict[str, bytes]:
        return self.known.setdefault(owner, {})

    def entered(self, owner: str, pieces: Iterable[str]) -> None:
        own, pieces = self.known[owner], list(pieces)
        sizes = list(map(len, pieces))
        if max(sizes, default=0) > LONGEST:
            self.long += [(own, piece) for piece, size in zip(pieces, sizes) if size > LONGEST]
            pieces = [piece for piece, size in zip(pieces, sizes) if size <= LONGEST]
            sizes = list(map(len, pieces))
        self.spent += 4 * sum(sizes) + sum(map(len, map(own.__getitem__, pieces))) + _ENTRY * len(pieces)

    def settle(self) -> None:
        """After a batch: back within the budget."""
        for own, piece in self.long:
            del own[piece]
        self.long.clear()
        if self.spent > self.budget:
            self.clear()

    def clear(self) -> None:
        for own in self.known.values():
            own.clear()
        self.spent = 0


class Memory(dict):
    """Values of short pieces; a missing one is made, a long one every time. Emptied when full."""

    def __init__(self, make: Callable[[str], object], most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, piece: str):
        value = self.make(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[piece] = value
        return value


KEPT = Kept(BUDGET)


class BatchEncoder:
    """Encodes texts with the tokenizer of a JSON file.

    Texts of known chains (byte-level words that take a leading space, and lower-cased words with an end mark) are cut
    into pieces; a text of any other tokenizer is one piece. Special strings inside texts are handled as the library does by
    default, or are plain text if `plain_specials` is set. With `merge_only`, pieces that are a plain word go straight to
    the library's merge model, which costs half of its whole chain.
    """

    def __init__(self, path: str, plain_specials: bool = False, merge_only: bool = True, kept: Kept | None = None):
        # The file is the library's input on each executor, read by path as the library does.
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = self._kind(spec)
        # Strings that the library takes out of a text before anything else.
        added = [t for t in spec.get("added_tokens") or () if not (plain_specials and t["special"])]
        self.added = [t["content"].encode() for t in added]
        self.merge_only = merge_only
        self.kept = KEPT if kept is None else kept
        self.name = f"{path}:{plain_specials}"

    @staticmethod
    def _kind(spec: dict) -> str:
        pre = spec.get("pre_tokenizer") or {}
        model = spec["model"]
        if model.get("type") != "BPE" or model.get("dropout"):
            return "whole"
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not spec["normalizer"]:
            return "byte"
        steps = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        if model.get("end_of_word_suffix") and steps == ["NFC", "Replace", "Lowercase"]:
            return "word"
        return "whole"

    def _library(self, texts: list[str]) -> list[bytes]:
        """The ids of texts by one call of the library."""
        return [as_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, spelled: Iterable[str]) -> Iterator[bytes]:
        """The ids of each plain word, spelled in the vocabulary's letters, by the library's merge model."""
        ids, ends = [], [0]
        # One call for the model: it is a property that makes a new object.
        tokenize = self.tokenizer.model.tokenize
        for word in spelled:
            ids += [t.id for t in tokenize(word)]
            ends.append(4 * len(ids))
        packed = as_bytes(ids)
        return (packed[a:b] for a, b in pairwise(ends))

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The different pieces of texts, the number of each piece in turn, and how many pieces each text has."""
        data, ends, first = together(texts)
        cuts, gone = first.copy(), None
        if self.kind == "word":
            # White space is only what stands between pieces.
            gone = (data == ord(" ")) | (data == ord("\n"))
            cuts |= gone
        elif self.kind == "byte":
            full = solid(data)
            # Where the next character is of the same text and surely not white.
            goes_on = np.append(full[1:] & ~first[1:], False)
            goes_on[self._before_added(data)] = False
            space, line = data == ord(" "), data == ord("\n")
            # The last white character before a word is apart from those before it: a space goes with the word.
            cuts |= (space | line) & goes_on
            cuts[1:] |= (line & goes_on)[:-1] | (line[1:] & full[:-1])
        if self.kind != "whole":
            cuts[before_marks(data, first)] = True
        return numbered(data, ends, cuts, gone)

    def cut(self, text: str) -> list[str]:
        """The pieces of a text in turn, as they stand in it."""
        pieces, numbers, _ = self._cut([text])
        return pieces.take(pa.array(numbers)).to_pylist()

    def _before_added(self, data: np.ndarray) -> list[int]:
        """The bytes before strings that the library takes out; for it a text ends there."""
        found, whole = [], data.tobytes() if self.added else b""
        for own in self.added:
            at = whole.find(own)
            while at >= 0:
                found.append(at - 1)
                at = whole.find(own, at + 1)
        return [at for at in found if at >= 0]

    def _encoded(self, parts: list[str], plain: list[bool]) -> dict[str, bytes]:
        """The ids of pieces; `plain` says which are a word of letters and go to the merge model."""
        words, rest = list(compress(parts, plain)), list(compress(parts, map(not_, plain)))
        found = dict(zip(rest, self._library(rest))) if rest else {}
        if self.kind == "byte":
            found.update(zip(words, self._merged(map(self._spelled, words))))
        elif words:
            # Words that differ in their capitals are merged once.
            lower = list(map(str.lower, words))
            new = list(dict.fromkeys(lower))
            merged = dict(zip(new, self._merged(map(self._spelled, new))))
            found.update(zip(words, map(merged.__getitem__, lower)))
        return found

    @staticmethod
    def _spelled(word: str) -> str:
        """A word in the letters that stand for its bytes."""
        if word.isascii():
            return word.replace(" ", "Ġ")
        return word.encode("utf-8").decode("latin-1").translate(_SPELLING)

    def _plain(self, pieces: pa.Array) -> np.ndarray:
        """Which pieces are words of letters, at byte level also with a space before them."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1)
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8, int(offsets[-1]))
        odd = np.append(0, np.cumsum(kinds(data) != _LETTER))
        starts, ends = offsets[:-1], offsets[1:]
        if self.kind == "byte":
            starts = starts + (np.append(data, 0)[starts] == ord(" "))
        return (odd[ends] == odd[starts]) & (ends > starts)

    def _coded(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The ids of each different piece, the number of each piece in turn, and how many pieces each text has. What is
        not kept goes to the library together, each piece once."""
        found, numbers, sizes = self._cut(texts)
        pieces = found.to_numpy(zero_copy_only=False).tolist()
        known = self.kept.of(self.name)
        coded = list(map(known.get, pieces))
        new = [ids is None for ids in coded]
        if any(new):
            self._learn(known, list(compress(pieces, new)))
            coded = list(map(known.__getitem__, pieces))
        self.kept.settle()
        return coded, numbers, sizes

    def _learn(self, known: dict[str, bytes], new: Iterable[str]) -> None:
        new = list(new)
        # Nothing made here refers back to itself; looking for that among so many objects takes a tenth of the time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            merge = self.merge_only and self.kind != "whole"
            plain = self._plain(pa.array(new, pa.large_string())).tolist() if merge else [False] * len(new)
            known.update(self._encoded(new, plain))
            self.kept.entered(self.name, new)
        finally:
            if collecting:
                gc.enable()

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, unsigned 32-bit, and where those of each text end."""
        coded, numbers, sizes = self._coded(texts)
        return gathered(coded, "<u4", numbers, sizes)

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        ids, ends = self.flat(texts)
        packed = ids.tobytes()
        return [packed[a:b] for a, b in pairwise([0, *(4 * ends).tolist()])]

    def counts(self, texts: list[str]) -> list[int]:
        """How many ids each text has."""
        coded, numbers, sizes = self._coded(texts)
        each = np.fromiter(map(len, coded), np.int64, len(coded))[numbers] // 4
        return np.diff(np.append(0, np.cumsum(each))[np.cumsum(sizes)], prepend=0).tolist()


_ENCODERS: dict[tuple, BatchEncoder] = {}


def release() -> None:
    """Give memory that is free again back to the system: Python workers outlive their stage and would sit on it."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def forget() -> None:
    """Drop what this process keeps, and release it; operators that need room of their own call this first."""
    KEPT.clear()
    _ENCODERS.clear()
    release()


def released(batches: Iterable) -> Iterator:
    """The batches of a task, after which its free memory is released."""
    yield from batches
    release()


def encoder(path: str, plain_specials: bool = False, merge_only: bool = True) -> BatchEncoder:
    """The encoder of a file, one per Python process."""
    key = (path, plain_specials, merge_only)
    if key not in _ENCODERS:
        _ENCODERS[key] = BatchEncoder(*key)
    return _ENCODERS[key]


def balanced(sizes: list[int], limit: int) -> Iterable[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to the limit at most; a single larger one stands alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
