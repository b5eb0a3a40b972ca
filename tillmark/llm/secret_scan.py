"""Secret scans with structural confirmation.

Patterns find what looks like a secret by its spelling. Runs of base64 or hex are also decoded, and what comes out is
parsed: private keys by their nested lengths (DER sequences, or the OpenSSH layout), signed tokens by their header.
Only what parses to its last byte is reported.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.pieces import forget, released

# In this order where two begin at one place.
KINDS = ("assign", "access", "hex", "jwt", "key", "pem")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs as long as possible, so those of 24 and more are the runs of one and more that are long enough.
_HEX = re.compile(r"[0-9a-f]{24,}")

_JWT = re.compile(r"(?<![A-Za-z0-9_.-])(e[wy3][A-Za-z0-9_-]{6,})\.(e[wy3][A-Za-z0-9_-]*)\.[A-Za-z0-9_-]*")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{56,}={0,2}")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){40,}(?![0-9A-Fa-f])")
_PEM = re.compile(
    r"-----BEGIN (?P<label>[A-Z0-9 ]{0,30}PRIVATE KEY)-----(?P<body>(?:[A-Za-z0-9+/=\s]|\\[nr])+)-----END (?P=label)-----"
)
# Line breaks, and such as are written with a backslash, as in JSON.
_BREAKS = re.compile(r"\s+|(?:\\[nr])+")
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/]{40,76}(?:\r?\n|(?:\\r)?\\n))+[A-Za-z0-9+/]{1,76}={0,2}(?![A-Za-z0-9+/=])"
)
_SSH_MAGIC = b"openssh-key-v1\0"
_LETTERS = {"integer": 0x02, "octets": 0x04, "oid": 0x06, "sequence": 0x30}


def decode_base64(text: str) -> bytes | None:
    """Standard or URL-safe base64 with or without its padding; None if it isn't any."""
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that fill `data` exactly; None if lengths don't add up."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + more], "big")
            at += more
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """A private key as PKCS #8 (plain or encrypted), PKCS #1, SEC 1 or the classic DSA layout."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != _LETTERS["sequence"]:
        return False
    items = der_items(outer[0][1])
    if not items:
        return False
    tags = [tag for tag, _ in items]
    integer, octets, oid, sequence = (_LETTERS[k] for k in ("integer", "octets", "oid", "sequence"))

    def algorithm(content: bytes) -> bool:
        inner = der_items(content)
        return bool(inner) and inner[0][0] == oid and len(inner[0][1]) > 0

    if tags[:1] == [integer] and items[0][1] in (b"\0", b"\1"):
        if tags[1:3] == [sequence, octets]:
            return algorithm(items[1][1]) and len(items[2][1]) > 0
        if tags[1:] in ([integer] * 8, [integer] * 5):
            return all(content and content != b"\0" for _, content in items[1:])
        if items[0][1] == b"\1" and tags[1:2] == [octets] and set(tags[2:]) <= {0xA0, 0xA1}:
            return len(items[1][1]) >= 16 and all(der_items(content) for _, content in items[2:])
    return tags == [sequence, octets] and algorithm(items[0][1]) and len(items[1][1]) >= 16


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: strings with their lengths in front, to the last byte."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)

    def take() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    if not all(take() is not None for _ in range(3)) or at + 4 > len(data):  # cipher, derivation, its options
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 64 or not all(take() for _ in range(keys)):
        return False
    return bool(take()) and at == len(data)


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def _is_object(part: str, name: str | None = None) -> bool:
    data = decode_base64(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and (name is None or isinstance(value.get(name), str))


def find_secrets(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) by start, then kind; code points, end exclusive."""
    found = []
    low = text.lower()
    if any(word in low for word in _ASSIGN_WORDS):
        found += [("assign", *m.span(), m.start(2)) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span(), m.start()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span(), m.start()) for m in _HEX.finditer(text)]
    if ".e" in text:
        found += [
            ("jwt", *m.span(), m.start()) for m in _JWT.finditer(text) if _is_object(m[1], "alg") and _is_object(m[2])
        ]
    blocks = []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            if is_key(decode_base64(_BREAKS.sub("", m["body"]))):
                blocks.append(m.span())
                found.append(("pem", *m.span(), m.start()))
    for m in _WRAPPED.finditer(text):
        lines = _BREAKS.split(m[0])
        even = len({len(x) for x in lines[:-1]}) == 1 and len(lines[-1].rstrip("=")) <= len(lines[0])
        if even and not any(a <= m.start() < b for a, b in blocks):
            if is_key(decode_base64("".join(lines))):
                blocks.append(m.span())
                found.append(("key", *m.span(), m.start()))
    for pattern, decode in ((_BASE64, decode_base64), (_HEX_KEY, bytes.fromhex)):
        for m in pattern.finditer(text):
            if not any(a <= m.start() < b for a, b in blocks) and is_key(decode(m[0])):
                found.append(("key", *m.span(), m.start()))
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind: string, start: long, end: long, value: long>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.int64())])


def secrets_of(text: Column) -> Column:
    """The secrets of a text as an array of kind, start, end and start of the value; null and empty texts have none."""

    @F.arrow_udf(SPANS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end", "value"), s)) for s in find_secrets(t)] for t in batch.to_pylist()
            ]
            yield pa.array(found, pa.list_(_SPAN))

    return scan(F.coalesce(text, F.lit("")))


def scan_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `secrets` to every row (a column of that name is replaced). Whole texts; repeated rows each get theirs."""
    return docs.withColumn("secrets", secrets_of(F.col(f"`{text}`")))


def redact(text: str | None, mark: str = "[REDACTED]") -> str | None:
    """The text with the value of every secret replaced; overlapping ones by one mark."""
    if not text:
        return text
    out, at = [], 0
    for _, _, end, value in sorted(find_secrets(text), key=lambda s: (s[3], s[2])):
        if value >= at:
            out += [text[at:value], mark]
            at = end
        else:
            at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """Replace the secrets of every text, and its length in code points where a secret was found.

    All rows and columns stay; null texts stay null.
    """

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        for batch in released(batches):
            yield pa.array([redact(t) for t in batch.to_pylist()], pa.string())

    own = F.col(f"`{text}`")
    cleaned = docs.withColumn("_cleaned", clean(own))
    columns = {text: F.col("_cleaned")}
    if length in docs.columns:
        changed = F.char_length("_cleaned").cast(docs.schema[length].dataType)
        columns[length] = F.when(F.col("_cleaned").eqNullSafe(own), F.col(f"`{length}`")).otherwise(changed)
    return cleaned.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
