"""Secret scans with structural confirmation.

Plain patterns find assignments, access keys and long hexadecimal runs. Beyond them, base64 and hexadecimal candidates are
decoded and reported only if the bytes parse: DER key encodings with nested lengths that fit exactly, OpenSSH
private keys with their length-prefixed parts, and signed tokens whose header and payload are JSON objects.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from delaylake.llm.shared import col
from delaylake.llm.words import chunks

# Fixed values of the base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 8
# Greedy runs of a class: a least length in the pattern drops the same matches as a check afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
# Base64 over lines too, as key files have it; the run is cut where decoding shows its end.
# 0x30, a sequence, is M and one of A to P whatever its length; lines may be indented.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXkt)[A-Za-z0-9+/]{30,}(?:(?:\\n|\r?\n)[ \t]*[A-Za-z0-9+/]+)*")
SYMBOL = re.compile(r"(?<!\\)[A-Za-z0-9+/]")
PADDING = re.compile(r"={0,2}")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{60,}(?![0-9A-Fa-f])")

KINDS = ("assign", "access", "hex", "key", "token")
SEQUENCE, INTEGER, BIT_STRING, OCTET_STRING, OBJECT_ID = 0x30, 0x02, 0x03, 0x04, 0x06
FOUND = "id long, n_assign long, n_access long, n_hex long, n_key long, n_token long, spans array<struct<kind:string,start:int,stop:int>>"


def der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag and bounds of the content of the item at a place; None if its length doesn't fit or isn't minimal."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size - 0x80
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if size < 0x80 or size < 1 << 8 * (n - 1):
            return None
    return (tag, at, at + size) if at + size <= end else None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """All items that fill a content exactly."""
    out = []
    while at < end:
        item = der_item(data, at, end)
        if item is None:
            return None
        out.append(item)
        at = item[2]
    return out


def is_key(data: bytes) -> bool:
    """Whether bytes are a private key: RSA or DSA integers, an elliptic curve key, PKCS 8 plain or encrypted, or OpenSSH."""
    if data.startswith(b"openssh-key-v1\0"):
        at, parts = 15, 0
        while parts < 3 and at + 4 <= len(data):
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            parts += at <= len(data)
        return parts == 3 and at + 4 <= len(data)
    whole = der_item(data, 0, len(data))
    if whole is None or whole[0] != SEQUENCE or whole[2] != len(data):
        return False
    items = der_items(data, whole[1], whole[2])
    if not items or len(items) < 2:
        return False
    tags = [t for t, _, _ in items]
    if tags[0] == INTEGER and items[0][2] - items[0][1] == 1:
        if len(tags) >= 6 and set(tags) == {INTEGER}:
            return True
        if tags[1] == OCTET_STRING:
            return items[1][2] - items[1][1] >= 16
        return len(tags) >= 3 and tags[1] == SEQUENCE and names_algorithm(data, items[1]) and tags[2] == OCTET_STRING
    return len(tags) == 2 and tags == [SEQUENCE, OCTET_STRING] and names_algorithm(data, items[0])


def names_algorithm(data: bytes, item: tuple[int, int, int]) -> bool:
    inner = der_items(data, item[1], item[2])
    return bool(inner) and inner[0][0] == OBJECT_ID and inner[0][2] > inner[0][1]


def whole_size(data: bytes) -> int | None:
    """Bytes that an encoding that begins here says it has: an item with its tag and length, or an OpenSSH key with all its parts."""
    if data.startswith(b"openssh-key-v1\0"):
        at = 15
        for part in ("cipher", "derivation", "options", "number of keys", "public key", "private part"):
            if at + 4 > len(data):
                return None
            n = int.from_bytes(data[at : at + 4], "big")
            if part == "number of keys" and n != 1:
                return None
            at += 4 + (n if part != "number of keys" else 0)
        return at
    if len(data) < 2 or data[1] < 0x80:
        return 2 + data[1] if len(data) > 1 else None
    n = data[1] - 0x80
    return 2 + n + int.from_bytes(data[2 : 2 + n], "big") if 1 <= n <= 4 and len(data) >= 2 + n else None


def key_end(run: str) -> int | None:
    """Where the key that begins a base64 run ends: whatever follows its last byte, such as lines of words, is cut off; None if it is no key."""
    places = [m.start() for m in SYMBOL.finditer(run)]
    body = "".join(run[k] for k in places)
    body = body[: len(body) - (len(body) % 4 == 1)]
    data = base64.b64decode(body + "=" * (-len(body) % 4))
    size = whole_size(data)
    if data.startswith(b"openssh") and (size is None or size > len(data)):
        size = len(data)  # encrypted or cut short after its three named parts
    if size is None or size > len(data) or not is_key(data[:size]):
        return None
    return places[-(-size * 8 // 6) - 1] + 1


def json_part(part: str) -> dict | None:
    try:
        found = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, stop) of every find, by start and then by kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in BASE64.finditer(text):
        end = key_end(m[0])
        if end is not None:
            stop = m.start() + end
            out.append((m.start(), 3, stop + len(PADDING.match(text, stop)[0])))
    for m in HEX_KEY.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            out.append((m.start(), 3, m.end()))
    for m in TOKEN.finditer(text):
        head = json_part(m[1])
        if head is not None and isinstance(head.get("alg"), str) and json_part(m[2]) is not None:
            out.append((m.start(), 4, m.end()))
    return [(k, a, b) for a, k, b in sorted(out)]


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: id, finds of each kind, and the spans (kind, start, stop; code points, stop exclusive).

    Spans are whole matches, sorted by start and then by kind in the order assign, access, hex, key, token; kinds may overlap each other.
    Null counts as empty and has none. Whole texts are scanned; repeated rows and rows without id are rows like others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for batch in chunks(batches, "text"):
            found = [spans_of(t or "") for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(k == c for k, _, _ in s) for s in found], pa.int64()) for c in range(len(KINDS))]
            spans = pa.array([[{"kind": KINDS[k], "start": a, "stop": b} for k, a, b in s] for s in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *counts, spans], ["id", *(f"n_{k}" for k in KINDS), "spans"])

    return docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("text")).mapInArrow(run, FOUND)
