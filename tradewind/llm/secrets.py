"""Secret scans: base patterns, and candidates confirmed by their structure.

Base patterns are `assign`, `access` and `hex`. Beyond them, base64 and hex runs and
dotted triples are decoded and must parse before they are reported:

* `token`  a signed token: header and payload are base64url JSON objects, the header
  names an algorithm, the signature has the length that the algorithm asks for;
* `der`    base64 or hex of one DER value whose nested lengths add up and whose first
  members are those of a private or public key;
* `wire`   base64 of length-prefixed fields that fill the data, the first of them a key
  type, or of the container format of the same tool;
* `pem`    a BEGIN/END block around such a body.

Each kind is searched leftmost and without overlaps. Null and empty texts have no spans.
Rows are independent: repeated rows and null ids give the same row again. Texts are
scanned whole; parsing keeps a stack of its own and stops at `DEPTH` nested values, more
than any key encoding has.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.frames import texts

BASE = ("assign", "access", "hex")
MORE = ("token", "der", "wire", "pem")
ORDER = {kind: i for i, kind in enumerate(BASE + MORE)}
DEPTH = 32

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs that are shorter fail anyway
ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])")
BASE64 = re.compile(r"[A-Za-z0-9+/]{32,}={0,2}")
TRIPLE = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]++)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----((?:(?!-----)[A-Za-z0-9+/=\s:,-])*+)-----END \1-----")

# Signature sizes in bytes by algorithm (None: any size).
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132,
              "EdDSA": 64, "RS256": None, "RS384": None, "RS512": None, "PS256": None,
              "PS384": None, "PS512": None}
# Names that begin a length-prefixed public key, and the container's magic.
KEY_TYPES = {b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256",
             b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521"}
MAGIC = b"openssh-key-v1\0"
INTEGER, BITS, OCTETS, OBJECT, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def unbase64(text: str, url: bool = False) -> bytes | None:
    body = text.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def header(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER value at `at`, if it fits before `end`."""
    if at + 2 > end or data[at] & 0x1F == 0x1F:
        return None
    size, start = data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > end:
            return None
        size = int.from_bytes(data[start:start + n])
        start += n
        if size < 0x80 or size < 1 << 8 * (n - 1):  # not the shortest form
            return None
    return (data[at], start, start + size) if start + size <= end else None


def members(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values that fill data[start:end]; None if they do not."""
    out = []
    while start < end:
        value = header(data, start, end)
        if value is None:
            return None
        out.append(value)
        start = value[2]
    return out


def nested(data: bytes) -> bool:
    """Whether one DER value fills the data and all lengths inside add up."""
    open_values = [(0, len(data), 0)]
    while open_values:
        start, end, depth = open_values.pop()
        found = members(data, start, end)
        if found is None or depth > DEPTH or depth == 0 and len(found) != 1:
            return False
        open_values += [(s, e, depth + 1) for tag, s, e in found if tag & 0x20]
    return True


def is_key(data: bytes | None) -> bool:
    """A DER key: integers after a version, or an algorithm and a wrapped key."""
    if not data or data[0] != SEQUENCE or len(data) < 16 or not nested(data):
        return False
    _, start, end = header(data, 0, len(data))
    parts = members(data, start, end)
    tags = [t for t, _, _ in parts]
    def algorithm(value):
        inner = members(data, value[1], value[2])
        return value[0] == SEQUENCE and inner and inner[0][0] == OBJECT
    if len(tags) >= 9 and set(tags[:9]) == {INTEGER}:
        return True  # version and eight numbers
    if len(tags) >= 3 and tags[0] == INTEGER and tags[2] == OCTETS and algorithm(parts[1]):
        return True  # version, algorithm, wrapped private key
    if len(tags) >= 2 and tags[:2] == [INTEGER, OCTETS] and 0xA0 in tags:
        return True  # version, private number, curve
    if len(tags) == 2 and tags[1] == BITS and algorithm(parts[0]):
        return True  # algorithm, public key
    return tags == [INTEGER] * 6 or (tags == [INTEGER] * 2 and end - start >= 64)


def fields(data: bytes, at: int) -> list[bytes] | None:
    """Length-prefixed fields that fill the data from `at`."""
    out = []
    while at < len(data):
        size = int.from_bytes(data[at:at + 4])
        if at + 4 + size > len(data):
            return None
        out.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return out


def is_wire(data: bytes | None) -> bool:
    if not data:
        return False
    if data.startswith(MAGIC):
        at = len(MAGIC)
        for _ in range(3):  # cipher, key derivation, its options
            size = int.from_bytes(data[at:at + 4])
            at += 4 + size
        n = int.from_bytes(data[at:at + 4])
        inner = fields(data, at + 4)
        return at + 4 < len(data) and 1 <= n <= 16 and inner is not None and len(inner) >= n + 1
    found = fields(data, 0)
    return bool(found) and found[0] in KEY_TYPES and len(found) >= 2


def is_token(head: str, payload: str, signature: str) -> bool:
    parsed = []
    for part in (head, payload):
        try:
            parsed.append(json.loads((unbase64(part, True) or b"").decode()))
        except (ValueError, RecursionError):
            return False
    if not all(isinstance(x, dict) for x in parsed):
        return False
    algorithm, data = parsed[0].get("alg"), unbase64(signature, True)
    if not isinstance(algorithm, str) or algorithm not in SIGNATURES or not data:
        return False
    size = SIGNATURES[algorithm]
    return len(data) == size if size else len(data) >= 128


def base_spans(text: str) -> list[tuple[int, str, int]]:
    out = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api")):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= 20]
    return out + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    out = []
    for m in TRIPLE.finditer(text):
        if is_token(*m.groups()):
            out.append((m.start(), "token", m.end()))
    for m in ANY_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            out.append((m.start(), "der", m.end()))
    for m in BASE64.finditer(text):
        data = unbase64(m[0])
        if is_key(data):
            out.append((m.start(), "der", m.end()))
        elif is_wire(data):
            out.append((m.start(), "wire", m.end()))
    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            body = "".join(x for x in m[2].split("\n") if ":" not in x)
            data = unbase64("".join(body.split()))
            if is_key(data) or is_wire(data):
                out.append((m.start(), "pem", m.end()))
    return out


def written(spans: list[tuple[int, str, int]]) -> str:
    ordered = sorted(set(spans), key=lambda x: (x[0], ORDER[x[1]], x[2]))
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in ordered)


SCHEMA = ("n_assign long, n_access long, n_hex long, n_confirmed long, base string, spans string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds and of confirmed spans, and the spans as text."""
    @F.pandas_udf(T.StructType.fromDDL(SCHEMA))
    def scanned(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in part:
                base, more = base_spans(text), confirmed_spans(text)
                kinds = [kind for _, kind, _ in base]
                rows.append((*(kinds.count(k) for k in BASE), len(more), written(base),
                             written(base + more)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in SCHEMA.split(", ")])

    return texts(docs, id_col, text_col).select("doc_id", scanned("text").alias("x")).select(
        "doc_id", "x.*")


def report(docs: DataFrame) -> DataFrame:
    return scan(docs).select("doc_id", "n_assign", "n_access", "n_hex",
                             F.sha2("base", 256).alias("base_sha256"), "spans", "n_confirmed")
