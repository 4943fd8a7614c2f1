"""Secrets in texts: patterns, and structural confirmation of encoded keys and signed tokens.

Base kinds are patterns. Two more are reported only if the decoded candidate proves its structure:

``key``
    base64 (a run, also over several lines, or the body of a PEM block; line ends may be escaped)
    or hexadecimal digits that decode to a private key; base64 may begin inside of a run but has to
    end with it: DER whose nested lengths fill the candidate exactly (PKCS#1, SEC 1, PKCS#8, encrypted
    PKCS#8), or the OpenSSH format, whose strings carry their lengths. A PEM body that is encrypted as
    a whole has whole blocks of the cipher that its headers name, and a start value of one block.
``jwt``
    three dotted base64url parts of which the first decodes to a header with an ``alg``, the second
    to a JSON object, and the third has the length that the algorithm's signature has.

Public keys and other DER (certificates, plain data) are not reported. Defined results: a null
text counts as an empty one and has no spans; rows are neither joined nor grouped; other columns
are left out by ``scan`` and kept by ``redact``. Spans count code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wordmill.llm.common import Span, map_rows, ordered, sha256, span_list, texts

BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "key", "jwt"]
REDACTED = "[SECRET]"

# The base patterns.
_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Candidates that are decoded.
# The first byte of DER is 0x30, and its second one is below 0x90; the other start is the OpenSSH magic.
_START = re.compile(r"M(?=[C-I][A-Za-z0-9+/_-]{14})|b(?=3BlbnNzaC1rZXktdjE)")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\+r)?\\+n)[ \t]*")
_PADDING = re.compile(r"={0,2}")
_LEAST_DIGITS = 40
_ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{2}){24,}(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:[0-9A-F]{2}){24,}(?![0-9A-Za-z])")
_PEM = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]+ ){0,3}PRIVATE KEY)-----"
    r"(?:(?:\s|\\+[nrt])*Proc-Type: 4,ENCRYPTED(?:\s|\\+[nrt])+DEK-Info: (?P<cipher>[A-Z0-9-]+),(?P<start>[0-9A-Fa-f]+)(?=\s|\\))?"
    r"(?P<body>(?:[A-Za-z0-9+/=\s]|\\+[nrt/])*)-----END \1-----"
)
# Bytes of a block by the cipher that encrypts a PEM body as a whole.
CIPHER_BLOCKS = {"DES-CBC": 8, "DES-EDE3-CBC": 8, "AES-128-CBC": 16, "AES-192-CBC": 16, "AES-256-CBC": 16}
_ESCAPED = re.compile(r"\s+|\\+[nrt]|\\+(?=/)")  # no digits of a PEM body
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(ey[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?!\.?[A-Za-z0-9_-])")
# Bytes that a signature may have by algorithm; None: any, but some. RSA signatures follow the key's length.
SIGNATURE_BYTES = {
    "none": (0,), "HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,),
    "EdDSA": (64, 114), "Ed25519": (64,), "Ed448": (114,),
    "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None,
}
_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """``(tag, first, after)`` of the values that fill ``data[start:end]`` exactly, or None."""
    items, at = [], start
    while at < end:
        if at + 2 > end or data[at] & 0x1F == 0x1F:
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length & 0x80:
            width = length & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            length = int.from_bytes(data[at : at + width], "big")
            if length < 0x80 or data[at] == 0:
                return None  # DER uses the shortest form
            at += width
        if at + length > end:
            return None
        items.append((tag, at, at + length))
        at += length
    return items


def is_der_key(data: bytes) -> bool:
    """Whether DER data that fills ``data`` is a private key."""
    outer = der_items(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    items = der_items(data, *outer[0][1:])
    if not items or len(items) < 2:
        return False
    tags = [t for t, _, _ in items]

    def algorithm(item: tuple[int, int, int]) -> bool:
        inner = der_items(data, *item[1:]) if item[0] == _SEQUENCE else None
        return bool(inner) and inner[0][0] == _OID and inner[0][2] > inner[0][1]

    if tags == [_SEQUENCE, _OCTETS]:  # encrypted PKCS#8
        return algorithm(items[0]) and items[1][2] - items[1][1] >= 16
    if tags[0] != _INTEGER or items[0][2] - items[0][1] != 1:
        return False
    version = data[items[0][1]]
    if tags[1:3] == [_SEQUENCE, _OCTETS]:  # PKCS#8
        return version in (0, 1) and algorithm(items[1]) and items[2][2] - items[2][1] >= 16
    if tags[1] == _OCTETS:  # SEC 1
        return version == 1 and 16 <= items[1][2] - items[1][1] <= 72
    numbers = [b - a for _, a, b in items]
    return version in (0, 1) and len(items) >= 9 and set(tags[:9]) == {_INTEGER} and numbers[1] >= 32  # PKCS#1


def is_openssh_key(data: bytes) -> bool:
    """The OpenSSH private key format: a magic, and strings after their lengths."""
    return 0 < openssh_length(data) == len(data)


def openssh_length(data: bytes) -> int:
    """Bytes of the OpenSSH private key that ``data`` begins with, 0 without one."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return 0
    at, found = len(magic), []

    def string(at: int) -> tuple[bytes, int]:
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data):
            raise ValueError
        return data[at + 4 : at + 4 + length], at + 4 + length

    try:
        for _ in range(3):
            value, at = string(at)
            found.append(value)
        keys = int.from_bytes(data[at : at + 4], "big")
        at += 4
        for _ in range(keys + 1):  # ends with the data at the latest
            value, at = string(at)
    except ValueError:
        return 0
    return at if keys >= 1 and found[0].isascii() and found[0] and value else 0


def is_encrypted_body(body: bytes, cipher: str, start: str) -> bool:
    """Whether an encrypted PEM body is whole blocks of its cipher, and its start value one block."""
    block = CIPHER_BLOCKS.get(cipher)
    return bool(block) and len(start) == 2 * block and len(body) >= 48 and len(body) % block == 0


def der_length(head: bytes) -> int:
    """Bytes that DER beginning with ``head`` says it has, 0 if no private key begins like this."""
    width = head[1] & 0x7F if head[1] & 0x80 else 0
    if head[0] != _SEQUENCE or width > 4 or head[1] == 0x80:
        return 0
    inner = head[2 + width : 4 + width]
    if inner[0] != _SEQUENCE and inner != bytes([_INTEGER, 1]):
        return 0
    return 2 + width + (int.from_bytes(head[2 : 2 + width], "big") if width else head[1])


def unbase64(text: str) -> bytes:
    """Decoded base64 of either alphabet, with or without padding; empty if it is none."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return b""
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    try:
        head, body = json.loads(unbase64(header)), json.loads(unbase64(payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    if head["alg"] not in SIGNATURE_BYTES:
        return False
    wanted, found = SIGNATURE_BYTES[head["alg"]], len(unbase64(signature))
    return found in wanted if wanted is not None else found >= 128


class Runs:
    """Base64 of a text from a place on, across line ends."""

    def __init__(self, text: str) -> None:
        self.text, self.known = text, (0, 0)

    def _end(self, at: int) -> int:
        if not self.known[0] <= at < self.known[1]:
            m = _RUN.match(self.text, at)
            if not m:
                return at
            self.known = m.span()
        return self.known[1]

    def take(self, at: int, wanted: int | None, enough: int | None = None) -> tuple[str, int] | None:
        """``wanted`` digits that end where a run ends, and the end behind the padding; None: all there are,
        or runs up to ``enough`` digits."""
        found, left = [], wanted
        while enough is None or sum(map(len, found)) < enough:
            end = self._end(at)
            if end == at or left is not None and end - at > left:
                break
            found.append(self.text[at:end])
            if left is not None:
                left -= end - at
                if not left:
                    return "".join(found), _PADDING.match(self.text, end).end()
            following = _BREAK.match(self.text, end)
            if not following:
                break
            at = following.end()
        return None if wanted is not None else ("".join(found), at)


def encoded_keys(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Places of base64 keys outside of ``taken``."""
    runs, after = Runs(text), 0
    for m in _START.finditer(text):
        at = m.start()
        if at < after or any(a <= at < b for a, b in taken):
            continue
        if m[0] == "M":
            size = der_length(unbase64(text[at : at + 16]))
        else:
            if int.from_bytes(unbase64(runs.take(at, None, 28)[0][:28])[15:19], "big") > len(text):
                continue  # the first string is longer than the text
            digits = runs.take(at, None)[0]
            size = openssh_length(unbase64(digits if len(digits) % 4 != 1 else digits[:-1]))
        wanted = -(-size * 4 // 3)
        if wanted < _LEAST_DIGITS or wanted > len(text) - at:
            continue
        found = runs.take(at, wanted)
        if found and is_key(unbase64(found[0])):
            after = found[1]
            yield at, after


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def confirmed_spans(text: str) -> list[Span]:
    found, taken = [], []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            body = unbase64(_ESCAPED.sub("", m["body"]))
            if is_encrypted_body(body, m["cipher"], m["start"]) if m["cipher"] else is_key(body):
                found.append(("key", m.start(), m.end()))
                taken.append((m.start(), m.end()))
    inside = lambda m: any(a <= m.start() and m.end() <= b for a, b in taken)
    found += [("key", *span) for span in encoded_keys(text, taken)]
    for m in _ANY_HEX.finditer(text):
        if m[0].startswith(("30", "6f", "6F")) and not inside(m) and is_key(bytes.fromhex(m[0])):
            found.append(("key", m.start(), m.end()))
    if "ey" in text:
        for m in _TOKEN.finditer(text):
            if is_signed_token(m[1], m[2], m[3]):
                found.append(("jwt", m.start(), m.end()))
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the spans of each kind, as ``(id, found array<struct<kind, start, end>>)``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            spans = [ordered(base_spans(t) + confirmed_spans(t), KINDS, by_start=True) for t in texts(part, text_col)]
            yield {
                id_col: part.column(0),
                "found": [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans],
            }

    return map_rows(docs.select(id_col, text_col), run, f"{id_col} {kind}, found array<struct<kind: string, start: int, end: int>>")


def scan_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the spans of each row; see ``scan`` for the spans themselves."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            base = [ordered(base_spans(t), KINDS, by_start=True) for t in texts(part, text_col)]
            every = [ordered(b + confirmed_spans(t), KINDS, by_start=True) for b, t in zip(base, texts(part, text_col), strict=True)]
            counts = {f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in BASE_KINDS}
            yield {
                id_col: part.column(0), **counts, "base_sha256": [sha256(span_list(b)) for b in base],
                "spans": [span_list(s) for s in every],
                **{f"n_{k}": [sum(s[0] == k for s in e) for e in every] for k in ("key", "jwt")},
            }

    schema = f"{id_col} {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_key long, n_jwt long"
    return map_rows(docs.select(id_col, text_col), run, schema)


def redacted(text: str) -> str:
    """The text with every secret replaced; overlapping spans are one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for _, start, end in ordered(base_spans(text) + confirmed_spans(text), KINDS, by_start=True):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], REDACTED]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets of each text replaced by ``REDACTED``; a null text stays null."""
    columns = docs.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            cleaned = [t and redacted(t) for t in part.column(columns.index(text_col)).to_pylist()]
            yield dict(zip(columns, part.columns, strict=True)) | {text_col: cleaned}

    return map_rows(docs, run, docs.schema)
