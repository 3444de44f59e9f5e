"""Secret scan: patterns find candidates, decoded structure confirms keys and tokens."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from lakeweir.llm.common import map_frames

# The base patterns with the least length of the part that counts.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

# Candidates of the structural kinds. A run of either alphabet is decoded whole.
# Lines of an armored key may end in a backslash and n, as in JSON, and begin with headers.
ARMOR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----((?:(?:\\r|\\n|\s)+[A-Za-z][A-Za-z-]*:[^\n\\]*)*)"
    r"((?:[A-Za-z0-9+/=\s]|\\r|\\n)+)-----END \1PRIVATE KEY-----"
)
BLOB = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_BLOB = re.compile(r"[0-9A-Fa-f]{64,}")
# Parts with dots between them. It begins at a run's first character only, so that long runs are read once.
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*)+")
HEADER_LEAST, CLAIMS_LEAST = 8, 2

KINDS = ("assign", "access", "hex", "key_der", "key_ssh", "token_signed")

# Octets of a signature by algorithm; for the others a least length.
EXACT_SIGNATURE = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,),
    "EdDSA": (64, 114),
}
LEAST_SIGNATURE = {"RS256": 128, "RS384": 128, "RS512": 128, "PS256": 128, "PS384": 128, "PS512": 128}

SSH_MAGIC = b"openssh-key-v1\0"


def unbase64(text: str) -> bytes | None:
    """Octets of standard or URL-safe base64 with or without padding, or None."""
    body = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Elements of a definite-length encoding that fill ``data`` exactly, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width], "big")
            at += width
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """A private key: one sequence whose nested lengths and element types fit a known layout."""
    outer = der_items(data)
    if outer is None or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_items(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]) and inner[0][1] in (b"\0", b"\1"):
        return True  # the nine integers of an RSA key
    if tags == [0x02] * 6 and inner[0][1] == b"\0":
        return True  # DSA: version, p, q, g, public, private
    if len(tags) >= 2 and tags[:2] == [0x02, 0x04] and inner[0][1] == b"\1":
        return 16 <= len(inner[1][1]) <= 66  # a curve's secret number
    if tags[0] == 0x02 and inner[0][1] in (b"\0", b"\1"):
        inner, tags = inner[1:], tags[1:]  # the version; an encrypted key has none
    if tags[:2] == [0x30, 0x04] and len(inner[1][1]) >= 16:
        algorithm = der_items(inner[0][1])  # starts with the algorithm's name; the key's octets follow
        return bool(algorithm) and algorithm[0][0] == 0x06
    return False


def is_ssh_key(data: bytes) -> bool:
    """The binary form of an OpenSSH private key: magic, then strings with nested lengths."""
    if not data.startswith(SSH_MAGIC):
        return False
    at, strings = len(SSH_MAGIC), 0
    while at < len(data):
        if strings == 3:  # number of keys, then public and private parts
            if int.from_bytes(data[at : at + 4], "big") < 1:
                return False
            at += 4
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return False
        at += 4 + size
        strings += 1
    return strings >= 5


def armored_kind(headers: str, body: str) -> int | None:
    """Kind of an armored key: its body is a key's encoding, or by its headers an encrypted one in whole cipher blocks."""
    data = unbase64(body.replace("\\n", "\n").replace("\\r", "\r"))
    if not data:
        return None
    if "Proc-Type:" in headers and "ENCRYPTED" in headers and "DEK-Info:" in headers:
        return 3 if len(data) >= 64 and len(data) % 8 == 0 else None
    return key_kind(data)


def key_kind(data: bytes) -> int | None:
    """Kind of the key that the octets encode, also as an armored text, or None."""
    if data.startswith(b"-----BEGIN "):
        whole = ARMOR.match(data.decode("latin-1"))
        return armored_kind(whole[2], whole[3]) if whole else None
    return 3 if is_der_key(data) else 4 if is_ssh_key(data) else None


def signed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of three neighbouring parts that make a signed token; a part is tried as header once."""
    found = []
    for run in DOTTED.finditer(text):
        parts, at, starts = run[0].split("."), run.start(), []
        for part in parts:
            starts.append(at)
            at += len(part) + 1
        k = 0
        while k + 2 < len(parts):
            head, claims, signature = parts[k : k + 3]
            # The first eight characters of a header decode to white space and an opening brace.
            if (
                len(head) >= HEADER_LEAST and len(claims) >= CLAIMS_LEAST
                and (unbase64(head[:8]) or b"").lstrip()[:1] in (b"{", b"")
                and is_signed_token(f"{head}.{claims}.{signature}")
            ):
                found.append((starts[k], 5, starts[k + 2] + len(signature)))
                k += 2
            k += 1
    return found


def is_signed_token(text: str) -> bool:
    """Three parts: a JSON header that names a known algorithm, JSON claims, a signature that long."""
    head, claims, signature = text.split(".")
    try:
        header, body = (json.loads(unbase64(x) or b"") for x in (head, claims))
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(body, dict):
        return False
    name, octets = header.get("alg"), unbase64(signature)
    if not isinstance(name, str) or octets is None:
        return False
    if name in EXACT_SIGNATURE:
        return len(octets) in EXACT_SIGNATURE[name]
    return len(octets) >= LEAST_SIGNATURE.get(name, 1 << 62)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns: leftmost, not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def structural_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans whose decoded form is a key or a signed token."""
    found, armored = set(), []
    if "PRIVATE KEY-----" in text:
        for m in ARMOR.finditer(text):
            if kind := armored_kind(m[2], m[3]):
                found.add((m.start(), kind, m.end()))
                armored.append(m.span())
    for m in BLOB.finditer(text):
        if any(a <= m.start() < b for a, b in armored):
            continue
        data = unbase64(m[0])
        if data and (kind := key_kind(data)):
            found.add((m.start(), kind, m.end()))
    for m in HEX_BLOB.finditer(text):
        if len(m[0]) % 2 == 0:
            data = bytes.fromhex(m[0])
            if kind := key_kind(data):
                found.add((m.start(), kind, m.end()))
    if "." in text:
        found.update(signed_spans(text))
    return sorted(found)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_text(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and structural spans of one whole text; a null text has none."""
    return (base_spans(text), structural_spans(text)) if text else ([], [])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of base spans, their digest, all spans.

    Reads only doc_id and text, moves no row: each task scans the whole texts it reads, a
    batch at a time. Null or empty text has no spans (digest of the empty string); repeated rows
    give repeated results; a null doc_id stays null; an empty table gives an empty one. Starts
    and ends count code points, ends excluded. Kinds of the method follow the base kinds on ties.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base, more = scan_text(text)
                count = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                digest = hashlib.sha256(spelled(base).encode()).hexdigest()
                out.append((*count, digest, spelled(sorted(base + more)), len(more)))
            frame = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), frame], axis=1)

    return map_frames(
        docs.select("doc_id", "text"), scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"
    )
