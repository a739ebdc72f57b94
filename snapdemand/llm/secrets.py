"""Secret scans: plain patterns, and encoded candidates that are reported only once their structure is confirmed."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import cut_out
from .tables import fresh

#: order in which kinds of one start are listed; the first three are plain patterns, the rest need confirmation
KINDS = ["assign", "access", "hex", "token", "key", "encoded"]
SPANS = "array<struct<kind:string,start:long,end:long,proof:string>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("proof", pa.string())]))

_NAMES = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|" \
         "[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = re.compile(f"(?:{_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile("AKIA[A-Z0-9]+")
#: a run is taken as a whole, so its first character follows none of its kind
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16

_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]{1,20} )?PRIVATE KEY-----\s*((?:[A-Za-z][A-Za-z0-9-]*+:[^\n]*+\n\s*+)*)([A-Za-z0-9+/=\s]+)"
                  r"(?:-----END (?:[A-Z0-9]{1,20} )?PRIVATE KEY-----)?")
_CIPHER = re.compile(r"^DEK-Info:\s*[A-Z0-9-]+,((?:[0-9A-Fa-f]{16}){1,2})\s*$", re.M)
#: 16 characters of base64 and 24 of hex are 12 bytes, the least that is looked into
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_LINE = re.compile("[A-Za-z0-9+/_-]+={0,2}")
_HEX_ANY = re.compile("(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}")
#: line ends and tabs as JSON and shells write them
_ESCAPED = re.compile(r"\\+[nrt]")
#: encodings within encodings that are looked into
DEPTH = 3


def _unbase64(text: str) -> bytes | None:
    text = "".join(text.split()).rstrip("=")
    if len(text) % 4 == 1 or ("-" in text or "_" in text) and ("+" in text or "/" in text):
        return None
    try:
        return base64.b64decode(text.translate({45: 43, 95: 47}) + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of each DER element; None unless their lengths fill ``data`` exactly."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > len(data):
                return None
            n = int.from_bytes(data[at:at + size], "big")
            at += size
        if at + n > len(data):
            return None
        found.append((tag, data[at:at + n]))
        at += n
    return found


def _der_key(data: bytes) -> str | None:
    """The kind of private key that ``data`` encodes: nested lengths must fit and the fields be those of that kind."""
    outer = _elements(data) if data[:1] == b"\x30" else None
    parts = _elements(outer[0][1]) if outer and len(outer) == 1 else None
    if not parts:
        return None
    tags, first = [t for t, _ in parts], parts[0][1]
    if tags[:9] == [2] * 9 and first in (b"\0", b"\1"):
        return "rsa"
    if tags == [2] * 6 and first == b"\0":
        return "dsa"
    if tags[:3] == [2, 0x30, 4] and first in (b"\0", b"\1") and (_elements(parts[1][1]) or [(0, b"")])[0][0] == 6:
        return "pkcs8"
    if tags == [0x30, 4] and (_elements(parts[0][1]) or [(0, b"")])[0][0] == 6:
        return "pkcs8-encrypted"
    if tags[:2] == [2, 4] and first == b"\1" and len(parts[1][1]) >= 16 and set(tags[2:]) <= {0xA0, 0xA1}:
        return "ec"
    return None


def _openssh_key(data: bytes) -> str | None:
    """Four-byte lengths, each followed by so many bytes: names, number of keys, public keys, private part."""
    head = b"openssh-key-v1\0"
    if not data.startswith(head):
        return None
    at, fields, want = len(head), [], 4
    while len(fields) < want:
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if len(fields) == 3:  # the number of keys; a public part for each and one private part follow
            if not 1 <= n <= 64:
                return None
            fields.append(b"")
            want = 4 + n + 1
            continue
        if at + n > len(data):
            return None
        fields.append(data[at:at + n])
        at += n
    return "openssh" if at == len(data) and fields[0] else None


def _signed_token(header: str, payload: str) -> str | None:
    """The algorithm that a signed token's header names; header and payload must be JSON objects."""
    values = []
    for part in (header, payload):
        raw = _unbase64(part)
        if raw is None or raw[:1] != b"{":
            return None
        try:
            values.append(json.loads(raw))
        except (ValueError, RecursionError):
            return None
    algorithm = values[0].get("alg")
    return algorithm if isinstance(algorithm, str) and isinstance(values[1], dict) else None


def _encoded(data: bytes | None, depth: int) -> tuple[str, str] | None:
    """Kind and proof of what the bytes hold: a key, or printable text with a secret of its own."""
    if not data:
        return None
    key = _der_key(data) or _openssh_key(data)
    if key:
        return "key", key
    if depth and len(data) >= 12 and all(32 <= b < 127 or b in (9, 10, 13) for b in data):
        text = data.decode("ascii")
        inner = _plain(text) or scan(text, depth - 1)
        if inner:
            return "encoded", inner[0][0]
    return None


def _tokens(text: str) -> Iterator[tuple[str, int, int, str]]:
    at = 0
    while m := _SIGNED.search(text, at):
        proof = _signed_token(m[1], m[2])
        if proof:
            yield "token", m.start(), m.end(), proof
        at = m.end() if proof else m.start(2)


def _framed(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Keys in PEM frames. An encrypted body shows no fields: its cipher must be named and its length fit the cipher's blocks."""
    for m in _PEM.finditer(text):
        data, cipher = _unbase64(m[2]), _CIPHER.search(m[1])
        proof = data and (_der_key(data) or _openssh_key(data))
        if data and cipher and len(data) % (len(cipher[1]) // 2) == 0:
            proof = proof or "encrypted"
        if proof:
            yield "key", m.start(), m.end(), proof


def _wrapped(text: str, depth: int) -> Iterator[tuple[str, int, int, str]]:
    """Base64 over several lines: all but the first and the last are of one length. What stands around it may look alike."""
    for m in _WRAPPED.finditer(text):
        lines, i = list(_LINE.finditer(text, m.start(), m.end())), 0
        while i + 1 < len(lines):
            j, length = i + 1, len(lines[i + 1][0])
            while j < len(lines) and len(lines[j][0]) == length:
                j += 1
            for first, end in ((i, j + 1), (i, j), (i + 1, j + 1), (i + 1, j)):
                some = lines[first:end]
                if end > len(lines) or len(some) < 2 or len(some[0][0]) < 16:
                    continue
                joined = "".join(x[0] for x in some)
                inner = _encoded(_unbase64(joined), depth)
                if not inner and len(joined) % 2 == 0 and _HEX_ANY.fullmatch(joined):
                    inner = _encoded(bytes.fromhex(joined), depth)
                if inner:
                    yield inner[0], some[0].start(), some[-1].end(), inner[1]
                    j = end
                    break
            i = j


def _plain(text: str) -> list[tuple[str, int, int, str]]:
    found = [("assign", m.start(), m.end(), "pattern") for m in ASSIGN.finditer(text)
             if m.end(1) - m.start(1) >= LEAST_VALUE]
    found += [("access", m.start(), m.end(), "pattern") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", m.start(), m.end(), "pattern") for m in HEX.finditer(text)]
    return found


def scan(text: str | None, depth: int = DEPTH) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, proof)`` of every secret of a text, by start, then kind; code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are plain patterns. Three kinds are candidates that had to be confirmed: a
    ``token`` has a JSON header that names its algorithm, a ``key`` is base64 or hex (in a PEM frame or bare, in one line or
    several) whose nested lengths and fields are those of a private key, ``encoded`` is base64 or hex of text that holds a
    secret of any kind, at most ``depth`` encodings deep. Line ends may be written as escapes. Null and empty texts have none.
    """
    if not text:
        return []
    found = _plain(text)
    # places stay as they are: an escape becomes as many characters of white space
    views = {text: 0, _ESCAPED.sub(lambda m: "\x20" * (len(m[0]) - 1) + "\n", text): 0} if "\\" in text else {text: 0}
    for view in views:
        found += _tokens(view)
    framed = [s for view in views for s in _framed(view)]
    framed += [s for view in views for s in _wrapped(view, depth) if not any(a <= s[1] and s[2] <= b for _, a, b, _ in framed)]
    found += framed
    for view in views:
        for pattern, decode in ((_BASE64, _unbase64), (_HEX_ANY, lambda s: bytes.fromhex(s) if len(s) % 2 == 0 else None)):
            for m in pattern.finditer(view):
                inner = _encoded(decode(m[0]), depth)
                if inner and not any(a <= m.start() and m.end() <= b for _, a, b, _ in framed):
                    found.append((inner[0], m.start(), m.end(), inner[1]))
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def found(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column behind its own, the spans of ``scan``, and that column's name. No shuffle."""
    name = fresh(docs, "spans")
    body = fresh(docs, "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            rows = [[dict(zip(("kind", "start", "end", "proof"), s)) for s in scan(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(rows, ARROW_SPANS)], [*batch.schema.names[:-1], name])

    given = docs.withColumn(body, F.col("text").cast("string"))
    schema = docs.withColumn(name, F.lit(None).cast(SPANS)).schema
    return given.mapInArrow(run, schema), name


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping spans become one. ``n_chars``, if there, is kept right.

    Rows without a secret stay as they are; null texts stay null. No row goes.
    """
    rows, name = found(docs)
    return cut_out(rows, name, mark).select(*docs.columns)
