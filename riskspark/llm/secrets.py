"""Secret scans by structural confirmation.

Base patterns find assignments, access ids and hex runs. The method then decodes base64 and hex candidates and
reports those whose bytes parse: DER private keys, encrypted ones included (nested tag lengths must fit exactly),
OpenSSH key files (length-prefixed fields), PEM bodies that decode to either or are encrypted as their header lines
say, and signed tokens whose header is a JSON object naming an algorithm. What decodes is decoded again, so a key in
base64 inside hex is found. A key may start inside a run of base64 or hex digits, after a separator or at any digit,
and base64 may be wrapped over lines, with real or escaped line ends: the length that the key itself declares must
end where a line or the run ends.

Offsets are code points, end exclusive. A null text counts as empty; an empty text, an empty table, ties and
repeated rows give empty arrays or equal rows. Extra columns of the input are ignored.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from riskspark.llm.base import map_rows

KINDS = ("assign", "access", "hex", "der", "openssh", "pem", "jwt")
BASE_KINDS = KINDS[:3]
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,detail:string>>"

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{32,}")
_HEX_SEQUENCE = re.compile(r"(?=30)")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
_RUN = re.compile(r"([A-Za-z0-9+/_-]+)={0,2}")
_LINE_END = re.compile(r"[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*")
_KEY_START = re.compile(r"(?<![A-Za-z0-9])(?:M[A-P](?=[A-Za-z0-9+/_-]{10})|b3BlbnNzaC1rZXktdjEA)")
_FRAME = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_ESCAPE = re.compile(r"\\[rnt]")
_HEADER = re.compile(r"^([A-Za-z0-9-]+):[ \t]*(.*(?:\n[ \t].*)*)$", re.M)
_CIPHER = re.compile(r"[A-Z0-9-]+,[ \t\n]*[0-9A-Fa-f]{16,}")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*)?")
_INTEGER, _OCTETS, _OBJECT, _SEQUENCE = 0x02, 0x04, 0x06, 0x30
_OPENSSH = b"openssh-key-v1\0"
# Object identifiers of password-based encryption, PKCS 5 and PKCS 12.
_ENCRYPTIONS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the DER element at ``at``; null unless it ends by ``end``."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length & 0x80:
        size = length & 0x7F
        if not 1 <= size <= 4 or at + size > end or data[at] == 0:
            return None
        length = int.from_bytes(data[at : at + size], "big")
        at += size
        if length < 0x80:
            return None
    return (tag, at, at + length) if at + length <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    found = []
    while at < end:
        element = _element(data, at, end)
        if element is None:
            return None
        found.append(element)
        at = element[2]
    return found


def der_private_key(data: bytes) -> str | None:
    """``rsa``, ``pkcs8``, ``pkcs8-encrypted`` or ``ec`` when the bytes are exactly one such private key, else null."""
    top = _element(data, 0, len(data))
    if top is None or top[0] != _SEQUENCE or top[2] != len(data):
        return None
    parts = _children(data, top[1], top[2])
    if not parts or len(parts) < 2:
        return None
    tags = [tag for tag, _, _ in parts]
    if tags == [_SEQUENCE, _OCTETS]:
        named = _children(data, parts[0][1], parts[0][2])
        named = data[named[0][1] : named[0][2]] if named and named[0][0] == _OBJECT else b""
        return "pkcs8-encrypted" if named.startswith(_ENCRYPTIONS) and parts[1][2] - parts[1][1] >= 32 else None
    if tags[0] != _INTEGER or parts[0][2] - parts[0][1] != 1:
        return None
    version = data[parts[0][1]]
    if len(parts) >= 9 and version in (0, 1) and all(t == _INTEGER for t in tags[:9]):
        return "rsa"
    if len(parts) >= 3 and version in (0, 1) and tags[1:3] == [_SEQUENCE, _OCTETS]:
        named = _children(data, parts[1][1], parts[1][2])
        return "pkcs8" if named and named[0][0] == _OBJECT else None
    if version == 1 and tags[1] == _OCTETS and parts[1][2] - parts[1][1] >= 16:
        return "ec"
    return None


def openssh_private_key(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    at = len(_OPENSSH)
    for _ in range(3):  # cipher, key derivation, its options
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data) and int.from_bytes(data[at : at + 4], "big") >= 1


def _openssh_size(digits: str, at: int) -> int | None:
    """Bytes of the key file whose base64 starts at ``at``: header fields, public keys, private part; null if cut off.

    Only the length fields are decoded, so that many starts in one long text stay cheap.
    """

    def number(offset: int) -> int | None:
        first = at + offset // 3 * 4
        data = _from_base64(digits[first : first + 8]) or b""
        field = data[offset % 3 : offset % 3 + 4]
        return int.from_bytes(field, "big") if len(field) == 4 else None

    offset, left, counted = len(_OPENSSH), 3, False
    while left or not counted:
        value = number(offset)
        if value is None:
            return None
        if left:
            offset, left = offset + 4 + value, left - 1
        else:
            offset, left, counted = offset + 4, value + 1, True
    return offset


def _from_base64(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _key(data: bytes) -> tuple[str, str] | None:
    key = der_private_key(data)
    if key:
        return "der", key
    return ("openssh", "openssh-key-v1") if openssh_private_key(data) else None


def _structure(data: bytes) -> tuple[str, str] | None:
    """Kind and detail of a key, decoded as often as it takes; each decoding shortens the data by a quarter or more."""
    if (hit := _key(data)) or not data.isascii():
        return hit
    text = data.decode("ascii").strip()
    if _HEX_ANY.fullmatch(text) and len(text) % 2 == 0:
        return _structure(bytes.fromhex(text))
    inner = _from_base64(text) if _BASE64.fullmatch(text) else None
    return _structure(inner) if inner else None


def _declared(head: bytes) -> int | None:
    """Bytes of the DER element that starts with ``head``, its tag and length included."""
    if len(head) < 2 or head[0] != _SEQUENCE:
        return None
    size = head[1] & 0x7F if head[1] & 0x80 else 0
    if size > 4 or 2 + size > len(head) or head[1] == 0x80:
        return None
    return 2 + size + (int.from_bytes(head[2 : 2 + size], "big") if size else head[1])


class _Block:
    """Base64 digits from ``start`` on over line ends: the digits joined, and where each line ends in them."""

    def __init__(self, text: str, start: int):
        self.start, parts, at = start, [], start
        self.ends: dict[int, int] = {}  # digits up to a line's end -> offset behind it, padding included
        self.lines: list[tuple[int, int]] = []  # (offset, digits before it)
        n = 0
        while run := _RUN.match(text, at):
            self.lines.append((at, n))
            parts.append(run[1])
            n, at = n + len(run[1]), run.end()
            self.ends[n] = at
            gap = _LINE_END.match(text, at) if run.end(1) == at else None
            if gap is None:
                break
            at = gap.end()
        self.digits, self.end = "".join(parts), max(self.ends.values(), default=start)

    def place(self, offset: int) -> int:
        line = self.lines[bisect.bisect_right(self.lines, (offset, len(self.digits))) - 1]
        return line[1] + offset - line[0]


def _base64_keys(text: str) -> Iterator[tuple]:
    """Keys by their declared length, from any start after a separator to a line's end."""
    block = None
    for m in _KEY_START.finditer(text):
        if block is None or m.start() >= block.end:
            block = _Block(text, m.start())
        at = block.place(m.start())
        if m.group()[0] == "M":
            size = _declared(_from_base64(block.digits[at : at + 8]) or b"")
        else:
            size = _openssh_size(block.digits, at)
        until = at + (size * 8 + 5) // 6 if size else -1
        if until in block.ends and (hit := _key(_from_base64(block.digits[at:until]) or b"")):
            yield hit[0], m.start(), block.ends[until], False, hit[1]


def _hex_keys(text: str) -> Iterator[tuple]:
    """Whole runs in both alignments, then keys that start at any digit and end with the run, a last digit left over."""
    for m in _HEX_ANY.finditer(text):
        run, found = m.group(), False
        odd = len(run) % 2
        for part in {run[: len(run) - odd], run[odd:]}:
            if hit := _structure(bytes.fromhex(part)):
                found = True
                yield hit[0], *m.span(), False, hit[1]
        for start in () if found else _HEX_SEQUENCE.finditer(run):
            at = start.start()
            head = run[at : at + 12]
            size = _declared(bytes.fromhex(head[: len(head) - len(head) % 2]))
            if size and len(run) - at - 2 * size in (0, 1):
                if key := der_private_key(bytes.fromhex(run[at : at + 2 * size])):
                    yield "der", m.start() + at, m.start() + at + 2 * size, False, key


def _pem_keys(text: str) -> Iterator[tuple]:
    begin = None
    for m in _FRAME.finditer(text):
        if m[1] == "END" and begin and begin[2] == m[2]:
            body = text[begin.end() : m.start()].replace("\\/", "/")
            body = _ESCAPE.sub("\n", body).replace("\r", "\n")
            headers = {name: value for name, value in _HEADER.findall(body)}
            data = _from_base64("".join(_HEADER.sub("", body).split())) or b""
            hit = _key(data)
            if hit:
                yield "pem", begin.start(), m.end(), False, hit[1]
            elif "ENCRYPTED" in headers.get("Proc-Type", "") and len(data) >= 32 and len(data) % 8 == 0:
                if _CIPHER.fullmatch(headers.get("DEK-Info", "").strip()):
                    yield "pem", begin.start(), m.end(), False, "encrypted"
        begin = m if m[1] == "BEGIN" else None


def _jwt_algorithm(token: str) -> str | None:
    raw = _from_base64(token.split(".", 1)[0])
    try:
        header = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return str(header["alg"])[:32] if isinstance(header, dict) and isinstance(header.get("alg"), str) else None


def spans_of(text: str | None) -> list[tuple[str, int, int, bool, str]]:
    """All spans of one text by start, then kind as listed in ``KINDS``."""
    text = text or ""
    found: list[tuple[str, int, int, bool, str]] = []
    lowered = text.lower()
    if any(w in lowered for w in _ASSIGN_WORDS):
        found += [("assign", *m.span(), True, "") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span(), True, "") for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span(), True, "") for m in _HEX.finditer(text)]
    found += _hex_keys(text)
    for m in _BASE64.finditer(text):
        data = _from_base64(m.group())
        if data and (hit := _structure(data)):
            found.append((hit[0], *m.span(), False, hit[1]))
    found += _base64_keys(text)
    if "-----BEGIN " in text:
        found += _pem_keys(text)
    if "eyJ" in text:
        for m in _JWT.finditer(text):
            if algorithm := _jwt_algorithm(m.group()):
                found.append(("jwt", *m.span(), False, algorithm))
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str, spans: list[tuple], mark: str) -> str:
    """The text with each maximal run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, end in sorted((s[1], s[2]) for s in spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): every secret of every whole text."""
    kind = dict(docs.dtypes)[id_col]

    def row(doc_id, text) -> Iterator[tuple]:
        names = ("kind", "start", "end", "base", "detail")
        yield doc_id, [dict(zip(names, s)) for s in spans_of(text)]

    return map_rows(docs.select(id_col, F.col(text_col).cast("string")), f"`{id_col}` {kind}, spans {SPANS}", row)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with assigned, access and structurally confirmed secrets replaced; bare hex runs stay.

    Every row is kept, all other columns are as they were, and a null text stays null.
    """
    names = docs.columns

    def row(*values) -> Iterator[tuple]:
        at = names.index(text_col)
        text = values[at]
        if text is not None:
            spans = [s for s in spans_of(text) if s[0] != "hex"]
            text = redacted(text, spans, mark) if spans else text
        yield *values[:at], text, *values[at + 1 :]

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return map_rows(docs, schema, row)
