"""Secret scans with structural confirmation.

Three plain patterns find assigned values, access ids and long hexadecimal runs. Longer base64 and hexadecimal runs are
candidates only: they are decoded and reported if what they hold is built like a key or a signed token, that is

* ``key``: a DER sequence whose nested lengths fill it to the last byte and which starts like a private key (a small
  version number, then at least one more element) or is an encrypted one (an algorithm with its settings, then bytes),
  bare, in hexadecimal or in PEM armour; or armour that names a cipher, whose bytes fill blocks of it;
* ``openssh``: an OpenSSH private key, with its length-prefixed cipher, derivation and key fields, likewise;
* ``jwt``: three base64url parts, the first a JSON object that names an algorithm, the second a JSON object.

Base64 may be wrapped, with line ends real or written as backslash-n, indented or as quoted strings: what is decoded of it
is as long as its own lengths say. A candidate starts where no letter or digit stands before it, but for such a line end.

Each text is worked on alone, so a scan is one pass of a map over whole texts with no shuffle.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridloom.llm._util import ready, small_batches

#: Fixed values of the plain patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run is taken whole, so a lower bound in the pattern gives what a check of its length would.
HEX = re.compile(r"[0-9a-f]{32,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "key", "openssh", "jwt")

_CHAR = r"[A-Za-z0-9+/_-]"
# A DER sequence starts with byte 0x30 and an OpenSSH key with its mark; line ends may come after the first characters.
_START = re.compile(rf"(?:M[A-P](?={_CHAR}{{14}})|b3BlbnNzaC1r(?={_CHAR}{{4}}))")
_RUN = re.compile(rf"{_CHAR}+")
_SLASH = re.compile(r"\\+/")
# A run of backslashes is taken at once, so that no place in it is tried anew.
_BREAK = re.compile(r"""(?:\\++[nrt]?|["'][ \t]*[+.][ \t]*(?=[\r\n"'\\])|["'\s,;|>*#])+""")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
# A JSON object starts with a brace, then a quote or white space: "ey" or "ew".
_TOKEN_START = re.compile(r"(?=e[yw][A-Za-z0-9_-]{8})")
# One part, with the two that must follow it looked at only.
_TOKEN = re.compile(r"[A-Za-z0-9_-]++(?=(\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+))")
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----")
_HEADER = re.compile(r"\b(Proc-Type|DEK-Info):[ \t]*([^\s\"']+)|^[ \t\"']*([A-Za-z][A-Za-z0-9-]*):(.*)$", re.M)

Span = tuple[str, int, int]


def decode64(text: str) -> bytes | None:
    """Bytes of base64 or base64url text, padded or not; None if it is neither."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of the DER element at a place; None if its length does not fit."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size > 0x80:
        width = size & 0x7F
        if width > 4 or at + width > end:
            return None
        size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if size < 0x80:
            return None
    elif size == 0x80:
        return None
    return (tag, at, at + size) if at + size <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill a stretch to its last byte, or None."""
    found = []
    while at < end:
        one = _element(data, at, end)
        if one is None:
            return None
        found.append(one)
        at = one[2]
    return found


def is_der_key(data: bytes | None) -> bool:
    """Whether bytes are a DER sequence, nested lengths and all, that starts like a private key."""
    if not data or data[0] != 0x30:
        return False
    top = _element(data, 0, len(data))
    if top is None or top[2] != len(data):
        return False
    first = _children(data, top[1], top[2])
    if not first or len(first) < 2:
        return False
    tag, at, end = first[0]
    if tag == 0x30:
        # Encrypted: the algorithm and its settings, then the bytes. A digest has no settings, a public key a bit string.
        kind = _children(data, at, end)
        if not kind or [t for t, _, _ in kind] != [0x06, 0x30] or [t for t, _, _ in first] != [0x30, 0x04]:
            return False
    elif tag != 0x02 or end - at != 1 or data[at] > 3:
        return False
    left = list(first)
    while left:
        tag, at, end = left.pop()
        if tag & 0x20:
            inner = _children(data, at, end)
            if inner is None:
                return False
            left += inner
        elif tag == 0x02 and at == end:
            return False
    return True


def is_openssh_key(data: bytes | None) -> bool:
    """Whether bytes are an OpenSSH private key: the mark, three fields, a key count, and the keys' fields."""
    mark = b"openssh-key-v1\x00"
    if not data or not data.startswith(mark):
        return False
    at = len(mark)

    def field(at: int) -> int | None:
        if at + 4 > len(data):
            return None
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return end if end <= len(data) else None

    for _ in range(3):
        at = field(at)
        if at is None:
            return False
    count = int.from_bytes(data[at : at + 4], "big") if at + 4 <= len(data) else 0
    at += 4
    # Each key's field takes four bytes at least, so more than fit are refused before they are counted through.
    if not 1 <= count <= len(data) // 4:
        return False
    for _ in range(count + 1):
        at = field(at)
        if at is None:
            return False
    return at == len(data)


class Base64:
    """The base64 of a text as one string, cut over line ends, with where each stretch of it stands in the text.

    Read once for all candidates, so that one that starts anywhere costs what is looked at of it.
    """

    def __init__(self, text: str):
        self._text = text
        # Of each stretch: where it starts in the text and in the base64, and what of the base64 it goes on to without a
        # break (a run) and over breaks (a chain); whether a run holds an escaped slash.
        self._at, self._clean, self._run, self._chain, self._escaped = [], [], [], [], []
        parts, size = [], 0
        start = _RUN.search(text)
        while start:
            at, first, chain = start.start(), len(self._at), True
            while chain:
                run, escaped = len(self._at), False
                while True:
                    one = _RUN.match(text, at)
                    slash = None if one else _SLASH.match(text, at)
                    if not one and not slash:
                        break
                    found = one[0] if one else "/"
                    self._at.append(at)
                    self._clean.append(size)
                    parts.append(found)
                    size, at, escaped = size + len(found), (one or slash).end(), escaped or not one
                count = len(self._at) - run
                self._run += [size] * count
                self._escaped += [escaped] * count
                gap = _BREAK.match(text, at) if count else None
                chain = gap is not None
                last, at = at, gap.end() if gap else at
            self._chain += [size] * (len(self._at) - first)
            start = _RUN.search(text, max(at, last))
        self.data = "".join(parts)

    def place(self, at: int) -> tuple[int, int]:
        """Where the base64 at a place of the text starts, and where its chain ends."""
        k = bisect_right(self._at, at) - 1
        return self._clean[k] + at - self._at[k], self._chain[k]

    def read(self, start: int, end: int, at: int, size: int) -> bytes | None:
        """So many bytes from an offset on of what starts at a place; None if the chain ends before."""
        first = start + at // 3 * 4
        last = first - (-4 * (at % 3 + size) // 3)
        data = decode64(self.data[first:last]) if last <= end else None
        return data[at % 3 : at % 3 + size] if data else None

    def end_of(self, start: int, need: int) -> int | None:
        """Where in the text so many characters end that must not go on; None if they do."""
        end = start + need
        k = bisect_right(self._clean, end - 1) - 1
        if end == self._run[k]:
            while k + 1 < len(self._clean) and self._clean[k + 1] < end:
                k += 1
            place = self._at[k] + (end - self._clean[k]) if self._text[self._at[k]] != "\\" else _SLASH.match(self._text, self._at[k]).end()
            last = place
            while last < len(self._text) and self._text[last] == "=" and last < place + 2:
                last += 1
            return last
        # A "-" or "_" after standard base64 is not part of it.
        if self.data[end] not in "-_" or self._escaped[k]:
            return None
        if self.data.find("-", start, end) >= 0 or self.data.find("_", start, end) >= 0:
            return None
        return self._at[k] + (end - self._clean[k])


def _header(stream: Base64, start: int, end: int, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the contents of the DER element at an offset, its length read but not what it holds."""
    head = stream.read(start, end, at, 2)
    if head is None:
        return None
    width = head[1] & 0x7F if head[1] > 0x80 else 0
    if head[1] == 0x80 or width > 4:
        return None
    size = head[1]
    if width:
        more = stream.read(start, end, at + 2, width)
        if more is None:
            return None
        size = int.from_bytes(more, "big")
    return head[0], at + 2 + width, at + 2 + width + size


def _key_at(stream: Base64, text: str, at: int) -> tuple[str, int] | None:
    """Kind and end of a key that starts at a place in base64, as long as its own lengths say.

    Lengths are followed one by one and refused at the first that does not fit; only what passes is decoded.
    """
    start, end = stream.place(at)
    if text[at] == "b":
        kind, check, size = "openssh", is_openssh_key, len(b"openssh-key-v1\x00")
        fields, counted = 3, False
        while fields:
            length = stream.read(start, end, size, 4)
            if length is None:
                return None
            size += 4 + int.from_bytes(length, "big")
            fields -= 1
            if not fields and not counted:
                number = stream.read(start, end, size, 4)
                size, fields, counted = size + 4, int.from_bytes(number or b"", "big") + 1, True
                if fields < 2:
                    return None
    else:
        kind, check, top = "key", is_der_key, _header(stream, start, end, 0)
        if top is None or top[0] != 0x30 or start - (-4 * top[2] // 3) > end:
            return None
        size, inner = top[2], top[1]
        while inner < size:
            one = _header(stream, start, end, inner)
            if one is None or one[2] > size or inner == top[1] and one[0] not in (0x02, 0x30):
                return None
            inner = one[2]
    need = -(-size * 4 // 3)
    if need < 32 or start + need > end:
        return None
    last = stream.end_of(start, need)
    return (kind, last) if last is not None and check(decode64(stream.data[start : start + need])) else None


def _armoured(body: str) -> str | None:
    """Kind of the key that stands between the marks of armour, with or without header lines."""
    body = re.sub(r"(?<!\\)\\+[nr]", "\n", body).replace("\\t", " ")
    headers = {}

    def note(m) -> str:
        headers[m[1] or m[3]] = m[2] or m[4]
        return "\n"

    if ":" in body:
        body = _HEADER.sub(note, body)
    # Between base64 stand line ends, the quotes and joins of string literals, and the marks of quoted or commented lines.
    data = decode64(_BREAK.sub("", body.replace("\\/", "/")))
    if is_openssh_key(data):
        return "openssh"
    if is_der_key(data):
        return "key"
    start = re.fullmatch(r"[A-Z0-9-]+,((?:[0-9A-Fa-f]{16}){1,2})", headers.get("DEK-Info", "").strip(), re.I)
    if data and start and "ENCRYPTED" in headers.get("Proc-Type", "") and len(data) >= 32 and len(data) % (len(start[1]) // 2) == 0:
        return "key"
    return None


def _may_start(text: str, at: int, glue: str) -> bool:
    """Whether no letter or digit stands before a place, nor one of the given marks, but for a written line end."""
    before = text[at - 1 : at]
    if not (before.isascii() and before.isalnum() or before and before in glue):
        return True
    return before in "nrt" and text[at - 2 : at - 1] == "\\"


def _starts_object(text: str, at: int, end: int) -> bool:
    """Whether base64 may hold a JSON object, by beginnings of twice the length each time until one shows that it does not."""
    size = 96
    while size < end - at:
        try:
            json.loads((decode64(text[at : at + size]) or b"").decode("utf-8", "ignore"))
        except json.JSONDecodeError as e:
            if e.pos < size * 3 // 4 - 16 and not e.msg.startswith(("Unterminated string", "Invalid \\")):
                return False
        except RecursionError:
            return False
        size *= 2
    return True


def is_signed_token(text: str) -> bool:
    """Whether text is header.payload.signature with a JSON header that names an algorithm and a JSON payload."""
    parts = text.split(".")
    if len(parts) != 3:
        return False
    try:
        header, payload = (json.loads(decode64(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict)


def base_spans(text: str) -> list[Span]:
    """Spans of the plain patterns, by start and then kind."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=_place)


def structural_spans(text: str) -> list[Span]:
    """Spans of candidates that decode to a key or a signed token."""
    found = []
    if "-----BEGIN " in text:
        for m in _ARMOUR.finditer(text):
            end, last = text.find("-----", m.end()), f"-----END {m[1]}-----"
            kind = _armoured(text[m.end() : end]) if end >= 0 and text.startswith(last, end) else None
            if kind:
                found.append((kind, m.start(), end + len(last)))
    armoured, inside, at, stream = list(found), 0, 0, None
    for m in _START.finditer(text):
        start = m.start()
        while inside < len(armoured) and armoured[inside][2] <= start:
            inside += 1
        if start < at or inside < len(armoured) and armoured[inside][1] <= start or not _may_start(text, start, "+"):
            continue
        stream = stream or Base64(text)
        key = _key_at(stream, text, start)
        if key:
            found.append((key[0], start, key[1]))
            at = key[1]
    for m in _HEX_RUN.finditer(text):
        if len(m[0]) % 2 == 0 and m[0].startswith("30") and is_der_key(bytes.fromhex(m[0])):
            found.append(("key", *m.span()))
        elif len(m[0]) % 2 == 0 and m[0].startswith("6f") | m[0].startswith("6F") and is_openssh_key(bytes.fromhex(m[0])):
            found.append(("openssh", *m.span()))
    if ("ey" in text or "ew" in text) and "." in text:
        at = 0
        for part in _TOKEN.finditer(text):
            # The leftmost start in a part from which it and the next two are a token.
            for m in _TOKEN_START.finditer(text, max(at, part.start()), part.end()):
                start = m.start()
                if _may_start(text, start, "") and _starts_object(text, start, part.end()) and is_signed_token(text[start : part.end(1)]):
                    found.append(("jwt", start, part.end(1)))
                    at = part.end(1)
                    break
    return found


def _place(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def find_secrets(text: str | None) -> list[Span]:
    """All spans (kind, start, end) of a text in code points, end exclusive, by start and then kind as listed."""
    text = text or ""
    return sorted(base_spans(text) + structural_spans(text), key=_place)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each stretch that any span covers replaced by a mark; null stays null."""
    if not text:
        return text
    out, at = [], 0
    for start, end in sorted((a, b) for _, a, b in find_secrets(text)):
        # A span that starts within the stretch before only makes that longer; spans that touch stay apart.
        if start >= at or not out:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, counts of the plain kinds, SHA-256 of the plain spans, and all spans.

    A null or empty text has no span (the digest is that of nothing, ``spans`` is empty). Ids may be null or repeated:
    each row is scanned by itself. A very long text is read whole; a candidate costs what is looked at before its lengths
    do not fit. Other columns are not read; an empty table gives no rows.
    """
    ready(docs)
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches):
        for batch in small_batches(batches, "text"):
            base, every = [], []
            for text in batch.column("text"):
                spans = find_secrets(text.as_py())
                base.append([s for s in spans if s[0] in BASE_KINDS])
                every.append(_joined(spans))
            count = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in BASE_KINDS]
            digest = pa.array([hashlib.sha256(_joined(x).encode()).hexdigest() for x in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *count, digest, pa.array(every, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    id_type = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with the secrets in the text column marked out.

    A null text stays null, an empty one empty; a very long one is read whole. Rows that repeat stay as often as they
    stand, ids are not looked at, and an empty table gives no rows.
    """
    ready(docs)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in small_batches(batches, at):
            texts = pa.array([redact(x.as_py(), mark) for x in batch.column(at)], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
