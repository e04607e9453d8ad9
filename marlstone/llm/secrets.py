"""Secret scans: patterns find candidates, and what decodes and parses as a key or a signed token is reported too.

Base spans (assign, access, hex) come from fixed patterns. The structural spans are candidates whose decoded
bytes parse: `jwt` is three base64url parts of which the first is a JSON object with an "alg" and the second a JSON
object; `pem` is an armoured private key; `der` is a base64 run and `derhex` a hex run that hold a private key in DER,
plain or encrypted, i.e. a SEQUENCE whose nested lengths fill the bytes exactly and whose items are those of such a key;
`sshkey` is a base64 run of an OpenSSH private key or of a private wire key, whose length-prefixed fields fill the bytes
exactly; `pubkey` is a run that parses as a public key in DER or in the wire form. Base64 may be wrapped into lines of
equal length. Public keys are reported, but no secrets: redaction leaves them.

Defined results: a null text is empty and has no spans; spans are code points, end exclusive; repeated rows give
repeated results; an empty table gives no rows. Texts are scanned whole.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marlstone.llm.common import id_text, record, table, texts_of

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run begins where no hex digit stands before it.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Runs of the base64 alphabets that could hold a key or a token; line breaks inside armour are handled apart.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
HEXRUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
#: Such runs broken into lines, indented or not.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{32,}(?:(?:\r?\n[ \t]*|(?:\\r)?\\n)[A-Za-z0-9+/]+)+={0,2}")
#: "{" begins with e and one of w-z, a digit or a sign in base64.
JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]+)\.(e[w-z0-9_-][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:\s|\\[nr])*Proc-Type: 4,ENCRYPTED(?:\s|\\[nr])+DEK-Info: [A-Z0-9-]+,[0-9A-Fa-f]+)?((?:[A-Za-z0-9+/=\s]|\\[nr])*)-----END \1-----")
#: Line ends in armour, those written with a backslash too (keys inside JSON).
LINE_END = re.compile(r"\s|\\[nr]")
LINE_BREAK = re.compile(r"\r?\n[ \t]*|(?:\\r)?\\n")
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "derhex", "sshkey", "pubkey")
#: Reported, but no secrets.
OPEN_KINDS = ("pubkey",)
ORDER = {k: i for i, k in enumerate(KINDS)}
#: Fields of a public key of each kind in the wire form, its name included.
SSH_FIELDS = {b"ssh-rsa": 3, b"ssh-dss": 5, b"ssh-ed25519": 2, b"ecdsa-sha2-nistp256": 3, b"ecdsa-sha2-nistp384": 3, b"ecdsa-sha2-nistp521": 3}
OPENSSH = b"openssh-key-v1\0"
#: Object identifiers of encryption by password (PKCS 5 and PKCS 12) begin so.
BY_PASSWORD = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))

Span = tuple[str, int, int]


def b64(run: str) -> bytes | None:
    """The bytes of a base64 run of either alphabet, or None."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, first and last offset of the content of the DER item at `at`, if its length is minimal and fits."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end or not data[at]:
            return None
        n = int.from_bytes(data[at : at + k], "big")
        if n < 0x80:
            return None
        at += k
    return (tag, at, at + n) if at + n <= end else None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The items that fill data[at:end] exactly."""
    found = []
    while at < end:
        if not (item := der_item(data, at, end)):
            return None
        found.append(item)
        at = item[2]
    return found


def der_key(data: bytes) -> str | None:
    """`der` or `pubkey` if data is one SEQUENCE that holds a private or a public key, all lengths exact.

    Private: a version and the 8 or 5 numbers of an RSA or DSA key; version 1 and an OCTET STRING (EC); a version, an
    algorithm and an OCTET STRING (PKCS 8); an algorithm of encryption by password and an OCTET STRING. Public: an
    algorithm and a BIT STRING; a modulus and a short exponent."""
    top = der_item(data, 0, len(data))
    if not top or top[0] != 0x30 or top[2] != len(data) or not (items := der_items(data, top[1], top[2])) or len(items) < 2:
        return None
    tags = bytes(t for t, _, _ in items)
    content = [data[a:b] for _, a, b in items]

    def algorithm(i: int) -> bytes:
        inner = der_items(data, *items[i][1:])
        return data[inner[0][1] : inner[0][2]] if inner and inner[0][0] == 0x06 else b""

    if content[0] in (b"\0", b"\1") and tags[0] == 0x02:
        if tags[1:2] == b"\x30":
            return "der" if tags[2:3] == b"\x04" and algorithm(1) else None
        if tags[1:2] == b"\x04":
            return "der" if content[0] == b"\1" and set(tags[2:]) <= {0xA0, 0xA1} else None
        return "der" if tags in (b"\2" * 9, b"\2" * 6, b"\2" * 9 + b"\x30") else None
    if tags == b"\2\2":
        return "pubkey" if len(content[0]) >= 64 and len(content[1]) <= 8 else None
    if tags == b"\x30\3":
        return "pubkey" if algorithm(0) else None
    return "der" if tags == b"\x30\4" and algorithm(0).startswith(BY_PASSWORD) else None


def wire_fields(data: bytes) -> list[bytes] | None:
    """The length-prefixed fields that fill data exactly."""
    at, fields = 0, []
    while at < len(data):
        if at + 4 > len(data) or (n := int.from_bytes(data[at : at + 4], "big")) > len(data) - at - 4:
            return None
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return fields


def is_openssh(data: bytes) -> bool:
    """An OpenSSH private key: cipher, derivation and its options, the number of keys, as many public keys, and what is
    private, which begins with two equal numbers unless it is encrypted."""
    at, head = len(OPENSSH), []
    for _ in range(3):
        n = int.from_bytes(data[at : at + 4], "big")
        head.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    keys = int.from_bytes(data[at : at + 4], "big")
    if at + 4 > len(data) or not head[0] or not head[1]:
        return False
    fields = wire_fields(data[at + 4 :])
    if not fields or not keys or len(fields) != keys + 1 or any(ssh_key(k) != "pubkey" for k in fields[:-1]):
        return False
    private = fields[-1]
    return len(private) >= 8 and (head[0] != b"none" or private[:4] == private[4:8])


def ssh_key(data: bytes) -> str | None:
    """`sshkey` or `pubkey` for a private or a public key of OpenSSH or of the wire form, whose fields fill it."""
    if data.startswith(OPENSSH):
        return "sshkey" if is_openssh(data) else None
    if data[:1] != b"\0" or not (fields := wire_fields(data)) or not (n := SSH_FIELDS.get(fields[0])) or len(fields) < n or not all(fields[:n]):
        return None
    return "pubkey" if len(fields) == n else "sshkey"


def key_in(run: str) -> str | None:
    """The kind of key that a base64 run holds."""
    data = b64(run)
    if not data or len(data) < 24:
        return None
    return der_key(data) if data[0] == 0x30 else ssh_key(data)


def wrapped_key(match: re.Match[str]) -> Span | None:
    """The key in lines of equal length and perhaps a shorter last one; what follows them is no part of it."""
    lines, at = [], match.start()
    for m in LINE_BREAK.finditer(match[0]):
        lines.append((at, match.start() + m.start()))
        at = match.start() + m.end()
    lines.append((at, match.end()))
    width = lines[0][1] - lines[0][0]
    full = next((i for i, (a, b) in enumerate(lines) if b - a != width), len(lines))
    for n in (full + 1, full):
        if 2 <= n <= len(lines) and lines[n - 1][1] - lines[n - 1][0] <= width and (kind := key_in("".join(match.string[a:b] for a, b in lines[:n]))):
            return kind, match.start(), lines[n - 1][1]
    return None


def is_json_object(part: str, key: str | None = None) -> bool:
    data = b64(part)
    if not data:
        return False
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and (key is None or key in value)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns: leftmost and non-overlapping for each kind, failing matches dropped after."""
    found: list[Span] = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(w in low for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def structural_spans(text: str) -> list[Span]:
    """Candidates that decode and parse."""
    found: list[Span] = []
    found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_json_object(m[1], "alg") and is_json_object(m[2])]
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            data = b64(LINE_END.sub("", m[3]))
            if data and (len(data) % 8 == 0 if m[2] else der_key(data) == "der" or ssh_key(data) == "sshkey"):
                found.append(("pem", *m.span()))
    for m in RUN.finditer(text):
        if kind := key_in(m[0]):
            found.append((kind, *m.span()))
    for m in WRAPPED.finditer(text):
        if span := wrapped_key(m):
            found.append(span)
    for m in HEXRUN.finditer(text):
        if m[0][:2] == "30" and (kind := der_key(bytes.fromhex(m[0]))):
            found.append(("derhex" if kind == "der" else kind, *m.span()))
    return found


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each by start, then by kind as KINDS lists them."""
    rank = lambda s: (s[1], ORDER[s[0]], s[2])
    base = sorted(base_spans(text or ""), key=rank)
    return base, sorted(base + structural_spans(text or ""), key=rank)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row a document: counts and digest of the base spans, and all spans. A narrow map; nothing is shuffled."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts_of(batch):
                base, spans = find_spans(text)
                kinds = [k for k, _, _ in base]
                rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans)))
            if rows:
                yield record(FOUND, [batch.column(0), *map(list, zip(*rows, strict=True))])

    return id_text(docs).mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long")


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every reported span but public keys replaced by `mark` (overlapping spans by one) and n_chars counted
    anew; every other column stays. Texts without spans, null ones included, stay as they are."""
    schema = docs.schema

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                out, done = [], 0
                for kind, a, b in find_spans(text)[1]:
                    if kind in OPEN_KINDS:
                        continue
                    if a >= done:
                        out += [text[done:a], mark]
                    done = max(done, b)
                texts.append(text if not out else "".join(out) + text[done:])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if (n := batch.schema.get_field_index("n_chars")) >= 0:
                columns[n] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(redact, schema)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("n_spans")


QUERIES = {"op9_secret_scans": op9_secret_scans}
