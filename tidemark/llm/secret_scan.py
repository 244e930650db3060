"""Secret scans with structural confirmation.

Three plain patterns give the base spans. Candidates for encoded secrets (runs of base64, base64url or hex digits, dotted
tokens) are decoded and reported only if their content has the structure of a secret: a DER key whose nested lengths fit, an
OpenSSH key whose fields fit, or a signed token whose header names an algorithm. Runs go on over real and escaped line ends,
with indentation, quote marks and the like around them; tokens and PEM texts are also found in one more coat of base64 or hex.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

#: The base kinds in the order in which spans with one start are listed, then the confirmed kinds.
KINDS = ("assign", "access", "hex", "key_der", "key_hex", "signed_token", "key_openssh")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
VALUE_CHARS, ACCESS_CHARS = 6, 20
#: Digits of a run by base64 (either alphabet) or hex, and what may lie between two lines of one.
DIGITS = {64: re.compile(r"[A-Za-z0-9+/_-]++"), 16: re.compile(r"[0-9A-Fa-f]++")}
JOINT = re.compile(r"""[\x20\t\r"',;]*+(?:\+[\x20\t\r]*+)?+\n(?:[\x20\t\r\n"',;>|*\#]|\+(?=[\x20\t\r]*+\n))*+""")
#: The end of a PEM text after its key.
PEM_END = re.compile(r"\s*+(?:-----END[A-Z0-9\x20]++-----\s?)?")
ESCAPED, MARK = re.compile(r"(?<!\\)\\++[nrt]"), re.compile(r"-----[A-Z0-9\x20]++-----")
#: No key or algorithm has more items than this at one level.
MOST_PARTS = 16
#: How a DER sequence (0x30), an OpenSSH key, a signed token and a PEM mark begin in base64 and in hex.
MAGIC = b"openssh-key-v1\0"
START = {
    64: re.compile(r"(?<![A-Za-z0-9+/])(?:(M)[A-Za-z0-9+/_-]{7}|b3BlbnNzaC1rZXktdjE(?=A)|ZXlK|LS0tLS1C)"),
    16: re.compile(r"(?<![0-9A-Fa-f])(?:(30)[0-9A-Fa-f]{10}|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd]763100|65794[Aa]|2[Dd]2[Dd]2[Dd]2[Dd]2[Dd]42)"),
}
SIGNED = re.compile(r"(eyJ[A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+)")
#: What may not stand before a candidate: it would be the middle of a longer run.
BEFORE_SIGNED = re.compile("[A-Za-z0-9_.-]")


def _runs(chars: bytes, n: int) -> tuple[bytes, bytes]:
    """A table that maps chars to one byte and all else to another, and a run of n of the first."""
    return bytes(1 if b in chars else 0 for b in range(256)), b"\1" * n


#: A text without such a run can hold no match; the test is a byte translation and a search, far cheaper than a pattern.
HEX_TEST = _runs(b"0123456789abcdef", 24)
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _has(raw: bytes, test: tuple[bytes, bytes]) -> bool:
    return test[1] in raw.translate(test[0])


def der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the content of the DER item at `at`; None unless its length fits before `end`."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
    return (tag, at, at + n) if at + n <= end else None


def der_items(data: bytes, at: int, end: int, most: int) -> list[tuple[int, int, int]] | None:
    """The items that fill at..end exactly; None if they don't or are more than `most`."""
    out = []
    while at < end:
        item = der_item(data, at, end)
        if item is None or len(out) == most:
            return None
        out.append(item)
        at = item[2]
    return out


def is_key(data: bytes, at: int = 0, end: int | None = None) -> int | None:
    """Where a private key that begins at `at` ends; None unless a DER sequence there has the shape of one: RSA (nine integers,
    perhaps with further primes) or DSA (six), an EC key, or an algorithm with a wrapped key."""
    top = der_item(data, at, len(data) if end is None else end)
    if top is None or top[0] != 0x30:
        return None
    parts = der_items(data, top[1], top[2], MOST_PARTS)
    if not parts:
        return None
    tags = [p[0] for p in parts]

    def algorithm(part: tuple[int, int, int]) -> bool:
        inner = der_items(data, part[1], part[2], MOST_PARTS)
        return bool(inner) and inner[0][0] == 0x06

    fits = False
    if tags[0] == 0x02 and parts[0][2] - parts[0][1] == 1:  # the version
        fits = tags in ([0x02] * 6, [0x02] * 9, [0x02] * 9 + [0x30])
        if tags[1:2] == [0x04]:
            fits = parts[1][2] - parts[1][1] >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
        elif tags[1:3] == [0x30, 0x04]:
            fits = algorithm(parts[1])
    elif tags == [0x30, 0x04]:  # an encrypted key
        fits = algorithm(parts[0])
    return top[2] if fits else None


def is_signed_token(header: str) -> bool:
    """The first part of a signed token: base64url of a JSON object that names its algorithm."""
    try:
        found = json.loads(base64.urlsafe_b64decode(header + "=" * (-len(header) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(found, dict) and isinstance(found.get("alg"), str)


def openssh_end(data: bytes, at: int = 0, end: int | None = None) -> int | None:
    """Where an OpenSSH private key that begins at `at` ends: names of cipher and derivation, options, public keys and the private
    part, each after its length. None unless all lengths fit."""
    end = len(data) if end is None else end
    if not data.startswith(MAGIC, at):
        return None
    fields: list[tuple[int, int]] = []

    def field(at: int) -> int | None:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > end:
            return None
        fields.append((at + 4, at + 4 + size))
        return at + 4 + size

    at += len(MAGIC)
    for _ in range(3):
        if (at := field(at)) is None:
            return None
        if len(fields) < 3 and not re.compile(rb"[\x21-\x7E]+").fullmatch(data, *fields[-1]):
            return None
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if keys < 1 or 4 * (keys + 1) > end - at:
        return None
    for _ in range(keys):
        if (at := field(at)) is None:
            return None
        start, stop = fields[-1]
        if not 0 < int.from_bytes(data[start : start + 4], "big") <= stop - start - 4:
            return None
    at = field(at)
    return at if at is not None and fields[-1][0] < fields[-1][1] else None


def decoded(digits: str, base: int) -> bytes:
    """The bytes of base64 digits of either alphabet, or of hex digits; digits over at the end are left out."""
    if base == 16:
        return bytes.fromhex(digits[: len(digits) & ~1])
    digits = digits[: len(digits) - (len(digits) % 4 == 1)]
    return base64.b64decode(digits.replace("-", "+").replace("_", "/") + "=" * (-len(digits) % 4))


class Run:
    """The lines of digits from one place of a text on, as far as joints connect them. What they decode to is kept for each of the few
    offsets that a candidate in it can have, so a run is decoded no more often than that, however many candidates it holds."""

    def __init__(self, text: str, at: int, base: int):
        self.base, self.lines, self.before = base, [], [0]
        while m := DIGITS[base].match(text, at):
            self.lines.append(m.span())
            self.before.append(self.before[-1] + m.end() - m.start())
            gap = JOINT.match(text, m.end())
            if not gap:
                break
            at = gap.end()
        self.starts = [s for s, _ in self.lines]
        self.end = self.lines[-1][1]
        self.digits = "".join(text[s:e] for s, e in self.lines)
        self._bytes: dict[int, bytes] = {}
        self._inner: dict[int, tuple[str, list[tuple[int, int, int]]]] = {}
        self._openings: dict[str, list[int]] = {}

    def digit(self, place: int) -> int:
        """The number of the digit at a place of the text."""
        i = bisect_right(self.starts, place) - 1
        return self.before[i] + place - self.starts[i]

    def place_after(self, digits: int) -> int:
        """The place behind so many digits."""
        i = bisect_right(self.before, digits - 1) - 1
        return self.starts[i] + digits - self.before[i]

    def bytes_from(self, digit: int) -> tuple[bytes, int]:
        """(bytes, place among them) at a digit."""
        shift = digit % (4 if self.base == 64 else 2)
        if shift not in self._bytes:
            self._bytes[shift] = decoded(self.digits[shift:], self.base)
        return self._bytes[shift], (digit - shift) * 3 // 4 if self.base == 64 else (digit - shift) // 2

    def text_from(self, digit: int) -> tuple[str, int, list[tuple[int, int, int]]]:
        """(text, place in it, spans confirmed in all of it) at a digit, a character a byte."""
        data, at = self.bytes_from(digit)
        shift = digit % (4 if self.base == 64 else 2)
        if shift not in self._inner:
            inner = data.decode("latin-1")
            self._inner[shift] = (inner, sorted(confirmed_spans(inner, True)) if "-----B" in inner else [])
        return self._inner[shift][0], at, self._inner[shift][1]

    def next_like(self, digit: int, opening: str) -> int:
        """The digit at which a later line begins with `opening`; the number of digits if none does."""
        if opening not in self._openings:
            self._openings[opening] = [b for b in self.before[:-1] if self.digits.startswith(opening, b)]
        found = self._openings[opening]
        i = bisect_right(found, digit)
        return found[i] if i < len(found) else len(self.digits)


def encoded_spans(text: str, base: int, nested: bool) -> list[tuple[int, int, int]]:
    """Spans of keys in base64 or hex and, unless this is such a text already, of tokens and PEM texts in it.

    A span ends with the last digit (and padding) of the key, token or PEM text itself, whatever follows it in the run.
    """
    out, past, run = [], 0, None
    each = 4 if base == 16 else 6  # bits of a digit
    for m in START[base].finditer(text):
        if m.start() < past:
            continue
        if m[1]:  # the length that it claims, before anything is read
            head = decoded(m[0], base)
            # a short length, or one of so many bytes; what follows it, if it is here, is a version or a sequence
            skip = 2 + (head[1] & 0x7F if head[1] >= 0x80 else 0)
            if not 2 <= skip <= 6 or head[1] == 0x80 or head[skip : skip + 1] not in (b"", b"\x02", b"\x30"):
                continue
            need = skip + (int.from_bytes(head[2:skip], "big") if skip > 2 else head[1])
            if -(-8 * need // each) > len(text) - m.start():
                continue
        if run is None or m.start() >= run.end:
            run = Run(text, m.start(), base)
        first = run.digit(m.start())
        last = len(run.digits) if m[1] else run.next_like(first, m[0])
        data, at = run.bytes_from(first)
        end = min(len(data), at + (last - first) * each // 8)
        kind = stop = None
        if m[1]:
            kind, stop = 3 if base == 64 else 4, is_key(data, at, end)
        elif data.startswith(MAGIC[:-1], at):
            kind, stop = 6, openssh_end(data, at, end)
        elif not nested:
            inner, at, found = run.text_from(first)
            token = SIGNED.match(inner, at, end)
            if token:
                kind, stop = 5, token.end() if is_signed_token(token[1]) else None
            elif inner.startswith("-----B", at):
                i = bisect_right(found, (at, -1, -1))
                again = inner.find("-----B", at + 1, end)
                if i < len(found) and found[i][2] <= (end if again < 0 else again):
                    close = PEM_END.match(inner, found[i][2], end)
                    kind, stop = found[i][1], close.end() if close else found[i][2]
        if stop is None:
            continue
        past = run.place_after(first + -(-8 * (stop - at) // each))
        while base == 64 and text[past : past + 1] == "=":
            past += 1
        out.append((m.start(), kind, past))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, kind by kind."""
    out, low = [], text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= VALUE_CHARS]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    if _has(text.encode("utf-8", "surrogatepass"), HEX_TEST):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def confirmed_spans(text: str, nested: bool = False) -> list[tuple[int, int, int]]:
    """Spans whose decoded content has a secret's structure."""
    # line ends that are written as escapes become real ones, and PEM marks spaces, in the same places
    plain = ESCAPED.sub(lambda m: " " * (len(m[0]) - 1) + (" " if m[0][-1] == "t" else "\n"), text) if "\\" in text else text
    plain = MARK.sub(lambda m: " " * len(m[0]), plain) if "-----" in plain else plain
    out = encoded_spans(plain, 64, nested) + encoded_spans(plain, 16, nested)
    if "eyJ" in text:
        out += [(m.start(), 5, m.end()) for m in SIGNED.finditer(plain) if not (m.start() and BEFORE_SIGNED.match(plain[m.start() - 1])) and is_signed_token(m[1])]
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Finds secrets in the text of every row.

    docs: any table with id_col (any type, null allowed) and text_col; other columns are ignored, whatever their names. A
    null text counts as empty and has no spans. Repeated rows each give a row; an empty table gives none. Long texts are
    scanned whole, in time linear in their length. A key is confirmed if its own nested lengths fit; bytes that follow it in the
    same run aren't part of its span.

    Returns id_col, spans array<struct<kind, start, end>> (code points, end exclusive; by start, then kind as listed in
    KINDS) and base array of the same type without the confirmed kinds.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                base, every = [], []
                for text in batch.column("text").to_pylist():
                    plain = base_spans(text) if text else []
                    base.append(listed(plain))
                    every.append(listed(plain + confirmed_spans(text)) if text else [])
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(every, span), pa.array(base, span)], names=["id", "spans", "base"])

    item = "array<struct<kind:string,start:bigint,end:bigint>>"
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"id {kind}, spans {item}, base {item}").withColumnRenamed("id", id_col)


def span_text(column: str) -> F.Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans as text."""
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select(id_col, *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


