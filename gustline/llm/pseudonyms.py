"""Format-preserving pseudonyms for personal data.

Valid values (card numbers by their check digit, calendar dates, IPv4 addresses, North American
phone numbers, mail addresses) are permuted within their format by a keyed Feistel network. The
permutation depends on the key and the format only, so equal values stay equal in all documents
and different values stay different. No value keeps its place, but mail names without any letter or
digit, which have nothing to permute. Cards and dates that fail validation are left alone. Phone numbers
with an area code or exchange that is never assigned are hidden as well, and get such a pseudonym.

Null text stays null and counts nothing; empty text stays empty. Rows come back one for one.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from gustline.llm.shared import batch_of, documents, slices

ROUNDS = 10
KINDS = ("email", "ip", "phone", "card", "date")

# One scan finds what may be a value. Left and right of it stands no letter or digit of any script; its own
# digits are 0 to 9.
CANDIDATE = re.compile(
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))"
    r"|(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9]))"
    r"|(?P<date>(?<![\w./-])(?:[0-9]{4}([-/.])[0-9]{2}\4[0-9]{2}|[0-9]{2}([./-])[0-9]{2}\5[0-9]{4})(?!\w|[./-][0-9]))"
    r"|(?P<phone>(?<![\w+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?!\w|[.-][0-9]))"
)
# A text without a digit or an @ holds none of these.
HINT = re.compile(r"[0-9@]")


def feistel(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A permutation of range(size), or its inverse: Feistel rounds over two halves, walked until back in range."""
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    width = max(8, (a.bit_length() + 71) // 8)
    sign, order = (-1, range(ROUNDS - 1, -1, -1)) if back else (1, range(ROUNDS))
    while True:
        left, right = divmod(value, b)  # left < a, right < b
        for i in order:
            if i % 2:
                mixed = keyed(key, f"{tweak}:{size}:{i}:{left}", width)
                right = (right + sign * mixed) % b
            else:
                mixed = keyed(key, f"{tweak}:{size}:{i}:{right}", width)
                left = (left + sign * mixed) % a
        value = left * b + right
        if value < size:
            return value


def moved(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size) that leaves no value in its place, unless there is only one.

    It is one step along a cycle through all values, in the order that the Feistel network gives.
    """
    return feistel((feistel(value, size, key, tweak) + 1) % max(1, size), size, key, tweak, back=True)


def keyed(key: bytes, message: str, width: int) -> int:
    if width <= 64:
        return int.from_bytes(blake2b(message.encode(), key=key, digest_size=width).digest())
    parts = (blake2b(f"{n}:{message}".encode(), key=key).digest() for n in range(-(-width // 64)))
    return int.from_bytes(b"".join(parts))


def luhn_digit(payload: str) -> str:
    """The check digit that follows these digits."""
    doubled = (sum(divmod(2 * int(c), 10)) for c in payload[::-2])
    return str(-(sum(doubled) + sum(map(int, payload[-2::-2]))) % 10)


def put_digits(pattern: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in pattern)


def card(text: str, key: bytes) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    payload = f"{moved(int(digits[:-1]), 10 ** (len(digits) - 1), key, 'card'):0{len(digits) - 1}d}"
    return put_digits(text, payload + luhn_digit(payload))


def phone(text: str, key: bytes) -> str | None:
    """Area codes and exchanges that begin with 0 or 1 (never assigned) become such again, others don't."""
    digits = re.sub("[^0-9]", "", text)
    value, size, classes = 0, 1, []
    for code in (int(digits[-10:-7]), int(digits[-7:-4])):
        start, count = (200, 800) if code >= 200 else (0, 200)
        value, size = value * count + code - start, size * count
        classes.append((start, count))
    changed = moved(value * 10_000 + int(digits[-4:]), size * 10_000, key, f"phone:{classes}")
    changed, line = divmod(changed, 10_000)
    area, exchange = divmod(changed, classes[1][1])
    return put_digits(text, f"{digits[:-10]}{area + classes[0][0]:03d}{exchange + classes[1][0]:03d}{line:04d}")


def ip(text: str, key: bytes) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255:
        return None
    changed = moved(int.from_bytes(bytes(octets)), 1 << 32, key, "ip")
    return ".".join(map(str, changed.to_bytes(4)))


def date(text: str, key: bytes) -> str | None:
    numbers = re.split("[-/.]", text)
    separator = re.search("[-/.]", text).group()
    year_first = len(numbers[0]) == 4
    try:
        # Of day and month, the day stands first where the year comes last.
        day = datetime.date(*map(int, numbers if year_first else numbers[::-1]))
    except ValueError:
        return None
    first, last = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
    if not first <= day.toordinal() <= last:
        first, last = 1, datetime.date.max.toordinal()
    changed = datetime.date.fromordinal(first + moved(day.toordinal() - first, last - first + 1, key, "date"))
    parts = [f"{changed.year:04d}", f"{changed.month:02d}", f"{changed.day:02d}"]
    return separator.join(parts if year_first else parts[::-1])


def email(text: str, key: bytes) -> str | None:
    """Letters stay letters and digits digits; upper and lower case of an address are one value."""
    name, at, domain = text.lower().partition("@")
    value, size = 0, 1
    for c in name:
        base, digit = (10, int(c)) if c.isdigit() else (26, ord(c) - 97) if c.isalpha() else (1, 0)
        value, size = value * base + digit, size * base
    value = moved(value, size, key, "email:" + re.sub("[a-z]", "a", re.sub("[0-9]", "9", name)) + at + domain)
    out = []
    for c in reversed(name):
        base, zero = (10, 48) if c.isdigit() else (26, 97) if c.isalpha() else (1, ord(c))
        value, digit = divmod(value, base)
        out.append(chr(zero + digit))
    return "".join(reversed(out)) + at + domain


CHANGE = {"email": email, "ip": ip, "phone": phone, "card": card, "date": date}


def pseudonymised(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each value in the original."""
    if not HINT.search(text):
        return text, []
    out, spans, end = [], [], 0
    for match in CANDIDATE.finditer(text):
        kind = match.lastgroup if match.lastgroup else next(k for k in KINDS if match[k])
        changed = CHANGE[kind](match.group(), key)
        if changed is not None:
            out += [text[end : match.start()], changed]
            end = match.end()
            spans.append((kind, match.start(), end))
    return "".join(out) + text[end:], spans


def pseudonymise(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the text with pseudonyms, spans (kind:start:end in the original text) and a count per kind.

    Rows are independent: no shuffle. The key goes to the executors with the function.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text", pa.string()), ("spans", pa.string())]
        + [(f"n_{kind}", pa.int64()) for kind in KINDS]
    )

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [
                (None, []) if text is None else pseudonymised(text, key) for text in batch.column("text").to_pylist()
            ]
            texts = [text for text, _ in rows]
            spans = [",".join(f"{kind}:{start}:{end}" for kind, start, end in found) for _, found in rows]
            counts = [[sum(k == kind for k, _, _ in found) for _, found in rows] for kind in KINDS]
            yield batch_of(schema, [batch.column("doc_id"), texts, spans, *counts])

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return documents(df, id_col=id_col, text_col=text_col).mapInArrow(
        change, f"doc_id long, text string, spans string, {counts}"
    )
