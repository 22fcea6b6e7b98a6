"""Format-preserving pseudonyms for personal data in whole texts.

Validated values are replaced by values of the same format: a keyed Feistel network permutes the numbers a format can
write, so equal values get equal pseudonyms in every document and different values different ones. Values outside the
format's valid range are walked on to the next (the permutation is applied again until the result is valid), which
keeps it a permutation of the valid values. Phone and social security numbers that cannot have been issued are still
replaced, by others of that sort, because the way they are written gives them away.

Kinds: payment cards (Luhn; the check digit is made anew), IBAN (modulo 97; check digits made anew), North American
phone numbers, social security numbers, IPv4 addresses, dates (three ways of writing; days of 1900-2099), e-mail
addresses (the part before the @, letter for letter, digit for digit; the domain stays), hexadecimal tokens, access keys
and values assigned to a password, secret, token or API key (up to the next blank or quote, in pieces of 64 letters and
digits). A ten-digit number without separators counts as no phone number.

Numbers are matched as values, not as spelling: separators stay where they are, and a card gets the same pseudonym with
or without spaces. Digits or capitals that follow or precede a card or an IBAN may look like a part of it: what is not
valid as a whole is tried in parts, cards in their usual groups (in others only as a whole), and a card never takes digits of a phone
number, social security number, address or date that reaches beyond it. A date that is none with the day first is read
with the month first, and replaced by a date that is none with the day first either. Everything is a narrow pass over the
rows; the key is a parameter and never written.

Defined results: a null text stays null, an empty one empty; equal rows give equal results; overlapping matches go to
the kind named first in ``KINDS``, then the leftmost; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 10
FOUND = "tidemark_pii"
FOUND_TYPE = "text string, spans array<struct<kind:string,start:int,length:int>>"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Permutation:
    """A keyed permutation of 0..size-1: an alternating Feistel network on a rectangle, walked back into the range."""

    def __init__(self, key: bytes, name: str, size: int):
        self.size = size
        self.high = max(1, isqrt(size - 1) + 1)
        self.low = -(-size // self.high)
        self.key = hashlib.blake2b(key, digest_size=32, person=b"tidemark-pii", salt=name.encode()[:16].ljust(16)).digest()

    def _round(self, i: int, half: int, modulus: int) -> int:
        data = i.to_bytes(1, "big") + self.size.to_bytes(64, "big") + half.to_bytes(64, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=48).digest(), "big") % modulus

    def _once(self, x: int) -> int:
        a, b = divmod(x, self.low)
        for i in range(ROUNDS):
            if i % 2:
                b = (b + self._round(i, a, self.low)) % self.low
            else:
                a = (a + self._round(i, b, self.high)) % self.high
        return a * self.low + b

    def _back(self, y: int) -> int:
        a, b = divmod(y, self.low)
        for i in reversed(range(ROUNDS)):
            if i % 2:
                b = (b - self._round(i, a, self.low)) % self.low
            else:
                a = (a - self._round(i, b, self.high)) % self.high
        return a * self.low + b

    def walk(self, x: int, valid: Callable[[int], bool], back: bool = False) -> int:
        step = self._back if back else self._once
        x = step(x)
        while x >= self.size or not valid(x):
            x = step(x)
        return x


def any_number(_: int) -> bool:
    return True


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def refill(template: str, digits: str) -> str:
    """The template with its digits replaced, in order."""
    rest = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(rest), template)


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


@dataclass(frozen=True)
class Pseudonyms:
    """Pseudonyms of single values; None for what is not a valid value of the kind."""

    key: bytes

    def _permuted(self, name: str, x: int, size: int, valid: Callable[[int], bool] = any_number, back: bool = False) -> int:
        return Permutation(self.key, name, size).walk(x, valid, back)

    def card(self, text: str, back: bool = False) -> str | None:
        digits = digits_of(text)
        if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        n = len(digits) - 1
        valid = lambda x: x % ((10**n - 1) // 9) != 0 and x >= 10 ** (n - 1)
        body = digits[:-1]
        if not valid(int(body)):
            return None
        body = str(self._permuted("card", int(body), 10**n, valid, back))
        return refill(text, body + str(luhn(body)))

    def iban(self, text: str, back: bool = False) -> str | None:
        bare = text.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(bare) <= 34 or number(bare[4:] + bare[:4]) % 97 != 1:
            return None
        body = self._characters("iban", bare[4:], back)
        checked = bare[:2] + f"{98 - number(body + bare[:2] + '00') % 97:02d}" + body
        rest = iter(checked)
        return "".join(c if c == " " else next(rest) for c in text)

    def phone(self, text: str, back: bool = False) -> str | None:
        digits = digits_of(text)
        country, digits = (digits[:-10], digits[-10:])
        if len(digits) < 10 or country not in ("", "1"):
            return None
        dialled = lambda x: x // 10**9 >= 2 and x // 10**6 % 10 >= 2
        real = dialled(int(digits))
        valid = lambda x: dialled(x) == real
        return refill(text, country + f"{self._permuted('phone', int(digits), 10**10, valid, back):010d}")

    def ssn(self, text: str, back: bool = False) -> str | None:
        def issued(x: int) -> bool:
            area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
            return area not in (0, 666) and area < 900 and group > 0 and serial > 0

        x = int(digits_of(text))
        return refill(text, f"{self._permuted('ssn', x, 10**9, lambda y: issued(y) == issued(x), back):09d}")

    def ipv4(self, text: str, back: bool = False) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        x = int.from_bytes(bytes(map(int, parts)), "big")
        return ".".join(map(str, self._permuted("ipv4", x, 1 << 32, back=back).to_bytes(4, "big")))

    def date(self, text: str, back: bool = False) -> str | None:
        parts, month_first = re.split(r"[-/.]", text), False
        short = len(parts[0]) == 4 and len(text) < 10  # single digits for the first months and days
        try:
            if len(parts[0]) == 4:
                day, write = datetime.date(*map(int, parts)), "{0:d}{3}{1:d}{3}{2:d}" if short else "{0:04d}{3}{1:02d}{3}{2:02d}"
            else:
                a, b, year = map(int, parts)
                month_first = b > 12
                if month_first:
                    day, write = datetime.date(year, a, b), "{1:02d}{3}{2:02d}{3}{0:04d}"
                else:
                    day, write = datetime.date(year, b, a), "{2:02d}{3}{1:02d}{3}{0:04d}"
        except ValueError:
            return None
        if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
            return None
        valid = (lambda x: datetime.date.fromordinal(FIRST_DAY + x).day > 12) if month_first else any_number
        if short:
            # as many digits as before, so that the text tells how it was written
            digits = lambda d: (d.month < 10, d.day < 10)
            if len(parts[1]) != 1 + (day.month > 9) or len(parts[2]) != 1 + (day.day > 9):
                return None
            valid = lambda x: digits(datetime.date.fromordinal(FIRST_DAY + x)) == digits(day)
        x = self._permuted("date", day.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, valid, back)
        new = datetime.date.fromordinal(FIRST_DAY + x)
        return write.format(new.year, new.month, new.day, re.search(r"[-/.]", text)[0])

    def _characters(self, name: str, text: str, back: bool) -> str:
        """Letters become letters of their case and digits digits, the whole string permuted as one number."""
        bases = [10 if c.isdigit() else 26 for c in text]
        x = size = 0
        size = 1
        for c, base in zip(text, bases, strict=True):
            x, size = x * base + (int(c) if base == 10 else ord(c.lower()) - 97), size * base
        x = self._permuted(name + "".join("d" if b == 10 else "l" for b in bases)[:8], x, size, back=back)
        out = []
        for c, base in zip(reversed(text), reversed(bases), strict=True):
            x, digit = divmod(x, base)
            new = str(digit) if base == 10 else chr(97 + digit)
            out.append(new.upper() if c.isupper() else new)
        return "".join(reversed(out))

    def email(self, text: str, back: bool = False) -> str | None:
        name, at, host = text.rpartition("@")
        plain = "".join(c for c in name if c.isascii() and c.isalnum())
        if not 1 <= len(plain) <= 64:
            return None
        rest = iter(self._characters("email", plain, back))
        return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in name) + at + host

    def token(self, text: str, back: bool = False) -> str | None:
        digits = len(text)
        if digits > 128 or text.isdigit() or not (text == text.lower() or text == text.upper()):
            return None
        new = f"{self._permuted(f'token{digits}', int(text, 16), 16**digits, back=back):0{digits}x}"
        return new.upper() if text != text.lower() else new


    def access_key(self, text: str, back: bool = False) -> str | None:
        return text[:4] + self._characters("access_key", text[4:], back)

    def secret(self, text: str, back: bool = False) -> str | None:
        """Letters and digits of the whole value; what else stands in it stays."""
        plain = "".join(c for c in text if c.isascii() and c.isalnum())
        if not plain:
            return None
        rest = iter("".join(self._characters("secret", plain[i : i + 64], back) for i in range(0, len(plain), 64)))
        return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in text)


# Kinds in order of preference, with what may be one (validated afterwards).
KINDS = [
    ("email", r"[\w.%+\-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?(?:\.[A-Za-z0-9\-]{1,63}){0,8}\.[A-Za-z]{2,63}"),
    ("token", r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,128}(?![0-9A-Za-z])"),
    ("access_key", r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"),
    ("secret", r"""(?i:password|passwd|pwd|secret|token|api[_-]?key)["']?[ \t]{0,4}[:=][ \t]{0,4}["']?([^\s"']{6,})"""),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])(?:\+?1[ .\-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9A-Za-z])"),
    ("ssn", r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])"),
    ("ipv4", r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"),
    ("date", r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?:(?=T[0-9]{2})|(?![0-9A-Za-z]))"),
]
PATTERNS = [(kind, re.compile(pattern)) for kind, pattern in KINDS]
# What a text must hold for a value of the kind to be in it.
HAS_DIGITS = re.compile(r"[0-9]{3}|[0-9][.\-/ ()]+[0-9]")
HELD = {"email": ("@",), "access_key": ("AKIA",)}
ASSIGNED = ("passw", "pwd", "secret", "token", "api")  # in lower case
NUMERIC = {"card", "phone", "ssn", "ipv4", "date"}
# How cards are written; parts of a longer run of digits count only if they are written so, or any list would hold some.
CARD = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1(?:[0-9]|[0-9]{4}(?:\1[0-9]{3})?)|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")
CUT_BY = [(kind, pattern) for kind, pattern in PATTERNS if kind in ("phone", "ssn", "ipv4", "date")]


def parts_of(kind: str, text: str, start: int, end: int) -> list[int]:
    """Ends of the values that may start where a card or an IBAN was matched, the longest first."""
    ends = [e for e in range(end, start, -1) if e == end or text[e] in " -"]
    return ends if kind == "iban" else [e for e in ends if CARD.fullmatch(text, start, e)]


def cuts_a_value(text: str, start: int, end: int, pseudonyms: Pseudonyms) -> bool:
    """Whether a value of another numeric kind stands partly within and partly beyond the span."""
    low, high = max(0, start - 24), end + 24
    for kind, pattern in CUT_BY:
        for match in pattern.finditer(text, low, high):
            s, e = match.span()
            if (s < start < e or s < end < e) and _cached(pseudonyms, kind)(match[0]) is not None:
                return True
    return False


def in_parts(
    kind: str, pattern: re.Pattern, text: str, free: Callable[[int, int], bool], pseudonyms: Pseudonyms
) -> Iterator[tuple[int, int, str, str]]:
    """Cards in their usual groups, or IBANs, without overlaps; what is none as a whole is tried in parts."""
    make, at = _cached(pseudonyms, kind), 0
    while match := pattern.search(text, at):
        start, whole = match.span()
        at = start + 1
        for end in parts_of(kind, text, start, whole):
            value = make(text[start:end]) if free(start, end) else None
            if value is not None and not (kind == "card" and cuts_a_value(text, start, end, pseudonyms)):
                yield start, end, kind, value
                at = end
                break


def emails(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Spans of addresses, looked for around each @: a long run of letters is not tried from every letter."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > max(done, at - 64) and (text[low - 1].isalnum() or text[low - 1] in "._%+-"):
            low -= 1
        match = pattern.match(text, low) if low < at else None
        if match and match.end() > at:
            yield match.span()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def spans_of(kind: str, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    if kind == "email":
        yield from emails(pattern, text)
    else:
        for match in pattern.finditer(text):
            yield match.span(1 if kind == "secret" else 0)


def find(text: str, pseudonyms: Pseudonyms) -> list[tuple[int, int, str, str]]:
    """start, end, kind and pseudonym of the values found, in order, without overlaps."""
    found: list[tuple[int, int, str, str]] = []  # in order
    numeric = HAS_DIGITS.search(text) is not None
    low = text.lower()

    def free(start: int, end: int) -> bool:
        place = bisect_left(found, (end,))
        return place == 0 or found[place - 1][1] <= start

    for kind, pattern in PATTERNS:
        if kind in NUMERIC and not numeric or kind in HELD and not any(part in text for part in HELD[kind]):
            continue
        if kind == "secret" and not any(part in low for part in ASSIGNED):
            continue
        if kind in ("iban", "card"):
            found = sorted([*found, *in_parts(kind, pattern, text, free, pseudonyms)])
        make = _cached(pseudonyms, kind)
        new = []
        for start, end in spans_of(kind, pattern, text):
            value = make(text[start:end]) if free(start, end) else None
            if value is not None and not (kind == "card" and cuts_a_value(text, start, end, pseudonyms)):
                new.append((start, end, kind, value))
        found = sorted([*found, *new])
    return found


@lru_cache(maxsize=64)
def _cached(pseudonyms: Pseudonyms, kind: str) -> Callable[[str], str | None]:
    make = getattr(pseudonyms, kind)
    known = lru_cache(maxsize=1 << 14)(make)
    return lambda text: known(text) if len(text) <= 128 else make(text)


def replace(text: str | None, pseudonyms: Pseudonyms) -> tuple[str | None, list[dict]]:
    """The text with pseudonyms for its values, and where they now stand."""
    found = find(text, pseudonyms) if text else []
    if not found:
        return text, []
    parts, spans, at, size = [], [], 0, 0
    for start, end, kind, value in found:
        size += start - at
        parts += [text[at:start], value]
        spans.append({"kind": kind, "start": size, "length": len(value)})
        size, at = size + len(value), end
    return "".join([*parts, text[at:]]), spans


def pseudonymise(docs: DataFrame, key: bytes, *keep: str, text: str = "text") -> DataFrame:
    """The ``keep`` columns and the struct ``FOUND`` of the new text and the spans of its pseudonyms."""
    columns = [*keep, *([] if text in keep else [text])]
    at_text, width = columns.index(text), len(keep)
    kept = docs.select(*[F.col(name) for name in columns])
    pseudonyms = Pseudonyms(key)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = [replace(x, pseudonyms) for x in part.column(at_text).to_pylist()]
                struct = pa.StructArray.from_arrays(
                    [pa.array([x for x, _ in rows], pa.string()), pa.array([x for _, x in rows], span)], ["text", "spans"]
                )
                yield pa.RecordBatch.from_arrays([*part.columns[:width], struct], names=[*part.schema.names[:width], FOUND])

    return kept.mapInArrow(run, T.StructType(kept.schema.fields[:width]).add(FOUND, T.StructType.fromDDL(FOUND_TYPE)))
