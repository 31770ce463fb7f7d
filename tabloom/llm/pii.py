"""Format-preserving pseudonyms for personal data in texts.

A value that is found is validated, read as a number within its format, permuted by a keyed
Feistel network over just the numbers of that format, and written back in the form it had. Equal
values get equal pseudonyms in every document, and the key turns them back. Equal are also cards,
account numbers and phones with other separators, account numbers and mail names in other cases,
and dates with their parts in another order.

What is read: mail addresses (the name is replaced); AKIA/ASIA access keys; named passwords, tokens,
secrets and API keys; IBANs, plain or in groups; dates with a four-digit year and numbers, as
2024-01-05, 5.1.2024, 5/1/2024 or 5-1-2024; IPv4 addresses; social security numbers with separators;
North American phones with + or separators, other phones with +; cards of 13 to 19 digits, plain or
separated by spaces or hyphens. Not read: dates with month names or two-digit years, social security
numbers and North American phones without a sign between the groups or with blanks only, cards
separated by dots, IPv6 addresses, names and postal addresses.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ..session import ship_package
from .textbytes import slices

ROUNDS = 10
MOST_CACHED = 200_000
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutations of range(n) for any n; `kind` keeps the formats' permutations apart."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, n: int, i: int, half: int, bits: int) -> int:
        need = (bits + 7) // 8
        text = f"{kind}|{n}|{i}|{half}|".encode()
        out = b"".join(
            hashlib.blake2b(text + str(k).encode(), key=self.key, digest_size=64).digest() for k in range(-(-need // 64))
        )
        return int.from_bytes(out[:need], "big") & ((1 << bits) - 1)

    def permute(self, kind: str, n: int, value: int, back: bool = False) -> int:
        """The value's place in the permutation; walks on while the network leaves the range."""
        if n < 2:
            return value
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        while True:
            left, right = value >> bits, value & mask
            for i in order:
                if back:
                    left, right = right ^ self._round(kind, n, i, left, bits), left
                else:
                    left, right = right, left ^ self._round(kind, n, i, right, bits)
            value = left << bits | right
            if value < n:
                return value


def luhn_digit(payload: str) -> str:
    """The check digit that makes payload + digit pass the Luhn test."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    """The two check digits of an account number (ISO 7064, mod 97)."""
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


Permute = Callable[[str, int, int], int]


def _mixed(values: list[int], sizes: list[int], kind: str, permute: Permute) -> list[int]:
    """Permute a number written in places of different sizes."""
    total, number = 1, 0
    for v, s in zip(values, sizes, strict=True):
        number, total = number * s + v, total * s
    number = permute(kind, total, number)
    out = []
    for s in reversed(sizes):
        number, v = divmod(number, s)
        out.append(v)
    return out[::-1]


CLASSES = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
SIZE_OF = {c: len(group) for group in CLASSES for c in group}
PLACE_OF = {c: i for group in CLASSES for i, c in enumerate(group)}
GROUP_OF = {c: group for group in CLASSES for c in group}


def _by_class(text: str, kind: str, permute: Permute, keep: int = 0) -> str:
    """Permute digits among digits and letters among letters of their case; the rest stays."""
    chars = list(text)
    at = [i for i, c in enumerate(chars) if i >= keep and c in SIZE_OF]
    shape = "".join("9" if chars[i].isdigit() else "a" if chars[i].islower() else "A" for i in at)
    new = _mixed([PLACE_OF[chars[i]] for i in at], [SIZE_OF[chars[i]] for i in at], f"{kind}:{shape}", permute)
    for i, v in zip(at, new, strict=True):
        chars[i] = GROUP_OF[chars[i]][v]
    return "".join(chars)


def _cased(form: str, text: str) -> str:
    """The text with capitals where the form has them."""
    return "".join(c.upper() if f.isupper() else c for f, c in zip(form, text, strict=True))


def _fill(form: str, digits: str) -> str:
    """Put digits into the places that hold digits."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


Made = tuple[int, int, str]  # start and end of the value within the match, and its pseudonym


def _runs(found: str, valid: Callable[[str], str | None]) -> Made | None:
    """Start, end and pseudonym of a single group of the match that is valid, else of the longest
    run of groups that is: what stands beside a number may look like more of it."""
    groups = [m.span() for m in re.finditer(r"\w+", found)]
    for size in [1, *range(len(groups), 1, -1)]:
        for i in range(len(groups) - size + 1):
            start, end = groups[i][0], groups[i + size - 1][1]
            if (new := valid(found[start:end])) is not None:
                return start, end, new
    return None


def _card(found: str, permute: Permute) -> Made | None:
    def one(text: str) -> str | None:
        if len(text) < 13 or text[0] not in "3456":
            return None
        digits = re.sub(r"\D", "", text)
        payload, n = digits[:-1], len(digits)
        if not 13 <= n <= 19 or luhn_digit(payload) != digits[-1]:
            return None
        new = payload[0] + str(permute(f"card:{n}:{payload[0]}", 10 ** (n - 2), int(payload[1:]))).zfill(n - 2)
        return _fill(text, new + luhn_digit(new))

    return _runs(found, one)


def _iban(found: str, permute: Permute) -> Made | None:
    def one(text: str) -> str | None:
        plain = text.replace(" ", "").upper()
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if not 11 <= len(account) <= 30 or not country.isalpha() or iban_digits(country, account) != check:
            return None
        new = _by_class(account, f"iban:{country}", permute)
        new = iter(country + iban_digits(country, new) + new)
        written = "".join(c if c == " " else next(new) for c in text)
        return written.lower() if text == text.lower() else written

    return _runs(found, one)


def _abroad(found: str, permute: Permute) -> Made | None:
    """The longest start of the match that has as many digits as a number may have."""
    for end in reversed([m.end() for m in re.finditer(r"\d+", found)]):
        digits = re.sub(r"\D", "", found[:end])
        if 9 <= len(digits) <= 15:
            return 0, end, _fill(found[:end], _by_class(digits, "phone", permute, keep=2))
    return None


def _phone(found: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", found)
    lead, own = digits[:-10], digits[-10:]
    if lead not in ("", "1") or len(own) != 10 or own[0] in "01" or own[3] in "01":
        return None
    values = [int(own[:3]) - 200, int(own[3:6]) - 200, int(own[6:])]
    area, office, line = _mixed(values, [800, 800, 10_000], "phone:1", permute)
    return _fill(found, f"{lead}{area + 200}{office + 200}{line:04d}")


def _social(found: str, permute: Permute) -> str | None:
    area, group, serial = (int(x) for x in re.split(r"[- ]", found))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    a, g, s = _mixed([place, group - 1, serial - 1], [898, 99, 9999], "social", permute)
    return _fill(found, f"{a + 1 + (a >= 665):03d}{g + 1:02d}{s + 1:04d}")


def _address(found: str, permute: Permute) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in found.split(".")):
        return None
    return ".".join(map(str, _mixed(parts, [256] * 4, "ip", permute)))


def _date(found: str, permute: Permute) -> str | None:
    sign = re.search(r"\D", found)[0]
    parts = found.split(sign)
    year_first = len(parts[0]) == 4
    numbers = [int(p) for p in parts]
    orders = [(0, 1, 2)] if year_first else [(2, 1, 0), (2, 0, 1)]  # day first, else month first
    for order in orders:
        try:
            day = date(*(numbers[i] for i in order)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = date.fromordinal(FIRST_DAY + permute("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY))
        out = [""] * 3
        for i, v in zip(order, (new.year, new.month, new.day), strict=True):
            out[i] = f"{v:04d}" if v == new.year and len(parts[i]) == 4 else f"{v:02d}"
        return sign.join(out)
    return None


def _mail(found: str, permute: Permute) -> str | None:
    local, domain = found.rsplit("@", 1)
    return f"{_cased(local, _by_class(local.lower(), 'mail', permute))}@{domain}"


def _key(found: str, permute: Permute) -> str | None:
    return _by_class(found, "key", permute, keep=4)


def _secret(found: str, permute: Permute) -> str | None:
    at = re.match(r"\w+\s*[=:]\s*[\"']?", found).end()
    return found[:at] + _by_class(found[at:], "secret", permute)


# kind, pattern, and what turns a match, or the part of it that is a value, into its pseudonym
# (None: nothing in it is valid, so it stays). Earlier kinds come first where several match at one place.
KINDS: list[tuple[str, str, Callable[[str, Permute], str | Made | None]]] = [
    ("mail", r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _mail),
    ("key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", _key),
    ("secret", r"\b(?:password|passwd|token|secret|api_?key)\s*[=:]\s*(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|[^\s\"']{6,})", _secret),
    ("iban", r"\b(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}|[a-z]{2}\d{2}(?: ?[a-z0-9]){11,30})\b", _iban),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}([./-])\d{1,2}\1\d{4})(?![\w/-]|\.\d)", _date),
    ("address", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", _address),
    ("social", r"(?<![\w-])\d{3}([- ])\d{2}\1\d{4}(?![\w-])", _social),
    ("phone", r"(?<!\w)\+1(?:\d{10}|[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4})(?!\d)|(?<![\w+-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])", _phone),
    ("phone", r"(?<!\w)\+[2-9]\d{0,2}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)", _abroad),
    ("card", r"(?<![\w.+])(?:(?<!-)|(?<=\d-))\d(?:[ -]?\d){12,18}(?![\w-])", _card),
    ("card", r"(?<![\w.+])(?:(?<!-)|(?<=\d-))\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}|\d{6}\1\d{4,5})(?![\w-])", _card),
]
ABROAD, ANY_CARD, GROUPED_CARD = range(len(KINDS) - 3, len(KINDS))
MAYBE = re.compile(r"\d|@|password|passwd|token|secret|api_?key", re.IGNORECASE)


class Pseudonyms:
    """Replaces the values of texts; one per Python worker, with the pseudonyms it made lately.

    With `back`, pseudonyms are turned back into the values they stand for.
    """

    def __init__(self, key: bytes, back: bool = False):
        self.permute: Permute = partial(Feistel(key).permute, back=back)
        self.cache: dict[tuple[str, str], Made | None] = {}
        self.kinds = [(name, re.compile(pattern, re.IGNORECASE if name == "secret" else 0), make) for name, pattern, make in KINDS]

    def _made(self, name: str, found: str, make) -> Made | None:
        at = (name, found)
        if at not in self.cache:
            if len(self.cache) > MOST_CACHED:
                self.cache.clear()
            made = make(found, self.permute)
            self.cache[at] = (0, len(found), made) if isinstance(made, str) else made
        return self.cache[at]

    def _next(self, kind: int, text: str, at: int, end: int) -> Made | None:
        """The first value of a kind that lies in text[at:end].

        A match may begin with another number, so behind one that holds no value the search goes on
        at the match's next group, and what stands before the value within a match is searched too.
        """
        name, pattern, make = self.kinds[kind]
        while m := pattern.search(text, at, end):
            at = m.start()
            if (made := self._made(name, m[0], make)) is not None:
                start, stop, new = made
                before = self._next(kind, text, at, at + start) if start else None
                return before or (at + start, at + stop, new)
            at += 1  # no pattern begins inside a group
        return None

    def _fitted(self, kind: int, value: Made, text: str, coming: dict[int, Made]) -> Made | None:
        """The value, cut where a surer one begins inside it; None where nothing valid is left.

        Foreign phones and digits of any grouping have the loosest patterns: such a phone ends
        before a value that reaches beyond it, and such a card before a card in the usual groups.
        """
        if kind not in (ABROAD, ANY_CARD):
            return value
        for other, (start, end, _) in coming.items():
            surer = end > value[1] if kind == ABROAD else other == GROUPED_CARD
            if other != kind and surer and value[0] < start < value[1]:
                cut = self._next(kind, text, value[0], start)
                if cut is None or cut[0] != value[0]:
                    return None
                value = cut
        return value

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and (start, end, kind) of each value in the original."""
        if not MAYBE.search(text):
            return text, []
        out, spans, at = [], [], 0
        coming = {k: v for k in range(len(self.kinds)) if (v := self._next(k, text, 0, len(text))) is not None}
        while coming:
            kind = min(coming, key=lambda k: (coming[k][0], k))
            value = self._fitted(kind, coming[kind], text, coming)
            if value is None:
                stale, behind = [kind], coming[kind][0] + 1
            else:
                start, end, new = value
                out += [text[at:start], new]
                spans.append((start, end, self.kinds[kind][0]))
                at = behind = end
                stale = [k for k, v in coming.items() if v[0] < at]
            for k in stale:  # what began inside the value is searched again behind it
                if (found := self._next(k, text, behind, len(text))) is None:
                    del coming[k]
                else:
                    coming[k] = found
        return "".join([*out, text[at:]]), spans


_MADE: dict[bytes, Pseudonyms] = {}
SPANS = ArrayType(StructType().add("start", IntegerType()).add("end", IntegerType()).add("kind", StringType()))


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """All columns, with the values in `text` replaced, and `pii`: (start, end, kind) of each in the original.

    Cards (Luhn), account numbers (mod 97), phones, social security numbers, network addresses and
    calendar dates must be valid, else they stay; mail names, access keys and named secrets are
    permuted character class by character class. A missing text stays missing, with no values; an
    empty or very long text is handled whole; repeated rows are replaced alike; a column called
    pii is replaced; an empty table stays empty. Equal values have equal pseudonyms under one key.
    """
    ship_package(docs.sparkSession)
    docs = docs.drop("pii")
    schema = StructType([*docs.schema.fields]).add("pii", SPANS)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MADE:
            _MADE[key] = Pseudonyms(key)
        made = _MADE[key]
        for whole in batches:
            for batch in slices(whole, "text"):
                at = batch.schema.get_field_index("text")
                done = [made.replace(t) if t is not None else (None, []) for t in batch.column(at).to_pylist()]
                spans = [[{"start": a, "end": b, "kind": k} for a, b, k in s] for _, s in done]
                columns = list(batch.columns)
                columns[at] = pa.array([t for t, _ in done], batch.column(at).type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, span)], [*names, "pii"])

    return docs.mapInArrow(run, schema)
