"""Format-preserving pseudonyms for validated personal data.

Card numbers (check digit), IBANs (check digits), social security numbers,
phone numbers, IPv4 and e-mail addresses and calendar dates are found in
whole texts and validated. Each is mapped to an integer of its format's
range and permuted there by a keyed Feistel network with cycle walking, so

* the pseudonym is valid and written alike (separators, letter case, order
  of day and month stay);
* equal values get equal pseudonyms in every document, however separated;
* the holder of the key can undo it (``restore=True``).

A card number or IBAN may be followed by more digits or words (an expiry date,
a bank code): its printed groups or its country's length are tried first, then
all that looks like it. Such a pseudonym is drawn again until the readings that
were tried before it fail as they did, so that restoring reads it alike.

Numbers that fail validation are left alone. Null texts stay null, texts
without personal data are unchanged, repeated rows give repeated results.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_columns

ROUNDS = 8
KINDS = ("email", "iban", "date", "ssn", "ip", "phone", "card")
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY

#: Letters and digits keep their class (those of other scripts: block and category); other characters stay.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7), "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7))
CLASS = {c: (f"{i}*", a) for i, a in enumerate(ALPHABETS) for c in a}


@cache
def other_letters(block: int, category: str) -> tuple[str, str]:
    """Name and members of a class of other letters or digits: those of a block of 256 code points and one category."""
    found = (chr(c) for c in range(block << 8, block + 1 << 8) if not 0xD800 <= c < 0xE000)
    return f"{block}{category}*", "".join(c for c in found if c not in CLASS and unicodedata.category(c) == category)


def class_of(c: str) -> tuple[str, str] | None:
    """Name and members of the class in which a letter or digit is permuted; None for any other character."""
    return CLASS.get(c) or (other_letters(ord(c) >> 8, unicodedata.category(c)) if c.isalnum() else None)


PATTERNS = {
    "email": re.compile(r"[\w.%+-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}(?![A-Za-z0-9])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", re.ASCII),
    "date": re.compile(r"(?<![\d./-])(?:(\d{4})([-/.])(\d{1,2})\2(\d{1,2})|(\d{1,2})([-/.])(\d{1,2})\6(\d{4}))(?!\d|[-/.]\d)", re.ASCII),
    "ssn": re.compile(r"(?<![\d-])(\d{3})-(\d{2})-(\d{4})(?![\d-])", re.ASCII),
    "ip": re.compile(r"(?<![\d.])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\d|\.\d)", re.ASCII),
    "phone": re.compile(r"(?:\+(\d{1,3})[\x20.-]?\(?\d{2,4}\)?(?:[\x20.-]?\d{2,4}){2,4}|(?<![\d+])\(\d{3}\)[\x20.-]?\d{3}[\x20.-]\d{4}"
                        r"|(?<![\d.+-])\d{3}([.-])\d{3}\2\d{4})(?!\d|[.-]\d)", re.ASCII),
    "card": re.compile(r"(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-])", re.ASCII),
}
#: Card numbers as printed, longest first: digits of each group. An undivided run of 13 to 19 digits is read alone.
CARD_GROUPS = ((4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 3, 3, 3))
CARD_REGION = re.compile(r"(?<![\w.-])\d(?:[\x20-]?\d){12,}", re.ASCII)
#: What a card number does not end before.
END = re.compile(r"[\w-]")
US_PHONE = re.compile(r"\+1[\x20.-]\(?\d{3}\)?[\x20.-]\d{3}[\x20.-]\d{4}(?=\x20)", re.ASCII)
#: Length of the IBANs of a country; of others every end at a space is tried.
IBAN_LENGTH = {country: size for size, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 33: "RU",
}.items() for country in countries.split()}
#: Characters of a candidate number at most, and of an address before its @.
LONGEST_NUMBER = 64
LOCAL = re.compile(r"[\w.%+-]")
#: What a text must hold for a pattern to be tried.
DIGITS = re.compile(r"[0-9]")


class Feistel:
    """Keyed permutations of 0 .. n-1 for any n, one for each tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, i: int, half: int, bits: int, tweak: bytes) -> int:
        size = max(1, (bits + 7) // 8)
        data = b"%d|%d|%s|" % (i, bits, tweak) + half.to_bytes(size, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=min(64, size + 8)).digest(), "big") & ((1 << bits) - 1)

    def permute(self, x: int, n: int, tweak: bytes, back: bool = False) -> int:
        if n < 2:
            return x
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:  # cycle walking: fewer than 4 steps on average, as 4 ** bits < 4 * n
            left, right = x >> bits, x & mask
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    left, right = right ^ self._round(i, left, bits, tweak), left
                else:
                    left, right = right, left ^ self._round(i, right, bits, tweak)
            x = left << bits | right
            if x < n:
                return x


def luhn(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _written(like: str, new: str) -> str:
    """``new`` letters and digits in the places that ``like`` has any."""
    it = iter(new)
    return "".join(next(it) if c.isalnum() else c for c in like)


class Pseudonyms:
    def __init__(self, key: bytes, restore: bool = False):
        if not key:
            raise ValueError("pseudonyms need a key")
        self.net, self.back = Feistel(key), restore

    def _digits(self, body: str, tweak: str) -> str:
        return f"{self.net.permute(int(body), 10 ** len(body), tweak.encode(), self.back):0{len(body)}d}" if body else ""

    def _classes(self, text: str, tweak: str) -> str:
        """Permutes the letters and digits of ``text`` as one number in mixed radix."""
        classes = [class_of(c) for c in text]
        x, n, shape = 0, 1, []
        for c, of in zip(text, classes, strict=True):
            shape.append(of[0] if of else c)
            if of:
                x, n = x * len(of[1]) + of[1].index(c), n * len(of[1])
        x = self.net.permute(x, n, (tweak + "|" + "".join(shape)).encode(), self.back)
        out = []
        for c, of in zip(reversed(text), reversed(classes), strict=True):
            if of:
                x, at = divmod(x, len(of[1]))
                c = of[1][at]
            out.append(c)
        return "".join(reversed(out))

    def email(self, m: re.Match) -> str:
        name, _, tld = m[0].rpartition(".")
        local, _, domain = name.partition("@")
        # local part and domain apart: addresses of one host stay together
        return f"{self._classes(local, 'local')}@{self._classes(domain.lower(), 'domain')}.{tld}"

    def iban(self, raw: str) -> str | None:
        plain = raw.replace(" ", "")
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_digits(country, account) != check:
            return None
        new = self._classes(account, "iban" + country)
        return _written(raw, country + iban_digits(country, new) + new)

    def date(self, m: re.Match) -> str | None:
        year, a, b = (m[1], m[3], m[4]) if m[1] else (m[8], m[5], m[7])
        orders = (("month", "day"),) if m[1] else (("day", "month"), ("month", "day"))
        for order in orders:
            part = dict(zip(order, (int(a), int(b)), strict=True))
            try:
                x = datetime.date(int(year), part["month"], part["day"]).toordinal() - FIRST_DAY
            except ValueError:
                continue
            if not 0 <= x < DAYS:
                return None
            new = datetime.date.fromordinal(FIRST_DAY + self._day(x, order == orders[0]))
            wide = len(a) == 2 and len(b) == 2
            own = [f"{getattr(new, k):02d}" if wide else str(getattr(new, k)) for k in order]
            sep = m[2] or m[6]
            return sep.join([f"{new.year:04d}", *own] if m[1] else [*own, f"{new.year:04d}"])
        return None

    def _day(self, x: int, first: bool) -> int:
        # month-first dates are those that day-first can't read: stay among days after the 12th, so that they are read alike again
        while True:
            x = self.net.permute(x, DAYS, b"date", self.back)
            if first or datetime.date.fromordinal(FIRST_DAY + x).day > 12:
                return x

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = int(m[1]), int(m[2]), int(m[3])
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        x = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
        x, serial = divmod(self.net.permute(x, len(areas) * 99 * 9999, b"ssn", self.back), 9999)
        x, group = divmod(x, 99)
        return f"{areas[x]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def ip(self, m: re.Match) -> str | None:
        parts = [int(x) for x in m.groups()]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m.groups()):
            return None
        x = self.net.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, b"ip", self.back)
        return ".".join(map(str, x.to_bytes(4, "big")))

    def phone(self, m: re.Match) -> str | None:
        """A North American number in its printed groups, or the most groups of at most 15 digits."""
        digits = "".join(c for c in m[0] if c.isdigit())
        code = m[1] or ""
        if not 10 <= len(digits) <= 15 or code[:1] == "0":
            return None
        return _written(m[0], code + self._digits(digits[len(code):], "phone" + code))

    def card(self, raw: str) -> str | None:
        digits = "".join(c for c in raw if c.isdigit())
        if not luhn(digits) or len(set(digits)) == 1:
            return None
        new = digits[0] + self._digits(digits[1:-1], "card" + digits[0])
        return _written(raw, new + luhn_digit(new))

    def replace(self, text: str | None) -> tuple[str | None, list[str]]:
        """The text with pseudonyms, and the kinds replaced, in order.

        Kinds are tried in the order of ``KINDS``; a match that overlaps an
        earlier kind's is skipped, a failed validation frees its characters.
        """
        if not text or not DIGITS.search(text) and "@" not in text:
            return text, []
        found: list[tuple[int, int, str, str]] = []  # disjoint, in order
        for kind in KINDS:
            if kind == "email" and "@" not in text:
                continue
            if kind in ("iban", "card"):
                self._numbers(text, kind, found)
                continue
            at = 0
            while m := _email(text, at) if kind == "email" else PATTERNS[kind].search(text, at):
                if kind == "phone":
                    m = self._phone_end(text, m)
                new = getattr(self, kind)(m)
                at = m.end() if new is not None else m.start() + 1
                if new is not None and _free(found, m.start(), m.end()):
                    insort(found, (m.start(), m.end(), kind, new))
        out, at = [], 0
        for s, e, _, new in found:
            out += [text[at:s], new]
            at = e
        return ("".join([*out, text[at:]]) if out else text), [k for _, _, k, _ in found]

    def _phone_end(self, text: str, m: re.Match) -> re.Match:
        """The match cut at a space, where it holds a number and more."""
        if m[0][0] == "+":
            if us := US_PHONE.match(text, m.start()):
                return PATTERNS["phone"].match(text, m.start(), us.end()) or m
            while sum(c.isdigit() for c in m[0]) > 15 and (end := m[0].rfind(" ")) > 0:
                shorter = PATTERNS["phone"].match(text, m.start(), m.start() + end)
                if not shorter:
                    break
                m = shorter
        return m

    def _numbers(self, text: str, kind: str, found: list) -> None:
        """Adds the spans of ``text`` that validate, among all candidates in their order."""
        make, tried = getattr(self, kind), []
        for s, e in (iban_candidates if kind == "iban" else card_candidates)(text):
            if not _free(found, s, e):
                continue
            new = make(text[s:e])
            if new is None:
                insort(tried, (s, e))
                continue
            near = [(x, y) for x, y in tried[bisect_left(tried, (s - LONGEST_NUMBER, 0)):bisect_left(tried, (e, 0))] if s < y]
            low, high = min([s, *(x for x, _ in near)]), max([e, *(y for _, y in near)])
            # cycle walking: what failed before must fail beside the pseudonym too
            while any(make((text[low:s] + new + text[e:high])[x - low:y - low]) is not None for x, y in near):
                new = make(new)
            insort(found, (s, e, kind, new))


def _free(found: list[tuple], start: int, end: int) -> bool:
    """Whether no span of a sorted disjoint list overlaps [start, end)."""
    at = bisect_right(found, start, key=lambda x: x[0])
    return (not at or found[at - 1][1] <= start) and (at == len(found) or found[at][0] >= end)


def _email(text: str, at: int) -> re.Match | None:
    """The next address: from each @ back over the local part, so a long run of letters is read once."""
    while (sign := text.find("@", at)) >= 0:
        start = sign
        while start > at and LOCAL.match(text[start - 1]):
            start -= 1
        if m := PATTERNS["email"].match(text, start):
            return m
        at = sign + 1
    return None


def iban_candidates(text: str) -> Iterator[tuple[int, int]]:
    """Spans that may be IBANs: the country's length, then ends at spaces, longest first."""
    at = 0
    while m := PATTERNS["iban"].search(text, at):
        at = m.start() + 1
        places = [m.start() + i for i, c in enumerate(m[0]) if c != " "]
        size = IBAN_LENGTH.get(m[0][:2], 0)
        fixed = places[size - 1] + 1 if 0 < size <= len(places) else 0
        ends = [m.end(), *(m.start() + i for i in range(len(m[0]) - 1, 14, -1) if m[0][i] == " ")]
        if fixed in ends:
            yield m.start(), fixed
        for e in ends if not size else ends[:1]:
            if e != fixed:
                yield m.start(), e


def card_candidates(text: str) -> Iterator[tuple[int, int]]:
    """Spans that may be card numbers: printed groups and undivided runs from left to right, then any 13 to 19 digits."""
    for region in CARD_REGION.finditer(text):
        groups = [(region.start() + g.start(), region.start() + g.end()) for g in re.finditer("[0-9]+", region[0])]
        for i, (s, e) in enumerate(groups):
            if 13 <= e - s <= 19 and (e < region.end() or not END.match(text, e)):
                yield s, e
            if i and text[s - 1] == "-":
                continue
            for shape in CARD_GROUPS:
                if tuple(y - x for x, y in groups[i:i + len(shape)]) == shape and not END.match(text, end := groups[i + len(shape) - 1][1]):
                    yield s, end
    at = 0
    while m := PATTERNS["card"].search(text, at):
        yield m.span()
        at = m.end()


def pseudonymise(docs: DataFrame, key: str, restore: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms and the array ``kinds`` of what was replaced, in order."""
    secret = key.encode()

    def run(ids: list, text: list) -> list:
        names = Pseudonyms(secret, restore)
        done = [names.replace(t) for t in text]
        return [ids, [t for t, _ in done], [k for _, k in done]]

    return map_columns(docs.select("doc_id", "text"), run,
                       f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, kinds array<string>")


def counted(done: DataFrame) -> DataFrame:
    """One row per document: text and a count for each kind."""
    def of(kind: str) -> F.Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return done.select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), *map(of, KINDS))
