"""Format-preserving pseudonyms for personal data.

A value found in a text is checked (see ``KINDS``), read as a number below the size of its format, permuted among the
numbers of that format by a keyed Feistel network, and written back in the same format and at the same place. Equal
values thus get equal pseudonyms in all documents, whatever separators they are written with; a pseudonym passes the
same check as its value; and who has the key can undo it (``restore``). A date has one pseudonym in all its notations.

One exception: where digits before a value look like the start of a longer value that fails its check, as in an order
number before a card number, a pseudonym with which the longer one would pass is permuted again. Else it couldn't be
told where the value begins, and ``restore`` would fail. There the value has another pseudonym than elsewhere.

The Feistel network works on two halves whose sizes multiply to at least the size of the format; numbers beyond that
size are permuted again until they fall below it. With the network P, a value x becomes P^-1(P(x) + 1), so that no
value is its own pseudonym.

What is found: card numbers (13 to 19 digits, valid check digit), IBANs (valid check digits), US social security
numbers, telephone numbers with a country code or in brackets, IPv4 addresses, calendar dates from 1900 to 2099 in
four notations (with slashes month first, or day first where the first number is no month), also with fields of one digit,
the local parts of e-mail addresses, and hexadecimal credentials that are named as such. Other numbers
are left alone, so a text without such values comes back as it was. An international number ends where its country's
plan has it end or, without one, where another style of number follows. What fails its check is searched from inside.

Defined cases: a null text stays null and an empty one empty; both hold no value. Rows with a null id and repeated rows
are treated like all others. Whole texts are searched. Other columns pass through unread.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdrift.llm.common import small_batches, table

ROUNDS = 8
#: Where a session keeps the key. Set it to link values across sessions, or to restore them in another one.
KEY_SETTING = "spark.rankdrift.pseudonym.key"


class Feistel:
    """Keyed permutations of the numbers below any size."""

    def __init__(self, key: str):
        self._key = hashlib.blake2b(key.encode()).digest()

    def _round(self, kind: str, size: int, k: int, half: int, below: int) -> int:
        data = f"{kind}|{size}|{k}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self._key, digest_size=32).digest()) % below

    def _permuted(self, kind: str, size: int, x: int, back: bool) -> int:
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        sign = -1 if back else 1
        while True:
            left, right = divmod(x, b)
            for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if k % 2:
                    right = (right + sign * self._round(kind, size, k, left, b)) % b
                else:
                    left = (left + sign * self._round(kind, size, k, right, a)) % a
            x = left * b + right
            if x < size:
                return x

    def swap(self, kind: str, size: int, x: int, back: bool = False) -> int:
        """The pseudonym of ``x`` among the numbers below ``size``; with ``back``, the number of the pseudonym ``x``."""
        if size < 2:
            return x
        y = (self._permuted(kind, size, x, False) + (-1 if back else 1)) % size
        return self._permuted(kind, size, y, True)


Swap = Callable[[str, int, int], int]


def _same_places(pattern: str, digits: str) -> str:
    """``pattern`` with its ASCII digits replaced by ``digits``, in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in pattern)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def _check_digit(digits: str) -> str:
    """The last digit that makes a card number of ``digits`` and it valid."""
    doubled = [int(d) * (2 - k % 2) for k, d in enumerate(reversed(digits))]
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def _swapped_digits(kind: str, digits: str, swap: Swap) -> str:
    return str(swap(kind, 10 ** len(digits), int(digits))).zfill(len(digits))


def _card(value: str, swap: Swap) -> str | None:
    digits = _digits(value)
    if _check_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    new = _swapped_digits("card", digits[:-1], lambda k, n, x: _skip_equal_digits(k, n, x, len(digits) - 1, swap))
    return _same_places(value, new + _check_digit(new))


def _skip_equal_digits(kind: str, size: int, x: int, n: int, swap: Swap) -> int:
    """Swaps until the whole number isn't one digit repeated, which is no valid card number."""
    while True:
        x = swap(kind, size, x)
        digits = str(x).zfill(n)
        if len(set(digits + _check_digit(digits))) > 1:
            return x


def _iban(value: str, swap: Swap) -> str | None:
    plain = value.replace(" ", "")
    numeric = lambda text: int("".join(str(int(c, 36)) for c in text))
    if not 15 <= len(plain) <= 34 or numeric(plain[4:] + plain[:4]) % 97 != 1:
        return None
    account = _spelled("iban", plain[4:], swap)
    check = f"{98 - numeric(account + plain[:2] + '00') % 97:02d}"
    new = iter(plain[:2] + check + account)
    return "".join(c if c == " " else next(new) for c in value)


def _ssn(value: str, swap: Swap) -> str | None:
    area, group, serial = (int(x) for x in value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    n = swap("ssn", len(areas) * 99 * 9999, (areas.index(area) * 99 + group - 1) * 9999 + serial - 1)
    n, serial = divmod(n, 9999)
    return f"{areas[n // 99]:03d}-{n % 99 + 1:02d}-{serial + 1:04d}"


#: Digits after a country code, where the numbering plan fixes them.
_PLANS = {"1": (10,), "7": (10,), "20": (8, 9, 10), "27": (9,), "30": (10,), "31": (9,), "32": (8, 9), "33": (9,), "34": (9,), "36": (8, 9)}
_PLANS |= {"40": (9,), "41": (9,), "44": (9, 10), "45": (8,), "46": (7, 8, 9), "47": (8,), "48": (9,), "49": (7, 8, 9, 10, 11)}
_PLANS |= {"51": (8, 9), "52": (10,), "54": (10, 11), "55": (10, 11), "56": (9,), "57": (10,), "61": (9,), "65": (8,), "81": (9, 10)}
_PLANS |= {"86": (10, 11), "90": (10,), "91": (10,), "351": (9,), "353": (7, 8, 9), "380": (9,), "420": (9,), "421": (9,)}
#: What a number in blocks parted by spaces doesn't go on with: other marks, or the form of a card number.
_NEW_STYLE = re.compile(r" (?:\d+[.,/:-]\d|\d{13}|\d{4} \d{4} \d{4} \d|\d{4} \d{6} \d{5}(?!\d))")
_PHONE_PART = re.compile(r"([ .-]?)(\(\d{1,4}\)|\d+)")


def _phone_end(text: str, start: int) -> int | None:
    """Where the international number at ``start`` ends. Digits count, but not which they are, so a pseudonym ends there too."""
    code = re.compile(r"\+(\d{1,3})(?=\D)").match(text, start)
    at, n, bracket, marks = code.end() if code else start + 1, 0, 0, set()
    ends, inner = [], []
    while n <= 14 and (part := _PHONE_PART.match(text, at)):
        mark, run = part[1], _digits(part[2])
        if part[2][0] == "(":
            if n or bracket or not code:
                break
            bracket = len(run)
        elif len(run) < 2:
            break
        elif n > bracket:
            marks.add(mark)
        n, at = n + len(run), part.end()
        if not 7 <= n <= 14 or re.compile(r"\w|-\d").match(text, at):
            continue
        following = _PHONE_PART.match(text, at)
        (inner if following and following[1] == "." and len(_digits(following[2])) > 1 else ends).append((n, at, marks - {" "}))
    plan = _PLANS.get(code[1], ()) if code else ()
    ends = ends or inner[-1:]
    # A single digit in brackets may be a trunk prefix, which is no part of the number.
    ends = [e for e in ends if e[0] in plan or bracket == 1 and e[0] - 1 in plan] or ends
    for _, at, other_marks in ends:
        if other_marks or _NEW_STYLE.match(text, at):
            return at
    return ends[-1][1] if ends else None


def _phone(value: str, swap: Swap) -> str | None:
    code = re.match(r"\+\d{1,3}(?=[^\d])", value)
    rest = value[code.end() :] if code else value
    digits = _digits(rest)
    if not 7 <= len(digits) <= 14:
        return None
    # Country codes without a plus have no place of their own, so all of these numbers are one format.
    return (code[0] if code else "") + _same_places(rest, _swapped_digits("phone", digits, swap))


def _ipv4(value: str, swap: Swap) -> str | None:
    octets = value.split(".")
    if any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in octets):
        return None
    n = swap("ipv4", 1 << 32, int.from_bytes(bytes(map(int, octets))))
    return ".".join(map(str, n.to_bytes(4)))


_FIRST, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


#: A date is permuted among those whose day and month lie in the same of these ranges, so that every notation that can
#: write the date can write its pseudonym: with fields of one digit, and with the day first where no month can be meant.
_DAY_RANGES, _MONTH_RANGES = (range(1, 10), range(10, 13), range(13, 32)), (range(1, 10), range(10, 13))


@lru_cache(None)
def _days_of(days: range, months: range) -> list[int]:
    """The days since the first one of which day and month are in these ranges."""
    dates = (_FIRST + timedelta(n) for n in range(_DAYS))
    return [n for n, d in enumerate(dates) if d.day in days and d.month in months]


def _date(value: str, swap: Swap) -> str | None:
    a, mark, b, c = re.match(r"(\d+)([-/.])(\d+)[-/.](\d+)", value).groups()
    year_first = len(a) == 4
    year, x, y = (a, b, c) if year_first else (c, a, b)
    # With slashes the month comes first, as in the US, unless there is no such month; with dots, the day.
    swapped = not year_first and mark == "/" and int(x) > 12
    month, day = (x, y) if (year_first or mark != ".") and not swapped else (y, x)
    try:
        meant = date(int(year), int(month), int(day))
    except ValueError:
        return None
    if not 0 <= (n := (meant - _FIRST).days) < _DAYS:
        return None
    days_in = next(r for r in _DAY_RANGES if meant.day in r)
    months_in = next(r for r in _MONTH_RANGES if meant.month in r)
    among = _days_of(days_in, months_in)
    new = _FIRST + timedelta(among[swap(f"date{days_in}{months_in}", len(among), bisect_left(among, n))])
    month, day = f"{new.month:0{len(month)}d}", f"{new.day:0{len(day)}d}"
    if year_first:
        return f"{new.year}{mark}{month}{mark}{day}"
    x, y = (month, day) if mark != "." and not swapped else (day, month)
    return f"{x}{mark}{y}{mark}{new.year}"


#: Letters that are permuted among themselves: digits, a to z, and the small letters of Latin-1 that have capitals there.
_ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, [*range(0xE0, 0xF7), *range(0xF8, 0xFF)]))]
_PLACE = {c: (alphabet, k) for alphabet in _ALPHABETS for k, c in enumerate(alphabet)}


def _spelled(kind: str, value: str, swap: Swap) -> str:
    """``value`` with each letter and digit replaced by one of its alphabet and case; other characters stay."""
    places = [_PLACE.get(c.lower()) if len(c.lower()) == 1 else None for c in value]
    size, n = 1, 0
    for place in places:
        if place:
            size, n = size * len(place[0]), n * len(place[0]) + place[1]
    n = swap(f"{kind}{[len(p[0]) if p else c for p, c in zip(places, value, strict=True)]}", size, n)
    out = []
    for c, place in zip(reversed(value), reversed(places), strict=True):
        if place:
            n, k = divmod(n, len(place[0]))
            c = place[0][k].upper() if c.isupper() else place[0][k]
        out.append(c)
    return "".join(reversed(out))


def _email(value: str, swap: Swap) -> str | None:
    local, _, domain = value.partition("@")
    return f"{_spelled('email', local, swap)}@{domain}"


def _credential(value: str, swap: Swap) -> str | None:
    start = re.search(r"[0-9A-Fa-f]+[\"']?$", value).start()
    number = value[start:].rstrip("\"'")
    new = f"{swap('credential', 16 ** len(number), int(number, 16)):0{len(number)}x}"
    return value[:start] + (new.upper() if number.upper() == number else new) + value[start + len(number) :]


#: Kinds in the order in which they are tried at a place, with the form in which each is found.
KINDS = {
    "email": (r"(?<![\w.+-])[\w.+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", _email),
    "credential": (
        r"(?i:\b(?:token|secret|password|api[_-]?key|key)\b)[\"']?\s{0,3}[=:]\s{0,3}[\"']?(?:[0-9a-f]{16,128}|[0-9A-F]{16,128})\b[\"']?",
        _credential,
    ),
    "iban": (r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b", _iban),
    "date": (
        r"(?<![\w./-])(?:\d{4}([-/])\d{1,2}\1\d{1,2}|\d{1,2}([/.])\d{1,2}\2\d{4})(?=T\d{2}|(?![\w/-]|\.\d))",
        _date,
    ),
    "ssn": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    "ipv4": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", _ipv4),
    "card": (
        r"(?<![\w+-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])",
        _card,
    ),
    "phone": (
        # An international number ends at _phone_end.
        r"(?<![\w+])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2}|(?:\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4})(?!\w|-\d))",
        _phone,
    ),
}
_GROUPS = list(KINDS)


def _numbered(pattern: str, by: int) -> str:
    return re.sub(r"\\([12])", lambda m: f"\\{int(m[1]) + by}", pattern)


def _pattern() -> re.Pattern:
    parts, groups = [], 0
    for name, (form, _) in KINDS.items():
        parts.append(f"(?P<{name}>{_numbered(form, groups + 1)})")
        groups += 1 + re.compile(form).groups
    return re.compile("|".join(parts))


_FORMS, _HINT = _pattern(), re.compile(r"[0-9@]")
_FORM = {name: re.compile(form) for name, (form, _) in KINDS.items()}


def _found_at(kind: str, text: str, start: int) -> str | None:
    """The value of a form at a place, checked or not."""
    match = _FORM[kind].match(text, start)
    if match and kind == "phone" and text[start] == "+":
        end = _phone_end(text, start)
        return text[start:end] if end else None
    return match[0] if match else None


class Pseudonymiser:
    def __init__(self, key: str):
        self._swap, self._known = Feistel(key).swap, {}

    def _swapped(self, kind: str, value: str, back: bool) -> str | None:
        if (kind, value, back) not in self._known:
            if len(self._known) >= 100_000:
                self._known.clear()
            new = KINDS[kind][1](value, lambda name, size, x: self._swap(name, size, x, back))
            self._known[kind, value, back] = new
        return self._known[kind, value, back]

    def _passes(self, kind: str, text: str, start: int) -> bool:
        value = _found_at(kind, text, start)
        return value is not None and self._swapped(kind, value, False) is not None

    def replace(self, text: str | None, back: bool = False) -> tuple[str | None, int]:
        """The text with pseudonyms for its values, and how many were replaced."""
        if not text or not _HINT.search(text):
            return text, 0
        out, done, at, replaced = [], 0, 0, 0
        failed: list[tuple[str, int, int]] = []  # forms whose check failed, which are searched from inside
        while match := _FORMS.search(text, at):
            start = match.start()
            first = next(k for k, kind in enumerate(_GROUPS) if match[kind] is not None)
            failed = [f for f in failed if f[2] > start]
            for kind in _GROUPS[first:]:
                if (value := _found_at(kind, text, start)) is None:
                    continue
                if (new := self._swapped(kind, value, back)) is not None:
                    break
                failed.append((kind, start, start + len(value)))
            else:
                at = start + 1
                continue
            end = start + len(value)
            if failed:
                # What failed must fail with the pseudonym too, or the value couldn't be found again.
                low = min(f[1] for f in failed)
                tail = text[end : end + 60]
                while any(self._passes(k, text[max(0, low - 1) : start] + new + tail, s - max(0, low - 1)) for k, s, _ in failed):
                    new = self._swapped(kind, new, back)
            out += text[done:start], new
            replaced += new != value
            at = done = end
        return "".join([*out, text[done:]]), replaced


def key_of(spark: SparkSession) -> str:
    """The session's key. Without a setting one is drawn at random and kept in the session."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def _udf(key: str, back: bool):
    @F.pandas_udf("struct<text: string, n_values: int>")
    def replaced(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pseudonymiser = Pseudonymiser(key)
        for column in texts:
            yield pd.DataFrame([pseudonymiser.replace(t, back) for t in column], columns=["text", "n_values"])

    return replaced


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", count: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in its texts; with ``count``, also a column of that name with the number of values."""
    small_batches(docs.sparkSession)
    found = "_pseudonymised" + "_" * max(map(len, docs.columns))  # no column's name
    out = docs.withColumn(found, _udf(key, back)(F.col(text_col).cast("string")))
    out = out.withColumn(text_col, F.col(f"{found}.text"))
    if count:
        out = out.withColumn(count, F.col(f"{found}.n_values"))
    return out.drop(found)


def restore(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The values again, from texts that were pseudonymised with the same key."""
    return pseudonymised(docs, key, text_col, back=True)


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(docs, key_of(spark), count="n_values")
