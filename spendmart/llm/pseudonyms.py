"""Format-preserving pseudonyms for personal data.

Emails, IBANs, IPv4 addresses, dates, social security numbers, payment cards and phone numbers are
found in whole texts and validated. A keyed Feistel network permutes each value among the values of
its own format: cards keep a right check digit, dates stay real dates, layouts and lengths of digit
groups stay. Equal values get equal pseudonyms in every document, and whoever holds the key can
invert the permutation.

A value of more than ``BLOCK`` letters and digits is permuted in blocks of that size, chained forth
and back: each block's permutation depends on all blocks before it, then on all after it. So every
character moves, equal values stay equal, time is linear, and the key still inverts it.

Defined results: null stays null, empty stays empty, a text without personal data is returned
unchanged; an empty table gives an empty result; texts and values of any length are treated whole;
repeated rows get equal results; where patterns tie, an email goes first, then the kinds in the order
of ``KINDS``; numbers that fail validation are left alone. All columns of the input come back; only
the text's changes, and a column of the name given for ``counts`` is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import free_name

KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")
ROUNDS = 8
#: Letters and digits permuted at once: halves of half as many stay far below the 24 bytes of a hash.
BLOCK = 48
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_CLASS = {c: alphabet for alphabet in (LOWER, UPPER, DIGITS) for c in alphabet}
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
_TYPE = "struct<text:string," + ",".join(f"n_{k}:bigint" for k in KINDS) + ">"


class Feistel:
    """A keyed permutation of pairs (l, r) with l below ``left`` and r below ``right``.

    Rounds add a hash of one half to the other half modulo its size, so any sizes will do.
    """

    def __init__(self, key: bytes, kind: str, left: int, right: int):
        self.left, self.right = left, right
        self.base = hashlib.blake2b(f"{kind}:{left}:{right}:".encode(), key=key[:64], digest_size=24)

    def _hash(self, step: int, value: int, tweak: bytes) -> int:
        h = self.base.copy()
        h.update(f"{step}:{value}".encode() + tweak)
        return int.from_bytes(h.digest(), "little")

    def forward(self, l: int, r: int, tweak: bytes = b"") -> tuple[int, int]:  # noqa: E741
        for step in range(ROUNDS):
            if step % 2:
                r = (r + self._hash(step, l, tweak)) % self.right
            else:
                l = (l + self._hash(step, r, tweak)) % self.left  # noqa: E741
        return l, r

    def backward(self, l: int, r: int, tweak: bytes = b"") -> tuple[int, int]:  # noqa: E741
        for step in reversed(range(ROUNDS)):
            if step % 2:
                r = (r - self._hash(step, l, tweak)) % self.right
            else:
                l = (l - self._hash(step, r, tweak)) % self.left  # noqa: E741
        return l, r


class Permuter:
    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.inverse = key, inverse
        self._network = lru_cache(4096)(lambda kind, left, right: Feistel(key, kind, left, right))

    def pair(self, kind: str, left: int, right: int, l: int, r: int, tweak: bytes = b"") -> tuple[int, int]:  # noqa: E741
        network = self._network(kind, left, right)
        return network.backward(l, r, tweak) if self.inverse else network.forward(l, r, tweak)

    def _permute(self, kind: str, out: list[str], places: list[int], tweak: bytes = b"") -> None:
        """Permute the characters at ``places``, each within its class."""
        half = len(places) // 2
        halves = places[:half], places[half:]
        sizes, numbers = [1, 1], [0, 0]
        for side, at in enumerate(halves):
            for i in at:
                alphabet = _CLASS[out[i]]
                sizes[side] *= len(alphabet)
                numbers[side] = numbers[side] * len(alphabet) + alphabet.index(out[i])
        numbers = list(self.pair(kind, sizes[0], sizes[1], numbers[0], numbers[1], tweak))
        for side, at in enumerate(halves):
            for i in reversed(at):
                alphabet = _CLASS[out[i]]
                numbers[side], digit = divmod(numbers[side], len(alphabet))
                out[i] = alphabet[digit]

    def _chained(self, kind: str, out: list[str], places: list[int]) -> None:
        """The same in blocks, once forth and once back; a block's tweak hashes the blocks before it."""
        n = -(-len(places) // BLOCK)
        blocks = [places[len(places) * i // n : len(places) * (i + 1) // n] for i in range(n)]
        passes = [("forth", blocks), ("back", blocks[::-1])]
        for name, ordered in passes[::-1] if self.inverse else passes:
            seen = hashlib.blake2b(f"{kind}:{name}:{len(places)}:".encode(), key=self.key[:64], digest_size=16)
            for block in ordered:
                before = "".join(out[i] for i in block)
                self._permute(kind, out, block, seen.digest())
                # what the pass makes of a block: when it is undone, that is what was there before
                seen.update((before if self.inverse else "".join(out[i] for i in block)).encode())

    def characters(self, kind: str, value: str, valid: Callable[[str], bool] = lambda _: True) -> str:
        """Permute letters and digits, each within its class; go on until ``valid`` holds again.

        ``value`` itself must be valid: going on then ends, at ``value`` at the latest.
        """
        places = [i for i, c in enumerate(value) if c in _CLASS]
        permute = self._chained if len(places) > BLOCK else self._permute
        out = list(value)
        while True:
            permute(kind, out, places)
            if valid("".join(out)):
                return "".join(out)

    def number(self, kind: str, size: int, value: int) -> int:
        """Permute the numbers below ``size`` (at most 2^32)."""
        while True:
            l, r = self.pair(kind, 1 << 16, (size >> 16) + 1, value & 0xFFFF, value >> 16)  # noqa: E741
            value = r << 16 | l
            if value < size:
                return value


def luhn_digit(digits: str) -> str:
    """The check digit to append."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _onto(layout: str, digits: str) -> str:
    """``digits`` in place of the digits of ``layout``."""
    left = iter(digits)
    return "".join(next(left) if c in DIGITS else c for c in layout)


def _digits(value: str) -> str:
    return "".join(c for c in value if c in DIGITS)


def _card(value: str, p: Permuter) -> str | None:
    digits = _digits(value)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = p.characters("card", digits[:-1], lambda s: len(set(s + luhn_digit(s))) > 1)
    return _onto(value, body + luhn_digit(body))


def _phone(value: str, p: Permuter) -> str | None:
    digits = _digits(value)
    if not 7 <= len(digits) <= 15:
        return None
    lead = re.match(r"\+(\d{1,3})(?=\D)", value)
    code = lead[1] if lead else ""
    body = digits[len(code) :]
    if len(body) < 7:
        return None
    # numbers whose area code starts with 2 to 9 go to numbers that do so too
    area = (lambda s: s[0] in "23456789") if body[0] in "23456789" else (lambda s: s[0] in "01")
    return _onto(value, code + p.characters("phone", body, area))


def _ssn_valid(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def _ssn(value: str, p: Permuter) -> str | None:
    digits = _digits(value)
    return _onto(value, p.characters("ssn", digits, _ssn_valid)) if _ssn_valid(digits) else None


def _ip(value: str, p: Permuter) -> str | None:
    parts = [int(x) for x in value.split(".")]
    if max(parts) > 255 or any(x != str(int(x)) for x in value.split(".")):
        return None
    n = p.number("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
    return ".".join(map(str, n.to_bytes(4, "big")))


def _day(year: str, month: str, day: str) -> date | None:
    try:
        found = date(int(year), int(month), int(day))
    except ValueError:
        return None
    return found if FIRST_DAY <= found <= LAST_DAY else None


_DATE_PARTS = re.compile(r"(\d+)(\D)(\d+)\D(\d+)")


def _date(value: str, p: Permuter) -> str | None:
    a, mark, b, c = _DATE_PARTS.fullmatch(value).groups()  # type: ignore[union-attr]
    if len(a) == 4:
        order = (0, 1, 2)
    elif mark == "/" and int(a) <= 12:
        order = (2, 0, 1)
    else:
        order = (2, 1, 0)
    parts = (a, b, c)
    found = _day(*(parts[i] for i in order))
    if found is None:
        return None
    # dates written without leading zeros, and months that could be days, go to dates of the same kind
    padded = len(a) + len(b) + len(c) == 8
    ambiguous = mark == "/" and len(a) != 4 and order == (2, 1, 0)
    size = (LAST_DAY - FIRST_DAY).days + 1
    n = (found - FIRST_DAY).days
    while True:
        n = p.number("date", size, n)
        new = FIRST_DAY + timedelta(n)
        three = [str(new.year), f"{new.month:02d}" if padded else str(new.month), f"{new.day:02d}" if padded else str(new.day)]
        if (padded or len("".join(three)) < 8) and (not ambiguous or new.day > 12):
            out = [""] * 3
            for place, text in zip(order, three):
                out[place] = text
            return mark.join(out)


def _iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _iban(value: str, p: Permuter) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
        return None
    body = p.characters("iban", plain[4:])
    check = 98 - _iban_rest(plain[:2] + "00" + body)
    new = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(new) for c in value)


def _email(value: str, p: Permuter) -> str | None:
    local, _, domain = value.rpartition("@")
    name, dot, top = domain.rpartition(".")
    return p.characters("email", local) + "@" + p.characters("host", name) + dot + top


_HANDLERS = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
_AT = re.compile(r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
_NUMBERS = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))"
    r"|(?P<date>(?<![0-9])(?:[0-9]{4}([-/.])[0-9]{1,2}\4[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\5[0-9]{4})(?![0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<card>(?<![0-9+])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\8[0-9]{4}\8[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9]))"
    r"|(?P<phone>(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,5}\)?){2,5}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]))"
)
_DIGIT = re.compile(r"[0-9]")


def pseudonymize(text: str | None, permuter: Permuter) -> tuple[str | None, Counter]:
    """The text with its personal data permuted, and how many of each kind were found."""
    found: Counter = Counter()
    if not text:
        return text, found

    def replace(m: re.Match) -> str:
        kind = m.lastgroup
        new = _HANDLERS[kind](m[0], permuter)
        if new is None:
            return m[0]
        found[kind] += 1
        return new

    if "@" in text:
        text = _AT.sub(replace, text)
    if _DIGIT.search(text):
        text = _NUMBERS.sub(replace, text)
    return text, found


def pseudonym_column(text: Column, key: bytes, inverse: bool = False) -> Column:
    """A struct: text, then the number of values of each kind."""

    def rewrite(texts: pa.Array) -> pa.Array:
        permuter = Permuter(key, inverse)
        rows = [pseudonymize(t, permuter) for t in texts.to_pylist()]
        counts = [pa.array([found[k] for _, found in rows], pa.int64()) for k in KINDS]
        return pa.StructArray.from_arrays(
            [pa.array([t for t, _ in rows], pa.string()), *counts], names=["text", *(f"n_{k}" for k in KINDS)]
        )

    return F.arrow_udf(rewrite, _TYPE)(text.cast("string"))


def with_pseudonyms(docs: DataFrame, key: bytes, *, text_col: str = "text", counts: str | None = None) -> DataFrame:
    """``docs`` with personal data of ``text_col`` permuted; ``counts`` names a struct of counts to add."""
    made = free_name(docs, "_pseudonyms")
    out = docs.withColumn(made, pseudonym_column(F.col(text_col), key)).withColumn(text_col, F.col(made)["text"])
    if counts:
        out = out.withColumn(counts, F.struct(*(F.col(made)[f"n_{k}"].alias(f"n_{k}") for k in KINDS)))
    return out.drop(made)
