"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation.

Numbers and dates are found by their form and checked (checksum, range, calendar); the value that is free to
vary is then permuted among all values of the same format by a Feistel network under a secret key. Equal
values get equal pseudonyms in all documents, different values different ones, and whoever has the key can
go back. Separators, lengths, letter case, country codes and domains stay as they are.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Digits or letters of one value that are permuted as a single number; more are permuted in two halves.
LONG = 64
DIGITS, LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Dates are permuted among all days from the first to the last.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)


@lru_cache(maxsize=20_000)
def permuted(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A permutation of 0 … size - 1 chosen by key and tweak, or its inverse.

    Pairs of digits to the base ``side`` go through ``ROUNDS`` rounds; a result of ``size`` or more goes through again,
    which ends because the rounds permute the slightly larger square.
    """
    side = math.isqrt(size - 1) + 1
    width = (side.bit_length() + 7) // 8 + 16
    while True:
        left, right = divmod(value, side)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            known = left if back else right
            mixed = hashlib.shake_256(key + f"|{tweak}|{size}|{i}|{known}".encode()).digest(width)
            noise = int.from_bytes(mixed, "big")
            left, right = ((right - noise) % side, left) if back else (right, (left + noise) % side)
        value = left * side + right
        if value < size:
            return value


def permuted_symbols(values: bytes, radix: int, key: bytes, tweak: str, back: bool = False) -> bytes:
    """A permutation of all sequences of numbers below ``radix``, for sequences of any length, or its inverse.

    The two halves of the sequence take turns: to each number of one half, noise from a hash of the other is added
    modulo ``radix``. Time and memory grow with the length.
    """
    half = len(values) // 2
    parts = [np.frombuffer(values[:half], dtype=np.uint8).astype(np.int64), np.frombuffer(values[half:], dtype=np.uint8).astype(np.int64)]
    head = key + f"|{tweak}|{radix}|{len(values)}|".encode()
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        changed, known = parts[i % 2], parts[1 - i % 2].astype(np.uint8).tobytes()
        noise = np.frombuffer(hashlib.shake_256(head + f"{i}|".encode() + known).digest(2 * len(changed)), dtype="<u2").astype(np.int64)
        parts[i % 2] = (changed - noise if back else changed + noise) % radix
    return np.concatenate(parts).astype(np.uint8).tobytes()


class Pseudonymizer:
    """Replaces values in texts under one key. ``back`` turns pseudonyms into the values again."""

    def __init__(self, key: bytes, back: bool = False):
        if not key:
            raise ValueError("pseudonyms need a key")
        self.key, self.back = key, back

    def _permuted(self, value: int, size: int, tweak: str) -> int:
        return permuted(value, size, self.key, tweak, self.back)

    def symbols(self, text: str, kind: str, alphabets: tuple[str, ...] = (DIGITS, LETTERS)) -> str:
        """All digits of a text permuted among digits and all letters among letters; case and all else stays."""
        out = list(text)
        for alphabet in alphabets:
            at = [i for i, c in enumerate(out) if c.lower() in alphabet and c.isascii()]
            if len(at) > LONG:
                values = bytes(alphabet.index(out[i].lower()) for i in at)
                for i, digit in zip(at, permuted_symbols(values, len(alphabet), self.key, kind, self.back)):
                    out[i] = alphabet[digit].upper() if out[i].isupper() else alphabet[digit]
            elif at:
                value = 0
                for i in at:
                    value = value * len(alphabet) + alphabet.index(out[i].lower())
                value = self._permuted(value, len(alphabet) ** len(at), f"{kind}{len(alphabet)}")
                for i in reversed(at):
                    value, digit = divmod(value, len(alphabet))
                    out[i] = alphabet[digit].upper() if out[i].isupper() else alphabet[digit]
        return "".join(out)

    def _refilled(self, form: str, digits: str) -> str:
        found = iter(digits)
        return "".join(next(found) if c.isdigit() else c for c in form)

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]):
            return None
        n = len(digits) - 1
        payload = f"{self._permuted(int(digits[:-1]), 10**n, 'card'):0{n}d}"
        return self._refilled(text, payload + str(luhn(payload)))

    def phone(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 8 <= len(digits) <= 15:
            return None
        country = re.match(r"\+\d{1,3}(?=\D)|", text).group()
        rest = re.sub(r"\D", "", text[len(country) :])
        return country + self._refilled(text[len(country) :], f"{self._permuted(int(rest), 10 ** len(rest), 'phone'):0{len(rest)}d}")

    def address(self, text: str) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255 or any(x != str(int(x)) for x in text.split(".")):
            return None
        value = self._permuted(int.from_bytes(bytes(octets), "big"), 1 << 32, "address")
        return ".".join(map(str, value.to_bytes(4, "big")))

    def social(self, text: str) -> str | None:
        area, group, serial = (int(x) for x in text.split("-"))
        areas = [a for a in range(1, 900) if a != 666]
        if area not in areas or not group or not serial:
            return None
        value = self._permuted((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "social")
        value, serial = divmod(value, 9999)
        return f"{areas[value // 99]:03d}-{value % 99 + 1:02d}-{serial + 1:04d}"

    def date(self, text: str) -> str | None:
        year, month, day = re.split(r"\D", text) if text[4].isdigit() is False else reversed(re.split(r"\D", text))
        for order in ((year, month, day), (year, day, month)):
            try:
                found = dt.date(*map(int, order))
            except ValueError:
                continue
            if not FIRST_DAY <= found <= LAST_DAY:
                return None
            days = self._permuted((found - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1, "date")
            new = FIRST_DAY + dt.timedelta(days)
            parts = [f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"]
            if order[1] != month:
                parts = [parts[0], parts[2], parts[1]]
            separator = re.search(r"\D", text).group()
            return separator.join(parts if not text[4].isdigit() else parts[::-1])
        return None

    def account(self, text: str) -> str | None:
        """An IBAN: country and length stay, the rest is permuted, and its check digits follow."""
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        body = self.symbols(plain[4:], "account")
        found = iter(plain[:2] + iban_check(plain[:2], body) + body)
        return "".join(c if c == " " else next(found) for c in text)

    def email(self, text: str) -> str | None:
        name, _, domain = text.rpartition("@")
        return f"{self.symbols(name, 'email')}@{domain}"

    def secret(self, text: str) -> str | None:
        head = re.match(r"AKIA|gh[a-z]_|(?i:bearer)\s+|.*?[=:]\s*[\"']?", text, re.DOTALL).group()
        body = text[len(head) :]
        if re.fullmatch("[0-9a-f]+", body):
            return head + self.symbols(body, "secret", (DIGITS + LETTERS[:6],))
        return head + self.symbols(body, "secret")

    def block(self, text: str) -> str | None:
        """A private key: the lines that frame it stay."""
        first, body, last = re.fullmatch(r"(-+[^-]+-+)(.*?)(-+[^-]+-+)", text, re.DOTALL).groups()
        return first + self.symbols(body, "block") + last

    def replace(self, text: str) -> tuple[str, list[dict]]:
        """The text with pseudonyms, and what was replaced where (places in the text given)."""
        found: list[tuple[int, int, str, str]] = []
        taken = bytearray(len(text))
        for pattern, hint in _PATTERNS:
            if hint(text):
                for m in pattern.finditer(text):
                    kind = m.lastgroup
                    new = getattr(self, kind)(m.group()) if taken.find(1, m.start(), m.end()) < 0 else None
                    if new is not None:
                        found.append((m.start(), m.end(), kind, new))
                        taken[m.start() : m.end()] = b"\1" * (m.end() - m.start())
        out, at = [], 0
        for a, b, _, new in sorted(found):
            out += [text[at:a], new]
            at = b
        spans = [{"kind": kind, "start": a, "end": b} for a, b, kind, _ in sorted(found)]
        return "".join([*out, text[at:]]), spans


def luhn(payload: str) -> int:
    """The check digit that belongs behind ``payload``."""
    digits = [int(c) for c in reversed(payload)]
    return -sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10


def iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


# Fixed forms, as text. Each alternative is named after the method that checks and replaces it.
_NUMBERS = re.compile(
    r"(?<![\w.+@-])(?:"
    r"(?P<date>\d{4}([-/.])\d{2}\2\d{2}|\d{2}([-/.])\d{2}\3\d{4})"
    r"|(?P<social>\d{3}-\d{2}-\d{4})"
    r"|(?P<address>\d{1,3}(?:\.\d{1,3}){3})"
    r"|(?P<card>(?:\d{4}[ -]){3}\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})"
    r"|(?P<phone>\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|\+\d{8,15}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})"
    r")(?![\w@]|[-.]\d)",
    re.ASCII,
)
_ACCOUNTS = re.compile(r"(?<!\w)(?P<account>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)", re.ASCII)
_EMAILS = re.compile(r"(?<![\w.+%-])(?P<email>[\w.+%-]+@[\w-]+(?:\.[\w-]+)+)", re.ASCII)
_SECRETS = re.compile(
    r"(?<!\w)(?P<secret>AKIA[0-9A-Z]{16}(?!\w)|gh[opsur]_[A-Za-z0-9]{20,}(?!\w)"
    r"|(?i:bearer)\s+(?=[A-Za-z._~+/-]*\d)[A-Za-z0-9._~+/-]{16,}"
    r"|(?i:token|password|passwd|secret|api[_-]?key)[\"']?\s*[=:]\s*[\"']?[A-Za-z0-9_/+-]{8,})",
    re.ASCII,
)
_BLOCKS = re.compile(r"(?P<block>-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[^-]+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)", re.ASCII)
_RUN = re.compile(r"\d[\d .()/-]{4,}\d")
_PATTERNS: list[tuple[re.Pattern[str], Callable[[str], object]]] = [
    (_BLOCKS, lambda t: "PRIVATE KEY-----" in t),
    (_SECRETS, lambda t: any(x in t for x in ("AKIA", "=", ":", "_")) or "bearer" in t.lower()),
    (_EMAILS, lambda t: "@" in t),
    (_ACCOUNTS, re.compile(r"[A-Z]{2}\d{2}[ A-Z0-9]").search),
    (_NUMBERS, _RUN.search),
]


def pseudonymize(docs: DataFrame, key: bytes, spans: str | None = None, back: bool = False) -> DataFrame:
    """The rows and columns of ``docs`` with pseudonyms in ``text``; ``spans`` names a column for what was replaced.

    Found are payment cards (Luhn), IBANs (mod 97), social security numbers, dates, phone numbers, IPv4 addresses,
    e-mail addresses, credentials behind their usual names or with their usual beginnings, and private keys. What fails
    its check stays. A null text stays null, an empty one empty, an empty table empty; a column named as ``spans``
    is replaced. Whole texts are searched, row by row, without a shuffle; copies get the same result. A value of any
    length takes time in proportion.
    """
    @F.pandas_udf("text string, spans array<struct<kind:string,start:int,end:int>>")
    def replaced(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Pseudonymizer(key, back)
        for series in texts:
            rows = [(None, []) if t is None else own.replace(t) for t in series]
            yield pd.DataFrame({"text": [t for t, _ in rows], "spans": [s for _, s in rows]})

    found = docs.withColumn("text", replaced("text"))
    if spans:
        found = found.withColumn(spans, F.col("text.spans"))
    return found.withColumn("text", F.col("text.text"))
