"""Format-preserving pseudonyms for personal data.

A value that its check (Luhn, mod 97, calendar, number ranges) confirms is replaced by another valid value of the same
format: its place among all values of the format goes through a keyed Feistel permutation. Equal values get equal
pseudonyms in every document, different ones different pseudonyms, and whoever has the key can go back.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from barflow.llm.common import column

ROUNDS = 10

# What counts as a card, an account, a date, a phone number, an address.
CARD_LENGTHS = range(13, 20)
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26,
}

_PERSONAL = re.compile(
    r"""(?P<email>(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-]))
    |(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))
    |(?P<iso>(?<![\w/.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?!(?!T[0-9]{2})[\w/-]|\.[0-9]))
    |(?P<day>(?<![\w/.-])[0-9]{2}(?P<mark>[/.])[0-9]{2}(?P=mark)[0-9]{4}(?![\w/-]|\.[0-9]))
    |(?P<ssn>(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]|\.[0-9]))
    |(?P<ip>(?<![\w.-])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w-]|\.[0-9]))
    |(?P<phone>(?<![\w.+-])(?:(?:(?:\+1[ .-]?|1-)\(?[0-9]{3}\)?|\([0-9]{3}\))[ .-]?[0-9]{3}[ .-]?
        |(?:1[ .])?[2-9][0-9]{2}(?:[.-][2-9][0-9]{2}[ .-]?|[ ][2-9][0-9]{2}[ .-]))[0-9]{4}(?!\w|[.-][0-9]))
    |(?P<abroad>(?<![\w.+-])\+[2-9][0-9](?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?!\w|[.-][0-9]))
    |(?P<card>(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?!\w|[.-][0-9]))""",
    re.X,
)
_SOME = re.compile(r"[0-9@]")


class Feistel:
    """Keyed permutations of the numbers below a size, one for each name."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = blake2b(key, digest_size=32).digest()

    def _part(self, name: bytes, turn: int, half: int, bits: int) -> int:
        wide = (bits + 7) // 8
        said = b"%b/%d/%d/%x" % (name, bits, turn, half)
        return int.from_bytes(blake2b(said, key=self.key, digest_size=min(64, wide + 8)).digest(), "big") & ((1 << bits) - 1)

    def permute(self, name: str, x: int, size: int, back: bool = False) -> int:
        """The place that ``x`` moves to. Two halves of equal bits; places beyond the size are walked through."""
        if not 0 <= x < size:
            raise ValueError("out of range")
        if size == 1:
            return 0
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        tag, mask = f"{name}/{size}".encode(), (1 << bits) - 1
        while True:
            a, b = x >> bits, x & mask
            if back:
                for turn in reversed(range(ROUNDS)):
                    a, b = b ^ self._part(tag, turn, a, bits), a
            else:
                for turn in range(ROUNDS):
                    a, b = b, a ^ self._part(tag, turn, b, bits)
            x = a << bits | b
            if x < size:
                return x


def luhn_digit(digits: str) -> int:
    """The check digit that makes ``digits`` and it a valid number."""
    total = sum(sum(divmod(2 * int(c), 10)) if k % 2 == 0 else int(c) for k, c in enumerate(reversed(digits)))
    return -total % 10


def _fill(shape: str, new: str) -> str:
    """``shape`` with its letters and digits replaced one by one."""
    it = iter(new)
    return "".join(next(it) if c.isalnum() else c for c in shape)


class Pseudonyms:
    """Replaces confirmed values; the methods return None for a value that is not what it looks like."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back
        self.memory: dict[tuple[str, str], str | None] = {}

    def _move(self, name: str, x: int, size: int) -> int:
        return self.feistel.permute(name, x, size, self.back)

    def _digits(self, name: str, digits: str) -> str:
        return f"{self._move(name, int(digits), 10 ** len(digits)):0{len(digits)}d}" if digits else ""

    def _letters(self, name: str, text: str) -> str:
        """Permute digits among digits and letters among letters of their case."""
        sizes = [10 if c.isdigit() else 26 for c in text]
        firsts = ["0" if c.isdigit() else "A" if c.isupper() else "a" for c in text]
        x, size = 0, 1
        for c, s, f in zip(text, sizes, firsts, strict=True):
            x, size = x * s + ord(c) - ord(f), size * s
        x = self._move(f"{name}/{''.join(firsts)}", x, size)
        out = []
        for s, f in zip(reversed(sizes), reversed(firsts), strict=True):
            x, k = divmod(x, s)
            out.append(chr(ord(f) + k))
        return "".join(reversed(out))

    def card(self, text: str) -> str | None:
        """Luhn-valid number of 13 to 19 digits: first digit kept, check digit made anew."""
        digits = re.sub(r"[ -]", "", text)
        if len(digits) not in CARD_LENGTHS or luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        body = digits[0] + self._digits(f"card/{digits[0]}", digits[1:-1])
        return _fill(text, f"{body}{luhn_digit(body)}")

    def iban(self, text: str) -> str | None:
        """Account number whose length and check are right: country kept, check made anew."""
        plain = text.replace(" ", "")
        rest = plain[4:] + plain[:4]
        if IBAN_LENGTHS.get(plain[:2]) != len(plain) or int("".join(str(int(c, 36)) for c in rest)) % 97 != 1:
            return None
        body = self._letters(f"iban/{plain[:2]}", plain[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{plain[:2]}00")) % 97
        return _fill(text, f"{plain[:2]}{check:02d}{body}")

    def _date(self, name: str, day: dt.date, fits: Callable[[dt.date], bool]) -> dt.date | None:
        if not (FIRST_DAY <= day <= LAST_DAY and fits(day)):
            return None
        size = (LAST_DAY - FIRST_DAY).days + 1
        x = (day - FIRST_DAY).days
        while True:
            x = self._move(f"date/{name}", x, size)
            if fits(found := FIRST_DAY + dt.timedelta(days=x)):
                return found

    def iso(self, text: str) -> str | None:
        """Calendar day, year first."""
        try:
            day = self._date("iso", dt.date.fromisoformat(text), lambda d: True)
        except ValueError:
            return None
        return day and day.isoformat()

    def day(self, text: str) -> str | None:
        """Calendar day with the year last: day first; or month first where only that is a date. Both stay what they are."""
        a, b, year = (int(x) for x in re.split("[/.]", text))
        mark = text[2]
        try:
            day = self._date(f"day{mark}", dt.date(year, b, a), lambda d: True)
            return day and f"{day.day:02d}{mark}{day.month:02d}{mark}{day.year:04d}"
        except ValueError:
            pass
        try:
            day = self._date(f"month{mark}", dt.date(year, a, b), lambda d: d.day > 12)
        except ValueError:
            return None
        return day and f"{day.month:02d}{mark}{day.day:02d}{mark}{day.year:04d}"

    def ssn(self, text: str) -> str | None:
        """Social security number: area 001 to 899 without 666, group and serial not zero."""
        area, group, serial = (int(x) for x in text.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        x, serial = divmod(self._move("ssn", x, 898 * 99 * 9999), 9999)
        area, group = divmod(x, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def ip(self, text: str) -> str | None:
        """IPv4 address other than 0.x and 127.x; parts may change their number of digits."""
        parts = [int(p) for p in text.split(".")]
        if any(p > 255 or str(p) != s for p, s in zip(parts, text.split("."), strict=True)) or parts[0] in (0, 127):
            return None
        x = int.from_bytes(bytes(parts), "big")
        while True:
            x = self._move("ip", x, 1 << 32)
            if x >> 24 not in (0, 127):
                return ".".join(str(p) for p in x.to_bytes(4, "big"))

    def phone(self, text: str) -> str | None:
        """North American number. Those with area and exchange from 200 up stay such, in every way of writing; so do the others."""
        digits = re.sub(r"[^0-9]", "", text)
        country, own = digits[:-10], digits[-10:]
        area, exchange, line = int(own[:3]) - 200, int(own[3:6]) - 200, int(own[6:])
        if min(area, exchange) < 0:
            while True:
                own = self._digits("phone/any", own)
                if min(own[0], own[3]) < "2":
                    return _fill(text, country + own)
        x = self._move("phone", (area * 800 + exchange) * 10_000 + line, 800 * 800 * 10_000)
        x, line = divmod(x, 10_000)
        area, exchange = divmod(x, 800)
        return _fill(text, f"{country}{area + 200}{exchange + 200}{line:04d}")

    def abroad(self, text: str) -> str | None:
        """Any other international number of 8 to 15 digits: the first two digits, which hold the country, are kept."""
        digits = re.sub(r"[^0-9]", "", text)
        if not 8 <= len(digits) <= 15:
            return None
        return _fill(text, digits[:2] + self._digits(f"abroad/{digits[:2]}", digits[2:]))

    def email(self, text: str) -> str | None:
        """Address: the part before the sign is permuted among names of its shape, the domain is kept."""
        name, _, domain = text.partition("@")
        plain = re.sub(r"[^A-Za-z0-9]", "", name)
        shape = re.sub(r"[A-Za-z0-9]", "x", name)
        return f"{_fill(name, self._letters(f'email/{domain.lower()}/{shape}', plain))}@{domain}"

    @staticmethod
    def _readings(kind: str, found: str) -> Iterator[str]:
        """What a match may stand for, longest first: a card may end at any of its groups, an account at its country's length."""
        if kind == "iban":
            ends = [k + 1 for k, c in enumerate(found) if c != " "]
            length = IBAN_LENGTHS.get(found[:2], len(ends) + 1)
            if length <= len(ends) and found[ends[length - 1] :][:1] in ("", " "):
                yield found[: ends[length - 1]]
            return
        yield found
        if kind == "card":
            for k in range(len(found) - 1, CARD_LENGTHS[0] - 1, -1):
                if found[k] in " -":
                    yield found[:k]

    @staticmethod
    def _behind(kind: str, found: str) -> int:
        """Where to go on in a match that no reading confirms: a card's next group, behind what an account would take up."""
        if kind == "card":
            return 1
        if kind == "iban":
            ends = [k + 1 for k, c in enumerate(found) if c != " "]
            length = IBAN_LENGTHS.get(found[:2], len(ends) + 1)
            return ends[length - 1] if length <= len(ends) else 4
        return len(found)

    def _replaced(self, kind: str, value: str) -> str | None:
        key = kind, value
        if key not in self.memory:
            if len(self.memory) > 100_000:
                self.memory.clear()
            self.memory[key] = getattr(self, kind)(value)
        return self.memory[key]

    def text(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, length) of each in the new text, counted in code points."""
        if not _SOME.search(text):
            return text, []
        out, spans, at, grown, next_at = [], [], 0, 0, 0
        while m := _PERSONAL.search(text, next_at):
            kind = m.lastgroup if m.lastgroup != "mark" else "day"
            made = ((v, new) for v in self._readings(kind, m[0]) if (new := self._replaced(kind, v)) is not None)
            value, new = next(made, ("", None))
            if new is None:
                next_at = m.start() + self._behind(kind, m[0])
                continue
            out += [text[at : m.start()], new]
            spans.append((kind, m.start() + grown, len(new)))
            grown += len(new) - len(value)
            at = next_at = m.start() + len(value)
        return "".join([*out, text[at:]]), spans


_SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("length", IntegerType())])
)


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", spans: str = "spans", back: bool = False) -> DataFrame:
    """Replace personal data in the text by pseudonyms and add ``spans``: kind, start and length of each, or an empty list.

    A null text stays null, with an empty list. What no check confirms stays as it is, so a text without personal data comes out
    unchanged. ``back`` undoes a run with the same key, up to the few values whose pseudonym reads as another kind.
    Other columns stay, but for one called like ``spans``. The key stays in the closure of the tasks; it is not stored.
    """
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), spans.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonyms(key, back)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
        for b in batches:
            made = [(None, []) if t is None else own.text(t) for t in b.columns[-1].to_pylist()]
            found = [[{"kind": k, "start": s, "length": n} for k, s, n in x] for _, x in made]
            texts = pa.array([t for t, _ in made], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], texts, pa.array(found, kind)], names=[*keep, text, spans])

    schema = StructType([*[docs.schema[c] for c in keep], StructField(text, StringType()), StructField(spans, _SPANS)])
    return docs.select(*[column(docs, c) for c in keep], column(docs, text)).mapInArrow(run, schema)
