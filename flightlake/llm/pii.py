"""Surrogates for personal data: keyed, of the same kind and format, one for each entity.

Every kind of entity is a sequence of symbols drawn from fixed alphabets: digits, octets, letters by case, script
and vowel or consonant. On the sequences of one shape a keyed Feistel network is a permutation s; the surrogate of
x is s^-1(s(x) + 1). So the same entity always gets the same surrogate, different entities get different ones, none
keeps its value, and no table of the corpus's entities is needed. Given names go round a keyed order of the names
of their gender and script in the same way. Where a text names somebody, the given or family name alone gets the
same part of the surrogate in the whole text. A check over the corpus confirms that no surrogate is shared.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import prod

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.packing import slices
from flightlake.llm.text import table

#: The key of the examples and queries; a user passes their own.
DEMO_KEY = b"not a secret: pass your own key"
ROUNDS = 8
#: Entities whose surrogate may be drawn again.
REDRAWN = 10_000
KINDS = ("email", "ip", "iban", "card", "ssn", "phone", "name", "given")

# Given names by script and gender, and titles.
GIVEN = {
    ("latin", "male"): (
        "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Andrew Joshua "
        "Kevin Brian George Edward Jacques Pierre Laurent Hans Klaus Jürgen Wolfgang Carlos Javier Alejandro Miguel"
    ).split(),
    ("latin", "female"): (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Margaret Sandra Ashley Emily Donna "
        "Michelle Amanda Rebecca Laura Camille Amélie Chloé Sabine Ursula Greta Heidi Carmen Lucía Isabel Marta"
    ).split(),
    ("cyrillic", "male"): "Иван Дмитрий Сергей Алексей Николай Михаил Андрей Владимир Павел Борис".split(),
    ("cyrillic", "female"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
}
TITLE_WORDS = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora Sr Sra".split()
# Alphabets whose letters stand for one another.
LETTERS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789",
           "аеиоуы", "бвгджзклмнпрстфхцчш", "АЕИОУ", "БВГДЖЗКЛМНПРСТФХЦЧШ",
           "àáâãäåæèéêëìíîïòóôõöøùúûüý", "çðñþ", "эюяё", "йщъь")
RESERVED = ("example.com", "example.net", "example.org")

_ALPHABET = {c: letters for letters in LETTERS for c in letters}
TITLES = rf"(?:{'|'.join(TITLE_WORDS)})\.?[ \t]+"
_GIVEN = {name: group for group, names in GIVEN.items() for name in names}

_EMAIL = re.compile(r"(?<![\w.+%-])[\w+%-](?:[\w.+%-]*[\w+%-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)", re.ASCII)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_CARD = re.compile(r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d]|[.-]\d)", re.ASCII)
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", re.ASCII)
_PHONE = re.compile(
    r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\d]|[.-]\d)",
    re.ASCII,
)
#: National forms with a trunk 0 (French, German, British) and Spanish numbers; dates are none.
_NATIONAL = re.compile(
    r"(?<![\w.+/-])(?!\d\d([./-])\d\d\1\d{4}(?!\d))(?:0[1-9]\d{8,9}|(?:\(0[1-9]\d{0,4}\) ?|0[1-9]\d{0,4}[ ./-])\d{2,8}(?:[ .-]\d{2,4}){0,4}|"
    r"[6-9]\d\d(?:[ -]\d{3}){2}|[6-9]\d\d(?:[ -]\d\d){3}|9\d[ -]\d{3}(?:[ -]\d\d){2})(?![\w]|[.-]\d)",
    re.ASCII,
)
_CAPITALISED = r"[A-ZÀ-ÖØ-ÞА-ЯЁ](?:['’][A-ZÀ-ÖØ-ÞА-ЯЁ])?[a-zß-öø-ÿа-яё]+(?:['’-][A-ZÀ-ÖØ-ÞА-ЯЁ]?[a-zß-öø-ÿа-яё]+)*"
_NAME = re.compile(rf"(?<!\w)(?P<title>{TITLES})?(?P<given>{_CAPITALISED})[ \t]+(?P<family>{_CAPITALISED})(?!\w)")
_TITLED = re.compile(rf"(?<!\w){TITLES}(?P<family>{_CAPITALISED})(?!\w)")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\w+")
_CAPITAL_WORD = re.compile("[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё]+")
#: One of these words stands in every text that names somebody; most texts are done after looking for them.
_HINTS = {*_GIVEN, *TITLE_WORDS}


class Permutation:
    """Keyed fixed-point-free permutations of symbol sequences, one for each purpose and shape."""

    def __init__(self, key: bytes):
        self._key = blake2b(key, digest_size=32).digest()

    def _pad(self, purpose: str, turn: int, value: int) -> int:
        data = f"{purpose}\0{turn}\0{value}".encode()
        return int.from_bytes(blake2b(data, key=self._key, digest_size=16).digest(), "big")

    def move(self, digits: list[int], sizes: list[int], purpose: str) -> list[int]:
        """Another sequence with ``digits[i] < sizes[i]``, the same for the same input."""
        half = len(sizes) // 2
        a, b = prod(sizes[:half]), prod(sizes[half:])
        if a * b == 1:
            return digits
        purpose = f"{purpose}/{sizes}"
        value = 0
        for d, n in zip(digits, sizes, strict=True):
            value = value * n + d
        x, y = divmod(value, b)
        for turn in range(0, ROUNDS, 2):
            x = (x + self._pad(purpose, turn, y)) % a
            y = (y + self._pad(purpose, turn + 1, x)) % b
        x, y = divmod((x * b + y + 1) % (a * b), b)
        for turn in range(ROUNDS - 2, -1, -2):
            y = (y - self._pad(purpose, turn + 1, x)) % b
            x = (x - self._pad(purpose, turn, y)) % a
        value, moved = x * b + y, []
        for n in reversed(sizes):
            value, d = divmod(value, n)
            moved.append(d)
        return moved[::-1]

    def letters(self, text: str, purpose: str) -> str:
        """Every character becomes one of its alphabet; characters of none stay. Case follows position."""
        lower = text.lower() if len(text.lower()) == len(text) else text
        sets = [_ALPHABET.get(c, c) for c in lower]
        moved = self.move([s.index(c) for s, c in zip(sets, lower, strict=True)], [len(s) for s in sets], f"{purpose}/{_shape(lower)}")
        new = [s[d] for s, d in zip(sets, moved, strict=True)]
        return "".join(n.upper() if c.isupper() and len(n.upper()) == 1 else n for n, c in zip(new, text, strict=True))

    def order(self, group: tuple[str, str]) -> list[str]:
        return sorted(GIVEN[group], key=lambda n: self._pad("given", 0, int.from_bytes(n.encode(), "big")))


def _shape(text: str) -> str:
    """The characters that stay, at their places, and the alphabets of the others."""
    return "".join(_ALPHABET[c][0] if c in _ALPHABET else c for c in text)


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in text)


def _form(digits: str) -> int:
    """What the first digits tell of a phone number's form: trunk 0, Spanish mobile or area number, others."""
    if digits[0] == "0":
        return int(digits[1] == "0")
    return 2 + (digits[0] >= "6") + (digits[0] == "9")


def _luhn(digits: str) -> int:
    """What is missing to a multiple of ten when one more digit follows."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def _iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _is_iban(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and _iban_check(v[:2], v[4:]) == v[2:4]


class Surrogates:
    """The surrogate and the identity of each entity. Values that a person would take for the same entity (other
    case, other grouping of digits, with and without country code) share their identity."""

    def __init__(self, key: bytes, again: dict[str, int] | None = None):
        self._p, self._again, self._secret = Permutation(key), again or {}, blake2b(key, digest_size=32).digest()
        self._next = {}
        for group in GIVEN:
            names = self._p.order(group)
            self._next |= dict(zip(names, names[1:] + names[:1], strict=True))
        self.of: Callable[[str, str], tuple[str, str]] = lru_cache(1 << 16)(self._of)

    def _digits(self, digits: str, purpose: str) -> str:
        return "".join(map(str, self._p.move(list(map(int, digits)), [10] * len(digits), purpose)))

    def _of(self, kind: str, value: str) -> tuple[str, str]:
        new, who = getattr(self, "_" + kind)(value)
        for _ in range(self._again.get(self.digest(who), 0) if self._again else 0):
            new = getattr(self, "_" + kind)(new)[0]
        return new, who

    def digest(self, identity: str) -> str:
        """An entity's keyed digest, by which it is spoken of outside its text."""
        return blake2b(identity.encode(), key=self._secret, digest_size=16).hexdigest()

    def _email(self, value: str) -> tuple[str, str]:
        local, domain = value.rsplit("@", 1)
        lower = domain.lower()
        new = self._p.letters(local, "local/" + lower)
        for known in RESERVED:
            if lower == known or lower.endswith("." + known):
                sub = domain[: -len(known)]
                return f"{new}@{self._p.letters(sub, 'domain')}{domain[len(sub):]}", value.lower()
        name, top = domain.rsplit(".", 1)
        return f"{new}@{self._p.letters(name, 'domain')}.{top}.example", value.lower()

    def _ip(self, value: str) -> tuple[str, str]:
        a, b, c, d = map(int, value.split("."))
        first = 224 if a < 224 else 32
        a, b, c, d = self._p.move([a % 224, b, c, d], [first, 256, 256, 256], "ip")
        return f"{a + 224 * (first == 32)}.{b}.{c}.{d}", ".".join(str(int(x)) for x in value.split("."))

    def _phone(self, value: str) -> tuple[str, str]:
        digits = "".join(c for c in value if c.isdigit())
        keep = max(0, len(digits) - 10)
        # All sequences lie on one cycle: going on to the next of the same form keeps numbers apart and none fixed.
        new = self._digits(digits[keep:], "phone")
        while _form(new) != _form(digits[keep:]):
            new = self._digits(new, "phone")
        # A number with its country code and the same one without are one entity.
        return _refill(value, digits[:keep] + new), digits[keep:] if digits[:keep] in ("", "1") else digits

    def _ssn(self, value: str) -> tuple[str, str]:
        digits = value.replace("-", "")
        return _refill(value, self._digits(digits, "ssn")), digits

    def _card(self, value: str) -> tuple[str, str]:
        digits = "".join(c for c in value if c.isdigit())
        new = digits[0] + self._digits(digits[1:-1], "card/" + digits[0])
        return _refill(value, new + str(_luhn(new))), digits

    def _iban(self, value: str) -> tuple[str, str]:
        plain = value.replace(" ", "")
        sets = [LETTERS[4] if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in plain[4:]]
        moved = self._p.move([s.index(c) for s, c in zip(sets, plain[4:], strict=True)], [len(s) for s in sets], "iban/" + plain[:2])
        account = "".join(s[d] for s, d in zip(sets, moved, strict=True))
        rest = iter(plain[:2] + _iban_check(plain[:2], account) + account)
        return "".join(c if c == " " else next(rest) for c in value), plain

    def _name(self, value: str) -> tuple[str, str]:
        """A given and a family name, or a family name alone after a title."""
        *given, family = value.split()
        # Cyrillic family names end by gender, so their endings stay behind a stem of two letters or more.
        ends = lambda name: len(name) > 3 and name[-1] in "авнйя"
        if ends(family):
            new = self._p.letters(family[:-2], "family/" + family[-2:]) + family[-2:]
        else:
            new = self._p.letters(family, "family/")
            while ends(new):  # on to the next that has no such ending: names without stay among themselves
                new = self._p.letters(new, "family/")
        return " ".join([self._next[g] for g in given] + [new]), value.lower()


    def _given(self, value: str) -> tuple[str, str]:
        """A given name alone."""
        return self._next[value], value.lower()


def _alone(text: str, name: str) -> Iterator[int]:
    """Where the name stands as a word of its own."""
    at = text.find(name)
    while at >= 0:
        end = at + len(name)
        if not (at and (text[at - 1].isalnum() or text[at - 1] == "_")) and not (text[end : end + 1].isalnum() or text[end : end + 1] == "_"):
            yield at
        at = text.find(name, end)


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, apart from one another, in order. Where two overlap the kind that is
    listed first in KINDS stays."""
    found: list[tuple[int, int, str]] = []  # apart from one another, in order

    def add(start: int, end: int, kind: str) -> None:
        at = bisect_left(found, (start,))
        if (at == len(found) or end <= found[at][0]) and (not at or found[at - 1][1] <= start):
            found.insert(at, (start, end, kind))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add(*m.span(), "email")
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                add(*m.span(), "ip")
        for m in _IBAN.finditer(text):
            if _is_iban(m[0]):
                add(*m.span(), "iban")
        for m in _CARD.finditer(text):
            digits = "".join(c for c in m[0] if c.isdigit())
            if _luhn(digits[:-1]) == int(digits[-1]):
                add(*m.span(), "card")
        for m in _SSN.finditer(text):
            add(*m.span(), "ssn")
        for m in _PHONE.finditer(text):
            if 7 <= sum(c.isdigit() for c in m[0]) <= 15:
                add(*m.span(), "phone")
        for m in _NATIONAL.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 12:
                add(*m.span(), "phone")
    if not _HINTS.isdisjoint(_CAPITAL_WORD.findall(text)):
        at, given, family = 0, set(), set()

        def named(m: re.Match, start: int) -> None:
            name = m["family"][:-2] if m["family"].endswith(("'s", "’s")) else m["family"]
            add(start, m.start("family") + len(name), "name")
            family.add(name)

        while m := _NAME.search(text, at):
            if m["given"] in _GIVEN:
                named(m, m.start("given"))
                given.add(m["given"])
                at = m.end()
            else:
                at = m.end("given")
        for m in _TITLED.finditer(text):
            if m["family"] not in _GIVEN:
                named(m, m.start("family"))
        # The same people by one of their names; a word that is both is taken for a given name.
        for kind, names in (("given", given), ("name", family - given)):
            for name in sorted(n for n in names if not n.isalpha()):
                for at in _alone(text, name):
                    add(at, at + len(name), kind)
            if names:
                for m in _WORD.finditer(text):
                    if m[0] in names:
                        add(*m.span(), kind)
    return found


def replace(text: str, surrogates: Surrogates) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates, and their spans in it."""
    parts, spans, at, size = [], [], 0, 0
    for start, end, kind in find(text):
        new = surrogates.of(kind, text[start:end])[0]
        parts += [text[at:start], new]
        size += start - at
        spans.append((size, size + len(new), kind))
        size, at = size + len(new), end
    return "".join([*parts, text[at:]]), spans


def _replaced(key: bytes, again: dict[str, int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key, again)
        for batch in batches:
            at = 0
            for _, part in slices(batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()):
                here = batch.slice(at, len(part))
                at += len(part)
                null = here.column(batch.num_columns - 1).is_null().to_pylist()
                done = [replace(t.decode(), surrogates) for t in part]
                texts = pa.array([None if n else t for n, (t, _) in zip(null, done, strict=True)], pa.string())
                counts = pa.array([len(s) for _, s in done], pa.int64())
                listed = pa.array([",".join(f"{k}:{a}:{b}" for a, b, k in s) for _, s in done], pa.string())
                cols = [*(here.column(i) for i in range(batch.num_columns - 1)), texts, counts, listed]
                yield pa.record_batch([x.cast(t) for x, t in zip(cols, schema.types, strict=True)], schema)

    return run


def _identified(key: bytes, again: dict[str, int]):
    schema = pa.schema([("kind", pa.string()), ("surrogate", pa.string()), ("entity", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates, plain = Surrogates(key, again), Surrogates(key)
        for batch in batches:
            seen = set()
            for _, part in slices(batch.column(0).cast(pa.binary()).to_pylist()):
                for t in map(bytes.decode, part):
                    for start, end, kind in find(t):
                        new, who = surrogates.of(kind, t[start:end])
                        # The surrogate's own identity, so that another way of writing it makes no difference.
                        seen.add((kind, plain.of(kind, new)[1], plain.digest(who)))
            if seen:
                yield pa.record_batch([pa.array(c) for c in zip(*sorted(seen), strict=True)], schema)

    return run


def collisions(df: DataFrame, key: bytes = DEMO_KEY, text_col: str = "text", again: dict[str, int] | None = None) -> DataFrame:
    """(kind, surrogate, entities, first, last) of every surrogate that stands for more than one entity of the
    corpus: no rows, as long as distinctness holds. Entities travel as keyed digests only; ``first`` and ``last``
    are the least and greatest of them."""
    texts = df.select(F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    pairs = texts.mapInArrow(_identified(key, again or {}), "kind string, surrogate string, entity string").distinct()
    return pairs.groupBy("kind", "surrogate").agg(
        F.count("*").alias("entities"), F.min("entity").alias("first"), F.max("entity").alias("last")).filter("entities > 1")


def resolved(df: DataFrame, key: bytes = DEMO_KEY, text_col: str = "text") -> dict[str, int]:
    """How many further steps the surrogates of which entities (by digest) must take so that none is shared.

    Of the entities that share a surrogate the one with the greatest digest goes on to the next surrogate of its
    form, and the corpus is searched again until no two share one. The permutations leave collisions to what two
    kinds of writing have in common, so there are few; more than ``REDRAWN`` are an error.
    """
    again: dict[str, int] = {}
    while rows := collisions(df, key, text_col, again).select("last").distinct().limit(REDRAWN + 1).collect():
        for r in rows:
            again[r.last] = again.get(r.last, 0) + 1
        if len(again) > REDRAWN or max(again.values()) > REDRAWN:
            raise ValueError(f"more than {REDRAWN} entities share surrogates under this key; choose another key")
    return again


def pseudonymise(df: DataFrame, key: bytes = DEMO_KEY, carry: dict[str, Column] | None = None, text_col: str = "text", check: bool = True) -> DataFrame:
    """The carried columns (doc_id if not named) of every row, its text with surrogates, n_entities, and entities (kind:start:end in the
    new text, comma-joined).

    Null texts stay null; texts without entities stay as they are, to the character. Repeated rows get the same
    text; an empty table gives no row. With ``check`` the corpus is first searched for surrogates that two entities
    share, and these are drawn again (see :func:`resolved`).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    again = resolved(df, key, text_col) if check else {}
    carry = {"doc_id": F.col("doc_id")} if carry is None else carry
    source = df.select(*[c.alias(k) for k, c in carry.items()], F.col(text_col).cast("string").alias("__text"))
    out = StructType(source.schema.fields[:-1] + StructType.fromDDL("text string, n_entities bigint, entities string").fields)
    return source.mapInArrow(_replaced(key, again, to_arrow_schema(out)), out)


def op8_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    """Personal data of all ``documents`` replaced; see :func:`pseudonymise`."""
    return pseudonymise(table(spark, sf_dir, "documents"))
