"""Surrogates for personal data: keyed, of the same type and format, distinct."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from ipaddress import AddressValueError, IPv6Address
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches, texts_of
from tiermart.llm.textstats import STOP_WORDS
from tiermart.session import materialise

# Given names by script and gender, and titles by gender
GIVEN = {
    ("latin", "f"): "Alice Anna Barbara Carmen Caroline Charlotte Claudia Elena Elizabeth Emma Hannah Helena Isabel Jennifer Julia Laura Linda Lucia Margaret Maria Marie Martina Mary Monika Nicole Olivia Patricia Sabine Sandra Sarah Sofia Sophie Susan Ursula Victoria Aisha Ananya Chiara Fatima Giulia Ingrid Kavita Layla Mei Priya Sakura Yuki Zainab".split(),
    ("latin", "m"): "Alexander Andreas Antonio Carlos Charles Christian Daniel David Diego Felix Francisco Frank George Hans Henry James Javier Jean John Jorge Joseph Juan Klaus Louis Manuel Mark Martin Michael Miguel Pablo Paul Pedro Peter Philippe Pierre Richard Robert Stefan Thomas William Wolfgang Ahmed Arjun Giovanni Hassan Hiroshi Ibrahim Kenji Lars Marco Mohammed Omar Rahul Raj Sven Wei Yusuf".split(),
    ("cyrillic", "f"): "Анна Галина Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна Юлия".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Павел Сергей".split(),
}
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Sra Doña госпожа".split(),
    "m": "Mr Herr Monsieur Señor Sr Don господин".split(),
    "": "Dr Prof Professor Doctor".split(),
}
# words behind a given name that make the two a place or an institution; the second kind behind names that are often places
PLACES = frozenset(
    "airport avenue cathedral college county hospital hotel institute island islands museum road station street university".split()
)
PLACE_NAMES = frozenset("Alexander Charlotte Christian David George Helena James Mary Sofia Victoria".split())
MORE_PLACES = frozenset(
    "bay beach bridge church city cross democratic democrats east falls garden gardens hall harbour hill house lake line "
    "north park peak river school south square state town valley west".split()
)
# country codes of one and two digits; all others have three
COUNTRIES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
    "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоуыэюя", "greek": "αειου"}
CONSONANTS = {"latin": "bcdfghjklmnprstvwz", "cyrillic": "бвгджзклмнпрстфхцчш", "greek": "βγδζθκλμνπρτφχ"}

NAMES = {name: kind for kind, names in GIVEN.items() for name in names}
GENDERS = {title: gender for gender, titles in TITLES.items() for title in titles}

_WORD = r"[^\W\d_]"
_CAPITAL = "[" + "".join(c for c in map(chr, range(0x10000)) if unicodedata.category(c) in ("Lu", "Lt")) + "]"
_PREFIX = "[OD]['\u2019]"
_SURNAME = rf"(?:{_PREFIX})?{_CAPITAL}{_WORD}+(?:-{_CAPITAL}{_WORD}+)?"
_MAIL = r"A-Za-z0-9\u00c0-\u024f\u0370-\u03ff\u0400-\u04ff"
EMAIL = re.compile(
    rf"(?<![{_MAIL}._%+\-])(?<![{_MAIL}._%+\-]')[{_MAIL}._%+\-]++(?:'[{_MAIL}._%+\-]++)*+"
    rf"@(?:[{_MAIL}](?:[{_MAIL}\-]*[{_MAIL}])?\.)+[A-Za-z]{{2,24}}(?![A-Za-z0-9])"
)
# a run of digits with the separators that numbers are written with
DIGITS = re.compile(
    r"(?<![\w.])(?:"
    r"(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?![\w]|\.\d)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?P<card>\d{13,19}|\d{4}(?P<sign>[ -])\d{4}(?P=sign)\d{4}(?P=sign)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]|\.\d)"
    r"|(?P<phone>(?:\+\d{1,3}[ .-]?|00\d{1,3}[ .-])?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ ./-]?\d{2,5}){1,4})(?![\w-]|\.\d)"
    r")"
    r"|(?P<plus>\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{1,5}(?:[ ./-]?\d{2,5}){1,5})(?![\w-]|\.\d)"
    r"|(?P<paren>(?<!\w)\(\d{2,5}\)[ .-]?\d{2,5}(?:[ ./-]?\d{2,5}){1,3})(?![\w-]|\.\d)"
)
IPV6 = re.compile(
    r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,7}:"
    r"|::(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{1,4})(?![\w:]|\.\w)"
)
# how numbers without a country code are grouped
DIALLED = re.compile(r"(?:\(\d{2,5}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|[2-9]\d\d([ -])\d{3}\1\d{3}")
LOCAL = re.compile(r"0\d{2,4}[ /-]\d{3,8}(?:[ -]\d{2,5})*")
GROUPED = re.compile(r"0[1-9]\d{0,3}([ ./-])\d{2,4}(?:\1\d{2,4}){1,4}|0[1-9]\d{1,3}/\d{2,4}(?: \d{2,4}){1,3}")
TOKEN = re.compile(rf"(?<!\w)(?:{_PREFIX})?{_WORD}++(?:-{_WORD}++)*+(?!\w)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)")
LOWER_IBAN = re.compile(
    r"(?<!\w)[a-z]{2}[0-9]{2}(?:[a-z0-9]{11,30}|(?: [0-9]{4}){2,7}(?: [0-9]{1,4})?)(?!\w)"
)
# numbers that only the words before them tell from others
CUED_PHONE = re.compile(
    r"\b(?:phone|telephone|tel|mobile|cell|call|whatsapp|fax)\b[.:]?(?: (?:number|no|me|us|at|on|is)\b)*[.:]? ?(\d{7,12})(?!\w|[.,]\d)", re.I
)
CUED_SSN = re.compile(
    r"\b(?:ssn|social security)(?: (?:number|no))?[.:#]?(?: is)? ?(\d{3}[ -]?\d{2}[ -]?\d{4})(?!\w|[.,]\d)", re.I
)
CUED_PERSON = re.compile(
    rf"(?i:\b(?:my name is|(?:full name|name|contact|patient|employee|applicant|tenant|attn):)) ({_SURNAME} {_SURNAME})(?!\w)"
)
PERSON = re.compile(
    rf"(?<!\w)(?:(?P<title>{'|'.join(sorted(GENDERS, key=len, reverse=True))})\.? (?P<named>{_SURNAME}(?: {_SURNAME})?)"
    rf"|(?P<given>{'|'.join(sorted([*NAMES, *map(str.upper, NAMES)], key=len, reverse=True))}) (?P<family>{_SURNAME}))(?!\w)"
)


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    gender: str = ""


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """Whether the check digits are those that belong to the rest, which are 02 to 98."""
    return 2 <= int(text[2:4]) <= 98 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _plain(text: str) -> str:
    """The text with the digits of any script as 0-9."""
    if text.isascii():
        return text
    return "".join(str(int(c)) if c.isdecimal() else c for c in text)


def _digits_of(text: str) -> str:
    return re.sub(r"\D", "", _plain(text))


def _dialled(text: str) -> tuple[str, str]:
    """The country code of a phone number and the digits behind it, without a (0) between them.

    Without + or 00 there is no code.
    """
    plain = _plain(text)
    if not plain.startswith(("+", "00")):
        return "", _digits_of(plain)
    digits = _digits_of(plain.replace("(0)", ""))
    if plain[0] == "0":
        digits = digits[2:]
    size = next(n for n in (1, 2, 3) if n == 3 or digits[:n] in COUNTRIES)
    return digits[:size], digits[size:]


def _ipv6_valid(text: str) -> bool:
    """Short forms need a digit and three groups, a first one of four signs as all assigned prefixes
    have, or to be ::1, as names and slices in programs are written alike."""
    if "::" in text and text != "::1":
        groups = [group for group in text.split(":") if group]
        assigned = len(groups) > 2 or len(text.split(":")[0]) == 4
        if not assigned or not re.search("[0-9]", text):
            return False
    try:
        IPv6Address(text)
    except AddressValueError:
        return False
    return True


def _number_kind(match: re.Match) -> str | None:
    text = _plain(match.group())
    digits = _digits_of(text)
    if match["ip"]:
        parts = text.split(".")
        return "ip" if all(int(p) < 256 and str(int(p)) == p for p in parts) else None
    if match["ssn"]:
        return "ssn"
    if match["card"]:
        # all numbers of 16 digits are taken for cards, also where the check digit is wrong
        return "card" if luhn(digits) or len(digits) == 16 else None
    if match["plus"] or match["paren"] or text.startswith(("+", "00")):
        return "phone" if 8 <= len(digits) <= 15 else None
    if match["phone"]:
        # without a country code the groups must look like a number to dial
        if DIALLED.fullmatch(text) or LOCAL.fullmatch(text):
            return "phone"
        return "phone" if GROUPED.fullmatch(text) and 9 <= len(digits) <= 11 else None
    return None


def _is_person(given: str, family: str) -> bool:
    """Whether a given name and the word behind it name a person, not a place; both are in capitals or neither."""
    word = family.lower()
    if word == given.lower() or word in PLACES or (given.capitalize() in PLACE_NAMES and word in MORE_PLACES):
        return False
    return family.isupper() or not given.isupper()


def find_entities(text: str) -> list[Entity]:
    """E-mail addresses, IP addresses, cards, IBANs, phone and social security numbers and
    names with a title, a known given name or a word like "name:" before them, and the bare parts of those names
    elsewhere in the text; from left to right, without overlaps."""
    found: list[Entity] = []
    if "@" in text:
        found += [Entity(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    if re.search(r"\d", text):
        found += [
            Entity(m.start(), m.end(), "iban")
            for pattern in (IBAN, LOWER_IBAN)
            for m in pattern.finditer(text)
            if iban_valid(m.group().replace(" ", ""))
        ]
        found += [
            Entity(m.start(1), m.end(1), kind)
            for kind, pattern in (("phone", CUED_PHONE), ("ssn", CUED_SSN))
            for m in pattern.finditer(text)
        ]
        found += [
            Entity(m.start(), m.end(), kind)
            for m in DIGITS.finditer(text)
            if (kind := _number_kind(m))
        ]
        if ":" in text:
            found += [Entity(m.start(), m.end(), "ipv6") for m in IPV6.finditer(text) if _ipv6_valid(m.group())]
    genders: dict[str, str] = {}
    named = [Entity(m.start(1), m.end(1), "person") for m in CUED_PERSON.finditer(text)]
    for match in PERSON.finditer(text):
        if match["given"] and _is_person(match["given"], match["family"]):
            gender = NAMES[match["given"].capitalize()][1]
            named.append(Entity(match.start(), match.end(), "person", gender))
        elif match["title"]:
            named.append(Entity(match.start("named"), match.end("named"), "person", GENDERS[match["title"]]))
    for entity in named:
        for part in text[entity.start : entity.end].split(" "):
            if part.lower().encode("utf-8", "replace") not in STOP_WORDS and part not in GENDERS:
                genders[part] = genders.get(part) or entity.gender
    found += named
    if genders:
        found += [
            Entity(m.start(), m.end(), "person", genders[m.group()])
            for m in TOKEN.finditer(text)
            if m.group() in genders
        ]
    found.sort(key=lambda e: (e.start, -e.end))
    kept: list[Entity] = []
    for entity in found:
        if not kept or entity.start >= kept[-1].end:
            kept.append(entity)
    return kept


class Surrogates:
    """Keyed one-to-one replacements.

    Each replacement permutes the values of one type and format among themselves, so equal entities get equal
    surrogates in every document and different entities different ones, without a table. What is
    permuted is the canonical form of an entity, so that all ways to write it agree.
    A Feistel network orders all values of a format, and a value is replaced by
    the next one in this order that is of the same kind; so none
    stays as it is where there is another.
    """

    def __init__(self, key: bytes) -> None:
        self.key = key
        self.cycles = {kind: self._cycle(kind) for kind in GIVEN}
        self.known: dict[tuple[str, str, str], str] = {}

    def _number(self, *parts: object) -> int:
        text = "\x1f".join(map(str, parts)).encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "big")

    def _cycle(self, kind: tuple[str, str]) -> dict[str, str]:
        """A keyed order of the names of one script and gender, each followed by its surrogate."""
        order = sorted(GIVEN[kind], key=lambda name: self._number("given", *kind, name))
        return dict(zip(order, order[1:] + order[:1]))

    def permute(self, value: int, size: int, tweak: str, accept: Callable[[int], bool] | None = None) -> int:
        """A keyed permutation of 0..size-1, within the values that `accept` holds for."""
        if size < 2:
            return value
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        place = self._placed(value, a, b, f"{tweak}/{size}", 1)
        while True:
            place = (place + 1) % (a * b)
            value = self._placed(place, a, b, f"{tweak}/{size}", -1)
            if value < size and (accept is None or accept(value)):
                return value

    def _placed(self, value: int, a: int, b: int, tweak: str, sign: int) -> int:
        """The place of a value of 0..a*b-1 in the keyed order; with sign -1 the value of a place."""
        left, right = divmod(value, b)
        for turn in range(6)[::sign]:
            if turn % 2:
                right = (right + sign * self._number(tweak, turn, left)) % b
            else:
                left = (left + sign * self._number(tweak, turn, right)) % a
        return left * b + right

    def _characters(self, text: str, alphabets: list[str], tweak: str) -> str:
        """Permute a text whose characters each come from their own alphabet."""
        value, size = 0, 1
        for character, alphabet in zip(text, alphabets):
            value = value * len(alphabet) + alphabet.index(character)
            size *= len(alphabet)
        value = self.permute(value, size, tweak)
        out = []
        for alphabet in reversed(alphabets):
            value, place = divmod(value, len(alphabet))
            out.append(alphabet[place])
        return "".join(reversed(out))

    def _digits(self, digits: str, tweak: str, accept: Callable[[str], bool] | None = None) -> str:
        n = len(digits)
        test = (lambda v: accept(str(v).zfill(n))) if accept else None
        return str(self.permute(int(digits), 10**n, f"{tweak}/{n}", test)).zfill(n)

    def replace(self, text: str, kind: str, gender: str = "") -> str:
        if (kind, gender, text) not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[kind, gender, text] = getattr(self, f"_{kind}")(text, gender)
        return self.known[kind, gender, text]

    def _email(self, text: str, gender: str) -> str:
        """Letters become letters and digits digits; signs, case and the last label stay."""
        head, _, last = text.rpartition(".")
        return self._mixed(head, "email/" + last.lower()) + "." + last

    def _mixed(self, text: str, tweak: str) -> str:
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        alphabets, shape = [], []
        for character in lower:
            alphabet = (
                "0123456789" if character in "0123456789"
                else "abcdefghijklmnopqrstuvwxyz" if "a" <= character <= "z"
                else character
            )
            alphabets.append(alphabet)
            shape.append(character if len(alphabet) == 1 else "9" if alphabet[0] == "0" else "a")
        new = self._characters(lower, alphabets, f"{tweak}/{''.join(shape)}")
        return "".join(n.upper() if t.isupper() else n for n, t in zip(new, text))

    def _ip(self, text: str, gender: str) -> str:
        """An address of one host becomes one, any other address another one of those."""

        def single(value: int) -> bool:
            return 1 <= value >> 24 < 224 and 0 < value & 255 < 255

        value = int.from_bytes(bytes(map(int, text.split("."))), "big")
        sort = single(value)
        new = self.permute(value, 1 << 32, f"ip/{sort}", lambda v: single(v) == sort)
        return ".".join(map(str, new.to_bytes(4, "big")))

    def _ipv6(self, text: str, gender: str) -> str:
        """Groups that are zero stay, and so do short forms, padding and case."""
        packed = IPv6Address(text).packed
        groups = [int.from_bytes(packed[i : i + 2], "big") for i in range(0, 16, 2)]
        value = 0
        for group in filter(None, groups):
            value = value * 0xFFFF + group - 1
        mask = "".join("x" if group else "0" for group in groups)
        value = self.permute(value, 0xFFFF ** mask.count("x"), f"ipv6/{mask}")
        for i in reversed(range(8)):
            if groups[i]:
                value, rest = divmod(value, 0xFFFF)
                groups[i] = rest + 1
        if "::" in text:
            new = IPv6Address(b"".join(group.to_bytes(2, "big") for group in groups)).compressed
        else:
            width = 4 if re.search(r"(?<!\w)0\w", text) else 1
            new = ":".join(f"{group:0{width}x}" for group in groups)
        return new.upper() if re.search("[A-F]", text) else new

    def _ssn(self, text: str, gender: str) -> str:
        return _refill(text, iter(self._digits(_digits_of(text), "ssn")))

    def _phone(self, text: str, gender: str) -> str:
        """The country code, the first digit behind it and all signs stay."""
        code, rest = _dialled(text)
        accept = None
        if not code and rest[0] == "0":  # 00 would make it a number with a country code
            accept = lambda new: (new[0] == "0") == (rest[1] == "0")
        new = rest[0] + self._digits(rest[1:], f"phone/{code}/{rest[0]}", accept)
        if not code:
            return _refill(text, iter(new))
        digits = iter(("00" if text[0] != "+" else "") + code + new)
        return "(0)".join(_refill(part, digits) for part in text.split("(0)"))

    def _card(self, text: str, gender: str) -> str:
        """The first digit stays; the check digit of a valid number is valid again."""
        digits = _digits_of(text)
        if luhn(digits):
            body = digits[0] + self._digits(digits[1:-1], f"card/{digits[0]}")
            new = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        else:
            first = digits[0]
            new = first + self._digits(
                digits[1:], f"invalid/{first}", lambda rest: not luhn(first + rest)
            )
        return _refill(text, iter(new))

    def _iban(self, text: str, gender: str) -> str:
        """The country stays; letters become letters and digits digits, with a valid check."""
        plain = text.replace(" ", "").upper()
        body = self._mixed(plain[4:], f"iban/{plain[:2]}").upper()
        check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
        new = iter(f"{plain[:2]}{check:02d}{body}")
        written = "".join(c if c == " " else next(new) for c in text)
        return written.lower() if text.islower() else written

    def _person(self, text: str, gender: str) -> str:
        """A known given name becomes another of its script and gender; other parts get other vowels
        and consonants in their places."""
        return "".join(
            part if part in " -" or re.fullmatch(_PREFIX, part)
            else self._given(part) if part.capitalize() in NAMES
            else self._spelled(part)
            for part in re.split(rf"({_PREFIX}(?=\w)|[ -])", text)
        )

    def _given(self, part: str) -> str:
        name = part.capitalize()
        new = self.cycles[NAMES[name]][name]
        return new.upper() if part.isupper() else new

    def _spelled(self, name: str) -> str:
        alphabets, shape = [], []
        for character in name:
            alphabet, sort = character, character
            for script in VOWELS:
                if character.lower() in VOWELS[script]:
                    alphabet, sort = VOWELS[script], "v" + script[0]
                elif character.lower() in CONSONANTS[script]:
                    alphabet, sort = CONSONANTS[script], "c" + script[0]
            alphabets.append(alphabet)
            shape.append(sort)
        new = "".join(c.lower() if len(a) > 1 else c for c, a in zip(name, alphabets))
        tweak = "name/" + "".join(shape).lower()
        new = self._characters(new, alphabets, tweak)
        while new.capitalize() in NAMES:  # a spelled name must not become a known given name
            new = self._characters(new, alphabets, tweak)
        return "".join(
            n.upper() if c.isupper() and len(a) > 1 else n for n, c, a in zip(new, name, alphabets)
        )

    def rewrite(self, text: str, entities: list[Entity]) -> str:
        parts, at = [], 0
        for entity in entities:
            parts.append(text[at : entity.start])
            parts.append(self.replace(text[entity.start : entity.end], entity.kind, entity.gender))
            at = entity.end
        return "".join([*parts, text[at:]])


def _refill(text: str, digits: Iterator[str]) -> str:
    """The text with other digits, of the script of those that they replace."""
    return "".join(chr(ord(c) - int(c) + int(next(digits))) if c.isdecimal() else c for c in text)


def canonical(text: str, kind: str) -> str:
    """What makes two spellings the same entity."""
    if kind == "phone":
        code, rest = _dialled(text)
        return f"+{code} {rest}" if code else rest
    if kind in ("card", "ssn"):
        return _digits_of(text)
    if kind == "iban":
        return text.replace(" ", "").upper()
    if kind == "ipv6":
        return IPv6Address(text).exploded
    return text.lower() if kind in ("email", "person") else text


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """The rows of docs(text, ...) with surrogates in their texts; other columns stay.

    A null or empty text, and one without entities, is unchanged. Rows may repeat.
    """
    place = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        surrogates = _surrogates(key)
        texts = [
            text if not text else surrogates.rewrite(text, find_entities(text))
            for text in column(batch, "text")
        ]
        columns = list(batch.columns)
        columns[place] = pa.array(texts, type=batch.schema.field(place).type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, run, docs.schema)


def entity_table(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, kind, entity, surrogate, canonical, replaced) of each entity of docs(doc_id, text).

    `canonical` and `replaced` are the entity and its surrogate without differences of writing. One
    row per mention, of all input rows; a row without id has a null doc_id.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        surrogates, rows = _surrogates(key), []
        for doc_id, text in zip(column(batch, "doc_id"), texts_of(batch)):
            for e in find_entities(text):
                old = text[e.start : e.end]
                new = surrogates.replace(old, e.kind, e.gender)
                rows.append(
                    (doc_id, e.kind, old, new, canonical(old, e.kind), canonical(new, e.kind))
                )
        if not rows:
            return None
        names = ["doc_id", "kind", "entity", "surrogate", "canonical", "replaced"]
        kinds = [pa.int64(), *[pa.string()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=k) for v, k in zip(zip(*rows), kinds)], names=names
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        "doc_id long, kind string, entity string, surrogate string, canonical string, replaced string",
    )


def collisions(entities: DataFrame) -> DataFrame:
    """(kind, replaced, entities) of the surrogates that several entities share.

    The check that distinctness held over the corpus: no rows, because replacements are one to one
    within a format. Works on distinct entities, combined before the shuffle.
    """
    distinct = entities.select("kind", "canonical", "replaced").distinct()
    return (
        distinct.groupBy("kind", "replaced")
        .agg(F.count(F.lit(1)).alias("entities"))
        .where(F.col("entities") > 1)
    )


MENTIONS = "array<struct<kind:string,canonical:string,replaced:string>>"
_MENTION = pa.struct([(name, pa.string()) for name in ("kind", "canonical", "replaced")])


def _mentions(text: str | None, found: list[Entity], surrogates: Surrogates) -> list[dict[str, str]]:
    """The different entities of a text, without differences of writing, and what replaces them."""
    pairs = {(e.kind, e.gender, text[e.start : e.end]) for e in found}
    mentions = {
        (kind, canonical(old, kind), canonical(surrogates.replace(old, kind, gender), kind))
        for kind, gender, old in pairs
    }
    return [dict(zip(("kind", "canonical", "replaced"), m)) for m in sorted(mentions)]


def _require_distinct(mentions: DataFrame) -> None:
    """Raise if two entities of the (mentions) of all texts share a surrogate."""
    shared = collisions(mentions.select(F.explode(mentions.columns[0]).alias("m")).select("m.*")).count()
    if shared:
        raise ValueError(f"{shared} surrogates stand for several entities")


def pseudonymise_checked(docs: DataFrame, key: bytes) -> DataFrame:
    """As `pseudonymise`, but stored, after the check that no two entities of all texts share a surrogate.

    Texts are looked through once; what was found lies beside them until the check is done.
    """
    names, place = docs.columns, docs.columns.index("text")
    extra = "mentions of the text"
    while extra in names:
        extra += "_"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        surrogates, texts, mentions = _surrogates(key), [], []
        for text in column(batch, "text"):
            found = find_entities(text) if text else []
            texts.append(surrogates.rewrite(text, found) if found else text)
            mentions.append(_mentions(text, found, surrogates))
        columns = list(batch.columns)
        columns[place] = pa.array(texts, type=batch.schema.field(place).type)
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(mentions, type=pa.list_(_MENTION))], names=[*names, extra]
        )

    kind = F.lit(None).cast(MENTIONS)
    stored = materialise(map_batches(docs, run, docs.withColumn(extra, kind).schema), "pii")
    _require_distinct(stored.select(extra))
    return stored.drop(extra)


def _scanned(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_entities, kinds, mentions): surrogates in the text, and what they stand for, once a text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        surrogates, rows = _surrogates(key), []
        for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
            found = find_entities(text) if text else []
            new = surrogates.rewrite(text, found) if found else text
            listed = _mentions(text, found, surrogates)
            rows.append((doc_id, new, len(found), ",".join(sorted({e.kind for e in found})), listed))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(_MENTION))
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=k) for v, k in zip(zip(*rows), kinds)],
            names=["doc_id", "text", "n_entities", "kinds", "mentions"],
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        lambda batch: run(batch) if batch.num_rows else None,
        f"doc_id long, text string, n_entities long, kinds string, mentions {MENTIONS}",
    )


def pseudonymised_documents(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_entities, kinds) of docs(doc_id, text): the text with surrogates.

    `kinds` are the sorted distinct types found, joined by a comma. Texts are looked through once and stored; the
    collision check reads what was found, and raises if two entities of the corpus share a surrogate. One
    row per input row; a null text stays null and has no entities.
    """
    scanned = materialise(_scanned(docs, key), "pii")
    _require_distinct(scanned.select("mentions"))
    return scanned.drop("mentions")


_KEYED: dict[bytes, Surrogates] = {}


def _surrogates(key: bytes) -> Surrogates:
    """One per worker process and key."""
    if key not in _KEYED:
        _KEYED[key] = Surrogates(key)
    return _KEYED[key]
