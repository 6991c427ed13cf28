"""Personal data and secrets replaced by surrogates of the same kind.

A surrogate depends on a key, the kind and the value only, so one value has one surrogate in all documents. It has the
value's format: the same separators, letters for letters and digits for digits, valid checksums for valid ones, names
of the same gender and script. Over all documents no two values of a kind share a surrogate and no surrogate is a value
of the documents: clashes are found by an aggregate over the distinct values, and their losers draw again.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import stored

# Titles by gender, and given names by script and gender.
TITLES = {
    "male": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "господин", "κύριος"],
    "female": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "κυρία"],
    "any": ["Dr", "Prof"],
}
GIVEN = {
    ("latin", "male"): ["Adam", "Albert", "Bruno", "Carlos", "Daniel", "Eduard", "Felix", "Hugo", "Ivan", "Jakob", "Louis", "Marco", "Oliver", "Paul", "Robert", "Thomas"],
    ("latin", "female"): ["Alice", "Anna", "Beatrice", "Clara", "Diana", "Elena", "Emma", "Helena", "Ines", "Julia", "Laura", "Maria", "Nora", "Olivia", "Rosa", "Sofia"],
    ("cyrillic", "male"): ["Алексей", "Борис", "Виктор", "Иван", "Михаил", "Николай", "Павел", "Сергей"],
    ("cyrillic", "female"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Татьяна"],
    ("greek", "male"): ["Αλέξανδρος", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Παύλος"],
    ("greek", "female"): ["Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gar", "hol", "ki", "lor", "man", "ner", "ost", "pel", "ran", "sel", "tor", "vin", "wes"],
    "cyrillic": ["ба", "вен", "гор", "дан", "зин", "кол", "лев", "мир", "нов", "пет", "рин", "сов", "тар", "фед", "хов", "шин"],
    "greek": ["βα", "γορ", "δελ", "ζαν", "θεο", "καλ", "λεν", "μαρ", "νικ", "παπ", "ριν", "σταθ", "τελ", "φιλ", "χρι", "ψαλ"],
}
SCRIPTS = {"cyrillic": ("Ѐ", "ӿ"), "greek": ("Ͱ", "Ͽ")}

#: Words that make a name before them one of a street or place.
STREETS = ["Street", "Road", "Avenue", "Lane", "Drive", "Square", "Boulevard", "Court", "Bridge", "Park", "School", "University", "Straße", "Strasse", "Platz", "Weg", "Allee", "улица", "площадь"]
#: Family names that take another "а" for a woman.
MALE_ENDINGS = ("ов", "ев", "ёв", "ин", "ын")

GENDER_OF_TITLE = {title: gender for gender, titles in TITLES.items() for title in titles}
GENDER_OF_NAME = {name.lower(): gender for (_, gender), names in GIVEN.items() for name in names}

EMAIL = re.compile(r"[^\s@<>()\[\],;:\"|]+@[\w-]+(?:\.[\w-]+)+")
NUMBER = re.compile(r"(?<!\w)\+?\(?\d[\d().\- /]*\d(?!\w)")
HEX = re.compile(r"\b[0-9a-fA-F]{32,128}\b")
PREFIXED = re.compile(r"\b(?:AKIA|ghp_|gho_|sk-|xoxb-|xoxp-)[A-Za-z0-9_-]{16,}")
NAMED_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key)[\"']?\s*[=:]\s*[\"']?([^\s\"'`]{8,})")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")
IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:])")
WORD = r"[^\W\d_][^\W\d_]+(?:-[^\W\d_]+)*"
TITLED = re.compile(rf"\b({'|'.join(GENDER_OF_TITLE)})\b\.? ({WORD})(?: ({WORD}))?")
STREET = re.compile(rf" ?(?:{'|'.join(STREETS)})\b", re.IGNORECASE)
GIVEN_NAME = re.compile(rf"\b({'|'.join(n for names in GIVEN.values() for n in names)}) ({WORD})\b")
IP = re.compile(r"(?:\d{1,3}\.){3}\d{1,3}")
SSN = re.compile(r"\d{3}-\d{2}-\d{4}")
CARD = re.compile(r"\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3}(?![ .-]?\d))?|\d{4}[ -]\d{6}[ -]\d{5}")
#: With a country code, or as written in North America.
PHONE = re.compile(r"\+\d[\d().\- ]{6,17}\d|\(\d{3}\) ?\d{3}[ -]?\d{4}|\d{3}[-. ]\d{3}[-. ]\d{4}|[2-9]\d{9}")
#: As written in France, Spain, and Germany or Britain; the last takes 9 to 12 digits in all.
FRENCH = r"0[1-9]([ .-]?)\d{2}(?:\1\d{2}){3}"
SPANISH = r"[67]\d{2} \d{3} \d{3}|[6-9]\d{2} \d{2} \d{2} \d{2}|9\d \d{3} \d{2} \d{2}"
TRUNK = r"(?:\(0\d{2,4}\) ?|0\d{2,4}[ /-])\d{3,8}(?:[ -]\d{2,4}){0,2}|0[1-9]\d{8,9}"
NATIONAL = re.compile(rf"{FRENCH}|{SPANISH}|{TRUNK}")

#: Found in this order where a run holds more than one number; each between what the ones before it left.
SEVERAL = [
    re.compile(rf"(?<!\d)(?<!\d\.)(?:{IP.pattern})(?!\.?\d)"),
    re.compile(rf"(?<!\d)(?:{SSN.pattern})(?!\d)"),
    re.compile(rf"(?<!\d)(?:{CARD.pattern})(?!\d)"),
    re.compile(rf"(?<![\d.])(?:{PHONE.pattern})(?!\d)"),
    re.compile(rf"(?<!\d)(?<!\d[.,-])(?:{NATIONAL.pattern})(?!\d)"),
]
#: Fewer signs hold none of them.
LEAST_NUMBER = 7


class Mention(NamedTuple):
    start: int
    end: int
    kind: str
    value: str  # the form in which two mentions of one entity are equal


def digits_of(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def script_of(word: str) -> str:
    return next((name for name, (low, high) in SCRIPTS.items() if low <= word[0] <= high), "latin")


def number_kind(text: str) -> tuple[str, str] | None:
    """Kind and value of a run of digits and separators."""
    if IP.fullmatch(text):
        return ("ip", text) if all(int(part) < 256 for part in text.split(".")) else None
    if SSN.fullmatch(text):
        return "ssn", digits_of(text)
    if CARD.fullmatch(text):
        return "card", digits_of(text)
    if PHONE.fullmatch(text) and 7 <= len(digits_of(text)) <= 15:
        return "phone", digits_of(text)
    if NATIONAL.fullmatch(text) and 9 <= len(digits_of(text)) <= 12:
        return "phone", digits_of(text)
    return None


def numbers_within(text: str, start: int, end: int) -> Iterator[Mention]:
    """The numbers of a run that is not one number itself: IP addresses and SSNs first, as longer forms could take them in."""
    gaps = [(start, end)]
    for pattern in SEVERAL:
        left = []
        for low, high in gaps:
            for part in pattern.finditer(text, low, high):
                if kind := number_kind(part[0]):
                    yield Mention(*part.span(), *kind)
                    left.append((low, part.start()))
                    low = part.end()
            left.append((low, high))
        gaps = [(low, high) for low, high in left if high - low >= LEAST_NUMBER]


def family_value(word: str) -> str:
    """A family name in the form that men and women share."""
    value = word.lower()
    return value[:-1] if value.endswith(tuple(e + "а" for e in MALE_ENDINGS)) else value


def given(start: int, end: int, word: str, gender: str) -> Mention:
    """A given name; if it is a known one it has its own gender, whatever the title says, so it is one entity."""
    gender = GENDER_OF_NAME.get(word.lower(), gender)
    return Mention(start, end, f"given-{gender}-{script_of(word)}", word.lower())


def family(start: int, end: int, word: str) -> Mention:
    return Mention(start, end, f"family-{script_of(word)}", family_value(word))


def name_mentions(text: str) -> Iterator[Mention]:
    """Given and family names behind a title or a known given name; each part is an entity of its own.

    Names of streets and places are left alone.
    """
    for found in TITLED.finditer(text):
        parts = [k for k in (2, 3) if found[k] and found[k][0].isupper()]
        if 2 not in parts:
            continue
        if 3 in parts or found[2].lower() in GENDER_OF_NAME:
            yield given(*found.span(2), found[2], GENDER_OF_TITLE[found[1]])
        else:
            yield family(*found.span(2), found[2])
        if 3 in parts:
            yield family(*found.span(3), found[3])
    for found in GIVEN_NAME.finditer(text):
        if found[2][0].isupper() and not STREET.match(text, found.start(2)) and not STREET.match(text, found.end()):
            yield given(*found.span(1), found[1], "any")
            yield family(*found.span(2), found[2])


def ipv6_mentions(text: str) -> Iterator[Mention]:
    for found in IPV6.finditer(text):
        if any(c.isdigit() for c in found[0]):
            try:
                yield Mention(*found.span(), "ip6", ipaddress.IPv6Address(found[0]).compressed)
            except ValueError:
                continue


def mentions(text: str) -> list[Mention]:
    """All mentions in a text in their order; of those that overlap the first and longest."""
    found: list[Mention] = []
    if "@" in text:
        for m in EMAIL.finditer(text):
            end = m.end()
            found.append(Mention(m.start(), end, "email", text[m.start() : end].lower()))
    for m in NUMBER.finditer(text):
        if kind := number_kind(m[0]):
            found.append(Mention(*m.span(), *kind))
        elif len(m[0]) >= LEAST_NUMBER:  # in brackets, or several numbers side by side
            found += numbers_within(text, *m.span())
    for pattern in (HEX, PREFIXED):
        found += [Mention(*m.span(), "secret", m[0]) for m in pattern.finditer(text) if not m[0].isalpha()]
    if "=" in text or ":" in text:
        found += [Mention(*m.span(1), "secret", m[1]) for m in NAMED_SECRET.finditer(text)]
    found += [Mention(*m.span(), "iban", m[0].replace(" ", "")) for m in IBAN.finditer(text)]
    if text.count(":") > 1:
        found += ipv6_mentions(text)
    found += name_mentions(text)
    found.sort(key=lambda m: (m.start, m.start - m.end))
    kept: list[Mention] = []
    for m in found:
        if not kept or m.start >= kept[-1].end:
            kept.append(m)
    return kept


class Draw:
    """Numbers that depend on key, kind, value and attempt alone."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int) -> None:
        seed = hmac.new(key, f"{kind}|{attempt}|{value}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self.seed, self.number, self.count = seed, int.from_bytes(seed, "big"), 0

    def below(self, n: int) -> int:
        if self.number < n << 64:
            self.count += 1
            self.number = int.from_bytes(hashlib.sha256(self.seed + self.count.to_bytes(4, "big")).digest(), "big")
        self.number, left = divmod(self.number, n)
        return left

    def like(self, c: str) -> str:
        """A letter for a letter of the same case and script, a digit for a digit, anything else as it is."""
        if c.isdigit():
            return str(self.below(10))
        if not c.isalpha():
            return c
        if script_of(c) == "cyrillic":
            drawn = chr(ord("а") + self.below(32))
        elif script_of(c) == "greek":
            drawn = chr(ord("α") + self.below(17))
        else:
            drawn = chr(ord("a") + self.below(26))
        return drawn.upper() if c.isupper() else drawn


def luhn_digit(digits: str) -> str:
    """The last digit that makes ``digits`` plus it valid."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_remainder(text: str) -> int:
    """1 for a valid one."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The replacement's value; more attempts draw from larger spaces where the first is small."""
    draw = Draw(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")[:-1]
        extra = "".join(chr(97 + draw.below(26)) for _ in range(attempt))
        return "".join(map(draw.like, local)) + extra + "@" + ".".join("".join(map(draw.like, x)) for x in labels) + ".example"
    if kind == "ip":
        first = 10 if attempt < 8 else 1 + draw.below(254)
        return f"{first}.{draw.below(256)}.{draw.below(256)}.{draw.below(256)}"
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[1:-1])
        check = luhn_digit(body)
        valid = luhn_digit(value[:-1]) == value[-1]
        return body + (check if valid else str((int(check) + 1 + draw.below(9)) % 10))
    if kind == "ssn":
        return "9" + "".join(str(draw.below(10)) for _ in value[1:])
    if kind == "phone":
        lead = max(1, len(value) - 10)
        return value[:lead] + "".join(str(draw.below(10)) for _ in value[lead:])
    if kind == "iban":
        drawn = value[:2] + "".join(map(draw.like, value[2:]))
        if iban_remainder(value) != 1:
            return drawn
        body = drawn[:2] + "00" + drawn[4:]
        return f"{drawn[:2]}{98 - iban_remainder(body):02d}{drawn[4:]}"
    if kind == "ip6":  # a private range; groups as long as they were
        groups = [g and "123456789abcdef"[draw.below(15)] + "".join("0123456789abcdef"[draw.below(16)] for _ in g[1:]) for g in value.split(":")]
        return ":".join(["fd" + "".join("0123456789abcdef"[draw.below(16)] for _ in "12"), *groups[1:]]) if groups[0] else ":".join(groups)
    if kind == "secret":
        if re.fullmatch("[0-9a-fA-F]+", value):
            signs = "0123456789ABCDEF" if value.isupper() else "0123456789abcdef"
            return "".join(signs[draw.below(16)] for _ in value)
        return "".join(map(draw.like, value))
    part, *rest = kind.split("-")
    script = rest[-1]
    if part == "given" and not attempt:
        genders = [rest[0]] if rest[0] != "any" else ["male", "female"]
        names = [n for g in genders for n in GIVEN[script, g]]
        return names[draw.below(len(names))].lower()
    syllables = SYLLABLES[script]

    def name_part() -> str:
        return "".join(syllables[draw.below(len(syllables))] for _ in range(3 + attempt // 2))

    if part == "family":
        return "-".join(name_part() + ("ов" if own.endswith(MALE_ENDINGS) else "") for own in value.split("-"))
    name = name_part()
    # female given names end in a vowel, male ones do not
    return name + {"female": {"latin": "a", "cyrillic": "а", "greek": "α"}, "male": {"latin": "n", "cyrillic": "н", "greek": "ς"}}.get(rest[0], {}).get(script, "")


def in_format(value: str, original: str, kind: str) -> str:
    """A surrogate written as the original mention was."""
    if kind in ("card", "ssn", "phone", "iban"):
        signs = iter(value)
        return "".join(next(signs) if c.isalnum() else c for c in original)
    if kind.startswith(("given", "family")):
        if kind == "family-cyrillic" and family_value(original) != original.lower():
            value += "а"
        return value.upper() if original.isupper() else "-".join(p.capitalize() for p in value.split("-"))
    if kind in ("email", "ip6") and original.isupper():
        return value.upper()
    return value


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, list[Mention]]:
    found = mentions(text)
    parts, at = [], 0
    for m in found:
        own = surrogate(key, m.kind, m.value, attempts.get((m.kind, m.value), 0))
        parts += [text[at : m.start], in_format(own, text[m.start : m.end], m.kind)]
        at = m.end
    return "".join([*parts, text[at:]]), found


def entity_mentions(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text_key (hash of the text), kind and value of the entities of each document; stored."""

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, text_key, *entity)
                for doc_id, text, text_key in zip(*(batch.column(k).to_pylist() for k in range(3)))
                for entity in sorted({(m.kind, m.value) for m in mentions(text or "")})
            ]
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "kind", "value"])

    plain = F.col(text).cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), plain, F.xxhash64(plain))
    return stored(rows.mapInArrow(detect, "doc_id long, text_key long, kind string, value string"), "mentions")


def settle(entities: DataFrame, key: bytes, most_rounds: int = 200) -> DataFrame:
    """kind, value, attempt and surrogate of distinct entities, no two alike within a kind; stored.

    Each round draws for the losers of the one before, and the smallest value keeps a surrogate that several have. Only
    the number of losers reaches the driver.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, attempts = (batch.column(k).to_pylist() for k in range(3))
            drawn = [surrogate(key, *row) for row in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], ["kind", "value", "attempt", "surrogate"])

    schema = "kind string, value string, attempt int, surrogate string"
    settled, open_ = None, entities.select("kind", "value", F.lit(0).alias("attempt"))
    real = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("is_real"))
    for round_ in range(most_rounds):
        drawn = stored(open_.mapInArrow(draw, schema), f"drawn-{round_}")
        # what was settled before keeps its surrogate: it counts as smaller than any value
        taken = drawn.select("kind", "surrogate", "value", F.lit(1).alias("turn"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "surrogate", "value", F.lit(0).alias("turn")))
        owners = taken.groupBy("kind", "surrogate").agg(F.min(F.struct("turn", "value")).alias("owner"))
        judged = (
            drawn.join(owners, ["kind", "surrogate"])
            .join(real, ["kind", "surrogate"], "left")
            .withColumn("wins", (F.col("owner.value") == F.col("value")) & F.col("is_real").isNull())
        )
        judged = stored(judged.select("kind", "value", "attempt", "surrogate", "wins"), f"judged-{round_}")
        won = judged.where("wins").drop("wins")
        settled = won if settled is None else stored(settled.unionByName(won), "settled")
        open_ = judged.where("not wins").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            return settled
    raise RuntimeError("surrogates did not settle")


def with_surrogates(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``doc`` (all columns, the text replaced) and ``replaced`` (kind and span in the original of each mention).

    Most values keep their first draw, which tasks make again from the key; only the attempts of values that drew again
    are joined to the documents with such a value, from a stored table whose size Spark knows. A null text stays null, a
    document without a doc_id is treated like any other, and rows repeat as they come.
    """
    found = entity_mentions(docs, text)
    settled = settle(stored(found.select("kind", "value").distinct(), "entities"), key)
    again = found.join(settled.where("attempt > 0").select("kind", "value", "attempt"), ["kind", "value"])
    again = stored(
        again.groupBy(F.col("doc_id").alias("again_id"), F.col("text_key").alias("again_key")).agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("again")),
        "drawn-again",
    )

    @F.pandas_udf("text string, replaced array<struct<kind:string,start:long,end:long>>")
    def rewritten(texts: pd.Series, again: pd.Series) -> pd.DataFrame:
        new, spans = [], []
        for text, attempts in zip(texts, again):
            if text is None:
                new.append(None)
                spans.append([])
                continue
            own = {(a["kind"], a["value"]): a["attempt"] for a in attempts} if attempts is not None else {}
            changed, found = replace(text, key, own)
            new.append(changed)
            spans.append([{"kind": m.kind, "start": m.start, "end": m.end} for m in found])
        return pd.DataFrame({"text": new, "replaced": spans})

    rows = docs.select(F.struct("*").alias("doc"))
    same = F.col("doc")["doc_id"].cast("long").eqNullSafe(F.col("again_id"))
    joined = rows.join(again, same & (F.xxhash64(F.col("doc")[text].cast("string")) == F.col("again_key")), "left")
    made = joined.select("doc", rewritten(F.col("doc")[text].cast("string"), F.col("again")).alias("made"))
    fields = [F.col("made.text").alias(name) if name == text else F.col("doc")[name].alias(name) for name in docs.columns]
    return made.select(F.struct(*fields).alias("doc"), F.col("made.replaced").alias("replaced"))
