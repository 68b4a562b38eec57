"""Surrogates for personal data: keyed, consistent in type, gender, script and format.

Numbers and addresses are mapped by a keyed permutation of all values of the
same format (each letter stays a letter of its alphabet and case, each digit a
digit), so two entities never share a surrogate and an entity has the same one
everywhere. Names have no such format: a given name goes to one of the same
gender and script, a surname to one of the same script, and distinctness is
checked over the whole corpus: of several names with one surrogate all but the
first are drawn again until none is left.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, materialize, read_table

#: The key of the registered query; real runs pass their own.
DEMO_KEY = b"wordloom-demo-key"

# Forms of address by gender.
TITLES = {
    "m": "Mr Mister Sir Herr Monsieur Señor Sr Don господин".split(),
    "f": "Mrs Ms Miss Madam Frau Mme Madame Mlle Señora Sra Señorita Srta Doña госпожа".split(),
    "n": "Dr Prof Professor Doktor Docteur Doctor Doctora".split(),
}
GENDER = {t.lower(): g for g, ts in TITLES.items() for t in ts}
# Given names by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Boris Carl David Emil Felix Georg Henri Ivo Jonas Karl Lucas Martin Noel Oscar Paul".split(),
    ("latin", "f"): "Ada Berta Clara Diana Emma Flora Greta Helen Ines Julia Karin Laura Maria Nora Olga Paula".split(),
    ("latin", "n"): "Alex Chris Dana Eden Jules Kim Leslie Morgan Noa Robin Sam Sasha Toni Val Yael Zoe".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Марк".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Ирина Лидия Мария Нина".split(),
    ("cyrillic", "n"): "Саша Женя Валя Слава Тоня Паша Шура Мика Рома Юля".split(),
    ("greek", "m"): "Άρης Βασίλης Γιάννης Δήμος Ηλίας Θωμάς Κώστας Λουκάς Μάριος Νίκος".split(),
    ("greek", "f"): "Άννα Βάσω Γεωργία Δέσποινα Ελένη Ζωή Ηρώ Θάλεια Κατερίνα Μαρία".split(),
}
# Given names, besides those of ``GIVEN``, that tell a name without a form of address.
LISTED = {
    "m": ("James John Robert Michael William Richard Thomas Charles Christopher Daniel Matthew Anthony Steven Andrew Joshua "
          "Kenneth Kevin Brian George Edward Ronald Timothy Jason Jeffrey Ryan Jacob Nicholas Jonathan Stephen Justin Scott "
          "Benjamin Samuel Gregory Alexander Patrick Peter Hans Jürgen Wolfgang Klaus Stefan Andreas Matthias Uwe Jean Pierre "
          "Michel Philippe Jacques François José Juan Carlos Luis Miguel Pedro Javier Fernando Jorge "
          "Александр Дмитрий Сергей Андрей Алексей Михаил Николай Владимир Γιώργος Δημήτρης Κωνσταντίνος Ιωάννης").split(),
    "f": ("Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Sandra Margaret Ashley Kimberly "
          "Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Sharon Cynthia Kathleen Amy Angela Anna Anne "
          "Catherine Alice Jane Ursula Monika Petra Sabine Renate Marie Nathalie Isabelle Sylvie Françoise Carmen Ana Isabel "
          "Pilar Teresa Lucía Ольга Татьяна Наталья Екатерина Светлана Людмила Ελένη Αικατερίνη Βασιλική Σοφία").split(),
}
KNOWN = {n.lower(): g for g in "mf" for n in (*LISTED[g], *(n for (_, h), ns in GIVEN.items() if h == g for n in ns))}
# Letters of which surnames are made, and endings.
SYLLABLES = {"latin": ("bdfgklmnprstv", "aeiou", ("n", "r", "s", "l", "")),
             "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("ов", "ин", "ко", "ев", "ук")),
             "greek": ("βγδκλμνπρστ", "αειο", ("ς", "ου", "ης", "ας", "ος"))}
# The country codes of two digits (1 and 7 have one, all others three).
TWO_DIGIT_CODES = frozenset((
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 "
    "91 92 93 94 95 98").split())
# The alphabets within which letters and digits are permuted.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "àáâäåæçèéêëìíîïñòóôöøùúûüýœ",
             "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")
_ALPHABET = {c: (a, i) for a in ALPHABETS for i, c in enumerate(a)}

_UPPER = "A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΩА-ЯЁ"
_NAME = rf"[{_UPPER}][^\W\d_]+(?:[-'’][{_UPPER}][^\W\d_]+)*"
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=lambda t: (-len(t), t)))
# in the order in which they claim a stretch of text
PATTERNS = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]+@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,}(?![\w-])"), "@"),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)", re.A),
     "."),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.A), "-"),
    ("phone", re.compile(r"(?<!\w)\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
                         r"|(?<!\w)\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\w)"
                         r"|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w.-]\d)", re.A), ""),
    ("card", re.compile(r"(?<!\w)(?:\d{4}([ -])(?:\d{4}\1){2}\d{1,7}|\d{13,19})(?!\w)", re.A), ""),
    ("name", re.compile(rf"(?<!\w)({_TITLE})\.?[ \t]+({_NAME}(?:[ \t]+{_NAME}){{0,2}})"), " "),
)
# a listed given name, more names or initials, and a surname; any capitalised word
_PAIR = re.compile(rf"(?<![\w-])({'|'.join(sorted((n.title() for n in KNOWN), key=lambda n: (-len(n), n)))})"
                   rf"((?:[ \t]+(?:{_NAME}|[{_UPPER}]\.)){{0,1}}[ \t]+{_NAME})(?!\w)")
_CAPITAL = re.compile(rf"(?<!\w){_NAME}(?!\w)")


@dataclass(frozen=True)
class Entity:
    """An entity of a text: where it is, its kind, its class (format or gender and script) and canonical form."""

    start: int
    end: int
    kind: str
    group: str
    canon: str


def script(word: str) -> str:
    first = word[0].lower()
    return "cyrillic" if "а" <= first <= "ё" else "greek" if "ά" <= first <= "ώ" else "latin"


def find(text: str | None) -> list[Entity]:
    """The entities of a text in order; of overlapping ones the kind that comes first in ``PATTERNS`` counts.

    A name with a title gives one entity per word: given names, and the surname.
    So does a listed given name (``KNOWN``) before a surname. Wherever else the
    text has one of its names as a capitalised word, that is the same entity.
    """
    if not text:
        return []
    names: dict[str, dict[str, str]] = {"given": {}, "surname": {}}  # of this text: canonical form and group

    def free():  # what was not claimed so far
        ends = [0, *(x for t in sorted(taken) for x in t), len(text)]
        return list(zip(ends[::2], ends[1::2], strict=True))

    def named(at, words, gender):
        for k, w in enumerate(words):
            kind = "surname" if k == len(words) - 1 else "given"
            canon = w[0].lower()
            group = script(w[0]) + (f"/{gender}" if kind == "given" else "")
            names[kind].setdefault(canon, group)
            out.append(Entity(at + w.start(), at + w.end(), kind, group, canon))

    taken: list[tuple[int, int]] = []
    out: list[Entity] = []
    for kind, pattern, sign in PATTERNS:
        if sign and sign not in text:
            continue
        for m in [m for x, y in free() for m in pattern.finditer(text, x, y)]:
            a, b = m.span(2) if kind == "name" else m.span()
            taken.append((a, b))
            if kind != "name":
                out.append(Entity(a, b, kind, "", _canonical(kind, m[0])))
                continue
            named(a, list(re.finditer(r"\S+", m[2])), GENDER[m[1].lower()])
    for m in [m for x, y in free() for m in _PAIR.finditer(text, x, y)]:
        taken.append(m.span())
        words = [w for w in re.finditer(r"\S+", m[0]) if not w[0].endswith(".")]  # initials stay
        first = words[0][0].lower()
        gender = names["given"].get(first, f"/{KNOWN[first]}").partition("/")[2]
        named(m.start(), words, gender)
    if names["given"] or names["surname"]:
        for x, y in free():
            found = list(_CAPITAL.finditer(text, x, y))
            for m, after in zip(found, [*found[1:], None], strict=False):
                canon = m[0].lower()
                before_name = after is not None and after[0].lower() in names["surname"] and not text[
                    m.end() : after.start()].strip(" \t")
                kind = "given" if canon in names["given"] and (before_name or canon not in names["surname"]) else "surname"
                if canon in names[kind]:
                    out.append(Entity(m.start(), m.end(), kind, names[kind][canon], canon))
    return sorted(out, key=lambda e: e.start)


def _canonical(kind: str, raw: str) -> str:
    if kind == "email":
        return raw.lower()
    if kind == "ip":
        return ".".join(str(int(x)) for x in raw.split("."))
    if kind == "phone" and raw[0] == "+":  # the country code stays
        digits = re.sub(r"\D", "", raw)
        size = 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3
        return f"+{digits[:size]}/{digits[size:]}"
    return re.sub(r"\D", "", raw)


def _random(key: bytes, *what) -> int:
    return int.from_bytes(blake2b("\x1f".join(map(str, what)).encode(), key=key[:64], digest_size=32).digest())


def permuted(key: bytes, tweak: str, x: int, size: int) -> int:
    """The image of ``x`` under a keyed permutation of 0 .. size - 1 (a Feistel network that walks back into range)."""
    if size < 2:
        return x
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(x, b)
        for r in range(4):
            left = (left + _random(key, tweak, size, r, "l", right)) % a
            right = (right + _random(key, tweak, size, r, "r", left)) % b
        x = left * b + right
        if x < size:
            return x


def shaped(key: bytes, tweak: str, text: str) -> str:
    """A permuted text of the same shape: every character that is in an alphabet stays in it, others stay."""
    x, size = 0, 1
    for c in text:
        if c in _ALPHABET:
            alphabet, i = _ALPHABET[c]
            x, size = x * len(alphabet) + i, size * len(alphabet)
    shape = "".join(_ALPHABET[c][0][0] if c in _ALPHABET else c for c in text)
    x = permuted(key, f"{tweak}|{shape}", x, size)
    out = []
    for c in reversed(text):
        if c in _ALPHABET:
            alphabet = _ALPHABET[c][0]
            x, i = divmod(x, len(alphabet))
            c = alphabet[i]
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> int:
    """The digit that completes ``digits`` to a number with a right check digit."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


@lru_cache(maxsize=50_000)
def surrogate(key: bytes, kind: str, group: str, canon: str, attempt: int = 0) -> str:
    """The canonical surrogate of an entity; names differ from attempt to attempt."""
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        labels = domain.split(".")
        keep = 2 if len(labels) > 2 or labels[-2] == "example" else 1  # registered part, so that domains still agree
        head = shaped(key, "domain|" + ".".join(labels[-keep:]), ".".join(labels[:-keep]))
        return f"{shaped(key, 'local|' + domain, local)}@" + ".".join(x for x in (head, *labels[-keep:]) if x)
    if kind == "ip":
        n = 0
        for x in canon.split("."):
            n = n << 8 | int(x)
        n = permuted(key, "ip", n, 1 << 32)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "card":
        body = shaped(key, "card", canon[:-1])
        off = (int(canon[-1]) - _luhn(canon[:-1])) % 10  # a right check digit stays right
        return body + str((_luhn(body) + off) % 10)
    if kind == "phone" and "/" in canon:
        code, _, rest = canon.partition("/")
        return f"{code}/{shaped(key, 'phone' + code, rest)}"
    if kind in ("phone", "ssn"):
        return shaped(key, kind, canon)
    name, _, gender = group.partition("/")
    x = _random(key, kind, group, canon, attempt)
    consonants, vowels, endings = SYLLABLES[name]

    def syllables(n):
        nonlocal x
        out = ""
        for _ in range(n):
            x, i = divmod(x, len(consonants))
            x, j = divmod(x, len(vowels))
            out += consonants[i] + vowels[j]
        return out

    if kind == "given":
        pool = GIVEN.get((name, gender)) or GIVEN[(name, "m")]
        x, i = divmod(x, len(pool))
        return (pool[i] + (syllables(min(1 + attempt // 8, 6)) if attempt else "")).lower()
    x, i = divmod(x, len(endings))
    return syllables(4) + endings[i]


def _dressed(kind: str, raw: str, new: str) -> str:
    """The surrogate in the case and punctuation of the text it replaces."""
    if kind in ("phone", "ssn", "card"):
        digits = iter(new.replace("/", "").replace("+", ""))
        return "".join(next(digits) if c.isdigit() else c for c in raw)
    if kind == "email":
        return "".join(n.upper() if r.isupper() else n for r, n in zip(raw, new, strict=False)) + new[len(raw):]
    if kind in ("given", "surname"):
        return new.upper() if raw.isupper() and len(raw) > 1 else new[0].upper() + new[1:]
    return new


def replaced(key: bytes, text: str, attempts: dict[tuple[str, str, str], int], entities=None) -> tuple[str, list[tuple]]:
    """The text with surrogates for its entities, and (kind, start, end) of each in the new text.

    ``entities`` are those found before, as (kind, group, canon, start, end).
    """
    if entities is None:
        entities = [(e.kind, e.group, e.canon, e.start, e.end) for e in find(text)]
    out, spans, at, size = [], [], 0, 0
    for kind, group, canon, start, end in entities:
        new = _dressed(kind, text[start:end], surrogate(key, kind, group, canon, attempts.get((kind, group, canon), 0)))
        out += [text[at:start], new]
        size += start - at
        spans.append((kind, size, size + len(new)))
        size += len(new)
        at = end
    out.append(text[at:])
    return "".join(out), spans


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("grp", pa.string()), ("canon", pa.string()),
                             ("start", pa.int32()), ("end", pa.int32())]))
_FOUND_SQL = "array<struct<kind:string,grp:string,canon:string,start:int,end:int>>"


def _scanned(rows: DataFrame, id_type: str) -> DataFrame:
    """``rows(id, text)`` with the entities of every text in order; each text is read once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": e.kind, "grp": e.group, "canon": e.canon, "start": e.start, "end": e.end} for e in find(t)]
                     if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, _FOUND)], ["id", "text", "found"])

    return rows.mapInArrow(run, f"id {id_type}, text string, found {_FOUND_SQL}")


def assigned(entities: DataFrame, key: bytes, max_attempts: int = 1000) -> DataFrame:
    """(kind, grp, canon, attempt, surrogate) with distinct surrogates per kind, from distinct entities."""
    @F.pandas_udf("string")
    def draw(kind: pd.Series, grp: pd.Series, canon: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, *x) for x in zip(kind, grp, canon, attempt, strict=True)], dtype=object)

    def drawn(df):
        return df.withColumn("surrogate", draw("kind", "grp", "canon", "attempt"))

    cur = materialize(drawn(entities.select("kind", "grp", "canon").distinct().withColumn("attempt", F.lit(0))),
                      "surrogates")
    for _ in range(max_attempts):
        mine = F.struct("attempt", "grp", "canon")
        clash = cur.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("n"), F.min(mine).alias("first")).filter(
            "n > 1").select("kind", "surrogate", "first")
        clash = materialize(clash, "clashes")
        if clash.isEmpty():
            return cur
        lost = cur.join(clash, ["kind", "surrogate"], "left").withColumn(
            "attempt", F.col("attempt") + F.coalesce((mine != F.col("first")).cast("int"), F.lit(0)))
        cur = materialize(drawn(lost.select("kind", "grp", "canon", "attempt")), "surrogates")
    raise RuntimeError("names still share surrogates")


def pseudonymize(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_entities, entities): one row per row of ``docs``, its whole text with surrogates.

    ``entities`` are (kind, start, end) in the new text, in code points. Null
    stays null with no entities; empty texts stay empty; repeated rows and null
    ids are kept; other columns are not read; an empty table gives an empty
    result.
    """
    bounded_batches(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = _scanned(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), id_type)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "texts-with-entities")
    entity = ["kind", "grp", "canon"]
    named = rows.select("row", F.explode("found").alias("e")).select("row", "e.kind", "e.grp", "e.canon")
    again = assigned(named, key).filter("attempt > 0").select(*entity, "attempt")
    if again.isEmpty():  # nothing but first draws: the texts need not move
        rows = rows.withColumn("again", F.lit(None).cast(
            "array<struct<kind:string,grp:string,canon:string,attempt:int>>"))
    else:
        per_row = named.distinct().join(again, entity).groupBy("row").agg(
            F.collect_list(F.struct(*entity, "attempt")).alias("again"))  # the entities of one text
        rows = rows.join(materialize(per_row, "attempts"), "row", "left")
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, found, more in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                attempts = {(x["kind"], x["grp"], x["canon"]): x["attempt"] for x in more or ()}
                new, put = replaced(key, text, attempts, [tuple(e.values()) for e in found]) if found else (text, [])
                texts.append(new)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in put])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(texts, pa.string()), pa.array([len(s) for s in spans], pa.int32()),
                pa.array(spans, span)], ["id", "text", "n_entities", "entities"])

    return rows.select("id", "text", "found", "again").mapInArrow(
        run, f"id {id_type}, text string, n_entities int, entities array<struct<kind:string,start:int,end:int>>")


def op3_surrogates(spark, sf_dir: str) -> DataFrame:
    return pseudonymize(read_table(spark, sf_dir, "documents"), DEMO_KEY).withColumnRenamed("id", "doc_id")
