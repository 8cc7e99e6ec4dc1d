"""Personal data replaced by keyed surrogates.

Detected entities - mail addresses, phone, card, social security and account numbers, network
addresses, secrets, and names after a title or with a known given name - are replaced by what a
keyed hash of their canonical form gives: digits for digits, letters for letters of the same case
and script, the same separators, a valid check digit where the original had one, a given name of
the same gender. The same entity gets the same surrogate in every text (coreference), whatever its
spelling. Distinctness is checked over the whole corpus: of entities that fall on one surrogate,
or on an entity that really occurs, all but the first are hashed anew until none collide.

As a task can compute every first surrogate itself, only the entities hashed anew have to be
carried to the texts: as a list in every task where they are few, by a join otherwise.
"""

from __future__ import annotations

import hashlib
import re
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import keep, slices, with_row_id

#: Entities hashed anew that are sent to every task; more are joined. The result is the same.
LISTED = 50_000

# Titles with the gender they tell (f, m, or n for neither).
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f",
    "Sr": "m", "Sra": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Господин": "m", "Госпожа": "f",
}
# Common given names by gender.
GIVEN = {
    "f": ("Alice", "Anna", "Barbara", "Carmen", "Claudia", "Elena", "Elizabeth", "Emily", "Emma", "Hannah", "Isabel", "Jennifer", "Julia", "Karen", "Laura", "Linda", "Lucía", "Maria", "María", "Mary", "Monika", "Olivia", "Patricia", "Sarah", "Sophie", "Susan", "Анна", "Елена", "Мария", "Ольга"),
    "m": ("Alejandro", "Andreas", "Carlos", "Charles", "Daniel", "David", "Fernando", "Hans", "James", "Javier", "Jean", "John", "José", "Jürgen", "Klaus", "Louis", "Manuel", "Michael", "Pablo", "Paul", "Peter", "Pierre", "Robert", "Stefan", "Thomas", "William", "Александр", "Иван", "Сергей"),
}
GENDER = {n.lower(): g for g, names in GIVEN.items() for n in names}

WORD = r"[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё]+)?"
PATTERNS = (
    ("email", re.compile(r"(?<![\w.%+-])[\w%+-][\w.%+-]*+@[\w-]+(?:\.[\w-]+)+"), "@"),
    ("secret", re.compile(r"(?<!\w)(?:AKIA[0-9A-Z]{16}|(?<=password=)[^\s\"']+|(?<=password = )[^\s\"']+|gh[pousr]_[0-9A-Za-z]{36})(?!\w)"), None),
    ("secret", re.compile(r"(?i)(?<=token = \")[^\s\"]{8,}(?=\")|(?<=token=)[^\s\"']{8,}|(?<=api_key=)[^\s\"']{8,}|(?<=secret=)[^\s\"']{8,}"), "="),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)"), "."),
    ("account", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"), None),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), "-"),
    ("card", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"), None),
    ("phone", re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-])"), None),
    ("phone", re.compile(r"(?<![\w.+-])\+\d{8,14}(?!\w)"), "+"),
)
NAME = re.compile(
    rf"(?<!\w)(?:(?P<title>{'|'.join(TITLES)})\.? (?P<first>{WORD})(?: (?P<last>{WORD}))?"
    rf"|(?P<given>{'|'.join(sorted((n for g in GIVEN.values() for n in g), key=len, reverse=True))})(?!\w)(?: (?P<family>{WORD}))?)")


def canonical(kind: str, text: str) -> str:
    """The form under which spellings of an entity are the same."""
    if kind == "email" or kind[:4] == "name":
        return text.lower()
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "account":
        return text.replace(" ", "")
    if kind == "phone":
        return re.sub(r"\D", "", re.sub(r"^\+\d{1,3}(?=[ .(-])", "", text))
    return text


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form), in order and without overlaps; earlier kinds win."""
    if not text:
        return []
    taken: list[tuple[int, int, str, str]] = []

    def take(start: int, end: int, kind: str) -> None:
        if all(end <= s or start >= e for s, e, _, _ in taken):
            taken.append((start, end, kind, canonical(kind, text[start:end])))

    for kind, pattern, hint in PATTERNS:
        if hint is None or hint in text:
            for m in pattern.finditer(text):
                end = m.end()
                take(m.start(), end - len(m.group()) + len(m.group().rstrip(".-")) if kind == "email" else end, kind)
    for m in NAME.finditer(text):
        if m["title"]:
            known = GENDER.get(m["first"].lower())
            if m["last"] or known:
                take(*m.span("first"), "name_" + (known or TITLES[m["title"]]))
            if m["last"] or not known:
                take(*(m.span("last") if m["last"] else m.span("first")), "name_s")
        else:
            take(*m.span("given"), "name_" + GENDER[m["given"].lower()])
            if m["family"] and m["family"].lower() not in GENDER:
                take(*m.span("family"), "name_s")
    return sorted(taken)


class Draws:
    """Numbers from a keyed hash of an entity."""

    def __init__(self, key: bytes, kind: str, canon: str, attempt: int) -> None:
        self.seed = hashlib.blake2b(f"{kind}\0{attempt}\0{canon}".encode("utf-8", "surrogatepass"), key=key[:64]).digest()
        self.state, self.turn = 0, 0

    def below(self, n: int) -> int:
        if self.state < 1 << 32:
            self.turn += 1
            self.state = int.from_bytes(hashlib.blake2b(self.seed + self.turn.to_bytes(4, "big")).digest(), "big")
        self.state, r = divmod(self.state, n)
        return r


# Letters that names are made of, by script; endings by gender.
LETTERS = {"latin": ("bdfglmnprstv", "aeiou"), "cyrillic": ("бвгдлмнрст", "аеиоу")}
ENDINGS = {"latin": {"f": ("a", "ina", "elle"), "m": ("o", "an", "us"), "n": ("en", "is"), "s": ("ner", "son", "ler", "mann")},
           "cyrillic": {"f": ("а", "ина"), "m": ("ан", "слав"), "n": ("ен",), "s": ("енко", "ский", "ов")}}


def _check_digit(digits: str) -> str:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return str(-total % 10)


#: What a character of a secret may become if it is neither a letter nor a digit.
SYMBOLS = "".join(c for c in string.punctuation if c not in "\"'")


@lru_cache(4096)
def _alike(block: int, category: str) -> str:
    """Characters of a category (letters with their case, digits, symbols) in a block of 256."""
    block_chars = map(chr, range(block << 8, block + 1 << 8))
    return "".join(c for c in block_chars if unicodedata.category(c) == category and not c.isspace() and c not in "\"'")


def _secret(draw: Draws, canon: str, attempt: int) -> str:
    """Every character is drawn, but the mark of a known format and single separators between
    letters or digits; further attempts grow, so that they never run out."""
    known = re.match(r"AKIA(?=[0-9A-Z]{16}$)", canon)
    head = len(known.group()) if known else 0
    if re.fullmatch(r"[0-9a-f]+", canon):
        return "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(canon) + attempt // 2))
    out = [canon[:head]]
    for i in range(head, len(canon)):
        c = canon[i]
        if c in "-_." and canon[i - 1:i].isalnum() and canon[i + 1:i + 2].isalnum():
            out.append(c)
        elif c.isascii() and not c.isalnum():
            out.append(SYMBOLS[draw.below(len(SYMBOLS))])
        elif c.isascii():
            of = string.digits if c.isdigit() else string.ascii_lowercase if c.islower() else string.ascii_uppercase
            # the first of several digits stays a digit other than 0
            out.append(str(1 + draw.below(9)) if i == 0 and c.isdigit() and c != "0" else of[draw.below(len(of))])
        else:
            of = _alike(ord(c) >> 8, unicodedata.category(c))
            of = of if len(of) > 1 else string.ascii_lowercase
            out.append(of[draw.below(len(of))])
    out += [string.ascii_lowercase[draw.below(26)] for _ in range(attempt // 2)]
    return "".join(out)


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The replacement of an entity, in canonical form."""
    draw = Draws(key, kind, canon, attempt)

    def digit(d: str, first: bool) -> str:
        return str(1 + draw.below(9)) if first and d != "0" else str(draw.below(10))

    if kind[:4] == "name":
        script = "cyrillic" if re.search("[а-яё]", canon) else "latin"
        consonants, vowels = LETTERS[script]
        ends = ENDINGS[script][kind[-1]]
        # longer names once the short ones collide, so that they never run out
        body = "".join(consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))]
                       for _ in range(1 + (len(canon) > 5) + attempt // 2 + (kind[-1] == "s")))
        return body + consonants[draw.below(len(consonants))] + ends[draw.below(len(ends))]
    if kind == "ip":
        # octets keep their lengths while there is choice
        low = {1: 1, 2: 10, 3: 100}
        high = {1: 10, 2: 100, 3: 256}
        parts = [len(p) if attempt < 8 else 1 + draw.below(3) for p in canon.split(".")]
        return ".".join(str(low[n] + draw.below(high[n] - low[n])) for n in parts)
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        host, dot, top = domain.rpartition(".")
        of_host = Draws(key, "domain", domain, 0)
        shape = [(local, draw), (host, of_host)]
        out = ["".join(str(d.below(10)) if c.isdigit() else chr(97 + d.below(26)) if c.isalpha() else c for c in s) for s, d in shape]
        extra = "".join(chr(97 + draw.below(26)) for _ in range(attempt // 4))
        return f"{out[0]}{extra}@{out[1]}{dot}{top}"
    if kind == "secret":
        return _secret(draw, canon, attempt)
    out = []
    for i, c in enumerate(canon):
        if kind == "account" and i < 2:
            out.append(c)
        elif c.isdigit():
            out.append(digit(c, i == 0))
        elif "a" <= c <= "z":
            out.append(chr(97 + draw.below(26)))
        elif "A" <= c <= "Z":
            out.append(chr(65 + draw.below(26)))
        else:
            out.append(c)
    made = "".join(out)
    if kind == "card" and _check_digit(canon[:-1]) == canon[-1]:
        made = made[:-1] + _check_digit(made[:-1])
    return made


def rendered(kind: str, mention: str, made: str) -> str:
    """The surrogate in the spelling of the mention."""
    if kind in ("card", "ssn", "account", "phone"):
        fixed = re.match(r"^\+\d{1,3}(?=[ .(-])", mention) if kind == "phone" else None
        head = fixed.group() if fixed else ""
        left = iter(made)
        return head + "".join(next(left, "") if c.isalnum() else c for c in mention[len(head):])
    if kind[:4] == "name":
        return made.upper() if mention.isupper() and len(mention) > 1 else "-".join(p.capitalize() for p in made.split("-"))
    if kind == "email" and mention.isupper():
        return made.upper()
    return made


def replaced(text: str | None, key: bytes, anew: dict[tuple[str, str], int]) -> tuple[str | None, int]:
    if not text:
        return text, 0
    out, at, found = [], 0, entities(text)
    for start, end, kind, canon in found:
        made = surrogate(key, kind, canon, anew.get((kind, canon), 0))
        out += [text[at:start], rendered(kind, text[start:end], made)]
        at = end
    out.append(text[at:])
    return "".join(out), len(found)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = {(r, kind, canon) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for _, _, kind, canon in entities(t)}
        rows = sorted(rows)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                                          pa.array([r[2] for r in rows], pa.string())], ["rid", "kind", "canon"])


def _surrogates(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, *x) for x in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["kind", "canon", "attempt", "made"])

    return run


def attempts(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, attempt, made) for distinct entities, no two with the same surrogate and none
    with a surrogate that is itself an entity of its kind in ``found``."""
    schema = "kind string, canon string, attempt int, made string"
    own = keep(found, "entities")
    now = keep(own.withColumn("attempt", F.lit(0)).mapInArrow(_surrogates(key), schema), "made")
    while True:
        first = now.groupBy("kind", "made").agg(F.min("canon").alias("first"), F.count("*").alias("n")).where("n > 1")
        clash = (now.join(first, ["kind", "made"]).where("canon <> first").select("kind", "canon")
                 .unionByName(now.join(own.select("kind", F.col("canon").alias("made")), ["kind", "made"], "left_semi")
                              .select("kind", "canon")).distinct())
        clash = keep(clash, "clash")
        if clash.isEmpty():
            return now
        again = (now.join(clash, ["kind", "canon"], "left_semi").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
                 .mapInArrow(_surrogates(key), schema))
        now = keep(now.join(clash, ["kind", "canon"], "left_anti").unionByName(again), "made")


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every detected entity in ``text_col`` replaced, and a last column ``n_entities``.

    All rows and other columns stay as they are; a column named ``n_entities`` is replaced. A null
    text stays null, a text without entities stays the same byte for byte. Repeated rows get the
    same replacements. The key is needed to make the same surrogates again; the surrogates of a few
    entities also depend on the rest of the corpus, by the check for collisions.
    """
    if not 0 < len(key) <= 64:
        raise ValueError("the key needs 1 to 64 bytes")
    base = docs.select(*[c for c in docs.columns if c != "n_entities"])
    schema = StructType([*base.schema.fields]).add("n_entities", "integer")
    at, width, names = base.columns.index(text_col), len(base.columns), schema.names
    spark = docs.sparkSession
    found = (base.select(F.lit(0).cast("long").alias("rid"), text_col).mapInArrow(_mentions, "rid long, kind string, canon string")
             .select("kind", "canon").distinct())
    anew = attempts(found, key).where("attempt > 0").select("kind", "canon", "attempt")

    def write(batch: pa.RecordBatch, texts: list, known: list[dict]) -> pa.RecordBatch:
        out = [replaced(t, key, k) for t, k in zip(texts, known, strict=True)]
        columns = list(batch.columns)[:width]
        columns[at] = pa.array([o[0] for o in out], pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array([o[1] for o in out], pa.int32())], names)

    few = anew.limit(LISTED + 1).toArrow().to_pylist()
    if len(few) <= LISTED:
        sent = spark.sparkContext.broadcast({(r["kind"], r["canon"]): r["attempt"] for r in few})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield write(batch, batch.column(at).to_pylist(), [sent.value] * batch.num_rows)

        return base.mapInArrow(run, schema)

    rows = with_row_id(base, id_col, "rows", *base.columns)
    per_row = (rows.select("rid", text_col).mapInArrow(_mentions, "rid long, kind string, canon string")
               .join(anew, ["kind", "canon"]).groupBy("rid").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("again")))

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            known = [{(x["kind"], x["canon"]): x["attempt"] for x in r or ()} for r in batch.column(width).to_pylist()]
            yield write(batch, batch.column(at).to_pylist(), known)

    return rows.join(per_row, "rid", "left").select(*base.columns, "again").mapInArrow(run_joined, schema)
