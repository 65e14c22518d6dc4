"""PII: detected entities get keyed surrogates of the same type, gender, script and format.

An entity is a (kind, canonical form): the digits of a phone number, the lower-cased name
token, the mailbox within its domain. Its surrogate is drawn from a keyed hash of both, so
one entity has one surrogate in all documents and spellings. All distinct entities of the
corpus are then checked together: where two drew the same surrogate, or one drew
something that is itself an entity, all but the smallest draw again, until none is left.
Documents compute plain draws themselves; only second and later draws are joined to them.

Names are found after a title, and from there at every other place of the same document
that has them as a capitalised word. A document that never has a name after a title keeps
it, as do inflected forms. A given name has the gender of its titles in all of the corpus,
none where they differ; a document that shows another is told the gender of the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickloom.llm.common import Scratch, settle, spare

#: Draws after this one may be longer than the original, so small ranges cannot run out.
SAME_LENGTH = 12
ROUNDS = 200
#: Later draws up to this number are broadcast to the documents; more are joined by shuffle.
BROADCAST = 100_000

# Titles with gender, given names by script and gender.
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Don", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Doña", "госпожа"),
    "n": ("Dr", "Prof", "Professor"),
}
GIVEN = {
    ("latin", "m"): "adam bruno carlo daniel erik felix hugo ivan jonas karl leon martin nils oscar paul simon".split(),
    ("latin", "f"): "alice berta clara diana emma flora greta helena irma julia karla laura maria nora olga paula".split(),
    ("latin", "n"): "alex andrea chris dominique florin jean kim noel robin sascha sidney toni".split(),
    ("cyrillic", "m"): "андрей борис виктор глеб иван кирилл олег павел роман сергей".split(),
    ("cyrillic", "f"): "алла вера галина дарья елена ирина марина ольга софия татьяна".split(),
    ("cyrillic", "n"): "саша женя валя шура слава".split(),
}
SYLLABLES = {
    "latin": "bel cor dan fer gal hol kem lar mon nor pel ras sol tor van wes".split(),
    "cyrillic": "бел вор дан гал кем лар мон нор пел рас сол тор".split(),
}
ENDING = {"latin": "er", "cyrillic": "ин"}

#: Capitalised words that follow a title by chance; they are replaced there and nowhere else.
NO_NAMES = frozenset(
    "a an and are as at but by can could did do does for from had has have he her here his how i if in is it its may my"
    " no not of on or our she so some that the their then there these they this to us was we were what when where which"
    " who why will with would yes you your".split()
)
#: A gender by the bits of the titles seen: none, male, female, both.
GENDERS = "nmfb"

_GENDER = {t.lower(): g for g, titles in TITLES.items() for t in titles}
_WORD = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_NAME = re.compile(
    r"(?<!\w)(" + "|".join(sorted(_GENDER, key=len, reverse=True)) + r")(\.?[ \t]+(?:(?:Dr|Prof|Professor)\.?[ \t]+)*)(" + _WORD + r")(?:([ \t]+)(" + _WORD + r"))?",
    re.IGNORECASE,
)
_OWNED = re.compile(r"['’][sS]$")
_ABBREVIATED = frozenset("mr mrs ms sr sra mme dr prof".split())
_EMAIL = re.compile(r"(?<![\w.%+-])([A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*)@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?i)(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key)[ \t]*[=:][ \t]*[\"']?([^\s\"']{6,})")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,2}|(?<=[\d][ .-])\d{2,4}(?:[ .-]?\d{2,4}){2,3})(?!\w)|(?<![\w+])\d{3}[.-]\d{3}[.-]\d{4}(?!\w)|(?<![\w+])\+\d{8,15}(?!\w)")
_CARD = re.compile(r"(?<![\w-])[3-6]\d(?:[ -]?\d){11,17}(?![\w-])")
_DIGIT = re.compile(r"\d")


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isascii() and c.isdigit())


def _script(text: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in text) else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities of a text: (start, end, kind, canonical), in order, none overlapping.

    The kind of a given name has the gender its titles in this text show.
    """
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        for m in _EMAIL.finditer(text):
            domain = m[2].lower()
            found.append((m.start(1), m.end(1), f"mailbox {domain}", m[1].lower()))
            found.append((m.start(2), m.end(2), "domain", domain))
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "key", m[0]) for m in _KEY.finditer(text)]
        found += [(m.start(), m.end(), "iban", m[0].replace(" ", "")) for m in _IBAN.finditer(text)]
        found += [(m.start(), m.end(), "ip", m[0]) for m in _IP.finditer(text)]
        found += [(m.start(), m.end(), "ssn", _digits(m[0])) for m in _SSN.finditer(text)]
        found += [(m.start(), m.end(), "phone", _digits(m[0])) for m in _PHONE.finditer(text)]
        found += [(m.start(), m.end(), "card", _digits(m[0])) for m in _CARD.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret", m[1]) for m in _SECRET.finditer(text)]
    found += _names(text)
    # The earliest, then the longest, then the first named kind wins an overlap.
    out: list[tuple[int, int, str, str]] = []
    for one in sorted(found, key=lambda e: (e[0], -e[1])):
        if not out or one[0] >= out[-1][1]:
            out.append(one)
    return out


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Names after a title, and their other mentions."""
    found: list[tuple[int, int, str, str]] = []
    kinds: dict[str, str] = {}
    bits: dict[str, int] = {}
    for m in _NAME.finditer(text):
        # A title and a lower-case word is no name.
        if not m[3][0].isupper():
            continue
        both = bool(m[5]) and m[5][0].isupper()
        # A full stop after a title written out ends a sentence; what follows may be any word.
        title = (m[1] + m[2]).split()[-1]
        sure = title[-1] != "." or title[:-1].lower() in _ABBREVIATED
        for group, kind in ((3, "given" if both else "family"), (5, "family"))[: 1 + both]:
            word = _OWNED.sub("", m[group])
            kind, form = f"{kind} {_script(word)}", word.lower()
            found.append((m.start(group), m.start(group) + len(word), kind, form))
            if kind.startswith("given"):
                bits[form] = bits.get(form, 0) | GENDERS.index(_GENDER[m[1].lower()])
            if sure and form not in NO_NAMES and form not in _GENDER:
                kinds.setdefault(form, kind)
    if kinds:
        at = {e[0] for e in found}
        mention = r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(kinds, key=len, reverse=True))) + r")(?!\w)"
        for m in re.finditer(mention, text, re.IGNORECASE):
            form = m[0].lower()
            if m.start() not in at and m[0][0].isupper() and form in kinds:
                found.append((m.start(), m.end(), kinds[form], form))
    return [(a, b, _shown(kind, bits.get(form, 0)), form) for a, b, kind, form in found]


def _shown(kind: str, gender: int) -> str:
    """The kind of a given name with its gender; other kinds as they are."""
    return kind.replace("given ", f"given {GENDERS[gender]} ", 1) if kind.startswith("given ") else kind


def _apart(kind: str) -> tuple[str, int]:
    """The kind without a gender, and the gender."""
    if not kind.startswith("given "):
        return kind, 0
    _, gender, script = kind.split(" ")
    return f"given {script}", GENDERS.index(gender)


class _Draw:
    """An endless stream of choices from a keyed hash."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self._seed = hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=key).digest()
        self._number, self._left = 0, b""

    def below(self, n: int) -> int:
        if len(self._left) < 8:
            self._number += 1
            self._left = hashlib.blake2b(self._seed + self._number.to_bytes(8, "big")).digest()
        value, self._left = int.from_bytes(self._left[:8], "big"), self._left[8:]
        return value % n

    def pick(self, values):
        return values[self.below(len(values))]


LOWER, UPPER, FIGURES, HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"


def _alike(text: str, draw: _Draw) -> str:
    """Every letter and digit replaced within its class; hexadecimal strings stay so."""
    if len(text) >= 8 and all(c in HEX for c in text) and any(c.isdigit() for c in text) and not text.isdigit():
        return "".join(draw.pick(HEX) for _ in text)
    out = []
    for c in text:
        if c in FIGURES:
            out.append(draw.pick(FIGURES))
        elif c in LOWER:
            out.append(draw.pick(LOWER))
        elif c in UPPER:
            out.append(draw.pick(UPPER))
        elif "Ѐ" <= c <= "ӿ":
            other = draw.pick(CYRILLIC)
            out.append(other.upper() if c.isupper() else other)
        else:
            out.append(draw.pick(LOWER) if c.isalpha() else c)
    return "".join(out)


def _check_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def draw(kind: str, canonical: str, attempt: int, key: bytes) -> str:
    """The surrogate of an entity in canonical form."""
    d = _Draw(key, kind, canonical, attempt)
    more = "".join(str(d.below(10)) for _ in range(max(0, attempt - SAME_LENGTH)))
    kind = kind.split(" ")
    if kind[0] == "domain":
        *labels, top = canonical.split(".")
        keep = labels and labels[-1] == "example"
        return ".".join([*[_alike(x, d) for x in (labels[:-1] if keep else labels)], *(["example"] if keep else []), top]) if not more else f"d{more}." + canonical.split(".", 1)[1]
    if kind[0] == "phone":
        prefix, rest = canonical[:-10], canonical[-10:]
        body = str(2 + d.below(8)) + "".join(str(d.below(10)) for _ in rest[1:])
        return prefix + body + more
    if kind[0] == "card":
        body = canonical[0] + "".join(str(d.below(10)) for _ in canonical[2:]) + more
        last = _check_digit(body)
        if _check_digit(canonical[:-1]) != canonical[-1]:
            last = str((int(last) + 1 + d.below(9)) % 10)
        return body + last
    if kind[0] == "ip":
        old = canonical.split(".")
        narrow = old[:2] == ["192", "168"] or (old[0] == "172" and 16 <= int(old[1]) < 32)
        if narrow and attempt > SAME_LENGTH:
            # A private block of 65,025 draws can be all taken; the one of 10 has 16 million.
            old, narrow = ["10", *old[1:]], False
        private = 1 if old[0] in ("10", "127") else 2 if narrow else 0
        # Beyond the draws of the same length any octet will do.
        range_of = {1: (1, 10), 2: (10, 100), 3: (100, 256)}
        new = []
        for octet in old[private:]:
            low, high = range_of[len(octet)] if attempt <= SAME_LENGTH else (1, 256)
            new.append(str(low + d.below(high - low)))
        return ".".join(old[:private] + new)
    if kind[0] == "ssn":
        return "9" + "".join(str(d.below(10)) for _ in canonical[1:]) + more
    if kind[0] == "key":
        return canonical[:4] + "".join(d.pick(UPPER + "234567") for _ in canonical[4:]) + more
    if kind[0] == "iban":
        body = _alike(canonical[4:], d) + more
        number = "".join(str(int(c, 36)) for c in body + canonical[:2] + "00")
        return canonical[:2] + f"{98 - int(number) % 97:02d}" + body
    if kind[0] == "given":
        names = GIVEN[kind[2], "n" if kind[1] == "b" else kind[1]]
        first = d.pick(names)
        return first if attempt < 3 else first + "-" + "".join(d.pick(SYLLABLES[kind[2]]) for _ in range(1 + attempt // 6))
    if kind[0] == "family":
        parts = 2 + (len(canonical) > 8) + max(0, attempt - SAME_LENGTH)
        return "".join(d.pick(SYLLABLES[kind[1]]) for _ in range(parts)) + ENDING[kind[1]]
    return _alike(canonical, d) + more


def pour(surrogate: str, kind: str, original: str) -> str:
    """The surrogate in the spelling of the original: its punctuation, spaces and case."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(surrogate)
        out = "".join(next(rest, "") if c.isalnum() and c.isascii() else c for c in original)
        return out + "".join(rest)
    if original.isupper() and not surrogate.isupper() and kind not in ("secret", "key"):
        return surrogate.upper()
    if kind.startswith(("given", "family")) and original[:1].isupper():
        return "-".join(p[:1].upper() + p[1:] for p in surrogate.split("-"))
    return surrogate


ENTITY = "kind string, canonical string"


def replace_entities(
    docs: DataFrame, key: bytes, doc: str = "doc_id", text: str = "text", count: str = "n_entities"
) -> DataFrame:
    """``docs`` with entities of ``text`` replaced and a column ``count`` of how many.

    All rows and other columns stay; NULL and empty texts stay as they are with count 0; a
    column that is named ``count`` already is replaced. Distinct entities have distinct
    surrogates, none of which is an entity of the corpus. ``key`` (1 to 64 bytes) decides
    all draws: the same key and corpus give the same texts. An empty table gives no rows.
    """
    docs = docs.drop(count)

    def entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, forms, genders = [], [], [], []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for kind, form in {e[2:] for e in find(value.as_py() or "")}:
                    kind, gender = _apart(kind)
                    ids.append(doc_id)
                    kinds.append(kind)
                    forms.append(form)
                    genders.append(gender)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, batch.column(0).type), pa.array(kinds, pa.string()),
                    pa.array(forms, pa.string()), pa.array(genders, pa.int32()),
                ],
                ["d", "kind", "canonical", "shown"],
            )

    id_type = docs.schema[doc].dataType.simpleString()
    with Scratch(docs.sparkSession) as scratch:
        held = scratch.table(
            docs.select(F.col(doc).alias("d"), F.col(text).cast("string").alias("t")).mapInArrow(
                entities, f"d {id_type}, {ENTITY}, shown int"
            ),
            "held",
        )
        everything = held.groupBy("kind", "canonical").agg(F.bit_or("shown").alias("gender")).withColumn("attempt", F.lit(0))
        again = scratch.table(_settle_collisions(scratch, everything, key), "again")
        # What a document needs beyond first draws and genders it shows: few rows, unless ranges are crowded.
        needed = held.join(again, ["kind", "canonical"]).where("attempt > 0 OR gender != shown").drop("shown").distinct()
        needed = needed.groupBy("d").agg(F.collect_list(F.struct("kind", "canonical", "gender", "attempt")).alias("_again"))
        needed = settle(needed)
    size = needed.agg(F.sum(F.size("_again"))).first()[0] or 0
    id_, again_ = spare(docs, "_doc"), spare(docs, "_again")
    needed = needed.toDF(id_, again_)
    needed = F.broadcast(needed) if size <= BROADCAST else needed
    joined = docs.join(needed, F.col(doc).eqNullSafe(F.col(id_)), "left").drop(id_)
    place, names = docs.columns.index(text), [*docs.columns, count]

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            column = batch.column(place)
            for value, extra in zip(column, batch.column(batch.num_columns - 1), strict=True):
                value = value.as_py()
                told = {(e["kind"], e["canonical"]): (e["gender"], e["attempt"]) for e in extra.as_py() or ()}
                spans = find(value) if value else []
                parts, at = [], 0
                for start, end, kind, form in spans:
                    plain, shown = _apart(kind)
                    gender, attempt = told.get((plain, form), (shown, 0))
                    new = draw(_shown(plain, gender), form, attempt, key)
                    parts += [value[at:start], pour(new, kind, value[start:end])]
                    at = end
                texts.append("".join([*parts, value[at:]]) if spans else value)
                counts.append(len(spans))
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names)

    return joined.mapInArrow(replaced, StructType([*docs.schema.fields, StructField(count, LongType())]))


def _settle_collisions(scratch: Scratch, everything: DataFrame, key: bytes) -> DataFrame:
    """Entities (kind, canonical, gender, attempt) that have a gender or need a later draw than the first."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True)
            new = [draw(_shown(kind, gender), form, attempt, key) for kind, form, gender, attempt in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(new, pa.string())], ["kind", "canonical", "gender", "attempt", "surrogate"]
            )

    shape = ENTITY + ", gender int, attempt int, surrogate string"
    now = scratch.table(everything.mapInArrow(drawn, shape), "draws")
    real = now.select(F.col("kind").alias("k"), F.col("canonical").alias("c"))
    for _ in range(ROUNDS):
        # Kinds that name a domain or script keep apart what may coincide; families share theirs.
        first = now.groupBy("kind", "surrogate").agg(
            F.min(F.struct("attempt", "canonical")).alias("first"), F.count(F.lit(1)).alias("n")
        ).where("n > 1").select(F.col("kind").alias("k"), F.col("surrogate").alias("s"), F.col("first.canonical").alias("winner"))
        clash = now.join(first, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s"))).where(
            "canonical != winner"
        ).select("kind", "canonical")
        taken = now.join(real, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("c"))).select("kind", "canonical")
        losers = scratch.table(clash.union(taken).distinct(), "losers")
        if losers.isEmpty():
            break
        lost = now.join(losers, ["kind", "canonical"]).withColumn("attempt", F.col("attempt") + 1)
        kept = now.join(losers, ["kind", "canonical"], "left_anti")
        now = scratch.table(
            kept.select("kind", "canonical", "gender", "attempt", "surrogate").unionByName(
                lost.select("kind", "canonical", "gender", "attempt").mapInArrow(drawn, shape)
            ),
            "draws",
        )
    else:
        raise RuntimeError(f"no distinct surrogates after {ROUNDS} rounds")
    return now.where("attempt > 0 OR gender > 0").select("kind", "canonical", "gender", "attempt")
