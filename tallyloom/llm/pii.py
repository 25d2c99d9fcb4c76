"""Surrogates for personal data: keyed replacements of the same type and format.

Entities are found in whole texts inside tasks. A surrogate is drawn by a keyed hash of type,
canonical entity and an attempt number, so one entity has one surrogate everywhere and two
processes agree without talking. The table of distinct entities is then checked: where two
entities of a type drew the same surrogate, or a surrogate is itself an entity of the corpus, all
but one draw again, until no collision is left. Only the entities with a later attempt (a small
share) need a lookup when the texts are rewritten.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.staging import stage

ROUNDS = 100  # of draws; each leaves a small share of the last one's collisions
FEW_REDRAWN = 500_000  # redrawn entities that may be sent to every task

# fixed values: titles by gender, name parts by gender and script
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Don", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Doña", "Госпожа"],
    "n": ["Mx", "Dr", "Prof", "Professor"],
}
NAMES = {
    ("LATIN", "m"): "Aldo Bruno Carlo Dario Emil Falk Gero Hugo Ivo Jonas Karl Linus Milo Nils Otto Pablo".split(),
    ("LATIN", "f"): "Ada Berta Clara Dora Elsa Frida Greta Hanna Ines Julia Karla Lena Mara Nora Olga Paula".split(),
    ("LATIN", "n"): "Alex Blake Charlie Drew Eden Finley Gray Harper Indigo Jules Kim Lane Morgan Noel Quinn Robin".split(),
    ("CYRILLIC", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл".split(),
    ("CYRILLIC", "f"): "Анна Вера Галина Дарья Елена Ирина Ольга Полина".split(),
    ("CYRILLIC", "n"): "Женя Саша Валя Шура".split(),
}
STEMS = {
    "LATIN": ["al", "ber", "cor", "dan", "el", "far", "gor", "hal", "is", "jor", "kel", "lin", "mor", "nor", "os", "per"],
    "CYRILLIC": ["ал", "бор", "вел", "гор", "дан", "ел", "зар", "кор", "лин", "мор", "нов", "пет"],
}
_WORD = r"[^\W\d_](?:[^\W\d_]|['’-])+"
_TITLE = "|".join(sorted((t for x in TITLES.values() for t in x), key=len, reverse=True))
_GENDER = {t: g for g, x in TITLES.items() for t in x}

#: in order of precedence where finds overlap
PATTERNS = {
    "secret": re.compile(r"\b(?:token|secret|password|api[_-]?key)\b\s*[=:]\s*[\"']?([A-Za-z0-9+/_\-]{16,})", re.I),
    "email": re.compile(r"[\w.+-]+@(?:[\w-]+\.)+[A-Za-z]{2,}"),
    "iban": re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "ip": re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)"),
    "phone": re.compile(r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.])\(\d{3}\) ?\d{3}-\d{4}(?!\d)"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "card": re.compile(r"(?<!\d)(?:\d[ -]?){12,18}\d(?!\d)"),
    "name": re.compile(rf"\b(?:{_TITLE})\.? ({_WORD}(?: {_WORD})?)"),
}


def _keep(kind: str, value: str) -> bool:
    if kind == "ip":
        return all(int(x) < 256 for x in value.split("."))
    if kind == "name":
        return all(w[0].isupper() for w in value.split(" ")[:1])
    return True


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities, without overlaps, in order."""
    found: list[tuple[int, int, str]] = []
    digits = re.search(r"\d", text) is not None
    for kind, pattern in PATTERNS.items():
        if (kind == "email" and "@" not in text) or (kind in ("iban", "ip", "phone", "ssn", "card") and not digits):
            continue
        for m in pattern.finditer(text):
            start, end = m.span(1) if pattern.groups and m.group(1) else m.span()
            if kind == "name":
                words = text[start:end].split(" ")
                end = start + len(" ".join(words[: 2 if len(words) > 1 and words[1][0].isupper() else 1]))
            if _keep(kind, text[start:end]) and not any(s < end and start < e for s, e, _ in found):
                found.append((start, end, kind))
    return sorted(found)


def _gender(text: str, start: int) -> str:
    before = re.search(r"(\S+?)\.? $", text[max(0, start - 40) : start])
    return _GENDER.get(before.group(1), "n") if before else "n"


def _script(value: str) -> str:
    letter = next((c for c in value if c.isalpha()), "a")
    return "CYRILLIC" if unicodedata.name(letter, "").startswith("CYRILLIC") else "LATIN"


def canonical(kind: str, value: str) -> str:
    """What two mentions of one entity share."""
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", value)
    if kind in ("email", "iban"):
        return value.replace(" ", "").lower() if kind == "email" else value.replace(" ", "")
    return value


class Draw:
    """A stream of numbers from a key, an entity and an attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.key, self.base, self.n, self.pool = key, f"{kind}|{attempt}|{entity}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.base + b"|%d" % self.n, hashlib.sha256).digest()
            self.n += 1
        number, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return number % n

    def like(self, c: str) -> str:
        if c.isdigit() and c.isascii():
            return "0123456789"[self.below(10)]
        if c.isascii() and c.isalpha():
            return chr((65 if c.isupper() else 97) + self.below(26))
        return c


def surrogate(key: bytes, kind: str, entity: str, attempt: int, gender: str = "n") -> str:
    """Canonical surrogate of a canonical entity: same type, length and kind of characters."""
    d = Draw(key, kind, entity, attempt)
    if kind == "name":
        script = _script(entity)
        words = entity.split(" ")
        pool = NAMES[script, gender]
        first = pool[d.below(len(pool))]
        stems = STEMS[script]
        family = "".join(stems[d.below(len(stems))] for _ in range(3 + attempt // 2)).capitalize()
        return f"{first} {family}" if len(words) > 1 else family
    if kind == "ip":
        return ".".join(str(d.below(256)) for _ in range(4))
    if kind == "email":
        local = "".join(d.like(c) for c in entity.partition("@")[0])
        return f"{local}@{''.join(d.like('a') for _ in range(8))}.example.net"
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", entity):
        return "".join("0123456789abcdef"[d.below(16)] for _ in entity)
    if kind == "card":
        body = [d.below(10) for _ in entity[:-1]]
        # check digit as cards have it, so the format stays valid
        total = sum(x if i % 2 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(body)))
        return "".join(map(str, body)) + str(-total % 10)
    if kind in ("iban", "phone"):
        kept = 2 if kind == "iban" else 1  # country
        return entity[:kept] + "".join(d.like(c) for c in entity[kept:])
    return "".join(d.like(c) for c in entity)


def _dress(kind: str, shown: str, drawn: str) -> str:
    """The surrogate in the layout of the mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(drawn)
        return "".join(next(left, c) if c.isalnum() else c for c in shown)
    if kind == "name" and shown.isupper():
        return drawn.upper()
    return drawn


def entities(docs: DataFrame) -> DataFrame:
    """kind, entity, gender of every mention in the texts."""

    def run(batches):
        for batch in batches:
            seen = set()
            for text in batch.column(0).to_pylist():
                for start, end, kind in find(text or ""):
                    seen.add((kind, canonical(kind, text[start:end]), _gender(text, start) if kind == "name" else "n"))
            kinds, names, genders = zip(*sorted(seen)) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(names, pa.string()), pa.array(genders, pa.string())],
                names=["kind", "entity", "gender"],
            )

    return docs.select("text").mapInArrow(run, "kind string, entity string, gender string")


def assignments(mentions: DataFrame, key: bytes) -> DataFrame:
    """kind, entity, gender, attempt, surrogate: distinct within a kind and no entity of the corpus.

    A name met with titles of several genders takes the one that is named most often.
    """
    counted = mentions.groupBy("kind", "entity", "gender").agg(F.count(F.lit(1)).alias("n"))
    table = counted.groupBy("kind", "entity").agg(F.max_by("gender", F.struct(F.col("gender") != "n", "n", "gender")).alias("gender"))

    def draw(batches):
        for batch in batches:
            rows = batch.to_pydict()
            drawn = [surrogate(key, *x) for x in zip(rows["kind"], rows["entity"], rows["attempt"], rows["gender"])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], names=[*batch.schema.names, "surrogate"])

    schema = "kind string, entity string, gender string, attempt int, surrogate string"
    known = stage(table, "entities")
    settled = stage(known.withColumn("attempt", F.lit(0)).mapInArrow(draw, schema), "surrogates")
    for _ in range(ROUNDS):
        # of all that share a surrogate the earliest entity keeps it, unless it is an entity itself
        first = settled.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "entity")).alias("first"), F.count(F.lit(1)).alias("n"))
        real = known.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
        clash = first.join(real, ["kind", "surrogate"], "left").where("n > 1 or real")
        again = stage(
            settled.join(clash, ["kind", "surrogate"])
            .where((F.col("entity") != F.col("first.entity")) | F.col("real"))
            .select("kind", "entity", "gender", (F.col("attempt") + 1).alias("attempt")),
            "redraw",
        )
        if again.isEmpty():
            return settled
        stay = settled.join(again.select("kind", "entity"), ["kind", "entity"], "left_anti")
        settled = stage(stay.unionByName(again.mapInArrow(draw, schema)), "surrogates")
    raise ValueError("a format has fewer surrogates than the corpus has entities of it")


def with_surrogates(docs: DataFrame, key: bytes = b"surrogates") -> DataFrame:
    """Columns of ``docs`` with surrogates in the text, and n_entities (mentions replaced).

    A column n_entities of ``docs`` gives way. A NULL text stays NULL with 0 entities, repeated rows come out alike, no rows give no rows.
    """
    table = assignments(stage(entities(docs), "mentions"), key)
    # gender can't be read off a single mention, so named entities with one are looked up as well
    special = table.where("attempt > 0 or kind = 'name'").select("kind", "entity", "gender", "attempt")
    few = special.count() <= FEW_REDRAWN
    columns = [c for c in docs.columns if c != "n_entities"]
    names = [c for c in columns if c != "text"]
    rest = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.lit(None)

    if few:
        lookup = {(r["kind"], r["entity"]): (r["attempt"], r["gender"]) for r in special.toLocalIterator()}
        sent = docs.sparkSession.sparkContext.broadcast(lookup)
        rows = docs.select(rest.alias("_doc"), "text")
        extra = None
    else:
        # each document brings the entities of its own that need a lookup
        sent = None
        numbered = docs.select(F.monotonically_increasing_id().alias("_row"), rest.alias("_doc"), "text")
        rows, extra = numbered, special

    def rewrite(text, lookup):
        out, at, n = [], 0, 0
        for start, end, kind in find(text):
            shown = text[start:end]
            entity = canonical(kind, shown)
            attempt, gender = lookup.get((kind, entity), (0, "n"))
            out += [text[at:start], _dress(kind, shown, surrogate(key, kind, entity, attempt, gender))]
            at, n = end, n + 1
        return "".join([*out, text[at:]]), n

    if extra is None:

        def run(batches):
            for batch in batches:
                done = [(None, 0) if t is None else rewrite(t, sent.value) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
                    names=["_doc", "text", "n_entities"],
                )

        done = rows.mapInArrow(run, _counted(rows))
    else:
        done = _rewrite_joined(rows, extra, rewrite)
    return done.select(*[F.col("text") if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in columns], "n_entities")


def _counted(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("n_entities", T.LongType())])


def _rewrite_joined(rows: DataFrame, special: DataFrame, rewrite) -> DataFrame:
    """As above with the lookups joined to the documents that mention them."""

    def mentions(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                found = {(k, canonical(k, text[s:e])) for s, e, k in find(text or "")}
                out.append([{"kind": k, "entity": e} for k, e in sorted(found)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("entity", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "_found"])

    kept = stage(rows, "rows")
    each = kept.select("_row", "text").mapInArrow(mentions, "_row long, text string, _found array<struct<kind:string,entity:string>>")
    wanted = each.select("_row", F.explode("_found").alias("f")).select("_row", "f.kind", "f.entity")
    own = wanted.join(special, ["kind", "entity"]).groupBy("_row").agg(F.collect_list(F.struct("kind", "entity", "attempt", "gender")).alias("_own"))
    joined = kept.join(own, "_row", "left").select("_doc", "text", "_own")

    def run(batches):
        for batch in batches:
            done = []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lookup = {(x["kind"], x["entity"]): (x["attempt"], x["gender"]) for x in own or []}
                done.append((None, 0) if text is None else rewrite(text, lookup))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
                names=["_doc", "text", "n_entities"],
            )

    return joined.mapInArrow(run, _counted(joined.drop("_own")))
