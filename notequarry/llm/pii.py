"""Replaces personal data by surrogates of the same kind and form.

Entities are found by patterns that need a clear sign (an at sign, digits in a known
grouping, a label such as ``password=``, a form of address before a name). Each is reduced
to a normal form, so that a number written in two ways is one entity. Over the whole corpus
each distinct entity draws a surrogate from a keyed hash. Draws are checked: a surrogate
that is itself an entity of the corpus, or that another entity holds already, is drawn
again. So different entities stay different, an entity has one surrogate wherever it
occurs, and without the key neither can be computed from the other.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notequarry.llm.common import text_bytes
from notequarry.session import materialise

#: After so many draws a surrogate is a labelled code, of which there are always enough.
DRAWS = 12

#: Characters end an entity, not its length: what is left of a longer one would stay in clear.
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[._%+-]*+([A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})\b")
#: The key may be quoted, as in JSON; a value in quotes goes to the closing one.
SECRET = re.compile(
    r"(?i)\b(?:password|passwd|pwd|pass|token|secret|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key)"
    r"([\"']?)(\s*[=:]\s*)"
    r"(?:\"(?P<double>(?:[^\"\\\r\n]++|\\.)*+)\"|'(?P<single>(?:[^'\\\r\n]++|\\.)*+)'|[\"']?(?P<bare>[^\s\"',;<>]{6,}))"
)
PREFIXED = re.compile(r"\b(AKIA|ASIA|ghp_|gho_|sk-|sk_live_|pk_live_|xox[abp]-|AIza)([A-Za-z0-9_-]{12,})")
IBAN = re.compile(r"\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")
IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")
CARD = re.compile(r"(?<![\w.-])[2-6]\d{3}(?:\d{9,15}|(?:[ -]\d{4}){2,3}(?:[ -]?\d{1,4})?|[ -]\d{6}[ -]\d{5})(?![\w-]|\.\d)")
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
PHONE = re.compile(
    r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w-])"
)
#: Forms of address; the letter says which given names fit.
ADDRESS = {
    "m": ("Mr.", "Mr", "Sir", "Herr", "Señor", "Sr.", "Don", "Monsieur", "Господин"),
    "f": ("Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Madam", "Frau", "Señora", "Sra.", "Doña", "Madame", "Mme", "Госпожа"),
    "n": ("Dr.", "Prof.", "Patient", "Patientin"),
}
_TITLES = {t: gender for gender, titles in ADDRESS.items() for t in titles}
_UPPER = "A-ZÀ-ÖØ-ÞА-ЯЁ"
_NAME = rf"[{_UPPER}][^\W\d_]+(?:[-'][{_UPPER}][^\W\d_]+)*"
TITLED = re.compile(
    rf"(?<!\w)({'|'.join(sorted(map(re.escape, _TITLES), key=len, reverse=True))}) ({_NAME}(?: {_NAME})*)(?!\w)"
)
NAMED = re.compile(rf"(?:[Mm]y name is|[Ii]ch heiße|[Mm]e llamo|[Jj]e m'appelle|[Mm]eine? Name ist) ({_NAME}(?: {_NAME})*)(?!\w)")

#: Given names for surrogates by gender and script, our own choice.
GIVEN = {
    ("m", "latin"): "Adrian Albert Arthur Bruno Conrad Daniel Edgar Emil Felix Gustav Hugo Ivan Jonas Julian Leon Lukas Martin Milan Nico Oscar Paul Ralf Robin Samuel Simon Theo Tobias Victor".split(),
    ("f", "latin"): "Adele Alma Amelia Bianca Carla Clara Diana Edith Elena Emma Eva Flora Greta Helena Ida Irene Julia Laura Lena Lucia Marta Mila Nora Olga Paula Rosa Selma Vera".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Олег Павел Роман Степан Юрий".split(),
    ("f", "cyrillic"): "Алина Вера Дарья Елена Жанна Зоя Инна Кира Лидия Майя Нина Ольга Полина Рита Софья Юлия".split(),
}
_ONSETS = {"latin": "b br d dr f g gr h k kl l m n p r s st t v w".split(), "cyrillic": "б бр в г д ж з к кл л м н п р с ст т".split()}
_VOWELS = {"latin": "a e i o u".split(), "cyrillic": "а е и о у".split()}

Found = tuple[int, int, str, str]  # start, end, kind, normal form


def luhn(digits: str) -> int:
    """Sum of the card checksum modulo ten; 0 for a valid number."""
    return sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(map(int, reversed(digits)))) % 10


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script(word: str) -> str:
    return "cyrillic" if re.match("[Ѐ-ӿ]", word) else "latin"


def detect(text: str) -> list[Found]:
    """Entities of a text in order, none overlapping; earlier kinds win over later ones."""
    found: list[Found] = []
    if "@" in text:
        found += [(m.start(1), m.end(1), "email", m[1].lower()) for m in EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        for m in SECRET.finditer(text):
            value = m[m.lastgroup]
            if len(value) >= 6 and (any(c.isdigit() for c in value) or m[2].strip() == "=" or m[1] and m.lastgroup != "bare"):
                found.append((*m.span(m.lastgroup), "secret", value))
    if re.search("[0-9]", text):
        found += [(m.start(2), m.end(2), "secret", m[2]) for m in PREFIXED.finditer(text)]
        for m in IBAN.finditer(text):
            plain = m[1].replace(" ", "")
            if 15 <= len(plain) <= 34 and _iban_rest(plain) == 1:
                found.append((m.start(), m.end(), "iban", plain))
        for kind, pattern in (("ip", IP), ("card", CARD), ("ssn", SSN), ("phone", PHONE)):
            for m in pattern.finditer(text):
                plain = m[0] if kind == "ip" else re.sub(r"\D", "", m[0])
                if kind == "card" and (luhn(plain) or len(plain) < 13):
                    continue  # other long numbers fail the checksum
                found.append((m.start(), m.end(), kind, "+" * m[0].startswith("+") + plain))
    if any(t in text for t in _TITLES) or NAMED.search(text):
        found += _names(text)
    found.sort(key=lambda x: x[0])
    kept: list[Found] = []
    order = ("email", "secret", "iban", "ip", "card", "ssn", "phone")
    rank = {k: i for i, k in enumerate(order)}
    for x in found:
        if kept and x[0] < kept[-1][1]:
            if rank.get(x[2], 9) < rank.get(kept[-1][2], 9):
                kept[-1] = x
            continue
        kept.append(x)
    return kept


def _names(text: str) -> list[Found]:
    """Name words after a form of address, and the same words elsewhere in the text."""
    words: dict[str, str] = {}
    known = {n: g for (g, _), names in GIVEN.items() for n in names}
    for m in [*TITLED.finditer(text), *NAMED.finditer(text)]:
        titled = m.re is TITLED
        gender = _TITLES[m[1]] if titled else "n"
        parts = m[m.lastindex].split(" ")
        given, last = parts[:-1], parts[-1]
        if not titled and len(parts) == 1:
            given, last = parts, None
        if gender == "n" and given:
            gender = known.get(given[0], "n")
        for word in given:
            words.setdefault(word, f"given_{gender}")
        if last:
            words.setdefault(last, "surname")
    if not words:
        return []
    every = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, words), key=len, reverse=True))})(?!\w)")
    return [(m.start(), m.end(), words[m[0]], m[0]) for m in every.finditer(text)]


class Draw:
    """Numbers drawn from a keyed hash of an entity, one after another."""

    def __init__(self, key: bytes, kind: str, value: str, draw: int):
        self.block = hmac.new(key, f"{kind}\0{draw}\0{value}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self.left = int.from_bytes(self.block, "big")

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            self.block = hashlib.sha256(self.block).digest()
            self.left = int.from_bytes(self.block, "big")
        self.left, found = divmod(self.left, n)
        return found

    def like(self, text: str, hexadecimal: bool = False) -> str:
        """Letters for letters, digits for digits, everything else as it was."""
        out = []
        for c in text:
            if "0" <= c <= "9":
                out.append(chr(48 + self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(6 if hexadecimal else 26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(6 if hexadecimal else 26)))
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, value: str, draw: int) -> str:
    """The ``draw``-th surrogate of an entity in its normal form."""
    d = Draw(key, kind, value, draw)
    if draw >= DRAWS:
        return f"[{kind.split('_')[0].upper()}-{d.block[:16].hex()}-{draw}]"
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        host = [d.like(x) for x in labels[:-2]]
        more = d.like("a0" * (draw // 3))  # short names run out, so later draws are longer
        return f"{d.like(local)}{more}@{'.'.join([*host, 'example', labels[-1]])}"
    if kind == "secret":
        return d.like(value, hexadecimal=re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) is not None)
    if kind == "iban":
        body = value[:2] + "00" + d.like(value[4:])
        return f"{value[:2]}{98 - _iban_rest(body):02d}{body[4:]}"
    if kind == "ip":
        octets = [_octet(d, part, i == 0) for i, part in enumerate(value.split("."))]
        if value.startswith(("10.", "192.168.", "127.")):
            octets[0] = value.split(".")[0]
            octets[1] = "168" if octets[0] == "192" else octets[1]
        return ".".join(octets)
    if kind == "card":
        body = value[0] + d.like(value[1:-1])
        return body + next(c for c in "0123456789" if luhn(body + c) == 0)
    if kind == "ssn":
        return f"{1 + d.below(665):03d}{1 + d.below(99):02d}{1 + d.below(9999):04d}"
    if kind == "phone":
        at = 2 if value.startswith("+1") or value.startswith("+7") else 3 if value.startswith("+") else 0
        rest = d.like(value[at:])
        return value[:at] + (str(2 + d.below(8)) + rest[1:] if rest else "")
    which = script(value)
    if kind.startswith("given"):
        gender = kind[-1] if kind[-1] in "mf" else "mf"[d.below(2)]
        names = GIVEN[gender, which]
        name = names[d.below(len(names))]
        # a second name keeps people apart once the list is used up
        return name if draw < 2 else f"{name}-{names[d.below(len(names))]}"
    stem = "".join(_ONSETS[which][d.below(len(_ONSETS[which]))] + _VOWELS[which][d.below(5)] for _ in range(2 + draw // 4))
    return (stem + ("н" if which == "cyrillic" else "ner")).capitalize()


def _octet(d: Draw, part: str, first: bool) -> str:
    if len(part) == 3:
        return str(100 + d.below(124 if first else 155))
    return str(10 + d.below(90)) if len(part) == 2 else str(1 + d.below(9))


def fitted(mention: str, kind: str, made: str) -> str:
    """A surrogate in the grouping and case of the mention it stands for."""
    if made.startswith("["):
        return made
    if kind in ("card", "ssn", "phone", "iban"):
        left = iter(made.lstrip("+") if kind == "phone" else made)
        return "".join(next(left, "") if c.isalnum() else c for c in mention)
    if kind == "email":
        halves = zip(mention.split("@"), made.split("@"), strict=True)
        return "@".join(new.upper() if old.isupper() else new for old, new in halves)
    if not kind.startswith(("given", "surname")):
        return made
    return made.upper() if mention.isupper() and len(mention) > 1 else made


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, made): a surrogate for every distinct entity, none used twice.

    Per round the smallest entity that drew a surrogate holds it, unless the surrogate is an
    entity itself or was taken before; the others draw again.
    """

    def draw_again(n: int):
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                made = [surrogate(key, kind, value, n) for kind, value in pairs]
                yield pa.record_batch([*batch.columns, pa.array(made, pa.string())], ["kind", "value", "made"])

        return run

    family = lambda kind: F.split(kind, "_")[0]
    originals = entities.select(family(F.col("kind")).alias("family"), F.col("value").alias("made"))
    pending, taken = entities, None
    for n in range(DRAWS + 1):
        drawn = pending.mapInArrow(draw_again(n), "kind string, value string, made string")
        drawn = materialise(drawn.withColumn("family", family(F.col("kind"))), "draws")
        free = drawn.join(originals.distinct(), ["family", "made"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["family", "made"], "left_anti")
        holder = F.min(F.struct("kind", "value")).alias("holder")
        held = free.groupBy("family", "made").agg(holder).select("family", "made", "holder.kind", "holder.value")
        held = materialise(held, "held")
        taken = held if taken is None else taken.union(held)
        if drawn.count() == held.count():
            break
        pending = materialise(drawn.join(held, ["kind", "value"], "left_anti").select("kind", "value"), "pending")
    return taken.select("kind", "value", "made")


def replace_pii(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the entities in its texts replaced, and a column n_replaced.

    - Texts without an entity, null and empty ones come back as they were (n_replaced 0).
    - Repeated rows are treated alike; all other columns are kept, whatever their names.
    - An entity has the same surrogate in every text; different entities never share one.
    - A column n_replaced that is there already is replaced.

    Only rows with an entity take part in the join with the table of surrogates.
    """
    docs = docs.drop("n_replaced")
    at = docs.columns.index(text_col)
    names = docs.columns
    spans = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("start", T.IntegerType()), ("end", T.IntegerType()), ("kind", T.StringType()), ("value", T.StringType()))]))
    span_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))

    def find(touched: bool):
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                found = [detect(x.decode("utf-8", "replace")) for x in text_bytes(batch.column(at))]
                keep = [i for i, x in enumerate(found) if bool(x) == touched]
                if not keep:
                    continue
                rest = batch.take(pa.array(keep, pa.int64()))
                if touched:
                    made = [[dict(zip(("start", "end", "kind", "value"), x, strict=True)) for x in found[i]] for i in keep]
                    yield pa.record_batch([*rest.columns, pa.array(made, span_kind)], [*names, "__spans"])
                else:
                    yield pa.record_batch([*rest.columns, pa.array([0] * len(keep), pa.int64())], [*names, "n_replaced"])

        return run

    fields = docs.schema.fields
    touched = docs.mapInArrow(find(True), T.StructType([*fields, T.StructField("__spans", spans)]))
    touched = materialise(touched.withColumn("__row", F.monotonically_increasing_id()), "touched")
    mentions = touched.select("__row", F.explode("__spans").alias("x")).select("__row", "x.kind", "x.value").distinct()
    table = surrogates(materialise(mentions.select("kind", "value").distinct(), "entities"), key.encode())
    pairs = F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\0", "kind", "value"), "made")))
    by_row = mentions.join(table, ["kind", "value"]).groupBy("__row").agg(pairs.alias("__made"))

    def put(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts, spans_, made = text_bytes(batch.column(at)), batch.column("__spans").to_pylist(), batch.column("__made").to_pylist()
            out = [rewritten(t.decode("utf-8", "replace"), s, dict(m)) for t, s, m in zip(texts, spans_, made, strict=True)]
            kept = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.record_batch([*kept, pa.array([*map(len, spans_)], pa.int64())], [*names, "n_replaced"])

    schema = T.StructType([*fields, T.StructField("n_replaced", T.LongType())])
    changed = touched.join(by_row, "__row").select(*names, "__spans", "__made").mapInArrow(put, schema)
    return docs.mapInArrow(find(False), schema).union(changed)


def rewritten(text: str, spans: list[dict], made: dict[str, str]) -> str:
    """The text with each span replaced by its surrogate."""
    out, at = [], 0
    for x in spans:
        mention = text[x["start"] : x["end"]]
        out += [text[at : x["start"]], fitted(mention, x["kind"], made[f"{x['kind']}\0{x['value']}"])]
        at = x["end"]
    return "".join([*out, text[at:]])
