"""Personal data: regular expressions propose spans, checksums confirm, context words adjust the score.

Only built-in column functions are used. The patterns are written so that Java's matcher stays
linear and does not recurse on long runs: loops are over single characters or bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the kinds look like, in the order in which kinds are listed.
# An e-mail's local part starts where the last match ended or after a character that it cannot hold.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?=\.\.|\.?(?:[^A-Za-z0-9.-]|\z))"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A whole run of digits with single separators; of other lengths than 14 to 19 none can be a card.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# Lengths of IBANs by country, as registered; other countries' are taken as far as they go.
IBAN_LENGTHS = """
15 NO; 16 BE; 18 DK FI FK FO GL NL SD; 19 MK SI; 20 AT BA EE KZ LT LU MN XK; 21 CH CR HR LI LV; 22 BG BH DE GB GE IE ME RS VA;
23 AE GI IL IQ OM SO TL; 24 AD CZ ES MD PK RO SA SE SK TN VG; 25 LY PT ST; 26 IS TR; 27 BI DJ FR GR IT MC MR SM;
28 AL AZ BY CY DO GT HN HU LB NI PL SV; 29 BR EG PS QA UA; 30 JO KW MU YE; 31 MT SC; 32 LC; 33 RU
"""
IBAN_FORMS = [(size, names) for size, *names in (group.split() for group in IBAN_LENGTHS.split(";"))]
IBAN_FORM = "(?:" + "|".join(rf"(?:{'|'.join(names)})[0-9]{{2}}(?: ?[A-Z0-9]){{{int(size) - 4}}}" for size, names in IBAN_FORMS) + r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})"
IBAN = rf"(?<![A-Za-z0-9_]){IBAN_FORM}(?![A-Za-z0-9_])"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

# Words near a span that speak for or against its kind.
CONTEXT = {
    "email": ("mail|e-mail|contact|write|kontakt|correo|courriel", "example|sample|version"),
    "ip": ("ip|address|server|host|login|adresse", "version|release|section|chapter"),
    "card": ("card|visa|credit|payment|karte|tarjeta|carte", "order|isbn|serial|tracking"),
    "phone": ("phone|tel|call|mobile|fax|telefon|teléfono|téléphone", "order|serial|score"),
    "iban": ("iban|account|bank|transfer|konto|cuenta|compte", "order|serial|part"),
}
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
NEAR = 40  # characters before and after a span that count as near

_digits = lambda c: F.regexp_replace(c, "[^0-9]", "")


def _remainder_97(iban: Column) -> Column:
    """Remainder of an IBAN's number: first four characters last, letters as 10 to 35."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    codes = F.transform(F.split(turned, ""), lambda ch: F.when(ch == "", F.lit(-1)).when(ch.rlike("[A-Z]"), F.ascii(ch) - 55).otherwise(F.ascii(ch) - 48))
    step = lambda acc, v: F.when(v < 0, acc).when(v > 9, (acc * 100 + v) % 97).otherwise((acc * 10 + v) % 97)
    return F.aggregate(codes, F.lit(0), step)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: object
    base: bool = True


KINDS = [
    Kind("email", EMAIL, lambda m: F.lit(True)),
    Kind("ip", IP, lambda m: m.rlike(OCTETS)),
    Kind("card", CARD, lambda m: F.call_function("luhn_check", _digits(m))),
    Kind("phone", PHONE, lambda m: F.length(_digits(m)).between(10, 15)),
    Kind("iban", IBAN, lambda m: F.length(F.regexp_replace(m, " ", "")).between(15, 34) & (_remainder_97(m) == 1), False),
]

#: An array of this is what the finder returns.
SPAN = "struct<start:int,kind:int,end:int,name:string>"


#: Items gathered at a time: a growing array is copied with every item, so long lists grow in parts.
_PART = 256


def gathered(items: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column, Column]], start: int = 0) -> Column:
    """struct<at, out>: a fold over `items` that keeps a number and gathers items of a kind.

    `step` gives from (number, item) the next number, whether something is gathered, and what.
    """
    none = F.array().cast(f"array<{kind}>")
    blank = F.struct(F.lit(start).alias("at"), none.alias("part"), F.array().cast(f"array<array<{kind}>>").alias("parts"))

    def merge(acc: Column, x: Column) -> Column:
        at, keep, new = step(acc["at"], x)
        full = F.size(acc["part"]) >= _PART
        part = F.when(keep, F.concat(F.when(full, none).otherwise(acc["part"]), F.array(new))).otherwise(acc["part"])
        parts = F.when(keep & full, F.concat(acc["parts"], F.array(acc["part"]))).otherwise(acc["parts"])
        return F.struct(at.alias("at"), part.alias("part"), parts.alias("parts"))

    return F.aggregate(items, blank, merge, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(F.concat(acc["parts"], F.array(acc["part"]))).alias("out")))


def _spans(text: Column, number: int, kind: Kind) -> Column:
    """Spans of one kind: the pieces between the matches give the offsets, in code points."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    sized = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda m, piece: F.struct(F.char_length(piece).alias("gap"), F.char_length(m).alias("long"), m.alias("m")))

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        start = at + x["gap"]
        end = start + x["long"]
        return end, kind.valid(x["m"]), F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), F.lit(kind.name).alias("name"))

    return F.when(F.size(found) > 0, gathered(sized, SPAN, step)["out"]).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_spans(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """`docs` with `into`: the confirmed spans of all kinds by start, then kind, offsets in code points.

    A null or empty text has none. `into` must not be a column of `docs`.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # All but IBANs hold one of these; most texts are left after a plain search.
    may = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast(f"array<{SPAN}>")
    each = [F.when(may.get(k.name, F.lit(True)), _spans(text, i, k)).otherwise(none) for i, k in enumerate(KINDS)]
    return docs.withColumn(into, F.array_sort(F.concat(*each)))


def scores(text: Column, spans: Column) -> Column:
    """A score from 0 to 1 for each span: the kind's own, moved by words that stand near it."""

    def one(s: Column) -> Column:
        near = F.lower(F.concat(F.substr(text, F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR))), F.lit(" "), F.substr(text, s["end"] + 1, F.lit(NEAR))))
        score = F.lit(0.0)
        for name, (good, bad) in CONTEXT.items():
            moved = F.lit(BASE_SCORE[name]) + F.when(near.rlike(rf"(?<!\p{{L}})(?:{good})(?!\p{{L}})"), 0.1).otherwise(0.0) - F.when(near.rlike(rf"(?<!\p{{L}})(?:{bad})(?!\p{{L}})"), 0.3).otherwise(0.0)
            score = F.when(s["name"] == name, F.least(moved, F.lit(1.0))).otherwise(score)
        return F.round(score, 2)

    return F.transform(spans, one)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_iban and scores for every row.

    A span is written kind:start:end; spans are in order of start, then of kind (email, ip, card,
    phone, iban), with commas between, and scores in the same order. base_sha256 is over the spans
    of the first four kinds. A null text is taken as empty; without spans the lists are empty.
    Repeated rows and null ids come back as they are; other columns are not read.
    """
    rows = find_spans(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    count = lambda n: F.size(F.filter("pii", lambda s: s["name"] == n)).cast("long")
    listed = _listed(F.col("pii"))
    base = F.when(F.exists("pii", lambda s: s["name"] == "iban"), _listed(F.filter("pii", lambda s: s["name"] != "iban"))).otherwise(listed)
    return rows.select(
        "doc_id",
        *(count(k.name).alias(f"n_{k.name}") for k in KINDS if k.base),
        F.sha2(base, 256).alias("base_sha256"),
        listed.alias("spans"),
        count("iban").alias("n_iban"),
        F.array_join(F.transform(scores(F.col("text"), F.col("pii")), lambda x: x.cast("string")), ",").alias("scores"),
    )


def redact(docs: DataFrame, text_col: str = "text", least_score: float = 0.0, length_col: str | None = None) -> DataFrame:
    """`docs` with every span of at least this score replaced by its kind in brackets.

    Spans that overlap are replaced together, by the kind of the first. A null text stays null.
    `length_col`, if given, is set to a changed text's length in code points.
    """
    names = docs.columns
    rows = find_spans(docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(text_col).alias("text")))
    if least_score > 0:
        chosen = F.zip_with("pii", scores(F.col("text"), F.col("pii")), lambda s, x: F.struct(s.alias("s"), x.alias("x")))
        rows = rows.withColumn("pii", F.transform(F.filter(chosen, lambda z: z["x"] >= least_score), lambda z: z["s"]))

    def step(at: Column, s: Column) -> tuple[Column, Column, Column]:
        gap = F.substr(F.col("text"), at + 1, s["start"] - at)
        return F.greatest(at, s["end"]), s["start"] >= at, F.concat(gap, F.lit("["), F.upper(s["name"]), F.lit("]"))

    done = gathered(F.col("pii"), "string", step)
    rest = F.concat(F.array_join(done["out"], ""), F.substr(F.col("text"), done["at"] + 1))
    new = F.when(F.size("pii") > 0, rest).otherwise(F.col("text"))
    fresh = rows.select("row", new.alias("new"), (F.size("pii") > 0).alias("changed"))
    cols = []
    for c in names:
        if c == text_col:
            cols.append(F.col("new").alias(c))
        elif c == length_col:
            cols.append(F.when(F.col("changed"), F.char_length("new").cast(docs.schema[c].dataType)).otherwise(F.col(f"row.`{c}`")).alias(c))
        else:
            cols.append(F.col(f"row.`{c}`").alias(c))
    return fresh.select(*cols)
