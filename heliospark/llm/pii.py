"""Personal data: regular expressions propose spans, checksums confirm them,
nearby words adjust the score. DataFrame functions only (no Python on the
executors).

Defined cases: NULL or empty text has no span; a text of any length is
scanned whole (every pattern is linear: runs are entered only at their first
character, repeats are possessive, so no backtracking and no recursion);
repeated rows give repeated rows; an empty table gives an empty table; other
columns pass through, and clashing ones (``spans``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Marks put round a match. A text that has these two noncharacters itself
# gets another noncharacter there first: same length, never part of a match.
OPEN, CLOSE, OTHER = "﷐", "﷑", "﷒"

# Patterns in contract order. ``(?:\G|(?<!x))`` enters a run of x only at its
# start or right after the last match, where a leftmost match must begin.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+(?<=[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
# A cheap test that a match needs, so that most texts skip the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "national_id": "-"}
# Score of a confirmed span, words that raise it, and the reach in characters.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "national_id": 0.3}
CONTEXT = {
    "email": r"mail|contact|write|kontakt|courriel|correo",
    "ip": r"\bip\b|address|host|server|login",
    "card": r"card|visa|credit|kredit|carte|tarjeta|payment",
    "phone": r"phone|tel|call|mobile|fax|ruf",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "national_id": r"ssn|social|security|national|passport|ausweis",
}
REACH = 48
KEEP = 0.5


def _marked_pieces(text: Column, kind: str) -> Column:
    return F.split(F.regexp_replace(text, PATTERNS[kind], f"{OPEN}$0{CLOSE}"), OPEN)


def _found(pieces: Column, kind: str) -> Column:
    """Matches of a marked text as structs (start, rank, end, kind, match), code points."""
    rank = KINDS.index(kind)
    kind_t = "struct<start:int,rank:int,end:int,kind:string,match:string>"

    def step(acc: Column, piece: Column) -> Column:
        match = F.substring_index(piece, CLOSE, 1)
        n = F.char_length(match)
        span = F.struct(acc["at"].alias("start"), F.lit(rank).alias("rank"), (acc["at"] + n).alias("end"), F.lit(kind).alias("kind"), match.alias("match"))
        return F.struct((acc["at"] + F.char_length(piece) - 1).alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    start = F.struct(F.char_length(pieces[0]).alias("at"), F.array().cast(f"array<{kind_t}>").alias("found"))
    return F.aggregate(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(1))), start, step, lambda acc: acc["found"])


def luhn(digits: Column) -> Column:
    """Luhn check of a string of ASCII digits."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.ascii(F.substr(digits, i, F.lit(1))) - 48
        twice = F.when((n - i) % 2 == 1, d * 2).otherwise(d)
        return acc + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """ISO 7064 mod 97-10 check of an IBAN without blanks."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def add(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int"), F.lit(256)) <= 255)
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        return mod97(F.translate(match, " ", ""))
    if kind == "national_id":
        return ~match.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _confirmed(pieces: Column, kind: str) -> Column:
    return F.filter(_found(pieces, kind), lambda s: _valid(kind, s["match"]))


def _scored(spans: Column, text: Column, kind: str) -> Column:
    def one(s: Column) -> Column:
        before = F.substr(text, F.greatest(s["start"] - REACH, F.lit(0)) + 1, F.least(s["start"], F.lit(REACH)))
        score = F.least(F.lit(PRIOR[kind]) + F.when(F.lower(before).rlike(CONTEXT[kind]), 0.3).otherwise(0.0), F.lit(1.0))
        return F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["match"].alias("match"), score.cast("double").alias("score"))

    return F.transform(spans, one)


def find_personal_data(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Add ``spans``: array<struct<start, rank, end, kind, match, score>> in
    order of start, then kind. Base kinds (email, ip, card, phone) keep every
    confirmed match; the added kinds (iban, national_id) keep matches that
    their checksum or rules confirm and whose score is at least ``KEEP``."""
    df = df.drop("spans")
    text = F.translate(text_of(df, text_column), OPEN + CLOSE, OTHER + OTHER)
    out = df.withColumn("_t", text)
    for kind in KINDS:
        some = F.contains(F.col("_t"), F.lit(NEEDS[kind])) if kind in NEEDS else F.col("_t").rlike("[0-9]")
        out = out.withColumn(f"_p_{kind}", F.when(some, _marked_pieces(F.col("_t"), kind)).otherwise(F.array(F.lit(""))))
    lists = []
    for kind in KINDS:
        pieces = F.col(f"_p_{kind}")
        scored = _scored(_confirmed(pieces, kind), F.col("_t"), kind)
        if kind not in BASE_KINDS:
            scored = F.filter(scored, lambda s: s["score"] >= KEEP)
        empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,match:string,score:double>>")
        lists.append(F.when(F.size(pieces) > 1, scored).otherwise(empty))
    out = out.withColumn("spans", F.array_sort(F.concat(*lists)))
    return out.drop("_t", *[f"_p_{k}" for k in KINDS])


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_rank(rank: int):
    return lambda s: s["rank"] == rank


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of their spans, all spans."""
    found = find_personal_data(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))
    counts = [F.size(F.filter("spans", _of_rank(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
