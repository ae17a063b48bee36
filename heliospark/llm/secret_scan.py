"""Secrets in texts: patterns propose candidates, a random forest removes the
false positives. DataFrame functions and Spark ML only.

A candidate is a provider-shaped key, a private key block, a long run of key
characters with a digit, or a quoted value given to a name like ``password``.
The forest sees its length, character classes and transitions, entropy,
coverage by the frequent words of the corpus, the path it stands in and the neighbouring words. It is
fitted on labelled findings: ``labelled_findings`` labels the clear cases of
the table at hand (a reviewed table of the same columns may be given instead),
at most ``SAMPLE`` of each label, the least by a hash. Everything is scanned
and scored whole.

Defined cases: NULL or empty text has no finding; without labelled findings of
both kinds the scores are the labels' own rule; repeated rows give repeated
findings; an empty table gives no findings; ``source`` may be absent.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .pii import CLOSE, OPEN, OTHER

SAMPLE = 4000
TREES, DEPTH = 24, 6
KEEP = 0.5
REACH = 48
MASK = "<SECRET>"

# Runs are entered at their first character only and repeats are possessive, so
# a value of any length is one candidate and the scan stays linear.
KEY = "[A-Za-z0-9+/_=-]"
CANDIDATE = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s:,]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
    r"|\beyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
    r"|\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[0-9A-Za-z-]{10,}|sk_(?:live|test)_[0-9A-Za-z]{16,}+|AIza[0-9A-Za-z_-]{35})\b"
    rf"|(?<!{KEY})(?=[A-Za-z+/_=-]*+[0-9]){KEY}{{16,}}+"
    r"|(?<=(?i:passwd|password|pwd|secret|token)\s{0,3}[=:]\s{0,3}[\"'])[^\s\"']{6,}+(?=[\"'])"
)
PROVIDER = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}|sk_(live|test)_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ|-----BEGIN)"
SECRET_WORDS = r"(?i)(secret|token|passwd|password|pwd|api[_-]?key|auth|bearer|credential|private|access[_-]?key)"
OTHER_WORDS = r"(?i)(commit|sha-?\d*|md5|checksum|hash|uuid|guid|digest|revision|etag|example|placeholder|dummy|sample|version|isbn|order|invoice|card)"
PLACEHOLDER = r"(?i)(xxxx|example|changeme|your[_-]|dummy|sample|placeholder|test1234|1234567890|(.)\2{7})"
RARE = 5000  # a word of the dictionary is at least one in so many of all words
FEATURES = ["length", "digits", "upper", "hexadecimal", "transitions", "distinct", "entropy", "vowels", "dictionary", "provider", "assigned", "quoted", "secret_near", "other_near", "in_path", "test_path", "placeholder"]


def candidates(df: DataFrame, text_column: str = "text") -> DataFrame:
    """One row per candidate: the columns of ``df`` but the text, and ``start``,
    ``end`` (code points), ``value``, ``before``, ``after`` (its neighbourhood)."""
    names = ("start", "end", "value", "before", "after")
    keep = [c for c in df.columns if c not in (text_column, *names)]
    text = F.translate(text_of(df, text_column), OPEN + CLOSE, OTHER + OTHER)
    some = df.select(*keep, text.alias("_t")).where(F.col("_t").rlike("[0-9]|[=:][ \t]{0,3}[\"']|AKIA|BEGIN"))
    some = some.withColumn("_p", F.split(F.regexp_replace("_t", CANDIDATE, f"{OPEN}$0{CLOSE}"), OPEN)).where(F.size("_p") > 1)
    # Where each piece begins: running sum of the lengths before, without the marks.
    starts = F.aggregate(
        F.slice("_p", F.lit(2), F.size("_p") - 1),
        F.struct(F.char_length(F.col("_p")[0]).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, p: F.struct((acc["at"] + F.char_length(p) - 1).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"],
    )
    found = some.select(*keep, "_t", F.explode(F.arrays_zip(starts.alias("start"), F.slice("_p", F.lit(2), F.size("_p") - 1).alias("piece"))).alias("_c"))
    value = F.substring_index("_c.piece", CLOSE, 1)
    start, end = F.col("_c.start"), F.col("_c.start") + F.char_length(value)
    return found.select(
        *keep,
        start.alias("start"),
        end.alias("end"),
        value.alias("value"),
        F.substr("_t", F.greatest(start - REACH, F.lit(0)) + 1, F.least(start, F.lit(REACH))).alias("before"),
        F.substr("_t", end + 1, F.lit(REACH)).alias("after"),
    )


def dictionary(df: DataFrame, text_column: str = "text") -> list[str]:
    """The frequent words of the whole corpus: of three ASCII letters or more,
    at least one in RARE of all such words, so there are RARE at most."""
    words = df.select(F.explode(F.split(F.lower(text_of(df, text_column)), "[^a-z]+")).alias("w")).where(F.length("w") > 2)
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "secret_words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r["w"] for r in counts.where(F.col("n") * RARE >= total).select("w").collect()]


def _share(value: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(value, pattern, "")) / F.greatest(F.char_length(value), F.lit(1))


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """Add the forest's inputs as double columns. Dictionary coverage is the
    share of characters in words, taken apart at changes of case and other signs."""
    v, n = F.col("value"), F.greatest(F.char_length("value"), F.lit(1))
    chars = F.split(v, "")
    # Class of each character, then how often neighbours differ in class.
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[0-9]", "9"), "[A-Z]", "Z"), "[a-z]", "a")
    runs = F.char_length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    entropy = F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda acc, c: acc - (F.size(F.filter(chars, lambda x: x == c)) / n) * F.log2(F.size(F.filter(chars, lambda x: x == c)) / n),
    )
    path = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in found.columns else F.lit("")
    parts = F.split(F.lower(F.regexp_replace(F.regexp_replace(v, "([a-z])([A-Z])", "$1 $2"), "[^A-Za-z]+", " ")), " ")
    covered = F.aggregate(F.filter(parts, lambda w: w.isin(words) if words else F.lit(False)), F.lit(0), lambda acc, w: acc + F.length(w))
    near = F.substr("before", F.greatest(F.char_length("before") - 23, F.lit(1)))
    made = {
        "length": n,
        "digits": _share(v, "[^0-9]"),
        "upper": _share(v, "[^A-Z]"),
        "hexadecimal": v.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "transitions": runs / n,
        "distinct": F.size(F.array_distinct(chars)) / n,
        "entropy": entropy,
        "vowels": _share(v, "[^aeiouAEIOU]"),
        "dictionary": covered / n,
        "provider": v.rlike(PROVIDER),
        "assigned": near.rlike(r"[\w-]\s{0,3}[=:]\s{0,3}[\"']?$"),
        "quoted": near.rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        "secret_near": near.rlike(SECRET_WORDS),
        "other_near": near.rlike(OTHER_WORDS),
        "in_path": near.rlike("(://|/|\\\\|www\\.)\\S*$"),
        "test_path": path.rlike("(?i)test|spec|example|sample|fixture|mock|doc"),
        "placeholder": v.rlike(PLACEHOLDER),
    }
    return found.drop(*made).select("*", *(c.cast("double").alias(k) for k, c in made.items()))


def rule(found: DataFrame) -> Column:
    """1 for a clear secret, 0 for a clear false positive, NULL between."""
    secret = ((F.col("provider") > 0) | (F.col("assigned") * F.col("secret_near") > 0) & (F.col("entropy") > 2.8)) & (F.col("placeholder") == 0) & (F.col("test_path") == 0)
    plain = (F.col("provider") == 0) & (F.col("secret_near") == 0)
    return F.when(secret, 1).when(plain, 0).when(F.col("placeholder") > 0, 0)


def labelled_findings(found: DataFrame) -> DataFrame:
    """The clear cases with ``label``, at most ``SAMPLE`` of each, in a fixed order."""
    known = found.withColumn("label", rule(found)).where("label IS NOT NULL").select("label", *FEATURES, F.xxhash64("value", "before").alias("_h"))
    each = [known.where(F.col("label") == k).orderBy("_h", *FEATURES).limit(SAMPLE) for k in (0, 1)]
    return each[0].unionByName(each[1]).drop("_h")


def fit(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """Forest over labelled findings; None unless both labels occur."""
    if labelled.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(labelled).select("_x", F.col("label").cast("double"))
    return RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7).fit(rows)


def find_secrets(df: DataFrame, text_column: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """One row per kept finding: the columns of ``df`` but the text, ``start``,
    ``end``, ``value`` and ``score``, the forest's share of votes."""
    df = df.drop("score")
    keep = [c for c in df.columns if c != text_column]
    found = stored(with_features(candidates(df, text_column), dictionary(df, text_column)), "secret_candidates")
    model = fit(stored(labelled if labelled is not None else labelled_findings(found), "secret_labels"))
    if model is None:
        scored = found.withColumn("score", F.coalesce(rule(found), F.lit(0)).cast("double"))
    else:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(found)
        # A provider's own format is proof enough where the labelled rows had none of it.
        shaped = (F.col("provider") > 0) & (F.col("placeholder") == 0) & (F.col("test_path") == 0)
        scored = model.transform(rows).withColumn("score", F.greatest(vector_to_array("probability")[1], F.when(shaped, 0.9).otherwise(0.0)))
    return scored.where(F.col("score") >= KEEP).select(*[c for c in keep if c not in ("start", "end", "value", "before", "after")], "start", "end", "value", "score")


def mask_secrets(docs: DataFrame, key: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with every found secret replaced by ``MASK``, span by span; all
    rows and columns stay. Findings meet their row by id and text, as ids may be
    NULL or repeated: rows alike in both have the same spans."""
    named = docs.withColumn("_th", F.xxhash64(text_of(docs, text_column)))
    found = find_secrets(named.select(key, "_th", text_column, *(["source"] if "source" in docs.columns else [])), text_column)
    spans = found.groupBy(F.col(key).alias("_k"), F.col("_th").alias("_h")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    joined = named.join(spans, named[key].eqNullSafe(F.col("_k")) & (named["_th"] == F.col("_h")), "left")
    text = F.col(text_column)
    masked = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)),
    )
    return joined.withColumn(text_column, F.when(F.size("_spans") > 0, masked).otherwise(text)).select(*docs.columns)


def secret_findings(docs: DataFrame) -> DataFrame:
    """doc_id, start, end, digest of the value and score of every finding."""
    found = find_secrets(docs.select("doc_id", "text", "source"))
    return found.select("doc_id", F.col("start").cast("long"), F.col("end").cast("long"), F.sha2("value", 256).alias("value_sha256"), "score")
