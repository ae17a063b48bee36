"""Toxicity of documents after noisy-channel deobfuscation.

Suspect words (leetspeak inside letters, letters spaced or dotted apart,
stretched letters) become character lattices: a symbol may stand for the
letters it imitates, a separator may vanish, a repeat may collapse. Viterbi
decoding under a character trigram model, counted over every document, gives
the restored text. A blank or separator in a run may also end a word, so a
run of any length is read as one word or several by the same lattice. A
logistic model over the words and affixes of restored texts, fitted on
labelled rows that are not held out, gives the score.

Bounds: the classifier is fitted on at most ``POSITIVES`` and ``NEGATIVES``
labelled rows (the least by a hash of doc_id), and their features of enough
evidence are all used; the language model has ``SYMBOLS``^3 cells whatever the corpus. Every document is
counted and scored whole.

Defined cases: NULL or empty text scores as text without features; without
usable labels of both classes every score is 0; repeated rows score alike;
labels given twice count as toxic if one is; NULL labels are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITIVES, NEGATIVES = 3000, 6000
LEAST_DOCS = 4  # positive sample documents that a feature must occur in

LEAST_EVIDENCE = 5.0  # log-likelihood ratio of a feature

# Symbols of the language model: 0 between words, a-z, 27 any other letter.
SYMBOLS = 28
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "×": "x",
}
SEPARATORS = frozenset(".-_*~'`^")
# Nats for reading a symbol as a letter, for a separator dropped or read as the
# end of a word, for a dropped symbol and repeat.
COST_LEET, COST_SEPARATOR, COST_END, COST_DROP, COST_REPEAT = 0.5, 0.3, 2.0, 12.0, 1.0
PIECE = 64  # characters decoded between two links of what is done
EDGES = "%#&*?,.;:\"'()[]<>{}/\\="

L = r"[^\W\d_]"
IMITATES = "[" + re.escape("".join(LEET)) + "]"
SUSPECT = re.compile(
    rf"{L}(?:{IMITATES}|[.\-_*~'`^])+(?={L})(?:(?<={IMITATES})|(?<=\W{L}[.\-_*~'`^])(?={L}[.\-_*~'`^]))"  # inside letters
    rf"|(?<!\S){IMITATES}+{L}|{L}{IMITATES}(?=[\s,.;:?]|\Z)"  # at an end of letters
    rf"|({L})\1\1"  # stretched
    rf"|(?<!\S)(?:[^\W_]|{IMITATES})(?:[ ](?:[^\W_]|{IMITATES})){{2,}}(?!\S)"  # spaced apart
)
NOT_LETTERS = re.compile(r"[\W\d_]+")
# Shapes of what is no word. Letters set apart by dots are no address.
ADDRESS = re.compile(r"(?<![\w.+%-])(?:\w\.){0,3}[\w+%-]+(?:\.[\w+%-]{2,})*@[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}(?!\w)")
PATH = re.compile(
    r"[a-z][a-z0-9+.-]*://|www\.[\w-]{2,}\.|[\w-]{2,}(?:\.[\w-]+)*\.[a-z]{2,}(?::\d+)?/"  # an address of the web, with or without scheme
    r"|(?:~|\.\.?|[a-z]:)[/\\]|[/\\][^/\\]+[/\\]"  # a path from a root
    r"|\S*/[\w-]{2,}(?:\.[\w-]{2,})*\.[a-z]\w{0,4}\Z"  # a path to a file
)
HEXADECIMAL = re.compile(r"(?:0x)?(?=[a-f-]*\d)[0-9a-f]{8,}(?:-?[0-9a-f]{4,})*")
TOKEN = re.compile(r"[a-z0-9+/=_-]{40,}")


def is_key(word: str) -> bool:
    """A long hexadecimal number, or random letters and digits: letters that
    are rare in words are then as frequent as others."""
    if len(word) >= 32 and HEXADECIMAL.fullmatch(word):
        return True
    if not TOKEN.fullmatch(word):
        return False
    rare = [word.count(c) for c in "jqxz"]
    return sum(n > 0 for n in rare) >= 3 and sum(rare) >= 0.06 * len(word) and sum(map(word.count, "0123456789")) >= 0.05 * len(word)


class Restorer:
    """Decoder under trigram counts of shape (SYMBOLS, SYMBOLS, SYMBOLS)."""

    def __init__(self, counts: np.ndarray) -> None:
        n3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        n2, n1 = n3.sum(0), n3.sum((0, 1))
        p1 = (n1 + 1) / (n1.sum() + SYMBOLS)
        p2 = (n2 + 5 * p1) / (n2.sum(1, keepdims=True) + 5)
        p3 = (n3 + 5 * p2) / (n3.sum(2, keepdims=True) + 5)
        self.cost = (-np.log(p3)).ravel().tolist()
        self.known: dict[str, str] = {}

    @staticmethod
    def symbol(c: str) -> int:
        return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0

    def options(self, c: str, last: str) -> list[tuple[str, float]]:
        """What a character may stand for after a given letter, with costs. A
        blank or separator may stand for nothing or, less often, end a word,
        in runs of any length."""
        if c.isalpha():
            return [(c, 0.0), ("", COST_REPEAT)] if c == last else [(c, 0.0)]
        if c == " " or c in SEPARATORS and not LEET.get(c):
            return [("", COST_SEPARATOR)] + [(" ", COST_END)] * (last not in ("", " "))
        out = [(x, COST_LEET) for x in LEET.get(c, "")]
        if last in LEET.get(c, "#"):
            out.append(("", COST_REPEAT))
        out.append(("", COST_SEPARATOR if c in SEPARATORS else COST_DROP))
        return out

    def decode(self, word: str) -> str:
        """The likeliest letters behind a lower-case word."""
        if word in self.known:
            return self.known[word]
        cost, symbol = self.cost, self.symbol
        # Best (cost, letters, letters of the pieces before) by the last two symbols and the last letter.
        beam = {(0, 0, ""): (0.0, "", None)}
        for at in range(0, len(word), PIECE):
            for c in word[at : at + PIECE]:
                new: dict[tuple[int, int, str], tuple[float, str, tuple | None]] = {}
                for (a, b, last), (total, done, before) in beam.items():
                    for letter, extra in self.options(c, last):
                        if letter:
                            s = symbol(letter)
                            key, value = (b, s, letter), total + extra + cost[(a * SYMBOLS + b) * SYMBOLS + s]
                        else:
                            key, value = (a, b, last), total + extra
                        if key not in new or value < new[key][0]:
                            new[key] = (value, done + letter, before)
                beam = new
            if at + PIECE < len(word):
                beam = {key: (total, "", (done, before)) for key, (total, done, before) in beam.items()}
        ends = [(total + (cost[(a * SYMBOLS + b) * SYMBOLS] if last != " " else 0.0), done, before) for (a, b, last), (total, done, before) in beam.items()]
        _, best, before = min(ends, key=lambda e: e[:2])
        pieces = [best]
        while before:
            pieces.append(before[0])
            before = before[1]
        best = "".join(reversed(pieces))
        if len(word) <= 40:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[word] = best
        return best

    def restore(self, text: str) -> str:
        """The lower-case text with suspect words decoded."""
        text = text.lower()
        out, at = [], 0
        for m in SUSPECT.finditer(text):
            if m.start() < at:
                continue
            start, end = m.start(), m.end()
            while start > at and not text[start - 1].isspace():
                start -= 1
            while end < len(text) and not text[end].isspace():
                end += 1
            word = text[start:end]
            core = re.sub(r"([^\w\s])(?:\s*\1)+$", "", word.strip(EDGES + " "))
            if " " not in word and (ADDRESS.search(core) or PATH.match(word.strip("\"'()[]<>{},;")) or is_key(core)):
                out += [text[at:start], word]  # an address, a path or a key, not a word
                at = end
                continue
            parts = [self.decode(p) if any(c.isalpha() for c in p) else p for p in core.split("/")]
            out += [text[at:start], "/".join(parts) if any(c.isalpha() for c in core) else word]
            at = end
        return "".join([*out, text[at:]]) if out else text


def spaced_letters(restored: str) -> str:
    """Words of a restored text with one space around each."""
    return f" {NOT_LETTERS.sub(' ', restored)} "


def features(words: set[str]) -> set[str]:
    """Words, heads and tails of the words of a document, with the space at their edge."""
    out = set()
    for w in words:
        out.add(f" {w} ")
        for n in range(3, min(9, len(w))):
            out.add(f" {w[:n]}")
        for n in range(4, min(7, len(w))):
            out.add(f"{w[-n:]} ")
    return out


_TABLE = np.zeros(0x110000, np.uint8)


def _symbols(text: str) -> np.ndarray:
    if not _TABLE[97]:
        _TABLE[0xAA:] = 27
        _TABLE[0x2000:0x2C00] = _TABLE[0x3000:0x3040] = 0
        _TABLE[[0xD7, 0xF7, *range(0xAB, 0xC0)]] = 0
        _TABLE[97:123] = _TABLE[65:91] = np.arange(1, 27)
    return _TABLE[np.frombuffer(text.encode("utf-32-le"), np.uint32)]


def character_counts(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Trigram counts over every document: one partial table per task, summed by cell."""
    cells = SYMBOLS**3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                s = np.concatenate([[0, 0], _symbols(text or ""), [0]]).astype(np.uint16)
                s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]  # one boundary between words
                s = np.concatenate([[0], s])
                total += np.bincount((s[:-2].astype(np.int32) * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=cells)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["cell", "n"])

    rows = docs.select(text_column).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most SYMBOLS^3
    out = np.zeros(cells, np.int64)
    out[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return out


def is_held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """Bounded sample of labelled rows that are not held out: (text, y)."""
    own = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~is_held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max(label).alias("y")).withColumn("h", F.xxhash64("doc_id"))
    some = own.where("y > 0").orderBy("h").limit(POSITIVES).unionByName(own.where("y <= 0").orderBy("h").limit(NEGATIVES))
    some = some.select("doc_id", (F.col("y") > 0).cast("int").alias("y"))
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "y")


def _logistic(rows: list[np.ndarray], y: np.ndarray, n: int, penalty: float = 0.5, steps: int = 400) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression on sets of features (Adam, full batch)."""
    indices = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, b = np.zeros(n), 0.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for k in range(1, steps + 1):
        z = np.bincount(row, w[indices], len(rows)) + b
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.append(np.bincount(indices, e[row], n) + penalty * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


class Model:
    """Language model, features and weights; small and fixed in size, sent with the task."""

    def __init__(self, counts: np.ndarray, weights: dict[str, float], intercept: float) -> None:
        self.counts, self.weights, self.intercept = counts, weights, intercept

    def scorer(self):
        """text -> (score, restored text), made once per task."""
        import ahocorasick

        restorer = Restorer(self.counts)
        machine = ahocorasick.Automaton()
        for i, (feature, weight) in enumerate(self.weights.items()):
            machine.add_word(feature, (i, weight))
        if self.weights:
            machine.make_automaton()

        def score(text: str) -> tuple[float, str]:
            restored = restorer.restore(text)
            found = {x for _, x in machine.iter(spaced_letters(restored))} if self.weights else ()
            z = self.intercept + math.fsum(w for _, w in found)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), restored

        return score


def _counted(found: DataFrame) -> dict[str, int]:
    """(feature, n) rows of the sample, which bounds them, without an object for each on the way."""
    table = found.toArrow()
    return dict(zip(table["feature"].to_pylist(), table["n"].to_pylist(), strict=True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Count the language model over all documents and fit the classifier."""
    counts = character_counts(docs)
    sample = labelled_sample(docs, labels, label).repartition(docs.sparkSession.sparkContext.defaultParallelism)
    sample = sample.persist()

    def words_of(restorer: Restorer, text: str | None) -> set[str]:
        return set(spaced_letters(restorer.restore(text or "")).split())

    def positive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, seen = Restorer(counts), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(features(words_of(restorer, text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["feature", "n"])

    y1 = sample.where("y = 1")
    candidates = y1.select("text").mapInArrow(positive, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    n_pos, n_neg = y1.count(), sample.where("y = 0").count()
    if not n_pos or not n_neg:
        sample.unpersist()
        return Model(counts, {}, -40.0)
    pos = _counted(candidates)

    def negative(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, seen = Restorer(counts), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(f for f in features(words_of(restorer, text)) if f in pos)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["feature", "n"])

    neg = _counted(sample.where("y = 0").select("text").mapInArrow(negative, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n")))

    def evidence(f: str) -> float:
        """Log-likelihood ratio of a feature for the positive class."""
        a, b = pos[f], neg.get(f, 0)
        p, q, r = a / n_pos, b / n_neg, (a + b) / (n_pos + n_neg)
        if p <= q:
            return 0.0
        ll = lambda k, n, p: (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)
        return ll(a, n_pos, p) + ll(b, n_neg, q) - ll(a, n_pos, r) - ll(b, n_neg, r)

    # All that the sample bears out, the strongest first.
    ranked = sorted(((evidence(f), f) for f in pos), key=lambda x: (-x[0], x[1]))
    index = {f: i for i, (e, f) in enumerate(ranked) if e > LEAST_EVIDENCE}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(counts)
        for batch in batches:
            found = [[index[f] for f in features(words_of(restorer, text)) if f in index] for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["found", "y"])

    rows = sample.mapInArrow(present, "found array<int>, y int").toArrow()  # bounded by the sample
    sample.unpersist()
    y = rows["y"].to_numpy().astype(float)
    w, b = _logistic([np.sort(r.values.to_numpy()).astype(np.int64) for r in rows["found"]], y, len(index))
    totals = labels.where(F.col(label).isNotNull()).where(~is_held_out(F.col("doc_id"))).agg(F.sum((F.col(label) > 0).cast("long")), F.sum((F.col(label) <= 0).cast("long"))).first()
    b += math.log((totals[0] / totals[1]) / (n_pos / n_neg))  # the sample's share of positives is not the labels'
    return Model(counts, {f: float(w[i]) for f, i in index.items()}, b)


def score(df: DataFrame, model: Model, restored: bool = False, keep_text: bool = True, text_column: str = "text") -> DataFrame:
    """Add ``score`` and, if asked, ``restored``, the deobfuscated lower-case
    text. Other columns pass through, the text if ``keep_text``."""
    from pyspark.sql import types as T

    keep = [c for c in df.columns if c not in ("score", "restored") and (keep_text or c != text_column)]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("score", T.DoubleType(), False)] + [T.StructField("restored", T.StringType(), False)] * restored)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for batch in batches:
            both = [one(t or "") for t in batch.column(len(keep)).to_pylist()]
            made = [pa.array([s for s, _ in both], pa.float64())] + [pa.array([t for _, t in both], pa.string())] * restored
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=schema.names)

    return df.select(*keep, F.col(text_column).alias("_scored_text")).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``."""
    return score(docs, fit(docs, labels)).where(F.col("score") < least).select(*docs.columns)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels), keep_text=False)
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
