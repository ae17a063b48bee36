"""Fingerprints, near copies, repeats, embeddings, toxicity and the pipeline against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliospark.llm import common, fingerprint, hnsw, minhash, suffix, toxicity

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


def plus(spark, rows):
    return documents(spark).unionByName(spark.createDataFrame(rows, SCHEMA))


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 301), (301, 302), (302, 300)]
    got = {r.node: r.component for r in common.component_labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 301: 300, 302: 300}
    assert common.component_labels(spark.createDataFrame([], "a long, b long")).count() == 0


# -- fingerprints ------------------------------------------------------------


def test_entropy_bins_and_features_against_plain_python(spark):
    ranks = fingerprint.rarity_ranks(fingerprint.entropy_histogram(documents(spark)))
    long = max((r.text for r in documents(spark).collect()), key=len)[:900]
    for text in (long, "a" * 200, "ab" * 100 + "xyz" * 50):
        x = np.frombuffer(text.encode(), np.uint8)
        bins = fingerprint.entropy_bins(x)
        w = fingerprint.WINDOW
        for i in range(0, len(bins), 17):
            s = sum(v * math.log2(v) for v in collections.Counter(x[i : i + w].tolist()).values())
            full = w * math.log2(w)
            assert abs((full - s) / full * (fingerprint.BINS - 1) - bins[i]) <= 1.01
        popular = collections.Counter()
        for i in range(len(bins) - fingerprint.NEAR + 1):
            rank, at = min((ranks[bins[j]], j) for j in range(i, i + fingerprint.NEAR))
            if rank < fingerprint.BINS:
                popular[at] += 1
        assert fingerprint.feature_starts(x, np.array([len(x)]), ranks).tolist() == sorted(k for k, v in popular.items() if v >= fingerprint.POPULAR)


def test_blocks_of_a_long_text_change_nothing(spark, monkeypatch):
    ranks = fingerprint.rarity_ranks(fingerprint.entropy_histogram(documents(spark)))
    text = "".join(r.text for r in documents(spark).collect())[:120_000].encode()
    whole = fingerprint.fingerprints([text, b"other text that is short"], ranks)
    monkeypatch.setattr(fingerprint, "BLOCK", 7000)
    cut = fingerprint.fingerprints([text, b"other text that is short"], ranks)
    assert [f.text() for f in whole] == [f.text() for f in cut]
    assert fingerprint.Fingerprint.parse(whole[0].text()).likeness(whole[0]) == 1.0


def test_likeness_does_not_jump_where_features_are_few(spark):
    ranks = fingerprint.rarity_ranks(fingerprint.entropy_histogram(documents(spark)))
    found = 0
    for text in (r.text.encode() for r in documents(spark).limit(40).collect() if r.text and len(r.text) > 400):
        counts = [len(fingerprint.feature_starts(np.frombuffer(text[:n], np.uint8), np.array([n]), ranks)) for n in range(len(text))]
        cut = next((n for n in range(1, len(text)) if counts[n] == fingerprint.FEW and counts[n - 1] == fingerprint.FEW - 1), None)
        if cut is None:
            continue
        found += 1
        few, enough, longer = fingerprint.fingerprints([text[: cut - 1], text[:cut], text], ranks)
        assert few.likeness(enough) > 0.9 and enough.likeness(few) > 0.9
        assert few.likeness(longer) > 0.5
        parse = fingerprint.Fingerprint.parse
        assert parse(few.text()).likeness(parse(enough.text())) == few.likeness(enough)
    assert found > 3


def test_edited_report(spark):
    docs = plus(spark, [(900001, None), (900002, ""), (900003, ""), (900004, "same text, twice here"), (900005, "same text, twice here"), (900006, "y" * 5000)])
    rows = {r.doc_id: r for r in fingerprint.edited_report(docs).collect()}
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    assert len(rows) == len(texts)
    for (k, t), (_, nxt) in zip(texts, texts[1:] + texts[:1], strict=True):
        half = len(t) // 2
        r = rows[k]
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
        assert r.n_chars == len(t) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert rows[900005].near_next == 1.0 and rows[900005].fingerprint == rows[900004].fingerprint
    assert rows[900002].fingerprint == "" and rows[900002].near_next == 1.0  # the next one is NULL
    long = [rows[k] for k, t in texts if len(t) > 1000 and k < 900000]
    assert np.median([r.near_edited for r in long]) > 0.3 > 0.15 > np.median([r.near_next for r in long])
    assert fingerprint.edited_report(docs.limit(0)).count() == 0
    one = fingerprint.edited_report(spark.createDataFrame([(1, "only one"), (None, "and one without id")], SCHEMA)).collect()
    assert {r.doc_id for r in one} == {1, None}
    alike = fingerprint.edited_report(spark.createDataFrame([(5, "a a a")] * 3 + [(4, "b b b")], SCHEMA)).collect()
    assert sorted(r.doc_id for r in alike) == [4, 5, 5, 5]


@pytest.mark.parametrize("hot", [None, 5, 1000, 2**62 + 1])
def test_ids_that_fill_several_runs(spark, monkeypatch, hot):
    """Documents of one id (or none) are dealt to several runs and still follow
    each other, in the order of their texts' hashes."""
    monkeypatch.setattr(fingerprint, "RUN_BYTES", 600)
    rng = random.Random(7)
    rows = [(hot, " ".join(rng.choice(["ab", "cd", "efg"]) for _ in range(20)) + str(i)) for i in range(60)]
    rows += [(i, f"text {i} " + "xyz " * rng.randint(0, 20)) for i in range(0, 40, 2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    dealt = fingerprint.in_descending_runs(docs)
    assert dealt.where("NOT guest").groupBy("id").agg(F.count_distinct("run").alias("n")).agg(F.max("n")).first()[0] > 3
    order = docs.select("doc_id", "text", F.xxhash64("text").alias("t"), F.coalesce("doc_id", F.lit(fingerprint.LEAST_ID)).alias("i")).orderBy(F.desc("i"), "t").collect()
    want = {}
    for r, nxt in zip(order, order[1:] + order[:1], strict=True):
        half = len(r.text) // 2
        want[r.text] = hashlib.sha256((r.text[: len(r.text) - half] + nxt.text[:half]).encode()).hexdigest()
    got = fingerprint.edited_report(docs).select("doc_id", "n_chars", "edited_sha256").collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(want.values())


# -- near copies -------------------------------------------------------------


def bag(text):
    words = (text or "").lower().split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def classes(rows, least=0.8):
    rows = sorted(rows)
    bags = [bag(t) for _, t in rows]
    links = []
    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            both, either = sum((a & b).values()), sum((a | b).values())
            if either == 0 or both / either >= least:
                links.append((i, j))
    root = roots(len(rows), links)
    return {k: rows[r][0] for (k, _), r in zip(rows, root, strict=True)}


def test_bagminhash_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(80):
        k = int(rng.integers(5, 200))
        h = rng.integers(0, 2**63, k).astype(np.uint64)
        w1 = rng.integers(0, 9, k)
        w2 = np.where(rng.random(k) < 0.7, w1, rng.integers(0, 9, k))
        s = [minhash.signatures(np.zeros((w > 0).sum(), int), h[w > 0], w[w > 0], 1)[0] for w in (w1, w2)]
        errors.append((s[0] == s[1]).mean() - np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_look_alikes_lose_fewer_links_than_the_bands():
    n, p = minhash.REGISTERS, minhash.LEAST
    lost = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(minhash.LOOKS_ALIKE))
    assert lost < (1 - p**minhash.ROWS) ** minhash.BANDS / 10


def near_rows():
    """A chain of edits (neighbours alike, ends not), copies, repeats, and short and empty texts."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(4000)}" for _ in range(300)]
    rows = []
    for i in range(60):
        rows.append((910000 + i, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(300)] = f"e{rng.randrange(4000)}"
    rows += [(920000, None), (920001, ""), (920002, "one two"), (920003, "One  two"), (920004, "one two three"), (920005, "ha " * 400), (920006, "ha " * 390)]
    return rows + [(920007, rows[0][1])]


@pytest.mark.parametrize("block", [512, 8])
def test_near_classes_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = plus(spark, near_rows())
    want = classes([(r.doc_id, r.text) for r in docs.collect()])
    got = minhash.classes_report(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_look_alikes_of_large_buckets_are_all_compared(spark, monkeypatch):
    """Of two bucket mates that look alike and stay in different classes, both
    bags have been compared, also where blocks are many."""
    for name, n in (("BLOCK", 6), ("QUICK", 1), ("PAIRS", 3), ("TASK_PARTNERS", 5)):
        monkeypatch.setattr(minhash, name, n)
    made = []

    class Kept(minhash._Links):
        def __init__(self, *a):
            super().__init__(*a)
            made.append(self)

    monkeypatch.setattr(minhash, "_Links", Kept)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(5, 295), 5):
            words[at] = f"e{i}_{at}"
        rows.append((i, " ".join(words)))
        for k in range(i % 4):  # links of their own: the largest classes change
            words[7 * k] += "!"
            rows.append((100 + 10 * i + k, " ".join(words)))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.class_id for r in minhash.classes_report(docs).collect()}
    assert got == classes(rows)
    links = made[0]
    nodes = links.nodes.select("node", "key", "signature").collect()
    sig = np.array([np.frombuffer(r.signature, np.uint32) for r in nodes])
    keys = minhash.band_keys(sig)
    tested = {(r.a, r.b) for r in links.tested.collect()}
    alike = 0
    for i, r in enumerate(nodes):
        for j in np.flatnonzero((keys == keys[i]).any(1) & ((sig == sig[i]).sum(1) >= minhash.LOOKS_ALIKE)):
            if got[r.key] < got[nodes[j].key]:
                alike += 1
                assert (min(r.node, nodes[j].node), max(r.node, nodes[j].node)) in tested
    assert alike > 200


def test_near_copies_dropped_with_other_columns(spark):
    rows = [(1, "a b c d e f g", "x", 5), (1, "a b c d e f g", "x", 5), (2, "a b c d e f g", "y", 6), (3, None, "z", 7), (None, "h i j k l m", "n", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, class_id int")
    kept = minhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.digest) for r in kept.collect()) == [(0, "n"), (1, "x"), (3, "z")]
    assert minhash.without_near_copies(docs.limit(0)).count() == 0


def test_near_copies_are_dropped_by_a_plan_of_few_joins(spark):
    """The driver holds a plan, and plans it anew, for each of its stages."""
    plan = minhash.without_near_copies(documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 and plan.count("Aggregate ") == 1


def test_near_copies_of_shared_and_missing_ids(spark):
    """Different texts of one id, or of none, stand or fall each by itself."""
    rows = [(None, "a b c d e f g"), (None, "h i j k l m n"), (None, "h i j k l m n"), (None, "o p q r s t u"), (5, "v w x y z a b"), (5, "one two three four five six"), (5, "a b c d e f g"), (6, "V w x y z a b"), (7, "o p q r s t u"), (7, "alone with its text here")]
    kept = minhash.without_near_copies(spark.createDataFrame(rows, SCHEMA))
    want = [(0, "a b c d e f g"), (0, "h i j k l m n"), (0, "o p q r s t u"), (5, "one two three four five six"), (5, "v w x y z a b"), (7, "alone with its text here")]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == want


# -- repeats -----------------------------------------------------------------


def repeats(rows, n=suffix.LENGTH):
    data = [(k, (t or "").encode()) for k, t in rows]
    seen = collections.Counter(b[i : i + n] for _, b in data for i in range(len(b) - n + 1))
    out = {}
    for k, b in data:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                covered[i : i + n] = True
        runs = int((np.diff(np.append(0, covered.astype(int))) == 1).sum())
        out[k] = (len(b), int(covered.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~covered])).hexdigest())
    return out


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(2)
    pieces = [bytes(rng.choice([97, 98], 600).astype(np.uint8)) for _ in range(5)]
    pieces += [pieces[0][50:520] + b"zz", b"q" * 700, pieces[1][:430], b"short", b""]
    seen = collections.Counter(p[i : i + 400] for p in pieces for i in range(len(p) - 399))
    for p, starts in zip(pieces, suffix.repeated_strings(pieces), strict=True):
        assert starts.tolist() == [i for i in range(len(p) - 399) if seen[p[i : i + 400]] > 1]
    x = np.append(np.frombuffer(b"banana" * 30, np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16)
    order, group = suffix.suffix_order(x, 100)
    heads = [bytes(x[i : i + 100].astype(np.uint8)) for i in order]
    assert heads == sorted(heads)
    shared = suffix.common_prefixes(x, order, group, np.array([0]), np.array([len(x)]), 100)
    for a, b in zip(order, order[1:], strict=False):
        k = 0
        while k < 100 and max(a, b) + k < len(x) and x[a + k] == x[b + k]:
            k += 1
        assert shared[b] == k


@pytest.mark.parametrize("most", [3000, 2])
def test_repeats_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(suffix, "CLASS_FRAGMENTS", most)  # 2: every class is halved down to single strings
    rng = random.Random(6)
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(120))
    extra = [(930000 + i, " ".join(f"x{rng.randrange(9999)}" for _ in range(30)) + passage[i : 500 + 3 * i] + str(i) * 40) for i in range(12)]
    extra += [(940000, None), (940001, ""), (940002, "x" * 1000), (940003, "é" * 399 + "ab" * 300), (940004, "short"), (940005, "short")]
    docs = plus(spark, extra)
    want = repeats([(r.doc_id, r.text) for r in docs.collect()])
    rows = suffix.repeats_report(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert all(r.has_repeat == (r.n_removed > 0) for r in rows)


@pytest.mark.parametrize("length, most", [(200, 3000), (200, 2), (37, 2)])
def test_shorter_repeats_against_brute_force(spark, monkeypatch, length, most):
    monkeypatch.setattr(suffix, "CLASS_FRAGMENTS", most)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(2 * length))
    rows = [(i, "".join(rng.choice("ijklmnop ") for _ in range(30)) + passage[i : length + 2 * i - 3] + str(i) * 40) for i in range(12)]
    rows += [(90, None), (91, ""), (92, "x" * length), (93, "x" * (length + 1)), (94, passage[: length - 1]), (95, passage), (96, passage)]
    want = repeats(rows, length)
    got = suffix.cleaned(spark.createDataFrame(rows, SCHEMA), length=length).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got} == want


def test_shards_sort_only_strings_whose_core_is_shared():
    rng = random.Random(5)
    word = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    gram, left = word(128), word(300)
    # The first two share 300 bytes ahead of the anchor; the third shares the anchor only, the last is of another class.
    datas = [left + gram + word(270), left + gram + word(270), word(300) + gram + word(270), left + gram + word(270)]
    counts = [min(len(d) - 399, 300 + 1) for d in datas]
    classes, aheads = [1, 1, 1, 2], [300] * 4
    some = suffix.shared_ranges(classes, aheads, counts, datas, 400)
    assert {i for i, _, _ in some} == {0, 1} and sum(to - at for _, at, to in some) < sum(counts[:2])
    whole = suffix.repeated_strings(datas[:3])
    found = suffix.repeated_strings([datas[i][at : to + 399] for i, at, to in some])
    assert {(i, int(s) + at) for (i, at, _), starts in zip(some, found, strict=True) for s in starts} == {(i, int(s)) for i, starts in enumerate(whole) for s in starts}
    assert [len(s) for s in whole[:2]] == [29, 29]


def test_repeats_of_repeated_rows_and_columns(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(500))
    docs = spark.createDataFrame([(1, long, 3, "k"), (1, long, 3, "k"), (2, "rest " + long, 4, "m"), (None, "clean", 5, "n")], "doc_id long, text string, n_bytes int, key string")
    out = suffix.without_repeats(docs.drop("n_bytes"))
    assert out.columns == ["doc_id", "text", "key"]
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "clean"), (1, ""), (1, ""), (2, "rest ")]
    assert suffix.repeats_report(docs.limit(0)).count() == 0


# -- embeddings --------------------------------------------------------------


def test_embedding_links_against_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rng = np.random.default_rng(8)
    centre = rng.normal(size=64)
    rows = [(10_000_000 + i, (centre + rng.normal(size=64) * 0.12).tolist(), 1) for i in range(120)]
    rows += [(10_001_000 + i, rows[0][1], 2) for i in range(5)]
    odd = [(20_000_000, None, 0), (20_000_001, [], 0), (20_000_002, [0.0] * 64, 0), (20_000_003, [float("nan")] * 64, 0), (20_000_004, [1.0, None] * 32, 0), (20_000_005, [float("inf")] * 64, 0)]
    two = [(20_000_006, [1.0, 2.0], 0), (20_000_007, [2.0, 4.0], 0)]
    union = table.unionByName(spark.createDataFrame(rows + odd + two, table.schema))
    got = {r.vec_id: r for r in hnsw.near_duplicates(union).collect()}
    good = sorted((r.vec_id, r.embedding) for r in union.where("vec_id < 20000000").collect())
    v = np.array([e for _, e in good], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.95
    root = roots(len(good), np.argwhere(np.triu(near, 1)).tolist())
    missed = 0
    for i, (k, _) in enumerate(good):
        assert got[k].n_links <= near[i].sum() - 1
        missed += near[i].sum() - 1 - got[k].n_links
        assert got[k].kept == (got[k].component_id == k)
    assert missed <= 0.02 * near.sum()
    assert np.mean([got[k].component_id == good[root[i]][0] for i, (k, _) in enumerate(good)]) > 0.99
    assert all(got[k].n_links == 0 and got[k].component_id == k for k, _, _ in odd)
    assert got[20_000_007].component_id == 20_000_006 and got[20_000_006].n_links == 1
    assert hnsw.near_duplicates(union.limit(0)).count() == 0


def test_beams_are_audited_where_nothing_is_near():
    """Without any link the audit still tells a narrow beam from a wide one."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph.build(x)
    q = x[:40]
    width = graph.width_for(q)
    best = np.argsort(-(q @ x.T), 1)[:, : hnsw.NEAREST]
    ids, _ = graph.search(q, width)
    assert np.mean([len(set(a) & set(b)) / hnsw.NEAREST for a, b in zip(ids, best, strict=True)]) >= hnsw.RECALL
    cut = hnsw.Graph.build(x)
    cut.links = [np.where(np.arange(t.shape[1]) < 1, t, -1) for t in cut.links]  # one link a node: hardly a graph
    assert cut.width_for(q) > width


def test_texts_are_signed_and_sent_in_batches_by_bytes(spark):
    """Long rows come to Python a few at a time, whatever their number."""
    import corpus_pipeline
    import pyarrow as pa

    long = spark.range(3000, numPartitions=1).select("id", F.expr("repeat('x', 10000)").alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    corpus_pipeline.mask_secrets(spark, long.select(F.col("id").alias("doc_id"), "text").limit(3), "")
    got = long.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 3000
    assert max(r.bytes for r in got) <= 1.5 * common.BATCH_BYTES

    texts = ["a" * n for n in (0, 5, minhash.SIGNED_BYTES, 700_000, 300_000, 60_000, 2 * minhash.SIGNED_BYTES)] + ["b"] * 3000
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = [p.column(0).to_pylist() for p in minhash.text_slices(batch, 0)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) <= minhash.SIGNED_ROWS and (len(p) == 1 or sum(map(len, p)) <= minhash.SIGNED_BYTES) for p in parts)
    assert list(minhash.text_slices(batch.slice(0, 0), 0)) == []


def test_no_beam_is_walked_that_costs_more_than_a_scan():
    """In a shard where narrow beams miss links the block is scanned, not walked
    with ever wider beams; no link is lost by it."""
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(60, 1, 24)) + 0.1 * rng.normal(size=(60, 50, 24))).reshape(-1, 24).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph.build(x)
    graph.links = [np.where(np.arange(t.shape[1]) < 2, t, -1) for t in graph.links]
    walked = []
    search = graph.search
    graph.search = lambda q, width: walked.append(width) or search(q, width)
    rows, nodes, _ = graph.audited(x[:512], 0.95)
    assert max(walked) <= hnsw.widest(len(x)) == 2 * hnsw.BEAM
    assert len(rows) == (x[:512] @ x.T >= 0.95).sum()
    assert hnsw.widest(1 << 20) == hnsw.WIDEST


def test_links_of_shared_and_missing_ids(spark):
    a, b, c = [1.0, 0.0], [1.0, 0.01], [0.0, 1.0]
    rows = [(None, a), (None, c), (5, b), (5, c), (6, None), (None, None)]
    got = sorted(map(tuple, hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    assert sorted(r[1] for r in got) == [0, 0, 1, 1, 1, 1]
    assert len(got) == 6 and all(r[3] == (r[0] == r[2]) for r in got)


# -- toxicity ----------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels, toxicity.fit(docs, labels)


def test_toxicity_held_out(spark, toxic):
    docs, labels, _ = toxic
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert len(pos) > 3 and auc > 0.75
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_restores_noisy_words(toxic):
    score = toxic[2].scorer()
    plain = score("the word idiot and the")[0]
    for word in ("i d i o t", "i.d.i.o.t", "idiiiiot", "IDIOT!!", "i_d_i_o_t"):
        assert score(f"the word {word} and the")[0] == pytest.approx(plain), word
    for noisy, word in (("tr@sh", "trash"), ("m0r0n", "moron"), ("cl0wn", "clown"), ("l-o-s-e-r", "loser"), ("stuuupid", "stupid")):
        assert word in score(f"the {noisy} and")[1].split(), noisy
    assert score("the mail of a.b@c.de and 12 of 345")[1] == "the mail of a.b@c.de and 12 of 345"


def test_toxicity_restores_runs_of_any_length(toxic):
    model = toxic[2]
    score = model.scorer()
    weights = {f: w for f, w in model.weights.items() if f[0] == f[-1] == " " and len(f) > 4}
    assert weights
    word = max(weights, key=weights.get).strip()
    plain = score(f"the {word} and")
    assert score(f"the {word[0]}{word[1] * 90}{word[2:]} and")[0] == pytest.approx(plain[0])  # stretched
    assert score("the idi0t/m0r0n and")[1] == "the idiot/moron and"
    sentence = " ".join(["the idiot and the moron of the trash"] * 4).replace(" ", "")
    for by in (" ", ".", "_"):
        restored = score("so " + by.join(sentence))[1]
        assert restored.replace(" ", "") == "so" + sentence and "idiot" in restored, by
        assert max(map(len, restored.split())) <= 30, by
    assert score(" ".join(sentence * 300))[1].replace(" ", "") == sentence * 300
    for kept in ("john.d0e@mail.example.org", "https://example.org/a1b/c2d", "/usr/l1b/x86", "src/ma1n/f1le.py", "0123456789abcdef" * 6, "9f86d081-884c-7d65-9a2f-eaa0c55ad015"):
        assert score(f"the {kept} and")[1] == f"the {kept} and", kept


def test_decoding_is_the_cheapest_lattice_path(toxic):
    """Against all readings of short words, each scored by itself."""
    restorer = toxicity.Restorer(toxic[2].counts)
    cost, n = restorer.cost, toxicity.SYMBOLS
    rng = random.Random(2)
    for _ in range(150):
        word = "".join(rng.choice("aillost0143$!.- ") for _ in range(rng.randint(1, 7)))
        readings = [((0, 0), "", 0.0)]
        for c in word:
            new = []
            for (a, b), done, total in readings:
                for letter, extra in restorer.options(c, done[-1:]):
                    if letter:
                        s = restorer.symbol(letter)
                        new.append(((b, s), done + letter, total + extra + cost[(a * n + b) * n + s]))
                    else:
                        new.append(((a, b), done, total + extra))
            readings = new
        ends = [(total + (cost[(a * n + b) * n] if done[-1:] != " " else 0.0), done) for (a, b), done, total in readings]
        best = min(ends)[0]
        got = restorer.decode(word)
        assert min(t for t, d in ends if d == got) == pytest.approx(best, abs=1e-9), word


def test_logistic_against_plain_newton():
    rng = np.random.default_rng(4)
    x = (rng.random((300, 6)) < 0.3).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [2, -1, 0, 1, 0.5, -2] - 0.3)))).astype(float)
    w, b = toxicity._logistic([np.flatnonzero(r) for r in x], y, 6)
    full, v = np.c_[x, np.ones(300)], np.zeros(7)
    ridge = np.diag([0.5] * 6 + [0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-full @ v))
        v -= np.linalg.solve(full.T @ (full * (p * (1 - p))[:, None]) + ridge, full.T @ (p - y) + ridge @ v)
    assert np.abs(np.append(w, b) - v).max() < 0.02


def test_toxicity_defined_cases(spark, toxic):
    docs, labels, model = toxic
    odd = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (2, "", 9.0), (None, "z" * 100_000, 9.0)], "doc_id long, text string, score double")
    rows = toxicity.score(odd, model, restored=True).collect()
    assert len(rows) == 4 and len({r.score for r in rows}) == 1 and rows[0].restored == ""
    none = toxicity.toxicity_scores(docs, labels.where("toxic = 0")).agg(F.max("score")).first()[0]
    assert none < 1e-9
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0


# -- pipeline ----------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.stored(stage(spark, before, SMALL), f"test_{name}")
        assert after.columns == docs.columns
        assert after.join(before, "doc_id", "left_anti").count() == 0
        if name == "near_duplicates":
            want = classes([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in after.collect()} == set(want.values())
        if name == "suffix_repeats":
            gone = repeats([(r.doc_id, r.text) for r in before.collect()], corpus_pipeline.REPEAT_BYTES)
            assert {r.doc_id: r.n_chars for r in after.collect()}.keys() == gone.keys()
            assert all(r.n_chars == len(r.text) for r in after.collect())
            assert all(r.text == t for r, t in ((r, {x.doc_id: x.text for x in before.collect()}[r.doc_id]) for r in after.collect()) if gone[r.doc_id][1] == 0)
        if name in ("suffix_repeats", "secrets"):
            assert after.count() == before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in before.collect()}
