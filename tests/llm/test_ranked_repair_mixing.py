"""Ranked search, conversation repair and source mixing against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from heliospark.llm import mixing, queries, ranked, repair

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_match_their_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SMALL)
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    found = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(got.columns) == sorted(columns)
    order = [columns.index(c) for c in got.columns]
    assert rows == sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=str)


# -- ranked search -----------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def ranking(docs, items, k=10):
    """[(item, rank, doc, score)] by the formula over all pairs."""
    words = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, total = sum(1 for w in words if w), sum(map(len, words))
    df = collections.Counter(t for w in words for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for (d, _), own in zip(docs, words, strict=True):
            tf = collections.Counter(own)
            m = 10 + (90 * len(own) * n_docs) // total if own else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(TERM.findall((text or "").translate(LOWER))) if tf[t])
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def ranked_rows(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked.ranked(d, i, **options).collect()), key=str)


def test_ranking_of_odd_documents_and_items(spark):
    docs = [(5, "Alpha beta alpha"), (3, "alpha beta Alpha"), (None, "ALPHA_beta.alpha"), (7, None), (8, ""), (9, "..."), (5, "Alpha beta alpha"), (11, "Ünï ünï a1"), (12, "alpha " * 5000 + "rare"), (-4, "gamma")]
    docs += [(100 + i, "alpha beta alpha") for i in range(15)]  # more ties than ranks
    items = [(1, "alpha BETA beta"), (2, "Ünï a1 unknown"), (3, None), (4, ""), (5, "rare, gamma"), (None, "gamma"), (6, "gamma"), (6, "rare")]
    want = ranking(docs, items)
    assert ranked_rows(spark, docs, items) == want
    # The same with many shards, many blocks of items, and both.
    assert ranked_rows(spark, docs, items, shard_counts=3) == want
    assert ranked_rows(spark, docs, items, shard_counts=5, item_bytes=80) == want
    assert ranked_rows(spark, [], items) == [] and ranked_rows(spark, docs, []) == [] and ranked_rows(spark, [(1, None)], items) == []


def test_ranking_ignores_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, item_id long, rank string")
    items = spark.createDataFrame([(7, "a", 1)], "item_id long, text string, score int")
    docs2 = [(1, "a b")]
    assert [tuple(r) for r in ranked.ranked(docs, items).collect()] == ranking(docs2, [(7, "a")])


def test_treap_finds_the_best_columns():
    rnd = np.random.default_rng(2)
    for rows, columns, cells in ((1, 1, 1), (5, 300, 200), (40, 37, 400), (3, 5000, 9000), (600, 2, 500), (4, 9, 0)):
        at = np.unique(rnd.integers(0, rows * columns, cells))
        value = rnd.integers(1, 9, len(at))  # many ties
        tree = ranked.Treap(at // columns, at % columns, value)
        for _ in range(5):
            own = np.unique(rnd.integers(0, rows + 3, 4))
            total = np.zeros(columns, np.int64)
            some = np.isin(at // columns, own)
            np.add.at(total, at[some] % columns, value[some])
            order = [c for c in np.lexsort((np.arange(columns), -total)) if total[c] > 0][:10]
            got, scores = tree.best(own, 10)
            assert got.tolist() == order and scores.tolist() == total[order].tolist()


# -- conversation repair -----------------------------------------------------

FOLLOWS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
AFTER = (2, 2, 3, 2)  # the state after a user or assistant that may come


def cheapest(rows):
    """(cost, initials) for (initial, must go, truncated) rows: all paths, best per state."""
    best = {0: (0, "")}
    for initial, gone, cut in rows:
        for _ in range(3):
            for q, (c, s) in list(best.items()):
                best[AFTER[q]] = min(best.get(AFTER[q], (9**9, "")), (c + 3, s + "I"))
        new = {}
        for q, (c, s) in best.items():
            steps = [(q, c + 4, s + "D")]
            if not gone:
                steps.append((AFTER[q], c + 3 + 3 * cut, s + "R"))
                steps.append((FOLLOWS.get(initial, (None,) * 4)[q], c + 3 * cut, s + "K"))
            for to, *x in steps:
                if to is not None:
                    new[to] = min(new.get(to, (9**9, "")), tuple(x))
        best = new
    return min((c + 3 * len(rest), s + rest) for q, (c, s) in best.items() for rest in [("", "II", "I", "")[q]])


def repaired(conv, rows):
    """The report's row of one conversation's (turn, role, text) rows, and its repaired turns."""
    out = []
    for turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(d, text)
        out += [(turn, "user" if d == 4 else role, text)] * {0: 0, 3: 2}.get(d, 1)
    out.sort(key=lambda o: (o[0] is not None, o[0] or 0, o[1], o[2][:64], hashlib.md5(o[2].encode()).digest()))
    seen, facts, faults = set(), [], [0, 0, 0]
    for _, role, text in out:
        body = text.rstrip(" \t\n\x0b\f\r")
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        if fault is not None:
            faults[fault] += 1
        seen.add((role, text))
        facts.append((role[:1], fault in (0, 1), fault == 2))
    cost, audit = cheapest(facts)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:], strict=False))
    turns = {t for t, _, _ in out if t is not None}
    state, lines, at = 0, [], iter(out)
    for edit in audit:
        role, text = next(at)[1:] if edit != "I" else ("", "")
        if edit == "D":
            continue
        state = FOLLOWS[role[:1]][state] if edit == "K" else AFTER[state]
        lines.append((role if edit == "K" else ("user", "assistant")[state == 3], text))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *faults, illegal, cost, audit, digest), lines


def by_conversation(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    return out


def odd_conversations(spark):
    rnd = random.Random(3)
    rows = []
    for conv in (None, 1, 2, 3, 4, 5):
        for turn in range(150 if conv in (None, 2) else 5):
            for _ in range(rnd.choice([1, 1, 2])):
                text = rnd.choice(["a.", "b", "", None, " \t", "x" * 70 + rnd.choice(".,"), "ü!", "hi. ", "y" * 50_000 + "?"])
                rows.append((conv, rnd.choice([turn, turn, None, turn // 2]), rnd.choice(["user", "assistant", "system", "tool", "", None, "u", "s"]), text))
    rows += [(9, i, "user", "hello.") for i in range(100)] + [(10, 1, "user", "same.")] * 40
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_cheapest_edits_against_dynamic_programming():
    rnd = random.Random(1)
    for _ in range(600):
        codes = bytes(rnd.choice([rnd.randrange(16), rnd.choice([1, 2, 9, 10])]) for _ in range(rnd.randint(0, 14)))
        cost, audit = cheapest([(("s", "u", "a", "x")[c & 3], bool(c & 4), bool(c & 8) and not c & 4) for c in codes])
        for chunk in (64, 1, 3):
            repair._SOLVED.clear()
            got = repair.solve(codes, chunk=chunk)
            state = 0
            for code, edits in zip(codes, got, strict=True):
                for label in edits:
                    state = next(to for name, _, _, to in repair._ARCS[code][state] if name == label)
            assert "".join(got) + repair._REST[state] == audit
        price = repair.opening_prices(codes, repair._ENDS)
        repair.auction(codes, 0, price)
        assert price[0] == cost


@pytest.mark.parametrize("range_rows, chunk", [(200_000, 64), (20, 3)])
def test_repaired_conversations(spark, monkeypatch, range_rows, chunk):
    monkeypatch.setattr(repair, "RERANGE_ROWS", range_rows)  # conversations over several partitions
    for df in (odd_conversations(spark), spark.read.parquet(f"{SMALL}/conversations.parquet")):
        want = {c: repaired(c, rows)[0] for c, rows in by_conversation(df).items()}
        got = [tuple(r) for r in repair.repair_report(repair.damaged(df), chunk).collect()]
        assert len(got) == len(want) and {r[0]: r for r in got} == want


def test_repaired_turns_are_the_conversations(spark):
    df = odd_conversations(spark)
    want = {c: repaired(c, rows)[1] for c, rows in by_conversation(df).items()}
    got = collections.defaultdict(list)
    for r in sorted(repair.repaired_turns(repair.damaged(df)).collect(), key=lambda r: (r["pid"], r["pos"], r["step"])):
        if r["role"] is not None:
            got[r["conv_id"]].append((r["role"], r["text"]))
    assert got == {c: x for c, x in want.items() if x}


def test_conversations_of_dropped_rows_and_none(spark):
    turns = [t for t in range(400) if zlib.crc32(f"77:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame([(77, t, "user", "x.", 1) for t in turns], "conv_id long, turn long, role string, text string, cost int")
    assert [tuple(r) for r in repair.conversations_report(df).collect()] == [(77, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.conversations_report(df.limit(0)).collect() == []


# -- mixing ------------------------------------------------------------------


def level_targets(sizes, weights, share, cap):
    """Targets by sharing the excess again until none is above its cap."""
    total = share[0] * sum(sizes) / share[1]
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        heavy = sum(weights[i] for i in free)
        for i in free:
            out[i] = left * weights[i] / heavy
        over = {i for i in free if out[i] >= cap * sizes[i]}
        for i in over:
            out[i] = float(cap * sizes[i])
        if not over:
            break
        free -= over
    return out


def test_targets_copies_and_odd_rows(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(3000):
        source = rnd.choice(["hot"] * 6 + ["b", "ä", "Z", "", None, "c", "d"])
        rows.append((i if i % 50 else None, source, rnd.choice([None, "", " \n", "one", "two words", "w " * rnd.randint(1, 40)]), "x", 7))
    rows += [(5000, "empty", None, "x", 1), (5001, "empty", " ", "x", 1), (5002, "one", "z " * 30_000, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size string, copies int")
    got = mixing.mixed(df).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, source, text, _, _ in rows:
        sizes[source] += len((text or "").split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(names, level_targets([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], (3, 2), 2), strict=True))
    taken = collections.Counter()
    for r in got:
        assert r["size"] == len((r["text"] or "").split()) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in ("hot", "b"):
        assert abs(taken[s] - want[s]) < 0.25 * want[s]
    # Reruns, other partitions and the join without broadcast agree; the mix holds each document that often.
    key = lambda rs: sorted(((r["doc_id"], r["source"], r["text"], r["target"], r["copies"]) for r in rs), key=str)
    assert key(mixing.mixed(df.repartition(7)).collect()) == key(got) == key(mixing.mixed(df, broadcast_bytes=0).collect())
    out = mixing.emitted(mixing.mixed(df))
    assert out.count() == sum(r["copies"] for r in got) and "copies" not in out.columns


def test_mixes_of_one_source_and_none(spark):
    df = spark.createDataFrame([(1, "a", "x y"), (2, "a", "z")], "doc_id long, source string, text string")
    assert {r["target"] for r in mixing.mixed(df).collect()} == {4.5}
    assert {r["copies"] for r in mixing.mixed(df, share=(5, 1)).collect()} == {2}  # more than the caps allow
    assert mixing.mix_report(df.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")
    assert [tuple(r) for r in mixing.mix_report(blank).collect()] == [(1, 0, 0, 0.0, 0)]
