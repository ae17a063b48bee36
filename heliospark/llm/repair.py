"""Repair of the turn structure of conversations by cheapest edits.

A conversation is brought to role initials of the form ``(s?(ua)+)?``. Every
row is kept (0), given the role user or assistant (3) or deleted (4; the only
way for blank rows and duplicates), empty rows of either role are inserted
anywhere (3), and a truncated row that stays costs 3 more. Of all cheapest
edits those are taken whose initials are least in ASCII order.

The edits are a path through a lattice of (rows done, state), the states being
nothing yet, after the system row, after a user row, after an assistant row.
The cheapest paths are found by the auction algorithm: every node has a price;
a path grows from the entry along the arc of least cost and price, and shrinks
by one node, whose price rises, where that arc costs more than the node's own
price. Prices stay dual feasible throughout, so when the path arrives all the
cheapest paths consist of tight arcs, and the least one is traced along them
by label (a node's arcs have different labels; dead ends are taken back).

No conversation has to fit a task. Rows are sorted over all conversations by
range partitions, without their texts, and equal rows are one row with a
number. A run of a conversation in a partition is cut into chunks; a chunk, or
a run, that is only part of a conversation is told by the costs between its
four entry and four exit states and by the order of the edits behind them, and
chains of such parts are settled by their 4 x 4 costs. At most two runs of a
partition can be parts, so that table has two rows a partition.

Defined cases: NULL conv_id or turn is one space in the damage's hash, NULL
role or text is one space; all rows with a NULL conv_id are one conversation;
NULL turns come first; rows of one turn go by role, then by the first 64
characters of the text, then by the text's MD5; repeated rows are duplicates
of the first; a conversation without rows needs no edits; other columns are
not needed; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import batched, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.global_order import with_global_index
from .common import stored

SPACES = " \t\n\x0b\f\r"
PREFIX = 64  # characters of a text in the order of rows
RERANGE_ROWS = 200_000  # rows of a range partition at most, as planned
CHUNK = 64  # rows of a lattice
KNOWN = 200_000  # solved short conversations remembered by a worker; emptied when full

INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
START, SYSTEM, USER, ASSISTANT = range(4)  # states
_INSERTED = (USER, USER, ASSISTANT, USER)  # the state after an insertion, by state
# The state after keeping a row of an initial, by state; None where it may not follow.
_KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
# What is still to be inserted at the end, by state.
_REST = ("", "II", "I", "")
_ENDS = tuple(INSERT * len(x) for x in _REST)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_NONE = float("inf")
COSTS = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}
LEGAL = ("su", "ua", "au")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

# A row's code: its initial (0 to 3), 4 if it must go, 8 if it is truncated.
_INITIALS = "sua"


def _row_arcs(code: int) -> list[list[tuple[str, int, int, int]]]:
    """By state the arcs (label, cost, rows passed, state) before and over a row, by label."""
    arcs = []
    for q in range(4):
        own = [("D", DELETE, 1, q), ("I", INSERT, 0, _INSERTED[q])]
        if not code & 4:
            more = TRUNCATED if code & 8 else 0
            kept = _KEPT[_INITIALS[code & 3]][q] if code & 3 < 3 else None
            if kept is not None:
                own.append(("K", more, 1, kept))
            own.append(("R", REROLE + more, 1, _INSERTED[q]))
        arcs.append(own)
    return arcs


_ARCS = [_row_arcs(code) for code in range(16)]
_LEAST = [DELETE if code & 4 else TRUNCATED if code & 8 else 0 for code in range(16)]


def opening_prices(codes: bytes, ends: tuple) -> list[float]:
    """Feasible prices of the nodes 4 * rows done + state: what the rows ahead
    cost at least; no price (infinite) for nodes that reach no end."""
    n = len(codes)
    price = [_NONE] * (4 * n) + list(ends)
    ahead = min(ends)
    for i in range(n - 1, -1, -1):
        ahead += _LEAST[codes[i]]
        arcs = _ARCS[codes[i]]
        alive = {q for q in range(4) if any(step and price[4 * i + 4 + to] < _NONE for _, _, step, to in arcs[q])}
        alive |= {q for q in range(4) if _INSERTED[q] in alive or _INSERTED[_INSERTED[q]] in alive}
        for q in alive:
            price[4 * i + q] = ahead
    return price


def auction(codes: bytes, entry: int, price: list[float]) -> None:
    """Raise ``price`` until a path from the entry state passes all rows."""
    last = 4 * len(codes)
    path = [entry]
    while (node := path[-1]) < last:
        i, q = divmod(node, 4)
        best, to = _NONE, node
        for _, cost, step, state in _ARCS[codes[i]][q]:
            ahead = 4 * (i + step) + state
            if cost + price[ahead] < best:
                best, to = cost + price[ahead], ahead
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def trace(codes: bytes, entry: int, price: list[float]) -> tuple[list[str], int]:
    """The least labels along tight arcs, by row, and the exit state."""
    last = 4 * len(codes)
    path, labels, dead = [entry], [], set()
    while (node := path[-1]) < last:
        i, q = divmod(node, 4)
        for label, cost, step, state in _ARCS[codes[i]][q]:
            ahead = 4 * (i + step) + state
            if price[node] == cost + price[ahead] and ahead not in dead:
                path.append(ahead)
                labels.append(label)
                break
        else:
            dead.add(path.pop())
            labels.pop()
    rows = [[] for _ in codes]
    for node, label in zip(path, labels, strict=False):
        rows[node // 4].append(label)
    return ["".join(r) for r in rows], path[-1] - last


Part = tuple[list[list[float]], list[list[int]]]  # costs and order by entry and exit state


def part(codes: bytes) -> Part:
    """Costs between entry and exit states of some rows and, for an entry, the
    place of each exit's least edits in ASCII order. (Edits to different exits
    pass equally many rows and end with one, so none begins another.)"""
    costs, edits = [[_NONE] * 4 for _ in range(4)], [[""] * 4 for _ in range(4)]
    for out in range(4):
        price = opening_prices(codes, tuple(0 if q == out else _NONE for q in range(4)))
        for q in range(4):
            if price[q] < _NONE:
                auction(codes, q, price)
                costs[q][out] = price[q]
                edits[q][out] = "".join(trace(codes, q, price)[0])
    return costs, [[sorted(e).index(x) for x in e] for e in edits]


def chain(parts: list[Part], entry: int, ends: tuple) -> tuple[float, list[int], list[int]]:
    """Through consecutive parts: the least cost, the state after each part and
    the places of the chosen edits."""
    ahead = [tuple(ends)]
    for costs, _ in reversed(parts):
        ahead.append(tuple(min(c + p for c, p in zip(costs[q], ahead[-1], strict=True)) for q in range(4)))
    ahead.reverse()
    q, states, places = entry, [], []
    for k, (costs, order) in enumerate(parts):
        good = [e for e in range(4) if costs[q][e] < _NONE and costs[q][e] + ahead[k + 1][e] == ahead[k][q]]
        e = min(good, key=order[q].__getitem__)
        states.append(e)
        places.append(order[q][e])
        q = e
    return ahead[0][entry], states, places


def joined(parts: list[Part]) -> Part:
    """Consecutive parts as one."""
    if len(parts) == 1:
        return parts[0]
    costs, places = [[_NONE] * 4 for _ in range(4)], [[[]] * 4 for _ in range(4)]
    for out in range(4):
        ends = tuple(0 if q == out else _NONE for q in range(4))
        for q in range(4):
            # Some exits cannot be reached from some entries.
            reach = {q}
            for c, _ in parts:
                reach = {e for x in reach for e in range(4) if c[x][e] < _NONE}
            if out in reach:
                costs[q][out], _, places[q][out] = chain(parts, q, ends)
    return costs, [[sorted(p).index(x) for x in p] for p in places]


def _chunks(codes: bytes, chunk: int) -> list[bytes]:
    return [codes[i : i + chunk] for i in range(0, len(codes), chunk)]


_SOLVED: dict[tuple, list[str]] = {}


def solve(codes: bytes, entry: int = START, out: int | None = None, chunk: int = CHUNK) -> list[str]:
    """The edits at each row from the entry state to the exit state, or to the
    end of a conversation (without the rows to be inserted there)."""
    ends = _ENDS if out is None else tuple(0 if q == out else _NONE for q in range(4))
    if len(codes) <= chunk:
        known = (codes, entry, out)
        if known not in _SOLVED:
            if len(_SOLVED) > KNOWN:
                _SOLVED.clear()
            price = opening_prices(codes, ends)
            auction(codes, entry, price)
            _SOLVED[known] = trace(codes, entry, price)[0]
        return _SOLVED[known]
    pieces = _chunks(codes, chunk)
    _, states, _ = chain([part(p) for p in pieces], entry, ends)
    return [e for p, q, o in zip(pieces, [entry, *states], states, strict=False) for e in solve(p, q, o, chunk)]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with the faults that the hash
    of ``conv_id:turn`` deals them; 0 copies for a dropped row."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_d"))
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_d") == 0, 0).when(F.col("_d") == 3, 2).otherwise(1).cast("long")
    return rows.select("conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies"))


ORDER = ["conv_id", "turn", "role", "prefix", "digest"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"prefix": F.left("text", F.lit(PREFIX)), "digest": F.unhex(F.md5("text"))})


def numbered(rows: DataFrame) -> DataFrame:
    """The different rows of every conversation in order, without texts: ORDER,
    their ``copies``, ``blank``, ``duplicate`` and ``truncated`` of the first
    copy, and their place ``_pid``, ``_pos`` over all conversations."""
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    told = _keyed(rows.where("copies > 0")).withColumns({"blank": end == "", "truncated": ~end.isin("", ".", "!", "?")})
    same = stored(told.groupBy(*ORDER).agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated")), "repair_rows")
    # The first turn of each role and text. The join is by the whole key, so many turns of one text are spread.
    firsts = same.groupBy("conv_id", "role", "digest").agg(F.min("turn").alias("_t"), F.max(F.col("turn").isNull()).alias("_n"))
    firsts = firsts.select(F.col("conv_id").alias("_c"), F.when(~F.col("_n"), F.col("_t")).alias("_t"), F.col("role").alias("_r"), F.col("digest").alias("_h"), F.lit(True).alias("_first"))
    match = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_h"))
    marked = same.join(firsts, match, "left").select(*ORDER, "copies", "blank", F.col("_first").isNull().alias("duplicate"), "truncated")
    partitions = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-same.count() // RERANGE_ROWS))
    return with_global_index(marked, ORDER, num_partitions=partitions).select(*ORDER, "copies", "blank", "duplicate", "truncated", "_pid", "_pos")


def _code(role: Column) -> Column:
    first = F.left(role, F.lit(1))
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    gone = F.col("blank") | F.col("duplicate")
    return (initial + F.when(gone, 4).otherwise(0) + F.when(F.col("truncated") & ~gone, 8).otherwise(0)).cast("tinyint")


def _runs(batches: Iterable[pa.RecordBatch]) -> tuple[pa.Table | None, bytes, list[int]]:
    """A partition's rows, their codes, and where its conversations begin and end."""
    parts = list(batches)
    if not parts or not sum(b.num_rows for b in parts):
        return None, b"", []
    rows = pa.Table.from_batches(parts)
    conv = rows["conv_id"].to_pylist()
    cuts = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
    return rows, rows["code"].to_numpy().astype(np.uint8).tobytes(), cuts


def edits(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The numbered rows with ``state``, in which the edits come to the row,
    ``edits``: the insertions before it and what happens to its first copy (the
    other copies are always deleted), and ``rest``, the insertions after it."""
    rows = rows.withColumn("code", _code(F.col("role")))
    conv = rows.schema["conv_id"].dataType.simpleString()

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, codes, cuts = _runs(batches)
        if table is None:
            return
        at = [0] if len(cuts) == 2 else [0, len(cuts) - 2]
        told = [joined([part(p) for p in _chunks(codes[cuts[k] : cuts[k + 1]], chunk)]) for k in at]
        flat = [[[-1 if x == _NONE else int(x) for row in m for x in row] for m in t] for t in told]
        yield pa.RecordBatch.from_arrays([table["conv_id"].combine_chunks().take(pa.array([cuts[k] for k in at])), table["_pid"].combine_chunks().take(pa.array([0] * len(at))), *(pa.array([f[j] for f in flat], pa.list_(pa.int32())) for j in (0, 1))], names=["conv_id", "_pid", "costs", "places"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["conv_id"] is not None, r["conv_id"], r["_pid"]))
        pid, first, entry, out = [], [], [], []
        for _, same in groupby(told, key=lambda r: r["conv_id"]):
            own = list(same)
            if len(own) > 1:
                parts = [tuple([[_NONE if x < 0 else x for x in r[c][i : i + 4]] for i in range(0, 16, 4)] for c in ("costs", "places")) for r in own]
                _, states, _ = chain(parts, START, _ENDS)
                pid += [r["_pid"] for r in own]
                first += [k > 0 for k in range(len(own))]
                entry += [START, *states[:-1]]
                out += [*states[:-1], -1]
        yield pa.RecordBatch.from_arrays([pa.array(pid, pa.int32()), pa.array(first, pa.bool_()), pa.array(entry, pa.int32()), pa.array(out, pa.int32())], names=["_pid", "_goes_on", "_entry", "_out"])

    # Two rows a partition at most; those of one conversation meet by its id.
    told = stored(rows.select("conv_id", "_pid", "code").mapInArrow(tell, f"conv_id {conv}, _pid int, costs array<int>, places array<int>"), "repair_parts")
    settled = told.repartition("conv_id").mapInArrow(settle, "_pid int, _goes_on boolean, _entry int, _out int")
    # By partition: how its first conversation goes on from the one before, and its last into the next.
    ahead = settled.groupBy("_pid").agg(
        F.max(F.when(F.col("_goes_on"), F.struct("_entry", "_out"))).alias("_head"),
        F.max(F.when(~F.col("_goes_on"), F.col("_out"))).alias("_tail"),
    )
    schema = rows.drop("code").schema.add("state", "integer").add("edits", "string").add("rest", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, codes, cuts = _runs(batches)
        if table is None:
            return
        head, tail = table["_head"][0].as_py(), table["_tail"][0].as_py()
        state, made, rest = [], [], []
        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            q, out = (head["_entry"], head["_out"]) if k == 0 and head else (START, tail if k == len(cuts) - 2 and tail is not None else -1)
            for code, e in zip(codes[lo:hi], own := solve(codes[lo:hi], q, None if out < 0 else out, chunk), strict=True):
                state.append(q)
                for label in e:
                    q = next(to for name, _, _, to in _ARCS[code][q] if name == label)
            made += own
            rest += [""] * (hi - lo - 1) + [_REST[q] if out < 0 else ""]
        done = table.drop_columns(["code", "_head", "_tail"]).append_column("state", pa.array(state, pa.int32())).append_column("edits", pa.array(made, pa.string())).append_column("rest", pa.array(rest, pa.string()))
        yield from done.to_batches(max_chunksize=10_000)

    return rows.join(F.broadcast(ahead), "_pid", "left").select(*rows.columns, "_head", "_tail").mapInArrow(run, schema)


def _meeting(rows: DataFrame, edited: DataFrame, by: list[str]) -> DataFrame:
    """Edited rows, each followed by its text, sorted in the partitions of ``by``.
    A dropped row comes without text."""
    told = edited.select(*ORDER, F.lit(0).alias("kind"), "copies", "blank", "duplicate", "truncated", "state", "edits", "rest", F.col("_pid").alias("pid"), F.col("_pos").alias("pos"))
    texts = _keyed(rows).select(*ORDER, F.when(F.col("copies") > 0, 1).otherwise(2).alias("kind"), F.when(F.col("copies") > 0, F.col("text")).alias("text"))
    return told.unionByName(texts, allowMissingColumns=True).repartition(*by).sortWithinPartitions(*ORDER, "kind")


def _with_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, str | None]]:
    """(row, text) of the edited rows of a sorted partition; (row, None) of a dropped row."""
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                last = row
            elif row["kind"] == 2:
                yield row, None
            elif last is not None:  # equal rows come once
                yield last, row["text"]
                last = None


def _turns(row: dict, text: str) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of the edits at a row; no role for a deletion."""
    q = row["state"]
    for label in row["edits"] + "D" * (row["copies"] - 1) + row["rest"]:
        if label == "D":
            yield label, None, None
        elif label == "K":
            yield label, row["role"], text
            q = _KEPT[row["role"][0]][q]
        else:
            q = _INSERTED[q]
            yield label, _ROLES[q], "" if label == "I" else text


def repaired_turns(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, pid, pos, step, edit, role, text) of (conv_id, turn, role, text,
    copies) rows: one row an edit, in the order of (pid, pos, step); deletions
    without role and text. The rows with a role are the repaired conversations."""
    rows = rows.where("copies > 0")
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, pid int, pos long, step int, edit string, role string, text string"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [kind, pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        for some in batched(((r["conv_id"], r["pid"], r["pos"], k, *t) for r, text in _with_texts(batches) for k, t in enumerate(_turns(r, text))), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=names)

    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    return _meeting(rows, edits(numbered(rows), chunk), ORDER).mapInArrow(run, schema)


def repair_report(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text, copies) rows: gaps, faults,
    illegal neighbours, cost and initials of the edits, and the digest of the
    repaired turns. A digest is of all turns in order, so here a conversation
    passes one task, row by row; only its initials and digest are held."""
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    names = [c.split()[0] for c in schema.split(", ")]

    def one(conv: object, own: Iterator[tuple[dict, str | None]]) -> tuple:
        turns, blank, duplicate, truncated, illegal, cost = [0, 0, 0], 0, 0, 0, 0, 0
        audit, digest, before, last_turn, begun = [], hashlib.sha256(), None, None, False
        for row, text in own:
            if text is None:
                continue
            if (turn := row["turn"]) is not None and turn != last_turn:
                turns = [turns[0] if turns[2] else turn, turn, turns[2] + 1]
                last_turn = turn
            n = row["copies"]
            blank += n if row["blank"] else 0
            duplicate += 0 if row["blank"] else n - (not row["duplicate"])
            cut = row["truncated"] and not row["blank"] and not row["duplicate"]
            truncated += cut
            initial = row["role"][:1]
            illegal += (before is not None and before + initial not in LEGAL) + n - 1
            before = initial
            for label, role, turn_text in _turns(row, text):
                audit.append(label)
                cost += COSTS[label] + (TRUNCATED if cut and label in "KR" else 0)
                if role is not None:
                    digest.update(f"{chr(10) if begun else ''}{role}:{turn_text}".encode())
                    begun = True
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        return conv, gaps, blank, duplicate, truncated, illegal, cost, "".join(audit), digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [kind] + [pa.int64()] * len(COUNTS) + [pa.string()] * 2
        for some in batched((one(conv, own) for conv, own in groupby(_with_texts(batches), key=lambda r: r[0]["conv_id"])), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=names)

    return _meeting(rows, edits(numbered(rows), chunk), ["conv_id"]).mapInArrow(run, schema)


def conversations_report(conversations: DataFrame) -> DataFrame:
    return repair_report(damaged(conversations))


def _sql() -> str:
    """The report in SQL. A path is its cost in nine digits and its initials, so
    the least string is the cheapest and, among those, the least in ASCII."""

    def plus(x: str, cost: str, label: str) -> str:
        return f"(printf('%09d', substr({x}, 1, 9)::BIGINT + {cost}) || substr({x}, 10) || '{label}')"

    def least(*xs: str) -> str:
        return f"least({', '.join(xs)})"

    keep = "CASE WHEN cut THEN 3 ELSE 0 END"
    rerole = "CASE WHEN cut THEN 6 ELSE 3 END"
    may = "CASE WHEN NOT gone"
    users = [f"{may} AND initial = 'u' THEN {plus(least('i0', 'i1', 'i3'), keep, 'K')} END", f"{may} THEN {plus(least('i0', 'i1', 'i3'), rerole, 'R')} END"]
    assistants = [f"{may} AND initial = 'a' THEN {plus('i2', keep, 'K')} END", f"{may} THEN {plus('i2', rerole, 'R')} END"]
    return rf"""
WITH RECURSIVE dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS damage
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN damage = 1 THEN '' WHEN damage = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN damage = 0 THEN [] WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM dealt),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS initial
  FROM damaged),
told AS (
  SELECT *, body = '' AS blank, body <> '' AND seen AS duplicate, body = '' OR seen AS gone,
         body <> '' AND NOT seen AND right(body, 1) NOT IN ('.', '!', '?') AS cut,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS neighbours
  FROM ordered),
paths AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS x0, NULL::VARCHAR AS x1, NULL::VARCHAR AS x2, NULL::VARCHAR AS x3 FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {plus('i0', '4', 'D')},
         {least(plus('i1', '4', 'D'), f"{may} AND initial = 's' THEN {plus('i0', keep, 'K')} END")},
         {least(plus('i2', '4', 'D'), *users)},
         {least(plus('i3', '4', 'D'), *assistants)}
  FROM (
    SELECT p.conv_id, t.i, initial, gone, cut, x0 AS i0, x1 AS i1,
           {least('x2', plus('x0', '3', 'I'), plus('x1', '3', 'I'), plus('x3', '3', 'I'))} AS i2,
           {least('x3', plus('x2', '3', 'I'), plus('x0', '6', 'II'), plus('x1', '6', 'II'))} AS i3
    FROM paths p JOIN told t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1)),
best AS (
  SELECT conv_id, i AS n, {least('x0', plus('x1', '6', 'II'), plus('x2', '3', 'I'), 'x3')} AS path
  FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
edits AS (
  SELECT conv_id, unnest(string_split(substr(path, 10), '')) AS edit, generate_subscripts(string_split(substr(path, 10), ''), 1) AS place FROM best WHERE length(path) > 9),
placed AS (
  SELECT conv_id, edit, place, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS i,
         count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY place) AS emitted
  FROM edits),
turns AS (
  SELECT p.conv_id, p.place, p.edit, p.emitted, t.role, t.text, t.initial,
         max(CASE WHEN p.edit = 'K' AND p.emitted = 1 AND t.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS led
  FROM placed p LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i AND p.edit <> 'I'),
repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (emitted - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS digest
  FROM turns WHERE edit <> 'D' GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (neighbours IS NOT NULL AND neighbours NOT IN ('su', 'ua', 'au')) AS illegal
  FROM told GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, substr(path, 1, 9)::BIGINT AS cost,
       substr(path, 10) AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM best b
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM b.conv_id
"""


REPAIR_SQL = _sql()
