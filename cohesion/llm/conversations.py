"""Conversation structure repair: cheapest edits by Hirschberg's divide and conquer.

A repaired conversation is an optional system row, then user and assistant rows in turn. Reading its rows
one by one, a repair is in one of four states: nothing yet, after the system row, after a user row, after an
assistant row. Each row moves it on by Keep, Rerole or Delete, with Inserts before; ``TRANSITIONS`` holds, for
each kind of row, the cheapest way between two states (of equally cheap ones the ASCII-least).

``reconstruct`` splits the rows in the middle, runs a cost vector of the four states forward to it and one
backward, takes the cheapest crossing and goes on in both halves, so it holds a vector and not a table. The
forward vector also ranks the states by the audits that lead to them. These all spend one letter that is not I
on each row and end with such a letter, so none is another's beginning: among equally cheap crossings the
least rank gives the ASCII-least audit.

On Spark, rows are range-partitioned by conversation, turn, role and text. A conversation that lies inside one
partition is repaired there. Conversations that reach over a border, be it one with a third of all rows, are
repaired by their segments: each gives a 4 x 4 table of costs and ranks, a conversation's tables (one for each
partition it touches) are joined into each segment's first and last state, and the segments are reconstructed
apart. Repeated rows across segments are found by digest and never meet in one task.

Null roles and texts count as one space, and null conv_id or turn as one space in the damage's key. Null conv_id is a
conversation of its own. Rows come by turn, nulls first; ties by role, then text as given, and equal rows are
interchangeable. Gaps past 2^63 - 1 count as that. Extra columns are ignored whatever their names. An empty table gives no rows; a conversation
without rows gives no edits and in ``report`` zeros and empty texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bound_batches, cut
from .near import join_per_key

#: What one partition holds: rows, and bytes of text.
PART_ROWS, PART_BYTES = 100_000, 24 << 20
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: Faults of a row: none, no end mark, nothing in it, seen before.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
FAULTS = ("", "truncated", "blank", "duplicate")
SPACE = " \t\n\x0b\x0c\r"
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
INF = 1 << 60
#: From each state to a whole conversation.
TAIL = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def _alternate(state: int) -> int:
    """The state after the next row of an alternating conversation."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial in ("u", "a") and (state == USER) == (initial == "a"):
        return _alternate(state)
    return None


@lru_cache(maxsize=None)
def transitions(initial: str, fault: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(from, to) -> (cost, letters) of the cheapest edits around one row; of equally cheap ones the ASCII-least."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in STATES:
        state = start
        for inserts in range(3):  # three would lead where one does
            moves = [(DELETE, state, COST[DELETE])]
            if fault < BLANK:
                moves.append((REROLE, _alternate(state), COST[REROLE] + fault))
                if (kept := _kept(state, initial)) is not None:
                    moves.append((KEEP, kept, COST[KEEP] + fault))
            for letter, end, cost in moves:
                way = (cost + inserts * COST[INSERT], INSERT * inserts + letter)
                best[start, end] = min(best.get((start, end), (INF, "")), way)
            state = _alternate(state)
    return best


def kind_of(role: str, fault: int) -> tuple[str, int]:
    return (role[:1] if role[:1] in ("s", "u", "a") else "", fault)


@lru_cache(maxsize=100_000)
def _forward(costs: tuple, ranks: tuple, kind: tuple) -> tuple[int, tuple, tuple]:
    """One row on: what the least cost rose by, and the costs above it and ranks of the four states."""
    ways: dict[int, tuple] = {}
    for (p, q), (cost, letters) in transitions(*kind).items():
        if costs[p] < INF:
            ways[q] = min(ways.get(q, (INF, 0, "")), (costs[p] + cost, ranks[p], letters))
    least = min(w[0] for w in ways.values())
    order = {w: i for i, w in enumerate(sorted(w[1:] for w in ways.values()))}
    return (least, tuple(ways[q][0] - least if q in ways else INF for q in STATES),
            tuple(order[ways[q][1:]] if q in ways else -1 for q in STATES))


@lru_cache(maxsize=100_000)
def _backward(costs: tuple, kind: tuple) -> tuple[int, tuple]:
    out = [INF] * 4
    for (p, q), (cost, _) in transitions(*kind).items():
        out[p] = min(out[p], costs[q] + cost)
    least = min(out)
    return least, tuple(c - least if c < INF else INF for c in out)


def _only(state: int) -> tuple:
    return tuple(0 if q == state else INF for q in STATES)


def forward(kinds: list[tuple], start: int, i: int, j: int) -> tuple[list[int], tuple]:
    """Costs and audit ranks of the four states after rows i..j-1, from ``start``."""
    base, costs, ranks = 0, _only(start), (0, 0, 0, 0)
    for k in range(i, j):
        rose, costs, ranks = _forward(costs, ranks, kinds[k])
        base += rose
    return [base + c if c < INF else INF for c in costs], ranks


def backward(kinds: list[tuple], end: int, i: int, j: int) -> tuple:
    """Costs, above the least of them, from the four states before row i to ``end`` after row j-1."""
    costs = _only(end)
    for k in range(j - 1, i - 1, -1):
        _, costs = _backward(costs, kinds[k])
    return costs


def reconstruct(kinds: list[tuple], start: int, end: int) -> Iterator[str]:
    """The letters of each row (its Inserts, then Keep, Rerole or Delete) of the ASCII-least of the cheapest audits."""
    todo = [(0, len(kinds), start, end)] if kinds else []
    while todo:
        i, j, p, q = todo.pop()
        if j - i == 1:
            yield transitions(*kinds[i])[p, q][1]
            continue
        mid = (i + j) // 2
        (ahead, ranks), behind = forward(kinds, p, i, mid), backward(kinds, q, mid, j)
        m = min((s for s in STATES if ahead[s] < INF and behind[s] < INF), key=lambda s: (ahead[s] + behind[s], ranks[s]))
        todo += [(mid, j, m, q), (i, mid, p, m)]


def best_end(costs: list[int], ranks: tuple) -> int:
    return min((s for s in STATES if costs[s] < INF), key=lambda s: (costs[s] + len(TAIL[s]) * COST[INSERT], ranks[s]))


def edits(rows: list[tuple], kinds: list[tuple], start: int, end: int, tail: str, before: str | None) -> Iterator[tuple]:
    """(edit, fault, illegal, role, text) in audit order. ``before``: the initial of the row before the first."""
    state = start
    for (role, text), kind, letters in zip(rows, kinds, reconstruct(kinds, start, end)):
        for _ in letters[:-1]:
            state = _alternate(state)
            yield INSERT, "", False, "user" if state == USER else "assistant", ""
        illegal = before is not None and before + role[:1] not in ("su", "ua", "au")
        before, done = role[:1], letters[-1]
        if done == REROLE:
            state = _alternate(state)
            role = "user" if state == USER else "assistant"
        elif done == KEEP:
            state = _kept(state, kind[0])
        yield done, FAULTS[kind[1]], illegal, role, text
    for _ in tail:
        state = _alternate(state)
        yield INSERT, "", False, "user" if state == USER else "assistant", ""


# ---- on Spark

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the place of ties (by_role, by_text, again), one kind of damage by crc32 of conv_id and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("by_role"), blank("text").alias("by_text"),
                                (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20).alias("hurt"))
    return (rows.where("hurt != 0")
            .withColumn("again", F.explode(F.when(F.col("hurt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", F.when(F.col("hurt") == 4, F.lit("user")).otherwise(F.col("by_role")).alias("role"),
                    F.when(F.col("hurt") == 1, F.lit("")).when(F.col("hurt") == 2, F.translate("by_text", ".!?", "")).otherwise(F.col("by_text")).alias("text"),
                    "by_role", "by_text", "again"))


def fault_of(text: Column) -> Column:
    """Blank, truncated or neither, from the text alone."""
    bare = F.rtrim(text, F.lit(SPACE))
    return F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED).cast("int")


EDIT = "conv_id long, part long, place long, edit string, fault string, illegal boolean, role string, text string"
SUMMARY = "conv_id long, gid long, costs array<long>, ranks array<int>, first string, last string"
BORDERS = "gid long, start int, end int, tail string, before string"
#: Rows of one output batch.
BATCH = 2_000


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _mapped(df: DataFrame, rows_of, ddl: str) -> DataFrame:
    """mapInArrow with a function from an iterator of rows to one of rows."""
    bound_batches(df.sparkSession)
    kind = T.StructType.fromDDL(ddl)
    return df.mapInArrow(lambda batches: _batches(rows_of(_rows(batches)), to_arrow_schema(kind)), ddl)


def _groups(rows: Iterator[tuple], key: int) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for row in rows:
        if held and row[key] != held[0][key]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _within(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted rows (conv_id, pos, role, text, fault, digest) of a partition: the edits of its inner conversations,
    and as they are the rows of its first and last one, which may go on next door."""
    at, gid, opening = None, None, False
    held: list[tuple] = []

    def raw(row: tuple) -> tuple:
        conv, pos, role, text, fault, digest = row
        return (conv, None, None, None, None, None, role, text, gid, pos, fault, digest)

    for row in rows:
        if gid is None or row[0] != at:
            if held:
                yield from _solve(held)
            opening, at, gid, held = gid is None, row[0], row[1], []
        if opening:
            yield raw(row)
        else:
            held.append(row)
    yield from map(raw, held)


def _solve(group: list[tuple]) -> Iterator[tuple]:
    seen, kinds = set(), []
    for _, _, role, _, fault, digest in group:
        if fault != BLANK and digest in seen:
            fault = DUPLICATE
        seen.add(digest)
        kinds.append(kind_of(role, fault))
    end = best_end(*forward(kinds, EMPTY, 0, len(kinds)))
    conv, part = group[0][0], group[0][1]
    for place, e in enumerate(edits([r[2:4] for r in group], kinds, EMPTY, end, TAIL[end], None)):
        yield (conv, part, place, *e, None, None, None, None)


def _summaries(rows: Iterator[tuple]) -> Iterator[tuple]:
    for group in _groups(rows, 1):
        kinds = [kind_of(r[3], r[5]) for r in group]
        costs, ranks = [], []
        for start in STATES:
            c, r = forward(kinds, start, 0, len(kinds))
            costs += c
            ranks += r
        yield group[0][0], group[0][1], costs, ranks, group[0][3][:1], group[-1][3][:1]


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states between the segments of one conversation."""
    pdf = pdf.sort_values("gid")
    costs, ranks = pdf["costs"].tolist(), pdf["ranks"].tolist()
    n = len(pdf)
    rest = [[0] * 4 for _ in range(n)] + [[len(TAIL[s]) * COST[INSERT] for s in STATES]]
    for k in range(n - 1, -1, -1):
        rest[k] = [min(int(costs[k][4 * p + q]) + rest[k + 1][q] for q in STATES) for p in STATES]
    out, p, before = [], EMPTY, None
    for k, (gid, last) in enumerate(zip(pdf["gid"], pdf["last"])):
        q = min((s for s in STATES if costs[k][4 * p + s] < INF), key=lambda s: (costs[k][4 * p + s] + rest[k + 1][s], ranks[k][4 * p + s]))
        out.append((gid, p, q, TAIL[q] if k == n - 1 else "", before))
        p, before = q, last
    return pd.DataFrame(out, columns=["gid", "start", "end", "tail", "before"])


def _reconstructed(rows: Iterator[tuple]) -> Iterator[tuple]:
    for group in _groups(rows, 1):
        kinds = [kind_of(r[3], r[5]) for r in group]
        start, end, tail, before = group[0][6:]
        for place, e in enumerate(edits([r[3:5] for r in group], kinds, start, end, tail, before)):
            yield (group[0][0], group[0][1], place, *e)


def repair(rows: DataFrame) -> DataFrame:
    """The edits of every conversation, in the order of part and place: conv_id, part, place, edit (K, R, D, I),
    fault, illegal (its role can't follow the row before), role and text after the edit.
    ``rows``: conv_id, turn, role, text, and by_role, by_text, again for ties, as ``damage`` gives them."""
    size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = int(max(1, -(-size[0] // PART_ROWS), -(-size[1] // PART_BYTES)))
    order = ["conv_id", "turn", "by_role", "by_text", "again"]
    # equal rows are dealt apart, too: one may be a third of all rows
    rows = rows.withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    ordered = (rows.repartitionByRange(n, *order, "deal").sortWithinPartitions(*order, "deal")
               .select("conv_id", F.monotonically_increasing_id().alias("pos"), "role", "text", fault_of(F.col("text")).alias("fault"),
                       F.unhex(F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role"), "role", "text").cast("binary"), 256)).alias("digest")))
    first = cut(_mapped(ordered, _within, EDIT + ", gid long, pos long, mark int, digest binary"), "conversations")
    inner = first.where("gid is null").select("conv_id", "part", "place", "edit", "fault", "illegal", "role", "text")
    raw = first.where("gid is not null").select("conv_id", "gid", "pos", "role", "text", F.col("mark").alias("fault"), "digest")

    full = raw.where(F.col("fault") != BLANK).select("digest", "pos")
    seen = cut(full.groupBy("digest").agg(F.min("pos").alias("earliest"), F.count("*").alias("n")).where("n > 1"), "seen")
    later = join_per_key(full, seen, ["digest"], "n", raw.count()).where("pos > earliest").select("pos", F.lit(DUPLICATE).alias("again"))
    marked = cut(raw.join(later.hint("merge"), "pos", "left").select("conv_id", "gid", "pos", "role", "text", F.coalesce("again", "fault").alias("fault")), "marked")
    by_segment = lambda df: df.repartitionByRange(n, "gid").sortWithinPartitions("gid", "pos")
    tables = _mapped(by_segment(marked), _summaries, SUMMARY)
    borders = cut(tables.groupBy("conv_id").applyInPandas(_chain, BORDERS), "borders")
    across = _mapped(by_segment(marked.join(borders.hint("merge"), "gid").select("conv_id", "gid", "pos", "role", "text", "fault", "start", "end", "tail", "before")), _reconstructed, EDIT)
    return inner.unionByName(across)


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row for each conversation from its edits in order; texts are hashed as they come."""
    at, out = None, None  # at: the conversation in a tuple, as its id may be null

    def close():
        return (at[0], out["blank"], out["duplicate"], out["truncated"], out["illegal"], out["cost"], "".join(out["audit"]), out["sha"].hexdigest())

    for conv, edit, fault, illegal, role, text in rows:
        if at is None or at[0] != conv:
            if at:
                yield close()
            at, out = (conv,), {f: 0 for f in FAULTS} | {"illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False}
        out[fault] += 1
        out["illegal"] += illegal
        out["cost"] += COST[edit] + (edit != DELETE and fault == FAULTS[TRUNCATED])
        out["audit"].append(edit)
        if edit != DELETE:
            out["sha"].update(f"{chr(10) if out['any'] else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            out["any"] = True
    if at:
        yield close()


def report(conversations: DataFrame) -> DataFrame:
    """Of every conv_id of the table: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 after damage and repair.

    The audit and the digest of a whole conversation are one value each, so this last step reads a conversation's edits in one
    task; it streams them, holding the audit's letters and not the texts."""
    hurt = damage(conversations)
    done = repair(hurt)
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = _mapped(done.repartitionByRange(n, "conv_id").sortWithinPartitions("conv_id", "part", "place").select("conv_id", "edit", "fault", "illegal", "role", "text"),
                   _digests, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    wide = lambda c: c.cast("decimal(30,0)")  # noqa: E731  no overflow between turns far apart
    gaps = hurt.groupBy("conv_id").agg(F.least(F.coalesce(wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn"), wide(F.lit(0))), wide(F.lit(2**63 - 1))).cast("long").alias("gaps"))
    both = (conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumns({"known": F.lit(True)}))
    for part in (gaps, told):
        both = both.alias("l").join(part.alias("r"), F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")), "left").select("l.*", *(f"r.{c}" for c in part.columns[1:]))
    zero = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return both.select("conv_id", *(zero(c, 0) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                       zero("audit", ""), zero("repaired_sha256", hashlib.sha256(b"").hexdigest()))
