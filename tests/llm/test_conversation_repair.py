"""Conversation repair against a plain search over all cheapest edits."""
import hashlib
import random
import zlib

import pytest

from cohesion.llm import conversations as c

COLUMNS = "conv_id long, turn long, role string, text string, cost string, audit long, part string, pos int"


def cheapest(kinds):
    """(cost, audit) of the ASCII-least of the cheapest audits: all states with their whole audits."""
    best = {c.EMPTY: (0, "")}

    def inserted(best):
        out = dict(best)
        for _ in range(4):
            for s, (cost, audit) in list(out.items()):
                t = c._alternate(s)
                out[t] = min(out.get(t, (99**9, "")), (cost + 2, audit + "I"))
        return out

    for initial, fault in kinds:
        after = {}
        for s, (cost, audit) in inserted(best).items():
            moves = [(s, 3, "D")]
            if fault < c.BLANK:
                moves.append((c._alternate(s), 2 + fault, "R"))
                if c._kept(s, initial) is not None:
                    moves.append((c._kept(s, initial), fault, "K"))
            for t, price, letter in moves:
                after[t] = min(after.get(t, (99**9, "")), (cost + price, audit + letter))
        best = after
    best = inserted(best)
    return min(best[s] for s in (c.EMPTY, c.ASSISTANT) if s in best)


def plainly(rows):
    """The contract, row by row: {conv_id: result}."""
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " "))
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in order if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            hurt = zlib.crc32(key.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if hurt == 0:
                continue
            text = "" if hurt == 1 else text.translate({46: None, 33: None, 63: None}) if hurt == 2 else text
            kept += [(turn, "user" if hurt == 4 else role, text)] * (2 if hurt == 3 else 1)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), 2**63 - 1) if turns else 0  # it is a long
        seen, faults = set(), []
        for _, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(c.BLANK if not bare else c.DUPLICATE if (role, text) in seen else c.SOUND if bare[-1] in ".!?" else c.TRUNCATED)
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        kinds = [c.kind_of(r, f) for (_, r, _), f in zip(kept, faults)]
        cost, audit = cheapest(kinds)
        state, lines, at = c.EMPTY, [], 0
        for letter in audit:
            if letter == "I":
                state = c._alternate(state)
                lines.append("user:" if state == c.USER else "assistant:")
                continue
            _, role, text = kept[at]
            at += 1
            if letter != "D":
                state = c._alternate(state) if letter == "R" or role[:1] != "s" else c.SYSTEM
                lines.append(f"{('user' if state == c.USER else 'assistant') if letter == 'R' else role}:{text}")
        out[conv] = (conv, gaps, faults.count(c.BLANK), faults.count(c.DUPLICATE), faults.count(c.TRUNCATED), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], COLUMNS)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, "", "usher", "User", "s"]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "Ünï!", "a  \t", "b.\n", "...", " x", "\x1c"]
    out = []
    for conv in range(400):
        for turn in range(rng.randint(1, 12)):
            out.append((conv, rng.choice([turn, turn, turn, turn + 3, None, -5]), rng.choice(roles), rng.choice(texts)))
    out += [(1000, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(300)]
    out += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(20)] + [(None, None, None, None)] * 3
    out += [(2000, 7, "user", "the same.")] * 400  # repeated rows
    out += [(3000, t, rng.choice(roles), rng.choice(texts)) for t in range(-400, 400)]
    out += [(4000, -2**63, "user", "least."), (4000, 2**63 - 1, "assistant", "long " * 60_000 + ".")]
    out += [(5000 + i, turn, "user", "gone") for i in range(60) for turn in (i,)]  # some lose all rows
    return out


def test_reconstruction_is_the_least_of_the_cheapest():
    rng = random.Random(2)
    for _ in range(3000):
        kinds = [(rng.choice("suuaa") if rng.random() < 0.9 else "", rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(rng.randint(0, 14))]
        ends = c.forward(kinds, c.EMPTY, 0, len(kinds))
        end = c.best_end(*ends)
        got = "".join(c.reconstruct(kinds, c.EMPTY, end)) + c.TAIL[end]
        assert (ends[0][end] + 2 * len(c.TAIL[end]), got) == cheapest(kinds), kinds


def check(spark, rows):
    got = [tuple(r) for r in c.report(table(spark, rows)).collect()]
    want = plainly(rows)
    assert len(got) == len(want)
    for r in got:
        assert r == want[r[0]]


def test_report_equals_plain_version(spark, rows):
    check(spark, rows)


def test_conversations_over_many_segments(spark, rows, monkeypatch):
    monkeypatch.setattr(c, "PART_ROWS", 60)
    parts = {r.part for r in c.repair(c.damage(table(spark, rows))).where("conv_id = 3000").select("part").collect()}
    assert len(parts) > 3
    check(spark, rows)


def test_empty_table_and_lost_conversations(spark, rows):
    assert c.report(table(spark, [])).collect() == []
    empty = [tuple(r) for r in c.report(table(spark, rows)).where("audit = ''").collect()]
    assert empty and all(r[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in empty if r[0] >= 5000)


def test_edits_are_rows(spark, rows):
    edits = c.repair(c.damage(table(spark, rows))).where("conv_id = 1000").orderBy("part", "place").collect()
    kept = [r.role for r in edits if r.edit != "D"]
    assert kept == ["user", "assistant"] * (len(kept) // 2)
