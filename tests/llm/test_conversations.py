"""Conversation repair against a search over all edits, and on messy rows."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tracelake.llm import conversations as c

DDL = "conv_id bigint, turn bigint, role string, text string, symbols string, part int, digest string, audit string"


def brute_damage(rows):
    name = lambda v: " " if v is None else str(v)
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute_repair(rows):
    """Counts, cost, audit and lines of one conversation, by trying every edit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(
            "blank" if not shown else "duplicate" if (role, text) in seen
            else "truncated" if shown[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(k, state, inserted):
        options = []
        if k == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if k < len(rows):
            _, _, role, text = rows[k]
            cost, audit, lines = best(k + 1, state, 0)
            options.append((cost + 2, "D" + audit, lines))
            if faults[k] not in ("blank", "duplicate"):
                extra = 5 if faults[k] == "truncated" else 0
                if (state, role[:1]) in moves:
                    cost, audit, lines = best(k + 1, role[0], 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                for r in "ua":
                    if (state, r) in moves:
                        cost, audit, lines = best(k + 1, r, 0)
                        options.append((cost + extra + 1, "R" + audit, (f"{full[r]}:{text}", *lines)))
        if inserted < 3:
            for r in "ua":
                if (state, r) in moves:
                    cost, audit, lines = best(k, r, inserted + 1)
                    options.append((cost + 5, "I" + audit, (f"{full[r]}:", *lines)))
        return min(options) if options else (10**9, "~", ())

    cost, audit, lines = best(0, "", 0)
    turns = {r[1] for r in rows if r[1] is not None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    ), list(lines)


def brute(rows):
    out = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        out[r[0]].append(r)
    return {conv: brute_repair(found)[0] for conv, found in out.items()}


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], DDL).repartition(5)
    return [(r["conv_id"], tuple(r[f] for f in FIELDS)) for r in c.audits_with_digests(c.damaged(df)).collect()]


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "Uncle", "agent"]
    texts = ["One.", "Two!", "Three?", "cut", "cut off ", "", None, " \n", "é中", "Same. "]
    rows = []
    for conv in range(convs):
        conv = None if conv == 3 else conv
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5])
            rows.append((conv, None if rng.random() < 0.1 else turn, rng.choice(roles), rng.choice(texts)))
    return rows


def test_random_conversations(spark):
    for seed, convs, longest in ((1, 150, 9), (2, 20, 60)):
        rows = random_rows(seed, convs, longest)
        got = found(spark, rows)
        assert len(got) == len(dict(got)) and dict(got) == brute(rows)


@pytest.mark.usefixtures("no_broadcast")
def test_plans_that_are_not_broadcast(spark):
    rows = random_rows(5, 60, 6)
    assert dict(found(spark, rows)) == brute(rows)


def test_empty_dropped_and_long(spark):
    assert found(spark, []) == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    sound = next(t for t in range(1000) if zlib.crc32(f"2:{t}".encode()) % 20 > 4)
    long_text = "word " * 400_000 + "end."
    rows = [(1, dropped, "user", "All that there was."), (2, sound, "user", long_text)]
    got = dict(found(spark, rows))
    assert got == brute(rows)
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and got[2][6] == "D"


def test_long_conversation(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice([f"Text {t}.", f"Text {t}", "Same."])) for t in range(20_000)]
    rows += [(k, t, "ua"[t % 2], "Hi.") for k in range(100, 400) for t in range(2)]
    got = dict(found(spark, rows))
    few = {k: v for k, v in got.items() if k != 7}
    assert few == brute([r for r in rows if r[0] != 7])
    # the long one: its audit has an edit for each message, and ends in the grammar
    damaged = brute_damage([r for r in rows if r[0] == 7])
    assert len(got[7][6].replace("I", "")) == len(damaged)


def test_repaired_messages_keep_to_the_grammar(spark):
    rows = random_rows(9, 120, 8)
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], DDL)
    plain = c.messages(df)
    repaired = c.repair(plain, c.audits(plain)).collect()
    by_conv = {}
    for r in sorted(repaired, key=lambda r: r["position"]):
        by_conv.setdefault(r["conv_id"], []).append(r)
    named = [tuple(" " if k > 1 and v is None else v for k, v in enumerate(r)) for r in rows]
    for conv in {r[0] for r in rows}:
        mine = by_conv.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in mine))
        assert [r["position"] for r in mine] == list(range(len(mine)))
        lines = brute_repair([r for r in named if r[0] == conv])[1]
        assert [f"{r['role']}:{r['text']}" for r in mine] == lines
        assert all(r["text"] == "" and r["turn"] is None for r in mine if r["edit"] == "I")


def test_common_ends_are_made_once():
    rng = random.Random(4)
    ends = ["".join(rng.choice("sSuUaAoOD") for _ in range(12)) for _ in range(5)]
    some = sorted({rng.choice("uaD") * rng.randint(0, 3) + e for e in ends for _ in range(30)}, key=lambda s: s[::-1])
    automaton = c.Automaton()
    shared = {s: automaton.plan(s) for s in some}
    assert shared == {s: c.Automaton().plan(s) for s in some}
    assert automaton.made == len({s[k:] for s in some for k in range(len(s))})


def test_damage(spark):
    rows = random_rows(6, 80, 9)
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], DDL)
    got = c.damaged(df).where("there").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_damage(rows)))
    assert c.damaged(df).where(~F.col("there")).count() > 0
