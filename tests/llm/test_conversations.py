"""Conversation repair against all edit sequences, against SQL, and as a stream."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from fluvion.llm import conversations, queries
from fluvion.llm.conversations import Repair, damage, repair_conversations, repair_digests

SF = "/root/testdata/sf0.001"
LAWFUL = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """Least (cost, audit, turns) over all edits with at most two inserts in each gap; rows are (role, text, fault)."""
    best = None
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    choices = []
    for role, text, fault in rows:
        extra = 5 * (fault == 1)
        some = [(2, "D", [])]
        if fault < 2:
            some += [(extra, "K", [(role, text)]), (1 + extra, "R", [("user", text)]), (1 + extra, "R", [("assistant", text)])]
        choices += [gaps, some]
    choices.append(gaps)
    for pick in itertools.product(*choices):
        cost, audit, turns = 0, "", []
        for k, c in enumerate(pick):
            if k % 2:
                cost, audit, turns = cost + c[0], audit + c[1], turns + c[2]
            else:
                cost, audit, turns = cost + 5 * len(c), audit + "I" * len(c), turns + [(r, "") for r in c]
        if LAWFUL.fullmatch("".join(r[:1] or "?" for r, _ in turns)) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, turns)
    return best


def repaired(rows):
    work = Repair()
    turns = [t for r in rows for t in work.add(*r)] + work.end()
    return work.cost, work.audit.decode(), turns


@pytest.mark.parametrize("seed", range(60))
def test_repairs_are_the_cheapest_of_all(seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), f"t{k}", rnd.choice([0, 0, 0, 1, 2])) for k in range(rnd.randint(0, 4))]
    assert repaired(rows) == cheapest(rows)


def plain_dp(rows):
    """The same by whole strings, for longer conversations."""
    held = {0: (0, "")}
    close = lambda h: [h.__setitem__(to, min(h.get(to, (1 << 60, "")), (h[a][0] + 5, h[a][1] + "I"))) for _ in range(2) for a, to in ((0, 2), (1, 2), (2, 3), (3, 2)) if a in h]
    close(held)
    for role, _, fault in rows:
        new = {}
        for a, (cost, audit) in held.items():
            for to, c, letter in [(a, 2, "D"), *([] if fault > 1 else [(1, 5 * fault, "K")] if role[:1] == "s" and a == 0 else [])]:
                new[to] = min(new.get(to, (1 << 60, "")), (cost + c, audit + letter))
            if fault < 2:
                to = 3 if a == 2 else 2
                keeps = role[:1] == ("a" if to == 3 else "u")
                new[to] = min(new.get(to, (1 << 60, "")), (cost + 5 * fault + (0 if keeps else 1), audit + ("K" if keeps else "R")))
        held = new
        close(held)
    return min(held[s] for s in (0, 3) if s in held)


@pytest.mark.parametrize("roles", ["u", "uuuuuua", "sua", "aus", "ssssu", "uaxa"])
def test_long_conversations_agree_with_whole_strings(roles, monkeypatch):
    monkeypatch.setattr(conversations, "LOOK", 8)
    rnd = random.Random(roles)
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    for n in (30, 300):
        rows = [(names[rnd.choice(roles)], f"t{k}", rnd.choice([0] * 6 + [1, 2])) for k in range(n)]
        work = Repair()
        work.look = 8
        turns = [t for r in rows for t in work.add(*r)] + work.end()
        assert (work.cost, work.audit.decode()) == plain_dp(rows)
        assert LAWFUL.fullmatch("".join(r[0] for r, _ in turns))
        assert len(turns) == len(work.audit) - work.audit.count(b"D")


def test_long_conversations_are_handed_out_as_they_come():
    work, waiting, out = Repair(), 0, 0
    for k in range(200_000):
        out += len(work.add(("user", "assistant")[k % 2], "a text", int(k % 97 == 0)))
        waiting = max(waiting, len(work.rows))
    out += len(work.end())
    assert waiting < 5000 and out > 190_000


ODD = [
    (1, None, None, None), (1, None, None, None), (1, 3, "user", "Hello."), (1, 3, "user", "Hello."), (1, 4, "assistant", " \t\n"), (1, 9, "assistant", "Cut off"), (1, 9, "", "No role."),
    (None, 1, "user", "No id."), (None, 2, "assistant", "None either!"), (None, 7, "system", "Late."), (3, 0, "assistant", "x "), (4, 2, "system", "Only."), (5, 1, "user", "w " * 50_000 + "."),
]


def by_hand(rows):
    """The contract's columns by plain Python, brute force for the repair of short conversations."""
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = role if role is not None else " ", text if text is not None else " "
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            held += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in held:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in held if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(held, held[1:])]
        plan = [(r, t, {"": 0, "truncated": 1}.get(f, 2)) for (_, r, t), f in zip(held, faults, strict=True)]
        cost, audit, new = cheapest(plan) if len(plan) < 5 else repaired(plan)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in new).encode()).hexdigest(),
        )
    return out


def test_odd_conversations(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").unionByName(spark.createDataFrame([(i and i + 10**6, t, r, x) for i, t, r, x in ODD], "conv_id long, turn long, role string, text string"))
    held = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    rows = rows.selectExpr("*", "1 AS fault", "'x' AS present")
    got = {r.conv_id: tuple(r)[1:] for r in repair_digests(repair_conversations(damage(rows), present=F.col("present"))).collect()}
    assert got == by_hand(held)


def test_turns_are_the_real_output(spark):
    rows = spark.createDataFrame([(7, 0, "user", "Hi"), (7, 1, "user", "Hi."), (7, 2, "assistant", "Yes."), (8, 0, "user", " ")], "conv_id int, turn int, role string, text string")
    out = repair_conversations(rows)
    assert sorted((r.conv_id, r.place, r.role, r.text) for r in out.where("place IS NOT NULL").collect()) == [(7, 0, "user", "Hi."), (7, 1, "assistant", "Yes.")]
    assert sorted((r.conv_id, r.audit, r.cost) for r in out.where("place IS NULL").collect()) == [(7, "DKK", 2), (8, "D", 2)]
    assert repair_digests(repair_conversations(rows.limit(0))).count() == 0


def test_repair_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    want = con.execute(queries.OP12).fetchdf()
    got = queries.op12_conversation_repair(spark, SF).toPandas()
    assert sorted(map(tuple, got[list(want.columns)].astype(str).values)) == sorted(map(tuple, want.astype(str).values))
