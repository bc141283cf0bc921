"""Repair of conversations: the cheapest edits that give each one a lawful order of roles.

The roles of a whole conversation read ``(s?(ua)+)?`` by their initials. A row
is kept (K), given another role (R) or deleted (D), and empty rows are inserted
(I). A forward Viterbi pass over four grammar states carries, for each, the
least (cost, audit string); a row's layer is closed by at most two inserts, as
two reach any state from any other.

Audit strings of one layer that end in a row's edit are never prefixes of each
other, so their order within the layer (a rank) stands for the strings, and a
step costs the same however long the conversation is. Costs are kept relative
to the cheapest state, and states that a cheaper one can always replace are
left out, so few different layers exist and each step is looked up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fluvion.session import ship, tidy

#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn. The first and the last may end.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: How much dearer a state may be than another before the other can always replace it: {state: {other: margin}}.
MARGINS = {NONE: {ASSISTANT: DELETE, USER: DELETE + INSERT}, SYSTEM: {ASSISTANT: 0}, USER: {ASSISTANT: INSERT}, ASSISTANT: {USER: INSERT}}
BLANKS = " \t\n\x0b\x0c\r"
#: Rows after which undecided turns are looked at for what is decided by now.
LOOK = 1024
NEVER = 1 << 60


def answered(state: int) -> int:
    """The state after an inserted turn."""
    return ASSISTANT if state == USER else USER


def edits(initial: str, fault: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(from, to) -> least (cost, inserts and edit) of one row; fault 0 none, 1 truncated, 2 blank or duplicate."""
    out = {}
    for start in range(4):
        state = start
        for inserts in range(3):
            after = [(state, DELETE, "D")]
            if fault < 2:
                dear = TRUNCATED * fault
                if initial == "s" and state == NONE:
                    after.append((SYSTEM, KEEP + dear, "K"))
                if initial == "ua"[answered(state) == ASSISTANT]:
                    after.append((answered(state), KEEP + dear, "K"))
                after.append((answered(state), REROLE + dear, "R"))
            for to, cost, letter in after:
                found = (cost + INSERT * inserts, "I" * inserts + letter)
                out[start, to] = min(out.get((start, to), found), found)
            state = answered(state)
    return out


TABLE = {(i, f): edits(i, f) for i in ("s", "u", "a", "") for f in range(3)}
#: A layer: relative costs of the states and the ranks of their audit strings.
FIRST = ((0, NEVER, NEVER, NEVER), (0, 0, 0, 0))


@lru_cache(maxsize=1 << 16)
def step(layer: tuple, initial: str, fault: int) -> tuple[tuple, int, tuple]:
    """The next layer, by how much its cheapest state costs more, and for each state the (state before, inserts and edit) that leads there."""
    costs, ranks = layer
    best: list = [None] * 4
    for (start, to), (cost, letters) in TABLE[initial, fault].items():
        if costs[start] < NEVER:
            found = (costs[start] + cost, ranks[start], letters, start)
            best[to] = found if best[to] is None or found < best[to] else best[to]
    for state, others in MARGINS.items():
        if best[state] and any(best[o] and best[state][0] > best[o][0] + margin for o, margin in others.items()):
            best[state] = None
    order = sorted({b[1:3] for b in best if b})
    low = min(b[0] for b in best if b)
    costs = tuple(b[0] - low if b else NEVER for b in best)
    return (costs, tuple(order.index(b[1:3]) if b else 0 for b in best)), low, tuple((b[3], b[2]) if b else None for b in best)


def cheapest_end(layer: tuple) -> tuple[int, int, str]:
    """(extra cost, state, last inserts) of the best lawful end of a layer."""
    costs, ranks = layer
    ends = [(costs[NONE], ranks[NONE], "", NONE), (costs[ASSISTANT], ranks[ASSISTANT], "", ASSISTANT), (costs[USER] + INSERT, ranks[USER], "I", USER), (costs[SYSTEM] + 2 * INSERT, ranks[SYSTEM], "II", SYSTEM)]
    cost, _, letters, state = min(ends)
    return cost, state, letters


class Repair:
    """One conversation, row by row: what is decided is handed out while later rows still come."""

    def __init__(self):
        self.layer, self.cost, self.audit = FIRST, 0, bytearray()
        self.backs: list[tuple] = []
        self.rows: list[tuple[str, str]] = []
        self.state, self.look = NONE, LOOK

    def add(self, role: str, text: str, fault: int) -> list[tuple[str, str]]:
        """Take one row in; returns repaired turns (role, text) that no later row can change any more."""
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        self.layer, dearer, back = step(self.layer, initial, fault)
        self.cost += dearer
        self.backs.append(back)
        self.rows.append((role, text))
        if len(self.backs) < self.look:
            return []
        states = {s for s in range(4) if self.layer[0][s] < NEVER}
        n = len(self.backs)
        while n and len(states) > 1:
            n -= 1
            states = {self.backs[n][s][0] for s in states}
        out = self.decide(n, states.pop()) if n else []
        self.look = 2 * len(self.backs) + LOOK
        return out

    def decide(self, n: int, state: int, last: str = "") -> list[tuple[str, str]]:
        """Turns of the first ``n`` pending rows on the way to ``state``, and of the inserts after them."""
        letters = []
        for back in reversed(self.backs[:n]):
            state, some = back[state]
            letters.append(some)
        out = []
        for some, row in zip([*reversed(letters), last], [*self.rows[:n], None], strict=True):
            for letter in some:
                if letter == "K":
                    self.state = SYSTEM if row[0][0] == "s" else answered(self.state)
                    out.append(row)
                elif letter != "D":
                    self.state = answered(self.state)
                    out.append(("user" if self.state == USER else "assistant", row[1] if letter == "R" else ""))
            self.audit += some.encode()
        del self.backs[:n], self.rows[:n]
        return out

    def end(self) -> list[tuple[str, str]]:
        """The turns that are left; ``cost`` and ``audit`` are final then."""
        cost, state, last = cheapest_end(self.layer)
        self.cost += cost
        return self.decide(len(self.backs), state, last)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None) -> DataFrame:
    """The repaired turns of every conversation, and after them a summary row.

    Turn rows have ``conv_id, place`` (from 0), ``role, text``; the summary has a
    null place and the columns gaps, blank, duplicate, truncated, illegal, cost
    and audit. Rows stay in this order within their partitions, so what comes
    next can read a conversation as a stream.

    Rows are taken by turn (nulls first), role and text. Null roles and texts
    count as one space; null ids are one conversation. A blank row has no other
    character than blanks, a duplicate has role and text of an earlier row, a
    truncated row does not end in ``. ! ?``; the first of these counts. Roles
    with other initials than s, u, a can only be changed or deleted. Rows for
    which ``present`` is false count for nothing but their conversation's
    existence; one without other rows gets zeros, an empty audit and no turn. An
    empty table gives no rows, further columns are ignored.

    Conversations are dealt by id and sorted on disk if need be. A worker holds
    the undecided turns of one conversation, of any text length, and a reference
    for each of their rows; its audit is one value of the result in any case.
    """
    ship(rows.sparkSession)
    named = rows.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    )
    copy = F.row_number().over(Window.partitionBy("conv_id", "present", "role", "text").orderBy("turn"))
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", "b").when(F.col("copy") > 1, "d").when(~last.isin(".", "!", "?"), "t").otherwise("")
    # The window reads each conversation where the repartition has put it: one shuffle in all.
    marked = named.repartition("conv_id").withColumn("copy", copy).withColumn("fault", F.when(F.col("present"), fault)).sortWithinPartitions("conv_id", "turn", "role", "text", "copy")
    schema = f"conv_id {dict(named.dtypes)['conv_id']}, place long, role string, text string, {', '.join(f'{c} long' for c in COUNTS)}, audit string"

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in ("conv_id", "place", "role", "text", *COUNTS, "audit")}
        kinds, held, current, work = None, 0, None, None

        def turns(found: list) -> None:
            nonlocal held
            for role, text in found:
                for column, value in zip(out, (current, work.place, role, text, *[None] * 7), strict=True):
                    out[column].append(value)
                work.place += 1
                held += len(text) + 50

        def close() -> None:
            nonlocal held
            turns(work.end())
            gaps = work.high - work.low + 1 - work.turns if work.turns else 0
            values = (current, None, None, None, gaps, work.faults["b"], work.faults["d"], work.faults["t"], work.illegal, work.cost, work.audit.decode())
            for column, value in zip(out, values, strict=True):
                out[column].append(value)
            held += len(work.audit) + 100

        def flush() -> pa.RecordBatch:
            nonlocal held, out
            some, out, held = out, {c: [] for c in out}, 0
            types = [kinds[0], pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(some.values(), types, strict=True)], names=list(some))

        for batch in batches:
            kinds = batch.schema.types
            for conv, turn, role, text, flaw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if work is None or conv != current:
                    if work is not None:
                        close()
                    current, work = conv, Repair()
                    work.place, work.illegal, work.turns, work.low, work.high, work.before = 0, 0, 0, None, None, None
                    work.faults = {"b": 0, "d": 0, "t": 0, "": 0}
                if flaw is not None:
                    work.faults[flaw] += 1
                    if turn is not None and turn != work.high:
                        work.turns, work.high = work.turns + 1, turn
                        work.low = turn if work.low is None else work.low
                    if work.before is not None and work.before + role[:1] not in ("su", "ua", "au"):
                        work.illegal += 1
                    work.before = role[:1]
                    turns(work.add(role, text, 2 if flaw in ("b", "d") else flaw == "t"))
                if held > 1 << 20:
                    yield flush()
        if work is not None:
            close()
            yield flush()

    return marked.select("conv_id", "turn", "role", "text", "fault").mapInArrow(tidy(repair), schema)


def repair_digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of repair_conversations: its summary and the SHA-256 of its turns, ``role:text`` joined by newlines.

    Turns are hashed as they stream by; none are gathered.
    """
    kind = dict(repaired.dtypes)["conv_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = hashlib.sha256()
        for batch in batches:
            digests = []
            for place, role, text in zip(*[batch.column(c).to_pylist() for c in ("place", "role", "text")], strict=True):
                if place is None:
                    digests.append(running.hexdigest())
                    running = hashlib.sha256()
                else:
                    running.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            ends = batch.filter(batch.column("place").is_null())
            yield pa.RecordBatch.from_arrays([ends.column("conv_id"), *[ends.column(c) for c in COUNTS], ends.column("audit"), pa.array(digests, pa.string())], names=["conv_id", *COUNTS, "audit", "repaired_sha256"])

    return repaired.mapInArrow(tidy(digest), f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32(``conv_id:turn``) modulo 20 (nulls: one space), and a column ``present`` that is false for dropped rows.

    0 drops a row, 1 empties its text, 2 takes its ``. ! ?`` away, 3 repeats it,
    4 makes the user its role.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(named("text"), ".!?", "")).otherwise(named("text"))
    marked = rows.withColumn("_kind", kind).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(named("role")).alias("role"), text.alias("text"), (F.col("_kind") != 0).alias("present"), F.when(F.col("_kind") == 3, 2).otherwise(1).alias("_times")
    )
    return marked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy")
