"""Repair of conversation structure: the cheapest edits that make roles read ``(s?(ua)+)?``, the ASCII-least on ties.

Keeping a message costs 0, giving it the role that is due 2, deleting it 3 (required for blank and repeated messages),
inserting an empty message of the role that is due 2; a message without closing punctuation that stays costs 1 more. The
state is the role read last, so the cost to finish from a message on is a vector of four numbers. A backward pass stores
that vector at checkpoints only, about the square root of the messages apart; a walk forward computes one block of vectors at
a time again and takes, of the edits that lie on a cheapest path, the one whose letter comes first.

On Spark the messages are sorted by range, so a conversation of any size lies in consecutive tasks. Conversations that end
inside a task and fit a block are solved there. The others are cut into blocks: a block's costs between any two states form
a (min, +) matrix; matrices are multiplied backward into the checkpoints at the blocks' ends, each block then says in which
state it would leave its messages for each state of entry, and with those known, all blocks are walked at the same time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import inf, isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shelfledger.llm.common import Stage

#: Messages and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 4096, 4 << 20
#: Of equal turns, those that agree in so many characters of role and text are sorted in one task.
ROLE_KEY, TEXT_KEY = 32, 256
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

# States: nothing read, system read, user read, assistant read. INSERTED: the state behind a message of the role that is due.
INSERTED = (2, 2, 3, 2)
DUE = ("user", "user", "assistant", "user")
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
LEGAL = {"su", "ua", "au"}
MUST_GO = "-"
END = (0, 4, 2, 0)

Vector = tuple[float, ...]


def closed(costs: list[float]) -> Vector:
    """Costs to finish when messages may be inserted first."""
    user, assistant = min(costs[2], costs[3] + 2), min(costs[3], costs[2] + 2)
    return min(costs[0], user + 2), min(costs[1], user + 2), user, assistant


def options(after: Vector, code: str, state: int) -> Iterator[tuple[str, int, float]]:
    """Edits of a message: letter, next state, cost to finish. A capital code is a message without closing punctuation."""
    yield "D", state, after[state] + 3
    if code != MUST_GO:
        open_end, kept = code.isupper(), KEPT[code.lower()].get(state)
        if kept is not None:
            yield "K", kept, after[kept] + open_end
        yield "R", INSERTED[state], after[INSERTED[state]] + 2 + open_end


@lru_cache(1 << 16)
def before(after: Vector, code: str) -> tuple[Vector, float]:
    """The vector in front of a message, with its least cost taken off, and that cost. Few vectors differ, so most are looked up."""
    costs = closed([min(cost for *_, cost in options(after, code, state)) for state in range(4)])
    least = min(costs)
    return tuple(cost - least for cost in costs), least


@lru_cache(1 << 18)
def tight(after: Vector, code: str, state: int) -> tuple[str, int]:
    """The ASCII-least tight edits at a message, inserted ones first, and the state behind it."""
    costs, least = before(after, code)
    edits = ""
    while True:
        cost = costs[state] + least
        found = {letter: to for letter, to, total in options(after, code, state) if total == cost}
        if "D" not in found and costs[INSERTED[state]] + least + 2 == cost:
            found = {"I": INSERTED[state]}
        letter = min(found)
        edits, state = edits + letter, found[letter]
        if letter != "I":
            return edits, state


def items(initials: str, faults: str, counts: Iterable[int]) -> Iterator[tuple[str, int, int]]:
    """The code of each message, how often it follows itself, and its place; copies of a message must go."""
    for at, (first, found, count) in enumerate(zip(initials, faults, counts, strict=True)):
        if found in "bd":
            yield MUST_GO, count, at
        else:
            yield (first.upper() if found == "t" else first), 1, at
            if count > 1:
                yield MUST_GO, count - 1, at


def vectors(codes: list[str], end: Vector) -> list[Vector]:
    """The vectors behind each message, first to last."""
    found = [end]
    for code in reversed(codes[1:]):
        found.append(before(found[-1], code)[0])
    return found[::-1]


def walk(codes: list[str], end: Vector, state: int) -> tuple[list[str], int]:
    """The edits at each message, and the state behind the last. Holds about twice the square root of the messages in vectors."""
    step = isqrt(len(codes)) + 1
    marks, vector = {}, end
    for at in range(len(codes) - 1, -1, -1):
        if (at + 1) % step == 0 or at == len(codes) - 1:
            marks[at] = vector
        vector = before(vector, codes[at])[0]
    edits = []
    for begin in range(0, len(codes), step):
        block = codes[begin : begin + step]
        for code, after in zip(block, vectors(block, marks[begin + len(block) - 1]), strict=True):
            found, state = tight(after, code, state)
            edits.append(found)
    return edits, state


def matrix(codes: list[str]) -> list[float]:
    """Least costs from each state in front of the messages (rows) to each behind them (columns)."""
    columns = []
    for state in range(4):
        vector, least = tuple(0 if s == state else inf for s in range(4)), 0
        for code in reversed(codes):
            vector, more = before(vector, code)
            least += more
        columns.append([cost + least for cost in vector])
    return [columns[to][at] for at in range(4) for to in range(4)]


def times(costs: list[float], after: Vector) -> Vector:
    """The vector in front of a block, with its least cost taken off."""
    found = closed([min(costs[4 * at + to] + after[to] for to in range(4)) for at in range(4)])
    return tuple(cost - min(found) for cost in found)


def initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "o"


def fault(text: str) -> str:
    """b: blank, t: without closing punctuation, else a full stop."""
    kept = text.rstrip(WHITE)
    return "b" if not kept else "." if kept[-1] in ".!?" else "t"


class Messages:
    """Consecutive messages of one conversation, equal ones counted."""

    def __init__(self, roles: list[str], texts: list[str], counts: list[int], faults: str):
        self.roles, self.texts, self.counts, self.faults = roles, texts, counts, faults
        self.initials = "".join(map(initial, roles))

    def items(self) -> list[tuple[str, int, int]]:
        return list(items(self.initials, self.faults, self.counts))

    def figures(self) -> dict[str, int]:
        copies = [count for f, count in zip(self.faults, self.counts, strict=True) if f == "d"]
        copies += [count - 1 for f, count in zip(self.faults, self.counts, strict=True) if f not in "bd"]
        pairs = map("".join, zip(self.initials, self.initials[1:]))
        return {
            "blank": sum(count for f, count in zip(self.faults, self.counts, strict=True) if f == "b"),
            "duplicate": sum(copies),
            "truncated": self.faults.count("t"),
            "illegal": sum(pair not in LEGAL for pair in pairs) + sum(self.counts) - len(self.counts),
        }

    def repaired(self, end: Vector, state: int, last: bool) -> tuple[str, list[tuple[str, str, str]], int]:
        """The edits' letters, the messages that they leave (letter, role, text), and the cost."""
        found_items = self.items()
        edits, leaving = walk([code for code, *_ in found_items], end, state)
        audit, rows, cost = [], [], 0
        for (code, count, at), found in zip(found_items, edits, strict=True):
            for _ in found[:-1]:
                rows.append(("I", DUE[state], ""))
                state = INSERTED[state]
            letter, role = found[-1], self.roles[at]
            if letter == "R":
                role = DUE[state]
            state = KEPT[code.lower()][state] if letter == "K" else INSERTED[state] if letter == "R" else state
            if letter != "D":
                rows.append((letter, role, self.texts[at]))
                cost += code.isupper()
            audit.append(found[:-1] + letter * count)
        assert state == leaving
        while last and END[state]:
            rows.append(("I", DUE[state], ""))
            audit.append("I")
            state = INSERTED[state]
        letters = "".join(audit)
        return letters, rows, cost + 3 * letters.count("D") + 2 * (letters.count("I") + letters.count("R"))


def lines(rows: list[tuple[str, str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in rows)


FIGURES = ("blank", "duplicate", "truncated", "illegal", "cost")
_MESSAGE = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
MESSAGE = "array<struct<edit: string, role: string, text: string>>"
_SOLVED = [("gaps", pa.int64()), *[(name, pa.int64()) for name in FIGURES], ("audit", pa.string()), ("repaired_sha256", pa.string())]
SOLVED = f"gaps long, {', '.join(f'{name} long' for name in FIGURES)}, audit string, repaired_sha256 string"
_BLOCK = [
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("faults", pa.string()),
    ("keys", pa.list_(pa.binary())), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64()),
]
BLOCK = "roles array<string>, texts array<string>, counts array<long>, faults string, keys array<binary>, first_turn long, last_turn long, turns long"


class Block:
    """Messages as they come, up to the size of a block, with the repeats inside it."""

    def __init__(self, rows: int = BLOCK_ROWS, chars: int = BLOCK_CHARS):
        self.rows_limit, self.chars_limit = rows, chars
        self.roles, self.texts, self.counts, self.faults, self.keys, self.seen, self.chars = [], [], [], [], [], set(), 0
        self.first_turn = self.last_turn = None
        self.turns = 0

    def full(self) -> bool:
        return len(self.roles) >= self.rows_limit or self.chars >= self.chars_limit

    def add(self, turn: int | None, role: str | None, text: str | None, count: int) -> None:
        if role is None:  # only tells that the conversation exists
            return
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        found, key = fault(text), None
        if found != "b":
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            if key in self.seen:
                found, key = "d", None
            else:
                self.seen.add(key)
        for values, value in zip((self.roles, self.texts, self.counts, self.faults, self.keys), (role, text, count, found, key), strict=True):
            values.append(value)
        self.chars += len(role) + len(text)

    def messages(self) -> Messages:
        return Messages(self.roles, self.texts, self.counts, "".join(self.faults))

    def row(self) -> dict:
        return {name: getattr(self, name) for name, _ in _BLOCK} | {"faults": "".join(self.faults)}

    def solved(self, want_messages: bool) -> dict:
        own = self.messages()
        audit, rows, cost = own.repaired(END, 0, True)
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        found = own.figures() | {"gaps": gaps, "cost": cost, "audit": audit}
        if want_messages:
            return found | {"messages": as_structs(rows)}
        return found | {"repaired_sha256": hashlib.sha256(lines(rows).encode()).hexdigest()}


def as_structs(rows: list[tuple[str, str, str]]) -> list[dict]:
    return [dict(zip(("edit", "role", "text"), row, strict=True)) for row in rows]


def each_row(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[dict]:
    """The rows of batches as dicts, so many at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield from batch.slice(begin, rows).to_pylist()


def written(rows: Iterator[dict], schema: pa.Schema, limit: int = 256, chars: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(text) for text in row.get("texts") or ()) + len(row.get("audit") or "") + len(row.get("piece") or "")
        if len(held) == limit or size >= chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def first_pass(rows: Iterator[dict], part: int, want_messages: bool, block_rows: int) -> Iterator[dict]:
    """Conversations that lie inside a task and fit a block, solved; the blocks of the others, numbered."""
    blocks, block, at, conv, opened, cut = 0, None, 0, None, False, False

    def as_block() -> dict:
        nonlocal blocks
        blocks += 1
        return {"conv_id": conv, "part": part, "block": blocks - 1} | block.row()

    for row in rows:
        if opened and row["conv_id"] == conv:
            if block.full():
                yield as_block()
                block, cut = Block(block_rows), True
        else:
            if opened:
                # The first conversation of a task may have begun in the one before.
                yield as_block() if cut or at == 1 else {"conv_id": conv} | block.solved(want_messages)
            block, conv, opened, cut, at = Block(block_rows), row["conv_id"], True, False, at + 1
        block.add(row["turn"], row["role"], row["text"], row["copies"])
    if opened:
        yield as_block()


def sorted_messages(messages: DataFrame, copies: str | None) -> DataFrame:
    """Distinct messages with their number, in order of conversation, turn (nulls first), role and text, dealt by range."""
    count = F.col(copies).cast("long") if copies else F.lit(1)
    there = count > 0
    rows = messages.select(
        "conv_id",
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        *[F.when(there, F.coalesce(F.col(name).cast("string"), F.lit(" "))).alias(name) for name in ("role", "text")],
        count.alias("copies"),
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    keys = ["conv_id", "turn", F.substring("role", 1, ROLE_KEY), F.substring("text", 1, TEXT_KEY)]
    return rows.repartitionByRange(*keys).sortWithinPartitions("conv_id", "turn", "role", "text")


def solve(messages: DataFrame, copies: str | None, want_messages: bool, block_rows: int) -> DataFrame:
    stage = Stage(messages.sparkSession)
    rows = sorted_messages(messages, copies)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def schema_of(batches: Iterator[pa.RecordBatch], fields: list) -> tuple[pa.Schema, Iterator[pa.RecordBatch]]:
        first = next(batches, None)
        if first is None:
            return pa.schema(fields), iter(())

        def all_of() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        return pa.schema([("conv_id", first.schema.field("conv_id").type), *fields]), all_of()

    places = [("part", pa.int32()), ("block", pa.int32())]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, batches = schema_of(batches, [*places, *_SOLVED, ("messages", pa.list_(_MESSAGE)), *_BLOCK])
        return written(first_pass(each_row(batches), TaskContext.get().partitionId(), want_messages, block_rows), schema)

    passed = stage(rows.mapInArrow(first, f"conv_id {kind}, part int, block int, {SOLVED}, messages {MESSAGE}, {BLOCK}"))
    whole = passed.where("block is null").drop("part", "block")
    blocks = passed.where("block is not null")

    # A message that an earlier block of the conversation has is a repeat. A key has one row for each block.
    keyed = blocks.select("conv_id", "part", "block", F.posexplode("keys").alias("at", "key")).where("key is not null")
    place = F.struct("part", "block")
    earliest = F.min(place).over(Window.partitionBy("conv_id", "key"))
    repeats = keyed.withColumn("later", earliest < place).where("later").groupBy("part", "block").agg(F.collect_list("at").alias("repeats"))
    slim = blocks.select("conv_id", "part", "block", "counts", "faults", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("roles"))
    slim = slim.join(repeats, ["part", "block"], "left")

    def to_matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, batches = schema_of(batches, [*places, ("faults", pa.string()), ("codes", pa.list_(pa.string())), ("matrix", pa.list_(pa.float64()))])

        def found() -> Iterator[dict]:
            for row in each_row(batches, 16):
                faults = list(row["faults"])
                for at in row["repeats"] or ():
                    faults[at] = "d"
                own = Messages(row["roles"], [], row["counts"], "".join(faults))
                codes = [code for code, *_ in own.items()]
                yield row | {"faults": own.faults, "codes": codes, "matrix": matrix(codes)}

        return written(({name: row[name] for name in schema.names} for row in found()), schema)

    slim = stage(slim.mapInArrow(to_matrix, f"conv_id {kind}, part int, block int, faults string, codes array<string>, matrix array<double>"))

    def to_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vector behind each block of a conversation, the last block first."""
        schema, batches = schema_of(batches, [*places, ("end", pa.list_(pa.float64())), ("last", pa.bool_())])

        def found() -> Iterator[dict]:
            begun, conv, vector = False, None, END
            for row in each_row(batches):
                last = not begun or row["conv_id"] != conv
                begun, conv, vector = True, row["conv_id"], END if last else vector
                yield {"conv_id": conv, "part": row["part"], "block": row["block"], "end": list(vector), "last": last}
                vector = times(row["matrix"], vector)

        return written(found(), schema, 4096)

    backward = slim.select("conv_id", "part", "block", "matrix").repartition("conv_id")
    backward = backward.sortWithinPartitions("conv_id", F.desc("part"), F.desc("block"))
    ends = stage(backward.mapInArrow(to_ends, f"conv_id {kind}, part int, block int, end array<double>, last boolean"))

    def to_exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, batches = schema_of(batches, [*places, ("exits", pa.list_(pa.int32()))])

        def found() -> Iterator[dict]:
            for row in each_row(batches, 16):
                end = tuple(row["end"])
                exits = [walk(row["codes"], end, state)[1] for state in range(4)]
                yield {name: row[name] for name in ("conv_id", "part", "block")} | {"exits": exits}

        return written(found(), schema, 4096)

    def to_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state in which the walk enters each block, the first block first."""
        schema, batches = schema_of(batches, [*places, ("entry", pa.int32())])

        def found() -> Iterator[dict]:
            begun, conv, state = False, None, 0
            for row in each_row(batches):
                state = state if begun and row["conv_id"] == conv else 0
                begun, conv = True, row["conv_id"]
                yield {name: row[name] for name in ("conv_id", "part", "block")} | {"entry": state}
                state = row["exits"][state]

        return written(found(), schema, 4096)

    exits = slim.select("conv_id", "part", "block", "codes").join(ends.drop("conv_id"), ["part", "block"])
    exits = exits.mapInArrow(to_exits, f"conv_id {kind}, part int, block int, exits array<int>")
    exits = exits.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    entries = exits.mapInArrow(to_entries, f"conv_id {kind}, part int, block int, entry int")
    known = slim.select("part", "block", "faults").join(ends.drop("conv_id"), ["part", "block"])
    known = known.join(entries.drop("conv_id"), ["part", "block"])
    full = blocks.drop("faults").join(known, ["part", "block"])
    figures = [("audit", pa.string()), ("first", pa.string()), ("final", pa.string()), *[(name, pa.int64()) for name in FIGURES]]
    turns = [("first_turn", pa.int64()), ("last_turn", pa.int64()), ("turns", pa.int64())]

    def to_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each block gives: its edits, its text or messages, its figures."""
        schema, batches = schema_of(batches, [*places, *figures, *turns, ("piece", pa.string()), ("messages", pa.list_(_MESSAGE))])

        def found() -> Iterator[dict]:
            for row in each_row(batches, 1):
                own = Messages(row["roles"], row["texts"], row["counts"], row["faults"])
                audit, rows, cost = own.repaired(tuple(row["end"]), row["entry"], row["last"])
                given = {"messages": as_structs(rows)} if want_messages else {"piece": lines(rows)}
                given |= own.figures() | {"cost": cost, "audit": audit, "first": own.initials[:1], "final": own.initials[-1:]}
                yield {name: row.get(name) for name in schema.names} | given

        return written(found(), schema, 16)

    fields = "audit string, first string, final string, blank long, duplicate long, truncated long, illegal long, cost long"
    fields = f"conv_id {kind}, part int, block int, {fields}, first_turn long, last_turn long, turns long, piece string, messages {MESSAGE}"
    pieces = full.mapInArrow(to_pieces, fields)
    if want_messages:
        both = whole.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("block"), "messages")
        both = both.unionByName(pieces.select("conv_id", "part", "block", "messages"))
        return both.select("conv_id", "part", "block", F.posexplode("messages").alias("at", "message")).select(
            "conv_id", "part", "block", "at", "message.*"
        )

    def to_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each conversation; its text passes a hash block by block."""
        schema, batches = schema_of(batches, _SOLVED)

        def found() -> Iterator[dict]:
            done: dict | None = None

            def closing() -> dict:
                spread = 0 if done["low"] is None else done["high"] - done["low"] + 1 - done["turns"]
                numbers = {name: done[name] for name in FIGURES}
                return numbers | {"conv_id": done["conv_id"], "gaps": spread, "audit": "".join(done["audit"]), "repaired_sha256": done["hash"].hexdigest()}

            for row in each_row(batches, 1):
                if done is None or row["conv_id"] != done["conv_id"]:
                    if done:
                        yield closing()
                    done = {"conv_id": row["conv_id"], "low": None, "high": None, "turns": 0, "audit": [], "hash": hashlib.sha256()}
                    done |= {"any": False, "final": "", **dict.fromkeys(FIGURES, 0)}
                for name in FIGURES:
                    done[name] += row[name]
                if done["final"] and row["first"]:
                    done["illegal"] += done["final"] + row["first"] not in LEGAL
                done["final"] = row["final"] or done["final"]
                if row["first_turn"] is not None:
                    done["turns"] += row["turns"] - (row["first_turn"] == done["high"])
                    done["low"] = row["first_turn"] if done["low"] is None else done["low"]
                    done["high"] = row["last_turn"]
                done["audit"].append(row["audit"])
                if row["piece"]:
                    done["hash"].update(("\n" * done["any"] + row["piece"]).encode())
                    done["any"] = True
            if done:
                yield closing()

        return written(found(), schema)

    pieces = pieces.drop("messages").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return whole.drop("messages", *[name for name, _ in _BLOCK]).unionByName(pieces.mapInArrow(to_conversations, f"conv_id {kind}, {SOLVED}"))


def audit(messages: DataFrame, copies: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per ``conv_id``: ``gaps``, counts of faults, ``cost``, ``audit`` (the edits' letters), ``repaired_sha256``.

    Messages are taken by turn, nulls first; equal turns by role, then text. A null role or text is one space, and a null
    conversation is one of its own. A role is judged by its first letter; one that is not s, u or a (or has none) cannot be
    kept. Repeated rows are repeats of a message: all but the first must go. ``copies`` names a column that says how often a row stands for itself; 0
    makes its conversation known without a message. An empty table gives no row; other columns are ignored. ``audit`` has a
    letter for each edit, so a conversation's row is as long as its messages are many; nothing else grows with it.
    """
    return solve(messages, copies, False, block_rows)


def repaired_messages(messages: DataFrame, copies: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The messages of repaired conversations: ``conv_id``, ``edit`` (K, R or I), ``role``, ``text``, in each conversation
    ordered by ``part``, ``block``, ``at``. A conversation without messages has no row. Otherwise as ``audit``."""
    return solve(messages, copies, True, block_rows)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops a row (its ``copies`` are 0), 1 empties its text, 2 takes its closing punctuation, 3 repeats it (2 copies), 4
    makes its role user. Returns ``conv_id``, ``turn``, ``role``, ``text``, ``copies``.
    """
    whole = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    code = F.pmod(F.crc32(F.concat(whole["conv_id"], F.lit(":"), whole["turn"]).cast("binary")), F.lit(20))
    text = F.when(code == 1, "").when(code == 2, F.translate(whole["text"], ".!?", "")).otherwise(whole["text"])
    return conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(whole["role"]).alias("role"),
        text.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
