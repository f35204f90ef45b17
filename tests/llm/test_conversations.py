from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache
from itertools import product

import pytest
from hypothesis import given, strategies as st

from shelfledger.llm import conversations, queries
from shelfledger.llm.common import table

WHITE = " \t\n\x0b\x0c\r"
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain_damage(rows):
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        yield conv, [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)


def plain_audit(rows):
    """All figures of one conversation, by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        kept = text.strip(WHITE)
        faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(at, read, inserts):
        """Cost, letters and messages from here on; read is what the roles read so far, without whole pairs."""
        found = []
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", read):
            found.append((0, "", ()))
        if inserts < 3:
            for role in ("user", "assistant"):
                found += [then(2, "I", role, "", best(at, key, inserts + 1)) for key in follows(read, role[0])]
        if at < len(rows):
            _, role, text = rows[at]
            cost, letters, kept = best(at + 1, read, 0)
            found.append((cost + 3, "D" + letters, kept))
            if faults[at] not in ("blank", "duplicate"):
                open_end = faults[at] == "truncated"
                found += [then(open_end, "K", role, text, best(at + 1, key, 0)) for key in follows(read, role[:1])]
                for new in ("user", "assistant"):
                    found += [then(2 + open_end, "R", new, text, best(at + 1, key, 0)) for key in follows(read, new[0])]
        return min(found, key=lambda f: f[:2], default=(10**9, "", ()))

    def then(cost, letter, role, text, rest):
        return rest[0] + cost, letter + rest[1], (f"{role}:{text}", *rest[2])

    def follows(read, letter):
        """Whether roles may go on so, with whole pairs shortened to one."""
        if letter and re.fullmatch("s?(ua)*u?", read + letter) and (read + letter).count("s") <= 1:
            yield re.sub("(ua)+", "ua", read + letter)

    for at in range(len(rows), 0, -1):  # so that no call goes deep
        for read in ("", "s", "u", "su", "ua", "sua", "uau", "suau"):
            best(at, read, 0)
    cost, letters, kept = best(0, "", 0)
    turns = {turn for turn, *_ in rows if turn is not None}
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        letters,
        hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    )


def expected(rows, damage):
    grouped: dict = {}
    for conv, found in plain_damage(rows) if damage else ((r[0], [(r[1], r[2], r[3])]) for r in rows):
        grouped.setdefault(conv, []).extend(found)
    return {conv: plain_audit(found) for conv, found in grouped.items()}


def got(df):
    found = df.collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[name] for name in FIELDS) for r in found}


MESSAGE = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b!", "c", " ", "d?"]))


@given(st.lists(MESSAGE, max_size=7))
def test_edits_equal_trying_all(messages):
    block = conversations.Block()
    for turn, (role, text) in enumerate(messages):
        block.add(turn, role, text, 1)
    row = block.solved(False)
    assert tuple(row[name] for name in FIELDS) == plain_audit([(n, *m) for n, m in enumerate(messages)])


@given(st.lists(st.sampled_from("suaoSUAO-"), max_size=40), st.integers(0, 3))
def test_walk_by_checkpoints_equals_a_walk_with_all_vectors(codes, state):
    vector, behind = conversations.END, []
    for code in reversed(codes):
        behind.append(vector)
        vector = conversations.before(vector, code)[0]
    at, edits = state, []
    for code, after in zip(codes, reversed(behind), strict=True):
        found, at = conversations.tight(after, code, at)
        edits.append(found)
    assert conversations.walk(codes, conversations.END, state) == (edits, at)


@given(st.lists(st.sampled_from("suaoSUAO-"), max_size=12), st.lists(st.sampled_from("suaoSUAO-"), max_size=12))
def test_matrices_multiply_into_checkpoints(first, second):
    vector = conversations.END
    for code in reversed(second):
        vector = conversations.before(vector, code)[0]
    by_matrix = conversations.times(conversations.matrix(second), conversations.END)
    assert by_matrix == vector
    whole = conversations.times(conversations.matrix(first + second), conversations.END)
    assert conversations.times(conversations.matrix(first), by_matrix) == whole


def test_few_vectors_however_long():
    found = {conversations.END}
    while True:
        more = found | {conversations.before(v, code)[0] for v, code in product(found, "suaoSUAO-")}
        if more == found:
            break
        found = more
    assert len(found) < 500


def test_given_conversations(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_conversations(spark, folder)) == expected(rows, True)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_long_conversations_over_many_blocks(spark, partitions):
    chance = random.Random(5)
    rows = []
    for conv, size in ((1, 300), (2, 90), (3, 3), (4, 25), (None, 40)):
        for n in range(size):
            role = chance.choice(["system", "user", "assistant", "user", "assistant", "tool", None])
            rows.append((conv, chance.choice([n, n, n + 3, None]), role, chance.choice([f"t{n}.", f"t{n % 9}.", f"u{n % 40}", " ", None, "x!"])))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        whole = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows]
        assert got(conversations.audit(df, block_rows=8)) == expected(whole, False)
        assert got(conversations.audit(conversations.damaged(df), "copies", 8)) == expected(rows, True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_messages_of_repaired_conversations(spark):
    df = table(spark, "/root/testdata/sf0.001", "conversations")
    digests = {r.conv_id: r.repaired_sha256 for r in conversations.audit(df).collect()}
    found: dict = {}
    for r in sorted(conversations.repaired_messages(df).collect(), key=lambda r: (r.conv_id, r.part, r.block, r.at)):
        found.setdefault(r.conv_id, []).append(r)
    for conv, messages in found.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(m.role[0] for m in messages)) and {m.edit for m in messages} <= set("KRI")
        assert hashlib.sha256("\n".join(f"{m.role}:{m.text}" for m in messages).encode()).hexdigest() == digests[conv]


def test_odd_rows_and_empty_tables(spark):
    schema = "conv_id string, turn long, role string, text string, copies string, block int, messages string"
    more = ("z", 1, "m")
    rows = [
        ("a", 1, "user", "x.", *more), ("a", 1, "user", "x.", *more), ("a", 2, "assistant", "y" * 100_000, *more),
        (None, None, None, None, *more), ("b", None, "", "q.", *more), ("c", 5, "user", "one.", *more), ("c", 5, "assistant", "two.", *more),
    ]
    df = spark.createDataFrame(rows, schema)
    found = got(conversations.audit(df))
    whole = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows]
    assert found == expected(whole, False)
    assert found["a"][:4] == (0, 0, 1, 1) and found["a"][6] == "KDK" and found[None][6] == "D"
    assert conversations.audit(df.limit(0)).collect() == [] and conversations.repaired_messages(df.limit(0)).collect() == []
    gone = conversations.audit(df.where("conv_id = 'a'").drop("copies").selectExpr("*", "0 as copies"), "copies").collect()
    assert [(r.conv_id, r.gaps, r.cost, r.audit, r.repaired_sha256) for r in gone] == [("a", 0, 0, "", hashlib.sha256(b"").hexdigest())]
