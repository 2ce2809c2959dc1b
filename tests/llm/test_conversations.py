import hashlib
import random
import zlib

import pytest

from eventfares.llm import conversations as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def hurt(rows):
    for conv_id, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        if kind == 4:
            role = "user"
        yield from [(conv_id, turn, role, text)] * (2 if kind == 3 else 1)


def expect(rows):
    """The summary of one conversation's rows, its edits by the least pair (cost, edits) of each state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        said = text.strip(BLANK)
        faults.append("b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else "-")
        seen.add((role, text))
    best = {0: (0, ""), 3: (0, ""), 2: (2, "I"), 1: (4, "II")}
    for (_, _, role, _), fault in zip(reversed(rows), reversed(faults)):
        extra = fault == "t"
        now = {}
        for state in range(4):
            ways = [(3, "D", state)]
            if fault not in "bd":
                ways.append((2 + extra, "R", WANTED[state][1]))
                if (state, role[:1]) in STEP:
                    ways.append((int(extra), "K", STEP[state, role[:1]]))
            now[state] = min((cost + best[to][0], edit + best[to][1]) for cost, edit, to in ways)
        for _ in range(4):
            for state in range(4):
                cost, edits = now[WANTED[state][1]]
                now[state] = min(now[state], (cost + 2, "I" + edits))
        best = now
    cost, audit = best[0]
    left, state, at = [], 0, iter(rows)
    for edit in audit:
        _, _, role, text = (None, None, "", "") if edit == "I" else next(at)
        if edit != "D":
            role, state = (role, STEP[state, role[:1]]) if edit == "K" else WANTED[state]
            left.append(f"{role}:{text}")
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[faults.count(f) for f in "bdt"],
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(left).encode()).hexdigest(),
    )


def by_conversation(rows):
    found = {}
    for row in rows:
        found.setdefault(row[0], []).append(row)
    return {key: expect(rows) for key, rows in found.items()}


def made(conversations, longest, seed=5):
    pick = random.Random(seed)
    for conv_id in conversations:
        for turn in range(pick.randrange(longest + 1)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = pick.choice(["a.", "b!", "c", None, "", "\t", "\x1c", "d?  ", "long " * 30 + ".", "long " * 30 + "x."])
            yield conv_id, pick.choice([turn, turn, turn * 3, None, -turn]), role, text


def values(found):
    return {r.conv_id: tuple(r)[1:] for r in found.collect()}


def plain(rows):
    return [(i, t, " " if r is None else r, " " if x is None else x) for i, t, r, x in rows]


@pytest.mark.parametrize("segment_rows", [200, 3, 1])
def test_faults_edits_and_repairs(spark, segment_rows):
    rows = [*made([*range(60), None], 9), *made(range(100, 103), 60)]
    rows += [(200, 1, "user", "same.")] * 30 + [(201, None, None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", copies string, first int")
    found = values(c.repair(docs, segment_rows))
    assert found == by_conversation(plain(rows))
    assert any(f[5] for f in found.values())


def test_a_conversation_in_many_ranges(spark):
    """More partitions than conversations: what each range holds of one is put together."""
    rows = [*made(range(2), 150, seed=7)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        found = values(c.repair(spark.createDataFrame(rows, SCHEMA), 10))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == by_conversation(plain(rows))


def test_turns_that_are_left(spark):
    rows = [(1, 1, "user", "a."), (1, 2, "user", "b."), (2, 1, "assistant", "x"), (2, 2, "user", " ")]
    left = c.repaired_turns(spark.createDataFrame(rows, SCHEMA), 1).orderBy("conv_id", "part", "seq", "place").collect()
    assert [(r.conv_id, r.role, r.text) for r in left] == [(1, "user", "a."), (1, "assistant", "b.")]


def test_no_conversations(spark):
    assert c.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_damage(spark):
    rows = [*made([*range(300), None], 6, seed=9)]
    found = c.damage(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", copy int")).collect()
    assert sorted(map(tuple, found), key=str) == sorted(hurt(rows), key=str)


def test_the_query_on_whole_tables(spark):
    small = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = values(c.op12(spark, small))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found == {r[0]: nothing for r in rows} | by_conversation(hurt(rows))
