"""Repair of conversations by their cheapest edits, found by iterative-deepening A*.

A sound conversation may open with a system turn, and then alternates between user and assistant,
the assistant last. Conversations are dealt to tasks by ranges of (conversation, turn), so that no
task holds a long one; what a range holds of it is a segment or several.

Most conversations are one segment, and are searched as such. For the others each segment is searched
once for every pair of states that the role pattern may be in before and after it. The pattern has
four states, so a segment comes down to sixteen costs and the order of their edits; these say which
states the cheapest edits of the whole conversation go through, and each segment is repaired for its
own. Edits up to a segment's last row begin no other segment's edits, so the least edits of a
conversation are made of the least edits of its segments.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, batches_of, map_arrow
from eventfares.settings import keep

SEGMENT_ROWS = 64
SEGMENT_CHARS = 4 << 20
PREFIX = 64

# The contract's costs, blanks and ends of sentences.
DELETE, INSERT, REROLE, LEFT_TRUNCATED = 3, 2, 2, 1
BLANK = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")

# States of the role pattern, by what came last: nothing, system, user, assistant.
STATES = range(4)
_KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_MADE = (2, 2, 3, 2)  # after a turn of the role that the state asks for
_ROLES = {2: "user", 3: "assistant"}
CLOSING = {0: 0, 1: 2 * INSERT, 2: INSERT, 3: 0}  # what it takes to end in each state

_SEGMENTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("seq", pa.int64()),
        ("open", pa.bool_()),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
        ("faults", pa.string()),
        ("illegal", pa.int64()),
        ("turns", pa.list_(pa.int64())),  # the first, the last, and how many different ones; or none
    ]
)
_SUMMARIES = pa.schema(
    [
        ("conv_id", pa.int64()),
        *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
_FAULTS = {"blank": "b", "duplicate": "d", "truncated": "t"}


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that crc32 of `conv_id:turn` deals out, by its remainder by 20.

    0 drops a row, 1 empties its text, 2 takes out its `.!?`, 3 repeats it, 4 makes it the user's.
    A null role or text is one space, and so is a null id or turn within that name. Other columns
    are not looked at.
    """

    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(named("text"), "[.!?]", "")).otherwise(named("text"))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(named("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per conversation of `rows(conv_id, turn, role, text)`, with its faults and its repair.

    Rows come in order of turn, nulls first, and of those with equal turns by role and text. The
    first fault of a row counts: `blank` (nothing but blanks), `duplicate` (its role and text came
    earlier), `truncated` (does not end in `.!?`). `illegal` counts neighbours whose roles' initials
    are not one of `LEGAL`, `gaps` the turns missing between the least and the greatest; null turns
    are not counted. `audit` has the initials of the cheapest edits, Delete, Insert, Keep or Rerole,
    the least in ASCII of equal ones, and `cost` theirs. `repaired_sha256` is of the `role:text`
    that are left, joined by line feeds. A null role or text is one space; a null id is a
    conversation of its own. Rows equal in all columns are each a row. No rows give no rows.
    """
    return _summaries(solve(rows, segment_rows))


def repaired_turns(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """`conv_id, part, seq, place, role, text` of every turn that `repair` leaves or adds.

    `part`, `seq` and `place`, in this order, are the order of a conversation's turns.
    """
    solved = solve(rows, segment_rows).select("conv_id", "part", "seq", F.posexplode(F.arrays_zip("out_roles", "out_texts")).alias("place", "turn"))
    return solved.select("conv_id", "part", "seq", "place", F.col("turn.out_roles").alias("role"), F.col("turn.out_texts").alias("text"))


def solve(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The segments of all conversations with their edits and what those leave, written.

    `segment_rows` bounds what is searched at once, and changes no result.
    """
    segments = keep(_segments(rows, segment_rows), "segments")
    whole = segments.where("not open").withColumns({"before": F.lit(0), "after": F.lit(None).cast("int"), "closing": F.lit(0)})
    split = segments.where("open")
    chosen = keep(_chain(_costs(split)), "chosen-states")
    through = split.join(chosen, ["part", "seq"])
    return keep(_edit(whole.unionByName(through)), "repaired")


# Segments


def _segments(rows: DataFrame, segment_rows: int) -> DataFrame:
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    # Equal rows are one row until they are dealt out, however many there are.
    distinct = keep(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")), "turns")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = distinct.groupBy("conv_id", "role", "text").agg(F.min(at).alias("first"), F.count("*").alias("places")).where("places > 1")
    first = first.select(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "text")], "first")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("text") == F.col("f_text"))
    seen = F.col("first").isNotNull() & (F.col("first") != at)
    marked = distinct.join(first, same, "left").select("conv_id", "turn", "role", "text", "copies", seen.alias("seen"))
    # Ranges by the beginning of a text keep to the order of whole texts, and long texts off the driver.
    dealt = marked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, PREFIX))

    def cut(batches):
        return batches_of(_SEGMENTS, _cut(batches, segment_rows))

    return map_arrow(dealt.sortWithinPartitions("conv_id", "turn", "role", "text"), cut, _SEGMENTS)


def _cut(batches, segment_rows: int):
    """Segments of sorted rows. A conversation that is not known to be whole is open."""
    part, seq = TaskContext.get().partitionId(), 0
    held, key, first_key, pieces, started = None, None, None, 0, False

    def emit(is_open: bool):
        return held.chars, (key, part, seq, is_open, *held.columns())

    for batch in batches:
        for conv_id, turn, role, text, copies, seen in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not started or conv_id != key:
                if started:
                    yield emit(pieces > 0 or key == first_key)
                    seq += 1
                else:
                    first_key, started = conv_id, True
                held, key, pieces = _Segment(), conv_id, 0
            for copy in range(copies):
                if held.full(segment_rows):
                    yield emit(True)
                    seq, pieces, held = seq + 1, pieces + 1, _Segment(held.last_role)
                held.add(turn, role, text, seen or copy > 0)
    if started:
        yield emit(True)


class _Segment:
    def __init__(self, last_role: str | None = None):
        self.roles, self.texts, self.faults = [], [], []
        self.illegal = self.chars = self.different = 0
        self.turns: list[int] = []
        self.last_role = last_role

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.chars >= SEGMENT_CHARS

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if self.roles or self.last_role is not None:
            self.illegal += self.last_role[:1] + role[:1] not in LEGAL
        said = text.strip(BLANK)
        fault = "b" if not said else "d" if seen else "t" if said[-1] not in ENDS else "-"
        self.roles.append(role)
        self.texts.append("" if fault in "bd" else text)  # the others go in any case
        self.faults.append(fault)
        self.chars += len(self.texts[-1])
        self.last_role = role
        if turn is not None:
            self.different += not self.turns or self.turns[-1] != turn
            self.turns = [self.turns[0], turn] if self.turns else [turn, turn]

    def columns(self):
        # Turns come in order, so the first is the least.
        turns = [*self.turns, self.different] if self.turns else []
        return self.roles, self.texts, "".join(self.faults), self.illegal, turns


# The search


def cheapest(initials: list[str], faults: str, start: int, finals: dict[int, int]) -> tuple[int, str] | None:
    """The least cost of edits that lead from state `start` over all rows to one of `finals`, and
    the first such edits in ASCII order; the value of a final state is the cost of closing there.

    Depth-first search in ASCII order of the edits, within a bound that grows until a path is
    accepted. What is left to pay for the rows ahead is never less than `ahead`, and a state that
    failed with some budget is not entered again with that or less.
    """
    n = len(faults)
    bad = [f in "bd" for f in faults]
    left_over = [LEFT_TRUNCATED if f == "t" else 0 for f in faults]
    ahead = [0] * (n + 1)
    for i in reversed(range(n)):
        stay = left_over[i] + (0 if initials[i] in ("s", "u", "a") else REROLE)
        ahead[i] = ahead[i + 1] + (DELETE if bad[i] else min(DELETE, stay))
    opens = start == 0 and any(s == "s" and not b for s, b in zip(initials, bad))
    if not any(q >= 2 or q == start or q == 1 and opens for q in finals):
        return None
    failed: dict[tuple[int, int], int] = {}
    bound = ahead[0]
    while True:
        stack, path = [(0, start, bound, 0, "")], []
        while stack:
            i, state, budget, depth, edit = stack.pop()
            if budget < ahead[i] or failed.get((i, state), -1) >= budget:
                continue
            failed[i, state] = budget
            path[depth:] = edit
            if i == n:
                if finals.get(state, budget + 1) <= budget:
                    return bound, "".join(path) + "I" * (finals[state] // INSERT)
                continue
            depth, made = len(path), _MADE[state]
            if not bad[i]:
                stack.append((i + 1, made, budget - REROLE - left_over[i], depth, "R"))
                kept = _KEEPS.get((state, initials[i]))
                if kept is not None:
                    stack.append((i + 1, kept, budget - left_over[i], depth, "K"))
            stack.append((i, made, budget - INSERT, depth, "I"))
            stack.append((i + 1, state, budget - DELETE, depth, "D"))
        bound += 1


def _rows_of(batches):
    for batch in batches:
        # A row at a time, as its texts may be long.
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _initials(roles: list[str]) -> list[str]:
    return [r[:1] for r in roles]


_COSTS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("seq", pa.int64()), ("costs", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))]
)
_CHOSEN = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("closing", pa.int32())])


def _costs(segments: DataFrame) -> DataFrame:
    """For each segment and pair of states, the least cost (-1 if there is no way), and the place of
    its edits among those from the same state."""

    def rows(batches):
        for row in _rows_of(batches):
            costs, places = [], []
            for before in STATES:
                found = [cheapest(_initials(row["roles"]), row["faults"], before, {after: 0}) for after in STATES]
                order = sorted(f[1] for f in found if f)
                costs += [f[0] if f else -1 for f in found]
                places += [order.index(f[1]) if f else -1 for f in found]
            yield 0, (row["conv_id"], row["part"], row["seq"], costs, places)

    def search(batches):
        return batches_of(_COSTS, rows(batches))

    return map_arrow(segments.select("conv_id", "part", "seq", "roles", "faults"), search, _COSTS)


def _chain(costs: DataFrame) -> DataFrame:
    """The states before and after each segment of the cheapest, then least edits of a conversation.

    A conversation has a row of 32 numbers here for each `SEGMENT_ROWS` of its rows.
    """

    def choose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))
        rest = [[CLOSING[s] for s in STATES]]
        for row in reversed(rows):
            ways = [[row["costs"][4 * a + b] for b in STATES] for a in STATES]
            rest.append([min((w + r for w, r in zip(way, rest[-1]) if w >= 0 and r is not None), default=None) for way in ways])
        rest.reverse()
        out, state = [], 0
        for k, row in enumerate(rows):
            ways = [(row["places"][4 * state + b], b) for b in STATES if (c := row["costs"][4 * state + b]) >= 0 and rest[k + 1][b] is not None and c + rest[k + 1][b] == rest[k][state]]
            after = min(ways)[1]
            out.append((row["part"], row["seq"], state, after, CLOSING[after] if k == len(rows) - 1 else 0))
            state = after
        return pa.Table.from_batches([batch_of(_CHOSEN, *zip(*out))])

    return costs.groupBy("conv_id").applyInArrow(choose, "part bigint, seq bigint, before int, after int, closing int")


def _edit(segments: DataFrame) -> DataFrame:
    """Segments with `cost`, `edits`, and the roles and texts of the turns that are left."""
    schema = _SEGMENTS
    for name, kind in (("cost", pa.int64()), ("edits", pa.string()), ("out_roles", pa.list_(pa.string())), ("out_texts", pa.list_(pa.string()))):
        schema = schema.append(pa.field(name, kind))

    def rows(batches):
        for row in _rows_of(batches):
            finals = CLOSING if row["after"] is None else {row["after"]: row["closing"]}
            cost, edits = cheapest(_initials(row["roles"]), row["faults"], row["before"], finals)
            left = _apply(edits, row["roles"], row["texts"], row["before"])
            yield sum(map(len, row["texts"])), (*[row[c] for c in _SEGMENTS.names], cost, edits, *left)

    def edit(batches):
        return batches_of(schema, rows(batches))

    return map_arrow(segments.select(*_SEGMENTS.names, "before", "after", "closing"), edit, schema)


def _apply(edits: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    rows = iter(zip(roles, texts, strict=True))
    out_roles, out_texts = [], []
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = _KEEPS[state, role[:1]] if edit == "K" else _MADE[state]
        out_roles.append(role if edit == "K" else _ROLES[state])
        out_texts.append(text)
    return out_roles, out_texts


# Summaries


def _summaries(solved: DataFrame) -> DataFrame:
    """The segments of each conversation put together, in order, as they stream through a task."""
    whole = map_arrow(solved.where("not open"), _fold, _SUMMARIES)
    split = solved.where("open").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return whole.unionByName(map_arrow(split, _fold, _SUMMARIES))


def _fold(batches):
    def rows():
        key, total = None, None
        for row in _rows_of(batches):
            if total is None or row["conv_id"] != key:
                if total is not None:
                    yield total.row(key)
                key, total = row["conv_id"], _Total()
            total.add(row)
        if total is not None:
            yield total.row(key)

    return batches_of(_SUMMARIES, rows())


class _Total:
    def __init__(self):
        self.faults = dict.fromkeys("bdt-", 0)
        self.illegal = self.cost = self.different = 0
        self.least = self.last = self.last_role = None
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        for fault in self.faults:
            self.faults[fault] += row["faults"].count(fault)
        self.illegal += row["illegal"]
        # A segment that a conversation was cut at has counted that pair; one that a range ends has not.
        if self.last_role is not None and (row["part"], row["seq"]) != self.following:
            self.illegal += self.last_role[:1] + row["roles"][0][:1] not in LEGAL
        self.following = (row["part"], row["seq"] + 1)
        self.last_role = row["roles"][-1]
        if row["turns"]:
            first, last, different = row["turns"]
            self.different += different - (self.last == first)
            self.least, self.last = first if self.least is None else self.least, last
        self.cost += row["cost"]
        self.audit.append(row["edits"])
        for role, text in zip(row["out_roles"], row["out_texts"], strict=True):
            self.sha.update(f"{chr(10) * self.any}{role}:{text}".encode())
            self.any = True

    def row(self, key: int | None) -> tuple[int, tuple]:
        gaps = 0 if self.last is None else self.last - self.least + 1 - self.different
        faults = [self.faults[f] for f in _FAULTS.values()]
        audit = "".join(self.audit)
        return len(audit), (key, gaps, *faults, self.illegal, self.cost, audit, self.sha.hexdigest())


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair(damage(conversations))
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    joined = ids.join(found.withColumnRenamed("conv_id", "f_id"), F.col("conv_id").eqNullSafe(F.col("f_id")), "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
