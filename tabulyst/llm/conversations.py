"""Conversation structure repair by Hirschberg's divide and conquer.

The rows of a conversation are edited (Delete, Insert, Keep, Rerole) at least cost until
their roles are an optional system turn and then user and assistant in turn. Four states
say what may follow: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.

Forward costs from the start and backward costs from the end meet in the middle of the
rows. Among the states with the least sum the audit-least one is crossed, and both halves are solved in the
same way: two vectors of four costs in memory, not one for each row. With
each forward cost goes the rank of its least audit among the four. This is enough to
compare audits without keeping them: an audit up to a row ends with that row's letter, so
none is the beginning of another.

A conversation of any length is spread over tasks. Rows are ordered in ranges and cut into blocks of BLOCK
rows at most; a conversation inside one block is solved there. Blocks of the others send
their four-by-four costs and ranks alone through a backward and a forward pass; the states where the vectors
meet at a block's ends make it a problem of its own, solved where the block lies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulyst.session import stage

#: Rows and characters of a block, at most (a longer row is a block of its own).
BLOCK, CHARACTERS = 4096, 1 << 20
#: Copies of one row that travel as one entry.
COPIES = 1024
#: What the edits cost, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEVER = 1 << 60

_STATES = range(4)
#: The state after a role's initial, by the state before.
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The role that a state needs next, system aside.
_NEEDS = {0: "user", 1: "user", 2: "assistant", 3: "user"}
#: Inserts that end a conversation.
_TAIL = {0: "", 1: "II", 2: "I", 3: ""}
_TAIL_COST = [INSERT * len(_TAIL[s]) for s in _STATES]
_INITIALS = "sua"
_FINE, _CUT, _GONE = 0, 1, 2


def _inserted(state: int) -> Iterator[tuple[int, str]]:
    """States that inserts lead to, with the inserts; three or more come round again."""
    word = ""
    for _ in range(3):
        yield state, word
        state, word = _AFTER[_NEEDS[state][0]][state], word + "I"


def _step(initial: str, fault: int) -> list[list[tuple[int, str] | None]]:
    """Least cost and least word (inserts, then the row's letter) between two states."""
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in _STATES]
    for s in _STATES:
        for at, word in _inserted(s):
            cost = INSERT * len(word)
            options = [(at, cost + DELETE, word + "D")]
            if fault != _GONE:
                more = cost + TRUNCATED * (fault == _CUT)
                if at in _AFTER.get(initial, {}):
                    options.append((_AFTER[initial][at], more + KEEP, word + "K"))
                options.append((_AFTER[_NEEDS[at][0]][at], more + REROLE, word + "R"))
            for to, c, w in options:
                table[s][to] = min(table[s][to] or (NEVER, ""), (c, w))
    return table


#: By row code: four initials (system, user, assistant, other) and three faults.
_STEPS = [_step((_INITIALS + "?")[code // 3], code % 3) for code in range(12)]
#: The same as moves (from, to, cost, word).
_MOVES = [[(s, t, *x) for s in _STATES for t in _STATES if (x := step[s][t])] for step in _STEPS]


def _forward(codes: bytes, start: int) -> tuple[list[int], list[int]]:
    """Least costs from ``start`` to each state over the rows, and the ranks of the least audits."""
    costs, ranks = [NEVER] * 4, [0] * 4
    costs[start] = 0
    for code in codes:
        best: list = [(NEVER, 0, "")] * 4
        for s, t, c, w in _MOVES[code]:
            if costs[s] < NEVER and (mine := (costs[s] + c, ranks[s], w)) < best[t]:
                best[t] = mine
        costs = [b[0] for b in best]
        order = sorted(_STATES, key=lambda t: best[t][1:])
        for rank, t in enumerate(order):
            ranks[t] = rank
    return costs, ranks


def _backward(codes: bytes, end: list[int]) -> list[int]:
    """Least costs from each state over the rows, given the costs after them."""
    costs = end
    for code in reversed(codes):
        before = [NEVER] * 4
        for s, t, c, _ in _MOVES[code]:
            if c + costs[t] < before[s]:
                before[s] = c + costs[t]
        costs = before
    return costs


def _crossing(costs: list[int], ranks: list[int], after: list[int]) -> int:
    return min(_STATES, key=lambda s: (min(costs[s] + after[s], NEVER), ranks[s]))


def solve(codes: bytes, start: int = 0, end: int | None = None) -> str:
    """The least audit of least cost from state ``start`` to ``end``, or to a finished
    conversation if that is None. ``codes`` are 3 * role (0 system, 1 user, 2 assistant, 3
    other) + fault (0 none, 1 truncated, 2 to be deleted)."""
    if not codes:
        return _TAIL[start] if end is None else ""
    if len(codes) == 1:
        row = _STEPS[codes[0]][start]
        if end is not None:
            return row[end][1]
        return min((row[t][0] + _TAIL_COST[t], row[t][1] + _TAIL[t]) for t in _STATES if row[t])[1]
    mid = len(codes) // 2
    last = _TAIL_COST if end is None else [0 if s == end else NEVER for s in _STATES]
    cross = _crossing(*_forward(codes[:mid], start), _backward(codes[mid:], last))
    return solve(codes[:mid], start, cross) + solve(codes[mid:], cross, end)


def apply(audit: str, rows: list[tuple[str, str]], start: int = 0) -> tuple[list[tuple[str, str, str]], int]:
    """The edited rows as (edit, role, text), and the state after them."""
    out, at, state = [], 0, start
    for edit in audit:
        if edit == "I":
            role, text = _NEEDS[state], ""
        else:
            role, text = rows[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = _NEEDS[state]
        out.append((edit, role, text))
        state = _AFTER[role[0]][state]
    return out, state


_LEGAL = ("su", "ua", "au")
_FACTS = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string"
_ROWS = "roles array<string>, texts array<string>"
_BLOCK = f"conv_id long, block long, alone boolean, codes binary, {_ROWS}, costs array<long>, ranks array<int>, {_FACTS}"
_PIECE = f"conv_id long, block long, alone boolean, audit string, cost long, {_ROWS}, {_FACTS}"
_FACT_NAMES = [f.split()[0] for f in _FACTS.split(", ")]


def _arrow(schema: str) -> pa.Schema:
    of = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
          "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, of[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _cost(codes: bytes, audit: str) -> int:
    own = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
    letters = audit.replace("I", "")
    return sum(own[e] for e in audit) + TRUNCATED * sum(c % 3 == _CUT and e != "D" for c, e in zip(codes, letters, strict=True))


class _Block:
    """Rows of one conversation, in order."""

    def __init__(self, conv_id: int | None, block: int):
        self.conv_id, self.block, self.size = conv_id, block, 0
        self.codes, self.roles, self.texts = bytearray(), [], []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.low = self.high = self.head = self.tail = None

    def add(self, row: dict, copy: int) -> None:
        fault = "blank" if row["blank"] else "duplicate" if copy or not row["first"] else "truncated" if row["truncated"] else None
        if fault:
            self.faults[fault] += 1
        initial = row["role"][:1]
        self.codes.append(3 * (_INITIALS + initial).index(initial) if initial in _INITIALS and initial else 9)
        self.codes[-1] += _GONE if fault in ("blank", "duplicate") else _CUT if fault else _FINE
        if self.head is None:
            self.head = initial
        else:
            self.illegal += self.tail + initial not in _LEGAL
        self.tail = initial
        turn = row["turn"]
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        self.roles.append(row["role"])
        self.texts.append(row["text"])
        self.size += len(row["text"])

    def facts(self) -> dict:
        return {**self.faults, **{k: getattr(self, k) for k in _FACT_NAMES[3:]}}

    def row(self, alone: bool) -> dict:
        both = [([], [])] if alone else [_forward(self.codes, s) for s in _STATES]
        return {"conv_id": self.conv_id, "block": self.block, "alone": alone, "codes": bytes(self.codes), "roles": self.roles, "texts": self.texts,
                "costs": [c for costs, _ in both for c in costs], "ranks": [r for _, ranks in both for r in ranks], **self.facts()}


def _blocks(most: int):
    """Cuts ordered rows into blocks. A conversation is alone in a block if others lie before
    and after it in the partition; the first and the last may go on in the neighbours."""
    schema = _arrow(_BLOCK)

    def cut(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, now, first, whole = TaskContext.get().partitionId() << 32, None, True, True
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for copy in range(row["copies"]):
                    if now and now.conv_id != row["conv_id"]:
                        out.append(now.row(whole and not first))
                        now, first, whole = None, False, True
                    elif now and (len(now.codes) >= most or now.size + len(row["text"]) > CHARACTERS):
                        out.append(now.row(False))
                        now, whole = None, False
                    if not now:
                        now, number = _Block(row["conv_id"], number), number + 1
                    now.add(row, copy + row["piece"])
            yield pa.RecordBatch.from_pylist(out, schema)
        if now:
            yield pa.RecordBatch.from_pylist([now.row(False)], schema)

    return cut


def _matrix(values: list) -> list[list]:
    return [values[4 * s : 4 * s + 4] for s in _STATES]


_CHAIN = "conv_id long, block long, costs array<long>, ranks array<int>, after array<long>"


def _back(batches) -> Iterator[pa.RecordBatch]:
    """Backward pass, last block first: the costs after each block."""
    conv, after, begun = None, _TAIL_COST, False
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != conv:
                conv, after, begun = row["conv_id"], _TAIL_COST, True
            out.append({**row, "after": after})
            costs = _matrix(row["costs"])
            after = [min(NEVER, *(costs[s][t] + after[t] for t in _STATES)) for s in _STATES]
        yield pa.RecordBatch.from_pylist(out, _arrow(_CHAIN))


def _ahead(batches) -> Iterator[pa.RecordBatch]:
    """Forward pass: the states in which the best audit enters and leaves each block."""
    schema = _arrow("block long, enter int, leave int")
    conv, begun = None, False
    costs, ranks, enter = [0, NEVER, NEVER, NEVER], [0] * 4, 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != conv:
                conv, begun, costs, ranks, enter = row["conv_id"], True, [0, NEVER, NEVER, NEVER], [0] * 4, 0
            c, r = _matrix(row["costs"]), _matrix(row["ranks"])
            best = [min((min(costs[s] + c[s][t], NEVER), ranks[s], r[s][t]) for s in _STATES) for t in _STATES]
            order = sorted(_STATES, key=lambda t: best[t][1:])
            costs, ranks = [b[0] for b in best], [order.index(t) for t in _STATES]
            leave = _crossing(costs, ranks, row["after"])
            out.append({"block": row["block"], "enter": enter, "leave": leave})
            enter = leave
        yield pa.RecordBatch.from_pylist(out, schema)


def _solved(batches) -> Iterator[pa.RecordBatch]:
    """Audits and edited rows of blocks whose end states are known."""
    schema = _arrow(_PIECE)
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            enter, leave = (0, None) if row["alone"] else (row["enter"], None if row["last"] else row["leave"])
            audit = solve(row["codes"], enter, leave)
            rows, _ = apply(audit, list(zip(row["roles"], row["texts"], strict=True)), enter)
            out.append({**{k: row[k] for k in ("conv_id", "block", "alone", *_FACT_NAMES)}, "audit": audit, "cost": _cost(row["codes"], audit),
                        "roles": [r for _, r, _ in rows], "texts": [t for _, _, t in rows]})
        yield pa.RecordBatch.from_pylist(out, schema)


def _spoken(name: str) -> Column:
    """A value as text; null is one space."""
    return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)


def _ordered(table: DataFrame) -> DataFrame:
    """Each distinct row once, with how often it comes and what is wrong with it, in the order of
    conversation, turn, role and text. Equal rows lie side by side in that order, and
    whether one was seen earlier needs the first turn of (conversation, role, text) alone: both
    are counted before the shuffles, by 128 bits of role and text."""
    digest = [F.xxhash64(F.lit(seed), "role", "text").alias(name) for seed, name in ((1, "h1"), (2, "h2"))]
    rows = table.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), _spoken("role"), _spoken("text")).select("*", *digest)
    earliest = rows.groupBy("conv_id", "h1", "h2").agg(F.min(F.struct(F.col("turn").isNotNull().alias("given"), "turn"))["turn"].alias("turn"))
    each = rows.withColumns({"copies": F.lit(1).cast("long"), "first": F.lit(False)})
    marked = each.unionByName(earliest.withColumn("first", F.lit(True)), allowMissingColumns=True)
    entries = marked.groupBy("conv_id", "turn", "h1", "h2").agg(
        F.sum("copies").alias("all"), F.max("first").alias("first"), F.max("role").alias("role"), F.max("text").alias("text"))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / COPIES))).alias("piece")
    pieces = entries.select("conv_id", "turn", "role", "text", "first", "all", at)
    many = F.least(F.lit(COPIES).cast("long"), F.col("all") - F.col("piece") * COPIES).alias("copies")
    blank, cut = ~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z")
    order = ["conv_id", "turn", "role", "text", "piece"]
    return pieces.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, "first", many, blank.alias("blank"), cut.alias("truncated"))


def _parts(table: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The repaired blocks of conversations that lie in one block, and those of the others."""
    blocks = stage(_ordered(table).mapInArrow(_blocks(block), _BLOCK), "blocks")
    chain = blocks.filter("not alone").select("conv_id", "block", "costs", "ranks")
    backward = chain.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc()).mapInArrow(_back, _CHAIN)
    backward = stage(backward, "backward")
    states = backward.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_ahead, "block long, enter int, leave int")
    # the last block of a conversation is the one with nothing but the end after it
    ends = backward.groupBy("conv_id").agg(F.max("block").alias("block")).select("block", F.lit(True).alias("last"))
    states = states.join(ends, "block", "left").select("block", "enter", "leave", F.coalesce("last", F.lit(False)).alias("last"))
    rest = ["conv_id", "block", "alone", "codes", "roles", "texts", *_FACT_NAMES]
    apart = blocks.filter("not alone").select(*rest).join(states, "block").mapInArrow(_solved, _PIECE)
    return blocks.filter("alone").select(*rest).mapInArrow(_solved, _PIECE), apart


def repair(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of repaired rows of a table ``conv_id, turn, role, text``: ``conv_id, block`` (in
    order), ``audit, cost, roles, texts`` (edited rows) and what was found in the block.

    Null roles and texts are one space, a null turn comes first, a null conv_id is a
    conversation of its own. Rows of one turn are ordered by role and text. A kept role has
    the initial s, u or a; others (an empty one too) are reroled or deleted. Further columns are left out. An
    empty table gives no blocks. ``block`` bounds the rows of a block.
    """
    alone, apart = _parts(table, block)
    return alone.unionByName(apart)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``conv_id, block, place, role, text``: the rows of the repaired conversations; their order
    is that of block and place."""
    both = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "x")
    return pieces.select("conv_id", "block", both).select("conv_id", "block", "place", F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _wrapped(x: int) -> int:
    """As a 64-bit number, like Spark's sums."""
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def _reported(batches) -> Iterator[pa.RecordBatch]:
    """One row for each conversation from its blocks in order; the text passes by once."""
    schema = _arrow(_REPORT)
    now, sha, audit, high, low, turns, tail, lines = None, None, [], None, None, 0, None, 0

    def done() -> dict:
        gaps = 0 if low is None else _wrapped(high - low + 1 - turns)
        return {**now, "gaps": gaps, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if now is None or now["conv_id"] != row["conv_id"]:
                if now is not None:
                    out.append(done())
                now = {"conv_id": row["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
                sha, audit, high, low, turns, tail, lines = hashlib.sha256(), [], None, None, 0, None, 0
            for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
                now[k] += row[k]
            if tail is not None:
                now["illegal"] += tail + row["head"] not in _LEGAL
            tail = row["tail"]
            if row["low"] is not None:
                turns += row["turns"] - (row["low"] == high)
                low, high = row["low"] if low is None else low, row["high"]
            audit.append(row["audit"])
            for role, text in zip(row["roles"], row["texts"], strict=True):
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([done()], schema)


def reports(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of
    each conversation that ``repair`` repairs. A check sum can't be taken in parts: the blocks
    of a conversation spread over several pass through one task in order, one at a time."""
    alone, apart = _parts(table, block)
    apart = apart.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return alone.mapInArrow(_reported, _REPORT).unionByName(apart.mapInArrow(_reported, _REPORT))


def damaged(table: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by a check sum of ``conv_id:turn``: of twenty
    rows one is dropped, one emptied, one loses its full stops, one is repeated and one
    gets the role user. Nulls are one space, but for conv_id and turn themselves."""
    kind = F.crc32(F.concat(_spoken("conv_id"), F.lit(":"), _spoken("turn"))) % 20
    rows = table.select("conv_id", "turn", _spoken("role"), _spoken("text"), kind.alias("kind")).filter("kind <> 0")
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text")
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")
    return rows.select("conv_id", "turn", role, text, times).drop("copy")


def damage_and_repair(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """The report of every conversation of ``table`` after damage; those without rows left have
    zeros, an empty audit and the check sum of nothing."""
    found = reports(damaged(table), block)
    every = table.select(F.col("conv_id").cast("long").alias("own")).distinct()
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    names = [f.split()[0] for f in _REPORT.split(", ")][1:]
    joined = every.join(found, F.col("own").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(F.col("own").alias("conv_id"), *(F.coalesce(n, F.lit(empty.get(n, 0))).alias(n) for n in names))
