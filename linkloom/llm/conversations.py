"""Conversation structure repair by depth-first branch-and-bound over edits.

Edits of a conversation: keep a turn, rerole it to user or assistant, delete it,
insert an empty turn. The cheapest edits that give the roles ``(s?(ua)+)?`` are
found by a search with an explicit stack, lower bounds on the rest, an incumbent
and a table per node of the best prefix that reached it. What is searched is one
byte per turn; texts move once, to be hashed in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Costs (fixed values).
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Turns that are searched at once; longer conversations are solved in blocks of so many, for each way in and out.
BLOCK = 32

# States between edits: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ENDS = (START, ASSISTANT)
_NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
#: The role that an inserted or reroled turn takes, and the state it leads to.
_WANTED = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
#: States that may follow a state.
_REACHED = {START: {*STATES}, SYSTEM: {SYSTEM, USER, ASSISTANT}, USER: {USER, ASSISTANT}, ASSISTANT: {USER, ASSISTANT}}
_LEGAL = {"su", "ua", "au"}

# A turn to the search: its role's initial, and a fault: none, blank, duplicate or truncated.
FINE, BLANK, DUPLICATE, CUT = " bdt"
Turn = tuple[str, str]


def _least(turn: Turn) -> int:
    return DELETE if turn[1] != FINE else min(KEEP, REROLE)


def _least_of_two(x: Turn, y: Turn) -> int:
    """Least cost of two turns that follow one another: if neither goes or changes, they must be legal side by side."""
    both = _least(x) + _least(y)
    if x[1] == y[1] == FINE and x[0] + y[0] not in _LEGAL:
        return both + min(REROLE, DELETE, INSERT)
    return both


def bounds(turns: list[Turn]) -> list[int]:
    """Lower bounds on the cost of the turns from each place on, whatever comes before."""
    out = [0] * (len(turns) + 1)
    for at in range(len(turns) - 1, -1, -1):
        out[at] = _least(turns[at]) + out[at + 1]
        if at + 1 < len(turns):
            out[at] = max(out[at], _least_of_two(turns[at], turns[at + 1]) + out[at + 2])
    return out


def _edits(turns: list[Turn], at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """``(initial, cost, next place, next state)`` of the edits possible at a node, in ASCII order of their initials."""
    if at < len(turns):
        yield "D", DELETE, at + 1, state
    yield "I", INSERT, at, _WANTED[state][1]
    if at < len(turns):
        role, fault = turns[at]
        if fault in (FINE, CUT):
            more = TRUNCATED if fault == CUT else 0
            if role in _NEXT[state]:
                yield "K", KEEP + more, at + 1, _NEXT[state][role]
            yield "R", REROLE + more, at + 1, _WANTED[state][1]


def _first_guess(turns: list[Turn], start: int, ends: tuple[int, ...]) -> tuple[int, str]:
    """Some valid edits, cheap ones first, from which the search starts."""
    cost, audit, state = 0, [], start
    for role, fault in turns:
        if fault != FINE:
            cost, step = cost + DELETE, "D"
        elif role in _NEXT[state]:
            state, step = _NEXT[state][role], "K"
        else:
            cost, step, state = cost + REROLE, "R", _WANTED[state][1]
        audit.append(step)
    while state not in ends:
        cost, state = cost + INSERT, _WANTED[state][1]
        audit.append("I")
    return cost, "".join(audit)


def search(turns: list[Turn], start: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """Cheapest ``(cost, audit)`` that leads from a state to one of ``ends``, the ASCII-least audit of those; None if none does.

    Children are opened in ASCII order, so of equally dear prefixes the least
    reaches a node first, and a node is opened again only for a lower cost: at
    most (places x states x possible costs) times. Equal costs at a node mean
    that neither prefix begins the other, as each further insertion costs, so the
    lesser prefix stays the lesser with any continuation.
    """
    if not _REACHED[start] & set(ends):
        return None
    below = bounds(turns)
    best = _first_guess(turns, start, ends) if {USER, ASSISTANT} & set(ends) else None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if best is not None:
            least = cost + below[at]
            if least > best[0] or (least == best[0] and audit > best[1][: len(audit)]):
                continue
        node = (at, state)
        known = seen.get(node)
        if known is not None and known <= (cost, audit):
            continue
        seen[node] = (cost, audit)
        if at == len(turns) and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        children = [
            (to, into, cost + price, audit + step)
            for step, price, to, into in _edits(turns, at, state)
            if _REACHED[into] & set(ends)
        ]
        stack.extend(reversed(children))
    return best


Table = dict[tuple[int, int], tuple[int, str]]


def _joined(left: Table, right: Table) -> Table:
    """Best ways through two blocks, by the state before and the state after."""
    out: Table = {}
    for (a, b), (cost, audit) in left.items():
        for c in STATES:
            way = right.get((b, c))
            if way is not None:
                found = (cost + way[0], audit + way[1])
                if (a, c) not in out or found < out[a, c]:
                    out[a, c] = found
    return out


def repair(turns: list[Turn]) -> tuple[int, str]:
    """Cheapest ``(cost, audit)`` of a whole conversation.

    Blocks are searched for each way in and out and joined two by two, so a very
    long conversation takes time and memory in proportion, but for a logarithm.
    """
    if len(turns) <= BLOCK:
        return search(turns)
    heap: list[tuple[int, Table]] = []
    for at in range(0, len(turns), BLOCK):
        block = turns[at : at + BLOCK]
        table = {}
        for a in STATES if at else (START,):
            for b in STATES:
                way = search(block, a, (b,))
                if way is not None:
                    table[a, b] = way
        rank = 0
        while heap and heap[-1][0] == rank:
            table, rank = _joined(heap.pop()[1], table), rank + 1
        heap.append((rank, table))
    table = heap.pop()[1]
    while heap:
        table = _joined(heap.pop()[1], table)
    return min(table[START, b] for b in ENDS if (START, b) in table)


def apply_edits(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired ``(role, text)`` rows; ``rows`` are read as they are needed."""
    names, state = {"u": "user", "a": "assistant"}, START
    for step in audit:
        role, text = next(rows) if step != "I" else ("", "")
        if step == "D":
            continue
        if step == "K":
            state = _NEXT[state][role[:1]]
        else:
            wanted, state = _WANTED[state]
            role = names[wanted]
        yield role, text


def _or_blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` rows after the damage that ``crc32('conv_id:turn') % 20`` names; dropped rows have ``copies`` 0.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4
    makes it a user's. Nulls are one blank, but ``conv_id`` and ``turn`` stay null
    where they group and order.
    """
    fault = F.crc32(F.concat_ws(":", _or_blank("conv_id"), _or_blank("turn"))) % 20
    text = _or_blank("text")
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(_or_blank("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(rows: DataFrame) -> DataFrame:
    """Rows taken as they are, for :func:`repaired`; nulls are one blank, as in :func:`damaged`."""
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _or_blank("role").alias("role"),
        _or_blank("text").alias("text"),
        F.lit(1).alias("copies"),
    )


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Rows of sorted batches by ``key``, as a stream within a stream: no conversation is held whole."""
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead: list[dict] = []

    def same(value: object) -> Iterator[dict]:
        while True:
            row = ahead.pop() if ahead else next(rows, None)
            if row is None:
                return
            if row[key] != value:
                ahead.append(row)
                return
            yield row

    while True:
        if not ahead:
            row = next(rows, None)
            if row is None:
                return
            ahead.append(row)
        value = ahead[-1][key]
        run = same(value)
        yield value, run
        for _ in run:
            pass


def _plan_schema(key: T.DataType) -> T.StructType:
    counts = [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return T.StructType([T.StructField("conv_id", key), *counts, T.StructField("audit", T.StringType())])


def _planner(schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        arrow: pa.Schema | None = None

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal arrow
            for batch in source:
                if arrow is None:
                    numbers = [pa.field(c, pa.int64()) for c in schema.names[1:-1]]
                    arrow = pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), *numbers, pa.field("audit", pa.string())])
                yield batch

        for conv_id, rows in _runs(typed(batches), "conv_id"):
            turns: list[Turn] = []
            faults = dict.fromkeys((FINE, BLANK, DUPLICATE, CUT), 0)
            illegal, before, first, last, distinct, counted = 0, None, None, None, 0, False
            for row in rows:
                if row["fault"] is None:
                    continue
                turn, initial = row["turn"], row["initial"]
                if turn is not None and turn != last:
                    first, last, distinct = turn if first is None else first, turn, distinct + 1
                faults[row["fault"]] += 1
                turns.append((initial, row["fault"]))
                illegal += before is not None and before + initial not in _LEGAL
                before = initial
            cost, audit = repair(turns) if turns else (0, "")
            gaps = last - first + 1 - distinct if last is not None else 0
            out.append((conv_id, gaps, faults[BLANK], faults[DUPLICATE], faults[CUT], illegal, cost, audit))
            if len(out) >= 4096:
                yield flush()
        if out:
            yield flush()

    return run


def plan(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` per ``conv_id`` of damaged rows.

    Of a text only its digest, whether it is blank and how it ends are moved. Rows
    of a conversation go to one task, as its audit is one value, and are streamed
    there.
    """
    ink = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (ink == "").alias("_blank"),
        (~ink.isin(".", "!", "?")).alias("_cut"),
        F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("_copy"),
        (F.col("copies") == 0).alias("_gone"),
    )
    dealt = narrow.repartition("conv_id")
    seen = Window.partitionBy("conv_id", "role", "digest", "_gone").orderBy(F.asc_nulls_first("turn"), "_copy")
    fault = (
        F.when(F.col("_gone"), F.lit(None))
        .when(F.col("_blank"), BLANK)
        .when(F.row_number().over(seen) > 1, DUPLICATE)
        .when(F.col("_cut"), CUT)
        .otherwise(FINE)
    )
    judged = dealt.select("conv_id", "turn", "role", "digest", fault.alias("fault"))
    # Identical rows of one turn: the one that is no duplicate comes first.
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", F.col("fault") == DUPLICATE]
    ordered = judged.sortWithinPartitions(*order).select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault")
    schema = _plan_schema(rows.schema["conv_id"].dataType)
    return ordered.mapInArrow(_planner(schema), schema)


def _hasher(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict] = []
        types: dict[str, pa.DataType] = {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[c] for r in kept], types[c]) for c in names]
            kept.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                types.update({f.name: f.type for f in batch.schema}, repaired_sha256=pa.string())
                yield batch

        for _, rows in _runs(typed(batches), "conv_id"):
            head = next(rows)
            turns = ((row["_role"], row["_text"]) for row in rows for _ in range(row["_copies"]))
            digest, first = hashlib.sha256(), True
            for role, text in apply_edits(head["audit"], turns):
                digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
                first = False
            kept.append({c: head.get(c) for c in names} | {"repaired_sha256": digest.hexdigest()})
            if len(kept) >= 4096:
                yield flush()
        if kept:
            yield flush()

    return run


def repaired(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``rows (conv_id, turn, role, text, copies)``: faults, cheapest repair, digest of the result.

    Rows are taken by turn, nulls first; ties go by role, then by the digest of
    the text. A row's first fault counts: blank, duplicate (role and text seen
    earlier), truncated. Repeated input rows are duplicates. ``gaps`` ignores null
    turns. A conversation without rows has zeros, an empty audit and the hash of
    the empty string; an empty table gives an empty result. Null ``conv_id`` is a
    conversation. Other columns are not read.
    """
    audits = plan(rows)
    names = audits.columns
    kinds = [f.dataType for f in audits.schema.fields]
    heads = audits.select(
        *names, F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_turn"), F.lit(None).cast("string").alias("_role"),
        F.lit(None).cast("binary").alias("_digest"), F.lit(None).cast("string").alias("_text"), F.lit(0).alias("_copies"),
    )
    texts = rows.where("copies > 0").select(
        "conv_id", *[F.lit(None).cast(t).alias(c) for c, t in zip(names[1:], kinds[1:])], F.lit(1).alias("_kind"),
        F.col("turn").alias("_turn"), F.col("role").alias("_role"), F.unhex(F.sha2("text", 256)).alias("_digest"),
        F.col("text").alias("_text"), F.col("copies").alias("_copies"),
    )
    together = heads.unionByName(texts).repartition("conv_id")
    order = ["conv_id", "_kind", F.asc_nulls_first("_turn"), "_role", "_digest"]
    schema = T.StructType([*audits.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    return together.sortWithinPartitions(*order).mapInArrow(_hasher(schema.names), schema)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """:func:`repaired` over rows after their damage."""
    return repaired(damaged(conversations))
