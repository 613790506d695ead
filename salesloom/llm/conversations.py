"""Repair of conversation structure by bidirectional Dijkstra over the edit lattice (operator 13).

A repaired conversation reads ``(s?(ua)+)?`` in role initials: an optional system turn, then user
and assistant in turn, or nothing. The lattice of a conversation of m rows has the vertices (rows
consumed, what the next role may be); keeping, re-roling, deleting or inserting a turn are its
edges. One heap grows from the start, one from the accepting ends; when no path through both
heaps' tops can be as cheap as the best one met, all crossings of that cost are compared and
the least concatenated audit wins.

Two cheapest ways between the same two vertices never have one audit as the start of the other:
the longer one would hold extra insertions, each of which costs. So the least audit of a path is
made of least audits of its parts, in either direction and over any cut.

That also is how a conversation of any size is repaired. Rows are sorted by conversation and turn
over the whole cluster (a range shuffle, which spreads a long conversation too) and cut into
blocks of BLOCK rows. A conversation inside one block is solved there. For the others, the ones on a
partition's border and the long ones, each block yields the cheapest audit between each two of
its border states, side by side; a pass over the blocks (not the rows) of a conversation then
picks the cheapest chain, and the blocks write their own turns.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import Remembered, lean, stage

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
BLOCK, BLOCK_BYTES = 512, 4_000_000
OUT_BYTES = 4_000_000

# States of what was written: nothing, a system turn, a user turn, an assistant turn.
START, ENDS, STATES = 0, (0, 3), 4
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = "uuau"  # the only role of user and assistant that may follow each state
ROLE = {"u": "user", "a": "assistant"}
FAULTY = "#"  # a row that must go


# --- the lattice ----------------------------------------------------------------


def _forward(shape: str, row: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """Edges that leave a vertex: edit, cost, vertex."""
    want = NEXT[state]
    yield "I", INSERT, (row, STEP[state, want])
    if row < len(shape):
        yield "D", DELETE, (row + 1, state)
        code = shape[row]
        if code != FAULTY:
            extra, role = TRUNCATED * code.isupper(), code.lower()
            if (state, role) in STEP:
                yield "K", KEEP + extra, (row + 1, STEP[state, role])
            if role != want:
                yield "R", REROLE + extra, (row + 1, STEP[state, want])


def _backward(shape: str, row: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """Edges that enter a vertex: edit, cost, the vertex they come from."""
    into = [(before, role) for (before, role), after in STEP.items() if after == state]
    for before, role in into:
        if role in ROLE:
            yield "I", INSERT, (row, before)
    if row:
        yield "D", DELETE, (row - 1, state)
        code = shape[row - 1]
        if code != FAULTY:
            extra = TRUNCATED * code.isupper()
            for before, role in into:
                if role == code.lower():
                    yield "K", KEEP + extra, (row - 1, before)
                elif role in ROLE:
                    yield "R", REROLE + extra, (row - 1, before)


def cheapest(shape: str, start: int = START, ends: Iterable[int] = ENDS) -> tuple[int, str] | None:
    """Least cost and, of that cost, the ASCII-least audit from ``start`` to one of ``ends``.

    ``shape`` has a character per row: the role's initial (x: none that is allowed), in upper
    case if the text is truncated, or FAULTY. None if no path leads there.
    """
    m, ends = len(shape), tuple(ends)
    best = ({(0, start): (0, "")}, {(m, q): (0, "") for q in ends})
    done: tuple[set, set] = (set(), set())
    # Edges without cost only consume rows, so of equal costs fewer consumed rows come first:
    # then a vertex is final when it leaves its heap.
    heaps = ([(0, 0, 0, start)], [(0, 0, m, q) for q in ends])
    heapq.heapify(heaps[1])
    met = None
    while heaps[0] and heaps[1]:
        if met is not None and heaps[0][0][0] + heaps[1][0][0] > met:
            break
        side = heaps[1][0][:2] < heaps[0][0][:2]
        cost, _, row, state = heapq.heappop(heaps[side])
        vertex = (row, state)
        if vertex in done[side]:
            continue
        done[side].add(vertex)
        own, other = best[side], best[not side]
        if vertex in other and (met is None or cost + other[vertex][0] < met):
            met = cost + other[vertex][0]
        audit = own[vertex][1]
        for edit, price, target in (_backward if side else _forward)(shape, row, state):
            found = (cost + price, edit + audit if side else audit + edit)
            held = own.get(target)
            if held is None or found < held:
                own[target] = found
                if held is None or found[0] < held[0]:
                    at = target[0]
                    heapq.heappush(heaps[side], (found[0], m - at if side else at, *target))
            if target in other and (met is None or found[0] + other[target][0] < met):
                met = found[0] + other[target][0]
    if met is None:
        return None
    # The start and the ends are final on their side from the beginning.
    done[0].add((0, start))
    done[1].update((m, q) for q in ends)
    audits = []
    for vertex in done[0]:
        cost, audit = best[0][vertex]
        if vertex in done[1] and cost + best[1][vertex][0] == met:
            audits.append(audit + best[1][vertex][1])
        for edit, price, target in _forward(shape, *vertex):
            if target in done[1] and cost + price + best[1][target][0] == met:
                audits.append(audit + edit + best[1][target][1])
    return met, min(audits)


# Short conversations share few shapes.
_whole = Remembered(cheapest, 1 << 16)


def written(
    audit: str, state: int, shape: str, roles: list[str], texts: list[str]
) -> list[tuple[str, str]]:
    """The turns (role, text) that the edits make of the rows, from a state on."""
    turns, row = [], 0
    for edit in audit:
        if edit == "I":
            turns.append((ROLE[NEXT[state]], ""))
            state = STEP[state, NEXT[state]]
            continue
        if edit == "K":
            turns.append((roles[row], texts[row]))
            state = STEP[state, shape[row].lower()]
        elif edit == "R":
            turns.append((ROLE[NEXT[state]], texts[row]))
            state = STEP[state, NEXT[state]]
        row += 1
    return turns


def _lines(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in turns)


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- counts of a run of rows, mergeable ------------------------------------------


def _tally(turns: list, initials: list[str], faults: str) -> list:
    """[blank, duplicate, truncated, illegal, lowest turn, highest turn, distinct turns, first
    initial, last initial] of consecutive rows, whose turns ascend behind the NULLs."""
    known = [t for t in turns if t is not None]
    return [
        faults.count("b"), faults.count("d"), faults.count("t"),
        sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        known[0] if known else None, known[-1] if known else None, len(set(known)),
        initials[0], initials[-1],
    ]


def _merged(a: list | None, b: list) -> list:
    """The tally of rows followed by others; turns ascend over both, NULLs first."""
    if a is None:
        return b
    shared = a[5] is not None and a[5] == b[4]
    return [
        a[0] + b[0], a[1] + b[1], a[2] + b[2], a[3] + b[3] + (a[8] + b[7] not in LEGAL),
        b[4] if a[4] is None else a[4], a[5] if b[5] is None else b[5], a[6] + b[6] - shared,
        a[7], b[8],
    ]


def _gaps(tally: list) -> int:
    return 0 if tally[4] is None else tally[5] - tally[4] + 1 - tally[6]


# --- blocks -----------------------------------------------------------------------

BLOCKS = (
    "conv_id {id}, part long, block long, whole boolean, turns array<bigint>, shape string, "
    "faults string, roles array<string>, texts array<string>, same array<binary>"
)
REPORT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
TALLY = "tally array<bigint>, first string, last string"


def _code(role: str, fault: str) -> str:
    if fault in ("b", "d"):
        return FAULTY
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "t" else initial


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _batches(
    rows: Iterable[tuple], schema: pa.Schema, weight=lambda row: 1000
) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= OUT_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for first in range(0, batch.num_rows, 2000):
            part = batch.slice(first, 2000)
            yield from zip(*[c.to_pylist() for c in part.columns])


def _in_blocks(schema: pa.Schema, most: int):
    """Sorted rows to blocks. ``whole`` is a block that is surely all of its conversation: not
    the first or last one of the task, whose neighbours may lie in the next."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        number, held, size = 0, [], 0
        seen: set[bytes] = set()
        current, first, cut = None, True, False

        def block(last: bool) -> tuple:
            _, turns, roles, texts, faults, same = map(list, zip(*held))
            whole = not (first or last or cut)
            return (
                current[0], part, number, whole, turns,
                "".join(map(_code, roles, faults)), "".join(faults), roles, texts,
                None if whole else same,
            )

        for row in _records(batches):
            conv, _, role, text, fault, same = row
            if current is not None and (conv,) != current:
                yield block(False)
                number, held, size, seen, first, cut = number + 1, [], 0, set(), False, False
            elif held and (len(held) >= most or size >= BLOCK_BYTES):
                cut = True
                yield block(False)
                number, held, size = number + 1, [], 0
            current = (conv,)
            if fault != "b":
                if same in seen:
                    fault = "d"
                else:
                    seen.add(same)
            held.append((conv, row[1], role, text, fault, same))
            size += len(text)
        if held:
            yield block(True)

    def weight(row: tuple) -> int:
        return 200 + sum(map(len, row[8])) + 60 * len(row[8])

    return lambda batches: lean(_batches(blocks(batches), schema, weight))


def _solved(schema: pa.Schema):
    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, turns, shape, faults, roles, texts in _records(batches):
            tally = _tally(turns, [r[:1] for r in roles], faults)
            cost, audit = _whole[shape]
            lines = _lines(written(audit, START, shape, roles, texts))
            yield conv, _gaps(tally), *tally[:4], cost, audit, _hex(lines)

    return lambda batches: lean(_batches(solved(batches), schema))


# --- conversations of several blocks -------------------------------------------------


def _shape_without(shape: str, faults: str, late: list[int] | None) -> tuple[str, str]:
    """Rows at the places in ``late`` are duplicates of rows in other tasks."""
    if not late:
        return shape, faults
    gone = set(late)
    return (
        "".join(FAULTY if i in gone else c for i, c in enumerate(shape)),
        "".join("d" if i in gone else c for i, c in enumerate(faults)),
    )


def _tabled(schema: pa.Schema):
    """Per block the cheapest audits between all border states, and its tally."""

    def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, part, block, turns, shape, faults, roles, late in _records(batches):
            shape, faults = _shape_without(shape, faults, late)
            tally = _tally(turns, [r[:1] for r in roles], faults)
            ways = [cheapest(shape, a, (b,)) for a in range(STATES) for b in range(STATES)]
            yield (
                conv, part, block, [w and w[0] for w in ways], [w and w[1] for w in ways],
                tally[:7], tally[7], tally[8],
            )

    def weight(row: tuple) -> int:
        return 500 + sum(len(a or "") for a in row[4])

    return lambda batches: lean(_batches(tabled(batches), schema, weight))


class _Chain:
    """The last piece of an audit and what is before it."""

    __slots__ = ("before", "piece", "start", "cost")

    def __init__(self, before, piece: str, start: int, cost: int):
        self.before, self.piece, self.start, self.cost = before, piece, start, cost

    def precedes(self, other: _Chain) -> bool:
        """Is this audit of equal cost and length in blocks less than the other one?"""
        mine, others, a, b = [], [], self, other
        while a is not b:
            mine.append(a.piece)
            others.append(b.piece)
            a, b = a.before, b.before
        return "".join(reversed(mine)) < "".join(reversed(others))

    def pieces(self) -> list[tuple[str, int]]:
        found, at = [], self
        while at.before is not None:
            found.append((at.piece, at.start))
            at = at.before
        return found[::-1]


def _extended(ways: dict[int, _Chain], costs: list, audits: list) -> dict[int, _Chain]:
    found: dict[int, _Chain] = {}
    for a, chain in ways.items():
        for b in range(STATES):
            price = costs[a * STATES + b]
            if price is None:
                continue
            new = _Chain(chain, audits[a * STATES + b], a, chain.cost + price)
            held = found.get(b)
            if held is None or new.cost < held.cost or (
                new.cost == held.cost and new.precedes(held)
            ):
                found[b] = new
    return found


def _chained(schema: pa.Schema):
    """Blocks of each conversation in order: the audit piece of each, and the totals in the row of
    the last. A task holds the pieces of one conversation, which together are its audit."""

    def finished(conv, places: list, ways: dict[int, _Chain], tally: list) -> Iterator[tuple]:
        best = None
        for q in ENDS:
            if q in ways and (best is None or ways[q].cost < best.cost or (
                ways[q].cost == best.cost and ways[q].precedes(best)
            )):
                best = ways[q]
        pieces = best.pieces()
        for (part, block), (piece, state) in zip(places, pieces):
            last = (part, block) == places[-1]
            totals = [_gaps(tally), *tally[:4], best.cost] if last else None
            audit = "".join(p for p, _ in pieces) if last else None
            yield conv, part, block, piece, state, totals, audit

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, places, ways, tally = None, [], {}, None
        for conv, part, block, costs, audits, numbers, first, last in _records(batches):
            if current is not None and (conv,) != current:
                yield from finished(current[0], places, ways, tally)
            if (conv,) != current:
                places, ways, tally = [], {START: _Chain(None, "", START, 0)}, None
            current = (conv,)
            places.append((part, block))
            ways = _extended(ways, costs, audits)
            tally = _merged(tally, [*numbers, first, last])
        if current is not None:
            yield from finished(current[0], places, ways, tally)

    return lambda batches: lean(_batches(chained(batches), schema, lambda r: 100 + len(r[3]) + len(r[6] or "")))


def _rewritten(schema: pa.Schema):
    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, part, block, shape, faults, roles, texts, late, piece, state in _records(batches):
            shape, _ = _shape_without(shape, faults, late)
            turns = written(piece, state, shape, roles, texts)
            yield conv, part, block, [{"role": r, "text": t} for r, t in turns]

    def weight(row: tuple) -> int:
        return 200 + sum(100 + len(t["text"]) for t in row[3])

    return lambda batches: lean(_batches(rewritten(batches), schema, weight))


def _digested(schema: pa.Schema):
    """One digest per conversation over its blocks in order, of which one is held at a time."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, state, some = None, hashlib.sha256(), False
        for conv, _, _, turns in _records(batches):
            if (conv,) != current:
                if current is not None:
                    yield current[0], state.hexdigest()
                current, state, some = (conv,), hashlib.sha256(), False
            if turns:
                text = _lines([(t["role"], t["text"]) for t in turns])
                state.update((("\n" if some else "") + text).encode())
                some = True
        if current is not None:
            yield current[0], state.hexdigest()

    return lambda batches: lean(_batches(digested(batches), schema))


# --- the operator -------------------------------------------------------------------


def _arrow(kind: str, ddl: str) -> tuple[str, pa.Schema]:
    """A table layout for Spark and for Arrow; ``kind`` is the type of the conversation's id."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    layout = ddl.format(id=kind)
    return layout, to_arrow_schema(StructType.fromDDL(layout))


def _mapped(df: DataFrame, function, kind: str, ddl: str) -> DataFrame:
    layout, schema = _arrow(kind, ddl)
    return df.mapInArrow(function(schema), layout)


class Repaired:
    """What ``repair`` found.

    ``report``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256), one row per conversation that has rows. ``turns()``: the repaired turns.
    """

    def __init__(self, kind: str, blocks: DataFrame, chosen: DataFrame, open_turns: DataFrame):
        self.kind, self._blocks, self._chosen, self._open = kind, blocks, chosen, open_turns
        whole = _mapped(
            blocks.where("whole").select("conv_id", "turns", "shape", "faults", "roles", "texts"),
            _solved, kind, REPORT,
        )
        digests = _mapped(
            open_turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block"),
            _digested, kind, "conv_id {id}, repaired_sha256 string",
        )
        names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        totals = chosen.where("totals is not null").select(
            "conv_id", *[F.col("totals")[i].alias(n) for i, n in enumerate(names)], "audit"
        ).alias("t")
        several = totals.join(
            digests.alias("d"), F.col("t.conv_id").eqNullSafe(F.col("d.conv_id"))
        ).select("t.*", "repaired_sha256")
        self.report = whole.unionByName(several)

    def turns(self) -> DataFrame:
        """(conv_id, part, block, at, role, text): ordered by the three numbers."""
        solved = self._blocks.where("whole").select(
            "conv_id", "part", "block", "shape", "faults", "roles", "texts",
            F.lit(None).cast("array<int>").alias("late"),
        )
        whole = _mapped(solved, _rewritten_whole, self.kind, TURNS)
        return whole.unionByName(self._open).select(
            "conv_id", "part", "block", F.posexplode("turns").alias("at", "turn")
        ).select("conv_id", "part", "block", "at", "turn.role", "turn.text")


TURNS = "conv_id {id}, part long, block long, turns array<struct<role:string,text:string>>"


def _rewritten_whole(schema: pa.Schema):
    def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, part, block, shape, _, roles, texts, _ in _records(batches):
            turns = written(_whole[shape][1], START, shape, roles, texts)
            yield conv, part, block, [{"role": r, "text": t} for r, t in turns]

    def weight(row: tuple) -> int:
        return 200 + sum(100 + len(t["text"]) for t in row[3])

    return lambda batches: lean(_batches(audited(batches), schema, weight))


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", block_rows: int = BLOCK,
) -> Repaired:
    """Each conversation's cheapest repair; the rows are its turns, in any order.

    Rows are taken by turn (NULL first), those of one turn by role and a hash of the text; a NULL
    role or text is one space. A row counts under its first fault: blank, duplicate (role and text
    occurred earlier), truncated (does not end in '.', '!' or '?', blanks aside). Blank rows and
    duplicates go; a truncated one that stays costs extra. A role whose initial is none of s, u, a (an
    empty one too) cannot be kept as it is. NULL ids are one conversation; other columns are
    not read; an empty table gives empty results. Neither texts nor rows of a conversation meet
    in one task beyond a block; its audit, one value of the result, does. Results are the same
    for any ``block_rows``.
    """
    kind = rows.schema[conv_id].dataType.simpleString()
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    who = F.coalesce(F.col(role).cast("string"), F.lit(" "))
    taken = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        who.alias("role"), said.alias("text"),
    )
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(end == "", "b").when(F.right(end, F.lit(1)).isin(".", "!", "?"), "").otherwise("t")
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    marked = taken.withColumns({"same": same, "fault": F.when(fault == "", "k").otherwise(fault)})
    order = ["conv_id", "turn", "role", "same"]
    in_order = marked.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "turn", "role", "text", "fault", "same"
    )
    blocks = stage(_mapped(
        in_order, lambda schema: _in_blocks(schema, block_rows), kind, BLOCKS
    ), "conversation-blocks")
    several = _with_late(blocks.where("not whole"))
    tables = _mapped(
        several.select("conv_id", "part", "block", "turns", "shape", "faults", "roles", "late"),
        _tabled, kind,
        "conv_id {id}, part long, block long, costs array<bigint>, audits array<string>, " + TALLY,
    )
    chosen = stage(_mapped(
        tables.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block"), _chained, kind,
        "conv_id {id}, part long, block long, piece string, state long, totals array<bigint>, audit string",
    ), "conversation-audits")
    pieces = chosen.select("part", "block", "piece", "state")
    open_turns = _mapped(
        several.join(pieces, ["part", "block"]).select(
            "conv_id", "part", "block", "shape", "faults", "roles", "texts", "late", "piece", "state"
        ),
        _rewritten, kind, TURNS,
    )
    return Repaired(kind, blocks, chosen, open_turns)


def _with_late(open_: DataFrame) -> DataFrame:
    """Adds ``late``: the places of rows that occurred in an earlier task's part of the same
    conversation. Within a task duplicates are known already."""
    told = open_.select(
        "conv_id", "part", "block", F.posexplode(F.arrays_zip("same", F.split("faults", "").alias("fault")))
        .alias("at", "row"),
    ).where("row.fault in ('k', 't')").select("conv_id", "part", "block", "at", "row.same")
    # The combiner leaves a row per task of a text that one conversation repeats.
    first = told.groupBy("conv_id", "same").agg(
        F.min("part").alias("first"), F.max("part").alias("final")
    ).where("first < final").select(F.col("conv_id").alias("_conv"), F.col("same").alias("_same"), "first")
    late = told.join(
        first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same"))
    ).where("part > first").groupBy("part", "block").agg(F.collect_list("at").alias("late"))
    return open_.join(late, ["part", "block"], "left")


# --- the damage and the query ---------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """The conversations with about a quarter of their rows damaged, by crc32 of their place."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
        fate.alias("_fate"),
    ).where("_fate <> 0")
    text = F.when(F.col("_fate") == 1, "").when(
        F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")
    ).otherwise(F.col("text"))
    role = F.when(F.col("_fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")
    ).drop("_copy")


def report_of_all(conversations: DataFrame, found: Repaired) -> DataFrame:
    """The report with a row for every original conversation; one without rows has zeros, an empty
    audit and the digest of the empty text."""
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    joined = ids.join(found.report, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        F.col("_id").alias("conv_id"), *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(_hex(""))).alias("repaired_sha256"),
    )
