"""Conversation structure repair: the cheapest edits after which speakers take turns.

A repaired conversation is ``(s?(ua)+)?`` over the initials of its roles: nothing, or an optional system turn
and then pairs of a user and an assistant turn. Edits, one letter each: Keep, Rerole to user or assistant, Delete,
Insert an empty user or assistant turn.

Grammar in Chomsky normal form: X(p, q) derives the rows that lead the accepting automaton from state p to state q,

    X(p, q) -> X(p, r) X(r, q)        X(p, q) -> one row, after any insertions

A cell of a span holds, for each (p, q), the smallest (cost, audit). Cells are combined bottom-up by span
length: 1, 2, 4 and so on; the nonterminals name states, so every split of a span gives the same cell and one is enough.
Insertions stand before a row or at the very end; hence two audits of one span are never
prefixes of one another, and the smallest of a span stays the smallest in every longer one.

Rows are laid out by (conversation, turn, role, text) in ranges, so one conversation may hold any share of them. Tasks
cut their range into pieces of bounded size. A conversation that is one piece is repaired where it lies; the pieces
of the others (also of those at the ends of a range) meet as cells only, and go on from there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.llm.common import stored

#: (system, user, assistant turns read so far) -> state: 0 nothing, 1 a system turn, 2 an open pair, 3 closed pairs
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
STATES = range(4)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
PIECE_ROWS, PIECE_CHARS = 64, 1 << 16
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

Cell = dict[tuple[int, int], tuple[int, str]]


def _insertions() -> Cell:
    """Cheapest runs of inserted turns between any two states."""
    best: Cell = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, q), (cost, audit) in list(best.items()):
            end = STEP[q, NEXT[q]]
            grown = (cost + INSERT, audit + "I")
            best[p, end] = min(best.get((p, end), grown), grown)
    return best


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            more = right.get((r, q))
            if more is not None:
                found = (cost + more[0], audit + more[1])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


INSERTIONS = _insertions()
#: state at the end -> insertions that complete the conversation
ENDING = {q: min(INSERTIONS[q, f] for f in (0, 3) if (q, f) in INSERTIONS) for q in STATES}


@lru_cache(maxsize=64)
def leaf(symbol: str) -> Cell:
    """The cell of one row: insertions, then the row's own edit.

    Symbols: s, u, a and x (any other role) for sound rows, the capital for truncated ones, ``-`` for rows that must go.
    """
    row: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if symbol != "-":
        extra = TRUNCATED if symbol.isupper() else 0
        edits = [(symbol.lower(), extra, "K")] + [(i, extra + REROLE, "R") for i in ROLES]
        for initial, cost, letter in edits:
            for p in STATES:
                q = STEP.get((p, initial))
                if q is not None:
                    row[p, q] = min(row.get((p, q), (cost, letter)), (cost, letter))
    return joined(INSERTIONS, row)


@lru_cache(maxsize=1 << 15)
def _short(symbols: str) -> Cell:
    return _combined([leaf(s) for s in symbols])


def _combined(cells: list[Cell]) -> Cell:
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[2 * len(pairs) :]
    return cells[0]


def parse(symbols: str) -> Cell:
    """The cell of a span, bottom-up by span length; equal spans of up to eight rows are parsed once."""
    return _combined([_short(symbols[k : k + 8]) for k in range(0, len(symbols), 8)])


def best_audits(cells: list[Cell]) -> tuple[int, list[str], list[int]]:
    """(cost, audit per span, state before each span) of adjacent spans that make up one conversation."""
    to_go = [{q: ENDING[q][0] for q in STATES}]
    for cell in reversed(cells):
        costs: dict[int, int] = {}
        for (p, q), (cost, _) in cell.items():
            if q in to_go[-1]:
                costs[p] = min(costs.get(p, cost + to_go[-1][q]), cost + to_go[-1][q])
        to_go.append(costs)
    to_go.reverse()
    state, audits, states = 0, [], []
    for k, cell in enumerate(cells):
        states.append(state)
        audit, state = min(
            (audit, q)
            for (p, q), (cost, audit) in cell.items()
            if p == state and q in to_go[k + 1] and cost + to_go[k + 1][q] == to_go[k][p]
        )
        audits.append(audit)
    audits[-1] += ENDING[state][1]
    return to_go[0][0], audits, states


def replay(rows: Iterable[tuple], audit: str, state: int = 0) -> list[dict]:
    """The repaired turns of (turn, role, text) rows by their audit."""
    source, out = iter(rows), []
    for edit in audit:
        turn, role, text = (None, "", "") if edit == "I" else next(source)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else NEXT[state]
        out.append({"turn": turn, "edit": edit, "role": role if edit == "K" else ROLES[initial], "text": text})
        state = STEP[state, initial]
    return out


def faults(rows: list[tuple], again: set[int]) -> tuple[str, dict[str, int]]:
    """Symbols of adjacent rows and how many have which first fault; ``again`` holds the places of repeated rows."""
    symbols, counts = [], dict.fromkeys(["blank", "duplicate", "truncated"], 0)
    for k, (_, role, text) in enumerate(rows):
        shown = text.rstrip(BLANKS)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not shown or k in again:
            counts["duplicate" if shown else "blank"] += 1
            initial = "-"
        elif shown[-1] not in ENDS:
            counts["truncated"] += 1
            initial = initial.upper()
        symbols.append(initial)
    return "".join(symbols), counts


def repeats(rows: list[tuple]) -> set[int]:
    """Places of rows whose role and text were seen earlier."""
    seen: set = set()
    return {k for k, (_, role, text) in enumerate(rows) if (role, text) in seen or seen.add((role, text))}


def illegal_pairs(rows: list[tuple]) -> int:
    initials = [role[:1] for _, role, _ in rows]
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _gaps(turns: list) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _row_type(turn: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct([("turn", turn), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _grouped(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows as batches; a batch is also ended by its amount of text."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(t["text"]) for t in row.get("turns") or ())
        if len(held) >= size or chars >= 16 * PIECE_CHARS:
            yield _table(held, schema)
            held, chars = [], 0
    if held:
        yield _table(held, schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a sorted range; those that are whole conversations already repaired."""
    part, schema = TaskContext.get().partitionId(), None

    def plain(conv, rows, chunk):
        turns = [{"turn": t, "edit": None, "role": r, "text": x} for t, r, x in rows]
        return {"conv_id": conv, "part": part, "chunk": chunk, "closed": False, "turns": turns}

    def whole(conv, rows):
        symbols, counts = faults(rows, repeats(rows))
        cost, (audit,), _ = best_audits([parse(symbols)])
        return {
            "conv_id": conv, "part": part, "chunk": 0, "closed": True, "turns": replay(rows, audit),
            "gaps": _gaps([t for t, _, _ in rows]), **counts, "illegal": illegal_pairs(rows), "cost": cost, "audit": audit,
        }

    def pieces(batch, more):
        conv, rows, chars, chunk, first = None, [], 0, 0, True
        while batch is not None:
            for key, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and key != conv:
                    yield plain(conv, rows, chunk) if first or chunk else whole(conv, rows)
                    rows, chars, chunk, first = [], 0, 0, False
                elif rows and (len(rows) >= PIECE_ROWS or chars >= PIECE_CHARS):
                    yield plain(conv, rows, chunk)
                    rows, chars, chunk = [], 0, chunk + 1
                conv = key
                rows.append((turn, role, text))
                chars += len(text)
            batch = next(more, None)
        if rows:
            yield plain(conv, rows, chunk)

    head = next(batches, None)
    if head is None:
        return
    kinds = {f.name: f.type for f in head.schema}
    schema = pa.schema([
        ("conv_id", kinds["conv_id"]), ("part", pa.int32()), ("chunk", pa.int64()), ("closed", pa.bool_()),
        ("turns", _row_type(kinds["turn"])), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
    ])
    yield from _grouped(pieces(head, batches), schema)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cell, faults and turn numbers of each piece."""
    for batch in batches:
        out = []
        for conv, part, chunk, turns, again in zip(*(c.to_pylist() for c in batch.columns)):
            rows = [(t["turn"], t["role"], t["text"]) for t in turns]
            symbols, counts = faults(rows, set(again or ()))
            known = [t for t, _, _ in rows if t is not None]
            cell = parse(symbols)
            out.append({
                "conv_id": conv, "part": part, "chunk": chunk, **counts, "illegal": illegal_pairs(rows),
                "first": rows[0][1][:1], "last": rows[-1][1][:1], "low": min(known, default=None),
                "high": max(known, default=None), "n_turns": len(set(known)),
                "cell": [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cell.items()],
            })
        kinds = {f.name: f.type for f in batch.schema}
        turn = kinds["turns"].value_type.field("turn").type
        whole = ["blank", "duplicate", "truncated", "illegal"]
        entry = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
        schema = pa.schema([
            ("conv_id", kinds["conv_id"]), ("part", pa.int32()), ("chunk", pa.int64()), *[(c, pa.int64()) for c in whole],
            ("first", pa.string()), ("last", pa.string()), ("low", turn), ("high", turn), ("n_turns", pa.int64()),
            ("cell", pa.list_(entry)),
        ])
        yield _table(out, schema)


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and state before each piece, in order of (conversation, place); the first piece carries the report."""

    def report(conv, pieces):
        cells = [{(e["p"], e["q"]): (e["cost"], e["audit"]) for e in x["cell"]} for x in pieces]
        cost, audits, states = best_audits(cells)
        edges = list(zip(pieces, pieces[1:]))
        known = [x for x in pieces if x["low"] is not None]
        distinct = sum(x["n_turns"] for x in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        total = {c: sum(x[c] for x in pieces) for c in ("blank", "duplicate", "truncated", "illegal")}
        total["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in edges)
        total["gaps"] = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
        for k, (x, audit, state) in enumerate(zip(pieces, audits, states)):
            row = {"conv_id": conv, "part": x["part"], "chunk": x["chunk"], "piece": k, "state": state, "own": audit}
            yield {**row, **total, "cost": cost, "audit": "".join(audits)} if k == 0 else row

    def conversations(batch, more):
        conv, pieces = None, []
        while batch is not None:
            for x in batch.to_pylist():
                if pieces and x["conv_id"] != conv:
                    yield from report(conv, pieces)
                    pieces = []
                conv = x["conv_id"]
                pieces.append(x)
            batch = next(more, None)
        if pieces:
            yield from report(conv, pieces)

    head = next(batches, None)
    if head is None:
        return
    schema = pa.schema([
        ("conv_id", head.schema.field("conv_id").type), ("part", pa.int32()), ("chunk", pa.int64()), ("piece", pa.int64()),
        ("state", pa.int32()), ("own", pa.string()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
    ])
    yield from _grouped(conversations(head, batches), schema)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The source rows of a piece replaced by its repaired turns."""
    for batch in batches:
        columns = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)}
        turns = [
            replay([(t["turn"], t["role"], t["text"]) for t in rows], audit, state)
            for rows, audit, state in zip(columns["turns"], columns["own"], columns["state"])
        ]
        at = batch.schema.get_field_index("turns")
        out = batch.set_column(at, batch.schema.field(at), pa.array(turns, batch.schema.field(at).type))
        yield out.drop_columns(["own", "state"])


def _range_order(rows: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Rows with what their order needs beside the columns; equal rows are told apart, so ranges can split them."""
    keyed = rows.withColumns({
        "__head": F.substring("text", 1, 200), "__hash": F.xxhash64("text"), "__id": F.monotonically_increasing_id(),
    })
    first = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "__head", "__hash", "__id")]
    return keyed, first


def repaired_pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations of one piece, pieces of the others), both: conv_id, piece, gaps, blank, duplicate, truncated,
    illegal, cost, audit, turns (array of turn, edit, role, text). Later pieces carry no counts and no audit.

    ``rows``: conv_id, turn, role, text; other columns are ignored. NULL role or text: empty. Rows of one turn go by role,
    then by the text's first 200 characters, then by its hash; equal rows are adjacent. NULL turns come first and NULL
    conv_ids are one conversation. A conversation of which everything is deleted keeps an empty list of turns.
    """
    plain = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    types = {f.name: f.dataType.simpleString() for f in plain.schema}
    key = f"conv_id {types['conv_id']}"
    numbers = ", ".join(f"{c} bigint" for c in COUNTS)
    turns = f"turns array<struct<turn: {types['turn']}, edit: string, role: string, text: string>>"
    keyed, order = _range_order(plain)
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
    shape = f"{key}, part int, chunk bigint, closed boolean, {turns}, {numbers}, audit string"
    pieces = stored(ranged.mapInArrow(_cut, shape), "conversation-pieces")
    whole = pieces.filter("closed").select("conv_id", F.lit(0).cast("bigint").alias("piece"), *COUNTS, "audit", "turns")

    loose = pieces.filter("not closed").select("conv_id", "part", "chunk", "turns")
    place = F.struct("part", "chunk", "at")
    seen = loose.select("conv_id", "part", "chunk", F.posexplode("turns").alias("at", "t")).select(
        "conv_id", place.alias("place"), F.md5(F.concat("t.role", F.lit("\0"), "t.text")).alias("said")
    )
    firsts = seen.groupBy("conv_id", "said").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("said").alias("s"), "first")
    later = seen.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s"))).filter("place != first")
    again = later.groupBy(F.col("conv_id").alias("c"), F.col("place.part").alias("p"), F.col("place.chunk").alias("k")).agg(
        F.collect_list("place.at").alias("again")
    )
    met = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("chunk") == F.col("k"))
    marked = loose.join(again, met, "left").select("conv_id", "part", "chunk", "turns", "again")
    cells = marked.mapInArrow(
        _cells,
        f"{key}, part int, chunk bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, "
        f"last string, low {types['turn']}, high {types['turn']}, n_turns bigint, "
        "cell array<struct<p: int, q: int, cost: bigint, audit: string>>",
    )
    ordered = cells.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    audits = ordered.mapInArrow(
        _resolved, f"{key}, part int, chunk bigint, piece bigint, state int, own string, {numbers}, audit string"
    ).withColumnsRenamed({"conv_id": "c", "part": "p", "chunk": "k"})
    joined_pieces = loose.join(audits, met).select("conv_id", "piece", *COUNTS, "audit", "turns", "own", "state")
    shape = f"{key}, piece bigint, {numbers}, audit string, {turns}"
    return whole, stored(joined_pieces.mapInArrow(_replayed, shape), "conversation-repaired")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Repaired conversations, a row per piece of at most 64 source rows; see ``repaired_pieces``."""
    whole, loose = repaired_pieces(rows)
    return whole.unionByName(loose)

