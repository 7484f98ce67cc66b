"""op11 against textbook parsing over all splits and against shortest paths, with its edge cases."""

import hashlib
import heapq
import random
import zlib

import pytest

from feira.llm import conversation_repair as repair
from feira.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, piece int, audit string, part string"
BLANK = " \t\n\x0b\x0c\r"


def textbook(symbols):
    """Cells of all spans by length over all splits, insertions closed on both sides."""
    n = len(symbols)
    chart = {(i, i + 1): repair.joined(repair.leaf(s), repair.INSERTIONS) for i, s in enumerate(symbols)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            best = {}
            for k in range(i + 1, i + size):
                for key, found in repair.joined(chart[i, k], chart[k, i + size]).items():
                    best[key] = min(best.get(key, found), found)
            chart[i, i + size] = best
    return min(chart[0, n][0, f] for f in (0, 3) if (0, f) in chart[0, n])


def cheapest(symbols):
    """Smallest (cost, audit) by a search over (row, state), no grammar involved."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(symbols) and q in (0, 3):
            return cost, audit
        if (i, q) in done:
            continue
        done.add((i, q))
        for to in "ua":
            if (q, to) in step:
                heapq.heappush(heap, (cost + 3, audit + "I", i, step[q, to]))
        if i < len(symbols):
            s = symbols[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q))
            extra = 3 if s.isupper() else 0
            if s != "-":
                if (q, s.lower()) in step:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, step[q, s.lower()]))
                for to in "ua":
                    if (q, to) in step:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, step[q, to]))


def brute(rows):
    """One conversation's result from its rows as (turn, role, text), already in order."""
    seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not text.strip(BLANK):
            counts["blank"] += 1
            initial = "-"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            initial = "-"
        elif text.rstrip(BLANK)[-1] not in ".!?":
            counts["truncated"] += 1
            initial = initial.upper()
        seen.add((role, text))
        symbols += initial
    cost, audit = cheapest(symbols)
    lines, state, source = [], 0, iter(rows)
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(source)
        if edit != "D":
            role = role if edit == "K" else "assistant" if state == 2 else "user"
            lines.append(f"{role}:{text}")
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **counts,
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(turn, role, text)] * (2 if fault == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def turns_of(spark_rows):
    """conv_id -> (report, repaired lines) from the operator's pieces."""
    out = {}
    for r in sorted(spark_rows, key=lambda r: r.piece):
        report, lines = out.setdefault(r.conv_id, ({}, []))
        lines += [f"{t.role}:{t.text}" for t in r.turns]
        if r.piece == 0:
            report.update({c: r[c] for c in (*repair.COUNTS, "audit")})
    return out


def check(spark, rows):
    got = turns_of(repair.repair_conversations(spark.createDataFrame([(*r, 9, "z", "y") for r in rows], SCHEMA)).collect())
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    assert set(got) == set(convs)
    for conv, given in convs.items():
        want = brute(in_order(given))
        report, lines = got[conv]
        assert report == {c: want[c] for c in (*repair.COUNTS, "audit")}, conv
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want["repaired_sha256"]


def test_one_split_per_span_gives_the_textbook_cell():
    draw = random.Random(5)
    for _ in range(300):
        symbols = "".join(draw.choices("suaxSUAX-", k=draw.randint(1, 9)))
        cost, audits, _ = repair.best_audits([repair.parse(symbols)])
        assert (cost, audits[0]) == textbook(symbols) == cheapest(symbols)
        at = draw.randint(0, len(symbols))
        parts = [repair.parse(s) for s in (symbols[:at], symbols[at:]) if s]
        pieced = repair.best_audits(parts)
        assert (pieced[0], "".join(pieced[1])) == (cost, audits[0])


ROLES = ["user", "assistant", "system", "tool", None, "", "usher"]
TEXTS = ["Well.", "So!", "open end", "", None, " \t", "Why?\n", "é ends.", "same."]


def some_rows(n, convs, seed):
    draw = random.Random(seed)
    return [
        (draw.choice(convs), draw.choice([None, *range(n // 2)]), draw.choice(ROLES[:3] * 4 + ROLES), draw.choice(TEXTS))
        for _ in range(n)
    ]


def test_random_conversations(spark):
    check(spark, some_rows(60, [None, *range(9)], 1) + some_rows(400, list(range(20, 80)), 2))


def test_a_conversation_in_many_pieces(spark):
    """Most rows are one conversation's; ranges and pieces cut it, results stay those of the whole."""
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = some_rows(900, [5], 3) + some_rows(100, [4, 6, 7], 4) + [(8, t, "user", "x" * 70_000 + ".") for t in range(3)]
        check(spark, rows + [(9, 1, "user", "Same.")] * 300)
        given = spark.createDataFrame([(*r, 9, "z", "y") for r in rows], SCHEMA)
        _, loose = repair.repaired_pieces(given)
        pieces = loose.filter("conv_id = 5").collect()
        assert len(pieces) >= 900 / repair.PIECE_ROWS and max(len(p.turns) for p in pieces) < 4 * repair.PIECE_ROWS
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_no_rows(spark):
    assert repair.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("own", [False, True])
def test_query_equals_brute_force(spark, folder, tmp_path, own):
    if own:
        rows = some_rows(300, [None, *range(40)], 6) + [(500 + k, k, "user", "Lost.") for k in range(40)]
        spark.createDataFrame([(*r, 1, "a", "b") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
        folder = str(tmp_path)
    convs = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        convs.setdefault(r.conv_id, []).append(tuple(r))
    got = {r.conv_id: r.asDict() for r in QUERIES["op11_conversation_repair"](spark, folder).collect()}
    assert set(got) == set(convs)
    for conv, rows in convs.items():
        assert got[conv] == {"conv_id": conv, **brute(in_order(damaged(rows)))}, conv
