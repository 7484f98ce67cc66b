"""op12 against the definition written out, with its edge cases."""

import hashlib

import numpy as np
import pytest

from feira.llm.order_minhash import BLOCK, OrderMinHash, edited, fingerprints_with_next, likeness
from feira.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, part string, kind int, after int"
MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def defined(method, text):
    """The fingerprint by its definition: count, sort, take, put back into order."""
    k = min(method.k, len(text))
    seen, units = {}, []
    for at in range(len(text) - k + 1 if k else 0):
        gram = text[at : at + k]
        value = 0
        for c in gram:
            value = (value * 0x9E3779B97F4A7C15 + mixed(ord(c) + 1)) & MASK
        number = seen[gram] = seen.get(gram, -1) + 1
        units.append(mixed((value + number * 0xD1B54A32D192ED03) & MASK))
    out = []
    for factor in map(int, method.factors):
        ranked = sorted(range(len(units)), key=lambda at: ((units[at] >> 32) * factor % (1 << 32), at))[: method.chosen]
        entry = len(ranked)
        for at in sorted(ranked):
            entry = mixed((entry * 0xD6E8FEB86659FD93 + units[at]) & MASK)
        out.append(entry >> 32)
    return np.array(out, np.uint32)


def prose(n, seed):
    draw = np.random.default_rng(seed)
    words = ["".join(draw.choice(list("abcdefghiéß漢"), draw.integers(1, 9))) for _ in range(4000)]
    return " ".join(draw.choice(words, n))


@pytest.mark.parametrize("method", [OrderMinHash(), OrderMinHash(k=3, chosen=3, entries=16), OrderMinHash(k=1, chosen=1, entries=8)])
def test_fingerprint_by_definition(method):
    for text in ["", "a", "abc", "aaaaaaaaaaaaaaaaaa", "ab" * 50, "\U0001f600é" * 9, prose(200, 1), prose(2 * BLOCK // 5, 2)]:
        assert (method.of(text) == defined(method, text)).all()


def test_likeness_follows_edits_and_order():
    method, text = OrderMinHash(entries=512), prose(800, 3)
    words = text.split(" ")
    one = likeness(method.of(text), method.of(" ".join([*words[:400], "new", *words[400:]])))
    half = likeness(method.of(text), method.of(edited(text, prose(800, 4))))
    swapped = likeness(method.of(text), method.of(" ".join([*words[400:], *words[:400]])))
    assert one > 0.95 and 0.05 < half < 0.25 and 0.3 < swapped < 0.7
    assert likeness(method.of(text), method.of(prose(800, 5))) < 0.02
    assert likeness(method.of(""), method.of("")) == 1 and likeness(method.of(""), method.of("a")) == 0


def brute(rows):
    """doc_id -> result of rows without ties, around the ring of descending ids."""
    method, rows = OrderMinHash(), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for at, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        changed = edited(text, following)
        own, theirs = method.of(text), method.of(changed)
        out[doc] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), theirs.tobytes().hex(),
            likeness(own, theirs), likeness(own, method.of(following)),
        )
    return out


def test_every_row_meets_the_next(spark):
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges of few rows, many ends
    try:
        for size in (1, 2, 40):
            rows = [(7 * k, prose(20 + k, k)) for k in range(size - 1)] + [(None, None)]
            rows += [(-3, ""), (-2, "x"), (-1, prose(200_000, 9))] if size == 40 else []
            given = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA)
            got = fingerprints_with_next(given).collect()
            assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint.hex(), r.edited_fingerprint.hex(), r.near_edited, r.near_next) for r in got} == brute(rows)
        assert fingerprints_with_next(given.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_repeated_rows_are_all_there(spark):
    rows = [(1, "one text here", "p", 1, 2)] * 50 + [(1, "another text", "p", 1, 2), (2, "two", "p", 1, 2)]
    got = fingerprints_with_next(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.n_chars for r in got) == sorted([13] * 50 + [12, 3])
    assert sum(r.near_next == 1 for r in got) >= 49


def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_fingerprints"](spark, folder).collect()}
    assert got == brute(rows)
