"""Windows that also start in a document with a smaller id: the distributed part of the two substring operators.

1. Every text is cut into runs of windows with one anchor (``windows``). Anchor keys are dealt to buckets, packed
   by Arrow batch; a bucket finds the anchors that different texts share, and answers by text.
2. Texts with shared anchors send those runs, contents included, to the bucket of the anchor. Equal windows have equal
   anchors, so all texts that hold a window meet there, and a method-specific ``matcher`` decides on the contents.
3. Covered windows return to their documents as ranges.

Equal texts are one text in 1 and 2, represented by the smallest id. What repeats inside a batch is settled in
the batch: an anchor travels once per batch, and of equal runs only the one with the smallest id, so a passage that
a third of all documents share sends one row per batch. The number of buckets follows the
size of the input.

Rows that share an id but not a text are told apart by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.llm.common import buckets_for, stored, total_of, version
from feira.llm.windows import BYTE_KEYS, anchored_runs, joined_ranges
from feira.llm.words import groups, word_keys

ANCHORS_TOGETHER = 2_500_000
RUNS_TOGETHER = 120_000
_TOKEN = np.uint64((1 << 48) - 1)


@dataclass(frozen=True)
class Kind:
    """What a window is made of."""

    words: bool
    length: int
    anchor: int
    per_byte: float  # anchors expected per byte of text


BYTES_50 = Kind(words=False, length=50, anchor=24, per_byte=0.072)
WORDS_13 = Kind(words=True, length=13, anchor=6, per_byte=0.04)

# (runs by text, contents): of each run its text, first window, windows, anchor key, and the content's bytes
Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def units_of(kind: Kind, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]:
    """(unit keys, units per text, byte range of each unit if units are words)."""
    if kind.words:
        key, start, end, counts = word_keys(texts)
        return key, counts, start, end
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return BYTE_KEYS[raw], np.array([len(t) for t in texts], dtype=np.int64), None, None


def _runs(kind: Kind, texts: list[bytes]) -> tuple[Runs, Callable[[np.ndarray], list[bytes]]]:
    """The runs of ``texts``, and a function that gives the contents of some of them."""
    units, sizes, start, end = units_of(kind, texts)
    text, first, count, key = anchored_runs(units, sizes, kind.length, kind.anchor)
    begins = np.cumsum(sizes) - sizes

    def contents(which: np.ndarray) -> list[bytes]:
        last = first[which] + count[which] + kind.length - 1
        if not kind.words:
            return [texts[t][a:b] for t, a, b in zip(text[which].tolist(), first[which].tolist(), last.tolist())]
        a, b = start[begins[text[which]] + first[which]], end[begins[text[which]] + last - 1]
        return [b" ".join(texts[t][x:y].split()) for t, x, y in zip(text[which].tolist(), a.tolist(), b.tolist())]

    return (text, first, count, key), contents


def _packed_tokens(tokens: np.ndarray) -> bytes:
    return (tokens & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (tokens >> np.uint64(32)).astype("<u2").tobytes()


def _unpacked_tokens(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    low, high = np.frombuffer(raw, dtype="<u4", count=n), np.frombuffer(raw, dtype="<u2", count=n, offset=4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def _edges(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not sorted_values.size:
        return np.zeros(1, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1], [True]]))


def _answers(names: list[bytes], owner: np.ndarray, token: np.ndarray, parts: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """Tokens by owner, packed by target: (target, digests, counts, tokens)."""
    of_name = np.array([int.from_bytes(n[:4], "little") % parts for n in names], dtype=np.int64)
    order = np.lexsort((owner, of_name[owner]))
    owner, token = owner[order], token[order]
    target = of_name[owner]
    edges = _edges(target)
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        who, counts = np.unique(owner[a:b], return_counts=True)
        out.append((int(target[a]), b"".join(names[w] for w in who), counts.astype("<u4").tobytes(), token[a:b].tobytes()))
    return out


def _posted(kind: Kind, parts: int) -> Callable:
    """Batches of (digest, text) to packed anchors: rows (bucket, digests, counts, tokens).

    Rows of buckets from ``parts`` on are answers already: anchors that texts of the batch share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index: dict[bytes, int] = {}
            of_row = np.array([index.setdefault(d, len(index)) for d in batch.column(0).to_pylist()], dtype=np.int64)
            owners, keys = [], []
            for at, held in groups(batch.column(1).to_pylist()):
                (text, _, _, key), _ = _runs(kind, held)
                owners.append(of_row[at + text])
                keys.append(key)
            owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
            if not owner.size:
                continue
            key = np.concatenate(keys)
            bucket = (key % np.uint64(parts)).astype(np.int64)
            token = (key // np.uint64(parts)) & _TOKEN
            order = np.lexsort((owner, token, bucket))
            owner, bucket, token = owner[order], bucket[order], token[order]
            fresh = np.ones(order.size, dtype=bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (token[1:] != token[:-1]) | (bucket[1:] != bucket[:-1])
            owner, bucket, token = owner[fresh], bucket[fresh], token[fresh]
            head = np.ones(owner.size, dtype=bool)
            head[1:] = (token[1:] != token[:-1]) | (bucket[1:] != bucket[:-1])
            group = np.cumsum(head) - 1
            shared = np.bincount(group)[group] > 1
            names = list(index)
            rows = [(parts + t, *rest) for t, *rest in _answers(names, owner[shared], token[shared], parts)]
            # every anchor once per bucket, by text
            owner, bucket, token = owner[head], bucket[head], token[head]
            order = np.lexsort((owner, bucket))
            owner, bucket, token = owner[order], bucket[order], token[order]
            edges = _edges(bucket)
            for a, b in zip(edges[:-1], edges[1:]):
                who, counts = np.unique(owner[a:b], return_counts=True)
                digests = b"".join(names[w] for w in who)
                rows.append((int(bucket[a]), digests, counts.astype("<u4").tobytes(), _packed_tokens(token[a:b])))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                names=["bucket", "digests", "counts", "tokens"],
            )

    return run


def _answered(parts: int) -> Callable:
    """The anchors of one bucket that different texts share, as (target, digests, counts, tokens)."""

    def run(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        found: list[tuple]
        if bucket >= parts:  # answers already
            found = [(bucket - parts, *r) for r in zip(*[rows.column(c).to_pylist() for c in ("digests", "counts", "tokens")])]
        else:
            index: dict[bytes, int] = {}
            owners, tokens = [], []
            for digests, counts, packed in zip(*[rows.column(c).to_pylist() for c in ("digests", "counts", "tokens")]):
                own = [index.setdefault(digests[at : at + 16], len(index)) for at in range(0, len(digests), 16)]
                owners.append(np.repeat(np.array(own, dtype=np.int32), np.frombuffer(counts, dtype="<u4")))
                tokens.append(_unpacked_tokens(packed))
            owner, token = np.concatenate(owners), np.concatenate(tokens)
            order = np.argsort(token)
            owner, token = owner[order], token[order]
            head = _edges(token)
            differ = np.minimum.reduceat(owner, head[:-1]) != np.maximum.reduceat(owner, head[:-1])
            shared = np.repeat(differ, np.diff(head))
            found = _answers(list(index), owner[shared], token[shared], parts)
        columns = list(zip(*found)) or [(), (), (), ()]
        return pa.table({
            "target": pa.array(columns[0], pa.int32()),
            **{n: pa.array(c, pa.binary()) for n, c in zip(("digests", "counts", "tokens"), columns[1:])},
        })

    return run


def _by_text(rows: pa.Table) -> pa.Table:
    """One target's answers to (digest, tokens), a row per text."""
    tokens: dict[bytes, list[bytes]] = {}
    for digests, counts, packed in zip(*[rows.column(c).to_pylist() for c in ("digests", "counts", "tokens")]):
        ends = (8 * np.cumsum(np.frombuffer(counts, dtype="<u4"))).tolist()
        for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
            tokens.setdefault(digests[16 * k : 16 * k + 16], []).append(packed[a:b])
    joined = [np.unique(np.frombuffer(b"".join(t), dtype="<u8")).tobytes() for t in tokens.values()]
    return pa.table({"digest": pa.array(list(tokens), pa.binary()), "tokens": pa.array(joined, pa.binary())})


def _results(
    doc: np.ndarray, ver: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray, parts: int
) -> list[tuple[int, bytes, bytes, bytes, bytes]]:
    """Ranges of the rows (doc, ver), merged and packed by target: (target, docs, vers, counts, ranges)."""
    target = ver[row].view(np.uint64) % np.uint64(parts)
    order = np.lexsort((row, target))
    row, start, end, target = row[order], start[order], end[order], target[order]
    by_row = _edges(row + target.astype(np.int64) * (len(doc) + 1))
    merged = [joined_ranges(start[a:b], end[a:b]) for a, b in zip(by_row[:-1], by_row[1:])]
    heads = by_row[:-1]
    out = []
    by_target = _edges(target[heads])
    for a, b in zip(by_target[:-1], by_target[1:]):
        own = row[heads[a:b]]
        out.append((
            int(target[heads[a]]), doc[own].astype("<i8").tobytes(), ver[own].astype("<i8").tobytes(),
            np.array([len(m[0]) for m in merged[a:b]], dtype="<u4").tobytes(),
            b"".join(np.column_stack(m).astype("<i8").tobytes() for m in merged[a:b]),
        ))
    return out


def _sent(kind: Kind, anchor_parts: int, parts: int) -> Callable:
    """Batches of (doc, ver, text, tokens) to packed runs: rows (bucket, docs, vers, who, first, sizes, content).

    Rows of buckets from ``parts`` on are results already: ranges covered by equal runs of the batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, ver = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            wanted = batch.column(3).to_pylist()
            held_runs, held_content = [], []
            for at, held in groups(batch.column(2).to_pylist()):
                (text, first, count, key), contents = _runs(kind, held)
                token = (key // np.uint64(anchor_parts)) & _TOKEN
                # tokens of a text against the answers for that text
                mine = np.zeros(text.size, dtype=bool)
                edges = np.searchsorted(text, np.arange(len(held) + 1))
                for t in range(len(held)):
                    a, b = edges[t], edges[t + 1]
                    if b > a:
                        mine[a:b] = np.isin(token[a:b], np.frombuffer(wanted[at + t], dtype="<u8"))
                which = np.flatnonzero(mine)
                held_runs.append((at + text[which], first[which], count[which], key[which]))
                held_content += contents(which)
            if not held_content:
                continue
            row, first, count, key = (np.concatenate(part) for part in zip(*held_runs))
            # of equal runs only that of the smallest id goes on
            leader: dict[bytes, int] = {}
            for k, content in enumerate(held_content):
                best = leader.setdefault(content, k)
                if doc[row[k]] < doc[row[best]]:
                    leader[content] = k
            lead = np.array([leader[c] for c in held_content], dtype=np.int64)
            settled = doc[row[lead]] < doc[row]
            goes = ~settled  # with its repeats in the same document
            done = row[settled], first[settled], (first + count + kind.length - 1)[settled]
            out = [(parts + t, *rest, None, None) for t, *rest in _results(doc, ver, *done, parts)]
            bucket = (key % np.uint64(parts)).astype(np.int64)
            which = np.flatnonzero(goes)
            which = which[np.argsort(bucket[which], kind="stable")]
            edges = _edges(bucket[which])
            for a, b in zip(edges[:-1], edges[1:]):
                some = which[a:b]
                rows, who = np.unique(row[some], return_inverse=True)
                content = [held_content[k] for k in some]
                out.append((
                    int(bucket[some[0]]), doc[rows].astype("<i8").tobytes(), ver[rows].astype("<i8").tobytes(),
                    who.astype("<i4").tobytes(), first[some].astype("<i8").tobytes(),
                    np.array([len(c) for c in content], dtype="<i4").tobytes(), b"".join(content),
                ))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                names=["bucket", "docs", "vers", "who", "first", "sizes", "content"],
            )

    return run


def _covered(kind: Kind, parts: int, matcher: Callable[[np.ndarray, list[bytes]], list[np.ndarray]]) -> Callable:
    """One bucket's runs to packed results (target, docs, vers, counts, ranges). ``matcher`` gets runs by rising id: (ids, contents), all contents
    different or of different ids, and returns the covered windows of each run."""

    def run(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        if bucket >= parts:  # results already
            return packed([(bucket - parts, *r) for r in zip(*[rows.column(c).to_pylist() for c in ("docs", "vers", "who", "first")])])
        doc, ver, first, content = [], [], [], []
        for docs, vers, who, at, sizes, joined in zip(
            *[rows.column(c).to_pylist() for c in ("docs", "vers", "who", "first", "sizes", "content")]
        ):
            w = np.frombuffer(who, dtype="<i4")
            doc.append(np.frombuffer(docs, dtype="<i8")[w])
            ver.append(np.frombuffer(vers, dtype="<i8")[w])
            first.append(np.frombuffer(at, dtype="<i8"))
            ends = np.cumsum(np.frombuffer(sizes, dtype="<i4")).tolist()
            content += [joined[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        doc, ver, first = np.concatenate(doc), np.concatenate(ver), np.concatenate(first)
        order = np.lexsort((first, ver, doc))
        doc, ver, first = doc[order], ver[order], first[order]
        content = [content[k] for k in order.tolist()]
        # an equal run of a smaller id covers all windows; only first holders go to the matcher
        holder: dict[bytes, int] = {}
        lead = np.array([holder.setdefault(c, k) for k, c in enumerate(content)], dtype=np.int64)
        windows = np.array(
            [(c.count(b" ") + 1 if kind.words else len(c)) - kind.length + 1 for c in content], dtype=np.int64
        )
        whole = doc[lead] < doc
        heads = np.flatnonzero(lead == np.arange(lead.size))
        starts, ends, owners = [first[whole]], [first[whole] + windows[whole] + kind.length - 1], [np.flatnonzero(whole)]
        hits = dict(zip(heads.tolist(), matcher(doc[heads], [content[k] for k in heads.tolist()])))
        for k in np.flatnonzero(~whole).tolist():
            hit = hits[int(lead[k])]
            if hit.size:
                starts.append(first[k] + hit)
                ends.append(first[k] + hit + kind.length)
                owners.append(np.full(hit.size, k))
        start, end, owner = np.concatenate(starts), np.concatenate(ends), np.concatenate(owners)
        opens = np.ones(doc.size, dtype=bool)
        opens[1:] = (doc[1:] != doc[:-1]) | (ver[1:] != ver[:-1])
        row, heads = np.cumsum(opens) - 1, np.flatnonzero(opens)
        return packed(_results(doc[heads], ver[heads], row[owner], start, end, parts))

    def packed(found: list[tuple]) -> pa.Table:
        columns = list(zip(*found)) or [(), (), (), (), ()]
        return pa.table({
            "target": pa.array(columns[0], pa.int32()),
            **{n: pa.array(c, pa.binary()) for n, c in zip(("docs", "vers", "counts", "ranges"), columns[1:])},
        })

    return run


def _by_doc(rows: pa.Table) -> pa.Table:
    """One target's results to (doc, ver, ranges), a row per document."""
    ranges: dict[tuple[int, int], list[bytes]] = {}
    for docs, vers, counts, packed in zip(*[rows.column(c).to_pylist() for c in ("docs", "vers", "counts", "ranges")]):
        ends = (16 * np.cumsum(np.frombuffer(counts, dtype="<u4"))).tolist()
        owners = zip(np.frombuffer(docs, dtype="<i8").tolist(), np.frombuffer(vers, dtype="<i8").tolist())
        for own, a, b in zip(owners, [0, *ends[:-1]], ends):
            ranges.setdefault(own, []).append(packed[a:b])
    return pa.table({
        "doc": pa.array([d for d, _ in ranges], pa.int64()),
        "ver": pa.array([v for _, v in ranges], pa.int64()),
        "ranges": pa.array([b"".join(r) for r in ranges.values()], pa.binary()),
    })


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def marked(
    docs: DataFrame, kind: Kind, matcher: Callable[[np.ndarray, list[bytes]], list[np.ndarray]],
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc, ver, text, ranges) of the documents with windows that start in a smaller id as well.

    ``ranges`` packs [start, end) pairs in units, which may overlap. Later copies of a whole text are not among
    them: see ``copies``.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).filter("doc is not null and text is not null")
    size = total_of(rows, F.octet_length("text"))
    anchor_parts = buckets_for(size * kind.per_byte, ANCHORS_TOGETHER)
    posted = rows.select(_digest(F.col("text")).alias("digest"), "text").mapInArrow(
        _posted(kind, anchor_parts), "bucket int, digests binary, counts binary, tokens binary"
    )
    shared = posted.groupBy("bucket").applyInArrow(
        _answered(anchor_parts), "target int, digests binary, counts binary, tokens binary"
    )
    by_text = shared.groupBy("target").applyInArrow(_by_text, "digest binary, tokens binary")
    first = rows.groupBy(_digest(F.col("text")).alias("digest")).agg(F.min(F.struct("doc", version(F.col("text")).alias("ver"))).alias("f"))
    asked = by_text.join(first, "digest").select(F.col("f.doc").alias("doc"), F.col("f.ver").alias("ver"), "tokens")
    candidates = stored(
        rows.withColumn("ver", version(F.col("text"))).join(asked, ["doc", "ver"]).select("doc", "ver", "text", "tokens"), "candidates"
    )
    parts = buckets_for(total_of(candidates, F.octet_length("tokens")) / 8, RUNS_TOGETHER)
    sent = candidates.mapInArrow(
        _sent(kind, anchor_parts, parts),
        "bucket int, docs binary, vers binary, who binary, first binary, sizes binary, content binary",
    )
    found = sent.groupBy("bucket").applyInArrow(
        _covered(kind, parts, matcher), "target int, docs binary, vers binary, counts binary, ranges binary"
    )
    by_doc = found.groupBy("target").applyInArrow(_by_doc, "doc bigint, ver bigint, ranges binary")
    return candidates.select("doc", "ver", "text").join(by_doc, ["doc", "ver"])


def cut(
    docs: DataFrame, kind: Kind, matcher: Callable[[np.ndarray, list[bytes]], list[np.ndarray]],
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Documents that lose something: (doc, ver, n_units, n_removed, spans, kept).

    ``spans`` are the maximal removed runs [start, end) in units; ``kept`` is what remains: the bytes
    joined, or the words joined by one space. Every other document stays whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, removed, spans, kept = [], [], [], []
            for content, ranges in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                raw = content.encode()
                pairs = np.frombuffer(ranges, dtype="<i8").reshape(-1, 2)
                start, end = joined_ranges(pairs[:, 0], pairs[:, 1])
                parts = raw.split() if kind.words else raw
                gaps = zip([0, *end.tolist()], [*start.tolist(), len(parts)])
                left = [parts[a:b] for a, b in gaps]
                kept.append(b" ".join([w for part in left for w in part]) if kind.words else b"".join(left))
                units.append(len(parts))
                removed.append(int((end - start).sum()))
                spans.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(units, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
                ],
                names=["doc", "ver", "n_units", "n_removed", "spans", "kept"],
            )

    schema = "doc bigint, ver bigint, n_units bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return marked(docs, kind, matcher, doc_id, text).select("doc", "ver", "text", "ranges").mapInArrow(run, schema)


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, ver): documents whose whole text is that of a smaller id."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).filter("doc is not null and text is not null")
    keyed = rows.select("doc", version(F.col("text")).alias("ver"), _digest(F.col("text")).alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    return keyed.join(first, "digest").filter("doc > first").select("doc", "ver").distinct()
