"""Best-fit packing planned on the histogram of lengths.

The plan never looks at documents. Pieces are counted by length (at most
``capacity`` rows reach the driver), best-fit decreasing runs over the counts,
many equal sequences at a time, and yields slot groups: "pieces of length L
with ranks a..b stand at offset o of sequences s..s+b-a". Every piece then gets
a rank within its length and takes the slot of that rank. Ranks come
from counts per (length, bucket) and row numbers inside buckets of bounded size,
so that a length which a third of all pieces share is spread like any other.

Defined results
* NULL text is an empty text; a document without text still has its end id.
* Only documents longer than a sequence are cut; then the first piece takes the remainder.
* A NULL id is an id; repeated rows are packed as often as they occur.
* An empty table gives no pieces. Only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.common import buckets_for
from feira.llm.tokens import text_encoder

CAPACITY = 1024
RANKED_TOGETHER = 20_000


def cut_pieces(
    docs: DataFrame, definition: str, split: str, lower: bool, end_id: int,
    capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's ids and end id, cut into pieces that fit.

    ``ids`` holds little-endian unsigned 32-bit integers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # the tokenizer file, of fixed size
    id_type = docs.schema[doc_id].dataType
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(shared.value, split, lower)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, piece, start, length, ids = [], [], [], [], []
                for row, own in enumerate(encode(part.column(1).to_pylist())):
                    own += end
                    n = len(own) // 4
                    edges = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append(row)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        ids.append(own[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    schema = f"doc_id {id_type.simpleString()}, piece int, start bigint, length bigint, ids binary"
    return docs.select(doc_id, text).mapInArrow(cut, schema)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Slot groups (length, n, first sequence, offset) of a best-fit decreasing packing of the histogram.

    Within a length the groups are in rank order: the first takes ranks 0..n-1, the next goes on from there.
    """
    open_by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, n) runs
    slots: list[tuple[int, int, int, int]] = []
    sequences = 0

    def place(length: int, first: int, n: int, room: int, each: int) -> None:
        """``each`` pieces into each of ``n`` sequences that have ``room``."""
        for k in range(each):
            slots.append((length, n, first, capacity - room + k * length))
        left = room - each * length
        if left:
            open_by_room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        waiting = counts[length]
        rooms = sorted(r for r, runs in open_by_room.items() if r >= length and runs)
        for room in rooms:  # best fit: the least room that is enough; it is filled up before the next
            each = room // length
            runs = open_by_room[room]
            while waiting and runs:
                first, n = runs.pop()
                whole = min(n, waiting // each)
                if whole:
                    place(length, first, whole, room, each)
                    waiting -= whole * each
                first, n = first + whole, n - whole
                if n and waiting:
                    place(length, first, 1, room, waiting)
                    first, n, waiting = first + 1, n - 1, 0
                if n:
                    runs.append((first, n))
            if not waiting:
                break
        if waiting:
            each = capacity // length
            whole, rest = divmod(waiting, each)
            if whole:
                place(length, sequences, whole, capacity, each)
            if rest:
                place(length, sequences + whole, 1, capacity, rest)
            sequences += whole + bool(rest)
    return slots


def with_rank(pieces: DataFrame, n: int) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... within each length, without gathering a length in one task."""
    parts = buckets_for(n, RANKED_TOGETHER)
    marked = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(parts)).cast("int"))
    counts = marked.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece"))
    return (
        marked.withColumn("inside", inside)
        .join(shifts, ["length", "bucket"])
        .withColumn("rank", F.col("inside") - 1 + F.col("shift"))
        .drop("inside", "shift", "bucket")
    )


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (at least doc_id, piece, start, length) with ``sequence_id`` and ``offset``.

    Hand in a stored frame: it is read for the histogram and again for the slots.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan_slots(counts, capacity)
    lengths = np.array([s[0] for s in slots], dtype=np.int64)
    sizes = np.array([s[1] for s in slots], dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    lengths, sizes = lengths[order], sizes[order]
    firsts = np.array([s[2] for s in slots], dtype=np.int64)[order]
    offsets = np.array([s[3] for s in slots], dtype=np.int64)[order]
    # one running number over (length, rank): groups of a length follow each other
    ends = np.cumsum(sizes)
    begins = ends - sizes
    of_length = {int(x): int(begins[i]) for x, i in zip(*np.unique(lengths, return_index=True))}
    # the plan's size depends on the lengths that occur, not on the number of documents
    shared = pieces.sparkSession.sparkContext.broadcast((begins, firsts, offsets, of_length))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, firsts, offsets, of_length = shared.value
        bases = np.zeros(capacity + 1, dtype=np.int64)
        for length, base in of_length.items():
            bases[length] = base
        for batch in batches:
            if not batch.num_rows:
                continue
            at = bases[batch.column("length").to_numpy()] + batch.column("rank").to_numpy()
            group = np.searchsorted(begins, at, side="right") - 1
            own = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in own], pa.array(firsts[group] + at - begins[group]), pa.array(offsets[group])],
                names=[*own, "sequence_id", "offset"],
            )

    ranked = with_rank(pieces, sum(counts.values())).select(*pieces.columns, F.col("rank").cast("bigint").alias("rank"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(take, f"{fields}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences themselves; at most ``capacity`` ids each.

    ``packed`` carries the pieces' ``ids``.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"), "length")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return whole.select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["length"]).alias("n_tokens"),
        F.unhex(F.concat_ws("", F.transform("parts", lambda p: p["ids"]))).alias("ids"),
    )
