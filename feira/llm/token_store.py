"""Token-id shards with a minimal perfect hash over their document keys.

File format: a folder of Parquet files whose rows are shards. Rows follow the
ascending document ids, and each holds

* ``payload``   the ids of its documents, one after the other, little-endian unsigned 32-bit
* ``keys``      its document ids in order (null flags aside), for sequential reading
* ``levels``, ``bits``  the minimal perfect hash: bit fields of falling size; a key's slot is
  the rank of its bit in the first level where it stands alone
* ``ranks``     the bits set before each block of 512, so that a rank counts inside one block only
* ``prints``    per slot a 32-bit fingerprint, which turns away keys that are not in the shard
* ``offsets``, ``lengths``  per slot where the document's ids begin in the payload and how many they are
* ``part``, ``first_id``  its range partition, and the ids before it in that partition

Documents are dealt to range partitions of the ascending id, sorted inside, and
encoded and written in one pass. Only one total per partition is ever gathered, and there are at most 20,000
partitions, larger ones for more text. Shards and row groups are small, so a reader holds a few shards at a time.

Defined results
* NULL text is empty: such a document has only its end id. A NULL document id sorts first.
* Rows that repeat a document id keep one entry each, in the order of their text; keyed access returns
  the first of them in every shard that has the key.
* An empty table writes an empty folder of shards, and reads back no rows.
* Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.llm.common import buckets_for, total_of
from feira.llm.tokens import text_encoder

SHARD_BYTES = 1 << 20
ROW_GROUP_BYTES = 4 << 20
SHARD_KEYS = 1 << 16
PARTITION_TEXT, PARTITIONS = 32 << 20, 20_000
BLOCK_BYTES = 64  # of bits that share a rank
SENT_KEYS = 100_000
GAMMA = 2  # bits per remaining key and level
SCHEMA = (
    "part int, first_id bigint, n_docs int, n_ids bigint, low bigint, high bigint, has_null boolean, payload binary, "
    "keys binary, levels array<int>, bits binary, ranks binary, prints binary, offsets binary, lengths binary"
)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well-mixed 64-bit value per key; one to one for a given seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1_000_003) >> np.uint64(32)).astype("<u4")


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Of distinct keys: level sizes in bits, all levels' bits one after the other as bytes, bits set before each block."""
    levels: list[int] = []
    fields: list[np.ndarray] = []
    left = keys
    while left.size:
        size = max(64, GAMMA * left.size)
        at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(size)
        fields.append(alone)
        left = left[~alone[at]]
    packed = np.packbits(np.concatenate(fields) if fields else np.zeros(0, dtype=bool))
    packed = np.pad(packed, (0, -packed.size % BLOCK_BYTES))
    inside = np.bitwise_count(packed.reshape(-1, BLOCK_BYTES)).sum(axis=1)
    return levels, packed, (np.cumsum(inside) - inside).astype("<u4")


def slots_of(keys: np.ndarray, levels: list[int], bits: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Each key's slot, or -1 where no level has a bit for it: a bit per level and one block, whatever the shard's size."""
    out = np.full(keys.size, -1, dtype=np.int64)
    blocks, bytes_before = bits.reshape(-1, BLOCK_BYTES), np.arange(BLOCK_BYTES)
    left, begin = np.arange(keys.size), 0
    for level, size in enumerate(levels):
        at = begin + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
        hit = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        mine, at = left[hit], at[hit]
        for some in range(0, at.size, 4096):  # a few blocks at a time
            place = at[some : some + 4096]
            block, byte = place // (8 * BLOCK_BYTES), (place >> 3) % BLOCK_BYTES
            near = blocks[block]
            whole = np.where(bytes_before < byte[:, None], np.bitwise_count(near), 0).sum(axis=1)
            part = np.bitwise_count(near[np.arange(place.size), byte] >> (8 - (place & 7)).astype(np.uint16))
            out[mine[some : some + 4096]] = ranks[block] + whole + part
        left, begin = left[~hit], begin + size
    return out


def _shard(part: int, first_id: int, keys: list, ids: list[bytes]) -> dict:
    lengths = np.array([len(x) // 4 for x in ids], dtype="<i8")
    offsets = np.cumsum(lengths) - lengths
    known = np.array([k is not None for k in keys], dtype=bool)
    values = np.array([0 if k is None else k for k in keys], dtype="<i8")
    distinct, first_row = np.unique(values[known], return_index=True)
    rows = np.flatnonzero(known)[first_row]
    levels, bits, ranks = build_hash(distinct)
    slots = slots_of(distinct, levels, bits, ranks)
    prints = np.zeros(distinct.size, dtype="<u4")
    at, size = np.zeros(distinct.size, dtype="<i8"), np.zeros(distinct.size, dtype="<i8")
    prints[slots], at[slots], size[slots] = fingerprint(distinct), offsets[rows], lengths[rows]
    return {
        "part": part, "first_id": first_id, "n_docs": len(keys), "n_ids": int(lengths.sum()),
        "low": int(distinct[0]) if distinct.size else None, "high": int(distinct[-1]) if distinct.size else None,
        "has_null": bool((~known).any()), "payload": b"".join(ids),
        "keys": known.tobytes() + values.tobytes() + lengths.tobytes(),
        "levels": levels, "bits": bits.tobytes(), "ranks": ranks.tobytes(), "prints": prints.tobytes(),
        "offsets": at.tobytes(), "lengths": size.tobytes(),
    }


ARROW = pa.schema([
    ("part", pa.int32()), ("first_id", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("low", pa.int64()),
    ("high", pa.int64()), ("has_null", pa.bool_()), ("payload", pa.binary()), ("keys", pa.binary()),
    ("levels", pa.list_(pa.int32())), ("bits", pa.binary()), ("ranks", pa.binary()), ("prints", pa.binary()), ("offsets", pa.binary()),
    ("lengths", pa.binary()),
])


def write_shards(
    docs: DataFrame, path: str, definition: str, split: str, lower: bool, end_id: int,
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Encode every text, append ``end_id``, and write the shards below ``path``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)  # the tokenizer file, of fixed size
    end = np.asarray([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    parts = min(PARTITIONS, buckets_for(total_of(rows, F.octet_length("text")), PARTITION_TEXT))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first = TaskContext.get().partitionId(), 0
        encode = text_encoder(shared.value, split, lower)
        keys: list = []
        ids: list[bytes] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                for key, own in zip(piece.column(0).to_pylist(), encode(piece.column(1).to_pylist())):
                    keys.append(key)
                    ids.append(own + end)
                    held += len(own) + 4
                    if held >= SHARD_BYTES or len(keys) >= SHARD_KEYS:
                        yield pa.RecordBatch.from_pylist([_shard(part, first, keys, ids)], schema=ARROW)
                        first += held // 4
                        keys, ids, held = [], [], 0
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, first, keys, ids)], schema=ARROW)

    ordered.mapInArrow(shards, SCHEMA).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def open_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards below ``path`` with ``first_id`` counted over all documents.

    Shards travel to Python a few at a time from here on, as a row is about ``SHARD_BYTES``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    shards = spark.read.schema(SCHEMA).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return shards.join(F.broadcast(bases), "part").withColumn("first_id", F.col("first_id") + F.col("base")).drop("base")


class Shard:
    """One shard, opened for keyed access."""

    def __init__(self, row: dict):
        self.levels = row["levels"]
        self.bits = np.frombuffer(row["bits"], dtype=np.uint8)
        self.ranks = np.frombuffer(row["ranks"], dtype="<u4")
        self.prints = np.frombuffer(row["prints"], dtype="<u4")
        self.offsets = np.frombuffer(row["offsets"], dtype="<i8")
        self.lengths = np.frombuffer(row["lengths"], dtype="<i8")
        self.payload = row["payload"]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, offset, length) of each key."""
        slots = slots_of(keys, self.levels, self.bits, self.ranks)
        found = slots >= 0
        found[found] = self.prints[slots[found]] == fingerprint(keys[found])
        at, size = np.zeros(keys.size, dtype=np.int64), np.zeros(keys.size, dtype=np.int64)
        at[found], size[found] = self.offsets[slots[found]], self.lengths[slots[found]]
        return found, at, size

    def ids(self, offset: int, length: int) -> bytes:
        return self.payload[4 * offset : 4 * (offset + length)]


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: by its key, or in order for NULL and repeated keys."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                n, shard = row["n_docs"], Shard(row)
                known = np.frombuffer(row["keys"], dtype=bool, count=n)
                keys = np.frombuffer(row["keys"], dtype="<i8", count=n, offset=n)
                lengths = np.frombuffer(row["keys"], dtype="<i8", count=n, offset=9 * n)
                in_order = np.cumsum(lengths) - lengths
                found, at, size = shard.find(keys)
                first = np.ones(n, dtype=bool)
                first[1:] = (keys[1:] != keys[:-1]) | ~known[:-1]
                keyed = known & first
                if not found[keyed].all():
                    raise ValueError("a key is missing in its shard's index")
                at, size = np.where(keyed, at, in_order), np.where(keyed, size, lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, mask=~known),
                        pa.array(row["first_id"] + at),
                        pa.array(size),
                        pa.array([shard.ids(a, m) for a, m in zip(at.tolist(), size.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    wanted = ["first_id", "n_docs", "payload", "keys", "levels", "bits", "ranks", "prints", "offsets", "lengths"]
    return shards.select(*wanted).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def look_up(shards: DataFrame, keys: Iterable[int]) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the given keys; keys that are nowhere give no row.

    Up to ``SENT_KEYS`` keys go to the shards whose range holds them; more of them are joined with the documents.
    """
    wanted = np.unique(np.array(list(keys), dtype=np.int64))
    if wanted.size > SENT_KEYS:
        asked = shards.sparkSession.createDataFrame([(int(k),) for k in wanted], "doc_id bigint")
        first = F.row_number().over(Window.partitionBy("doc_id").orderBy("start"))
        found = read_documents(shards).join(asked, "doc_id", "left_semi")
        return found.withColumn("__nth", first).filter("__nth = 1").drop("__nth")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                mine = wanted[(wanted >= row["low"]) & (wanted <= row["high"])]
                shard = Shard(row)
                found, at, size = shard.find(mine)
                mine, at, size = mine[found], at[found], size[found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mine), pa.array(row["first_id"] + at), pa.array(size),
                        pa.array([shard.ids(a, m) for a, m in zip(at.tolist(), size.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    low, high = (int(wanted[0]), int(wanted[-1])) if wanted.size else (1, 0)
    inside = shards.filter((F.col("low") <= high) & (F.col("high") >= low))
    return inside.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
