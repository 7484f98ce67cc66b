"""Near duplicates by an inverted join over signature coordinates.

Every distinct shingle set gets a signature of ``COORDINATES`` minima and is posted under each
(coordinate, value) pair. Two sets are candidates when at least ``MATCHES`` of their coordinates are equal.

* Prefix: pairs that share MATCHES of n coordinates share one of any n - MATCHES + 1 of them, so a set is
  posted only under its rarest ones; a set with enough values of its own is posted nowhere.
* Skip: a posting list first meets its smallest member only (a join, no group is gathered). Lists whose
  members are then one component are skipped. The others count collisions block against block, leaving out pairs
  that are already connected; blocks have about ``BLOCK`` members at most, fewer of long texts, so no list is too long
  for a task. A member that has pairs to confirm goes on once per list and block, with its set; pairs are not written.
* Merge: a pair that shares several lists is counted in the first of them only.

Candidates are confirmed on their full shingle sets in whole numbers, then connected. At similarity 0.8 a pair misses
the match threshold with a probability of about one in a million, less above it.

Defined results
* Texts without words have an empty set, link with nothing and are their own component.
* A NULL id takes no part in linking: component NULL, kept.
* Rows that repeat an id are one document, which links wherever one of its texts does.
* Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.common import buckets_for, stored, total_of, version
from feira.llm.components import components
from feira.llm.words import groups, shingle_sets

COORDINATES = 32
MATCHES = 14
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21
ROWS_TOGETHER = 30_000
SET_BYTES_TOGETHER = 1 << 23
PARTNERS_TOGETHER = 256
MEMBER = ["c", "value", "i", "j", "own", "key", "comp", "n", "sig", "lists"]
PAIRS_TOGETHER = 1 << 17
_DRAW = np.random.default_rng(5)
_MASKS = _DRAW.integers(0, 2**63, COORDINATES, dtype=np.int64).astype(np.uint64)
_FACTORS = _DRAW.integers(0, 2**63, COORDINATES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def signature_rows(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per set, 32 bits per coordinate; zeros for empty sets."""
    out = np.zeros((len(sets), COORDINATES), dtype="<u4")
    full = [k for k, s in enumerate(sets) if s.size]
    if full:
        keys = np.concatenate([sets[k] for k in full])
        begins = np.cumsum([0, *[sets[k].size for k in full[:-1]]])
        for c in range(COORDINATES):
            x = (keys ^ _MASKS[c]) * _FACTORS[c]
            x = (x ^ (x >> np.uint64(32))) * _FACTORS[c]
            out[full, c] = np.minimum.reduceat(x, begins) >> np.uint64(32)
    return out


def signatures(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, key, sig) per row: set size, 128-bit key of the set, signature; key and sig NULL for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for _, held in groups(batch.column(1).to_pylist()):
                sets = shingle_sets(held, words)
                for found, row in zip(sets, signature_rows(sets)):
                    sizes.append(found.size)
                    keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if found.size else None)
                    sigs.append(row.tobytes() if found.size else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc", "n", "key", "sig"],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc bigint, n bigint, key binary, sig binary")


def _coordinate(sig: Column, c: Column) -> Column:
    return F.substring(sig, 1, 4) if c is None else F.substr(sig, c * 4 + 1, F.lit(4))


def postings(classes: DataFrame) -> DataFrame:
    """(c, value, key, rep, n, lists): each class under its rarest coordinates, where it meets others at all.

    ``lists`` has a bit for every coordinate under which the class is posted.
    """
    tokens = classes.select("key", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda c: _coordinate(F.col("sig"), c)
    )).alias("c", "value"))
    met = tokens.groupBy("c", "value").agg(F.count("*").alias("often")).filter("often > 1")
    ranked = tokens.join(met, ["c", "value"])
    prefix = COORDINATES - MATCHES + 1
    rare = Window.partitionBy("key").orderBy("often", "c")
    own = Window.partitionBy("key")
    # coordinates of the class's own are rarest of all: they come first and post nowhere
    posted = (
        ranked.withColumn("nth", F.row_number().over(rare))
        .withColumn("shared", F.count("*").over(own))
        .filter(F.col("nth") + (COORDINATES - F.col("shared")) <= prefix)
        .select("c", "value", "key", F.bit_or(F.expr("shiftleft(1L, c)")).over(own).alias("lists"))
    )
    return posted.join(classes.select("key", "rep", "n"), "key")


def _matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (columns 0, 1) whose signatures (columns 2, 3) agree often enough."""
    for batch in batches:
        if batch.num_rows:
            a, b = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype="<u4").reshape(-1, COORDINATES) for k in (2, 3)
            )
            yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= MATCHES))


def _size_fits(a: Column, b: Column, share: int) -> Column:
    return (F.least(a, b) * 100) >= (F.greatest(a, b) * share)


def leader_candidates(posted: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """(ka, kb): every list's smallest member with its other members, where signatures match."""
    leaders = posted.groupBy("c", "value").agg(F.min(F.struct("rep", "key", "n")).alias("l"))
    pairs = (
        posted.join(leaders, ["c", "value"])
        .filter((F.col("key") != F.col("l.key")) & _size_fits(F.col("n"), F.col("l.n"), share))
        .select(F.col("l.key").alias("ka"), F.col("key").alias("kb"))
        .distinct()
    )
    signed = pairs.join(classes.select(F.col("key").alias("ka"), F.col("sig").alias("sa")), "ka").join(
        classes.select(F.col("key").alias("kb"), F.col("sig").alias("sb")), "kb"
    )
    return signed.select("ka", "kb", "sa", "sb").mapInArrow(_matching, "ka binary, kb binary")


def _open_pairs(group: pa.Table, share: int) -> tuple[pa.Table, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """``group`` by list and block pair, and the row numbers of its pairs that are not connected, whose sizes fit and
    whose signatures match; each pair in its first common list, as many together as memory allows."""
    value = np.frombuffer(b"".join(group.column("value").to_pylist()), dtype="<u4")
    c, i, j = (group.column(name).to_numpy() for name in ("c", "i", "j"))
    order = np.lexsort((j, i, value, c))
    group, value = group.take(pa.array(order)), value[order]
    c, i, j, own, comp, n, lists = (group.column(name).to_numpy() for name in ("c", "i", "j", "own", "comp", "n", "lists"))
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), dtype="<u4").reshape(-1, COORDINATES)
    posted = (lists[:, None] >> np.arange(COORDINATES)) & 1 == 1
    opens = np.ones(c.size, dtype=bool)
    opens[1:] = (c[1:] != c[:-1]) | (value[1:] != value[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    edges = np.concatenate([np.flatnonzero(opens), [c.size]])
    # every row meets the rows behind it in its list
    behind = np.repeat(edges[1:], np.diff(edges)) - np.arange(c.size) - 1
    reach = np.cumsum(behind)

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low = 0
        while low < c.size:
            high = max(low + 1, int(np.searchsorted(reach, reach[low] - behind[low] + PAIRS_TOGETHER, side="right")))
            some = behind[low:high]
            a = np.repeat(np.arange(low, high), some)
            b = a + 1 + np.arange(a.size) - np.repeat(np.cumsum(some) - some, some)
            low = high
            # inside a block all pairs; between blocks only across
            open_ = (comp[a] != comp[b]) & ((i[a] == j[a]) | (own[a] != own[b]))
            open_ &= np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * share
            a, b = a[open_], b[open_]
            equal = sig[a] == sig[b]
            enough = equal.sum(axis=1) >= MATCHES
            a, b, equal = a[enough], b[enough], equal[enough]
            here = (equal & posted[a] & posted[b]).argmax(axis=1) == c[a]
            yield a[here], b[here]

    return group, pairs()


def _collisions(share: int) -> Callable[[pa.Table], pa.Table]:
    """Lists, or pairs of their blocks, to those of their members that have a pair to confirm there."""

    def count(group: pa.Table) -> pa.Table:
        group, pairs = _open_pairs(group.select(MEMBER), share)
        met = np.zeros(group.num_rows, dtype=bool)
        for a, b in pairs:
            met[a] = met[b] = True
        return group.filter(pa.array(met))

    return count


def block_candidates(posted: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """Members (``MEMBER``) of lists, dealt as pairs of blocks, that have pairs to confirm which are not connected yet
    (column ``comp``). A list of m members gives at most m rows for each of its blocks, however many pairs it holds."""
    mixed = stored(
        posted.groupBy("c", "value")
        .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("m"), F.sum("n").alias("size"))
        .filter("low < high")
        .select("c", "value", "m", F.ceil(F.greatest(F.col("m") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")),
        "lists",
    )
    # several lists share a task's call
    parts = buckets_for(total_of(mixed, F.col("m") * F.col("blocks")), ROWS_TOGETHER)
    rows = posted.join(mixed.drop("m"), ["c", "value"]).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = rows.join(classes.select("key", "sig"), "key").select(
        "c", "value", "key", "comp", "n", "sig", "lists", "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select(
        "c", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "key", "comp", "n", "sig", "lists",
    )
    together = F.pmod(F.xxhash64("c", "value", "i", "j"), F.lit(parts)).cast("int")
    return dealt.withColumn("part", together).groupBy("part").applyInArrow(_collisions(share), dealt.select(MEMBER).schema)


def _links(share: int) -> Callable[[pa.Table], pa.Table]:
    """Members with their full sets to confirmed links; pairs that a link found here has connected are left out."""

    def confirm(group: pa.Table) -> pa.Table:
        group, pairs = _open_pairs(group, share)
        key, comp = group.column("key").to_pylist(), group.column("comp").to_pylist()
        sets = [np.frombuffer(s, dtype="<u8") for s in group.column("keys").to_pylist()]
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        found: list[tuple[int, int]] = []
        for a, b in pairs:
            heads = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if a.size else a
            for low, high in zip(heads.tolist(), [*heads[1:].tolist(), a.size]):
                one = int(a[low])
                mine = top(comp[one])
                others = [k for k in b[low:high].tolist() if top(comp[k]) != mine]
                # so many partners at once that their sets stay within memory
                for at in range(0, len(others), PARTNERS_TOGETHER):
                    some = others[at : at + PARTNERS_TOGETHER]
                    sizes = np.array([sets[k].size for k in some])
                    joined = np.concatenate([sets[k] for k in some])
                    place = np.minimum(np.searchsorted(sets[one], joined), sets[one].size - 1)
                    shared = np.add.reduceat(sets[one][place] == joined, np.cumsum(sizes) - sizes, dtype=np.int64)
                    linked = 100 * shared >= share * (sizes + sets[one].size - shared)
                    for k in np.flatnonzero(linked).tolist():
                        x, y = top(comp[one]), top(comp[some[k]])
                        if x != y:
                            above[max(x, y)] = min(x, y)
                            found.append((one, some[k]))
        return pa.table({
            "ka": pa.array([key[x] for x, _ in found], pa.binary()), "kb": pa.array([key[y] for _, y in found], pa.binary())
        })

    return confirm


def block_links(members: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """(ka, kb): confirmed links among ``members``, enough of them to connect all that the links of a list connect."""
    parts = buckets_for(total_of(members, F.col("n") * 8), SET_BYTES_TOGETHER)
    together = F.pmod(F.xxhash64("c", "value", "i", "j"), F.lit(parts)).cast("int")
    rows = members.join(sets, "key").withColumn("part", together)
    return rows.groupBy("part").applyInArrow(_links(share), "ka binary, kb binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Pairs of ``ka``, ``kb`` with 100 * shared shingles >= share * all shingles, counted on the full sets."""
    both = pairs.join(sets.select(F.col("key").alias("ka"), F.col("keys").alias("xa")), "ka").join(
        sets.select(F.col("key").alias("kb"), F.col("keys").alias("xb")), "kb"
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for xa, xb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(xa, dtype="<u8"), np.frombuffer(xb, dtype="<u8")
                shared = np.intersect1d(a, b, assume_unique=True).size
                linked.append(100 * shared >= share * (a.size + b.size - shared))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return both.select("ka", "kb", "xa", "xb").mapInArrow(confirm, "ka binary, kb binary")


def _sets(docs: DataFrame, wanted: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """(key, keys): the full shingle sets ``wanted`` (doc, key). Texts travel once, sets not at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(1).to_pylist()
            for at, held in groups(batch.column(0).to_pylist()):
                raw = [s.tobytes() for s in shingle_sets(held, words)]
                # an id may have other texts as well
                found = [
                    (key, s) for key, s in zip(asked[at : at + len(raw)], raw)
                    if hashlib.blake2b(s, digest_size=16).digest() == key
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.binary()), pa.array([s for _, s in found], pa.binary())],
                    names=["key", "keys"],
                )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).withColumn("ver", version(F.col("text")))
    # repeated rows once; both steps are dealt by the id
    once = rows.join(wanted, "doc").groupBy("doc", "key", "ver").agg(F.first("text").alias("text"))
    return once.select("text", "key").mapInArrow(run, "key binary, keys binary")


def near_duplicates(
    docs: DataFrame, words: int = 5, share: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    ``share`` is the similarity in hundredths. ``kept`` marks the smallest id of a component.
    """
    signed = stored(signatures(docs, words, doc_id, text), "signatures")
    # equal sets are one class; a group of copies is one row from here on
    classes = stored(
        signed.filter("key is not null and doc is not null")
        .groupBy("key")
        .agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "classes",
    )
    posted = stored(postings(classes), "postings")

    def sets_of(keys: DataFrame, purpose: str) -> DataFrame:
        wanted = keys.distinct().join(classes.select("key", F.col("rep").alias("doc")), "key")
        return stored(_sets(docs, wanted, words, doc_id, text), purpose)

    def named(links: DataFrame) -> DataFrame:
        ids = classes.select("key", "rep")
        return (
            links.join(ids.select(F.col("key").alias("ka"), F.col("rep").alias("a")), "ka")
            .join(ids.select(F.col("key").alias("kb"), F.col("rep").alias("b")), "kb")
            .select("a", "b")
        )

    # texts of one id belong together
    of_id = signed.filter("key is not null and doc is not null").select("doc", "key").join(classes.select("key", "rep"), "key")
    same_id = of_id.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b")
    spread = of_id.join(same_id.select("doc", "a"), "doc").select("a", F.col("rep").alias("b"))

    led = stored(leader_candidates(posted, classes, share), "led")
    ends = led.select(F.col("ka").alias("key")).unionByName(led.select(F.col("kb").alias("key")))
    first = named(_confirmed(led, sets_of(ends, "led-sets"), share)).unionByName(spread)
    first = stored(first, "links")
    joined = components(first)
    labelled = (
        posted.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("comp", F.coalesce("component", "rep"))
        .drop("component")
    )
    members = stored(block_candidates(labelled, classes, share), "members")
    second = named(block_links(members, sets_of(members.select("key"), "member-sets"), share))
    # the first links go on as stars
    stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    linked = components(stars.unionByName(second))
    component = (
        classes.select("key", "rep")
        .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", F.coalesce("component", "rep").alias("component"))
    )
    out = signed.select("doc", "n", "key").join(component, "key", "left")
    found = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return out.select(
        F.col("doc").alias(doc_id),
        F.col("n").alias("n_shingles"),
        found.alias("component_id"),
        F.coalesce(found == F.col("doc"), F.lit(True)).alias("kept"),
    )
