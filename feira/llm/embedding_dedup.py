"""Embedding near-dedup on a robust-pruned flat graph.

Vectors are compared within equal labels (and dimensions) by cosine. Identical vectors are one vector from the start.

1. Cluster: pivots are fitted per label on a bounded sample; every vector goes to the shards of its
   ``OVERLAP`` nearest pivots. Shards of more than ``SHARD`` vectors are dealt as pairs of blocks, so none is too large
   for a task and no pair of a shard is lost.
2. Build: a shard links each vector to close ones in different directions (robust pruning). The adjacency
   lists of all shards are united per vector.
3. Search: every vector is a query in each of its shards: a greedy search from the medoids and its own list,
   which then expands every node inside the range widened by ``SLACK``.
4. Verify: what was found counts if its cosine, in double precision from the given components, reaches the threshold.

``audit`` measures the recall against brute force for the ids divisible by 100.

Defined results
* A vector that is NULL, empty, zero or holds NULL or non-finite components, or has no label, links with nothing.
* A NULL id links with nothing: component NULL, kept.
* Repeated rows are one vector; rows that repeat an id with other vectors add up their links.
* Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.common import stored
from feira.llm.components import components

THRESHOLD = 0.93
SAMPLE = 20_000
SHARD = 800
OVERLAP = 3
DEGREE = 24
BACK = 4
ALPHA = 1.2
BEAM = 32
SLACK = 0.2


def classes_of(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(rep, label, m, v): distinct comparable vectors with their smallest id and the number of ids."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.groupBy("label", "v").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("m"))


def _units(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_pivots(classes: DataFrame, sample: int = SAMPLE) -> dict[tuple, np.ndarray]:
    """Unit pivots by (label, dimension), by a few rounds of spherical k-means over a bounded sample."""
    counts = {(r["label"], r["d"]): r["n"] for r in classes.groupBy("label", F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(sample).collect()}
    drawn = classes.select("label", "v").orderBy(F.xxhash64("rep", "v")).limit(sample).collect()
    by_group: dict[tuple, list] = {}
    for r in drawn:
        by_group.setdefault((r["label"], len(r["v"])), []).append(r["v"])
    out = {}
    for group in sorted(by_group, key=str):
        x = _units(by_group[group])
        k = max(1, min(len(x) // 4, -(-counts.get(group, 1) * OVERLAP // (SHARD // 2))))
        pivots = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(4):
            nearest = (x @ pivots.T).argmax(axis=1)
            sums = np.zeros_like(pivots)
            np.add.at(sums, nearest, x)
            norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            pivots = np.where(norms > 0, sums / np.maximum(norms, 1e-12), pivots)
        out[group] = pivots
    return out


def assigned(classes: DataFrame, pivots: dict[tuple, np.ndarray]) -> DataFrame:
    """(shard, rep, v): every class in the shards of its nearest pivots; groups the sample missed are one shard each."""
    plain = {g: p.tobytes() for g, p in pivots.items()}
    first = {g: k for g, k in zip(plain, np.cumsum([0, *[len(p) for p in pivots.values()]]).tolist())}
    shared = classes.sparkSession.sparkContext.broadcast((plain, first))  # bounded by the sample
    kind = classes.schema["label"].dataType.simpleString()
    rep_kind = classes.schema["rep"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, first = shared.value
        for batch in batches:
            labels, vectors = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            groups: dict[tuple, list[int]] = {}
            for k, (lab, v) in enumerate(zip(labels, vectors)):
                groups.setdefault((lab, len(v)), []).append(k)
            rows, shards = [], []
            for (lab, d), own in groups.items():
                if (lab, d) not in plain:
                    rows += own
                    shards += [-1] * len(own)
                    continue
                p = np.frombuffer(plain[(lab, d)]).reshape(-1, d)
                sims = _units([vectors[k] for k in own]) @ p.T
                near = np.argsort(-sims, axis=1, kind="stable")[:, :OVERLAP]
                rows += np.repeat(own, near.shape[1]).tolist()
                shards += (near.ravel() + first[(lab, d)]).tolist()
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int64()), *[batch.column(c).take(take) for c in range(3)]],
                names=["shard", "rep", "label", "v"],
            )

    return classes.select("rep", "label", "v").mapInArrow(run, f"shard bigint, rep {rep_kind}, label {kind}, v array<double>")


def dealt(rows: DataFrame) -> DataFrame:
    """Shards as groups (label, d, shard, i, j) of at most two blocks."""
    rows = rows.withColumn("d", F.size("v"))
    keys = ["label", "d", "shard"]
    blocks = rows.groupBy(*keys).agg(F.ceil(F.count("*") / SHARD).cast("int").alias("blocks"))
    rows = rows.join(blocks, keys).withColumn("own", F.pmod(F.xxhash64("rep", "v"), F.col("blocks")).cast("int"))
    # one block: itself. several: every pair of different blocks, which also holds the pairs inside both
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: (F.col("blocks") == 1) | (o != F.col("own")))
    out = rows.select(*keys, "rep", "v", "own", F.explode(others).alias("other"))
    return out.select(*keys, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "v")


def pruned_graph(x: np.ndarray) -> list[np.ndarray]:
    """Robust pruning: of the closest candidates keep one unless a kept one is clearly closer to it."""
    n = len(x)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    width = min(n - 1, 3 * DEGREE)
    if width <= 0:
        return [np.zeros(0, dtype=np.int64) for _ in range(n)]
    near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
    out = []
    for k in range(n):
        own = near[k][np.argsort(-sims[k, near[k]], kind="stable")]
        far = 1 - sims[k, own]
        among = 1 - sims[np.ix_(own, own)]
        alive, kept = np.ones(own.size, dtype=bool), []
        for c in range(own.size):
            if alive[c]:
                kept.append(own[c])
                if len(kept) == DEGREE:
                    break
                alive &= ALPHA * among[c] > far
        out.append(np.array(kept, dtype=np.int64))
    # the closest neighbours link back, else vectors at the rim of a tight group have no way in
    back: list[list[int]] = [[] for _ in range(n)]
    for k, kept in enumerate(out):
        for m in kept[:BACK].tolist():
            back[m].append(k)
    return [np.union1d(own, np.array(b, dtype=np.int64)) for own, b in zip(out, back)]


def search(x: np.ndarray, graph: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) of at least ``threshold`` that range-expanding greedy searches from the medoids find."""
    n = len(x)
    width = max([1, *[len(g) for g in graph]])
    links = np.full((n, width), -1, dtype=np.int64)
    for k, g in enumerate(graph):
        links[k, : len(g)] = g
    # medoids: the vector nearest the mean, then the ones farthest from those chosen
    starts = [int((x @ x.mean(axis=0)).argmax())]
    closest = x @ x[starts[0]]
    while len(starts) < min(8, n):
        starts.append(int(closest.argmin()))
        closest = np.maximum(closest, x @ x[starts[-1]])
    seen = np.full((n, n), -np.inf, dtype=np.float32)
    seen[:, starts] = x @ x[starts].T
    # a query also knows its own list; a tight group may have no way in from outside
    np.fill_diagonal(seen, 1.0)
    open_ = seen.copy()  # seen and not yet expanded
    active = np.arange(n)
    step = 0
    while active.size:
        best = open_[active].argmax(axis=1)
        value = open_[active, best]
        go = (value >= threshold - SLACK) | ((step < BEAM) & np.isfinite(value))
        active, best = active[go], best[go]
        open_[active, best] = -np.inf
        step += 1
        fresh = links[best]
        query = np.repeat(active, width)
        node = fresh.ravel()
        new = node >= 0
        query, node = query[new], node[new]
        new = np.isneginf(seen[query, node])
        query, node = query[new], node[new]
        value = np.einsum("ij,ij->i", x[query], x[node])
        seen[query, node] = value
        open_[query, node] = value
    a, b = np.nonzero(seen >= threshold - 1e-4)
    low, high = np.minimum(a, b), np.maximum(a, b)
    pairs = np.unique(low[low != high] * n + high[low != high])
    return pairs // n, pairs % n


def _exact(v: list, w: list) -> float:
    a, b = np.array(v, dtype=np.float64), np.array(w, dtype=np.float64)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def links_of(classes: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(a, b): linked pairs of classes by their smallest ids, each once, a < b."""
    rows = stored(dealt(assigned(classes, fit_pivots(classes, sample))), "shards")
    rep = rows.schema["rep"].dataType.simpleString()
    keys = ["label", "d", "shard", "i", "j"]

    def build(group: pa.Table) -> pa.Table:
        x = _units(group.column("v").to_pylist())
        reps = group.column("rep").to_numpy()
        return pa.table({"rep": pa.array(reps), "near": pa.array([reps[g].tolist() for g in pruned_graph(x)], pa.list_(pa.from_numpy_dtype(reps.dtype)))})

    lists = rows.groupBy(*keys).applyInArrow(build, f"rep {rep}, near array<{rep}>")
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    held = rows.join(united, "rep").select(*keys, "rep", "v", "near")

    def find(group: pa.Table) -> pa.Table:
        vectors, reps = group.column("v").to_pylist(), group.column("rep").to_pylist()
        place = {r: k for k, r in enumerate(reps)}
        graph = [np.array([place[m] for m in near if m in place], dtype=np.int64) for near in group.column("near").to_pylist()]
        a, b = search(_units(vectors), graph, threshold)
        pairs = [(reps[p], reps[q]) for p, q in zip(a.tolist(), b.tolist()) if _exact(vectors[p], vectors[q]) >= threshold]
        kind = group.schema.field("rep").type
        return pa.table({"a": pa.array([min(p) for p in pairs], kind), "b": pa.array([max(p) for p in pairs], kind)})

    return held.groupBy(*keys).applyInArrow(find, f"a {rep}, b {rep}").filter("a <> b").distinct()


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding",
    label: str = "label", sample: int = SAMPLE,
) -> DataFrame:
    """One row per vector id: ``n_links``, ``component_id``, ``kept``."""
    classes = stored(classes_of(vectors, vec_id, embedding, label), "vectors")
    links = stored(links_of(classes, threshold, sample), "vector-links")
    sizes = classes.groupBy("rep").agg(F.sum("m").alias("m"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partners = both.join(sizes.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("m").alias("others"))
    joined = components(links)
    facts = (
        sizes.join(partners.withColumnRenamed("a", "rep"), "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "rep",
            (F.coalesce("others", F.lit(0)) + F.col("m") - 1).cast("bigint").alias("n"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    own = rows.join(classes.select("label", "v", "rep"), ["label", "v"]).select("id", "rep").distinct().join(facts, "rep")
    by_id = own.groupBy("id").agg(F.sum("n").cast("bigint").alias("n"), F.min("component").alias("component"))
    out = rows.select("id").distinct().join(by_id, "id", "left")
    found = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(vec_id),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        found.alias("component_id"),
        F.coalesce(found == F.col("id"), F.lit(True)).alias("kept"),
    )


def audit(vectors: DataFrame, found: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row: links of the ids divisible by 100 by brute force (``true_links``), those that ``found`` counts
    (``found_links``), and their share (``recall``). The queries meet all rows of their label by a join."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))

    def dot(a: str, b: str):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    queries = rows.filter("id % 100 = 0").select("label", F.col("id").alias("q"), F.col("v").alias("w"))
    near = queries.join(rows, "label").filter("q <> id and size(v) = size(w)")
    near = near.filter(dot("v", "w") / F.sqrt(dot("v", "v") * dot("w", "w")) >= threshold)
    true = near.groupBy("q").agg(F.count("*").alias("n"))
    met = true.join(found.withColumnRenamed(vec_id, "q"), "q", "left")
    return met.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("true_links"),
        F.coalesce(F.sum(F.least("n", "n_links")), F.lit(0)).alias("found_links"),
    ).withColumn("recall", F.expr("if(true_links = 0, 1.0D, found_links / true_links)"))
