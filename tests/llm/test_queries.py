"""Every registered text query over the given tables: against its SQL, or against brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

import compare
import corpus_pipeline
import public_tokenizers
from feira.llm.decontaminate import contaminated
from feira.llm.queries import ORACLE, QUERIES

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def read(spark, folder, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*columns).collect()]


@pytest.fixture(scope="module")
def docs(spark, folder):
    return [(d, t or "") for d, t in sorted(read(spark, folder, "documents", "doc_id", "text"))]


def run(spark, folder, name, key="doc_id"):
    rows = QUERIES[name](spark, folder).collect()
    return {r[key]: r for r in rows}, rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    assert compare.difference(QUERIES[name](spark, folder), compare.connect(folder), ORACLE[name]) is None


def words_of(text):
    return [w for w in text.translate(str.maketrans(BLANK, " " * 6)).split(" ") if w]


def lowered(text):
    return text.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))


def components(docs, words):
    """doc_id -> (set size, smallest doc_id reachable) by all pairs that share a shingle."""
    sets, holders = {}, defaultdict(list)
    for doc, text in docs:
        w = words_of(lowered(text))
        sets[doc] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
        for s in sets[doc]:
            holders[s].append(doc)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    seen = set()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                        a_, b_ = sorted((find(a), find(b)))
                        root[b_] = a_
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_op5(spark, folder, docs):
    got, _ = run(spark, folder, "op5_minhash")
    assert {d: (r.n_shingles, r.component_id, r.kept) for d, r in got.items()} == {
        d: (n, c, c == d) for d, (n, c) in components(docs, 2).items()
    }


def test_op4(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    vector = next(c for c, t in table.dtypes if t.startswith("array"))
    rows = [tuple(r) for r in table.select("vec_id", "label", vector).orderBy("vec_id").collect()]
    links = {v: 0 for v, _, _ in rows}
    root = {v: v for v in links}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    fit = [
        (v, label, np.array(x, float)) for v, label, x in rows
        if label is not None and x is not None and None not in x and np.isfinite(np.array(x, float)).all() and any(x)
    ]
    for i, (a, la, x) in enumerate(fit):
        for b, lb, y in fit[i + 1 :]:
            if la == lb and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    got, _ = run(spark, folder, "op4_embedding_dedup", "vec_id")
    assert {v: (r.n_links, r.component_id, r.kept) for v, r in got.items()} == {
        v: (n, find(v), find(v) == v) for v, n in links.items()
    }


def ids_of(name, texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [[*e.ids, end] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def packed(rows, docs):
    """Whether pieces are the documents' ids, and sequences are gapless and within the limit."""
    all_ids = dict(zip((d for d, _ in docs), ids_of("byte_bpe_50k.json", [t for _, t in docs], 2)))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(all_ids)
    for doc, ids in all_ids.items():
        own, at = sorted(pieces[doc], key=lambda r: r.piece), 0
        assert [r.piece for r in own] == list(range(len(own)))
        for r in own:
            assert (r.start, r.ids_crc32) == (at, crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids) and all(r.length == 1024 for r in own[1:])
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, all_ids.values()))
    assert len(sequences) <= -(-total // 1024) * 1.05 + 1


def test_op6(spark, folder, docs):
    packed(run(spark, folder, "op6_packing")[1], docs)


def test_op7(spark, folder, docs):
    got, _ = run(spark, folder, "op7_quality")
    labels = dict(read(spark, folder, "labels", "doc_id", "quality"))
    assert set(got) == {d for d, _ in docs}
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    unseen = [(got[d].score, q) for d, q in labels.items() if got[d].held_out and q is not None]
    good, bad = ([s for s, q in unseen if q == k] for k in (1, 0))
    if good and bad:
        assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.9


def test_op8(spark, folder, docs):
    got, _ = run(spark, folder, "op8_token_store")
    at = 0
    for (doc, _), ids in zip(docs, ids_of("word_bpe_49k.json", [t for _, t in docs], 1)):
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    assert len(got) == len(docs)


def covered(units, size):
    """Per document in order of id, which units are in a window that starts in a smaller id's document."""
    first = {}
    for doc, seq in units:
        for i in range(len(seq) - size + 1):
            first.setdefault(seq[i : i + size], doc)
    for doc, seq in units:
        gone = np.zeros(len(seq) + 1, int)
        for i in range(len(seq) - size + 1):
            if first[seq[i : i + size]] != doc:
                gone[i] += 1
                gone[i + size - len(seq) - 1] -= 1
        yield doc, seq, np.cumsum(gone[: len(seq)]) > 0


def test_op9(spark, folder, docs):
    got, _ = run(spark, folder, "op9_suffix_dedup")
    for doc, seq, gone in covered([(d, t.encode()) for d, t in docs], 50):
        kept = bytes(b for b, g in zip(seq, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        r = got[doc]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(seq), gone.sum(), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_op10(spark, folder, docs):
    got, _ = run(spark, folder, "op10_substring_dedup")
    for doc, seq, gone in covered([(d, tuple(words_of(t))) for d, t in docs], 13):
        kept = " ".join(w for w, g in zip(seq, gone) if not g)
        r = got[doc]
        assert (r.n_words, r.n_removed) == (len(seq), gone.sum())
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def without_repeated_lines(docs):
    lines = [(d, t.split("\n")) for d, t in docs]
    first, out = {}, []
    for d, ls in lines:
        for i in range(len(ls) - 2):
            first.setdefault(tuple(ls[i : i + 3]), (d, i))
    for d, ls in lines:
        gone = set()
        for i in range(len(ls) - 2):
            window = tuple(ls[i : i + 3])
            at = first[window]
            if at != (d, i) and "".join(window).translate(str.maketrans("", "", "\t\n\r")).strip(" "):
                gone.update(range(max(i, at[1] + 3) if at[0] == d else i, i + 3))
        out.append((d, "\n".join(x for k, x in enumerate(ls) if k not in gone)))
    return out


def test_pipeline(spark, folder, docs):
    """The stages by brute force, but for the trained classifier and the templates, which are taken from their operators."""
    tables = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["quality classifier"](spark, tables, folder).select("doc_id").collect()}
    left = without_repeated_lines([(d, t) for d, t in docs if d in kept])
    own = components(left, 5)
    left = [(d, t) for d, t in left if own[d][1] == d]
    found = contaminated(
        spark.createDataFrame(left, "doc_id bigint, text string"), spark.read.parquet(f"{folder}/benchmark.parquet")
    )
    dirty = {r.doc_id for r in found.select("doc_id").collect()}
    packed(corpus_pipeline.run(spark, folder).collect(), [(d, t) for d, t in left if d not in dirty])
