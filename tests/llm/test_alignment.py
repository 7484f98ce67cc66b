"""op13 against the libraries and a byte-by-byte alignment, with its edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from feira.llm import alignment
from feira.llm.alignment import align_tokens, byte_entries, groups_of, links_of, piece_encoder, piece_entries, without_special
from feira.llm.queries import QUERIES
from feira.llm.tokens import BYTE_SPLIT, SAFE, model_file, text_encoder, vocabulary

SCHEMA = "doc_id bigint, text string, block int, pair string, groups int"
A, B = vocabulary("byte_bpe_50k.json"), model_file("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "a ", "a  b", " a", "<|endoftext|>", "<s>x</s> <unk> <0x41>", "▁a", "x▁", "漢字 and more", "\U0001f600!",
       "tab\tand\nlines\r\n\n  end", "don't we'll", "a\x00b", "é́ ﬁ ①", "\xa0x　y", "=" * 40, " " * 21 + "w", "1234567 89"]


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(rows, sides):
    """Results of (doc_id, text) rows by whole-text encoding and a byte-by-byte walk."""
    a_lib, b_lib = sides
    a_bytes, b_bytes = byte_entries(A), piece_entries(B)
    found, held = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_lib.encode(text, num_threads=1) if text else []
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            a, b = [], []
        owner_a = [k for k, i in enumerate(a) for _ in a_bytes[i]]
        owner_b = [k for k, i in enumerate(b) for _ in b_bytes[i]]
        links = sorted(set(zip(owner_a, owner_b)))
        ends = {k for k in range(len(owner_a)) if owner_a[k + 1 : k + 2] != [owner_a[k]] and owner_b[k + 1 : k + 2] != [owner_b[k]]}
        groups, start = [], 0
        for end in sorted(ends):
            groups.append([list(dict.fromkeys(o[start : end + 1])) for o in (owner_a, owner_b)])
            start = end + 1
        shown = ";".join(",".join(str(a[k]) for k in x) + "|" + ",".join(str(b[k]) for k in y) for x, y in groups)
        pairs = [(a[x], b[y]) for x, y in links]
        held.update(set(pairs))
        found.append((doc, len(a), len(b), len(groups), pairs, shown))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    return Counter(
        (doc, n_a, n_b, n, len(p), sum(held[x] == most[x[0]] for x in p), sum(held[x] for x in p), shown)
        for doc, n_a, n_b, n, p, shown in found
    )


FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def mess(draw, n):
    near = [chr(c) for c in range(0x250) if c and not 0xD800 <= c < 0xE000]
    return "".join(draw.choices(near + list("  etaoin shrdlu") * 40 + ["the ", "  ", "\n", "'s", "漢"], k=n))


def test_word_by_word_ids_are_the_librarys(sides):
    draw = random.Random(4)
    texts = [t for t in ODD if t] + [mess(draw, draw.randint(1, 60)) for _ in range(4000)]
    texts += ["".join(c for c in t if __import__("re").fullmatch(SAFE, c)) for t in texts]
    pieces, entries = piece_encoder(B), text_encoder(without_special(A), BYTE_SPLIT, lower=False)
    for text in texts:
        assert np.frombuffer(pieces(text), "<u4").tolist() == sides[1].encode(text), repr(text)
        assert np.frombuffer(entries([" " + text])[0], "<u4").tolist() == sides[0].encode(" " + text, add_special_tokens=False).ids


def test_pointers_find_common_ends():
    draw = np.random.default_rng(3)
    for _ in range(300):
        size = int(draw.integers(1, 40))
        a, b = (np.append(np.flatnonzero(draw.random(size) < p) + 1, size + 1) for p in draw.random(2))
        common = np.intersect1d(a, b)
        for got, ends in zip(groups_of(a, b), (a, b)):
            assert got.tolist() == np.searchsorted(common, ends).tolist()
        got = set(zip(*(x.tolist() for x in links_of(np.append(0, a[:-1]), a, b))))
        owners = [np.searchsorted(ends, np.arange(size + 1), side="right") for ends in (a, b)]
        assert got == set(zip(*(x.tolist() for x in owners)))


def test_against_byte_walk(spark, sides, monkeypatch):
    draw = random.Random(8)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "same text"), (None, "same text"), (1, "same text"), (1, None)]
    rows += [(100 + k, mess(draw, draw.randint(1, 300))) for k in range(60)] + [(500, " ".join(["thou", "wast"] * 40_000))]
    given = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], SCHEMA).repartition(5)
    assert Counter(tuple(r[f] for f in FIELDS) for r in align_tokens(given, A, B).collect()) == brute(rows, sides)
    assert align_tokens(given.limit(0), A, B).count() == 0


def test_blocks_of_few_documents():
    texts = ["x" * (alignment.BLOCK_CHARS // 3)] * 7 + ["y" * alignment.BLOCK_CHARS * 2, "", "z"]
    cut = list(alignment._blocks(list(range(10)), texts))
    assert [d for docs, _ in cut for d in docs] == list(range(10)) and len(cut) == 5
    assert all(len(t) == 1 or sum(map(len, t)) <= alignment.BLOCK_CHARS for _, t in cut)


def test_query_equals_brute_force(spark, folder, sides):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_alignment"](spark, folder).collect()
    digest = lambda shown: hashlib.sha256(shown.encode()).hexdigest() if shown else ""
    want = Counter({(*r[:-1], digest(r[-1])): n for r, n in brute(rows, sides).items()})
    assert Counter(tuple(r[f if f != "groups" else "groups_sha256"] for f in FIELDS) for r in got) == want
