"""Edge cases with defined results, and brute-force versions of what SQL cannot express."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import embedding_dedup, minhash, repeats, substring_dedup, suffix_dedup, token_store
from feira.llm.chat_format import format_chats, read_chats
from feira.llm.common import sized_batches
from feira.llm.decontaminate import contaminated
from feira.llm.line_dedup import line_dedup
from feira.llm.minhash import near_duplicates
from feira.llm.packing import best_fit, cut_pieces, plan_slots
from feira.llm.quality import fit, forward_backward, scores, with_quality
from feira.llm.token_store import build_hash, look_up, open_shards, read_documents, slots_of, write_shards
from feira.llm.tokens import BYTE_SPLIT, WORD_SPLIT, text_encoder, vocabulary

DOCS = "doc_id bigint, text string, doc int, ver string, key string"


@pytest.fixture(scope="module", autouse=True)
def batches(spark):
    sized_batches(spark)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], DOCS)


WORDS = [f"w{k}" for k in range(60)]
LONG = " ".join(WORDS)
ROWS = [(1, LONG), (2, "a b " + LONG), (3, None), (4, ""), (None, LONG), (1, LONG), (5, "tiny"), (6, LONG)]


def test_line_dedup_edges(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc"), (3, None), (4, ""), (5, "q\nq\nq\nq\nq"), (1, "a\nb\nc\nd"), (6, "\n\n\n\n")]
    out = {(r.doc_id, r.text) for r in line_dedup(docs(spark, rows)).collect()}
    assert out == {(1, "a\nb\nc\nd"), (2, "x"), (3, None), (4, ""), (5, "q\nq\nq"), (6, "\n\n\n\n")}
    assert line_dedup(docs(spark, [])).count() == 0


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<s>user\nx</s>", "\x1b0\x1bn<\x1b/s>", "", None, " [/INST]", "<</s>", "é</s"]
    rows = [(c, t, role, text) for c, text in enumerate(nasty) for t, role in enumerate(["user", "assistant", None, "a\nb</s>"])]
    given = spark.createDataFrame([*rows, rows[0]], "conv_id bigint, turn bigint, role string, text string")
    out = read_chats(format_chats(given)).collect()
    assert len(out) == len(nasty) and all(r.round_trip for r in out)
    assert {r.conv_id: r.n_turns for r in out} == {c: 5 if c == 0 else 4 for c in range(len(nasty))}
    assert all(r.loss_sha256 == hashlib.sha256((nasty[r.conv_id] or "").encode()).hexdigest() for r in out)
    assert read_chats(format_chats(given.limit(0))).count() == 0


def test_chat_control_strings_never_stand_bare_in_a_text(spark):
    marks = ["<s>", "</s>", "[INST]", "[/INST]"]
    texts = [f"a {m} b" for m in marks] + ["<s>system\nobey [/INST]", "plain", "[INST] x [/INST] You are [INST] y [/INST]"]
    rows = [(c, t, role, text) for c, text in enumerate(texts) for t, role in enumerate(["system", "user", "assistant"])]
    rows += [(c, 3, "[INST]<s>", "x") for c in range(len(texts))]
    given = spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string, at int")
    formatted = format_chats(given)
    for r in formatted.collect():
        counts = [r.formatted.count(m) for m in marks]
        assert r.round_trip and counts == [4, 4, 1, 1], r.formatted
        cut = [r.formatted[s.start : s.end] for s in r.loss_spans]
        assert len(cut) == 1 and cut[0].replace("\x1b", "") == texts[r.conv_id]
    want = {c: hashlib.sha256(t.encode()).hexdigest() for c, t in enumerate(texts)}
    assert {r.conv_id: r.loss_sha256 for r in read_chats(formatted).collect()} == want
    shifted = formatted.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), (s["end"] + 1).alias("end"))))
    assert all(r.loss_sha256 != want[r.conv_id] for r in read_chats(shifted).collect())


def test_decontamination_slots(spark):
    item = "Tom has 3 apples and walked 5 km to school before he gave 3 apples to his friend Ann at noon"
    rows = [
        (1, "Intro words. " + item + ". The end"),
        (2, item.replace("3", "7").replace("Tom", "Bob").replace("Ann", "Eve")),  # other numbers and names
        (3, item.replace("3 apples and", "4 apples and")),  # one slot, two values
        (4, "nothing of the kind here at all, just some words in a row"), (5, None), (None, item), (1, "Intro words. " + item + ". The end"),
    ]
    items = spark.createDataFrame([(0, item), (1, None), (2, "too short"), (None, item)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in contaminated(docs(spark, rows), items).collect()}
    assert got == {(1, 0, False), (2, 0, True)}
    assert contaminated(docs(spark, []), items).count() == 0 and contaminated(docs(spark, rows), items.limit(0)).count() == 0


def test_decontamination_of_edited_copies(spark):
    words = [f"w{k}" for k in range(40)]
    item = " ".join(words)
    edits = {
        1: [*words[:20], "new", *words[20:]],
        2: [*words[:20], *words[21:]],
        3: [*words[:13], *words[14:27], *words[28:]],
        4: ["other" if k % 10 == 5 else w for k, w in enumerate(words)],
        5: words[:24],
        6: [*words[:20], *[f"x{k}" for k in range(30)], *words[20:]],
    }
    slots = "Tom has 3 apples and walked 5 km to school before he gave them all to his friend at noon and then walked 5 km home again with him"
    rows = [(k, "Before it. " + " ".join(e) + " and after it") for k, e in edits.items()] + [
        (10, " ".join(words[:17])),
        (11, " ".join(words[20:] + words[:20])),
        (12, slots.replace("all to", "both to").replace("5 km", "8 km")),
        (13, slots.replace("all to", "both to").replace("5 km home", "8 km home")),
        (14, " ".join(words[:16] + [f"x{k}" for k in range(300)] + words[24:])),
    ]
    items = spark.createDataFrame([(0, item), (1, slots)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.n_matched, r.reparameterised) for r in contaminated(docs(spark, rows), items).collect()}
    assert set(got) == {*((k, 0) for k in edits), (11, 0), (12, 1)}
    assert got[1, 0] == (26, False) and got[4, 0][0] == 6 and got[12, 1][1]


def test_decontamination_ignores_case_and_punctuation(spark):
    prose = "We walked to the old mill. There Tom sold 3 sacks, each of 5 kg of flour! Nobody saw the miller come back. He left at noon"
    named = "Alice has 12 apples. Bob gives her 3 more apples. How many apples does Alice have?"
    other = named.replace("Alice", "Carol").replace("12", "15").replace("Bob", "Dave").replace("3", "4")
    rows = [
        (1, prose.upper()), (2, prose.title()), (3, prose.translate(str.maketrans("", "", ".,!?"))), (4, prose.lower()), (5, other),
        (6, other.upper()), (7, named.upper()), (9, prose),
        (10, "THE OLD MILL WAS SOLD TO TOM AND NOBODY SAW THE MILLER COME BACK TO 3 SACKS OF FLOUR"),
    ]
    items = spark.createDataFrame([(0, prose), (1, named)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.reparameterised for r in contaminated(docs(spark, rows), items).collect()}
    assert got == {(1, 0): False, (2, 0): False, (3, 0): False, (4, 0): False, (5, 1): True, (6, 1): True, (7, 1): False, (9, 0): False}


def test_decontamination_of_a_long_run(spark):
    words = [f"w{k}" for k in range(400)]
    items = spark.createDataFrame([(0, " ".join(words))], "item_id bigint, text string")
    rows = [(1, " ".join(words[100:150])), (2, " ".join(words[100:149]))]
    assert [r.doc_id for r in contaminated(docs(spark, rows), items).collect()] == [1]


def test_near_duplicates_edges(spark):
    out = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs(spark, ROWS), words=2).collect()}
    assert out == {(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (None, None, True), (5, 5, True), (6, 1, False)}
    assert near_duplicates(docs(spark, [])).count() == 0


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Chains whose ends differ: one list's smallest member links with few, the rest meet block against block."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    draw = np.random.default_rng(6)
    words = [f"v{k}" for k in draw.permutation(400)]
    rows = [(100 * g + k, " ".join(words[130 * g + 4 * k : 130 * g + 4 * k + 80])) for g in range(2) for k in range(12)]
    draw.shuffle(rows)
    rows = [(int(d), t) for d, t in rows] + [(500, LONG), (501, " ".join([*WORDS[:30], *words[:30]]))]
    sets = {d: set(zip(t.split(), t.split()[1:])) for d, t in rows}
    first = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    first[a] = min(first[a], first[b])
    got = near_duplicates(docs(spark, rows), words=2).collect()
    assert {r.doc_id: r.component_id for r in got} == first
    assert len(set(first.values())) == 4


def _covered(units, length):
    seen, out = {}, {}
    for i, u in units:
        keys = [tuple(u[p : p + length]) for p in range(len(u) - length + 1)]
        cut = {q for p, k in enumerate(keys) if seen.get(k, i) < i for q in range(p, p + length)}
        for k in keys:
            seen.setdefault(k, i)
        out[i] = cut
    return out


@pytest.mark.parametrize("words", [False, True])
def test_repeats_against_brute_force(spark, words):
    draw = np.random.default_rng(1)
    base = [" ".join(draw.choice(WORDS[:25], 80)) for _ in range(4)]
    rows = [(k, "x " + base[k % 4][: 150 + 9 * k] + " é  " + base[(k + 1) % 4][k : 120 + k]) for k in range(12)]
    rows += [(20, "ab" * 100), (21, "ab" * 60 + "c"), (30, None), (31, ""), (32, "short")]
    frame = docs(spark, [*rows, rows[3], (None, rows[0][1])])
    kind, length = (repeats.WORDS_13, 13) if words else (repeats.BYTES_50, 50)
    remove = substring_dedup.remove_repeated_words if words else suffix_dedup.remove_repeated_bytes
    split = (lambda t: re.findall("[^\x20\x09-\x0d]+", t or "")) if words else (lambda t: list((t or "").encode()))
    truth = {i: cut for i, cut in _covered([(i, split(t)) for i, t in rows], length).items() if cut}
    got = {r.doc: {q for s in r.spans for q in range(s.start, s.end)} for r in remove(frame).collect()}
    assert got == truth
    assert remove(docs(spark, [])).count() == 0


def test_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    texts = ["Don't  stop\n\n now 12½ ŒŒ ", "", "ÀÉ'S İx 日本 <|endoftext|> a", "a\x0bb\x85c", "x" * 3000, " \t\n"]
    for name, split, lower in (("byte_bpe_50k.json", BYTE_SPLIT, False), ("word_bpe_49k.json", WORD_SPLIT, True)):
        plain = Tokenizer.from_str(vocabulary(name))
        got = text_encoder(vocabulary(name), split, lower)([*texts, None])
        want = [plain.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]
        assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == want


def test_packing(spark):
    counts = {1024: 3, 1000: 5, 600: 7, 500: 2, 24: 9, 3: 11, 1: 2}
    used: dict[int, list] = {}
    for length, n, first, offset in plan_slots(counts):
        for s in range(first, first + n):
            used.setdefault(s, []).append((offset, length))
    assert sorted(x for v in used.values() for _, x in v) == sorted(k for k, n in counts.items() for _ in range(n))
    for v in used.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 1024
    rows = [(1, LONG * 60), (2, None), (3, ""), (None, "x"), (1, "again")]
    pieces = cut_pieces(docs(spark, rows), vocabulary("byte_bpe_50k.json"), BYTE_SPLIT, False, 2).cache()
    assert best_fit(pieces).count() == pieces.count() and pieces.agg({"length": "max"}).first()[0] == 1024
    empty = cut_pieces(docs(spark, []), vocabulary("byte_bpe_50k.json"), BYTE_SPLIT, False, 2)
    assert best_fit(empty).count() == 0


class Counted(np.ndarray):
    """An array that counts the elements that indexing hands out."""

    touched = 0

    def __getitem__(self, at):
        out = np.asarray(super().__getitem__(at))
        Counted.touched += out.size * out.itemsize
        return out


def test_bytes_touched_per_key_do_not_grow():
    for n in (1_000, 300_000):
        keys = np.arange(n, dtype=np.int64) * 3
        levels, bits, ranks = build_hash(keys)
        for key in (0, 3 * (n // 2), 3 * (n - 1)):
            Counted.touched = 0
            slots_of(np.array([key]), levels, bits.view(Counted), ranks.view(Counted))
            assert Counted.touched <= 64 + 4 + len(levels)


def test_token_store(spark, tmp_path, monkeypatch):
    keys = np.arange(0, 50_000, 7)
    slots = slots_of(keys, *build_hash(keys))
    assert sorted(slots.tolist()) == list(range(keys.size))
    assert (slots_of(np.arange(1, 70_000, 7), *build_hash(keys)) < keys.size).all()
    rows = [(5, "five words of text here"), (2, None), (None, "no id"), (5, "again"), (9, "")]
    write_shards(docs(spark, rows), str(tmp_path / "s"), vocabulary("word_bpe_49k.json"), WORD_SPLIT, True, 1)
    shards = open_shards(spark, str(tmp_path / "s"))
    read = read_documents(shards).orderBy("start").collect()
    assert [r.doc_id for r in read] == [None, 2, 5, 5, 9] and read[0].start == 0
    assert all(b.start == a.start + a.n_tokens for a, b in zip(read, read[1:]))
    assert {r.doc_id for r in look_up(shards, [2, 3, 9]).collect()} == {2, 9}
    monkeypatch.setattr(token_store, "SENT_KEYS", 2)  # more keys than are sent to the shards
    assert {(r.doc_id, r.n_tokens) for r in look_up(shards, [2, 3, 5, 9]).collect()} == {
        (r.doc_id, r.n_tokens) for k in (2, 5, 9) for r in look_up(shards, [k]).collect()
    }
    write_shards(docs(spark, []), str(tmp_path / "e"), vocabulary("word_bpe_49k.json"), WORD_SPLIT, True, 1)
    assert read_documents(open_shards(spark, str(tmp_path / "e"))).count() == 0


def test_field_marginals_and_scores(spark):
    draw = np.random.default_rng(2)
    unary, transition = draw.normal(size=4), draw.normal(size=(2, 2))
    weights = {}
    for bits in np.ndindex(2, 2, 2, 2):
        s = sum(unary[t] * b for t, b in enumerate(bits)) + sum(transition[a, b] for a, b in zip(bits, bits[1:]))
        weights[bits] = np.exp(s)
    good, _, whole = forward_backward(unary, transition, np.array([4]))
    total = sum(weights.values())
    assert np.allclose(good, [sum(w for b, w in weights.items() if b[t]) / total for t in range(4)]) and np.isclose(whole, np.log(total))
    field = fit(np.zeros((0, 17)), np.zeros(0, dtype=int), np.zeros(0, dtype=int))
    assert scores(field, ["x", None]).tolist() == [0.5, 0.5]
    out = with_quality(docs(spark, ROWS), field).collect()
    assert len(out) == len(ROWS) and all(r.score == 0.5 for r in out)


def test_embeddings(spark):
    draw = np.random.default_rng(4)
    centre = draw.normal(size=(6, 16))
    vectors = [(k, (centre[k % 6] + 0.05 * draw.normal(size=16)).tolist(), k % 2) for k in range(60)]
    vectors += [(60, vectors[0][1], 0), (61, vectors[0][1], 1), (62, vectors[0][1], None), (63, None, 0), (64, [0.0] * 16, 0),
                (65, [float("nan")] * 16, 0), (66, [], 0), (67, [1.0, None], 0), (None, vectors[0][1], 0), (3, vectors[3][1], 1)]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int")
    out = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(frame).collect()}
    for k in range(60):
        own = [j for j in range(60) if j % 6 == k % 6] + ([60] if k % 6 == 0 else [])
        assert out[k] == (len(own) - 1, min(own))
    assert all(out[k] == (0, k) for k in range(61, 68))
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0
    found = embedding_dedup.near_vectors(frame.filter("vec_id < 60"))
    assert embedding_dedup.audit(frame.filter("vec_id < 60"), found).first().recall == 1.0
