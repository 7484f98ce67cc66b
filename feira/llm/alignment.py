"""Alignment of two tokenizers' tokens over the same texts.

Both tokenizers cut the bytes of `` `` + text. The smallest groups of tokens that cover the same bytes are the
components of the overlaps between tokens of either side. They are found by pointer jumping, for many texts at
once: every token points to the token of the other side that overlaps it and reaches farthest to the right, a token
that ends where the other side's does to the left side's token ending there, which points to itself. Replacing each pointer by its
target's pointer doubles the distance, so after the logarithm of the longest chain all point to
their component's last token, the group's label.

An id pair counts the documents that hold it linked (by a pair of overlapping tokens). Tasks settle blocks of some hundred documents:
distinct pairs of a block are counted before they are shuffled, and the counts come back to a block once,
not once per document.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
from array import array
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.common import stored
from feira.llm.tokens import BYTE_SPLIT, KEPT, SAFE, _byte_alphabet, text_encoder

BLOCK_CHARS = 1 << 21
RADIX = 31  # bits of an id pair


def without_special(definition: str) -> str:
    """A tokenizer file without its special tokens: their strings in texts are plain text."""
    return json.dumps({**json.loads(definition), "added_tokens": []})


def byte_entries(definition: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    alphabet = {ord(shown): byte for byte, shown in _byte_alphabet().items()}
    vocab = json.loads(definition)["model"]["vocab"]
    out = [b""] * (max(vocab.values()) + 1)
    for shown, at in vocab.items():
        out[at] = bytes(shown.translate(alphabet), "latin1") if all(ord(c) in alphabet for c in shown) else shown.encode()
    return out


def _pieces(model: bytes):
    from sentencepiece import SentencePieceProcessor

    home = sys.modules.setdefault("feira_worker_state", types.ModuleType("feira_worker_state"))
    states = vars(home).setdefault("sentencepiece", {})
    if model not in states:
        states[model] = SentencePieceProcessor(model_proto=model)
    return states[model]


def piece_entries(model: bytes) -> list[bytes]:
    """The bytes of each id of a piece vocabulary: U+2581 stands for a space, byte pieces for their byte."""
    processor = _pieces(model)
    names = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return [
        bytes([int(n[3:5], 16)]) if processor.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)
    ]


class _Words(dict):
    """A word with the spaces before it -> its ids; two generations keep the frequent ones in bounded memory."""

    def __init__(self, encode: Callable):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:  # the library puts the first space back
            found = array("I", self.encode(word[1:], num_threads=1)).tobytes()
        self[word] = found
        return found

    def age(self) -> None:
        if len(self) > KEPT:
            self.old = dict(self)
            self.clear()


def piece_encoder(model: bytes) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers, the library's own.

    Where no piece of the vocabulary holds a space after another character, merges never cross from a word into the spaces
    after it. Texts are then encoded word by word, each with the spaces before it, and a worker remembers words. Other
    vocabularies, texts with unusual characters and texts that end with a space go through the library whole.
    """
    processor = _pieces(model)
    names = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    apart = not any("▁" in n.lstrip("▁") for n in names)
    words, split, safe = _Words(processor.encode), re.compile(" *[^ ]+").findall, re.compile(SAFE).fullmatch
    ids_of = words.__getitem__

    def encode(text: str) -> bytes:
        if not apart or text.endswith(" ") or not safe(text):
            return array("I", processor.encode(text, num_threads=1)).tobytes()
        found = b"".join(map(ids_of, split(" " + text)))
        words.age()
        return found

    return encode


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token, by pointer jumping; both sides end at the same byte."""
    n_a = len(a_ends)
    over = np.searchsorted(b_ends, a_ends)  # the b token that holds an a token's last byte
    own = np.arange(n_a)
    pointer = np.concatenate((np.where(b_ends[over] > a_ends, n_a + over, own), np.searchsorted(a_ends, b_ends)))
    while True:
        farther = pointer[pointer]
        if np.array_equal(farther, pointer):
            break
        pointer = farther
    last = np.flatnonzero(pointer[:n_a] == own)
    label = np.searchsorted(last, pointer)
    return label[:n_a], label[n_a:]


def links_of(a_starts: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (a token, b token) whose bytes overlap."""
    first = np.searchsorted(b_ends, a_starts, side="right")
    many = np.searchsorted(b_ends, a_ends) - first + 1
    a = np.repeat(np.arange(len(a_ends)), many)
    place = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
    return a, first[a] + place


class _Aligner:
    """One worker's encoders and tables."""

    def __init__(self, definition: str, model: bytes):
        self.a_ids, self.b_ids = text_encoder(definition, BYTE_SPLIT, lower=False), piece_encoder(model)
        self.a_bytes, self.b_bytes = byte_entries(definition), piece_entries(model)
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.n_b = len(self.b_bytes)
        if len(self.a_bytes) * self.n_b > 1 << RADIX:
            raise ValueError("the two vocabularies are too large for one number a pair")
        # ids as text with what follows them: a "," or "|"; b "," or ";" or nothing
        self.shown = [f"{i}{end}".encode() for i in range(len(self.a_bytes)) for end in ",|"]
        self.shown += [f"{i}{end}".encode() for i in range(self.n_b) for end in (",", ";", "")]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Both sides' ids, or None where the text has none or a side does not give its bytes back."""
        if not text:
            return None
        a, b = (np.frombuffer(x, "<u4").astype(np.int64) for x in (self.a_ids([" " + text])[0], self.b_ids(text)))
        whole = (" " + text).encode()
        for ids, entries in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(entries.__getitem__, ids.tolist())) != whole:
                return None
        return a, b

    def block(self, texts: list[str]) -> tuple[list[dict], np.ndarray, np.ndarray]:
        """(one dict per text, the block's id pairs, how many of its texts hold each)."""
        out = [{"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "pairs": b"", "times": b""} for _ in texts]
        found = [(k, t) for k, t in enumerate(map(self.tokens, texts)) if t]
        if not found:
            return out, np.empty(0, np.int64), np.empty(0, np.int64)
        n = len(found)
        a, b = (np.concatenate([t[side] for _, t in found]) for side in (0, 1))
        many_a, many_b = (np.array([len(t[side]) for _, t in found]) for side in (0, 1))
        text_a, text_b = np.repeat(np.arange(n), many_a), np.repeat(np.arange(n), many_b)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        group_a, group_b = groups_of(a_ends, b_ends)
        at_a, at_b = links_of(a_ends - self.a_size[a], a_ends, b_ends)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        n_groups = np.bincount(text_a[last_a], minlength=n)
        n_links = np.bincount(text_a[at_a], minlength=n)

        # canonical form: tokens by (group, side), each with the sign after it
        done_b = np.append(text_b[1:] != text_b[:-1], True)
        shown = np.concatenate((a * 2 + last_a, 2 * len(self.a_bytes) + b * 3 + last_b + done_b))
        shown = shown[np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")]
        stops = np.cumsum(many_a + many_b)

        # distinct pairs per text, then the block's dictionary of pairs
        held, times = np.unique((text_a[at_a] << RADIX) | (a[at_a] * self.n_b + b[at_b]), return_counts=True)
        pairs, place, texts_of = np.unique(held & ((1 << RADIX) - 1), return_inverse=True, return_counts=True)
        cuts = np.searchsorted(held >> RADIX, np.arange(n + 1))
        place, times = place.astype("<u4"), times.astype("<u4")
        for j, (k, _) in enumerate(found):
            ids = shown[stops[j] - many_a[j] - many_b[j] : stops[j]].tolist()
            out[k] = {
                "n_a": int(many_a[j]), "n_b": int(many_b[j]), "n_groups": int(n_groups[j]), "n_links": int(n_links[j]),
                "groups": b"".join(itemgetter(*ids)(self.shown)).decode(),
                "pairs": place[cuts[j] : cuts[j + 1]].tobytes(), "times": times[cuts[j] : cuts[j + 1]].tobytes(),
            }
        return out, pairs, texts_of


def _aligner(definition: str, model: bytes) -> _Aligner:
    home = sys.modules.setdefault("feira_worker_state", types.ModuleType("feira_worker_state"))
    states = vars(home).setdefault("aligners", {})
    key = definition, model
    if key not in states:
        states[key] = _Aligner(definition, model)
    return states[key]


def _blocks(docs: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    """Documents in runs of bounded size; a longer text is a run of its own."""
    start, chars = 0, 0
    for k, text in enumerate(texts):
        if chars and chars + len(text) > BLOCK_CHARS:
            yield docs[start:k], texts[start:k]
            start, chars = k, 0
        chars += len(text)
    yield docs[start:], texts[start:]


_DOC = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string())]


def _aligned(definition: str, model: bytes, digest: bool):
    """Rows of two kinds: documents with their part of the block's pairs, and blocks with their pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, aligner = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            aligner = aligner or _aligner(definition, model)
            id_type = batch.schema.field("doc_id").type
            schema = pa.schema([
                ("block", pa.int64()), ("doc_id", id_type), *_DOC, ("pairs", pa.binary()), ("times", pa.binary()),
                ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.int64())),
            ])
            docs, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
            for some, theirs in _blocks(docs, texts):
                block, (found, ids, held) = (part << 32) + number, aligner.block(theirs)
                number += 1
                for doc, row in zip(some, found):
                    row.update(block=block, doc_id=doc)
                    if digest and row["n_a"]:
                        row["groups"] = hashlib.sha256(row["groups"].encode()).hexdigest()
                found.append({"block": block, "ids": ids, "texts": held})
                yield pa.RecordBatch.from_pylist(found, schema)

    return run


def _summed(_, left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block with the counts of their pairs."""
    order = np.argsort(right.column("at").to_numpy())
    count, best = (right.column(c).to_numpy()[order] for c in ("n", "best"))
    sums: list[list[int]] = [[], []]
    for pairs, times in zip(left.column("pairs").to_pylist(), left.column("times").to_pylist()):
        place, many = np.frombuffer(pairs, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
        sums[0].append(int(many[best[place]].sum()) if len(place) else 0)
        sums[1].append(int((many * count[place]).sum()) if len(place) else 0)
    kept = left.select(["doc_id", *[n for n, _ in _DOC]])
    return kept.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))


def align_tokens(docs: DataFrame, definition: str, model: bytes, digest: bool = False) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum, and ``groups`` as ``a1,a2|b1;a3|b2,b3`` (decimal ids).

    ``definition``: content of a byte-level tokenizer file (side a, over a space and the text); ``model``: a piece model
    (side b, over the text, to which it adds the space itself). ``docs``: doc_id, text; other columns are ignored, every row has a result, and
    repeated rows count as documents. Texts that are NULL, empty or not given back byte by byte by both sides have
    no tokens: zeros and empty groups. ``digest``: groups as their SHA-256, which is much shorter to store.

    ``n_best`` counts links whose id pair is, over all documents, among the most frequent of its a id. Memory grows with the longest
    text; the per-id maxima are broadcast, one row per id of the vocabulary at most.
    """
    definition = without_special(definition)
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    numbers = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
    shape = f"block bigint, doc_id {id_type}, {numbers}, pairs binary, times binary, ids array<bigint>, texts array<bigint>"
    met = stored(given.mapInArrow(_aligned(definition, model, digest), shape), "aligned")

    each = met.filter("ids IS NOT NULL").select("block", F.posexplode(F.arrays_zip("ids", "texts")).alias("at", "p"))
    each = each.select("block", "at", F.col("p.ids").alias("pair"), F.col("p.texts").alias("texts"))
    counts = stored(each.groupBy("pair").agg(F.sum("texts").alias("n")), "pair-counts")
    n_b = len(piece_entries(model))
    a_id = F.floor(F.col("pair") / n_b).cast("int")
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    known = counts.join(F.broadcast(most), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    back = each.join(known, "pair").select(F.col("block").alias("asked"), "at", "n", "best")

    rows = met.filter("ids IS NULL").select("block", "doc_id", *[n for n, _ in _DOC], "pairs", "times")
    out = f"doc_id {id_type}, {numbers}, n_best bigint, count_sum bigint"
    return rows.groupBy("block").cogroup(back.groupBy("asked")).applyInArrow(_summed, out)
