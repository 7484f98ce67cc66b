"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is good or bad. A line's score comes from its own features and those of the
lines before and after it; a transition score ties neighbouring labels.
The model is fitted by gradient ascent on the conditional likelihood of a bounded
sample of labelled documents, whose lines carry their document's label. A
document's quality is the mean of its lines' marginal probabilities of being good
(forward-backward), weighted by line length.

Only the text enters a score. Line features: length, shares of letters, capitals, digits, punctuation,
bars and other symbols, word lengths, shares of distinct and of immediately repeated words, line endings.

Defined results
* NULL and empty texts are one empty line and get that line's score.
* A NULL id is an id; repeated rows are scored each; labels that are NULL are not learned from.
* Without any label of one kind, all scores are the share of good labels (0.5 without labels).
* The sample takes at most ``sample`` documents, those with the smallest hashes of their id and text, and none
  of more than ``sample_lines`` lines. Scoring reads every line of every text.
* Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 6000
SAMPLE_LINES = 2048
SEGMENT = 1 << 20
THRESHOLD = 0.3

# --- features of lines -------------------------------------------------------

_CLASSES = {
    "letter": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "capital": [*range(65, 91)],
    "digit": [*range(48, 58)],
    "stop": [*b".!?"],
    "comma": [*b",;:"],
    "bar": [*b"|"],
    "symbol": [*b"#$%&*+/<=>@[\\]^_`{}~"],
    "blank": [*b" \t\r\x0b\x0c"],
}
_TABLES = np.zeros((len(_CLASSES), 256), dtype=np.int32)
for _row, _bytes in enumerate(_CLASSES.values()):
    _TABLES[_row, _bytes] = 1
_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[*b" \t\r\n\x0b\x0c"]] = True
_WORD_KEYS = np.random.default_rng(7).integers(0, 2**63, (64, 256), dtype=np.int64).astype(np.uint64)
N_FEATURES = 17


def _segment_features(buffer: bytes) -> np.ndarray:
    """One row of features per line of ``buffer``."""
    raw = np.frombuffer(buffer, dtype=np.uint8)
    breaks = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.concatenate([breaks, [raw.size]])
    n = starts.size
    length = (ends - starts).astype(np.float64)
    counts = {}
    for name, lut in zip(_CLASSES, _TABLES):
        sums = np.concatenate([[0], np.cumsum(lut[raw], dtype=np.int64)])
        counts[name] = (sums[ends] - sums[starts]).astype(np.float64)

    apart = _SEPARATES[raw]
    edge = np.diff(np.concatenate([[True], apart, [True]]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = np.zeros(n)
    mean_length, distinct, again, short, long_share, longest_run = (np.zeros(n) for _ in range(6))
    if first.size:
        size = last - first
        inside = ~apart
        place = np.arange(raw.size)[inside] - np.repeat(first, size)
        cells = _WORD_KEYS[place & 63, raw[inside]]
        key = np.add.reduceat(cells, np.concatenate([[0], np.cumsum(size)[:-1]]))
        line = np.searchsorted(breaks, first)
        words = np.bincount(line, minlength=n).astype(np.float64)
        some = np.maximum(words, 1)
        mean_length = np.bincount(line, weights=size, minlength=n) / some
        short = np.bincount(line, weights=size <= 3, minlength=n) / some
        long_share = np.bincount(line, weights=size >= 16, minlength=n) / some
        same = np.zeros(first.size)
        same[1:] = (key[1:] == key[:-1]) & (line[1:] == line[:-1])
        again = np.bincount(line, weights=same, minlength=n) / some
        marked = np.sort((line.astype(np.uint64) << np.uint64(40)) | (key >> np.uint64(24)))
        fresh = np.ones(marked.size, dtype=bool)
        fresh[1:] = marked[1:] != marked[:-1]
        own = (marked[fresh] >> np.uint64(40)).astype(np.int64)
        distinct = np.bincount(own, minlength=n) / some
    chars = np.maximum(length, 1)
    end_byte = np.where(length > 0, raw[np.maximum(ends - 1, 0)] if raw.size else 0, 0)
    return np.column_stack([
        np.log1p(length), counts["letter"] / chars, counts["capital"] / np.maximum(words, 1), counts["digit"] / chars,
        counts["stop"] / np.maximum(words, 1), counts["comma"] / np.maximum(words, 1), counts["bar"] / np.maximum(words, 1),
        counts["symbol"] / chars, counts["blank"] / chars, np.log1p(words), mean_length / 10, distinct, again, short,
        long_share, np.isin(end_byte, [*b".!?"]).astype(np.float64), (length == 0).astype(np.float64),
    ])


def _segments(text: bytes) -> Iterator[bytes]:
    """``text`` cut at line ends into parts of about a megabyte; joined by line ends they are the text."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = text.rfind(b"\n", at, at + SEGMENT)
        if cut < 0:
            cut = text.find(b"\n", at + SEGMENT)
            if cut < 0:
                break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features by line, lines per text, weight by line) of whole texts."""
    blocks, waiting, held = [], [], 0
    lines, weights = [], []
    for text in texts:
        raw = (text or "").encode()
        lines.append(raw.count(b"\n") + 1)
        for part in _segments(raw):
            waiting.append(part)
            held += len(part)
            if held >= SEGMENT:
                blocks.append(_segment_features(b"\n".join(waiting)))
                waiting, held = [], 0
    if waiting:
        blocks.append(_segment_features(b"\n".join(waiting)))
    x = np.concatenate(blocks) if blocks else np.zeros((0, N_FEATURES))
    weights = np.expm1(x[:, 0]) + 1
    return x, np.array(lines, dtype=np.int64), weights


# --- the field ---------------------------------------------------------------


@dataclass
class Field:
    """Weights of the unary scores (three lines' features, edges, bias) and the 2 x 2 transitions."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transition: np.ndarray
    constant: float | None = None

    def inputs(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        ends = np.cumsum(lines)
        starts = ends - lines
        before, after = np.zeros_like(z), np.zeros_like(z)
        before[1:], after[:-1] = z[:-1], z[1:]
        before[starts], after[ends - 1] = 0, 0
        edges = np.zeros((z.shape[0], 3))
        edges[starts, 0], edges[ends - 1, 1], edges[:, 2] = 1, 1, 1
        return np.hstack([z, before, after, edges])


def _chains(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents by falling length, and where their lines start."""
    order = np.argsort(-lines, kind="stable")
    return order, (np.cumsum(lines) - lines)[order]


def forward_backward(unary: np.ndarray, transition: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(marginal probability of label 1 by line, expected transitions, log of the partition functions' product).

    ``unary`` is the score of label 1, label 0 scores 0. All documents advance together.
    """
    order, starts = _chains(lines)
    sizes = lines[order]
    steps = int(sizes[0]) if sizes.size else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # documents longer than t
    score = np.column_stack([np.zeros(unary.size), unary])
    ahead = np.empty_like(score)  # log forward messages, own score included
    back = np.zeros_like(score)
    for t in range(steps):
        at = starts[: active[t]] + t
        if t == 0:
            ahead[at] = score[at]
        else:
            prev = ahead[at - 1]
            ahead[at] = score[at] + np.logaddexp(prev[:, :1] + transition[0], prev[:, 1:] + transition[1])
    for t in range(steps - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        into = score[at + 1] + back[at + 1]
        back[at] = np.logaddexp(into[:, :1] + transition[:, 0], into[:, 1:] + transition[:, 1])
    both = ahead + back
    whole = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - whole)
    inner = np.ones(unary.size, dtype=bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    expected = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            expected[a, b] = np.exp(ahead[at - 1, a] + transition[a, b] + score[at, b] + back[at, b] - whole[at]).sum()
    return good, expected, float(whole[starts].sum())


def fit(x: np.ndarray, lines: np.ndarray, labels: np.ndarray, rounds: int = 200, ridge: float = 1e-3) -> Field:
    """Maximum conditional likelihood with a small ridge, by full-batch adaptive gradients."""
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if x.size else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    field = Field(mean, scale, np.zeros(3 * N_FEATURES + 3), np.zeros((2, 2)))
    if labels.size == 0 or labels.min() == labels.max():
        field.constant = float(labels.mean()) if labels.size else 0.5
        return field
    z = field.inputs(x, lines)
    truth = np.repeat(labels, lines).astype(np.float64)
    inner = np.repeat(lines - 1, 1)
    seen = np.array([[inner[labels == 0].sum(), 0], [0, inner[labels == 1].sum()]], dtype=np.float64)
    # every document counts alike, however long: its lines share its weight
    share = np.repeat(1.0 / lines, lines)
    theta = np.zeros(field.weights.size + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, t = theta[:-4], theta[-4:].reshape(2, 2)
        good, expected, _ = forward_backward(z @ w, t, lines)
        slope = np.concatenate([z.T @ ((truth - good) * share) / labels.size, ((seen - expected) / lines.sum()).ravel()])
        slope -= ridge * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + 0.08 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    field.weights, field.transition = theta[:-4], theta[-4:].reshape(2, 2)
    return field


def scores(field: Field, texts: list) -> np.ndarray:
    """Quality of each text between 0 and 1."""
    if field.constant is not None or not texts:
        return np.full(len(texts), field.constant or 0.0)
    x, lines, weights = features(texts)
    good, _, _ = forward_backward(field.inputs(x, lines) @ field.weights, field.transition, lines)
    starts = np.cumsum(lines) - lines
    return np.clip(np.add.reduceat(good * weights, starts) / np.add.reduceat(weights, starts), 0.0, 1.0)


# --- Spark -------------------------------------------------------------------


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES,
) -> Field:
    """Fit the field on a bounded sample; ``labels`` must hold only rows that may be learned from."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull()
    )
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # the sample is drawn among ids first, so that only its texts meet the labels
    drawn = known.orderBy(F.xxhash64("id"), "label").limit(sample)
    few = F.size(F.split(F.coalesce("text", F.lit("")), "\n")) <= sample_lines
    picked = rows.join(F.broadcast(drawn), "id").filter(few).orderBy(F.xxhash64("id", "text"), "label").limit(sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, lines, _ = features(batch.column(1).to_pylist())
            ends = np.cumsum(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x[e - n : e].astype("<f4").tobytes() for e, n in zip(ends, lines)], pa.binary()),
                ],
                names=["label", "x"],
            )

    got = picked.select("label", "text").mapInArrow(extract, "label int, x binary").collect()  # at most ``sample`` rows
    got = sorted(got, key=lambda r: (r["label"], bytes(r["x"])))  # one order, whatever the partitions
    each = [np.frombuffer(r["x"], dtype="<f4").reshape(-1, N_FEATURES).astype(np.float64) for r in got]
    x = np.concatenate(each) if each else np.zeros((0, N_FEATURES))
    return fit(x, np.array([len(e) for e in each], dtype=np.int64), np.array([r["label"] for r in got], dtype=np.int64))


def with_quality(docs: DataFrame, field: Field, text: str = "text", keep: list[str] | None = None, score: str = "score") -> DataFrame:
    """The columns ``keep`` of every row (default: all) and its quality in ``score``."""
    keep = docs.columns if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = scores(field, part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(found, pa.float64())], names=[*names, score]
                )

    names = [f"c{k}" for k in range(len(keep))]
    types = [docs.schema[c].dataType.simpleString() for c in keep]
    chosen = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(f"`{text}`").alias("__text"))
    schema = ", ".join([*[f"{n} {t}" for n, t in zip(names, types)], f"{score} double"])
    out = chosen.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], score)


def held_out(doc_id: Column) -> Column:
    """The fifth of all ids that is never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
