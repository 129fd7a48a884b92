"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of toxic and one on
windows of ordinary text (a window is a word in lower case between blanks; the
padding behind it lets the matcher look at all of it).  A window is compressed
with each; its length and the difference of the two compressed lengths name a
cell.  Calibration turns the cells' shares in a text into a score: a logistic
regression with an L2 penalty on the square roots of the shares, fitted on
labelled documents that the dictionaries have not seen.

Labels are learned from a bounded sample (``MAX_TOXIC`` and ``MAX_ORDINARY``
documents, the smallest by a hash of their id) of rows whose crc32(doc_id as
text) mod 3 is not 1.  Of near copies (sharing one of their four smallest
five-word shingles) only one trains.  Scoring reads every whole text; nothing but
the text enters a score.

Defined results: null and empty texts score as a text without windows (the
intercept); with fewer than ``MIN_CLASS`` documents of a class every score is the
sample's share of toxic documents (0 without labels), never above 0.5; repeated
rows score equally; extra columns are ignored."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOXIC, MAX_ORDINARY, MIN_CLASS = 3000, 7000, 8
DICT_BYTES, LEVEL, SEGMENT, PAD = 8192, 3, 16, b" " * 12
LENGTHS, SPREAD = 25, 15  # window lengths are cut at 24, differences at +-15
CELLS = LENGTHS * (2 * SPREAD + 1)
SHRINK, PENALTY = 10, 30.0
MEMO_WORDS = 300_000
MARKS, COPIES = 4, 20  # shingles that tell a near copy; how often a window of many documents trains at most
PARAMETERS = dict(min_match=4, format=zstd.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    raw: tuple[bool, bool]  # untrained content instead of a trained dictionary
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray     # one per cell, then the intercept
    constant: float | None = None


def windows(text: bytes) -> list[bytes]:
    return text.lower().split()


def _compressor(content: bytes, raw: bool):
    kind = zstd.DICT_TYPE_RAWCONTENT if raw else zstd.DICT_TYPE_FULLDICT
    return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(content, dict_type=kind),
                               compression_params=zstd.ZstdCompressionParameters.from_level(LEVEL, **PARAMETERS))


class Cells(dict):
    """word -> cell, kept for at most ``MEMO_WORDS`` words."""

    def __init__(self, ordinary: bytes, toxic: bytes, raw: tuple[bool, bool]):
        super().__init__()
        self.pair = _compressor(ordinary, raw[0]), _compressor(toxic, raw[1])

    def __missing__(self, word: bytes) -> int:
        window = b" " + word + b" " + PAD
        a, b = (len(c.compress(window)) for c in self.pair)
        cell = min(len(word), LENGTHS - 1) * (2 * SPREAD + 1) + min(max(a - b, -SPREAD), SPREAD) + SPREAD
        if len(self) < MEMO_WORDS and len(word) <= 64:
            self[word] = cell
        return cell

    def counts(self, text: bytes) -> np.ndarray:
        w = windows(text)
        return np.bincount(np.fromiter(map(self.__getitem__, w), np.int64, len(w)), minlength=CELLS)


def features(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / (counts.sum(axis=-1, keepdims=True) + SHRINK))


def _train(samples: list[bytes]) -> tuple[bytes, bool]:
    try:
        return zstd.train_dictionary(DICT_BYTES, samples, k=SEGMENT, d=6, f=18, split_point=1.0, accel=1, level=LEVEL).as_bytes(), False
    except zstd.ZstdError:  # too few samples for a trained one
        return (b" ".join(dict.fromkeys(samples)) or b" ")[-DICT_BYTES:], True


def _without_near_copies(rows: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    seen: set[int] = set()
    out = []
    for text, label in rows:
        w = text.split()
        marks = sorted({zlib.crc32(b" ".join(w[i:i + 5])) for i in range(max(1, len(w) - 4))})[:MARKS]
        if not seen.intersection(marks):
            out.append((text, label))
            seen.update(marks)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 15) -> np.ndarray:
    """Weights, the last for the intercept (not penalised); damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(ridge)
        w += np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def fit(rows: list[tuple[bytes, int]]) -> Model:
    """Train on (text, label) rows: every second document trains the dictionaries, the others calibrate."""
    rows = _without_near_copies([(t or b"", y) for t, y in rows])
    toxic, ordinary = [t for t, y in rows if y], [t for t, y in rows if not y]
    if min(len(toxic), len(ordinary)) < MIN_CLASS:
        share = min(0.5, len(toxic) / len(rows)) if rows else 0.0
        return Model(b"", b"", (True, True), np.zeros(0), np.zeros(0), np.zeros(0), share)
    in_toxic = Counter(w for t in toxic[::2] for w in set(windows(t)))
    in_ordinary = Counter(w for t in ordinary[::2] for w in set(windows(t)))
    # a window of few toxic documents is chance: 5 documents, fewer only in tiny samples
    ratio, least = len(ordinary) / len(toxic), max(2, min(5, len(toxic) // 20), len(toxic) // 200)

    def sample(own: Counter, other: Counter, least: int, most: float) -> list[bytes]:
        # windows of several documents that the other side lacks, by document count
        return [b" " + w + b" " for w in sorted(own) if own[w] >= least and other[w] <= most * own[w] for _ in range(min(own[w], COPIES))]

    t_dict, t_raw = _train(sample(in_toxic, in_ordinary, least, 0))
    o_dict, o_raw = _train(sample(in_ordinary, in_toxic, max(2, least), 3 / ratio))
    cells = Cells(o_dict, t_dict, (o_raw, t_raw))
    held = [(t, 1) for t in toxic[1::2]] + [(t, 0) for t in ordinary[1::2]]
    x, y = features(np.array([cells.counts(t) for t, _ in held])), np.array([y for _, y in held], float)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-6] = np.inf  # a cell the sample lacks says nothing
    penalty = PENALTY * min(1.0, len(held) / 2000)
    return Model(o_dict, t_dict, (o_raw, t_raw), mean, scale, fit_logistic((x - mean) / scale, y, penalty))


def _score(model):
    cells: list[Cells] = []

    def run(batches):
        m: Model = model.value
        if m.constant is None and not cells:
            cells.append(Cells(m.ordinary, m.toxic, m.raw))
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            scores = np.full(b.num_rows, m.constant or 0.0)
            if m.constant is None:
                for i in range(0, b.num_rows, 256):
                    some = [cells[0].counts(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts.slice(i, 256)]
                    z = (features(np.array(some)) - m.mean) / m.scale @ m.weights[:-1] + m.weights[-1]
                    scores[i:i + len(some)] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], names=["doc_id", "score"])
    return run


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """At most MAX_TOXIC + MAX_ORDINARY (text, label) rows outside the held-out fold."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = known.filter("toxic = 1").orderBy(*order).limit(MAX_TOXIC).union(known.filter("toxic = 0").orderBy(*order).limit(MAX_ORDINARY))
    found = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(ids), "doc_id")  # at most 10,000 ids
    found = found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # a repeated id trains once
    return [(r.text, r.toxic) for r in found.orderBy(*order).collect()]


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(labelled_sample(docs, labels)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_score(model), f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
