"""Quality by importance resampling: hashed n-gram models and Gumbel top-k.

Two generative models count hashed byte n-grams: the target (labelled documents
of quality 1) and the raw corpus (every document).  A document's log importance
weight is the mean log ratio of the two over its n-grams, shrunk towards 0 for
short texts and put on a fixed scale, so a text's length does not decide.
Adding Gumbel noise (a hash of id and text) and keeping the k largest keys draws
k documents without replacement in proportion to their weights; k is the number
of documents of target quality that the calibrated weights make one expect.

The raw model's counts and k cover all documents.  The target and the
calibration use a bounded sample of labelled rows (``MAX_LABELS`` per class, the
smallest by a hash of the id) outside the held-out fold (crc32(doc_id as text)
mod 3 = 1).

Defined results: a null text or one of white space alone is never kept; ties at
the border are all kept; repeated rows are counted and kept alike; without labels
of both classes every document with a word is kept; null ids draw noise from
their text; extra columns pass through (the operator's own start with ``_is_``)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotide.llm import grams
from velotide.llm.common import written
from velotide.llm.toxicity import fit_logistic, held_out

BUCKETS, N_BYTES, SMOOTH = 1 << 16, 3, 1.0
MAX_LABELS, SHRINK, SCALE = 10_000, 200, 200.0


def buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram from each byte on, the text standing between blanks."""
    padded = np.concatenate([[32], data, [32]]).astype(np.uint64)
    size = max(0, len(padded) - N_BYTES + 1)
    out = np.zeros(size, np.uint64)
    for k in range(N_BYTES):
        out = (out << np.uint64(8)) | padded[k:k + size]
    with np.errstate(over="ignore"):
        return ((out * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def _texts(batch: pa.RecordBatch, name: str):
    for i, j, data, offsets in grams.groups(grams.text_column(batch, name)):
        for k in range(i, j):
            yield k, data[offsets[k - i]:offsets[k - i + 1]]


def _count(batches):
    """Bucket counts of all texts and of the target's, once a task."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b in batches:
        is_target = b.column(1).to_numpy(zero_copy_only=False)
        for k, data in _texts(b, "text"):
            if len(data):
                n = np.bincount(buckets(data), minlength=BUCKETS) if len(data) > 4096 else None
                for counts in (raw, target) if is_target[k] else (raw,):
                    if n is None:
                        np.add.at(counts, buckets(data), 1)
                    else:
                        counts += n
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """log(target / raw) per bucket; BUCKETS rows come to the driver."""
    marked = docs.select("doc_id", "text").join(F.broadcast(target_ids.withColumn("_t", F.lit(True))), "doc_id", "left")
    counts = marked.select("text", F.coalesce("_t", F.lit(False)).alias("t")).mapInArrow(_count, "bucket int, raw long, target long")
    total = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = total.column("bucket").to_numpy()
    raw[at], target[at] = total.column("raw").to_numpy(), total.column("target").to_numpy()
    share = lambda x: (x + SMOOTH) / (x.sum() + SMOOTH * BUCKETS)
    return np.log(share(target)) - np.log(share(raw))


def gumbel(data: np.ndarray, ident: int | None) -> float:
    """Standard Gumbel noise fixed by text and id."""
    with np.errstate(over="ignore"):
        h = grams.mix(np.array([len(data) if ident is None else ident & (2 ** 64 - 1)], np.uint64) + np.uint64(0x5851F42D4C957F2D))
        if ident is None:
            h = grams.mix(h + buckets(data).astype(np.uint64).sum(dtype=np.uint64))
    u = (int(h[0] >> np.uint64(11)) + 0.5) / 2 ** 53
    return float(-np.log(-np.log(u)))


def _weigh(ratios, names: list[str]):
    def run(batches):
        table = ratios.value
        for b in batches:
            weight, key = np.full(b.num_rows, np.nan), np.full(b.num_rows, -np.inf)
            ids = b.column(names.index("doc_id"))
            for k, data in _texts(b, "text"):
                if len(data) and not grams._SPACE[data].all():
                    found = table[buckets(data)]
                    weight[k] = SCALE * found.sum() / (len(found) + SHRINK)
                    key[k] = weight[k] + gumbel(data, ids[k].as_py())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(weight), pa.array(key)], names=[*names, "_is_weight", "_is_key"])
    return run


def weighed(docs: DataFrame, ratios) -> DataFrame:
    """``docs`` with ``_is_weight`` (NaN without words) and ``_is_key``."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_is_weight", T.DoubleType()), T.StructField("_is_key", T.DoubleType())])
    return docs.mapInArrow(_weigh(ratios, docs.columns), schema)


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value of a column: counts of ever narrower bins; at most
    ``bins`` counts or values come to the driver at a time."""
    x = F.col(col)
    low, high = df.agg(F.min(x), F.max(x)).first()
    while True:
        inside = df.filter((x >= low) & (x <= high))
        above = df.filter(x > high).count()
        if low == high:
            return low
        at = F.least(F.floor((x - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1)).cast("int")
        counts = inside.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).collect()
        for r in sorted(counts, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                break
            above += r["n"]
        if r["n"] <= bins:
            values = sorted((v[0] for v in df.filter((x >= r["low"]) & (x <= r["high"])).select(x).collect()), reverse=True)
            return values[max(k - above, 1) - 1]
        low, high = r["low"], r["high"]


class Selection:
    """A fitted model: log ratios, calibration, and the border of the k largest keys."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        spark = docs.sparkSession
        known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(
            F.min("quality").alias("quality"))
        order = [F.xxhash64("doc_id"), "doc_id"]
        sample = known.filter("quality = 1").orderBy(*order).limit(MAX_LABELS).union(
            known.filter("quality = 0").orderBy(*order).limit(MAX_LABELS))
        sample = written(sample, "labels")  # at most 2 * MAX_LABELS ids
        self.ratios = spark.sparkContext.broadcast(log_ratios(docs, sample.filter("quality = 1").select("doc_id")))
        slim = docs.select("doc_id", "text")
        self.scores = written(weighed(slim, self.ratios).drop("text").filter("NOT isnan(_is_weight)"), "weights")
        fit = self.scores.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("_is_weight").alias("w")).toArrow()
        y, w = fit.column("quality").to_numpy().astype(float), fit.column("w").to_numpy()
        self.k, self.border = None, -np.inf
        self.slope, self.intercept = 0.0, 0.0
        if 0 < y.sum() < len(y):
            # both classes count as in the labels, not as in the sample
            self.slope, self.intercept = fit_logistic(w[:, None], y, 1e-3)
            shares = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
            self.intercept += float(np.log(shares[1] / shares[0]) - np.log(y.sum() / (len(y) - y.sum())))
            z = F.lit(float(self.slope)) * F.col("_is_weight") + F.lit(float(self.intercept))
            expected = self.scores.agg(F.sum(1 / (1 + F.exp(-z)))).first()[0] or 0.0
            self.k = int(round(expected))
            if self.k:
                self.border = kth_largest(self.scores, "_is_key", self.k)
            else:
                self.border = np.inf

    def kept(self):
        return (F.col("_is_key") >= F.lit(float(self.border))) & ~F.isnan("_is_weight")

    def select(self, docs: DataFrame) -> DataFrame:
        """Rows of ``docs`` that the draw keeps; weights and noise are computed again
        in the scan, so no text is shuffled."""
        return weighed(docs, self.ratios).filter(self.kept()).select(*docs.columns)


def importance_resampling(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, log_weight, key, kept) of every document."""
    s = Selection(docs, labels)
    out = weighed(docs.select("doc_id", "text"), s.ratios)
    return out.select("doc_id", F.col("_is_weight").alias("log_weight"), F.col("_is_key").alias("key"), s.kept().alias("kept"))
