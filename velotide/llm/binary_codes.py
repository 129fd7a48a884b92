"""Embedding near-dedup by randomised-rotation binary codes.

A unit vector o is rotated by a random orthogonal matrix; its code is the sign of
every coordinate, and its correction factor f = <o, code / sqrt(D)> is stored.
For a rotated unit vector q the estimate <q, code / sqrt(D)> / f of <o, q> is
unbiased, with an error beyond e * sqrt((1 - f^2) / (f^2 (D - 1))) only with a
probability that falls as exp(-c e^2).  q itself is kept in one signed byte per
coordinate; the rounding error's norm is known and widens the bound.

* Equal vectors (same label) are one class, compared once and counted as often
  as they stand in the table.
* Classes meet in buckets: bands of ``band_bits`` code bits of several rotations.
  Two vectors at the threshold's angle t agree in a bit with probability
  1 - t / pi; ``tuned_bands`` takes as many bands as miss such a pair with a
  probability of ``miss`` at most (closer pairs far more rarely).
* Buckets are compared in blocks on codes and factors alone: pairs whose upper
  confidence bound lies below the threshold are ruled out.  Members with a pair
  left come back with their vectors, and those pairs' cosines are recomputed
  exactly in double precision.  A pair is handled in the first band it shares, so
  links are counted once, and no table of pairs within a bucket is made: a block
  returns counts per member and a spanning forest.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without a label or id, link with nothing (their component
is their id); vectors of different lengths never link; rows that repeat an id
are vectors of their own.  Extra columns are ignored."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.blocks import Forest, block_units, runs
from velotide.llm.common import written
from velotide.llm.components import components

THRESHOLD, BAND_BITS, MISS, SIGMAS, BLOCK, SEED = 0.98, 20, 1e-6, 5.0, 512, 7
PAIRS = 4096  # cosines computed at a time


def tuned_bands(threshold: float, band_bits: int = BAND_BITS, miss: float = MISS) -> int:
    same = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(miss) / math.log(1 - same ** band_bits))


def rotations(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """(dim, >= bits) columns of random orthogonal matrices, drawn until there are enough."""
    rng, parts = np.random.default_rng(seed + dim), []
    while sum(p.shape[1] for p in parts) < bits:
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        parts.append(q * np.sign(np.diag(r)))
    return np.concatenate(parts, axis=1)


class Coder:
    """Codes of one dimension: band keys, and the code and factor of the first rotation."""

    def __init__(self, dim: int, bands: int, band_bits: int):
        self.dim, self.bands, self.bits = dim, bands, band_bits
        self.turn = rotations(dim, max(bands * band_bits, dim))

    def keys(self, unit: np.ndarray) -> np.ndarray:
        signs = (unit @ self.turn[:, :self.bands * self.bits] > 0).reshape(len(unit), self.bands, self.bits)
        return signs @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))

    def code(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sign bits, correction factors, rotated vectors in bytes, and the bytes' steps."""
        z = unit @ self.turn[:, :self.dim]
        step = np.maximum(np.abs(z).max(1), 1e-30) / 127
        return np.packbits(z > 0, axis=1), np.abs(z).sum(1) / math.sqrt(self.dim), np.rint(z / step[:, None]).astype(np.int8), step


def upper_bounds(bits: np.ndarray, factors: np.ndarray, coords: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Upper confidence bounds of the inner products of all pairs of rows: each
    pair is estimated from either side's code, and the lower bound counts."""
    dim = coords.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    middle = signs @ (coords.astype(np.float32) * steps[:, None].astype(np.float32)).T / (math.sqrt(dim) * factors[:, None])
    half = SIGMAS * np.sqrt(np.maximum(1 - factors ** 2, 0) / (factors ** 2 * max(dim - 1, 1)))
    rounding = (steps / 2 * math.sqrt(dim))[None, :] / factors[:, None]
    upper = middle + half[:, None] + rounding + 1e-5
    return np.minimum(upper, upper.T)


def _prepare(bands: int, band_bits: int):
    """Class rows: id, label, copies, dim, unit vector -> code, factor, band keys."""
    coders: dict[int, Coder] = {}

    def run(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                coder = coders.setdefault(int(dim), Coder(int(dim), bands, band_bits))
                part = b.take(pa.array(rows))
                flat = part.column(2).flatten().to_numpy().astype(np.float64).reshape(len(rows), dim)
                unit = flat / np.linalg.norm(flat, axis=1, keepdims=True)
                codes, factors, coords, steps = coder.code(unit)
                keys = coder.keys(unit)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factors),
                     pa.array([c.tobytes() for c in coords], pa.binary()), pa.array(steps), pa.array(list(keys.astype(np.int32)), pa.list_(pa.int32()))],
                    names=["cid", "dim", "code", "factor", "coords", "step", "keys"])
    return run


def candidate_pairs(unit: pa.Table, threshold: float) -> np.ndarray:
    """Pairs of a unit that first meet in its band and whose upper confidence bound
    reaches the threshold."""
    n, dim = unit.num_rows, unit.column("dim")[0].as_py()
    gi, gj, band = (unit.column(c)[0].as_py() for c in ("gi", "gj", "band"))
    pairs = np.triu(np.ones((n, n), bool), 1)
    if gi != gj:
        mine = unit.column("mine").to_numpy()
        pairs &= mine[:, None] != mine[None, :]
    keys = unit.column("keys").combine_chunks().flatten().to_numpy().reshape(n, -1)[:, :band]
    if n <= 64:
        pairs &= ~(keys[:, None, :] == keys[None, :, :]).any(axis=2)
    else:
        for k in keys.T:
            pairs &= k[:, None] != k[None, :]
    if pairs.any():
        codes = np.frombuffer(b"".join(unit.column("code").to_pylist()), np.uint8).reshape(n, -1)
        coords = np.frombuffer(b"".join(unit.column("coords").to_pylist()), np.int8).reshape(n, dim)
        pairs &= upper_bounds(codes, unit.column("factor").to_numpy(), coords, unit.column("step").to_numpy()) >= threshold
    return np.argwhere(pairs)


UNIT = ["bucket", "gi", "gj"]


def _survivors(threshold: float):
    def run(batches):
        for unit in runs(batches, UNIT):
            rows = np.unique(candidate_pairs(unit, threshold))
            if len(rows):
                yield from unit.take(pa.array(rows)).combine_chunks().to_batches()
    return run


def _exact(threshold: float):
    """Per unit: (kind 0) links counted per class, (kind 1) a forest of the links."""
    def run(batches):
        for unit in runs(batches, UNIT):
            pairs = candidate_pairs(unit, threshold)
            if not len(pairs):
                continue
            dim = unit.column("dim")[0].as_py()
            flat = unit.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dim)
            a, b = pairs.T
            hit, norms = np.zeros(len(pairs), bool), np.linalg.norm(flat, axis=1)
            for i in range(0, len(pairs), PAIRS):
                x, y = a[i:i + PAIRS], b[i:i + PAIRS]
                hit[i:i + PAIRS] = np.einsum("ij,ij->i", flat[x], flat[y]) / (norms[x] * norms[y]) >= threshold
            if not hit.any():
                continue
            a, b, ids, copies = a[hit], b[hit], unit.column("cid").to_numpy(), unit.column("copies").to_numpy()
            links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
            forest, tree = Forest(len(ids)), []
            for x, y in zip(a.tolist(), b.tolist()):
                if forest.find(x) != forest.find(y):
                    forest.join(x, y)
                    tree.append((x, y))
            x, y = np.array(tree).T
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[some], ids[x]])), pa.array(np.concatenate([links[some].astype(np.int64), ids[y]])),
                 pa.array(np.repeat([False, True], [len(some), len(x)]))], names=["a", "b", "link"])
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, band_bits: int = BAND_BITS, miss: float = MISS) -> DataFrame:
    """Per vector: vec_id, n_links (other vectors at ``threshold`` or above with the
    same label), component_id (smallest vec_id reachable, itself included), kept."""
    bands = tuned_bands(threshold, band_bits, miss)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
              & finite & F.exists("vector", lambda x: x != 0))
    usable = F.coalesce(usable, F.lit(False))
    # adding 0.0 makes -0.0 and 0.0 one; two hashes of 64 bits name the class
    norm = F.transform("vector", lambda x: x + F.lit(0.0))
    v = v.withColumn("ok", usable).withColumn("h1", F.xxhash64(F.lit(1), "label", norm)).withColumn("h2", F.xxhash64(F.lit(2), "label", norm))
    good = v.filter("ok")
    sizes = written(good.groupBy("h1", "h2").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("copies")), "classes")
    # of rows that share the smallest id of their class, one carries the vector
    first = good.withColumnRenamed("vec_id", "cid").join(sizes, ["h1", "h2", "cid"]).dropDuplicates(["h1", "h2"])
    # a class is named by its smallest id; where repeated ids give two classes one name, both are kept apart by the row number
    named = written(first.select("cid", F.size("vector").alias("dim"), "vector", "label", "copies", "h1", "h2").withColumn(
        "key", F.monotonically_increasing_id()), "class-vectors")
    coded = written(named.select(F.col("key").alias("cid"), "dim", "vector").mapInArrow(
        _prepare(bands, band_bits), "cid long, dim int, code binary, factor double, coords binary, step double, keys array<int>"), "codes")
    at = coded.join(named.select(F.col("key").alias("cid"), "label", "copies"), "cid")
    rows = at.select("cid", F.posexplode("keys").alias("band", "k"), "label", "dim").select(
        "cid", "band", F.xxhash64("label", "dim", "band", "k").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = rows.join(shared, "bucket")
    units = block_units(members, "bucket", "cid", BLOCK).join(at.select("cid", "dim", "code", "factor", "coords", "step", "keys", "copies"), "cid")
    cols = ["bucket", "gi", "gj", "mine", "band", "cid", "copies", "dim", "code", "factor", "coords", "step", "keys"]
    schema = "bucket long, gi int, gj int, mine int, band int, cid long, copies long, dim int, code binary, factor double, coords binary, step double, keys array<int>"
    left = units.select(*cols).repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(_survivors(threshold), schema)
    left = left.join(named.select(F.col("key").alias("cid"), "vector"), "cid").repartition(*UNIT).sortWithinPartitions(*UNIT)
    found = written(left.mapInArrow(_exact(threshold), "a long, b long, link boolean"), "links")
    counts = found.filter("NOT link").groupBy(F.col("a").alias("key")).agg(F.sum("b").alias("near"))
    names = named.select("key", "cid", "h1", "h2", "copies")
    links = found.filter("link").join(names.select(F.col("key").alias("a"), F.col("cid").alias("x")), "a").join(
        names.select(F.col("key").alias("b"), F.col("cid").alias("y")), "b")
    comp = components(links, "x", "y").withColumnRenamed("node", "cid")
    classes = names.join(counts, "key", "left").join(comp, "cid", "left")
    classes = classes.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    linked = good.select("vec_id", "h1", "h2").join(classes, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = v.filter("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
                                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
