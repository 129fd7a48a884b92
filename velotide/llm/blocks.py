"""Comparing all members of a group, in blocks of bounded size.

A group of any size is cut into blocks by a hash of its members; each pair of
blocks is one unit of work, so no task holds more than two blocks.  ``runs``
streams the sorted units of a partition."""

from __future__ import annotations

from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import written


def block_units(members: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """(key, gi, gj, mine, columns of members): one row for each unit a member
    takes part in.  ``mine`` is its block; units with gi = gj compare a block
    with itself, others only across."""
    # only groups of more than one block need their size: a short table, joined by
    # the planner without a shuffle of the members where it is small
    sizes = members.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("_nb"))
    m = members.join(written(sizes.filter("_nb > 1"), "group-sizes"), key, "left").fillna(1, ["_nb"])
    mine = F.pmod(F.xxhash64(member, F.lit(11)), F.col("_nb")).cast("int")
    m = m.withColumn("mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return m.withColumn("gi", F.least("mine", "_other")).withColumn("gj", F.greatest("mine", "_other")).drop("_nb", "_other")


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys of a stream sorted by them."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        cols = [t.column(k).to_numpy() for k in keys]
        cut = np.zeros(t.num_rows, bool)
        cut[0] = last is not None and last != tuple(c[0] for c in cols)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        start = 0
        for at in np.flatnonzero(cut):
            if at > start:
                held.append(t.slice(start, at - start))
            if held:
                yield pa.concat_tables(held)
            held, start = [], at
        held.append(t.slice(start))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.concat_tables(held)


def lots(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 8192) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole units of a stream sorted by ``keys``, about ``rows`` rows together: a
    table and where its units start (one more entry at the end)."""
    held: list[pa.Table] = []
    size = 0

    def cuts(t: pa.Table) -> np.ndarray:
        new = np.ones(t.num_rows, bool)
        new[1:] = False
        for c in (t.column(k).to_numpy() for k in keys):
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
        if size >= rows:
            t = pa.concat_tables(held)
            starts = cuts(t)
            held, size = [t.slice(starts[-1])], t.num_rows - int(starts[-1])  # the last unit may go on
            if len(starts) > 1:
                yield t.slice(0, starts[-1]), starts
    if size:
        t = pa.concat_tables(held)
        yield t, np.append(cuts(t), t.num_rows)


class Forest:
    """Union-find over the rows of a unit."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def parity_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 64-bit words per set: bit h mod m is the parity of the members
    hashed there, so the Hamming distance of two rows is at most the size of the
    symmetric difference."""
    bits = 64 * max(8, -(-max(map(len, sets)) // 8))
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        odd = (np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
        out[i] = np.packbits(odd).view(np.uint64)
    return out


def small_forest(sets: list[frozenset], sides, percent: int) -> Iterator[tuple[int, int]]:
    """``jaccard_forest`` for a few sets: every pair is compared as it is."""
    forest = Forest(len(sets))
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j]
            low, high = sorted((len(a), len(b)))
            if low and 100 * low >= percent * high and (sides is None or sides[i] != sides[j]):
                both = len(a & b)
                if 100 * both >= percent * (low + high - both) and forest.find(i) != forest.find(j):
                    forest.join(i, j)
                    yield i, j


def jaccard_forest(sets: list[np.ndarray], sides: np.ndarray | None, percent: int) -> Iterator[tuple[int, int]]:
    """Links (row, row) with 100 |A and B| >= percent |A or B| that join the rows
    into the same trees as all such links would.  Sizes and sketch distances
    rule pairs out; the rest is verified on the whole sets.  With ``sides`` only
    pairs across sides are compared."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    forest, sketches = Forest(n), parity_sketches(sets) if n else None
    for i in range(n - 1):
        low, high = np.minimum(sizes[i], sizes[i + 1:]), np.maximum(sizes[i], sizes[i + 1:])
        far = np.bitwise_count(sketches[i] ^ sketches[i + 1:]).sum(axis=1, dtype=np.int64)
        near = (100 * low >= percent * high) & ((100 + percent) * far <= (100 - percent) * (low + high)) & (low > 0)
        if sides is not None:
            near &= sides[i + 1:] != sides[i]
        for j in np.flatnonzero(near) + i + 1:
            if forest.find(i) != forest.find(j):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                    forest.join(i, j)
                    yield i, int(j)
