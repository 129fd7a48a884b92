"""Best-fit packing in bulk-synchronous rounds.

``pieces`` tokenizes whole texts and cuts only those longer than a sequence.
``pack`` places the pieces into sequences, by waves of falling length, each in
rounds over two tables, pieces without a place and sequences with a gap:

1. range-sort both by size together (ties dealt by a hash, so a size that a
   third of all pieces have spans several ranges);
2. sweep each range from its largest piece down: a piece takes the smallest gap
   that holds it (its successor), and the gap's rest stays on offer;
3. what a range could not place is matched across ranges by rank: the counts by
   range and size come to the driver (a range holds few sizes), which pairs the k-th
   open piece with the k-th open gap of the nearest larger ranges;
4. gaps are updated and the next round begins; once a round places few pieces,
   those without a gap open about as many new sequences as their tokens fill: the
   largest ones, of pieces tied at the border an even share by hash;
5. when all that is left is no more than one range, its sweep ends the work: a
   piece without a gap opens a sequence there (best-fit decreasing).

Every round's tables are written to the shared folder.  Defined results: a null
or empty text is the single end token; null ids and repeated rows are pieces of
their own; no documents give no pieces.  Extra columns are ignored."""

from __future__ import annotations

import zlib
from array import array
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import written
from velotide.llm.word_table import tokenizer
from velotide.session import scratch_path

CAPACITY, END_ID = 2048, 0
WAVES = (4,)  # sizes above capacity / 4 first, then all
PROGRESS = 0.9  # a round that leaves more of its pieces than this opens new sequences
RANGE_ROWS = 100_000  # rows of a range: a round has as many tasks as its rows need
SPECIAL = "<|"  # texts that may hold a special token's string are encoded whole
PIECE = "pid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _ranks_encoder(source: str):
    """A rank-merge encoder over the vocabulary of a byte-level BPE file: the same
    ids as the ``tokenizers`` library for text without special tokens."""
    import json

    import public_tokenizers
    import tiktoken

    spec = json.loads(source)
    kept = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]  # bytes written as themselves
    rest = [b for b in range(256) if b not in kept]
    byte = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_ENCODERS: dict[int, tuple] = {}


def text_ids(texts: list[str], source: str) -> list[bytes]:
    """Ids (little-endian unsigned 32-bit) of each text.  Texts that may hold a special
    token's string are encoded by the ``tokenizers`` library, which knows it; for all
    others the vocabulary's ranks give the same ids at a fifth of the cost."""
    key = hash(source)
    if key not in _ENCODERS:
        _ENCODERS[key] = tokenizer(source), _ranks_encoder(source)
    whole, ranks = _ENCODERS[key]
    return [array("I", whole.encode(x, add_special_tokens=False).ids if SPECIAL in x else ranks.encode_ordinary(x)).tobytes() for x in texts]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def _pieces(source, capacity: int):
    end = END_ID.to_bytes(4, "little")

    def run(batches):
        for b in batches:
            i = 0
            texts = b.column(1)
            while i < b.num_rows:  # about a million characters at a time
                j, n, group = i, 0, []
                while j < b.num_rows and (not group or n < 1 << 20):
                    group.append(texts[j].as_py() or "")
                    n, j = n + len(group[-1]), j + 1
                rows = []
                for doc, ids in zip(b.column(0).slice(i, j - i).to_pylist(), text_ids(group, source.value)):
                    ids += end
                    rows += [(doc, k, s, m, zlib.crc32(memoryview(ids)[4 * s:4 * (s + m)]))
                             for k, (s, m) in enumerate(cut(len(ids) // 4, capacity))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
                i = j
    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents, written once; ``pid`` numbers them."""
    with open(tokenizer_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    p = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _pieces(source, capacity), PIECE.removeprefix("pid long, "))
    return written(p.withColumn("pid", F.monotonically_increasing_id()), "pieces")


def best_fit(sizes, ids, gaps, seqs, used, capacity: int, opening: bool = False):
    """Pieces in falling order of size into the gaps: (placed (piece, sequence,
    offset), pieces left, {gap: [(sequence, used)]} after it).  One bit per
    possible gap tells in one step the smallest that holds a piece.  With ``opening``
    a piece without a gap opens a sequence."""
    shelf: dict[int, list[tuple[int, int]]] = {}
    mask = 0
    for g, s, u in zip(gaps, seqs, used):
        shelf.setdefault(g, []).append((s, u))
        mask |= 1 << g
    placed, left = [], []
    for size, i in zip(sizes, ids):
        above = mask >> size
        if not above and opening:
            shelf.setdefault(capacity, []).append((i, 0))
            mask |= 1 << capacity
            above = mask >> size
        if not above:
            left.append((i, size))
            continue
        g = size + (above & -above).bit_length() - 1
        seq, u = shelf[g].pop()
        if not shelf[g]:
            mask &= ~(1 << g)
        placed.append((i, seq, u))
        if g > size:
            shelf.setdefault(g - size, []).append((seq, u + size))
            mask |= 1 << (g - size)
    return placed, left, shelf


SWEPT = "part int, kind int, rank long, id long, size int, used int, seq long"
PLACED, PIECE_LEFT, GAP_OFFERED, GAP_KEPT = range(4)


def _sweep(capacity: int, opening: bool = False):
    """One range: kind 0 piece placed, 1 piece left, 2 gap on offer to smaller ranges, 3 other gap."""
    def run(batches):
        cols = [np.concatenate(c) for c in zip(*([b.column(i).to_numpy() for i in range(5)] for b in batches if b.num_rows))]
        if not cols:
            return
        part, kind, ident, size, used = cols
        is_gap = kind == 1
        order = np.argsort(-size[~is_gap], kind="stable")
        p_size, p_id = size[~is_gap][order].tolist(), ident[~is_gap][order].tolist()
        placed, left, shelf = best_fit(p_size, p_id, size[is_gap].tolist(), ident[is_gap].tolist(), used[is_gap].tolist(), capacity, opening)
        floor = int(size.min())
        rows = [(PLACED, 0, i, 0, u, s) for i, s, u in placed]
        rows += [(PIECE_LEFT, r, i, n, 0, 0) for r, (i, n) in enumerate(left)]
        offered = [(g, s, u) for g in sorted(shelf) for s, u in shelf[g] if g >= floor]
        rows += [(GAP_OFFERED, r, s, g, u, s) for r, (g, s, u) in enumerate(offered)]
        rows += [(GAP_KEPT, 0, s, g, u, s) for g in shelf if g < floor for s, u in shelf[g]]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        for i in range(0, len(rows), 50_000):
            some = rows[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([int(part[0])] * len(some), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*some), types))],
                                             names=[x.split()[0] for x in SWEPT.split(", ")])
    return run


def rank_segments(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """From (range, pieces left, gaps on offer), ranges from the largest sizes
    down: (range and first rank of pieces, range and first rank of gaps, length,
    first match number).  Pieces take the gaps of the nearest larger range."""
    stack: list[list[int]] = []
    out, number = [], 0
    for part, n_pieces, n_gaps in counts:
        rank = 0
        while rank < n_pieces and stack:
            g_part, g_rank, g_n = stack[-1]
            n = min(n_pieces - rank, g_n)
            out.append((part, rank, g_part, g_rank, n, number))
            rank, number = rank + n, number + n
            if n == g_n:
                stack.pop()
            else:
                stack[-1] = [g_part, g_rank + n, g_n - n]
        if n_gaps:
            stack.append([part, 0, n_gaps])
    return out


def _numbered(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows with a match number: those whose rank lies in a segment of their range."""
    at = F.col("rank") - F.col("first")
    return rows.join(segments, ["part", "kind"]).filter((at >= 0) & (at < F.col("n"))).withColumn("match", F.col("number") + at)


SEGMENT = "part int, kind int, first long, n long, number long, matched long"
CROSSED = "pid long, seq long, used int, size int, gap int"


def _both(todo: DataFrame, gaps: DataFrame) -> DataFrame:
    return todo.select(F.lit(0).alias("kind"), F.col("pid").alias("id"), F.col("size").cast("int").alias("size"), F.lit(0).alias("used")).union(
        gaps.select(F.lit(1), "seq", "gap", "used"))


class Left(NamedTuple):
    """What a round leaves: pieces (pid, size) and gaps (seq, gap, used), how many
    pieces of each size, at most how many gaps and how large."""

    pieces: DataFrame
    gaps: DataFrame
    by_size: dict[int, int]
    n_gaps: int
    largest: int


def _round(todo: DataFrame, gaps: DataFrame, ranges: int, capacity: int, folder: str) -> Left:
    """One round.  ``folder`` gets its sweep and its matches across ranges; both
    tables left are read from these two."""
    spark = todo.sparkSession
    dealt = _both(todo, gaps).repartitionByRange(ranges, F.desc("size"), F.xxhash64("id", "kind")).select(
        F.spark_partition_id().alias("part"), "kind", "id", "size", "used")
    dealt.mapInArrow(_sweep(capacity), SWEPT).write.parquet(f"{folder}/swept")
    swept = spark.read.schema(SWEPT).parquet(f"{folder}/swept")
    left, offered = (swept.filter(F.col("kind") == k) for k in (PIECE_LEFT, GAP_OFFERED))
    found = swept.filter(F.col("kind") != PLACED).groupBy("part", "kind", "size").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {(r.part, r.kind): 0 for r in found}
    for r in found:
        counts[r.part, r.kind] += r.n
    segments = rank_segments([(p, counts.get((p, PIECE_LEFT), 0), counts.get((p, GAP_OFFERED), 0)) for p in sorted({r.part for r in found})])
    # a range's pieces and gaps are matched from rank 0 on: the rest needs no join
    gone: dict[tuple[int, int], int] = {}
    for p_part, _, g_part, _, n, _ in segments:
        gone[p_part, PIECE_LEFT] = gone.get((p_part, PIECE_LEFT), 0) + n
        gone[g_part, GAP_OFFERED] = gone.get((g_part, GAP_OFFERED), 0) + n
    by_size, largest, matched = {}, 0, dict(gone)
    # pieces are ranked from the largest on, gaps from the smallest
    for r in sorted(found, key=lambda r: -r.size if r.kind == PIECE_LEFT else r.size):
        taken = min(r.n, matched.get((r.part, r.kind), 0))
        matched[r.part, r.kind] = matched.get((r.part, r.kind), 0) - taken
        if r.kind == PIECE_LEFT and r.n > taken:
            by_size[r.size] = by_size.get(r.size, 0) + r.n - taken
        if r.kind != PIECE_LEFT:
            largest = max(largest, r.size - 1 if taken == r.n else r.size)
    rows = [x for p, p_rank, g, g_rank, n, number in segments
            for x in ((p, PIECE_LEFT, p_rank, n, number, gone[p, PIECE_LEFT]), (g, GAP_OFFERED, g_rank, n, number, gone[g, GAP_OFFERED]))]
    # written, so that the planner knows their size and broadcasts them below its threshold
    table = written(spark.createDataFrame(rows, SEGMENT), "segments")
    a = _numbered(left, table).select("match", F.col("id").alias("pid"), "size")
    b = _numbered(offered, table).select("match", "seq", "used", F.col("size").alias("gap"))
    a.join(b, "match").select("pid", "seq", "used", "size", "gap").write.parquet(f"{folder}/crossed")
    crossed = spark.read.schema(CROSSED).parquet(f"{folder}/crossed")
    taken = crossed.select("seq", (F.col("gap") - F.col("size")).alias("gap"), (F.col("used") + F.col("size")).alias("used"))
    matched = table.filter("first = 0").select("part", "kind", "matched")
    open_rows = swept.filter(F.col("kind") != PLACED).join(matched, ["part", "kind"], "left").filter(
        F.col("matched").isNull() | (F.col("rank") >= F.col("matched")))
    rest = open_rows.filter(F.col("kind") != PIECE_LEFT).select("seq", F.col("size").alias("gap"), "used").union(taken).filter("gap > 0")
    still = open_rows.filter(F.col("kind") == PIECE_LEFT).select(F.col("id").alias("pid"), "size")
    n_gaps = sum(n for (_, kind), n in counts.items() if kind != PIECE_LEFT)
    return Left(still, rest, by_size, n_gaps, largest)


def _opened(by_size: dict[int, int], capacity: int, salt: int) -> tuple[dict[int, int], Column]:
    """(pieces by size that open sequences, their condition): the largest, about as
    many as the sequences that all of them fill."""
    wanted = max(-(-sum(s * n for s, n in by_size.items()) // capacity), sum(n for s, n in by_size.items() if 2 * s > capacity))
    chosen: dict[int, int] = {}
    for size in sorted(by_size, reverse=True):
        n = by_size[size]
        if n >= wanted:
            chosen[size] = wanted
            share = F.pmod(F.xxhash64("pid", F.lit(salt)), F.lit(1 << 40)) < int((1 << 40) * wanted / n) + 1
            return chosen, (F.col("size") > size) | ((F.col("size") == size) & share)
        chosen[size], wanted = n, wanted - n
    return chosen, F.lit(True)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(pid, seq, used) for ``items`` (pid, size): places without overlap, each
    sequence gapless from 0.  A sequence is named by the piece that opened it."""
    spark = items.sparkSession
    path, rounds = scratch_path(spark, "packing"), []
    sizes = dict(sorted((r["size"], r["n"]) for r in items.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()))
    borders = [capacity, *(capacity // w for w in WAVES), 0]
    waves = list(zip(borders[1:], borders))
    full = items.filter(F.col("size") >= capacity).select("pid", F.col("pid").alias("seq"), F.lit(0).alias("used"))
    seeds, gaps = [full], spark.createDataFrame([], "seq long, gap int, used int")
    pieces = items.filter(F.col("size") < capacity).select("pid", F.col("size").cast("int").alias("size"))
    unplaced, n_gaps, finished = sum(n for s, n in sizes.items() if s < capacity), 0, None
    for low, high in waves:
        todo = pieces.filter((F.col("size") > low) & (F.col("size") <= high))
        by_size = {s: n for s, n in sizes.items() if low < s <= high and s < capacity}
        while by_size:
            before = sum(by_size.values())
            if unplaced + n_gaps <= RANGE_ROWS:
                # the rest of this wave and all later ones
                dealt = _both(todo.union(pieces.filter(F.col("size") <= low)), gaps).repartition(F.lit(0))
                dealt.select(F.lit(0).alias("part"), "kind", "id", "size", "used").mapInArrow(_sweep(capacity, True), SWEPT).write.parquet(f"{path}/last")
                finished = f"{path}/last"
                break
            fits = False
            if n_gaps:
                rounds.append(f"{path}/round-{len(rounds)}")
                left = _round(todo, gaps, 1 + (before + n_gaps) // RANGE_ROWS, capacity, rounds[-1])
                todo, gaps, by_size, n_gaps = left.pieces, left.gaps, left.by_size, left.n_gaps
                unplaced -= before - sum(by_size.values())
                fits = bool(by_size) and sum(by_size.values()) < PROGRESS * before and min(by_size) <= left.largest
            if by_size and not fits:  # else another round first
                chosen, condition = _opened(by_size, capacity, len(seeds))
                new = written(todo.filter(condition), "seeds")
                seeds.append(new.select("pid", F.col("pid").alias("seq"), F.lit(0).alias("used")))
                gaps = gaps.union(new.select(F.col("pid").alias("seq"), (F.lit(capacity) - F.col("size")).cast("int").alias("gap"), F.col("size").alias("used")))
                todo, opened = todo.filter(~condition), sum(chosen.values())
                n_gaps, unplaced = n_gaps + opened, unplaced - opened
                # of the tied size about as many as counted: the next round counts anew
                by_size = {s: n - chosen.get(s, 0) for s, n in by_size.items() if n > chosen.get(s, 0)}
        if finished:
            break
    places = reduce(DataFrame.union, seeds)
    if rounds or finished:
        swept = spark.read.schema(SWEPT).parquet(*(f"{r}/swept" for r in rounds), *([finished] if finished else [])).filter(F.col("kind") == PLACED)
        places = places.union(swept.select("id", "seq", "used"))
    if rounds:
        places = places.union(spark.read.schema(CROSSED).parquet(*(f"{r}/crossed" for r in rounds)).select("pid", "seq", "used"))
    return places


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there."""
    p = pieces(docs, tokenizer_path, capacity)
    places = pack(p.select("pid", F.col("length").alias("size")), capacity)
    return p.join(places, "pid").select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"),
                                        F.col("used").cast("long").alias("offset"))
