"""N-gram Jaccard join by parity sketches.

Two sets of sizes a and b with Jaccard similarity of ``percent`` or more differ
in at most d = (100 - percent)(a + b) / (100 + percent) members.  Sizes are cut
into bands; in a band whose largest size is m, a set's members are dealt by hash
over C = D + 1 + E + F chunks, D being the bound for two sets of size m, and each
chunk is the XOR of its members' hashes.  The d differing members touch at most
D chunks, so linked sets agree in E + F + 1 chunks or more (pigeonhole).  Agreeing
on an empty chunk says nothing, so empty chunks are only emitted by a set with
more than E of them: a pair agrees in F + 1 emitted keys or more either way.  A
set whose partner may lie in the next band joins that band too.

Keys held by one set only are done with.  Of the others each set passes over its
F most frequent ones (by the number of sets, then by the key): of F + 1 agreed
keys the rarest has F more frequent ones in either set, so it stays in both and no
link is lost.  A set with F such keys or fewer has no link at all, and what many
sets share (a common line alone in its chunk) forms no group.

Equal sets are one class, joined through its 64-bit signature.  All sets that
agree in a chunk share that chunk's smallest signature, so grouping by it keeps
every colliding pair while a set appears once per group however many chunks it
shares.  Groups are compared in blocks, first on parity sketches alone (about a
bit per member): their Hamming distance bounds the difference from below and
rules pairs out.  Members with a pair left come back with their texts and those
pairs are verified exactly on the whole sets.  Each block returns a spanning
forest of its links: no table of pairs within a group is ever made.

Defined results: a null or empty text has an empty set, linked with nothing; a
text shorter than n words is one shingle; null ids are never linked and keep a
null component; rows with an equal id must hold the same text (they are one
document).  Extra columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotide.llm import grams
from velotide.llm.blocks import block_units, jaccard_forest, runs
from velotide.llm.common import written
from velotide.llm.components import components

BLOCK, SKETCH_BITS = 512, 1 << 16
MOST = 1 << 16  # sets of a key are counted so far; keys with more are equally frequent


def band_bounds() -> np.ndarray:
    """Smallest size of each band: steps of one half."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out, np.int64)


BOUNDS = band_bounds()


def chunk_plan(band: int, percent: int) -> tuple[int, int, int]:
    """(chunks, empty chunks passed over, frequent keys passed over) of a band;
    zeros where only equal sets link."""
    most = (100 - percent) * 2 * (int(BOUNDS[band + 1]) - 1) // (100 + percent)
    if not most:
        return 0, 0, 0
    spare, frequent = 2 + most // 100, 1 + most // 5
    return most + 1 + spare + frequent, spare, frequent


def chunk_keys(members: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Join keys of a sorted set in a band."""
    chunks, spare, _ = chunk_plan(band, percent)
    if not chunks:
        return np.zeros(0, np.uint64)
    at = ((members >> np.uint64(32)) * np.uint64(chunks)) >> np.uint64(32)  # ascending, as the members are
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    filled = at[first]
    value = np.bitwise_xor.reduceat(grams.mix(members), first)
    if chunks - len(filled) > spare:
        empty = np.setdiff1d(np.arange(chunks, dtype=np.uint64), filled, assume_unique=True)
        filled, value = np.concatenate([filled, empty]), np.concatenate([value, np.zeros(len(empty), np.uint64)])
    with np.errstate(over="ignore"):
        return grams.mix(value + grams.mix(filled * np.uint64(64) + np.uint64(band)))


def bands_of(size: int, percent: int) -> list[int]:
    """The band of a set's size, and the next one if a partner may lie there."""
    band = int(np.searchsorted(BOUNDS, size, "right")) - 1
    return [band, band + 1] if 100 * size >= percent * int(BOUNDS[band + 1]) else [band]


def set_keys(members: np.ndarray, percent: int) -> np.ndarray:
    return np.concatenate([chunk_keys(members, b, percent) for b in bands_of(len(members), percent)])


def sketch(members: np.ndarray, band: int) -> bytes:
    """Parity bits of a set, as many as the band's largest size (at most SKETCH_BITS)."""
    bits = min(SKETCH_BITS, 64 * -(-int(BOUNDS[band + 1]) // 64))
    odd = np.bincount((grams.mix(members) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signature(members: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        m = grams.mix(members + np.uint64(0x51ED2701))
        return int(m.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(grams.mix(m)).view(np.int64))


def _heads(n: int, percent: int):
    def rows(batches):
        for b in batches:
            size, s1, s2 = [np.zeros(b.num_rows, np.int64) for _ in range(3)]
            own, upper = [None] * b.num_rows, [None] * b.num_rows
            for k, members in grams.shingle_sets(grams.text_column(b), n):
                size[k] = len(members)
                if len(members):
                    s1[k], s2[k] = signature(members)
                    band, *more = bands_of(len(members), percent)
                    own[k] = sketch(members, band)
                    upper[k] = sketch(members, band + 1) if more else None
            band = np.searchsorted(BOUNDS, size, "right") - 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(s1), pa.array(s2), pa.array(band.astype(np.int32)),
                                              pa.array(own, pa.binary()), pa.array(upper, pa.binary())],
                                             names=["doc_id", "n", "s1", "s2", "band", "own", "upper"])
    return rows


def _keys(n: int, percent: int):
    def rows(batches):
        for b in batches:
            seen, keys, owners, bands = set(), [], [], []
            for _, members in grams.shingle_sets(grams.text_column(b), n):
                if len(members) and (s := signature(members)) not in seen:  # copies in a batch emit once
                    seen.add(s)
                    for band in bands_of(len(members), percent):
                        keys.append(chunk_keys(members, band, percent))
                        owners.append(np.full(len(keys[-1]), s[0], np.int64))
                        bands.append(np.full(len(keys[-1]), band, np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)),
                                                  pa.array(np.concatenate(owners)), pa.array(np.concatenate(bands))], names=["key", "s1", "band"])
    return rows


def _shared_keys(batches):
    """(key, s1, band, sets) of the keys with several sets, each set once, from a
    stream sorted by (key, s1)."""
    def rows(key, s1, band, sets):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(s1), pa.array(band), pa.array(sets)], names=["key", "s1", "band", "sets"])

    held, full = None, None  # rows of the last key, which may go on; a key known to have MOST sets
    for b in batches:
        if not b.num_rows:
            continue
        k, s, band = (c.to_numpy() for c in b.columns)
        if held is not None:
            k, s, band = (np.concatenate(x) for x in zip(held, (k, s, band)))
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        k, s, band = k[new], s[new], band[new]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        count = np.diff(np.append(first, len(k)))
        # the last key waits for the next batch, or goes on with its number of sets settled
        keep = slice(first[-1], None)
        sets = np.repeat(np.minimum(count, MOST), count)
        sets[k == full] = MOST  # its other sets went by before
        if count[-1] > MOST or k[-1] == full:
            full, keep = k[-1], slice(len(k) - 1, None)
        out = np.flatnonzero(sets[:keep.start] > 1)
        held = (k[keep], s[keep], band[keep])
        if len(out):
            yield rows(k[out], s[out], band[out], sets[out])
    if held is not None and (len(held[0]) > 1 or held[0][0] == full):
        yield rows(*held, np.full(len(held[0]), MOST if held[0][0] == full else len(held[0]), np.int64))


def rare_keys(keys: DataFrame, percent: int) -> DataFrame:
    """(key, s1, band): the shared keys of each set without its most frequent ones."""
    shared = keys.repartition("key").sortWithinPartitions("key", "s1").mapInArrow(_shared_keys, "key long, s1 long, band int, sets long")
    plans = [chunk_plan(band, percent)[2] for band in range(len(BOUNDS) - 1)]
    passed = F.get(F.array(*map(F.lit, plans)), F.col("band"))
    rank = F.row_number().over(Window.partitionBy("s1", "band").orderBy(F.desc("sets"), "key"))
    return shared.withColumn("rank", rank).filter(F.col("rank") > passed).select("key", "s1", "band")


def stars(batches):
    """(p, x) for every distinct x sharing a key with a smaller p, the smallest of
    the key, from a stream sorted by (key, s1); once per batch.  A third column
    (of the key, such as its band) goes along."""
    key = low = None
    for b in batches:
        if not b.num_rows:
            continue
        k, s, *more = (c.to_numpy() for c in b.columns)
        first = np.concatenate([[True], k[1:] != k[:-1]])
        if k[0] == key:
            first[0] = False
        lead = np.maximum.accumulate(np.where(first, np.arange(len(k)), -1))
        p = np.where(lead < 0, low if low is not None else 0, s[np.maximum(lead, 0)])
        key, low = k[-1], p[-1]
        hit = p != s
        if hit.any():
            pairs = np.unique(np.stack([p[hit], s[hit], *(m[hit].astype(np.int64) for m in more)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs.T], names=["p", "x", "band"][:pairs.shape[1]])


def sketch_pairs(unit: pa.Table, percent: int) -> np.ndarray:
    """Rows of a unit with a pair that sizes and sketches do not rule out."""
    sizes, words = unit.column("n").to_numpy(), unit.column("sketch").to_pylist()
    if len(set(map(len, words))) > 1:  # two groups whose names collided: nothing is ruled out here
        return np.arange(len(words))
    bits = np.frombuffer(b"".join(words), np.uint64).reshape(len(words), -1)
    cross = unit.column("gi")[0].as_py() != unit.column("gj")[0].as_py()
    mine, keep = unit.column("mine").to_numpy(), np.zeros(len(words), bool)
    for i in range(len(words) - 1):
        low, high = np.minimum(sizes[i], sizes[i + 1:]), np.maximum(sizes[i], sizes[i + 1:])
        near = 100 * low >= percent * high
        if cross:
            near &= mine[i + 1:] != mine[i]
        at = np.flatnonzero(near) + i + 1
        if len(at):
            far = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
            at = at[(100 + percent) * far <= (100 - percent) * (sizes[i] + sizes[at])]
            keep[at] = True
            keep[i] |= len(at) > 0
    return np.flatnonzero(keep)


UNIT = ["p", "gi", "gj"]


def _survivors(percent: int):
    def rows(batches):
        for unit in runs(batches, UNIT):
            left = sketch_pairs(unit, percent)
            if len(left):
                yield from unit.select([*UNIT, "mine", "doc_id"]).take(pa.array(left)).combine_chunks().to_batches()
    return rows


def _verify(n: int, percent: int):
    def rows(batches):
        unzip = zstandard.ZstdDecompressor()
        for unit in runs(batches, UNIT):
            ids = unit.column("doc_id").to_numpy()
            texts = pa.array([unzip.decompress(z.as_py()) for z in unit.column("z")], pa.large_binary())
            sets = [s for _, s in grams.shingle_sets(texts.cast(pa.large_string()), n)]
            cross = unit.column("gi")[0].as_py() != unit.column("gj")[0].as_py()
            sides = unit.column("mine").to_numpy() if cross else None
            links = list(jaccard_forest(sets, sides, percent))
            if links:
                a, b = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])
    return rows


def zipped(batches):
    """(doc_id, text compressed): shuffled texts take a third of their size."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([squeeze.compress(t.as_buffer()) if t.is_valid else None
                                          for t in grams.text_column(b).cast(pa.large_binary())], pa.binary())], names=["doc_id", "z"])


def jaccard_links(docs: DataFrame, n: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """(heads, links): per document its set size and signature; links (a, b) between
    class representatives whose components are those of all links."""
    if not 70 <= percent <= 100:
        raise ValueError("bands of one half hold similarities of 70 percent and more")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    heads = written(texts.mapInArrow(_heads(n, percent), "doc_id long, n long, s1 long, s2 long, band int, own binary, upper binary"), "sets")
    reps = heads.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("doc_id"))
    keys = texts.mapInArrow(_keys(n, percent), "key long, s1 long, band int")
    star = written(rare_keys(keys, percent).repartition("key").sortWithinPartitions("key", "s1").mapInArrow(
        stars, "p long, x long, band long").distinct(), "stars")
    members = star.union(star.select("p", F.col("p").alias("x"), "band").distinct())
    # one group per smallest signature and band: its sketches have one length
    members = members.select(F.xxhash64("p", "band").alias("p"), "x", "band")
    sketches = heads.join(reps.select("doc_id", "n", "s1", "s2"), ["doc_id", "n", "s1", "s2"], "left_semi").dropDuplicates(["doc_id"])
    sketches = sketches.select("doc_id", "n", F.col("s1").alias("x"), F.inline(F.array(
        F.struct(F.col("band").cast("long").alias("band"), F.col("own").alias("sketch")),
        F.struct((F.col("band") + 1).cast("long").alias("band"), F.col("upper").alias("sketch"))))).filter("sketch IS NOT NULL")
    members = members.join(sketches, ["x", "band"]).select("p", "doc_id", "n", "sketch")
    units = block_units(members, "p", "doc_id", BLOCK).select(*UNIT, "mine", "doc_id", "n", "sketch")
    left = units.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(
        _survivors(percent), "p long, gi int, gj int, mine int, doc_id long")
    # written, so that the planner knows how many documents are left: only their texts
    # travel, and these are joined in one way at every size
    left = written(left, "survivors")
    some = written(left.select("doc_id").distinct(), "survivor-ids")
    packed = texts.join(some, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(zipped, "doc_id long, z binary")
    # a repeated row of one document adds an equal set to its unit: no new component
    left = left.hint("merge").join(packed, "doc_id").repartition(*UNIT).sortWithinPartitions(*UNIT)
    links = left.select(*UNIT, "mine", "doc_id", "z").mapInArrow(_verify(n, percent), "a long, b long")
    return heads.select("doc_id", "n", "s1", "s2"), links


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the smallest
    doc_id reachable by links (itself included)."""
    heads, links = jaccard_links(docs, n, percent)
    comp = components(links)
    reps = heads.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    reps = reps.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    reps = reps.select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = heads.join(reps, ["n", "s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
