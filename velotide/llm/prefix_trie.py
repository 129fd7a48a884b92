"""Conversation prefix trie by burst tries.

Conversations are rebuilt (a prefix of their family's first conversation, then
their own turns) and equal ones form a class.  Every distinct prefix of a
rebuilt conversation is a node of one trie:

1. a class is a suffix in the container of the root, the first trie head;
2. a container of more than ``CONTAINER`` classes bursts by the next turn id:
   it becomes a trie head, its classes move to a container per next turn.  All
   containers burst at once, several levels a round and twice as many in the
   next, so the rounds grow with the logarithm of the depth.  Whether a prefix
   is a head is told by counting classes per prefix (combined before the
   shuffle); classes learn their deepest head by a join against the heads,
   which are at most one in ``CONTAINER`` of the rows and stand there once per
   salt, so that a head with a third of all rows is dealt over many tasks;
3. the remaining containers hold at most ``CONTAINER`` classes; each is sorted
   by its turn ids and swept once with a stack, which gives its nodes;
4. heads get their sums from the containers and heads below them (every path
   from a container to the root, combined before the shuffle).

A turn is known by 16 bytes of SHA-256 over role and text and carries its byte
length; a prefix by 16 bytes of SHA-256 over its turns.  Texts never leave the
first scan.

A conversation is one sequence: its turns (24 bytes each) stand in one row.  The
digest of a node's own members is a sequential hash: ids are range-sorted, packed
into pieces of text, and only these pieces meet.

Defined results: rows without conv_id belong to no conversation; turns of equal
number are ordered by their turn id; equal turns repeat; no rows give no nodes,
not even a root; extra columns are ignored."""

from __future__ import annotations

import hashlib
import zlib
from functools import reduce
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import written

FAMILY, HEADS = 5, 9  # conversations of a family; longest borrowed prefix + 1
TOKEN, LENGTH = 24, 8  # bytes of a turn: 16 of its hash, 8 of its length
CONTAINER, SALTS = 1024, 32
FIRST_LEVELS = 8
PIECE_IDS = 4096  # ids packed into one row for a digest
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_token() -> Column:
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    # the role's length keeps ("ab", "c") and ("a", "bc") apart
    name = F.concat_ws(":", F.octet_length(role), F.concat(role, text))
    size = F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))
    return F.concat(F.substring(F.unhex(F.sha2(name, 256)), 1, 16), size)


def borrowed(conv: int) -> int:
    """How many first turns a conversation takes from its family's first."""
    return zlib.crc32(str(conv).encode()) % HEADS


def _rebuild(batches):
    """(conv_id, seq) from rows sorted by family, first conversation of the family
    before the others, and turn."""
    ids, seqs = [], []
    family = head = None  # first turns of the family's first conversation
    conv, own = None, []

    def closed():
        nonlocal head
        if conv is not None:
            n = borrowed(conv)
            if conv == family:
                head = own[:HEADS - 1]
                ids.append(conv)
                seqs.append(b"".join(own))
            else:
                ids.append(conv)
                seqs.append(b"".join((head or [])[:n] + own[n:]))

    for b in batches:
        for f, c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if c != conv or f != family:
                closed()
                if f != family:
                    family, head = f, None
                conv, own = c, []
            own.append(t)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seqs, pa.binary())], names=["conv_id", "seq"])
            ids, seqs = [], []
    closed()
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seqs, pa.binary())], names=["conv_id", "seq"])


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): every conversation's turns after rebuilding."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        (F.col("conv_id") - F.col("conv_id") % FAMILY).cast("long").alias("family"), F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"), turn_token().alias("token"))
    later = F.col("conv_id") != F.col("family")
    dealt = rows.repartition("family").sortWithinPartitions("family", later, "conv_id", F.asc_nulls_first("turn"), "token")
    return dealt.select("family", "conv_id", "token").mapInArrow(_rebuild, "conv_id long, seq binary")


def key_of(seq: Column) -> Column:
    """Key of a sequence of turns; the empty one, the root, has one too."""
    return F.substring(F.unhex(F.sha2(seq, 256)), 1, 16)


def first_turns(seq: Column, depth: Column) -> Column:
    return F.substring(seq, F.lit(1), depth * TOKEN)


def _id_pieces(batches):
    """(k, first, ids): runs of a class's ascending ids as text, in pieces."""
    for b in batches:
        if not b.num_rows:
            continue
        ks, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
        out, at = [], 0
        for i in range(1, len(ks) + 1):
            if i == len(ks) or ks[i] != ks[at] or i - at == PIECE_IDS:
                out.append((ks[at], ids[at], ",".join(map(str, ids[at:i]))))
                at = i
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["k", "first", "ids"])


def _digests(batches):
    """(k, ends): SHA-256 of each class's pieces, from rows sorted by (k, first)."""
    key, sha = None, None
    for b in batches:
        out = []
        for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    out.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["k", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["k", "ends"])


def classes_of(convs: DataFrame) -> DataFrame:
    """(k, seq, low, n, ends): equal conversations once, with the digest of their ids."""
    keyed = convs.withColumn("k", key_of(F.col("seq")))
    grouped = keyed.groupBy("k").agg(F.any_value("seq").alias("seq"), F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n"))
    pieces = keyed.select("k", "conv_id").repartitionByRange("k", "conv_id").sortWithinPartitions("k", "conv_id").mapInArrow(
        _id_pieces, "k binary, first long, ids string")
    digests = pieces.repartition("k").sortWithinPartitions("k", "first").select("k", "ids").mapInArrow(_digests, "k binary, ends string")
    return grouped.join(digests, "k")


def _prefixes(low: int, high: int):
    """(prefix, depth, k, first, n, size): the class's prefixes of depths low to
    high; size is the last turn's bytes."""
    def run(batches):
        for b in batches:
            rows = []
            for k, seq, first, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                sha = hashlib.sha256(seq[:TOKEN * (low - 1)])
                for d in range(low, min(high, len(seq) // TOKEN) + 1):
                    token = seq[TOKEN * (d - 1):TOKEN * d]
                    sha.update(token)
                    rows.append((sha.digest()[:16], d, k, first, n, int.from_bytes(token[-LENGTH:], "big")))
                if len(rows) > 20_000:
                    yield _prefix_batch(rows)
                    rows = []
            if rows:
                yield _prefix_batch(rows)
    return run


PREFIX = "prefix binary, depth int, k binary, first long, n long, size long"


def _prefix_batch(rows):
    types = (pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[x.split()[0] for x in PREFIX.split(", ")])


def with_heads(rows: DataFrame, heads: DataFrame, by: str) -> DataFrame:
    """Join rows with the heads on a prefix that many rows may share: heads stand
    once per salt, rows take one by ``by``."""
    many = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return salted.join(many, ["prefix", "salt"]).drop("salt")


def burst(classes: DataFrame, container: int) -> tuple[DataFrame, DataFrame]:
    """(heads, places): heads (prefix, depth, low, n, size) of all containers that
    burst, and per class (k, depth, parent_low) of its deepest head."""
    spark = classes.sparkSession
    low_id, n, count = classes.agg(F.min("low"), F.sum("n"), F.count(F.lit(1))).first()
    root = [(hashlib.sha256(b"").digest()[:16], 0, low_id, n, 0)] if count else []
    heads = [spark.createDataFrame(root, "prefix binary, depth int, low long, n long, size long")]
    places = [classes.select("k", F.lit(0).alias("depth"), F.lit(low_id).cast("long").alias("parent_low"))]
    active, low, levels = classes, 1, FIRST_LEVELS
    while count > container:
        high = low + levels - 1
        emitted = active.select("k", "seq", "low", "n").mapInArrow(_prefixes(low, high), PREFIX)
        found = emitted.groupBy("prefix", "depth", "size").agg(F.min("first").alias("low"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes"))
        found = written(found.filter(F.col("classes") > container).select("prefix", "depth", "low", "n", "size"), "trie-heads")
        if found.isEmpty():
            break
        heads.append(found)
        deepest = with_heads(emitted.select("prefix", "k"), found.select("prefix", "depth", "low"), "k")
        deepest = written(deepest.groupBy("k").agg(F.max(F.struct("depth", "low")).alias("m")).select("k", "m.depth", F.col("m.low").alias("parent_low")), "trie-places")
        places.append(deepest)
        # who reached the last level inside a head goes on below it
        active = written(active.join(deepest.filter(F.col("depth") == high).select("k"), "k", "left_semi").filter(
            F.octet_length("seq") > high * TOKEN), "trie-active")
        low, levels = high + 1, 2 * levels
    best = reduce(DataFrame.union, places).groupBy("k").agg(F.max(F.struct("depth", "parent_low")).alias("m"))
    return written(reduce(DataFrame.union, heads), "trie-heads"), best.select("k", "m.depth", "m.parent_low")


NODE = ("conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
SWEPT = f"kind int, container binary, top binary, leaves long, saved long, {NODE}"


class _Open:
    """A node on the stack: the subtree below it is not complete yet."""

    __slots__ = ("at", "depth", "size", "low", "n", "children", "leaves", "saved", "ends", "below")

    def __init__(self, depth, size):
        self.depth, self.size, self.low, self.n = depth, size, None, 0
        self.children, self.leaves, self.saved, self.ends, self.below = 0, 0, 0, EMPTY_SHA, []


def sweep(rows: list[tuple], depth: int, parent_low: int) -> Iterator[tuple]:
    """Nodes of one container from its classes (seq, low, n, ends) in order of
    their turns; all share their first ``depth`` turns.  The node at ``depth`` is
    the last one given."""
    stack: list[_Open] = []
    before = b""

    def close(keep: int):
        while len(stack) > keep:
            node = stack.pop()
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.size
            for child in node.below:
                yield child.low, child.depth, node.low, child.n, child.children, child.leaves, child.saved, child.ends
            node.below = []
            if stack:
                up = stack[-1]
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
                up.n += node.n
                up.low = node.low if up.low is None else min(up.low, node.low)
                up.below.append(node)
            else:
                yield node.low, node.depth, parent_low, node.n, node.children, node.leaves, node.saved, node.ends

    for seq, low, n, ends in rows:
        total = len(seq) // TOKEN
        shared = depth - 1
        if stack:
            a = np.frombuffer(before, np.uint8, min(len(before), len(seq)))
            b = np.frombuffer(seq, np.uint8, len(a))
            differ = np.flatnonzero(a != b)
            shared = (int(differ[0]) if len(differ) else len(a)) // TOKEN
        yield from close(shared - depth + 1)
        for d in range(max(shared, depth - 1) + 1, total + 1):
            stack.append(_Open(d, int.from_bytes(seq[TOKEN * d - LENGTH:TOKEN * d], "big")))
        last = stack[-1]
        last.low = low if last.low is None else min(last.low, low)
        last.n += n
        last.ends = ends
        before = seq
    yield from close(0)


def _sweep_containers(batches):
    """Kind 0: nodes; kind 1: a container's sums, for the heads above it."""
    def swept(key, depth, parent_low, rows):
        nodes = list(sweep(rows, depth, parent_low))
        last = nodes[-1]
        out = [(0, None, None, None, None, *node) for node in nodes]
        out.append((1, key, rows[0][0][:TOKEN * (depth - 1)], last[5], last[6], *([None] * 8)))
        return out

    types = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string())
    names = [x.split()[0] for x in SWEPT.split(", ")]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    now, rows, out = None, [], []
    for b in batches:
        for key, depth, parent_low, seq, low, n, ends in zip(*(b.column(i).to_pylist() for i in range(7))):
            if now is None or key != now[0]:
                if now is not None:
                    out += swept(*now, rows)
                now, rows = (key, depth, parent_low), []
                if len(out) > 10_000:
                    yield batch(out)
                    out = []
            rows.append((seq, low, n, ends))
    if now is not None:
        out += swept(*now, rows)
    if out:
        yield batch(out)


def _paths(batches):
    """(prefix, leaves, saved) for every head above a container or head, from
    (turns up to the deepest of them, leaves, saved)."""
    def batch(rows):
        types = (pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["prefix", "leaves", "saved"])

    for b in batches:
        rows = []
        for top, leaves, saved in zip(*(b.column(i).to_pylist() for i in range(3))):
            sha = hashlib.sha256()
            rows.append((sha.digest()[:16], leaves, saved))
            for at in range(0, len(top), TOKEN):
                sha.update(top[at:at + TOKEN])
                rows.append((sha.digest()[:16], leaves, saved))
            if len(rows) > 20_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


def prefix_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    convs = written(rebuilt(conversations), "trie-convs")
    classes = written(classes_of(convs), "trie-classes")
    heads, places = burst(classes, container)
    placed = classes.join(places, "k")
    # classes that end in a head have no suffix left
    below = placed.filter(F.octet_length("seq") > F.col("depth") * TOKEN).withColumn("depth", F.col("depth") + 1)
    below = below.select(key_of(first_turns(F.col("seq"), F.col("depth"))).alias("container"), "depth", "parent_low", "seq", "low", "n", "ends")
    swept = written(below.repartition("container").sortWithinPartitions("container", "seq").mapInArrow(_sweep_containers, SWEPT), "trie-nodes")
    nodes = swept.filter("kind = 0").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    # heads: one of a head's classes tells the turns that lead to it
    tops = swept.filter("kind = 1").select("top", "leaves", "saved")
    own = heads.join(convs.select(F.col("conv_id").alias("low"), "seq"), "low").select(
        "prefix", "depth", "low", "n", first_turns(F.col("seq"), F.col("depth")).alias("path"),
        ((F.col("n") - 1) * F.col("size")).alias("saved"))
    own = written(own, "trie-paths")
    up = first_turns(F.col("path"), F.col("depth") - 1)
    sums = tops.union(own.select("path", F.lit(0).cast("long"), "saved")).mapInArrow(_paths, "prefix binary, leaves long, saved long")
    sums = sums.groupBy("prefix").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parents = own.filter("depth > 0").select(key_of(up).alias("parent"), "prefix")
    children = tops.select(key_of(F.col("top")).alias("prefix")).union(parents.select("parent")).groupBy("prefix").agg(
        F.count(F.lit(1)).alias("children"))
    above = parents.join(heads.select(F.col("prefix").alias("parent"), F.col("low").alias("parent_low")), "parent").select("prefix", "parent_low")
    ends = classes.select(F.col("k").alias("prefix"), "ends")
    full = own.select("prefix", "depth", "low", "n").join(sums, "prefix").join(children, "prefix", "left").join(
        above, "prefix", "left").join(ends, "prefix", "left")
    zero = F.lit(0).cast("long")
    head_nodes = full.select(
        F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("children", zero).alias("n_children"), F.when(F.col("children").isNull(), 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    out = nodes.union(head_nodes)
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
