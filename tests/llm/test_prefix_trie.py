"""Conversation trie against a plain dictionary of prefixes, with small and large containers."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F
from pyspark.sql import types as T

from velotide.llm.prefix_trie import prefix_trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = f"{len(role.encode())}:{role}{text}".encode()
            own[c].append((turn is not None, turn or 0, hashlib.sha256(name).digest(), role, text))
    for turns in own.values():
        turns.sort()
    built = {}
    for c in own:
        h, first = zlib.crc32(str(c).encode()) % 9, int(c - (c % 5 if c >= 0 else -(-c % 5)))
        built[c] = tuple((r, t) for *_, r, t in own.get(first, [])[:h]) + tuple((r, t) for *_, r, t in own[c][h:])
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    kids = defaultdict(list)
    for path in nodes:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(nodes[path]) - 1) * size + sum(saved[k] for k in kids[path])
    return sorted(
        (min(cs), len(path), min(nodes[path[:-1]]) if path else None, len(cs), len(kids[path]), leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(c for c in cs if built[c] == path))).encode()).hexdigest()) for path, cs in nodes.items())


def conversations(seed=3, n=120):
    rng, rows = random.Random(seed), []
    starts = [[("user", f"hello {k}")] * k for k in range(4)]
    for c in range(n):
        turns = starts[rng.randrange(4)] + [(rng.choice(["user", "assistant"]), rng.choice("abc") * rng.randrange(3)) for _ in range(rng.randrange(14))]
        if c % 3 == 0:  # a third are copies
            turns = [("system", "très"), ("user", "same"), ("assistant", "as ever")] * 5
        if c % 31 == 30:  # deep, and alike up to the last turns
            turns = [("user", "on")] * 40 + [("user", str(c))]
        rows += [(c * 2 if c % 7 else c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(900, None, None, None), (900, None, "user", "x"), (900, 5, "user", "y"), (900, 5, "user", "y"), (900, 5, "bot", "z"), (901, 0, None, ""),
             (-3, 0, "user", "minus"), (-7, 0, "user", "minus"), (-7, 1, "user", "minus"), (None, 0, "user", "nobody"), (902, 1, "user", "😀" * 30_000),
             (1004, 0, "user", "no first conversation in this family")]
    rng.shuffle(rows)
    return rows


def trie(spark, rows, container, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).select("*", *extra)
    return sorted((tuple(r) for r in prefix_trie(df, container).collect()), key=lambda r: (r[0], r[1]))


def test_nodes_equal_brute_force_for_any_container_size(spark):
    rows = conversations()
    wanted = sorted(brute(rows), key=lambda r: (r[0], r[1]))
    clash = [F.lit("x").alias(c) for c in ("family", "seq", "k", "prefix", "depth", "low", "n", "container", "kind", "salt")]
    assert trie(spark, rows, 1, clash) == wanted
    assert trie(spark, rows, 7) == wanted
    assert trie(spark, rows, 1024) == wanted


def test_empty_and_turnless(spark):
    assert trie(spark, [], 4) == []
    assert trie(spark, [(None, 0, "user", "x")], 4) == []
    # conversation 3 borrows from an absent one and loses all its own turns
    rows = [(3, 0, "user", "x")]
    assert zlib.crc32(b"3") % 9 >= 1
    assert trie(spark, rows, 4) == brute(rows) and len(brute(rows)) == 1
