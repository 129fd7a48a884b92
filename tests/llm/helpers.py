"""Small tables with awkward rows, and brute-force versions."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# extra columns whose names clash with names the operators use inside
CLASH = ["key", "p", "u", "doc", "row", "h1", "size", "seq", "n", "words", "part", "block", "x", "z", "component", "keeper", "match"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def documents(spark, rows, clash=False):
    """rows: (doc_id, text)."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"clash-{c}").alias(c) for c in CLASH])
    return df


def words(n, rng, vocabulary=400):
    return [f"w{int(rng.paretovariate(0.6)) % vocabulary}{rng.choice('abcde')}" for _ in range(n)]


def sentence_text(n, rng):
    out = []
    while n > 0:
        k = min(n, rng.randint(4, 14))
        out.append(" ".join(words(k, rng)).capitalize() + rng.choice([".", "!", "?"]) + rng.choice([" ", " ", "\n"]))
        n -= k
    return "".join(out).strip()


def corpus(seed=1):
    """Unique texts, exact and near copies, nulls, empty, short, tied, very long and odd texts."""
    rng = random.Random(seed)
    rows, base = [], [sentence_text(rng.randint(30, 200), rng) for _ in range(12)]
    for i, t in enumerate(base):
        rows.append((i, t))
    for i in range(30):
        w = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(words(3, rng))
        rows.append((100 + i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, "   \t\n "), (203, "one"), (204, "ONE"), (205, "a b"), (206, "A  B"),
             (207, "\n\n\n"), (208, "été à la plage ́x 漢字 😀 it's <|endoftext|> 'Tis don't\x1c!\x1c! x1y22"),
             (None, base[0]), (None, None), (None, "no id at all here"), (3, base[3]), (3, base[3]),
             (300, sentence_text(8000, rng)), (301, " ".join(["same"] * 3000))]
    return rows


def shingles(text, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)])


def brute_components(items, linked):
    """items: id -> value; linked(a, b) -> bool; smallest id of each component."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(items)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if linked(items[a], items[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def jaccard_at_least(a, b, percent):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)
