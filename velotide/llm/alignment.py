"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers write the same bytes (a space and the text); offsets where a
token of each ends cut them into groups, and all tokens of a group are linked.

1. A task encodes its documents in lots of about ``LOT_CHARS`` characters and
   lines their token ends up one after another, so that a document's end is a
   common end.  Merging the two ascending lists of ends is cut along diagonals: a
   binary search on each finds how many ends of A lie before it, which gives
   pieces of equal work however the texts' lengths differ (``merge_path``).
2. Each piece finds its own common ends and numbers its tokens' groups from its
   first, open one.  Stitching adds the common ends of the pieces before: the
   tokens behind a piece's last common end and those before the next piece's
   first one get the same number, and so are one group.
3. Documents are packed in blocks of ``BLOCK_CHARS``: per document its distinct id
   pairs, as places in the block's list of pairs, with how often each is linked.
4. The blocks' pairs are counted over the corpus (per block first, then by Spark),
   and each A id's highest count is found.  A pair stands once per block, so the
   commonest one has as many rows as there are blocks.
5. Counts go back to the blocks and are summed up per document.

Texts are never shuffled.  A group of very many tokens is counted by its distinct
ids, not token by token.  A text's tokens are one task's work, since a tokenizer
takes a whole text.

Defined results: a null, empty or not reproducible text has no tokens, zeros and
an empty digest; repeated rows are documents of their own, also in the counts;
null ids keep their rows; extra columns are ignored."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import written

LOT_CHARS, BLOCK_CHARS, WORK = 1 << 20, 24 << 20, 1 << 13
WIDE = 4096  # links of a group counted by distinct ids
_MODELS: dict[int, "Tokenizers"] = {}


class Tokenizers:
    """A: byte-level BPE (its ranks, no special tokens); B: pieces with byte fallback."""

    def __init__(self, a_source: str, b_model: bytes):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        spec = json.loads(a_source)
        added = {t["content"] for t in spec["added_tokens"]}
        kept = [c for r in ((33, 127), (161, 173), (174, 256)) for c in range(*r)]  # bytes written as themselves
        byte = {chr(c): c for c in kept} | {chr(256 + k): c for k, c in enumerate(sorted(set(range(256)) - set(kept)))}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        n_a, n_b = max(ranks.values()) + 1, self.b.get_piece_size()
        a_bytes: list[bytes] = [b""] * n_a
        for t, i in ranks.items():
            a_bytes[i] = t
        self.a_bytes = a_bytes
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(n_b)))]
        self.a_size, self.b_size = (np.array([len(t) for t in ts], np.int64) for ts in (a_bytes, self.b_bytes))
        # printed ids with what follows them: inside and at the end of a group's A and B tokens
        self.printed = [b"%d%c" % (i, sign) for n, sign in ((n_a, 44), (n_a, 124), (n_b, 44), (n_b, 59)) for i in range(n)]
        self.n_a, self.n_b = n_a, n_b

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B per text; none where the bytes are not reproduced."""
        none = np.zeros(0, np.int32)
        for x, b in zip(texts, self.b.encode(texts, num_threads=1)):
            whole = (" " + x).encode()
            if not x or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
                yield none, none
                continue
            a = self.a.encode_ordinary(" " + x)
            same = b"".join(map(self.a_bytes.__getitem__, a)) == whole
            yield (np.array(a, np.int32), np.array(b, np.int32)) if same else (none, none)


def tokenizers(sources) -> Tokenizers:
    key = hash(sources)
    if key not in _MODELS:
        _MODELS[key] = Tokenizers(*sources)
    return _MODELS[key]


# ------------------------------------------------------------ merge path ---
def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Borders (in a, in b) of pieces of about ``work`` ends of both ascending
    lists, merged with a before an equal b; equal ends stay in one piece."""
    k = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, k - len(b)), np.minimum(k, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        before = np.zeros(len(k), bool)
        before[open_] = a[mid[open_]] <= b[(k - 1 - mid)[open_]]
        low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
    i, j = low, k - low
    split = (i > 0) & (j < len(b))
    split[split] = a[i[split] - 1] == b[j[split]]
    return i, j + split


def piece_groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group numbers of one piece's tokens, from its first (maybe open) group on,
    and how many groups end in it."""
    at = np.searchsorted(b, a)
    common = a[(at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a)] if len(b) else a[:0]
    return np.searchsorted(common, a), np.searchsorted(common, b), len(common)


def stitched_groups(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, int]:
    """Group of every token of A and B, and the number of groups."""
    i, j = merge_path(a, b, work)
    in_a, in_b, done = [], [], 0
    for p in range(len(i) - 1):
        x, y, closed = piece_groups(a[i[p]:i[p + 1]], b[j[p]:j[p + 1]])
        in_a.append(x + done)
        in_b.append(y + done)
        done += closed
    none = [np.zeros(0, np.int64)]
    return np.concatenate(none + in_a), np.concatenate(none + in_b), done


class Lot(NamedTuple):
    """Documents of one lot: counts per document, digests, and its links as
    ascending distinct (document, pair) with how often each is linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def _wide_links(a, b, n_b):
    """(pair, times) of one group by its distinct ids."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    return (ua.astype(np.int64)[:, None] * n_b + ub).ravel(), (ca[:, None] * cb).ravel()


def align(encoded: list[tuple[np.ndarray, np.ndarray]], t: Tokenizers) -> Lot:
    n_a, n_b = (np.array([len(e[s]) for e in encoded], np.int64) for s in (0, 1))
    a, b = (np.concatenate([e[s] for e in encoded]).astype(np.int64) for s in (0, 1))
    first_a, first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    ga, gb, n = stitched_groups(np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b]))
    size_a, size_b = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
    start_a, start_b = (np.concatenate([[0], np.cumsum(s)]) for s in (size_a, size_b))
    group_doc = np.searchsorted(first_a, start_a[:-1], "right") - 1  # rows without tokens own no group
    links = size_a * size_b
    n_groups = np.bincount(group_doc, minlength=len(encoded))
    n_links = np.zeros(len(encoded), np.int64)
    np.add.at(n_links, group_doc, links)

    order = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (ga, gb))
    order[np.arange(len(a)) + start_b[ga]] = a + t.n_a * last_a
    order[np.arange(len(b)) + start_a[gb + 1]] = b + 2 * t.n_a + t.n_b * last_b
    digests, at = [], first_a + first_b
    for s, e in zip(at[:-1], at[1:]):
        digests.append(hashlib.sha256(b"".join(map(t.printed.__getitem__, order[s:e].tolist()))[:-1]).hexdigest() if e > s else "")

    narrow = links <= WIDE
    some = np.flatnonzero(narrow[ga])  # tokens of A, each with the B tokens of its group
    times = size_b[ga[some]]
    of_a = np.repeat(some, times)
    of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(times) - times, times) + start_b[ga[of_a]]
    docs, pairs = [group_doc[ga[of_a]]], [a[of_a] * t.n_b + b[of_b]]
    counts = [np.ones(len(of_a), np.int64)]
    for g in np.flatnonzero(~narrow):
        p, c = _wide_links(a[start_a[g]:start_a[g + 1]], b[start_b[g]:start_b[g + 1]], t.n_b)
        docs.append(np.full(len(p), group_doc[g]))
        pairs.append(p)
        counts.append(c)
    key = np.concatenate(docs) * (t.n_a * t.n_b) + np.concatenate(pairs)
    if len(counts) == 1:
        key, times = np.unique(key, return_counts=True)
    else:
        key, place = np.unique(key, return_inverse=True)
        times = np.zeros(len(key), np.int64)
        np.add.at(times, place, np.concatenate(counts))
    doc, pair = np.divmod(key, t.n_a * t.n_b)
    return Lot(n_a, n_b, n_groups, n_links, digests, doc, pair, times)


# ---------------------------------------------------------------- blocks ---
def pack(values: np.ndarray, squeeze) -> bytes:
    """Unsigned 32-bit values, byte by byte of their places, compressed."""
    return squeeze.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack(data: bytes, unzip) -> np.ndarray:
    raw = np.frombuffer(unzip.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times")
BLOCK_ROW = "block binary, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, pairs binary"


def _lots(batches, limit: int):
    """Lists of (doc_id, text) of about ``limit`` characters."""
    lot, size = [], 0
    for b in batches:
        for i in range(b.num_rows):
            text = b.column(1)[i].as_py() or ""
            lot.append((b.column(0)[i], text))
            size += len(text)
            if size >= limit or len(lot) >= 4096:
                yield lot, size
                lot, size = [], 0
    if lot:
        yield lot, size


def _blocks(sources, id_type, block_chars: int):
    """Rows of documents, and for each block one row with its pairs and in how many
    of its documents each is linked."""
    def packed(ids, lots: list[Lot]):
        squeeze, block = zstandard.ZstdCompressor(level=3), uuid.uuid4().bytes
        pairs, place = np.unique(np.concatenate([x.pair for x in lots]), return_inverse=True)
        docs = np.bincount(place, minlength=len(pairs))
        done, first = 0, 0
        for lot in lots:
            borders = np.searchsorted(lot.doc, np.arange(len(lot.n_a) + 1)) + done
            cells = [(pack(np.diff(place[s:e], prepend=0), squeeze), pack(lot.times[s - done:e - done], squeeze)) for s, e in zip(borders[:-1], borders[1:])]
            n = len(cells)
            columns = [pa.array([block] * n, pa.binary()), pa.array(ids[first:first + n], id_type),
                       *(pa.array(c, pa.int64()) for c in (lot.n_a, lot.n_b, lot.n_groups, lot.n_links)), pa.array(lot.digests),
                       pa.array([c[0] for c in cells], pa.binary()), pa.array([c[1] for c in cells], pa.binary()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", *DOC, "pairs"])
            done, first = done + len(lot.doc), first + n
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.binary()), pa.nulls(1, id_type), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.string()),
             pa.nulls(1, pa.binary()), pa.array([pack(docs, squeeze)], pa.binary()), pa.array([pack(np.diff(pairs, prepend=0), squeeze)], pa.binary())],
            names=["block", *DOC, "pairs"])

    def run(batches):
        t = tokenizers(sources.value)
        ids, lots, size = [], [], 0
        for rows, chars in _lots(batches, LOT_CHARS):
            ids += [r[0].as_py() for r in rows]
            lots.append(align(list(t.encode([r[1] for r in rows])), t))
            size += chars
            if size >= block_chars:
                yield from packed(ids, lots)
                ids, lots, size = [], [], 0
        if lots:
            yield from packed(ids, lots)
    return run


def _pair_rows(batches):
    """(block, pair, docs) of the blocks' lists."""
    unzip = zstandard.ZstdDecompressor()
    for b in batches:
        for block, docs, pairs in zip(*(b.column(i).to_pylist() for i in range(3))):
            pairs, docs = np.cumsum(unpack(pairs, unzip)), unpack(docs, unzip)
            for i in range(0, len(pairs), 50_000):
                n = len(pairs[i:i + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.binary()), pa.array(pairs[i:i + n]), pa.array(docs[i:i + n])], names=["block", "pair", "docs"])


def _sums(id_type):
    """Documents with their sums, from rows sorted by block: the block's pairs by
    number first (count, best), then its documents."""
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        now, counts, best, ready = None, [], [], None
        for b in batches:
            blocks = b.column(0)
            is_pair = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            names = blocks.to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (is_pair[1:] != is_pair[:-1]))) if len(names) else []
            for s, e in zip(edges, [*edges[1:], len(names)]):
                if names[s] != now:
                    now, counts, best, ready = names[s], [], [], None
                part = b.slice(s, e - s)
                if is_pair[s]:
                    counts.append(part.column(2).to_numpy())
                    best.append(part.column(3).to_numpy())
                    continue
                if ready is None:
                    ready = (np.concatenate(counts), np.concatenate(best)) if counts else (np.zeros(0, np.int64),) * 2
                n_best, sums = [], []
                for places, times in zip(part.column(10).to_pylist(), part.column(11).to_pylist()):
                    at, times = np.cumsum(unpack(places, unzip)), unpack(times, unzip)
                    n_best.append(int((times * ready[1][at]).sum()))
                    sums.append(int((times * ready[0][at]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(4), *(part.column(i) for i in (5, 6, 7, 8)), pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), part.column(9)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row: doc_id, token, group and link counts, links with their A id's
    highest pair count, the sum of pair counts, and the digest of its groups.
    The vocabulary files are read on the driver and broadcast; their size is fixed."""
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        sources = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    id_type = docs.schema["doc_id"].dataType
    arrow_id = pa.int64() if id_type.simpleString() == "bigint" else pa.int32() if id_type.simpleString() == "int" else pa.string()
    texts = docs.select("doc_id", F.col(text_col).cast("string").alias("text"))
    rows = written(texts.mapInArrow(_blocks(sources, arrow_id, block_chars), BLOCK_ROW.format(id=id_type.simpleString())), "aligned")
    n_b = tokenizers(sources.value).n_b
    held = rows.filter("pairs IS NOT NULL").select("block", "times", "pairs").mapInArrow(_pair_rows, "block binary, pair long, docs long")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("count"))
    counts = written(counts.withColumn("a", F.floor(F.col("pair") / n_b)), "pair-counts")
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    counts = counts.join(top, "a").select("pair", "count", F.when(F.col("count") == F.col("top"), 1).otherwise(0).cast("long").alias("best"))
    answers = held.select("block", "pair").join(counts, "pair").select("block", "pair", "count", "best")
    documents = rows.filter("pairs IS NULL").select("block", *DOC)
    both = answers.unionByName(documents, allowMissingColumns=True).select("block", "pair", "count", "best", *DOC)
    dealt = both.repartition("block").sortWithinPartitions("block", F.asc_nulls_last("pair"))
    return dealt.mapInArrow(_sums(arrow_id), f"doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
                            "n_best long, count_sum long, groups_sha256 string")
