"""BPE encoding and decoding through a table of distinct words.

Words (runs of bytes outside ``\\x20 \\x09-\\x0D``) never share a token in a
tokenizer that drops white space, so a text's ids are its words' ids in order.

1. Documents are numbered in blocks of ``BLOCK_ROWS`` rows of a file.  Each task
   reduces a block to its distinct words, packed by hash bucket.
2. A bucket's words meet in one task, and each distinct word is encoded once;
   the ids go back to the blocks that hold the word.  The task reads its blocks'
   lists one after another and remembers at most ``MAX_WORDS`` words (beyond that it
   starts anew and may encode a word again), so its memory does not grow with the
   data; there are as many buckets as the input's size needs.  The table lies in as
   many folders as buckets, sorted by block, and a block reads its own rows only.
3. The documents are read again; a block's words are replaced by their ids
   position by position, and ids by their pieces (a bounded table of the
   vocabulary).

No text is shuffled, only packed distinct words.  A word's share of the rows
does not matter: it stands once per block.

Defined results: null and empty texts have no ids and decode to the empty text;
repeated rows are encoded each; any id type may be null; extra columns are
ignored.  Documents that are not a plain Parquet scan are written to the shared
folder first."""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import written
from velotide.llm.warc import file_system
from velotide.session import scratch_path

BLOCK_ROWS = 8192
BUCKET_BYTES = 64 << 20  # input (as the planner sees it) per bucket
MAX_WORDS = 1 << 20  # distinct words a task holds before it passes them on
OUT_ROWS = 512
_TOKENIZERS: dict[int, object] = {}


def tokenizer(source: str):
    """The tokenizer of a JSON text, once per worker; truncation and padding unused."""
    key = hash(source)
    if key not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(source)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[key] = t
    return _TOKENIZERS[key]


def blocked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, block, text); the block depends on the file and the row's place
    in it only, so both readings agree however the scan is split."""
    cols = ["doc_id", F.col(text_col).alias("text")]
    block = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / BLOCK_ROWS)).alias("block")
    try:
        return docs.select(*cols, block)
    except AnalysisException:
        return written(docs.select(*cols), "documents").select("doc_id", "text", block)


def _block_words(buckets: int):
    def pack(block, words):
        parts: list[list[bytes]] = [[] for _ in range(buckets)]
        for w in words:
            parts[zlib.crc32(w) % buckets].append(w)
        squeeze = zstandard.ZstdCompressor(level=3)
        full = [i for i, p in enumerate(parts) if p]
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()),
             pa.array([squeeze.compress(b" ".join(sorted(parts[i]))) for i in full], pa.binary())], names=["bucket", "block", "words"])

    def run(batches):
        held, now = set(), None
        for b in batches:
            for block, text in zip(b.column(0).to_numpy(), b.column(1).cast(pa.large_binary())):
                if (block != now or len(held) > MAX_WORDS) and held:
                    yield pack(now, held)
                    held = set()
                now = block
                if text.is_valid:
                    held.update(text.as_buffer().to_pybytes().split())
        if held:
            yield pack(now, held)
    return run


def _encode_buckets(source):
    """(block, words, ids) of every list, from lists sorted by bucket."""
    def run(batches):
        t, unzip, squeeze = tokenizer(source.value), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        ids: dict[bytes, bytes] = {}
        for b in batches:
            for block, packed in zip(b.column(1).to_pylist(), b.column(2)):
                words = unzip.decompress(packed.as_py()).split(b" ")
                if len(ids) > MAX_WORDS:
                    ids.clear()
                new = [w for w in words if w not in ids]
                for i in range(0, len(new), 8192):
                    some = new[i:i + 8192]
                    for w, e in zip(some, t.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)):
                        ids[w] = array("I", e.ids).tobytes()
                each = [ids[w] for w in words]
                counts = np.array([len(x) // 4 for x in each], np.uint32).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([packed.as_py()], pa.binary()),
                                                  pa.array([squeeze.compress(counts + b"".join(each))], pa.binary())], names=["block", "words", "ids"])
    return run


def bucket_count(texts: DataFrame) -> int:
    """Buckets for the input's size, at least two per shuffle partition."""
    size = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = 2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(1 << 20, -(-size // BUCKET_BYTES)))


def word_table(texts: DataFrame, source) -> tuple[str, int]:
    """(folder, number of sub-folders) of the blocks' words with their ids, each
    distinct word of a bucket encoded once; a block's rows stand in sub-folder
    block mod number, sorted by block."""
    buckets = bucket_count(texts)
    packed = texts.select("block", "text").mapInArrow(_block_words(buckets), "bucket int, block long, words binary")
    coded = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_encode_buckets(source), "block long, words binary, ids binary")
    path = scratch_path(texts.sparkSession, "word-table")
    dealt = coded.withColumn("home", F.pmod("block", F.lit(buckets)).cast("int")).repartition("home").sortWithinPartitions("home", "block")
    # small row groups: a block looks at few rows of others
    dealt.write.partitionBy("home").option("compression", "none").option("parquet.block.size", 4 << 20).parquet(path)
    return path, buckets


def load_block(folder: str, homes: int, block: int) -> dict[bytes, bytes]:
    system, path = file_system(f"{folder}/home={block % homes}")
    from pyarrow import fs

    out, unzip = {}, zstandard.ZstdDecompressor()
    for info in system.get_file_info(fs.FileSelector(path)):
        if not info.path.endswith(".parquet"):
            continue
        with system.open_input_file(info.path) as f:
            rows = pq.ParquetFile(f)
            for g in range(rows.num_row_groups):
                span = rows.metadata.row_group(g).column(0).statistics  # block is the first column
                if span is not None and span.has_min_max and not span.min <= block <= span.max:
                    continue
                for part in rows.iter_batches(batch_size=64, row_groups=[g], columns=["block", "words", "ids"]):
                    for k in np.flatnonzero(part.column(0).to_numpy() == block).tolist():
                        names, data = unzip.decompress(part.column(1)[k].as_py()).split(b" "), unzip.decompress(part.column(2)[k].as_py())
                        ends = len(names) * 4 + 4 * np.cumsum(np.frombuffer(data, np.uint32, len(names))).astype(np.int64)
                        at = len(names) * 4
                        for w, end in zip(names, ends.tolist()):
                            out[w] = data[at:end]
                            at = end
    return out


def _apply(folder: str, homes: int, source):
    def run(batches):
        t = tokenizer(source.value)
        pieces = [t.id_to_token(i) or "" for i in range(t.get_vocab_size(with_added_tokens=True))]
        now, words = None, {}
        for b in batches:
            for i in range(0, b.num_rows, OUT_ROWS):
                part, coded, decoded = b.slice(i, OUT_ROWS), [], []
                for block, text in zip(part.column(1).to_numpy(), part.column(2).cast(pa.large_binary())):
                    found = text.as_buffer().to_pybytes().split() if text.is_valid else []
                    if found and block != now:
                        now, words = block, load_block(folder, homes, block)
                    ids = b"".join(map(words.__getitem__, found))
                    coded.append(ids)
                    decoded.append(" ".join(map(pieces.__getitem__, array("I", ids))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(coded, pa.binary()), pa.array(decoded, pa.string())],
                                                 names=["doc_id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """(doc_id, ids as little-endian unsigned 32-bit integers, decoded text).

    For tokenizers without a decoder that drop white space (pieces are joined by
    one space); the vocabulary file is read on the driver and sent as a
    broadcast of its own size."""
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    import json

    if json.loads(text).get("decoder") is not None:
        raise ValueError("a tokenizer with a decoder of its own needs its own joining of pieces")
    source = docs.sparkSession.sparkContext.broadcast(text)
    texts = blocked(docs, text_col)
    folder, homes = word_table(texts, source)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "block", "text").mapInArrow(_apply(folder, homes, source), f"doc_id {id_type}, ids binary, decoded string")
