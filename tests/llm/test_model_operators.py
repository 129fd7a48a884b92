"""Binary codes, WARC archives, packing, toxicity, word table, importance resampling."""

import bisect
import gzip
import hashlib
import io
import math
import random
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tests.llm.helpers import brute_components, corpus, documents, sentence_text
from velotide.llm import binary_codes as BC
from velotide.llm import importance as IM
from velotide.llm import packing as PK
from velotide.llm import toxicity as TX
from velotide.llm import warc as WA
from velotide.llm import word_table as WT
from velotide.llm.zip_archive import ZipWriter, directory

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("copies", T.StringType())])
PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      T.StructField("digest", T.StringType()), T.StructField("first", T.StringType())])


# ------------------------------------------------------------ binary codes ---
def vector_rows():
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            center = rng.standard_normal(48)
            for spread in (0, 0.05, 0.1, 0.14, 0.2, 0.4):
                noise = rng.standard_normal(48)
                v = center / np.linalg.norm(center) + spread * noise / np.linalg.norm(noise)
                rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 3])], label))
                i += 1
        rows += [(i + k, rows[-1][1], label) for k in range(3)]
        i += 3
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 48, 1), (903, [nan] * 48, 1), (904, [1.0, None], 1), (905, [inf, 1.0], 1),
             (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (908, [-0.0, 1.0], 0), (909, [0.0, 1.0], 0), (None, [1.0, 2.0], 1)]
    return [(a, b, c, "clash", "clash") for a, b, c in rows]


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(BC, "BLOCK", 8)
    rows = vector_rows()
    got = BC.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == len(rows)

    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    unit = {r[0]: (r[2], np.array(r[1], np.float64) / np.linalg.norm(np.array(r[1], np.float64))) for r in rows if usable(r)}
    near = lambda a, b: a[0] == b[0] and len(a[1]) == len(b[1]) and float(a[1] @ b[1]) >= 0.98
    comp = brute_components(unit, near)
    for r in got:
        if r.vec_id in unit:
            links = sum(near(unit[r.vec_id], v) for k, v in unit.items() if k != r.vec_id)
            assert (r.n_links, r.component_id, r.kept) == (links, comp[r.vec_id], comp[r.vec_id] == r.vec_id)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
    assert sum(r.n_links for r in got) > 100
    assert not BC.near_duplicates(spark.createDataFrame([], VECTORS)).collect()


def test_estimates_are_unbiased_and_bounds_hold():
    rng, dim = np.random.default_rng(1), 64
    a = rng.standard_normal(dim)
    a /= np.linalg.norm(a)
    noise = rng.standard_normal(dim)
    b = a + 0.3 * noise / np.linalg.norm(noise)
    b /= np.linalg.norm(b)
    errors, below = [], 0
    for seed in range(300):
        turn = BC.rotations(dim, dim, seed)
        z = np.array([a, b]) @ turn
        factor = np.abs(z).sum(1) / math.sqrt(dim)
        errors.append(float(np.sign(z[0]) @ z[1] / math.sqrt(dim) / factor[0] - a @ b))
        coder = BC.Coder(dim, 2, 4)
        coder.turn = turn
        below += BC.upper_bounds(*coder.code(np.array([a, b])))[0, 1] < a @ b
    assert abs(np.mean(errors)) < 4 * np.std(errors) / math.sqrt(len(errors)) and below == 0


# -------------------------------------------------------------------- WARC ---
def page_rows():
    long = "<p>" + "x" * 200
    rows = [(1, "http://a/1", long), (2, "http://a/2", long), (3, None, "short"), (4, "u\r\nx", "short"), (5, "http://é/5", None), (6, "h", ""),
            (7, "h", "é" * 70 + "\r\n\r\nWARC/1.1"), (8, "h", "é" * 70 + "\r\n\r\nWARC/1.1"), (None, "h", long), (None, "h", "only " * 40), (1, "again", long),
            (9, "h", "y" * 99), (10, "h", "y" * 99), (11, "h", "y" * 100), (12, "h", "y" * 100), (13, "h", sentence_text(5000, random.Random(1)))]
    return [(*r, "clash", "clash") for r in rows]


def test_warc_round_trip_matches_brute_force(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(WA, "SPAN", 300)
    rows = page_rows()
    got = WA.round_trip(spark, spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    first = {}
    for i, _, html, *_ in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, _, html, *_ in rows:
        data, own = (html or "").encode(), first.get(html)
        revisit = own is not None and (i is None or i > own)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", own if revisit else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert not WA.round_trip(spark, spark.createDataFrame([], PAGES)).collect()


def test_archives_are_plain_zip_files_with_gzip_members(spark, tmp_dir):
    rows = page_rows()
    manifest = WA.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), f"{tmp_dir}/archives")
    paths = [r.archive for r in manifest.collect()]
    records = []
    for path in paths:
        with zipfile.ZipFile(path) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            assert z.namelist() == [WA.DATA, WA.INDEX]
            records.append(gzip.decompress(z.read(WA.DATA)))
    assert b"".join(records).count(b"WARC-Record-ID") == len(rows)
    payloads = {r.page_id: r.payload for r in WA.read_archives(manifest, payloads=True).collect() if r.record_type == "response"}
    assert payloads[7] == rows[6][2].encode() and payloads[5] == b""


def foreign_record(name, payload, kind="response", refers=None):
    block = (b"HTTP/1.1 200 OK\r\n\r\n" if kind != "resource" else b"") + (payload if kind != "revisit" else b"")
    head = f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: {name}\r\nWARC-Payload-Digest: sha1:ABC\r\n"
    head += f"WARC-Refers-To: {refers}\r\n" if refers else ""
    return f"{head}Content-Length:{len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_with_several_members_and_foreign_ids(spark, tmp_dir, zip64):
    one = [gzip.compress(foreign_record(f"<urn:uuid:{k}>", b"p%d" % k)) for k in range(4)]
    two = [gzip.compress(foreign_record("<urn:uuid:r>", b"", "revisit", "<urn:uuid:1>")), gzip.compress(foreign_record("<urn:uuid:9>", b"x" * 200_000))]
    three = [foreign_record("<urn:uuid:plain>", b"\r\n\r\nWARC/1.0", "resource"), foreign_record("<urn:page:7>", b"own")]
    index = b"".join(b'com,example)/ 2024 {"filename": "a.warc.gz", "offset": "%d", "length": %d}\n' % (sum(map(len, one[:k])), len(x)) for k, x in enumerate(one))
    with open(f"{tmp_dir}/x.wacz", "wb") as f:
        w = ZipWriter(f, zip64=zip64)
        for name, data in (("datapackage.json", b"{}"), ("archive/a.warc.gz", b"".join(one)), ("indexes/a.cdx.gz", gzip.compress(b"!meta\n" + index)),
                           ("indexes/again.cdxj", index), ("archive/b.warc.gz", b"".join(two)), ("archive/c.warc", b"".join(three))):
            w.begin(name)
            w.write(data)
            w.end()
        w.close()
    got = {r.record_id: r for r in WA.read_archives(spark.createDataFrame([(f"{tmp_dir}/x.wacz",)], "archive string"), payloads=True).collect()}
    assert sorted(got) == sorted([f"<urn:uuid:{k}>" for k in (0, 1, 2, 3, 9, "r", "plain")] + ["<urn:page:7>"])
    assert got["<urn:uuid:3>"].payload == b"p3" and got["<urn:uuid:9>"].payload_bytes == 200_000 and got["<urn:uuid:3>"].payload_digest == "sha1:ABC"
    assert (got["<urn:uuid:r>"].record_type, got["<urn:uuid:r>"].refers_to_record, got["<urn:uuid:r>"].payload) == ("revisit", "<urn:uuid:1>", None)
    assert got["<urn:uuid:plain>"].payload == b"\r\n\r\nWARC/1.0" and got["<urn:page:7>"].page_id == 7 and got["<urn:uuid:0>"].page_id is None


def test_index_that_points_nowhere_fails():
    members = {"archive/a.warc.gz": (0, 10, 0), "archive/b.warc.gz": (10, 10, 0)}
    with pytest.raises(ValueError):
        list(WA.index_entries(b'{"offset": 0, "length": 5}', members))
    with pytest.raises(ValueError):
        list(WA.index_entries(b'{"filename": "c.warc.gz", "offset": 0, "length": 5}', members))
    assert list(WA.index_entries(b'k {"filename": "x/b.warc.gz", "offset": "3", "length": "5"}', members)) == [("archive/b.warc.gz", 3, 5)]


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_directory_of_own_and_foreign_files(zip64):
    own = io.BytesIO()
    w = ZipWriter(own, zip64=zip64)
    for name, data in (("a/é.txt", b"hello"), ("empty", b""), ("b", b"PK\5\6" * 9)):
        w.begin(name)
        w.write(data)
        w.end()
    w.close()
    with zipfile.ZipFile(io.BytesIO(own.getvalue())) as z:
        assert z.testzip() is None and z.read("a/é.txt") == b"hello"
    foreign = io.BytesIO()
    with zipfile.ZipFile(foreign, "w") as z:
        z.comment = b"a comment with PK\5\6 inside"
        with z.open("a/é.txt", "w", force_zip64=zip64) as f:
            f.write(b"hello")
        z.writestr("b", b"PK\5\6" * 9)
    for data in (own.getvalue(), foreign.getvalue()):
        members = directory(io.BytesIO(data), len(data))
        at, size, method = members["a/é.txt"]
        assert data[at:at + size] == b"hello" and method == 0
        at, size, _ = members["b"]
        assert data[at:at + size] == b"PK\5\6" * 9


def test_package_with_more_members_than_a_short_directory_holds():
    own = io.BytesIO()
    w = ZipWriter(own)
    for k in range(65_600):
        w.begin(str(k))
        w.write(b"%d" % k)
        w.end()
    w.close()
    members = directory(own, len(own.getvalue()))
    at, size, _ = members["65599"]
    assert len(members) == 65_600 and own.getvalue()[at:at + size] == b"65599"


# ----------------------------------------------------------------- packing ---
def check_packing(rows, items):
    by_seq = {}
    for pid, seq, used in rows:
        by_seq.setdefault(seq, []).append((used, items[pid]))
    assert sorted(r[0] for r in rows) == sorted(items)
    for places in by_seq.values():
        at = 0
        for used, size in sorted(places):
            assert used == at
            at += size
        assert at <= PK.CAPACITY
    return len(by_seq)


def best_fit_decreasing(sizes):
    gaps, n = [], 0
    for x in sorted(sizes, reverse=True):
        k = bisect.bisect_left(gaps, x)
        if k < len(gaps):
            bisect.insort(gaps, gaps.pop(k) - x)
        else:
            n += 1
            bisect.insort(gaps, PK.CAPACITY - x)
    return n


@pytest.mark.parametrize("kind", ["mixed", "hot"])
def test_pack_is_gapless_and_near_best_fit(spark, kind):
    rng = random.Random(6)
    sizes = [min(2048, int(rng.lognormvariate(6.3, 0.9)) + 1) for _ in range(1500)] if kind == "mixed" else [700] * 400 + [300] * 300 + [2048] * 3 + [1] * 50
    items = dict(enumerate(sizes))
    df = spark.createDataFrame(list(items.items()), "pid long, size long")
    n = check_packing([tuple(r) for r in PK.pack(df).collect()], items)
    assert n <= 1.04 * best_fit_decreasing(sizes) + 3
    assert not PK.pack(df.limit(0)).collect()


@pytest.mark.parametrize("rows", [60, 300])
def test_pack_in_many_ranges(spark, monkeypatch, rows):
    # ranges of a few rows: rounds, matches across ranges and the last range
    monkeypatch.setattr(PK, "RANGE_ROWS", rows)
    rng = random.Random(rows)
    sizes = [min(2048, int(rng.lognormvariate(6.3, 0.9)) + 1) for _ in range(900)] + [1500] * 300
    items = dict(enumerate(sizes))
    df = spark.createDataFrame(list(items.items()), "pid long, size long")
    n = check_packing([tuple(r) for r in PK.pack(df).collect()], items)
    assert n <= 1.05 * best_fit_decreasing(sizes) + 5


def test_pack_takes_few_jobs(spark):
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = spark.createDataFrame([(k, 1 + k * 37 % 2048) for k in range(3000)], "pid long, size long")
    PK.pack(df).collect()
    assert len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before) <= 30


def test_rank_segments_pair_nearest_larger_ranges():
    got = PK.rank_segments([(0, 0, 2), (1, 1, 3), (2, 5, 0), (3, 1, 1)])
    assert got == [(1, 0, 0, 0, 1, 0), (2, 0, 1, 0, 3, 1), (2, 3, 0, 1, 1, 4)]


def test_pieces_are_the_tokenizer_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = corpus() + [(600, " lead  and  \n trail \t "), (601, "a  b  c​d\x85\n\n e\x1c\x1df"), (602, "  "), (603, "<|endoftext|> x<|endoftext|>")]
    t = Tokenizer.from_file(path)
    got = PK.pieces(documents(spark, rows, clash=True), path).collect()
    seen = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got)
    want = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, (s, n) in enumerate(PK.cut(len(ids), PK.CAPACITY)):
            want.append((str(i), k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    assert seen == sorted(want)
    assert PK.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)] and PK.cut(4096, 2048) == [(0, 2048), (2048, 2048)]


# -------------------------------------------------------------- word table ---
def test_word_table_equals_the_tokenizer(spark, monkeypatch, tmp_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = corpus() + [(600, "I'm <|startoftext|>x y<|endoftext|>"), (601, "café ́a  wide ÀB ΑΣ Σ̇"), (602, "x" * 50_000)]
    df = documents(spark, rows, clash=True)
    df.repartition(3).write.parquet(f"{tmp_dir}/docs")
    monkeypatch.setattr(WT, "BLOCK_ROWS", 5)
    for most in (1 << 20, 30):  # a task that forgets its words encodes them again
        monkeypatch.setattr(WT, "MAX_WORDS", most)
        again = WT.encode_decode(spark.read.parquet(f"{tmp_dir}/docs"), path).select("doc_id", "ids").collect()
        assert sorted((str(r.doc_id), bytes(r.ids)) for r in again) == sorted(
            (str(i), np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()) for i, text in rows)
    for source in (df, spark.read.parquet(f"{tmp_dir}/docs")):  # written first; a plain scan
        got = WT.encode_decode(source, path).collect()
        seen = sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in got)
        want = []
        for i, text in rows:
            ids = t.encode(text or "", add_special_tokens=False).ids
            want.append((str(i), np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
        assert seen == sorted(want)
    assert not WT.encode_decode(df.limit(0), path).collect()


# ---------------------------------------------------------------- toxicity ---
def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = TX.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    caught, missed, wrong = n.get((1, 1), 0), n.get((1, 0), 0), n.get((0, 1), 0)
    assert caught >= 0.6 * (caught + missed) and wrong <= 0.01 * (n[0, 0] + wrong)


def test_toxicity_awkward_rows(spark):
    rows = corpus()
    docs = documents(spark, rows, clash=True)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for table in (labels, labels.limit(0)):
        got = TX.toxicity(docs, table).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 0.5 and r.predicted == 0 for r in got)
        for r in got:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert not TX.toxicity(docs.limit(0), labels).collect()


def test_ordinary_words_train_whatever_their_first_letter(monkeypatch):
    trained = []
    monkeypatch.setattr(TX, "_train", lambda samples: trained.append(set(samples)) or (b" ".join(sorted(set(samples))[:50]) or b" ", True))
    rng, common = random.Random(5), [f"{c}{k}" for c in "abz" for k in range(2000)] + ["été", "жук"]
    ordinary = [" ".join(rng.sample(common, len(common))).encode() for _ in range(40)]
    toxic = [" ".join(f"t{rng.randrange(40)}" for _ in range(30)).encode() for _ in range(10)]
    TX.fit([(t, 0) for t in ordinary] + [(t, 1) for t in toxic])
    assert len(trained) == 2 and trained[1] == {f" {w} ".encode() for w in common}


# ------------------------------------------------------ importance resampling ---
def test_kth_largest(spark):
    rng = random.Random(2)
    values = [rng.gauss(0, 5) for _ in range(900)] + [1.5] * 50 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 40, 500, len(values)):
        assert IM.kth_largest(df, "x", k, bins=16) == sorted(values, reverse=True)[k - 1]


def test_importance_weights_match_brute_force(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    s = IM.Selection(docs, labels)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    target = {i for i, q in known.items() if q == 1 and zlib.crc32(str(i).encode()) % 3 != 1}
    raw, good = np.zeros(IM.BUCKETS), np.zeros(IM.BUCKETS)
    for i, t in texts.items():
        n = np.bincount(IM.buckets(np.frombuffer(t, np.uint8)), minlength=IM.BUCKETS) if t else 0
        raw += n
        if i in target:
            good += n
    share = lambda x: (x + 1) / (x.sum() + IM.BUCKETS)
    assert np.allclose(s.ratios.value, np.log(share(good) / share(raw)))
    rows = IM.importance_resampling(docs, labels).collect()
    keys = sorted((r.key for r in rows if r.key > float("-inf")), reverse=True)
    assert sum(r.kept for r in rows) == s.k == sum(k >= keys[s.k - 1] for k in keys)
    kept = {r.doc_id for r in rows if r.kept}
    clean = [i for i, q in known.items() if q == 1]
    junk = [i for i, q in known.items() if q == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in junk) <= 0.2 * len(junk)
    assert {r.doc_id for r in s.select(docs).collect()} == kept


def test_importance_awkward_rows(spark):
    rows = corpus()
    docs = documents(spark, rows, clash=True)
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(12)], "doc_id long, quality int")
    for table in (labels, labels.limit(0), labels.filter("quality = 1")):
        got = IM.importance_resampling(docs, table).collect()
        assert len(got) == len(rows)
        assert not any(r.kept for r in got if r.doc_id in (200, 201, 202, 207))
        assert len({r.key for r in got if r.doc_id == 3}) == 1
    assert IM.Selection(docs, labels.limit(0)).select(docs).columns == docs.columns
    assert not IM.importance_resampling(docs.limit(0), labels).collect()
