"""Tokenizer alignment against tokens paired one by one, and merge-path pieces."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.helpers import corpus, documents
from velotide.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_levels():
    kept = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table, k = {chr(c): c for c in kept}, 0
    for c in range(256):
        if c not in kept:
            table[chr(256 + k)] = c
            k += 1
    return table


LEVEL = byte_levels()


def groups_of(text, libraries):
    """[(A ids, B ids)] of a text."""
    a_lib, b_lib = libraries
    if not text:
        return []
    a = a_lib.encode(" " + text, add_special_tokens=False).ids
    b = b_lib.encode(text)
    a_bytes = [bytes(LEVEL[c] for c in a_lib.id_to_token(i)) for i in a]
    pieces = [b_lib.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
    out, x, y = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        i, j = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
        out.append((a[x:i], b[y:j]))
        x, y = i, j
    return out


def brute(rows, libraries):
    groups = [groups_of(t, libraries) for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (doc, _), g, c in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def test_merge_path_pieces_are_equal_and_keep_equal_ends_together():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = (np.cumsum(rng.integers(1, 6, rng.integers(0, 60))) for _ in range(2))
        work = int(rng.integers(1, 20))
        i, j = alignment.merge_path(a, b, work)
        assert i[0] == j[0] == 0 and i[-1] == len(a) and j[-1] == len(b)
        sizes = np.diff(i) + np.diff(j)
        assert (sizes <= work + 1).all() and (sizes[:-1] >= work - 1).all()
        merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
        for x, y in zip(i.tolist(), j.tolist()):
            assert sorted([(v, 0) for v in a[:x].tolist()] + [(v, 1) for v in b[:y].tolist()]) == merged[:x + y]
            assert not (x and y < len(b) and a[x - 1] == b[y])
        common = np.intersect1d(a, b)
        ga, gb, n = alignment.stitched_groups(a, b, work)
        assert n == len(common) and ga.tolist() == np.searchsorted(common, a).tolist() and gb.tolist() == np.searchsorted(common, b).tolist()


def odd_rows():
    rng = random.Random(8)
    rows = corpus() + [(500, "a▁b"), (501, " leading  blanks \t and\n\nlines \r\n"), (502, "<|endoftext|> </s> <s> <unk> <0x41>"),
                       (503, "ﬁ①é é​\x00x"), (504, "😀🤷🏽‍♂️ 漢字かな한국어 ދިވެހި"), (505, "a" * 3000), (506, "=" * 999 + "漢" * 500), (507, " ")]
    for k in range(60):
        rows.append((600 + k, "".join(rng.choice(["é", "ß ", "  ", "\n", "ing", "the ", "漢", "😀", "\x85", " ", "'s", "12", "_", "Zx", "​"]) for _ in range(rng.randint(1, 60)))))
    return rows


def test_rows_equal_brute_force(spark, libraries):
    rows = odd_rows()
    wanted = brute(rows, libraries)
    for chars in (alignment.BLOCK_CHARS, 2000):
        got = alignment.align_tokenizers(documents(spark, rows, clash=True), A, B, block_chars=chars).collect()
        assert sorted((tuple(r) for r in got), key=repr) == wanted


def test_wide_groups_are_counted_by_distinct_ids(spark, libraries, monkeypatch):
    t = alignment.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = [t_ for _, t_ in odd_rows() if t_ and len(t_) < 5000]
    encoded = list(t.encode(texts))
    plain = alignment.align(encoded, t)
    monkeypatch.setattr(alignment, "WIDE", 1)
    wide = alignment.align(encoded, t)
    for x, y in zip(plain, wide):
        assert list(x) == list(y)


def test_empty_table(spark):
    out = alignment.align_tokenizers(documents(spark, []), A, B)
    assert out.count() == 0 and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
