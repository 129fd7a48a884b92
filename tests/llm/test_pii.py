"""Personal data: base spans against plain patterns, disguises, offsets, awkward rows."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import corpus, documents
from velotide.llm import pii

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    """The contract word by word: find, then drop what fails."""
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2:
                weights = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(w - 9 if w > 9 else w for w in weights) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@-+ 0123456789()%_Zé\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [tuple(s) for s in pii.detect(text)] == brute(text)


def test_base_spans_of_longer_texts():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["4111 1111 1111 1111", "+1 (988) 555-2485", "10.1.2.3", "1.2.3.256", "a.b@c.de", "@", " ", ".", "x", "7", "-", "+"])
                       for _ in range(rng.randint(0, 25)))
        assert [tuple(s) for s in pii.detect(text)] == brute(text)


DISGUISED = [
    ("mail john.smith [at] example [dot] com now", "email", "john.smith [at] example [dot] com"),
    ("write john dot smith at mail dot example dot com!", "email", "john dot smith at mail dot example dot com"),
    ("rhokk.73 at mail2.example.com is it", "email", "rhokk.73 at mail2.example.com"),
    ("u＠example．com", "email", "u＠example．com"),
    ("by jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("john @ example . com", "email", "john @ example . com"),
    ("a(at)b(dot)c(dot)org", "email", "a(at)b(dot)c(dot)org"),
    ("foo[@]bar.com", "email", "foo[@]bar.com"),
    ("10[.]1[.]2[.]3", "ip", "10[.]1[.]2[.]3"),
    ("host １０．１．２．３ up", "ip", "１０．１．２．３"),
    ("one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
    ("ring plus one nine eight eight five five five two four eight five ok", "phone", "plus one nine eight eight five five five two four eight five"),
    ("ring ＋1 (988) 555–2485 ok", "phone", "＋1 (988) 555–2485"),
    ("pay four five three two 0151 1283 0366 x", "card", "four five three two 0151 1283 0366"),
    ("41​11 1111 1111 1111", "card", "41​11 1111 1111 1111"),
    ("4111.1111.1111.1111", "card", "4111.1111.1111.1111"),
    ("vier fünf drei zwei null eins fünf eins eins zwei acht drei null drei sechs sechs", "card",
     "vier fünf drei zwei null eins fünf eins eins zwei acht drei null drei sechs sechs"),
]


def test_disguises_are_found_at_their_source_offsets():
    for before in ("", "é 漢字 ＠ ​ x. ", "Ａ" * 5 + " [dot] . "):
        for text, kind, wanted in DISGUISED:
            text = before + text
            found = [(pii.KINDS[s.kind], text[s.start:s.end]) for s in pii.disguised(text, pii.detect(text))]
            assert (kind, wanted) in found, (text, found)


def test_odd_letters_and_neighbouring_pieces_keep_offsets():
    for text in ("x [at] [dot] y (at) (dot) z", "four \u017fix five \u0130 s\u0130x \u017f\u0130x four FIVE", "[at] [at] [dot]", "(dot)", "K at \u212a dot com"):
        plain, passes = pii.normalise(text)
        for x in range(len(plain)):
            a, b = x, x + 1
            for p in reversed(passes):
                a, b = p.start(a), p.end(b)
            assert 0 <= a < b <= len(text)
        pii.disguised(text, pii.detect(text))
    text = "card \u017feven \u017fix four three 4111 1111 1111 ok"
    assert pii.spelled(text)[0] == "card 7 6 4 3 4111 1111 1111 ok"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["[at]", " at ", "(dot)", " dot ", "four", "\u017fix", "plus ", "7", " ", "-", ",", "\u200b", "\uff11", "x", "@", ".", "4111", "é"]), max_size=25))
def test_any_mixture_maps_back_into_the_text(parts):
    text = "".join(parts)
    for s in pii.disguised(text, pii.detect(text)):
        assert 0 <= s.start < s.end <= len(text)


def test_prose_is_left_alone():
    for text in ("look at it dot and go", "see me at example.com", "erin at it. Thes of ones", "one or two of the three, four at most",
                 "un deux trois", "les 10 – 20 at home", "call at nine one one", "a · b • c — d", "Привет, мир. Это о том, что @ нет",
                 "1 2 3 4 5 6 7 8 9", "+1 (848) 555-1373 Un an"):
        assert pii.disguised(text, pii.detect(text)) == [], text


def test_very_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "a." * 150_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000, "one " * 80_000, " at " * 80_000,
                 "[ " * 150_000, "a@" * 150_000, "1234." * 60_000):
        pii.disguised(text, pii.detect(text))


def test_rows_and_digests(spark):
    rows = corpus() + [(400, "a.b@c.de and 10.1.2.3, x (at) y (dot) org"), (401, "x@y.z " * 20_000)]
    got = {}
    for r in pii.personal_data(documents(spark, rows, clash=True)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for doc, text in rows:
        base = brute(text or "")
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = next(x for x in got[doc] if x.base_sha256 == hashlib.sha256(listed.encode()).hexdigest())
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        assert len([s for s in r.spans.split(",") if s]) == len(base) + r.n_added
    assert got[400][0].spans == "email:0:8,ip:13:21,email:23:41"
    empty = pii.personal_data(documents(spark, []))
    assert empty.count() == 0 and empty.columns[:6] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
