"""Personal data with offset-preserving deobfuscation.

Base spans come from the text as it is, leftmost and non-overlapping per kind
(email, ip, card, phone).  Then small transducers rewrite the text where it is
disguised, and the same detectors run over the result:

1. ``homoglyphs``: look-alike letters, digits of other scripts and full-width
   forms, dashes and blanks become their ASCII character, one for one;
2. ``invisible``: zero-width characters and soft hyphens vanish;
3. ``spelled``: a run of three or more digits or digit words (four languages)
   becomes digits, "plus" before it a plus sign;
4. ``bracketed``: "[at]", "(dot)" and the like become "@" and ".";
5. ``addresses``: "name at host dot com", "name @ host . com" lose their blanks;
6. ``quads``: four numbers with spelled or spaced dots;
7. ``card_dots``: groups of four digits joined by dots, slashes or underscores.

A transducer keeps, for every piece it rewrote, where it began and ended before
and after, so a span found at the end is mapped back through all of them to
offsets (code points) of the source.  A mapped span is added when it covers
something rewritten and is not inside a base span of its kind.

All detectors are linear in the text: none starts again inside a run.

One pass over the table, nothing is shuffled.  Defined results: a null text
counts as empty; an empty text has no spans; repeated rows and null ids give a
row each; extra columns are ignored."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from typing import Iterator, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


# ------------------------------------------------------------- detectors ---
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
LUHN_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(LUHN_DOUBLED[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        # a local part has no "@": a failing run cannot be part of a later match
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                yield m.span()


DETECTORS = (emails, ips, cards, phones)


def detect(text: str) -> list[Span]:
    """All spans of a text by start, then kind as listed."""
    return sorted(Span(a, k, b) for k, find in enumerate(DETECTORS) for a, b in find(text))


# ----------------------------------------------------------- transducers ---
class Edits:
    """Rewritten pieces of one pass, ascending: [a, b) of its input became [c, d)
    of its output."""

    def __init__(self):
        self.a: list[int] = []
        self.b: list[int] = []
        self.c: list[int] = []
        self.d: list[int] = []

    def add(self, a, b, c, d):
        self.a.append(a)
        self.b.append(b)
        self.c.append(c)
        self.d.append(d)

    def start(self, x: int) -> int:
        """Input offset where the character at output offset ``x`` begins."""
        k = bisect_right(self.c, x) - 1
        if k < 0:
            return x
        if x >= self.d[k]:
            return x - self.d[k] + self.b[k]
        return self.a[k] + (x - self.c[k] if self._same(k) else 0)

    def end(self, x: int) -> int:
        """Input offset where the character before output offset ``x`` ends."""
        k = bisect_left(self.c, x) - 1
        if k < 0:
            return x
        if x > self.d[k]:
            return x - self.d[k] + self.b[k]
        return self.a[k] + x - self.c[k] if self._same(k) else self.b[k]

    def _same(self, k: int) -> bool:
        """Whether a piece was rewritten character by character."""
        return self.b[k] - self.a[k] == self.d[k] - self.c[k]

    def touches(self, x: int, y: int) -> bool:
        """Whether a rewritten piece lies in output [x, y), vanished ones inside it included."""
        k = bisect_right(self.d, x)
        return k < len(self.c) and self.c[k] < y


def rewrite(text: str, matches: Iterator[tuple[int, int, str]]) -> tuple[str, Edits]:
    """Text with the ascending (start, end, new) pieces put in, and the edits."""
    edits, out, at, size = Edits(), [], 0, 0
    for a, b, new in matches:
        a = max(a, at)  # a blank between two pieces goes with the first
        out += (text[at:a], new)
        size += a - at
        edits.add(a, b, size, size + len(new))
        size, at = size + len(new), b
    out.append(text[at:])
    return "".join(out), edits


# Letters that look like ASCII letters (Cyrillic, Greek, Latin
# small capitals) and signs that look like ASCII signs.
LOOKALIKES = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T",
    "Х": "X", "У": "Y", "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ь": "b", "п": "n", "т": "t", "г": "r", "к": "k", "м": "m",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y",
    "Χ": "X", "α": "a", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ʀ": "r", "ɴ": "n", "ʟ": "l", "ʙ": "b", "ɢ": "g", "ʜ": "h", "ɪ": "i", "ᴀ": "a", "ᴄ": "c", "ᴅ": "d",
    "ᴇ": "e", "ᴊ": "j", "ᴋ": "k", "ᴍ": "m", "ᴏ": "o", "ᴘ": "p", "ᴛ": "t", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ѡ": "w", "օ": "o",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "⁃": "-", "․": ".", "。": ".", "｡": ".", "·": ".", "•": ".", "∙": ".",
    "٫": ".", "⋅": ".", "❨": "(", "❩": ")", "⁺": "+", "ⓐ": "@",
}
INVISIBLE = "­᠎​‌‍⁠﻿"
# first code points of runs of ten digits 0-9 in other scripts
DIGIT_ZEROS = (0x0660, 0x06F0, 0x07C0, 0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0B66, 0x0BE6, 0x0C66, 0x0CE6, 0x0D66, 0x0E50, 0x0ED0, 0x0F20,
               0x1040, 0x17E0, 0x1810, 0xFF10, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)


def _one_for_one() -> dict[int, str]:
    out = {ord(a): b for a, b in LOOKALIKES.items()}
    for zero in DIGIT_ZEROS:
        out |= {zero + k: str(k) for k in range(10)}
    # compatibility forms of ASCII characters: full-width, mathematical, circled, raised
    for block in ((0x2070, 0x209C), (0x2460, 0x24EA), (0xFE50, 0xFE6B), (0xFF01, 0xFF5E), (0x1D400, 0x1D6A3)):
        for c in range(block[0], block[1] + 1):
            form = unicodedata.normalize("NFKC", chr(c))
            if len(form) == 1 and " " < form <= "~":
                out.setdefault(c, form)
    return out | {c: " " for c in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)}


_TABLE = _one_for_one()
# mathematical forms as one range: a class of single characters that far up is searched one by one
_FOREIGN = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_TABLE) if c < 0x10000) + "]+|[\U0001D400-\U0001D7FF]+")
_INVISIBLE = re.compile(f"[{INVISIBLE}]+")


def homoglyphs(text: str) -> tuple[str, Edits]:
    if text.isascii():
        return text, Edits()
    return rewrite(text, ((m.start(), m.end(), m.group().translate(_TABLE)) for m in _FOREIGN.finditer(text)))


def invisible(text: str) -> tuple[str, Edits]:
    if text.isascii():
        return text, Edits()
    return rewrite(text, ((m.start(), m.end(), "") for m in _INVISIBLE.finditer(text)))


# Digit words of English, German, French and Spanish.
DIGIT_WORDS = (
    ("zero", "null", "zéro", "cero", "oh", "nought"), ("one", "eins", "un", "uno"), ("two", "zwei", "zwo", "deux", "dos"),
    ("three", "drei", "trois", "tres"), ("four", "vier", "quatre", "cuatro"), ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"), ("seven", "sieben", "sept", "siete"), ("eight", "acht", "huit", "ocho"), ("nine", "neun", "neuf", "nueve"),
)
_VALUE = {w: str(k) for k, ws in enumerate(DIGIT_WORDS) for w in ws}
_DIGIT_WORD = "|".join(sorted(_VALUE, key=len, reverse=True))
_DOT_WORD = r"dot|punkt|point|punto"
_TOKEN = rf"(?:{_DIGIT_WORD}|[0-9]++)"
# digits and digit words with a blank, a dash, a comma, a bracket or a (spelled) dot between
_GAP = rf"(?:[ ]?[-,][ ]?|[ ]?[(\[](?:\.|{_DOT_WORD})[)\]][ ]?|[ ](?:{_DOT_WORD})[ ]|[ ]?[()][ ]?|[ ])"
_RUN = re.compile(rf"(?<!\w)(?P<plus>plus (?={_TOKEN}))?{_TOKEN}(?:{_GAP}{_TOKEN}){{2,}}+(?!\w)", re.I)
_EACH = re.compile(_TOKEN, re.I)
LEAST_WORDS = 3  # "one" or "un" beside a number is prose
_HAS_DOT = re.compile(rf"\.|{_DOT_WORD}", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")


def _digit(word: str) -> str | None:
    """The digit of a word as the pattern matches it: any case, also of letters such
    as a long s or a dotted capital I."""
    return _VALUE.get(unicodedata.normalize("NFKC", word).casefold().replace("\u0307", ""))


def _spelled(text: str):
    for run in _RUN.finditer(text):
        tokens = list(_EACH.finditer(text, run.end("plus") if run["plus"] else run.start(), run.end()))
        if sum(not t.group().isdigit() for t in tokens) < LEAST_WORDS:
            continue
        dotted = _HAS_DOT.search(run.group()) is not None
        if run["plus"]:
            yield *run.span("plus"), "+"
        for t, after in zip(tokens, [*tokens[1:], None]):
            if not t.group().isdigit() and (digit := _digit(t.group())):
                yield *t.span(), digit
            if after is not None:
                gap, a, b = text[t.end():after.start()].strip(), t.end(), after.start()
                new = ("" if dotted else " ") if gap in ("", ",") else "-" if gap == "-" else text[a:b]
                if new != text[a:b]:  # digits of a dotted number stand together
                    yield a, b, new


def spelled(text: str) -> tuple[str, Edits]:
    if _VALUE.keys().isdisjoint(_LETTERS.findall(text.lower())):
        return text, Edits()
    return rewrite(text, _spelled(text))


_AT_WORD = r"at|arroba|chez|bei|klammeraffe"
_BRACKETED = re.compile(rf"[\[({{<][ ]?(?:(?P<at>@|{_AT_WORD})|\.|{_DOT_WORD})[ ]?[\])}}>][ ]?", re.I)


def bracketed(text: str) -> tuple[str, Edits]:
    return rewrite(text, ((m.start() - (text[m.start() - 1:m.start()] == " "), m.end(), "@" if m["at"] else ".")
                          for m in _BRACKETED.finditer(text)))


# Top-level domains that are no common words.
DOMAINS = frozenset("com org net edu gov mil int info biz io ai dev app co eu us uk de fr es ch nl pl ru cn jp br au ca mx example test".split())
_DOT = rf"(?:\.|[ ]\.[ ]|[ ](?:{_DOT_WORD})[ ])"
_ADDRESS = re.compile(rf"(?<![A-Za-z0-9._%+-])(?P<local>[A-Za-z0-9_%+-]++(?:{_DOT}[A-Za-z0-9_%+-]++){{0,8}}?)"
                      rf"(?P<at>@|[ ]@[ ]?|@[ ]|[ ](?:{_AT_WORD})[ ])(?P<host>[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++)", re.I)
_ANY_DOT = re.compile(rf"[ ]\.[ ]|[ ](?:{_DOT_WORD})[ ]", re.I)


def _addresses(text: str):
    for m in _ADDRESS.finditer(text):
        host_dots = list(_ANY_DOT.finditer(text, *m.span("host")))
        if "@" not in m["at"] and not (host_dots and re.split("[ .]", m["host"])[-1].lower() in DOMAINS):
            # "at host.com" is prose unless the name before it looks like an account
            name = m["local"]
            if not (re.search("[A-Za-z]", name) and re.search("[0-9._+-]", name) and re.search(r"[ .][A-Za-z]{2,}\Z", m["host"])):
                continue
        for d in _ANY_DOT.finditer(text, *m.span("local")):
            yield *d.span(), "."
        if m["at"] != "@":
            yield *m.span("at"), "@"
        for d in host_dots:
            yield *d.span(), "."


_BARE_AT = re.compile(rf" (?:{'|'.join(f'[{w[0].upper()}{w[0]}]{"".join(f"[{c.upper()}{c}]" for c in w[1:])}' for w in _AT_WORD.split('|'))}) "
                      rf"[A-Za-z0-9-]++(?i:{_DOT})[A-Za-z0-9-]")


def addresses(text: str) -> tuple[str, Edits]:
    if "@" not in text and not _BARE_AT.search(text):
        return text, Edits()
    return rewrite(text, _addresses(text))


_QUAD = re.compile(rf"(?<![0-9])[0-9]++(?:{_DOT}[0-9]++){{3}}", re.I)


def quads(text: str) -> tuple[str, Edits]:
    return rewrite(text, ((*d.span(), ".") for m in _QUAD.finditer(text) for d in _ANY_DOT.finditer(text, *m.span())))


_DOTTED_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[ ]?[._/][ ]?[0-9]{4}){2,3}(?:[ ]?[._/][ ]?[0-9]{1,3})?(?![0-9])")
_CARD_DOT = re.compile(r"[ ]?[._/][ ]?")


def card_dots(text: str) -> tuple[str, Edits]:
    return rewrite(text, ((*d.span(), "-") for m in _DOTTED_CARD.finditer(text) for d in _CARD_DOT.finditer(text, *m.span())))


TRANSDUCERS = (homoglyphs, invisible, spelled, bracketed, addresses, quads, card_dots)


def normalise(text: str) -> tuple[str, list[Edits]]:
    passes = []
    for transducer in TRANSDUCERS:
        text, edits = transducer(text)
        passes.append(edits)
    return text, passes


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that show in the normalised text only, in source offsets."""
    plain, passes = normalise(text)
    if not any(p.a for p in passes):
        return []
    found = set()
    for start, kind, end in detect(plain):
        changed, a, b = False, start, end
        for p in reversed(passes):
            changed = changed or p.touches(a, b)
            a, b = p.start(a), p.end(b)
        if changed and not any(s.kind == kind and s.start <= a and b <= s.end for s in base):
            found.add(Span(a, kind, b))
    return sorted(found)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            counts, base_spans, all_spans, added = [], [], [], []
            for text in part.column(1).to_pylist():
                base = detect(text or "")
                more = disguised(text, base) if text else []
                counts.append([sum(s.kind == k for s in base) for k in range(len(KINDS))])
                base_spans.append(spans_text(base))
                all_spans.append(spans_text(sorted(base + more)) if more else base_spans[-1])
                added.append(len(more))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)]
            shas = [hashlib.sha256(s.encode()).hexdigest() for s in base_spans]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array(shas), pa.array(all_spans), pa.array(added, pa.int64())],
                                             names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])


def personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base counts by kind, the digest of the base spans, all
    spans (kind:start:end, code points) and how many the method added."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", F.col(text_col).cast("string").alias("text")).mapInArrow(
        _scan, f"doc_id {id_type}, {counts}, base_sha256 string, spans string, n_added long")
