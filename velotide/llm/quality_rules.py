"""Quality rules: a threshold table compiled into one Spark projection.

Every statistic of a text is a DataFrame expression (no user function); the
table ``RULES`` names a ratio of two statistics with a lower and an upper
bound, and ``verdict`` compiles the rows into one boolean.

Words are maximal runs of characters outside ``\\x20 \\x09-\\x0D``.  Defined
results: a null or empty text has no words and all statistics 0; a rule whose
denominator is 0 holds.  Repeated rows are judged one by one.  Columns of the
input are kept apart from the statistics by the alias ``_text``; only ``id``
and the statistics come out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.llm.common import SPACES, UPPER

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of the supported languages (fixed values).
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years much where your way down should because long each just state those people too mr how little good make".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la avec son ou aux mais comme nous sa été cette d être ses ont elle".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy".split(),
}

# statistic / statistic, lowest and highest allowed (None: open)
RULES = (
    ("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    ("symbols_per_word", "n_symbols", "n_words", None, 0.25),
    ("upper_case_chars", "n_upper", "word_chars", None, 0.5),
    ("exclamations_per_word", "n_exclamations", "n_words", None, 0.3),
    ("stop_words_per_word_past_50", "n_stop_words", "n_words_past_50", 0.02, None),
    ("repeated_line_share", "n_dup_lines", "n_text_lines", None, 0.5),
    ("ellipsis_line_share", "n_ellipsis_lines", "n_text_lines", None, 0.3),
    ("bullet_line_share", "n_bullet_lines", "n_text_lines", None, 0.9),
)


def _long(c: Column) -> Column:
    return c.cast("long")


def _removed(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Words covered by 5-word windows that stand twice or more in their text.

    Window hashes are made from word hashes.  ``array_distinct`` tells the
    texts without a repetition; for the others the (hash, position) pairs are
    sorted, pairs with an equal neighbour are kept, and the sorted positions'
    gaps, cut at the window, add up to the words covered -- no step is more than
    n log n in the text's words."""
    at = "element_at(_hashes, i + {})"
    window = "xxhash64(" + ", ".join(at.format(k + 1) for k in range(WINDOW)) + ")"
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_windows", F.expr(
        f"CASE WHEN size(_hashes) >= {WINDOW} THEN transform(sequence(0, size(_hashes) - {WINDOW}), i -> {window}) "
        "ELSE array() END"))
    df = df.withColumn("_again", F.expr("size(array_distinct(_windows)) < size(_windows)"))
    df = df.withColumn("_pairs", F.expr(
        "CASE WHEN _again THEN sort_array(transform(_windows, (h, i) -> named_struct('h', h, 'i', i))) END"))
    df = df.withColumn("_starts", F.expr(
        "CASE WHEN _again THEN sort_array(transform(filter(_pairs, (p, k) -> "
        "coalesce(get(_pairs, k - 1).h = p.h, false) OR coalesce(get(_pairs, k + 1).h = p.h, false)), p -> p.i)) END"))
    covered = (f"aggregate(transform(_starts, (s, k) -> coalesce(least(get(_starts, k + 1) - s, {WINDOW}), {WINDOW})), "
               "0L, (a, x) -> a + x)")
    return df.withColumn("n_repeat_words", F.expr(f"CASE WHEN _again THEN {covered} ELSE 0L END"))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and one long column per statistic of every text."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    df = df.withColumn("_words", F.filter(F.split(F.translate("_text", SPACES, " " * len(SPACES)), " "), lambda w: w != ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: _removed(x, SPACES) != ""))
    df = _repeat_words(df)
    text, lines, n = F.col("_text"), F.col("_lines"), F.length("_text")
    out = {
        "n_words": F.size("_words"),
        "n_words_past_50": F.greatest(F.size("_words") - 50, F.lit(0)),  # a short text may hold no stop word by chance
        "word_chars": F.length(_removed(text, SPACES)),
        "n_symbols": n - F.length(_removed(text, SYMBOLS)),
        "n_upper": n - F.length(_removed(text, UPPER)),
        "n_exclamations": n - F.length(_removed(text, "!")),
        "n_stop_words": F.size(F.filter(F.transform("_words", lambda w: F.lower(w)), lambda w: w.isin(
            *sorted({w for ws in STOP_WORDS.values() for w in ws})))),
        "n_text_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: F.ltrim(x).startswith("- ") | F.ltrim(x).startswith("* ")
                                          | F.ltrim(x).startswith("•"))),
    }
    return df.select("doc_id", *[_long(c).alias(k) for k, c in out.items()], "n_repeat_words")


def holds(rule: tuple) -> Column:
    """One row of the threshold table as a predicate on the statistics."""
    _, top, bottom, low, high = rule
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col(top) >= F.lit(float(low)) * F.col(bottom))
    if high is not None:
        ok = ok & (F.col(top) <= F.lit(float(high)) * F.col(bottom))
    return (F.col(bottom) == 0) | ok


def quality_rules(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Statistics, ``base_failed``, the names of failed rules, and ``kept``."""
    s = statistics(docs, id_col, text_col)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    failed = F.concat(*[F.when(holds(r), F.array().cast("array<string>")).otherwise(F.array(F.lit(r[0]))) for r in rules])
    ok = F.lit(True)
    for r in rules:
        ok = ok & holds(r)
    return s.withColumn("base_failed", base).withColumn("failed_rules", F.concat_ws(",", failed)).withColumn("kept", ~base & ok)
