"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is a built-in column function: the measures are array and string
expressions of the text, the verdict is the conjunction of the table's rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Common function words of the four languages.
STOP_WORDS = ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "with", "as", "be", "by", "at",
              "this", "are", "was", "an", "from", "he", "or", "der", "die", "das", "und", "von", "zu", "mit", "den",
              "des", "ist", "ein", "eine", "nicht", "auf", "für", "le", "la", "les", "de", "et", "un", "une", "que",
              "qui", "dans", "pour", "sur", "pas", "est", "du", "avec", "en", "el", "los", "las", "y", "se", "no",
              "por", "para", "es", "del")


@dataclass(frozen=True)
class Rule:
    """A row passes if ``low <= measure <= high``; an open end is None; a null measure passes."""
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_chars", 2.0, 16.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("upper_share", None, 0.5),
    Rule("stop_word_share", 0.02, None),
    Rule("dup_line_share", None, 0.5),
    Rule("exclaimed_share", None, 0.3),
)


def _chars(c: Column) -> Column:
    return F.char_length(c).cast("long")


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def _repeat_words(doc: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``_wh``, the array of word hashes, in sorting steps.

    Window hashes are sorted with their places; equal neighbours are repeats; a
    repeated window covers the words up to the next repeated window, five at most.
    """
    wh = F.col("_wh")
    windows = F.when(F.size(wh) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(wh) - WINDOW),
        lambda i: F.xxhash64(*[wh[i + k] for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    doc = doc.withColumn("_win", windows)
    win = F.col("_win")
    ordered = F.when(F.size(F.array_distinct(win)) < F.size(win), F.sort_array(
        F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    doc = doc.withColumn("_ord", ordered)
    o = F.col("_ord")
    same = lambda j: (F.get(o, j)["h"] == F.get(o, j + 1)["h"])
    places = F.sort_array(F.transform(F.filter(
        F.sequence(F.lit(0), F.size(o) - 1),
        lambda j: F.coalesce(same(j), F.lit(False)) | F.coalesce(same(j - 1), F.lit(False))),
        lambda j: F.get(o, j)["i"]))
    doc = doc.withColumn("_at", F.when(o.isNotNull(), places))
    at = F.col("_at")
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size(at) - 1), F.lit(0).cast("long"),
        lambda acc, j: acc + F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - F.get(at, j), F.lit(WINDOW))))
    return doc.withColumn("n_repeat_words", F.when(at.isNotNull(), covered).otherwise(F.lit(0).cast("long")))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each whole text (null text: no words, one empty line)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = docs.select("doc_id", text.alias("_t")).withColumn("_w", F.array_remove(F.split("_t", r"[\x20\x09-\x0D]+"), ""))
    doc = doc.select("doc_id", "_t", "_w", F.transform("_w", lambda w: F.xxhash64(w)).alias("_wh"),
                     F.filter(F.split("_t", "\n", -1), lambda s: F.btrim(s, F.lit(SPACES)) != "").alias("_lines"))
    doc = _repeat_words(doc)
    t, w, lines = F.col("_t"), F.col("_w"), F.col("_lines")
    n_chars = _chars(t)
    return doc.select(
        "doc_id",
        F.size(w).cast("long").alias("n_words"),
        _chars(_without(t, SPACES)).alias("word_chars"),
        (n_chars - _chars(_without(t, SYMBOLS))).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size(lines).cast("long").alias("n_lines"),
        (n_chars - _chars(_without(t, UPPER))).alias("n_upper"),
        (n_chars - _chars(_without(t, LOWER))).alias("n_lower"),
        (n_chars - _chars(_without(t, "!"))).alias("n_exclaimed"),
        F.size(F.filter(w, lambda x: F.translate(x, UPPER + ".,!", LOWER).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


#: Ratio measures: (count, what it is divided by); null where the divisor is 0.
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "upper_share": ("n_upper", "n_upper + n_lower"),
    "stop_word_share": ("n_stop_words", "CASE WHEN n_words >= 50 THEN n_words ELSE 0 END"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "exclaimed_share": ("n_exclaimed", "n_words"),
}


def _ratio(measure: str) -> Column:
    count, base = RATIOS[measure]
    return F.when(F.expr(base) > 0, F.expr(count) / F.expr(base))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of the names of the rules that a row of :func:`measures` fails."""
    fails = []
    for r in rules:
        m, bad = _ratio(r.measure), F.lit(False)
        if r.low is not None:
            bad = bad | (m < r.low)
        if r.high is not None:
            bad = bad | (m > r.high)
        fails.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(r.measure)))
    return F.array_compact(F.array(*fails))


def rules_sql(rules: tuple[Rule, ...] = RULES) -> list[str]:
    """The table's rows as SQL conditions on the counts."""
    out = []
    for r in rules:
        count, base = RATIOS[r.measure]
        for bound, sign in ((r.low, ">="), (r.high, "<=")):
            if bound is not None:
                out.append(f"coalesce({count} / nullif({base}, 0) {sign} {bound}, true)")
    return out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, ...): the counts, ``base_failed``,
    ``kept`` and ``failed`` (names of the rules that did not hold).

    Null or blank text: zero words, so ``base_failed`` and not kept.  Ids may repeat
    or be null; other columns are ignored; an empty table gives an empty result.
    """
    m = measures(docs)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    m = m.withColumn("base_failed", base).withColumn("failed", compile_rules(rules))
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
