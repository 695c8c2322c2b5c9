"""Quality rules with adaptive thresholds (operator 9, DataFrame functions only).

Per document: ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
``n_dup_lines`` (lines with a word that equal an earlier line) and
``n_repeat_words`` (words inside a window of ``WINDOW`` words that occurs twice
or more in the document).  They are computed inside the row with array
functions, so nothing is shuffled or exploded.

Rates derived from the counts (``METRICS``) are summarised per language and
source by mergeable quantile sketches (``approx_percentile``, whose partial
sketches combine on the map side: one small row per group and task, however
large a source is).  A group's upper fence is its ``TAIL`` quantile plus ``FENCE`` times
that quantile's distance from the median (at least ``LEAST_WIDTH``), its lower fence likewise
from the other tail.  The fences of a group are shrunk towards those of its
language, and these towards those of all documents, with weight ``size / (size + PRIOR)``, so
that small groups have no rule of their own and no size changes the rule.  A document fails
where its count lies beyond the fence times its size by more than a few single events
(``slack``: what a short document may show by chance).  Fixed rules (``base_failed``) stay besides.

Defined results: a null or empty text has zero counts and fails the fixed
rule; a null language or source is a group of its own; repeated rows are
rated alike; an empty table gives an empty result; texts of any length are
read whole; other input columns (also ones named like a result) are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import materialize

WHITE = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
TAIL = 0.95
FENCE = 3.0
#: Least distance of a tail from the median: only against fences of width 0 where most documents have none of a thing.
LEAST_WIDTH = 0.005
PRIOR = 50.0
ACCURACY = 2000
# rate -> (count, size, events a document may have beyond its group's fence, lower fence used)
METRICS = {
    "mean_word": ("word_chars", "n_words", None, True),   # its slack is the standard error of a mean of lengths
    "symbol_rate": ("n_symbols", "word_chars", 3.0, False),
    "dup_line_rate": ("n_dup_lines", "n_lines", 2.0, False),
    "repeat_rate": ("n_repeat_words", "n_words", 4.0 * WINDOW, False),
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row (a lambda variable),
    however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def _repeated(windows: Column, window: int) -> Column:
    """Words inside windows whose hash occurs at least twice.

    Hashes are sorted with their positions; neighbours of equal hash are
    repeats.  Their positions, sorted again, cover up to ``window`` words
    each, less what the previous one covers too."""
    def same(keyed: Column, x: Column, j: Column) -> Column:
        return F.coalesce(F.get(keyed, j)["h"] == x["h"], F.lit(False))

    def total(at: Column) -> Column:
        return F.aggregate(
            at, F.struct(F.lit(0).alias("sum"), F.lit(-window).alias("last")),
            lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(window), i - acc["last"])).alias("sum"), i.alias("last")),
            lambda acc: acc["sum"])
    keyed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(keyed, lambda k: let(
        F.sort_array(F.transform(F.filter(k, lambda x, j: same(k, x, j - 1) | same(k, x, j + 1)), lambda x: x["i"])),
        total))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words covered by windows that occur twice or more in ``words``."""
    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _repeated(windows, window)).otherwise(0)

    def of_hashes(h: Column) -> Column:
        return F.when(F.size(h) > window, let(
            F.transform(F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, window))),
            of_windows)).otherwise(0)
    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """Base counts per document, with its language and source."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    of_words = lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeated"))
    of_lines = lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(A_WORD))
    without = lambda chars: F.length(F.translate(text, chars, ""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        let(words_of(text), of_words).alias("w"), let(lines, of_lines).alias("l"),
        without(BLANKS).cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols")).select(
        "doc_id", "lang", "source", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("l.dup").cast("long").alias("n_dup_lines"), F.col("l.n").cast("long").alias("n_lines"),
        F.col("w.repeated").cast("long").alias("n_repeat_words"))


def rates(counts: DataFrame) -> DataFrame:
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return counts.withColumns({m: part(a, b) for m, (a, b, _, _) in METRICS.items()}).withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def fences(rated: DataFrame, by: list[str]) -> DataFrame:
    """Group size and fences of every rate, per group of the given columns.

    Documents that already fail the fixed rules take no part."""
    passed = rated.filter(~F.col("base_failed"))
    sketch = [F.percentile_approx(m, [1 - TAIL, 0.5, TAIL], ACCURACY).alias(m) for m in METRICS]
    out = passed.groupBy(*by).agg(F.count("*").alias("size"), *sketch)
    for m in METRICS:
        low, middle, high = (F.get(F.col(m), F.lit(i)) for i in range(3))
        out = out.withColumns({f"{m}_low": low - FENCE * F.greatest(middle - low, F.lit(LEAST_WIDTH)),
                               f"{m}_high": high + FENCE * F.greatest(high - middle, F.lit(LEAST_WIDTH))})
    return out.drop(*METRICS)


def _shrunk(size: str, own: str, wider: Column) -> Column:
    weight = F.coalesce(F.col(size), F.lit(0)) / (F.coalesce(F.col(size), F.lit(0)) + PRIOR)
    return F.coalesce(weight * F.col(own) + (1 - weight) * wider, wider)


def quality(docs: DataFrame, **columns: str) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` per document row."""
    rated = materialize(rates(measures(docs, **columns)))
    limits = [f"{m}_{side}" for m in METRICS for side in ("low", "high")]
    group, lang, total = fences(rated, ["lang", "source"]), fences(rated, ["lang"]), fences(rated, [])

    def named(frame: DataFrame, prefix: str, by: list[str]) -> DataFrame:
        return frame.select(*(F.col(c).alias(f"{prefix}_{c}") for c in [*by, "size", *limits]))
    wide = (rated
            .join(named(group, "g", ["lang", "source"]),
                  F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left")
            .join(named(lang, "l", ["lang"]), F.col("lang").eqNullSafe(F.col("l_lang")), "left")
            .join(F.broadcast(named(total, "a", [])), F.lit(True), "left"))  # exactly one row
    bound = lambda c: _shrunk("g_size", f"g_{c}", _shrunk("l_size", f"l_{c}", F.col(f"a_{c}")))
    inside = F.lit(True)
    for m, (count, size, slack, lower) in METRICS.items():
        n = F.col(size)
        slack = F.lit(slack) if slack is not None else 9.0 * F.sqrt(n)
        # no fence at all where no document passes the fixed rules
        inside = inside & F.coalesce(F.col(count) <= bound(f"{m}_high") * n + slack, F.lit(True))
        if lower:
            inside = inside & F.coalesce(F.col(count) >= bound(f"{m}_low") * n - slack, F.lit(True))
    return wide.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"))
