"""Quality rules as one native projection.

``RULES`` is a table of (name, metric, comparison, threshold). ``quality_metrics`` computes every metric of a
whole text with built-in functions only, and ``compile_rules`` turns the table into one boolean Column.
No user function, no shuffle: one scan, one projection.

Definitions. Words are maximal runs of anything but blank, tab, line feed, vertical tab, form feed and carriage
return; a null text has none. Two 3-word windows are equal if their 64-bit fingerprints are (for 20,000 words the
chance of any false match is below 1e-10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[ \t\n\x0B\f\r]+"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "with", "as", "be", "by", "at", "this", "are", "from", "a",
    "le", "la", "les", "de", "des", "du", "et", "est", "un", "une", "en", "que", "dans", "pour", "par", "pas",
    "der", "die", "das", "und", "ist", "von", "den", "dem", "ein", "eine", "zu", "mit", "sich", "auf",
    "el", "los", "las", "y", "se", "no", "con", "por", "su", "una",
)

# As they stand in a text: lower case, capitalised and upper case.
STOP_FORMS = tuple(dict.fromkeys(form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())))

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_bangs", "n_stop_words")

# The threshold table: a text fails a rule when `metric comparison threshold` holds.
RULES = (
    ("too_few_words", "n_words", "<", 50.0),
    ("repeated_words", "repeat_word_ratio", ">", 0.5),
    ("symbols", "symbol_word_ratio", ">", 0.1),
    ("bangs", "bang_word_ratio", ">", 0.3),
    ("short_words", "mean_word_length", "<", 2.0),
    ("long_words", "mean_word_length", ">", 25.0),
    ("no_stop_words", "n_stop_words", "<", 2.0),
    ("duplicate_lines", "dup_line_ratio", ">", 0.5),
)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Number of words inside a 3-word window that stands at two or more places of the text."""
    def of_windows(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def covered(s: Column) -> Column:
            keys = F.transform(s, lambda x: x["h"])

            def starts(k: Column) -> Column:
                same = F.transform(s, lambda x, j: F.when(
                    (F.get(k, j + 1) == x["h"]) | (F.get(k, j - 1) == x["h"]), x["i"]))
                return F.filter(same, lambda i: i.isNotNull())

            return _let(_let(keys, starts), lambda p: F.size(F.array_distinct(F.concat(
                p, F.transform(p, lambda i: i + 1), F.transform(p, lambda i: i + 2)))))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(ordered, covered))

    def windows(w: Column) -> Column:
        n = F.size(w)
        pairs = F.zip_with(w, F.slice(w, F.lit(2), n), lambda x, y: F.xxhash64(x, y))
        return F.slice(F.zip_with(pairs, F.slice(w, F.lit(3), n), lambda x, y: F.xxhash64(x, y)), F.lit(1), n - 2)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(words, lambda w: _let(windows(w), of_windows)))


def _words(body: Column) -> Column:
    return F.array_remove(F.split(body, BLANKS), "")


def _lines(body: Column) -> Column:
    return F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))


def _counts(body: Column, words: Column, lines: Column) -> dict[str, Column]:
    counts = {
        "n_words": F.size(words), "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_lines": F.size(lines),
        "n_repeat_words": _repeat_words(words), "n_bangs": F.regexp_count(body, F.lit("!!")),
        "n_stop_words": F.size(F.array_intersect(words, F.array(*map(F.lit, STOP_FORMS))))}
    return {name: count.cast("long") for name, count in counts.items()}


def quality_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add a column ``_quality_<metric>`` for every metric; other columns stay untouched."""
    body = F.coalesce(F.col(text), F.lit(""))
    counts = _counts(body, F.col("_quality_words"), F.col("_quality_lines"))
    # Separate columns, not fields of one struct: the optimizer would inline a field at each of its uses.
    return (docs.withColumns({"_quality_words": _words(body), "_quality_lines": _lines(body)})
            .withColumns({f"_quality_{k}": v for k, v in counts.items()})
            .drop("_quality_words", "_quality_lines"))


def _base_failed(q) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def compile_rules(q, rules=RULES) -> Column:
    """True where no rule of the table rejects the text. A ratio over nothing is 0."""
    def per(a: str, b: str) -> Column:
        return F.when(q[b] > 0, q[a] / q[b]).otherwise(F.lit(0.0))

    metrics = {
        "n_words": q["n_words"], "n_stop_words": q["n_stop_words"],
        "repeat_word_ratio": per("n_repeat_words", "n_words"), "symbol_word_ratio": per("n_symbols", "n_words"),
        "bang_word_ratio": per("n_bangs", "n_words"), "mean_word_length": per("word_chars", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines")}
    compare = {"<": Column.__lt__, ">": Column.__gt__}
    kept = F.lit(True)
    for _, metric, how, threshold in rules:
        kept = kept & ~compare[how](metrics[metric], F.lit(threshold))
    return kept


def quality_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Every column of ``docs`` plus ``_quality_<metric>``, ``_quality_base_failed`` and ``_quality_kept``.

    Null and empty texts have no words and fail; repeated rows are judged alike, each on its own; an empty table
    gives an empty one; further columns pass through, and only the names ``_quality*`` are reserved.
    """
    q = {name: F.col(f"_quality_{name}") for name in METRICS}
    judged = quality_metrics(docs, text).withColumn("_quality_base_failed", _base_failed(q))
    return judged.withColumn("_quality_kept", ~F.col("_quality_base_failed") & compile_rules(q, rules))


def quality_filter(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns.

    The verdict is one expression whose metrics are bound once: a filter over named columns would be pushed below
    them and compute each metric at every use.
    """
    def verdict(words: Column) -> Column:
        def judge(lines: Column) -> Column:
            metrics = F.struct(*[v.alias(k) for k, v in _counts(body, words, lines).items()])
            return _let(metrics, lambda q: ~_base_failed(q) & compile_rules(q, rules))

        return _let(_lines(body), judge)

    body = F.coalesce(F.col(text), F.lit(""))
    return docs.filter(_let(_words(body), verdict))


def quality_digest(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, the base verdict and the verdict of the table."""
    return quality_rules(docs).select(
        "doc_id", *[F.col(f"_quality_{c}").alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])
