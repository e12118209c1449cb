"""Quality rules: one projection compiled from a table of thresholds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but blank and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Words of a repeated passage.
WINDOW = 5

# Frequent words of the languages in the corpus.
STOP_WORDS = (
    "the of and to a in is that for it on was with be as this at by are from "
    "de et le la les des en un du une que est pour au dans qui par pas sur avec "
    "der die und zu den von das sich mit für auf im nicht ist dem eine ein als "
    "el los se del y por las con una no para lo su es al"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails where the numerator is over ``most`` or under ``least`` percent of the denominator.

    Only documents of at least ``from_words`` words are held against it.
    """

    name: str
    numerator: str
    denominator: str
    least: int | None = None
    most: int | None = None
    from_words: int = 0


#: Ratios of clean prose lie well inside these bounds.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("exclamations", "n_exclamations", "n_words", most=30),
    Rule("lines", "n_dup_lines", "n_lines", most=40),
    Rule("stop_words", "n_stop_words", "n_words", least=2, from_words=40),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a variable, so that it is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five that occur at least twice in the text."""

    def covered(starts: Column) -> Column:
        own = F.transform(
            starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    def repeated(ordered: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(ordered, i)["h"] == x["h"], F.lit(False))
        marked = F.transform(ordered, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["at"]))
        return _let(F.sort_array(F.array_compact(marked)), covered)

    def counted(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            _let(ordered, repeated)
        )

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(
        _let(hashed, lambda h: _let(windows(h), counted))
    )


def measures(docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """Columns ``keep`` and ``_m``, a struct of counts over the whole text.

    A null text has no words, lines or symbols. Repeated rows each get a row.
    """
    words = F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    found = docs.select(F.col(keep), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumns(
        {"_words": words, "_lines": lines}
    )
    w, lines = F.col("_words"), F.col("_lines")
    counts = {
        "n_words": F.size(w),
        "word_chars": F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOL)),
        "n_exclamations": F.regexp_count("_text", F.lit("!")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))),
        "n_repeat_words": _repeat_words(w),
    }
    return found.select(keep, F.struct(*[c.cast("long").alias(n) for n, c in counts.items()]).alias("_m"))


def base_failed(m: Column) -> Column:
    """Fewer than ten words, or more than a fifth of them in repeated passages."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def rule_failed(rule: Rule, m: Column) -> Column:
    over = F.lit(False)
    if rule.most is not None:
        over = over | (100 * m[rule.numerator] > rule.most * m[rule.denominator])
    if rule.least is not None:
        over = over | (100 * m[rule.numerator] < rule.least * m[rule.denominator])
    return over & (m["n_words"] >= rule.from_words)


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: str = "doc_id"
) -> DataFrame:
    """Columns ``keep``, ``_m``, ``base_failed``, ``failed`` (names of rules) and ``kept``.

    Null and empty texts fail the base test. An empty table gives an empty result.
    """
    m = F.col("_m")
    failed = F.array_compact(F.array(*[F.when(rule_failed(r, m), F.lit(r.name)) for r in rules]))
    return (
        measures(docs, text, keep)
        .withColumns({"base_failed": base_failed(m), "failed": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that pass the base test and every rule, with their own columns only.

    All columns of ``docs`` travel in one struct, so that no name can clash.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = judge(docs.select(whole.alias("_own"), F.col(text).alias("_t")), rules, "_t", "_own")
    # A filter moves below the columns it needs, and then computes the words anew for every use of
    # them. It stays above a column that counts rows, so the measures are made once.
    return judged.withColumn("_row", F.monotonically_increasing_id()).filter("kept AND _row >= 0").select("_own.*")
