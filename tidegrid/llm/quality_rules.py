"""Quality rules: a threshold table compiled into one Spark projection, with no user functions.

``MEASURES`` gives each measure as a Column over the text's words and lines; ``RULES`` gives bounds on
measures. ``apply_rules`` adds the measures, the base verdict, the failed rules and ``kept``.

A null or empty text has no words, no lines and ratios of 0; it fails the base rule on length. Ties do not
arise; repeated rows are judged alike; an empty table gives no rows. Other columns pass through; those named
like an output column are replaced. A text of any length is judged whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = """
the of and to a in is it that for was on as with by be this are from at or an not
der die und das den dem des ein eine einen ist zu mit von im auf sich nicht für auch als
le la les de des du et en un une que qui est dans pour sur pas par au plus
el los las y un una con por se del para es lo su
il che di non per sono gli o os um uma não het een van dat
""".split()

#: (rule, measure, lowest, highest) allowed; None: no bound.
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("mean_word_length", "mean_word_length", 2.0, 20.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("capitals", "capital_ratio", None, 0.3),
    ("stop_words", "stop_ratio", 0.01, None),
    ("line_ends", "ended_line_ratio", 0.5, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.3),
    ("repeated_words", "repeat_ratio", None, 0.3),
]

OUTPUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that are found twice or more: equal windows meet in one sort of the row's own array, by a 64-bit hash; only
    texts with a hash that is found twice are sorted, and windows of one hash have to have the same words."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(3))))

    def adjacent(ordered: Column) -> Column:
        def same(s: Column, j: Column, step: int) -> Column:
            other = F.get(ordered, j + step)
            equal = other["h"] == s["h"]
            for k in range(3):
                equal = equal & (F.get(words, other["i"] + k) == F.get(words, s["i"] + k))
            return F.coalesce(equal, F.lit(False))

        return F.array_sort(F.transform(F.filter(ordered, lambda s, j: same(s, j, -1) | same(s, j, 1)), lambda s: s["i"]))

    def total(found: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(found, zero, lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end")), lambda a: a["n"])

    def count(own: Column) -> Column:
        ordered = F.array_sort(F.transform(own, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(own)) == F.size(own), F.lit(0)).otherwise(total(let(ordered, adjacent)))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, count)).cast("long")


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Counts first; the ratios, which name the counts' columns, after them."""
    per_word = lambda c: F.coalesce(F.try_divide(c, F.col("n_words")), F.lit(0.0))
    per_line = lambda c: F.coalesce(F.try_divide(c, F.size(lines)), F.lit(0.0))
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))  # a match a run, not a match a letter
    ended = F.size(F.filter(lines, lambda x: x.rlike(r"[.!?:;…。！？\"'»”’)\]][\x20\x09-\x0D]*$")))
    stops = F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "mean_word_length": per_word(F.col("word_chars")),
        "symbol_ratio": per_word(F.col("n_symbols")),
        "capital_ratio": F.coalesce(F.try_divide(F.regexp_count(text, F.lit("[A-Z]")), letters), F.lit(0.0)),
        "stop_ratio": per_word(stops),
        "ended_line_ratio": per_line(ended),
        "dup_line_ratio": per_line(F.col("n_dup_lines")),
        "repeat_ratio": per_word(F.col("n_repeat_words")),
    }


def apply_rules(documents: DataFrame, rules: list[tuple[str, str, float | None, float | None]] = RULES) -> DataFrame:
    """documents with OUTPUT's columns; failed_rules lists the names of the rules that failed, in the table's order."""
    text = F.coalesce(F.col("__tg_t"), F.lit(""))
    kept = [c for c in documents.columns if c.lower() not in OUTPUT]
    lines = F.filter(F.split("__tg_t", "\n", -1), lambda x: x.rlike(WORD))
    split = documents.select(*(F.col(f"`{c}`") for c in kept), F.coalesce("text", F.lit("")).alias("__tg_t"))
    split = split.withColumns({"__tg_w": F.regexp_extract_all("__tg_t", F.lit(WORD), F.lit(0)), "__tg_l": lines})
    made = measures(text, F.col("__tg_w"), F.col("__tg_l"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    measured = split.withColumns({k: made[k] for k in counts}).withColumns({f"__tg_{k}": v for k, v in made.items() if k not in counts})
    of = lambda m: F.col(m if m in counts else f"__tg_{m}")
    failed = []
    for name, measure, low, high in rules:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (of(measure) < low)
        if high is not None:
            bad = bad | (of(measure) > high)
        failed.append(F.when(bad, F.lit(name)))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = measured.withColumns({"base_failed": base, "failed_rules": F.array_compact(F.array(*failed))})
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return judged.select(*(F.col(f"`{c}`") for c in kept), *OUTPUT)
