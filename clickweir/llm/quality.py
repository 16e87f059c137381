"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the whole text; nothing is shuffled and
no user function runs. A rule compares the ratio of two measures with its limits.

Defined results: a null or blank text has no words, all its measures are 0 and it
fails. Rows are judged one by one, so repeated rows get equal answers, and columns of
the input other than the text are neither read nor touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import position, shielded, unshielded
from clickweir.operators.columns import computed_once

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
MIN_WORDS = 50
WINDOW = 3
# Up to this many repeated windows of a text are found by lookup, more by sorting.
LOOKED_UP = 48

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from had has have he her his in is it not of on or she that "
    "the their they this to was were which will with you "
    "au aux avec ce ces dans de des du elle en et il la le les leur lui mais ne nous ou par pas "
    "pour que qui sa se ses son sur un une vous "
    "aber auf aus bei das dem den der die ein eine er es für ich im ist mit nach nicht sich sie "
    "sind und von war wir zu zum zur "
    "al como con del el está fue ha las lo los más no o para pero por su sus y"
).split()

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_stop_words", "n_shouted")


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= numerator / denominator <= high; 0 / 0 counts as 0."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


# Length, symbol, stop-word and line ratios of the production run.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("shouting", "n_shouted", "n_words", high=0.2),
    Rule("stop_words", "n_stop_words", "n_words", low=0.03),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.6),
)


def _measured(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the measures as columns; helper columns start with ``_q_``.

    The lists are made one projection apart: the optimizer keeps a costly column that
    is read several times in a projection of its own.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lists = df.withColumn("_q_text", body).withColumns({
        "_q_words": F.filter(F.split("_q_text", SPACE), lambda w: w != F.lit("")),
        "_q_lines": F.filter(F.split("_q_text", "\n"), lambda x: x.rlike(WORD)),
        "word_chars": F.length(F.regexp_replace("_q_text", SPACE, "")).cast("long"),
        "n_symbols": (F.length("_q_text")
                      - F.length(F.regexp_replace("_q_text", SYMBOLS, ""))).cast("long"),
    })
    sized = lists.withColumns({
        "n_words": F.size("_q_words").cast("long"),
        "n_lines": F.size("_q_lines").cast("long"),
        "n_dup_lines": (F.size("_q_lines")
                        - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "n_stop_words": F.size(F.filter(
            "_q_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
        "n_shouted": F.size(F.filter("_q_words", lambda w: w.endswith("!!"))).cast("long"),
    })
    starts = F.when(
        F.col("n_words") >= WINDOW,
        F.sequence(F.lit(1), F.size("_q_words") - (WINDOW - 1)),
    ).otherwise(F.array().cast("array<int>"))
    hashed = sized.withColumn("_q_starts", starts).withColumn("_q_hashes", F.transform(
        "_q_starts", lambda i: F.xxhash64(*[F.get("_q_words", i - 1 + k) for k in range(WINDOW)])))
    ordered = hashed.withColumn("_q_ordered", F.sort_array("_q_hashes"))
    repeated = ordered.withColumn("_q_repeated", F.array_distinct(F.filter(
        "_q_ordered", lambda h, k: h == F.get("_q_ordered", k + 1))))
    # Where they start. A few repeated windows are looked up one by one; with many, windows
    # are sorted with their positions instead, so that equal ones become neighbours.
    few = F.filter("_q_starts", lambda i: F.array_contains(
        "_q_repeated", F.get("_q_hashes", i - 1)))
    placed = repeated.withColumn("_q_placed", F.when(
        F.size("_q_repeated") > LOOKED_UP,
        F.sort_array(F.transform("_q_starts", lambda i: F.struct(
            F.get("_q_hashes", i - 1).alias("h"), i.alias("at")))),
    ))
    many = F.array_sort(F.transform(
        F.filter("_q_placed", lambda w, k: (w["h"] == F.get("_q_placed", k - 1)["h"])
                 | (w["h"] == F.get("_q_placed", k + 1)["h"])),
        lambda w: w["at"],
    ))
    found = placed.withColumn("_q_found", F.when(F.size("_q_repeated") == 0, F.array().cast(
        "array<int>")).when(F.size("_q_repeated") <= LOOKED_UP, few).otherwise(many))
    # A found window covers its words up to the next found one.
    covered = F.aggregate(
        F.transform("_q_found", lambda at, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_q_found", k + 1) - at, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    return found.withColumn("n_repeat_words", covered)


def _broken(rule: Rule) -> Column:
    ratio = F.when(F.col(rule.denominator) > 0, F.col(rule.numerator) / F.col(rule.denominator))
    ratio = F.coalesce(ratio, F.lit(0.0))
    below = ratio < rule.low if rule.low is not None else F.lit(False)
    above = ratio > rule.high if rule.high is not None else F.lit(False)
    return below | above


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with one struct column ``quality``.

    It holds the measures, ``base_failed`` (too short or repetitive), ``broken`` (the
    names of the rules that the text breaks) and ``kept``.
    """
    names = F.filter(
        F.array(*[F.when(_broken(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    rows, columns = shielded(df)
    measured = _measured(rows, position(df, text))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    flagged = measured.select(
        *columns, *MEASURES, base_failed.alias("base_failed"), names.alias("broken"))
    # A filter on the result would be pushed below all these projections, and its
    # expressions repeated for each element of a list; it stops at a generator.
    judged = computed_once(flagged, "_q_result", F.struct(
        *MEASURES, "base_failed", "broken",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"),
    ))
    return unshielded(judged, columns, df.columns, F.col("_q_result").alias("quality"))


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that pass, with its own columns only."""
    rows, columns = shielded(df)
    judged = judge(rows, position(df, text), rules)
    return judged.where("quality.kept").select(*columns).toDF(*df.columns)
