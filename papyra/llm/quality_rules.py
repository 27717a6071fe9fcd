"""Quality rules whose cutoffs are certified on labelled holdouts, stratum by stratum."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.llm.labels import agreed_labels
from papyra.llm.stored import stored
from papyra.sources.sizes import can_broadcast

WORD_SPACE = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# Each rule's measure, of which more is worse, and the cutoffs tried, from lax to strict. They are
# fixed beforehand, so every labelled document is a holdout for them.
RULES = {
    "symbols": (2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "stutter": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "capitals": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "repeats": (0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
}
# Per rule and stratum, the share of good documents that may be rejected, and the chance, over all
# rules and strata together, that any certified cutoff rejects more than that.
RISK = 0.02
CONFIDENCE_LOSS = 0.05


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col``, with counts over the whole text; null texts count as empty.

    Added: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, the number of lines
    with a word, of words equal to the word before, and of letters A-Z. Everything is computed
    inside the row.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = [c for c in docs.columns if c != text_col]
    first = docs.select(
        *kept,
        F.array_remove(F.split(text, WORD_SPACE + "+"), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_SPACE)).alias("_lines"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("_capitals"),
    )
    starts = F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1))
    hashes = F.when(
        F.size("_words") > WINDOW,
        F.transform(starts, lambda start: F.xxhash64(F.slice("_words", start, F.lit(WINDOW)))),
    ).otherwise(F.array().cast("array<bigint>"))
    repeats = F.filter(
        "_words", lambda word, at: (at > 0) & (word == F.get("_words", at - 1))
    )
    second = first.select(
        *kept, "n_symbols", "_capitals",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(repeats).cast("long").alias("_stutter"),
        hashes.alias("_hashes"),
    )
    # Only texts with an equal pair of windows pay for the sort that finds all of them.
    placed = F.sort_array(F.transform("_hashes", lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    third = second.withColumn(
        "_sorted", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), placed)
    )
    same = F.filter(
        "_sorted",
        lambda one, j: (one["h"] == F.get("_sorted", j + 1)["h"])
        | ((j > 0) & (one["h"] == F.get("_sorted", F.greatest(j - 1, F.lit(0)))["h"])),
    )
    starts = F.sort_array(F.transform(same, lambda one: one["at"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        starts, zero,
        lambda state, at: F.struct(
            (state["n"] + F.least(F.lit(WINDOW), at + WINDOW - state["end"])).alias("n"),
            (at + WINDOW).alias("end"),
        ),
    )["n"]
    return third.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "_n_lines", "_stutter", "_capitals",
    )


def rule_values() -> dict[str, Column]:
    """The measure of each rule, from the counts of ``measures``."""
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return {
        "symbols": share("n_symbols", "n_words"), "stutter": share("_stutter", "n_words"),
        "capitals": share("_capitals", "word_chars"), "dup_lines": share("n_dup_lines", "_n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series from 21 on (error below 1e-12)."""
    x = n.cast("double")
    series = (
        x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x)
        + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))
    )
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(at most ``k`` of ``n``) for chance ``p``; 1 where ``k`` is not below the mean.

    Below the mean the terms shrink from ``k`` down, so they are summed in that order.
    """
    odds = (1 - p) / p
    start = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] * i / (n - i + 1) * odds
        return F.struct((state["sum"] + term).alias("sum"), term.alias("term"))

    down = F.when(k > 0, F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    log_first = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
        + k * math.log(p) + (n - k) * math.log(1 - p)
    )
    return F.when(k >= n * p, 1.0).otherwise(
        F.exp(log_first + F.log(F.aggregate(down, start, add)["sum"]))
    )


def certified_cutoffs(
    measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang",
    label_col: str = "quality", risk: float = RISK, loss: float = CONFIDENCE_LOSS,
) -> DataFrame:
    """``stratum, rule, cutoff, n_good, good_rejected, n_bad, bad_rejected, p_value``.

    A cutoff is certified when so few of a stratum's good holdouts exceed it that, were its true
    rate of false rejection ``risk``, so few would be seen with a chance of at most the level: the
    exact one-sided binomial test, the same as an upper Clopper-Pearson bound below ``risk``. A
    rule's cutoffs are tested from lax to strict and testing stops at the first that fails, which
    needs no correction; the level is ``loss`` divided by the number of rules and strata
    (Bonferroni). Of the certified cutoffs the one with the largest rejected share of bad less that
    of good holdouts is taken, the laxest of equals, and none that rejects no bad holdout.
    """
    values = rule_values()
    good = agreed_labels(labels, id_col, label_col, "_label").select(
        F.col("id").alias(id_col), (F.col("_label") == 1).alias("_good")
    )
    held = measured.where(~base_failed()).join(good, id_col).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), "_good",
        F.array(*[
            F.struct(F.lit(rule).alias("rule"), values[rule].alias("value")) for rule in RULES
        ]).alias("_values"),
    )
    # Holdouts must be independent: documents of one id are one, the least by its measures.
    held = held.groupBy("id").agg(F.min(F.struct("stratum", "_good", "_values")).alias("one")).select("one.*")
    grid = F.create_map(*[
        x for rule, cuts in RULES.items() for x in (F.lit(rule), F.array(*map(F.lit, cuts)))
    ])
    tried = (
        held.select("stratum", "_good", F.explode("_values").alias("v"))
        .select("stratum", "_good", "v.rule", "v.value", F.posexplode(grid[F.col("v.rule")]).alias("step", "cutoff"))
        .groupBy("stratum", "rule", "step", "cutoff")
        .agg(
            F.count_if(F.col("_good")).alias("n_good"),
            F.count_if(F.col("_good") & (F.col("value") > F.col("cutoff"))).alias("good_rejected"),
            F.count_if(~F.col("_good")).alias("n_bad"),
            F.count_if(~F.col("_good") & (F.col("value") > F.col("cutoff"))).alias("bad_rejected"),
        )
    )
    strata = max(held.select("stratum").distinct().count(), 1)
    tested = tried.withColumn(
        "p_value", binomial_tail(F.col("good_rejected"), F.col("n_good"), risk)
    )
    level = loss / (len(RULES) * strata)
    failed = F.when(F.col("p_value") > level, F.col("step"))
    one = F.struct(
        "step", "cutoff", "n_good", "good_rejected", "n_bad", "bad_rejected", "p_value",
        failed.alias("failed"),
    )
    rules = tested.groupBy("stratum", "rule").agg(
        F.collect_list(one).alias("steps"), F.min(failed).alias("first_failed")
    )
    gain = lambda s: s["bad_rejected"] / s["n_bad"] - s["good_rejected"] / s["n_good"]
    passed = F.filter(
        "steps",
        lambda s: (F.col("first_failed").isNull() | (s["step"] < F.col("first_failed"))) & (s["bad_rejected"] > 0),
    )
    best = F.array_max(F.transform(
        passed, lambda s: F.struct(gain(s).alias("gain"), (-s["step"]).alias("order"), s.alias("s"))
    ))
    return rules.select("stratum", "rule", best["s"].alias("s")).where("s is not null").select(
        "stratum", "rule", "s.cutoff", "s.n_good", "s.good_rejected", "s.n_bad", "s.bad_rejected", "s.p_value"
    )


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    stratum_col: str = "lang", label_col: str = "quality", row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the counts, ``base_failed, kept, failed_rules``.

    Kept is a document that passes the base rules and exceeds none of its stratum's certified
    cutoffs (see ``certified_cutoffs``). A stratum with too few labels has none, and loses only
    what the base rules reject; null strata form one stratum. Null and empty texts fail the base
    rules. Null and repeated ids are kept, each row for itself; labels of an id that contradict
    each other are not used. Without documents there are no rows; without labels only the base rules
    act. ``row_col``, a column of ``docs``, comes last in the result if it is given.
    """
    given = docs.select(
        F.col(id_col), *([] if row_col is None else [F.col(row_col).alias("_row")]), F.col(stratum_col).cast("string").alias("_stratum"), F.col(text_col).alias("_text")
    )
    measured = stored(measures(given, "_text"), "measures")
    cutoffs = certified_cutoffs(measured, labels, id_col, "_stratum", label_col)
    limits = stored(
        cutoffs.groupBy("stratum").agg(
            F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_limits")
        ),
        "cutoffs",
    )
    size = limits.select("stratum", F.lit("x" * 200).alias("limits"))
    limits = F.broadcast(limits) if can_broadcast(size) else limits
    values = rule_values()
    failed = F.array_compact(F.array(*[
        F.when(values[rule] > F.coalesce(F.col("_limits")[rule], F.lit(float("inf"))), F.lit(rule)) for rule in RULES
    ]))
    stratum = F.coalesce(F.col("_stratum"), F.lit(""))
    return (
        measured.join(limits, stratum == F.col("stratum"), "left")
        .withColumn("base_failed", base_failed()).withColumn("failed_rules", failed)
        .select(
            id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules",
            *([] if row_col is None else [F.col("_row").alias(row_col)]),
        )
    )
