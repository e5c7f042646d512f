"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Each rule rejects a text whose signal lies above a cutoff.  Cutoffs come from a
fixed grid and are certified per stratum on labelled documents: for a cutoff
that rejects ``k`` of ``n`` good documents, the exact binomial tail
``P(Bin(n, risk) <= k)`` is the p-value of "it rejects more than ``risk`` of
the good ones".  Within a rule, cutoffs are tested from the most lenient on and
the first failure ends the sequence (fixed-sequence testing), so no correction
is needed inside it; across rules and strata the level is divided by their
number (Bonferroni).  The risk is divided by the number of rules, so all rules
together falsely reject at most ``risk`` of a stratum's good documents, with
probability ``1 - delta`` over all strata at once.  Of the certified cutoffs,
all of which are valid at once, the one that separates bad from good best is
used (ties: the most lenient).

Statistics cover all labelled documents.  They shuffle one row per stratum,
rule and level and task; no document text moves.

Defined cases: null text has no words and fails the base rule; a null stratum is
a stratum of its own; a document labelled twice is good only if every label says
so; null labels are ignored; strata with too few labels certify nothing and keep
what the base rule keeps; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved

SPACE = r"[\\x20\\x09-\\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

MOST_CUTOFFS = 50_000  # certified cutoffs (strata x rules) that may be broadcast

# rule -> (signal, cutoffs from lenient to strict); the signal is null without words
RULES = {
    "symbols": ("n_symbols / n_words", (2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "word_length": ("word_chars / n_words", (40.0, 25.0, 20.0, 15.0, 12.0, 11.0, 10.0, 9.0)),
    "dup_lines": ("n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "repeats": ("n_repeat_words / n_words", (0.28, 0.25, 0.2, 0.15, 0.1, 0.05)),
    "shouting": ("n_upper / word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    "marks": ("n_marks / n_words", (3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2)),
}

# Words in 8-word windows that occur twice or more.  ``transform(array(x), y -> ...)[0]``
# binds x once; windows are compared by a 64-bit hash of their words' 64-bit hashes.
_REPEATS = """
transform(array(transform(__words, w -> xxhash64(w))), h -> CASE WHEN size(h) < 9 THEN 0L ELSE
 transform(array(transform(sequence(0, size(h) - 8), i -> xxhash64(
     h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4], h[i + 5], h[i + 6], h[i + 7]))),
  g -> CASE WHEN size(array_distinct(g)) = size(g) THEN 0L ELSE
   transform(array(array_sort(transform(g, (x, i) -> struct(x AS x, i AS i)))), s ->
    aggregate(
     array_sort(transform(
      filter(sequence(0, size(s) - 1), j -> coalesce(get(s, j - 1).x = s[j].x, false)
                                         OR coalesce(get(s, j + 1).x = s[j].x, false)),
      j -> s[j].i)),
     struct(0L AS c, -8 AS p),
     (a, p) -> struct(a.c + least(8, p - a.p) AS c, p AS p),
     a -> a.c))[0] END)[0] END)[0]
"""


def with_signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts and one column ``signal_<rule>`` for each rule.

    Columns of ``docs`` with these names are replaced.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def count(of: str) -> Column:
        return F.length("__text") - F.length(F.translate("__text", of, ""))

    out = (docs.withColumn("__text", text)
           .withColumn("__words", F.expr(f"filter(split(__text, '{SPACE}'), w -> w != '')"))
           .withColumn("__lines", F.expr(r"filter(split(__text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
           .withColumns({
               "n_words": F.size("__words").cast("long"),
               "word_chars": F.length(F.translate("__text", " \t\n\x0b\x0c\r", "")).cast("long"),
               "n_symbols": count("#*$%&|<>").cast("long"),
               "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
               "n_repeat_words": F.expr(_REPEATS),
               "n_lines": F.size("__lines").cast("long"),
               "n_upper": count(letters).cast("long"),
               "n_marks": count("!?").cast("long"),
           }).drop("__text", "__words", "__lines"))
    out = out.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
    return out.withColumns({f"signal_{r}": F.expr(f"CASE WHEN n_words > 0 THEN {e} END") for r, (e, _) in RULES.items()})


def _log_gamma(x: Column) -> Column:
    """ln gamma for x >= 1: Stirling's series after a shift by 8."""
    z = x + 8
    shift = F.lit(1.0)
    for i in range(8):
        shift = shift * (x + i)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - F.log(shift)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k): the top term by log gamma, the lower ones by their ratios.

    Terms more than 12 standard deviations below ``k`` vanish in double
    precision.  Above the mean the answer is only used as "more than any level",
    so 1 is returned there.
    """
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
                + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    terms = F.least(k, F.ceil(12 * F.sqrt(n * p)) + 50).cast("int")
    below = F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>"))
    odds = (1 - p) / p
    ratio_sum = F.aggregate(
        below, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
        lambda a, i: F.struct((a["t"] * (k - i) / (n - k + i + 1) * odds).alias("t"),
                              (a["s"] + a["t"] * (k - i) / (n - k + i + 1) * odds).alias("s")),
        lambda a: a["s"])
    return F.when(n <= 0, F.lit(1.0)).when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * ratio_sum))


def _level(rule: str) -> str:
    """Number of the rule's cutoffs that the signal exceeds."""
    return " + ".join(f"CASE WHEN signal_{rule} > {c} THEN 1 ELSE 0 END" for c in RULES[rule][1])


def certified_cutoffs(signals: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", stratum_col: str = "lang",
                      risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff, n_good, k_good, n_bad, k_bad, p_value), one row per certified rule."""
    good = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
            .agg((F.min("quality") > 0).alias("__good")))
    held = (signals.where(~F.col("base_failed"))
            .select(F.col(id_col).alias("__id"), F.col(stratum_col).cast("string").alias("stratum"),
                    F.array(*[F.struct(F.lit(r).alias("rule"), F.expr(_level(r)).alias("level")) for r in RULES]).alias("levels"))
            .join(good, "__id").select("stratum", "__good", F.inline("levels")))
    counts = saved(held.groupBy("stratum", "rule", "level").agg(
        F.count(F.when(F.col("__good"), 1)).alias("good"), F.count(F.when(~F.col("__good"), 1)).alias("bad")), "level_counts")
    # cutoffs fall, so the i-th of n is exceeded from level n - i on: sums over a table of stratum x rule x level rows
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("place"), F.lit(c).alias("cutoff"),
                              F.lit(len(cuts) - i).alias("from_level"))
                     for r, (_, cuts) in RULES.items() for i, c in enumerate(cuts)])
    strata = counts.groupBy("stratum").agg(F.lit(1).alias("__one"))
    n_strata = max(1, strata.count())
    cells = strata.select("stratum", F.inline(grid))
    joined = (cells.alias("c").join(counts.alias("n"), F.expr("c.stratum <=> n.stratum AND c.rule = n.rule"))
              .groupBy("c.stratum", "c.rule", "place", "cutoff")
              .agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
                   F.sum(F.expr("CASE WHEN level >= from_level THEN good ELSE 0 END")).alias("k_good"),
                   F.sum(F.expr("CASE WHEN level >= from_level THEN bad ELSE 0 END")).alias("k_bad")))
    tested = (joined.withColumn("p_value", binomial_tail(F.col("k_good"), F.col("n_good"), risk / len(RULES)))
              .withColumn("__ok", F.col("p_value") <= delta / len(RULES) / n_strata))
    by_rule = Window.partitionBy("stratum", "rule").orderBy("place")
    passed = tested.withColumn("__all", F.min("__ok").over(by_rule)).where("__all")
    gain = F.expr("(CASE WHEN n_bad > 0 THEN k_bad / n_bad ELSE 0 END) - k_good / n_good")
    best = Window.partitionBy("stratum", "rule").orderBy(gain.desc(), "place")
    return (passed.withColumn("__best", F.row_number().over(best)).where("__best = 1 AND k_bad > 0")
            .select("stratum", "rule", "cutoff", "n_good", "k_good", "n_bad", "k_bad", "p_value"))


def judge(signals: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """``signals`` with ``kept``: not failed by the base rule nor by a certified cutoff.

    One row per stratum is joined, broadcast up to ``MOST_CUTOFFS`` certified
    cutoffs and by a shuffle beyond; strata without a certified rule stay.
    """
    small = cutoffs.limit(MOST_CUTOFFS + 1).count() <= MOST_CUTOFFS
    wide = (cutoffs.groupBy(F.col("stratum").alias("__stratum"))
            .agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cutoff_{r}") for r in RULES]))
    wide = F.broadcast(wide) if small else wide
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(f"signal_{r}") > F.col(f"cutoff_{r}"), F.lit(False))
    return (signals.join(wide, F.col(stratum_col).cast("string").eqNullSafe(F.col("__stratum")), "left")
            .withColumn("kept", ~(F.col("base_failed") | over)).drop("__stratum"))
