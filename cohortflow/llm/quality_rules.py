"""Quality rules whose cutoffs carry a statistical guarantee.

A rule rejects a document when its measure exceeds a cutoff. On documents labelled good, a cutoff's false
rejections are binomial; it may be used when the exact binomial upper bound of their rate is below the rule's
limit. Every (stratum, rule, cutoff) is one test at confidence 1 - delta / number of tests, so that with
probability 1 - delta no chosen cutoff breaks its limit in any stratum. Each rule takes its lowest cutoff
that may be used, or rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.columns import BLANK, let, words
from cohortflow.llm.scratch import written

WINDOW = 8
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Measure and cutoffs of each rule, fixed before any label is seen.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols_per_word": ("n_symbols / n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 1.0)),
    "exclaims_per_word": ("n_exclaims / n_words", (0.1, 0.2, 0.5, 1.0)),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeat_share": ("n_repeat_words / n_words", (0.05, 0.1, 0.15, 0.2, 0.25)),
    "mean_word_chars": ("word_chars / n_words", (9.0, 10.0, 12.0, 15.0)),
}


def repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, given the window hashes in order."""
    pair = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

    def starts(sorted_pairs: Column) -> Column:
        def start(s: Column, k: Column) -> Column:
            before, after = F.get(sorted_pairs, k - 1), F.get(sorted_pairs, k + 1)
            twice = (before["x"] == s["x"]) | (after["x"] == s["x"])
            return F.when(twice, s["i"])

        return F.array_sort(F.filter(F.transform(sorted_pairs, start), lambda i: i.isNotNull()))

    def add(state: Column, i: Column) -> Column:
        fresh = i + WINDOW - F.greatest(i, state["end"])
        return F.struct((state["total"] + fresh).alias("total"), (i + WINDOW).alias("end"))

    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    covered = F.aggregate(let(pair, starts), zero, add, lambda s: s["total"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0).cast("bigint")


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every whole text: those of BASE, n_lines, n_exclaims and base_failed, with doc_id and stratum."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANK}]"))

    def count(of: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, of, ""))).cast("bigint")

    df = docs.select(
        "doc_id", "stratum",
        words(F.col("text")).alias("words"), lines.alias("lines"),
        count(r"[#*$%&|<>]").alias("n_symbols"), count("!").alias("n_exclaims"),
    )
    df = df.select(
        "doc_id", "stratum", "n_symbols", "n_exclaims",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    rest = ", ".join(f"hashes[i + {k}]" for k in range(1, WINDOW))
    full = f"slice(hashes, 1, greatest(size(hashes) - {WINDOW - 1}, 0))"
    df = df.withColumn("hashes", F.expr(f"transform({full}, (x, i) -> xxhash64(x, {rest}))"))
    df = df.withColumn("n_repeat_words", repeated_words(F.col("hashes"))).drop("hashes")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def log_factorial(n: Column) -> Column:
    """Logarithm of n!, by Stirling's series from ten places on."""
    x = n.cast("double") + 10
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3.0))) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    down = F.log(n.cast("double") + 1)
    for step in range(2, 11):
        down = down + F.log(n.cast("double") + step)
    return (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series - down


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """Logarithm of P(X <= k) for X of binomial(n, p) and k of at most n * p.

    The term of k is the largest; those below it are summed as shares of it. After j steps down, a share is at most
    exp(-j^2 / 2np), so that ten times the root of np steps leave nothing a double can hold, whatever k.
    """
    odds = math.log(p) - math.log1p(-p)
    top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.lit(odds) + n * F.lit(math.log1p(-p))
    most = F.ceil(10 * F.sqrt(n * F.lit(p))) + 50
    steps = F.sequence(F.lit(0).cast("bigint"), F.least(k, most.cast("bigint")))

    def add(state: Column, j: Column) -> Column:
        share = F.when(j == 0, F.lit(1.0)).otherwise(state["share"] * (k - j + 1) / (n - k + j) * F.lit(math.exp(-odds)))
        return F.struct(share.alias("share"), (state["sum"] + share).alias("sum"))

    start = F.struct(F.lit(1.0).alias("share"), F.lit(0.0).alias("sum"))
    return top + F.log(F.aggregate(steps, start, add, lambda s: s["sum"]))


def select_cutoffs(good: DataFrame, alpha: float, delta: float) -> DataFrame:
    """Per stratum and rule the lowest cutoff that may be used: stratum, then a column per rule (null: none).

    `good` has the measures of documents labelled good. A rule's limit is alpha divided by the number of rules.
    """
    limit = alpha / len(RULES)
    tries = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cut"), (F.expr(measure) > cut).alias("hit"))
            for rule, (measure, cuts) in RULES.items()
            for cut in cuts
        ]
    )
    tested = (
        good.select("stratum", F.explode(tries).alias("t"))
        .groupBy("stratum", "t.rule", "t.cut")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("t.hit").alias("k"))
    )
    tests = sum(len(cuts) for _, cuts in RULES.values())
    # A null stratum is tested like any other, beside an empty one.
    null = F.coalesce(F.max(F.col("stratum").isNull().cast("int")), F.lit(0))
    strata = good.select((F.count_distinct("stratum") + null).alias("strata")).first().strata
    confident = F.lit(math.log(delta / max(1, tests * strata)))
    # Beyond the mean the lower tail is over a half, so only cutoffs below it need the sum.
    able = F.when(F.col("k") < F.col("n") * limit, log_binomial_cdf(F.col("k"), F.col("n"), limit) <= confident)
    usable = tested.where(able)
    picks = [F.min(F.when(F.col("rule") == rule, F.col("cut"))).alias(f"cut_{rule}") for rule in RULES]
    return usable.groupBy("stratum").agg(*picks)


def apply_quality_rules(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.05
) -> DataFrame:
    """One row per row of `docs` (doc_id, text and the stratum's column): doc_id, the counts of BASE, base_failed, kept.

    base_failed: under 20 words, or over 30 % of them inside 8-word windows that occur twice or more. kept: not
    base_failed, and no rule of the document's stratum rejects. Cutoffs are chosen on documents that `labels`
    (doc_id, quality) calls good (1) and that did not fail the base; with probability 1 - delta, no stratum
    loses more than a share alpha of its good documents to them. A document labelled both ways counts as good;
    labels without id or quality say nothing. Null and empty texts have no words and fail the base. A null
    stratum is a stratum of its own. Every labelled document is one draw, copies of a text too. A stratum with too few labels rejects nothing. Other columns are ignored.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(stratum).cast("string").alias("stratum"),
    )
    known = written(measured(docs), "measures")
    named_good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    good = known.where("not base_failed").join(named_good, "doc_id", "left_semi")
    cutoffs = written(select_cutoffs(good, alpha, delta).withColumnRenamed("stratum", "of"), "cutoffs")
    rejects = F.lit(False)
    for rule, (measure, _) in RULES.items():
        over = F.when(~F.col("base_failed"), F.expr(measure) > F.col(f"cut_{rule}"))
        rejects = rejects | F.coalesce(over, F.lit(False))
    judged = known.join(cutoffs, F.col("stratum").eqNullSafe(F.col("of")), "left")
    return judged.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & ~rejects).alias("kept"))
