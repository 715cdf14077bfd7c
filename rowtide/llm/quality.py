"""Quality rules whose cutoffs limit the false rejection of good documents, stratum by stratum.

Each rule is a measure of a text, higher being worse, with a grid of candidate cutoffs;
a document above the cutoff is rejected. The holdout is the labelled documents. For every
stratum, rule and cutoff the good documents wrongly rejected, ``k`` of ``n``, are counted;
a cutoff is certified if the exact (Clopper-Pearson) binomial bound on its false-rejection
rate stays at ``limit`` or below, that is if P(Binomial(n, limit) <= k) <= delta / m. The
division by the number ``m`` of all cells (Bonferroni) makes all certified cutoffs hold at
once with probability ``1 - delta``, so choosing among them costs nothing: taken is the
one that rejects most bad documents, less the good ones; ties go to the higher cutoff. A
stratum with too few labels to certify anything gets no cutoff and loses nothing.

Measures are worked out once, in one pass without a shuffle, and settled (about 100 bytes
a document); counts are one aggregate per stratum, combined on the map side.

Defined cases: a null text has no words; words of no count make every measure 0; a null
stratum is a stratum of its own; a null label or a label without its document is no
evidence; a document labelled more than once counts once, as bad if any label says so;
repeated rows each get their verdict; an empty table gives an empty table. Equal windows
inside a text are told by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import let, settle, text_of, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
#: Candidate cutoffs of every rule: shares of a text.
GRID = (0.005, 0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)
#: At most this share of good documents may fall to one rule, in each stratum ...
LIMIT = 0.02
#: ... but for this probability that any cell breaks it.
DELTA = 0.05

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(starts: Column) -> Column:
    """How many words lie in the windows that start at these ascending places."""
    state = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("at"), (s["n"] + F.least(F.lit(WINDOW), i - s["at"])).alias("n")),
    )
    return state["n"]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with its counts, as struct column ``__m``; the text stays as it is."""
    own = text_of(text)
    staged = docs.withColumn("__w", words(own))
    # Hashes of 2, 4 and then 8 words in a row, each from two of the hashes before.
    pairs = lambda p, gap: let(
        p,
        lambda x: F.zip_with(
            x, F.slice(x, gap + 1, F.greatest(F.lit(0), F.size(x) - gap)), lambda a, b: F.xxhash64(a, b)
        ),
    )
    windows = pairs(pairs(pairs(F.col("__w"), 1), 2), 4)
    staged = staged.withColumn(
        "__win", let(windows, lambda x: F.slice(x, 1, F.greatest(F.lit(0), F.size(x) - (WINDOW - 1))))
    )
    any_twice = F.size(F.array_distinct("__win")) < F.size("__win")
    placed = F.sort_array(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    staged = staged.withColumn("__placed", F.when(any_twice, placed))
    same = lambda x, p, j: x["h"].eqNullSafe(F.get(p, j)["h"])
    twice = let(
        F.col("__placed"),
        lambda p: F.transform(p, lambda x, j: F.when(same(x, p, j + 1) | same(x, p, j - 1), x["i"])),
    )
    staged = staged.withColumn("__twice", F.sort_array(F.array_compact(twice)))
    staged = staged.withColumn("__lines", F.filter(F.split(own, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return staged.withColumn(
        "__m",
        F.struct(
            F.size("__w").cast("long").alias("n_words"),
            F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
            (F.char_length(own) - F.char_length(F.regexp_replace(own, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            F.coalesce(_covered(F.col("__twice")), F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size("__lines").cast("long").alias("n_lines"),
            (F.char_length(own) - F.char_length(F.regexp_replace(own, "[A-Z]", ""))).cast("long").alias("n_upper"),
        ),
    ).drop("__w", "__h", "__win", "__placed", "__twice", "__lines")


def rules(m: Column) -> dict[str, Column]:
    """The measures that cutoffs are chosen for."""
    share = lambda a, b: F.when(m[b] > 0, m[a] / m[b]).otherwise(F.lit(0.0))
    return {
        "symbols": share("n_symbols", "word_chars"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "capitals": share("n_upper", "word_chars"),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (F.lit(100) * m["n_repeat_words"] > F.lit(30) * m["n_words"])


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1: Stirling's series at x + 8, taken back by the recurrence."""
    z = x + 8.0
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    back = sum((F.ln(x + float(i)) for i in range(1, 8)), F.ln(x))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + series - back


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for k <= n p, else 1: the terms from k downward, to double precision."""
    k, n = k.cast("double"), n.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    steps = F.least(k, F.ceil(60 * F.sqrt(n)) + 200).cast("int")
    one = F.lit(1.0)
    tail = F.aggregate(
        F.sequence(F.lit(0), F.greatest(steps, F.lit(1)) - 1),
        F.struct(one.alias("t"), one.alias("s")),
        lambda a, j: F.struct(
            (a["t"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("t"),
            (a["s"] + a["t"] * (k - j) * (1 - p) / ((n - k + j + 1) * p)).alias("s"),
        ),
    )
    return F.when(k > n * p, 1.0).otherwise(F.exp(top) * F.when(steps > 0, tail["s"]).otherwise(1.0))


def choose_cutoffs(
    labelled: DataFrame,
    stratum: str,
    measure: dict[str, Column],
    good: Column,
    grid: tuple[float, ...] = GRID,
    limit: float = LIMIT,
    delta: float = DELTA,
) -> DataFrame:
    """(stratum, rule, cutoff): the certified cutoff of most use, where there is one."""
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    cells = [(r, c) for r in measure for c in grid]
    sums = labelled.groupBy(F.col(stratum).alias("stratum")).agg(
        count(good).alias("n"),
        *[count(good & (measure[r] > c)).alias(f"k{i}") for i, (r, c) in enumerate(cells)],
        *[count(~good & (measure[r] > c)).alias(f"b{i}") for i, (r, c) in enumerate(cells)],
    )
    long = settle(
        sums.select(
            "stratum",
            "n",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"k{i}").alias("k"), F.col(f"b{i}").alias("bad"))
                        for i, (r, c) in enumerate(cells)
                    ]
                )
            ).alias("c"),
        ).select("stratum", "n", "c.*")
    )
    m = max(1, long.count())  # rules x cutoffs x strata
    certified = long.filter((F.col("n") > 0) & (F.col("bad") > F.col("k")) & (binomial_cdf(F.col("k"), F.col("n"), limit) <= delta / m))
    return certified.groupBy("stratum", "rule").agg(
        F.max(F.struct((F.col("bad") - F.col("k")).alias("use"), F.col("cutoff")))["cutoff"].alias("cutoff")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    **risk,
) -> DataFrame:
    """doc_id, version (hash of the text), the counts, base_failed and kept of every document."""
    scored = settle(
        measures(docs.select(F.col(doc_id).alias("__id"), F.col(stratum).alias("__stratum"), F.col(text).alias("__text")), "__text")
        .select("__id", "__stratum", F.xxhash64("__text").alias("version"), "__m")
    )
    said = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("quality").alias("__q"))
    )
    holdout = scored.dropDuplicates(["__id"]).join(said, "__id")
    measure = rules(F.col("__m"))
    chosen = choose_cutoffs(holdout, "__stratum", measure, F.col("__q") > 0, **risk)
    by_stratum = chosen.groupBy(F.col("stratum").alias("__s")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__c_{r}") for r in measure]
    )
    joined = scored.join(by_stratum, F.col("__stratum").eqNullSafe(F.col("__s")), "left")
    failed = base_failed(F.col("__m"))
    kept = ~failed
    for r, v in measure.items():
        kept = kept & ~F.coalesce(v > F.col(f"__c_{r}"), F.lit(False))
    return joined.select(
        F.col("__id").alias(doc_id), "version", *[F.col(f"__m.{c}") for c in COUNTS], failed.alias("base_failed"), kept.alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **rule) -> DataFrame:
    """The rows of ``docs`` whose text is kept."""
    kept = judge(docs, labels, doc_id, text, **rule).filter("kept")
    kept = kept.select(F.col(doc_id).alias("__id"), F.col("version").alias("__version"))
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(f"d.`{text}`")) == F.col("__version"))
    return docs.alias("d").join(kept, same, "left_semi")
