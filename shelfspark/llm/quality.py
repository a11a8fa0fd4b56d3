"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base rules fail a text with fewer than 20 words, or with more than 30 % of its words in 8-word
windows that the text repeats. The other texts meet one cutoff per feature and stratum:

* labelled documents are split in two halves by a hash of the id: one half proposes cutoffs
  (a cutoff is useful if it rejects ``PRECISION`` bad documents for each good one), the other
  half is the holdout that certifies them;
* the false rejections of a cutoff among the holdout's good documents are binomial. The exact
  lower tail ``P(Bin(n, alpha) <= k)`` is the p-value of "it rejects more than ``alpha`` of the
  good documents". The useful cutoffs of one feature, from the loosest on, are tested in a fixed
  sequence that stops at the first failure;
* what is useful is known before the holdout is looked at, so the budget is spent on that alone:
  ``alpha`` is the stratum's ``limit`` (5 %) divided by its useful features, the level is ``delta``
  divided by the number of (stratum, useful feature) sequences. With probability ``1 - delta`` the
  cutoffs of every stratum together reject at most ``limit`` of its good documents;
* the tightest certified and useful cutoff is used. Where the holdout is too small to certify
  any, nothing is rejected.

Defined cases: null text has no words and fails the base rules, like an empty one; a null
stratum is a stratum of its own; null labels are ignored, and of repeated labels of an id the
largest counts; without labels only the base rules act; repeated rows and rows with a null id
are judged like any other; only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.llm.common import read, stored

SPACES = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
WINDOW = 8
FEWEST_WORDS, MOST_REPEATED = 20, 30  # words; per cent of the words
LIMIT, DELTA = 0.05, 0.05  # false rejections per stratum; error probability of all cutoffs together
PRECISION = 10  # a cutoff is useful if the proposing half has so many bad rows for each good one behind it
# Share of a text's words or characters from which a feature rejects, loosest cutoff first.
CUTOFFS = {
    "symbol_share": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05],
    "upper_share": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "bang_share": [0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05],
    "repeat_share": [0.29, 0.27, 0.25, 0.22, 0.2, 0.15, 0.1],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside ``width``-word windows that occur twice or more, first ones included."""
    def windows(hashes: Column) -> Column:
        last = F.size(hashes) - width
        return F.when(last > 0, F.transform(
            F.sequence(F.lit(1), last + 1),
            lambda i: F.xxhash64(*[F.get(hashes, i + (k - 1)) for k in range(width)])))

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(ordered, lambda a: F.array_sort(F.transform(
            F.filter(F.transform(a, lambda x, i: F.struct(
                x["i"].alias("i"),
                (x["h"].eqNullSafe(F.get(a, i - 1)["h"]) | x["h"].eqNullSafe(F.get(a, i + 1)["h"])).alias("twice"))),
                lambda x: x["twice"]),
            lambda x: x["i"])))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
        return F.aggregate(
            again, start,
            lambda acc, i: F.struct((acc["n"] + (i + width - F.greatest(acc["upto"], i))).cast("long").alias("n"),
                                    (i + width).alias("upto")),
            lambda acc: acc["n"])

    none = F.lit(0).cast("long")
    found = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.coalesce(let(found, lambda a: F.when(
        F.size(F.array_distinct(a)) < F.size(a), covered(a)).otherwise(none)), none)


def features(docs: DataFrame, id_col: str, text_col: str, stratum_col: str | None) -> DataFrame:
    """Counts of every whole text; one row per input row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(A_WORD))

    def counted(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w).alias("n_repeat_words"))

    def repeated_lines(a: Column) -> Column:
        return F.struct(F.size(a).cast("long").alias("n_lines"),
                        (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"))

    def removed(pattern: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")

    return docs.select(
        F.col(id_col), stratum.alias("stratum"), let(words_of(text), counted).alias("w"),
        let(lines, repeated_lines).alias("l"), removed("[#*$%&|<>]").alias("n_symbols"),
        removed(r"\p{Lu}").alias("n_upper"), removed("!").alias("n_bang"),
    ).select(id_col, "stratum", "w.*", "l.*", "n_symbols", "n_upper", "n_bang")


def shares() -> dict[str, Column]:
    chars = F.greatest("word_chars", F.lit(1))
    return {"symbol_share": F.col("n_symbols") / chars, "upper_share": F.col("n_upper") / chars,
            "bang_share": F.col("n_bang") / chars,
            "repeat_share": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
            "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))}


def base_failed() -> Column:
    return ((F.col("n_words") < FEWEST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def binomial_tail(n: Column, k: Column, p: float | Column) -> Column:
    """Exact ``P(Bin(n, p) <= k)``, summed in logarithms; 1 where ``k`` exceeds the mean."""
    p = p if isinstance(p, Column) else F.lit(p)
    odds = F.log(p / (1 - p))
    zero = n * F.log1p(-p)

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j) + odds
        return F.struct(term.alias("term"), (
            F.greatest(acc["total"], term) + F.log1p(F.exp(-F.abs(acc["total"] - term)))).alias("total"))

    js = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    total = F.aggregate(js, F.struct(zero.alias("term"), zero.alias("total")), add, lambda acc: F.exp(acc["total"]))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.least(total, F.lit(1.0)))


def certified(rows: DataFrame, labels: DataFrame, id_col: str, label_col: str,
              limit: float, delta: float) -> DataFrame:
    """Certified cutoffs: stratum, feature, cutoff (at most one row per stratum and feature), with the
    rows and false rejections of the holdout they were certified on."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(id_col).agg(F.max(label_col).alias("good")))
    grid = F.array(*[F.struct(F.lit(name).alias("feature"), F.lit(float(c)).alias("cutoff"),
                              (value >= c).cast("long").alias("hit"))
                     for name, value in shares().items() for c in CUTOFFS[name]])
    holdout = F.substring(F.md5(F.col(id_col).cast("string")), 1, 1) < "8"
    good, held = F.col("good") > 0, F.col("held")
    one = lambda when: F.sum(F.when(when, F.col("x.hit")).otherwise(0))
    tested = (rows.filter(~base_failed()).join(known, id_col)
              .select("stratum", "good", holdout.alias("held"), F.explode(grid).alias("x"))
              .groupBy("stratum", F.col("x.feature").alias("feature"), F.col("x.cutoff").alias("cutoff"))
              .agg(F.sum((held & good).cast("long")).alias("n"), one(held & good).alias("k"),
                   one(~held & good).alias("good_hits"), one(~held & ~good).alias("bad_hits")))
    useful = stored(tested.filter((F.col("bad_hits") > 0) & (F.col("bad_hits") >= PRECISION * F.col("good_hits"))), "quality-useful")
    # The budget is spent on what the proposing half found useful: a stratum's limit is divided among
    # its useful features, the error probability among all useful features of all strata.
    sequences = useful.select("stratum", "feature").distinct()
    features_of = sequences.groupBy("stratum").agg(F.count("*").alias("n_features"))
    level = F.lit(delta) / F.greatest(sequences.select(F.count("*")).scalar(), F.lit(1))
    looser = W.partitionBy("stratum", "feature").orderBy(F.desc("cutoff")).rowsBetween(W.unboundedPreceding, 0)
    return (useful.join(features_of, "stratum")
            .withColumn("p", binomial_tail(F.col("n"), F.col("k"), F.lit(limit) / F.col("n_features")))
            .withColumn("worst", F.max("p").over(looser)).filter(F.col("worst") <= level)
            .groupBy("stratum", "feature").agg(
                F.min("cutoff").alias("cutoff"),
                F.min(F.struct("cutoff", F.col("n").alias("holdout_good"), F.col("k").alias("holdout_rejected"),
                               F.col("bad_hits").alias("proposed_bad"))).alias("on")))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str | None = "lang", label_col: str = "quality",
          limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """Per input row: id, the counts, base_failed, the failed features and kept."""
    rows = stored(features(docs, id_col, text_col, stratum_col), "quality")
    # One row per stratum; stored so that Spark's own size threshold decides how it is joined.
    cuts = stored(certified(rows, labels, id_col, label_col, limit, delta)
                  .groupBy("stratum").pivot("feature", list(CUTOFFS)).agg(F.min("cutoff")), "quality-cuts")
    failed = F.array_compact(F.array(*[F.when(value >= cuts[name], F.lit(name)) for name, value in shares().items()]))
    return (rows.join(cuts, rows["stratum"] == cuts["stratum"], "left")
            .select(rows[id_col], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"), failed.alias("failed"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
