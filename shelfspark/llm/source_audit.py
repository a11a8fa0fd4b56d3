"""Divergence between the sources of a language, by frequent-pattern trees of term rows.

A term's row lists the sources of its language that hold it, in order, with its counts there. The
smoothed divergence of a pair of sources is a sum over all kept terms, but only a few kinds of
addends differ: with both counts zero they are all equal; with one count zero they depend on that
count; what is left is a correction for terms that both sources hold. So

    sum = V f(0, 0) + sum over a's counts (f(c, 0) - f(0, 0)) + sum over b's counts (f(0, c) - f(0, 0))
          + sum over terms in both (f(c, d) - f(c, 0) - f(0, d) + f(0, 0)).

The first three sums need a histogram of counts per source. For the last, equal rows are merged
with their multiplicity and inserted into frequent-pattern trees, an item being a source with a
count: rows that begin alike share nodes, and every node adds its multiplicity once for each of its
ancestors, which gives the number of terms for each pair of items. Sorted rows are dealt out in
ranges; a tree is emptied when it has ``NODES`` nodes, since the numbers of parts of a tree add up.
All arithmetic is on integers (decimal where a product can leave 64 bits).

Defined cases: null text, lang and source are empty strings; a group is listed even if its
documents hold no term; a language without a kept term has V = 0, pair values 0 and no terms; a
language with one source has no pairs; repeated rows count as documents of their own; very long
texts are counted whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import read, ship, stored

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
HELD = 200_000  # counted terms held by a task before they are sent on
NODES = 50_000  # nodes of a tree before it is emptied


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term of a group in the rows of a task; '' stands for the group itself."""
    n: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def counted() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in n.items():
            seen = docs[lang, source]
            rows = len(terms) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * rows, pa.string()), pa.array([source] * rows, pa.string()),
                 pa.array([b"", *terms], pa.binary()).cast(pa.string()),
                 pa.array([0, *terms.values()], pa.int64()), pa.array([0, *(seen[t] for t in terms)], pa.int64())],
                ["lang", "source", "term", "n", "docs"])
        n.clear()
        docs.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            found = TERM.findall((text.as_py() or "").encode().lower())
            group = lang.as_py() or "", source.as_py() or ""
            n[group].update(found)
            docs[group].update(set(found))
        if sum(map(len, n.values())) > HELD:
            yield from counted()
    yield from counted()


def term_rows(documents: DataFrame) -> DataFrame:
    """Kept terms: lang, term, total and ``row``, the ordered (source, n) of the sources that hold it.

    The row of term '' lists all sources of its language.
    """
    ship(documents.sparkSession)
    counts = documents.select("lang", "source", "text").mapInArrow(
        _count, "lang string, source string, term string, n long, docs long")
    return (counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                         F.sort_array(F.collect_list(F.struct("source", "n"))).alias("row"))
            .filter((F.col("docs") >= LEAST_DOCUMENTS) | (F.col("term") == "")).drop("docs"))


def groups(rows: DataFrame) -> DataFrame:
    """Every (lang, source): n, the occurrences of kept terms there; v, the kept terms of its language; lang_n."""
    kept = rows.filter("term <> ''")
    n = kept.select("lang", F.inline("row")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    v = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    every = rows.filter("term = ''").select("lang", F.explode("row.source").alias("source"))
    return every.join(n, ["lang", "source"], "left").join(v, "lang", "left").na.fill(0, ["n", "v", "lang_n"])


# --- trees of term rows --------------------------------------------------------------------
class Tree:
    """Frequent-pattern tree: insert ordered items with a multiplicity; numbers of item pairs."""

    def __init__(self):
        self.child: dict[tuple, int] = {}
        self.item: list[tuple] = []
        self.parent: list[int] = []
        self.times: list[int] = []

    def insert(self, lang: str, items: list[tuple], times: int) -> None:
        node = -1
        for item in items:
            key = (lang, node, item)
            at = self.child.get(key)
            if at is None:
                at = self.child[key] = len(self.item)
                self.item.append((lang, *item))
                self.parent.append(node)
                self.times.append(0)
            self.times[at] += times
            node = at

    def pairs(self) -> Iterator[pa.RecordBatch]:
        """(lang, a, a_n, b, b_n, terms) of every node b and each of its ancestors a, one step up at a time."""
        if not self.item:
            return
        lang, source, n = ([i[k] for i in self.item] for k in range(3))
        lang, source, n = pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(n, pa.int64())
        parent, times = np.array(self.parent), np.array(self.times)
        node, above = np.arange(len(parent)), parent
        while len(node := node[above >= 0]):
            above = above[above >= 0]
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(node)), source.take(pa.array(above)), n.take(pa.array(above)),
                                              source.take(pa.array(node)), n.take(pa.array(node)), pa.array(times[node], pa.int64())],
                                             ["lang", "a", "a_n", "b", "b_n", "terms"])
            above = parent[above]


def _tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = Tree()
    for batch in batches:
        for lang, source, n, times in zip(*(batch.column(i).to_pylist() for i in range(4))):
            tree.insert(lang, list(zip(source, n)), times)
            if len(tree.item) >= NODES:
                yield from tree.pairs()
                tree = Tree()
    yield from tree.pairs()


def item_pairs(rows: DataFrame) -> DataFrame:
    """Number of kept terms that source a holds a_n times and source b, behind it in order, b_n times."""
    paths = (rows.filter((F.col("term") != "") & (F.size("row") > 1)).groupBy("lang", "row").agg(F.count("*").alias("times"))
             .repartitionByRange("lang", "row").sortWithinPartitions("lang", "row")
             .select("lang", F.col("row.source"), F.col("row.n"), "times"))
    return (paths.mapInArrow(_tree_pairs, "lang string, a string, a_n long, b string, b_n long, terms long")
            .groupBy("lang", "a", "a_n", "b", "b_n").agg(F.sum("terms").alias("terms")))


# --- divergences -----------------------------------------------------------------------------
def _p(count: Column, n: str, v: str = "v") -> Column:
    """1 + floor(SCALE (count + 1) / (n + v))."""
    scaled = F.lit(SCALE).cast("decimal(38,0)") * (count + F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", scaled, (F.col(n) + F.col(v)).cast("decimal(20,0)")) + F.lit(1)


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q).cast("decimal(38,0)")


def _ranked(values: DataFrame, part: str) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return values.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value")).withColumn(
        "rank", F.row_number().over(by))


def pair_divergences(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Divergence of every source from every other source of its language."""
    zero = F.lit(0)
    left = sizes.select("lang", F.col("source").alias("a"), F.col("n").alias("na"), "v")
    right = sizes.select("lang", F.col("source").alias("b"), F.col("n").alias("nb"))
    f00, f0 = _f(_p(zero, "na"), _p(zero, "nb")), lambda p, q: _f(p, q) - _f(_p(zero, "na"), _p(zero, "nb"))
    pairs = left.join(right, "lang").filter("a <> b")
    none = pairs.select("lang", "a", "b", F.when(F.col("v") > 0, f00 * F.col("v")).otherwise(F.lit(0)).alias("value"))
    histogram = (rows.filter("term <> ''").select("lang", F.inline("row")).groupBy("lang", "source", "n").agg(F.count("*").alias("terms")))
    counted = histogram.join(sizes.withColumnRenamed("n", "na"), ["lang", "source"]).select(
        "lang", F.col("source").alias("a"), "na", "v", F.col("n").alias("c"), "terms")
    each = counted.join(right, "lang").filter("a <> b")
    # In one source only: the count is on the side of the one or of the other.
    one = each.select("lang", "a", "b", (f0(_p(F.col("c"), "na"), _p(zero, "nb")) * F.col("terms")).alias("value"))
    other = (each.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("nb").alias("na"), F.col("na").alias("nb"), "v", "c", "terms")
             .select("lang", "a", "b", (f0(_p(zero, "na"), _p(F.col("c"), "nb")) * F.col("terms")).alias("value")))
    held = (item_pairs(rows).join(left, ["lang", "a"]).join(right, ["lang", "b"])
            .select("lang", "v", "terms", F.explode(F.array(
                F.struct("a", F.col("a_n").alias("c"), "na", "b", F.col("b_n").alias("d"), "nb"),
                F.struct(F.col("b").alias("a"), F.col("b_n").alias("c"), F.col("nb").alias("na"),
                         F.col("a").alias("b"), F.col("a_n").alias("d"), F.col("na").alias("nb")))).alias("x"))
            .select("lang", "v", "terms", "x.*"))
    pc, pd, a0, b0 = _p(F.col("c"), "na"), _p(F.col("d"), "nb"), _p(zero, "na"), _p(zero, "nb")
    both = held.select("lang", "a", "b", ((_f(pc, pd) - _f(pc, b0) - _f(a0, pd) + _f(a0, b0)) * F.col("terms")).alias("value"))
    total = none.unionByName(one).unionByName(other).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return _ranked(total.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"), "pair")


def term_divergences(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Terms that a source holds more often than its language does, the first ``TOP_TERMS`` of each source."""
    held = rows.filter("term <> ''").select("lang", F.col("term").alias("item"), "total", F.inline("row")).withColumnRenamed("n", "c")
    p, q = _p(F.col("c"), "n"), _p(F.col("total"), "lang_n")
    values = held.join(sizes, ["lang", "source"]).withColumn("p", p).withColumn("q", q).filter("p > q").withColumn(
        "value", _f(F.col("p"), F.col("q")))
    return _ranked(values, "term").filter(F.col("rank") <= TOP_TERMS)


def audit(documents: DataFrame) -> DataFrame:
    """Both parts: lang, source, part, item, value, rank."""
    rows = stored(term_rows(documents), "term-rows")
    sizes = stored(groups(rows), "term-groups")
    return pair_divergences(rows, sizes).unionByName(term_divergences(rows, sizes))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))
