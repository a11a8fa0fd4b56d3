"""MinHash near-duplicates: universal hash minima, banding, verification, components.

1. One pass over the texts makes the set of word-shingle hashes of every document, its digest
   and the minima of 128 universal hash functions ``(a x + b) mod 2^32``, in 32 bands of 4.
   Two sets of similarity 0.85 miss every band with probability 6e-11, of 0.8 with 5e-8.
2. Equal digests are exact copies of a set: one class, represented by its smallest id.
3. Classes that share a bucket of a band are candidates. Signature verification: a class must
   share at least two buckets (a linked one shares fewer with probability 2e-9 at 0.85, 1e-6
   at 0.8). Then the full sets of the candidates are made, and shingles that only one candidate
   has are counted: as no partner has them, ``own = n - unique`` bounds every intersection, and
   classes and pairs that cannot reach the threshold are dropped. This keeps heavily changed
   members of a large group from being compared with each other; it loses no link.
4. Each bucket's members are compared on full sets with the bucket's hub (the member with the
   smallest share of unique shingles); linked ones form components. Stars around further hubs
   follow as long as they join components. Of the pairs that are left in different components,
   the exact counts against the common hub bound what they can share: only pairs with a large
   enough part in the hub, or with common shingles outside it, can be linked, and just these
   are found by joins and compared. So no link is lost, and no bucket is expanded into pairs.
5. Components by alternating large-star and small-star.

Defined cases: null and empty texts, and texts of white space only, have no shingles and are
linked with nothing; texts with fewer words than a shingle are one shingle; rows with a null id
are not linked and are kept; repeated rows of one id are one document for linking; ties (equal
sets) are one component and the smallest id is kept; an empty table gives an empty result; only
the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.llm.common import mix64, read, ship, shingles, stored, to_long, word_hashes
from shelfspark.llm.components import components

BANDS, ROWS = 32, 4
LEAST_BANDS = 2
FAIR_SHARE = 100  # stars go on while they find a link per so many open places; the rest is found by other joins
_draw = np.random.default_rng(20240229)
FACTOR = _draw.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFT = _draw.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text."""
    return np.unique(shingles(word_hashes((text or "").encode())[0], width))


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of the universal hash functions over a set, taken in blocks of bounded size."""
    x = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 4096):
        h = FACTOR[:, None] * x[None, i:i + 4096]
        h += SHIFT[:, None]
        np.minimum(least, h.min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix64(key * np.uint64(0x9FB21C651E98DF25) + rows[:, i])
    return key


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), width)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                keys.append(to_long(bands(signature(found))) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "digest", "bands"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "id long, n long, digest binary, bands array<long>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                sets = [to_long(shingle_set(x.as_py(), width)) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "id long, shingles array<long>")


def _reachable(n_a: Column, own_a: Column, n_b: Column, own_b: Column, percent: int) -> Column:
    """Whether two sets can reach the threshold, given how many shingles each can share at all."""
    most = F.least(own_a, own_b)
    return 100 * most >= percent * (n_a + n_b - most)


def _required(n_a: Column, n_b: Column, percent: int) -> Column:
    """Shingles that two sets must share to reach the threshold."""
    return F.ceil(percent * (n_a + n_b) / F.lit(100 + percent) - F.lit(1e-9)).cast("long")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, hub) pairs compared on full sets: sizes, shared shingles, what only ``id`` has."""
    left = sets.select("id", F.col("shingles").alias("s"))
    right = sets.select(F.col("id").alias("hub"), F.col("shingles").alias("t"))
    return (pairs.select("id", "hub").join(left, "id").join(right, "hub")
            .select("id", "hub", F.size("s").cast("long").alias("n"), F.size("t").cast("long").alias("n_hub"),
                    F.array_except("s", "t").alias("extra"))
            .withColumn("both", F.col("n") - F.size("extra")))


def _reaches(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("n") + F.col("n_hub") - F.col("both"))


def links(docs: DataFrame, marked: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """Component (smallest id) of every class representative that has a link: node, component."""
    reps = marked.filter("digest is not null and id is not null").groupBy("digest").agg(F.min("id").alias("id"))
    members = (marked.join(reps, ["digest", "id"], "left_semi").select("id", F.explode("bands").alias("band")).distinct())
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = stored(members.join(shared.select("band"), "band"), "buckets")
    chosen = buckets.groupBy("id").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= LEAST_BANDS).select("id")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(chosen, "id", "left_semi")
    sets = stored(full_sets(texts, "id", "text", width), "sets")
    if sets.agg(F.count(F.lit(1)) - F.count_distinct("id")).first()[0]:
        # Repeated rows of one id are one document: the union of their sets.
        sets = stored(sets.select("id", F.explode("shingles").alias("s")).distinct()
                      .groupBy("id").agg(F.collect_set("s").alias("shingles")), "sets")
    unique = (sets.select("id", F.explode("shingles").alias("s")).groupBy("s")
              .agg(F.count(F.lit(1)).alias("k"), F.min("id").alias("id")).filter("k = 1")
              .groupBy("id").agg(F.count(F.lit(1)).alias("unique")))
    sized = (sets.select("id", F.size("shingles").alias("n")).join(unique, "id", "left")
             .select("id", "n", (F.col("n") - F.coalesce("unique", F.lit(0))).alias("own"))
             .filter(100 * F.col("own") >= percent * F.col("n")))
    places = stored(buckets.join(sized, "id"), "places")

    def star(members: DataFrame, rank: Column) -> DataFrame:
        """(band, id, hub) of the members of each bucket that are in another component than its hub."""
        hubs = members.filter("free").groupBy("band").agg(
            F.min(F.struct(rank.alias("rank"), "id", "n", "own", "c")).alias("h"))
        return (members.join(hubs, "band")
                .filter(F.col("h.c") != F.col("c"))
                .select("band", "id", F.col("h.id").alias("hub"), _reachable(
                    F.col("n"), F.col("own"), F.col("h.n"), F.col("h.own"), percent).alias("can")))

    many = places.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("band")
    first = stored(star(places.join(many, "band").withColumns({"c": F.col("id"), "free": F.lit(True)}),
                        1 - F.col("own") / F.col("n")), "stars")
    pairs = first.select("id", "hub").distinct()
    compared = stored(_compared(pairs, sets), "compared")
    edges = compared.filter(_reaches(percent)).select(F.col("id").alias("u"), F.col("hub").alias("v"))
    label = stored(components(edges), "labels")

    def still_open(placed: DataFrame) -> DataFrame:
        """Members (band, id, n, own, c) of the buckets that hold several components; free: outside the largest."""
        tops = (placed.groupBy("band", "c").agg(F.count(F.lit(1)).alias("size")).groupBy("band")
                .agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("size", "c")).alias("top"))
                .filter("parts > 1").select("band", F.col("top.c").alias("top")))
        return placed.join(tops, "band").select("band", "id", "n", "own", "c", (F.col("c") != F.col("top")).alias("free"))

    def joined(more: DataFrame) -> DataFrame:
        return stored(components(label.select(F.col("node").alias("u"), F.col("component").alias("v"))
                                 .unionByName(more.select(F.col("id").alias("u"), F.col("hub").alias("v")))), "labels")

    # Further stars among what is outside the largest component of a bucket, as long as they link
    # a fair share of it: a family whose members are hardly linked is left to the exact rest. A
    # bucket that is closed stays closed, so only the open ones are carried on.
    placed = stored(places.join(label, places["id"] == label["node"], "left").select(
        "band", "id", "n", "own", F.coalesce("component", "id").alias("c")), "placed")
    open_now, turn = stored(still_open(placed), "open"), 0
    while True:
        turn += 1
        more = star(open_now, F.xxhash64("id", F.lit(turn))).filter("can").select("id", "hub").distinct().join(pairs, ["id", "hub"], "left_anti")
        more = stored(_compared(stored(more, "star-pairs"), sets).filter(_reaches(percent)).select("id", "hub"), "star-links")
        found = more.count()
        if not found:
            break
        label = joined(more)
        carried = open_now.count()
        placed = stored(open_now.join(label, open_now["c"] == label["node"], "left").select(
            "band", "id", "n", "own", F.coalesce("component", "c").alias("c")), "placed")
        open_now = stored(still_open(placed), "open")
        if found * FAIR_SHARE < carried:
            break

    # The rest, without listing the pairs of a bucket. Two members that were compared with the
    # same hub share at most the smaller of their parts in the hub, and what they share outside
    # it: a link needs a large enough part in the hub (A), or common shingles outside it (B).
    own_hub = first.join(open_now.select("band", "id", "c").distinct(), ["band", "id"])
    rest = stored(own_hub.select("id", "hub", "c").distinct().join(compared, ["id", "hub"])
                  .select("id", "hub", "c", "n", "both", "extra"), "rest")
    one = rest.select("hub", F.col("id").alias("a"), F.col("c").alias("c_a"), F.col("n").alias("n_a"), F.col("both").alias("in_a"), "extra")
    two = rest.select("hub", F.col("id").alias("b"), F.col("c").alias("c_b"), F.col("n").alias("n_b"), F.col("both").alias("in_b"), "extra")
    smallest = F.ceil(percent * F.col("n_a") / F.lit(100) - F.lit(1e-9)).cast("long")
    largest = F.floor(F.col("in_a") * F.lit(100 + percent) / percent - F.col("n_a") + F.lit(1e-9)).cast("long")
    need = _required(F.col("n_a"), F.col("n_b"), percent)
    inside = (one.filter(smallest <= largest).drop("extra").withColumn("n_b", F.explode(F.sequence(smallest, largest)))
              .join(two.drop("extra"), ["hub", "n_b"])
              .filter((F.col("c_a") != F.col("c_b")) & (F.least("in_a", "in_b") >= need)).select("a", "b"))
    # A link needs at least ``short`` common shingles outside the hub, so one of them is among
    # all but the ``short - 1`` most frequent ones of either side.
    smallest_n = rest.groupBy("hub").agg(F.min("n").alias("n_min"))
    least_n = F.greatest("n_min", F.ceil(percent * F.col("n") / F.lit(100) - F.lit(1e-9)).cast("long"))
    extras = (rest.join(smallest_n, "hub")
              .withColumn("short", F.greatest(F.lit(1).cast("long"), _required(F.col("n"), least_n, percent) - F.col("both")))
              .withColumn("size", F.size("extra").cast("long")).filter("size >= short")
              .select("hub", "id", "c", "n", "both", "size", "short", F.explode("extra").alias("x")))
    counts = extras.groupBy("hub", "x").agg(F.count(F.lit(1)).alias("k"))
    rarest = W.partitionBy("hub", "id").orderBy("k", "x")  # at most one set's shingles each
    extras = (extras.join(counts, ["hub", "x"]).withColumn("place", F.row_number().over(rarest))
              .filter("k > 1 and place <= size - short + 1").drop("k", "place", "short"))
    extras = stored(extras, "extras")
    one, two = (extras.select("hub", "x", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "c", "n", "both", "size")])
                for side in ("a", "b"))
    short = _required(F.col("n_a"), F.col("n_b"), percent) - F.least("both_a", "both_b")
    outside = (one.join(two, ["hub", "x"])
               .filter((F.col("c_a") != F.col("c_b")) & (F.col("id_a") < F.col("id_b"))
                       & (100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))
                       & (F.least("size_a", "size_b") >= short))
               .select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    rest_pairs = stored(inside.unionByName(outside).select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("hub"))
                        .distinct(), "rest-pairs")
    more = stored(_compared(rest_pairs, sets).filter(_reaches(percent)).select("id", "hub"), "rest-links")
    return label if more.isEmpty() else joined(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80) -> DataFrame:
    """Per input row: id, n_shingles, component_id (smallest linked id) and kept."""
    ship(docs.sparkSession)
    marked = stored(sketches(docs, id_col, text_col, width), "sketches")
    found = links(docs, marked, id_col, text_col, width, percent)
    reps = marked.filter("digest is not null and id is not null").groupBy("digest").agg(F.min("id").alias("rep"))
    classes = stored(reps.join(found, reps["rep"] == found["node"], "left")
                     .select("digest", F.coalesce("component", "rep").alias("component_id")), "classes")
    return (marked.join(classes, "digest", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)
