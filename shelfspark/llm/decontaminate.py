"""Benchmark decontamination: a BM25 index of test items, block-max WAND, overlap checks.

Test items are indexed as postings ``term -> (item, impact)`` in item order, in blocks that
know their largest impact. An impact is the term's BM25 weight in the item divided by the
item's score for its own text, so that a passage scores 1 if it has all of an item's terms and
one threshold serves all items. Every document is cut into overlapping passages, long enough
that a copy of any item lies whole in one of them, and each passage queries the index for all
items at or above the threshold. Before that, a document is passed over if the terms it has
cannot lift any item to the threshold (an upper bound, so nothing is lost). Retrieved pairs are
verified: the word n-grams of the item's question and of its answer must both be in the passage.
The n-grams of a short part are shorter, so that one changed word leaves it half of them, and are
sought in one stretch of the passage, twice as long as the part. An answer of one word has nothing
left when it changes: it is judged together with the question.

The index is broadcast in shards of at most ``SHARD`` items; more items mean more passes.

Defined cases: null and empty texts and items match nothing; an item without words is skipped;
an empty benchmark or document table gives an empty result; repeated items or documents give
one row per distinct (document, item), different texts of one item id are all searched; rows with a null id are ignored; long texts are searched
whole; only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.common import read, ship, stored

K1, B = 1.2, 0.75  # BM25
THRESHOLD = 0.6  # share of an item's own score
OVERLAP, NGRAM = 0.5, 5  # n-grams of the question and of the answer that a passage must have
BLOCK = 64  # postings in a block
SLACK = 0.3  # share of an item's score that its commonest terms may have to be left out of the bound
SHARD = 20_000  # items in one broadcast index
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32
               for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return (text or "").encode().translate(_TABLE).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The answer is the last sentence; an item of one sentence is cut after two thirds."""
    parts = [w for w in (terms(s) for s in re.split(r"[.!?\n]+", text)) if w]
    if len(parts) > 1:
        return [t for p in parts[:-1] for t in p], parts[-1]
    words = parts[0]
    cut = max(1, (2 * len(words) + 2) // 3)
    return words[:cut], words[cut:] or words[-1:]


def _grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def gram_size(size: int) -> int:
    """Words of an n-gram, at most NGRAM, of which a changed word leaves half of the part's."""
    return max(1, min(NGRAM, (size + 1) // 3))


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of the part's n-grams that the passage has; for short n-grams, a stretch of the passage."""
    n, longest = gram_size(len(part)), min(NGRAM, len(part))
    own = _grams(part, longest)
    share = len(own & _grams(passage, longest)) / len(own)
    if n == longest or share >= OVERLAP:
        return share
    own = _grams(part, n)
    # Grams in a sliding stretch of 2 * len(part) words, counted as they enter and leave.
    width, inside, most = 2 * len(part) - n + 1, {}, 0
    grams = [tuple(passage[i:i + n]) for i in range(len(passage) - n + 1)]
    for i, g in enumerate(grams):
        if g in own:
            inside[g] = inside.get(g, 0) + 1
            most = max(most, len(inside))
        if i + 1 >= width and (old := grams[i + 1 - width]) in inside:
            inside[old] -= 1
            if not inside[old]:
                del inside[old]
    return max(share, most / len(own))


class Index:
    """Inverted index of items with block maxima. ``items``: (id, text); ``df``: items per term."""

    def __init__(self, items: list[tuple[int, str]], df: dict[bytes, int], n_items: int, mean_size: float):
        self.ids, self.parts = [], []
        found: dict[bytes, list[tuple[int, float]]] = {}
        self.least_rest: list[float] = []  # what an item needs from its essential terms
        essential: dict[bytes, list[tuple[int, float]]] = {}
        self.longest = 1
        for item_id, text in items:
            words = terms(text)
            if not words:
                continue
            at = len(self.ids)
            self.ids.append(item_id)
            self.parts.append(question_and_answer(text))
            self.longest = max(self.longest, len(words))
            counts: dict[bytes, int] = {}
            for w in words:
                counts[w] = counts.get(w, 0) + 1
            norm = K1 * (1 - B + B * len(words) / mean_size)
            weight = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * c * (K1 + 1) / (c + norm)
                      for w, c in counts.items()}
            total = sum(weight.values())
            common = 0.0
            for w in sorted(weight, key=lambda t: (weight[t], t)):
                share = weight[w] / total
                found.setdefault(w, []).append((at, share))
                if common + share <= SLACK:
                    common += share
                else:
                    essential.setdefault(w, []).append((at, share))
            self.least_rest.append(THRESHOLD - common)
        self.postings = {w: ([i for i, _ in p], [x for _, x in p],
                             [(p[min(k + BLOCK, len(p)) - 1][0], max(x for _, x in p[k:k + BLOCK]))
                              for k in range(0, len(p), BLOCK)]) for w, p in found.items()}
        self.largest = {w: max(x for x in p[1]) for w, p in self.postings.items()}
        self.essential = essential
        self.essential_terms = frozenset(essential)

    def may_match(self, words: list[bytes]) -> bool:
        """Whether the terms of a text could lift any item to the threshold."""
        have = self.essential_terms.intersection(words)
        if not have:
            return False
        total: dict[int, float] = {}
        for w in have:
            for item, share in self.essential[w]:
                total[item] = total.get(item, 0.0) + share
        return any(x >= self.least_rest[item] - 1e-9 for item, x in total.items())

    def search(self, words: list[bytes], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All (item, score) at or above the threshold, by block-max WAND."""
        # One cursor per term: [current item, position, items, impacts, blocks, block, largest]
        cursors = []
        for w in set(words):
            p = self.postings.get(w)
            if p is not None:
                cursors.append([p[0][0], 0, p[0], p[1], p[2], 0, self.largest[w]])
        out, bar, end = [], threshold - 1e-9, len(self.ids)

        def move(c, target: int) -> None:
            blocks, b = c[4], c[5]
            while b < len(blocks) and blocks[b][0] < target:
                b += 1
            c[5] = b
            k = max(c[1], b * BLOCK)
            items = c[2]
            while k < len(items) and items[k] < target:
                k += 1
            c[1] = k
            c[0] = items[k] if k < len(items) else end

        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                if c[0] == end:
                    break
                bound += c[6]
                if bound >= bar:
                    pivot = k
                    break
            if pivot < 0:
                return out
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block_bound, next_item = 0.0, end
            for c in cursors[:pivot + 1]:
                blocks, b = c[4], c[5]
                while b < len(blocks) and blocks[b][0] < item:
                    b += 1
                if b < len(blocks):
                    block_bound += blocks[b][1]
                    next_item = min(next_item, blocks[b][0] + 1)
            if block_bound < bar:
                if pivot + 1 < len(cursors):
                    next_item = min(next_item, cursors[pivot + 1][0])
                for c in cursors[:pivot + 1]:
                    if c[0] < next_item:
                        move(c, max(next_item, item + 1))
            elif cursors[0][0] == item:
                score = sum(c[3][c[1]] for c in cursors[:pivot + 1])
                if score >= bar:
                    out.append((item, score))
                for c in cursors[:pivot + 1]:
                    move(c, item + 1)
            else:
                for c in cursors[:pivot + 1]:
                    if c[0] < item:
                        move(c, item)

    def leaks(self, words: list[bytes]) -> dict[int, tuple[float, float, float, int]]:
        """Verified items of a text: score, question and answer overlap, first word of the passage."""
        best: dict[int, tuple[float, float, float, int]] = {}
        if not self.may_match(words):
            return best
        step = self.longest
        for start in range(0, max(1, len(words) - step), step):
            passage = words[start:start + 2 * step]
            if not self.may_match(passage):
                continue
            for item, score in self.search(passage):
                own_question, own_answer = self.parts[item]
                question, answer = overlap(own_question, passage), overlap(own_answer, passage)
                if len(own_answer) == 1 and answer < OVERLAP:
                    answer = overlap(own_question + own_answer, passage)
                if question >= OVERLAP and answer >= OVERLAP and (item not in best or score > best[item][0]):
                    best[item] = (score, question, answer, start)
        return best


def _statistics(items: DataFrame) -> tuple[DataFrame, int, float]:
    """Distinct terms of every item text, number of texts with words, mean number of words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms(text)
                own = sorted(set(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(own), pa.int64()), pa.array(own, pa.binary()),
                     pa.array([len(words) if k == 0 else None for k in range(len(own))], pa.int64())], ["item_id", "term", "size"])

    rows = stored(items.mapInArrow(count, "item_id long, term binary, size long"), "item-terms")
    sizes = rows.agg(F.count("size").alias("n"), F.avg("size").alias("mean")).first()  # one size per text
    return rows, sizes["n"], sizes["mean"] or 1.0


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per (document, item) leak: id, item_id, score, overlaps, first word of the passage."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    schema = ("id long, item_id long, score double, question_overlap double, "
              "answer_overlap double, first_word long")
    items = (items.filter(F.col(item_col).isNotNull())
             .select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct())
    items = stored(items, "items")
    rows, n_items, mean_size = _statistics(items)
    frequency = stored(rows.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term-df")
    shards = max(1, -(-n_items // SHARD))
    out = None
    for shard in range(shards):
        own = F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard
        texts = [(r["item_id"], r["text"]) for r in items.filter(own).orderBy("item_id", "text").collect()]
        used = rows.filter(own).select("term").distinct()
        df = {bytes(r["term"]): r["df"] for r in frequency.join(used, "term", "left_semi").collect()}
        index = spark.sparkContext.broadcast(Index(texts, df, n_items, mean_size))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            own_index = index.value
            for batch in batches:
                found = []
                for doc, text in zip(batch.column(0), batch.column(1)):
                    for item, x in sorted(own_index.leaks(terms(text.as_py())).items()):
                        found.append((doc.as_py(), own_index.ids[item], *x))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                                                                      pa.float64(), pa.int64()))],
                        ["id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

        part = (docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col))
                .mapInArrow(run, schema))
        out = part if out is None else out.unionByName(part)
    return (out.groupBy("id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap", "first_word")).alias("x"))
            .select(F.col("id").alias(id_col), "item_id", "x.*"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
