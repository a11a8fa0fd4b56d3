"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

A sentence has the probability ``s(z) = 1 / (1 + exp(-z))`` with ``z`` linear in its word
features (weights of at least 0, and a bias); a document is toxic unless every sentence is clean:
``P = 1 - prod(1 - s(z))``. Only documents are labelled, so weights and bias are fitted to document
labels through that product, and the sentence probabilities then locate the offending sentences.
The noisy-or is leaky: the leak ``s(bias)`` counts once in a document, and every sentence counts by
what it has above the leak, ``(1 - s(z)) / (1 - s(bias))``. A sentence without a feature, or with
features of weight 0, has nothing above it, so that no text is toxic by its length; all others enter.

Features are word starts of 3 to 10 letters and whole words, lower-cased. They are counted on
Spark over a bounded sample of labelled rows (``SAMPLE`` documents, the smallest hashes of the
id), tested for association with the label, and the strongest ``FEATURES`` are kept. The fit on
the driver sees only those features' positions in the sample. Scoring covers every whole text.

Defined cases: null and empty texts have no sentence and score 0; a table without usable labels
(none, or only one class) gives a model without features, which scores every document 0; null
labels are ignored and repeated labels of one id count as toxic if any is; repeated rows and
rows with a null id are scored like any other; very long texts are scored whole; of the
documents only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import read, ship, stored

SAMPLE = 12_000  # labelled documents the model is fitted on, at most
FEATURES = 400  # features of the model, at most
LEAST_Z = 4.0  # association of a feature with the label, in standard errors
LEAST_DOCS = 4  # toxic sample documents that have a feature, at least
SHORTEST, LONGEST = 3, 10  # letters of a word start
COUNTED = 100_000  # features counted in a worker's memory at a time
THRESHOLD = 0.3
BIAS, STIFF = -6.0, 10.0  # mean and precision of the prior of the bias, which is z of a sentence without a feature
SENTENCE = re.compile(r"[^.!?\n]+")
LETTERS = re.compile(r"[^\W\d_]+")


def lowered(text: str) -> str:
    """Lower case without moving any character."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def word_features(text: str) -> set[str]:
    """Word starts, and whole words marked by a closing blank."""
    out = set()
    for word in set(LETTERS.findall(lowered(text))):
        out.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
        out.add(word + " ")
    return out


class Finder:
    """Positions of a model's features in a text, by one Aho-Corasick pass."""

    def __init__(self, features: list[str]):
        self.auto = ahocorasick.Automaton()
        for k, f in enumerate(features):
            stem = f.rstrip(" ")
            old = self.auto.get(stem, ())
            self.auto.add_word(stem, (*old, (k, len(stem), f != stem)))
        if features:
            self.auto.make_automaton()
        self.any = bool(features)

    def sentences(self, text: str) -> tuple[int, dict[int, list[int]], list[tuple[int, int]]]:
        """Number of sentences that are not blank, features by number of the sentence that has them, its span."""
        hits = []
        if self.any:
            low = lowered(text)
            for end, found in self.auto.iter(low):
                for k, size, whole in found:
                    start = end + 1 - size
                    if start and low[start - 1].isalpha():
                        continue
                    if whole and end + 1 < len(low) and low[end + 1].isalpha():
                        continue
                    hits.append((start, k))
        if not hits:
            return sum(not x.isspace() for x in SENTENCE.findall(text)), {}, []
        spans = [m.span() for m in SENTENCE.finditer(text) if not m[0].isspace()]
        at = np.searchsorted([s for s, _ in spans], [h for h, _ in hits], side="right") - 1
        by: dict[int, list[int]] = {}
        for sentence, (_, k) in zip(at.tolist(), hits):
            by.setdefault(sentence, []).append(k)
        return len(spans), by, spans


def distinct_stems(found: list[tuple[str, int, int]]) -> list[str]:
    """One feature for each family of word starts that occur in the same documents.

    Nested starts with equal counts mark the same documents; the longest start stands for them
    (before the whole word). The order of ``found`` is kept.
    """
    best: dict[tuple[str, int, int], str] = {}
    for feature, n1, n0 in found:
        key = (feature[:SHORTEST], n1, n0)
        old = best.get(key)
        if old is None or (feature.startswith(old) and not feature.endswith(" ")):
            best[key] = feature
    return list(best.values())


def _softplus(z):
    return np.logaddexp(0.0, z)


class Model:
    """Weights by feature and a bias, with the noisy-or over all sentences that have a feature."""

    def __init__(self, features: list[str], weights, bias: float):
        self.features, self.weights, self.bias = list(features), np.asarray(weights, dtype=float), float(bias)

    def sentence_scores(self, by: dict[int, list[int]]) -> dict[int, float]:
        return {s: float(self.bias + self.weights[ks].sum()) for s, ks in by.items()}

    def score(self, n: int, by: dict[int, list[int]]) -> float:
        if not len(self.weights) or not n:
            return 0.0
        leak = _softplus(self.bias)
        clean = leak + (_softplus(np.array(list(self.sentence_scores(by).values()))) - leak).sum()
        return float(-np.expm1(-clean))


def fit(features: list[str], rows: list[tuple[int, int, dict[int, list[int]]]],
        steps: int = 600, rate: float = 0.05, ridge: float = 0.5) -> Model:
    """Weights and bias that maximise the noisy-or likelihood of document labels (full-batch Adam).

    Both have normal priors: the weights (at least 0) around 0, the bias around ``BIAS``.

    ``rows``: (label, number of sentences, features by sentence) of each sample document.
    """
    labels = np.array([r[0] for r in rows], dtype=float)
    if not features or not len(labels) or labels.min() == labels.max():
        return Model([], [], 0.0)
    speaks = np.array([float(r[1] > 0) for r in rows])
    doc_of, entry_of, feature_of, sentence = [], [], [], 0
    for d, (_, _, by) in enumerate(rows):
        for ks in by.values():
            doc_of.append(d)
            entry_of.extend([sentence] * len(ks))
            feature_of.extend(ks)
            sentence += 1
    doc_of, entry_of, feature_of = (np.array(x, dtype=np.int64) for x in (doc_of, entry_of, feature_of))
    n_docs, n_features = len(rows), len(features)
    w = np.r_[np.zeros(n_features), BIAS]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        bias = w[-1]
        z = bias + np.bincount(entry_of, w[feature_of], minlength=sentence)
        clean = speaks * _softplus(bias) + np.bincount(doc_of, _softplus(z) - _softplus(bias), minlength=n_docs)
        clean = np.maximum(clean, 1e-9)
        # d(-log likelihood) / d(clean): 1 for clean documents, -exp(-c) / (1 - exp(-c)) for toxic ones
        slope = np.where(labels > 0, -1.0 / np.expm1(np.minimum(clean, 500.0)), 1.0)
        dz = slope[doc_of] / (1.0 + np.exp(-z))
        leak = ((slope * speaks).sum() - slope[doc_of].sum()) / (1.0 + np.exp(-bias))
        of_bias = dz.sum() + leak + STIFF * (bias - BIAS)
        grad = np.r_[np.bincount(feature_of, dz[entry_of], minlength=n_features) + ridge * w[:-1], of_bias] / n_docs
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        np.maximum(w[:-1], 0.0, out=w[:-1])
    return Model(features, w[:-1], float(w[-1]))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    label_col: str, sample: int) -> DataFrame:
    """At most ``sample`` labelled documents outside the held-out quarter: id, text, label."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label")))
    chosen = (known.filter(~held_out(F.col(id_col)))
              .orderBy(F.xxhash64(id_col), id_col).limit(sample))
    # ``chosen`` has at most ``sample`` rows of two numbers: its size does not follow the input.
    return (docs.select(F.col(id_col), F.col(text_col).alias("_text"))
            .join(F.broadcast(chosen), id_col).select(id_col, "_text", "_label"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    ship(docs.sparkSession)
    rows = stored(labelled_sample(docs, labels, id_col, text_col, label_col, sample), "toxicity-sample")
    sizes = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1 = sum(n for label, n in sizes.items() if label)
    n0 = sum(sizes.values()) - n1
    if not n0 or not n1:
        return Model([], [], 0.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            keys = list(toxic.keys() | clean.keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                 pa.array([clean[k] for k in keys], pa.int64())], ["feature", "n1", "n0"])
            toxic.clear()
            clean.clear()
            return out

        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                (toxic if label.as_py() else clean).update(word_features(text.as_py() or ""))
                if len(toxic) + len(clean) >= COUNTED:  # Spark adds up the partial counts
                    yield flushed()
        if toxic or clean:
            yield flushed()

    counts = (rows.select("_text", "_label").mapInArrow(count, "feature string, n1 long, n0 long")
              .groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
              .filter(F.col("n1") >= LEAST_DOCS))
    p1, p0 = F.col("n1") / n1, F.col("n0") / n0
    p = (F.col("n1") + F.col("n0") + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    strong = (counts.withColumn("z", z).filter(F.col("z") >= LEAST_Z)
              .orderBy(F.desc("z"), "feature").limit(10 * FEATURES).collect())
    features = distinct_stems([(r["feature"], r["n1"], r["n0"]) for r in strong])[:FEATURES]
    finder = Finder(features)

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [finder.sentences(x or "")[:2] for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int32()), pa.array([n for n, _ in found], pa.int32()),
                 pa.array([[x for s, ks in by.items() for k in ks for x in (s, k)] for _, by in found],
                          pa.list_(pa.int32()))], ["label", "n", "pairs"])

    bags = []
    for r in (rows.orderBy(id_col).select("_text", "_label")
              .mapInArrow(positions, "label int, n int, pairs array<int>").collect()):
        by: dict[int, list[int]] = {}
        for s, k in zip(r["pairs"][0::2], r["pairs"][1::2]):
            by.setdefault(s, []).append(k)
        bags.append((r["label"], r["n"], by))
    return fit(features, bags)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Per input row: id, score, predicted and the offending sentences (start, end, probability)."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("probability", T.DoubleType())])
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           T.StructField("offending", T.ArrayType(span))])
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
    features, weights, bias = model.features, model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, finder = Model(features, weights, bias), Finder(features)
        for batch in batches:
            scores, places = [], []
            for text in batch.column(1):
                n, by, spans = finder.sentences(text.as_py() or "")
                scores.append(own.score(n, by))
                found = []
                for s, z in own.sentence_scores(by).items():
                    if (p := 1.0 / (1.0 + np.exp(-z))) >= threshold / 2:
                        found.append({"start": spans[s][0], "end": spans[s][1], "probability": float(p)})
                places.append(sorted(found, key=lambda x: x["start"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array([int(x >= threshold) for x in scores], pa.int32()),
                 pa.array(places, spans_type)], [f.name for f in schema])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input rows whose score is below ``threshold``, unchanged."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)
    features, weights, bias = model.features, model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, finder = Model(features, weights, bias), Finder(features)
        for batch in batches:
            keep = [own.score(*finder.sentences(x.as_py() or "")[:2]) < threshold for x in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
