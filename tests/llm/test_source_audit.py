"""Source audit against brute force, with trees that are emptied early and odd rows."""

import collections
import itertools
import random
import re

import pytest

from shelfspark.llm import source_audit
from tests.llm.fixtures import SCHEMA, documents, no_documents, rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs: list[tuple]) -> collections.Counter:
    """Rows of (lang, source, text) documents by the definition: every term of every pair."""
    out = []
    for lang in {d[0] or "" for d in docs}:
        held = [(s or "", TERM.findall((t or "").translate(UPPER))) for l, s, t in docs if (l or "") == lang]
        seen = collections.Counter(t for _, found in held for t in set(found))
        kept = sorted(t for t, k in seen.items() if k >= 3)
        sources = sorted({s for s, _ in held})
        n = {s: collections.Counter() for s in sources}
        for s, found in held:
            n[s].update(t for t in found if seen[t] >= 3)
        every = sum(n.values(), collections.Counter())

        def p(counts, t):
            return 1 + 10 ** 9 * (counts[t] + 1) // (sum(counts.values()) + len(kept))

        def f(x, y):
            return (x - y) ** 2 // y

        for a in sources:
            pairs = [(sum(f(p(n[a], t), p(n[b], t)) for t in kept), b) for b in sources if b != a]
            terms = [(f(p(n[a], t), p(every, t)), t) for t in kept if n[a][t] > 0 and p(n[a], t) > p(every, t)]
            for part, values in (("pair", pairs), ("term", terms)):
                ordered = sorted(values, key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, a, part, item, value, k + 1) for k, (value, item) in enumerate(ordered) if part == "pair" or k < 200]
    return collections.Counter(out)


def got(frame) -> collections.Counter:
    assert frame.columns == ["lang", "source", "part", "item", "value", "rank"]
    return collections.Counter(tuple(r) for r in frame.collect())


def random_docs(seed: int, count: int, sources: int, vocabulary: int) -> list[tuple]:
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abXYé漢") for _ in range(rnd.randint(1, 4))) for _ in range(vocabulary)]
    return [(rnd.choice(["en", "de", None]), rnd.choice([None, *(f"s{k}" for k in range(sources))]),
             None if rnd.random() < 0.05 else "1-".join(rnd.choices(vocab, k=rnd.randint(0, 60)))) for _ in range(count)]


@pytest.mark.parametrize("seed,count,sources,vocabulary,nodes,held", [
    (1, 60, 4, 30, 50_000, 200_000), (2, 90, 7, 300, 20, 50), (3, 40, 1, 20, 3, 10), (4, 3, 3, 5, 50_000, 200_000)])
def test_audit_equals_brute_force(spark, monkeypatch, seed, count, sources, vocabulary, nodes, held):
    monkeypatch.setattr(source_audit, "NODES", nodes)
    monkeypatch.setattr(source_audit, "HELD", held)
    docs = random_docs(seed, count, sources, vocabulary)
    frame = spark.createDataFrame(docs, "lang string, source string, text string").repartition(4)
    assert got(source_audit.audit(frame)) == brute(docs)


def test_large_counts_stay_exact(spark):
    """Counts beyond 10^9 and a group whose divergence from a tiny one is far over 2^53."""
    counted = spark.createDataFrame(
        [("en", t, total, [(s, n) for s, n in row]) for t, total, row in [
            ("a", 20_000_000_003, [("s1", 20_000_000_000), ("s2", 3)]), ("b", 7, [("s2", 7)]), ("", 0, [("s1", 0), ("s2", 0), ("s3", 0)])]],
        "lang string, term string, total long, row array<struct<source: string, n: long>>")
    sizes = source_audit.groups(counted)
    n = {"s1": {"a": 20_000_000_000, "b": 0}, "s2": {"a": 3, "b": 7}, "s3": {"a": 0, "b": 0}}

    def p(s, t):
        return 1 + 10 ** 9 * (n[s][t] + 1) // (sum(n[s].values()) + 2)

    want = {(a, b): sum((p(a, t) - p(b, t)) ** 2 // p(b, t) for t in "ab") for a, b in itertools.permutations(n, 2)}
    assert {(r["source"], r["item"]): r["value"] for r in source_audit.pair_divergences(counted, sizes).collect()} == want


def test_tree_counts_a_node_once_for_each_ancestor():
    tree = source_audit.Tree()
    tree.insert("en", [("a", 1), ("b", 2), ("c", 1)], 5)
    tree.insert("en", [("a", 1), ("b", 2)], 2)
    tree.insert("en", [("a", 1), ("c", 1)], 1)
    assert len(tree.item) == 4
    found = collections.Counter()
    for batch in tree.pairs():
        for r in batch.to_pylist():
            found[r["a"], r["b"]] += r["terms"]
    assert found == {("a", "b"): 7, ("a", "c"): 6, ("b", "c"): 5}


def test_awkward_documents(spark):
    every = [(r[2], r[3], r[1]) for r in rows()]
    assert got(source_audit.audit(documents(spark))) == brute(every)
    assert source_audit.audit(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None, None, None, None, None, None)], SCHEMA)
    assert source_audit.audit(blank).count() == 0
