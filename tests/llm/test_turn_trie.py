"""Conversation trie against a brute-force trie, over many shards and odd rows."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from shelfspark.llm import turn_trie

# Extra columns have names that the operator uses itself.
SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("key", T.StringType()), T.StructField("depth", T.IntegerType()),
                       T.StructField("code", T.StringType()), T.StructField("seq", T.StringType()), T.StructField("first", T.BooleanType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "c", "s", True) for r in rows], SCHEMA).repartition(3)


def brute(convs: dict[int, list[tuple]]) -> collections.Counter:
    """Rows of every node of the trie of id -> turns (role, text)."""
    node = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            node[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in node if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, members in node.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1]) if p else 0)
    return collections.Counter(
        (min(m), len(p), min(node[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in node.items())


def conversations(rows) -> dict[int, list[tuple]]:
    """Conversations of distinct (conv_id, turn), in order of turn with null first."""
    out = collections.defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out[c].append((role or "", text or ""))
    return out


def rebuilt(convs) -> dict[int, list[tuple]]:
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in convs}
    return {c: convs.get(c - c % 100, [])[:heads[c]] + turns[heads[c]:] for c, turns in convs.items()}


def got(nodes) -> collections.Counter:
    return collections.Counter(tuple(r[c] for c in turn_trie.COLUMNS) for r in nodes.collect())


def random_rows(seed: int, conversations: int, longest: int, texts: int) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(6 * conversations), conversations):
        for turn in range(rnd.randint(1, longest)):
            text = f"t{rnd.randrange(texts)} é" * rnd.randint(1, 2)
            rows.append((c, None if turn == 0 and rnd.random() < 0.3 else turn, rnd.choice(["user", "assistant", None]) if texts > 2 else "user",
                         None if rnd.random() < 0.1 else text))
    return rows


@pytest.mark.parametrize("seed,count,longest,texts,shard", [
    (1, 300, 8, 2, 1 << 20), (2, 200, 6, 1, 60), (3, 150, 5, 40, 2000), (4, 1, 3, 2, 100)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, count, longest, texts, shard):
    monkeypatch.setattr(turn_trie, "SHARD", shard)
    rows = random_rows(seed, count, longest, texts)
    want = brute(rebuilt(conversations(rows)))
    codes = turn_trie.turn_codes(frame(spark, rows))
    assert got(turn_trie.prefix_trie(turn_trie.rebuilt(codes))) == want
    assert got(turn_trie.prefix_trie(codes)) == brute(conversations(rows))


def test_long_common_prefixes_over_shard_borders(spark, monkeypatch):
    """Conversations longer than a matrix, equal ones, prefixes of others and one-turn ones."""
    monkeypatch.setattr(turn_trie, "SHARD", 1500)
    rnd = random.Random(7)
    stem = [("user", f"turn {k}") for k in range(150)]
    convs = {c: stem[:rnd.choice([1, 31, 32, 33, 64, 65, 100, 150])] + [("user", str(rnd.randrange(3)))] * rnd.randrange(3) for c in range(60)}
    convs |= {100 + c: stem[:90] for c in range(40)}
    rows = [(c, k, role, text) for c, turns in convs.items() for k, (role, text) in enumerate(turns)]
    assert got(turn_trie.prefix_trie(turn_trie.turn_codes(frame(spark, rows)))) == brute(convs)


def test_many_members_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "JOINED", 7)
    convs = {c: [("user", "hello")] for c in range(500)} | {900: [("user", "hello"), ("assistant", "é😀")]}
    rows = [(c, k, *t) for c, turns in convs.items() for k, t in enumerate(turns)]
    assert got(turn_trie.prefix_trie(turn_trie.turn_codes(frame(spark, rows)))) == brute(convs)


def test_odd_rows(spark):
    """Null ids go, null role and text are empty, a null turn comes first, equal rows are turns of their own."""
    rows = [(None, 1, "user", "lost"), (5, 2, None, None), (5, None, "user", "first"), (5, 2, None, None), (-105, 1, "user", "a"),
            (0, 0, "user", "x" * 100_000), (0, 1, "", ""), (7, 3, "user", "x" * 100_000)]
    convs = conversations(rows)
    codes = turn_trie.turn_codes(frame(spark, rows))
    assert got(turn_trie.prefix_trie(codes)) == brute(convs)
    # Turns that tie come by role.
    tied = turn_trie.turn_codes(frame(spark, [(1, 1, "user", "b"), (1, 1, "assistant", "a"), (2, 0, "assistant", "a"), (2, 1, "user", "b")]))
    assert tied.select("codes").distinct().count() == 1


def test_conversations_without_turns_and_an_empty_table(spark):
    rows = [(c, 0, "user", f"only {c}") for c in range(101, 160)]  # no conversation 100: heads are empty
    want = rebuilt(conversations(rows))
    assert any(not t for t in want.values())
    assert got(turn_trie.prefix_trie(turn_trie.rebuilt(turn_trie.turn_codes(frame(spark, rows))))) == brute(want)
    assert turn_trie.prefix_trie(turn_trie.turn_codes(frame(spark, []))).count() == 0
