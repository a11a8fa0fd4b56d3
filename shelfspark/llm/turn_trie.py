"""Prefix trie of conversations, by sorted matrices of turn ids.

A turn becomes a 20-byte code (16 bytes of a digest of role and text, 4 bytes of the text's code
points), a conversation the codes of its turns in order. Equal conversations are one row with a
count, so a conversation that many share is sorted once; the digest of its members is fed from
pieces that were joined in parallel. The rows are range-partitioned by their codes, and a range is
one task (a shard of about ``SHARD`` bytes):

* turn ids become small numbers in the order of their codes, padded with 0 into matrices of
  ``WIDTH`` columns; ``numpy.lexsort`` orders the rows (further columns only for rows still tied);
* columns in which a row differs from the row before are marked, the marks OR-accumulated from the
  left: the columns without a mark are the common prefix, the first marked one starts a node;
* at every depth ``reduceat`` over the starts adds up members, leaves and saved tokens.

Only the nodes along a shard's first and last row can go on in the shards beside it. They leave the
shard as partial rows with a digest of their prefix. How far the first row of a shard agrees with
the last row of the shard before it tells which nodes both counted as new; after that correction
partial rows of a prefix are added up. No conversation is compared with any other outside its
shard, and nothing travels but sums.

Defined cases: null role and text are empty; rows without a conv_id are left out; turns are ordered
by turn (null first), turns that tie by role and then by the digest of their code; repeated rows
are repeated turns; an empty conversation is a member of the root only; an empty table has no
nodes. A conversation is one row (20 bytes a turn), as a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import read, ship, shuffle_width, stored

CODE = 20  # bytes of a turn's code
WIDTH = 32  # columns of a matrix
SHARD = 8 << 20  # bytes of codes in one range
JOINED = 4096  # conversation ids joined into one text before they are hashed
HEAD = 6  # a rebuilt conversation takes 0 to HEAD - 1 turns of the first of its hundred
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


# --- conversations ---------------------------------------------------------------------------
def turn_codes(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and the codes (hexadecimal) of its turns in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    code = F.concat(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32),
                    F.lpad(F.hex(F.char_length(text)), 8, "0"))
    return (turns.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", role.alias("role"), code.alias("code")).alias("t"))
            .groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["code"]).alias("codes")))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Every conversation behind the first turns of the first conversation of its hundred."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    heads = convs.filter(F.col("conv_id") % 100 == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("codes", 1, HEAD - 1).alias("head"))
    empty = F.array().cast("array<string>")
    return (convs.join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("first_id"), "left")
            .select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), taken), empty),
                                        F.slice("codes", taken + 1, F.size("codes"))).alias("codes")))


# --- equal conversations ---------------------------------------------------------------------
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of neighbouring rows of one key, joined in pieces of at most ``JOINED``."""
    key, held = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([len(held)], pa.int64()),
                                           pa.array([",".join(map(str, held))])], ["key", "conv_id", "n_convs", "ids"])

    out: list[pa.RecordBatch] = []
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (k != key or len(held) == JOINED):
                out.append(piece())
                held = []
            key = k
            held.append(c)
        if len(out) > 1000:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            out = []
    if held:
        out.append(piece())
    if out:
        yield from pa.Table.from_batches(out).combine_chunks().to_batches()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest id, number and digest of the members of every key; pieces come in order of key and id."""
    key = digest = first = None
    n = 0
    for batch in batches:
        rows = []
        for k, c, m, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if k != key:
                if key is not None:
                    rows.append((key, first, n, digest.hexdigest()))
                key, first, n, digest = k, c, 0, hashlib.sha256()
            digest.update((b"," if n else b"") + ids.encode())
            n += m
        yield _members(rows)
    if key is not None:
        yield _members([(key, first, n, digest.hexdigest())])


def _members(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "conv_id", "n_convs", "ends_sha256"])


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """One row per distinct conversation: smallest conv_id, n_convs, ends_sha256 and its codes (binary)."""
    codes = F.unhex(F.array_join("codes", ""))
    every = stored(convs.select("conv_id", codes.alias("seq"))
                   .withColumn("key", F.unhex(F.sha2("seq", 256))), "conversations")
    pieces = (every.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .mapInArrow(_joined, "key binary, conv_id long, n_convs long, ids string"))
    members = (pieces.repartition("key").sortWithinPartitions("key", "conv_id")
               .mapInArrow(_hashed, "key binary, conv_id long, n_convs long, ends_sha256 string"))
    return members.join(every, ["key", "conv_id"]).select("seq", "conv_id", "n_convs", "ends_sha256")


# --- one shard ---------------------------------------------------------------------------------
def _matrix(ids: np.ndarray, start: np.ndarray, size: np.ndarray, rows: np.ndarray, at: int) -> np.ndarray:
    """Turn ids of some rows in the columns from ``at`` on, 0 behind a row's last turn."""
    column = at + np.arange(WIDTH)
    inside = column < size[rows, None]
    return np.where(inside, ids[np.minimum(start[rows, None] + column, len(ids) - 1)], 0) if len(ids) else np.zeros(inside.shape, np.int64)


def _ordered(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Row order by turn ids, a prefix before what it begins."""
    n = len(size)
    order, tied, at = np.arange(n), np.zeros(n, np.int64), 0  # tied: group of rows that are equal so far
    while True:
        _, group, members = np.unique(tied, return_inverse=True, return_counts=True)
        open_places = np.flatnonzero(members[group] > 1)
        if not len(open_places) or at > size[order[open_places]].max():
            return order
        rows = order[open_places]
        m = _matrix(ids, start, size, rows, at)
        by = np.lexsort([*m.T[::-1], tied[open_places]])
        order[open_places] = rows[by]
        m, before = m[by], tied[open_places]
        new = np.ones(len(by), bool)
        new[1:] = (before[1:] != before[:-1]) | (m[1:] != m[:-1]).any(axis=1)
        # A group is named by the place of its first row, so names stay in order and unique.
        tied[:] = np.where(members[group] > 1, tied, np.arange(n))
        tied[open_places] = open_places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        at += WIDTH


def _common(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the row before it (0 for the first)."""
    same = np.zeros(len(size), np.int64)
    rows, at = np.arange(1, len(size)), 0
    while len(rows):
        changed = np.logical_or.accumulate(
            _matrix(ids, start, size, rows, at) != _matrix(ids, start, size, rows - 1, at), axis=1)
        same[rows] += (~changed).sum(axis=1)
        rows, at = rows[~changed[:, -1]], at + WIDTH
        rows = rows[size[rows] > at]
    return same


def _prefix_keys(codes: bytes) -> list[bytes]:
    """Digest of every prefix of a row, the empty one first."""
    running = hashlib.blake2b(digest_size=16)
    keys = [running.digest()]
    for at in range(0, len(codes), CODE):
        running.update(codes[at:at + CODE])
        keys.append(running.copy().digest())
    return keys


_NODE = ("shard long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, first boolean, last boolean, whole boolean, key binary, parent_key binary, "
         "before long, upto long")
_TYPES = [pa.int64()] * 8 + [pa.string()] + [pa.bool_()] * 3 + [pa.binary()] * 2 + [pa.int64()] * 2
_NAMES = [c.split()[0] for c in _NODE.split(", ")]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a range of distinct conversations: whole ones, and partial ones along its first and last row."""
    table = pa.Table.from_batches(held) if (held := list(batches)) else None
    if table is None or not table.num_rows:
        return
    seqs = table.column(0).to_pylist()
    shard = TaskContext.get().partitionId()
    size = np.array([len(s) // CODE for s in seqs], np.int64)
    start = np.cumsum(size) - size
    codes = np.frombuffer(b"".join(seqs), np.dtype([("hi", ">u8"), ("lo", ">u8"), ("chars", ">u4")]))
    hi, lo = codes["hi"].astype(np.uint64), codes["lo"].astype(np.uint64)
    by = np.lexsort((lo, hi))
    new = np.ones(len(by), bool)
    new[1:] = (hi[by][1:] != hi[by][:-1]) | (lo[by][1:] != lo[by][:-1])
    ids = np.empty(len(by), np.int64)
    ids[by] = np.cumsum(new)

    order = _ordered(ids, start, size)
    start, size = start[order], size[order]
    same = _common(ids, start, size)
    conv, n = (table.column(c).to_numpy()[order] for c in ("conv_id", "n_convs"))
    ends = np.array(table.column("ends_sha256").to_pylist(), object)[order]
    chars = np.concatenate([[0], np.cumsum(codes["chars"], dtype=np.int64)])
    total = chars[start + size] - chars[start]
    fresh = total - (chars[start + same] - chars[start])  # code points of the nodes a row starts
    leaf = np.ones(len(size), np.int64)
    leaf[:-1] = same[1:] < size[:-1]
    edges = [_prefix_keys(seqs[order[0]]), _prefix_keys(seqs[order[-1]])]

    last_row = len(size) - 1
    rows, heads, parents = np.arange(len(size)), np.array([0]), None
    for depth in range(int(size.max()) + 1):
        at = np.searchsorted(rows, heads)
        below = chars[start[heads] + max(depth - 1, 0)] - chars[start[heads]]
        upto = chars[start[heads] + depth] - chars[start[heads]]
        count, smallest = np.add.reduceat(n[rows], at), np.minimum.reduceat(conv[rows], at)
        saved = (np.add.reduceat((n * total)[rows], at) - count * below
                 - (np.add.reduceat(fresh[rows], at) - fresh[heads] + total[heads] - below))
        leaves = np.add.reduceat(leaf[rows], at)
        deeper = rows[size[rows] > depth]
        next_heads = deeper[(same[deeper] <= depth) | (deeper == 0)]
        children = np.bincount(np.searchsorted(heads, next_heads, "right") - 1, minlength=len(heads))
        first = np.zeros(len(heads), bool)
        last, partial_parent = first.copy(), first.copy()
        first[0], last[-1] = size[0] >= depth, size[last_row] >= depth
        keys, parent_keys, parent = [None] * len(heads), [None] * len(heads), [None] * len(heads)
        if parents is not None:
            up = np.searchsorted(parents[0], heads, "right") - 1
            parent = parents[1][up]
            for side, (end, reaches) in enumerate(((0, size[0]), (len(parents[0]) - 1, size[last_row]))):
                if reaches >= depth - 1:
                    for i in np.flatnonzero(up == end):
                        parent_keys[i] = edges[side][depth - 1]
        if first[0]:
            keys[0] = edges[0][depth]
        if last[-1]:
            keys[-1] = edges[1][depth]
        columns = [np.full(len(heads), shard), np.full(len(heads), depth), smallest, parent, count, children, leaves, saved,
                   np.where(size[heads] == depth, ends[heads], NO_MEMBERS), first, last, last & (size[last_row] == depth),
                   keys, parent_keys, below, upto]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)
        parents, rows, heads = (heads, smallest), deeper, next_heads


# --- all shards --------------------------------------------------------------------------------
def _combined(partial: DataFrame) -> DataFrame:
    """Partial rows with what neighbouring shards both counted taken out: shard, key and sums."""
    shards = partial.filter("depth = 0").select("shard").withColumn("left", F.lag("shard").over(Window.orderBy("shard")))
    ending = partial.filter("last").select(F.col("shard").alias("left"), "key", F.col("whole").alias("ends_there"))
    # Of the nodes both shards hold, the deepest: its depth, its code points, and whether it ends the left shard.
    shared = (partial.filter("first").join(shards, "shard").join(ending, ["left", "key"])
              .groupBy("shard", "left").agg(F.max(F.struct("depth", "upto", "ends_there")).alias("s"))
              .select("shard", "left", F.col("s.depth").alias("deepest"), F.col("s.upto").alias("chars"), F.col("s.ends_there").alias("goes_on")))
    again = shared.select("shard", "deepest", "chars")
    inner = shared.filter("goes_on").select(F.col("left").alias("shard"), F.lit(1).alias("not_leaf"))
    both = F.col("first") & (F.col("depth") <= F.col("deepest"))

    def less(condition: Column, value) -> Column:
        return F.when(condition, value).otherwise(F.lit(0))

    return (partial.join(again, "shard", "left").join(inner, "shard", "left")
            .withColumn("saved_tokens", F.col("saved_tokens") + less(both, F.col("chars") - F.col("before")))
            .withColumn("n_children", F.col("n_children") - less(both & (F.col("depth") < F.col("deepest")), F.lit(1)))
            .withColumn("n_leaves", F.col("n_leaves") - less(F.col("last") & F.col("not_leaf").isNotNull(), F.lit(1)))
            .groupBy("key").agg(
                F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
                *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
                F.max(F.when(F.col("ends_sha256") != NO_MEMBERS, F.col("ends_sha256"))).alias("ends_sha256")))


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, codes): see ``COLUMNS``.

    A node is a distinct sequence of first turns; conv_id is its smallest member, n_leaves and
    saved_tokens are those of its subtree, ends_sha256 is of the members that end in it.
    """
    ship(convs.sparkSession)
    sequences = stored(distinct_sequences(convs), "sequences")
    size = sequences.agg(F.sum(F.octet_length("seq"))).first()[0] or 0
    shards = max(shuffle_width(sequences), -(-size // SHARD))
    nodes = stored(sequences.repartitionByRange(shards, "seq").mapInArrow(_shard, _NODE), "nodes")
    partial = nodes.filter(F.col("first") | F.col("last"))
    final = stored(_combined(partial), "edges")
    parent = final.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("over"))
    edges = final.join(parent, "parent_key", "left").select(
        *(F.col("over").alias(c) if c == "parent_conv_id" else F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias(c) if c == "ends_sha256"
          else F.col(c) for c in COLUMNS))
    # Parents along a shard's edges get their smallest member from all shards; joined per shard,
    # so that the children of the root are not one key.
    known = partial.select("shard", "key").join(final.select("key", F.col("conv_id").alias("over")), "key")
    whole = (nodes.filter(~F.col("first") & ~F.col("last"))
             .join(known.select("shard", F.col("key").alias("parent_key"), "over"), ["shard", "parent_key"], "left")
             .withColumn("parent_conv_id", F.coalesce("over", "parent_conv_id")).select(*COLUMNS))
    return edges.unionByName(whole)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = stored(turn_codes(read(spark, sf_dir, "conversations")), "turn-codes")
    return prefix_trie(rebuilt(convs))
