"""Exact substring dedup on a sparse enhanced suffix array with its common-prefix interval tree.

A byte is removed if a string of ``length`` bytes that covers it also starts in a document with
a smaller id; strings are judged on the input. The suffix array is sparse and spread over Spark:

1. Anchors. Of the ``SEED``-byte strings in every window of ``length`` bytes the ones with the
   smallest hash are anchors, so equal windows have equal anchors at equal offsets.
2. Anchor hashes are dealt to partitions by value; those that two documents share come back as
   a list per document. All other text needs no suffix.
3. The suffixes at shared anchors (``length`` bytes to the right, ``length - SEED`` to the left)
   are dealt by anchor hash again. Each partition sorts them (the suffix array), compares
   neighbours (the common-prefix array) and scans that array with a stack, which visits the
   nodes of the common-prefix interval tree: each is a string with *all* its occurrences.
4. A node whose occurrences differ in the bytes to their left is split by left extension:
   sorted by left context, the longest left match of an occurrence with one of a smaller
   document is at the nearest such neighbour on either side, found with a second stack. A node
   without that diversity extends to the left as a whole. A match of ``length`` bytes or more
   is a span to remove in the later document.

Identical texts are removed as whole documents, so a group of copies sends one text per batch.

Defined cases: null text is empty; texts shorter than ``length`` can
hold no match and are kept; repeats inside one document, and rows that repeat an id,
do not count (no smaller id); rows with a null id are kept whole and are no source; long texts
are indexed whole, in blocks that overlap; an empty table gives an empty result; only the id and
text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.common import _power_tables, mix64, read, ship, shuffle_width, stored

LENGTH, SEED = 50, 20
CHUNK = 1 << 18  # bytes hashed at a time
BUCKETS_PER_PARTITION = 4


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """Minimum or maximum (``op``) of every run of ``width`` values, by doubling."""
    n, size = len(x), 1
    while size * 2 <= width:
        x = op(x[:len(x) - size], x[size:])
        size *= 2
    rest = n - width + 1
    return op(x[:rest], x[width - size:width - size + rest])


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """Positions and hashes of the anchors of concatenated texts that end at ``ends``."""
    n, span = len(data), length - seed + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = _power_tables(n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=prefix[1:])
    h = mix64((prefix[seed:] - prefix[:-seed]) * down[:n - seed + 1]) | np.uint64(1)
    least = _sliding(h, span, np.minimum)  # one per window start
    inside = np.ones(len(least), dtype=bool)
    for end in ends[:-1].tolist():  # windows that cross into the next text
        inside[max(0, end - length + 1):end] = False
    least[~inside] = 0
    padded = np.zeros(len(h) + span - 1, dtype=np.uint64)
    padded[span - 1:span - 1 + len(least)] = least
    at = np.flatnonzero(_sliding(padded, span, np.maximum) == h)
    return at, h[at]


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to blocks of about CHUNK bytes: data, ends, number of the text, its offset.

    A long text is cut into blocks that overlap by ``length - 1`` bytes, so no window is lost.
    """
    parts, numbers, offsets, size = [], [], [], 0
    for k, text in enumerate(texts):
        for lo in range(0, max(1, len(text) - length + 1), CHUNK):
            part = text[lo:lo + CHUNK + length - 1]
            if len(part) < length:
                continue
            parts.append(part)
            numbers.append(k)
            offsets.append(lo)
            size += len(part)
            if size >= CHUNK:
                yield _joined(parts, numbers, offsets)
                parts, numbers, offsets, size = [], [], [], 0
    if parts:
        yield _joined(parts, numbers, offsets)


def _joined(parts, numbers, offsets):
    ends = np.cumsum([len(p) for p in parts])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), ends, np.array(numbers), np.array(offsets)


def text_anchors(texts: list[bytes], length: int = LENGTH, seed: int = SEED):
    """Number of the text, position and hash of every anchor of a list of texts."""
    out = []
    for data, ends, numbers, offsets in _blocks(texts, length):
        at, h = anchors(data, ends, length, seed)
        part = np.searchsorted(ends, at, side="right")
        start = np.concatenate([[0], ends[:-1]])
        out.append((numbers[part], at - start[part] + offsets[part], h))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def squeezed(data: bytes) -> bytes:
    """Bytes compressed for a shuffle (entropy-coded, which Spark's own shuffle codec is not)."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if data else b""


def unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True) if data else b""


def _packets(buckets: int, h: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
    """Rows of parallel arrays dealt to buckets by hash: bucket and the packed, compressed arrays."""
    if not len(h):
        return
    bucket = (h >> np.uint64(33)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for lo, hi in zip(edges, np.r_[edges[1:], len(order)]):
        yield (int(bucket[lo]), *[squeezed(np.ascontiguousarray(c[order[lo:hi]]).tobytes()) for c in columns])


def _unpack(batches: Iterator[pa.RecordBatch], types: list[str]) -> list[np.ndarray]:
    """The packed arrays of all rows of a partition, joined."""
    parts = [[] for _ in types]
    for batch in batches:
        for k in range(len(types)):
            parts[k].extend(unsqueezed(x.as_py()) for x in batch.column(k + 1))
    return [np.frombuffer(b"".join(p), dtype=t) for p, t in zip(parts, types)]


def _unpack_known(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, documents and whether they are known to be shared, of all rows of a partition."""
    h, doc, known = [], [], []
    for batch in batches:
        for a, b, k in zip(*[batch.column(i) for i in (1, 2, 3)]):
            h.append(unsqueezed(a.as_py()))
            doc.append(unsqueezed(b.as_py()))
            known.append(np.full(len(doc[-1]) // 8, k.as_py()))
    return (np.frombuffer(b"".join(h), dtype="<u8"), np.frombuffer(b"".join(doc), dtype="<i8"),
            np.concatenate(known) if known else np.empty(0, dtype=bool))


def _send_anchors(buckets: int, length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, seen = [], [], set()
            rows = sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), key=lambda r: r[0])
            for doc, text in rows:
                data = (text or "").encode()
                if len(data) < length:
                    continue
                digest = hashlib.blake2b(data, digest_size=16).digest()
                if digest not in seen:  # the copies of this batch with larger ids are removed whole
                    seen.add(digest)
                    ids.append(doc)
                    texts.append(data)
            number, _, h = text_anchors(texts, length, seed)
            if not len(h):
                continue
            doc = np.array(ids, dtype=np.int64)[number]
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]
            doc, h = doc[new], h[new]
            # The smallest and the largest document of this batch speak for a hash; the others
            # are known to share it and are dealt out evenly, so no hash has more than two
            # rows of a batch in its own bucket.
            order = np.lexsort((doc, h))
            doc, h = doc[order], h[order]
            known = np.zeros(len(h), dtype=bool)
            known[1:-1] = (h[1:-1] == h[:-2]) & (h[1:-1] == h[2:])
            rows = [(*r, False) for r in _packets(buckets, h[~known], [h[~known], doc[~known]])]
            even = mix64(h[known] + doc[known].view(np.uint64))
            rows += [(*r, True) for r in _packets(buckets, even, [h[known], doc[known]])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary()),
                                              pa.array([r[3] for r in rows], pa.bool_())], ["bucket", "h", "doc", "known"])
    return run


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(document, anchor hash) for the hashes that several documents of the partition have."""
    h, doc, known = _unpack_known(batches)
    if not len(h):
        return
    own_h, own_doc = h[~known], doc[~known]
    order = np.lexsort((own_doc, own_h))
    own_h, own_doc = own_h[order], own_doc[order]
    if len(own_h):
        new = np.r_[True, own_h[1:] != own_h[:-1]]
        starts = np.flatnonzero(new)
        last = np.r_[starts[1:], len(own_h)] - 1
        shared = (own_doc[starts] != own_doc[last])[np.cumsum(new) - 1]
        own_h, own_doc = own_h[shared], own_doc[shared]
    h, doc = np.r_[own_h, h[known]], np.r_[own_doc, doc[known]]
    for lo in range(0, len(h), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(doc[lo:lo + 100_000]), pa.array(h[lo:lo + 100_000].view(np.int64))],
                                         ["id", "h"])


def _send_suffixes(buckets: int, length: int, seed: int):
    left, size = length - seed, 2 * length - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids = np.array(part.column(0).to_pylist(), dtype=np.int64)
                texts = [unsqueezed(x) for x in part.column(1).to_pylist()]
                number, at, h = text_anchors(texts, length, seed)
                if not len(h):
                    continue
                # Keep the anchors whose (document, hash) is listed as shared.
                keys = [np.array(k.values.to_numpy(zero_copy_only=False)).view(np.uint64) for k in part.column(2)]
                listed = mix64(np.concatenate(keys)) + np.repeat(np.arange(len(keys), dtype=np.uint64), [len(k) for k in keys])
                own = mix64(h) + number.astype(np.uint64)
                keep = np.isin(own, listed)
                number, at, h = number[keep], at[keep], h[keep]
                if not len(h):
                    continue
                joined = np.frombuffer(b"\0" * left + (b"\0" * length).join(texts) + b"\0" * length, dtype=np.uint8)
                base = left + np.concatenate([[0], np.cumsum([len(t) + length for t in texts])[:-1]])
                context = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(joined, size)[base[number] + at - left])
                to_left = np.minimum(at, left)
                to_right = np.minimum(np.array([len(t) for t in texts])[number] - at, length)
                doc = ids[number]
                # Of equal suffixes in this slice the smallest document's go to their bucket; the
                # others match it over their whole length, so their spans are known. They are
                # dealt out evenly, without hash and context.
                as_bytes = context.view(f"V{size}").ravel()
                sides = to_left * 256 + to_right
                order = np.lexsort((doc, sides, h))
                by, same = as_bytes[order], np.zeros(len(order), dtype=bool)
                same[1:] = ((h[order][1:] == h[order][:-1]) & (sides[order][1:] == sides[order][:-1])
                            & (by[1:] == by[:-1]))
                first = doc[order][np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
                known = np.zeros(len(order), dtype=bool)
                known[order] = same & (doc[order] > first)
                own = ~known
                columns = [h, doc, at.astype(np.int64), to_left.astype(np.uint8), to_right.astype(np.uint8), context]
                rows = list(_packets(buckets, h[own], [c[own] for c in columns]))
                known &= to_left + to_right >= length
                even = mix64(doc[known].view(np.uint64) + at[known].astype(np.uint64))
                rows += [(r[0], b"", *r[1:], b"") for r in _packets(buckets, even, [c[known] for c in columns[1:5]])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32())]
                    + [pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 7)],
                    ["bucket", "h", "doc", "at", "to_left", "to_right", "context"])
    return run


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Nodes (common prefix, first, last) of the interval tree, inner nodes first.

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i (below ``least``: none); the stack
    holds the open intervals.
    """
    stack: list[list[int]] = []
    for i in range(1, len(lcp) + 1):
        value = lcp[i] if i < len(lcp) and lcp[i] >= least else 0
        first = i - 1
        while stack and stack[-1][0] > value:
            size, first = stack.pop()
            yield size, first, i - 1
        if value and (not stack or stack[-1][0] < value):
            stack.append([value, first])


def left_matches(members: list[int], doc: list[int], left: list[int], to_left: list[int], width: int) -> dict[int, int]:
    """Longest left match of each occurrence with an occurrence of a smaller document.

    ``left`` holds the left contexts as numbers, nearest byte first, so sorting them sorts the
    contexts and the highest differing bit gives the match. On each side the nearest neighbour
    with a smaller document has the longest match: a stack keeps the candidates.
    """
    order = sorted(members, key=left.__getitem__)
    best: dict[int, int] = {}
    for line in (order, order[::-1]):
        stack: list[int] = []
        for x in line:
            while stack and doc[stack[-1]] >= doc[x]:
                stack.pop()
            if stack:
                y = stack[-1]
                match = min((8 * width - (left[x] ^ left[y]).bit_length()) // 8, to_left[x], to_left[y])
                if match > best.get(x, -1):
                    best[x] = match
            stack.append(x)
    return best


def _span_packets(buckets: int, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """Spans dealt to buckets by document."""
    rows = list(_packets(buckets, mix64(doc.view(np.uint64)), [doc, lo.astype(np.int64), hi.astype(np.int64)]))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32())]
                                      + [pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)],
                                      ["bucket", "doc", "lo", "hi"])


def _spans(buckets: int, length: int, seed: int):
    width = length - seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = [], []
        for batch in batches:  # packets without a context hold known spans
            has = np.array([len(x.as_py()) > 0 for x in batch.column(6)], dtype=bool)
            own.append(batch.filter(pa.array(has)))
            known.append(batch.filter(pa.array(~has)))
        _, doc, at, to_left, to_right, _ = _unpack(iter(known), ["<u8", "<i8", "<i8", "u1", "u1", "u1"])
        known = doc, at - to_left, at + to_right
        h, doc, at, to_left, to_right, context = _unpack(iter(own), ["<u8", "<i8", "<i8", "u1", "u1", "u1"])
        n = len(h)
        if not n:
            if len(known[0]):
                yield _span_packets(buckets, *known)
            return
        context = context.reshape(n, width + length)
        right = np.zeros((n, -(-length // 8) * 8), dtype=np.uint8)
        right[:, :length] = context[:, width:]
        words = right.view(">u8")
        order = np.lexsort((*[words[:, k] for k in range(words.shape[1] - 1, -1, -1)], h))
        h, doc, at, to_left, to_right = (x[order] for x in (h, doc, at, to_left, to_right))
        context, right = context[order], right[order][:, :length]
        lcp = np.zeros(n, dtype=np.int64)
        for lo in range(1, n, 100_000):
            hi = min(n, lo + 100_000)
            differ = right[lo:hi] != right[lo - 1:hi - 1]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
            first = np.minimum(first, np.minimum(to_right[lo:hi], to_right[lo - 1:hi - 1]))
            lcp[lo:hi] = np.where(h[lo:hi] == h[lo - 1:hi - 1], first, 0)
        turned = np.ascontiguousarray(context[:, width - 1::-1] if width else context[:, :0]).tobytes()
        del context, right, words
        left = [int.from_bytes(turned[i:i + width], "big") for i in range(0, n * width, width)]
        docs, near = doc.tolist(), to_left.tolist()
        back, forth = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for size, first, last in intervals(lcp.tolist(), seed):
            need = length - size
            if last - first == 1:
                x, y = (first, last) if docs[first] > docs[last] else (last, first)
                if docs[x] == docs[y]:
                    continue
                match = min((8 * width - (left[x] ^ left[y]).bit_length()) // 8, near[x], near[y])
                found = {x: match}
            else:
                found = left_matches(list(range(first, last + 1)), docs, left, near, width)
            for x, match in found.items():
                if match >= need:
                    if match > back[x]:
                        back[x] = match
                    if size > forth[x]:
                        forth[x] = size
        hit = np.flatnonzero(forth)
        # Matches at one anchor all hold the anchor: together they are one span.
        found = doc[hit], at[hit] - back[hit], at[hit] + forth[hit]
        if len(hit) or len(known[0]):
            yield _span_packets(buckets, *[np.concatenate(x) for x in zip(found, known)])
    return run


def merged(blobs: list[bytes]) -> np.ndarray:
    """Maximal runs (start, end) of the union of packed spans; runs that touch are one."""
    pairs = np.frombuffer(b"".join(blobs), dtype="<i8").reshape(-1, 2)
    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    cut = np.flatnonzero(pairs[1:, 0] > reach[:-1])
    out = np.empty((len(cut) + 1, 2), dtype=np.int64)
    out[0, 0], out[1:, 0] = pairs[0, 0], pairs[cut + 1, 0]
    out[-1, 1], out[:-1, 1] = reach[-1], reach[cut]
    return out


def squeezed_texts(rows: DataFrame) -> DataFrame:
    """(id, text) with the text as compressed bytes, so that a join by id moves less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([squeezed((x.as_py() or "").encode()) for x in part.column(1)], pa.binary())],
                    ["id", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text binary")


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(document, packed maximal runs) from the spans of a partition."""
    doc, lo, hi = _unpack(batches, ["<i8", "<i8", "<i8"])
    order = np.lexsort((lo, doc))
    doc, pairs = doc[order], np.stack([lo[order], hi[order]], axis=1)
    edges = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, np.int64)
    blobs = [merged([pairs[a:b].tobytes()]).astype("<i8").tobytes() for a, b in zip(edges, np.r_[edges[1:], len(doc)])]
    for k in range(0, len(edges), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(doc[edges[k:k + 10_000]]), pa.array(blobs[k:k + 10_000], pa.binary())],
                                         ["id", "spans"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """id and packed maximal runs of the documents that repeat an earlier one, copies of whole texts aside."""
    ship(docs.sparkSession)
    width = shuffle_width(docs)
    buckets = BUCKETS_PER_PARTITION * width
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sent = rows.mapInArrow(_send_anchors(buckets, length, seed), "bucket int, h binary, doc binary, known boolean")
    # The lists are built after the shuffle: as partial results they would be larger than their rows.
    shared = (sent.repartition(width, "bucket").mapInArrow(_shared_anchors, "id long, h long")
              .repartition(width, "id").groupBy("id").agg(F.collect_list("h").alias("keys")))
    suffixes = squeezed_texts(rows).join(shared, "id").select("id", "text", "keys").mapInArrow(
        _send_suffixes(buckets, length, seed),
        "bucket int, h binary, doc binary, at binary, to_left binary, to_right binary, context binary")
    spans = suffixes.repartition(width, "bucket").mapInArrow(
        _spans(width, length, seed), "bucket int, doc binary, lo binary, hi binary")
    return spans.repartition(width, "bucket").mapInArrow(_by_document, "id long, spans binary")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
          seed: int = SEED, keep_text: bool = False) -> DataFrame:
    """Per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes."""
    marks = docs.filter(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= length)).select(
        F.col(id_col).cast("long").alias("id"), F.sha2(text_col, 256).alias("digest"))
    marks = stored(marks, "digests")
    firsts = stored(marks.groupBy("digest").agg(F.min("id").alias("first")), "firsts")
    copies = marks.join(firsts, "digest").filter("id > first").select("id", F.lit(True).alias("copy")).distinct()
    spans = stored(repeated_spans(docs, id_col, text_col, length, seed), "spans")
    found = spans.join(copies, "id", "full").withColumnRenamed("id", "_id")
    id_type = docs.schema[id_col].dataType
    texts = squeezed_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    rows = (texts.join(found, F.col("id").cast("long") == F.col("_id"), "left").select("id", "text", "spans", "copy"))
    types = f"{id_col} {id_type.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, blobs, copy in zip(*[batch.column(k) for k in (1, 2, 3)]):
                data = unsqueezed(text.as_py())
                if copy.as_py() and len(data) >= length:
                    runs = np.array([[0, len(data)]])
                else:
                    runs = np.minimum(np.frombuffer(blobs.as_py() or b"", dtype="<i8").reshape(-1, 2), len(data))
                kept, at = [], 0
                for lo, hi in runs.tolist():
                    kept.append(data[at:lo])
                    at = hi
                kept = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) or [()] * 5
            arrays = [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                arrays.append(pa.array(columns[4], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, types + (", kept binary" if keep_text else ""))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"))
