"""SentencePiece BPE encoding and decoding that keeps the source offsets.

``Pieces`` reads a ``.model`` file. A text is normalised by the longest prefix that the model's
compiled character map knows at each position (a double-array trie of the replaced strings), with
white space escaped as U+2581; every normalised byte records the source byte its prefix began at.
Merges join the neighbouring pair whose joined piece scores best, leftmost first, until none is a
piece; a character without a piece falls back to byte pieces. Each piece is projected through the
alignment to a span of bytes of the original text: spans are in order, and all but the last of
a character's byte pieces are empty.

In models whose pieces hold U+2581 only at their start (checked when the model is read) no merge
crosses the end of a word, so words are encoded on their own: the distinct words of a batch side
by side, one merge of each word a round, long ones one by one with a bounded cache. Other models
are encoded a whole text at a time with the same result.

Decoding joins the pieces, U+2581 as a space, without the one that was put before the text; runs
of byte pieces become characters, or U+FFFD where they are not UTF-8.

Defined cases: null text is treated as empty; an empty text has no ids and decodes to an empty
text; texts of any length are encoded whole; rows are independent, so repeated rows and ids, null
ids and extra columns are passed through; an empty table gives an empty result. Models that are
not BPE, or have user-defined or unused pieces, are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import read, ship

SPACE = "▁"  # fixed value: the mark of white space in pieces
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces in a model file
WORDS_KEPT = 300_000  # encoded words in each of two caches of a Python worker (bounded caches, not a cap on input)
LONGEST_KEPT = 64  # characters; longer words are encoded afresh
ROWS = 500  # texts encoded at a time
TEXT = 2_000_000  # characters; texts whose words are held at a time (at least one text)
SCANNED = 60  # characters; neighbours of longer words are kept in a heap
BESIDE = 8192  # words merged side by side
NEVER = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or (varint() if key & 7 == 2 else None)
            if size is None:
                raise ValueError("not a model file")
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class CharacterMap:
    """The compiled character map: longest replaced prefix at a position, and what replaces it."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.texts = blob[4 + size:]
        # Bytes a replaced prefix can begin with: the other positions need no walk.
        first = bytes(b for b in range(256) if self._next(self._child(0), b) is not None)
        self.starts = re.compile(b"[" + re.escape(first) + b"]") if first else None

    def _child(self, node: int) -> int:
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def _next(self, base: int, byte: int) -> int | None:
        node = base ^ byte
        return node if node < len(self.units) and self.units[node] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Size of the longest known prefix at a position and its replacement."""
        found, base = None, self._child(0)
        for end in range(at, len(data)):
            node = self._next(base, data[end])
            if node is None:
                break
            base = self._child(node)
            if self.units[node] >> 8 & 1:
                found = end + 1 - at, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1]:self.texts.index(b"\0", found[1])]

    def apply(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The mapped bytes, and for each of them the byte of ``data`` its prefix began at."""
        parts, origin, done, at = [], [], 0, 0
        while self.starts is not None and (hit := self.starts.search(data, at)) is not None:
            at = hit.start()
            known = self.longest(data, at)
            if known is None:
                at += 1
                while at < len(data) and data[at] & 0xC0 == 0x80:
                    at += 1
                continue
            parts += [data[done:at], known[1]]
            origin += [np.arange(done, at), np.full(len(known[1]), at)]
            at = done = at + known[0]
        parts.append(data[done:])
        origin.append(np.arange(done, len(data)))
        return b"".join(parts), np.concatenate(origin)


class PairTable:
    """Neighbouring pieces that join: a hash table with open addressing, looked up for many pairs at once."""

    NONE = np.iinfo(np.int64).max

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        self.bits = max(8, int(len(left) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, self.NONE, dtype=np.int64)
        key = left.astype(np.int64) << 32 | right
        slot = self._slots(key)
        while len(key):  # of the pairs that ask for a free slot one gets it, the others try the next
            free = np.flatnonzero(self.keys[slot] == -1)
            self.keys[slot[free]] = key[free]
            got = self.keys[slot] == key
            self.values[slot[got]] = value[got]
            key, value, slot = key[~got], value[~got], (slot[~got] + 1) & ((1 << self.bits) - 1)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The values of the pairs, NONE where a pair does not join."""
        key = left << 32 | right
        slot = self._slots(key)
        there = self.keys[slot]
        out = np.where(there == key, self.values[slot], self.NONE)
        more = np.flatnonzero((there != key) & (there != -1))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[more]]
            hit = there == key[more]
            out[more[hit]] = self.values[slot[more[hit]]]
            more = more[~hit & (there != -1)]
        return out


class Pieces:
    """A BPE model: normalisation with alignment, merges by score, byte fallback, decoding."""

    def __init__(self, data: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                pieces.append(dict(_fields(value)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        kinds = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3, 1) != 2 or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.get(24, 0):
            raise ValueError("only BPE models without user-defined or unused pieces are supported")
        names = [p[1].decode() for p in pieces]
        self.ids = {n: i for i, (n, k) in enumerate(zip(names, kinds)) if k == NORMAL}
        self.cost = {n: -struct.unpack("<f", pieces[i].get(2, b"\0\0\0\0"))[0] for n, i in self.ids.items()}
        self.unknown = kinds.index(UNKNOWN)
        fallback = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(names, kinds)) if k == BYTE}
        self.fallback = [fallback[b] for b in range(256)] if trainer.get(35, 0) else None
        self.prefix, self.squeeze = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        self.space = SPACE if normaliser.get(5, 1) else " "
        self.map = CharacterMap(normaliser[2]) if normaliser.get(2) else None
        self.by_word = all(self.space not in n.lstrip(self.space) for n in self.ids)
        self.words = re.compile(f"{self.space}+[^{self.space}]*|[^{self.space}]+").findall
        self.beside = {n[i:i + 2] for n in self.ids for i in range(len(n) - 1)}
        self.packed = {n: struct.pack("<I", i) for n, i in self.ids.items()}
        self.decimal = [str(i) for i in range(len(names))]
        self.raw = np.full(len(names), -1)  # the byte of a byte piece
        self.raw[list(fallback.values())] = list(fallback)
        self.width = np.array([len(n.encode()) if k == NORMAL else 0 for n, k in zip(names, kinds)], np.int64)
        self.kinds, self.names, self.kind = kinds, names, np.array(kinds, np.int8)
        surface = trainer.get(44, " ⁇ ".encode())
        self.label = [{CONTROL: b"", UNKNOWN: surface, BYTE: bytes([max(self.raw[i], 0)])}.get(
            k, n.replace(SPACE, " ").encode()) for i, (n, k) in enumerate(zip(names, kinds))]
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the cache before it was full last
        if self.by_word and self.fallback is not None:
            self._tables()

    def _tables(self) -> None:
        """Tables for merging many words at once: codes of characters, and what pairs of pieces join to.

        A character's code is its piece; beyond the pieces if none holds it, -1 if only longer ones do.
        """
        ids = self.ids
        self.characters = np.arange(0x110000) + len(self.names) + 1
        self.characters[[ord(c) for c in set().union(*ids)]] = -1
        for n, i in ids.items():
            if len(n) == 1:
                self.characters[ord(n)] = i
        # Pieces of equal cost have equal ranks: the leftmost of them is joined first.
        costs = np.array([self.cost[n] for n in ids])
        rank = np.unique(costs, return_inverse=True)[1].tolist()
        pairs = [(a, b, r << 32 | i) for (n, i), r in zip(ids.items(), rank) for k in range(1, len(n))
                 if (a := ids.get(n[:k])) is not None and (b := ids.get(n[k:])) is not None]
        self.pairs = PairTable(*np.array(pairs, dtype=np.int64).reshape(-1, 3).T)

    # --- normalisation -------------------------------------------------------------------
    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the source byte of each of its UTF-8 bytes and of its end."""
        data = text.encode()
        n = len(data)
        if self.map is None:
            origin = np.arange(n)
        else:
            data, origin = self.map.apply(data)
        byte = np.frombuffer(data, np.uint8)
        if self.squeeze:  # of neighbouring blanks the first stays, none at the start
            blank = byte == 0x20
            keep = ~blank
            keep[1:] |= blank[1:] & ~blank[:-1]
            byte, origin = byte[keep], origin[keep]
        if not len(byte):
            return "", np.array([n])
        wide = len(self.space.encode())
        align = np.concatenate([np.repeat(origin, np.where(byte == 0x20, wide, 1)), [n]])
        norm = byte.tobytes().decode().replace(" ", self.space)
        if self.prefix:
            norm, align = self.space + norm, np.concatenate([np.full(wide, align[0]), align])
        if self.squeeze:  # marks at the end go, and are no part of the last piece
            short = norm.rstrip(self.space)
            align = align[:len(align) - wide * (len(norm) - len(short))]
            norm = short
        return norm, align

    # --- merges ----------------------------------------------------------------------------
    def _merge(self, word: str) -> list[str]:
        """Pieces of a word: the best-scoring neighbours are joined first, leftmost on ties."""
        if len(word) > SCANNED:
            return self._merge_long(word)
        part, cost = list(word), self.cost
        costs = [cost.get(a + b, NEVER) for a, b in zip(part, part[1:])]
        while costs and (best := min(costs)) is not NEVER:
            i = costs.index(best)
            joined = part[i] = part[i] + part.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = cost.get(joined + part[i + 1], NEVER)
            if i:
                costs[i - 1] = cost.get(part[i - 1] + joined, NEVER)
        return part

    def _merge_long(self, word: str) -> list[str]:
        """The same with a heap of neighbours, for words in which a scan for each merge is slow."""
        part: list[str | None] = list(word)
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        cost = self.cost
        heap = [(c, i, word[i:i + 2]) for i in range(n - 1) if (c := cost.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if j >= n or len(part[i]) + len(part[j]) != len(joined) or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, None
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if (c := cost.get(both := joined + part[j])) is not None:
                    heapq.heappush(heap, (c, i, both))
            h = before[i]
            if h >= 0 and (c := cost.get(both := part[h] + joined)) is not None:
                heapq.heappush(heap, (c, h, both))
        return [p for p in part if p is not None]

    def _merge_all(self, code: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for many words at once: codes of their characters and their sizes in, of their pieces out.

        Place p of all words is row p; a row without pieces on either side ends every word. A pair is
        kept at its left place as rank, place and joined piece in one number: the least is next.
        """
        n, rows = len(size), int(size.max()) + 2
        none, end = PairTable.NONE, len(self.names)
        part = np.full((rows, n), end, dtype=np.int64)
        word = np.repeat(np.arange(n), size)
        part[np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size) + 1, word] = code
        best = np.full((rows, n), none, dtype=np.int64)
        found = self.pairs.get(part[:-1].reshape(-1), part[1:].reshape(-1))
        best[:-1] = found.reshape(rows - 1, n) | (np.arange(rows - 1) << 24)[:, None]
        after = np.repeat(np.arange(1, rows + 1, dtype=np.int64), n)
        before = np.repeat(np.arange(-1, rows - 1, dtype=np.int64), n)
        live, part = np.arange(n), part.reshape(-1)
        while True:
            least = best.min(axis=0)
            some = np.flatnonzero(least != none)
            if not len(some):
                break
            if len(some) < len(live):
                best, least, live = best[:, some], least[some], live[some]
            at, joined = (least >> 24) & 0xFF, least & 0xFFFFFF
            here = at * n + live
            gone = after[here]
            there = gone * n + live
            right, left = after[there], before[here]
            part[here], part[there] = joined, -1
            after[here] = right
            before[right * n + live] = at
            column = np.arange(len(live))
            found = self.pairs.get(np.concatenate([part[left * n + live], joined]),
                                   np.concatenate([joined, part[right * n + live]]))
            best[gone, column] = none
            best[left, column] = found[:len(live)] | left << 24
            best[at, column] = found[len(live):] | at << 24
        part = part.reshape(rows, n).T
        kept = (part >= 0) & (part != end)  # not joined to the left, not beyond the word
        return part[kept], kept.sum(axis=1)

    def known(self, texts: list[list[str]]) -> dict[str, bytes]:
        """Packed ids of all words of some texts."""
        words = set().union(*texts)
        out = self._side_by_side([w for w in words if len(w) <= SCANNED]) if self.by_word else {}
        get, encode = self.cache.get, self._ids
        out.update({w: get(w) or encode(w) for w in words.difference(out)})
        return out

    def _side_by_side(self, words: list[str]) -> dict[str, bytes]:
        """The same for short words, without those of characters that pieces hold but that are none."""
        out, end = {}, len(self.names)
        words.sort(key=len)
        for lo in range(0, len(words), BESIDE):
            some = words[lo:lo + BESIDE]
            size = np.array([len(w) for w in some])
            code = self.characters[np.frombuffer("".join(some).encode("utf-32-le"), "<u4")]
            fit = np.minimum.reduceat(code, np.cumsum(size) - size) >= 0
            if not fit.all():
                some = list(itertools.compress(some, fit))
                code, size = code[np.repeat(fit, size)], size[fit]
            if not some:
                continue
            code, size = self._merge_all(code, size)
            unknown = code > end
            if unknown.any():  # as many byte pieces as the character has bytes
                lone = (code[unknown] - end - 1).astype("<u4")
                wide = np.ones(len(code), dtype=np.int64)
                wide[unknown] += np.searchsorted([0x80, 0x800, 0x10000], lone, "right")
                size = np.add.reduceat(wide, np.cumsum(size) - size)
                code = np.repeat(code, wide)
                raw = np.frombuffer(lone.tobytes().decode("utf-32-le").encode(), np.uint8)
                code[code > end] = np.array(self.fallback)[raw]
            packed, ends = code.astype("<u4").tobytes(), (4 * np.cumsum(size)).tolist()
            out.update(zip(some, [packed[a:b] for a, b in zip([0, *ends], ends)]))
        return out

    def _ids(self, word: str) -> bytes:
        """Packed ids of a word that is not in the cache."""
        if (known := self.before.get(word)) is not None:
            self._keep(word, known)
            return known
        ids = []
        for part in self._parts(word):
            found = self.cache.get(part) or self.before.get(part)
            if found is None:
                pieces = self._merge(part)
                try:
                    found = b"".join([self.packed[p] for p in pieces])
                except KeyError:
                    found = b"".join([self._piece(p) for p in pieces])
                self._keep(part, found)
            ids.append(found)
        packed = b"".join(ids)
        if len(ids) != 1:
            self._keep(word, packed)
        return packed

    def _parts(self, word: str) -> list[str]:
        """A word cut between neighbours that no piece holds side by side: no merge crosses a cut."""
        cuts = [i for i, pair in enumerate(map(str.__add__, word, word[1:]), 1) if pair not in self.beside]
        return [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def _piece(self, piece: str) -> bytes:
        known = self.packed.get(piece)
        if known is None and self.fallback is not None:
            return np.array([self.fallback[b] for b in piece.encode()], "<u4").tobytes()
        return known or struct.pack("<I", self.unknown)

    def _keep(self, word: str, ids: bytes) -> None:
        if len(word) <= LONGEST_KEPT:
            if len(self.cache) >= WORDS_KEPT:
                self.before, self.cache = self.cache, {}
            self.cache[word] = ids

    def _sizes(self, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes of every piece; a character's byte pieces are empty but for the last."""
        sizes = self.width[ids]
        raw = self.raw[ids]
        if (raw >= 0).any():
            lead = np.flatnonzero((raw >= 0) & (raw & 0xC0 != 0x80))
            wide = np.searchsorted([0x80, 0xE0, 0xF0], raw[lead], "right") + 1  # bytes by the first of them
            sizes[lead + wide - 1] = wide
        return sizes

    def encode(self, text: str) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """Decimal ids joined by commas, the ids, and start and end byte of every piece in the text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """The same for each of several texts, about TEXT characters at a time."""
        lo = 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and (size := size + len(texts[hi])) <= TEXT:
                hi += 1
            some = [self.normalise(text) for text in texts[lo:hi]]
            words = [self.words(norm) if self.by_word else [norm] if norm else [] for norm, _ in some]
            known = self.known(words) if self.fallback is not None else {}
            yield from (self._encoded(*n, w, known) for n, w in zip(some, words))
            lo = hi

    def _encoded(self, norm: str, align: np.ndarray, words: list[str],
                 known: dict[str, bytes]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        if self.fallback is not None:
            ids = np.frombuffer(b"".join([known[w] for w in words]), "<u4")
            size = self._sizes(ids)
        else:  # neighbouring unknown characters are one piece, over the ends of words too
            found = [(p, self.ids.get(p, self.unknown)) for p in (self._merge(norm) if norm else [])]
            joined = [(i, sum(len(p.encode()) for p, _ in run)) for (i, _), run in itertools.groupby(
                found, lambda f, n=itertools.count(): (f[1], 0 if f[1] == self.unknown else next(n) + 1))]
            ids, size = np.array([j[0] for j in joined], "<u4"), np.array([j[1] for j in joined], np.int64)
        hi = np.cumsum(size)
        decimal = self.decimal
        return ",".join([decimal[i] for i in ids.tolist()]), ids, align[hi - size], align[hi]

    # --- decoding ----------------------------------------------------------------------------
    def decode(self, ids: np.ndarray) -> str:
        """The text of ids."""
        # A control piece, which has no text, ends a run of byte pieces.
        broken = (self.kind[ids] == CONTROL).any()
        ids = ids.tolist()
        label, kinds = self.label, self.kinds
        parts = [label[i] for i in ids]
        if self.prefix or self.squeeze:
            for k, i in enumerate(ids):  # one space before the text goes (all, where blanks are squeezed)
                if kinds[i] == CONTROL:
                    continue
                if kinds[i] != NORMAL or not self.names[i].startswith(SPACE):
                    break
                parts[k] = parts[k][1:]
                if parts[k] or not self.squeeze:
                    break
        try:
            return self._decode_runs(ids, parts) if broken else b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> str:
        """Runs of byte pieces on their own: each byte that starts no character is U+FFFD."""
        out, run = [], bytearray()
        for i, part in zip([*ids, -1], [*parts, b""]):
            if i >= 0 and self.kinds[i] == BYTE:
                run += part
                continue
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + size]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                at += size
            run.clear()
            out.append(part.decode())
        return "".join(out)


_loaded: dict[int, Pieces] = {}


def model(packed: bytes) -> Pieces:
    """The model of a compressed file, read once per Python worker."""
    key = zlib.crc32(packed)
    if key not in _loaded:
        _loaded[key] = Pieces(zlib.decompress(packed))
    return _loaded[key]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_pieces: bool = True, keep_text: bool = False) -> DataFrame:
    """One row per input row: the id column, n_tokens and the digests of ids, spans and decoded text.

    ``path`` is a SentencePiece ``.model`` file; the driver reads it and broadcasts its bytes,
    whose size is fixed by the model and checked (64 MB at most). ``keep_pieces`` adds the ids and
    the start and end bytes of the pieces (arrays), ``keep_text`` the decoded text. The spans'
    digest is that of start and end of every piece as little-endian unsigned 32-bit integers.
    """
    ship(docs.sparkSession)
    with open(path, "rb") as f:
        packed = zlib.compress(f.read())
    if len(packed) > 64 << 20:
        raise ValueError("the model file is too large to broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("spans_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    if keep_pieces:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())),
                   T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))]
    if keep_text:
        fields.append(T.StructField("decoded", T.StringType()))

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = [[] for _ in fields[1:]]
                for joined, ids, lo, hi in m.encode_all([text or "" for text in part.column(1).to_pylist()]):
                    back = m.decode(ids)
                    row = [len(ids), sha(joined.encode()), sha(np.array([lo, hi], "<u4").T.tobytes()), sha(back.encode())]
                    row += [ids.astype(np.int32), lo, hi] if keep_pieces else []
                    for column, value in zip(out, row + ([back] if keep_text else [])):
                        column.append(value)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
                kinds += [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())] if keep_pieces else []
                kinds += [pa.string()] if keep_text else []
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], [f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, T.StructType(fields))


def production_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"), production_model(), keep_pieces=False)
