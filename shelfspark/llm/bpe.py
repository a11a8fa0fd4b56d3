"""BPE encoding and decoding with a tokenization automaton.

``Automaton`` starts from the one-state machine that accepts every byte string and applies one
gadget per merge, in rank order. The gadget for ``u v -> w`` splits the state that ``u`` leads
to: arcs labelled ``u`` now end in a copy without its ``v`` arc, and every state with a ``u``
arc gets a ``w`` arc that ends where ``v`` led from the split state. What is left after the last
merge accepts exactly the correct tokenizations. All states come from splitting the first one, and
a label's arcs end in one state, so a state is named by the label that leads to it and stored as
its differences: the arc each gadget took from it and when, and for a merged label the state it
shared until it was split itself. The 50,000 gadgets cost 50,000 small records instead of
50,000 rows of 50,000 arcs; ``has_arc`` reads the table of a state through them.

Encoding walks a pre-split word: the byte trie of the token labels (a transition table) finds
the longest label at a position, and the automaton state reached so far has an arc for it or
not. A word has exactly one accepted path, so the first walk that reaches its end is the answer.
Decoding concatenates the arc labels of the ids.

Defined cases: null text is treated as empty; an empty text has no ids and decodes to an empty
text; texts of any length are encoded whole, word by word; rows are independent, so repeated
rows and ids, null ids and extra columns are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import read, ship

# Fixed value: the public pattern that splits a text before byte-level merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORDS_KEPT = 400_000  # encoded words kept per Python worker (a bounded cache, not a cap on input)
ROWS = 500  # texts encoded at a time
LONGEST_KEPT = 64  # characters; longer words are encoded afresh


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Deterministic tokenization automaton of a merge list.

    ``labels``: byte string of every token id; ``merges``: (left id, right id, merged id) in rank order.
    """

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        self.born: dict[int, int] = {}  # rank of the gadget that made a token's arcs
        self.parts: dict[int, tuple[int, int]] = {}
        self.lost: dict[int, int] = {}  # label u and the arc v its copied state lost: rank of the gadget
        for rank, (u, v, w) in enumerate(merges):
            # The copy loses its arc before the w arcs are added: with u = v it gets none.
            self.lost.setdefault(u << 20 | v, rank)
            if w not in self.born:  # a repeated label keeps its first gadget
                self.born[w], self.parts[w] = rank, (u, v)
        self._index()

    def _index(self) -> None:
        """Byte trie of the labels as a transition table, label sizes and shorter labels."""
        labels = [t for t, b in self.labels.items() if len(b) == 1 or t in self.parts]
        self.step: dict[int, int] = {}
        self.accept: dict[int, int] = {}
        nodes = 1
        for t in labels:
            node = 0
            for b in self.labels[t]:
                key = node << 8 | b
                node = self.step.get(key)
                if node is None:
                    node = self.step[key] = nodes
                    nodes += 1
            self.accept[node] = t
        self.size = {t: len(self.labels[t]) for t in labels}
        self.shorter: dict[int, int] = {}  # the longest label that is a proper prefix of a label
        for t in labels:
            node, best = 0, None
            for b in self.labels[t][:-1]:
                node = self.step[node << 8 | b]
                best = self.accept.get(node, best)
            if best is not None:
                self.shorter[t] = best
        self.arcs: dict[int, bool] = {}

    def has_arc(self, label: int, token: int) -> bool:
        """Whether the state that ``label`` leads to has an arc for ``token`` after the last gadget."""
        key = label << 20 | token
        known = self.arcs.get(key)
        if known is None:
            known = self._arc(label, token)
            if len(self.arcs) < 4_000_000:
                self.arcs[key] = known
        return known

    def _arc(self, label: int, token: int) -> bool:
        """A merged token's arc stands where its left part's arc stood when its gadget ran."""
        lost, born, parts = self.lost, self.born, self.parts
        upto = 1 << 60
        while True:
            state, until = label, 1 << 60
            while True:
                rank = lost.get(state << 20 | token)
                if rank is not None and rank < until and rank <= upto:
                    return False
                # Until it is split itself, w shares the state that v led to when w was made.
                if state not in parts:
                    break
                until = min(until, born[state])
                state = parts[state][1]
            if token not in parts:
                return True
            upto = born[token]
            token = parts[token][0]

    def encode(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word.

        Takes the longest label at each position that is an arc of the state, then shorter ones,
        and steps back where no label fits. A position that was stepped back from is not on the
        word's only accepted path and is not entered again, so the walk is linear in the word.
        """
        n = len(word)
        size, shorter, has_arc, longest = self.size, self.shorter, self.has_arc, self._longest
        ids: list[int] = []
        dead: set[int] = set()
        at, state = 0, -1  # -1: the first state, which has every arc
        token = longest(word, 0, n)
        while at < n:
            end = at + size[token]
            if end not in dead and (state < 0 or has_arc(state, token)):
                ids.append(token)
                at, state = end, token
                if at < n:
                    token = longest(word, at, n)
                continue
            token = shorter.get(token)
            while token is None:  # no label fits here: step back and shorten the token before
                dead.add(at)
                last = ids.pop()
                at -= size[last]
                state = ids[-1] if ids else -1
                token = shorter.get(last)
        return ids

    def _longest(self, word: bytes, at: int, n: int) -> int:
        """The longest label that starts at a position of the word."""
        node, token, step, accept = 0, -1, self.step, self.accept
        for j in range(at, n):
            node = step.get(node << 8 | word[j])
            if node is None:
                break
            token = accept.get(node, token)
        return token


class Tokenizer:
    """Byte-level BPE of a vocabulary file: added tokens, pre-splitting, automaton, decoding."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without a normalizer or prefix space is supported")
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        labels = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items()
                  if all(c in alphabet for c in s)}
        merges = []
        for m in model["merges"]:
            left, right = m.split(" ") if isinstance(m, str) else m
            merges.append((vocab[left], vocab[right], vocab[left + right]))
        self.automaton = Automaton(labels, merges)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = labels | {i: s.encode() for s, i in self.added.items()}
        self.split_added = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.find = regex.compile(SPLIT).findall
        self.cache: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = struct.pack(f"<{len(found := self.automaton.encode(word.encode()))}I", *found)
        if len(word) <= LONGEST_KEPT:
            if len(self.cache) >= WORDS_KEPT:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out = []
        parts = [text] if self.split_added is None else self.split_added.split(text)
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part].to_bytes(4, "little"))
                continue
            get, word = self.cache.get, self._word
            out.extend([get(w) or word(w) for w in self.find(part)])
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_loaded: dict[int, Tokenizer] = {}


def tokenizer(packed: bytes) -> Tokenizer:
    """The tokenizer of a compressed vocabulary file, compiled once per Python worker."""
    key = zlib.crc32(packed)
    if key not in _loaded:
        _loaded[key] = Tokenizer(zlib.decompress(packed))
    return _loaded[key]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                     text_col: str = "text", keep_ids: bool = True, keep_text: bool = False) -> DataFrame:
    """One row per input row: the id column, n_tokens and both digests.

    ``vocabulary`` is the path of a byte-level BPE ``tokenizer.json``; the driver reads it and
    broadcasts its bytes, whose size is fixed by the vocabulary and checked (64 MB at most).
    ``keep_ids`` adds the ids (packed binary), ``keep_text`` the decoded text.
    """
    ship(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        packed = zlib.compress(f.read())
    if len(packed) > 64 << 20:
        raise ValueError("the vocabulary file is too large to broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    if keep_text:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                ids = [t.encode(x.as_py() or "") for x in part.column(1)]
                back = [t.decode(x) for x in ids]
                columns = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                           pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                           pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string())]
                if keep_ids:
                    columns.append(pa.array(ids, pa.binary()))
                if keep_text:
                    columns.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, T.StructType(fields))


def production_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(read(spark, sf_dir, "documents"), production_vocabulary(), keep_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
