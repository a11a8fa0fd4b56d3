"""SentencePiece encoding against the library: ids, source spans, decoding, compiled character maps."""

import hashlib
import random
import struct

import numpy as np
import pytest

from shelfspark.llm import pieces
from tests.llm.fixtures import documents, no_documents, rows

sentencepiece = pytest.importorskip("sentencepiece")


def message(field: int, data: bytes) -> bytes:
    size, out = len(data), bytearray([field << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes(out) + bytes([size]) + data


def with_normaliser(model: bytes, spec: bytes) -> bytes:
    """The model with another normaliser (field 3 of the file)."""
    kept = b"".join(message(f, v) for f, v in pieces._fields(model) if f in (1, 2))
    return kept + message(3, spec)


def odd_texts() -> list[str]:
    rnd = random.Random(3)
    out = [r[1] or "" for r in rows()]
    alphabet = "abcdetshinr  \n\t'éß漢😀▁.,!0123=-_#*<s>\u0000​　ﬁ①ｱﾞé ﷺ"
    out += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return out + [" ", "   ", "a  b", " a", "a ", "  a  b  ", "▁", "<s>", "<0x0A>", "<unk>", " " * 100 + "x" + " " * 33,
                  "x" * 5000, "漢字" * 2000, "a" * 300 + "▁" * 50]


def same_as_library(model: bytes, texts: list[str]) -> None:
    own, library = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in texts:
        joined, ids, lo, hi = own.encode(text)
        want = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in want], text
        assert joined == ",".join(str(p.id) for p in want)
        assert own.decode(ids) == library.decode(ids.tolist()), text
        if text.strip(" "):
            assert list(zip(lo.tolist(), hi.tolist())) == [(p.begin, p.end) for p in want], text


def model_file() -> bytes:
    with open(pieces.production_model(), "rb") as f:
        return f.read()


def test_encoding_equals_the_library():
    same_as_library(model_file(), odd_texts())


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("flags", [b"\x18\x01\x20\x01", b"\x18\x00\x20\x00", b"\x18\x01\x20\x00"])
def test_character_map_and_alignment_equal_the_library(rule, flags):
    """flags: dummy prefix and removal of extra white space, on or off."""
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    blob = dict(pieces._fields(normaliser.serialized_normalizer_spec()))[2]
    same_as_library(with_normaliser(model_file(), message(1, b"own") + message(2, blob) + flags), odd_texts())


def test_decoding_of_any_ids_equals_the_library():
    own, library = pieces.Pieces(model_file()), sentencepiece.SentencePieceProcessor(model_proto=model_file())
    rnd = random.Random(9)
    for _ in range(3000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(3), rnd.randrange(3, 259), rnd.randrange(259, 262), 28705])
               for _ in range(rnd.randint(0, 12))]
        assert own.decode(np.array(ids, "<u4")) == library.decode(ids)


def test_words_of_a_batch_are_merged_side_by_side(monkeypatch):
    """Rare words, characters without pieces and cuts between texts; no short word is merged on its own."""
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice("aehnrstäß.,%0\n漢\u0378😀") for _ in range(rnd.randint(1, 59))) for _ in range(40))
             for _ in range(200)] + odd_texts()[-300:]
    own, library = pieces.Pieces(model_file()), sentencepiece.SentencePieceProcessor(model_proto=model_file())
    alone, merged = [], own._merge
    monkeypatch.setattr(own, "_merge", lambda word: alone.append(word) or merged(word))
    monkeypatch.setattr(pieces, "TEXT", 20_000)
    monkeypatch.setattr(pieces, "BESIDE", 100)
    found = list(own.encode_all(texts))
    assert [ids.tolist() for _, ids, _, _ in found] == [library.encode(t) for t in texts]
    assert [(lo.tolist(), hi.tolist()) for _, _, lo, hi in found[:200]] == [
        tuple(map(list, zip(*[(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]))) for t in texts[:200]]
    # Longer words are cut where no piece holds two neighbours: only their parts are merged alone.
    long = {w for t in texts for w in own.words(own.normalise(t)[0]) if len(w) > pieces.SCANNED}
    assert all(any(part in w for w in long) for part in alone)


def test_equal_scores_are_joined_leftmost_first():
    """A small model of equal scores, in which one longer piece holds a character that is no piece."""
    rnd = random.Random(8)
    names = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), pieces.SPACE, *"abc"]
    names += sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 4))) for _ in range(40)}) + [pieces.SPACE + "a", "xa", "xab"]
    kinds = [2] + [6] * 256 + [1] * (len(names) - 257)
    scores = [0.0] * 257 + [-float(rnd.randint(1, 3)) for _ in names[257:]]
    model = b"".join(message(1, message(1, n.encode()) + b"\x15" + struct.pack("<f", s) + bytes([0x18, k]))
                     for n, k, s in zip(names, kinds, scores))
    # BPE with byte fallback; an unknown piece only besides.
    model += message(2, b"\x18\x02" + b"\x98\x02\x01" + b"\xd0\x02" + b"\xff" * 9 + b"\x01" + b"\xc8\x02" + b"\xff" * 9 + b"\x01")
    model += message(3, message(1, b"identity"))
    same_as_library(model, ["".join(rnd.choice("abcabcabcx z") for _ in range(rnd.randint(0, 90))) for _ in range(1500)])


def test_pairs_are_found_in_a_crowded_table():
    rnd = random.Random(1)
    known = {(rnd.randrange(60), rnd.randrange(60)): k for k in range(900)}
    table = pieces.PairTable(*np.array([(a, b, v) for (a, b), v in known.items()], dtype=np.int64).T)
    a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(70), np.arange(70)))
    assert table.get(a, b).tolist() == [known.get(p, pieces.PairTable.NONE) for p in zip(a.tolist(), b.tolist())]


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.Pieces(message(1, message(1, b"a") + b"\x18\x04") + message(2, b"\x18\x02"))


def test_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=model_file())
    out = pieces.encode_documents(documents(spark), pieces.production_model(), keep_text=True).collect()
    assert len(out) == len(rows())
    texts = {r[0]: r[1] or "" for r in rows()}
    for r in out:
        text = texts[r["doc_id"]]
        want = library.encode(text)
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["decoded"] == library.decode(want) == text
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        # Spans follow one another and cover the text.
        assert r["starts"][1:] == r["ends"][:-1] and (r["starts"][:1], r["ends"][-1:]) == (([0], [len(text.encode())]) if text else ([], []))
    assert pieces.encode_documents(no_documents(spark), pieces.production_model()).count() == 0
