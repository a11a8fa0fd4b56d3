"""Dedup operators against brute force, with awkward rows and empty tables."""

import collections
import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest

from shelfspark.llm import compact_windows, near_dedup, substring_dedup
from shelfspark.llm.common import mix64, shingles, word_hashes
from shelfspark.llm.components import components
from tests.llm.fixtures import changed, documents, no_documents, rows, words


def test_word_hashes_follow_the_word_rule():
    text = "A b\tc\x0bd\x0ce\rf\ng   h é\x85ü"
    data = text.encode()
    _, start, end = word_hashes(data)
    assert [data[a:b] for a, b in zip(start, end)] == data.split()
    assert [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)] == data.split()
    h, _, _ = word_hashes(b"same Same other same")
    assert h[0] == h[1] == h[3] != h[2]
    assert len(shingles(h, 5)) == 1 and len(shingles(h, 3)) == 2 and len(shingles(h[:0], 3)) == 0


# --- components ------------------------------------------------------------------------------
def test_components_match_union_find(spark):
    rnd = random.Random(4)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(230)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (2000, 2001), (2001, 2000), (2000, 2001)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- near duplicates -----------------------------------------------------------------------------
def brute_near(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset(
            [tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows(frame, **kw):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
            for r in near_dedup.near_duplicates(frame, **kw).collect()}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, width, percent):
    docs = [r[:2] for r in rows() if r[0] is not None]
    center = words(50, 150)
    docs += [(100 + k, " ".join(changed(center, 500 + k, 0.002 * (k % 30)))) for k in range(90)]     # a group with a fringe
    docs += [(300 + k, " ".join(center[:150 - 2 * k])) for k in range(40)]                             # truncated copies
    tail = words(51, 12)
    docs += [(400 + k, " ".join(center[:138] + tail[:12 - k % 3])) for k in range(9)]                  # with a common change
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute_near(docs, width, percent)
    got = near_rows(frame, width=width, percent=percent)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_near_duplicates_awkward_tables(spark):
    out = near_dedup.near_duplicates(documents(spark), width=3, percent=85).collect()
    assert len(out) == len(rows())
    by = {r["doc_id"]: r for r in out}
    assert by[None]["component_id"] is None and by[None]["kept"]
    for i in (10, 11, 12):
        assert (by[i]["n_shingles"], by[i]["component_id"], by[i]["kept"]) == (0, i, True)
    assert by[14]["component_id"] == 13 and by[21]["component_id"] == 20 and by[2]["component_id"] == 1
    assert near_dedup.near_duplicates(no_documents(spark)).count() == 0


# --- exact substrings ------------------------------------------------------------------------------
def brute_substrings(docs, length):
    first = {}
    for i, t in docs:
        data = (t or "").encode()
        for k in range(len(data) - length + 1):
            w = data[k:k + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in docs:
        data = (t or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - length + 1):
            if first[data[k:k + length]] < i:
                gone[k:k + length] = True
        edge = np.diff(np.r_[0, gone.astype(int), 0])
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        out[i] = (len(data), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK", 700)        # long texts are cut into several blocks
    rnd = random.Random(6)
    docs = [r[:2] for r in rows() if r[0] is not None and r[0] != 19]
    pool = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(45, 90))) for _ in range(12)]
    docs += [(100 + k, "".join(rnd.choice(pool) + "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 9)))
                               for _ in range(rnd.randint(1, 8)))) for k in range(60)]
    docs += [(200, "a" * 49), (201, "a" * 50), (202, "a" * 51), (203, "é" * 30), (204, "é" * 30 + "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.dedup(frame).collect()}
    assert got == brute_substrings(docs, 50)


def test_substring_dedup_awkward_tables(spark):
    out = substring_dedup.dedup(documents(spark), keep_text=True).collect()
    assert len(out) == len(rows())
    for r in out:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        if r["n_removed"] == 0:
            assert bytes(r["kept"]).decode() == (dict(x[:2] for x in rows())[r["doc_id"]] or "")
    assert substring_dedup.dedup(no_documents(spark)).count() == 0


def test_interval_tree_lists_all_groups():
    suffixes = sorted(["banana"[i:] for i in range(6)] + ["bandana"[i:] for i in range(7)])
    lcp = [0] + [next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
                 for x, y in zip(suffixes, suffixes[1:])]
    nodes = set(substring_dedup.intervals(lcp, 1))
    want = set()
    for i in range(len(suffixes)):
        for j in range(i + 1, len(suffixes)):
            size = min(lcp[i + 1:j + 1])
            if size and (i == 0 or lcp[i] < size) and (j + 1 == len(suffixes) or lcp[j + 1] < size):
                want.add((size, i, j))
    assert nodes == want


# --- compact windows ---------------------------------------------------------------------------------
def test_compact_windows_are_the_large_cartesian_nodes():
    rng = np.random.default_rng(0)
    for case in range(20):
        seqs = [rng.integers(0, 30 if case % 2 else 2 ** 62, rng.integers(1, 60)).astype(np.uint64) for _ in range(4)]
        got = set(zip(*[x.tolist() for x in compact_windows.compact_windows(seqs, 7)]))
        want = set()
        for k, s in enumerate(seqs):
            for i in range(compact_windows.HASHES):
                v = np.maximum(((s * compact_windows.FACTOR[i] + compact_windows.SHIFT[i]) >> np.uint64(32)).astype(np.uint32), 1)
                for c in range(len(v)):
                    lo = hi = c
                    while lo > 0 and v[lo - 1] > v[c]:
                        lo -= 1
                    while hi + 1 < len(v) and v[hi + 1] >= v[c]:
                        hi += 1
                    if hi - lo + 1 >= 7:
                        want.add((k, i, int(mix64(s[c:c + 1] + np.uint64(i))[0]), lo, c, hi))
        assert got == want


def test_passages_are_found_and_clean_documents_left_alone(spark):
    rnd = random.Random(8)
    docs = {i: words(1000 + i, rnd.randint(60, 300)) for i in range(60)}
    shared = {k: words(2000 + k, 60) for k in range(4)}
    groups = collections.defaultdict(set)
    for i in range(0, 40):
        k = i % 4
        passage = shared[k] if i % 3 else changed(shared[k], 3000 + i, 0.005)
        at = rnd.randrange(len(docs[i]))
        docs[i] = docs[i][:at] + passage + docs[i][at:]
        groups[k].add(i)
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()] + [(90, None), (91, ""), (None, "x")],
                                  "doc_id long, text string")
    pairs, classes = compact_windows.passages(frame)
    out = {r["doc_id"]: r for r in compact_windows.summary(frame, pairs, classes).collect()}
    assert len(out) == 63
    for k, members in groups.items():
        exact = {i for i in members if i % 3}
        assert len({out[i]["class_id"] for i in exact}) == 1
    for i in [*range(40, 60), 90, 91]:
        assert out[i]["class_id"] == i and out[i]["partners"] == [] and out[i]["spans"] == ""
    for i in range(40):
        assert all(j % 4 == i % 4 for j in out[i]["partners"])      # no false partner
        for span in filter(None, out[i]["spans"].split(",")):
            a, b = map(int, span.split(":"))
            assert b - a >= compact_windows.LEAST


def windows_of(text):
    """Values of a text's compact windows, by hash function."""
    seq = shingles(word_hashes(text.encode())[0], compact_windows.WIDTH)
    _, row, key, *_ = compact_windows.compact_windows([seq], compact_windows.LEAST - compact_windows.WIDTH + 1)
    return collections.defaultdict(set, {r: set(key[row == r].tolist()) for r in range(compact_windows.HASHES)})


def test_links_between_members_with_other_hubs_are_found(spark):
    """Two near copies, each of whose shared values has a smaller document as its hub."""
    passage = words(90, 55)
    order = sorted(range(1000, 1200), key=lambda i: int(mix64(np.array([i], dtype=np.uint64))[0]))
    pair = order[-2:]                                        # neither is the smallest by id or by its hash
    docs = {i: " ".join(words(91 + k, 60) + passage + words(95 + k, 60)) for k, i in enumerate(pair)}
    both = [windows_of(docs[pair[0]])[r] & windows_of(docs[pair[1]])[r] for r in range(compact_windows.HASHES)]
    assert sum(map(len, both)) >= compact_windows.HASHES
    seq = shingles(word_hashes(" ".join(passage).encode())[0], compact_windows.WIDTH)
    for r, keys in enumerate(both):
        for key in keys:
            at = next(i for i in range(len(seq)) if int(mix64(seq[i:i + 1] + np.uint64(r))[0]) == key)
            phrase = passage[at:at + compact_windows.WIDTH]
            docs[order[len(docs)]] = next(t for t in (" ".join(words(5000 + n, 23) + phrase + words(9000 + n, 23))
                                                      for n in range(500)) if key in windows_of(t)[r])
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    pairs, classes = compact_windows.passages(frame)
    out = {r["doc_id"]: r["class_id"] for r in compact_windows.summary(frame, pairs, classes).collect()}
    assert out == {i: min(pair) if i in pair else i for i in docs}


def test_classes_equal_brute_force_on_stock_phrases(spark):
    """Texts of common phrases, a few of which share a passage of 50 words."""
    rnd = random.Random(12)
    phrases = [words(400 + k, 6) for k in range(12)]

    def filler(n):
        return [w for _ in range(n) for w in rnd.choice(phrases) + words(rnd.randrange(10 ** 6), 9)]

    shared = [filler(4)[:50] for _ in range(12)]
    texts = {i: filler(3) + (shared[i % 12] if i < 36 else []) + filler(3) for i in range(80)}
    runs = {i: {tuple(t[k:k + 50]) for k in range(len(t) - 49)} for i, t in texts.items()}
    brute = {i: min(j for j in texts if runs[i] & runs[j]) for i in texts}
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    pairs, classes = compact_windows.passages(frame)
    out = {r["doc_id"]: r["class_id"] for r in compact_windows.summary(frame, pairs, classes).collect()}
    assert out == brute


def test_one_changed_word_anywhere_leaves_a_passage():
    """50 words with one changed word (similarity 41 / 51), between 40 unrelated words on both sides."""
    passage = words(70, 50)
    for k in range(5, 45):
        other = [*passage[:k], "changedword", *passage[k + 1:]]
        a, b = (shingles(word_hashes(" ".join(words(71 + n, 40) + p + words(81 + n, 40)).encode())[0], 5)
                for n, p in enumerate((passage, other)))
        own = set(a[40:86].tolist()), set(b[40:86].tolist())
        assert 100 * len(own[0] & own[1]) >= 80 * len(own[0] | own[1])
        assert compact_windows.similar_stretches(a, np.arange(len(a)), b, np.arange(len(b))) == [(40, 85, 40, 85)], k


def test_rarest_shingles_of_every_run():
    rnd = random.Random(4)
    for _ in range(30):
        rank = np.array([rnd.randrange(25) for _ in range(rnd.randint(1, 60))], dtype=np.int32)
        want = np.zeros(len(rank), dtype=bool)
        for a in range(len(rank) - 11):
            low = sorted(set(rank[a:a + 12].tolist()))[:3]
            want[a:a + 12] |= np.isin(rank[a:a + 12], low)
        # A position is taken by any run that holds it and whose third smallest rank it does not pass.
        assert compact_windows.rarest(rank, 12, 3).tolist() == want.tolist()


def test_the_first_split_equals_trying_all():
    rnd = np.random.default_rng(6)
    found = []
    for _ in range(400):
        at = [np.flatnonzero(rnd.random(90) < 0.9) for _ in range(2)]
        codes = [rnd.integers(0, 60, len(p)) for p in at]
        same = np.isin(at[1], at[0]) & (rnd.random(len(at[1])) < 0.93)
        codes[1][same] = codes[0][np.searchsorted(at[0], at[1][same])]
        x, y, lo, hi = 40, 80, int(rnd.integers(0, 10)), int(rnd.integers(10, 40))

        def similar(n):
            a, b = (set(c[(p >= x - n) & (p <= y - n)].tolist()) for c, p in zip(codes, at))
            return 100 * len(a & b) >= compact_windows.PERCENT * len(a | b)
        want = next((n for n in range(lo, hi + 1) if similar(n)), None)
        a, at_a, b, at_b = (v.tolist() for v in (codes[0], at[0], codes[1], at[1]))
        assert compact_windows._first_split(a, at_a, x, y, b, at_b, x, y, lo, hi) == want
        found.append(want)
    assert len({w for w in found if w is not None}) > 5 and None in found


def test_steps_that_are_done_leave_the_disk(spark):
    """Of what is stored only small results stay: pairs, classes and their stars."""
    from shelfspark.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(root))
    passage = words(3, 60)
    frame = spark.createDataFrame([(i, " ".join([*words(100 + i, 80), *passage, *words(900 + i, 80)])) for i in range(12)],
                                  "doc_id long, text string")
    pairs, classes = compact_windows.passages(frame)
    left = {name.removeprefix("shelfspark-llm-").rsplit("-", 1)[0] for name in set(os.listdir(root)) - before if name.startswith("shelfspark-")}
    assert left <= {"passage-pairs", "passage-classes", "edges", "stars", "passage-met"}
    assert {r["component"] for r in classes.collect()} == {0} and pairs.count() >= 11


def test_a_stock_phrase_costs_rows_in_proportion(spark):
    """Unrelated texts around one phrase of 40 words: no passage, and no pairs of documents to test."""
    phrase, stored_rows = words(60, 40), []
    for n in (100, 400):
        frame = spark.createDataFrame([(i, " ".join([*words(7000 + i, 60), f"before{i}", *phrase, f"after{i}", *words(17000 + i, 60)]))
                                       for i in range(n)], "doc_id long, text string")
        rows_, parts, pairs, classes = compact_windows.by_hubs(frame)
        assert pairs.count() == 0
        stretches = compact_windows.open_stretches(rows_, parts, pairs, classes)
        assert compact_windows.dense_stretches(stretches).count() == 0
        stored_rows.append(stretches.count())
    assert stored_rows[1] <= 4 * stored_rows[0] and stored_rows[0] > 0


def marked(spark, marks):
    """Open stretches with nothing but marks: rows (shingle, around, id, class, bare)."""
    by = collections.defaultdict(list)
    for shingle, around, doc, home, bare in marks:
        by[doc, home].append((shingle, around, bare))
    return spark.createDataFrame([(*k, bytearray(np.array(v, dtype=compact_windows.MARK).tobytes())) for k, v in by.items()],
                                 "id long, class long, marks binary")


def test_open_pairs_equal_their_definition(spark):
    rnd = random.Random(14)
    marks = {(rnd.randrange(8), rnd.randrange(4), i, i % 5 * 100, rnd.random() < 0.15) for i in range(60) for _ in range(rnd.randint(1, 4))}
    marks = list({m[:4]: m for m in sorted(marks)}.values())
    want, groups = set(), collections.defaultdict(list)
    for shingle, around, doc, home, bare in marks:
        groups[shingle, around].append((doc, home, bare))
    for group in groups.values():      # same surroundings: with the smallest
        low, high = min(group), max(group)
        want |= {(doc if doc != low[0] else high[0], low[0]) for doc, home, bare in group
                 if len(group) > 1 and (bare or home != low[1])}
    some = {}
    for (shingle, around), group in groups.items():      # other surroundings: the smallest of each class
        for home in {g[1] for g in group}:
            mine = [g for g in group if g[1] == home]
            some[shingle, around, home] = min(mine)[0], any(g[2] for g in mine)
    for (s, x, c), (i, bare) in some.items():
        want |= {(max(i, j), min(i, j)) for (t, y, d), (j, other) in some.items()
                 if s == t and x != y and i != j and (c != d or bare or other)}
    got = [tuple(r) for r in compact_windows.open_pairs(marked(spark, marks)).select("id", "hub").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_what_a_text_repeats_is_not_telling():
    """Beside one other shingle, 45 times the same one is in no passage of texts without the other."""
    rnd, least = random.Random(18), compact_windows.LEAST - compact_windows.WIDTH + 1
    alone = np.zeros(200, dtype=bool)
    rank = np.r_[np.arange(60), np.full(45, 500), np.arange(60, 155)].astype(np.int32)
    assert not compact_windows.telling(rank, alone)[60:105].any()
    rank = np.r_[np.arange(60), np.full(46, 500), np.arange(60, 154)].astype(np.int32)
    assert compact_windows.telling(rank, alone)[60:106].all()
    for _ in range(20):
        rank = np.array([rnd.choice((rnd.randrange(4), rnd.randrange(200))) for _ in range(120)], dtype=np.int32)
        before, after = rnd.choice((0, 7, 45)), rnd.choice((0, 45))
        places = [None] * before + rank.tolist() + [None] * after
        want = np.zeros(len(places), dtype=bool)
        for lo in range(len(places) - least + 1):
            some = sorted({x for x in places[lo:lo + least] if x is not None})
            few = set(some[:compact_windows.ENOUGH[len(some)]])
            want[lo:lo + least] |= [x in few for x in places[lo:lo + least]]
        got = compact_windows.telling(rank, alone[:120], before, after)
        assert (got == want[before:before + 120]).all() or got.all()


def test_documents_of_different_classes_meet_at_telling_shingles(spark):
    """A word that many documents repeat, amid other words: no pairs of different classes, all bare ones of one."""
    frame = spark.createDataFrame([(i, i % 50 * 100, bytearray(np.array([(7, i, 2 + (i >= 50))], dtype=compact_windows.MARK).tobytes()))
                                   for i in range(100)], "id long, class long, marks binary")
    got = {tuple(r) for r in compact_windows.open_pairs(frame).select("id", "hub").collect()}
    assert got == {(i + 50, i) for i in range(50)}


def test_a_shingle_repeated_in_documents_is_joined_once_for_each(spark, monkeypatch):
    """Each document has the shingle amid 200 surroundings of its own: the join gets a row a document."""
    sizes, keep = {}, compact_windows.stored

    def watched(df, name):
        out = keep(df, name)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(compact_windows, "stored", watched)
    frame = marked(spark, [(7, 1000 * i + k, i, i, True) for i in range(5) for k in range(200)])
    assert compact_windows.open_pairs(frame).count() == 10
    assert sizes["passage-surroundings"] == 5


def test_a_second_passage_of_one_class_is_reported(spark):
    """Two documents of one class share a further passage that no smaller document of the class has."""
    first, second = words(61, 55), words(62, 90)
    seq = shingles(word_hashes(" ".join(first).encode())[0], compact_windows.WIDTH)
    values = {(r, k) for r, ks in windows_of(" ".join(first)).items() for k in ks}
    docs = {500: words(63, 60) + first + words(64, 100) + second + words(65, 60),
            501: words(66, 60) + first + words(67, 100) + second + words(68, 60), 1: words(69, 80) + second + words(70, 80)}
    for r, key in values:                    # smaller documents hold the values of the first passage
        at = next(i for i in range(len(seq)) if int(mix64(seq[i:i + 1] + np.uint64(r))[0]) == key)
        phrase = first[at:at + compact_windows.WIDTH]
        docs[len(docs)] = next(w for w in (words(31000 + n, 23) + phrase + words(41000 + n, 23) for n in range(500))
                               if key in windows_of(" ".join(w))[r])
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    out = {r["doc_id"]: r for r in compact_windows.summary(frame, *compact_windows.passages(frame)).collect()}
    assert out[500]["class_id"] == out[501]["class_id"] == 1
    assert out[501]["spans"] == "60:115,215:305" and out[501]["partners"][-1] == 500
    assert all(out[i]["class_id"] == i for i in docs if 1 < i < 500)


def test_recall_of_similar_passages(spark):
    """Pairs with a passage of similarity 0.8, 0.85 and 0.9 or more, amid unrelated words."""
    texts, pairs = {}, {}
    for k, (length, percent) in enumerate(itertools.product((50, 80, 150, 300), (80, 85, 90))):
        for n in range(12):
            at, passage = 100 * k + 2 * n, words(50000 + 100 * k + n, length)
            other = list(passage)
            rnd = random.Random(at)
            while True:  # changes as many words as the similarity allows
                w = rnd.randrange(length)
                trial = [*other[:w], f"new{w}", *other[w + 1:]]
                a, b = ({tuple(x[i:i + 5]) for i in range(length - 4)} for x in (passage, trial))
                if 100 * len(a & b) < percent * len(a | b):
                    break
                other = trial
            for i, p in ((at, passage), (at + 1, other)):
                texts[i] = " ".join(words(60000 + i, 70) + p + words(70000 + i, 70))
            pairs.setdefault(percent, []).append(at)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r["doc_id"]: r["class_id"] for r in compact_windows.summary(frame, *compact_windows.passages(frame)).collect()}
    for percent, ids in pairs.items():
        assert sum(out[i + 1] == i for i in ids) >= 0.9 * len(ids), percent


def test_passages_awkward_tables(spark):
    pairs, classes = compact_windows.passages(documents(spark))
    out = compact_windows.summary(documents(spark), pairs, classes).collect()
    assert len(out) == len(rows())
    by = {r["doc_id"]: r["class_id"] for r in out}
    assert by[2] == 1 and by[17] == 16 and by[9] == 8 and by[21] == 20 and by[10] == 10 and by[None] is None
    empty = no_documents(spark)
    assert compact_windows.summary(empty, *compact_windows.passages(empty)).count() == 0


# --- pipeline -------------------------------------------------------------------------------------------
def test_pipeline_matches_brute_force(spark, tmp_path):
    import corpus_pipeline
    from shelfspark.llm import bpe
    rnd = random.Random(9)
    plain = [f"w{i}" for i in range(400)]
    docs, labels, toxic = [], [], set()
    for i in range(700):
        sentences = [" ".join(rnd.choice(plain) for _ in range(9)) + "." for _ in range(rnd.randint(2, 9))]
        if i % 6 == 0:
            toxic.add(i)
            sentences = [s[:-1] + rnd.choice([" vilewort.", " grubnose."]) for s in sentences]
        docs.append((i, " ".join(sentences)))
        labels.append((i, 1, int(i in toxic)))
    items = [(k, " ".join(words(600 + k, 25)) + ". " + " ".join(words(700 + k, 9)) + ".") for k in range(5)]
    docs += [(1000 + k, " ".join(words(800 + k, 80)) + " " + items[k][1]) for k in range(5)]
    docs += [(2000 + i, docs[i][1]) for i in (1, 2, 3)] + [(3000, "password = hunter2hunter2 and more"), (3001, None), (3002, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in docs], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    near = brute_near(docs, 5, 80)
    want = {i: t for i, t in docs if i not in toxic and near[i][1] in (i, None) and not 1000 <= i < 1005}
    assert set(got) == set(want)
    with open(bpe.production_vocabulary(), "rb") as f:
        own = bpe.Tokenizer(f.read())
    for i, t in want.items():
        text = (t or "").replace("password = hunter2hunter2", "[SECRET]")
        assert got[i]["ids_sha256"] == hashlib.sha256(own.encode(text)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "secrets", "bpe"]


def test_pipeline_returns_the_ids(spark):
    import corpus_pipeline
    from shelfspark.llm import bpe
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, "naïve 漢字 😀")], "doc_id long, text string")
    with open(bpe.production_vocabulary(), "rb") as f:
        own = bpe.Tokenizer(f.read())
    for r, text in zip(sorted(corpus_pipeline.bpe_stage(spark, docs, "").collect()), ("some words", "", "naïve 漢字 😀")):
        assert own.decode(bytes(r["ids"])) == text and len(r["ids"]) == 4 * r["n_tokens"]
        assert hashlib.sha256(bytes(r["ids"])).hexdigest() == r["ids_sha256"]
