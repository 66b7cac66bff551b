import random
from collections import Counter

import corpus_pipeline as cp
import numpy as np
import pytest

from tallyweave.llm import shingles


def weighted(a, b):
    def grams(t):
        w = (t or "").lower().split()
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 5 else Counter([tuple(w)] if w else [])

    x, y = grams(a), grams(b)
    both, either = sum((x & y).values()), sum((x | y).values())
    return both / either if either else 1.0


def kept(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, s) in enumerate(rows):
        for j, t in rows[k + 1 :]:
            if weighted(s, t) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [i for i, _ in rows if find(i) == i]


@pytest.mark.parametrize("common,big", [(shingles.ORDER_SHINGLES, shingles.BIG), (1, 2)])
def test_near_copies_equal_brute_force(spark, monkeypatch, common, big):
    monkeypatch.setattr(shingles, "ORDER_SHINGLES", common)
    monkeypatch.setattr(shingles, "BIG", big)
    monkeypatch.setattr(shingles, "BLOCK", 3 if big == 2 else shingles.BLOCK)
    # So that whole groups find what rounds leave.
    monkeypatch.setattr(shingles, "STARS", 1 if big == 2 else shingles.STARS)
    monkeypatch.setattr(shingles, "WORTH", 1 if big == 2 else shingles.WORTH)
    rnd = random.Random(4)
    line = [f"common{i}" for i in range(30)]
    texts = []
    for i in range(260):
        w = [f"w{rnd.randrange(4000)}" for _ in range(rnd.randint(1, 120))]
        if i % 4 == 0:
            w += line
        if i % 3 == 1 and texts:
            w = rnd.choice(texts).split()
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(4000)}"
        if i % 25 == 7:
            w = ["la"] * rnd.randint(5, 60)
        texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, " \n")]
    want = kept(rows)
    pairs = [weighted(s, t) for k, s in enumerate(texts) for t in texts[k + 1 :]]
    assert sum(0.8 <= x < 1 for x in pairs) > 20 and sum(0.7 <= x < 0.8 for x in pairs) > 5
    df = spark.createDataFrame([*rows, (None, texts[0])], "doc_id long, text string")
    got = [r.doc_id for r in cp.one_of_each(spark, df, "").collect()]
    assert sorted(i for i in got if i is not None) == want and got.count(None) == 1
    assert cp.one_of_each(spark, df.limit(0), "").count() == 0


def test_sketches_rule_out_no_similar_pair():
    rnd, kept, ruled_out = random.Random(9), 0, 0
    for _ in range(3000):
        w = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(1, 300))]
        v = list(w)
        for _ in range(rnd.randint(0, 12)):
            at = rnd.randrange(len(v))
            v[at : at + rnd.randint(0, 2)] = [f"x{rnd.randrange(400)}"] * rnd.randint(1, 3)
        x, y = (shingles.elements(" ".join(t).encode()) for t in (w, v))
        may = shingles.may_match(len(x), shingles.sketch(x), len(y), shingles.sketch(y), 0.8)
        assert may or shingles.jaccard(x, y) < 0.8
        kept, ruled_out = kept + may, ruled_out + (not may)
    assert kept > 500 and ruled_out > 500
    assert shingles.may_match(0, shingles.sketch(shingles.elements(b"")), 0, shingles.sketch(shingles.elements(b"")), 0.8)


def test_only_texts_of_possible_pairs_travel(spark, monkeypatch):
    """Unrelated texts that share a rare shingle are told apart from their sketches, and the texts of the others come slice by slice."""
    monkeypatch.setattr(shingles, "SLICE", 1)
    rnd = random.Random(3)
    rows = [(i, " ".join(f"w{rnd.randrange(9000)}" for _ in range(80))) for i in range(30)]
    rows += [(100 + i, t.replace(" w", " v", 1)) for i, t in rows[:12]] + [(200 + i, t.replace(" w", " u", 1)) for i, t in rows[:12]]
    texts = spark.createDataFrame(rows, "node long, text string")
    sketches = shingles.sketched(texts, 5)
    ids = [i for i, _ in rows]
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a long, b long")
    want = sorted((a, b) for k, (a, s) in enumerate(rows) for b, t in rows[k + 1 :] if weighted(s, t) >= 0.8)
    assert shingles.possible(pairs, sketches, 0.8).count() < 60 < pairs.count()
    assert sorted(map(tuple, shingles.similar(pairs, texts, sketches, 5, 0.8).collect())) == want and len(want) == 36


def test_simhash_finds_near_copies_by_itself(spark, monkeypatch):
    """The stage goes by fingerprints: near copies are found with no prefixes at all, and what is close only by fingerprint stays."""
    monkeypatch.setattr(shingles, "prefix", lambda e, *a: e[:0])
    rnd = random.Random(8)
    rows = [(i, " ".join(f"w{rnd.randrange(9000)}" for _ in range(400))) for i in range(20)]
    rows += [(100 + i, t.rsplit(" ", 1)[0] + f" x{i}") for i, t in rows]
    found = shingles.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(r.root == r.id % 100 for r in found.collect()) and found.count() == 40
    monkeypatch.setattr(shingles, "RADIUS", 30)
    apart = [(i, " ".join(f"w{rnd.randrange(9000)}" for _ in range(400))) for i in range(8)]
    assert all(r.root == r.id for r in shingles.near_copies(spark.createDataFrame(apart, "doc_id long, text string")).collect())


def test_tallies_rule_out_texts_that_share_a_passage():
    """No similar pair is ruled out, and texts that only share a passage give no pair, however many they are."""
    rnd, ruled_out, similar = random.Random(10), 0, 0
    for _ in range(2000):
        w = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(1, 600))]
        v = list(w)
        for _ in range(rnd.randint(0, 25)):
            at = rnd.randrange(len(v))
            v[at : at + rnd.randint(0, 2)] = [f"x{rnd.randrange(400)}"] * rnd.randint(1, 3)
        x, y = (shingles.elements(" ".join(t).encode()) for t in (w, v))
        bins = shingles.bins_of(np.stack([shingles.tally(x), shingles.tally(y)]))
        gap = int(shingles.apart(bins[0], bins[1:])[0])
        assert gap <= len(np.setxor1d(x, y))
        ruled_out += gap > (len(x) + len(y)) / 9
        similar += shingles.jaccard(x, y) >= 0.8
    assert ruled_out > 300 and similar > 300
    passage = [f"p{i}" for i in range(60)]
    own = [shingles.elements(" ".join([f"w{rnd.randrange(99999)}" for _ in range(rnd.randint(400, 440))] + passage).encode()) for _ in range(200)]
    rows = np.array([(1, i, len(e), 0, i, *shingles.tally(e)) for i, e in enumerate(own)], np.int64)
    assert shingles.across(0.8)(rows) is None
    twins = rows[[0, 0, 1]]
    twins[1, [1, 4]] = 500
    assert shingles.across(0.8)(twins).tolist() == [[0, 500]]


def test_pairs_of_many_shingles_are_written_once(spark):
    """A task that meets a pair by many shingles writes it once; with little room it may repeat it but loses none."""
    e = shingles.elements(" ".join(f"w{i}" for i in range(300)).encode())
    rows = [(h, node, len(e), 0, node, *map(int, shingles.tally(e))) for h in range(50) for node in (1, 2, 3)]
    df = spark.createDataFrame(rows, ["h", "node", "n", "place", "group", *shingles.TALLY])
    got = shingles.dealt(df.coalesce(1), shingles.across(0.8), ["a", "b"], repeats=False)
    assert 3 <= got.count() <= 3 * got.rdd.getNumPartitions() < 150
    parts = [np.array([(i % 7, j) for j in range(4)]) for i in range(60)]
    for most in (5, 20, 1000):
        out = np.concatenate(list(shingles.once(iter(parts), most)))
        assert {tuple(x) for x in out.tolist()} == {(i, j) for i in range(7) for j in range(4)}
    assert len(out) == 28
