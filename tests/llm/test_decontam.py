import random
from collections import Counter

from pyspark.sql import functions as F

from tallyweave.llm import decontam


def sim(a, b, k=5):
    grams = lambda w: Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))
    x, y = grams(a), grams(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def brute(rows, items):
    out = {}
    for i, t in rows:
        w = (t or "").lower().split()
        for j, u in items:
            v = (u or "").lower().split()
            if not w or not v:
                continue
            got = max((sim(w[s : s + len(v)], v), -s) for s in range(max(1, len(w) - len(v) + 1)))
            if got[0] >= 0.8:
                out[i, j] = max(out.get((i, j), (0, 0)), got)
    return {(i, j, -s, round(x, 9)) for (i, j), (x, s) in out.items()}


def test_matches_equal_brute_force(spark):
    rnd = random.Random(11)
    word = lambda: f"W{rnd.randrange(400)}"
    items = [(j, " ".join(word() for _ in range(rnd.randint(9, 45)))) for j in range(12)] + [(50, None), (51, ""), (52, "one two three"), (53, "a a a a a a a a a a")]
    rows = []
    for i in range(120):
        body = [word() for _ in range(rnd.randint(0, 60))]
        part = rnd.choice(items)[1] or ""
        part = part.lower().split()
        for _ in range(rnd.choice([0, 0, 1, 2])):
            if part:
                at = rnd.randrange(len(part))
                part[at : at + rnd.choice([0, 1])] = [word()] * rnd.choice([0, 1])
        at = rnd.randint(0, len(body))
        rows.append((i, " \n".join(body[:at] + (part if i % 2 else []) + body[at:])))
    rows += [(200, None), (201, ""), (202, "One  two\tthree"), (203, "a " * 400), (None, items[0][1]), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("clash")).withColumn("item", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit("clash"))
    got = {(r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in decontam.matches(docs, bench).collect()}
    assert got == brute(rows, items)
    bad = {i for i, *_ in got}
    assert {r.doc_id for r in decontam.without_benchmark(docs, bench).collect()} == {i for i, _ in rows} - bad
    assert decontam.matches(docs.limit(0), bench).count() == 0
    assert decontam.matches(docs, bench.limit(0)).count() == 0


def test_order_and_repeats_lose_no_match(spark):
    """Items whose halves stand the other way round, and items of few shingles many times: SimHashes far apart, similarity 0.8 or more."""
    rnd = random.Random(4)
    items, rows = [], []
    for j, n in enumerate([80, 120, 45, 46, 60]):
        w = [f"i{j}w{k}" for k in range(n)]
        cut = rnd.randrange(n // 3, n // 2)
        items.append((j, " ".join(w)))
        rows.append((j, " ".join([f"u{k}" for k in range(rnd.randrange(9))] + w[cut:] + w[:cut] + ["v"])))
    phrase = "a b c d e f g h".split()
    items.append((50, " ".join(phrase * 5)))
    rows += [(50, " ".join((phrase * 6)[3:43])), (51, " ".join((phrase * 30)[5:])), (52, " ".join("x " * 3) + " ".join(phrase * 2)), (53, " ".join(phrase * 4 + ["z"]))]
    items.append((60, " ".join(["a"] * 9 + ["b"] * 8)))
    rows += [(60, " ".join(["a"] * 8 + ["b"] * 9)), (61, " ".join(["b"] * 4 + ["a"] * 9 + ["b"] * 7 + ["c"]))]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in decontam.matches(docs, bench).collect()}
    assert got == brute(rows, items)
    assert {(0, 0), (1, 1)} <= {x[:2] for x in got}


def test_starts_of(spark):
    rnd = random.Random(9)
    for _ in range(12):
        at = sorted(rnd.sample(range(40), rnd.randrange(0, 20)))
        need, n, last = rnd.randint(1, 6), rnd.randint(1, 10), rnd.randint(0, 35)
        row = spark.createDataFrame([(at, need, n, last)], "at array<int>, need int, n int, last int").select(decontam.starts_of(*map(F.col, ("at", "need", "n", "last"))).alias("s")).first()
        assert row.s == [s for s in range(last + 1) if sum(s <= x < s + n for x in at) >= need]
