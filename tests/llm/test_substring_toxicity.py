import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import substring, toxicity


def brute(rows, window):
    """Kept words by the definition. Places are (id, start); rows with equal places are one place."""
    seen = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for s in range(len(words) - window + 1):
            seen.setdefault(tuple(words[s : s + window]), set()).add((i is None, i or 0, s))
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - window + 1):
            if min(seen[tuple(words[s : s + window])]) < (i is None, i or 0, s):
                gone.update(range(s, s + window))
        kept = [w for q, w in enumerate(words) if q not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept).decode()))
    return out


@pytest.mark.parametrize("tree_rows", [2, 1000])
def test_digest_equals_brute_force(spark, tree_rows):
    rnd = random.Random(5)
    passages = [" ".join(rnd.choice("ab cd ef é g".split()) for _ in range(rnd.randint(5, 14))) for _ in range(6)]
    rows = [(i, "\t ".join(rnd.choice(passages) if rnd.random() < 0.5 else f"u{rnd.randrange(50)}" for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "x " * 300), (73, "x " * 30), (3, rows[3][1]), (None, rows[4][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.lit(0)).withColumn("start", F.lit("clash"))
    want = brute(rows, 6)
    got = substring.digest(df, window=6, seed=3, tree_rows=tree_rows).collect()
    key = lambda x: (x[0] or -1, *x[1:])
    assert sorted(map(tuple, got), key=key) == sorted((x[:4] for x in want), key=key)
    if tree_rows > 2:
        texts = substring.without_repeats(df, window=6, seed=3).collect()
        expect = {(i, t if not n else k) for (i, t), (_, _, n, _, k) in zip(rows, want, strict=True)}
        assert {(r.doc_id, r.text) for r in texts} == expect
        assert substring.digest(df.limit(0)).count() == 0


def test_deep_nodes_are_maximal_repeats():
    rnd = random.Random(2)
    text = [bytes([rnd.choice(b"abc")]) for _ in range(60)] * 2 + [b"z"] + [bytes([rnd.choice(b"ab")]) for _ in range(40)]
    suffixes = [text[i : i + 25] for i in range(len(text) - 5)]
    seen = set()
    for leaves, depth in substring.deep_nodes(suffixes, 5):
        assert depth >= 5 and len({tuple(suffixes[i][:depth]) for i in leaves}) == 1
        longer = {tuple(suffixes[i][: depth + 1]) for i in leaves}
        assert len(longer) > 1 or min(len(suffixes[i]) for i in leaves) == depth
        seen.update(leaves)
    counts = {}
    for i, x in enumerate(suffixes):
        if len(x) >= 5:
            counts.setdefault(tuple(x[:5]), []).append(i)
    assert seen == {i for v in counts.values() if len(v) > 1 for i in v}


def test_columns_of_any_name(spark):
    rows = [(i, "a b c d e f g h " * 2, "x", i, "y", None) for i in range(3)] + [(9, None, "x", 0, "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __spans string, n_chars long, __id string, th string")
    got = {r.doc_id: r for r in substring.without_repeats(df, window=6, seed=3, length_col="n_chars").collect()}
    assert got[0]["__spans"] == "x" and got[1].text == "" and got[1].n_chars == 0 and got[9].text is None and got[0].n_chars == len(got[0].text)
    assert len(got) == 4


def test_toxicity_learns_and_handles_odd_rows(spark):
    rnd = random.Random(3)
    bad = ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(900):
        words = [f"w{rnd.randrange(200)}" for _ in range(rnd.randint(3, 60))]
        toxic = int(rnd.random() < 0.2)
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), rnd.choice(["en", "fr", None])))
        labels.append((i, toxic))
    rows += [(1000, None, "en"), (1001, "", None), (None, "vile " * 9000, "en"), (5, rows[5][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    marks = spark.createDataFrame(labels + [(2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks, shape=toxicity.Shape(steps=4000))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = {r.doc_id: r.score for r in got if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    right = sum((s >= 0.3) == bool(dict(labels)[i]) for i, s in held.items())
    assert right / len(held) > 0.95
    kept = {r.doc_id for r in toxicity.keep_clean(docs, marks, shape=toxicity.Shape(steps=4000)).select("doc_id").collect()}
    assert None not in kept and len(kept) > 600
    assert toxicity.score(docs.limit(0), model).count() == 0
    empty = toxicity.learn(docs, marks.limit(0))
    assert empty.score("vile") < 0.01


def test_toxicity_of_word_order_and_odd_tables(spark):
    """Only the order of two words tells: word odds alone can't, the convolution can. Rows that repeat an id don't make the model depend on the run, other column names work."""
    rnd = random.Random(7)
    rows, labels = [], []
    for i in range(1500):
        words = [f"w{rnd.randrange(50)}" for _ in range(rnd.randint(4, 14))]
        toxic = int(rnd.random() < 0.5)
        at = rnd.randrange(len(words))
        words[at:at] = ["kill", "you"] if toxic else ["you", "kill"]
        rows.append((i, " ".join(words), "en"))
        labels.append((i, toxic))
    rows += [(i, "zz " * 5000, "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "key long, body string, tongue string").withColumn("text", F.lit(7))
    marks = spark.createDataFrame(labels, "key long, toxic int")
    names = {"id_col": "key", "text_col": "body", "lang_col": "tongue"}
    models = [toxicity.learn(d, marks, shape=toxicity.Shape(steps=12000), **names) for d in (docs, docs.repartition(7))]
    assert (models[0].embed == models[1].embed).all()
    held = [(t, dict(labels)[i]) for i, t, _ in rows[:1500] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((models[0].score(t) >= 0.5) == bool(y) for t, y in held) / len(held) > 0.9
    kept = toxicity.keep_clean(docs, marks, shape=toxicity.Shape(steps=2000), **names)
    assert kept.columns == docs.columns and kept.count() < len(rows)
    assert toxicity.keep_clean(docs.limit(0), marks, shape=toxicity.Shape(steps=10), **names).count() == 0


def test_score_equals_plain_convolution():
    """The score of a text against sums over its words, filter by filter; blocks of a long text don't change it."""
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randrange(40)}" for _ in range(rnd.randint(0, 30))) for _ in range(80)]
    labels = [int("w3" in t.split()) for t in texts]
    model = toxicity.train(texts, labels, [None] * 80, toxicity.Shape(steps=300))
    for text in ["", "w3", "W3 unseen w5, w1", texts[7], "w1 w2 " * 60]:
        words = toxicity.WORD(text.lower())
        rows = [[sum(float(model.embed[s][d]) for s in toxicity.slots_of(w, model.shape)) for d in range(model.shape.size)] for w in words]
        rows += [[0.0] * model.shape.size] * max(model.shape.widths)
        total, at, k = model.last, 0, 0
        for width in model.shape.widths:
            for n in range(model.shape.filters):
                best = max(sum(rows[p + j][d] * float(model.conv[d, at + j * model.shape.filters + n]) for j in range(width) for d in range(model.shape.size)) for p in range(len(rows) - width + 1))
                total += max(0.0, best + float(model.bias[k])) * float(model.out[k])
                k += 1
            at += width * model.shape.filters
        assert abs(model.logit(text) - total) < 1e-3
        assert abs(model.logit(text, block=5) - total) < 1e-3


def test_training_texts_stay_off_the_driver(spark, monkeypatch):
    """Only the model comes to the driver, and it is that of the same rows trained here."""
    from pyspark.sql.classic.dataframe import DataFrame

    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: pytest.fail("texts on the driver") if "__text" in self.columns else collect(self))
    rows = [(i, f"{'vile' if i % 3 == 0 else 'fine'} w{i % 40} w{i % 7}", "en") for i in range(400)]
    shape = toxicity.Shape(steps=300)
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([(i, int(i % 3 == 0)) for i, *_ in rows], "doc_id long, toxic int"), shape=shape)
    own = sorted((r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2), key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
    want = toxicity.train([t for _, t, _ in own], [int(i % 3 == 0) for i, *_ in own], [x for *_, x in own], shape)
    assert all(model.score(t) == want.score(t) for _, t, _ in rows) and model.thresholds == want.thresholds and model.threshold == want.threshold
