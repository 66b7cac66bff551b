import random

import corpus_pipeline as cp

from tests.llm.test_bytebpe_simhash import brute as brute_links
from tests.llm.test_bytebpe_simhash import ids_of, slow_fingerprint
from tests.llm.test_decontam import brute as brute_benchmark
from tests.llm.test_substring_toxicity import brute as brute_repeats


def test_stages_equal_brute_force(spark, tmp_path):
    rnd = random.Random(2)
    words = lambda n: [f"w{rnd.randrange(3000)}" for _ in range(n)]
    items = [(j, " ".join(words(30))) for j in range(5)]
    passages = [" ".join(words(60)) for _ in range(4)]
    rows, labels = [], []
    for i in range(260):
        w = words(rnd.randint(20, 90))
        toxic = i % 6 == 0
        if toxic:
            w.insert(3, "vile")
        if i % 9 == 1:
            w[10:10] = rnd.choice(passages).split()
        if i % 13 == 2:
            w[5:5] = rnd.choice(items)[1].split()
        text = " ".join(w)
        if i % 10 == 5 and rows:
            text = rnd.choice(rows)[1]
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int("vile" in text.split())))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = []
    for _, stage in cp.STAGES:
        docs = cp.checkpointed(stage(spark, docs, str(tmp_path)))
        got.append({r["doc_id"]: r for r in docs.collect()})
    first = {i: r.text for i, r in got[0].items()}
    assert all("vile" not in (t or "").split() for t in first.values()) and len(first) >= 210
    ids = sorted(first)
    label = brute_links([slow_fingerprint(first[i]) for i in ids])
    assert sorted(got[1]) == [i for i, g in zip(ids, label, strict=True) if ids[g] == i]
    second = [(i, got[1][i].text) for i in sorted(got[1])]
    for (i, n, gone, _, kept), (_, text) in zip(brute_repeats(second, 20), second, strict=True):
        assert got[2][i].text == (kept if gone else text), (i, n)
        assert not gone or got[2][i].n_chars == len(kept)
    third = [(i, r.text) for i, r in got[2].items()]
    assert set(got[3]) == set(got[2]) - {i for i, *_ in brute_benchmark(third, items)}
    assert {i: r.n_tokens for i, r in got[4].items()} == {i: len(ids_of(r.text or "")) for i, r in got[3].items()}
    assert all(r.same for r in got[4].values())
    assert all(set(g) for g in got) and docs.columns[0] == "doc_id"
