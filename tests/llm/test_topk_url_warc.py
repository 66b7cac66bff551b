import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import common, topk, urlfilter, warc


def test_top_k_equals_brute_force(spark):
    rnd = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rnd.standard_normal(6)]) for i in range(400)] + [(i, [0.5] * 6) for i in range(400, 430)]
    rows += [(1000, None), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1100, [float("nan")] * 6), (1150, [1.0, 2.0]), (None, [1.0] * 6), (3, rows[3][1]), (1200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for i, q in good:
        if i % 50 == 0:
            found = sorted((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q))[:5]
            want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(found)}
    got = [tuple(r) for r in topk.top_k(df, shard_rows=64).collect()]
    assert set(got) == want and len(got) == len(want)
    assert topk.top_k(df.limit(0)).count() == 0


def test_judge(spark):
    urls = [(1, "http://Casino-Win.example.com/x"), (2, "https://a.example.net/en/1?q=/de/"), (3, "https://a.example.net/fr/"), (4, "http://b.example.org/fr/x"), (5, None), (6, "no scheme"), (7, "x://EXAMPLE.com/de/"), (8, "x://badexample.com/de/"), (9, "x://net"), (None, "x://net/"), (1, "x://m.free-bets.example.com?://net/"), (10, "")]
    df = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))
    for size in (urlfilter.SEGMENT_KEYS, 2):
        got = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in urlfilter.judge(df, segment_keys=size).collect()}
        assert got[1, "casino-win.example.com"] == ("/x", None, "block")
        assert got[2, "a.example.net"] == ("/en/1", "example.net/en/", "allow")
        assert got[3, "a.example.net"][1:] == ("net/", "block") and got[4, "b.example.org"][1:] == ("org/fr/", "allow")
        assert got[5, ""] == ("", None, "allow") == got[6, ""] == got[10, ""]
        assert got[7, "example.com"][1:] == ("example.com/de/", "block") and got[8, "badexample.com"][2] == "allow"
        assert got[9, "net"] == ("", None, "allow") and got[None, "net"][2] == "block"
        assert got[1, "m.free-bets.example.com"] == ("", None, "block")
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_listed_table(spark):
    hosts = [f"{a}.{b}.c{c}" for a in "xyz" for b in "pqr" for c in range(40)]
    pages = spark.createDataFrame([(i, f"h://{h}/" if i % 5 else f"h://{'.' * (i % 3)}{h}") for i, h in enumerate(hosts)] + [(999, "h://" + "a." * 3000 + "c7")], "page_id long, url string")
    domains = [f"q.c{c}" for c in range(0, 40, 3)] + ["x.p.c1", "c7", "C9", "", None, "c7"]
    listed = spark.createDataFrame([(d,) for d in domains], "domain string")
    want = {r.page_id: r.host for r in urlfilter.judge(pages, listed, segment_keys=8).collect()}
    got = {r.page_id for r in urlfilter.judge(pages, listed, segment_keys=8).where("verdict = 'block'").collect()}
    assert got == {i for i, h in want.items() if any(h == d.lower() or h.endswith("." + d.lower()) for d in domains if d)}
    assert {r.verdict for r in urlfilter.judge(pages, listed.limit(0), rules=()).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    keys = spark.range(6000).select(F.concat(F.lit("h"), F.col("id")).alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    names = [f"h{i}".encode() for i in range(6000)]
    for size in (100, 1 << 20):
        assert urlfilter.cascade(keys, size).holds(names).tolist() == [i % 7 == 0 for i in range(6000)]
    assert len(urlfilter.layers(names[::7], [x for i, x in enumerate(names) if i % 7])) > 1


def test_top_k_of_large_components(spark):
    rnd = np.random.default_rng(5)
    for rows in ([(i, [1e30] * 4) for i in (0, 1, 2)] + [(3, [-1e30] * 4), (50, [1e300] * 4), (4, [1e308] * 4)], [(int(i), (1e6 + rnd.standard_normal(64)).tolist()) for i in range(300)]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        whole = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows if all(math.isfinite(256.0 * x) for x in v)]
        score = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=True))))
        want = {(i, r + 1, j, -s) for i, q in whole if i % 50 == 0 for r, (s, j) in enumerate(sorted((-score(q, v), j) for j, v in whole if j != i)[:5])}
        assert {tuple(r) for r in topk.top_k(df, shard_rows=50).collect()} == want


def test_warc_round_trip(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i, f"http://{rnd.choice('abc')}.x.org/{i}?q= z", rnd.choice(["<p>é</p>", f"<b>{i}</b>", "", None])) for i in range(1200)]
    rows += [(None, None, "<p>only</p>"), (None, "http://n", "<p>é</p>"), (2, "http://again\r\n", rows[2][2]), (5000, "http://big", "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    archive = warc.write(df, folder=str(tmp_path / "w"))
    got = sorted((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_back(archive, df).collect() if r.page_id is not None)
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(least.get(h or "", i), i)
    want = sorted((False, i, len((h or "").encode()), warc.payload_digest((h or "").encode()), "response" if least[h or ""] == i else "revisit", None if least[h or ""] == i else least[h or ""]) for i, _, h in rows if i is not None)
    assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in want]
    found = warc.lookup(archive, "http://big")
    assert len(found) == 1 and found[0]["payload"] == b"x" * 300_000
    assert warc.lookup(archive, "http://none.org/") == []
    assert len(warc.lookup(archive, "http://n")) == 1 and len(warc.lookup(archive, rows[9][1])) == 1
    some = df.where("page_id < 5")
    assert warc.read_back(archive, some).count() == some.count()
    assert warc.read_back(warc.write(df.limit(0), folder=str(tmp_path / "e")), df).count() == 0
    same = spark.createDataFrame([(i % 3, "http://one/", f"{i}") for i in range(2000)], "page_id long, url string, html string")
    assert warc.read_back(warc.write(same), same).count() == 2000


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (7, 7), (None, 3), (100, 101)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 102: 100}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("url,key", [("http://A.b.org:80/x y", "org,b,a:80)/x%20y"), (None, ""), ("http://h", "h)/"), ("x", "x")])
def test_url_key(url, key):
    assert warc.url_key(url) == key
