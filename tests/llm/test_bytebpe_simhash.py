import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import bytebpe, common, simhash

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_multi_50k.tiktoken")

TEXTS = [(1, "Hello, world's  best\n\n tokens 12345 — naïve 中文🙂"), (2, ""), (3, None), (None, "x"), (3, "   "), (4, "a" * 5000), (5, "\x1c\x85　 ퟿\U0001F9FF z")]


def ids_of(text):
    import tiktoken

    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(PATH), special_tokens={}).encode_ordinary(text)


def test_encode_decode_offsets(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    rows = bytebpe.encode(df, PATH, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, r.ids) for r in rows) == sorted((i or 0, ids_of(t or "")) for i, t in TEXTS)
    for r in rows:
        text = next(t for i, t in TEXTS if i == r.doc_id and ids_of(t or "") == r.ids) or ""
        own = bytebpe.codec(bytebpe.read_ranks(PATH), P.PATTERN, "test")
        for i, a, b in zip(r.ids, r.char_start, r.char_end, strict=True):
            assert own.decode([i]) in text[a:b].encode()
    back = bytebpe.decode(spark.createDataFrame([(1, ids_of("é🙂")[:-1] if len(ids_of("🙂")) > 1 else []), (2, None)], "doc_id long, ids array<int>"), PATH, P.PATTERN).collect()
    assert back[0].text.startswith("é") and back[1].bytes == b""
    assert bytebpe.encode(df.limit(0), PATH, P.PATTERN).count() == 0


def test_round_trip_digests(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bytebpe.round_trip(df, PATH, P.PATTERN).collect()}
    want = set()
    for i, t in TEXTS:
        ids = ids_of(t or "")
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want


def brute(fps, radius=3):
    """Component of each row by comparing all pairs."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("limit", [24, 2048])
def test_links_equal_brute_force(spark, limit):
    rnd = random.Random(limit)
    fps = [0, 7, 15]
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 8)):
            fps.append(base ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 3))) & (1 << 64) - 1)
    dense = rnd.getrandbits(64)
    fps += [dense ^ (x << 20) for x in range(60)]
    fps = list(dict.fromkeys(x & (1 << 64) - 1 for x in fps))
    reps = spark.createDataFrame([(simhash.signed(x), i) for i, x in enumerate(fps)], "fp long, rep long")
    roots = {r.node: r.root for r in common.components(simhash.links(reps, 3, limit)).collect()}
    assert [roots.get(i, i) for i in range(len(fps))] == brute(fps)


def slow_fingerprint(text, k=3):
    import xxhash

    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def test_near_duplicates(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, "a b c d"), (3, "A  b\tc d"), (9, None), (8, ""), (7, "é É x"), (1, long), (2, long + " tail"), (None, "a b c d"), (5, "a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1))
    got = {(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(df).collect()}
    fps = [slow_fingerprint(t) for _, t in rows]
    with_id = [(i, f) for (i, _), f in zip(rows, fps, strict=True) if i is not None]
    label = brute([f for _, f in with_id])
    least = {}
    for (i, _), g in zip(with_id, label, strict=True):
        least[g] = min(least.get(g, i), i)
    want = {(i, f, least[g]) for (i, f), g in zip(with_id, label, strict=True)} | {(None, fps[7], None)}
    assert got == want
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == {i for i, _, c in want if i == c} 
    assert simhash.near_duplicates(df.limit(0)).count() == 0
