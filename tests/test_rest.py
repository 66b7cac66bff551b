import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave import catalog_party
from tallyweave.functions import kernels
from tallyweave.knobs import Knobs
from tallyweave.operators import blocking, checks, embedding, features, matching, sampling, training, validation
from tallyweave.plans import party
from tallyweave.sources import records, store
from tallyweave.sources.parties import parties, party_truth
from tallyweave.streaming import arrivals

SF = "/root/testdata/sf0.001"
PAIR = matching.PAIR


def test_kernels_by_their_meaning():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abc d") for _ in range(rnd.randint(0, 12))) for _ in range(60)]

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    plain = lambda a, b: 2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0
    for a, b in zip(texts, texts[::-1], strict=True):
        assert kernels.lcs_ratio(a, b) == pytest.approx(plain(a, b))
        if a and b:
            best = 0.0
            for s, t in ((a, b), (b, a)) if len(a) == len(b) else (sorted((a, b), key=len),):
                best = max([best, *(plain(s, t[max(0, i) : i + len(s)]) for i in range(1 - len(s), len(t)))])
            assert kernels.partial_ratio_of(a, b) == pytest.approx(best)
            x, y = set(a.split()), set(b.split())
            if x and y:
                both, left, right = (" ".join(sorted(z)) for z in (x & y, x - y, y - x))
                ab, ba = (" ".join(z for z in (both, w) if z) for w in (left, right))
                gap = len(left) + len(right) - 2 * lcs(left, right)
                want = 1.0 if both and (not left or not right) else max([1 - gap / (len(ab) + len(ba)), *([plain(both, ab), plain(both, ba)] if both else [])])
                assert kernels.token_set_of(a, b) == pytest.approx(want), (a, b)
        for name, v in zip(kernels.EDITS, kernels.edits_of(a, b), strict=True):
            assert 0 <= v <= 1 and (v == 0 or (a and b)), name
    assert kernels.edits_of("acme", "acme") == (1.0,) * 7 and kernels.token_sort_of("b a", "a b") == 1
    assert kernels.domain_match_of("acme-foods.co.in", "acme foods") == 1 and kernels.domain_match_of("a.b", "a b") == 0 and kernels.domain_match_of("", "x.com") == 0


def test_feature_matrix(spark):
    rows = parties(spark, SF).where("entity_id like '%-1' or entity_id like '%-2' or entity_id like '%-6' or entity_id like '%-12'")
    s1, pool = records.sides(party.normal.normalise_frame(rows))
    cands = spark.createDataFrame([("S1-6", "S2-6", 5, 2, 1, 2.0), ("S1-6", "S3-6", 4, 1, 3, 0.3), ("S1-2", "S2-6", 4, 1, 1, 1.0), ("S1-9", "S2-6", 4, 1, 1, 1.0)], "source1_entity_id string, candidate_entity_id string, channels int, n_channels int, best_rank int, prior_score double")
    near = spark.createDataFrame([("S1-6", "S2-6", 4, 0.5)], "source1_entity_id string, candidate_entity_id string, channel_rank int, channel_score double")
    got = {(r[0], r[1]): r for r in features.feature_columns(cands, s1, pool, near).collect()}
    assert len(got) == 3 and len(features.NAMES) == 71 and features.NAMES[22] == "name_acronym_match" and features.NAMES[46] == "addr_street_num_match"
    a = got["S1-6", "S2-6"]
    assert (a.embed_cosine, a.embed_rank, a.ch_name_tfidf, a.ch_addr_tfidf, a.ch_exact_key, a.margin_to_best, a.entity_n_cands, a.cand_n_claims, a.cand_is_argmax) == (0.5, 4, 1, 0, 1, 0, 2, 3, 1)
    b = got["S1-2", "S2-6"]
    assert (b.embed_cosine, b.embed_rank, b.cand_is_argmax, b.is_source3, got["S1-6", "S3-6"].is_source3, got["S1-6", "S3-6"].margin_to_best) == (0, features.NO_RANK, 0, 0, 1, -1.7)
    left, right = ({r.entity_id: r for r in df.collect()} for df in (s1, pool))
    for (x, y), r in got.items():
        for field in ("name_norm", "name_roman", "addr_norm", "addr_roman"):
            for name, v in zip(kernels.EDITS, kernels.edits_of(left[x][field], right[y][field]), strict=True):
                assert r[f"{field}_{name}"] == pytest.approx(v, abs=1e-6)
    m = features.feature_matrix(cands, s1, pool, near, party_truth(rows))
    assert m.columns == [*PAIR, *features.COLUMNS, "label"] and {r[1]: r.label for r in m.where("source1_entity_id = 'S1-6'").collect()} == {"S2-6": 1, "S3-6": 1}
    with pytest.raises(ValueError):
        features.require_embeddings(cands.withColumn("channels", F.lit(16)), None)
    assert features.feature_matrix(cands.limit(0), s1, pool).count() == 0
    assert features.sampled_entities(cands, 1.0).count() == 4 and features.sampled_entities(cands, 0.0).count() == 0


def test_trees_are_monotone_and_learn():
    rnd = np.random.default_rng(2)
    x = rnd.random((3000, 4))
    y = (rnd.random(3000) < 1 / (1 + np.exp(-(4 * x[:, 0] - 3 * x[:, 1] + 2 * np.sin(6 * x[:, 2]) - 1)))).astype(float)
    signs = [1, -1, 0, 1]
    model = training.fit_trees(x[:2000], y[:2000], x[2000:], y[2000:], list("abcd"), signs, rounds=60, leaves=15, rate=0.1)
    assert training.log_loss(y[2000:], model.raw(x[2000:])) < 0.9 * training.log_loss(y[2000:], np.full(1000, model.base))
    for j, s in enumerate(signs):
        if s:
            grid = np.repeat(x[:50], 30, axis=0)
            grid[:, j] = np.tile(np.linspace(0, 1, 30), 50)
            steps = np.diff(model.raw(grid).reshape(50, 30), axis=1) * s
            assert (steps >= -1e-9).all()
    again = training.Boosted.loads(model.dumps())
    assert np.allclose(again.raw(x[:9]), model.raw(x[:9])) and max(len(t.value) // 2 + 1 for t in model.trees) <= 15
    with pytest.raises(ValueError):
        training.Boosted.loads(json.dumps(json.loads(model.dumps()) | {"version": -1}))
    assert training.fit_trees(x[:5], np.zeros(5), x[:0], np.zeros(0), list("abcd"), signs).trees == []


def test_roles_calibration_and_scores(spark):
    ids = spark.range(20000).select(F.concat(F.lit("S1-"), F.col("id")).alias("e"))
    share = {r.role: r.n / 20000 for r in ids.groupBy(training.role_of(training.bucket_of(F.col("e"))).alias("role")).agg(F.count("*").alias("n")).collect()}
    assert abs(share["train"] - 0.7) < 0.02 and abs(share["val"] - 0.2) < 0.02 and abs(share["calib"] - 0.1) < 0.02
    rnd = np.random.default_rng(3)
    raw = rnd.random(4000)
    rows = spark.createDataFrame([(f"S1-{i % 500}", f"S2-{i}", float(s), int(rnd.random() < s**2), i % 100) for i, s in enumerate(raw)], "source1_entity_id string, candidate_entity_id string, raw double, label int, bucket int")
    fitted = training.isotonic(rows)
    assert (np.diff(fitted[1]) >= 0).all()
    out = training.calibrated(rows, fitted)
    q = training.quality(out).first()
    assert abs(q.mean_prob - q.prevalence) < 0.005 and q.ece < 0.05 and q.n == 4000
    halves = training.quality(training.cross_fitted(rows)).first()
    assert halves.ece < 0.08 and halves.auc > 0.7
    assert [r.n for r in training.equal_count_bins(rows.limit(23).withColumnRenamed("raw", "prob")).orderBy("bin").collect()] == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]
    model = training.fit_trees(raw[:, None], (raw > 0.5).astype(float), raw[:0, None], raw[:0], ["raw"], [1], rounds=3)
    scored = [training.score_split(rows.repartition(n), model, fitted, rows.where("bucket < 10").select(PAIR[0])).orderBy(*PAIR).collect() for n in (1, 5)]
    assert scored[0] == scored[1] and len(scored[0]) > 0
    with pytest.raises(ValueError):
        training.predict(rows.drop("raw"), model)


def test_slices(spark):
    rows = spark.createDataFrame([(f"S1-{i // 7}", f"S2-{i}", int(i % 7 == 0), float(i % 5)) for i in range(700)], "source1_entity_id string, candidate_entity_id string, label int, prior_score double")
    out = training.slices(rows, spark.createDataFrame([("S1-0",)], "entity_id string"))
    per = {(r.role, r.n) for r in out.groupBy(PAIR[0], "role").agg(F.count("*").alias("n")).collect()}
    assert {n for role, n in per if role == "calib"} <= {7} and {n for role, n in per if role != "calib"} == {4}
    assert out.where("source1_entity_id = 'S1-0'").isEmpty()


def test_embedding_search_equals_brute_force(spark):
    rnd = np.random.default_rng(8)
    rows = [(f"S{1 + i % 2}-{i}", "ab"[i % 3 == 0], [float(v) for v in rnd.integers(-3, 4, 5)], [float(v) for v in rnd.standard_normal(3)]) for i in range(90)]
    rows += [("S1-900", "a", None, [1.0, 0.0, 0.0]), ("S2-900", "a", [1.0, None, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0]), (None, "a", [1.0] * 5, [1.0] * 3), ("S2-901", "a", [0.0] * 5, [0.0] * 3)]
    df = spark.createDataFrame(rows, "entity_id string, country string, x array<double>, y array<double>")
    s1, pool = records.sides(df)
    unit = lambda v: np.array(v) / max(1e-12, np.sqrt(np.dot(v, v)))
    good = [r for r in rows if r[0] and r[2] and None not in r[2]]
    want = set()
    for i, c, x, y in good:
        if i.startswith("S1-"):
            found = sorted((-round(float(unit(x) @ unit(u) + unit(y) @ unit(v)) / 2, 6), j) for j, d, u, v in good if d == c and not j.startswith("S1-"))[:4]
            want |= {(i, j, n + 1) for n, (_, j) in enumerate(found)}
    for block in (7, 1000):
        got = embedding.embed_top_k(s1, pool, 4, ("x", "y"), pool_block=block, query_block=block)
        assert {(r[0], r[1], r[2]) for r in got.collect()} == want
    assert embedding.embed_top_k(s1.limit(0), pool, 4, ("x", "y")).count() == 0


def test_channels(spark):
    s1 = spark.createDataFrame([("S1-1", "c", ["acme"], []), ("S1-2", "c", ["zeta"], []), ("S1-3", "c", [], [])], "entity_id string, country string, name_tokens array<string>, addr_tokens array<string>")
    pool = spark.createDataFrame([(f"S2-{i}", "c", t, []) for i, t in enumerate((["acme"], ["acme"], ["acme", "zeta"], ["zeta"], []))], s1.schema)
    got = {(r[0], r[1]) for r in blocking.tfidf_top_k(s1, pool, df_ceiling=0.5).collect()}
    # acme stands in three of four records, so only its fallback finds others of the same kind.
    assert ("S1-1", "S2-0") in got and ("S1-1", "S2-1") in got and ("S1-2", "S2-3") in got and ("S1-1", "S2-3") not in got
    assert blocking.tfidf_top_k(s1, pool.limit(0)).count() == 0 and blocking.rare_token(s1.limit(0), pool).count() == 0
    for bad in (0.0, 1.5, "x", True):
        with pytest.raises(ValueError):
            blocking.limit_of("knob", bad, F.col("n"))
    with pytest.raises(ValueError):
        blocking.run_channel("none", s1, pool)
    wide = {(r[0], r[1]) for r in blocking.rare_token(s1, pool, df_fraction=1.0).collect()}
    assert len(wide) == 5 and not blocking.rare_token(s1, pool, df_fraction=0.3).count()
    twice = blocking.channel_stats(spark.createDataFrame([("S1-1", "x"), ("S1-1", "x")], "source1_entity_id string, candidate_entity_id string"), s1).first()
    assert (twice.entities, twice.pairs, twice.with_pair, twice.twice) == (3, 2, 1, 1)


def test_metric_needs_all_answers(spark):
    entities = spark.createDataFrame([("a", "c"), ("b", "c")], "source1_entity_id string, country string")
    truth = spark.createDataFrame([("a", "x")], "source1_entity_id string, candidate_entity_id string")
    lists = spark.createDataFrame([("a", "x"), ("b", "")], "source1_entity_id string, matched_entity_ids string")
    assert matching.macro_f05(entities, truth, lists) == 1.0
    with pytest.raises(ValueError):
        matching.macro_f05(entities, truth, lists.limit(1))
    assert matching.restricted(entities, lists, truth).count() == 1
    row = matching.breakdown(matching.per_entity(entities, truth, truth, truth)).where("country is null and k_bucket is null").first()
    assert (row.blocking_recall, row.singleton_accuracy, row.mean_predicted) == (1.0, 1.0, 0.5)


def test_sampling(spark):
    rows = spark.createDataFrame([(f"S1-{i}", "ab"[i % 5 == 0]) for i in range(883)], "entity_id string, country string")
    a, b = (sampling.stratified(df, 320).orderBy("entity_id").collect() for df in (rows, rows.repartition(3).orderBy(F.desc("entity_id"))))
    assert a == b and len(a) == 320
    assert sampling.stratified(rows, 0).count() == 883 == sampling.stratified(rows, 5000).count()
    with pytest.raises(ValueError):
        sampling.stratified(rows, 5, split="test")
    split = sampling.make_split(rows, 100)
    assert split.where("held_out").count() == 100 and split.count() == 883 and sampling.make_split(rows, 0).where("held_out").count() == 0
    assert sampling.allocate({"a": 100, "b": 10}, 50, 8) == {"a": 42, "b": 8}
    with pytest.raises(ValueError):
        sampling.allocate({"a": 1}, 5, 0)
    cut = sampling.smoke_test(rows, rows, 100, 10)
    assert cut["s1"].count() == 100 and abs(cut["pool"].count() - 100) <= 2
    profile = sampling.split_profile(split, spark.createDataFrame([("S1-1", "x")], "source1_entity_id string, candidate_entity_id string"))
    assert sum(r.entities for r in profile.collect()) == 883


def test_linkage_of_nulls_repeats_and_nothing(spark):
    schema = "source1_entity_id string, candidate_entity_id string, channels int, n_channels int, best_rank int, prior_score double"
    cands = spark.createDataFrame([("a", "x", 1, 1, 1, 1.0), ("a", "x", 1, 1, 1, 1.0), ("a", "y", 1, 1, 2, None), ("b", "x", 1, 1, 1, 1.0), ("c", "z", 1, 1, 1, None)], schema)
    rows = {(r[0], r[1]): r for r in matching.context(cands).collect()}
    assert rows["a", "x"].entity_n_cands == 3 and rows["a", "x"].cand_n_claims == 3 and rows["a", "y"].margin_to_best is None and rows["b", "x"].cand_is_argmax == 1
    stub = {(r[0], r[1]): r.prob for r in matching.stub_scores(cands).collect()}
    assert stub["b", "x"] == 0.5 == stub["c", "z"]
    assert {tuple(r)[:2] for r in matching.unique_claims(matching.stub_scores(cands).where("prob is not null")).collect()} >= {("c", "z")}
    norm = spark.createDataFrame([("a", None, None), ("x", "abcd e", ["abcd", "e"]), ("b", "abcd e", ["e", "abcd"])], "entity_id string, name_norm string, name_tokens array<string>")
    sims = {(r[0], r[1]): r for r in matching.set_similarities(cands, norm).collect()}
    assert set(sims) == {("a", "x"), ("b", "x")} and sims["a", "x"].char3_jaccard == 0 and sims["b", "x"].token_jaccard == 1
    assert {r.cap: (r.pairs, r.found) for r in matching.cap_sweep(cands, cands, [1, 9]).collect()} == {1: (3, 3), 9: (5, 5)}
    assert [r.slot for r in blocking.cap(cands, 1).withColumn("slot", F.lit(1)).collect()] == [1, 1, 1]
    none = cands.limit(0)
    for df in (matching.context(none), matching.stub_scores(none), matching.set_similarities(none, norm), matching.cap_sweep(none, none, [1]), blocking.cap(none), blocking.union([(1, none.withColumn("channel_rank", F.lit(1)))])):
        assert df.count() == 0
    people = spark.createDataFrame([("a", None), ("b", "c"), ("b", "c")], "entity_id string, country string")
    assert sum(r.quota for r in checks.quotas(people, 2).collect()) == 2 and checks.quotas(people.limit(0), 2).count() == 0
    ids = spark.createDataFrame([("a",)], "source1_entity_id string")
    found = checks.violations(ids, people, cands, cands.select(*PAIR).union(cands.select(*PAIR).limit(1)))
    assert {r.rule for r in found.collect()} == {"unknown query id", "unknown pool id", "matched twice"} and checks.violations(ids, people, none, none).count() == 0
    labelled = cands.withColumn("label", F.lit(0))
    assert matching.hard_negatives(labelled, 2.0, 1).count() == 3 and matching.hard_negatives(labelled.limit(0)).count() == 0


def test_runs(spark):
    rnd = random.Random(6)
    keys = [rnd.choice([1, 2, None]) for _ in range(300)] + [7] * 200
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, o long").repartition(8)
    want, start = [], 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            want.append((keys[start], start, i - 1, i - start))
            start = i
    assert sorted(map(tuple, checks.runs(df, "k", "o").collect()), key=lambda r: r[1]) == want


def test_files(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    (tmp_path / "raw.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a ""b"""\t\tUS\nS1-2\tnull\tx\tFrance\n')
    rows, facts = store.ingest(spark, p("raw.tsv"), "source1", 2)
    assert facts == {"rows": 2, "ids": 2, "prefixed": True, "no_address": 1, "countries": 2}
    for bad in (("source2", 2), ("source1", 3)):
        with pytest.raises(ValueError):
            store.ingest(spark, p("raw.tsv"), *bad)
    (tmp_path / "head.tsv").write_text("a\tb\nS1-1\t\n")
    with pytest.raises(ValueError):
        store.ingest(spark, p("head.tsv"), "source1")
    store.write_tsv(rows, p("again"))
    assert rows.exceptAll(records.read_tsv(spark, p("again"))).isEmpty()
    (tmp_path / "lists.tsv").write_text('source1_entity_id\tmatched_entity_ids\nS1-1\t"q\nS1-2\t\n')
    plain = store.read_plain_tsv(spark, p("lists.tsv"), ("source1_entity_id", "matched_entity_ids"))
    assert {tuple(r) for r in plain.collect()} == {("S1-1", '"q'), ("S1-2", "")}
    assert store.read_plain_tsv(spark, p("lists.tsv"), ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id",)).columns == ["source1_entity_id"]
    assert [tuple(r) for r in store.read_id_lists_of(plain, plain.limit(0)).collect()] == []
    for _ in range(2):
        store.publish(rows.limit(0), p("t"), rows.schema)
    schema, n = store.table_facts(spark, p("t"))
    assert ([(f.name, f.dataType) for f in schema], n) == ([(f.name, f.dataType) for f in rows.schema], 0)
    with pytest.raises(ValueError):
        store.publish(rows, p("t"), "a string")
    store.publish(rows, p("u"))
    assert store.read_country(spark, [p("t"), p("u")], "US", ["entity_id"]).collect()[0][0] == "S1-1"
    assert store.require_inputs(spark, {"train": [p("t")], "test": [p("none")]}) == ["train"]
    with pytest.raises(FileNotFoundError):
        store.require_inputs(spark, {"train": [p("t"), p("none")]})
    store.write_report(spark, p("r.json"), {"rows": rows.select("entity_id")}, tag="x")
    assert json.loads((tmp_path / "r.json").read_text())["rows"][0]["entity_id"].startswith("S1-")
    made = []
    parts = store.Parts(spark, p("parts"))
    for k in (1, 1, 2):
        parts.get("a", lambda: made.append(k) or rows, knob=k)
    assert made == [1, 2] and Knobs().cap == 30
    assert {tuple(r) for r in store.empty_answers(rows).collect()} == {("S1-1", ""), ("S1-2", "")}


def test_gate(spark, tmp_path):
    good = "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\n"
    s1, pool = (spark.createDataFrame([(x,) for x in ids], "entity_id string") for ids in (("S1-1", "S1-2"), ("S2-1", "S3-1")))
    path = tmp_path / "m.tsv"
    path.write_text(good)
    assert validation.gate(spark, str(path), s1, pool) == {"test_entities": 2, "matching_rows": 2, "matching_ids": 1, "matching_empty_rows": 1}
    cand = tmp_path / "c.tsv"
    cand.write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS3-1\nS1-2\t\n")
    cases = [(good.replace("S2-1", "S2-9"), "ID not in test pool"), (good.replace("S1-2", "S1-9"), "query ID not in test set"), (good.replace("S1-2\t\n", ""), "missing entity"), (good.replace("\n", "\r\n"), "CR line ending"), (good.replace("matched", "found"), "wrong header"), ("﻿" + good, "byte-order mark"), (good.split("\n")[0] + "\n", "no rows"), (good.replace("\t", ","), "comma-separated"), (good.replace("S1-2", "S1-\udcff"), "not UTF-8")]
    for text, rule in cases:
        path.write_bytes(text.encode(errors="surrogateescape"))
        with pytest.raises(ValueError, match=rule):
            validation.check_submission(spark, str(path), s1, pool)
    path.write_text(good)
    with pytest.raises(ValueError, match="match not in candidate list"):
        validation.gate(spark, str(path), s1, pool, str(cand))
    assert not path.exists() and (tmp_path / "m.tsv.rejected").exists()


def test_arrivals(spark, tmp_path):
    rows = parties(spark, SF).select("entity_id", "business_name", "business_address", "country")
    s1, pool = records.sides(rows)
    pool = party.written(party.normal.normalise_frame(pool))
    place = [str(tmp_path / x) for x in ("in", "out", "check")]
    s1.where("entity_id < 'S1-5'").coalesce(1).write.parquet(place[0])
    arrivals.link_arrivals(spark, place[0], pool, place[1], place[2])
    first = spark.read.parquet(place[1]).count()
    s1.where("entity_id >= 'S1-5'").coalesce(1).write.mode("append").parquet(place[0])
    arrivals.link_arrivals(spark, place[0], pool, place[1], place[2])
    assert 0 < first < spark.read.parquet(place[1]).count()


@pytest.mark.parametrize("name", ["edit_similarity_features", "feature_matrix", "gbdt_scores", "isotonic_scores"])
def test_queries_without_sql(spark, name):
    df = catalog_party.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name == "gbdt_scores":
        assert all(0 <= r.raw <= 1 for r in rows) and len({r.raw for r in rows}) > 5
    if name == "edit_similarity_features":
        assert all(0 <= r.token_set <= 1 for r in rows)


def test_tfidf_in_blocks_equals_all_pairs(spark):
    """Blocks, kinds of equal tokens, repeated ids and ids of two countries give what all pairs give, and only the best are written."""
    import math
    import random
    from collections import Counter, defaultdict

    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 5)))
    words = [word() for _ in range(40)]
    rows = [(f"S{1 + i % 3}-{i}", "xy"[i % 4 == 0], [rnd.choice(words) for _ in range(rnd.randint(0, 3))]) for i in range(240)]
    rows += [(f"S2-{i}", "x", [words[0], words[1]]) for i in range(1000, 1020)] + [("S1-1000", "x", [words[1], words[0]]), ("S1-1000", "x", [words[2]])]
    rows += [(i, c, [words[3], words[4]]) for i in ("S1-2000", "S2-2000") for c in "xy"]
    s1, pool = records.sides(spark.createDataFrame(rows, "entity_id string, country string, name_tokens array<string>"))

    def grams(t):
        return Counter(g for w in t for n in (3, 4) for g in [f" {w} "[i : i + n] for i in range(max(len(w) + 3 - n, 1))])

    vec, n = defaultdict(Counter), Counter(c for i, c, t in rows if t and i[:2] != "S1")
    for i, c, t in rows:
        vec[c, i] += grams(t)
    df = Counter((c, g) for (c, i), v in vec.items() if i[:2] != "S1" for g in v)
    weights = {}
    for (c, i), v in vec.items():
        known = {g: df[c, g] for g in v if df[c, g] >= 2}
        core = {g for g in known if known[g] <= math.floor(0.1 * n[c])}
        kept = core or set(sorted(known, key=lambda g: (known[g], g))[:5])
        w = {g: (math.log(v[g]) + 1) * (math.log((n[c] + 1) / (known[g] + 1)) + 1) for g in kept}
        size = math.sqrt(sum(x * x for x in w.values()))
        weights[c, i] = (bool(core), {g: x / size for g, x in w.items()})
    scores = defaultdict(float)
    for (c, i), (core, w) in weights.items():
        for (d, j), (other, v) in weights.items() if i[:2] == "S1" else ():
            if c == d and j[:2] != "S1" and core == other and w.keys() & v.keys():
                scores[i, j] += sum(w[g] * v[g] for g in w.keys() & v.keys())
    want = set()
    for i in {i for i, _ in scores}:
        best = sorted((-round(x, 8), j) for (a, j), x in scores.items() if a == i)[:4]
        want |= {(i, j, at, round(-x, 6)) for at, (x, j) in enumerate(best, 1)}
    for block in (17, 10_000):
        got = blocking.tfidf_top_k(s1, pool, k=4, df_ceiling=0.1, block=block)
        assert {(r[0], r[1], r[2], round(r[3], 6)) for r in got.collect()} == want
    assert any(i == "S1-2000" for i, *_ in want) and len(want) > 200
    kinds = spark.createDataFrame([(i, "x", True, [1], [1.0]) for i in range(50)], "kind long, country string, core boolean, g array<long>, w array<double>")
    right = kinds.selectExpr("kind as other", "'S2-' || kind as first", "country", "core", "g", "w")
    assert blocking.tfidf_nearest(kinds, right, 3, 10_000).count() == 150


def test_matrix_works_out_each_kind_once(spark, tmp_path, monkeypatch):
    """Copies of source-1 records cost no candidates or features of their own, and the rows are those of record-wise work."""
    customer = spark.read.parquet(f"{SF}/customer.parquet").where("c_custkey < 24")
    copies = customer.crossJoin(spark.range(5).withColumnRenamed("id", "copy")).withColumn("c_custkey", F.col("c_custkey") + 42000 * F.col("copy"))
    copies.drop("copy").write.parquet(f"{tmp_path}/customer.parquet")
    made = []
    whole = features.feature_columns
    monkeypatch.setattr(features, "feature_columns", lambda candidates, *a, **b: made.append(candidates.count()) or whole(candidates, *a, **b))
    got = sorted(map(tuple, party.matrix(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(blocking, "repeats_ids", lambda *a: True)
    assert got == sorted(map(tuple, party.matrix(spark, str(tmp_path)).collect()))
    assert sum(r[-1] for r in got) > 60 and made[1] == len(got) == 5 * made[0]


def test_training_rows_come_as_columns(spark, monkeypatch):
    """Rows for the driver are Arrow columns of single floats, and the model is that of the same rows as doubles."""
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("rows as Python objects"))
    rnd = np.random.default_rng(5)
    x = rnd.random((900, 3)).astype(np.float32)
    y = (x[:, 0] + 0.3 * rnd.random(900) > 0.6).astype(int)
    rows = [(f"S1-{i:04d}", f"S2-{i}", *map(float, x[i]), int(y[i]), "val" if i % 4 == 0 else "train") for i in range(900)]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, a float, b float, c float, label int, role string")
    model = training.train(df, columns=("a", "b", "c"), signs=[1, 0, 0], rounds=8, leaves=7)
    val = np.arange(900) % 4 == 0
    want = training.fit_trees(x[~val].astype(float), y[~val].astype(float), x[val].astype(float), y[val].astype(float), ["a", "b", "c"], [1, 0, 0], rounds=8, leaves=7)
    assert model.trees and model.dumps() == want.dumps()
    assert training.arrays(training.bounded(df), ("a", "b", "c"), "train")[0].dtype == np.float32


def test_trees_learn_from_all_rows(spark, monkeypatch):
    """More rows than the driver takes train the same model, none left out, and don't come to the driver."""
    rnd = np.random.default_rng(8)
    x = np.round(rnd.normal(size=(1500, 4)), 2).astype(np.float32)
    x[:, 2], x[:, 3] = np.round(x[:, 2]), 7
    y = (x[:, 0] + 0.4 * x[:, 1] * x[:, 2] + 0.3 * rnd.random(1500) > 0.6).astype(int)
    rows = [(f"S1-{i:04d}", f"S2-{i}", *map(float, x[i]), int(y[i]), ("val", "train", "train", "calib")[i % 4]) for i in range(1500)]
    more = {"columns": ("a", "b", "c", "d"), "signs": [1, 0, -1, 0], "rounds": 4, "leaves": 9}
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"source1_entity_id string, candidate_entity_id string, a {kind}, b {kind}, c {kind}, d {kind}, label int, role string").repartition(3)
        whole = training.train(df, **more)
        with monkeypatch.context() as m:
            m.setattr(training, "arrays", lambda *a: pytest.fail("rows on the driver"))
            assert training.train(df, limit=100, **more).dumps() == whole.dumps()
        assert len(whole.trees) == 4 and max(len(t.value) for t in whole.trees) == 17
    rare = np.array([-3.5, -0.0, 0.0, 2**-149, 1e30, 7, 7], np.float32)
    assert training.from_order(np.sort(training.in_order(rare))).tolist() == sorted(rare.tolist())


def test_isotonic_scores_learn_from_all_rows(spark, monkeypatch):
    """The scores of isotonic_scores don't depend on how many rows the driver takes."""
    whole, made = training.train, []
    got = []
    for limit in (10**6, 40):
        monkeypatch.setattr(training, "train", lambda rows, limit=limit, **more: made.append(whole(rows, limit=limit, **more | {"rounds": 2})) or made[-1])
        got.append(sorted(map(tuple, catalog_party.QUERIES["isotonic_scores"](spark, SF).collect())))
    assert got[0] == got[1] and made[0].trees and made[0].dumps() == made[1].dumps()


def test_address_pairs_count_every_shared_gram(spark):
    """tfidf_topk_addr is the plain cosine over all grams that two records of the pool have, however common they are."""
    import math
    from collections import Counter

    rows = [(r.entity_id, r.country, list(r.addr_tokens)) for r in party.norm(spark, SF).collect()]

    def grams(t):
        return Counter(g for w in t for n in (3, 4) for g in [f" {w} "[i : i + n] for i in range(max(len(w) + 3 - n, 1))])

    n, df = Counter(c for i, c, t in rows if t and i[:2] != "S1"), Counter((c, g) for i, c, t in rows if i[:2] != "S1" for g in grams(t))
    weights = {}
    for i, c, t in rows:
        w = {g: (math.log(m) + 1) * (math.log((n[c] + 1) / (df[c, g] + 1)) + 1) for g, m in grams(t).items() if df[c, g] >= 2}
        size = math.sqrt(sum(x * x for x in w.values()))
        weights[i, c] = {g: x / size for g, x in w.items()}
    want = set()
    for (i, c), w in weights.items():
        if i[:2] == "S1":
            near = [(-round(sum(w[g] * v[g] for g in w.keys() & v.keys()), 8), j) for (j, d), v in weights.items() if d == c and j[:2] != "S1" and w.keys() & v.keys()]
            want |= {(i, j, at, round(-x, 6)) for at, (x, j) in enumerate(sorted(near)[:5], 1)}
    got = {(r[0], r[1], r[2], round(r[3], 6)) for r in catalog_party.QUERIES["tfidf_topk_addr"](spark, SF).collect()}
    assert got == want and len(got) > 500
