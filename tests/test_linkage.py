import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyweave import catalog, catalog_party
from tallyweave.functions import text
from tallyweave.operators import blocking, matching
from tallyweave.sources import records

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


QUERIES, ORACLES = catalog.QUERIES | catalog_party.QUERIES, catalog.ORACLES | catalog_party.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = con.execute(ORACLES[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall())


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_text_functions(spark):
    assert one(spark, text.clean(F.col("a")), a="  Ünder-Score, N°5 ") == "ünder score n 5"
    assert one(spark, text.clean(F.col("a")), a=None) == ""
    assert one(spark, text.phonetic_fold(F.col("a")), a="phoooone") == "fone"
    for value, code in (("", 0), ("12", 0), ("abc", 1), ("अआ a", 2), ("தமிழ்", 7), ("Ж", 15), ("සිංහල", 15)):
        assert one(spark, text.script_of(F.col("a")), a=value) == code
    assert one(spark, text.prefix_ratio(F.col("a"), F.col("b")), a="abcd", b="abx") == 0.5
    assert one(spark, text.prefix_ratio(F.col("a"), F.col("b")), a="ab", b="ab") == 1.0
    assert one(spark, text.length_ratio(F.col("a"), F.col("b")), a="", b="ab") == 0.0


def test_tsv_keeps_empty_and_quotes(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"""ehpad"" x"\t\tFrance\nS1-2\tnull\tb\t\n')
    rows = records.read_tsv(spark, str(tmp_path / "a.tsv")).orderBy("entity_id").collect()
    assert [tuple(r) for r in rows] == [("S1-1", '"ehpad" x', "", "France"), ("S1-2", "null", "b", "")]


def test_id_lists_round_trip(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "source1_entity_id string")
    pairs = spark.createDataFrame([("a", "y", 2), ("a", "x", 1), ("a", "z", 10)], "source1_entity_id string, candidate_entity_id string, rank int")
    lists = records.id_lists(ids, pairs)
    assert {tuple(r) for r in lists.collect()} == {("a", "x,y,z"), ("b", "")}
    assert {r[1] for r in records.read_id_lists(lists).collect()} == {"x", "y", "z"}


def scored(spark, rows):
    return spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, prob double")


def test_prefix_search(spark):
    keep = lambda df, mode="p_none": sorted(r.candidate_entity_id for r in matching.prefix_search(df, mode).where("pos <= m_star").collect())
    assert keep(scored(spark, [("a", "x", 0.95), ("a", "y", 0.9), ("a", "z", 0.2)])) == ["x", "y"]
    assert keep(scored(spark, [("a", "x", 0.3)])) == [] and keep(scored(spark, [("a", "x", 0.3)]), "plugin") == ["x"]
    assert keep(scored(spark, [("a", "x", 1.0), ("a", "y", 0.1)])) == ["x"]
    owned = matching.unique_claims(scored(spark, [("b", "x", 0.5), ("a", "x", 0.5), ("c", "y", 0.1)])).collect()
    assert {(r[0], r[1]) for r in owned} == {("a", "x"), ("c", "y")}


def test_metric(spark):
    df = spark.createDataFrame([(2, 2, 3), (0, 0, 0), (0, 1, 0), (3, 3, 3), (0, 0, 2)], "c int, k int, m int")
    got = [r[0] for r in df.select(matching.f05(F.col("c"), F.col("k"), F.col("m"))).collect()]
    assert got == [pytest.approx(5 / 7), 1.0, 0.0, 1.0, 0.0]


def test_exact_key_limit_on_either_side(spark):
    row = lambda i, k: (i, "c", k)
    s1 = spark.createDataFrame([row("S1-1", "k"), row("S1-2", "k"), row("S1-3", "j"), row("S1-4", "")], "entity_id string, country string, key string")
    pool = spark.createDataFrame([row("S2-1", "k"), row("S2-2", "j"), row("S2-3", "j"), row("S2-4", "")], "entity_id string, country string, key string")
    pairs = lambda n: {(r[0], r[1]) for r in blocking.exact_key(s1, pool, [["key"]], n).collect()}
    assert pairs(2) == {("S1-1", "S2-1"), ("S1-2", "S2-1"), ("S1-3", "S2-2"), ("S1-3", "S2-3")} and pairs(1) == set()


def test_result_does_not_depend_on_partitions(spark):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("2", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(Counter(map(tuple, catalog.QUERIES["end_to_end_stub"](spark, SF).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_kernels():
    from tallyweave.functions import kernels as k

    assert k.lcs_ratio("", "a") == 0 and k.lcs_ratio("abc", "abc") == 1 and k.lcs_ratio("abcd", "abxd") == 0.75 and k.lcs_ratio("ab", "cd") == 0
    assert round(k.jaro_winkler_of("martha", "marhta"), 4) == 0.9611 and k.jaro_winkler_of("", "") == 0 and k.jaro_winkler_of("abc", "abc") == 1
    assert k.folded("Cœur Straße Øl é ñ") == "Coeur Strasse Øl e n".replace("Ø", k.LETTERS.get("Ø", "Ø"))


def test_exact_key_ranks_copies_once(spark):
    """Records that agree on every key have one ranked list; results are those of single pairs, which repeated ids still take."""
    rows = [(f"S{1 + i % 3}-{i}", "xy"[i % 2], f"a{i % 4}" if i % 11 else "", f"b{i % 3}" * (1 + 40 * (i % 5 == 0))) for i in range(240)]
    df = spark.createDataFrame(rows, "entity_id string, country string, p string, q string")
    s1, pool = records.sides(df)
    found = [blocking.family_pairs(s1, pool, c, 60).withColumn("family", F.lit(i)) for i, c in enumerate((["p"], ["p", "q"], ["q"]))]
    plain_pairs = found[0].union(found[1]).union(found[2]).groupBy(*blocking.PAIR).agg(F.countDistinct("family").alias("families"), F.min("bucket").alias("bucket"))
    want = {(r[0], r[1], r["channel_rank"], float(r["families"])) for r in blocking.ranked(plain_pairs, F.desc("families"), "bucket").collect()}
    got = blocking.exact_key(s1, pool, [["p"], ["p", "q"], ["q"]], 60)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 500
    twice = blocking.exact_key(s1, pool.union(pool.limit(1)), [["p"], ["p", "q"], ["q"]], 60)
    assert twice.count() == twice.select(*blocking.PAIR).distinct().count() > 0
    kinds, members = blocking.kinds_of(s1, ["country", "p", "q"])
    assert kinds.count() < members.count() == s1.count()


def test_parties_normalise_each_spelling_once(spark, tmp_path, monkeypatch):
    from tallyweave.plans import party

    seen, real = [], party.normal.normalise_frame
    monkeypatch.setattr(party.normal, "normalise_frame", lambda df: seen.append(df.count()) or real(df))
    spark.createDataFrame([(k + 42000 * i, k % 3) for k in range(6) for i in range(3)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r["entity_id"]: r for r in party.norm(spark, str(tmp_path)).collect()}
    want = {r["entity_id"]: r for r in real(party.parties(spark, str(tmp_path))).collect()}
    assert got == want and len(got) == 33 and seen == [11]
