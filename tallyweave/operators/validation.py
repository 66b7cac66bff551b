"""The rules that a submission's files must keep, each line judged where it is; the first violation counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What a file must look like, and spellings of nothing that aren't allowed.
KEY = "source1_entity_id"
HEADERS = {"matching": (KEY, "matched_entity_ids"), "candidate": (KEY, "candidate_entity_ids")}
NOTHING = ("none", "nan", "null", "na", "n/a", "[]", "nat", "<na>")


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(line, raw): the lines of a file from 1 on, with carriage returns. Offsets give the order, so files of any size are read in parts."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    sizes = rows.groupBy("block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row for each block of the file.
    before = sizes.select("block", "first", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(before), "block").select((F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "raw")


def has_mark(spark: SparkSession, path: str) -> bool:
    """Whether a file begins with a byte-order mark, which Spark's reader passes over."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(at)
    try:
        return [file.read() for _ in range(3)] == [0xEF, 0xBB, 0xBF]
    finally:
        file.close()


def format_rules(kind: str) -> list[tuple[str, Column]]:
    """Rules of a line in the order in which they are judged: name, and where it is broken. Needs line, raw, first_line (of its query id)."""
    raw, want = F.col("raw"), "\t".join(HEADERS[kind])
    head, body = F.col("line") == 1, F.col("line") > 1
    tabs = F.regexp_count(raw, F.lit("\t"))
    query, rest = F.split(raw, "\t")[0], F.coalesce(F.get(F.split(raw, "\t"), F.lit(1)), F.lit(""))
    ids = F.split(rest, ",")
    listed = body & (rest != "")
    some = lambda broken: listed & F.exists(ids, broken)
    bare = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return [
        ("CR line ending", raw.contains("\r")), ("not UTF-8", ~F.is_valid_utf8(raw)), ("byte-order mark", head & raw.startswith("﻿")),
        ("comma-separated", head & ~raw.contains("\t") & raw.contains(",")), ("index column", head & raw.endswith("\t" + want) & (tabs == 2)), ("wrong header", head & (raw != want)),
        ("quoted field", body & raw.contains('"')), ("blank line", body & (tabs == 0) & (bare(raw) == "")), ("wrong column count", body & (tabs != 1)),
        ("whitespace in query ID", body & (query != bare(query))), ("query ID prefix", body & ~query.startswith("S1-")), ("duplicate row", body & (F.col("line") > F.col("first_line"))),
        ("whitespace-only list", listed & (bare(rest) == "")), ("NaN/None literal", listed & F.lower(bare(rest)).isin(*NOTHING)),
        ("empty ID in list", some(lambda x: x == "")), ("whitespace in ID", some(lambda x: x != bare(x))), ("self-match", some(lambda x: x.startswith("S1-"))),
        ("ID prefix", some(lambda x: ~x.startswith("S2-") & ~x.startswith("S3-"))), ("repeated ID in list", listed & (F.size(F.array_distinct(ids)) < F.size(ids))),
    ]


def format_violations(lines: DataFrame, kind: str) -> DataFrame:
    """(line, rule): each line's first broken rule. lines: (line, raw)."""
    own = F.when(F.col("line") > 1, F.split("raw", "\t")[0])
    first = lines.where("line > 1").groupBy(F.split("raw", "\t")[0].alias("own")).agg(F.min("line").alias("first_line"))
    rows = lines.withColumn("own", own).join(first, "own", "left")
    rule = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in format_rules(kind)])
    return rows.select("line", rule.alias("rule")).where("rule is not null")


def parsed(lines: DataFrame) -> DataFrame:
    """(line, source1_entity_id, ids) of the body of a well-formed file."""
    return lines.where("line > 1").select("line", F.split("raw", "\t")[0].alias(KEY), F.filter(F.split(F.split("raw", "\t")[1], ","), lambda x: x != "").alias("ids"))


def set_violations(rows: DataFrame, s1_ids: DataFrame, pool_ids: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """(rule, line, source1_entity_id, id): query ids and listed ids that don't exist, matches that are no candidates, and entities without a row (line null). s1_ids, pool_ids: entity_id; rows, candidates: as parsed."""
    known = lambda df, name: df.select(F.col("entity_id").alias(name)).distinct()
    long = rows.select("line", KEY, F.explode("ids").alias("id"))
    none = F.lit(None).cast("string")
    out = rows.join(known(s1_ids, KEY), KEY, "left_anti").select(F.lit("query ID not in test set").alias("rule"), "line", KEY, none.alias("id"))
    out = out.union(long.join(known(pool_ids, "id"), "id", "left_anti").select(F.lit("ID not in test pool"), "line", KEY, "id"))
    if candidates is not None:
        allowed = candidates.select(KEY, F.explode("ids").alias("id")).distinct()
        out = out.union(long.join(allowed, [KEY, "id"], "left_anti").select(F.lit("match not in candidate list"), "line", KEY, "id"))
    missing = known(s1_ids, KEY).join(rows.select(KEY).distinct(), KEY, "left_anti")
    return out.union(missing.select(F.lit("missing entity (completeness)"), F.lit(None).cast("long"), KEY, none))


def check_submission(spark: SparkSession, matching: str, s1_ids: DataFrame, pool_ids: DataFrame, candidate: str | None = None) -> dict:
    """Counts of the files, or ValueError with the first violation: formats in the order of lines, then sets in the order of rules and lines."""
    report, tables = {"test_entities": s1_ids.count()}, {}
    for kind, path in (("matching", matching), ("candidate", candidate)):
        if path is None:
            continue
        if has_mark(spark, path):
            raise ValueError(f"{kind}, line 1: byte-order mark")
        lines = lines_of(spark, path)
        if bad := format_violations(lines, kind).orderBy("line").first():
            raise ValueError(f"{kind}, line {bad['line']}: {bad['rule']}")
        tables[kind] = parsed(lines)
        counts = tables[kind].agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("ids"), F.count_if(F.size("ids") == 0).alias("empty")).first()
        if not counts["n"]:
            raise ValueError(f"{kind}: no rows")
        report |= {f"{kind}_rows": counts["n"], f"{kind}_ids": counts["ids"], f"{kind}_empty_rows": counts["empty"]}
    for kind, rows in tables.items():
        found = set_violations(rows, s1_ids, pool_ids, tables.get("candidate") if kind == "matching" else None)
        order = F.array_position(F.lit(["query ID not in test set", "ID not in test pool", "match not in candidate list", "missing entity (completeness)"]), F.col("rule"))
        if bad := found.orderBy(order, "line", KEY, "id").first():
            raise ValueError(f"{kind}, {'line ' + str(bad['line']) if bad['line'] else bad[KEY]}: {bad['rule']}")
    return report


def gate(spark: SparkSession, matching: str, s1_ids: DataFrame, pool_ids: DataFrame, candidate: str | None = None) -> dict:
    """check_submission; files that break a rule are renamed with .rejected behind them, so that nobody sends them, and the error goes on."""
    try:
        return check_submission(spark, matching, s1_ids, pool_ids, candidate)
    except ValueError:
        for path in filter(None, (matching, candidate)):
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).rename(at, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + ".rejected"))
        raise
