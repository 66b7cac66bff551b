"""Sampling quotas and the rules that a submission must keep."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.sources.work import written


def quotas(entities: DataFrame, total: int) -> DataFrame:
    """(country, n, quota): total dealt over the countries in proportion, the rest to the largest remainders, ties in country order; all rows if total is their number or more. Rows that repeat an id count as rows, null countries as one country; an empty table gives no quotas."""
    counts = entities.groupBy("country").agg(F.count("*").alias("n"))
    # One row for each country.
    every = Window.partitionBy()
    rows = counts.withColumn("all", F.sum("n").over(every)).withColumn("base", F.floor(F.lit(total) * F.col("n") / F.col("all")))
    rest = F.lit(total) - F.sum("base").over(every)
    left = (F.lit(total).cast("long") * F.col("n")) % F.col("all")
    rows = rows.withColumn("rest", rest).withColumn("at", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(left.desc(), "country")))
    dealt = F.col("base") + F.when(F.col("at") <= F.col("rest"), 1).otherwise(0)
    return rows.select("country", "n", F.when(F.col("all") <= total, F.col("n")).otherwise(dealt).cast("long").alias("quota"))


def violations(ids: DataFrame, pool: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """(rule, source1_entity_id, candidate_entity_id) of what breaks a rule: an unknown query or pool id, a match that is no candidate, a record matched twice. A row may break several rules and then stands under each; repeated matches are matched twice; empty tables break nothing but what the others lack."""
    pair = ["source1_entity_id", "candidate_entity_id"]
    known = ids.select("source1_entity_id").distinct()
    there = pool.select(F.col("entity_id").alias("candidate_entity_id")).distinct()
    twice = matches.groupBy("candidate_entity_id").agg(F.count("*").alias("n")).where("n > 1")
    found = [("unknown query id", matches.join(known, "source1_entity_id", "left_anti")), ("unknown pool id", matches.join(there, "candidate_entity_id", "left_anti")), ("no candidate", matches.join(candidates.select(*pair).distinct(), pair, "left_anti")), ("matched twice", matches.join(twice, "candidate_entity_id", "left_semi"))]
    out = None
    for rule, rows in found:
        rows = rows.select(F.lit(rule).alias("rule"), *pair)
        out = rows if out is None else out.union(rows)
    return out


def runs(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each run of rows of one key in the order of a whole-number column: key, first, last, n. Null orders are left out; equal ones stand in the order of the key.

    Rows are dealt by ranges of the order; only the first and last run of each range can go on in the
    next one, so only those are put together in one place.
    """
    kind = rows.schema[key].dataType.simpleString()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, first = TaskContext.get().partitionId(), None, True
        for batch in batches:
            before = batch["k"].shift()
            change = ((batch["k"] != before) & ~(batch["k"].isna() & before.isna())).cumsum()
            found = batch.groupby(change).agg(k=("k", "first"), first=("o", "min"), last=("o", "max"), n=("o", "size")).reset_index(drop=True)
            if held is not None:
                a, b = held["k"].iloc[0], found["k"].iloc[0]
                if a == b or (pd.isna(a) and pd.isna(b)):
                    found.loc[0, ["first", "n"]] = [held["first"].iloc[0], held["n"].iloc[0] + found["n"].iloc[0]]
                else:
                    found = pd.concat([held, found], ignore_index=True)
            held, done = found.tail(1).reset_index(drop=True), found.head(len(found) - 1)
            if len(done):
                yield done.assign(part=part, border=[first, *[False] * (len(done) - 1)])
                first = False
        if held is not None:
            yield held.assign(part=part, border=True)

    dealt = rows.where(F.col(order).isNotNull()).select(F.col(key).alias("k"), F.col(order).cast("long").alias("o")).repartitionByRange("o").sortWithinPartitions("o", "k")
    pieces = written(dealt.mapInPandas(work, f"k {kind}, first long, last long, n long, part int, border boolean"))
    seen = Window.orderBy("part", "first")
    same = F.lag("k").over(seen).eqNullSafe(F.col("k")) & (F.lag("part").over(seen) != F.col("part"))
    marked = pieces.where("border").withColumn("fresh", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(seen.rowsBetween(Window.unboundedPreceding, 0)))
    joined = marked.groupBy("run").agg(F.first("k").alias("k"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("run")
    return joined.union(pieces.where("not border").select("k", "first", "last", "n")).withColumnRenamed("k", key)
