"""Sources: tab-separated records, id lists, and records made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.text import acronym, clean, tokens

COLUMNS = ("entity_id", "business_name", "business_address", "country")


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Tab-separated text with a header and doubled quotes; all columns are strings and empty fields stay empty."""
    schema = ", ".join(f"{c} string" for c in columns)
    rows = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("enforceSchema", False).csv(path)
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def write_id_lists(ids: DataFrame, pairs: DataFrame, path: str, column: str = "matched_entity_ids") -> None:
    """A row for each source1_entity_id of ids with its candidate_entity_ids in the order of rank, comma-separated; empty if it has none."""
    id_lists(ids, pairs, column).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "\u0000").csv(path)


def id_lists(ids: DataFrame, pairs: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    lists = pairs.groupBy("source1_entity_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "candidate_entity_id"))), lambda x: x["candidate_entity_id"]), ",").alias(column))
    return ids.select("source1_entity_id").join(lists, "source1_entity_id", "left").withColumn(column, F.coalesce(column, F.lit("")))


def read_id_lists(rows: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """The inverse: a row for each id of a list; empty ids are dropped."""
    return rows.select("source1_entity_id", F.explode(F.split(column, ",")).alias("candidate_entity_id")).where("candidate_entity_id <> ''")


def doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from documents: doc_id mod 3 gives the source, the first six words the name, all that follow the address, lang the country. Null texts and languages count as empty; whole texts are read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    w = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda x: x != "")
    rows = docs.select("doc_id", w.alias("w"), F.coalesce("lang", F.lit("")).alias("country"))
    return rows.select(
        F.concat(F.lit("S"), (F.pmod("doc_id", F.lit(3)) + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.array_join(F.slice("w", 1, 6), " ").alias("business_name"), F.array_join(F.slice("w", F.lit(7), F.greatest(F.size("w") - 6, F.lit(0))), " ").alias("business_address"), "country",
    )


def normalised(records: DataFrame) -> DataFrame:
    """Records with name_norm, addr_norm, their tokens and the acronym of the name."""
    rows = records.select("entity_id", "country", clean(F.col("business_name")).alias("name_norm"), clean(F.col("business_address")).alias("addr_norm"))
    rows = rows.withColumns({"name_tokens": tokens(F.col("name_norm")), "addr_tokens": tokens(F.col("addr_norm"))})
    return rows.withColumn("name_acronym", acronym(F.col("name_tokens")))


def sides(norm: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source 1, and the pool of all others."""
    first = F.col("entity_id").startswith("S1-")
    return norm.where(first), norm.where(~first)
