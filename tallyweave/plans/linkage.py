"""Whole queries: records from the test tables through blocking, scoring and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import kernels, lexicon, normal, text
from tallyweave.operators import blocking, checks, matching
from tallyweave.sources import records
from tallyweave.sources.work import written

FAMILIES = [["name_norm"], ["name_acronym", "addr_norm"]]
CAPS = [1, 2, 3, 5, 10, 30]


def norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.normalised(records.doc_records(spark, sf_dir))


def written_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """norm, worked out once; the lists of tokens, which hold the texts again, are split off as they are read."""
    rows = written(norm(spark, sf_dir).drop("name_tokens", "addr_tokens"))
    return rows.withColumns({"name_tokens": text.tokens(F.col("name_norm")), "addr_tokens": text.tokens(F.col("addr_norm"))})


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source-1 document with the first document of sources 2 and 3 that has its language and text: as many pairs as documents, however many copies there are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null").select("doc_id", F.coalesce("lang", F.lit("")).alias("country"), F.sha2("text", 256).alias("h"))
    who = docs.select("doc_id", (F.pmod("doc_id", F.lit(3)) + 1).alias("source"), "country", "h")
    name = F.concat(F.lit("S"), F.col("source").cast("string"), F.lit("-"), F.col("doc_id").cast("string"))
    first = who.where("source > 1").groupBy("country", "h", "source").agg(F.min("doc_id").alias("doc_id")).select("country", "h", name.alias("candidate_entity_id"))
    return who.where("source = 1").select("country", "h", name.alias("source1_entity_id")).join(first, ["country", "h"]).select("source1_entity_id", "candidate_entity_id")


#: Options of the channels on the test tables.
OPTIONS = {"exact_key": {"families": FAMILIES}, "rare_token": {"df_fraction": 0.05}, "name_tfidf": {"k": 5}}
BITS = {"name_tfidf": 1, "exact_key": 4, "rare_token": 8}


def channel(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return blocking.run_channel(name, *records.sides(norm(spark, sf_dir)), **OPTIONS[name])

    return run


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union and cap of all channels; the records are normalised once."""
    s1, pool = records.sides(written_norm(spark, sf_dir))
    return blocking.cap(blocking.union([(bit, blocking.run_channel(name, s1, pool, **OPTIONS[name])) for name, bit in BITS.items()]))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.doc_records(spark, sf_dir)
    return rows.groupBy("country").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("ids"), F.count_if(F.col("business_address") == "").alias("no_address"), F.countDistinct("business_name").alias("names"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = norm(spark, sf_dir)
    return rows.select("entity_id", "name_norm", "addr_norm", "name_acronym", text.phonetic_fold(F.col("name_norm")).alias("name_fold"), text.script_of(F.col("name_norm")).alias("script"))


def streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses made from customers, so that each street word occurs."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    words = F.array(*[F.lit(x) for x in lexicon.STREET_TYPES])
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(" north "), F.lower("c_mktsegment"), F.lit(" "), F.element_at(words, (F.col("c_custkey") % len(lexicon.STREET_TYPES) + 1).cast("int")), F.lit(" p o box 7"))
    return c.select("c_custkey", normal.street(line).alias("street"))


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made from customers with the suffixes of three countries at the end, and at the beginning."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    pick = lambda n, *values: F.element_at(F.array(*[F.lit(x) for x in values]), (F.col("c_custkey") % n + 1).cast("int"))
    name = F.trim(F.concat(pick(7, "", "", "sarl ", "", "", "sas ", ""), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.lower("c_mktsegment")), F.lit(" "), pick(8, "private limited", "inc", "sarl", "", "and co", "l l c", "pvt ltd", "sas")))
    stripped, removed = normal.legal_suffix(name, pick(3, "US", "India", "France"))
    return c.select("c_custkey", stripped.alias("stripped"), removed.alias("removed"))


def contextual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.context(candidates(spark, sf_dir))


def similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.set_similarities(channel("exact_key")(spark, sf_dir).union(channel("rare_token")(spark, sf_dir)).select(*blocking.PAIR).distinct(), norm(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.stub_scores(candidates(spark, sf_dir))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from events: the user claims one of 200 records with the fraction of the value; a pair's highest counts."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("value is not null and user_id is not null")
    rows = e.select(F.format_string("S1-%05d", "user_id").alias("source1_entity_id"), F.format_string("S2-%05d", F.pmod(F.floor("value"), F.lit(200)).cast("long")).alias("candidate_entity_id"), F.round(F.col("value") - F.floor("value"), 6).alias("prob"))
    return rows.groupBy(*blocking.PAIR).agg(F.max("prob").alias("prob"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.unique_claims(scored_events(spark, sf_dir))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matching.prefix_search(claims(spark, sf_dir))
    return rows.select("source1_entity_id", F.round("k", 6).alias("k_hat"), "empty_ef", "best_ef", "m_star").distinct()


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.prefix_search(claims(spark, sf_dir)).where("pos <= m_star").select(*blocking.PAIR)


def match_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.prefix_search(claims(spark, sf_dir)).where("pos <= m_star").withColumnRenamed("pos", "rank")
    return records.id_lists(scored_events(spark, sf_dir).select("source1_entity_id").distinct(), found)


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = norm(spark, sf_dir).where("entity_id like 'S1-%'").select(F.col("entity_id").alias("source1_entity_id"), "country")
    return matching.per_entity(entities, truth(spark, sf_dir), channel("exact_key")(spark, sf_dir))


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.breakdown(evaluated(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event scores with label 1 where the record's number is a multiple of 3, and prob as the prior."""
    return scored_events(spark, sf_dir).withColumn("label", F.when(F.substring("candidate_entity_id", 4, 5).cast("int") % 3 == 0, 1).otherwise(0)).withColumn("prior_score", F.col("prob"))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.hard_negatives(labelled(spark, sf_dir)).select(*blocking.PAIR, "label")


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.reliability(labelled(spark, sf_dir))


def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.threshold_rule(scored_events(spark, sf_dir), 0.6, 5, 0.2)


def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.cap_sweep(candidates(spark, sf_dir), truth(spark, sf_dir), CAPS)


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaro-Winkler similarity of each part's name and type, which are ASCII."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.lower("p_name").alias("a"), F.lower("p_type").alias("b"))
    return part.select("p_partkey", F.round(kernels.jaro_winkler(F.col("a"), F.col("b")), 6).alias("jaro_winkler"))


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records.doc_records(spark, sf_dir)
    return rows.select("entity_id", kernels.fold_accents(F.col("business_name")).alias("name_ascii"))


def stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.quotas(norm(spark, sf_dir).where("entity_id like 'S1-%'"), 100)


def submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact-key pairs checked as matches against the TF-IDF candidates."""
    s1, pool = records.sides(norm(spark, sf_dir))
    ids = s1.where(F.col("country") != "es").withColumnRenamed("entity_id", "source1_entity_id")
    return checks.violations(ids, pool.where(F.col("country") != "fr"), channel("name_tfidf")(spark, sf_dir), channel("exact_key")(spark, sf_dir))


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final matches of the documents' records: blocking, stub scores, one owner each, best prefix."""
    rows = matching.prefix_search(matching.unique_claims(scored(spark, sf_dir)))
    return rows.where("pos <= m_star").select(*blocking.PAIR, F.round("prob", 6).alias("prob"))
