"""Whole queries over the business records of the customers, and over literal values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import kernels, normal, script, text
from tallyweave.knobs import FAMILIES, Knobs
from tallyweave.operators import blocking, checks, diagnostics, embedding, features, matching, sampling, training, validation
from tallyweave.plans import linkage
from tallyweave.sources import records
from tallyweave.sources.parties import parties, party_truth
from tallyweave.sources.work import written

PAIR = matching.PAIR
KNOBS = Knobs(rare_df_fraction=0.05, tfidf_top_k=5)


def norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised records; each spelling of a name, address and country is normalised once, however many records have it."""
    raw = ("business_name", "business_address", "country")
    rows = parties(spark, sf_dir).withColumn("spelling", F.to_json(F.struct(*raw)))
    once = rows.select(F.col("spelling").alias("entity_id"), *raw).dropDuplicates(["entity_id"]).repartition(spark.sparkContext.defaultParallelism, "entity_id")
    done = normal.normalise_frame(once)
    columns = done.columns
    return rows.select("entity_id", "spelling").join(done.withColumnRenamed("entity_id", "spelling"), "spelling").select(*columns)


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm(spark, sf_dir).select("entity_id", "street_num", "city_norm", "state_canon", "postcode")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm(spark, sf_dir).select("entity_id", "country", "name_norm", "name_roman", "name_suffix", "name_acronym", "addr_roman", "has_addr", F.col("script").bitwiseAND(F.lit(15)).cast("int").alias("name_script"), F.shiftright("script", 4).cast("int").alias("addr_script"))


def state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses taken apart, each part looked up in the table of states: records by state, and the first place at which it stands."""
    rows = parties(spark, sf_dir).select("entity_id", "country", F.posexplode(F.split(normal.clean_expr(F.col("business_address")), ",")).alias("pos", "part"))
    alpha = F.trim(F.regexp_replace(text.phonetic_fold(normal.spaced(F.col("part"))), r"\s*\S*\d\S*\s*", " "))
    found = rows.withColumn("alpha", alpha).join(F.broadcast(normal.state_table(spark)), ["country", "alpha"])
    return found.groupBy("entity_id", "country").agg(F.min_by("state", "pos").alias("state")).groupBy("country", "state").agg(F.count("*").alias("n"))


def family_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.run_channel("exact_key", *records.sides(norm(spark, sf_dir)), **KNOBS.options()["exact_key"])


def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, pool = records.sides(written(norm(spark, sf_dir)))
    names, truth = ["+".join(f) for f in FAMILIES], party_truth(parties(spark, sf_dir))
    if blocking.repeats_ids(s1, pool):
        return diagnostics.family_ablation([(name, blocking.family_pairs(s1, pool, list(f))) for name, f in zip(names, FAMILIES, strict=True)], truth)
    left, right = (blocking.kinds_of(x, ["country", *dict.fromkeys(c for f in FAMILIES for c in f)]) for x in (s1, pool))
    return diagnostics.kind_ablation(names, blocking.kind_pairs(left[0], right[0], [list(f) for f in FAMILIES]), left, right, truth)


def addr_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.run_channel("addr_tfidf", *records.sides(norm(spark, sf_dir)), **KNOBS.options()["addr_tfidf"])


def pairs_of(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Candidates of the records by names, exact keys and rare tokens."""
    options = KNOBS.options()
    found = [(1 << i, blocking.run_channel(name, s1, pool, **options[name])) for i, name in enumerate(features.CHANNELS) if name in ("name_tfidf", "exact_key", "rare_token")]
    return written(blocking.cap(blocking.union(found), 10))


def kind_pairs_of(own: DataFrame, pool: DataFrame) -> DataFrame:
    """pairs_of for own, kinds of source-1 records (entity_id, n and their columns), with n."""
    options, bit = KNOBS.options(), {name: 1 << i for i, name in enumerate(features.CHANNELS)}
    found = [(bit["name_tfidf"], blocking.run_channel("name_tfidf", own, pool, **options["name_tfidf"])), (bit["rare_token"], blocking.run_channel("rare_token", own, pool, weight="n", **options["rare_token"]))]
    cands = blocking.kind_candidates(own, pool, found, (bit["exact_key"], options["exact_key"]), 10)
    return written(cands.join(own.select(F.col("entity_id").alias(PAIR[0]), "n"), PAIR[0]))


def component_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-part comparisons of the exact-key pairs; records that agree on all columns are compared once."""
    s1, pool = records.sides(written(norm(spark, sf_dir)))
    families, columns = [list(f) for f in FAMILIES], [c for c in s1.columns if c != "entity_id"]

    def compared(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
        got = features.component_matches(*({c: F.col(f"{p}_{c}") for c in columns} for p in "ab"))
        return features.joined(pairs, a, b).select(*PAIR, *[F.round(v, 6).alias(k) for k, v in got.items()])

    if blocking.repeats_ids(s1, pool):
        return compared(blocking.exact_key(s1, pool, families).select(*PAIR), s1, pool)
    (a, own), (b, others) = (blocking.kinds_of(x, columns) for x in (s1, pool))
    pairs = blocking.kind_pairs(a, b, families).select(F.col("l").alias(PAIR[0]), F.col("r").alias(PAIR[1])).distinct()
    rows = written(compared(pairs, *(x.withColumnRenamed("kind", "entity_id").drop("n") for x in (a, b))))
    member = lambda df, x: df.select(F.col("kind").alias(x), F.col("entity_id").alias(f"{x}_id"))
    full = rows.join(member(others, PAIR[1]), PAIR[1]).join(member(own, PAIR[0]), PAIR[0])
    return full.select(*[F.col(f"{x}_id").alias(x) for x in PAIR], *rows.columns[2:])


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 71 features of the candidates, with the embedding search of hashed names, and the label. Source-1 records that agree on all columns have the same candidates and features, which are worked out once."""
    s1, pool = records.sides(written(norm(spark, sf_dir)))
    truth = party_truth(parties(spark, sf_dir))
    vector = lambda df: df.select("entity_id", "country", embedding.hashed_vector(F.col("name_roman")).alias("embedding"))
    if blocking.repeats_ids(s1, pool):
        return features.feature_matrix(pairs_of(s1, pool), s1, pool, embedding.embed_top_k(vector(s1), vector(pool), 5), truth)
    kinds, members = blocking.kinds_of(s1, [c for c in s1.columns if c != "entity_id"])
    own = kinds.withColumn("entity_id", F.col("kind").cast("string")).drop("kind")
    cands, own = kind_pairs_of(own, pool), own.drop("n")
    rows = written(features.feature_matrix(cands, own, pool, embedding.embed_top_k(vector(own), vector(pool), 5), weight="n"))
    return features.of_members(rows, members, truth)


def edit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All edit similarities of each part's name and type."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.lower("p_name").alias("a"), F.lower("p_type").alias("b"))
    rows = part.withColumn("s", kernels.edit_similarities(F.col("a"), F.col("b"))).withColumn("domain", kernels.domain_match(F.concat("a", F.lit(".com")), F.col("b")))
    return rows.select("p_partkey", *[F.round(f"s.{x}", 6).alias(x) for x in kernels.EDITS], "domain")


def trained(spark: SparkSession, sf_dir: str, **more) -> tuple[DataFrame, training.Boosted]:
    """Features with roles, and a model of few rounds."""
    rows = written(matrix(spark, sf_dir))
    parts = written(training.slices(rows.withColumn("prior_score", F.col(features.COLUMNS[features.NAMES.index("prior_score")]))))
    return parts, training.train(parts, **({"rounds": 20, "leaves": 15, "patience": 5} | more))


def gbdt(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, model = trained(spark, sf_dir)
    return training.predict(parts, model).withColumn("raw", F.round("raw", 6))


def isotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, model = trained(spark, sf_dir)
    scored = written(training.predict(parts, model).join(parts.select(*PAIR, "label", "role", "bucket"), list(PAIR)))
    fitted = training.isotonic(scored.where("role = 'calib'"))
    return training.calibrated(scored.where("role <> 'calib'"), fitted).select(*PAIR, "prob")


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by the role of a bucket that both engines can tell."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy(training.role_of(F.col("c_custkey") % 100).alias("role")).agg(F.count("*").alias("n"))


def brier_ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.quality(linkage.labelled(spark, sf_dir))


def reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten bins, and one around 0.7."""
    rows = linkage.labelled(spark, sf_dir)
    return training.reliability_table(rows).union(training.reliability_table(rows, low=0.65, high=0.75, bins=1))


def entities_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.norm(spark, sf_dir).where("entity_id like 'S1-%'").select(F.col("entity_id").alias(PAIR[0]), "country")


def cap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.cap_report(linkage.candidates(spark, sf_dir), linkage.truth(spark, sf_dir), entities_of(spark, sf_dir), linkage.CAPS)


def channel_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.channel_slots(linkage.candidates(spark, sf_dir), linkage.truth(spark, sf_dir), entities_of(spark, sf_dir))


def channel_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by country, a column for each number of channels that found them."""
    rows = linkage.candidates(spark, sf_dir).join(entities_of(spark, sf_dir), PAIR[0])
    return rows.groupBy("country").pivot("n_channels", [1, 2, 3]).agg(F.count(F.lit(1))).na.fill(0).select("country", *[F.col(str(i)).alias(f"by_{i}") for i in (1, 2, 3)])


def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, _ = records.sides(linkage.norm(spark, sf_dir))
    return blocking.channel_stats(linkage.channel("exact_key")(spark, sf_dir), s1)


def crossed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source-1 documents matched with the next document, whatever its language."""
    docs = records.doc_records(spark, sf_dir).select("entity_id", "country")
    s1, pool = records.sides(docs)
    number = F.substring("entity_id", 4, 20).cast("long")
    truth = s1.select(F.col("entity_id").alias(PAIR[0]), F.concat(F.lit("S2-"), (number + 1).cast("string")).alias(PAIR[1]))
    return truth, s1, pool


def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.country_consistency(*crossed(spark, sf_dir)).drop("set")


def mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.mismatches(*crossed(spark, sf_dir))


def ranked_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Event scores squeezed into 0.75 to 1 with their rank, the labelled pairs, and all entities."""
    rows = linkage.labelled(spark, sf_dir).withColumn("channel_score", F.round(0.75 + F.col("prob") / 4, 6))
    return blocking.ranked(rows, F.desc("channel_score")), rows.where("label = 1").select(*PAIR), rows.select(PAIR[0]).distinct()


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnostics.threshold_sweep(*ranked_events(spark, sf_dir))


def sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By country: entities that a stratified sample of 40 keeps beside the first hundred ids."""
    rows = linkage.norm(spark, sf_dir).where("entity_id like 'S1-%'").select("entity_id", "country")
    held = rows.where(F.substring("entity_id", 4, 20).cast("long") < 100)
    return sampling.stratified(rows, 40, held).groupBy("country").agg(F.count("*").alias("n"))


def smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of a small training set: 50 entities, their true records and a third as many others."""
    rows = parties(spark, sf_dir)
    s1, pool = records.sides(rows)
    cut = sampling.smoke_train(s1, pool, party_truth(rows), 50, 1.0)
    both = written(cut["truth"])
    others = both.join(cut["s1"].select(F.col("entity_id").alias(PAIR[0])), PAIR[0], "left_anti").count()
    facts = [("entities", cut["s1"].count()), ("pool records for 100 true ones", round(100 * cut["pool"].count() / max(1, both.count()))), ("truth of others", others)]
    return spark.createDataFrame(facts, "what string, n long")


def held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities on either side of a split of 30."""
    s1, _ = records.sides(parties(spark, sf_dir))
    return sampling.make_split(s1.select("entity_id", "country"), 30).groupBy("held_out").agg(F.count("*").alias("n"))


def embed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third vector against all others of its label's parity."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id is not null and embedding is not null")
    rows = e.select(F.concat(F.when(F.col("vec_id") % 3 == 0, "S1-").otherwise("S2-"), F.col("vec_id").cast("string")).alias("entity_id"), (F.col("label") % 2).cast("string").alias("country"), "embedding")
    s1, pool = records.sides(rows)
    return embedding.embed_top_k(s1, pool, 5, digits=5)


def embed_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search's pairs as a channel: rank 3 or better, of records with an even number."""
    e = embed_topk(spark, sf_dir)
    even = e.select(F.col(PAIR[1]).alias("entity_id")).distinct().where(F.substring("entity_id", 4, 20).cast("long") % 2 == 0)
    return blocking.run_channel("embed_ann", e.select(F.col(PAIR[0]).alias("entity_id")).distinct(), even, pairs=e, top=3)


# Texts and what the normaliser makes of them.
SCRIPTS = [("", 0, ""), ("123 - ,", 0, "123 - ,"), ("Acme Inc", 1, "Acme Inc"), ("विजय प्रोजेक्ट्स प्राइवेट लिमिटेड", 2, "vijay projekts praivet limited"), ("महाराष्ट्र", 2, "maharashtr"), ("ரா", 7, "ra"), ("দিল্লি", 3, "dilli"), ("Москва", 15, "Москва")]
JUNK = [("CEDAR STREET, null, MONTICELLO, IA", "cedar street, monticello, ia"), ("Fairfield, Bldg N/A, 138 Armstrong Street", "fairfield, bldg, 138 armstrong street"), ("ＡＣＭＥ   Ｉｎｃ", "acme inc"), ("N0032 N/A N/A K N Roy Road", "n0032 k n roy road"), ("<< Team Ecole", "team ecole"), ("null", "")]
FILE = ["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,S3-2", "S1-2\t", "S1-2\tS2-2", "S2-3\t", "S1-4\tS2-1,S2-1", "S1-5\tS2-1,", "S1-6\tnull", "S1-7\tS1-8", "S1-9", "S1-10\t\"S2-1\"", "S1-11\tS2-1, S2-2", "S1-12\tX-1", " S1-13\t", "S1-14\t  "]
BROKEN = [(4, "duplicate row"), (5, "query ID prefix"), (6, "repeated ID in list"), (7, "empty ID in list"), (8, "NaN/None literal"), (9, "self-match"), (10, "wrong column count"), (11, "quoted field"), (12, "whitespace in ID"), (13, "ID prefix"), (14, "whitespace in query ID"), (15, "whitespace-only list")]


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(t,) for t, _, _ in SCRIPTS], "text string")
    return rows.select("text", text.script_of(F.col("text")).alias("script"), script.romanise(F.col("text")).alias("roman"))


def junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t, _ in JUNK], "text string").select("text", normal.clean_expr(F.col("text")).alias("cleaned"))


def file_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.format_violations(spark.createDataFrame(list(enumerate(FILE, 1)), "line long, raw string"), "matching")


def file_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact-key lists of documents against ids and candidates that lack some."""
    s1, pool = records.sides(linkage.written_norm(spark, sf_dir))
    exact, near = (blocking.run_channel(name, s1, pool, **linkage.OPTIONS[name]) for name in ("exact_key", "name_tfidf"))
    lists = lambda df: df.groupBy(PAIR[0]).agg(F.array_sort(F.collect_list(PAIR[1])).alias("ids")).select(F.substring(PAIR[0], 4, 20).cast("long").alias("line"), PAIR[0], "ids")
    return validation.set_violations(lists(exact), s1.where("country <> 'es'"), pool.where("country <> 'fr'"), lists(near))


def contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of events of one user in the order of events: how many runs, and users that come back later."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").where("user_id is not null and event_id is not null")
    return checks.runs(rows, "user_id", "event_id").groupBy().agg(F.count("*").alias("runs"), F.countDistinct("user_id").alias("users"))


def overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that stand on both sides of a split by hash, of which there are none, and all ids."""
    s1, _ = records.sides(parties(spark, sf_dir))
    held = diagnostics.hash_split(F.col("entity_id"))
    both = s1.where(held).select("entity_id").intersect(s1.where(~held).select("entity_id"))
    return both.agg(F.count("*").alias("shared")).crossJoin(s1.agg(F.count("*").alias("ids")))

