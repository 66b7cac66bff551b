"""From candidates to matches: features, scores, one owner for each record, the best prefix, and the metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.text import char_grams, containment, jaccard, length_ratio, prefix_ratio

PAIR = ("source1_entity_id", "candidate_entity_id")


def context(candidates: DataFrame, weight: str | None = None) -> DataFrame:
    """Candidates with what their entity and their record have elsewhere: best score and count of each, margin, and whether this claim is the record's best.

    Equal scores are all best; repeated candidates count as often as they stand; null scores are passed
    over by the best and have null margins; an empty table stays empty. A row makes as many claims as
    its weight, a column that tells for how many entities it stands.
    """
    entity, record = Window.partitionBy("source1_entity_id"), Window.partitionBy("candidate_entity_id")
    claims = F.count("*") if weight is None else F.sum(weight)
    rows = candidates.withColumns({"entity_best": F.max("prior_score").over(entity), "entity_n_cands": F.count("*").over(entity), "cand_best_score": F.max("prior_score").over(record), "cand_n_claims": claims.over(record)})
    return rows.withColumns({
        "margin_to_best": F.round(F.col("entity_best") - F.col("prior_score"), 8), "reciprocal_rank": F.round(1 / F.col("best_rank"), 8),
        "is_source3": F.col("candidate_entity_id").startswith("S3-").cast("int"), "cand_is_argmax": (F.col("prior_score") >= F.col("cand_best_score") - 1e-7).cast("int"),
    })


def set_similarities(pairs: DataFrame, norm: DataFrame) -> DataFrame:
    """Token and character set similarities of the names of each pair, rounded to 8 places.

    A side without tokens or characters makes its similarities 0, and null names count as empty; pairs
    of unknown records give no row; repeated pairs stay. Grams are made once for each record.
    """
    name, words = F.coalesce("name_norm", F.lit("")), F.coalesce("name_tokens", F.array().cast("array<string>"))
    side = lambda p: norm.select(F.col("entity_id").alias(f"{p}_id"), name.alias(f"{p}_name"), words.alias(f"{p}_tokens"), char_grams(name, 3).alias(f"{p}_grams"))
    rows = pairs.select(*PAIR).join(side("a"), F.col("source1_entity_id") == F.col("a_id")).join(side("b"), F.col("candidate_entity_id") == F.col("b_id"))
    a, b, x, y = (F.col(c) for c in ("a_name", "b_name", "a_tokens", "b_tokens"))
    r = lambda c, name: F.round(c, 8).alias(name)
    return rows.select(*PAIR, r(jaccard(x, y), "token_jaccard"), r(containment(x, y), "token_containment"), r(jaccard(F.col("a_grams"), F.col("b_grams")), "char3_jaccard"), r(prefix_ratio(a, b), "prefix_ratio"), r(length_ratio(a, b), "length_ratio"))


def stub_scores(candidates: DataFrame) -> DataFrame:
    """prob: prior_score on a scale from 0 to 1 within its entity; 0.5 where all are equal or null. Repeated rows stay; an empty table stays empty."""
    entity = Window.partitionBy("source1_entity_id")
    low, high = F.min("prior_score").over(entity), F.max("prior_score").over(entity)
    rows = candidates.withColumns({"low": low, "high": high})
    return rows.select(*PAIR, F.when(F.col("high") > F.col("low"), F.round((F.col("prior_score") - F.col("low")) / (F.col("high") - F.col("low")), 8)).otherwise(0.5).alias("prob"))


def unique_claims(scored: DataFrame) -> DataFrame:
    """Each record stays with the entity that claims it with the highest probability; ties to the smaller entity id, null probabilities last. A repeated claim stays once."""
    at = F.row_number().over(Window.partitionBy("candidate_entity_id").orderBy(F.desc("prob"), "source1_entity_id"))
    return scored.withColumn("claim", at).where("claim = 1").drop("claim")


def prefix_search(scored: DataFrame, mode: str = "p_none") -> DataFrame:
    """All pairs with m_star, the number of best candidates to keep for the highest expected F0.5 (0: none), and pos, the place of the pair.

    Expected F0.5 of the first m: 1.25 c / (0.25 k + m), with c their and k all probabilities summed;
    that of no candidate is the probability that none is right (p_none), or 1 if k is 0 (plugin). The
    shortest of equally good prefixes counts, and none wins over equals.
    """
    order = Window.partitionBy("source1_entity_id").orderBy(F.desc("prob"), "candidate_entity_id")
    entity = Window.partitionBy("source1_entity_id")
    rows = scored.withColumns({"pos": F.row_number().over(order), "c": F.sum("prob").over(order.rowsBetween(Window.unboundedPreceding, 0)), "k": F.sum("prob").over(entity)})
    rows = rows.withColumn("ef", F.round(1.25 * F.col("c") / (0.25 * F.col("k") + F.col("pos")), 8))
    none = F.round(F.product(1 - F.col("prob")), 8) if mode == "p_none" else F.when(F.max("k") == 0, 1.0).otherwise(0.0)
    best = rows.groupBy("source1_entity_id").agg(F.max("ef").alias("best_ef"), none.alias("empty_ef"))
    rows = rows.join(best, "source1_entity_id")
    first = rows.where(F.col("ef") == F.col("best_ef")).groupBy("source1_entity_id").agg(F.min("pos").alias("m"))
    return rows.join(first, "source1_entity_id").withColumn("m_star", F.when(F.col("empty_ef") >= F.col("best_ef"), 0).otherwise(F.col("m")))


def f05(c: Column, k: Column, m: Column) -> Column:
    """F0.5 of c right among m predicted of k true; with no true ones 1 if none is predicted."""
    return F.when(k == 0, F.when(m == 0, 1.0).otherwise(0.0)).when(m == 0, 0.0).otherwise(1.25 * c / (0.25 * k + m))


def per_entity(entities: DataFrame, truth: DataFrame, predicted: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """k true, m predicted, c right, k_in_cand true among candidates (those predicted, if none are given) and F0.5 of each source1_entity_id of entities. Repeated pairs count once, pairs of other entities not at all."""
    side = lambda df, *flags: df.select(*PAIR, *[F.lit(x).alias(n) for n, x in zip("tpx", flags, strict=True)])
    both = side(truth, 1, 0, 0).union(side(predicted, 0, 1, 0)).union(side(predicted if candidates is None else candidates, 0, 0, 1))
    pairs = both.groupBy(*PAIR).agg(*[F.max(n).alias(n) for n in "tpx"])
    counts = pairs.groupBy("source1_entity_id").agg(F.sum("t").alias("k"), F.sum("p").alias("m"), F.sum(F.col("t") * F.col("p")).alias("c"), F.sum(F.col("t") * F.col("x")).alias("k_in_cand"))
    rows = entities.join(counts, "source1_entity_id", "left").na.fill(0, ["k", "m", "c", "k_in_cand"])
    return rows.withColumn("f05", F.round(f05(F.col("c"), F.col("k"), F.col("m")), 8))


def require_predictions(entities: DataFrame, answered: DataFrame) -> None:
    """Refuses entities without a row among those answered (an empty answer is a row)."""
    missing = entities.select("source1_entity_id").distinct().join(answered.select("source1_entity_id").distinct(), "source1_entity_id", "left_anti")
    if first := missing.orderBy("source1_entity_id").first():
        raise ValueError(f"no prediction for {missing.count()} entities, first {first[0]}")


def macro_f05(entities: DataFrame, truth: DataFrame, lists: DataFrame, column: str = "matched_entity_ids") -> float | None:
    """Mean F0.5 of the entities whose answers are comma lists; an entity without a list is an error."""
    from tallyweave.sources.records import read_id_lists

    require_predictions(entities, lists)
    return per_entity(entities, truth, read_id_lists(lists, column)).agg(F.avg("f05")).first()[0]


def restricted(entities: DataFrame, held_out: DataFrame, scored: DataFrame) -> DataFrame:
    """Entities that are held out and have scores."""
    for other in (held_out, scored):
        entities = entities.join(other.select(F.col(other.columns[0]).alias("source1_entity_id")).distinct(), "source1_entity_id", "left_semi")
    return entities


def breakdown(rows: DataFrame) -> DataFrame:
    """Entities, macro F0.5, micro precision and recall, recall of blocking, mean number predicted, and how many entities without a true match were left alone: overall, by country and by number of true matches, in one aggregation. Shares of nothing are null."""
    bucket = F.when(F.col("k") <= 0, "0").when(F.col("k") <= 1, "1").when(F.col("k") <= 3, "2-3").when(F.col("k") <= 5, "4-5").otherwise("6+")
    rows = rows.withColumn("k_bucket", bucket)
    sets = rows.groupingSets([[], [F.col("country")], [F.col("k_bucket")]], "country", "k_bucket")
    share = lambda a, b, name: F.round(F.try_divide(a, b), 6).alias(name)
    return sets.agg(
        F.count("*").alias("entities"), F.round(F.avg("f05"), 6).alias("macro_f05"), share(F.sum("c"), F.sum("m"), "precision"), share(F.sum("c"), F.sum("k"), "recall"),
        share(F.sum("k_in_cand"), F.sum("k"), "blocking_recall"), F.round(F.avg("m"), 6).alias("mean_predicted"), share(F.count_if((F.col("k") == 0) & (F.col("m") == 0)), F.count_if(F.col("k") == 0), "singleton_accuracy"),
    )


def hard_negatives(rows: DataFrame, ratio: float = 2.0, least: int = 3) -> DataFrame:
    """All positives (label 1) and for each entity its ratio times as many negatives, least or more, with the highest prior score; ties to the smaller candidate id, repeated rows count as rows."""
    order = Window.partitionBy("source1_entity_id", "label").orderBy(F.desc("prior_score"), "candidate_entity_id")
    marked = rows.withColumns({"nth": F.row_number().over(order), "n_pos": F.sum("label").over(Window.partitionBy("source1_entity_id"))})
    return marked.where((F.col("label") == 1) | (F.col("nth") <= F.greatest(F.ceil(F.lit(ratio) * F.col("n_pos")), F.lit(least)))).drop("nth", "n_pos")


def reliability(rows: DataFrame) -> DataFrame:
    """Count, mean probability and rate of label 1 in tenths of prob; 1 belongs to the last."""
    tenth = F.least(F.floor(F.col("prob") * 10), F.lit(9)).cast("int")
    return rows.groupBy(tenth.alias("tenth")).agg(F.count("*").alias("n"), F.round(F.avg("prob"), 6).alias("mean_prob"), F.round(F.avg("label"), 6).alias("rate"), F.round(F.avg((F.col("prob") - F.col("label")) * (F.col("prob") - F.col("label"))), 6).alias("brier"))


def threshold_rule(scored: DataFrame, least: float, top: int, delta: float) -> DataFrame:
    """Pairs with prob of least or more, among the top of their entity, and within delta of its best; ties to the smaller candidate id, null probabilities never."""
    order = Window.partitionBy("source1_entity_id").orderBy(F.desc("prob"), "candidate_entity_id")
    rows = scored.withColumns({"r": F.row_number().over(order), "best": F.max("prob").over(Window.partitionBy("source1_entity_id"))})
    return rows.where((F.col("prob") >= least) & (F.col("r") <= top) & (F.col("prob") >= F.col("best") - delta)).select(*scored.columns)


def cap_sweep(candidates: DataFrame, truth: DataFrame, caps: list[int]) -> DataFrame:
    """For each cap: pairs kept and true pairs found, from one ranking. Ties go by the order of the cap; repeated true pairs count once; empty candidates give no rows."""
    at = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(F.desc("prior_score"), F.desc("n_channels"), "best_rank", "candidate_entity_id"))
    rows = candidates.withColumn("slot", at).join(truth.select(*PAIR).distinct().withColumn("label", F.lit(1)), list(PAIR), "left")
    return rows.select(F.explode(F.array(*[F.lit(c) for c in caps])).alias("cap"), "slot", "label").groupBy("cap").agg(F.count_if(F.col("slot") <= F.col("cap")).alias("pairs"), F.count_if((F.col("slot") <= F.col("cap")) & (F.col("label") == 1)).alias("found"))
