"""What blocking loses and where: sweeps of the cap, shares of the channels, consistency of the truth, and a threshold baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.features import CHANNELS
from tallyweave.operators.matching import PAIR, f05

#: Caps of a sweep; what is over all of them stands for no cap.
CAPS = (10, 15, 20, 25, 30, 40, 50, 60)


def slots(candidates: DataFrame) -> DataFrame:
    """candidates with slot, the place that the cap gives them within their entity."""
    order = Window.partitionBy(PAIR[0]).orderBy(F.desc("prior_score"), F.desc("n_channels"), "best_rank", PAIR[1])
    return candidates.withColumn("slot", F.row_number().over(order))


def bit(channels: Column, i: int) -> Column:
    return channels.bitwiseAND(F.lit(1 << i)) != 0


def cap_report(candidates: DataFrame, truth: DataFrame, entities: DataFrame, caps=CAPS) -> DataFrame:
    """(cap, country, channel, entities, true, found, found_only, pairs, recall): for each cap (null: none), overall and by country, and for each channel (null: all), true pairs that candidates up to the cap hold, those that the channel alone found, and pairs kept.

    One ranking and one aggregation answer all caps. entities: source1_entity_id and country. Countries
    without candidates still have a row for all channels.
    """
    rows = slots(candidates).join(entities.select(PAIR[0], "country"), PAIR[0]).join(truth.select(*PAIR).distinct().withColumn("t", F.lit(1)), list(PAIR), "left")
    every = F.array(*[F.lit(c) for c in caps], F.lit(None).cast("int"))
    kinds = F.array(F.lit(None).cast("string"), *[F.when(bit(F.col("channels"), i), F.lit(name)) for i, name in enumerate(CHANNELS)])
    marked = rows.select("country", "t", "n_channels", "slot", F.explode(F.array_distinct(kinds)).alias("channel"))
    kept = marked.select("*", F.explode(every).alias("cap")).where(F.col("cap").isNull() | (F.col("slot") <= F.col("cap")))
    both = lambda df: df.union(df.withColumn("country", F.lit("*")))
    counts = both(kept.select("country", "cap", "channel", "t", "n_channels")).groupBy("cap", "country", "channel").agg(F.count("*").alias("pairs"), F.count("t").alias("found"), F.count(F.when(F.col("n_channels") == 1, F.col("t"))).alias("found_only"))
    known = truth.select(*PAIR).distinct().join(entities.select(PAIR[0], "country"), PAIR[0]).groupBy("country").agg(F.count("*").alias("true"))
    base = entities.groupBy("country").agg(F.count("*").alias("entities")).join(known, "country", "left").na.fill(0, ["true"])
    base = base.union(base.agg(F.lit("*"), F.sum("entities"), F.sum("true")))
    grid = base.crossJoin(F.broadcast(base.sparkSession.createDataFrame([(c, n) for c in (*caps, None) for n in (None, *CHANNELS)], "cap int, channel string")))
    same = grid["cap"].eqNullSafe(counts["cap"]) & (grid["country"] == counts["country"]) & grid["channel"].eqNullSafe(counts["channel"])
    out = grid.join(counts, same, "left").select(grid["cap"], grid["country"], grid["channel"], "entities", "true", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("found", "found_only", "pairs")])
    return out.withColumn("recall", F.round(F.try_divide("found", "true"), 6))


def channel_slots(candidates: DataFrame, truth: DataFrame, entities: DataFrame, n: int = 30) -> DataFrame:
    """(country, channel, entities, share_any, share_only, only_slots, only_true_rate): mean share of an entity's first n slots that a channel fills at all, and alone, and how many of the latter are true."""
    rows = slots(candidates).where(F.col("slot") <= n).join(entities.select(PAIR[0], "country"), PAIR[0]).join(truth.select(*PAIR).distinct().withColumn("t", F.lit(1)), list(PAIR), "left")
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("channel"), bit(F.col("channels"), i).cast("int").alias("any")) for i, name in enumerate(CHANNELS)])).alias("x")
    long = rows.select("country", PAIR[0], "t", "n_channels", each).select("country", PAIR[0], "t", "x.channel", "x.any", F.when((F.col("x.any") == 1) & (F.col("n_channels") == 1), 1).otherwise(0).alias("only"))
    one = long.groupBy("country", "channel", PAIR[0]).agg(F.avg("any").alias("a"), F.avg("only").alias("o"), F.sum("only").alias("n"), F.count(F.when(F.col("only") == 1, F.col("t"))).alias("true"))
    return one.groupBy("country", "channel").agg(F.count("*").alias("entities"), F.round(F.avg("a"), 6).alias("share_any"), F.round(F.avg("o"), 6).alias("share_only"), F.sum("n").alias("only_slots"), F.round(F.try_divide(F.sum("true"), F.sum("n")), 6).alias("only_true_rate"))


def family_ablation(found: list[tuple[str, DataFrame]], truth: DataFrame) -> DataFrame:
    """(family, pairs, true, only, only_true): pairs of each family of keys, true ones, and those that no other family gives."""
    long = reduce(DataFrame.union, [df.select(*PAIR, F.lit(name).alias("family")) for name, df in found]).distinct()
    rows = long.withColumn("n", F.count("*").over(Window.partitionBy(*PAIR))).join(truth.select(*PAIR).distinct().withColumn("t", F.lit(1)), list(PAIR), "left")
    return rows.groupBy("family").agg(F.count("*").alias("pairs"), F.count("t").alias("true"), F.count_if(F.col("n") == 1).alias("only"), F.count(F.when(F.col("n") == 1, F.col("t"))).alias("only_true"))


def kind_ablation(names: list[str], pairs: DataFrame, left: tuple[DataFrame, DataFrame], right: tuple[DataFrame, DataFrame], truth: DataFrame) -> DataFrame:
    """family_ablation from pairs of kinds (l, r, family: place in names), counting their records without listing them. left, right: blocking.kinds_of, each id once."""
    at = lambda side, name, key: side[1].select(F.col("kind").alias(name), F.col("entity_id").alias(key))
    size = lambda side, name: side[0].select(F.col("kind").alias(name), F.col("n").alias(f"n_{name}"))
    true = truth.select(*PAIR).distinct().join(at(left, "l", PAIR[0]), PAIR[0]).join(at(right, "r", PAIR[1]), PAIR[1]).groupBy("l", "r").agg(F.count("*").alias("t"))
    each = pairs.groupBy("l", "r").agg(F.collect_set("family").alias("families")).join(size(left, "l"), "l").join(size(right, "r"), "r").join(true, ["l", "r"], "left")
    alone = F.when(F.size("families") == 1, 1).otherwise(0)
    rows = each.select(F.explode("families").alias("family"), (F.col("n_l") * F.col("n_r")).alias("n"), F.coalesce("t", F.lit(0)).alias("t"), alone.alias("alone"))
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("family") + 1).alias("family")
    return rows.groupBy(name).agg(F.sum("n").alias("pairs"), F.sum("t").alias("true"), F.sum(F.col("n") * F.col("alone")).alias("only"), F.sum(F.col("t") * F.col("alone")).alias("only_true"))


def country_consistency(truth: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """(source, country, pairs, unknown_s1, unknown_match, different) of the true pairs: overall, by the source of the match (first two characters of its id), and by the country of source 1."""
    known = lambda df, key, name: df.select(F.col("entity_id").alias(key), F.col("country").alias(name))
    rows = truth.join(known(s1, PAIR[0], "a"), PAIR[0], "left").join(known(pool, PAIR[1], "b"), PAIR[1], "left").withColumn("source", F.substring(PAIR[1], 1, 2)).withColumn("country", F.col("a"))
    sets = rows.groupingSets([[], [F.col("source")], [F.col("country")]], "source", "country")
    return sets.agg(F.count("*").alias("pairs"), F.count_if(F.col("a").isNull()).alias("unknown_s1"), F.count_if(F.col("b").isNull()).alias("unknown_match"), F.count_if(F.col("a") != F.col("b")).alias("different"), F.grouping_id().alias("set"))


def mismatches(truth: DataFrame, s1: DataFrame, pool: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent pairs of countries that differ: (country_s1, country_match, pairs)."""
    known = lambda df, key, name: df.select(F.col("entity_id").alias(key), F.col("country").alias(name))
    rows = truth.join(known(s1, PAIR[0], "country_s1"), PAIR[0]).join(known(pool, PAIR[1], "country_match"), PAIR[1]).where("country_s1 <> country_match")
    return rows.groupBy("country_s1", "country_match").agg(F.count("*").alias("pairs")).orderBy(F.desc("pairs"), "country_s1", "country_match").limit(top)


def hash_split(entity: Column, share: int = 20) -> Column:
    """Whether an entity is held out: share of 100 buckets of its hash."""
    return F.pmod(F.xxhash64(entity, F.lit(0)), F.lit(100)) < share


#: Grids of the threshold baseline.
LOW, STEP, STEPS = 0.80, 0.0025, 81
TOPS, DELTAS = (1, 2, 3, 5, 10, 20), (0.02, 0.05, 0.1, None)


def threshold_sweep(scored: DataFrame, truth: DataFrame, entities: DataFrame, low: float = LOW, step: float = STEP, steps: int = STEPS, tops=TOPS, deltas=DELTAS) -> DataFrame:
    """(k, delta, t, f05, empty) for all combinations: mean F0.5 over entities, and share of entities without a prediction, if pairs are kept whose score is t or more, whose rank is k or less and which are within delta of their entity's best.

    scored: ids, channel_rank, channel_score. Each pair goes to the highest threshold that it reaches;
    counts at lower ones come by running sums. Scores under low reach none. An entity's counts change
    only where a pair of its own is, so entities give changes of the sums, not a row for each threshold.
    """
    best = F.max("channel_score").over(Window.partitionBy(PAIR[0]))
    rows = scored.join(truth.select(*PAIR).distinct().withColumn("t", F.lit(1)), list(PAIR), "left").join(entities.select(PAIR[0]).distinct(), PAIR[0], "left_semi").withColumn("best", best)
    grid = rows.sparkSession.createDataFrame([(k, d) for k in tops for d in deltas], "k int, delta double")
    kept = rows.join(F.broadcast(grid), (F.col("channel_rank") <= F.col("k")) & (F.col("delta").isNull() | (F.col("channel_score") >= F.col("best") - F.col("delta"))))
    at = F.least(F.floor((F.col("channel_score") - low) / step + 1e-9), F.lit(steps - 1)).cast("int")
    bins = kept.withColumn("bin", at).where("bin >= 0").groupBy("k", "delta", PAIR[0], "bin").agg(F.count("*").alias("m"), F.count("t").alias("c"))
    down = Window.partitionBy("k", "delta", PAIR[0]).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    true = truth.select(*PAIR).distinct().groupBy(PAIR[0]).agg(F.count("*").alias("n_true"))
    own = entities.select(PAIR[0]).distinct().join(true, PAIR[0], "left").na.fill(0, ["n_true"])
    run = bins.withColumns({"mm": F.sum("m").over(down), "cc": F.sum("c").over(down)}).join(own, PAIR[0])
    # From its bin downwards an entity has this value, until its next bin.
    value = f05(F.col("cc"), F.col("n_true"), F.col("mm"))
    nothing = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    last = F.lag(value).over(Window.partitionBy("k", "delta", PAIR[0]).orderBy(F.desc("bin")))
    change = run.withColumns({"gain": value - F.coalesce(last, nothing), "first": F.when(last.isNull(), 1).otherwise(0)})
    sums = change.groupBy("k", "delta", "bin").agg(F.sum("gain").alias("gain"), F.sum("first").alias("first"))
    base = own.agg(F.count("*").alias("n"), F.sum(nothing).alias("zero"))
    every = F.broadcast(grid).select("k", "delta", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("bin"))
    same = (every["k"] == sums["k"]) & every["delta"].eqNullSafe(sums["delta"]) & (every["bin"] == sums["bin"])
    full = every.join(sums, same, "left").select(every["k"], every["delta"], every["bin"], F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("first", F.lit(0)).alias("first")).crossJoin(F.broadcast(base))
    order = Window.partitionBy("k", "delta").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    return full.select("k", "delta", F.round(low + F.col("bin") * step, 6).alias("t"), F.round(F.try_divide(F.col("zero") + F.sum("gain").over(order), "n"), 6).alias("f05"), F.round(1 - F.try_divide(F.sum("first").over(order), "n"), 6).alias("empty"))
