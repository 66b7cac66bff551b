"""Candidate pairs: exact keys, rare tokens, character n-gram TF-IDF; their union and cap. Pairs stay within a country."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.sources.work import written

PAIR = ("source1_entity_id", "candidate_entity_id")


def ranked(pairs: DataFrame, *order) -> DataFrame:
    """channel_rank from 1 within each source-1 entity; ties to the smaller candidate id; clipped at 65535."""
    at = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(*order, "candidate_entity_id"))
    return pairs.withColumn("channel_rank", F.least(at, F.lit(65535)))


def limit_of(knob: str, value, n: Column) -> Column | None:
    """A document-frequency limit: a fraction of n (0 to 1, rounded down), a whole number as it is, None for no limit; anything else is refused."""
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, int | float) or (isinstance(value, float) and not 0 < value <= 1):
        raise ValueError(f"{knob}: {value!r} is neither a fraction, nor a whole number, nor None")
    return F.lit(value).cast("long") if isinstance(value, int) else F.floor(F.lit(value) * n)


#: Parts into which the rows of a key are dealt where a key may hold any share of them.
SALTS = 16


def family_pairs(s1: DataFrame, pool: DataFrame, columns: list[str], max_bucket: int = 1000) -> DataFrame:
    """(ids, bucket) of the pairs that agree on all these columns, none of them empty, in buckets of up to max_bucket rows on either side; bucket is the pool's.

    Larger buckets are told from counts and dropped, part by part, before any of their rows meet; that
    limit is the operator's meaning.
    """
    keys = ["country", *columns]

    def side(df: DataFrame, name: str) -> DataFrame:
        full = reduce(lambda a, b: a & b, [F.col(c) != "" for c in columns])
        rows = df.where(full).select(*keys, F.col("entity_id").alias(name)).withColumn("salt", F.pmod(F.xxhash64(name), F.lit(SALTS)))
        large = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > max_bucket).select(*keys, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt"))
        return rows.join(large, [*keys, "salt"], "left_anti").drop("salt")

    right = side(pool, PAIR[1])
    right = right.join(right.groupBy(*keys).agg(F.count("*").alias("bucket")), keys)
    return side(s1, PAIR[0]).join(right, keys).select(*PAIR, "bucket")


def weight_of(weight: str | None) -> Column:
    """For how many records a row stands: the column weight, or 1."""
    return F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")


def kinds_of(df: DataFrame, columns: list[str], weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(kind, n, columns) of records that agree on these columns, and (kind, entity_id) of the records, both written. n adds up weights. Equal digests (SHA-256) count as equal."""
    rows = df.select("entity_id", weight_of(weight).alias("n"), *columns)
    key = F.sha2(F.to_json(F.struct(*columns)), 256).alias("__key")
    kinds = rows.groupBy(key).agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in columns])
    kinds = written(kinds.withColumn("kind", F.monotonically_increasing_id()))
    return kinds.drop("__key"), written(rows.select(key, "entity_id").join(kinds.select("__key", "kind"), "__key").select("kind", "entity_id"))


def kind_pairs(left: DataFrame, right: DataFrame, families: list[list[str]], max_bucket: int = 1000) -> DataFrame:
    """(l, r, family, bucket): kinds whose records family_pairs would pair, by the place of the family; buckets count records."""

    def of_family(i: int, columns: list[str]) -> DataFrame:
        keys = ["country", *columns]
        full = reduce(lambda a, b: a & b, [F.col(c) != "" for c in columns])
        a, b = (x.where(full).select(*keys, F.col("kind").alias(name), "n") for x, name in ((left, "l"), (right, "r")))
        fits = lambda x: x.groupBy(*keys).agg(F.sum("n").alias("bucket")).where(F.col("bucket") <= max_bucket)
        b = b.drop("n").join(fits(b), keys)
        return a.drop("n").join(fits(a).drop("bucket"), keys, "left_semi").join(b, keys).select("l", "r", F.lit(i).alias("family"), "bucket")

    return reduce(DataFrame.union, [of_family(i, columns) for i, columns in enumerate(families)])


def repeats_ids(*sides: DataFrame) -> bool:
    return any(not df.groupBy("entity_id").count().where("count > 1").isEmpty() for df in sides)


def exact_key(s1: DataFrame, pool: DataFrame, families: list[list[str]], max_bucket: int = 1000) -> DataFrame:
    """Pairs that agree on a family of columns (see family_pairs). Score: families that agree; then the smallest bucket.

    Null and empty parts make no key; repeated ids count as rows of their bucket and give their pair
    once; empty tables give no pairs. Records that agree on all columns are one kind and have one list of
    candidates, ranked once; where ids repeat, each pair is ranked by itself.
    """
    if repeats_ids(s1, pool):
        found = [family_pairs(s1, pool, columns, max_bucket).withColumn("family", F.lit(i)) for i, columns in enumerate(families)]
        pairs = reduce(DataFrame.union, found).groupBy(*PAIR).agg(F.countDistinct("family").alias("families"), F.min("bucket").alias("bucket"))
        return ranked(pairs, F.desc("families"), "bucket").select(*PAIR, "channel_rank", F.col("families").cast("double").alias("channel_score"))
    lists, own = exact_lists(s1, pool, families, max_bucket)
    return lists.join(own.select(F.col("kind").alias("l"), F.col("entity_id").alias(PAIR[0])), "l").select(*PAIR, "channel_rank", "channel_score")


def exact_lists(s1: DataFrame, pool: DataFrame, families: list[list[str]], max_bucket: int = 1000, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """exact_key by kinds of source-1 records: (l, candidate_entity_id, channel_rank, channel_score) and (kind, entity_id); each id stands once. A row of s1 counts as many records as its weight."""
    columns = list(dict.fromkeys(c for family in families for c in family))
    # Long values go by their digests.
    short = {c: F.when(F.length(c) < 64, F.col(c)).otherwise(F.sha2(c, 256)) for c in columns}
    (left, own), (right, others) = (kinds_of(x.withColumns(short), ["country", *columns], w) for x, w in ((s1, weight), (pool, None)))
    pairs = kind_pairs(left, right, families, max_bucket).groupBy("l", "r").agg(F.countDistinct("family").alias("families"), F.min("bucket").alias("bucket"))
    lists = pairs.join(others.select(F.col("kind").alias("r"), F.col("entity_id").alias(PAIR[1])), "r")
    at = F.row_number().over(Window.partitionBy("l").orderBy(F.desc("families"), "bucket", PAIR[1]))
    return lists.select("l", PAIR[1], F.least(at, F.lit(65535)).alias("channel_rank"), F.col("families").cast("double").alias("channel_score")), own


def rare_token(s1: DataFrame, pool: DataFrame, df_min: int = 2, df_fraction: float | int | None = 0.005, df_max: int = 5000, per_entity: int = 3, top: int = 100, weight: str | None = None) -> DataFrame:
    """Pairs that share one of the per_entity rarest tokens of a source-1 entity; score: how many they share.

    Records without tokens give no pairs; repeated ids count as records of their own in the frequencies
    and give a pair once; ties go to the smaller token and the smaller id. Entities of the same rarest
    tokens are one kind and have one list of candidates. A row of s1 counts as many records as its weight.
    """

    def long(df: DataFrame, weight: str | None) -> DataFrame:
        marked = F.array_union(F.transform("name_tokens", lambda x: F.concat(F.lit("n:"), x)), F.transform("addr_tokens", lambda x: F.concat(F.lit("a:"), x)))
        return df.select("country", "entity_id", weight_of(weight).alias("records"), F.explode(marked).alias("token"))

    left, right = long(s1, weight), long(pool, None)
    total = s1.select("country", weight_of(weight).alias("c")).union(pool.select("country", weight_of(None))).groupBy("country").agg(F.sum("c").alias("n"))
    ceiling = limit_of("df_fraction", df_fraction, F.col("n"))
    ceiling = F.lit(df_max) if ceiling is None else F.least(ceiling, F.lit(df_max))
    df = left.union(right).groupBy("country", "token").agg(F.sum("records").alias("df")).join(F.broadcast(total), "country")
    df = df.where((F.col("df") >= df_min) & (F.col("df") <= ceiling)).select("country", "token", "df")
    rarest = F.row_number().over(Window.partitionBy("entity_id").orderBy("df", "token"))
    chosen = left.join(df, ["country", "token"]).withColumn("r", rarest).where(F.col("r") <= per_entity)
    rare, own = kinds_of(chosen.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("country", "token", "df"))).alias("rare")), ["rare"])
    pairs = rare.select("kind", F.explode("rare").alias("x")).select("kind", "x.*").join(right.select("country", "token", F.col("entity_id").alias(PAIR[1])), ["country", "token"])
    pairs = pairs.groupBy("kind", PAIR[1]).agg(F.count("*").cast("double").alias("channel_score"), F.min("df").alias("df"))
    at = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("channel_score"), "df", PAIR[1]))
    lists = pairs.withColumn("channel_rank", F.least(at, F.lit(65535))).where(F.col("channel_rank") <= top)
    return lists.join(own.withColumnRenamed("entity_id", PAIR[0]), "kind").select(*PAIR, "channel_rank", "channel_score")


def char_ngrams(df: DataFrame, tokens: str, *keys: str) -> DataFrame:
    """(keys, gram, tf): pieces of 3 and 4 characters of each token between spaces; a token shorter than that gives itself once for each size."""

    def of_size(w, n: int):
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) + 3 - n, F.lit(1))), lambda i: F.substr(padded, i, F.lit(n)))

    pieces = F.transform(tokens, lambda w: F.concat(of_size(w, 3), of_size(w, 4)))
    return df.select(*keys, F.explode(F.flatten(pieces)).alias("gram")).groupBy(*keys, "gram").agg(F.count("*").alias("tf"))


#: Different lists of tokens, of either side, that one task compares at once.
TFIDF_BLOCK = 30_000


def tfidf_records(df: DataFrame, tokens: str) -> DataFrame:
    """(country, entity_id, tokens) of the records with tokens: sorted, repeats included, those of rows that repeat an id together."""
    rows = df.select("country", "entity_id", F.col(tokens).alias("tokens")).where(F.size("tokens") > 0).where("country is not null and entity_id is not null")
    return rows.groupBy("country", "entity_id").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"))


def tfidf_vectors(kinds: DataFrame, n: DataFrame, df_min: int = 2, df_ceiling=0.01, fallback: int = 5) -> DataFrame:
    """(kind, country, core, g, w): numbers of the grams and their weights, of length 1, of each kind (kind, country, tokens, own, held: records of source 1 and of the pool): (1 + ln tf) times the gram's idf in the pool.

    Grams of a document frequency under df_min never count. A record whose grams are all over the
    ceiling keeps the fallback of them that are rarest (ties to the smaller gram), and meets only
    records of which the same holds: the two sorts share no gram.
    """
    grams = char_ngrams(kinds, "tokens", "kind", "country", "held")
    df = grams.groupBy("country", "gram").agg(F.sum("held").alias("df")).where(F.col("df") >= df_min).join(F.broadcast(n), "country")
    ceiling = limit_of("df_ceiling", df_ceiling, F.col("n"))
    df = written(df.select("country", "gram", "df", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"), (F.lit(True) if ceiling is None else F.col("df") <= ceiling).alias("core"), F.monotonically_increasing_id().alias("g")))
    record = Window.partitionBy("kind")
    rows = grams.join(df, ["country", "gram"]).withColumns({"any": F.max("core").over(record), "nth": F.row_number().over(record.orderBy("core", "df", "gram"))})
    kept = rows.where(F.col("core") | (~F.col("any") & (F.col("nth") <= fallback))).withColumn("w", (F.log("tf") + 1) * F.col("idf"))
    unit = kept.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(record)))
    both = F.array_sort(F.collect_list(F.struct("g", "w")))
    return written(unit.groupBy("kind").agg(F.first("country").alias("country"), F.first("core").alias("core"), both.alias("x")).select("kind", "country", "core", F.col("x.g").alias("g"), F.col("x.w").alias("w")))


def tfidf_nearest(left: DataFrame, right: DataFrame, k: int, block: int) -> DataFrame:
    """(kind, other, channel_score): for each vector of left (kind, country, core, g, w) the k vectors of right (other, first, country, core, g, w) of highest cosine, ties to the smaller first, that share a gram with it.

    A task holds a block of either side, right as an index by gram, and adds up the products of one left vector at a
    time; no product and no pair is written but the k best of each block.
    """

    def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[], [], []]
        if len(a) and len(b):
            b = b.sort_values("first", kind="stable")
            names, at = b["other"].to_numpy(), np.repeat(np.arange(len(b)), [len(x) for x in b["g"]])
            g, w = np.concatenate(b["g"].to_numpy()), np.concatenate(b["w"].to_numpy())
            order = np.argsort(g, kind="stable")
            g, w, at = g[order], w[order], at[order]
            for kind, own, weight in zip(a["kind"], a["g"], a["w"], strict=True):
                low, high = np.searchsorted(g, own, "left"), np.searchsorted(g, own, "right")
                count = high - low
                if not count.any():
                    continue
                flat = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                score = np.bincount(at[flat], w[flat] * np.repeat(weight, count), len(b))
                hit = np.flatnonzero(score)
                score = np.floor(score[hit] * 1e8 + 0.5)
                if len(hit) > k:
                    enough = score >= np.partition(score, len(score) - k)[len(score) - k]
                    hit, score = hit[enough], score[enough]
                best = np.argsort(-score, kind="stable")[:k]
                out[0].append(np.full(len(best), kind))
                out[1].append(names[hit[best]])
                out[2].append(score[best] / 1e8)
        return pd.DataFrame({c: np.concatenate(x).astype(t) if x else np.zeros(0, t) for c, t, x in zip(("kind", "other", "channel_score"), (np.int64, np.int64, np.float64), out, strict=True)})

    blocks = lambda df, name: df.groupBy("country", "core").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = written(blocks(left, "nq").join(blocks(right, "np"), ["country", "core"]))
    part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(F.broadcast(sizes), ["country", "core"]).withColumn("q", part("kind", "nq")).withColumn("p", every("np"))
    b = right.join(F.broadcast(sizes), ["country", "core"]).withColumn("p", part("other", "np")).withColumn("q", every("nq"))
    keys = ["country", "core", "p", "q"]
    fresh = lambda df, *columns: df.select(*[F.col(c).alias(c) for c in (*keys, *columns)]).groupBy(*keys)
    return fresh(a, "kind", "g", "w").cogroup(fresh(b, "other", "first", "g", "w")).applyInPandas(near, "kind long, other long, channel_score double")


def tfidf_top_k(s1: DataFrame, pool: DataFrame, tokens: str = "name_tokens", k: int = 20, df_min: int = 2, df_ceiling=0.01, fallback: int = 5, block: int = TFIDF_BLOCK) -> DataFrame:
    """The k most similar pool records of each source-1 record by cosine of character n-gram TF-IDF (tfidf_vectors); only pairs that share a gram.

    Records of the same tokens are one kind: kinds are compared, and the k smallest ids of a pool kind stand for it, since no
    other one of it can be among the k best. Records without tokens give no pairs; rows that repeat an id are
    one record, and an id of several countries has the sum of its scores; ties go to the smaller candidate id; empty tables give no pairs.
    """
    n = pool.where(F.size(tokens) > 0).groupBy("country").agg(F.count("*").alias("n"))
    a, b = (tfidf_records(x, tokens) for x in (s1, pool))
    both = a.select("country", "tokens", F.lit(1).alias("own"), F.lit(0).alias("held")).union(b.select("country", "tokens", F.lit(0), F.lit(1)))
    kinds = written(both.groupBy("country", "tokens").agg(F.sum("own").alias("own"), F.sum("held").alias("held")).withColumn("kind", F.monotonically_increasing_id()))
    vectors = tfidf_vectors(kinds, n, df_min, df_ceiling, fallback)
    of = lambda rows: rows.join(kinds.select("kind", "country", "tokens"), ["country", "tokens"]).select("country", "kind", "entity_id")
    a, b = written(of(a)), written(of(b))
    heads = written(b.withColumn("nth", F.row_number().over(Window.partitionBy("kind").orderBy("entity_id"))).where(F.col("nth") <= k))
    left = vectors.join(kinds.where("own > 0").select("kind"), "kind")
    right = vectors.join(heads.where("nth = 1").select("kind", F.col("entity_id").alias("first")), "kind").withColumnRenamed("kind", "other")
    found = tfidf_nearest(left, right, k, block).join(heads.select(F.col("kind").alias("other"), F.col("entity_id").alias(PAIR[1])), "other")
    best = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("channel_score"), PAIR[1]))
    found = written(found.withColumn("channel_rank", best).where(F.col("channel_rank") <= k).select("kind", PAIR[1], "channel_rank", "channel_score"))
    own = lambda rows: rows.select("kind", F.col("entity_id").alias(PAIR[0]))
    several = written(a.groupBy("entity_id").agg(F.count("*").alias("c")).where("c > 1").select("entity_id"))
    if several.isEmpty():
        return own(a).join(found, "kind").select(*PAIR, "channel_rank", "channel_score")
    # Ids of several countries can meet in each of them: all their pairs are added up.
    side = lambda rows, name: rows.join(vectors.drop("country"), "kind").select("country", "core", F.col("entity_id").alias(name), F.explode(F.arrays_zip("g", "w")).alias("x")).select("country", "core", name, F.col("x.g").alias("g"), F.col("x.w").alias(f"{name}_w"))
    met = side(a.join(several, "entity_id"), PAIR[0]).join(side(b, PAIR[1]), ["country", "core", "g"])
    sums = met.groupBy(*PAIR).agg(F.round(F.sum(F.col(f"{PAIR[0]}_w") * F.col(f"{PAIR[1]}_w")), 8).alias("channel_score"))
    others = own(a.join(several, "entity_id", "left_anti")).join(found, "kind").select(*PAIR, "channel_rank", "channel_score")
    return others.union(ranked(sums, F.desc("channel_score")).where(F.col("channel_rank") <= k).select(*PAIR, "channel_rank", "channel_score"))


def tfidf_channel(s1: DataFrame, pool: DataFrame, field: str = "name", **more) -> DataFrame:
    """TF-IDF over the tokens of names or of addresses."""
    if field not in ("name", "addr"):
        raise ValueError(f"no field {field!r}")
    return tfidf_top_k(s1, pool, f"{field}_tokens", **more)


def embedding_channel(pairs: DataFrame, s1: DataFrame, pool: DataFrame, top: int = 20) -> DataFrame:
    """The pairs of an embedding search up to rank top, of entities and records that are in these tables."""
    known = lambda df, name: df.select(F.col("entity_id").alias(name)).distinct()
    kept = pairs.where(F.col("channel_rank") <= top).join(known(s1, PAIR[0]), PAIR[0], "left_semi").join(known(pool, PAIR[1]), PAIR[1], "left_semi")
    return kept.select(*PAIR, "channel_rank", F.col("channel_score").cast("double").alias("channel_score"))


#: Channels by name: functions of source 1, the pool and their own options that give ids, channel_rank and channel_score, each pair once. More can be registered.
CHANNELS: dict[str, Callable[..., DataFrame]] = {}


def register(name: str, channel: Callable[..., DataFrame]) -> None:
    CHANNELS[name] = channel


def run_channel(name: str, s1: DataFrame, pool: DataFrame, **options) -> DataFrame:
    """The pairs of a registered channel; unknown names and results of other columns are refused."""
    if name not in CHANNELS:
        raise ValueError(f"no channel {name!r}; there are {sorted(CHANNELS)}")
    out = CHANNELS[name](s1, pool, **options)
    if tuple(out.columns) != (*PAIR, "channel_rank", "channel_score"):
        raise ValueError(f"channel {name!r} gives {out.columns}")
    return out


def union(channels: list[tuple[int, DataFrame]]) -> DataFrame:
    """One row for each pair: channels (bits), n_channels, best_rank, prior_score (sum of 1 / rank), from (bit, pairs) of each channel. A channel gives each pair once; channels without pairs add nothing."""
    long = reduce(DataFrame.union, [df.select(*PAIR, F.lit(bit).alias("bit"), "channel_rank") for bit, df in channels])
    return long.groupBy(*PAIR).agg(F.bit_or("bit").alias("channels"), F.count("*").alias("n_channels"), F.min("channel_rank").alias("best_rank"), F.round(F.sum(1 / F.col("channel_rank")), 8).alias("prior_score"))


def cap(candidates: DataFrame, n: int = 30) -> DataFrame:
    """The n candidates of each entity with the highest prior score, then most channels, then best rank, then smallest id; null scores come last. No candidates give no rows."""
    at = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(F.desc("prior_score"), F.desc("n_channels"), "best_rank", "candidate_entity_id"))
    return candidates.withColumn("slot", at).where(F.col("slot") <= n).drop("slot")


def kind_candidates(own: DataFrame, pool: DataFrame, channels: list[tuple[int, DataFrame]], exact: tuple[int, dict], n: int = 30) -> DataFrame:
    """cap(union) of the channels and of exact_key (its bit and options) for own, kinds of source-1 records that stand for n records each; ids occur once.

    Not all exact-key pairs are listed: one that no other channel found has a lower score than each one
    before it, so it is among the n best only if its rank is n or less.
    """
    lists, kinds = exact_lists(own, pool, weight="n", **exact[1])
    lists, kinds = written(lists), kinds.select(F.col("kind").alias("l"), F.col("entity_id").alias(PAIR[0]))
    others = [(bit, written(pairs.select(*PAIR, "channel_rank"))) for bit, pairs in channels]
    found = reduce(DataFrame.union, [pairs.select(*PAIR) for _, pairs in others]).distinct()
    both = found.join(kinds, PAIR[0]).join(lists.where(F.col("channel_rank") > n), ["l", PAIR[1]])
    first = lists.where(F.col("channel_rank") <= n).join(kinds, "l")
    return cap(union([*others, (exact[0], first.select(*PAIR, "channel_rank")), (exact[0], both.select(*PAIR, "channel_rank"))]), n)


register("name_tfidf", lambda s1, pool, **more: tfidf_channel(s1, pool, "name", **more))
register("addr_tfidf", lambda s1, pool, **more: tfidf_channel(s1, pool, "addr", **more))
register("exact_key", exact_key)
register("rare_token", rare_token)
register("embed_ann", lambda s1, pool, **more: embedding_channel(s1=s1, pool=pool, **more))


def channel_stats(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """By country: entities, pairs, entities with a pair, and pairs that occur twice (0 in a right channel)."""
    counts = pairs.groupBy(*PAIR).agg(F.count("*").alias("n")).groupBy(PAIR[0]).agg(F.sum((F.col("n") > 1).cast("int")).alias("twice"), F.sum("n").alias("n"))
    rows = s1.select("country", F.col("entity_id").alias(PAIR[0])).join(counts, PAIR[0], "left")
    return rows.groupBy("country").agg(F.count("*").alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.count("n").alias("with_pair"), F.coalesce(F.sum("twice"), F.lit(0)).alias("twice"))
