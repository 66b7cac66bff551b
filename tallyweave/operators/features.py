"""The feature matrix: 71 columns of each candidate pair, in fixed order with the sign that a monotone model gives them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import text
from tallyweave.functions.kernels import EDITS, domain_match, edit_similarities
from tallyweave.operators.matching import PAIR, context

#: Bits of the blocking channels, in this order.
CHANNELS = ("name_tfidf", "addr_tfidf", "exact_key", "rare_token", "embed_ann")
#: Rank of a pair that the embedding search didn't give: worse than any real one.
NO_RANK = 9999.0
VERSION = 1
_FAMILY = (*EDITS, "token_jaccard", "token_containment")
#: Name and monotone sign of each feature.
SPEC: list[tuple[str, int]] = [
    *[(f"name_{side}_{x}", 1) for side in ("norm", "roman") for x in (*_FAMILY, "prefix_ratio", "length_ratio")],
    ("name_acronym_match", 1), ("name_first_token_match", 1), ("name_suffix_agree", 1), ("name_digit_eq", 1), ("name_domain_match", 1), ("name_script_pair", 0),
    *[(f"addr_{side}_{x}", 1) for side in ("norm", "roman") for x in _FAMILY],
    ("addr_street_num_match", 1), ("addr_postcode_match", 1), ("addr_state_match", 1), ("addr_city_match", 1), ("addr_numeric_jaccard", 1), ("s1_has_addr", 0), ("cand_has_addr", 0), ("both_have_addr", 0),
    ("n_channels", 1), *[(f"ch_{x}", 0) for x in CHANNELS], ("best_rank", -1), ("reciprocal_rank", 1), ("prior_score", 1), ("margin_to_best", 0), ("entity_n_cands", 0), ("is_source3", 0),
    ("cand_best_score", 0), ("cand_n_claims", 0), ("cand_is_argmax", 1), ("embed_cosine", 1), ("embed_rank", -1),
]
NAMES = tuple(name for name, _ in SPEC)
COLUMNS = tuple(f"f{i:03d}" for i in range(len(SPEC)))


def both_equal(a: Column, b: Column) -> Column:
    """1 if the texts are equal and not empty."""
    return ((a != "") & (b != "") & (a == b)).cast("double")


def same_set(a: Column, b: Column) -> Column:
    """1 if two arrays hold the same values; two empty ones do."""
    return ((F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)).cast("double")


def component_matches(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Features of names and addresses that compare whole parts: acronym, first token, suffix, digits, script, and the address parts."""
    digits = lambda t: F.filter(t, lambda x: F.rlike(x, F.lit("^[0-9]+$")))
    numeric = lambda t: F.array_distinct(F.filter(t, lambda x: F.rlike(x, F.lit("[0-9]"))))
    head = lambda t: F.coalesce(F.get(t, F.lit(0)), F.lit(""))
    return {
        "name_acronym_match": both_equal(a["name_acronym"], b["name_acronym"]), "name_first_token_match": both_equal(head(a["name_tokens"]), head(b["name_tokens"])),
        "name_suffix_agree": (a["name_suffix"] == b["name_suffix"]).cast("double"), "name_digit_eq": same_set(digits(a["name_tokens"]), digits(b["name_tokens"])),
        "name_script_pair": (a["script"] * 10 + b["script"]).cast("double"),
        "addr_street_num_match": both_equal(a["street_num"], b["street_num"]), "addr_postcode_match": both_equal(a["postcode"], b["postcode"]),
        "addr_state_match": both_equal(a["state_canon"], b["state_canon"]), "addr_city_match": both_equal(a["city_norm"], b["city_norm"]),
        "addr_numeric_jaccard": text.jaccard(numeric(a["addr_tokens"]), numeric(b["addr_tokens"])),
        "s1_has_addr": a["has_addr"].cast("double"), "cand_has_addr": b["has_addr"].cast("double"), "both_have_addr": (a["has_addr"] & b["has_addr"]).cast("double"),
    }


def channel_flags(channels: Column) -> dict[str, Column]:
    """1 for each channel whose bit is set."""
    return {f"ch_{name}": channels.bitwiseAND(F.lit(1 << i)).cast("boolean").cast("double") for i, name in enumerate(CHANNELS)}


def joined(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """pairs with the normalised columns of both sides, as a_ and b_; pairs without either record go."""
    side = lambda df, p, key: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c != "entity_id"])
    return pairs.join(side(s1, "a", PAIR[0]), PAIR[0]).join(side(pool, "b", PAIR[1]), PAIR[1])


def feature_columns(candidates: DataFrame, s1: DataFrame, pool: DataFrame, embed: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """The features by name for each candidate (ids, channels, n_channels, best_rank, prior_score) of normalised records.

    Competition is over all candidates given, so compute it before any sampling. embed: (ids,
    channel_rank, channel_score) of the embedding search; pairs it doesn't have get cosine 0 and NO_RANK.
    Nulls in records count as empty; a side that is empty makes every similarity 0. Repeated candidates
    stay repeated; an empty table gives no rows. One pass of Python batches does all edit similarities.
    weight: see context.
    """
    rows = joined(context(candidates, weight), s1, pool)
    if embed is not None:
        near = embed.groupBy(*PAIR).agg(F.max("channel_score").alias("embed_cosine"), F.min("channel_rank").alias("embed_rank"))
        rows = rows.join(near, list(PAIR), "left")
    for name, none in (("embed_cosine", 0.0), ("embed_rank", NO_RANK)):
        rows = rows.withColumn(name, F.coalesce(F.col(name).cast("double"), F.lit(none)) if embed is not None else F.lit(none))
    kinds = {"name_tokens": "array<string>", "addr_tokens": "array<string>", "has_addr": "boolean", "script": "int"}
    nothing = {"array<string>": F.array().cast("array<string>"), "boolean": F.lit(False), "int": F.lit(0), "string": F.lit("")}
    sides = [{c: F.coalesce(F.col(f"{p}_{c}").cast(kinds.get(c, "string")), nothing[kinds.get(c, "string")]) for c in s1.columns if c != "entity_id"} for p in "ab"]
    a, b = sides
    fields = [f"{what}_{side}" for what in ("name", "addr") for side in ("norm", "roman")]
    rows = rows.withColumns({f"sim_{f}": edit_similarities(a[f], b[f]) for f in fields} | {"dom": domain_match(a["name_norm"], b["name_norm"])})
    out: dict[str, Column] = {"name_domain_match": F.col("dom"), "embed_cosine": F.col("embed_cosine"), "embed_rank": F.col("embed_rank")}
    for f in fields:
        tokens = f.split("_")[0] + "_tokens"
        out |= {f"{f}_{x}": F.col(f"sim_{f}.{x}") for x in EDITS}
        out |= {f"{f}_token_jaccard": text.jaccard(a[tokens], b[tokens]), f"{f}_token_containment": text.containment(a[tokens], b[tokens])}
        if f.startswith("name"):
            out |= {f"{f}_prefix_ratio": text.prefix_ratio(a[f], b[f]), f"{f}_length_ratio": text.length_ratio(a[f], b[f])}
    out |= component_matches(a, b) | channel_flags(F.col("channels").cast("int"))
    out |= {c: F.col(c).cast("double") for c in ("n_channels", "best_rank", "reciprocal_rank", "prior_score", "entity_n_cands", "is_source3", "cand_best_score", "cand_n_claims", "cand_is_argmax")}
    out["margin_to_best"] = -F.col("margin_to_best")
    return rows.select(*PAIR, *[F.round(out[name], 6).alias(name) for name in NAMES])


def feature_matrix(candidates: DataFrame, s1: DataFrame, pool: DataFrame, embed: DataFrame | None = None, labels: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """feature_columns as floats f000 to f070, and label (1 for the pairs of labels) if they are given."""
    rows = feature_columns(candidates, s1, pool, embed, weight)
    out = rows.select(*PAIR, *[F.col(name).cast("float").alias(c) for name, c in zip(NAMES, COLUMNS, strict=True)])
    if labels is None:
        return out
    marked = labels.select(*PAIR).distinct().withColumn("label", F.lit(1))
    return out.join(marked, list(PAIR), "left").withColumn("label", F.coalesce("label", F.lit(0)))


def of_members(rows: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The matrix of source-1 records, with label, from that of their kinds (entity: the kind) and members (kind, entity_id). Labels come with the members, so no wide row is sorted for them."""
    true = labels.groupBy(F.col(PAIR[0]).alias("entity_id")).agg(F.collect_set(PAIR[1]).alias("__true"))
    own = members.join(true, "entity_id", "left").select(F.col("kind").cast("string").alias("__kind"), F.col("entity_id").alias("__id"), "__true")
    out = rows.withColumnRenamed(PAIR[0], "__kind").join(own, "__kind")
    return out.select(F.col("__id").alias(PAIR[0]), PAIR[1], *COLUMNS, F.coalesce(F.array_contains("__true", F.col(PAIR[1])).cast("int"), F.lit(0)).alias("label"))


def require_embeddings(candidates: DataFrame, embed: DataFrame | None) -> None:
    """Refuses candidates of the embedding channel without the table that it came from."""
    if embed is None and not candidates.where(F.col("channels").bitwiseAND(F.lit(1 << CHANNELS.index("embed_ann"))) != 0).isEmpty():
        raise ValueError("candidates come from the embedding channel, but its pairs aren't given")


def sampled_entities(rows: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """The rows of about this fraction of the source-1 entities, chosen by hash, to the thousandth; take it after context and competition."""
    return rows.where(F.pmod(F.xxhash64(F.col(PAIR[0]), F.lit(seed)), F.lit(1000)) < round(fraction * 1000))
