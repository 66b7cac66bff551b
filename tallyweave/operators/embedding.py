"""Search by embeddings of names and addresses: exact top-k of the mean cosine, block by block."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.blocking import PAIR, ranked
from tallyweave.sources.work import written

#: Records of a block of the pool, and queries that one task compares with it at once.
POOL_BLOCK, QUERY_BLOCK = 20_000, 20_000


def query_text(raw: Column, roman: Column) -> Column:
    """What an encoder reads of a field: the text as it is, then its romanisation."""
    some = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit("query: "), some(raw), F.lit(" "), some(roman))


def hashed_vector(text: Column, size: int = 64, n: int = 3) -> Column:
    """A vector for texts where no encoder is at hand: counts of character n-grams by hash, of length 1 (zeros for null texts and those without one). It is made in Arrow batches, as an encoder would."""

    @F.pandas_udf("array<float>")
    def run(s: pd.Series) -> pd.Series:
        out = []
        for t in s.fillna(""):
            v = np.bincount([zlib.crc32(t[i : i + n].encode()) % size for i in range(len(t) - n + 1)], minlength=size).astype(np.float32)
            out.append(v / max(1e-9, float(np.sqrt((v * v).sum()))))
        return pd.Series(out)

    return run(text)


def embed_top_k(s1: DataFrame, pool: DataFrame, k: int = 20, vectors: tuple[str, ...] = ("embedding",), shard: str = "country", pool_block: int = POOL_BLOCK, query_block: int = QUERY_BLOCK, digits: int = 6) -> DataFrame:
    """The k pool records of each source-1 record with the highest mean cosine of their vectors, within a shard: ids, channel_rank, channel_score.

    Every query meets every record of its shard, in blocks: a task holds one block of either side, and
    gives the k best of each query; the best of those are the result. Scores count to some digits, ties
    go to the smaller id. Rows of the same vectors are one kind: kinds are compared, and the k smallest ids of
    a pool kind stand for it, since no other one of it can be among the k best. Rows with a null or wrongly long vector, or a null id, take part in nothing;
    vectors of length 0 have cosine 0; empty tables give no pairs. The number of blocks follows the counts.
    """
    size = lambda df, n: max(1, -(-df.count() // n))
    good = lambda df: df.where(F.col("entity_id").isNotNull() & ~F.greatest(*[F.coalesce(F.exists(v, lambda x: x.isNull()), F.lit(True)) for v in vectors], F.lit(False)))
    s1, pool = (written(good(x).select("entity_id", shard, *vectors)) for x in (s1, pool))
    s1, pool = (x.select("entity_id", F.coalesce(F.col(shard), F.lit("")).alias("shard"), F.concat(*vectors).alias("v"), *[F.size(v).alias(f"n{i}") for i, v in enumerate(vectors)]) for x in (s1, pool))
    sizes = [f"n{i}" for i in range(len(vectors))]
    same = ["shard", "v", *sizes]
    numbered = lambda df, name: written(df.groupBy(*same).agg(F.min("entity_id").alias("first")).withColumn(name, F.monotonically_increasing_id()))
    own, held = numbered(s1, "l"), numbered(pool, "r")
    members, heads = s1.join(own.drop("first"), same).select("l", F.col("entity_id").alias(PAIR[0])), pool.join(held.drop("first"), same).select("r", F.col("entity_id").alias(PAIR[1]))
    heads = heads.withColumn("nth", F.row_number().over(Window.partitionBy("r").orderBy(PAIR[1]))).where(F.col("nth") <= k).drop("nth")
    nq, np_ = size(own, query_block), size(held, pool_block)
    left = own.withColumn("q", F.pmod(F.xxhash64("l"), F.lit(nq)).cast("int")).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(np_ - 1))))
    right = held.withColumn("p", F.pmod(F.xxhash64("r"), F.lit(np_)).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    def unit(rows: pd.DataFrame) -> np.ndarray:
        x, at, out = np.stack(rows["v"].to_numpy()).astype(np.float64), 0, []
        for n in rows[sizes].iloc[0]:
            part = x[:, at : at + n]
            out.append(part / np.maximum(np.sqrt((part * part).sum(axis=1, keepdims=True)), 1e-12))
            at += n
        return np.concatenate(out, axis=1)

    def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"l": np.zeros(0, np.int64), "r": np.zeros(0, np.int64), "channel_score": np.zeros(0)})
        b = b.sort_values("first", kind="stable")
        x, y, names, ids, out = unit(a), unit(b), a["l"].to_numpy(), b["r"].to_numpy(), []
        for start in range(0, len(a), 1024):
            scores = np.round(x[start : start + 1024] @ y.T / len(sizes), digits)
            order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            out.append((np.repeat(names[start : start + 1024], order.shape[1]), ids[order.ravel()], np.take_along_axis(scores, order, axis=1).ravel()))
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(("l", "r", "channel_score"), zip(*out, strict=True), strict=True)})

    keys = ["shard", "q", "p", *sizes]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(near, "l long, r long, channel_score double").join(heads, "r")
    best = F.row_number().over(Window.partitionBy("l").orderBy(F.desc("channel_score"), PAIR[1]))
    # Rows that repeat an id of source 1 are ranked together.
    found = found.withColumn("nth", best).where(F.col("nth") <= k).join(members, "l").select(*PAIR, "channel_score")
    return ranked(found, F.desc("channel_score")).where(F.col("channel_rank") <= k).select(*PAIR, "channel_rank", "channel_score")

