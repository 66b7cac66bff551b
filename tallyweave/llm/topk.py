"""Exact top-k inner product search: ball-tree branch and bound in each shard of the vectors, under the kth score that is known so far."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import checkpointed, table

#: Vectors of a shard, queries of a block, vectors of a leaf.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 16384, 64
#: Scores beyond the long range count as its ends.
LOW, HIGH = -(1 << 63), (1 << 63) - 1
#: Bounds are widened by this share of the norms they come from, many times the rounding of a dot product.
SLACK = 1e-9


class Ball:
    """A node: center and radius of its vectors; two children, or the rows of a leaf."""

    def __init__(self, x: np.ndarray, rows: np.ndarray) -> None:
        own = x[rows]
        self.center = own.mean(axis=0)
        self.radius = float(np.sqrt(((own - self.center) ** 2).sum(axis=1).max()))
        self.reach = float(np.sqrt((self.center**2).sum())) + self.radius
        self.rows, self.children = rows, ()
        if len(rows) > LEAF_ROWS:
            far = own[((own - self.center) ** 2).sum(axis=1).argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            order = np.argsort(own @ (other - far), kind="stable")
            half = len(rows) // 2
            self.children = (Ball(x, rows[order[:half]]), Ball(x, rows[order[half:]]))


def integer_score(a: np.ndarray, b: np.ndarray) -> int:
    """The inner product of vectors of whole numbers, without rounding, within the long range."""
    return max(LOW, min(HIGH, sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist(), strict=True))))


def search(q: np.ndarray, q_ids: np.ndarray, known: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the k best rows of x for each row of q, ties to smaller ids; fewer where known, a kth score found elsewhere (LOW: none), rules rows out.

    q and x hold whole numbers. A row with the query's own id is no candidate. A node is entered only
    with the queries whose bound q.c + |q| r reaches their kth score; the child with the higher bounds
    comes first. Where products may pass 2**53, both sides are scaled for the bounds, and what is
    within their slack is scored anew in Python's integers.
    """
    if not len(x) or not len(q):
        return []
    most = [max(1.0, float(np.abs(m).max(initial=0))) for m in (q, x)]
    large = not q.shape[1] * most[0] * most[1] <= 2.0**53
    scale = most if large else [1.0, 1.0]
    a, y = q / scale[0], x / scale[1]
    norms = np.sqrt((a * a).sum(axis=1))
    best: list[list[tuple[int, int]]] = [[] for _ in q]  # (-score, id), sorted
    floor = np.array([-np.inf if v <= LOW else v / scale[0] / scale[1] for v in map(int, known)])

    def bound(node: Ball, rows: np.ndarray) -> np.ndarray:
        return a[rows] @ node.center + norms[rows] * (node.radius + SLACK * node.reach)

    def enter(node: Ball, rows: np.ndarray) -> None:
        rows = rows[bound(node, rows) >= floor[rows]]
        if not len(rows):
            return
        if node.children:
            for child in sorted(node.children, key=lambda c: -bound(c, rows).mean()):
                enter(child, rows)
            return
        scores = a[rows] @ y[node.rows].T
        slack = SLACK * norms[rows] * node.reach if large else 0 * norms[rows]
        at, hit = np.nonzero((scores >= (floor[rows] - slack)[:, None]) & (ids[node.rows][None, :] != q_ids[rows][:, None]))
        for i in np.unique(at):
            mine = hit[at == i]
            r = rows[i]
            exact = [integer_score(q[r], x[j]) for j in node.rows[mine]] if large else scores[i, mine].astype(np.int64).tolist()
            best[r] = sorted(best[r] + [(-s, int(j)) for s, j in zip(exact, ids[node.rows[mine]], strict=True)])[:k]
            if len(best[r]) == k and best[r][-1][0] != -LOW:
                floor[r] = max(floor[r], -best[r][-1][0] / scale[0] / scale[1])

    enter(Ball(y, np.arange(len(x))), np.arange(len(q)))
    return [(int(i), j, -s) for i, own in zip(q_ids, best, strict=True) for s, j in own]


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, v array<double> of whole numbers, dim): floor(scale * x) of each component. Null ids, null vectors and vectors in which a component or its product is null or not finite are left out."""
    v = F.transform(vector_col, lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # From 2**53 on, every double is whole.
    whole = F.transform("v", lambda x: F.when(F.abs(x) >= 2.0**53, x).otherwise(F.floor(x).cast("double")))
    return rows.select("id", whole.alias("v")).withColumn("dim", F.size("v"))


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row whose id is divisible by every; all if there are fewer.

    Vectors of another dimension aren't candidates. Rows that repeat an id are candidates each, but not
    of queries with that id; equal query rows are one query, different ones of the same id don't occur
    together in a result (the first by value counts). Scores are whole numbers without rounding; those
    beyond the long range count as its ends. Empty tables give no rows. First each query searches the shard of its own hash; the
    kth scores found there then bound the search of all other shards.
    """
    rows = checkpointed(integer_vectors(df, id_col, vector_col))
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    query = rows.where(F.pmod("id", F.lit(every)) == 0).groupBy("id", "dim").agg(F.min("v").alias("v"))
    blocks = max(1, -(-query.count() // BLOCK_ROWS))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    query = checkpointed(query.withColumn("home", home).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        q, x = (np.stack(d["v"].to_numpy()).astype(float).reshape(len(d), -1) for d in (left, right))
        got = search(q, left["id"].to_numpy(), left["known"].to_numpy(), x, right["id"].to_numpy(), k)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"], dtype="int64")

    keys = ["dim", "shard", "block"]
    spread = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(q: DataFrame) -> DataFrame:
        return checkpointed(q.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(one, "query_id long, vec_id long, score long"))

    first = run(query.select("id", "v", "dim", "block", F.col("home").alias("shard"), F.lit(LOW).alias("known")))
    known = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(LOW)).alias("known"))
    rest = query.join(known, query.id == known.query_id, "left").select("id", "v", "dim", "block", "home", F.coalesce("known", F.lit(LOW)).alias("known"))
    rest = rest.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard != home").drop("home")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.union(run(rest)).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: DuckDB SQL for op2_topk's rows.
OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
