"""What the training-data operators share: shared work tables, words, connected components."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tallyweave

# Functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(tallyweave)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a new local one for each application if it runs on one machine, as in tests; on a cluster that is an error."""
    if found := spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    cache, name = process_cache("dirs"), spark.sparkContext.applicationId
    if name not in cache:
        cache[name] = "file://" + tempfile.mkdtemp(prefix="tallyweave-")
    return cache[name]


#: Spark removes the shuffle files of a query as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """df through a Parquet table in the shared folder: lineage ends there, and a lost executor loses nothing. Its shuffle files go once it is written; the session keeps that setting."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallyweave-work/{uuid.uuid4().hex}"
    spark.conf.set(CLEANUP, "true")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the files of checkpointed tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._work_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder's whole URI: one without a scheme is in Spark's default file system, as for Spark's own readers."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def file_system(uri: str):
    """The file system of a whole URI, and the path in it; executors reach it as well as the driver."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def share(spark: SparkSession, value) -> Callable:
    """Broadcasts an object of this package's classes by value; what it returns gives the object on an executor."""
    import pickle

    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def process_cache(name: str) -> dict:
    """A dict that lives as long as this Python process, also between the tasks of one worker."""
    holder = sys.modules.setdefault("_tallyweave_process", types.ModuleType("_tallyweave_process"))
    return holder.__dict__.setdefault(f"cache_{name}", {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """The strings of an Arrow column as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what a task holds at once stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_map(df: DataFrame, columns: list[str], work: Callable, schema: str) -> DataFrame:
    """work over the Arrow batches of these columns alone; other columns, also those with clashing names, don't reach it."""
    return df.select(*columns).mapInArrow(lambda it: work(pieces(it)), schema)


def lower_ascii(column):
    return F.translate(column, UPPER, LOWER)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the smallest node of its connected component.

    Alternates large-star and small-star steps; each is an aggregation with map-side combine and a
    join, and no node's neighbours are ever held together. The least neighbours are written before they
    are joined, so that Spark can split the root of a giant component. No edges: no rows. Null ends are
    dropped, loops and repeated edges change nothing.
    """
    spark = edges.sparkSession
    a, b = F.col("a"), F.col("b")
    star = checkpointed(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    state = None
    while True:
        now = star.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1000003).alias("h")).first()
        if now == state or not now["n"]:
            break
        state = now
        both = star.union(star.select(b.alias("a"), a.alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.min(F.least(a, b)).alias("m")))
        large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).union(
            star.join(least, "a").select(F.col("a"), F.col("m").alias("b"))
        ).where(F.col("a") != F.col("b")).distinct()
        large = checkpointed(large)
        near = checkpointed(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(near, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, star = star, checkpointed(small.union(near.select("a", F.col("m").alias("b"))).distinct())
        discard(old, least, large, near)
    roots = star.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = checkpointed(roots.union(star.select(F.col("b"), F.col("b"))).distinct()) if state else spark.createDataFrame([], roots.schema)
    discard(star)
    return out
