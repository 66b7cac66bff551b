"""New source-1 records as they arrive in a folder, linked with a fixed pool: bounded batches, one result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweave.functions.normal import normalise_frame
from tallyweave.knobs import Knobs
from tallyweave.operators import blocking, matching

SCHEMA = "entity_id string, business_name string, business_address string, country string"


def link(records: DataFrame, pool: DataFrame, knobs: Knobs) -> DataFrame:
    """(ids, prob) of the best candidates of these records among the normalised pool, by exact keys and rare tokens."""
    s1, options = normalise_frame(records), knobs.options()
    found = [(4, blocking.run_channel("exact_key", s1, pool, **options["exact_key"])), (8, blocking.run_channel("rare_token", s1, pool, **options["rare_token"]))]
    return matching.stub_scores(blocking.cap(blocking.union(found), knobs.cap))


def link_arrivals(spark: SparkSession, folder: str, pool: DataFrame, out: str, checkpoint: str, knobs: Knobs | None = None, files: int = 100) -> None:
    """Links every Parquet file of folder that this checkpoint hasn't seen, some files at a time, and appends (ids, prob) to out; ends when there are none left.

    A batch that is done again after a failure writes the folder of its number anew. What an entity gets
    depends on the records of its own batch only through the frequencies of tokens.
    """
    knobs = knobs or Knobs()

    def one(batch: DataFrame, number: int) -> None:
        link(batch, pool, knobs).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    arrivals = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(folder)
    arrivals.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
