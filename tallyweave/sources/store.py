"""Files around a run: plain and quoted tab-separated text, checked ingestion, published tables, parts that a later run can take up, reports."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyweave.sources.records import COLUMNS, read_id_lists, read_tsv


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def read_plain_tsv(spark: SparkSession, path: str, columns: tuple[str, ...], keep: tuple[str, ...] | None = None) -> DataFrame:
    """Tab-separated text with a header in which quotes mean nothing; all columns are strings, empty fields stay empty. keep: only these columns are parsed."""
    schema = ", ".join(f"{c} string" for c in columns)
    rows = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "\u0000").option("enforceSchema", False).csv(path)
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in (keep or columns)])


def read_country(spark: SparkSession, paths: list[str], country: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of one country of several Parquet tables as one; filter and columns reach the scan."""
    rows = spark.read.parquet(*paths).where(F.col("country") == country)
    return rows.select(*columns) if columns else rows


def table_facts(spark: SparkSession, path: str) -> tuple[StructType, int]:
    """Schema and number of rows of a Parquet table, from its metadata alone."""
    rows = spark.read.parquet(path)
    return rows.schema, rows.count()


def publish(df: DataFrame, path: str, schema: str | StructType | None = None) -> None:
    """Writes df beside path and puts it there when it is whole; what was there goes first, so that nobody reads half a table. An empty df leaves its schema. schema: columns and types that df must have, in order."""
    spark = df.sparkSession
    if schema is not None:
        want = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        if [(f.name, f.dataType) for f in want] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"columns are {df.schema.simpleString()}, not {want.simpleString()}")
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    (df if df.columns else df.select(F.lit(None).alias("none"))).write.parquet(beside)
    fs, at = _fs(spark, path)
    fs.delete(at, True)
    fs.rename(_fs(spark, beside)[1], at)


def read_id_lists_of(rows: DataFrame, entities: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """read_id_lists of these entities alone; other lists are never taken apart."""
    return read_id_lists(rows.join(entities.select(F.col(entities.columns[0]).alias("source1_entity_id")).distinct(), "source1_entity_id", "left_semi"), column)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header, quoted only where needed, then read back: a difference raises ValueError. Nulls are written as empty."""
    plain = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    plain.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = read_tsv(df.sparkSession, path, tuple(df.columns))
    if not plain.exceptAll(back).isEmpty() or not back.exceptAll(plain).isEmpty():
        raise ValueError(f"{path} doesn't hold what was written")


def ingest(spark: SparkSession, path: str, source: str, expected_rows: int | None = None) -> tuple[DataFrame, dict]:
    """Records of a raw file, and facts about them. Another header, another number of rows, repeated ids, or ids that don't begin with the source's (S1- to S3-) raise ValueError."""
    header = spark.read.text(path).limit(1).first()
    if header is None or tuple(header[0].rstrip("\r").split("\t")) != COLUMNS:
        raise ValueError(f"{path}: header is {header[0] if header else None!r}")
    rows = read_tsv(spark, path)
    at = f"S{source[-1]}-"
    facts = rows.agg(
        F.count("*").alias("rows"), F.countDistinct("entity_id").alias("ids"), F.coalesce(F.bool_and(F.col("entity_id").startswith(at)), F.lit(True)).alias("prefixed"),
        F.count_if(F.col("business_address") == "").alias("no_address"), F.countDistinct("country").alias("countries"),
    ).first().asDict()
    if expected_rows is not None and facts["rows"] != expected_rows:
        raise ValueError(f"{path}: {facts['rows']} rows, not {expected_rows}")
    if facts["ids"] != facts["rows"] or not facts["prefixed"]:
        raise ValueError(f"{path}: ids repeat or don't begin with {at}")
    return rows, facts


def require_inputs(spark: SparkSession, splits: dict[str, list[str]]) -> list[str]:
    """The splits of which all files are there. None of a split: it is passed over; some: FileNotFoundError."""
    ready = []
    for split, paths in splits.items():
        missing = [p for p in paths if not exists(spark, p)]
        if missing and len(missing) < len(paths):
            raise FileNotFoundError(f"{split} lacks {missing}")
        if not missing:
            ready.append(split)
    return ready


def write_report(spark: SparkSession, path: str, rows: dict[str, DataFrame], **facts) -> dict:
    """A JSON file of small results by name (each a list of rows) and facts; also returned."""
    report = facts | {name: [r.asDict(recursive=True) for r in df.collect()] for name, df in rows.items()}
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(report, sort_keys=True, default=str, indent=1).encode()))
    out.close()
    return report


class Parts:
    """Results by name in a folder, each with a fingerprint of what it came from. A result is worked out again only if that differs."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    @staticmethod
    def fingerprint(**inputs) -> str:
        return hashlib.sha256(json.dumps(inputs, sort_keys=True, default=str).encode()).hexdigest()[:16]

    def get(self, name: str, make: Callable[[], DataFrame], **inputs) -> DataFrame:
        """The result of make for these inputs, from the folder if it is there; results of other inputs are removed."""
        print_, own = self.fingerprint(**inputs), f"{self.folder}/{name}"
        path = f"{own}/{print_}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            fs, at = _fs(self.spark, own)
            fs.delete(at, True)
            make().write.parquet(path)
        return self.spark.read.parquet(path)


def empty_answers(s1: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """An answer for each entity that names no match."""
    return s1.select(F.col("entity_id").alias("source1_entity_id")).distinct().withColumn(column, F.lit(""))
