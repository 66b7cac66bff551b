"""URL filters: rules on host and path, and a Bloom filter cascade that tells listed hosts from all others of the corpus exactly, without a join: in segments, each a file that workers read when they need it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import checkpointed, discard, file_system, lower_ascii, process_cache, qualified, shared_dir, table, text_map

#: (host and path, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Listed domains: they and their subdomains are blocked where no rule fits.
LISTED = ("ads-track.example.com", "casino-win.example.com", "cheap-pills.example.com", "free-bets.example.com")
#: Keys of a segment of the cascade, about; bits of a level for each of its keys; bytes of filters that a worker keeps.
SEGMENT_KEYS, BITS_PER_KEY, HELD_BYTES = 1 << 17, 10, 256 << 20


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or no ://."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null or no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def under(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith("." + domain)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. Of equally long rules the first counts."""
    out = (F.lit(None).cast("string"),) * 2
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        at = rule.index("/")
        fits = under(host, rule[:at]) & path.startswith(rule[at:])
        out = F.when(fits, F.lit(rule)).otherwise(out[0]), F.when(fits, F.lit(verdict)).otherwise(out[1])
    return out


def positions(keys: list[bytes], level: int, bits: int, k: int = 4) -> np.ndarray:
    """Bits of each key in the filter of a level: k of 2**bits."""
    import xxhash

    a = np.array([xxhash.xxh64_intdigest(x, 2 * level) for x in keys], np.uint64)
    b = np.array([xxhash.xxh64_intdigest(x, 2 * level + 1) for x in keys], np.uint64) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(k, dtype=np.uint64)[None, :]) >> np.uint64(64 - bits)).astype(np.int64)


def holds(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def layers(inside: list[bytes], outside: list[bytes]) -> list[tuple[int, np.ndarray]]:
    """Filters (bits, bitmap) that tell inside from outside (no key in both): each level encodes what the one before lets through wrongly."""
    found: list[tuple[int, np.ndarray]] = []
    while inside:
        bits, level = max(10, (len(inside) * BITS_PER_KEY).bit_length()), len(found)
        flags = np.zeros(1 << bits, bool)
        flags[positions(inside, level, bits).ravel()] = True
        bitmap = np.packbits(flags, bitorder="little")
        found.append((bits, bitmap))
        wrong = [outside[i] for i in np.flatnonzero(holds(bitmap, positions(outside, level, bits)))] if outside else []
        inside, outside = wrong, inside
    return found


def member(levels: list[tuple[int, np.ndarray]], keys: list[bytes]) -> np.ndarray:
    """Whether each key of the universe is listed: the first level that doesn't hold it decides."""
    out, alive = np.zeros(len(keys), bool), np.arange(len(keys))
    for i, (bits, bitmap) in enumerate(levels):
        if not len(alive):
            break
        ok = holds(bitmap, positions([keys[j] for j in alive], i, bits))
        out[alive[~ok]] = i % 2 == 1
        alive = alive[ok]
    out[alive] = len(levels) % 2 == 1
    return out


def packed(levels: list[tuple[int, np.ndarray]]) -> bytes:
    return b"".join(bytes([bits]) + bitmap.tobytes() for bits, bitmap in levels)


def unpacked(blob: bytes) -> list[tuple[int, np.ndarray]]:
    out, at = [], 0
    while at < len(blob):
        size = 1 << (blob[at] - 3)
        out.append((blob[at], np.frombuffer(blob, np.uint8, size, at + 1)))
        at += 1 + size
    return out


@dataclass
class Cascade:
    """folder: a file for each segment of keys (first bits of their hash) that holds listed ones; files: their names."""

    folder: str
    bits: int
    files: dict[int, str]

    def levels(self, segment: int) -> list[tuple[int, np.ndarray]]:
        """The filters of a segment; a worker keeps those it read last, up to HELD_BYTES."""
        held = process_cache("cascade")
        name = self.files[segment]
        if name not in held:
            while held and sum(x[0] for x in held.values()) > HELD_BYTES:
                held.pop(next(iter(held)))
            fs, path = file_system(self.folder)
            with fs.open_input_file(f"{path}/{name}") as file:
                blob = file.read()
            held[name] = (len(blob), unpacked(blob))
        return held[name][1]

    def holds(self, keys: list[bytes]) -> np.ndarray:
        """Whether each key of the universe is listed. No key is joined, shuffled or compared with a list."""
        segment = segments(keys, self.bits)
        out = np.zeros(len(keys), bool)
        for s in np.unique(segment):
            if int(s) in self.files:
                at = np.flatnonzero(segment == s)
                out[at] = member(self.levels(int(s)), [keys[i] for i in at])
        return out


def segments(keys: list[bytes], bits: int) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(x, 42) >> (64 - bits) if bits else 0 for x in keys], np.int64)


def cascade(universe: DataFrame, segment_keys: int = SEGMENT_KEYS) -> Cascade:
    """The filters of universe (key, listed; each key once), segment by segment on the executors.

    A segment has about segment_keys keys, whatever the number of all; only the names of the files of
    segments with listed keys come to the driver.
    """
    spark = universe.sparkSession
    folder = qualified(spark, f"{shared_dir(spark)}/tallyweave-work/{uuid.uuid4().hex}")
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    n = universe.count()
    bits = max(0, (n // segment_keys).bit_length())

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [x.encode() for x in pdf["key"]]
        flags = pdf["listed"].to_numpy(bool)
        levels = layers([x for x, f in zip(keys, flags, strict=True) if f], [x for x, f in zip(keys, flags, strict=True) if not f])
        if not levels:
            return pd.DataFrame({"segment": pd.Series([], dtype="int64"), "file": pd.Series([], dtype=object)})
        fs, path = file_system(folder)
        name = f"{uuid.uuid4().hex}.bloom"
        with fs.open_output_stream(f"{path}/{name}", compression=None) as file:
            file.write(packed(levels))
        return pd.DataFrame({"segment": [int(segments(keys[:1], bits)[0])], "file": [name]})

    segment = F.shiftrightunsigned(F.xxhash64("key"), 64 - bits) if bits else F.lit(0).cast("bigint")
    rows = universe.select("key", "listed", segment.alias("s")).groupBy("s").applyInPandas(build, "segment long, file string").collect()
    return Cascade(folder, bits, {r["segment"]: r["file"] for r in rows})


def ends_of(host: str, labels: int) -> list[str]:
    """The host's domains of up to so many labels, itself included if it has no more."""
    parts = host.rsplit(".", labels)
    return [".".join(parts[i:]) for i in range(max(0, len(parts) - labels), len(parts))]


def judge(pages: DataFrame, listed: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", rules=RULES, segment_keys: int = SEGMENT_KEYS) -> DataFrame:
    """id_col, host, path, rule, verdict of each row: that of the longest rule that fits, else block for hosts at or under a listed domain and allow for all others.

    listed: a table whose first column has the domains, of any number; null and empty ones list
    nothing, repeated ones count once. The key universe is all domains of the hosts of pages, of as many
    labels as listed ones have at most; it meets the list once, when the cascade is built. Each row of
    pages gives one row, whatever is null or repeated; empty tables give no rows.
    """
    spark = pages.sparkSession
    listed = listed if listed is not None else spark.createDataFrame([(x,) for x in LISTED], "domain string")
    listed = listed.select(lower_ascii(F.col(listed.columns[0])).alias("key")).where("key <> ''").distinct()
    url = F.col(url_col)
    rule, own = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path")).select(F.col(id_col), "host", "path", rule.alias("rule"), own.alias("own"))
    labels = listed.agg(F.max(F.length("key") - F.length(F.replace("key", F.lit("."), F.lit(""))) + 1)).first()[0] or 0

    def domains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = dict.fromkeys(x for host in batch.column(0).to_pylist() for x in ends_of(host, labels))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], ["key"])

    universe = text_map(rows.select("host").distinct(), ["host"], domains, "key string").distinct()
    universe = checkpointed(universe.join(listed.withColumn("listed", F.lit(True)), "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False))))
    filters = cascade(universe, segment_keys)
    discard(universe)

    @F.pandas_udf("boolean")
    def hit(host: pd.Series) -> pd.Series:
        code, hosts = pd.factorize(host)
        own = [[x.encode() for x in ends_of(h, labels)] for h in hosts]
        flags = filters.holds([x for xs in own for x in xs])
        ends = np.cumsum([0, *map(len, own)])
        found = np.array([flags[a:b].any() for a, b in zip(ends[:-1], ends[1:], strict=True)], bool)
        return pd.Series(found[code] if len(hosts) else np.zeros(0, bool))

    verdict = F.coalesce("own", F.when(hit("host"), "block").otherwise("allow"))
    return rows.select(F.col(id_col), "host", "path", "rule", verdict.alias("verdict"))


def _sql() -> str:
    """DuckDB SQL for op5_urlfilter's rows."""
    fit = lambda d: f"(host = '{d}' OR ends_with(host, '.{d}'))"
    cases = [(f"{fit(r[: r.index('/')])} AND starts_with(path, '{r[r.index('/') :]}')", r, v) for r, v in sorted(RULES, key=lambda r: -len(r[0]))]
    pick = lambda i: " ".join(f"WHEN {c[0]} THEN '{c[i]}'" for c in cases)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, CASE {pick(1)} END AS rule,
       CASE {pick(2)} WHEN {' OR '.join(map(fit, LISTED))} THEN 'block' ELSE 'allow' END AS verdict FROM h
"""


OP5_SQL = _sql()


def op5_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
