"""Substring dedup: suffixes go by prefix into groups that fit in memory; the deep internal nodes of each group's suffix tree, read from sorted suffixes and common prefixes, give the repeats of a window of words or more."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import checkpointed, discard, pieces, table, utf8

#: Suffixes of one prefix that one suffix tree takes. Prefixes with more are lengthened to a whole window; all suffixes of such a
#: prefix are below one deep node, of which only the least place is needed, so it is aggregated and never held.
TREE_ROWS = 1000
#: The filter of repeated prefixes has 2**30 bits (128 MB) at most. A fuller filter lets more suffixes through and loses none.
FILTER_BITS = 30


def anchors(words: list[bytes], window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places of a text at which suffixes are taken: place, hash of the seed words there, first and last window (by its first word) that has this place.

    Each window takes the place of its seed with the smallest hash, the leftmost of equals: equal
    windows take the same place, whatever surrounds them.
    """
    import xxhash

    n = len(words)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    h = np.frombuffer(b"".join([xxhash.xxh64_digest(w) for w in words]), ">u8").astype(np.uint64)
    g = h[: n - seed + 1].copy()
    for j in range(1, seed):
        g *= np.uint64(0x9E3779B97F4A7C15)
        g += h[j : n - seed + 1 + j]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(32)
    span = window - seed + 1
    # Sliding minimum with its leftmost place, by doubling: m covers `have` seeds from each place.
    m, at, have = g, np.arange(len(g)), 1
    while have < span:
        step = min(have, span - have)
        left, right = m[:-step], m[step:]
        take = right < left
        m, at, have = np.where(take, right, left), np.where(take, at[step:], at[:-step]), have + step
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    place = at[first]
    return place, g[place], first, last


def common_words(a: list[bytes], b: list[bytes]) -> int:
    """Length of the common prefix."""
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def deep_nodes(suffixes: list[list[bytes]], depth: int) -> Iterator[tuple[list[int], int]]:
    """The highest internal nodes of depth words or more in the suffix tree of these suffixes: the leaves below each, and its own depth, the length of the maximal repeat that it is.

    The tree is read from the sorted suffixes and the common prefixes of neighbours: a run of neighbours
    with depth words or more in common is one such node, as deep as its first and last leaf agree.
    """
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    heads = [suffixes[i][:depth] for i in order]
    start = 0
    for i in range(1, len(order) + 1):
        if i == len(order) or heads[i] != heads[start]:
            if i - start > 1 and len(heads[start]) == depth:
                yield order[start:i], common_words(suffixes[order[start]], suffixes[order[i - 1]])
            start = i


def runs(flags: list[bool]) -> Iterator[tuple[int, int]]:
    """Start and length of each run of true."""
    start = None
    for i, x in enumerate([*flags, False]):
        if x and start is None:
            start = i
        elif not x and start is not None:
            yield start, i - start
            start = None


def _order(row: tuple) -> tuple:
    """Where a suffix starts, for comparing: null ids come after all others."""
    return (row[0] is None, row[0] if row[0] is not None else 0, row[1])


def _filters(seeds: DataFrame, tree_rows: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Bits of the slot, and bitmaps over slots of the prefixes that occur twice or more, and more than tree_rows times.

    The bitmaps are put together on the executors in parts of 65536 slots; their size is fixed by FILTER_BITS.
    """
    many = checkpointed(seeds.groupBy("g").agg(F.sum("n").alias("n")).where("n > 1"))
    bits = min(FILTER_BITS, max(16, (16 * many.count()).bit_length()))
    slots = many.groupBy(F.shiftrightunsigned("g", 64 - bits).alias("slot")).agg(F.max((F.col("n") > tree_rows).cast("int")).alias("hot"))

    def part(pdf):
        import pandas as pd

        low = (pdf["slot"] & 0xFFFF).to_numpy()
        maps = []
        for rows in (low, low[pdf["hot"].to_numpy() == 1]):
            flags = np.zeros(1 << 16, bool)
            flags[rows] = True
            maps.append(np.packbits(flags, bitorder="little").tobytes())
        return pd.DataFrame({"part": [int(pdf["slot"].iloc[0]) >> 16], "some": [maps[0]], "hot": [maps[1]]})

    some, hot = np.zeros(1 << (bits - 3), np.uint8), np.zeros(1 << (bits - 3), np.uint8)
    got = slots.groupBy(F.shiftright("slot", 16)).applyInPandas(part, "part long, some binary, hot binary")
    for row in got.toLocalIterator():
        at = row["part"] << 13
        some[at : at + 8192] = np.frombuffer(row["some"], np.uint8)
        hot[at : at + 8192] = np.frombuffer(row["hot"], np.uint8)
    return bits, some, hot


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, seed: int = 8, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(id, th, start, n): n windows of the text with this id and xxhash64 th, from word start on, whose words also start earlier.

    Earlier: in a smaller id, or in the same document before. Null ids come after all others. Rows
    that repeat an id and text have the same places and don't make each other repeat.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    kind = df.schema[id_col].dataType.simpleString()

    def count_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2048):
            found = [anchors(x.split(), window, seed)[1] for x in utf8(batch.column(0))]
            g, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], ["g", "n"])

    bits, some, hot = _filters(rows.select("text").mapInArrow(count_seeds, "g long, n long"), tree_rows)
    shared = df.sparkSession.sparkContext.broadcast((some, hot))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, hot = shared.value
        for batch in pieces(batches, 256):
            index, out = [], [[] for _ in range(6)]
            for i, text in enumerate(utf8(batch.column(1))):
                words = text.split()
                _, g, first, last = anchors(words, window, seed)
                slot = (g >> np.uint64(64 - bits)).astype(np.int64)
                for j in np.flatnonzero(some[slot >> 3] >> (slot & 7).astype(np.uint8) & 1):
                    a, b = int(first[j]), int(last[j])
                    piece, s = b" ".join(words[a : b + window]), int(slot[j])
                    large = bool(hot[s >> 3] >> (s & 7) & 1)
                    digest = hashlib.blake2b(piece, digest_size=16).digest() if large else b""
                    index.append(i)
                    values = (large, int.from_bytes(digest[:8], "little", signed=True) if large else int(g[j].view(np.int64)), int.from_bytes(digest[8:], "little", signed=True), a, b - a + 1, piece)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            at = pa.array(index, pa.int32())
            columns = [batch.column(0).take(at), batch.column(2).take(at), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "th", "large", "k1", "k2", "start", "n", "words"])

    suffixes = checkpointed(rows.select("id", "text", "th").mapInArrow(take, f"id {kind}, th long, large boolean, k1 long, k2 long, start int, n int, words binary"))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A tree for each prefix; rows come sorted by it."""

        def tree(group: list[tuple]) -> None:
            suffixes, place = [], []
            for r, (_, _, _, _, n, text) in enumerate(group):
                words = text.split(b" ")
                for i in range(n):
                    suffixes.append(words[i:])
                    place.append((r, i))
            flags = [[False] * x[4] for x in group]
            for leaves, _ in deep_nodes(suffixes, window):
                starts = [_order((group[r][1], group[r][3] + i)) for r, i in map(place.__getitem__, leaves)]
                least = min(starts)
                for x, leaf in zip(starts, leaves, strict=True):
                    if x > least:
                        r, i = place[leaf]
                        flags[r][i] = True
            for row, own in zip(group, flags, strict=True):
                if any(own):
                    out.extend((row[1], row[2], row[3] + a, n) for a, n in runs(own))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_kind), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())], ["id", "th", "start", "n"])

        out: list[tuple] = []
        group: list[tuple] = []
        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field("id").type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    if len(group) > 1:
                        tree(group)
                    group = []
                group.append(row)
            if len(out) > 5000:
                yield flush()
        if len(group) > 1:
            tree(group)
        if id_kind is not None:
            yield flush()

    small = suffixes.where("not large").select("k1", "id", "th", "start", "n", "words").repartition("k1").sortWithinPartitions("k1")
    found = checkpointed(small.mapInArrow(grow, f"id {kind}, th long, start int, n int"))

    # Long prefixes: equal surroundings are one class, of which all but the first repeat; the first ones of the classes meet window by window.
    place = F.struct(F.col("id").isNull().alias("late"), F.col("id").alias("id"), F.col("start").alias("start"))
    large = suffixes.where("large").withColumn("place", place)
    # Written, so that the join takes both sides from plain exchanges and Spark can split a hot class.
    first = checkpointed(large.groupBy("k1", "k2").agg(F.min("place").alias("first")))
    classes = checkpointed(large.join(first, ["k1", "k2"]).select("k1", "k2", "id", "th", "start", "n", "place", "first", F.when(F.col("place") == F.col("first"), F.col("words")).alias("words")))
    copies = classes.where("place > first").select("id", "th", "start", "n")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2000):
            index, keys, starts = [], [], []
            for i, (start, n, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("start", "n", "words")), strict=True)):
                words = text.split(b" ")
                for j in range(n):
                    index.append(i)
                    starts.append(start + j)
                    keys.append(hashlib.blake2b(b" ".join(words[j : j + window]), digest_size=16).digest())
            at = pa.array(index, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("th").take(at), pa.array(starts, pa.int32()), pa.array(keys, pa.binary())], ["id", "th", "start", "key"])

    own = checkpointed(classes.where("place = first").select("id", "th", "start", "n", "words").mapInArrow(windows, f"id {kind}, th long, start int, key binary"))
    placed = own.withColumn("place", place)
    again = checkpointed(placed.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("c")).where("c > 1"))
    met = placed.join(again, "key")
    out = checkpointed(found.union(copies).union(met.where("place > first").select("id", "th", "start", F.lit(1).alias("n"))))
    for done in (found, suffixes, first, classes, own, again):
        discard(done)
    return out


def _marked(df: DataFrame, id_col: str, text_col: str, window: int, **more) -> DataFrame:
    """The columns of df by place, as c0, c1 and so on, so that no name can clash, and spans array<struct<start, n>>: the words of the text, from start on, n of them, that repeats cover; null if none."""
    spans = repeats(df, id_col, text_col, window, **more).groupBy("id", "th").agg(F.collect_list(F.struct("start", (F.col("n") + window - 1).alias("n"))).alias("spans"))
    rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    i, t = (f"c{df.columns.index(c)}" for c in (id_col, text_col))
    hit = rows[i].eqNullSafe(spans["id"]) & (F.xxhash64(F.coalesce(rows[t], F.lit(""))) == spans["th"])
    return rows.join(spans, hit, "left").drop("id", "th")


def kept_words(text: bytes, spans: list[dict] | None) -> tuple[int, list[bytes]]:
    """Number of words, and the words that no span covers."""
    words = text.split()
    if not spans:
        return len(words), words
    cover = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        cover[s["start"]] += 1
        cover[s["start"] + s["n"]] -= 1
    return len(words), [w for w, c in zip(words, np.cumsum(cover[:-1]).tolist(), strict=True) if not c]


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, **more) -> DataFrame:
    """id_col, n_words, n_removed, kept_sha256 of each row: the kept words joined by one space. Null texts have no words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            got = [kept_words(t, s) for t, s in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True)]
            sha = [hashlib.sha256(b" ".join(k)).hexdigest() for _, k in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array([n - len(k) for n, k in got], pa.int64()), pa.array(sha, pa.string())], ["id", "n_words", "n_removed", "kept_sha256"])

    rows = _marked(df.select(id_col, text_col), id_col, text_col, window, **more)
    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n_words long, n_removed long, kept_sha256 string").withColumnRenamed("id", id_col)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, length_col: str | None = None, **more) -> DataFrame:
    """The rows of df, all columns. Texts with repeats become their kept words, joined by one space (empty if none is kept), and length_col, if given, their number of characters; the rest stay as they are.

    No row goes: null and empty texts stay, rows that repeat an id and text are treated alike, an empty
    table stays empty. Columns may have any names.
    """
    columns = df.columns
    at = columns.index(text_col)
    size = columns.index(length_col) if length_col else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            spans = batch.column(len(columns)).to_pylist()
            text = batch.column(at).to_pylist()
            lengths = None if size is None else batch.column(size).to_pylist()
            for i, s in enumerate(spans):
                if s:
                    text[i] = b" ".join(kept_words(text[i].encode(), s)[1]).decode()
                    if lengths is not None:
                        lengths[i] = len(text[i])
            own = list(batch.columns[: len(columns)])
            own[at] = pa.array(text, pa.string())
            if lengths is not None:
                own[size] = pa.array(lengths, own[size].type)
            yield pa.RecordBatch.from_arrays(own, columns)

    return _marked(df, id_col, text_col, window, **more).mapInArrow(work, df.schema)


#: DuckDB SQL for op7_substring's rows.
OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS key FROM s),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY key ORDER BY doc_id, p) AS nth FROM k),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM r WHERE nth > 1),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS t, count(*) AS n FROM words ANTI JOIN c USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
