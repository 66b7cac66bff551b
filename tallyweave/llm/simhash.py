"""SimHash near-duplicates: pigeonhole blocks find every close pair of fingerprints, Hamming distance verifies it."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import checkpointed, components, table, text_map, utf8

#: Members of a block that are compared with each other at once; larger blocks are split by further bits.
BLOCK_ROWS = 2048


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text: ASCII-lower-cased words, shingles with repeats, XXH64 with seed 42; a bit is set if over half the hashes have it."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        raw = digest(b" ".join(words), 42)
    else:
        raw = b"".join([digest(b" ".join(x), 42) for x in zip(*(words[i:] for i in range(shingle)), strict=False)])
    n = len(raw) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(n, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) of each row; null and empty texts have fingerprint 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(x, shingle) for x in utf8(batch.column(1))], pa.int64())], ["id", "fp"])

    return text_map(df, [id_col, text_col], work, f"id {df.schema[id_col].dataType.simpleString()}, fp long")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def parts(mask: int, n: int) -> list[int]:
    """The bits of mask in n masks of about equal size."""
    bits = [b for b in range(64) if mask >> b & 1]
    return [sum(1 << b for b in bits[i * len(bits) // n : (i + 1) * len(bits) // n]) for i in range(n)]


def key_masks(radius: int, rows: int) -> list[int]:
    """Masks of which any two fingerprints within radius agree on at least one whole mask.

    64 bits in radius + 2 blocks (one more from 2**26 rows, for longer keys): radius differing bits
    spoil radius blocks at most, so two (three) blocks agree.
    """
    same = 2 if rows < 1 << 26 else 3
    blocks = parts((1 << 64) - 1, radius + same)
    return [sum(x) for x in itertools.combinations(blocks, same)]


def mixed(masks: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """A 64-bit key of a mask and the bits below it. Keys that clash cost comparisons, nothing else."""
    x = (fps & masks) * np.uint64(0x9E3779B97F4A7C15) ^ masks * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def forest(fps: np.ndarray, reps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what pairs within radius connect: each member to the least of its component."""
    order = np.argsort(reps, kind="stable")
    fps, reps = fps[order], reps[order]
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (new == label).all():
            break
        label = new
    return [(int(reps[i]), int(reps[j])) for i, j in enumerate(label) if i != j and reps[i] != reps[j]]


def _level(keyed: DataFrame, radius: int, limit: int) -> DataFrame:
    """One pass over (gkey, mask, fp, rep): edges (kind 0: a, b) of blocks up to limit; members of larger ones under four longer masks each (kind 1).

    A block's rows come sorted one after another, and a task holds up to limit of them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the key at the end of the last batch: gkey, mask, fp, rep
        hot = None  # that key, if its block is known to be large
        edges: list[tuple[int, int]] = []
        split: list[np.ndarray] = []

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            if len(edges) + sum(map(len, split)) > least:
                rows = np.concatenate([np.array([(0, a, b, 0, 0) for a, b in edges], np.int64).reshape(-1, 5), *split])
                edges.clear()
                split.clear()
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(5)], ["kind", "a", "b", "mask", "fp"])

        def divide(rows: np.ndarray) -> None:
            for mask in np.unique(rows[:, 1]):
                own = rows[rows[:, 1] == mask].view(np.uint64)
                for more in parts(~int(own[0, 1]) & (1 << 64) - 1, radius + 1):
                    longer = np.full(len(own), int(own[0, 1]) | more, np.uint64)
                    split.append(np.column_stack([np.ones(len(own), np.int64), own[:, 3].view(np.int64), mixed(longer, own[:, 2]).view(np.int64), longer.view(np.int64), own[:, 2].view(np.int64)]))

        def large(rows: np.ndarray) -> bool:
            # A block with so few free bits that it can't hold more is compared whole.
            return len(rows) > limit and 64 - (int(rows[0, 1]) & (1 << 64) - 1).bit_count() > 11

        def block(rows: np.ndarray) -> None:
            if large(rows):
                divide(rows)
            elif len(rows) > 1:
                edges.extend(forest(np.ascontiguousarray(rows[:, 2]).view(np.uint64), rows[:, 3], radius))

        for batch in batches:
            rows = np.column_stack([np.asarray(c) for c in batch.columns]).astype(np.int64)
            if not len(rows):
                continue
            cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(rows)]])
            last = len(starts) - 1
            if hot is not None and rows[0, 0] == hot:
                divide(rows[: ends[0]])
                starts, ends = starts[1:], ends[1:]
                if not len(starts):
                    yield from flush(20_000)
                    continue
                last -= 1
            elif held and rows[0, 0] == held[0][0, 0]:
                held.append(rows[: ends[0]])
                if last:
                    block(np.concatenate(held))
                starts, ends = starts[1:], ends[1:]
                last -= 1
            elif held:
                block(np.concatenate(held))
                held = []
            if len(starts):
                hot, held = None, []
                size = ends - starts
                two = np.flatnonzero(size[:-1] == 2)
                first, second = starts[two], starts[two] + 1
                close = np.bitwise_count((rows[first, 2] ^ rows[second, 2]).view(np.uint64)) <= radius
                edges.extend(zip(rows[first[close], 3].tolist(), rows[second[close], 3].tolist(), strict=True))
                for r in np.flatnonzero(size[:-1] > 2):
                    block(rows[starts[r] : ends[r]])
                held = [rows[starts[last] : ends[last]]]
            if held and large(whole := np.concatenate(held)):
                divide(whole)
                held, hot = [], whole[0, 0]
            yield from flush(20_000)
        if held:
            block(np.concatenate(held))
        yield from flush(0)

    dealt = keyed.repartition("gkey").sortWithinPartitions("gkey")
    return dealt.select("gkey", "mask", "fp", "rep").mapInArrow(work, "kind long, a long, b long, mask long, fp long")


def links(reps: DataFrame, radius: int = 3, limit: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) between the reps of distinct fingerprints (fp, rep) that connect exactly what pairs within radius connect.

    Blocks of up to limit fingerprints are compared in one task. Larger ones are split again by four
    (radius + 1) further groups of bits, of which one must agree, until they are small or so few bits
    are free that they must be; no block is cut off.
    """
    rows = reps.count()
    masks = key_masks(radius, rows)
    keyed = reps.select(
        F.explode(F.array(*[F.struct(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))).alias("gkey"), F.lit(signed(m)).alias("mask")) for i, m in enumerate(masks)])).alias("k"), "fp", "rep"
    ).select("k.gkey", "k.mask", "fp", "rep")
    found = []
    while True:
        level = checkpointed(_level(keyed, radius, limit))
        found.append(level.where("kind = 0").select("a", "b"))
        keyed = level.where("kind = 1").select(F.col("b").alias("gkey"), "mask", "fp", F.col("a").alias("rep"))
        if keyed.isEmpty():
            break
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out.distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row for each row of df: id_col, fp long, component_id, the smallest id that can be reached over links of radius or fewer differing bits.

    Ids are integers; rows with a null id take part in no group and have a null component. Rows that
    repeat an id each keep their row. Documents with equal fingerprints are one node, so a group of
    copies costs one row however large it is. Empty tables give no rows.
    """
    marked = checkpointed(fingerprints(df, id_col, text_col, shingle).withColumn("id", F.col("id").cast("long")))
    reps = checkpointed(marked.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")))
    # An id that is the least of two fingerprints (repeated ids) is one node.
    roots = components(links(reps, radius))
    of_fp = reps.join(roots, reps.rep == roots.node, "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    out = marked.join(of_fp, "fp", "left")
    return out.select(F.col("id").alias(id_col), "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of df, all columns, of which the id is the smallest of its group. Rows with a null id stay; rows that repeat a kept id stay together."""
    found = near_duplicates(df, id_col, text_col, shingle, radius)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct()
    return df.join(gone, df[id_col] == gone["__gone"], "left_anti")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
