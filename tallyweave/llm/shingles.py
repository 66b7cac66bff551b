"""Near copies by SimHash and exact shingle similarity: blocks of fingerprints find close texts, prefixes of ordered shingles every other pair that can be similar enough; weighted Jaccard decides."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import simhash
from tallyweave.llm.common import checkpointed, components, discard, pieces, share, text_map, utf8

#: Texts, at most, whose shingles say which ones are common, and how many of those are remembered. Common
#: shingles come last in the order of all shingles; any order finds all pairs, so only speed depends on them.
ORDER_TEXTS, ORDER_SHINGLES = 20_000, 200_000
#: Comparisons of a text in a round, at most. A link to a group saves all other comparisons within that group, so rounds go on
#: while they find links; what is left then is compared in full.
STARS = 4
#: Rounds go on while one comparison in so many finds a link. Groups of BIG nodes or more are then compared as a whole with all nodes that met one of theirs,
#: BLOCK nodes of either side at a time.
WORTH, BIG, BLOCK = 20, 64, 2000
#: Bits in which fingerprints of near copies may differ to be found by SimHash.
RADIUS = 3
TALLY = ("t0", "t1", "t2", "t3")
#: Pairs, or as many as there are texts if those are more, whose texts are brought together at once.
SLICE = 100_000


def elements(text: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted hashes of a text's shingles; each repeat is an element of its own, so the Jaccard of two sets is the weighted one of the shingles. Fewer words than a shingle are one."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_digest
    grams = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) > shingle else [words]
    h = np.sort(np.frombuffer(b"".join([digest(b" ".join(x), 42) for x in grams]), ">u8").astype(np.uint64))
    repeat = np.arange(len(h)) - np.searchsorted(h, h)
    return np.sort(h + repeat.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def node_of(text: bytes) -> int:
    """The same number for texts of the same words."""
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(b" ".join(text.lower().split())), "big", signed=True)


def prefix(e: np.ndarray, common: np.ndarray, rank: np.ndarray, least: float) -> np.ndarray:
    """The first elements of e, by rank and then by value: two sets of similarity least or more have one of these in common."""
    n = len(e)
    at = np.searchsorted(common, e)
    at[at == len(common)] = 0
    place = np.where(common[at] == e, rank[at], 0) if len(common) else np.zeros(n, np.int64)
    return e[np.lexsort((e, place))[: n - math.ceil(least * n - 1e-9) + 1]] if n else e


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else 0.0


def sketch(e: np.ndarray) -> bytes:
    """Bits at the elements modulo a power of two, at least twice as many as elements; the halves of a longer one, put together, are the shorter one."""
    m = max(64, 1 << (2 * len(e) - 1).bit_length()) if len(e) else 64
    flags = np.zeros(m, bool)
    flags[(e & np.uint64(m - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def tally(e: np.ndarray) -> np.ndarray:
    """Elements in each of 64 bins modulo 16, in four longs. Bins are cut by other bits than those of a sketch."""
    counts = np.bincount((e >> np.uint64(58)).astype(np.int64), minlength=64).astype(np.uint64) & np.uint64(15)
    return (counts.reshape(4, 16) << np.arange(0, 64, 4, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def bins_of(longs: np.ndarray) -> np.ndarray:
    """The 64 counts of each row of four longs."""
    x = np.ascontiguousarray(longs).view(np.uint64)
    return (x[:, :, None] >> np.arange(0, 64, 4, dtype=np.uint64) & np.uint64(15)).astype(np.uint8).reshape(len(x), 64)


def apart(bins: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Elements, at least, that only one of two sets has: each moves the count of its bin by one. One set against several, by their bins."""
    gap = (others - bins) & np.uint8(15)
    return np.minimum(gap, np.uint8(16) - gap).sum(axis=1, dtype=np.int64)


def may_match(m: int, x: bytes, n: int, y: bytes, least: float) -> bool:
    """False only if sets of m and n elements with these sketches can't be similar by least: a bit that one sketch has alone is an element that the other set lacks."""
    if min(m, n) < least * max(m, n) - 1e-9:
        return False
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(p) > len(q):
        p = p[: len(p) // 2] | p[len(p) // 2 :]
    while len(q) > len(p):
        q = q[: len(q) // 2] | q[len(q) // 2 :]
    both = np.bitwise_count(p & q).sum()
    most = min(m - (int(np.bitwise_count(p).sum()) - int(both)), n - (int(np.bitwise_count(q).sum()) - int(both)))
    return most >= (least - 1e-12) * (m + n - most)


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The rows of sorted batches of longs, in lists of whole keys (column 0)."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.column_stack([np.asarray(c) for c in batch.columns]).astype(np.int64)
        if not len(rows):
            continue
        cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
        groups = np.split(rows, cuts)
        if held and held[0][0, 0] == groups[0][0, 0]:
            held.append(groups.pop(0))
            if not groups:
                continue
        done = [np.concatenate(held)] if held else []
        held = [groups.pop()]
        yield done + groups
    if held:
        yield [np.concatenate(held)]


def once(found: Iterator[np.ndarray], most: int = 1_000_000) -> Iterator[np.ndarray]:
    """The rows without repeats, as far as a task can hold them: whenever most rows have come, the different ones go on if they are more than half of that."""
    held: list[np.ndarray] = []
    for x in found:
        held.append(x)
        if sum(map(len, held)) > most:
            held = [np.unique(np.concatenate(held), axis=0)]
            if len(held[0]) > most // 2:
                yield held.pop()
    if held:
        yield np.unique(np.concatenate(held), axis=0)


def dealt(rows: DataFrame, each: Callable, names: list[str], repeats: bool = True) -> DataFrame:
    """What each gives (an array of longs or None) for the rows of each key, the first column. Without repeats, a task gives what several of its keys give once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for groups in by_key(batches):
            some = [x for g in groups if len(g) > 1 and (x := each(g)) is not None]
            if some:
                yield np.concatenate(some)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in found(batches) if repeats else once(found(batches)):
            for i in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in out[i : i + 50_000].T], names)

    key = rows.columns[0]
    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(work, ", ".join(f"{n} long" for n in names))


def leaders(g: np.ndarray) -> np.ndarray | None:
    """(h, node, n, place, lead) of one shingle: its nodes once each and the one that leads, another one for each shingle."""
    g = g[np.unique(g[:, 1], return_index=True)[1]]
    if len(g) < 2:
        return None
    return np.column_stack([g, np.full(len(g), g[np.argmin(drawn(g[:, 1], g[0, 0])), 1])])


def drawn(nodes: np.ndarray, seed: int) -> np.ndarray:
    """A number of each node by which it is drawn, another one for each seed."""
    x = (nodes ^ np.int64(seed)).view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


def joiners(turn: int, least: float) -> Callable:
    def pairs(g: np.ndarray) -> np.ndarray | None:
        """(h, node, n, place, group): each node outside the largest group of a shingle with one node of that group, whose size allows the similarity if there is one."""
        groups, at, counts = np.unique(g[:, 4], return_inverse=True, return_counts=True)
        if len(groups) < 2:
            return None
        inside = at == np.argmax(counts)
        g, members = g[~inside], g[inside]
        members = members[np.lexsort((drawn(members[:, 1], turn ^ int(members[0, 0])), members[:, 2]))]
        # A window of sizes from which one member is drawn.
        low = np.searchsorted(members[:, 2], np.ceil(g[:, 2] * least - 1e-9), "left")
        high = np.searchsorted(members[:, 2], np.floor(g[:, 2] / least + 1e-9), "right")
        some = high > low
        if not some.any():
            return None
        g, low, high = g[some], low[some], high[some]
        other = members[low + (drawn(g[:, 1], turn ^ int(g[0, 0])) % (high - low).astype(np.uint64)).astype(np.int64), 1]
        return np.column_stack([g[:, 1], other])

    return pairs


def visitors(g: np.ndarray) -> np.ndarray | None:
    """(h, node, n, place, group, big): each node with each big group, not its own, that this shingle has a node of."""
    hosts = np.unique(g[g[:, 5] == 1, 4])
    out = [np.column_stack([x := g[g[:, 4] != host, 1], np.full(len(x), host)]) for host in hosts]
    return np.concatenate(out) if out and sum(map(len, out)) else None


def meet(visits: DataFrame, members: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Links (a, b) of nodes with big groups: for each (node, group) of visits one member of the group that is similar by least or more, if there is one. members: (node, group).

    A task holds a block of a group's members as an index of their elements and counts what each node
    of a block of visitors shares with all of them; no pair is written but the links.
    """

    def near(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        if not len(left) or not len(right):
            return none
        own = [elements(x.encode(), shingle) for x in right["text"]]
        sizes, who = np.array([len(e) for e in own]), right["node"].to_numpy()
        flat, at = np.concatenate(own), np.repeat(np.arange(len(own)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, at = flat[order], at[order]
        a, b = [], []
        for node, text in zip(left["node"], left["text"], strict=True):
            e = elements(text.encode(), shingle)
            low, high = np.searchsorted(flat, e, "left"), np.searchsorted(flat, e, "right")
            count = high - low
            hit = at[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
            both = np.bincount(hit, minlength=len(own))
            right_ones = np.flatnonzero(both >= (least - 1e-12) * (len(e) + sizes - both)) if len(e) else []
            if len(right_ones):
                a.append(min(node, who[right_ones[0]]))
                b.append(max(node, who[right_ones[0]]))
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    def parts(df: DataFrame) -> DataFrame:
        sizes = checkpointed(df.groupBy("group").agg((F.ceil(F.count("*") / BLOCK)).cast("int").alias("parts")))
        return df.join(sizes, "group")

    text = texts.select("node", "text")
    block = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    left, right = parts(visits), parts(members.join(visits.select("group").distinct(), "group"))
    other = lambda df, name: df.select("group", F.col("parts").alias(name)).distinct()
    left = left.withColumn("l", block).join(other(right, "p"), "group").withColumn("r", F.explode(F.sequence(F.lit(0), F.col("p") - 1))).select("group", "l", "r", "node").join(text, "node")
    right = right.withColumn("r", block).join(other(parts(visits), "p"), "group").withColumn("l", F.explode(F.sequence(F.lit(0), F.col("p") - 1))).select("group", "l", "r", "node").join(text, "node")
    keys = ["group", "l", "r"]
    some = lambda df: df.withColumn("text", F.coalesce("text", F.lit(""))).groupBy(*keys)
    return checkpointed(some(left).cogroup(some(right)).applyInPandas(near, "a long, b long").distinct())


def across(least: float) -> Callable:
    def pairs(g: np.ndarray) -> np.ndarray | None:
        """(h, node, n, place, group, tally): pairs of nodes of different groups whose sizes, and the places of this shingle if it is the first that they share, and whose tallies allow the similarity."""
        if (g[:, 4] == g[0, 4]).all():
            return None
        g, out = g[np.argsort(g[:, 2], kind="stable")], []
        ends = np.searchsorted(g[:, 2], np.floor(g[:, 2] / least + 1e-9), "right")
        left, bins = g[:, 2] - g[:, 3], bins_of(g[:, 5:9])
        for i, end in enumerate(ends):
            other = g[i + 1 : end]
            fits = (other[:, 4] != g[i, 4]) & (np.minimum(left[i], left[i + 1 : end]) >= least / (1 + least) * (other[:, 2] + g[i, 2]) - 1e-9)
            if not fits.any():
                continue
            most = (1 - least) / (1 + least) * (other[fits, 2] + g[i, 2]) + 1e-9
            other = other[fits, 1][apart(bins[i], bins[i + 1 : end][fits]) <= most]
            if len(other):
                out.append(np.column_stack([np.minimum(other, g[i, 1]), np.maximum(other, g[i, 1])]))
        return np.concatenate(out) if out else None

    return pairs


def sketched(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, n, bits, t0 to t3, fp): elements of each text, their sketch and tally, and the SimHash of the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = utf8(batch.column(1))
            own = [elements(x, shingle) for x in raw]
            tallies = np.stack([tally(e) for e in own])
            columns = [batch.column(0), pa.array([len(e) for e in own], pa.int64()), pa.array([sketch(e) for e in own], pa.binary()), *[pa.array(np.ascontiguousarray(t)) for t in tallies.T], pa.array([simhash.fingerprint(x, shingle) for x in raw], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "bits", *TALLY, "fp"])

    return checkpointed(text_map(texts, ["node", "text"], work, f"node long, n long, bits binary, {', '.join(f'{t} long' for t in TALLY)}, fp long"))


def close_prints(sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that the blocks of SimHash connect: equal fingerprints, and those that differ in RADIUS bits or fewer."""
    prints = checkpointed(sketches.groupBy("fp").agg(F.min("node").alias("rep")))
    same = sketches.select("node", "fp").join(prints, "fp").where("node != rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    return same.union(simhash.links(prints, RADIUS)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def possible(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches allow the similarity. A sketch is some twentieth of its text, so few texts travel."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            m, x, n, y = (batch.column(i).to_pylist() for i in range(2, 6))
            ok = [may_match(*row, least) for row in zip(m, x, n, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda x: sketches.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return checkpointed(both.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(work, "a long, b long"))


def similar(pairs: DataFrame, texts: DataFrame, sketches: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar by least or more.

    Pairs that their sketches rule out go first. The others go SLICE at a time to their texts, cut by
    the hash of a, so that only so many texts are on disk at once, whatever the number of pairs.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in pieces(batches, 512):
            a, b = (batch.column(i).to_pylist() for i in (0, 1))
            ok = []
            for x, y, s, t in zip(a, b, utf8(batch.column(2)), utf8(batch.column(3)), strict=True):
                if len(known) > 2000:
                    known.clear()
                for node, text in ((x, s), (y, t)):
                    if node not in known:
                        known[node] = elements(text, shingle)
                ok.append(jaccard(known[x], known[y]) >= least - 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = possible(pairs, sketches, least)
    slices = max(1, -(-left.count() // max(SLICE, texts.count())))
    out = []
    for i in range(slices):
        cut = lambda df, x: df.where(F.pmod(F.xxhash64(x, F.lit(7)), F.lit(slices)) == i)  # noqa: B023, E731
        text = lambda df, n: df.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}"))
        both = cut(left, "a").join(text(cut(texts, "node"), "a"), "a").join(text(texts, "b"), "b")
        out.append(checkpointed(both.select("a", "b", "text_a", "text_b").mapInArrow(work, "a long, b long")))
    if slices == 1:
        discard(left)
        return out[0]
    links = checkpointed(reduce(DataFrame.union, out))
    discard(left, *out)
    return links


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(id, root) of the rows of df whose id isn't null: root is the smallest id that can be reached over pairs of texts whose weighted Jaccard of word shingles is least or more.

    1. Texts of the same words are one node. SimHash links nodes of close fingerprints, if their similarity
       is enough; no radius finds all similar texts, so the other steps find the rest.
    2. Of two sets as similar as that, the first n - ceil(least * n) + 1 elements by any common order
       share one. Nodes that share one of these meet; common shingles come last, so few do.
    3. Each node is first compared with some leaders, then, round by round, with some of the largest group
       that it met and isn't in; that costs as many comparisons as nodes.
    4. When rounds find little more, big groups are compared as a whole with each node that met one of
       theirs, and nodes of small groups that met with each other, if sizes, places and tallies of their
       elements allow the similarity.

    Texts without words are alike. Shingles are compared by 64-bit hashes. Null texts count as empty;
    rows that repeat an id and empty tables are as they are.
    """
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([node_of(x) for x in utf8(batch.column(1))], pa.int64())], ["id", "node"])

    marked = checkpointed(text_map(rows, ["id", "text"], number, "id long, node long"))
    reps = checkpointed(marked.groupBy("node").agg(F.min("id").alias("rep")))

    def number_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in utf8(batch.column(0))], pa.int64()), batch.column(0)], ["node", "text"])

    first = rows.join(reps.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").select("text")
    texts = checkpointed(text_map(first, ["text"], number_texts, "node long, text string").dropDuplicates(["node"]))

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([elements(x, shingle) for x in utf8(batch.column(0))]).view(np.int64) if batch.num_rows else [], pa.int64())], ["h"])

    step = max(1, -(-reps.count() // ORDER_TEXTS))
    some = text_map(texts.where(F.pmod("node", F.lit(step)) == 0), ["text"], all_of, "h long")
    top = some.groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(ORDER_SHINGLES).toArrow()
    common = np.asarray(top.column(0)).astype(np.int64).view(np.uint64)
    order = np.argsort(common)
    # The commonest come last.
    shared = share(df.sparkSession, (common[order], (len(common) - np.arange(len(common)))[order]))

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = shared()
        for batch in batches:
            nodes, out = np.asarray(batch.column(0)), []
            for node, text in zip(nodes, utf8(batch.column(1)), strict=True):
                e = elements(text, shingle)
                p = prefix(e, common, rank, least).view(np.int64)
                out.append(np.column_stack([p, np.full(len(p), node), np.full(len(p), len(e)), np.arange(len(p))]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in np.concatenate(out).T], ["h", "node", "n", "place"])

    met = checkpointed(dealt(text_map(texts, ["node", "text"], firsts, "h long, node long, n long, place long"), leaders, ["h", "node", "n", "place", "lead"]))
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    few = lambda df, x, y: df.groupBy(x).agg(F.slice(F.array_sort(F.collect_set(y), lambda p, q: order(p, q)), 1, STARS).alias("l")).select(x, F.explode("l").alias(y)).select(*pair(x, y)).distinct()
    order = lambda p, q: F.when(F.xxhash64(p) < F.xxhash64(q), -1).when(F.xxhash64(p) > F.xxhash64(q), 1).otherwise(0)
    sketches = sketched(texts, shingle)
    done = checkpointed(close_prints(sketches).union(few(met.where("node != lead"), "node", "lead")).distinct())
    links = similar(done, texts, sketches, shingle, least)
    turn, found = 0, None

    def labelled(groups: DataFrame) -> DataFrame:
        return checkpointed(met.join(groups, met.node == groups["node"], "left").select("h", met.node, "n", "place", F.coalesce("root", met.node).alias("group")))

    while found is None or found[0] * WORTH > found[1]:
        turn += 1
        marks = labelled(components(links))
        new = checkpointed(few(dealt(marks, joiners(turn, least), ["node", "other"]), "node", "other").join(done, ["a", "b"], "left_anti"))
        more = similar(new, texts, sketches, shingle, least)
        found = more.count(), new.count()
        links, done = checkpointed(links.union(more)), checkpointed(done.union(new))
        discard(marks, new, more)
    groups = checkpointed(components(links))
    big = checkpointed(groups.groupBy("root").agg(F.count("*").alias("c")).where(F.col("c") >= BIG).select(F.col("root").alias("group")))

    def flagged(groups: DataFrame) -> DataFrame:
        """Nodes by their groups of now; big are those of the groups that took visitors."""
        own = groups.join(big.withColumn("big", F.lit(1)), groups["root"] == big["group"], "left").select(F.col("node").alias("m"), "root", F.coalesce("big", F.lit(0)).alias("big"))
        return checkpointed(met.join(own, met.node == F.col("m"), "left").select("h", met.node, "n", "place", F.coalesce("root", met.node).alias("group"), F.coalesce("big", F.lit(0)).cast("bigint").alias("big")))

    marks = flagged(groups)
    visits = checkpointed(dealt(marks, visitors, ["node", "group"]).distinct())
    members = groups.select("node", F.col("root").alias("group")).join(big, "group")
    links = checkpointed(links.union(meet(visits, members.select("node", "group"), texts, shingle, least)))
    # Nodes of those big groups have been compared with all that they met; the others meet each other.
    small = marks.where("big = 0").join(sketches.select("node", *TALLY), "node").select("h", "node", "n", "place", "group", *TALLY)
    rest = checkpointed(dealt(small, across(least), ["a", "b"], repeats=False).distinct().join(done, ["a", "b"], "left_anti"))
    discard(marks, met, visits, done)
    links = links.union(similar(rest, texts, sketches, shingle, least))
    # Rows that repeat an id which is the least of two texts are one node.
    ends = lambda n: reps.select(F.col("node").alias(n), F.col("rep").alias(f"rep_{n}"))
    roots = components(links.join(ends("a"), "a").join(ends("b"), "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    of_node = reps.join(roots, reps.rep == roots["node"], "left").select(reps.node, F.coalesce("root", "rep").alias("root"))
    return marked.join(of_node, "node").select("id", "root")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of df, all columns, of which the id is the smallest of its group. Rows with a null id stay; rows that repeat a kept id stay together."""
    gone = near_copies(df, id_col, text_col, shingle, least).where("id != root").select(F.col("id").alias("__gone")).distinct()
    return df.join(gone, df[id_col] == gone["__gone"], "left_anti")
