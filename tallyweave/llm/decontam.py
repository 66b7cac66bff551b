"""Benchmark decontamination with DataFrame functions only: item-sized windows that hold enough of an item's shingles, SimHash within a proven radius, exact similarity of weighted shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import checkpointed, discard, lower_ascii, table

SPACE = "[\\x20\\x09-\\x0D]+"
#: The gate that passes over shingles no item has is a literal of 2**GATE_BITS bytes; a fuller gate lets more through and loses none.
GATE_BITS = 18
#: Rows of item shingles that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    """ASCII-lower-cased words; null and empty texts have none."""
    plain = F.btrim(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r"))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, SPACE))


def shingles_at(words: Column, starts: Column, shingle: int) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(words, i + 1, shingle)).alias("h")))


def n_shingles(words: Column, shingle: int) -> Column:
    return F.greatest(F.size(words) - (shingle - 1), F.least(F.size(words), F.lit(1)))


def hashes(words: Column, shingle: int) -> Column:
    """Hashes of all shingles with repeats; of fewer words, that of all of them."""
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n_shingles(words, shingle) - 1, F.lit(0))), lambda i: F.xxhash64(F.slice(words, i + 1, shingle)))
    )


def simhash(hs: Column) -> Column:
    """64-bit SimHash of an array of hashes: a bit is set if over half of them have it."""
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda b: F.when(
            2 * F.aggregate(hs, F.lit(0), lambda acc, h: acc + F.getbit(h, b).cast("int")) > F.size(hs),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), b),
        ).otherwise(F.lit(0).cast("bigint")),
    )
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(x))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two arrays with repeats: sum of the smaller counts over sum of the larger."""
    both = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x)))
    )
    total = F.size(a) + F.size(b) - both
    return F.when(total > 0, both / total).otherwise(F.lit(0.0))


def grams(words: Column, shingle: int) -> Column:
    """The shingles themselves."""
    return F.transform(F.sequence(F.lit(0), F.greatest(n_shingles(words, shingle) - 1, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, shingle), " "))


def spoiled(n: int, least: float) -> int:
    """Shingles of an item-sized window of n that may miss the item at this similarity."""
    return int(n - n * 2 * least / (1 + least) + 1e-9)


def stride(sizes: list[int], least: float) -> int:
    """The widest step at which any window that is similar enough has a sampled shingle in common with its item."""
    short = [n for size in sizes for n in range(int(size * least), size + 1) if n]
    return max(s for s in range(1, 9) if s == 1 or all(n // s > spoiled(n, least) for n in short))


def bits_that_may_flip(hs: Column, spoil: Column) -> Column:
    """In how many bits the SimHash of hs can differ from that of any list as similar as it must be: spoil of its hashes may be others, or as many more or fewer."""
    counts = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.aggregate(hs, F.lit(0), lambda acc, h: acc + F.getbit(h, b).cast("int")))
    return F.size(F.filter(counts, lambda c: F.abs(2 * c - F.size(hs)) <= 2 * spoil + 1))


def starts_of(at: Column, need: Column, n: Column, last: Column) -> Column:
    """All starts from 0 to last at which a window of n places holds need or more of the sorted places at; each once, in order."""
    none = F.array().cast("array<int>")

    def between(i: Column) -> Column:
        low = F.greatest(F.get(at, i + need - 1) - n + 1, F.lit(0), F.coalesce(F.get(at, i - 1) + 1, F.lit(0)))
        high = F.least(F.get(at, i), last)
        return F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(none)

    most = F.size(at) - need
    return F.when(most < 0, none).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), between)))


def held(column: Column, name: str) -> Column:
    """The column worked out once: no filter and no later expression is drawn below the generator that gives it."""
    return F.explode(F.array(column)).alias(name)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(id_col, item_col, start, similarity): documents with a window of an item's number of words that is similar to the item by least or more; its best window, the first of equals.

    1. A shingle at every stride-th word is looked up among the items' shingles; the stride is so
       narrow that every window similar enough has a hit. Documents without a hit are done.
    2. Of the others all shingles are looked up. A window can only be similar enough if so many of its
       places have shingles of the item that their number alone reaches the similarity, in whatever
       order they stand. All such windows are taken, and no others.
    3. Windows and item are compared by SimHash. The radius is that item's own: the bits that can
       differ at all at this similarity, so no match is lost.
    4. The weighted Jaccard similarity of the shingles themselves decides.

    Equal windows are judged once for an item. Items and documents without words, null texts among
    them, match nothing; a document shorter than an item is one window. Null ids are kept. Rows that
    repeat an id are judged together, the best row counts; items that repeat an id likewise. Other
    columns don't reach the result. Empty tables give no rows. Items are small against the documents;
    their number is checked before they are broadcast.
    """
    item = items.select(F.col(item_col).alias("item"), words_of(F.col(item_text)).alias("w")).where(F.size("w") > 0).distinct()
    item = item.select("item", "w", F.size("w").alias("size"), n_shingles(F.col("w"), shingle).alias("n"), hashes(F.col("w"), shingle).alias("hs"))
    # Arrays that a lambda reads over and over are written first, so that it reads them and doesn't work them out again.
    item = checkpointed(item.withColumn("g", grams(F.col("w"), shingle)).withColumn("key", F.xxhash64("item", "w")))
    share = F.lit(2 * least / (1 + least))
    item = checkpointed(item.withColumn("fp", simhash(F.col("hs"))).withColumn("radius", bits_that_may_flip(F.col("hs"), F.floor(F.col("n") * (1 - share) + 1e-9).cast("int"))))
    seeds = checkpointed(item.select("key", "size", "n", F.explode("hs").alias("h")).distinct())
    kinds = [(r["size"], r["n"]) for r in seeds.select("size", "n").distinct().collect()]
    long = sorted({n for size, n in kinds if size >= shingle})
    few = seeds.count() <= BROADCAST_ROWS
    near = F.broadcast if few else lambda x: x
    step = stride(long, least)
    gate = bytearray(1 << GATE_BITS)
    for r in seeds.select(F.shiftrightunsigned("h", 64 - GATE_BITS).alias("s")).distinct().toLocalIterator():
        gate[r["s"]] = 1
    shut = F.lit(bytes(gate))

    def passes(h: Column) -> Column:
        return F.substring(shut, F.call_function("shiftrightunsigned", h, F.lit(64 - GATE_BITS)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01")

    none = F.array().cast("array<struct<at:int,h:bigint>>")
    w = F.col("w")

    def hits(step: int) -> Column:
        found = F.when(F.size("w") > 0, shingles_at(w, F.sequence(F.lit(0), F.greatest(n_shingles(w, shingle) - 1, F.lit(0)), F.lit(step)), shingle)).otherwise(none)
        # An item of fewer words than a shingle is one shingle of its own size; those are looked up at every word.
        for k in sorted({size for size, _ in kinds if size < shingle}):
            found = F.concat(found, F.when(F.size("w") > k, shingles_at(w, F.sequence(F.lit(0), F.size("w") - k), k)).otherwise(none))
        return F.filter(found, lambda x: passes(x["h"]))

    doc = docs.select(F.col(id_col).alias("id"), held(words_of(F.col(text_col)), "w")).select("id", "w", held(hits(step), "some")).where(F.size("some") > 0)
    doc = checkpointed(doc.select("id", "w", F.monotonically_increasing_id().alias("row")))
    seen = doc.select("row", F.size("w").alias("words"), n_shingles(w, shingle).alias("own"), F.explode(hits(1)).alias("hit"))
    seen = seen.select("row", "words", "own", F.col("hit.at").alias("at"), F.col("hit.h").alias("h")).join(near(seeds), "h")
    seen = seen.groupBy("row", "key", "words", "own", "size", "n").agg(F.array_sort(F.collect_list("at")).alias("at"))
    places = F.least("n", "own")
    need = F.greatest(F.ceil((F.col("n") + places) * F.lit(least / (1 + least)) - 1e-9).cast("int"), F.lit(1))
    found = starts_of(F.col("at"), F.col("need"), F.col("places"), F.col("last"))
    seen = checkpointed(seen.withColumns({"places": places, "need": need, "last": F.greatest(F.col("words") - F.col("size"), F.lit(0))}).where(F.size("at") >= F.col("need")))
    laid = seen.select("row", "key", "size", F.explode(found).alias("start")).join(doc, "row")
    windows = checkpointed(laid.select("id", "key", "start", "size", F.array_join(F.slice("w", F.col("start") + 1, F.col("size")), " ").alias("t")))
    text = checkpointed(windows.select("size", "t").distinct().withColumn("tw", F.split("t", " ")))
    text = checkpointed(text.select("size", "t", hashes(F.col("tw"), shingle).alias("hs"), grams(F.col("tw"), shingle).alias("g")))
    text = checkpointed(text.select("size", "t", "g", simhash(F.col("hs")).alias("fp")))
    met = windows.select("key", "size", "t").distinct().join(text, ["size", "t"])
    met = met.join(near(item.select("item", "key", F.col("fp").alias("item_fp"), "radius", F.col("g").alias("item_g"))), "key")
    met = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= F.col("radius"))
    met = checkpointed(met.select("t", "size", "key", "item", similarity(F.col("g"), F.col("item_g")).alias("similarity"))).where(F.col("similarity") >= least)
    best = windows.join(met.select("t", "size", "key", "item", "similarity"), ["t", "size", "key"]).groupBy("id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("b")
    )
    out = checkpointed(best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("b.s")).cast("long").alias("start"), F.col("b.similarity").alias("similarity")))
    discard(doc, seen, windows, text, seeds, item)
    return out


def without_benchmark(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **more) -> DataFrame:
    """The rows of docs, all columns, of which the id matches no item. Rows with a null id stay unless they match."""
    gone = matches(docs, items, id_col=id_col, **more).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["__gone"]), "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
