"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy, with thresholds calibrated by language."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import pieces, share, table

WORD = re.compile(r"[^\W_]+").findall
#: Labelled rows that the classifier learns from, at most: those with the smallest hash of their id.
SAMPLE = 8000
#: Words whose embeddings a worker remembers; then it starts anew. Only speed depends on it.
WORD_CACHE = 300_000


@dataclass
class Shape:
    buckets: int = 1 << 15
    size: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    slots: int = 3
    steps: int = 16_000
    seed: int = 7


#: What training finds out, by the names of Model.
LEARNT = ("embed", "conv", "bias", "out", "last", "slope", "shift", "thresholds", "threshold")


def slots_of(word: str, shape: Shape) -> tuple[int, ...]:
    """Buckets of a word: of itself, its beginning and its end."""
    return tuple(zlib.crc32(x.encode()) % shape.buckets for x in (word, "^" + word[:5], word[-5:] + "$"))[: shape.slots]


@dataclass
class Model:
    """embed: bucket vectors; filters by width, offset, size and filter flat in conv; then a logistic layer, scaled to probabilities by slope and shift."""

    shape: Shape
    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    last: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.3
    words: dict[str, int] = field(default_factory=dict)
    rows: np.ndarray | None = None

    def vectors(self, words: list[str]) -> np.ndarray:
        if self.rows is None or len(self.words) > WORD_CACHE:
            self.words, self.rows = {}, np.zeros((1 << 14, self.shape.size), np.float32)
        if new := [x for x in dict.fromkeys(words) if x not in self.words]:
            k = len(self.words)
            while k + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[k : k + len(new)] = self.embed[np.array([slots_of(x, self.shape) for x in new])].sum(axis=1)
            self.words.update(zip(new, range(k, k + len(new)), strict=True))
        return self.rows[np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))]

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter and where it is. x has the padding already."""
        f, at, values, places = self.shape.filters, 0, [], []
        y = x @ self.conv
        for w in self.shape.widths:
            n = len(x) - w + 1
            z = y[:n, at : at + f]
            for j in range(1, w):
                z = z + y[j : j + n, at + j * f : at + (j + 1) * f]
            best = z.argmax(axis=0)
            values.append(z[best, np.arange(f)])
            places.append(best)
            at += w * f
        return np.concatenate(values), np.concatenate(places)

    def logit(self, text: str, block: int = 4096) -> float:
        """The raw score of a whole text, in blocks that overlap by the longest filter."""
        words, more = WORD(text.lower()), max(self.shape.widths) - 1
        pad, best = np.zeros((more + 1, self.shape.size), np.float32), None
        for start in range(0, max(1, len(words)), block):
            x = self.vectors(words[start : start + block + more])
            values = self.pooled(np.concatenate([x, pad]))[0]
            best = values if best is None else np.maximum(best, values)
        return float(np.maximum(best + self.bias, 0) @ self.out + self.last)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.logit(text) + self.shift, -30, 30))))


def first_model(ids: list[np.ndarray], labels: np.ndarray, shape: Shape) -> Model:
    """Before training: small random values, and in the first dimension how much more often documents with a bucket are toxic, shrunk for rare buckets."""
    rnd = np.random.default_rng(shape.seed)
    total, toxic = np.zeros(shape.buckets), np.zeros(shape.buckets)
    for x, label in zip(ids, labels, strict=True):
        own = np.unique(x)
        total[own] += 1
        toxic[own] += label
    base = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    rate = (toxic + 5 * base) / (total + 5)
    odds = np.where(total >= 4, np.log(rate / (1 - rate)) - np.log(base / (1 - base)), 0)
    embed = (0.05 * rnd.standard_normal((shape.buckets, shape.size))).astype(np.float32)
    embed[:, 0] = odds
    n = shape.filters
    conv = (0.1 * rnd.standard_normal((shape.size, n * sum(shape.widths)))).astype(np.float32)
    conv[0] = np.abs(conv[0]) + 0.2
    bias = np.zeros(n * len(shape.widths), np.float32)
    return Model(shape, embed, conv, bias, np.full(len(bias), 0.1, np.float32), float(np.log(base / (1 - base))))


def train(texts: list[str], labels: list[int], langs: list[str | None], shape: Shape | None = None) -> Model:
    """The classifier of these rows: four fifths train it, one fifth gives the scale of the score and the threshold of each language.

    No rows, or labels of one kind only, give a constant score of their mean label (0 for no rows).
    """
    shape = shape or Shape()
    y = np.array(labels, np.float32)
    held = np.arange(len(y)) % 5 == 4
    cache: dict[str, tuple[int, ...]] = {}
    ids = []
    for text in texts:
        words = WORD(text.lower())
        for w in words:
            if w not in cache:
                cache[w] = slots_of(w, shape)
        ids.append(np.array([cache[w] for w in words], np.int32).reshape(-1, shape.slots))
    fit = np.flatnonzero(~held)
    model = first_model([ids[i] for i in fit], y[fit], shape)
    if not 0 < y.sum() < len(y):
        model.out[:] = 0
        model.slope, model.shift = 0.0, 30.0 * (1 if len(y) and y[0] else -1)
        return model
    rnd = np.random.default_rng(shape.seed + 1)
    pos, neg = fit[y[fit] == 1], fit[y[fit] == 0]
    f, rate = shape.filters, 0.05
    pad = np.zeros((max(shape.widths), shape.size), np.float32)
    grads = {k: np.full(getattr(model, k).shape, 1e-3, np.float32) for k in ("conv", "bias", "out")}
    last_grad = 1e-3
    embed_grad = np.full(shape.buckets, 1e-2, np.float32)
    for step in range(shape.steps if len(pos) and len(neg) else 0):
        # A third of the steps see a toxic text; the scale fitted afterwards undoes that.
        i = rnd.choice(pos) if step % 3 == 0 else rnd.choice(neg)
        own = ids[i][rnd.random(len(ids[i])) > 0.15] if len(ids[i]) > 8 else ids[i]
        x = np.concatenate([model.embed[own].sum(axis=1), pad])
        value, place = model.pooled(x)
        a = np.maximum(value + model.bias, 0)
        g = 1 / (1 + np.exp(-np.clip(a @ model.out + model.last, -30, 30))) - y[i]
        d = g * model.out * (a > 0)
        parts = {"out": g * a + 1e-4 * model.out, "bias": d, "conv": np.zeros_like(model.conv)}
        at = 0
        for k, w in enumerate(shape.widths):
            for n in range(f):
                dn, p = d[k * f + n], place[k * f + n]
                if dn == 0:
                    continue
                for j in range(w):
                    c = at + j * f + n
                    parts["conv"][:, c] += dn * x[p + j]
                    if p + j < len(own):
                        row, change = own[p + j], dn * model.conv[:, c]
                        embed_grad[row] += float(change @ change)
                        model.embed[row] -= (rate * 0.5 / np.sqrt(embed_grad[row]))[:, None] * change
            at += w * f
        for k, change in parts.items():
            grads[k] += change * change
            getattr(model, k)[...] -= rate * change / np.sqrt(grads[k])
        last_grad += g * g
        model.last -= rate * g / last_grad**0.5
    calibrate(model, [texts[i] for i in np.flatnonzero(held)], y[held], [langs[i] for i in np.flatnonzero(held)])
    return model


def calibrate(model: Model, texts: list[str], y: np.ndarray, langs: list[str | None]) -> None:
    """Slope and shift of the probability by logistic regression, then the threshold of best F1 overall and of each language with 10 toxic rows or more."""
    z = np.array([model.logit(t) for t in texts])
    if not 0 < y.sum() < len(y):
        return
    center, spread = z.mean(), max(z.std(), 1e-6)
    x, a, b = (z - center) / spread, 1.0, float(np.log(y.mean() / (1 - y.mean())))
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = p * (1 - p) + 1e-6
        grad = np.array([(x * (p - y)).sum() + 0.05 * a, (p - y).sum()])
        h = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum()]])
        da, db = np.linalg.solve(h, grad)
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    model.slope, model.shift = float(a / spread), float(b - a * center / spread)
    p = 1 / (1 + np.exp(-(model.slope * z + model.shift)))

    def best(rows: np.ndarray) -> float:
        cuts = np.unique(np.round(np.clip(p[rows], 0.02, 0.98), 3))
        f1 = [2 * (y[rows] * (p[rows] >= c)).sum() / max(1e-9, y[rows].sum() + (p[rows] >= c).sum()) for c in cuts]
        good = cuts[np.array(f1) >= max(f1) - 1e-9]
        return float(np.median(good))

    lang = np.array([x or "" for x in langs], object)
    model.threshold = best(np.arange(len(y)))
    model.thresholds = {x: best(np.flatnonzero(lang == x)) for x in sorted(set(lang)) if y[lang == x].sum() >= 10}


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang", sample: int = SAMPLE, shape: Shape | None = None) -> Model:
    """The classifier of the labelled rows of docs whose crc32 of the id as text, mod 4, isn't 2; of up to sample of them, those with the smallest hashes.

    Labels other than 0 and 1 and null ids are passed over; of repeated labels of an id the largest
    counts, of rows that repeat an id the one with the smallest text. Null texts are empty. Training
    sees whole texts. Empty tables give a model whose scores are about 0.
    """
    key = F.col(id_col).cast("string")
    few = labels.where(F.col(label_col).isin(0, 1) & (F.crc32(key) % 4 != 2)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("__label"))
    few = few.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"), lang.alias("__lang")).join(F.broadcast(few), "__id")
    one = rows.groupBy("__id").agg(F.min(F.struct("__text", "__lang", "__label")).alias("r")).select("__id", "r.*")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: (zlib.crc32(str(r["__id"]).encode()), str(r["__id"])))
        if got:
            model = train([r["__text"] for r in got], [r["__label"] for r in got], [r["__lang"] for r in got], shape)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps({k: getattr(model, k) for k in LEARNT})], pa.binary())], ["model"])

    # One task trains, so that neither texts nor what training needs come to the driver.
    found = one.coalesce(1).mapInArrow(fit, "model binary").first()
    return train([], [], [], shape) if found is None else Model(shape or Shape(), **pickle.loads(found["model"]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id_col, score double, threshold double (of the row's language), flagged boolean of every whole text; null texts count as empty. One row for each row of docs."""
    shared = share(docs.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in batches:
            got = [own.score(t or "") for t in batch.column(1).to_pylist()]
            cut = [own.thresholds.get(x or "", own.threshold) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64()), pa.array(cut, pa.float64()), pa.array([s >= c for s, c in zip(got, cut, strict=True)])], ["id", "score", "threshold", "flagged"])

    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col), F.col(text_col), lang.alias("__lang"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(lambda it: work(pieces(it, 256)), f"id {kind}, score double, threshold double, flagged boolean").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang", **more) -> DataFrame:
    """The rows of docs, all columns, that the threshold of their language doesn't reject.

    The text is scored where it is: nothing is shuffled. Rows with a null id or text are scored like
    others, each row that repeats an id by its own text; an empty table stays empty.
    """
    model = learn(docs, labels, id_col, text_col, label_col, lang_col, **more)
    shared = share(docs.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in pieces(batches, 256):
            langs = batch.column(lang_col).cast(pa.string()).to_pylist() if lang_col in batch.schema.names else [None] * batch.num_rows
            keep = [own.score(t or "") < own.thresholds.get(x or "", own.threshold) for t, x in zip(batch.column(text_col).to_pylist(), langs, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "threshold", "flagged")
