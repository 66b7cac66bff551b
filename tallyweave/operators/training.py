"""Training and scoring: entity roles, a monotone boosted tree model, isotonic calibration, and how good the probabilities are."""

from __future__ import annotations

import hashlib
import json
import pickle
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators import features
from tallyweave.operators.matching import PAIR, hard_negatives

#: Labelled rows up to which the trees grow on the driver. Beyond that executors add up the histograms of all rows; the model is the same.
TRAIN_ROWS = 200_000
#: Rows of a block, the unit of work on them.
BLOCK = 1 << 16
#: Gradients and losses are whole numbers of 1 / UNIT, so that their sums depend neither on the order of rows nor on how they are cut.
UNIT = 2.0**30
#: Blocks of which a process remembers the log-odds.
REMEMBERED = 64


def bucket_of(entity: Column, seed: int = 42) -> Column:
    """0 to 99, stable for an id."""
    return F.pmod(F.xxhash64(entity, F.lit(seed)), F.lit(100)).cast("int")


def role_of(bucket: Column, val: float = 0.20, calib: float = 0.10) -> Column:
    """calib for the first buckets, then val, then train."""
    a, b = round(calib * 100), round(calib * 100) + round(val * 100)
    return F.when(bucket < a, "calib").when(bucket < b, "val").otherwise("train")


def slices(rows: DataFrame, held_out: DataFrame | None = None, ratio: float = 2.0, least: int = 3) -> DataFrame:
    """rows (ids, label, prior_score) with bucket and role of their entity. Hard negatives are chosen for train and val; calib stays whole; entities of held_out are left out."""
    if held_out is not None:
        rows = rows.join(held_out.select(F.col(held_out.columns[0]).alias(PAIR[0])).distinct(), PAIR[0], "left_anti")
    rows = rows.withColumn("bucket", bucket_of(F.col(PAIR[0]))).withColumn("role", role_of(F.col("bucket")))
    return hard_negatives(rows.where("role <> 'calib'"), ratio, least).unionByName(rows.where("role = 'calib'"))


@dataclass
class Tree:
    """Nodes by number: feature, cut (left: value <= cut), children and value; feature -1 marks a leaf."""

    feature: list[int]
    cut: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        f, c, at = np.array(self.feature), np.array(self.cut), np.zeros(len(x), np.int64)
        left, right = np.array(self.left), np.array(self.right)
        while (inner := f[at] >= 0).any():
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = np.where(x[rows, f[node]] <= c[node], left[node], right[node])
        return np.array(self.value)[at]


@dataclass
class Boosted:
    """base plus the sum of the trees is the log-odds; names and version say what the columns are."""

    names: list[str]
    base: float
    trees: list[Tree] = field(default_factory=list)
    version: int = features.VERSION
    rounds: int = 0

    def raw(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float64)
        return self.base + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def dumps(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def loads(text: str) -> Boosted:
        """Refuses a model of another version or other columns."""
        d = json.loads(text)
        if d["version"] != features.VERSION:
            raise ValueError(f"model of feature version {d['version']}, not {features.VERSION}")
        return Boosted(d["names"], d["base"], [Tree(**t) for t in d["trees"]], d["version"], d["rounds"])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def log_loss(y: np.ndarray, z: np.ndarray) -> float:
    p = np.clip(sigmoid(z), 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()) if len(y) else 0.0


@dataclass
class Block:
    """Binned features (one row for each feature), labels and whether the rows are for validation; key names the block within a training."""

    key: tuple[str, str]
    bins: np.ndarray
    y: np.ndarray
    val: np.ndarray


_MARGINS: OrderedDict[tuple[str, str], tuple[int, np.ndarray]] = OrderedDict()


def rows_of(bins: np.ndarray, tree: Tree, rows: np.ndarray) -> list[np.ndarray]:
    """The rows that reach each node of a tree whose cuts are numbers of bins; children come after their parents."""
    found = [rows] * len(tree.feature)
    for node, j in enumerate(tree.feature):
        if j >= 0:
            rows = found[node]
            goes = bins[j][rows] <= tree.cut[node]
            found[tree.left[node]], found[tree.right[node]] = rows[goes], rows[~goes]
    return found


def margins(block: Block, base: float, trees: list[Tree]) -> np.ndarray:
    """The log-odds of the block's rows. Those that an earlier call found are remembered: trees are only ever added within a training."""
    done, z = _MARGINS.pop(block.key, (0, np.full(len(block.y), base)))
    for tree in trees[done:]:
        gain = np.zeros(len(z))
        for node, rows in enumerate(rows_of(block.bins, tree, np.arange(len(z)))):
            if tree.feature[node] < 0:
                gain[rows] = tree.value[node]
        z = z + gain
    _MARGINS[block.key] = len(trees), z
    while len(_MARGINS) > REMEMBERED:
        _MARGINS.popitem(last=False)
    return z


def histograms(blocks: Iterable[Block], n_features: int, n_bins: int, base: float, trees: list[Tree], shape: Tree, wanted: list[int], loss_of: bool | None = None) -> tuple[int, np.ndarray]:
    """The loss of the validation rows (loss_of) or of the others (None: of none), and for each wanted node of shape the rows, gradients and second derivatives of its training rows by feature and bin."""
    loss, out = 0, np.zeros((len(wanted), 3, n_features, n_bins), np.int64)
    for block in blocks:
        z = margins(block, base, trees)
        p = sigmoid(z)
        if loss_of is not None:
            own, q = block.val == loss_of, np.clip(p, 1e-12, 1 - 1e-12)
            loss -= int(np.rint(UNIT * (block.y * np.log(q) + (1 - block.y) * np.log(1 - q)))[own].astype(np.int64).sum())
        found = rows_of(block.bins, shape, np.flatnonzero(~block.val))
        rows = np.concatenate([found[node] for node in wanted])
        slot = np.repeat(np.arange(len(wanted)) * n_bins, [len(found[node]) for node in wanted])
        g, h = (np.rint(UNIT * x[rows]) for x in (p - block.y, p * (1 - p)))
        for j in range(n_features):
            at = slot + block.bins[j][rows]
            for i, w in enumerate((None, g, h)):
                out[:, i, j] += np.bincount(at, w, len(wanted) * n_bins).astype(np.int64).reshape(len(wanted), n_bins)
    return loss, out


def best_split(of: np.ndarray, signs: np.ndarray, least: int, ridge: float) -> tuple[float, tuple[int, int] | None]:
    """Gain, and feature and bin, of the best split of a node's histogram. A split of a signed feature that turns the sign is refused."""
    n, gs, hs = (int(of[0, 0].sum()), *(of[i, 0].sum() / UNIT for i in (1, 2)))
    if n < 2 * least:
        return 1e-6, None
    nl, gl, hl = (np.cumsum(of[i], axis=1)[:, :-1] / (UNIT if i else 1) for i in range(3))
    turn = signs[:, None] * (-(gs - gl) / (hs - hl + ridge) + gl / (hl + ridge))
    ok = (nl >= least) & (n - nl >= least) & ((signs[:, None] == 0) | (turn >= 0))
    gain = np.where(ok, gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge), -1)
    at = int(gain.argmax())
    return (float(gain.flat[at]), divmod(at, gain.shape[1])) if gain.flat[at] > 1e-6 else (1e-6, None)


def grow(measure: Callable[[Tree, list[int]], np.ndarray], root: np.ndarray, signs: np.ndarray, leaves: int, rate: float, least: int = 20, ridge: float = 1.0) -> Tree:
    """One tree, best leaf first; cuts are numbers of bins. Bounds keep what lies below a split of a signed feature on its side.

    measure gives the histograms of nodes. It is asked at once for all leaves that can still be split, of
    each the smaller half; the other half is the difference.
    """
    shape, known, sums = Tree([-1], [0], [0], [0], [0.0]), {0: root}, {0: root[1:, 0].sum(axis=1) / UNIT}
    splits = {0: best_split(root, signs, least, ridge)}
    while True:
        picked, open_ = [], [0]
        while len(picked) + 1 < leaves and open_:
            node = max(open_, key=lambda i: splits[i][0])
            if splits[node][1] is None or shape.feature[node] < 0:
                break
            open_.remove(node)
            picked.append(node)
            open_ += [shape.left[node], shape.right[node]]
        first = sorted((i for i in open_ if splits[i][1]), key=lambda i: -splits[i][0])[: leaves - 1 - len(picked)]
        fresh = [i for i in first if shape.feature[i] < 0]
        if not fresh:
            break
        wanted = []
        for node in fresh:
            j, k = splits[node][1]
            shape.feature[node], shape.cut[node] = j, k
            shape.left[node], shape.right[node] = len(shape.feature), len(shape.feature) + 1
            for x, v in ((shape.feature, -1), (shape.cut, 0), (shape.left, 0), (shape.right, 0), (shape.value, 0.0)):
                x += [v, v]
            n = known[node][0, j]
            wanted.append(shape.left[node] if 2 * n[: k + 1].sum() <= n.sum() else shape.right[node])
        for node, small, of in zip(fresh, wanted, measure(shape, wanted), strict=True):
            other = shape.left[node] + shape.right[node] - small
            known[small], known[other] = of, known.pop(node) - of
            for i in (small, other):
                sums[i], splits[i] = known[i][1:, 0].sum(axis=1) / UNIT, best_split(known[i], signs, least, ridge)

    def value(node: int, low: float, high: float) -> float:
        return float(np.clip(-sums[node][0] / (sums[node][1] + ridge), low, high))

    tree, at = Tree([-1], [0], [0], [0], [value(0, -np.inf, np.inf)]), {0: (0, -np.inf, np.inf)}
    for node in picked:
        (own, low, high), (j, k), parts = at[node], splits[node][1], (shape.left[node], shape.right[node])
        values = [value(i, low, high) for i in parts]
        bounds = [(low, high), (low, high)]
        if signs[j]:
            mid = sum(values) / 2
            if signs[j] * (values[1] - values[0]) < 0:
                values = [mid, mid]
            bounds = [(low, mid), (mid, high)] if signs[j] > 0 else [(mid, high), (low, mid)]
        tree.feature[own], tree.cut[own] = j, k
        tree.left[own], tree.right[own] = len(tree.value), len(tree.value) + 1
        for i, v, (lo, hi) in zip(parts, values, bounds, strict=True):
            at[i] = len(tree.value), lo, hi
            tree.feature.append(-1), tree.cut.append(0), tree.left.append(0), tree.right.append(0), tree.value.append(v)
    tree.value = [rate * v for v in tree.value]
    return tree


def boost(run: Callable[..., tuple[int, np.ndarray]], model: Boosted, n: tuple[int, int], edges: list[np.ndarray], signs: list[int], rounds: int, leaves: int, rate: float, patience: int) -> Boosted:
    """model with its trees. run is histograms over all blocks, which hold the features that have edges; n counts training and validation rows."""
    used = [j for j, e in enumerate(edges) if len(e)]
    if not used:
        return model
    trees, own, size = [], np.array(signs)[used], (len(used), max(map(len, edges)) + 1)
    start = lambda: run(*size, model.base, trees, Tree([-1], [0], [0], [0], [0.0]), [0], n[1] > 0)
    loss, root = start()
    best, best_at = loss / UNIT / n[1] if n[1] else 0.0, 0
    for r in range(1, rounds + 1):
        trees.append(grow(lambda shape, wanted: run(*size, model.base, trees, shape, wanted)[1], root[0], own, leaves, rate))
        loss, root = start()
        now = loss / UNIT / (n[1] or n[0])
        if now < best - 1e-9:
            best, best_at = now, r
        elif r - best_at >= patience:
            break
    for t in trees[:best_at]:
        names = [used[j] if j >= 0 else j for j in t.feature]
        model.trees.append(Tree(names, [float(edges[j][k]) if j >= 0 else 0.0 for j, k in zip(names, t.cut, strict=True)], t.left, t.right, t.value))
    model.rounds = best_at
    return model


def constant(n: int, positives: float, names: list[str]) -> Boosted:
    share = float(np.clip(positives / n if n else 0.5, 1e-6, 1 - 1e-6))
    return Boosted(list(names), float(np.log(share / (1 - share))))


def binned(x: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """The bins (left: value <= edge) of the features that have edges."""
    most = max(map(len, edges), default=0)
    kept = [np.searchsorted(e, c.astype(np.float64), "left") for c, e in zip(x, edges, strict=True) if len(e)]
    return np.array(kept, np.uint8 if most < 256 else np.uint16 if most < 65536 else np.int32)


def fit_trees(x: np.ndarray, y: np.ndarray, vx: np.ndarray, vy: np.ndarray, names: list[str], signs: list[int], rounds: int = 500, leaves: int = 63, rate: float = 0.05, patience: int = 50, bins: int = 64) -> Boosted:
    """Binary log loss, stopped when the validation rows haven't gained for patience rounds; the best round counts. No rows or labels of one kind give a constant."""
    model = constant(len(y), y.sum() if len(y) else 0, names)
    if not 0 < (y.sum() if len(y) else 0) < len(y):
        return model
    edges = []
    for j in range(x.shape[1]):
        column = x[:, j].astype(np.float64)
        e = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
        edges.append(e[e < column.max()])
    run_id, blocks = uuid.uuid4().hex, []
    for part, labels, val in ((x, y, False), (vx, vy, True)):
        for i in range(0, len(labels), BLOCK):
            own = labels[i : i + BLOCK].astype(np.float32)
            blocks.append(Block((run_id, f"{val}{i}"), binned([part[i : i + BLOCK, j] for j in range(x.shape[1])], edges), own, np.full(len(own), val)))
    model = boost(lambda *a: histograms(blocks, *a), model, (len(y), len(vy)), edges, signs, rounds, leaves, rate, patience)
    for block in blocks:
        _MARGINS.pop(block.key, None)
    return model


def bounded(rows: DataFrame, limit: int = TRAIN_ROWS) -> pa.Table | None:
    """All rows as Arrow columns, not as Python objects; None if there are more than limit."""
    return rows.toArrow() if rows.count() <= limit else None


def arrays(got: pa.Table, columns: tuple[str, ...], role: str) -> tuple[np.ndarray, np.ndarray]:
    """Features (nulls as 0) and labels of the rows of a role, by their ids. Features stay single floats if all columns are."""
    got = got.filter(pc.equal(got["role"], role))
    order = pc.sort_indices(got, sort_keys=[(c, "ascending") for c in PAIR])
    x = np.empty((len(got), len(columns)), float_type(got.schema, columns), order="F")
    for j, c in enumerate(columns):
        x[:, j] = filled(got[c].take(order).to_numpy())
    return x, got["label"].take(order).to_numpy().astype(np.float64)


def float_type(schema: pa.Schema, columns: tuple[str, ...]) -> type:
    return np.float32 if all(schema.field(c).type == pa.float32() for c in columns) else np.float64


def filled(x: np.ndarray) -> np.ndarray:
    """x with 0 for what isn't a number, as in predict, and for the negative zero."""
    return np.where(np.isnan(x), x.dtype.type(0), x) + x.dtype.type(0) if x.dtype.kind == "f" else x


def matrices(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The batches with their features."""
    for batch in batches:
        kind = float_type(batch.schema, columns)
        yield batch, [filled(batch.column(c).to_numpy(zero_copy_only=False)).astype(kind) for c in columns]


def in_order(x: np.ndarray) -> np.ndarray:
    """Whole numbers with the order of floats."""
    u = x.view(f"u{x.itemsize}")
    top = u.dtype.type(1 << (8 * x.itemsize - 1))
    return np.where(u & top, ~u, u | top)


def from_order(u: np.ndarray) -> np.ndarray:
    top = u.dtype.type(1 << (8 * u.itemsize - 1))
    return np.where(u & top, u ^ top, ~u).view(f"f{u.itemsize}")


def at_ranks(rows: DataFrame, columns: tuple[str, ...], ranks: np.ndarray) -> np.ndarray:
    """The values (one row for each column) at these ranks, from 0, of each column among all rows: exact, digit by digit from counts of the leading bits of all values."""
    kinds = dict(rows.dtypes)
    size = 4 if all(kinds[c] == "float" for c in columns) else 8
    whole = np.dtype(f"u{size}").type
    heads, left = [np.zeros(len(ranks), whole) for _ in columns], [ranks.astype(np.int64) for _ in columns]
    shift = 8 * size
    while shift:
        wide = 16 if shift == 8 * size else 8
        shift -= wide
        seen = [np.unique(h) for h in heads]

        def count(batches: Iterator[pa.RecordBatch], seen=seen, wide=wide, shift=shift) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(len(s) << wide, np.int64) for s in seen]
            for _, x in matrices(batches, columns):
                for own, s, c in zip(sums, seen, x, strict=True):
                    u = in_order(c) >> whole(shift)
                    head = u >> whole(wide)
                    at = np.minimum(np.searchsorted(s, head), len(s) - 1)
                    ok = s[at] == head
                    own += np.bincount((at[ok].astype(np.int64) << wide) + (u[ok] & whole((1 << wide) - 1)).astype(np.int64), minlength=len(own))
            for j, own in enumerate(sums):
                if len(at := np.flatnonzero(own)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), j)), pa.array(at), pa.array(own[at])], ["j", "at", "n"])

        got = rows.select(*columns).mapInArrow(count, "j long, at long, n long").groupBy("j", "at").agg(F.sum("n").alias("n")).toArrow()
        got = {c: got[c].to_numpy() for c in got.column_names}
        for j, s in enumerate(seen):
            own = got["j"] == j
            full = np.zeros(len(s) << wide, np.int64)
            full[got["at"][own]] = got["n"][own]
            full = full.reshape(len(s), -1).cumsum(axis=1)
            for i, which in enumerate(np.searchsorted(s, heads[j])):
                digit = int(np.searchsorted(full[which], left[j][i], "right"))
                left[j][i] -= full[which][digit - 1] if digit else 0
                heads[j][i] = (int(heads[j][i]) << wide) + digit
    return np.array([from_order(h) for h in heads]).astype(np.float64)


def edges_of(rows: DataFrame, columns: tuple[str, ...], n: int, bins: int) -> list[np.ndarray]:
    """The edges that fit_trees has for n rows: quantiles under the largest value."""
    where = np.linspace(0, 1, bins + 1)[1:-1] * (n - 1)
    low = np.floor(where).astype(np.int64)
    ranks = np.unique([*low, *np.minimum(low + 1, n - 1), n - 1])
    out = []
    for values in at_ranks(rows, columns, ranks):
        v = dict(zip(ranks.tolist(), values.tolist(), strict=True))
        e = np.unique([np.quantile([v[i], v[min(i + 1, n - 1)]], w - i) for i, w in zip(low.tolist(), where.tolist(), strict=True)])
        out.append(e[e < v[n - 1]])
    return out


def fit_spread(rows: DataFrame, columns: tuple[str, ...], signs: list[int], rounds: int = 500, leaves: int = 63, rate: float = 0.05, patience: int = 50, bins: int = 64) -> Boosted:
    """fit_trees, with the same model, of rows (columns, label, role) that stay on the executors: as blocks of bins on their disks, of which each step adds up histograms."""
    n, positives, checked = rows.agg(F.count_if(F.col("role") == "train"), F.sum(F.when(F.col("role") == "train", F.col("label"))), F.count_if(F.col("role") == "val")).first()
    model = constant(n, positives or 0, columns)
    if not 0 < (positives or 0) < n:
        return model
    sc = rows.sparkSession.sparkContext
    rows = rows.select(*columns, "label", "role").coalesce(2 * sc.defaultParallelism)
    edges, run_id = edges_of(rows.where("role = 'train'"), columns, n, bins), uuid.uuid4().hex

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps((np.concatenate([b for b, _, _ in held], axis=1), *(np.concatenate([x[i] for x in held]) for i in (1, 2))))], pa.binary())], ["block"])

        for batch, x in matrices(batches, columns):
            held.append((binned(x, edges), batch.column("label").to_numpy(zero_copy_only=False).astype(np.float32), pc.equal(batch.column("role"), "val").to_numpy(zero_copy_only=False)))
            if sum(len(y) for _, y, _ in held) >= BLOCK:
                yield packed()
                held.clear()
        if held:
            yield packed()

    stored = rows.mapInArrow(blocks, "block binary").rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.DISK_ONLY)
    opened = lambda found: (Block((run_id, hashlib.sha256(b).hexdigest()), *pickle.loads(b)) for b in found)
    try:
        return boost(lambda *a: stored.mapPartitions(lambda found: [histograms(opened(found), *a)]).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1])), model, (n, checked), edges, signs, rounds, leaves, rate, patience)
    finally:
        stored.unpersist()


def train(rows: DataFrame, limit: int = TRAIN_ROWS, columns: tuple[str, ...] = features.COLUMNS, signs: list[int] | None = None, **more) -> Boosted:
    """The model of all rows (ids, columns, label, role): train fits, val stops. More than limit rows stay on the executors."""
    signs = [s for _, s in features.SPEC] if signs is None else signs
    rows = rows.where("role in ('train', 'val')").select(*PAIR, *columns, "label", "role")
    if (got := bounded(rows, limit)) is None:
        return fit_spread(rows, columns, signs, **more)
    parts = [*arrays(got, columns, "train"), *arrays(got, columns, "val")]
    del got
    return fit_trees(*parts, list(columns), signs, **more)


def predict(rows: DataFrame, model: Boosted) -> DataFrame:
    """ids and raw, the model's probability, of each row; columns that the model needs but rows lack are refused."""
    if missing := [c for c in model.names if c not in rows.columns]:
        raise ValueError(f"rows have no {missing[:5]}")
    shared = rows.sparkSession.sparkContext.broadcast(model.dumps())

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Boosted.loads(shared.value)
        for batch in batches:
            yield batch[list(PAIR)].assign(raw=sigmoid(own.raw(batch[own.names].fillna(0.0).to_numpy())))

    return rows.select(*PAIR, *model.names).mapInPandas(work, "source1_entity_id string, candidate_entity_id string, raw double")


def isotonic(rows: DataFrame, score: str = "raw", label: str = "label"):
    """The calibration of rows: rising, straight between its points, constant beyond its ends. Rows without a score or label are passed over."""
    from pyspark.ml.functions import array_to_vector

    data = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(array_to_vector(F.array(F.col(score).cast("double"))).alias("features"), F.col(label).cast("double").alias("label"))
    fitted = IsotonicRegression(featuresCol="features", labelCol="label").fit(data)
    return np.array(fitted.boundaries), np.array(fitted.predictions)


def calibrated(rows: DataFrame, fitted, score: str = "raw", name: str = "prob") -> DataFrame:
    """rows with the calibrated probability of their score."""
    at, to = fitted

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(np.interp(s.to_numpy(float), at, to))

    return rows.withColumn(name, run(F.col(score).cast("double")).cast("float"))


def cross_fitted(rows: DataFrame) -> DataFrame:
    """rows (raw, label, bucket) with prob from the calibration of the other half of the entities, by odd and even bucket."""
    halves = [rows.where(F.col("bucket") % 2 == i) for i in (0, 1)]
    return calibrated(halves[0], isotonic(halves[1])).unionByName(calibrated(halves[1], isotonic(halves[0])))


def place_in_order(rows: DataFrame, score: str, ties: list[str]) -> DataFrame:
    """rows with place, from 0, by score and then ties, and the number of all rows. Places are counted by distinct score first, so no task holds all rows."""
    counts = rows.groupBy(F.col(score).alias("__s")).agg(F.count("*").alias("__n"))
    # One row for each distinct score of six places.
    before = counts.withColumn("__before", F.sum("__n").over(Window.orderBy("__s").rowsBetween(Window.unboundedPreceding, -1))).withColumn("total", F.sum("__n").over(Window.partitionBy()))
    out = rows.join(before.select("__s", "__before", "total"), F.col(score) == F.col("__s"))
    nth = F.row_number().over(Window.partitionBy("__s").orderBy(*ties)) - 1
    return out.withColumn("place", F.coalesce("__before", F.lit(0)) + nth).drop("__s", "__before")


def equal_count_bins(rows: DataFrame, score: str = "prob", label: str = "label", bins: int = 10, ties: list[str] = list(PAIR)) -> DataFrame:
    """n, mean score and rate of label in bins of equal counts, the larger bins first. Scores count to six places; ties go by ties."""
    rows = place_in_order(rows.withColumn(score, F.round(F.col(score).cast("double"), 6)), score, ties)
    size, more = F.floor(F.col("total") / bins), F.col("total") % bins
    # As ntile deals: the first more bins hold one row more.
    first = F.when(F.col("place") < more * (size + 1), F.floor(F.col("place") / (size + 1))).otherwise(more + F.floor((F.col("place") - more * (size + 1)) / F.greatest(size, F.lit(1))))
    return rows.groupBy(first.cast("int").alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_prob"), F.avg(label).alias("rate"))


def quality(rows: DataFrame, score: str = "prob", label: str = "label", ties: list[str] = list(PAIR)) -> DataFrame:
    """One row: n, prevalence, negatives for each positive, mean score, Brier score, expected calibration error over ten equal-count bins, and area under the curve (ties half)."""
    rows = rows.withColumn(score, F.round(F.col(score).cast("double"), 6))
    error = equal_count_bins(rows, score, label, ties=ties).agg((F.sum(F.col("n") * F.abs(F.col("mean_prob") - F.col("rate"))) / F.sum("n")).alias("ece"))
    by = rows.groupBy(F.col(score).alias("s")).agg(F.sum(label).alias("p"), F.count("*").alias("n"))
    lower = F.coalesce(F.sum(F.col("n") - F.col("p")).over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    area = by.withColumn("lower", lower).agg(F.try_divide(F.sum(F.col("p") * (F.col("lower") + (F.col("n") - F.col("p")) / 2)), F.sum("p") * F.sum(F.col("n") - F.col("p"))).alias("auc"))
    y = F.col(label)
    whole = rows.agg(F.count("*").alias("n"), F.avg(y).alias("prevalence"), F.try_divide(F.sum(1 - y), F.sum(y)).alias("neg_per_pos"), F.avg(score).alias("mean_prob"), F.avg((F.col(score) - y) * (F.col(score) - y)).alias("brier"))
    return whole.join(error, how="cross").join(area, how="cross").select("n", *[F.round(c, 6).alias(c) for c in ("prevalence", "neg_per_pos", "mean_prob", "brier", "ece", "auc")])


def reliability_table(rows: DataFrame, score: str = "prob", label: str = "label", low: float = 0.0, high: float = 1.0, bins: int = 10) -> DataFrame:
    """(lo, hi, n, mean_pred, observed) of bins of equal width from low to high, the upper end closed; scores outside and empty bins are left out."""
    width = (high - low) / bins
    rows = rows.where(F.col(score).between(low, high))
    at = F.least(F.floor((F.col(score) - low) / width + 1e-9), F.lit(bins - 1))
    out = rows.groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.round(F.avg(score), 6).alias("mean_pred"), F.round(F.avg(label), 6).alias("observed"))
    return out.select(F.round(low + F.col("b") * width, 6).alias("lo"), F.round(low + (F.col("b") + 1) * width, 6).alias("hi"), "n", "mean_pred", "observed")


def transfer(rows: DataFrame, learn: Column, test: Column, **more) -> DataFrame:
    """quality of a model that learns where learn holds, on other entities (bucket mod 5 is 0) where test holds."""
    held = bucket_of(F.col(PAIR[0])) % 5 == 0
    part = rows.where(learn & ~held)
    model = train(part.withColumn("role", F.when(bucket_of(F.col(PAIR[0]), 7) < 20, "val").otherwise("train")), **more)
    tested = rows.where(test & held)
    return quality(predict(tested, model).join(tested.select(*PAIR, "label"), list(PAIR)), "raw")


def score_split(rows: DataFrame, model: Boosted, fitted, only: DataFrame | None = None) -> DataFrame:
    """ids and prob of all rows, or of the entities of only: predicted, then calibrated. No result depends on how rows are cut."""
    if only is not None:
        rows = rows.join(only.select(F.col(only.columns[0]).alias(PAIR[0])).distinct(), PAIR[0], "left_semi")
    return calibrated(predict(rows, model), fitted).select(*PAIR, "prob")
