"""Gradient-boosted trees as Spark jobs over a binned table (F13-F15), many models in one run.

Second-order boosting (Chen & Guestrin, 2016): histogram splits, L2 leaf penalty, minimum child weight, row and column
subsampling per tree, early stopping by patience on validation rows inside the loop.

How it runs.  ``bin_table`` writes the rows once: a key, the labels, and for each *fold* (a choice of train and validation
rows) the bin of every feature, cut at quantiles of that fold's train rows, and the row's role.  Growing one level of one
tree is one pass over that table: every task rebuilds the margins from the last written margin column and the trees grown
since, and sends the non-empty histogram cells (gradient and hessian sums) of its rows; the best split of each node follows
from their sums.  All models of a run (gate and experts of a mixture, candidates x folds of a search) share the pass, so
the number of jobs does not depend on the number of models.  Every ``KEEP_ROUNDS`` rounds the margins are written as a
new table, which bounds both the work per pass and what a lost executor has to redo; fitting can go on from there.

Histograms are bounded by the model (nodes x columns x bins), not by the rows.  While those of all tasks together stay under
``GATHER_BYTES`` the driver adds them up; beyond that a shuffle by (model, node) does, and only splits reach the driver.
A table of one partition (``PART_ROWS`` rows) needs no sums across tasks: there the tasks share out the models instead of the
rows, and each grows its models by the same steps.

Missing values take the fold's train median.  Rows without a label take part neither in training nor in validation.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplet.session import materialize

TRAIN, VALID = 1, 2
KEEP_ROUNDS = 25
GATHER_BYTES = 64 << 20
PENDING_BYTES = 8 << 20
MAX_BINS = 64
PART_ROWS = 100_000  # rows a partition: some MB
_CELL = np.dtype([("at", "<i4"), ("g", "<f8"), ("h", "<f8")])


@dataclass(frozen=True)
class Spec:
    """One model of a run.  ``label`` indexes the label columns, ``fold`` the folds of the binned table."""
    task: str = "regression"
    label: int = 0
    fold: int = 0
    rounds: int = 1000
    patience: int | None = 30
    rate: float = 0.05
    depth: int = 4
    min_child: float = 5.0
    reg_lambda: float = 1.0
    rows: float = 0.85
    columns: float = 0.85
    seed: int = 42
    pos_weight: float = 1.0  # weight of the train rows of class 1 (G4)


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1, 2i + 2); feature -1 is a leaf."""
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = (1 << (depth + 1)) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.zeros(n))

    def trimmed(self) -> Tree:
        n = int(np.flatnonzero(self.cover).max(initial=0)) + 1
        return Tree(self.feature[:n], self.bin[:n], self.value[:n], self.cover[:n], self.gain[:n])

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """Deepest grown node of each row of ``bins`` (rows x features)."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = self.feature[at]
            live = f >= 0
            if not live.any():
                return at
            r = rows[live]
            at[r] = 2 * at[r] + 1 + (bins[r, f[live]] > self.bin[at[r]])
        return at


@dataclass
class BoostedModel:
    """A fitted model on raw features: ``x <= threshold`` goes left."""
    features: list[str]
    medians: np.ndarray
    cuts: list[np.ndarray]
    task: str
    base: float
    trees: list[Tree]
    curve: list[float] = field(default_factory=list)

    def thresholds(self, tree: Tree) -> np.ndarray:
        return np.array([self.cuts[f][b] if f >= 0 else np.nan for f, b in zip(tree.feature.tolist(), tree.bin.tolist())])

    def matrix(self, pdf_columns: list) -> np.ndarray:
        x = np.column_stack([np.asarray(c, float) for c in pdf_columns])
        return np.where(np.isnan(x), self.medians, x)

    def bins_of(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)])

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins, out = self.bins_of(x), np.full(len(x), self.base)
        for t in self.trees:
            out += t.value[t.nodes_of(bins)]
        return out

    def predict_array(self, x: np.ndarray) -> np.ndarray:
        m = self.margin(x)
        return m if self.task == "regression" else 1 / (1 + np.exp(-m))

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with a column: the value, or the probability of class 1.  Vectorised per Arrow batch."""
        score = F.pandas_udf(lambda *c: pd.Series(self.predict_array(self.matrix(c))), "double")
        return df.withColumn(name, score(*[F.col(c).cast("double") for c in self.features]))

    def transform(self, df: DataFrame) -> DataFrame:
        """The columns a Spark ML model would add: ``prediction``, and ``probability`` of class 1 for a classifier."""
        if self.task == "regression":
            return self.predict(df)
        return self.predict(df, "score").withColumn("prediction", (F.col("score") > 0.5).cast("double"))

    def nodes(self, spark) -> DataFrame:
        """The node table (tree, node, feature, threshold, gain, cover, value); bounded by rounds x 2^depth."""
        rows = []
        for i, t in enumerate(self.trees):
            reach, thr = [0], self.thresholds(t)
            for n in reach:
                f = int(t.feature[n])
                rows.append((i, n, self.features[f] if f >= 0 else None, float(thr[n]) if f >= 0 else None,
                             float(t.gain[n]) if f >= 0 else None, float(t.cover[n]), float(t.value[n]) if f < 0 else None))
                if f >= 0:
                    reach += [2 * n + 1, 2 * n + 2]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, gain double, cover double, value double")


@dataclass
class BinTable:
    """The written rows and what binned them."""
    rows: DataFrame
    features: list[str]
    medians: list[np.ndarray]
    cuts: list[list[np.ndarray]]
    parts: int
    n_rows: int
    n_labels: int


def bin_table(df: DataFrame, features: list[str], labels: list[str], folds: list, keys: list[str], max_bins: int = MAX_BINS,
              part_rows: int = PART_ROWS) -> BinTable:
    """Write the binned rows.  ``folds``: a pair of boolean columns (train, validation) each."""
    features = list(features)
    roles = [F.when(F.coalesce(tr, F.lit(False)), TRAIN).when(F.coalesce(va, F.lit(False)), VALID).otherwise(0).cast("byte") for tr, va in folds]
    base = df.select(F.xxhash64(*keys).alias("key"), F.array(*[F.col(y).cast("double") for y in labels]).alias("y"),
                     F.array(*roles).alias("role"), *[F.col(c).cast("double").alias(c) for c in features])
    shares = [i / max_bins for i in range(1, max_bins)]
    cuts, medians = [], []
    for k in range(len(folds)):
        row = base.where(F.col("role")[k] == TRAIN).agg(
            *[F.percentile_approx(c, [0.5, *shares], 10_000).alias(c) for c in features]).first()
        got = [row[c] or [0.0] for c in features]
        medians.append(np.array([g[0] for g in got]))
        cuts.append([np.unique(np.array(g[1:])) for g in got])
    n = base.count()
    parts, width, n_folds = max(1, -(-n // part_rows)), len(features), len(folds)

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(3 + j).to_numpy(zero_copy_only=False).astype(float) for j in range(width)])
            packed = []
            for k in range(n_folds):
                z = np.where(np.isnan(x), medians[k], x)
                packed.append(np.column_stack([np.searchsorted(cuts[k][j], z[:, j], side="left") for j in range(width)]).astype(np.uint8))
            whole = np.concatenate(packed, axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([r.tobytes() for r in whole], pa.binary())],
                                             ["key", "y", "role", "bins"])

    spread = base.repartition(parts, "key")
    rows = spread.mapInArrow(run, "key long, y array<double>, role array<byte>, bins binary").withColumn("margin", F.lit(None).cast("binary"))
    return BinTable(materialize(rows, "boost-rows"), features, medians, cuts, parts, n, len(labels))


def _uniform(key: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Draws in [0, 1) from the row key, the same in every pass."""
    h = key.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


class _Batch:
    """One Arrow batch of the table as arrays."""

    def __init__(self, b: pa.RecordBatch, width: int, labels: int, folds: int, models: int):
        n = len(b)
        self.key = b.column(0).to_numpy(zero_copy_only=False)
        self.y = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, labels)
        self.role = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, folds)
        self.bins = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(n, folds, width)
        kept = b.column(4)
        self.kept = None if kept.null_count else np.frombuffer(b"".join(kept.to_pylist()), np.float64).reshape(n, models)


def _gradients(s: Spec, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if s.task == "regression":
        return margin - y, np.ones(len(y))
    p, w = 1 / (1 + np.exp(-margin)), np.where(y > 0.5, s.pos_weight, 1.0)
    return w * (p - y), np.maximum(w * p * (1 - p), 1e-16)


def _loss(task: str, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    return (margin - y) ** 2 if task == "regression" else np.logaddexp(0, margin) - y * margin


def _leaf(g: float, h: float, spec: Spec) -> float:
    return -spec.rate * g / (h + spec.reg_lambda)


def split_nodes(g: np.ndarray, h: np.ndarray, spec: Spec):
    """Best split of every node from its histograms (nodes, columns, bins): (column, bin, gain, g, h, g_left, h_left) as
    arrays; column -1 where no split is worth it."""
    nodes, width, bins = g.shape
    all_g, all_h = g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)
    if bins < 2:
        none = np.zeros(nodes)
        return np.full(nodes, -1), np.zeros(nodes, int), none, all_g, all_h, none, none
    gl, hl = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    gr, hr = all_g[:, None, None] - gl, all_h[:, None, None] - hl
    lam = spec.reg_lambda
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (gl * gl / (hl + lam) + gr * gr / (hr + lam) - (all_g * all_g / (all_h + lam))[:, None, None])
    gain[~((hl >= spec.min_child) & (hr >= spec.min_child) & (hl > 0) & (hr > 0))] = -np.inf
    best = gain.reshape(nodes, -1).argmax(axis=1)
    at = np.arange(nodes), best // (bins - 1), best % (bins - 1)
    column = np.where(gain[at] > 1e-12, at[1], -1)
    return column, at[2], gain[at], all_g, all_h, gl[at], hl[at]


def best_split(cells: np.ndarray, columns: np.ndarray, bins: int, spec: Spec) -> tuple:
    """(feature, bin, gain, g, h, g_left, h_left) of one node from the cells of all tasks; feature -1: no split."""
    size = len(columns) * bins
    g, h = (np.bincount(cells["at"], cells[c], size).reshape(1, len(columns), bins) for c in ("g", "h"))
    column, *rest = (x[0] for x in split_nodes(g, h, spec))
    return (int(columns[column]) if column >= 0 else -1, int(rest[0]), *map(float, rest[1:]))


def sampled_columns(spec: Spec, step: int, width: int) -> np.ndarray:
    n = max(1, int(round(spec.columns * width)))
    return np.sort(np.random.default_rng((spec.seed, step)).permutation(width)[:n])


def place_split(tree: Tree, spec: Spec, node: int, feature: int, cut: int, gain: float, g: float, h: float, gl: float, hl: float) -> None:
    """Write a node's value and, if it splits, its children's."""
    tree.cover[node], tree.value[node] = h, _leaf(g, h, spec)
    if feature < 0:
        return
    tree.feature[node], tree.bin[node], tree.gain[node] = feature, cut, gain
    for child, cg, ch in ((2 * node + 1, gl, hl), (2 * node + 2, g - gl, h - hl)):
        tree.cover[child], tree.value[child] = ch, _leaf(cg, ch, spec)


def grow_alone(b: _Batch, s: Spec, base: float, bins: int) -> tuple[list[Tree], list[float]]:
    """All rounds of one model over rows that one task holds: the same steps as a distributed run, with no sums to fetch."""
    x, y, role = b.bins[:, s.fold], b.y[:, s.label], b.role[:, s.fold]
    train, valid = (role == TRAIN) & ~np.isnan(y), (role == VALID) & ~np.isnan(y)
    margin, trees, curve = np.full(len(y), base), [], []
    while len(trees) < s.rounds and not stopped(curve, s.patience):
        step = len(trees)
        cols = sampled_columns(s, step, x.shape[1])
        rows = np.flatnonzero(train & (_uniform(b.key, s.seed, step) < s.rows) if s.rows < 1 else train)
        g, h = _gradients(s, y[rows], margin[rows])
        tree, at, xs = Tree.empty(s.depth), np.zeros(len(rows), np.int64), x[rows].astype(np.int64)
        for depth in range(s.depth):
            here = np.flatnonzero(at >= (1 << depth) - 1)
            if not len(here):
                break
            nodes, slot = np.unique(at[here], return_inverse=True)
            cell = ((slot[:, None] * len(cols) + np.arange(len(cols))) * bins + xs[here][:, cols]).ravel()
            shape, size = (len(nodes), len(cols), bins), len(nodes) * len(cols) * bins
            got = split_nodes(*(np.bincount(cell, np.repeat(v[here], len(cols)), size).reshape(shape) for v in (g, h)), s)
            for node, column, *rest in zip(nodes.tolist(), *(v.tolist() for v in got)):
                place_split(tree, s, node, int(cols[column]) if column >= 0 else -1, *rest)
            f = tree.feature[at[here]]
            go = here[f >= 0]
            at[go] = 2 * at[go] + 1 + (xs[go, f[f >= 0]] > tree.bin[at[go]])
        tree = tree.trimmed()
        trees.append(tree)
        margin += tree.value[tree.nodes_of(x)]
        loss = _loss(s.task, y[valid], margin[valid])
        curve.append(float(loss.sum()) / len(loss) if len(loss) else float("nan"))
    return trees, curve


class _Run:
    """State of a run on the driver: specs, grown trees, the tree under growth, validation curves."""

    def __init__(self, table: BinTable, specs: list[Spec]):
        self.table, self.specs = table, specs
        self.bins = 1 + max((len(c) for cuts in table.cuts for c in cuts), default=0)
        self.rows = table.rows
        self.trees: list[list[Tree]] = [[] for _ in specs]
        self.written = [0] * len(specs)  # trees that the written margins hold
        self.curve: list[list[float]] = [[] for _ in specs]
        self.live = list(range(len(specs)))
        self.base = self._bases()

    def _bases(self) -> list[float]:
        kinds = sorted({(s.label, s.fold, s.task) for s in self.specs})
        train = lambda s: (F.col("role")[s[1]] == TRAIN) & F.col("y")[s[0]].isNotNull()
        row = self.rows.agg(*[F.avg(F.when(train(s), F.col("y")[s[0]])).alias(f"m{i}") for i, s in enumerate(kinds)]).first()
        means = {s: row[f"m{i}"] or 0.0 for i, s in enumerate(kinds)}

        def base(s: Spec) -> float:
            m = means[(s.label, s.fold, s.task)]
            if s.task == "regression":
                return m
            m = min(max(m, 1e-6), 1 - 1e-6)
            return float(np.log(m / (1 - m)))
        return [base(s) for s in self.specs]

    def columns(self, m: int, step: int) -> np.ndarray:
        return sampled_columns(self.specs[m], step, len(self.table.features))

    def _margins(self):
        """Function that gives a model's margins of a batch, from the written column and the trees grown since."""
        base, specs, trees = self.base, self.specs, [t[w:] for t, w in zip(self.trees, self.written)]

        def margin(batch: _Batch, m: int) -> np.ndarray:
            out = np.full(len(batch.key), base[m]) if batch.kept is None else batch.kept[:, m].copy()
            bins = batch.bins[:, specs[m].fold]
            for t in trees[m]:
                out += t.value[t.nodes_of(bins)]
            return out

        return margin

    def _reader(self):
        width, labels, folds, models = len(self.table.features), self.table.n_labels, len(self.table.cuts), len(self.specs)
        return lambda b: _Batch(b, width, labels, folds, models)

    def pending_bytes(self) -> int:
        """Size of the trees that the written margins do not hold yet: every pass carries them."""
        return sum(32 * len(t.feature) for trees, w in zip(self.trees, self.written) for t in trees[w:])

    def losses(self) -> None:
        """Append the mean validation loss of every live model."""
        margin, read, live, specs = self._margins(), self._reader(), list(self.live), self.specs

        def run(batches):
            total, n = np.zeros(len(live)), np.zeros(len(live))
            for b in map(read, batches):
                for i, m in enumerate(live):
                    loss, count = _valid_loss(b, m, specs[m], margin)
                    total[i] += loss
                    n[i] += count
            yield pa.RecordBatch.from_arrays([pa.array(live, pa.int32()), pa.array(total), pa.array(n)], ["m", "loss", "n"])

        got = self.rows.mapInArrow(run, "m int, loss double, n double").groupBy("m").agg(F.sum("loss"), F.sum("n")).collect()
        for m, loss, n in got:
            self.curve[m].append(loss / n if n else float("nan"))

    def level(self, step: int, depth: int, growing: dict[int, Tree], with_loss: bool) -> dict[int, list[tuple]]:
        """Best splits of the nodes at ``depth`` of the growing trees: one pass over the rows."""
        margin, read, specs, bins = self._margins(), self._reader(), self.specs, self.bins
        cols = {m: self.columns(m, step) for m in growing}
        first = (1 << depth) - 1

        def run(batches):
            sums: dict[int, np.ndarray] = {}
            losses = {m: np.zeros(2) for m in growing}
            for b in map(read, batches):
                for m, tree in growing.items():
                    s = specs[m]
                    out = margin(b, m)
                    if with_loss:
                        losses[m] += _valid_loss(b, m, s, lambda *_, out=out: out)
                    y = b.y[:, s.label]
                    use = (b.role[:, s.fold] == TRAIN) & ~np.isnan(y)
                    if s.rows < 1:
                        use &= _uniform(b.key, s.seed, step) < s.rows
                    x = b.bins[use][:, s.fold]
                    at = tree.nodes_of(x)
                    here = at >= first
                    if not here.any():
                        continue
                    g, h = _gradients(s, y[use][here], out[use][here])
                    cell = (((at[here] - first)[:, None] * len(cols[m]) + np.arange(len(cols[m]))) * bins + x[here][:, cols[m]]).ravel()
                    used, cell = np.unique(cell, return_inverse=True)
                    part = np.zeros(len(used), _CELL)
                    part["at"] = used
                    part["g"] = np.bincount(cell, np.repeat(g, len(cols[m])))
                    part["h"] = np.bincount(cell, np.repeat(h, len(cols[m])))
                    sums[m] = part if m not in sums else _merge(np.concatenate((sums[m], part)))
            out_m, out_node, out_cells = [], [], []
            for m, part in sums.items():
                node, size = part["at"] // (len(cols[m]) * bins), len(cols[m]) * bins
                for k in np.unique(node).tolist():
                    mine = part[node == k].copy()
                    mine["at"] -= k * size
                    out_m.append(m)
                    out_node.append(first + k)
                    out_cells.append(mine.tobytes())
            if with_loss:
                for m, v in losses.items():
                    out_m.append(m)
                    out_node.append(-1)
                    out_cells.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_m, pa.int32()), pa.array(out_node, pa.int32()), pa.array(out_cells, pa.binary())], ["m", "node", "cells"])

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            m, node = int(pdf["m"].iloc[0]), int(pdf["node"].iloc[0])
            if node < 0:
                loss, n = np.sum([np.frombuffer(c) for c in pdf["cells"]], axis=0).tolist()
                return pd.DataFrame([(m, node, 0, 0, loss, n, 0.0, 0.0, 0.0)], columns=_SPLIT)
            cells = np.concatenate([np.frombuffer(c, _CELL) for c in pdf["cells"]])
            return pd.DataFrame([(m, node, *best_split(cells, cols[m], bins, specs[m]))], columns=_SPLIT)

        sent = self.rows.mapInArrow(run, "m int, node int, cells binary")
        most = sum(min(self.table.n_rows, self.table.parts * (1 << depth) * bins) * len(c) for c in cols.values()) * _CELL.itemsize
        if most <= GATHER_BYTES:
            got = sent.toPandas()
            splits = pd.concat([choose(p) for _, p in got.groupby(["m", "node"])]) if len(got) else pd.DataFrame(columns=_SPLIT)
        else:
            splits = sent.groupBy("m", "node").applyInPandas(choose, _SPLIT_TYPE).toPandas()
        out: dict[int, list[tuple]] = {m: [] for m in growing}
        for r in splits.itertuples(index=False):
            out[int(r.m)].append((int(r.node), int(r.feature), int(r.bin), *map(float, (r.gain, r.g, r.h, r.gl, r.hl))))
        return out

    def grow_models_apart(self) -> None:
        """One task can hold the rows, so tasks share out the models: each gets the rows and grows its models to the end."""
        read, specs, base, bins = self._reader(), self.specs, self.base, self.bins
        groups = min(len(specs), max(1, self.rows.sparkSession.sparkContext.defaultParallelism))

        def run(key, rows):
            b = read(rows.sort_by("key").combine_chunks().to_batches()[0])
            out = []
            for m in range(key[0].as_py(), len(specs), groups):
                trees, curve = grow_alone(b, specs[m], base[m], bins)
                out += [(m, i, t.feature, t.bin, t.value, t.cover, t.gain, c) for i, (t, c) in enumerate(zip(trees, curve))]
            columns = list(zip(*out)) if out else [[]] * 8
            return pa.table({f.name: pa.array(list(v), f.type) for f, v in zip(_TREE_ROWS, columns)})

        dealt = self.rows.drop("margin").withColumns({"margin": F.lit(None).cast("binary"), "g": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
        got = dealt.groupBy("g").applyInArrow(run, _TREE_TYPE).toPandas().sort_values(["m", "tree"])
        for r in got.itertuples(index=False):
            self.trees[r.m].append(Tree(np.asarray(r.feature, np.int32), np.asarray(r.bin, np.int32), *(np.asarray(v, float) for v in (r.value, r.cover, r.gain))))
            self.curve[r.m].append(r.loss)
        self.live = []

    def write_margins(self) -> None:
        margin, read, models = self._margins(), self._reader(), len(self.specs)

        def run(batches):
            for b in batches:
                got = read(b)
                whole = np.column_stack([margin(got, m) for m in range(models)])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in range(4)), pa.array([r.tobytes() for r in whole], pa.binary())],
                                                 ["key", "y", "role", "bins", "margin"])

        self.rows = materialize(self.rows.mapInArrow(run, self.rows.schema), "boost-rows")
        self.written = [len(t) for t in self.trees]


_TREE_ROWS = pa.schema([("m", pa.int32()), ("tree", pa.int32()), ("feature", pa.list_(pa.int32())), ("bin", pa.list_(pa.int32())),
                        ("value", pa.list_(pa.float64())), ("cover", pa.list_(pa.float64())), ("gain", pa.list_(pa.float64())), ("loss", pa.float64())])
_TREE_TYPE = "m int, tree int, feature array<int>, bin array<int>, value array<double>, cover array<double>, gain array<double>, loss double"
_SPLIT = ["m", "node", "feature", "bin", "gain", "g", "h", "gl", "hl"]
_SPLIT_TYPE = "m int, node int, feature int, bin int, gain double, g double, h double, gl double, hl double"


def _valid_loss(b: _Batch, m: int, s: Spec, margin) -> np.ndarray:
    y = b.y[:, s.label]
    va = (b.role[:, s.fold] == VALID) & ~np.isnan(y)
    return np.array([float(_loss(s.task, y[va], margin(b, m)[va]).sum()), float(va.sum())])


def _merge(cells: np.ndarray) -> np.ndarray:
    used, at = np.unique(cells["at"], return_inverse=True)
    out = np.zeros(len(used), _CELL)
    out["at"], out["g"], out["h"] = used, np.bincount(at, cells["g"]), np.bincount(at, cells["h"])
    return out


def early_stop_rounds(curve: list[float], patience: int = 30) -> int:
    """rounds to keep = best prefix before ``patience`` non-improving rounds."""
    best, best_i = float("inf"), 0
    for i, v in enumerate(curve):
        if v < best:
            best, best_i = v, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def stopped(curve: list[float], patience: int | None) -> bool:
    """Whether ``patience`` rounds have passed since the best one."""
    return patience is not None and len(curve) > patience and not np.isnan(curve).any() and int(np.argmin(curve)) < len(curve) - patience


def fit_boosted_many(table: BinTable, specs: list[Spec], keep_rounds: int = KEEP_ROUNDS) -> list[BoostedModel]:
    """All models at once.  A model ends at its ``rounds``, or when ``patience`` rounds brought no better validation loss;
    the trees after its best round are dropped.  ``curve`` holds the validation loss of every grown round."""
    run = _Run(table, specs)
    if table.parts == 1:
        run.grow_models_apart()
    step = 0
    while run.live:
        growing = {m: Tree.empty(specs[m].depth) for m in run.live}
        deepest = max(specs[m].depth for m in growing)
        for depth in range(deepest):
            open_ = {m: t for m, t in growing.items() if depth < specs[m].depth and (depth == 0 or (t.feature[(1 << depth >> 1) - 1:(1 << depth) - 1] >= 0).any())}
            if not open_ and depth:
                break
            splits = run.level(step, depth, open_, with_loss=depth == 0 and step > 0)
            for m, nodes in splits.items():
                t, s = growing[m], specs[m]
                for node, f, b, gain, g, h, gl, hl in nodes:
                    if node < 0:
                        run.curve[m].append(gain / g if g else float("nan"))
                        continue
                    place_split(t, s, node, f, b, gain, g, h, gl, hl)
        # the pass of this round's first level showed the loss of the rounds before: a model past its patience ends here
        run.live = [m for m in run.live if not stopped(run.curve[m], specs[m].patience)]
        for m in run.live:
            run.trees[m].append(growing[m].trimmed())
        step += 1
        done = [m for m in run.live if len(run.trees[m]) >= specs[m].rounds]
        if done:
            live, run.live = run.live, done
            run.losses()
            run.live = [m for m in live if m not in done]
        if run.live and (step % keep_rounds == 0 or run.pending_bytes() > PENDING_BYTES):
            run.write_margins()
    out = []
    for m, s in enumerate(specs):
        curve = run.curve[m]
        kept = len(run.trees[m]) if s.patience is None or np.isnan(curve).any() else early_stop_rounds(curve, s.patience)
        out.append(BoostedModel(table.features, table.medians[s.fold], table.cuts[s.fold], s.task, run.base[m], run.trees[m][:kept], curve))
    return out


def fit_boosted(panel: DataFrame, features: list[str], task: str, label: str, train, valid, keys=("symbol", "date"), **spec) -> BoostedModel:
    """One model; ``train`` and ``valid`` are boolean columns of ``panel``."""
    table = bin_table(panel, features, [label], [(train, valid)], list(keys))
    return fit_boosted_many(table, [replace(Spec(task=task), **spec)])[0]
