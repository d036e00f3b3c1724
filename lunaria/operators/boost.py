"""Gradient-boosted trees for several classes: histograms of gradients, early stopping, class weights.

Features are binned once by exact quantiles. A round grows one tree a class, level by level. For a level each
task adds up gradients and curvatures of its rows by (class, node, feature, bin); one aggregation sums these
up, and the driver, which gets as many numbers as there are such cells, picks the splits. Rows and their
scores lie in a table that each round writes anew. The loss over a part of the groups (subjects) that no
tree learns from is measured after each round, and training ends when it has not fallen for some rounds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LunariaError
from ..scratch import Kept
from . import select

ROWS = "x binary, y int, w double, held boolean, s binary"


@dataclass
class Tree:
    """Nodes of a complete binary tree, the children of i being 2 i + 1 and 2 i + 2: a feature (-1 in a leaf),
    the last bin that goes left, and a leaf's value."""

    feature: list[int]
    bin: list[int]
    value: list[float]

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        at, feature, last = np.zeros(len(x), np.int64), np.array(self.feature), np.array(self.bin)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            n = at[inner]
            at[inner] = 2 * n + 1 + (x[inner, feature[n]] > last[n])

    def values(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(x)]


@dataclass
class Booster:
    """classes and features in order, the features' bin edges, trees by round and class, and the losses of the
    training part and of the part held out (weighted means, by round); rounds is how many count."""

    classes: list
    features: list[str]
    edges: list[list[float]]
    trees: list[list[Tree]] = field(default_factory=list)
    losses: list[tuple[float, float]] = field(default_factory=list)
    rounds: int = 0

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.classes)))
        for one in self.trees[: self.rounds]:
            for k, tree in enumerate(one):
                out[:, k] += tree.values(x)
        return out

    def predicted(self, rows: DataFrame) -> DataFrame:
        """rows with probs (in order of classes) and guess. A null feature counts as NaN, which lies above all."""
        model, kind = self, rows.schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = softmax(model.scores(binned(_matrix(batch, model.features), model.edges)))
                listed = pa.ListArray.from_arrays(pa.array((np.arange(len(p) + 1) * p.shape[1]).astype(np.int32)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, listed, pa.array([model.classes[i] for i in p.argmax(1)])], [*batch.schema.names, "probs", "guess"])

        guess = "string" if isinstance(self.classes[0], str) else "long"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
        return rows.mapInArrow(run, f"{columns}, probs array<double>, guess {guess}")

    def save(self, spark: SparkSession, path: str) -> None:
        """As one JSON text in a new folder."""
        text = json.dumps(self.__dict__ | {"trees": [[t.__dict__ for t in one] for one in self.trees]})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        found = json.loads(spark.read.text(path).first().value)
        return cls(**found | {"trees": [[Tree(**t) for t in one] for one in found["trees"]]})


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    columns = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.float64) for c in names]
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))


def binned(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """The number of edges below each value; NaN is in the last bin."""
    return np.column_stack([np.where(np.isnan(v), len(e), np.searchsorted(e, v, "left")) for v, e in zip(x.T, edges, strict=True)]).astype(np.uint8)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def quantile_edges(rows: DataFrame, names: Sequence[str], bins: int) -> list[list[float]]:
    """For each feature its distinct quantiles at 1/bins, 2/bins, ...: exact, without a task that holds a feature."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(names)])).alias("e")).select("e.f", "e.value")
    q = select.quantiles(long.where(~F.isnan("value")), [k / bins for k in range(1, bins)], "value", ("f",))
    found = {r.f: [r[f"q{k}"] for k in range(bins - 1)] for r in q.collect()}  # a row a feature
    return [sorted(set(found.get(i, []))) for i in range(len(names))]


def _rows(features: DataFrame, names: Sequence[str], label: str, weight: str, held: str, classes: Sequence, edges: Sequence[Sequence[float]]) -> DataFrame:
    order = {c: i for i, c in enumerate(classes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, zeros = batch.num_rows, bytes(8 * len(classes))
            x = binned(_matrix(batch, names), edges)
            y = [order[v] for v in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array(y, pa.int32()), batch.column(len(names) + 1), batch.column(len(names) + 2), pa.array([zeros] * n, pa.binary())], ["x", "y", "w", "held", "s"])

    return features.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names], label, weight, held).mapInArrow(run, ROWS)


def _unpacked(batch: pa.RecordBatch, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = batch.num_rows
    x, s = (np.frombuffer(b"".join(batch.column(i).to_pylist()), kind).reshape(n, -1) for i, kind in ((0, np.uint8), (4, np.float64)))
    return x, batch.column(1).to_numpy(), batch.column(2).to_numpy(), s.reshape(n, classes)


def histograms(rows: DataFrame, trees: Sequence[Tree], level: int, features: int, bins: int) -> np.ndarray:
    """(class, node of the level, feature, bin, 2): summed gradients and curvatures of the rows of `rows` that
    are not held out, the trees grown to that level."""
    classes, nodes, first = len(trees), 1 << level, (1 << level) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, classes * nodes * features * bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, w, s = _unpacked(batch, classes)
            p, place = softmax(s), np.arange(features) * bins + x
            for k, tree in enumerate(trees):
                at = tree.nodes(x) - first
                own = np.flatnonzero(at >= 0)  # rows in a leaf above the level have no part in it
                cell = ((k * nodes + at[own])[:, None] * features * bins + place[own]).ravel()
                for i, v in enumerate((w * (p[:, k] - (y == k)), w * p[:, k] * (1 - p[:, k]))):
                    total[i] += np.bincount(cell, np.repeat(v[own], features), minlength=total.shape[1])
        some = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], ["cell", "g", "h"])

    sums = rows.where("not held").mapInArrow(run, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((classes * nodes * features * bins, 2))
    out[sums.column("cell").to_numpy()] = np.column_stack([sums.column("g").to_numpy(), sums.column("h").to_numpy()])
    return out.reshape(classes, nodes, features, bins, 2)


def gains(hist: np.ndarray, damping: float) -> np.ndarray:
    """The fall of the loss (twice, to second order) if what lies in the bins up to each one is split off."""
    left = np.cumsum(hist, -2)
    whole = left[..., -1:, :]
    part = lambda v: v[..., 0] ** 2 / (v[..., 1] + damping)
    return part(left) + part(whole - left) - part(whole)


def _split(tree: Tree, hist: np.ndarray, level: int, damping: float, rate: float, least_gain: float, least: float, last: bool) -> bool:
    """Splits the nodes of a level; whether any was. Children begin as leaves with their values."""
    any_split, first = False, (1 << level) - 1
    value = lambda v: float(-rate * v[0] / (v[1] + damping))
    for node, cells in enumerate(hist):
        total = cells[0].sum(0)
        if level == 0:
            tree.value[0] = value(total)
        if not cells.any():
            continue
        left = np.cumsum(cells, 1)
        fits = (left[..., 1] >= least) & (total[1] - left[..., 1] >= least)
        gain = np.where(fits, gains(cells, damping), -np.inf)
        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
        if gain[f, b] > least_gain:
            at, any_split = first + node, True
            tree.feature[at], tree.bin[at] = int(f), int(b)
            tree.value[2 * at + 1], tree.value[2 * at + 2] = value(left[f, b]), value(total - left[f, b])
    return any_split and not last


def train(
    features: DataFrame, names: Sequence[str], label: str, group: str, weights: Mapping | None = None, held: float = 0.2, trees: int = 200, depth: int = 4, rate: float = 0.1,
    bins: int = 32, damping: float = 1.0, least_gain: float = 1e-6, least: float = 1e-3, patience: int = 10, seed: int = 0,
) -> Booster:
    """A booster over features(names, label, group): about the share `held` of the groups is held out, and
    rounds end when the loss over them has not fallen for `patience` rounds (never, if nothing is held out);
    the rounds up to the best one count. weights gives classes other weights than 1. Rows without a label
    are left out. A label has few values and a node many rows: the driver gets classes x 2^depth x features
    x bins pairs of sums a level.
    """
    if not 2 <= bins <= 256:
        raise LunariaError(f"{bins} bins")
    spark, names = features.sparkSession, list(names)
    own = features.where(F.col(f"`{label}`").isNotNull())
    classes = sorted(r[0] for r in own.select(label).distinct().collect())  # a row a class
    if not classes:
        raise LunariaError("no rows with a label")
    weight = F.lit(1.0)
    for c, w in (weights or {}).items():
        weight = F.when(F.col(f"`{label}`") == c, float(w)).otherwise(weight)
    out = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{group}`")), F.lit(1_000_000)) < int(held * 1_000_000)
    own = own.withColumns({"__weight": weight, "__held": out})
    edges = quantile_edges(own.where("not __held"), names, bins)
    book, kept = Booster(classes, names, edges), Kept(spark)
    size = (1 << (depth + 1)) - 1
    try:
        rows = kept.put(_rows(own, names, label, "__weight", "__held", classes, edges))
        best = np.inf
        for _ in range(trees):
            one = [Tree([-1] * size, [0] * size, [0.0] * size) for _ in classes]
            for level in range(depth):
                hist = histograms(rows, one, level, len(names), bins)
                if not any([_split(t, h, level, damping, rate, least_gain, least, level == depth - 1) for t, h in zip(one, hist, strict=True)]):
                    break
            book.trees.append(one)
            rows = kept.put(rows.mapInArrow(_added(one), ROWS))
            book.losses.append(_losses(rows, len(classes)))
            now = book.losses[-1][1]
            if now != now or now < best:  # without held-out rows each round counts
                best, book.rounds = now, len(book.trees)
            elif len(book.trees) - book.rounds >= patience:
                break
    finally:
        kept.drop()
    return book


def _added(trees: Sequence[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _, _, s = _unpacked(batch, len(trees))
                s = s + np.column_stack([t.values(x) for t in trees])
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([r.tobytes() for r in s], pa.binary())], batch.schema.names)

    return run


def _losses(rows: DataFrame, classes: int) -> tuple[float, float]:
    """Weighted mean log losses of the rows learned from and of those held out (NaN for none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, y, w, s = _unpacked(batch, classes)
                loss = -w * np.log(np.maximum(softmax(s)[np.arange(len(y)), y], 1e-300))
                yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(w), pa.array(loss)], ["held", "w", "loss"])

    found = {r.held: r.loss for r in rows.mapInArrow(run, "held boolean, w double, loss double").groupBy("held").agg((F.sum("loss") / F.sum("w")).alias("loss")).collect()}
    return found.get(False, float("nan")), found.get(True, float("nan"))


def root_gains(features: DataFrame, names: Sequence[str], label: str, bins: int = 8, damping: float = 1.0) -> DataFrame:
    """(label, feature, bin, gain) of all splits that a first tree can begin with."""
    own = features.where(F.col(f"`{label}`").isNotNull()).withColumns({"__weight": F.lit(1.0), "__held": F.lit(False)})
    classes, edges = sorted(r[0] for r in own.select(label).distinct().collect()), quantile_edges(own, names, bins)
    rows = _rows(own, names, label, "__weight", "__held", classes, edges)
    found = gains(histograms(rows, [Tree([-1], [0], [0.0]) for _ in classes], 0, len(names), bins)[:, 0], damping)
    made = [(c, f, b, float(found[k, i, b])) for k, c in enumerate(classes) for i, f in enumerate(names) for b in range(len(edges[i]))]
    kind = features.schema[label].dataType.simpleString()
    return features.sparkSession.createDataFrame(made, f"label {kind}, feature string, bin int, gain double")
