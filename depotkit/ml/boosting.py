"""Histogram gradient boosting on Spark: binned blocks, one histogram pass a level, many models at once.

The table is binned once into blocks of rows. Each level of each round is one pass over them, which sums
gradients per node, feature and bin. Several models over the same table, such as the folds of a
walk-forward evaluation or the candidates of a grid, grow in the same passes.

A fit of many passes is one Spark job whose tasks run at the same time (a barrier stage) and hold their
rows. Each task sums its rows, adds the sums of all tasks for its share of the features, by files in the
shared folder, and tells the others the best splits of that share. Elsewhere (few passes, no fixed
executors, more rows a task than it may hold) a pass is a Spark job: a task walks its blocks down the trees
grown so far; the driver adds the sums of the tasks (or one task a feature does, when there are many) and
picks the splits.

Gradients are whole multiples of a step that keeps every sum below 2**53, so sums are exact and a
model does not depend on how rows are dealt to tasks. The raw scores so far are kept with the blocks,
so that a row goes down the trees of a finished round once, and written every ``WRITE_EVERY`` rounds
(in one job: the trees are); a lost executor costs the trees since then.
"""

from __future__ import annotations

import json
import math
import pickle
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotkit.session import cut_lineage, shared_folder, task_slots

MISSING_BIN = 255
BLOCK_ROWS = 65_536
WRITE_EVERY = 10
#: Up to so many tasks the driver adds histograms itself; beyond, one task a feature does.
DIRECT_TASKS = 64
#: Values of a column that a part of the table gives at most.
POINTS = 20_000
#: Rows a task should have, and models that grow in the same passes.
TASK_ROWS, LANES = 16_384, 12
#: Fits of more passes than this grow in one job, if a task of it holds at most so many rows.
JOB_PASSES, HELD_ROWS = 32, 2_000_000
#: Features are counted together while their joint bins are at most so many; rows that are counted at a time.
JOINT_BINS, CHUNK_ROWS = 1024, 32_768


@dataclass(frozen=True)
class Spec:
    """What one boosted model is fitted with. ``loss`` is "squared" or "softmax" (labels 0..classes-1).

    ``patience`` rounds without a smaller loss on the validation rows end a fit (0: never). Each
    round uses a ``subsample`` share of the training rows, by hash. ``max_leaves`` bounds a tree (0: no
    bound); in a level, splits of higher gain come first.
    """

    loss: str = "squared"
    rounds: int = 100
    rate: float = 0.1
    depth: int = 5
    min_leaf: int = 1
    l2: float = 0.0
    patience: int = 0
    tolerance: float = 1e-7
    subsample: float = 1.0
    max_leaves: int = 0
    classes: int = 1
    seed: int = 42


@dataclass
class Tree:
    """Nodes as lists; a leaf has feature -1. Rows with bin <= ``bin`` go left, missing values by
    ``missing_left``. ``value`` is the mean of the leaves below (times the rate), ``n`` the rows."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    n: list[float] = field(default_factory=list)

    def add(self, value: float, n: float) -> int:
        for name, x in zip(("feature", "bin", "missing_left", "left", "right", "value", "n"), (-1, 0, False, 0, 0, value, n)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature), np.array(self.bin, np.uint8), np.array(self.missing_left, bool), np.array(self.left),
                np.array(self.right), np.array(self.value, np.float64))

    def average(self) -> None:
        """Inner nodes get the mean value of their rows; children stand behind their parents."""
        for i in range(len(self.feature) - 1, -1, -1):
            if self.feature[i] >= 0:
                a, b = self.left[i], self.right[i]
                self.value[i] = (self.value[a] * self.n[a] + self.value[b] * self.n[b]) / (self.n[a] + self.n[b])


def walk(arrays: tuple[np.ndarray, ...], bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """The leaf (or open node) each column of ``bins`` (features x rows), or each of ``rows``, ends in."""
    feature, cut, missing_left, left, right, _ = arrays
    n = bins.shape[1]
    rows = np.arange(n) if rows is None else rows
    at, flat = np.zeros(len(rows), np.int64), bins.ravel()
    if feature[0] < 0:
        return at
    # Where each bin leads from each node; leaves lead to themselves.
    goes = np.arange(MISSING_BIN + 1) <= cut[:, None]
    goes[:, MISSING_BIN] = missing_left
    itself = np.arange(len(feature))[:, None]
    child = np.where(feature[:, None] < 0, itself, np.where(goes, left[:, None], right[:, None])).ravel()
    first, level = np.maximum(feature, 0) * n, np.zeros(len(feature), np.int64)
    for node in np.flatnonzero(feature >= 0):  # children stand behind their parents
        level[left[node]] = level[right[node]] = level[node] + 1
    for _ in range(level.max()):
        at = child.take(at * (MISSING_BIN + 1) + flat.take(first.take(at) + rows))
    return at


# Bins.

_VALUES = "c int, error long, values binary, rows binary"


def _values(df: DataFrame, columns: Sequence[str], within: Sequence[tuple[float, float]] | None = None) -> DataFrame:
    """The known values of each column, in order, and the rows of each, by parts of the table; ``within`` are
    bounds (the lower one open) to values of interest, the rows below are given for the lower one.

    A part of more than POINTS different values gives so many of them, the first and the last among them;
    then up to ``error`` rows with values up to a given one are counted with the next."""
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(columns)])

    def part(c: int, x: np.ndarray) -> tuple:
        x = x[~np.isnan(x)] + 0.0
        if within is not None:
            low, high = within[c]
            x = np.maximum(x[x <= high], low)
        values, counts = np.unique(x, return_counts=True)
        step = 1
        if within is None and len(values) > POINTS:
            upto, step = np.cumsum(counts), -(-len(x) // POINTS)
            wanted = np.unique(np.concatenate([[0], np.searchsorted(upto, np.arange(step, len(x), step)), [len(values) - 1]]))
            values, counts = values[wanted], np.diff(upto[wanted], prepend=0)
        return c, step - 1, values.tobytes(), counts.astype(np.int64).tobytes()

    def run(batches):
        held, size = [], 0

        def parts():
            table = pa.Table.from_batches(held)
            found = [part(c, table.column(c).to_numpy().astype(np.float64)) for c in range(len(columns))]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["c", "error", "values", "rows"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 16 * BLOCK_ROWS:
                yield parts()
                held, size = [], 0
        if size:
            yield parts()

    return rows.mapInArrow(run, _VALUES)


def _by_column(values: DataFrame, k: int, find: Callable[[int, np.ndarray, np.ndarray, int], np.ndarray]) -> list[np.ndarray]:
    """``find(column, values, rows up to each, error)`` of each column, over all parts."""

    def run(batches):
        parts: dict[int, list] = {}
        for batch in batches:
            for c, *part in zip(*[x.to_pylist() for x in batch.columns]):
                parts.setdefault(c, []).append(part)
        for c, mine in parts.items():
            x, n = (np.concatenate([np.frombuffer(p[i], t) for p in mine]) for i, t in ((1, np.float64), (2, np.int64)))
            order = np.argsort(x, kind="stable")
            x, upto = x[order], np.cumsum(n[order])
            last = np.flatnonzero(np.append(x[1:] != x[:-1], True)) if len(x) else order
            found = np.asarray(find(c, x[last], upto[last], sum(p[0] for p in mine)), np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([found.tobytes()])], ["c", "found"])

    got = {r["c"]: np.frombuffer(r["found"]) for r in values.repartition(k, "c").mapInArrow(run, "c int, found binary").collect()}
    return [got.get(c, np.zeros(0)) for c in range(k)]


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of whole columns; one without values has none. Parts of very many different values leave
    an interval open, the values of which a second pass counts. A few numbers a column reach the driver."""

    def bounds(c: int, values: np.ndarray, upto: np.ndarray, error: int) -> list[float]:
        if not len(values):
            return []
        low, high = (int(upto[-1]) - 1) // 2, int(upto[-1]) // 2
        below = int(np.searchsorted(upto + error, low, "right")) - 1  # the last value that too few rows reach in any case
        return [error, low, high, -math.inf if below < 0 else values[below], *(values[np.searchsorted(upto, r, "right")] for r in (low, high))]

    def exact(c: int, values: np.ndarray, upto: np.ndarray, error: int) -> list[float]:
        return [values[np.searchsorted(upto, int(r), "right")] for r in found[c][1:3]]

    found = _by_column(_values(df, columns), len(columns), bounds)
    middle = [x[4:] for x in found]
    if any(x[0] for x in found if len(x)):
        middle = _by_column(_values(df, columns, [(x[3], x[5]) if len(x) else (0.0, -math.inf) for x in found]), len(columns), exact)
    between = lambda low, high: float(low) if low == high else float(low + (high - low) * 0.5)
    return {c: between(*x) if len(x) else None for c, x in zip(columns, middle)}


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = 255) -> list[list[float]]:
    """Upper edges of each feature's bins: midpoints of its values, if they are at most ``max_bins``,
    else of neighbouring quantiles. At most ``max_bins`` values a feature and one more reach the driver."""
    if not 2 <= max_bins <= 255:
        raise ValueError("between 2 and 255 bins")

    def find(c: int, values: np.ndarray, upto: np.ndarray, error: int) -> np.ndarray:
        if len(values) <= max_bins:
            return values
        ranks = np.maximum(1, np.ceil(np.arange(max_bins + 1) / max_bins * upto[-1]).astype(np.int64))
        return values[np.searchsorted(upto, np.minimum(ranks, upto[-1]))]

    out = []
    for found in _by_column(_values(df, features), len(features), find):
        values = np.unique(found)
        out.append(np.unique((values[:-1] + values[1:]) / 2)[:max_bins - 1].tolist())
    return out


def to_bins(columns: Sequence[np.ndarray], edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins of each value; NaN has a bin of its own."""
    out = np.empty((len(columns), len(columns[0]) if columns else 0), np.uint8)
    for i, (x, cut) in enumerate(zip(columns, edges)):
        out[i] = np.where(np.isnan(x), MISSING_BIN, np.searchsorted(np.asarray(cut, np.float64), x, "left"))
    return out


_BLOCK = "n long, bins binary, y binary, fold binary, test binary, valid binary, hash binary, raw binary"


def to_blocks(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]], labels: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The binned table: a row holds the arrays of up to BLOCK_ROWS rows of ``df``, which has the
    columns fold, is_test and is_validation besides. A label may be missing."""
    rows = df.select(
        *[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)],
        *[F.col(f"`{c}`").cast("double").alias(f"y{i}") for i, c in enumerate(labels)],
        F.coalesce(F.col("fold").cast("int"), F.lit(-1)).alias("fold"), F.col("is_test").cast("boolean").alias("test"),
        F.col("is_validation").cast("boolean").alias("valid"), F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("hash"))
    k = len(features)

    def run(batches):
        held, size = [], 0

        def block():
            table = pa.Table.from_batches(held)
            x = [table.column(i).to_numpy().astype(np.float64) for i in range(k + len(labels))]
            flat = [table.column(c).to_numpy().astype(t).tobytes() for c, t in (("fold", np.int16), ("test", bool), ("valid", bool), ("hash", np.int64))]
            cells = [table.num_rows, to_bins(x[:k], edges).tobytes(), b"".join(y.tobytes() for y in x[k:]), *flat, b""]
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], ["n", "bins", "y", "fold", "test", "valid", "hash", "raw"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block()
                held, size = [], 0
        if size:
            yield block()

    return rows.mapInArrow(run, _BLOCK)


@dataclass(frozen=True)
class Lane:
    """A model to fit, its training rows, ("before", f), ("other", f), ("train",) or ("all",), and the
    place of its label. Rows without that label train nothing."""

    spec: Spec
    rows: tuple
    label: int = 0


def _rows(lane: Lane, fold: np.ndarray, test: np.ndarray, y: np.ndarray) -> np.ndarray:
    name, *at = lane.rows
    kinds = {"before": lambda: fold < at[0], "other": lambda: ~test & (fold != at[0]), "train": lambda: ~test, "all": lambda: True}
    return kinds[name]() & ~np.isnan(y)


def _sampled(hashes: np.ndarray, spec: Spec, round_: int) -> np.ndarray:
    mixed = hashes.view(np.uint64) ^ np.uint64((spec.seed * 0x9E3779B97F4A7C15 + round_ * 0xD1B54A32D192ED03) & (2**64 - 1))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < spec.subsample * 2.0**53


def _gradients(loss: str, raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """First and second derivatives (classes x rows); a squared error has a second one of 1."""
    if loss == "squared":
        return raw - y, None
    e = np.exp(raw - raw.max(axis=0))
    p = e / e.sum(axis=0)
    return p - (y == np.arange(len(raw))[:, None]), p * (1 - p)


def _losses(loss: str, raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    if loss == "squared":
        return (raw[0] - y) ** 2 / 2
    top = raw.max(axis=0)
    return np.log(np.exp(raw - top).sum(axis=0)) + top - raw[y.astype(np.int64), np.arange(len(y))]


class _Grown:
    """A model while it grows: finished trees by round and class, those of this round, open nodes."""

    def __init__(self, lane: Lane, start: list[float], bound: float, n: float):
        self.lane, self.start, self.n = lane, start, max(n, 1.0)
        self.bound, self.top, self.best, self.since, self.done = bound, 0.0, math.inf, 0, False
        self.rounds: list[list[Tree]] = []
        self.written = 0
        self.begin()

    def begin(self) -> None:
        self.trees = [Tree() for _ in self.start]
        self.open: list[list[int]] = [[t.add(0.0, 0.0)] for t in self.trees]
        self.asked = [list(o) for o in self.open]
        self.sums: list[dict[int, np.ndarray]] = [{} for _ in self.start]
        self.level, self.step = 0, 2.0 ** -math.floor(math.log2(2.0**51 / (self.n * max(self.bound, 1e-200))))

    def task(self) -> dict:
        """What a task needs to know."""
        pending = [[t.arrays() for t in trees] for trees in self.rounds[self.written:]]
        return {"spec": self.lane.spec, "lane": self.lane, "start": self.start, "pending": pending, "fresh": self.written == 0,
                "round": len(self.rounds), "trees": [t.arrays() for t in self.trees], "asked": self.asked, "step": self.step, "first": self.level == 0}


def _raw(task: dict, held: np.ndarray, bins: np.ndarray) -> np.ndarray:
    raw = np.repeat(np.array(task["start"])[:, None], bins.shape[1], 1) if task["fresh"] else held.copy()
    for trees in task["pending"]:
        for k, tree in enumerate(trees):
            raw[k] += tree[5][walk(tree, bins)]
    return raw


def _blocks_of(batches, k: int, classes: Sequence[int]):
    """(bins, labels, fold, test, valid, hash, raw per model) of each block."""
    for batch in batches:
        for row in batch.to_pylist():
            n = row["n"]
            bins = np.frombuffer(row["bins"], np.uint8).reshape(k, n)
            raw, at = [], np.frombuffer(row["raw"], np.float64)
            for c in classes:
                raw.append(at[:c * n].reshape(-1, n))
                at = at[c * n:]
            yield (bins, np.frombuffer(row["y"]).reshape(-1, n), np.frombuffer(row["fold"], np.int16), np.frombuffer(row["test"], bool),
                   np.frombuffer(row["valid"], bool), np.frombuffer(row["hash"], np.int64), raw), row


def _histograms(blocks: DataFrame, tasks: dict[int, dict], sizes: list[int], classes: list[int], many: bool) -> tuple[dict, dict]:
    """({(model, class): nodes x bins of all features x (gradient[, curvature], rows)}, {model: (loss, rows, top)})."""
    k, starts, total = len(sizes), np.concatenate([[0], np.cumsum(sizes)])[:-1], int(sum(sizes))

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        notes = {m: [0.0, 0.0, 0.0] for m in tasks}
        for (bins, labels, fold, test, valid, hashes, held), _ in _blocks_of(batches, k, classes):
            for m, task in tasks.items():
                spec, y = task["spec"], labels[task["lane"].label]
                raw = _raw(task, held[m], bins)
                mine = _rows(task["lane"], fold, test, y)
                if spec.patience:
                    if task["first"]:
                        check = mine & valid
                        notes[m][0] += float(_losses(spec.loss, raw[:, check], y[check]).sum())
                        notes[m][1] += int(check.sum())
                    mine = mine & ~valid
                if task["first"] and spec.loss == "squared" and mine.any():
                    notes[m][2] = max(notes[m][2], float(np.abs(raw[0, mine] - y[mine]).max()))
                if spec.subsample < 1:
                    mine = mine & _sampled(hashes, spec, task["round"])
                rows = np.flatnonzero(mine)
                first, second = _gradients(spec.loss, raw[:, rows], y[rows])
                for c, (tree, asked) in enumerate(zip(task["trees"], task["asked"])):
                    if not asked:
                        continue
                    place = np.full(len(tree[0]), -1, np.int64)
                    place[asked] = np.arange(len(asked))
                    at = place[walk(tree, bins, rows)] if len(tree[0]) > 1 else np.zeros(len(rows), np.int64)
                    inside = np.flatnonzero(at >= 0)
                    use, at = rows[inside], at[inside]
                    g = np.rint(first[c][inside] / task["step"])
                    h = None if second is None else np.rint(second[c][inside] / task["step"])
                    if (m, c) not in sums:
                        sums[m, c] = np.zeros((2 if h is None else 3, len(asked), total))
                    out, first_cell = sums[m, c], at * (MISSING_BIN + 1)
                    for f in range(k):
                        # a byte a bin, the last for missing values: one addition makes the cell
                        cell, known = first_cell + bins[f][use], sizes[f] - 1
                        for i, w in enumerate((g, None) if h is None else (g, h, None)):
                            found = np.bincount(cell, w, len(asked) * (MISSING_BIN + 1)).reshape(len(asked), -1)
                            out[i, :, starts[f]:starts[f] + known] += found[:, :known]
                            out[i, :, starts[f] + known] += found[:, MISSING_BIN]
        found = [(m, c, f, np.ascontiguousarray(x[:, :, starts[f]:starts[f] + sizes[f]]).tobytes()) for (m, c), x in sums.items() for f in range(k)]
        found += [(m, -1, -1, np.array(x).tobytes()) for m, x in notes.items() if tasks[m]["first"]]
        for part in (found[i:i + 512] for i in range(0, len(found), 512)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["m", "c", "f", "sums"])

    def add(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for m, c, f, raw in zip(*[x.to_pylist() for x in batch.columns]):
                _add(sums, (m, c, f), np.frombuffer(raw))
        for key, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, x.tobytes()), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["m", "c", "f", "sums"])

    schema = "m int, c int, f int, sums binary"
    made = blocks.mapInArrow(run, schema)
    if many:
        made = made.repartition(k, "f").mapInArrow(add, schema)
    parts: dict[tuple, np.ndarray] = {}
    for m, c, f, raw in zip(*[x.to_pylist() for x in made.toArrow().columns]):
        _add(parts, (m, c, f), np.frombuffer(raw))
    hists, notes = {}, {}
    for m, task in tasks.items():
        if task["first"]:
            notes[m] = parts.get((m, -1, -1), np.zeros(3))
        width = 2 if task["spec"].loss == "squared" else 3
        for c, asked in enumerate(task["asked"]):
            if asked:
                cells = [parts.get((m, c, f), np.zeros(width * len(asked) * sizes[f])).reshape(width, len(asked), -1) for f in range(k)]
                hists[m, c] = np.concatenate(cells, axis=2)
    return hists, notes


def _add(sums: dict, key: tuple, x: np.ndarray) -> None:
    """Adds histograms; of the notes (feature -1) the last is a maximum."""
    old = sums.get(key)
    if old is None:
        sums[key] = x.copy()
    elif key[2] < 0:
        sums[key] = np.array([old[0] + x[0], old[1] + x[1], max(old[2], x[2])])
    else:
        old += x


def candidates(hist: np.ndarray, sizes: Sequence[int], spec: Spec, step: float) -> list[tuple]:
    """(gain, feature, bin, missing_left, left sums, right sums) of a node's cuts that may be its best split.

    ``hist`` is (gradient[, curvature], rows) x bins of all features, each feature's missing bin last.
    Ties fall to the first feature, the lowest bin, then to missing values on the right; without
    missing values in the node they follow the larger side. The last bin as the cut parts known
    values from missing ones. Of cuts as good as the best, up to rounding, those better than all before them
    are given, so that :func:`pick` finds the same among all features as among the finds of some of them each.
    """
    if not len(sizes):
        return []
    scale = np.array([step] * (len(hist) - 1) + [1.0])[:, None]
    stops = np.cumsum(sizes)
    starts, of = stops - sizes, np.repeat(np.arange(len(sizes)), sizes)
    running = np.cumsum(hist, axis=1)
    before = (running - hist)[:, starts]
    total, missing = (running[:, stops[:1] - 1] - before[:, :1]) * scale, hist[:, stops - 1] * scale
    upto = (running - before[:, of]) * scale
    left = np.stack([upto, upto + missing[:, of]], axis=2)
    right = total[:, :, None] - left
    at = 1 if len(hist) == 3 else -1
    worth = lambda s: s[0] ** 2 / np.maximum(s[at] + spec.l2, 1e-12)
    whole = float(worth(total)[0])
    gain = worth(left) + worth(right) - whole
    gain[np.minimum(left[-1], right[-1]) < max(1, spec.min_leaf)] = -np.inf
    gain[stops - 1] = -np.inf
    gain[:, 1][missing[-1][of] == 0] = -np.inf
    best = gain.max()
    if not best > 1e-12 * max(1.0, abs(whole)):
        return []
    near = np.flatnonzero(gain.ravel() >= best * (1 - 1e-12))
    worths = gain.ravel()[near]
    found = []
    for place in near[worths > np.concatenate([[-np.inf], np.maximum.accumulate(worths)[:-1]])]:
        cell, missing_left = divmod(int(place), 2)
        f = int(of[cell])
        ours, theirs = left[:, cell, missing_left], right[:, cell, missing_left]
        goes = bool(missing_left) if missing[-1, f] else bool(ours[-1] > theirs[-1])
        found.append((float(gain[cell, missing_left]), f, int(cell - starts[f]), goes, ours, theirs))
    return found


def pick(found: Sequence[tuple]) -> tuple | None:
    """The first of the cuts, in the order of features, that is as good as the best, up to rounding."""
    best = max((c[0] for c in found), default=0.0)
    return next((c for c in found if c[0] >= best * (1 - 1e-12)), None)


def best_split(hist: np.ndarray, sizes: Sequence[int], spec: Spec, step: float) -> tuple | None:
    """The best of the :func:`candidates` of a node, if any cut gains."""
    return pick(candidates(hist, sizes, spec, step))


def _sums_of(model: _Grown, c: int, hist: np.ndarray) -> dict[int, np.ndarray]:
    """Histograms of all open nodes of a tree, from those of the nodes that were asked for."""
    known = {node: hist[:, i] for i, node in enumerate(model.asked[c])}
    for node in model.open[c]:  # the larger child is its parent less its sibling
        if node not in known:
            parent, sibling = model.sums[c][("of", node)]
            known[node] = parent - known[sibling]
    return known


def _total(model: _Grown, hist: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """The sums of a node, which are those of any feature's bins."""
    return hist[:, :sizes[0]].sum(axis=1) * np.array([model.step] * (len(hist) - 1) + [1.0])


def _grow(model: _Grown, c: int, hist: np.ndarray, sizes: Sequence[int]) -> None:
    known = _sums_of(model, c, hist)
    splits = {node: best_split(known[node], sizes, model.lane.spec, model.step) for node in model.open[c]}
    _split(model, c, splits, known, _total(model, known[0], sizes) if model.level == 0 else None)


def _split(model: _Grown, c: int, splits: dict[int, tuple | None], known: dict[int, np.ndarray], total: np.ndarray | None) -> None:
    """Split the open nodes of one tree; children that may be split again are open next."""
    spec, tree = model.lane.spec, model.trees[c]
    weight = lambda s: s[1 if len(s) == 3 else -1]
    value = lambda s: float(-spec.rate * s[0] / max(weight(s) + spec.l2, 1e-12))
    order = sorted((n for n in splits if splits[n]), key=lambda n: (-splits[n][0], n))
    if spec.max_leaves:
        order = order[:max(0, spec.max_leaves - sum(f < 0 for f in tree.feature))]
    if total is not None:
        tree.value[0], tree.n[0] = (value(total) if total[-1] else 0.0), float(total[-1])
    opened, asked, sums = [], [], {}
    for node in sorted(order):
        _, f, b, goes, left, right = splits[node]
        tree.feature[node], tree.bin[node], tree.missing_left[node] = f, b, goes
        tree.left[node], tree.right[node] = tree.add(value(left), float(left[-1])), tree.add(value(right), float(right[-1]))
        if model.level + 1 < spec.depth:
            small, large = (tree.left[node], tree.right[node]) if left[-1] <= right[-1] else (tree.right[node], tree.left[node])
            opened += [tree.left[node], tree.right[node]]
            asked.append(small)
            sums["of", large] = (known[node], small)
    model.open[c], model.asked[c], model.sums[c] = opened, asked, sums


def _take(model: _Grown, note: Sequence[float]) -> None:
    """What a round's first pass found: the loss of the rows that check the model, their number, the largest gradient."""
    model.top = float(note[2])
    if model.lane.spec.patience and note[1]:
        loss = float(note[0] / note[1])
        model.since = 0 if loss < model.best - model.lane.spec.tolerance else model.since + 1
        model.best = min(model.best, loss)
        model.done = model.since >= model.lane.spec.patience


def _end_round(model: _Grown) -> None:
    spec = model.lane.spec
    leaf = max((abs(v) for t in model.trees for v in t.value), default=0.0)
    for tree in model.trees:
        tree.average()
    model.rounds.append(model.trees)
    if spec.loss == "squared":
        model.bound = model.top + leaf
    stuck = spec.subsample == 1 and all(len(t.feature) == 1 for t in model.trees)
    model.done = len(model.rounds) >= spec.rounds or stuck or (spec.loss == "squared" and model.top == 0.0)


def _advanced(blocks: DataFrame, models: list[_Grown], k: int, classes: list[int], write: bool) -> DataFrame:
    """The blocks with the raw scores of all trees so far: written, or made and kept by the next pass."""
    tasks = [m.task() for m in models]

    def run(batches):
        for (bins, *_, held), row in _blocks_of(batches, k, classes):
            row["raw"] = b"".join(_raw(t, h, bins).tobytes() for t, h in zip(tasks, held))
            yield pa.RecordBatch.from_pylist([row], pa.schema([("n", pa.int64()), *[(c, pa.binary()) for c in ("bins", "y", "fold", "test", "valid", "hash", "raw")]]))

    made = blocks.mapInArrow(run, _BLOCK)
    out = (cut_lineage(made) if write else made).persist(StorageLevel.MEMORY_AND_DISK)
    for m in models:
        m.written = len(m.rounds)
    return out


@dataclass
class Boosted:
    """A fitted model: features, bin edges, start scores and trees by round and class.

    ``fills`` replace missing values of a feature before it is binned.
    """

    features: list[str]
    edges: list[list[float]]
    spec: Spec
    start: list[float]
    rounds: list[list[Tree]]
    fills: dict[str, float] = field(default_factory=dict)

    def _inputs(self) -> list[Column]:
        x = [F.col(f"`{c}`").cast("double") for c in self.features]
        return [F.coalesce(v, F.lit(self.fills[c])) if c in self.fills else v for c, v in zip(self.features, x)]

    def raw(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Scores (classes x rows) of feature columns."""
        bins = to_bins(columns, self.edges)
        out = np.repeat(np.array(self.start)[:, None], bins.shape[1], 1)
        for trees in self.arrays_by_round:
            for k, tree in enumerate(trees):
                out[k] += tree[5][walk(tree, bins)]
        return out

    @cached_property
    def arrays_by_round(self) -> list[list[tuple[np.ndarray, ...]]]:
        return [[t.arrays() for t in trees] for trees in self.rounds]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``: the score, or the class of the highest score (the first of equals)."""
        return df.withColumn("prediction", predictions([self])[0])

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The trees as a table, one row a node."""
        rows = []
        for r, trees in enumerate(self.rounds):
            for c, t in enumerate(trees):
                for i, f in enumerate(t.feature):
                    rows.append((r, c, i, self.features[f] if f >= 0 else None, _threshold(self.edges, f, t.bin[i]), t.missing_left[i] if f >= 0 else None,
                                 t.left[i] if f >= 0 else None, t.right[i] if f >= 0 else None, float(t.value[i]), int(t.n[i])))
        return spark.createDataFrame(rows, "round int, class int, node int, feature string, threshold double, missing_left boolean, left int, right int, value double, n long")

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "edges": self.edges, "spec": asdict(self.spec), "start": self.start, "fills": self.fills,
                           "rounds": [[asdict(t) for t in trees] for trees in self.rounds]})

    @staticmethod
    def from_json(text: str) -> "Boosted":
        d = json.loads(text)
        rounds = [[Tree(**t) for t in trees] for trees in d["rounds"]]
        return Boosted(d["features"], d["edges"], Spec(**d["spec"]), d["start"], rounds, d["fills"])

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Boosted":
        return Boosted.from_json(spark.read.text(path, wholetext=True).first()[0])

    def importance(self) -> dict[str, float]:
        """Share of all squared value changes, weighed by rows, that splits on a feature make."""
        out = dict.fromkeys(self.features, 0.0)
        for trees in self.rounds:
            for t in trees:
                for i, f in enumerate(t.feature):
                    if f >= 0:
                        out[self.features[f]] += sum(t.n[j] * (t.value[j] - t.value[i]) ** 2 for j in (t.left[i], t.right[i]))
        total = sum(out.values()) or 1.0
        return {c: v / total for c, v in out.items()}


def _threshold(edges: Sequence[Sequence[float]], feature: int, at: int) -> float | None:
    return float(edges[feature][at]) if feature >= 0 and at < len(edges[feature]) else None


@lru_cache(maxsize=64)
def loaded(text: str) -> Boosted:
    return Boosted.from_json(text)


def _matrix(columns: Sequence[pd.Series]) -> list[np.ndarray]:
    return [c.to_numpy(np.float64, na_value=np.nan) for c in columns]


def _answers(text: str, columns: Sequence[np.ndarray]) -> np.ndarray:
    model = loaded(text)
    raw = model.raw(columns)
    return raw[0] if model.spec.loss == "squared" else raw.argmax(axis=0).astype(np.float64)


def predictions(models: Sequence[Boosted]) -> list[Column]:
    """A column of predictions for each model, over the columns of the table they are used in."""

    def of(text: str):
        def run(*columns: pd.Series) -> pd.Series:
            return pd.Series(_answers(text, _matrix(columns)))

        return F.pandas_udf(run, T.DoubleType())

    return [of(model.to_json())(*model._inputs()) for model in models]


def prediction_by(models: Sequence[Boosted], which: Column) -> Column:
    """The prediction of the model that ``which`` gives the place of, for models over the same features."""
    texts = [m.to_json() for m in models]

    def run(*columns: pd.Series) -> pd.Series:
        place, x = columns[0].to_numpy(), _matrix(columns[1:])
        out = np.full(len(place), np.nan)
        for i in np.unique(place):
            mine = place == i
            out[mine] = _answers(texts[int(i)], [c[mine] for c in x])
        return pd.Series(out)

    return F.pandas_udf(run, T.DoubleType())(which.cast("int"), *models[0]._inputs())


def contributions(model: Boosted, class_: int = 0) -> tuple[float, Column]:
    """(base value, column of one contribution a feature): how each split on a row's paths changes the
    mean value of the rows that get there. Base value and contributions add up to the score."""
    text = model.to_json()
    base = model.start[class_] + sum(trees[class_].value[0] for trees in model.rounds)

    def run(*columns: pd.Series) -> pd.Series:
        mine = loaded(text)
        bins = to_bins(_matrix(columns), mine.edges)
        out = np.zeros(bins.shape)
        for trees in mine.arrays_by_round:
            steps(trees[class_], bins, out)
        return pd.Series(list(out.T))

    return base, F.pandas_udf(run, T.ArrayType(T.DoubleType()))(*model._inputs())


def steps(arrays: tuple[np.ndarray, ...], bins: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` (features x rows) what each split of a tree changes."""
    feature, cut, missing_left, left, right, value = arrays
    n = bins.shape[1]
    rows, at, flat = np.arange(n), np.zeros(n, np.int64), bins.ravel()
    while len(rows := rows[feature[at[rows]] >= 0]):
        node = at[rows]
        f = feature[node]
        b = flat[f * n + rows]
        child = np.where(np.where(b == MISSING_BIN, missing_left[node], b <= cut[node]), left[node], right[node])
        out[f, rows] += value[child] - value[node]
        at[rows] = child


def fit_all(
    df: DataFrame, features: Sequence[str], labels: Sequence[str], keys: Sequence[str], lanes: Sequence[Lane],
    edges: list[list[float]] | None = None, fills: dict[str, float] | None = None,
) -> list[Boosted]:
    """One model a lane, grown together, LANES at a time.

    ``df`` has the features (missing values as null or NaN), the labels, the columns fold, is_test and
    is_validation, and ``keys``, whose hash picks the rows of a round's sample. Bins come from all
    rows given that are not held out. A model without training rows has a start score of 0 and no trees.
    """
    fills = fills or {}
    filled = df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(v)) for c, v in fills.items()})
    if edges is None:
        edges = bin_edges(filled.filter(~F.col("is_test")), features)
    sizes = [len(e) + 2 for e in edges]
    base = cut_lineage(to_blocks(filled, features, edges, labels, keys))
    rows = base.agg(F.sum("n")).first()[0] or 1
    tasks = min(max(1, base.rdd.getNumPartitions()), -(-rows // TASK_ROWS))
    at_once = _tasks_of_a_job(df.sparkSession, rows, lanes)
    if at_once:
        dealt = base.repartition(at_once)
        parts = [lanes[i:i + LANES] for i in range(0, len(lanes), LANES)]
        return [m for part in parts for m in _fit_in_a_job(dealt, list(features), edges, sizes, _begun(base.coalesce(tasks), part, len(features)), fills)]
    base, many = base.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK), tasks > DIRECT_TASKS
    try:
        return [m for i in range(0, len(lanes), LANES) for m in _fit(base, list(features), edges, sizes, lanes[i:i + LANES], fills, many)]
    finally:
        base.unpersist()


def _starts(blocks: DataFrame, lanes: Sequence[Lane], k: int) -> list[tuple[list[float], float, float]]:
    """(start scores, bound of the gradients, rows) of each lane, from one pass."""
    widest = max(lane.spec.classes for lane in lanes)

    def run(batches):
        out = np.zeros((len(lanes), 2 + widest))
        low, high = np.full(len(lanes), np.inf), np.full(len(lanes), -np.inf)
        for (_, labels, fold, test, valid, *_), _ in _blocks_of(batches, k, []):
            for i, lane in enumerate(lanes):
                y = labels[lane.label]
                mine = _rows(lane, fold, test, y)
                z = y[mine & ~valid if lane.spec.patience else mine]
                out[i, 0] += len(z)
                if len(z):
                    out[i, 1] += z.sum()
                    low[i], high[i] = min(low[i], z.min()), max(high[i], z.max())
                if lane.spec.loss == "softmax":
                    out[i, 2:2 + lane.spec.classes] += np.bincount(z.astype(np.int64), minlength=lane.spec.classes)
        yield pa.RecordBatch.from_arrays([pa.array([np.column_stack([out, low, high]).tobytes()])], ["sums"])

    parts = [np.frombuffer(r["sums"]).reshape(len(lanes), -1) for r in blocks.mapInArrow(run, "sums binary").collect()]
    out = []
    for i, lane in enumerate(lanes):
        n, total = (sum(float(p[i, j]) for p in parts) for j in (0, 1))
        counts = sum((p[i, 2:2 + lane.spec.classes] for p in parts), np.zeros(lane.spec.classes))
        low, high = min((p[i, -2] for p in parts), default=0.0), max((p[i, -1] for p in parts), default=0.0)
        if lane.spec.loss == "softmax":
            out.append((np.log(np.maximum(counts, 1e-9) / max(n, 1.0)).tolist(), 1.0, n))
        else:
            mean = total / n if n else 0.0
            out.append(([mean], max(high - mean, mean - low) if n else 0.0, n))
    return out


# Fits in one job.

def _tasks_of_a_job(spark: SparkSession, rows: int, lanes: Sequence[Lane]) -> int:
    """Tasks that grow the models in one job, or 0 if each pass has to be a job."""
    if max((lane.spec.rounds * lane.spec.depth for lane in lanes), default=0) <= JOB_PASSES:
        return 0
    tasks = min(-(-rows // TASK_ROWS), task_slots(spark))
    if not tasks or -(-rows // tasks) > HELD_ROWS:
        return 0
    try:
        _files(shared_folder(spark))
    except (OSError, pa.ArrowException):  # a store that only Spark opens
        return 0
    return tasks


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _joint(sizes: Sequence[int]) -> list[list[int]]:
    """Groups of features that are counted by their joint bin; sums over a group give the counts of each."""
    groups: list[list] = []
    for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
        room = next((g for g in groups if g[0] * sizes[f] <= JOINT_BINS), None)
        if room is None:
            groups.append(room := [1, []])
        room[0] *= sizes[f]
        room[1].append(f)
    return [members for _, members in groups]


class _Held:
    """The rows of a task that any model is fitted or checked with; scores, weights and nodes of each model's rows."""

    def __init__(self, batches: Iterator[pa.RecordBatch], models: Sequence[_Grown], sizes: Sequence[int]):
        self.sizes, self.starts, self.cells = sizes, np.cumsum(sizes) - sizes, int(sum(sizes))
        lanes = [m.lane for m in models]
        k, labels = len(sizes), 1 + max(lane.label for lane in lanes)
        parts = [(np.zeros((k, 0), np.uint8), np.zeros((labels, 0)), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros((len(lanes), 0), bool))]
        for (bins, y, fold, test, valid, hashes, _), _ in _blocks_of(batches, k, []):
            mine = np.stack([_rows(lane, fold, test, y[lane.label]) for lane in lanes])
            rows = np.flatnonzero(mine.any(axis=0))
            parts.append((bins[:, rows], y[:labels, rows], valid[rows], hashes[rows], mine[:, rows]))
        self.bins, self.y, valid, self.hashes, mine = (np.concatenate(p, axis=-1) for p in zip(*parts))
        self.n = len(valid)
        self.groups, self.codes = _joint(sizes), []
        for members in self.groups:
            code = np.zeros(self.n, np.uint16)
            for f in members:
                code = code * np.uint16(sizes[f]) + np.where(self.bins[f] == MISSING_BIN, np.uint16(sizes[f] - 1), self.bins[f])
            self.codes.append(code)
        checks = [bool(lane.spec.patience) for lane in lanes]
        self.trained = [np.flatnonzero(m & ~valid if c else m) for m, c in zip(mine, checks)]
        self.checked = [np.flatnonzero(m & valid if c else np.zeros_like(m)) for m, c in zip(mine, checks)]
        self.raw = [np.repeat(np.array(m.start)[:, None], self.n, 1) for m in models]
        self.weights: list[list[np.ndarray]] = [[] for _ in models]
        self.nodes: list[list[dict[int, tuple[np.ndarray, np.ndarray]]]] = [[] for _ in models]
        for raw, model in zip(self.raw, models):  # of a fit that goes on
            for trees in model.rounds:
                for k, tree in enumerate(trees):
                    arrays = tree.arrays()
                    raw[k] += arrays[5][walk(arrays, self.bins)]

    def _of(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return x if len(rows) == self.n else x.take(rows, axis=-1)

    def begin(self, i: int, model: _Grown) -> list[float]:
        """Weights of a round, all rows in the root; (loss, rows, top) as the first pass of a round finds them."""
        spec, raw, y, used, rest = model.lane.spec, self.raw[i], self.y[model.lane.label], self.trained[i], self.checked[i]
        note = [0.0, 0.0, 0.0]
        if spec.patience:
            note[:2] = float(_losses(spec.loss, raw[:, rest], y[rest]).sum()), float(len(rest))
        if spec.loss == "squared" and len(used):
            note[2] = float(np.abs(self._of(raw, used)[0] - self._of(y, used)).max())
        if spec.subsample < 1:
            picked = _sampled(self._of(self.hashes, used), spec, len(model.rounds))
            used, rest = used[picked], np.concatenate([rest, used[~picked]])
        first, second = _gradients(spec.loss, self._of(raw, used), self._of(y, used))
        self.weights[i] = []
        for c in range(len(first)):
            w = np.empty(len(used), np.complex128)
            w.real, w.imag = np.rint(first[c] / model.step), 1.0 if second is None else np.rint(second[c] / model.step)
            if len(used) < self.n:
                whole = np.empty(self.n, np.complex128)
                whole[used] = w
                w = whole
            self.weights[i].append(w)
        self.nodes[i] = [{0: (used, rest)} for _ in first]
        return note

    def sums(self, i: int, model: _Grown) -> dict[int, np.ndarray]:
        """By class: (gradient[, curvature], rows) x nodes asked for x bins of all features."""
        out, counted = {}, model.lane.spec.loss != "squared"
        classes = [c for c, asked in enumerate(model.asked) if asked]
        if model.level == 0:  # the classes share their rows
            found = self._counted(self.nodes[i][0][0][0], [self.weights[i][c] for c in classes], counted)
            return {c: found[j][:, None] for j, c in enumerate(classes)}
        for c in classes:
            out[c] = np.stack([self._counted(self.nodes[i][c][node][0], [self.weights[i][c]], counted)[0] for node in model.asked[c]], axis=1)
        return out

    def _counted(self, rows: np.ndarray, weights: list[np.ndarray], counted: bool) -> np.ndarray:
        """Sums of real and imaginary parts [and rows] in the bins of all features, for each of the weights."""
        joint = [np.zeros((len(weights), math.prod(self.sizes[f] for f in g)), np.complex128) for g in self.groups]
        number = [np.zeros(j.shape[1], np.int64) for j in joint]
        for at in range(0, len(rows), CHUNK_ROWS):
            part = rows[at:at + CHUNK_ROWS]
            whole = len(rows) == self.n
            mine = [w[at:at + CHUNK_ROWS] if whole else w.take(part) for w in weights]
            for code, sums, n in zip(self.codes, joint, number):
                cell = (code[at:at + CHUNK_ROWS] if whole else code.take(part)).astype(np.intp)
                for s, w in zip(sums, mine):
                    np.add.at(s, cell, w)
                if counted:
                    n += np.bincount(cell, minlength=len(n))
        out = np.empty((len(weights), 2 + counted, self.cells))
        for members, sums, n in zip(self.groups, joint, number):
            shape = [self.sizes[f] for f in members]
            for j, f in enumerate(members):
                mine, others = slice(self.starts[f], self.starts[f] + self.sizes[f]), tuple(a for a in range(len(members)) if a != j)
                whole = sums.reshape(len(weights), *shape).sum(axis=tuple(a + 1 for a in others))
                out[:, 0, mine], out[:, 1, mine] = whole.real, whole.imag
                if counted:
                    out[:, 2, mine] = n.reshape(shape).sum(axis=others)
        return out

    def follow(self, i: int, model: _Grown) -> None:
        """Rows go to the children of their nodes; those in leaves get the value of the leaf."""
        for c, tree in enumerate(model.trees):
            before, self.nodes[i][c] = self.nodes[i][c], {}
            raw, still = self.raw[i][c], set(model.open[c])
            for node, sets in before.items():
                f = tree.feature[node]
                if f < 0:
                    for rows in sets:
                        raw[rows] += tree.value[node]
                    continue
                left, right = tree.left[node], tree.right[node]
                goes = np.arange(MISSING_BIN + 1) <= tree.bin[node]
                goes[MISSING_BIN] = tree.missing_left[node]
                sides = [goes.take(self._of(self.bins[f], rows)) for rows in sets]
                if left in still:
                    self.nodes[i][c] |= {left: tuple(r[s] for r, s in zip(sets, sides)), right: tuple(r[~s] for r, s in zip(sets, sides))}
                else:
                    for rows, side in zip(sets, sides):
                        raw[rows] += np.where(side, tree.value[left], tree.value[right])


class _Tasks:
    """The tasks of a job that run at the same time. Each adds the sums of all for its share of the features.

    They meet by files of the shared folder: a step is over for a task once it has read a file of each
    (the barrier of Spark looks once a second only)."""

    def __init__(self, folder: str, sizes: Sequence[int]):
        context = BarrierTaskContext.get()
        self.place, self.n = context.partitionId(), len(context.getTaskInfos())
        self.files, self.folder = _files(folder)
        self.attempt, self.step = context.allGather(uuid.uuid4().hex)[0], 0
        upto, cells = np.cumsum([0, *sizes]), sum(sizes)
        cuts = [int(np.searchsorted(upto, cells * j / self.n)) for j in range(self.n)] + [len(sizes)]
        self.features = range(cuts[self.place], cuts[self.place + 1])
        self.cells = [(int(upto[a]), int(upto[b])) for a, b in zip(cuts, cuts[1:])]

    def _file(self, step: int, place: int) -> str:
        return f"{self.folder}/{self.attempt}-{step}-{place}"

    def put(self, path: str, data: bytes) -> None:
        """A file that is there as a whole or not at all."""
        with self.files.open_output_stream(f"{path}.new") as out:
            out.write(data)
        self.files.move(f"{path}.new", path)

    def _met(self, data: bytes) -> Iterator[tuple[int, pa.NativeFile]]:
        """The files of all other tasks, as they come."""
        self.put(self._file(self.step, self.place), data)
        missing, pause = [p for p in range(self.n) if p != self.place], 0.0005
        while missing:
            there = [i.type == fs.FileType.File for i in self.files.get_file_info([self._file(self.step, p) for p in missing])]
            for place in (p for p, is_there in zip(missing, there) if is_there):
                with self.files.open_input_file(self._file(self.step, place)) as file:
                    yield place, file
            missing = [p for p, is_there in zip(missing, there) if not is_there]
            if missing:
                time.sleep(pause)
                pause = min(pause * 1.2, 0.02)
        if self.step:  # all have read the file of the step before
            self.files.delete_file(self._file(self.step - 1, self.place))
        self.step += 1

    def tell(self, thing) -> list:
        """What each task tells, in the same order for all."""
        told = {self.place: thing}
        for place, file in self._met(pickle.dumps(thing)) if self.n > 1 else ():
            told[place] = pickle.loads(file.read())
        return [told[p] for p in range(self.n)]

    def add(self, sums: np.ndarray) -> np.ndarray:
        """The columns of this task's share, added over the ``sums`` (rows x cells) of all."""
        low, high = self.cells[self.place]
        own = sums[:, low:high].copy()
        for _, file in self._met(b"".join(np.ascontiguousarray(sums[:, a:b]).tobytes() for a, b in self.cells)) if self.n > 1 else ():
            own += np.frombuffer(file.read_at(own.nbytes, 8 * len(sums) * low)).reshape(own.shape)
        return own


def _level(held: _Held, tasks: _Tasks, busy: dict[int, _Grown], notes: dict[int, list[float]]) -> None:
    """Grows the trees of the models by a level."""
    mine = {(i, c): x for i, m in busy.items() for c, x in held.sums(i, m).items()}
    own = tasks.add(np.concatenate([x.reshape(-1, held.cells) for x in mine.values()]))
    sizes, known, found, at = [held.sizes[f] for f in tasks.features], {}, {}, 0
    for (i, c), x in mine.items():
        model, shape = busy[i], (*x.shape[:2], own.shape[1])
        hist, at = own[at:at + shape[0] * shape[1]].reshape(shape), at + shape[0] * shape[1]
        known[i, c] = _sums_of(model, c, hist)
        cuts = {node: [(g, f + tasks.features.start, *rest) for g, f, *rest in candidates(known[i, c][node], sizes, model.lane.spec, model.step)]
                for node in model.open[c]}
        found[i, c] = cuts, _total(model, known[i, c][0], sizes) if model.level == 0 and sizes else None
    told = tasks.tell((notes, found))
    for i in notes:
        loss, rows, top = zip(*[by_model[i] for by_model, _ in told])
        _take(busy[i], (sum(loss), sum(rows), max(top)))
    for i, c in found:
        if not busy[i].done:
            cuts = [t[i, c] for _, t in told]
            splits = {node: pick([x for by_node, _ in cuts for x in by_node[node]]) for node in busy[i].open[c]}
            _split(busy[i], c, splits, known[i, c], next((total for _, total in cuts if total is not None), None))
    for i, m in busy.items():
        if not m.done:
            held.follow(i, m)
        m.level += 1


def _fit_in_a_task(batches: Iterator[pa.RecordBatch], models: list[_Grown], sizes: list[int], folder: str) -> list[_Grown]:
    tasks = _Tasks(folder, sizes)
    state, saved = f"{tasks.folder}/state", None
    if tasks.place == 0 and tasks.files.get_file_info(state).type == fs.FileType.File:  # of an attempt that was lost
        with tasks.files.open_input_file(state) as known:
            saved = known.read()
    saved = tasks.tell(saved)[0]
    models = pickle.loads(saved) if saved else models
    held, rounds = _Held(batches, models, sizes), 0
    while any(not m.done for m in models):
        live = {i: m for i, m in enumerate(models) if not m.done}
        notes = {i: held.begin(i, m) for i, m in live.items()}
        while busy := {i: m for i, m in live.items() if not m.done and any(m.asked)}:
            _level(held, tasks, busy, notes)
            notes = {}
        for m in live.values():
            if not m.done:
                _end_round(m)
            if not m.done:
                m.begin()
        rounds += 1
        if tasks.place == 0 and rounds % WRITE_EVERY == 0:
            tasks.put(state, pickle.dumps(models))
    return models


def _fit_in_a_job(blocks: DataFrame, features: list[str], edges: list, sizes: list[int], models: list[_Grown], fills: dict) -> list[Boosted]:
    """The models of :func:`_fit`, grown by tasks that hold their rows until all models are done."""
    folder = f"{shared_folder(blocks.sparkSession).rstrip('/')}/boost-{uuid.uuid4().hex}"
    files, path = _files(folder)
    files.create_dir(path)

    def run(batches):
        grown = _fit_in_a_task(batches, models, sizes, folder)
        if BarrierTaskContext.get().partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps([m.rounds for m in grown])])], ["rounds"])

    try:
        rounds = pickle.loads(blocks.mapInArrow(run, "rounds binary", barrier=True).collect()[0]["rounds"])
    finally:
        files.delete_dir(path)
    return [Boosted(features, edges, m.lane.spec, m.start, trees, dict(fills)) for m, trees in zip(models, rounds)]


def _begun(blocks: DataFrame, lanes: Sequence[Lane], k: int) -> list[_Grown]:
    models = [_Grown(lane, start, bound, n) for lane, (start, bound, n) in zip(lanes, _starts(blocks, lanes, k))]
    for m in models:
        m.done = m.lane.spec.rounds < 1 or m.n <= 1 and m.bound == 0.0
    return models


def _fit(blocks: DataFrame, features: list[str], edges: list, sizes: list[int], lanes: Sequence[Lane], fills: dict, many: bool) -> list[Boosted]:
    classes = [lane.spec.classes for lane in lanes]
    models = _begun(blocks, lanes, len(features))
    # Blocks without scores hold none; each model starts from its own until they are written.
    held, rounds = blocks, 0
    empty = [0] * len(lanes)
    past: list[DataFrame] = []
    while any(not m.done for m in models):
        live = {i: m for i, m in enumerate(models) if not m.done}
        while any(any(m.asked) for m in live.values()):
            busy = {i: m for i, m in live.items() if any(m.asked)}
            hists, notes = _histograms(held, {i: m.task() for i, m in busy.items()}, sizes, empty if held is blocks else classes, many)
            while past:  # the pass has made the scores that follow these
                past.pop().unpersist()
            for i, note in notes.items():
                _take(busy[i], note)
            for (i, c), hist in hists.items():
                if not busy[i].done:
                    _grow(busy[i], c, hist, sizes)
            for m in busy.values():
                m.level += 1
            live = {i: m for i, m in live.items() if not m.done}
        for m in live.values():
            _end_round(m)
        rounds += 1
        if any(not m.done for m in models):
            newer = _advanced(held, models, len(features), empty if held is blocks else classes, rounds % WRITE_EVERY == 0)
            if held is not blocks:
                past.append(held)
            held = newer
            for m in models:
                if not m.done:
                    m.begin()
    for old in [*past, *([] if held is blocks else [held])]:
        old.unpersist()
    return [Boosted(features, edges, m.lane.spec, m.start, m.rounds, dict(fills)) for m in models]


def fit(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], spec: Spec, **settings) -> Boosted:
    """One model of all rows of ``df``; with patience, a tenth of them, by hash, only checks it."""
    checks = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(spec.seed)), F.lit(10)) == 0
    tagged = df.withColumns({"fold": F.lit(0), "is_test": F.lit(False), "is_validation": checks})
    return fit_all(tagged, features, [label], keys, [Lane(spec, ("all",))], **settings)[0]
