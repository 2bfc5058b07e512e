"""Forests of deep trees on large tables: large nodes are split by passes over all rows, small ones in grouped tasks.

Rows of equal bins are one cell. While rows fall in few cells, whatever their number, trees grow from sums by cell; in all
cases but those of very many columns a cell is scored once for all of its rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, functions as F

from rowsmith.features.base import FittedStep, integer, text
from rowsmith.operators.ranks import column_quantiles
from rowsmith.session import materialise

# A node of at most so many drawn rows, and values in them, is finished in one task.
LOCAL_ROWS, LOCAL_VALUES = 1 << 17, 1 << 22
# Cells of statistics that a pass or a task holds at once.
CELLS = 1 << 21
# Possible cells times sums of a cell up to which the votes of all cells are a table of the model.
GRID = 1 << 16
# Up to so many times the rows of a task it grows a whole tree from cells with rows, times classes.
TREE_CELLS = 8
# Numbers of cells, and of cells and classes, are below this.
CODES = 1 << 62
# Different values, of all columns together, that are counted one by one.
VALUES = 1 << 12
_DRAWN = "tree int, node int, at long, label binary, weight binary, x binary"
_NODES = "tree int, node int, feature binary, cut binary, next binary, value binary, importance binary"
_ROUTED = "tree int, node int, slice int, at long, rid binary, x binary"
_VOTES = "at long, rid binary, class binary, vote binary"
_SUMS = "tree int, at long, cell binary, weight binary, total binary, low binary, high binary"


def column_cuts(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Thresholds of every column of the array ``x``: midpoints if it has at most ``bins`` values, else inner quantiles."""

    most = max(bins, VALUES // width)

    def run(batches):
        seen = [(np.zeros(0), np.zeros(0, np.int64))] * width
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            seen = [s if len(s[0]) > most else _added(*s, x[:, j]) for j, s in enumerate(seen)]
        # A column of more values is only marked.
        seen = [s if len(s[0]) <= most else (np.array([np.nan]), np.array([0])) for s in seen]
        j = np.repeat(np.arange(width), [len(v) for v, _ in seen])
        yield pa.RecordBatch.from_arrays([pa.array(j), *(pa.array(np.concatenate(v)) for v in zip(*seen))], names=["j", "v", "n"])

    counted = rows.select("x").mapInArrow(run, "j long, v double, n long").groupBy("j", "v").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "values")
    few = counted.groupBy("j").agg(F.count("v").alias("k"), F.min("n").alias("n")).where(f"k <= {most} and n > 0").select("j")
    found = counted.join(few, "j").toArrow().sort_by([("j", "ascending"), ("v", "ascending")])
    j, v, n = (found[c].to_numpy() for c in ("j", "v", "n"))
    many = [f"x{i}" for i in range(width) if i not in set(j.tolist())]
    probs = [i / bins for i in range(1, bins)]
    cuts = column_quantiles(rows.select(*[F.get("x", int(c[1:])).alias(c) for c in many]), many, probs) if many else {}
    return [np.unique(cuts[f"x{i}"]) if f"x{i}" in cuts else _counted_cuts(v[j == i], n[j == i], bins, probs) for i in range(width)]


def _added(values: np.ndarray, n: np.ndarray, more: np.ndarray):
    new, times = np.unique(more, return_counts=True)
    values, place = np.unique(np.concatenate([values, new]), return_inverse=True)
    return values, np.bincount(place, np.concatenate([n, times])).astype(np.int64)


def _counted_cuts(values: np.ndarray, n: np.ndarray, bins: int, probs) -> np.ndarray:
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    ends = np.cumsum(n)
    at = (ends[-1] - 1) * np.array(probs)
    low, high = (values[np.searchsorted(ends, f(at), "right")] for f in (np.floor, np.ceil))
    return np.unique(low + (high - low) * (at - np.floor(at)))


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _bytes_matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _binned(x: np.ndarray, cuts) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _stored_bins(rows: DataFrame, cuts) -> DataFrame:
    """A byte a value, beside the row number and the label."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _binned(_matrix(batch.column("x"), len(cuts)), cuts)
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], names=["rid", "label", "x"])

    return materialise(_spread(rows.select("rid", "label", "x")).mapInArrow(run, "rid long, label double, x binary"), "bins")


def _spread(rows: DataFrame) -> DataFrame:
    """The rows over all cores, whatever their files; the same rows in the same order in every run."""
    return rows.repartition(_tasks(rows), "rid").sortWithinPartitions("rid")


def _tasks(rows: DataFrame) -> int:
    return 2 * rows.sparkSession.sparkContext.defaultParallelism


def _possible(cuts) -> int:
    """How many cells there can be."""
    return math.prod(len(c) + 1 for c in cuts)


def _cell(x: np.ndarray, cuts) -> np.ndarray:
    """The number of the cell of every row: its bins, read as one number."""
    return np.ravel_multi_index(tuple(_binned(x, cuts).T), [len(c) + 1 for c in cuts]).astype(np.int64)


def _bins_of(cell: np.ndarray, cuts) -> np.ndarray:
    return np.stack(np.unravel_index(cell, [len(c) + 1 for c in cuts]), axis=1).astype(np.uint8)


def _stored_cells(rows: DataFrame, cuts, n: int) -> tuple[DataFrame, DataFrame]:
    """Row number, label and cell, and the cells there are; the rows of a cell lie together, those of a large one in several tasks."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("label"), pa.array(_cell(_matrix(batch.column("x"), len(cuts)), cuts))], names=["rid", "label", "cell"])

    found = materialise(rows.mapInArrow(run, "rid long, label double, cell long"), "cells")
    pieces = F.ceil(F.count(F.lit(1)) / F.lit(max(1.0, n / (8 * _tasks(rows))))).alias("pieces")
    sizes = materialise(found.groupBy("cell").agg(pieces), "sizes")
    large = materialise(sizes.where("pieces > 1"), "large")  # no more than pieces there are
    dealt = found.join(large, "cell", "left").repartition(_tasks(rows), "cell", F.expr("rid % coalesce(pieces, 1)"))
    return dealt.sortWithinPartitions("cell", "rid").select("rid", "label", "cell"), sizes


def draws(rid: np.ndarray, trees: int, seed: int, rate: float, replace: bool) -> np.ndarray:
    """How often each tree draws each row: Poisson numbers from a hash of row, tree and seed."""
    if not replace and rate >= 1:
        return np.ones((trees, len(rid)), np.uint8)
    with np.errstate(over="ignore"):
        keys = np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed & (2**64 - 1))
        h = _mixed(_mixed(rid.astype(np.uint64))[None, :] ^ _mixed(keys)[:, None])
    u = (h >> np.uint64(11)).astype(np.float64) * 2.0**-53
    if not replace:
        return (u < rate).astype(np.uint8)
    steps = np.cumsum([math.exp(-rate) * rate**i / math.factorial(i) for i in range(24)])
    return np.searchsorted(steps, u, "right").astype(np.uint8)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _walk(x: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The last node of every row; ``at`` holds first nodes, for one tree (rows) or several (trees x rows)."""
    at, row = at.ravel().copy(), np.tile(np.arange(len(x)), at.size // max(len(x), 1))
    live = np.arange(len(at))
    while len(live):
        live = live[feature[at[live]] >= 0]
        here = at[live]
        at[live] = below[here] + (x[row[live], feature[here]] > cut[here])
    return at


def _hist(x, label, w, node, slots, bins: int, classes: int) -> np.ndarray:
    """Sums by (node, slot, bin): weight per class, or weight and weighted label (``classes`` 0)."""
    return _sums(x[np.arange(len(x))[:, None], slots[node]], label, w, node, len(slots), bins, classes)


def _sums(x, label, w, node, n: int, bins: int, classes: int) -> np.ndarray:
    m = x.shape[1]
    cell = (node[:, None] * m + np.arange(m)) * bins + x
    if classes:
        cell = cell * classes + label.astype(np.int64)[:, None]
        return np.bincount(cell.ravel(), np.repeat(w, m), n * m * bins * classes).reshape(n, m, bins, classes)
    sums = [np.bincount(cell.ravel(), np.repeat(v, m), n * m * bins) for v in (w, w * label)]
    return np.stack(sums, axis=-1).reshape(n, m, bins, 2)


def best_splits(hist: np.ndarray, classes: int, least: float):
    """Per node: slot, bin, gain (Gini, or variance) and the sums left and right; gain -inf if no split parts its rows."""
    left = hist.cumsum(axis=2)
    whole = left[:, :1, -1:]
    left = left[:, :, :-1]
    right = whole - left
    weight = (lambda s: s.sum(axis=-1)) if classes else (lambda s: s[..., 0])
    square = (lambda s: (s * s).sum(axis=-1)) if classes else (lambda s: s[..., 1] ** 2)
    a, b, n = weight(left), weight(right), weight(whole)
    fits = (a >= least) & (b >= least) & (a > 0) & (b > 0)
    gain = (square(left) / np.where(fits, a, 1) + square(right) / np.where(fits, b, 1) - square(whole) / n) / n
    gain = np.where(fits, gain, -np.inf).reshape(len(hist), -1)
    at = gain.argmax(axis=1)
    i = np.arange(len(hist))
    slot, edge = np.divmod(at, left.shape[2])
    return slot, edge, gain[i, at], left[i, slot, edge], right[i, slot, edge]


def node_splits(x, label, w, node, slots, bins: int, classes: int, least: float):
    """Slot, bin and gain of the best split of every node, as by all bins. Rows lie in the order of their nodes.

    The bins of a node of few rows are numbered anew without the empty ones, whose sums change nothing.
    """
    x = x[np.arange(len(x))[:, None], slots[node]]
    size = np.bincount(node, minlength=len(slots))
    slot, edge, gain = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64), np.full(len(slots), -np.inf)
    tops = [t for t in (2, 4, 8, 16) if t < bins <= 64]  # the bins of a node are the bits of a number
    for above, top in zip([0, *tops], [*tops, np.inf]):
        some = np.flatnonzero((size > above) & (size <= top))
        if not len(some):
            continue
        rows = np.repeat((size > above) & (size <= top), size)
        of, mine = np.repeat(np.arange(len(some)), size[some]), x[rows]
        if top > bins:
            slot[some], edge[some], gain[some], _, _ = best_splits(_sums(mine, label[rows], w[rows], of, len(some), bins, classes), classes, least)
            continue
        first = np.cumsum(size[some]) - size[some]
        bit = np.uint64(1) << mine.astype(np.uint64)
        rank = np.bitwise_count(np.bitwise_or.reduceat(bit, first, axis=0)[of] & (bit - np.uint64(1)))
        s, e, gain[some], _, _ = best_splits(_sums(rank, label[rows], w[rows], of, len(some), top, classes), classes, least)
        at = np.arange(len(mine)), s[of]
        slot[some], edge[some] = s, np.maximum.reduceat(np.where(rank[at] <= e[of], mine[at], 0), first)
    return slot, edge, gain


def _slots(rng, nodes: int, width: int, m: int) -> np.ndarray:
    if m >= width:
        return np.tile(np.arange(width), (nodes, 1))
    return np.sort(rng.random((nodes, width)).argpartition(m - 1, axis=1)[:, :m], axis=1)


def _pure(sums: np.ndarray, classes: int) -> np.ndarray:
    return (sums > 0).sum(axis=1) < 2 if classes else np.zeros(len(sums), bool)


def grow(x: np.ndarray, label: np.ndarray, w: np.ndarray, depth: int, rng, plan: dict, ends=None):
    """The tree below a node from its drawn rows, level by level: feature (-1: leaf), cut, first child or leaf number,
    leaf sums, importance by column. ``ends``: smallest and largest label, where a row stands for all of its cell."""
    classes, bins, width, m = plan["classes"], plan["bins"], plan["width"], plan["m"]
    w = w.astype(np.float64)
    middle = 0.0 if classes or not len(label) else float(np.average(label, weights=w))
    label = label - middle
    low, high = ends or (label, label)
    if not classes and not ends and bins**width < 2**62:  # rows of equal bins are one row
        code, first, place = np.unique(x @ (np.int64(bins) ** np.arange(width)), return_index=True, return_inverse=True)
        order = np.argsort(place, kind="stable")
        begin = np.flatnonzero(np.diff(place[order], prepend=-1))
        low, high = np.minimum.reduceat(label[order], begin), np.maximum.reduceat(label[order], begin)
        mass = np.bincount(place, w)
        x, label, w = x[first], np.bincount(place, w * label) / mass, mass
    node = np.zeros(len(x), np.int64)
    count, offset = 1, 0
    levels, importance = [], np.zeros(width)
    while count:
        if classes:
            sums = np.bincount(node * classes + label.astype(np.int64), w, count * classes).reshape(count, classes)
        else:
            sums = np.stack([np.bincount(node, v, count) for v in (w, w * label)], axis=1)
        feature, cut, below = np.full(count, -1, np.int32), np.zeros(count, np.uint8), np.zeros(count, np.int32)
        gained = np.zeros(count)
        size = np.bincount(node, minlength=count)
        start = np.concatenate([[0], np.cumsum(size)])
        todo = (size > 1) & ~_pure(sums, classes)
        if not classes and len(x):
            todo &= np.maximum.reduceat(high, start[:-1]) > np.minimum.reduceat(low, start[:-1])
        todo = np.flatnonzero(todo) if depth < plan["depth"] else np.zeros(0, np.int64)
        cost = np.cumsum(np.maximum(m * bins * sums.shape[1], size[todo] * m))
        for part in np.split(todo, np.flatnonzero(np.diff(cost // CELLS)) + 1) if len(todo) else ():
            slots = _slots(rng, len(part), width, m)
            place = np.full(count, -1)
            place[part] = np.arange(len(part))
            # Rows lie in the order of their nodes.
            rows = np.arange(start[part[0]], start[part[-1] + 1])
            rows = rows[place[node[rows]] >= 0]
            slot, edge, gain = node_splits(x[rows], label[rows], w[rows], place[node[rows]], slots, bins, classes, plan["least"])
            total = sums[part].sum(axis=1) if classes else sums[part, 0]
            good = (gain > 1e-12 * plan["scale"]) & (gain >= plan["gain"])
            feature[part[good]] = slots[np.arange(len(part)), slot][good]
            cut[part[good]] = edge[good]
            gained[part[good]] = (gain * total)[good]
        split = feature >= 0
        below[split] = offset + count + 2 * np.arange(split.sum())
        levels.append((offset, feature, cut, below, sums, gained))
        kept = split[node]
        x, label, w, node, low, high = (v[kept] for v in (x, label, w, node, low, high))
        node = below[node] - offset - count + (x[np.arange(len(x)), feature[node]] > cut[node])
        order = np.argsort(node, kind="stable")
        x, label, w, node, low, high = (v[order] for v in (x, label, w, node.astype(np.int64), low, high))
        offset, count, depth = offset + count, 2 * int(split.sum()), depth + 1
    feature, cut, below, sums, gained = (np.concatenate([v[i] for v in levels]) for i in range(1, 6))
    if classes:  # as Spark's trees: two leaves that say the same class become one
        said = sums.argmax(axis=1)
        for first, f, *_ in reversed(levels):
            at = first + np.flatnonzero(f >= 0)
            a = below[at]
            at = at[(feature[a] < 0) & (feature[a + 1] < 0) & (said[a] == said[a + 1])]
            feature[at], gained[at] = -1, 0
    np.add.at(importance, feature[feature >= 0], gained[feature >= 0])
    leaf = feature < 0
    below[leaf] = np.arange(leaf.sum())
    value = sums[leaf].astype(np.float32) if classes else sums[leaf, 1] / sums[leaf, 0] + middle
    return feature, cut, below, value, importance


class _Top:
    """Nodes of all trees that are split by passes; the first ones are the roots. ``small`` nodes are left to tasks."""

    def __init__(self, plan: dict, rows: int):
        trees = plan["trees"]
        self.plan = plan
        self.tree, self.depth = np.arange(trees), np.zeros(trees, np.int64)
        self.feature, self.cut, self.below = np.full(trees, -1), np.zeros(trees, np.int64), np.zeros(trees, np.int64)
        self.value = np.zeros((trees, max(plan["classes"], 2)))
        self.large = np.arange(trees) if rows > plan["local"] else np.zeros(0, np.int64)
        self.small = np.full(trees, rows <= plan["local"])

    def place(self, rows: DataFrame) -> np.ndarray:
        """Split the large nodes; returns importance by tree and column."""
        plan = self.plan
        importance = np.zeros((plan["trees"], plan["width"]))
        step = max(1, CELLS // (plan["m"] * plan["bins"] * max(plan["classes"], 2)))
        while len(self.large):
            large, self.large = self.large, np.zeros(0, np.int64)
            for i in range(0, len(large), step):
                self._pass(rows, large[i : i + step], importance)
        return importance

    def _pass(self, rows: DataFrame, nodes: np.ndarray, importance: np.ndarray) -> None:
        plan, routes = self.plan, self.routes()
        slots = np.concatenate([_slots(np.random.default_rng([plan["seed"], 1, int(n)]), 1, plan["width"], plan["m"]) for n in nodes])
        place = np.full(len(self.tree), -1)
        place[nodes] = np.arange(len(nodes))

        def count(batches):
            total = None
            for rid, label, x, w in _drawn(batches, plan):
                at = place[_walk(x, np.repeat(np.arange(plan["trees"])[:, None], len(x), axis=1), *routes)]
                w, label = w.ravel(), label - plan["middle"]
                pairs = np.flatnonzero((at >= 0) & (w > 0))
                for some in np.array_split(pairs, 1 + len(pairs) * plan["m"] // CELLS):
                    i = some % len(x)
                    h = _hist(x[i], label[i], w[some].astype(np.float64), at[some], slots, plan["bins"], plan["classes"])
                    total = h if total is None else total + h
            for i, n in enumerate(nodes if total is not None else ()):
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total[i].tobytes()], pa.binary())], names=["node", "sums"])

        kinds = max(plan["classes"], 2)

        def choose(table):
            h = sum(np.frombuffer(v.as_buffer(), np.float64) for v in table["sums"].combine_chunks()).reshape(1, plan["m"], plan["bins"], kinds)
            slot, edge, gain, left, right = (v[0] for v in best_splits(h, plan["classes"], plan["least"]))
            return pa.table({"node": table["node"][:1], "slot": [int(slot)], "cut": [int(edge)], "gain": [float(gain)], "left": [left.tolist()], "right": [right.tolist()]})

        chosen = rows.mapInArrow(count, "node long, sums binary").groupBy("node").applyInArrow(
            choose, "node long, slot long, cut long, gain double, left array<double>, right array<double>").collect()
        for r in sorted(chosen, key=lambda r: r["node"]):
            n, sides = r["node"], np.array([r["left"], r["right"]])
            self.value[n] = sides.sum(axis=0)
            pure = plan["classes"] and (self.value[n] > 0).sum() < 2
            if pure or not (r["gain"] > 1e-12 * plan["scale"] and r["gain"] >= plan["gain"]):
                continue
            size = sides.sum(axis=1) if plan["classes"] else sides[:, 0]
            self.feature[n], self.cut[n], self.below[n] = slots[place[n], r["slot"]], r["cut"], len(self.tree)
            importance[self.tree[n], self.feature[n]] += r["gain"] * size.sum()
            deep = self.depth[n] + 1
            last = deep >= plan["depth"]
            tall = size > plan["local"]
            new = len(self.tree) + np.arange(2)
            self.tree, self.depth = np.append(self.tree, [self.tree[n]] * 2), np.append(self.depth, [deep] * 2)
            self.feature, self.cut, self.below = np.append(self.feature, [-1, -1]), np.append(self.cut, [0, 0]), np.append(self.below, [0, 0])
            self.value = np.concatenate([self.value, sides])
            self.small = np.append(self.small, ~tall & (not last))
            self.large = np.append(self.large, new[tall & (not last)])

    def routes(self):
        return self.feature.copy(), self.cut.copy(), self.below.copy()


def _drawn(batches, plan: dict):
    for batch in batches:
        if batch.num_rows:
            rid, label = batch.column("rid").to_numpy(), batch.column("label").to_numpy()
            w = draws(rid, plan["trees"], plan["seed"], plan["rate"], plan["bootstrap"])
            yield rid, label, _bytes_matrix(batch.column("x"), plan["width"]), w


def _runs(at: np.ndarray):
    """(node, places) of every node in ``at``."""
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(order))):
        yield int(at[order[a]]), order[a:b]


def _finish(rows: DataFrame, top: _Top) -> DataFrame:
    """The trees below the small nodes, each grown from its drawn rows by one task."""
    plan, routes, tree, small, depth = top.plan, top.routes(), top.tree.copy(), top.small.copy(), top.depth.copy()

    def deal(batches):
        for rid, label, x, w in _drawn(batches, plan):
            at = _walk(x, np.repeat(np.arange(plan["trees"])[:, None], len(x), axis=1), *routes)
            w = w.ravel()
            pairs = np.flatnonzero(small[at] & (w > 0))
            out = []
            for n, some in _runs(at[pairs]):
                some = pairs[some]
                i = some % len(x)
                out.append((int(tree[n]), n, int(rid[0]), label[i].tobytes(), w[some].tobytes(), x[i].tobytes()))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("tree", "node", "at", "label", "weight", "x"), map(list, zip(*out)))), schema=pa.schema(
                    [("tree", pa.int32()), ("node", pa.int32()), ("at", pa.int64()), ("label", pa.binary()), ("weight", pa.binary()), ("x", pa.binary())]))

    def finish(table):
        table = table.sort_by("at")
        label, w, x = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("label", np.float64), ("weight", np.uint8), ("x", np.uint8)))
        n = table["node"][0].as_py()
        made = grow(x.reshape(len(w), plan["width"]), label, w, int(depth[n]), np.random.default_rng([plan["seed"], 2, n]), plan)
        return pa.table({"tree": table["tree"][:1], "node": table["node"][:1], **{
            c: pa.array([v.tobytes()], pa.binary()) for c, v in zip(("feature", "cut", "next", "value", "importance"), made)}})

    return materialise(rows.mapInArrow(deal, _DRAWN).groupBy("tree", "node").applyInArrow(finish, _NODES), "nodes")


def _finish_cells(rows: DataFrame, cuts, plan: dict) -> DataFrame:
    """All trees, each grown by one task from the sums of its drawn rows by cell."""
    trees, classes = plan["trees"], plan["classes"]

    def add(batches):
        for batch in batches:
            step = max(1, CELLS // trees)
            for some in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                rid, label, cell = (some.column(c).to_numpy() for c in ("rid", "label", "cell"))
                key = cell * max(classes, 1) + (label.astype(np.int64) if classes else 0)
                order = np.argsort(key, kind="stable")
                rid, label, key = rid[order], label[order], key[order]
                w = draws(rid, trees, plan["seed"], plan["rate"], plan["bootstrap"])
                first = np.flatnonzero(np.diff(key, prepend=-1))
                mass = np.add.reduceat(w, first, axis=1, dtype=np.float64)
                if not classes:
                    total = np.add.reduceat(w * label, first, axis=1)
                    low = np.minimum.reduceat(np.where(w > 0, label, np.inf), first, axis=1)
                    high = np.maximum.reduceat(np.where(w > 0, label, -np.inf), first, axis=1)
                key, out = key[first], []
                for t in np.flatnonzero(mass.any(axis=1)):
                    at = mass[t] > 0
                    more = (b"", b"", b"") if classes else (v[t, at].tobytes() for v in (total, low, high))
                    out.append((int(t), int(rid.min()), key[at].tobytes(), mass[t, at].tobytes(), *more))
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(("tree", "at", "cell", "weight", "total", "low", "high"), map(list, zip(*out)))), schema=pa.schema(
                        [("tree", pa.int32()), ("at", pa.int64()), *((c, pa.binary()) for c in ("cell", "weight", "total", "low", "high"))]))

    def finish(table):
        table = table.sort_by("at")
        key, w, total, low, high = (
            np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in zip(("cell", "weight", "total", "low", "high"), (np.int64, *[np.float64] * 4)))
        order = np.argsort(key, kind="stable")  # a large cell comes in several parts
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        cell, label = np.divmod(key[order][first], max(classes, 1))
        w, ends = np.add.reduceat(w[order], first), None
        if not classes:
            label = np.add.reduceat(total[order], first) / w
            ends = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
        x = _bins_of(cell, cuts)
        t = table["tree"][0].as_py()
        made = grow(x, label.astype(np.float64), w, 0, np.random.default_rng([plan["seed"], 2, t]), plan, ends)
        return pa.table({"tree": table["tree"][:1], "node": table["tree"][:1], **{
            c: pa.array([v.tobytes()], pa.binary()) for c, v in zip(("feature", "cut", "next", "value", "importance"), made)}})

    # Trees take long and their sums are small: a task has about one.
    return materialise(rows.mapInArrow(add, _SUMS).repartition(trees, "tree").groupBy("tree").applyInArrow(finish, _NODES), "nodes")


def _cell_votes(nodes: DataFrame, cuts, plan: dict) -> DataFrame:
    """The votes of all trees for every cell there can be."""
    classes, kinds, cells = plan["classes"], max(plan["classes"], 1), _possible(cuts)
    step = max(1, CELLS // (8 * plan["trees"] * kinds))

    def say(batches):
        x = _bins_of(np.arange(cells), cuts)
        for batch in batches:
            for node in batch.to_pylist():
                *route, value = _grown_node(node, classes)
                vote = _share(value[_last(x, *route)], classes)
                at = range(0, cells, step)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([vote[i : i + step].tobytes() for i in at], pa.binary())], names=["at", "vote"])

    def total(table):
        votes = np.stack([np.frombuffer(v, np.float64) for v in table["vote"].to_pylist()])
        sums = np.sort(votes, axis=0).sum(axis=0)  # sums do not depend on the order of arrival
        at = table["at"][0].as_py() + np.arange(len(sums) // kinds)
        return pa.table({"__cell": at, "__votes": pa.FixedSizeListArray.from_arrays(pa.array(sums), kinds).cast(pa.list_(pa.float64()))})

    votes = nodes.drop("importance").mapInArrow(say, "at long, vote binary").groupBy("at")
    return materialise(votes.applyInArrow(total, "__cell long, __votes array<double>"), "votes")


def _grown_node(node: dict, classes: int):
    """Feature, cut, first child or leaf number, and leaf values of a stored row of ``_NODES``."""
    value = np.frombuffer(node["value"], np.float32).reshape(-1, classes).astype(np.float64) if classes else np.frombuffer(node["value"], np.float64)
    return *(np.frombuffer(node[c], t) for c, t in (("feature", np.int32), ("cut", np.uint8), ("next", np.int32))), value


def _last(x: np.ndarray, feature, cut, below) -> np.ndarray:
    """The leaf number of every row in the tree below a node."""
    return below[_walk(x, np.zeros(len(x), np.int64), feature, cut, below)]


def _share(value: np.ndarray, classes: int) -> np.ndarray:
    return value / value.sum(axis=1, keepdims=True) if classes else value


def fit_forest(df: DataFrame, names: dict, plan: dict) -> "GrownForest":
    """``plan``: trees, depth, bins, m (columns a node looks at), width, classes (0: regression), least (rows a child has),
    gain, rate, bootstrap, seed, rows; ``names``: the columns read and made."""
    x, label = vector_to_array(F.col(names["featuresCol"])), F.col(names["labelCol"]).cast("double")
    rows = materialise(df.select(F.monotonically_increasing_id().alias("rid"), label.alias("label"), x.alias("x")), "rows")
    mid = rows.agg(F.avg("label"), F.var_pop("label")).first()
    plan = plan | {"middle": 0.0 if plan["classes"] else mid[0], "scale": 1.0 if plan["classes"] else mid[1],
                   "local": max(2, min(LOCAL_ROWS, LOCAL_VALUES // plan["width"]))}
    cuts = column_cuts(rows, plan["width"], plan["bins"])
    few = _possible(cuts) * max(plan["classes"], 2) <= GRID
    by_cell = _possible(cuts) * max(plan["classes"], 1) < CODES
    if by_cell:
        binned, cells = _stored_cells(rows, cuts, plan["rows"])
        by_cell = few or cells.count() * max(plan["classes"], 1) <= TREE_CELLS * plan["local"]
    if not by_cell:
        binned = _stored_bins(rows, cuts)
    top = _Top(plan, 0 if by_cell else plan["rows"])  # sums by cell leave no node too large for a task
    importance = top.place(binned)
    nodes = _finish_cells(binned, cuts, plan) if by_cell else _finish(binned, top)
    for r in nodes.select("tree", "importance").toLocalIterator():
        importance[r["tree"]] += np.frombuffer(r["importance"], np.float64)
    share = importance.sum(axis=1, keepdims=True)
    total = (importance / np.where(share > 0, share, 1)).sum(axis=0)
    value = top.value if plan["classes"] else top.value[:, 1] / np.maximum(top.value[:, 0], 1e-300) + plan["middle"]
    model = GrownForest(**names)
    model.state = {
        "trees": plan["trees"], "classes": plan["classes"], "rows": plan["rows"], "cuts": [c.tolist() for c in cuts],
        "importance": (total / (total.sum() or 1)).tolist(), "top": {
            "feature": top.feature.tolist(), "cut": top.cut.tolist(), "below": top.below.tolist(), "small": top.small.tolist(),
            "tree": top.tree.tolist(), "value": value.tolist()}}
    model.tables = {"nodes": nodes} | ({"votes": _cell_votes(nodes, cuts, plan)} if few else {})
    return model


class GrownForest(FittedStep):
    """Large nodes are state, the trees below them a table. Cells travel to the trees below, their votes travel back, and
    rows join the votes of their cell; with very many columns rows travel.

    With few possible cells the votes for each are a table of the model.
    """

    featuresCol = text("featuresCol")
    labelCol = text("labelCol")
    predictionCol = text("predictionCol")
    probabilityCol = text("probabilityCol")
    rawPredictionCol = text("rawPredictionCol")
    numTrees = integer("numTrees")
    defaults = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction"}

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.state["importance"])

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        classes, trees = s["classes"], s["trees"]
        x = vector_to_array(F.col(self.value("featuresCol")))
        # Rows without features have no votes and keep nulls.
        if "votes" in self.tables:
            base, votes = df.withColumn("__at", self._cells(x)), self.tables["votes"]
            out = base.join(votes, base["__at"] == votes["__cell"], "left").drop("__at", "__cell")
        elif math.prod(len(c) + 1 for c in s["cuts"]) < CODES:
            base = materialise(df.withColumn("__rid", self._cells(x)), "rows")
            cells = materialise(base.select(F.col("__rid").alias("rid")).distinct(), "cells")
            votes = self._votes(_spread(cells))
            out = base.join(votes, base["__rid"] == votes["rid"], "left").drop("__rid", "rid")
        else:
            base = materialise(df.withColumn("__rid", F.monotonically_increasing_id()), "rows")
            votes = self._votes(_spread(base.select(F.col("__rid").alias("rid"), x.alias("x")).where("x is not null")))
            out = base.join(votes, base["__rid"] == votes["rid"], "left").drop("__rid", "rid")
        if not classes:
            return out.withColumn(self.value("predictionCol"), F.get("__votes", 0) / F.lit(float(trees))).drop("__votes")
        share = F.transform("__votes", lambda v: v / F.lit(float(trees)))
        best = (F.array_position("__votes", F.array_max("__votes")) - 1).cast("double")
        return out.withColumns({self.value("rawPredictionCol"): array_to_vector("__votes"), self.value("probabilityCol"): array_to_vector(share),
                                self.value("predictionCol"): best}).drop("__votes")

    def _cells(self, x):
        cuts = [np.array(c) for c in self.state["cuts"]]

        @F.arrow_udf("long")
        def cell(x: pa.Array) -> pa.Array:
            return pa.array(_cell(_matrix(x, len(cuts)), cuts))

        return cell(x)

    def _votes(self, rows: DataFrame) -> DataFrame:
        """Votes by ``rid``: row number, beside the array ``x``, or cell."""
        s = self.state
        classes, trees, cuts, width = s["classes"], s["trees"], [np.array(c) for c in s["cuts"]], len(s["cuts"])
        top = {k: np.array(v) for k, v in s["top"].items()}
        routes = top["feature"], top["cut"], top["below"]
        # Tables larger than the fitted one are dealt into slices, so that no task meets more rows than a fit does.
        slices = 1 + rows.count() // (4 * s["rows"])
        kinds = max(classes, 1)

        def walked(batches):
            for batch in batches:
                if batch.num_rows:
                    rid = batch.column("rid").to_numpy()
                    x = _binned(_matrix(batch.column("x"), width), cuts) if batch.num_columns > 1 else _bins_of(rid, cuts)
                    yield rid, x, _walk(x, np.repeat(np.arange(trees)[:, None], len(x), axis=1), *routes)

        def deal(batches):
            for rid, x, at in walked(batches):
                pairs = np.flatnonzero(top["small"][at])
                out = []
                for n, some in _runs(at[pairs]):
                    i = pairs[some] % len(x)
                    out.append((int(top["tree"][n]), n, int(rid[0] % slices), int(rid[0]), rid[i].tobytes(), x[i].tobytes()))
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(("tree", "node", "slice", "at", "rid", "x"), map(list, zip(*out)))), schema=pa.schema(
                        [("tree", pa.int32()), ("node", pa.int32()), ("slice", pa.int32()), ("at", pa.int64()), ("rid", pa.binary()), ("x", pa.binary())]))

        def said(rid, value):
            """Row numbers, classes and votes of leaf values, without zeros."""
            if not classes:
                return rid, np.zeros(len(rid), np.int16), value
            value = _share(value, classes)
            i, c = np.nonzero(value)
            return rid[i], c.astype(np.int16), value[i, c]

        def packed(out):
            return pa.table({"at": pa.array([o[0] for o in out], pa.int64()), **{
                c: pa.array([o[1][k].tobytes() for o in out], pa.binary()) for k, c in enumerate(("rid", "class", "vote"))}})

        def settled(batches):  # rows that end in a leaf above the small nodes
            for rid, x, at in walked(batches):
                pairs = np.flatnonzero(~top["small"][at])
                if len(pairs):
                    yield from packed([(int(rid[0]), said(rid[pairs % len(x)], top["value"][at[pairs]].astype(np.float64)))]).to_batches()

        def vote(left, right):
            if not left.num_rows:
                return packed([])
            *route, value = _grown_node(right.slice(0, 1).to_pylist()[0], classes)
            out = []
            for r in left.select(["at", "rid", "x"]).to_pylist():
                x = np.frombuffer(r["x"], np.uint8).reshape(-1, width)
                out.append((r["at"], said(np.frombuffer(r["rid"], np.int64), value[_last(x, *route)])))
            return packed(out)

        def total(table):
            rid, kind, v = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("rid", np.int64), ("class", np.int16), ("vote", np.float64)))
            order = np.lexsort((v, kind, rid))  # sums do not depend on the order of arrival
            some, place = np.unique(rid[order], return_inverse=True)
            sums = np.bincount(place * kinds + kind[order], v[order], len(some) * kinds)
            return pa.table({"rid": some, "__votes": pa.FixedSizeListArray.from_arrays(pa.array(sums), kinds).cast(pa.list_(pa.float64()))})

        key = ["tree", "node", "slice"]
        below = self.tables["nodes"].drop("importance").withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(int(slices) - 1))))
        votes = rows.mapInArrow(deal, _ROUTED).groupBy(*key).cogroup(below.groupBy(*key)).applyInArrow(vote, _VOTES)
        if (~top["small"] & (top["feature"] < 0)).any():
            votes = votes.union(rows.mapInArrow(settled, _VOTES))
        return votes.groupBy("at").applyInArrow(total, "rid long, __votes array<double>")
