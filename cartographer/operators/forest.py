"""Decision trees and forests whose nodes need not fit the driver or one pass.

Features are binned once into at most 32 bins. The upper part of every tree is split level by
level from class counts that Spark gathers over all rows. A node of few enough rows
(``local_rows``) is finished in one go: its rows are shuffled to a group of their own, and the
subtree stays a row of a table. To score, rows go down the upper part and meet the subtree they
lead to in a join. The driver holds the upper parts only; no tree and no node grows with a task.

As in ``pyspark.ml``: Poisson(1) bags, sqrt(features) per node of a forest and all of them for a
single tree, Gini gain, at most 32 bins, probabilities averaged over the trees.
"""

from __future__ import annotations

import json
import math
import os
import threading
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, release

BINS = 32
#: Bytes of binned features that a task unpacks at once, and most rows, and cells of chosen features, of a node that is finished in one group.
BLOCK_BYTES, BLOCK_ROWS, LOCAL_ROWS, LOCAL_CELLS = 64 << 20, 50_000, 4_000_000, 24_000_000
#: A node below this many rows is always finished in one group; groups aimed at per core, and tasks they are spread over.
LEAST_LOCAL_ROWS, GROUPS_A_CORE, TASKS_A_CORE = 20_000, 8, 32
#: Bytes of rows dealt out to nodes at once, about; and up to which fits deal theirs out beside each other.
DEALT_BYTES, BESIDE_BYTES = 4 << 30, 512 << 20
#: Subtrees of all models together that are sent to every task to score, instead of the rows to them.
SHARED_BYTES = 64 << 20
#: Scored rows that meet a subtree in one group, some more or less.
GROUP_ROWS = 1_000_000
#: Points that describe a feature's values in one block.
SKETCH = 256
#: Cells of chosen features looked at together.
CELLS = 1 << 22
#: Rows counted together; cells of a node for each of its entries up to which empty ones are kept as well; most chosen features, and features
#: for each of them, of rows that are moved to their nodes.
ROWS, DENSE, PLACES, MOVED = 1 << 14, 4, 64, 8
#: Rows from which a node is counted by itself, and cells of the features counted together then.
LARGE, TOGETHER = 1_500, 512
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODEC = "zstd"
#: Least gain of a split, next to rounding.
LEAST_GAIN = 1e-12


def _importable(spark: SparkSession) -> None:
    """Workers get this package's folder on their path, for sessions that were started elsewhere."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


def _pack(x: np.ndarray) -> bytes:
    return pa.Codec(CODEC, compression_level=1).compress(np.ascontiguousarray(x).tobytes(), asbytes=True)


def _unpack(b: bytes, dtype, *shape: int) -> np.ndarray:
    size = int(np.prod(shape)) * np.dtype(dtype).itemsize
    return np.frombuffer(pa.Codec(CODEC).decompress(b, size, asbytes=True), dtype).reshape(shape)


# --- features and bins ---------------------------------------------------------

def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the stored entries of a vector column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    kinds, values, indices = (column.field(i) for i in (0, 3, 2))
    dense = np.asarray(kinds) == 1
    counts = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(column)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    feature = np.arange(len(row)) - first
    feature[~dense[row]] = indices.flatten().to_numpy(zero_copy_only=False)
    return row, feature, values.flatten().to_numpy(zero_copy_only=False)


def _dense(column: pa.Array) -> np.ndarray | None:
    """Rows x features of a vector column, if all its vectors are dense and of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    kinds, values = column.field(0), column.field(3)
    if column.null_count or not len(column) or not (np.asarray(kinds) == 1).all():
        return None
    size = values.value_lengths().to_numpy(zero_copy_only=False)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if (size == size[0]).all() and size[0] else None


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, values, counts) of a block: all values of a feature, or ``SKETCH`` evenly spaced ones; feature -1 counts the rows."""
    for b in _gathered(batches, BLOCK_ROWS):
        if (all_ := _dense(b.column(0))) is not None:
            stretches = enumerate(np.sort(all_.T, axis=1))
        else:
            _, feature, value = _entries(b.column(0))
            order = np.lexsort((value, feature))
            stretches = zip(*_runs(feature[order], value[order]), strict=True)
        out = [(-1, np.zeros(1), np.full(1, float(b.num_rows)))]
        for f, v in stretches:
            u, n = np.unique(v, return_counts=True)
            if len(u) > SKETCH:
                ends = np.linspace(0, len(v), SKETCH + 1).astype(int)[1:]
                u, n = v[ends - 1], np.diff(ends, prepend=0)
            out.append((int(f), u, n.astype(float)))
        yield pa.record_batch([pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[i].tobytes() for o in out], pa.binary()) for i in (1, 2)]],
                              names=["feature", "value", "n"])


def _runs(key: np.ndarray, *others: np.ndarray):
    """Distinct values of a sorted key and the stretches of the others that belong to them."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    return (key[starts], *[np.split(o, starts[1:]) if len(key) else [] for o in others])


def _cuts(value: np.ndarray, n: np.ndarray, rows: float) -> np.ndarray:
    """At most ``BINS - 1`` thresholds: between all values if there are few, else at even shares of the rows."""
    if rows > n.sum():  # entries that are not stored are zeros
        value, n = np.r_[value, 0.0], np.r_[n, rows - n.sum()]
    keep = ~np.isnan(value)
    value, at = np.unique(value[keep], return_inverse=True)
    n = np.bincount(at, n[keep], len(value)) if len(value) else n[:0]
    middle = (value[1:] + value[:-1]) / 2
    middle = np.where(middle < value[1:], middle, value[:-1])
    if len(middle) < BINS:
        return middle
    share, places, last = np.cumsum(n)[:-1], [], 0.0
    for _ in range(BINS - 1):  # a value with more than its share takes one place; the rest is shared evenly
        target = last + (n.sum() - last) / (BINS - len(places))
        i = int(np.searchsorted(share, target))
        i = i - 1 if i and (i >= len(share) or target - share[i - 1] < share[i] - target) and share[i - 1] > last else i
        if i >= len(share):
            break
        places.append(i)
        last = share[i]
    return middle[places]


def thresholds(df: DataFrame, features: str, size: int) -> list[np.ndarray]:
    """Cuts of every feature, from all rows. A block is described by ``SKETCH`` points a feature at most."""
    parts = df.select(features).mapInArrow(_sketch, "feature int, value binary, n binary")
    parts = cut_lineage(parts)
    total = sum(np.frombuffer(r.n)[0] for r in parts.where("feature < 0").select("n").toLocalIterator())

    def cuts(key, table):
        value, n = (np.concatenate([np.frombuffer(x) for x in table.column(c).to_pylist()]) for c in ("value", "n"))
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "cuts": [_cuts(value, n, total).tobytes()]})

    found = {r.feature: np.frombuffer(r.cuts) for r in parts.where("feature >= 0").groupBy("feature").applyInArrow(cuts, "feature int, cuts binary").collect()}
    return [found.get(f, np.zeros(0)) for f in range(size)]


def _binned(column: pa.Array, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Rows x features: the number of cuts below each value."""
    if (all_ := _dense(column)) is not None:
        return np.column_stack([np.searchsorted(c, v).astype(np.uint8) for c, v in zip(cuts, all_.T.copy(), strict=True)])
    row, feature, value = _entries(column)
    zero = np.array([np.searchsorted(c, 0.0) for c in cuts], np.uint8)
    x = np.empty((len(column), len(cuts)), np.uint8)
    x[:] = zero
    order = np.argsort(feature, kind="stable")
    for f, r, v in zip(*_runs(feature[order], row[order], value[order]), strict=True):
        x[r, f] = np.searchsorted(cuts[f], v)
    return x


def _block_rows(size: int) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(size, 1)))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together or cut to ``rows`` rows at most."""
    held, n = [], 0
    for b in batches:
        for at in range(0, b.num_rows, rows):
            part = b.slice(at, rows)
            if n + part.num_rows > rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield pa.Table.from_batches(held)


def blocks(df: DataFrame, features: str, labels: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """(block, n, y, x): binned rows and one label (a class number) per entry of the array ``labels``, written once."""
    def run(batches):
        for t in _gathered(batches, _block_rows(len(cuts))):
            y = np.array(t.column(1).combine_chunks().flatten(), np.uint8)
            yield pa.record_batch([pa.array([t.num_rows], pa.int32()), pa.array([_pack(y)], pa.binary()),
                                   pa.array([_pack(_binned(t.column(0), cuts))], pa.binary())], names=["n", "y", "x"])

    rows = df.select(features, labels).mapInArrow(run, "n int, y binary, x binary")
    return cut_lineage(rows.select(F.monotonically_increasing_id().alias("block"), "*"))


# --- splits --------------------------------------------------------------------

def _subsets(rng: np.random.Generator, nodes: int, size: int, m: int) -> np.ndarray:
    """m different features for each node, in ascending order."""
    if m >= size:
        return np.broadcast_to(np.arange(size), (nodes, size))
    if 4 * m > size:
        return np.sort(np.argsort(rng.random((nodes, size)), axis=1)[:, :m], axis=1)
    out = np.sort(rng.integers(size, size=(nodes, m)), axis=1)
    while (twice := np.diff(out, axis=1, prepend=-1) == 0).any():  # drawn again until all differ
        out[twice] = rng.integers(size, size=twice.sum())
        out.sort(axis=1)
    return out


def _added(key: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their whole-numbered weights."""
    if not len(key):
        return key, w.astype(np.int64)
    top, heaviest = int(key.max()), int(w.max())
    if top < 4 * len(key):
        sums = np.bincount(key, w)
        at = np.flatnonzero(sums != 0)
        return at, sums[at].astype(np.int64)
    for bits, kind in ((4, np.uint32), (8, np.int64)):  # key and weight in one number: sorted together, the shorter the faster
        if heaviest < 1 << bits and top << bits < 1 << 32 if kind is np.uint32 else heaviest < 1 << bits:
            both = (key.astype(kind) << kind(bits)) | w.astype(kind)
            both.sort()
            key, w = (both >> kind(bits)).astype(np.int64), both & kind((1 << bits) - 1)
            break
    else:
        order = np.argsort(key)
        key, w = key[order], w[order]
    starts = np.flatnonzero(_first(key))
    return key[starts], np.add.reduceat(w, starts, dtype=np.int64)


def _first(key: np.ndarray) -> np.ndarray:
    """Whether a place begins a stretch of equal keys."""
    out = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=out[1:])
    return out


def _cells(x: np.ndarray, row: np.ndarray, node: np.ndarray, chosen: np.ndarray, y: np.ndarray, w: np.ndarray, k: int):
    """Weights by (node, chosen feature, bin, class), without bin 0: it is what remains of the node."""
    size, m, keys, sums = x.shape[1], chosen.shape[1], [], []
    flat, step = x.reshape(-1), max(1, CELLS // m)
    chosen = np.ascontiguousarray(chosen, np.int64)
    for s in range(0, len(row), step):
        r, c = row[s:s + step], node[s:s + step]
        if m == size:
            g = x.take(r, 0).reshape(-1)
        else:
            at = chosen.take(c, 0)
            at += (r * size)[:, None]
            g = flat.take(at.reshape(-1))
        at = np.flatnonzero(g != 0)
        i = at // m
        begin = (c - np.arange(len(r))) * (m * BINS * k) + y.take(r)  # a row's first cell, less those of the rows before
        key = at * (BINS * k)
        key += begin.take(i)
        key += g.take(at).astype(np.int64) * k
        a, b = _added(key, w.take(r).take(i))
        keys.append(a)
        sums.append(b)
    if len(keys) == 1:
        return keys[0], sums[0]
    return _added(np.concatenate(keys), np.concatenate(sums)) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _best(key: np.ndarray, n: np.ndarray, totals: np.ndarray, m: int, weights: np.ndarray):
    """Of every node (row of ``totals``) the place of its chosen feature, or -1, and the last bin on the left.

    Ties: the first feature, the lowest bin.
    """
    nodes, k = totals.shape
    place, last = np.full(nodes, -1), np.zeros(nodes, np.int64)
    if not len(key):
        return place, last
    cell = key // k  # in order, as the keys are
    one = _first(cell)
    at, class_ = np.cumsum(one) - 1, key - cell * k
    cell = cell[one]
    count = np.zeros((len(cell), k), np.int64)
    count[at, class_] = n
    pair, b = cell // BINS, cell % BINS
    first = _first(pair)
    starts, pair_of = np.flatnonzero(first), np.cumsum(first) - 1
    upto = np.cumsum(count, axis=0)
    inside = upto - (upto - count)[starts][pair_of]  # with this cell
    ends = np.r_[starts[1:], len(cell)] - 1
    node = pair // m
    zero = totals[node[starts]] - inside[ends]
    left = zero[pair_of] + inside - count  # the cell and what follows go right
    right = totals[node] - left
    lw, rw, tw = left * weights, right * weights, totals * weights
    with np.errstate(invalid="ignore", divide="ignore"):
        score = (lw * lw).sum(1) / lw.sum(1) + (rw * rw).sum(1) / rw.sum(1)
        parent = (tw * tw).sum(1) / tw.sum(1)
        gain = (score - parent[node]) / tw.sum(1)[node]
    gain = np.where((left.sum(1) > 0) & (gain > LEAST_GAIN), gain, -1.0)
    begin = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    top = np.maximum.reduceat(gain, begin)
    top_of = np.repeat(top, np.diff(np.r_[begin, len(node)]))
    hit = np.flatnonzero((gain == top_of) & (gain > 0))[::-1]
    before = np.where(first, 0, np.r_[0, b[:-1]])
    place[node[hit]], last[node[hit]] = (pair % m)[hit], before[hit]
    return place, last


def _joint(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Bin and class of every row and feature in one number."""
    joint = x.astype(np.uint8 if BINS * k <= 1 << 8 else np.uint16)
    joint *= joint.dtype.type(k)
    joint += y.astype(joint.dtype)[:, None]
    return joint


def _rows_of(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of all rows of nodes that stand at ``start``."""
    row = np.repeat(start - (np.cumsum(counts) - counts), counts)
    row += np.arange(len(row))
    return row


def _tallies(joint: np.ndarray, start: np.ndarray, counts: np.ndarray, chosen: np.ndarray, cells: np.ndarray, k: int, w: np.ndarray) -> list[np.ndarray]:
    """Weights by (node, bin, class) for each place of the chosen features, all ``cells`` of a node side by side.

    The rows of a node are a stretch of ``joint`` (as ``_joint``) and of the weights.
    """
    before, sums, size = np.cumsum(cells, axis=0) - cells, [np.zeros(int(n)) for n in cells.sum(0)], joint.shape[1]
    large = counts >= LARGE
    for i in np.flatnonzero(large):
        for places, found in _crossed(joint, int(start[i]), int(start[i] + counts[i]), chosen[i], cells[i] // k, k, w):
            for axis, j in enumerate(places[::-1]):
                others = tuple(a for a in range(len(places)) if a != axis)
                sums[j][before[i, j]:before[i, j] + cells[i, j]] = found.sum(others).reshape(-1)
    if large.all():
        return sums
    small = np.flatnonzero(~large)
    start, counts, chosen, before, cells = start[small], counts[small], chosen[small], before[small], cells[small]
    ends = np.cumsum(counts)
    for s in range(0, int(ends[-1]), ROWS):
        e = min(s + ROWS, int(ends[-1]))
        lo, hi = int(np.searchsorted(ends, s, "right")), int(np.searchsorted(ends, e)) + 1
        share = np.minimum(ends[lo:hi], e) - np.maximum(ends[lo:hi] - counts[lo:hi], s)
        row = np.repeat(start[lo:hi] + counts[lo:hi] - ends[lo:hi], share)
        row += np.arange(s, e)
        part, begin = w.take(row), row * size
        for j, out in enumerate(sums):
            first, stop = int(before[lo, j]), int(before[hi - 1, j] + cells[hi - 1, j])
            at = np.repeat(chosen[lo:hi, j], share)
            at += begin
            cell = np.repeat(before[lo:hi, j] - first, share)
            cell += joint.reshape(-1).take(at)
            out[first:stop] += np.bincount(cell, part, stop - first)
    return sums


def _crossed(joint: np.ndarray, start: int, stop: int, chosen: np.ndarray, bins: np.ndarray, k: int, w: np.ndarray) -> list[tuple[list, np.ndarray]]:
    """The rows of one node by the bins of some features together and class: places of the features and weights (axes: last feature first, class).

    Features of few bins share a count.
    """
    groups, n = [], k
    for j in np.argsort(-bins, kind="stable"):
        if not groups or n * bins[j] > TOGETHER:
            groups.append([])
            n = k
        groups[-1].append(int(j))
        n *= int(bins[j])
    sums = [np.zeros(int(bins[g].prod()) * k) for g in groups]
    for s in range(start, stop, ROWS):
        part = joint[s:min(s + ROWS, stop)]
        class_ = part[:, chosen[0]].astype(np.uint16)
        class_ -= class_ // np.uint16(k) * np.uint16(k)
        for places, out in zip(groups, sums, strict=True):
            cell, step = part[:, chosen[places[0]]].astype(np.uint16), int(bins[places[0]])
            for j in places[1:]:
                more = part[:, chosen[j]].astype(np.uint16)
                more -= class_
                more *= np.uint16(step)
                cell += more
                step *= int(bins[j])
            out += np.bincount(cell, w[s:s + len(part)], len(out))
    return [(g, n.reshape(*bins[g[::-1]], k)) for g, n in zip(groups, sums, strict=True)]


def _best_of_tallies(sums: list[np.ndarray], cells: np.ndarray, totals: np.ndarray, weights: np.ndarray):
    """As ``_best``, with the class counts on the left, from the sums of ``_tallies``."""
    nodes, k = totals.shape
    tw = totals * weights
    whole, top = tw.sum(1), np.full(nodes, LEAST_GAIN)
    parent = (tw * tw).sum(1) / whole
    place, last, lefts = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros((nodes, k), np.int64)
    for j, s in enumerate(sums):
        bins = cells[:, j] // k
        start = np.cumsum(bins) - bins
        left, right, score, sides = [], [], 0.0, []
        for c in range(k):
            upto = np.cumsum(s[c::k])
            upto -= np.repeat(np.r_[0.0, upto].take(start), bins)  # with this bin
            left.append(upto)
            right.append(np.repeat(totals[:, c], bins) - upto)
        with np.errstate(invalid="ignore", divide="ignore"):
            for side in (left, right):
                sides.append(reduce(np.add, side) > 0)
                weighed = [n * v for n, v in zip(side, weights, strict=True)]
                score = score + reduce(np.add, [n * n for n in weighed]) / reduce(np.add, weighed)
            score -= np.repeat(parent, bins)
            gain = np.where(sides[0] & sides[1], score / np.repeat(whole, bins), -1.0)
        best = np.maximum.reduceat(gain, start)
        better = best > top
        hit = np.flatnonzero((gain == np.repeat(best, bins)) & np.repeat(better, bins))[::-1]
        node = np.searchsorted(start, hit, "right") - 1
        place[node], last[node] = j, hit - start[node]
        lefts[node] = np.column_stack([n.take(hit) for n in left])
        top = np.where(better, best, top)
    return place, last, lefts


def _grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, k: int, m: int, depth: int, rng: np.random.Generator, weights: np.ndarray) -> dict:
    """A subtree of ``depth`` levels at most, level after level. Children of a node stand side by side.

    Rows stand node after node, so that a level reads and counts in stretches; rows of pure nodes are left out.
    """
    x, size = np.ascontiguousarray(x), x.shape[1]
    narrow = m <= PLACES and size <= MOVED * m
    joint, step, width = (_joint(x, y, k), k, x.max(0, initial=0).astype(np.int64) + 1) if narrow else (x, 1, np.full(size, BINS))
    row, heavy, counts = np.arange(len(y)), w.astype(float), np.array([len(y)])
    totals, levels, base = np.bincount(y, w, k)[None].astype(np.int64), [], 0
    for d in range(depth + 1):
        nodes = len(totals)
        feature, last, child = np.full(nodes, -1, np.int32), np.zeros(nodes, np.uint8), np.zeros(nodes, np.int32)
        levels.append((feature, last, child, totals))
        at = np.flatnonzero((totals > 0).sum(1) > 1)
        if d == depth or not len(at):
            break
        chosen, own, start = _subsets(rng, len(at), size, m), totals[at], np.cumsum(counts) - counts
        cells = width[chosen] * k
        place, cut, left = np.full(len(at), -1), np.zeros(len(at), np.int64), np.zeros((len(at), k), np.int64)
        dense = narrow & (cells.sum(1) <= DENSE * m * counts)
        if (some := dense).any():
            sums = _tallies(joint, start[some], counts[some], chosen[some], cells[some], k, heavy)
            place[some], cut[some], left[some] = _best_of_tallies(sums, cells[some], own[some], weights)
        if (some := ~dense).any():
            node, mine = np.repeat(np.arange(some.sum()), counts[some]), row.take(_rows_of(start[some], counts[some]))
            place[some], cut[some] = _best(*_cells(x, mine, node, chosen[some], y, w, k), own[some], m, weights)
        ok = place >= 0
        if not ok.any():
            break
        f = chosen[np.arange(len(place)), np.maximum(place, 0)]
        feature[at], last[at], child[at] = np.where(ok, f, -1), cut, np.where(ok, base + nodes + 2 * (np.cumsum(ok) - 1), 0)
        right = _right(joint, None if narrow else row, start, counts, f, (cut + 1) * step)
        if not dense.all():
            some = np.flatnonzero(~dense)
            mine = _rows_of(start[some], counts[some])
            mine, node = mine[~right.take(mine)], np.repeat(some, counts[some])[~right.take(mine)]
            left += np.bincount(node * k + y.take(row.take(mine)), heavy.take(mine), len(at) * k).reshape(-1, k).astype(np.int64)
        base, totals = base + nodes, np.stack([left[ok], (own - left)[ok]], axis=1).reshape(-1, k)
        order, counts = _dealt(right, start, counts, ok, (totals > 0).sum(1) > 1)
        row, heavy = row.take(order), heavy.take(order)
        joint = joint.take(order, 0) if narrow else joint
    return {n: np.concatenate([lv[i] for lv in levels]) for i, n in enumerate(("feature", "last", "child", "totals"))}


def _right(values: np.ndarray, row: np.ndarray | None, start: np.ndarray, counts: np.ndarray, feature: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether each row has ``least`` or more of its node's feature. Rows stand node after node themselves, or by their places ``row``."""
    out, some = np.empty(int(counts.sum()), bool), np.arange(len(counts))
    if row is None:
        for i in np.flatnonzero(counts >= LARGE):
            s = slice(int(start[i]), int(start[i] + counts[i]))
            np.greater_equal(values[s, feature[i]], least[i], out=out[s])
        some = np.flatnonzero(counts < LARGE)
    n = counts[some]
    mine = _rows_of(start[some], n)
    at = (mine if row is None else row) * values.shape[1]
    at += np.repeat(feature[some], n)
    out[mine] = values.reshape(-1).take(at) >= np.repeat(least[some], n)
    return out


def _dealt(right: np.ndarray, start: np.ndarray, counts: np.ndarray, ok: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the ``wanted`` children (left and right of each node that is ``ok``), child after child, and their numbers."""
    sides = np.zeros((len(counts), 2), bool)
    sides[ok] = wanted.reshape(-1, 2)
    number = np.add.reduceat(right, start, dtype=np.int64)
    number = np.where(sides, np.column_stack([counts - number, number]), 0)
    begin = np.cumsum(number).reshape(-1, 2) - number
    order = np.empty(int(number.sum()), np.int64)
    for i in np.flatnonzero((counts >= LARGE) & sides.any(1)):
        there = right[start[i]:start[i] + counts[i]]
        for side in np.flatnonzero(sides[i]):
            to = order[begin[i, side]:begin[i, side] + number[i, side]]
            np.add(np.flatnonzero(there if side else ~there), start[i], out=to)
    small = np.flatnonzero((counts < LARGE) & sides.any(1))
    mine = _rows_of(start[small], counts[small])
    there = right.take(mine)
    for side, those in enumerate((~there, there)):
        those &= np.repeat(sides[small, side], counts[small])
        order[_rows_of(begin[small, side], number[small, side])] = mine[those]
    return order, number[sides]


def _descend(x: np.ndarray, tree: dict, row: np.ndarray) -> np.ndarray:
    """The node at which each of the rows ends."""
    feature = tree["feature"]
    out, active, here, begin = np.zeros(len(row), np.int64), np.arange(len(row)), np.zeros(len(row), np.int64), row * x.shape[1]
    if len(feature) < 2:
        return out
    flat, child, last = x.reshape(-1), tree["child"].astype(np.int64), tree["last"]
    while len(active):
        f = feature.take(here)
        if (f < 0).any():
            ends, goes = np.flatnonzero(f < 0), np.flatnonzero(f >= 0)
            out[active.take(ends)] = here.take(ends)
            f, active, here, begin = f.take(goes), active.take(goes), here.take(goes), begin.take(goes)
        right = flat.take(begin + f) > last.take(here)
        here = child.take(here)
        here += right
    return out


def _blob(tree: dict) -> bytes:
    n, k = tree["totals"].shape
    return np.array([n, k], np.int64).tobytes() + _pack(np.frombuffer(b"".join(
        [tree["feature"].astype(np.int32).tobytes(), tree["child"].astype(np.int32).tobytes(),
         tree["totals"].astype(np.int32).tobytes(), tree["last"].astype(np.uint8).tobytes()]), np.uint8))


def _tree(blob: bytes) -> dict:
    n, k = (int(v) for v in np.frombuffer(blob[:16], np.int64))
    raw = _unpack(blob[16:], np.uint8, n * (4 + 4 + 4 * k + 1)).tobytes()
    part = lambda a, b, t: np.frombuffer(raw[a:b], t)
    return {"feature": part(0, 4 * n, np.int32), "child": part(4 * n, 8 * n, np.int32),
            "totals": part(8 * n, 8 * n + 4 * k * n, np.int32).reshape(n, k), "last": part(8 * n + 4 * k * n, len(raw), np.uint8)}


# --- bags ----------------------------------------------------------------------

def _poisson_table() -> np.ndarray:
    """Poisson(1) counts by the upper 16 bits of a hash."""
    share, p, out = 0.0, math.exp(-1), np.zeros(1 << 16, np.uint8)
    for i in range(1, 12):
        share += p
        out[round(share * (1 << 16)):] = i
        p /= i
    return out


POISSON = _poisson_table()


def _bag(block: int, n: int, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """How often the tree takes each row of a block: the same in every pass."""
    if not bootstrap:
        return np.ones(n, np.int64)
    rng = np.random.Generator(np.random.Philox(key=[(seed << 32) ^ tree, block]))
    return POISSON[rng.integers(1 << 16, size=n, dtype=np.uint16)].astype(np.int64)


# --- growing -------------------------------------------------------------------

#: Nodes of an upper part: to be split by a pass over all rows, finished in a group, without children, split.
OPEN, LOCAL, LEAF, INNER = 0, 1, 2, 3


def _level(rows: DataFrame, trees: list[dict], chosen: dict, label: int, labels: int, k: int, m: int, seed: int, bootstrap: bool,
           weights: np.ndarray) -> list:
    """(tree, node, feature, last bin, class counts of both sides) of every open node, from all rows."""
    size = trees[0]["size"]
    shared = rows.sparkSession.sparkContext.broadcast((trees, chosen))

    def count(batches):
        trees, chosen = shared.value
        found: dict[tuple[int, int], list] = {}
        for b in batches:
            for block, n, y, x in zip(*[c.to_pylist() for c in b.columns], strict=True):
                x, y = _unpack(x, np.uint8, n, size), _unpack(y, np.uint8, n, labels)[:, label]
                for t, (nodes, features) in chosen.items():
                    w = _bag(block, n, t, seed, bootstrap)
                    row = np.flatnonzero(w)
                    at = _descend(x, trees[t], row)
                    where = np.full(len(trees[t]["feature"]), -1)
                    where[nodes] = np.arange(len(nodes))
                    row, node = row[where[at] >= 0], where[at][where[at] >= 0]
                    key, c = _cells(x, row, node, features, y, w, k)
                    total = np.bincount(node * k + y[row], w[row], len(nodes) * k).reshape(-1, k).astype(np.int64)
                    ends = np.searchsorted(key, np.arange(len(nodes) + 1) * (m * BINS * k))
                    for i, v in enumerate(nodes):
                        s = slice(ends[i], ends[i + 1])
                        found.setdefault((t, int(v)), []).append((key[s] - i * (m * BINS * k), c[s], total[i]))
        for (t, v), parts in found.items():
            key, c = _added(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield pa.record_batch([pa.array([t], pa.int32()), pa.array([v], pa.int32()), pa.array([key.astype(np.int64).tobytes()], pa.binary()),
                                   pa.array([c.astype(np.int64).tobytes()], pa.binary()),
                                   pa.array([sum(p[2] for p in parts).tobytes()], pa.binary())], names=["tree", "node", "key", "c", "total"])

    def decide(key, table):
        t, v = key[0].as_py(), key[1].as_py()
        cells, c = (np.concatenate([np.frombuffer(b, np.int64) for b in table.column(n).to_pylist()]) for n in ("key", "c"))
        total = sum(np.frombuffer(b, np.int64) for b in table.column("total").to_pylist())
        cells, c = _added(cells, c)
        place, last = _best(cells, c, total[None], m, weights)
        nodes, features = shared.value[1][t]
        feature, left = -1, np.zeros(k, np.int64)
        if place[0] >= 0:
            feature = int(features[np.searchsorted(nodes, v), place[0]])
            over = (cells // k // BINS == place[0]) & (cells // k % BINS > last[0])
            left = total - np.bincount(cells[over] % k, c[over], k).astype(np.int64)
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([v], pa.int32()), "feature": pa.array([feature], pa.int32()),
                         "last": pa.array([int(last[0])], pa.int32()), "total": [total.tolist()], "left": [left.tolist()]})

    parts = rows.mapInArrow(count, "tree int, node int, key binary, c binary, total binary")
    out = parts.groupBy("tree", "node").applyInArrow(
        decide, "tree int, node int, feature int, last int, total array<long>, left array<long>").collect()
    shared.unpersist()
    return out


def _local_rows(rows: DataFrame, size: int, num_trees: int) -> tuple[int, int]:
    """Rows, and how many a node may have at most to be finished in one group: enough groups for all cores, none too large for a task."""
    n = rows.agg(F.sum("n")).first()[0] or 0
    even = n * num_trees / (GROUPS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    return n, max(1, min(max(LEAST_LOCAL_ROWS, int(even)), LOCAL_ROWS, LOCAL_CELLS // _chosen(size, num_trees), 2 * BLOCK_BYTES // size))


def _chosen(size: int, num_trees: int) -> int:
    """Features looked at in a node."""
    return math.ceil(math.sqrt(size)) if num_trees > 1 else size


def _root(size: int, k: int, state: int) -> dict:
    return {"size": size, "feature": np.full(1, -1, np.int32), "last": np.zeros(1, np.uint8), "child": np.zeros(1, np.int32),
            "totals": np.zeros((1, k), np.int64), "state": np.array([state]), "level": np.zeros(1, int)}


def grow(rows: DataFrame, size: int, k: int, num_trees: int, max_depth: int, seed: int, weights: Sequence[float],
         label: int = 0, labels: int = 1, local_rows: int | None = None) -> tuple[list[dict], DataFrame]:
    """Upper parts of the trees, and the (tree, node, subtree) rows that finish them."""
    _importable(rows.sparkSession)
    bootstrap, m, weights = num_trees > 1, _chosen(size, num_trees), np.array(weights, float)
    n, bound = _local_rows(rows, size, num_trees)
    local_rows = bound if local_rows is None else local_rows
    trees = [_root(size, k, LOCAL if n <= local_rows else OPEN) for _ in range(num_trees)]
    depth = 0
    while any((t["state"] == OPEN).any() for t in trees):
        chosen = {}
        for t in range(num_trees):
            if len(nodes := np.flatnonzero(trees[t]["state"] == OPEN)):
                chosen[t] = nodes, _subsets(np.random.default_rng([seed, t, depth]), len(nodes), size, m).astype(np.int32)
        for r in sorted(_level(rows, trees, chosen, label, labels, k, m, seed, bootstrap, weights), key=lambda r: (r.tree, r.node)):
            t, total, left = trees[r.tree], np.array(r.total), np.array(r.left)
            t["totals"][r.node] = total
            if r.feature < 0:
                t["state"][r.node] = LEAF
                continue
            at = len(t["feature"])
            t["feature"][r.node], t["last"][r.node], t["child"][r.node], t["state"][r.node] = r.feature, r.last, at, INNER
            below = np.array([left, total - left])
            leaf = ((below > 0).sum(1) < 2) | (depth + 1 >= max_depth)
            state = np.where(leaf, LEAF, np.where(below.sum(1) <= local_rows, LOCAL, OPEN))
            more = {"feature": np.full(2, -1, np.int32), "last": np.zeros(2, np.uint8), "child": np.zeros(2, np.int32),
                    "totals": below, "state": state, "level": np.full(2, depth + 1)}
            for name, v in more.items():
                t[name] = np.concatenate([t[name], v])
        for t in trees:  # a node that no row reached (an empty bag)
            t["state"][(t["state"] == OPEN) & (t["level"] <= depth)] = LEAF
        depth += 1
    return trees, _subtrees(rows, trees, [label], labels, k, m, max_depth, seed, bootstrap, [weights]).drop("label")


#: Held by the fit that deals out many rows.
_DEALING = threading.Lock()


def _subtrees(rows, trees, wanted, labels, k, m, max_depth, seed, bootstrap, weights) -> DataFrame:
    """Rows of every node left to finish, shuffled to their node; each node grows its subtree for each of the ``wanted`` labels there.

    Every tree moves nearly all rows, so trees take turns: the rows of ``DEALT_BYTES`` or so lie on disk at a time.
    """
    spark = rows.sparkSession
    some = [t for t, tree in enumerate(trees) if (tree["state"] == LOCAL).any()]
    a_tree = (rows.agg(F.sum(F.octet_length("x") + F.col("n"))).first()[0] or 0) or 1
    at_once = max(1, DEALT_BYTES // a_tree)
    turns = [some[i:i + at_once] for i in range(0, len(some), at_once)] or [[]]

    def take(turn: list[int]) -> DataFrame:
        return _dealt_and_grown(rows, trees, turn, wanted, labels, k, m, max_depth, seed, bootstrap, weights)

    if len(some) * a_tree <= BESIDE_BYTES:
        return take(some)
    out = []
    for turn in turns:
        with _DEALING:
            out.append(take(turn))
            release(spark)
    return reduce(DataFrame.unionByName, out)


def _dealt_and_grown(rows, trees, turn, wanted, labels, k, m, max_depth, seed, bootstrap, weights) -> DataFrame:
    """``_subtrees`` of the trees whose ``turn`` it is, written."""
    spark, size = rows.sparkSession, trees[0]["size"]
    shared = spark.sparkContext.broadcast(trees)

    def deal(batches):
        for b in batches:
            for block, n, y, x in zip(*[c.to_pylist() for c in b.columns], strict=True):
                x, y = _unpack(x, np.uint8, n, size), _unpack(y, np.uint8, n, labels)[:, wanted]
                for t in turn:
                    tree = shared.value[t]
                    w = _bag(block, n, t, seed, bootstrap)
                    row = np.flatnonzero(w)
                    at = _descend(x, tree, row)
                    here = tree["state"][at] == LOCAL
                    row, at = row[here], at[here]
                    order = np.argsort(at, kind="stable")
                    out = [(int(v), len(r), _pack(np.column_stack([w[r], y[r]]).astype(np.uint8).T), _pack(x[r]))
                           for v, r in zip(*_runs(at[order], row[order]), strict=True)]
                    if out:
                        yield pa.record_batch([pa.array([t] * len(out), pa.int32()), *[pa.array([o[i] for o in out], ty) for i, ty in enumerate(
                            (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], pa.array([block] * len(out), pa.int64())], names=["tree", "node", "n", "wy", "x", "block"])

    def finish(key, table):
        t, v = key[0].as_py(), key[1].as_py()
        table = table.sort_by("block")
        ns = table.column("n").to_pylist()
        wy = np.concatenate([_unpack(b.as_py(), np.uint8, 1 + len(wanted), n) for b, n in zip(table.column("wy"), ns, strict=True)], axis=1)
        x = np.empty((sum(ns), size), np.uint8)
        for at, n, b in zip(np.cumsum(ns) - ns, ns, table.column("x"), strict=True):
            x[at:at + n] = _unpack(b.as_py(), np.uint8, n, size)
        depth = max_depth - int(shared.value[t]["level"][v])
        grown = [_grow(x, y, wy[0], k, m, depth, np.random.default_rng([seed, t, v, 1]), w) for y, w in zip(wy[1:], weights, strict=True)]
        return pa.table({"label": pa.array(wanted, pa.int32()), "tree": pa.array([t] * len(wanted), pa.int32()), "node": pa.array([v] * len(wanted), pa.int32()),
                         "levels": pa.array([_levels(g) for g in grown], pa.int32()), "subtree": pa.array([_blob(g) for g in grown], pa.binary())})

    groups = sum(int((trees[t]["state"] == LOCAL).sum()) for t in turn)
    parts = rows.mapInArrow(deal, "tree int, node int, n int, wy binary, x binary, block long")
    tasks = max(1, min(4 * groups, TASKS_A_CORE * spark.sparkContext.defaultParallelism))  # more than groups: few share a task
    parts = parts.repartition(tasks, "tree", "node")  # few bytes, much work: not to be put together
    return cut_lineage(parts.groupBy("tree", "node").applyInArrow(finish, "label int, tree int, node int, levels int, subtree binary"))


def _levels(tree: dict) -> int:
    """Levels below the first node."""
    depth, nodes = 0, np.zeros(1, np.int64)
    while len(nodes := nodes[tree["feature"][nodes] >= 0]):
        nodes, depth = np.concatenate([tree["child"][nodes], tree["child"][nodes] + 1]), depth + 1
    return depth


# --- the model -----------------------------------------------------------------

def _shares(totals: np.ndarray, weights: np.ndarray) -> np.ndarray:
    v = totals * weights
    total = v.sum(1, keepdims=True)
    return np.where(total > 0, v / np.where(total > 0, total, 1), 1 / v.shape[1]).astype(np.float32)


def probabilities(df: DataFrame, features: str, models: Sequence["ForestModel"], out: str) -> DataFrame:
    """Adds ``out``: an array of class probabilities per model. The models share their cuts."""
    spark, cuts = df.sparkSession, models[0].cuts
    _importable(spark)
    if not all(len(a) == len(b) and (a == b).all() for m in models for a, b in zip(m.cuts, cuts, strict=True)):
        raise ValueError("models with cuts of their own are scored one by one")
    d = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    shared = spark.sparkContext.broadcast([m.trees for m in models])
    weights, classes, size = [np.array(m.weights) for m in models], [m.classes for m in models], len(cuts)
    names = [f"_p{i}" for i in range(len(models))]
    subtrees = None
    for i, mdl in enumerate(models):
        s = mdl.subtrees.select(F.lit(i).alias("model"), "tree", "node", "subtree")
        subtrees = s if subtrees is None else subtrees.unionByName(s)

    def added(sums: list[np.ndarray]) -> dict:
        sums = [s / s.sum(1, keepdims=True) for s in sums]
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(s.reshape(-1)), s.shape[1]).cast(pa.list_(pa.float64())) for s in sums]
        return dict(zip(names, lists, strict=True))

    def done(sums: DataFrame) -> DataFrame:
        return d.join(sums, "_row").withColumn(out, F.array(*names)).drop("_row", *names)

    schema = "_row long, " + ", ".join(f"{n} array<double>" for n in names)
    if (subtrees.agg(F.sum(F.octet_length("subtree"))).first()[0] or 0) <= SHARED_BYTES:
        small = spark.sparkContext.broadcast({(r.model, r.tree, r.node): bytes(r.subtree) for r in subtrees.collect()})

        def score(batches):
            held = {key: _tree(blob) for key, blob in small.value.items()}
            for t in _gathered(batches, _block_rows(size)):
                x = _binned(t.column(features), cuts)
                sums = [np.zeros((len(x), k)) for k in classes]
                for i, trees in enumerate(shared.value):
                    for k, tree in enumerate(trees):
                        at = _descend(x, tree, np.arange(len(x)))
                        p = _shares(tree["totals"], weights[i])[at]
                        for v in np.flatnonzero(tree["state"] == LOCAL):
                            row = np.flatnonzero(at == v)
                            p[row] = 1 / classes[i]  # where no row of the tree's bag came to the node
                            if sub := held.get((i, k, int(v))):
                                p[row] = _shares(sub["totals"], weights[i])[_descend(x, sub, row)]
                        sums[i] += p
                yield from pa.table({"_row": t.column("_row"), **added(sums)}).combine_chunks().to_batches()

        return done(d.select("_row", features).mapInArrow(score, schema))

    def route(batches):
        for t in _gathered(batches, _block_rows(size)):
            rows = t.column("_row").to_numpy()
            x, block = _binned(t.column(features), cuts), int(rows[0])
            yield _votes([(block, -1, -1, -1, rows.astype(np.int64).tobytes(), b"")])
            for i, trees in enumerate(shared.value):
                for k, tree in enumerate(trees):
                    at = _descend(x, tree, np.arange(len(rows)))
                    order, got = np.argsort(at, kind="stable"), []
                    for v, r in zip(*_runs(at[order], order), strict=True):
                        place = r.astype(np.int32).tobytes()
                        if tree["state"][v] == LOCAL:
                            got.append((block, i, k, int(v), place, _pack(x[r])))
                        else:
                            p = _shares(tree["totals"][v][None], weights[i])
                            got.append((block, i, k, -1, place, np.repeat(p, len(r), 0).tobytes()))
                    yield _votes(got)

    def vote(key, left, right):
        i, k, v = (part.as_py() for part in key[:3])
        got = left.select(["block", "place", "x"]).to_pylist()
        if v >= 0:  # else the rows were done on their way
            # no row of the tree's bag came to the node: nothing is known there
            tree = _tree(right.column("subtree")[0].as_py()) if right.num_rows else {"feature": np.full(1, -1), "totals": np.zeros((1, classes[i]))}
            shares = _shares(tree["totals"], weights[i])
            for r in got:
                n = len(r["place"]) // 4
                r["x"] = shares.take(_descend(_unpack(r["x"], np.uint8, n, size), tree, np.arange(n)), 0).tobytes()
        return pa.Table.from_batches([_votes([(r["block"], i, k, v, r["place"], r["x"]) for r in got])])

    def add(key, table):
        got = sorted(zip(*[table.column(c).to_pylist() for c in ("model", "tree", "node", "place", "x")], strict=True), key=lambda r: r[:3])
        rows = next(np.frombuffer(p, np.int64) for i, _, _, p, _ in got if i < 0)
        sums = [np.zeros((len(rows), k)) for k in classes]
        for i, _, _, place, p in got:
            if i >= 0:
                sums[i][np.frombuffer(place, np.int32)] += np.frombuffer(p, np.float32).reshape(-1, classes[i])
        return pa.table({"_row": rows, **added(sums)})

    # a subtree meets the rows of a node once, not once for each block; of very many rows, once for every GROUP_ROWS or so
    salts = math.ceil(d.count() / GROUP_ROWS) or 1
    keys, tasks = ["model", "tree", "node", "salt"], TASKS_A_CORE * spark.sparkContext.defaultParallelism
    parts = d.select("_row", features).mapInArrow(route, "block long, model int, tree int, node int, place binary, x binary")
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")).repartition(tasks, *keys)
    all_ = subtrees.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).repartition(tasks, *keys)
    votes = parts.groupBy(*keys).cogroup(all_.groupBy(*keys)).applyInArrow(vote, "block long, model int, tree int, node int, place binary, x binary")
    return done(votes.groupBy("block").applyInArrow(add, schema))


def _votes(rows: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["block", "model", "tree", "node", "place", "x"])


class ForestModel(Model, MLWritable, MLReadable):
    """Fitted trees: cuts and upper parts here, subtrees in a table. ``transform`` adds ``probability`` and ``prediction``."""

    def __init__(self, features: str = "features", cuts: Sequence[np.ndarray] = (), classes: int = 2, weights: Sequence[float] = (1.0, 1.0),
                 trees: Sequence[dict] = (), subtrees: DataFrame | None = None):
        super().__init__()
        self.features, self.cuts, self.classes, self.weights = features, list(cuts), classes, list(weights)
        self.trees, self.subtrees = list(trees), subtrees

    @property
    def depth(self) -> int:
        """Levels of the deepest tree."""
        deepest = [int(t["level"].max()) for t in self.trees]
        for r in self.subtrees.select("tree", "node", "levels").toLocalIterator():
            deepest.append(int(self.trees[r.tree]["level"][r.node]) + r.levels)
        return max(deepest, default=0)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = probabilities(dataset, self.features, [self], "_all").withColumn("_p", F.col("_all")[0])
        best = F.array_position("_p", F.array_max("_p")) - 1
        return p.withColumn("probability", array_to_vector("_p")).withColumn("prediction", best.cast("double")).drop("_all", "_p")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"features": m.features, "classes": m.classes, "weights": [float(w) for w in m.weights]})
        rows = [(f"cut{i}", json.dumps(c.tolist())) for i, c in enumerate(m.cuts)]
        rows += [(f"tree{i}", json.dumps({k: v if k == "size" else v.tolist() for k, v in t.items()})) for i, t in enumerate(m.trees)]
        spark.createDataFrame(rows, "name string, value string").write.parquet(f"{path}/upper")
        m.subtrees.write.parquet(f"{path}/subtrees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        held = {r.name: json.loads(r.value) for r in spark.read.parquet(f"{path}/upper").collect()}
        kinds = {"feature": np.int32, "last": np.uint8, "child": np.int32, "totals": np.int64, "state": np.int64, "level": np.int64}
        cuts = [np.array(held[f"cut{i}"], float) for i in range(sum(n.startswith("cut") for n in held))]
        trees = [{k: v if k == "size" else np.array(v, kinds[k]) for k, v in held[f"tree{i}"].items()} for i in range(sum(n.startswith("tree") for n in held))]
        model = self.cls(meta["features"], cuts, meta["classes"], meta["weights"], trees, spark.read.parquet(f"{path}/subtrees"))
        model._resetUid(meta["uid"])
        return model


def bins(train: DataFrame, features: str, labels: Sequence[str]) -> tuple[list[np.ndarray], DataFrame]:
    """Cuts and blocks, which fits of the same rows and labels can share."""
    _importable(train.sparkSession)
    first = train.select(features).first()
    cuts = thresholds(train, features, len(first[0]) if first else 1)
    return cuts, blocks(train.select(features, F.array(*[F.col(c).cast("int") for c in labels]).alias("_y")), features, "_y", cuts)


def fit_forests(train: DataFrame, features: str, labels: Sequence[str], num_trees: int, max_depth: int, seed: int,
                weights: Sequence[Sequence[float]], classes: int = 2, fit_all: Callable = map, binned: tuple | None = None) -> list[ForestModel]:
    """A forest (or, with one tree, a plain tree) per label column (class numbers from 0, no nulls); all share cuts and blocks.

    ``binned`` are those of an earlier fit of the same rows and labels.
    """
    _importable(train.sparkSession)
    cuts, rows = binned or bins(train, features, labels)
    size = len(cuts)
    n, local_rows = _local_rows(rows, size, num_trees * len(labels))
    if len(labels) > 1 and n <= local_rows:
        # a tree's bag is the same for all labels: its rows are dealt out once and each label's tree grows from them
        trees = [_root(size, classes, LOCAL) for _ in range(num_trees)]
        all_ = _subtrees(rows, trees, list(range(len(labels))), len(labels), classes, _chosen(size, num_trees), max_depth, seed, num_trees > 1,
                         [np.array(w, float) for w in weights]).coalesce(rows.sparkSession.sparkContext.defaultParallelism)  # read once per label
        return [ForestModel(features, cuts, classes, weights[i], trees, all_.where(F.col("label") == i).drop("label")) for i in range(len(labels))]

    def one(i: int) -> ForestModel:
        trees, subtrees = grow(rows, size, classes, num_trees, max_depth, seed, weights[i], i, len(labels))
        return ForestModel(features, cuts, classes, weights[i], trees, subtrees)

    return list(fit_all(one, range(len(labels))))
