"""Which vectors can link: unit vectors are dealt to cells in several tables, and those of a cell whose sketches lie
close together are joined.

A cell is named by the random directions a vector is closest to (cross-polytope hashing); the number of tables is set by
a simulation of pairs at the threshold, so that all tables miss such a pair with a chance of ``MISSED`` at most, whatever
the vectors are. A sketch holds a few coordinates of a random rotation in a byte each; the distance up to which two
are joined is that which pairs at the threshold exceed with a chance of ``MISSED`` / 10. Closer pairs are missed far
more seldom. A neighbourhood joins more than what links, never decides a link, and costs time where it is too large.

Entries travel as blocks of bytes, one for each task and range of cells, not as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Vectors of a cell on average; chance to miss a pair at the threshold; more tables than these are not worth their work.
CELL_ROWS, MISSED, TABLES = 1024, 1e-4, 40
#: Coordinates of a sketch; components of a task's vectors that are dealt at once, vectors hashed at once; MB of entries to
#: a partition.
SKETCH, BLOCK, HASHED, PART_MB = 20, 1 << 22, 4096, 32
#: Cells beyond this are thinned by tight heads first, so many of them; with more heads than the last a cell is joined whole.
HEAVY, HEADS, WHOLE = 4096, 64, 16_384


class Plan:
    """Tables, directions and sketch for vectors of one length; the same in every task."""

    def __init__(self, dim: int, count: int, threshold: float):
        rng = np.random.default_rng([dim, count])
        wanted = max(1, count // CELL_ROWS)
        self.hashes = 1 if wanted <= 128 else 2 if wanted <= 1 << 14 else 3
        self.sides = 1 if wanted == 1 else 2 * int(np.ceil(wanted ** (1 / self.hashes) / 2))
        self.cells = self.sides**self.hashes
        self.tables = 1
        if self.cells > 1:
            met = 1.0
            a, b = _pairs(dim, max(2000, 1_000_000 // dim), threshold, rng)
            for _ in range(self.hashes):
                way = _directions(dim, self.sides // 2, rng)
                met *= max(float((_side(a @ way) == _side(b @ way)).mean()), 1e-3)
            self.tables = max(1, int(np.ceil(np.log(MISSED) / np.log(max(1 - met, 1e-9)))))
        if self.tables > TABLES:  # all in one cell then
            self.hashes, self.sides, self.cells, self.tables = 1, 1, 1, 1
        self.ways = None
        if self.cells > 1:
            self.ways = np.concatenate([_directions(dim, self.sides // 2, rng) for _ in range(self.tables * self.hashes)], axis=1).astype(np.float32)
        self.width = min(dim, SKETCH)
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, : self.width].astype(np.float32)
        self.step = min(1.0, 4 / np.sqrt(dim)) / 127
        share = 1.0
        if dim > self.width:  # of a difference's square that falls on the sketch's coordinates
            inside, outside = rng.gamma(self.width / 2, size=10**6), rng.gamma((dim - self.width) / 2, size=10**6)
            share = float(np.quantile(inside / (inside + outside), 1 - MISSED / 10))
        # rounding moves a difference by a step in each coordinate at most; cutting off at +-127 only shortens it
        self.reach = np.sqrt(max(0.0, 2 - 2 * threshold) * share) / self.step + np.sqrt(self.width) + 1e-3

    def cells_of(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each unit vector in each table."""
        out = np.zeros((len(vectors), self.tables), np.int64)
        if self.ways is not None:
            scores = (vectors @ self.ways).reshape(len(vectors), self.tables, self.hashes, -1)
            for k in range(self.hashes):
                out = out * self.sides + _side(scores[:, :, k])
        return out

    def sketches(self, vectors: np.ndarray) -> np.ndarray:
        return np.clip(np.rint(vectors @ self.turn / np.float32(self.step)), -127, 127).astype(np.int8)


def _directions(dim: int, count: int, rng: np.random.Generator) -> np.ndarray:
    """Random unit columns, at right angles as far as the dimension goes."""
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-count // dim))], axis=1)[:, :count]


def _side(scores: np.ndarray) -> np.ndarray:
    best = np.abs(scores).argmax(axis=-1)
    return 2 * best + (np.take_along_axis(scores, best[..., None], -1)[..., 0] > 0)


def _pairs(dim: int, count: int, cosine: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at this cosine; in one dimension there is only the vector itself."""
    a, b = rng.normal(size=(2, count, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    if dim == 1:
        return a, a
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(max(0.0, 1 - cosine * cosine)) * b


@lru_cache(maxsize=64)
def plan(dim: int, count: int, threshold: float) -> Plan:
    return Plan(dim, count, threshold)


def merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots of sets, the smallest member of each, after joining a[k] with b[k]."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def joined(sketches: np.ndarray, reach: float) -> np.ndarray:
    """For each sketch of a cell the first of those it is joined with: all within ``reach``, and at times some beyond."""
    size = len(sketches)
    root, heads, radius = np.arange(size), np.arange(size), None
    points = sketches.astype(np.float32)
    squares = np.einsum("ij,ij->i", points, points)
    if size > HEAVY:  # what lies tightly around a head is joined with it and stands for it, the radius is added
        left, taken, far = np.arange(size), [], []
        for _ in range(HEADS):
            if len(left) < 2:
                break
            apart = np.sqrt(np.maximum(squares[left] + squares[left[0]] - 2 * (points[left] @ points[left[0]]), 0))
            near = apart <= reach / 2
            near[0] = True
            root[left[near]] = left[0]
            taken.append(left[0])
            far.append(apart[near].max() if near.sum() > 1 else 0.0)
            left = left[~near]
        heads = np.concatenate((np.array(taken, np.int64), left))
        radius = np.concatenate((far, np.zeros(len(left)))).astype(np.float32)
        if len(heads) > WHOLE:
            return np.zeros(size, np.int64)
        order = np.argsort(heads)
        heads, radius = heads[order], radius[order]
        points, squares = points[heads], squares[heads]
    among = np.arange(len(heads))
    limit = np.float32(reach * reach)
    one = np.ones((len(heads), 1), np.float32)
    left, right = np.hstack((-2 * points, squares[:, None], one)), np.hstack((points, one, squares[:, None]))
    rows = max(64, min(256, (1 << 20) // len(heads)))
    for a in range(0, len(heads), rows):  # with itself and those behind it
        apart = left[a : a + rows] @ right[a:].T
        if radius is not None:
            limit = (np.float32(reach) + radius[a : a + rows, None] + radius[None, a:]) ** 2
        close = np.flatnonzero(apart <= limit)
        if len(close) > len(apart):
            x, y = np.divmod(close, apart.shape[1])
            among = merged(among, x + a, y + a)
    return heads[among][np.searchsorted(heads, root)]


def _entries(count: int, threshold: float, ranges: int, dim: int, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(range of cells, entries) of a block of vectors: cells, ids and sketches, one after the other."""
    way = plan(dim, count, threshold)
    parts = [vectors[a : a + HASHED] for a in range(0, len(vectors), HASHED)]
    sketches = np.concatenate([way.sketches(x) for x in parts])
    cells = np.concatenate([way.cells_of(x) for x in parts])
    cut = min(ranges, way.cells)
    for table in range(way.tables):
        cell = cells[:, table]
        order = np.argsort(cell, kind="stable")
        bucket = cell[order] * cut // way.cells
        edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            here = order[a:b]
            yield table * cut + int(bucket[a]), cell[here].astype(np.uint32).tobytes() + ids[here].tobytes() + sketches[here].tobytes()


def _opened(blocks: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cells, ids, sketches = [], [], []
    for x in blocks:
        n = len(x) // (12 + width)
        cells.append(np.frombuffer(x, np.uint32, n))
        ids.append(np.frombuffer(x, np.int64, n, 4 * n))
        sketches.append(np.frombuffer(x, np.int8, n * width, 12 * n).reshape(n, width))
    return np.concatenate(cells), np.concatenate(ids), np.concatenate(sketches)


def _joins(blocks: list[bytes], way: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(id, id it is joined with) of all entries of a range of cells that are joined with another."""
    cells, ids, sketches = _opened(blocks, way.width)
    order = np.argsort(cells, kind="stable")
    cells, ids, sketches = cells[order], ids[order], sketches[order]
    edges = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True])))
    root = np.arange(len(ids))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a > 1:
            root[a:b] = a + joined(sketches[a:b], way.reach)
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[moved], ids[root[moved]]


def worthwhile(threshold: float, count: int, dim: int = 64) -> bool:
    """Whether tables in a reasonable number find the pairs; the length of vectors changes that number little."""
    return plan(dim, count, threshold).cells > 1 or count < 2 * CELL_ROWS


def edges(vectors: DataFrame, count: int, threshold: float, units) -> DataFrame:
    """Joins (a, b) of ids among ``vectors`` (cls, vector), ``count`` rows; repeated rows occur. ``units`` makes arrays of
    vectors unit vectors in double precision."""
    most = max(common.width(vectors.sparkSession), count * 20 * (12 + SKETCH) // (PART_MB << 20))
    ranges = max(1, -(-most // 4))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def flush(dim):
            ids, rows = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            for bucket, block in _entries(count, threshold, ranges, dim, ids, rows):
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([dim], pa.int32()), "bucket": pa.array([bucket], pa.int32()), "block": pa.array([block], pa.binary()),
                })

        for batch in batches:
            dims = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                here = batch.filter(pa.array(dims == dim))
                flat = here.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                held = waiting.setdefault(dim, [])
                held.append((here.column(0).to_numpy(), units(flat.reshape(here.num_rows, -1)).astype(np.float32)))
                if sum(x[1].size for x in held) >= BLOCK:
                    yield from flush(dim)
        for dim in list(waiting):
            yield from flush(dim)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[bytes]] = {}
        for batch in batches:
            for dim, bucket, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held.setdefault((dim, bucket), []).append(block)
        while held:
            (dim, _), blocks = held.popitem()
            a, b = _joins(blocks, plan(dim, count, threshold))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = vectors.select("cls", "vector").mapInArrow(deal, "dim int, bucket int, block binary")
    return dealt.repartition(most, F.col("dim"), F.col("bucket")).mapInArrow(join, "a long, b long")
