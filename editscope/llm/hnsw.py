"""Embedding near-duplicates: a navigable small-world graph for each shard, searched for every vector that can link in it.

Exact copies are one class. Classes are joined into neighbourhoods (``neighbourhoods.py``), which hold all links but for a
stated small chance, and a shard holds whole neighbourhoods; a class without a neighbour links with nothing. A task builds
the graph of its shard and then streams the classes through it in batches, all searches of a batch side by side in
numpy. A neighbourhood too large for a shard has several, and all of these are searched for each of its classes.
Vectors of a shard that lie close together are one group: the graph has its head, and a group that lies wholly within the
links' angle of a vector counts as a whole, one that lies across it is checked member by member. A search for a vector of
the shard enters the graph also at its head and at those of some of its neighbours. The beam of a search is set before any link is returned: it is widened until the
shard's own sample, searched in the graph, misses nothing that a look at all vectors finds. Later audits of a few
searches can widen it further, for their batch and those that follow. A beam that ends full of links is widened for its
search until something else is in it, or all heads are looked at. Links count after their cosine holds in double
precision. Tasks return sums and joining edges, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, neighbourhoods

THRESHOLD = 0.95
#: Shards at least; classes of a shard at most, and on average where a shard holds many neighbourhoods; classes with
#: neighbours up to which their list of two numbers each is broadcast, more are joined.
SHARDS, SHARD_ROWS, PACKED_ROWS, NEAR_ROWS = 12, 200_000, 10_000, 2_000_000
DEGREE, BUILD_BEAM, BEAM = 14, 40, 24
#: Of a node's closest neighbours, so many, one at least points back; others of a neighbourhood at which a search starts.
CLOSE, BESIDE = 4, 8
#: Own vectors that set the beam; searches of an audit, one in so many batches; share of the links that must be found.
CALIBRATED, AUDITED, AUDIT_EVERY, TARGET = 256, 12, 16, 0.995
BATCH = 512
#: Heads to a place of a full beam up to which a look at all heads takes less than a wider beam; scores of a look at once.
LOOK, LOOKED = 256, 1 << 22
#: Bits of the cells in which groups are looked for, and heads tried in a cell.
CELL_BITS, CELL_HEADS = 20, 16
#: Float32 sums may be off by this much; the double check decides.
SLACK = 1e-4


class Graph:
    """Navigable layers over unit vectors. Nodes are in falling order of level, so a layer is a prefix of them."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 0):
        self.size = len(vectors)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(self.size)) / np.log(degree)).astype(int)
        self.order = np.argsort(-level, kind="stable")
        level = level[self.order]
        self.vectors = np.ascontiguousarray(vectors[self.order], np.float32)
        self.degree = degree
        sizes = [int((level >= k).sum()) for k in range((level.max() if self.size else 0) + 1)]
        self.layers = [np.full((n, 2 * degree), -1, np.int32) for n in sizes]
        self.used = [np.zeros(n, np.int32) for n in sizes]
        done = min(self.size, 2 * degree)
        if done:
            self._insert(0, done, level, beam)
        while done < self.size:
            stop = min(self.size, done + min(BATCH, max(1, done // 2)))
            self._insert(done, stop, level, beam)
            done = stop
        self.place = np.argsort(self.order)
        self._adopt()

    def _insert(self, start: int, stop: int, level: np.ndarray, beam: int) -> None:
        fresh = self.vectors[start:stop]
        near = fresh @ fresh.T
        entry = None
        for k in range(len(self.layers) - 1, -1, -1):
            inside = int(np.searchsorted(-level[start:stop], -k, side="right"))  # those with this layer come first
            ready = min(start, len(self.layers[k]))
            found, sims = None, None
            if ready:
                found, sims = self._beam(k, fresh, entry, beam if inside else 4, ready)
                entry = found[:, : min(4, found.shape[1])]
            for n in range(inside):
                ids = np.arange(start, start + n)
                scores = near[n, :n]
                if found is not None:
                    good = found[n] >= 0
                    ids = np.concatenate((found[n][good], ids))
                    scores = np.concatenate((sims[n][good], scores))
                if len(ids):
                    best = np.argsort(-scores, kind="stable")[:beam]
                    self._connect(k, start + n, ids[best], scores[best])

    def _pick(self, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """At most ``degree`` neighbours: first those closer to the node than to any chosen one, then the closest."""
        if len(ids) <= self.degree:
            return ids
        among = self.vectors[ids] @ self.vectors[ids].T
        chosen = [0]
        blocked = among[0].copy()
        for k in range(1, len(ids)):
            if scores[k] > blocked[k]:
                chosen.append(k)
                if len(chosen) == self.degree:
                    break
                np.maximum(blocked, among[k], out=blocked)
        if len(chosen) < self.degree:
            rest = np.ones(len(ids), bool)
            rest[chosen] = False
            chosen += np.flatnonzero(rest)[: self.degree - len(chosen)].tolist()
        return ids[chosen]

    def _connect(self, k: int, node: int, ids: np.ndarray, scores: np.ndarray) -> None:
        layer, used = self.layers[k], self.used[k]
        mine = self._pick(ids, scores)
        layer[node, : len(mine)] = mine
        used[node] = len(mine)
        for other in mine.tolist():
            if used[other] < layer.shape[1]:
                layer[other, used[other]] = node
                used[other] += 1
                continue
            ids = np.append(layer[other], node)
            scores = self.vectors[ids] @ self.vectors[other]
            best = np.argsort(-scores, kind="stable")
            keep = self._pick(ids[best], scores[best])
            layer[other] = -1
            layer[other, : len(keep)] = keep
            used[other] = len(keep)

    def _adopt(self) -> None:
        """A node of the lowest layer that none of its closest neighbours points to is hardly found from where it lies: the
        closest one points to it, in a free place or instead of a node that more than one other points to."""
        layer = self.layers[0]
        at, place = np.nonzero(layer >= 0)
        to = layer[at, place].astype(np.int64)
        met = np.bincount(to, minlength=self.size)
        scores = np.full(layer.shape, -2.0, np.float32)
        for a in range(0, len(at), 1 << 16):
            b = slice(a, a + (1 << 16))
            scores[at[b], place[b]] = np.einsum("ij,ij->i", self.vectors[at[b]], self.vectors[to[b]])
        close = np.argsort(-scores, axis=1, kind="stable")[:, :CLOSE]
        both = np.zeros(layer.shape, bool)
        both[at, place] = np.isin(at * self.size + to, to * self.size + at)
        for node in np.flatnonzero(~np.take_along_axis(both, close, 1).any(axis=1)).tolist():
            for other in layer[node, close[node]].tolist():
                free = np.flatnonzero((layer[other] < 0) | (met[layer[other]] > 1)) if other >= 0 else ()
                if len(free):
                    if layer[other, free[-1]] >= 0:
                        met[layer[other, free[-1]]] -= 1
                    layer[other, free[-1]] = node
                    met[node] += 1
                    break

    def _beam(self, k: int, queries: np.ndarray, entry: np.ndarray | None, beam: int, ready: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of layer ``k`` closest to each query, by a beam search of all queries side by side; -1 for none."""
        count, rows = len(queries), np.arange(len(queries))
        beam = min(beam, ready)
        if entry is None:
            entry = np.zeros((count, 1), np.int32)
        seen = np.zeros((count, ready), bool)
        ids = np.full((count, beam), -1, np.int64)
        sims = np.full((count, beam), -2.0, np.float32)
        open_ = np.zeros((count, beam), bool)
        more = np.where(entry >= 0, entry, 0).astype(np.int64)
        active = rows
        fresh = entry >= 0
        while True:
            query, column = np.nonzero(fresh)  # entries that are not fresh stand at node 0 and must not unmark it
            node = more[query, column]
            score = np.full(more.shape, -2.0, np.float32)
            score[query, column] = np.einsum("ij,ij->i", self.vectors[node], queries[active[query]])
            seen[active[query], node] = True
            all_ids = np.concatenate((ids[active], np.where(fresh, more, -1)), axis=1)
            all_sims = np.concatenate((sims[active], score), axis=1)
            all_open = np.concatenate((open_[active], fresh), axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            side = np.arange(len(active))[:, None]
            ids[active], sims[active], open_[active] = all_ids[side, top], all_sims[side, top], all_open[side, top]
            going = open_[active].any(axis=1)
            active = active[going]
            if not len(active):
                break
            next_ = np.where(open_[active], sims[active], -3.0).argmax(axis=1)
            open_[active, next_] = False
            more = self.layers[k][ids[active, next_]].astype(np.int64)
            fresh = (more >= 0) & (more < ready)
            more = np.where(fresh, more, 0)
            fresh &= ~seen[active[:, None], more]
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, queries: np.ndarray, beam: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (in the order given to the graph, -1 for none) and cosines of the closest to each unit vector; ``own`` has
        nodes known to be close (-1 for none), where the lowest layer is entered as well."""
        entry = None
        for k in range(len(self.layers) - 1, 0, -1):
            entry = self._beam(k, queries, entry, 8, len(self.layers[k]))[0][:, :8]
        if own is not None:
            entry = np.full((len(queries), 1), -1) if entry is None else entry
            entry = np.sort(np.concatenate((np.where(own >= 0, self.place[own], -1), entry), axis=1), axis=1)
            entry[:, 1:][entry[:, 1:] == entry[:, :-1]] = -1
        found, sims = self._beam(0, queries, entry, beam, self.size)
        return np.where(found >= 0, self.order[found], -1), sims


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows over their largest component, then over their length, in double precision."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def tight_groups(vectors: np.ndarray, tight: float, seed: int = 0) -> np.ndarray:
    """For each unit vector the place of its head, whose cosine with it is at least ``tight``; heads are their own.

    Groups are looked for in cells, the signs of some random projections, a few heads a cell; vectors that no head takes
    are groups of one. Missing a group costs time only.
    """
    head = np.arange(len(vectors))
    if len(vectors) < 2:
        return head
    planes = np.random.default_rng(seed).normal(size=(vectors.shape[1], CELL_BITS))
    cell = ((vectors @ planes > 0) << np.arange(CELL_BITS)).sum(axis=1)
    order = np.argsort(cell, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(cell[order]) != 0, [True])))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        left = order[a:b]
        for _ in range(CELL_HEADS):
            if len(left) < 2:
                break
            near = vectors[left] @ vectors[left[0]] >= tight
            near[0] = True
            head[left[near]] = left[0]
            left = left[~near]
    return head


class Shard:
    """One shard: its groups, the graph of their heads, and the links of batches of vectors to it."""

    def __init__(self, vectors: np.ndarray, threshold: float = THRESHOLD):
        self.exact, self.threshold = vectors, threshold
        self.angle = float(np.arccos(threshold))
        self.head = tight_groups(vectors, np.cos(self.angle / 3))
        self.heads, self.group = np.unique(self.head, return_inverse=True)  # a vector's group, as a place among heads
        self.members = np.argsort(self.group, kind="stable")
        self.at = np.concatenate(([0], np.cumsum(np.bincount(self.group, minlength=len(self.heads)))))
        spread = np.arccos(np.clip(np.einsum("ij,ij->i", vectors, vectors[self.head]), -1, 1))
        spread[self.head == np.arange(len(vectors))] = 0
        self.radius = np.zeros(len(self.heads))
        np.maximum.at(self.radius, self.group, spread)
        self.small = vectors[self.heads].astype(np.float32)
        self.graph = Graph(self.small)
        self.floor = float(np.cos(self.angle + self.radius.max(initial=0.0))) - SLACK
        self.beam, self.waiting = BEAM, np.zeros((0, vectors.shape[1] if vectors.ndim > 1 else 0), np.float32)
        step = max(1, len(self.small) // CALIBRATED)
        sample = self.small[::step]
        truth = self._pairs(*self._all(sample))
        while self.beam < len(self.small) and not self._finds(truth, sample):
            self.beam *= 2

    def _all(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = max(1, LOOKED // max(1, len(self.small)))
        parts = [np.nonzero(queries[a : a + rows] @ self.small.T >= self.floor) for a in range(0, max(1, len(queries)), rows)]
        return np.concatenate([q + k * rows for k, (q, _) in enumerate(parts)]), np.concatenate([n for _, n in parts])

    @staticmethod
    def _pairs(query: np.ndarray, node: np.ndarray) -> set:
        return set(zip(query.tolist(), node.tolist()))

    def _finds(self, truth: set, queries: np.ndarray) -> bool:
        missed = len(truth - self._pairs(*self._search(queries, self.beam)))
        return missed <= (1 - TARGET) * len(truth)

    def _search(self, queries: np.ndarray, beam: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Candidates (query, place among heads) of a batch; beams full of them are widened, up to a look at all heads
        where that takes less."""
        if beam >= len(self.small):
            return self._all(queries)
        found, sims = self.graph.search(queries, beam) if own is None else self.graph.search(queries, beam, own)
        near = (sims >= self.floor) & (found >= 0)
        full = near.all(axis=1)
        near[full] = False
        query, place = np.nonzero(near)
        node = found[query, place]
        if full.any():
            which = np.flatnonzero(full)
            if len(self.small) <= LOOK * beam:
                again, more = self._all(queries[which])
            else:
                again, more = self._search(queries[which], beam * 4, None if own is None else own[which])
            query, node = np.concatenate((query, which[again])), np.concatenate((node, more))
        return query, node

    def _audit(self, queries: np.ndarray, turn: int) -> None:
        """Every so many batches a few searches are held against all heads. Those without a link test nothing and wait for
        the next audit, a bounded number of them."""
        if turn % AUDIT_EVERY or self.beam >= len(self.small) or not len(queries):
            return
        step = max(1, len(queries) // AUDITED)
        sample = np.concatenate((self.waiting, queries[(turn // AUDIT_EVERY) % step :: step]))[-8 * AUDITED :]
        truth = self._pairs(*self._all(sample))
        self.waiting = sample if not truth else sample[:0]
        while truth and self.beam < len(self.small) and not self._finds(truth, sample):
            self.beam *= 2

    def found(
        self, vectors: np.ndarray, turn: int = 1, own: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Links of unit vectors: (query, group) of groups that link as a whole, and (query, node) of single links. ``own``
        has, for vectors of the shard itself, their nodes and some of their neighbours' (-1 for none)."""
        queries = vectors.astype(np.float32)
        self._audit(queries, turn)
        query, group = self._search(queries, self.beam, None if own is None else np.where(own >= 0, self.group[own], -1))
        cosine = np.einsum("ij,ij->i", vectors[query], self.exact[self.heads[group]])
        angle = np.arccos(np.clip(cosine, -1, 1))
        whole = (angle + self.radius[group] <= self.angle - 1e-6) & (self.radius[group] > 0)
        near = ~whole & (angle - self.radius[group] <= self.angle + 1e-6)
        sizes = (self.at[1:] - self.at[:-1])[group[near]]
        starts = np.cumsum(sizes) - sizes
        single = np.repeat(query[near], sizes)
        node = self.members[np.repeat(self.at[group[near]] - starts, sizes) + np.arange(int(sizes.sum()))]
        holds = np.einsum("ij,ij->i", vectors[single], self.exact[node]) >= self.threshold
        return query[whole], group[whole], single[holds], node[holds]

    def links(self, vectors: np.ndarray, turn: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``vectors``, node) of all links found."""
        query, group, single, node = self.found(vectors, turn)
        sizes = (self.at[1:] - self.at[:-1])[group]
        starts = np.cumsum(sizes) - sizes
        each = self.members[np.repeat(self.at[group] - starts, sizes) + np.arange(int(sizes.sum()))]
        return np.concatenate((np.repeat(query, sizes), single)), np.concatenate((each, node))


def usable(vector: Column) -> Column:
    """Whether a vector can link: no null or non-finite component, and one that is not zero."""
    most, least = F.array_max(vector), F.array_min(vector)  # NaN is more than infinity
    finite = F.forall(vector, lambda x: x.isNotNull()) & (most < float("inf")) & (least > float("-inf"))
    return F.coalesce(finite & ((most > 0) | (least < 0)), F.lit(False))


def _everywhere(classes: DataFrame, shards: int) -> DataFrame:
    """Each class in a shard of its own and, as one that is searched, away in all the others."""
    return classes.select(
        "cls", "weight", "vector", F.lit(None).cast("long").alias("root"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("cls"), F.lit(shards)).alias("home"),
    ).withColumn("away", F.col("shard") != F.col("home"))


def _by_neighbourhood(classes: DataFrame, count: int, threshold: float) -> tuple[DataFrame, int]:
    """Each class that has a neighbour in a shard with all of its neighbourhood, and the number of shards; classes without
    one have no link to be found and are in no shard. A neighbourhood of more than ``SHARD_ROWS`` classes has shards of
    its own; its classes are away in all of these but one."""
    joins = neighbourhoods.edges(classes.select("cls", "vector"), count, threshold, units)
    roots = common.staged(common.components(joins, "hnsw-near"), "hnsw-roots")
    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    near = roots.count()
    packed = max(SHARDS, -(-near // PACKED_ROWS))
    large, shards = [], packed
    for r in sizes.filter(F.col("size") > SHARD_ROWS).sort("root").collect():  # a few: each has more than SHARD_ROWS classes
        large.append((r["root"], shards, -(-r["size"] // SHARD_ROWS)))
        shards += large[-1][2]
    frame = classes.sparkSession.createDataFrame(large, "root long, start int, parts int")
    placed = roots.withColumnRenamed("id", "cls")
    placed = classes.join(F.broadcast(placed) if near <= NEAR_ROWS else placed, "cls")
    if large:
        placed = placed.join(F.broadcast(frame), "root", "left")
    else:
        placed = placed.withColumns({"start": F.lit(None).cast("int"), "parts": F.lit(None).cast("int")})
    start = F.coalesce("start", F.pmod(F.xxhash64("root"), F.lit(packed)).cast("int"))
    placed = placed.select("cls", "weight", "vector", "root", start.alias("start"), F.coalesce("parts", F.lit(1)).alias("parts"))
    dealt = placed.select(
        "cls", "weight", "vector", "root", F.explode(F.expr("sequence(start, start + parts - 1)")).alias("shard"),
        (F.col("start") + F.pmod(F.xxhash64("cls"), F.col("parts"))).alias("home"),
    )
    return dealt.withColumn("away", F.col("shard") != F.col("home")), shards


def _found(every: DataFrame, shards: int, threshold: float) -> DataFrame:
    """For every class and shard with links: (cls, other, weight): the rows that the class links to there, and one
    joining edge; edges within a shard come with weight 0."""
    dealt = every.drop("home").withColumn("dim", F.size("vector")).repartitionByRange(shards, "shard").sortWithinPartitions("dim", "shard", "away", "root", "cls")
    kind = pa.schema([("cls", pa.int64()), ("other", pa.int64()), ("weight", pa.int64())])

    def rows(cls, other, weight):
        return pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(other, pa.int64()), pa.array(weight, pa.int64())], schema=kind)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _), parts in _by_key(batches):
            yield from _shard_links(parts, threshold, rows)

    return dealt.select("dim", "shard", "away", "cls", "weight", "vector", F.coalesce("root", "cls").alias("root")).mapInArrow(search, "cls long, other long, weight long")


def _by_key(batches: Iterator[pa.RecordBatch]):
    """Sorted batches as one stream of parts for each (dim, shard)."""
    pending: list = []

    def cut():
        for batch in batches:
            if not batch.num_rows:
                continue
            dim, shard = (batch.column(k).to_numpy() for k in (0, 1))
            edges = np.flatnonzero((dim[1:] != dim[:-1]) | (shard[1:] != shard[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(dim)]):
                yield (int(dim[a]), int(shard[a])), batch.slice(a, b - a)

    parts = cut()

    def stream(key):
        while pending and pending[0][0] == key:
            yield pending.pop()[1]
            after = next(parts, None)
            if after is not None:
                pending.append(after)

    first = next(parts, None)
    if first is not None:
        pending.append(first)
    while pending:
        key = pending[0][0]
        group = stream(key)
        yield key, group
        for _ in group:
            pass


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    flat = batch.column(5).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (
        batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(), batch.column(4).to_numpy(),
        units(flat.reshape(batch.num_rows, -1)), batch.column(6).to_numpy(),
    )


def _beside(roots: np.ndarray) -> np.ndarray:
    """For each place its own and the next ``BESIDE`` places of the same root, from the last on to the first; -1 for none.
    Equal roots stand together."""
    places = np.arange(len(roots))
    edges = np.flatnonzero(np.concatenate(([True], roots[1:] != roots[:-1], [True])))
    sizes = np.diff(edges)
    size, start = np.repeat(sizes, sizes)[:, None], np.repeat(edges[:-1], sizes)[:, None]
    ahead = np.arange(BESIDE + 1)
    return np.where(ahead < size, start + (places[:, None] - start + ahead) % size, -1)


def _shard_links(parts: Iterator[pa.RecordBatch], threshold: float, rows) -> Iterator[pa.RecordBatch]:
    """The shard's own rows come first and make the graph; they and all that follow are searched."""
    own: list[tuple[np.ndarray, ...]] = []
    shard, ids, weights, joined, whole, beside, turn = None, None, None, None, None, None, 0

    def search(cls, vectors, own=False):
        nonlocal turn
        for a in range(0, len(cls), BATCH):
            turn += 1
            here = vectors[a : a + BATCH]
            query, group, single, node = shard.found(here, turn, beside[a : a + BATCH] if own else None)
            worth = whole[group]
            if own:  # a vector is no link of its own
                mine = shard.group[a + query] == group
                worth = worth - np.where(mine, weights[a + query], 0)
                query, group, worth = query[worth > 0], group[worth > 0], worth[worth > 0]
                other = node != a + single
                single, node = single[other], node[other]
            query = np.concatenate((query, single))
            node, worth = np.concatenate((shard.heads[group], node)), np.concatenate((worth, weights[node]))
            if not len(query):
                continue
            order = np.argsort(query, kind="stable")
            query, node, worth = query[order], node[order], worth[order]
            start = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
            first = np.repeat(node[start], np.diff(np.append(start, len(query))))
            for x, y in set(zip(first.tolist(), node.tolist())):
                joined.union(x, y)
            yield rows(cls[a : a + BATCH][query[start]], ids[node[start]], np.add.reduceat(worth, start))

    def build():
        nonlocal shard, ids, weights, joined, whole, beside
        ids, weights, roots = (np.concatenate([x[k] for x in own]) for k in (0, 1, 3))
        beside = _beside(roots)
        shard = Shard(np.concatenate([x[2] for x in own]), threshold)
        whole = np.bincount(shard.group, weights=weights, minlength=len(shard.heads)).astype(np.int64)
        joined = common.UnionFind(len(ids))
        for x, y in zip(shard.head.tolist(), range(len(ids))):  # members link to their head, and to each other
            joined.union(x, y)

    for batch in parts:
        away, cls, weight, vectors, roots = _arrays(batch)
        if (~away).any():
            own.append((cls[~away], weight[~away], vectors[~away], roots[~away]))
        if away.any() and own:
            if shard is None:
                build()
                yield from search(ids, shard.exact, True)
            yield from search(cls[away], vectors[away])
    if own and shard is None:
        build()
        yield from search(ids, shard.exact, True)
    if joined is not None:
        roots = np.array([joined.find(k) for k in range(len(ids))])
        moved = np.flatnonzero(roots != np.arange(len(ids)))
        if len(moved):
            yield rows(ids[moved], ids[roots[moved]], np.zeros(len(moved), np.int64))


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
    shards: int | None = None,
) -> DataFrame:
    """One row for each row: the id, ``n_links`` (other rows of a cosine of at least ``threshold``), ``component_id``
    (smallest id reachable by links, its own included) and ``kept`` (the id is the component's).

    Vectors that are null, zero, or hold a null or non-finite component link with nothing; vectors of different length
    do not link. Rows without an id link but name no component. Repeated rows are vectors of their own.
    """
    spark = vectors.sparkSession
    common.small_batches(spark)
    value = F.col(vector_col)
    if vectors.schema[vector_col].dataType != T.ArrayType(T.FloatType()):
        value = value.cast("array<double>")
    rows = vectors.select(
        F.col(id_col).alias("id"), F.when(usable(value), value).alias("vector"),
    ).withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(7), "vector")})
    groups = rows.filter("vector is not null").groupBy("h1", "h2").agg(
        F.count("*").alias("weight"), F.min("id").alias("low"), F.first("vector").alias("vector")
    ).withColumn("cls", F.monotonically_increasing_id())
    classes = common.staged(groups, "hnsw-classes")
    count = classes.count()
    if shards or not neighbourhoods.worthwhile(threshold, count):
        shards = shards or max(SHARDS, -(-count // SHARD_ROWS))
        every = _everywhere(classes, shards)
    else:
        every, shards = _by_neighbourhood(classes, count, threshold)
    found = common.staged(_found(every, shards, threshold), "hnsw-links")
    sums = found.groupBy("cls").agg(F.sum("weight").alias("links"))
    roots = common.components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")), "hnsw")
    named = classes.drop("vector").join(roots.withColumnRenamed("id", "cls"), "cls", "left").join(sums, "cls", "left").select(
        "h1", "h2", "low", F.coalesce("root", "cls").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
    )
    named = common.staged(named, "hnsw-named")
    least = named.groupBy("root").agg(F.min("low").alias("least"))
    named = common.staged(named.join(least, "root").select("h1", "h2", "n", "least"), "hnsw-result")
    plain = rows.select("id", "h1", "h2", F.col("vector").isNotNull().alias("usable"))
    alone = plain.filter("not usable").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("least"))
    linked = plain.filter("usable").join(named, ["h1", "h2"]).select("id", "n", "least")
    return linked.union(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_links"), F.col("least").alias("component_id"),
        F.coalesce(F.col("id") == F.col("least"), F.lit(False)).alias("kept"),
    )


def op9_hnsw(spark, sf_dir) -> DataFrame:
    """Near-duplicate links and components of all embeddings, whatever their labels."""
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), usable AS (
  SELECT vec_id, e FROM vectors
  WHERE e IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reached(id, other) AS (
  SELECT vec_id, vec_id FROM vectors
  UNION
  SELECT links.a, reached.other FROM reached JOIN links ON reached.id = links.b
), lowest AS (
  SELECT id, min(other) AS component_id FROM reached GROUP BY id
), counts AS (
  SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN lowest ON vec_id = id LEFT JOIN counts ON vec_id = a
"""
