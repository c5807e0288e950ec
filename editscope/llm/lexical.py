"""Ranked lexical search of a set of items over all documents, exactly, by a dual-tree search.

Documents and items are vectors over the terms of the items: a document has the saturated frequency of each term, an
item its weight times its repeats, and a pair's score is their product, all in 64-bit integers. Both sides are put into
hierarchies whose nodes hold the greatest value of each coordinate below them, so the product of two nodes bounds every
score between them. A search goes down both at once and drops a pair of nodes whose bound is below the weakest k-th
score of the node's items: such pairs can change no result. At a document and an item the bound is the score itself.

Documents are read twice in little: their texts become term counts once, in the shared folder, and every partition is
searched chunk by chunk with the items at hand. The k-th scores start from those of a sample of the documents, which are
bounds for all, and each partition passes on at most k documents an item. Items go in blocks of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOP = 10
FANOUT = 8
BLOCK_TERMS = 1 << 20
CHUNK_ROWS, CHUNK_ENTRIES = 2048, 1 << 19
SEED_ROWS = 20_000
#: The ranking's constants.
SHARE, SATURATION, SCALE, UNIT = 75, 8, 1000, 1_000_000_000

#: Bytes of a term are digits, letters of ASCII in small, and all of any other character; the rest is a blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


# ---- hierarchies -------------------------------------------------------------------------


class Level:
    """Sparse rows of one level of a hierarchy: row r has the coordinates ``ids[at[r]:at[r + 1]]``, in order."""

    __slots__ = ("at", "ids", "values")

    def __init__(self, at: np.ndarray, ids: np.ndarray, values: np.ndarray):
        self.at, self.ids, self.values = at, ids, values

    def __len__(self) -> int:
        return len(self.at) - 1

    def above(self, fanout: int) -> Level:
        """The next level: every ``fanout`` rows become one with the greatest value of each coordinate."""
        sizes = np.diff(self.at)
        owner = np.repeat(np.arange(len(self)) // fanout, sizes)
        rows = -(-len(self) // fanout)
        wide = int(self.ids.max()) + 1 if len(self.ids) else 1
        key = owner * wide + self.ids
        order = np.argsort(key, kind="stable")
        key, values = key[order], self.values[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        top = np.maximum.reduceat(values, first) if len(key) else values
        key = key[first] if len(key) else key
        at = np.searchsorted(key, np.arange(rows + 1) * wide)
        return Level(at, key % wide, top)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the entries of ``rows``, and where each row's entries start among them."""
        sizes = self.at[rows + 1] - self.at[rows]
        starts = np.cumsum(sizes) - sizes
        return np.repeat(self.at[rows] - starts, sizes) + np.arange(int(sizes.sum())), starts


def rows_of(rows: list[tuple[np.ndarray, np.ndarray]]) -> Level:
    sizes = [len(ids) for ids, _ in rows]
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    ids = np.concatenate([ids for ids, _ in rows]) if rows else np.zeros(0, np.int64)
    return Level(at, ids.astype(np.int64), np.concatenate([v for _, v in rows]).astype(np.int64) if rows else ids)


def by_heaviest(level: Level, weights: np.ndarray | None = None) -> np.ndarray:
    """An order that puts rows with the same heaviest coordinates side by side; rows without any come first."""
    worth = level.values if weights is None else level.values * weights[level.ids]
    owner = np.repeat(np.arange(len(level)), np.diff(level.at))
    order = np.lexsort((level.ids, -worth, owner))
    ids = level.ids[order]
    full = np.diff(level.at) > 0
    first = np.full((len(level), 2), -1)
    first[full, 0] = ids[level.at[:-1][full]]
    more = np.diff(level.at) > 1
    first[more, 1] = ids[level.at[:-1][more] + 1]
    return np.lexsort((np.arange(len(level)), first[:, 1], first[:, 0]))


def reordered(level: Level, order: np.ndarray) -> Level:
    at, _ = level.gather(order)
    sizes = (level.at[1:] - level.at[:-1])[order]
    return Level(np.concatenate(([0], np.cumsum(sizes))), level.ids[at], level.values[at])


class Tree:
    """Levels from single rows up to one node."""

    def __init__(self, leaves: Level, fanout: int = FANOUT):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].above(fanout))
        self.fanout = fanout

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """The rows one level below ``nodes``."""
        below = nodes[:, None] * self.fanout + np.arange(self.fanout)
        below = below.ravel()
        return below[below < len(self.levels[level - 1])]


# ---- search ------------------------------------------------------------------------------


@dataclass
class Items:
    """A block of items: the numbers of their terms, and (numbers, repeats) of each item's terms."""

    vocabulary: dict[bytes, int]
    rows: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        rows = []
        for terms in texts:
            counted = Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms)
            ids = np.array(sorted(counted), np.int64)
            rows.append((ids, np.array([counted[i] for i in ids.tolist()], np.int64)))
        return cls(vocabulary, rows)

    def vector(self, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of the block's terms among ``terms``."""
        number = self.vocabulary
        found = [(number[t], n) for t, n in Counter(terms).items() if t in number]
        found.sort()
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


class Search:
    """The items of a block as a hierarchy, their best documents so far, and the scores a document must reach."""

    def __init__(self, items: Items, weights: np.ndarray, top: int = TOP, least: np.ndarray | None = None):
        leaves = rows_of([(ids, repeats * weights[ids]) for ids, repeats in items.rows])
        self.order = by_heaviest(leaves)
        self.tree = Tree(reordered(leaves, self.order))
        self.weights, self.top = weights, top
        self.best: list[list[tuple[int, int]]] = [[] for _ in items.rows]  # (score, -doc), weakest first
        low = np.ones(len(items.rows), np.int64)  # only scores above 0 count
        if least is not None:
            low = np.maximum(low, least)
        self.low = [low[self.order]]
        for level in self.tree.levels[1:]:
            starts = np.arange(len(level)) * self.tree.fanout
            self.low.append(np.minimum.reduceat(self.low[-1], starts) if len(level) else self.low[-1])
        self.pairs = 0

    def raise_low(self, leaf: int, score: int) -> None:
        """The item at ``leaf`` needs ``score`` from now on; the nodes above it need their weakest."""
        self.low[0][leaf] = score
        for k in range(1, len(self.low)):
            parent = leaf // self.tree.fanout
            weakest = self.low[k - 1][parent * self.tree.fanout : (parent + 1) * self.tree.fanout].min()
            if self.low[k][parent] == weakest:
                return
            self.low[k][parent] = weakest
            leaf = parent

    def offer(self, leaf: int, score: int, doc: int) -> None:
        best = self.best[self.order[leaf]]
        entry = (score, -doc)
        if len(best) < self.top:
            heapq.heappush(best, entry)
        elif entry > best[0]:
            heapq.heapreplace(best, entry)
        else:
            return
        if len(best) == self.top and best[0][0] > self.low[0][leaf]:
            self.raise_low(leaf, best[0][0])

    def run(self, docs: Level, ids: np.ndarray) -> None:
        """Take in a chunk of documents: rows of saturated frequencies, and what orders equal scores."""
        if not len(docs) or not self.best:
            return
        order = by_heaviest(docs, self.weights)
        tree, self.docs = Tree(reordered(docs, order)), ids[order]
        self.scratch = np.zeros(len(self.weights), np.int64)
        top = len(self.tree.levels) - 1
        self._visit(tree, len(tree.levels) - 1, 0, top, np.zeros(1, np.int64))

    def _bounds(self, docs: Level, node: int, level: int, nodes: np.ndarray) -> np.ndarray:
        at = slice(docs.at[node], docs.at[node + 1])
        self.scratch[docs.ids[at]] = docs.values[at]
        items = self.tree.levels[level]
        entries, starts = items.gather(nodes)
        products = items.values[entries] * self.scratch[items.ids[entries]]
        self.scratch[docs.ids[at]] = 0
        self.pairs += len(nodes)
        sums = np.concatenate(([0], np.cumsum(products)))
        return sums[np.append(starts[1:], len(entries))] - sums[starts]

    def _visit(self, tree: Tree, depth: int, node: int, level: int, nodes: np.ndarray) -> None:
        """The pairs of document node ``node`` with the item nodes ``nodes``, all of one level."""
        while True:
            bounds = self._bounds(tree.levels[depth], node, level, nodes)
            open_ = bounds >= self.low[level][nodes]
            if not open_.any():
                return
            nodes = nodes[open_]
            if depth > 0 or level == 0:
                break
            nodes, level = self.tree.children(level, nodes), level - 1
        if depth == 0:
            for leaf, score in zip(nodes.tolist(), bounds[open_].tolist()):
                self.offer(leaf, score, int(self.docs[node]))
            return
        if level > 0:
            nodes, level = self.tree.children(level, nodes), level - 1
        for child in tree.children(depth, np.array([node])).tolist():
            self._visit(tree, depth - 1, child, level, nodes)


# ---- Spark -------------------------------------------------------------------------------

VECTORS = "doc_id {}, n long, ids array<int>, counts array<int>"


def vectors(docs: DataFrame, items: Items, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, ids, counts): the number of terms of each document, and which terms of the block it has how often."""
    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(1):
                terms = terms_of(text.as_py())
                sizes.append(len(terms))
                found.append(block.vector(terms))
            at = pa.array(np.concatenate(([0], np.cumsum([len(i) for i, _ in found]))), pa.int32())
            flat = [pa.array(np.concatenate([f[k] for f in found]), pa.int32()) if found else pa.array([], pa.int32()) for k in (0, 1)]
            lists = [pa.ListArray.from_arrays(at, values) for values in flat]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "ids", "counts"])

    return rows.mapInArrow(count, VECTORS.format(rows.schema["doc_id"].dataType.simpleString()))


def _frequencies(found: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the block occurs. Each task adds up its own counts first; the driver gets one
    row for a term of the block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["term", "df"])

    counts = found.select("ids").mapInArrow(add, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for row in counts.collect():
        out[row["term"]] = row["df"]
    return out


def _best(found: DataFrame, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, top: int, least) -> DataFrame:
    """At most ``top`` documents an item and partition: ``item`` (its place in the block), ``doc_id``, ``score``. None of
    the best of all is missing."""
    shared = found.sparkSession.sparkContext.broadcast((items, weights, least))
    kind = found.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weighed, low = shared.value
        state = Search(block, weighed, top, low)
        held: list[pa.RecordBatch] = []
        entries = rows = 0

        def flush() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            n = table.column("n").to_numpy()
            ids = table.column("ids").chunk(0)
            at = ids.offsets.to_numpy().astype(np.int64)
            terms = ids.values.to_numpy()[at[0] : at[-1]].astype(np.int64)
            often = table.column("counts").chunk(0).flatten().to_numpy().astype(np.int64)
            length = (100 - SHARE) + (SHARE * n * n_docs) // n_terms
            norm = np.repeat(length, np.diff(at))
            impact = (UNIT * often) // (SCALE * often + SATURATION * norm)
            names = table.column("doc_id")
            order = names.fill_null((1 << 63) - 1).to_numpy().astype(np.int64)
            state.run(Level(at - at[0], terms, impact), order)

        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(start, CHUNK_ROWS)
                held.append(part)
                rows += part.num_rows
                entries += len(part.column(2).flatten())
                if rows >= CHUNK_ROWS or entries >= CHUNK_ENTRIES:
                    flush()
                    held, rows, entries = [], 0, 0
        if held:
            flush()
        out = [(k, -doc, score) for k, best in enumerate(state.best) for score, doc in best]
        item, doc, score = zip(*out) if out else ((), (), ())
        doc = pa.array([None if d == (1 << 63) - 1 else d for d in doc], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), doc, pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    if kind != "bigint":
        raise TypeError("documents are ranked by a bigint id")
    return found.mapInArrow(search, "item long, doc_id long, score long")


def _top(rows: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _blocks(items: DataFrame, item_col: str, text_col: str, block_terms: int) -> Iterator[tuple[list, Items]]:
    """Items in blocks of at most ``block_terms`` terms (one item may have more), passed through one at a time."""
    names, texts, size = [], [], 0
    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    for row in rows.toLocalIterator():
        terms = terms_of(row["text"])
        if names and size + len(terms) > block_terms:
            yield names, Items.of(texts)
            names, texts, size = [], [], 0
        names.append(row["item"])
        texts.append(terms)
        size += len(terms)
    if names:
        yield names, Items.of(texts)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", block_terms: int = BLOCK_TERMS, seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """The ``top`` documents with the highest score above 0 for each row of ``items``: ``item_id``, ``rank`` (from 1),
    ``doc_id``, ``score``. Equal scores rank by ascending id, documents without one last.

    Rows count each for itself: repeated documents are ranked beside each other, repeated items have results of their
    own. Null and empty texts have no terms; they match nothing and do not count as documents. Other columns are not
    looked at. Exact: bounds and the sample of ``seed_rows`` documents that starts the k-th scores only save work.
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    results = None
    for names, block in _blocks(items, item_col, item_text, block_terms):
        found = common.staged(vectors(docs, block, id_col, text_col).filter("n > 0"), "lexical-vectors")
        total = found.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        n_docs, n_terms = total["n"], total["terms"]
        df = _frequencies(found, len(block.vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        arguments = (block, weights, n_docs, max(n_terms, 1), top)
        share = F.pmod(F.xxhash64("doc_id", "n"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, seed_rows / max(n_docs, 1))))
        tried = _top(_best(found.filter(share), *arguments, None), top, "item").filter(F.col("rank") == top)
        least = np.zeros(len(names), np.int64)
        for row in tried.select("item", "score").collect():  # at most one row an item of the block
            least[row["item"]] = row["score"]
        best = _best(found, *arguments, least)
        # two steps, so that no task gets the rows of one item from all partitions
        near = _top(best.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(common.width(spark)))), top, "item", "part")
        ranked = _top(near.drop("part", "rank"), top, "item")
        named = spark.createDataFrame(list(enumerate(names)), f"item long, item_id {kind}")
        part = common.staged(ranked.join(named, "item").select("item_id", "rank", "doc_id", "score"), "lexical-ranked")
        results = part if results is None else results.union(part)
    if results is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return results


def op13_lexical(spark, sf_dir) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), total AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), tf AS (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM d) GROUP BY ALL
), weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM tf, total GROUP BY t
), q AS (
  SELECT item_id, unnest(w) AS t FROM b
), scores AS (
  SELECT item_id, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN weight USING (t), total GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
