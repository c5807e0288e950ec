"""SimHash near-duplicates: word-shingle fingerprints, linked within a Hamming radius by BK-trees.

Texts become 64-bit fingerprints; equal ones are one node. Two fingerprints that differ in at most ``d`` bits agree on
at least ``b - d`` of ``b`` blocks, so each goes to one shard for each choice of that many blocks. A shard builds a
BK-tree, children keyed by their Hamming distance to the parent, and each search follows only the edges within the
radius. A shard of many fingerprints is cut into slices and the tree of each pair of slices is searched by a task of
its own, so no task holds more than two slices. Shard trees stay in their task: fingerprints of all documents have no
size bound, so they are not broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHINGLE, MAX_BITS, SEED = 3, 3, 42
SLICE = 2048
CHUNK = 1 << 16

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def _hashes(words: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, in chunks of bounded length."""
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        if words:
            yield np.array([digest(b" ".join(words), SEED)], np.uint64)
        return
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(sizes + 1) - 1
    starts = stops - sizes
    text = b" ".join(words)
    n = len(words) - shingle + 1
    for k in range(0, n, CHUNK):
        a = starts[k : min(n, k + CHUNK)].tolist()
        b = stops[k + shingle - 1 : min(n, k + CHUNK) + shingle - 1].tolist()
        yield np.fromiter((digest(text[i:j], SEED) for i, j in zip(a, b)), np.uint64, len(a))


def fingerprints(texts, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprints of a batch of texts: a bit is set if over half of the shingles have it.

    A-Z count as a-z, words stand between ASCII white space, repeated shingles count each time. A text of fewer words
    is one shingle; a text without words, or null, has fingerprint 0.
    """
    ones = np.zeros((len(texts), 64))
    total = np.zeros(len(texts))
    held, owners, size = [], [], 0

    def flush():
        nonlocal held, owners, size
        if held:
            raw = np.concatenate(held).astype("<u8").view(np.uint8).astype(np.int64).reshape(-1, 8)
            first = owners[0]
            span = owners[-1] - first + 1
            owner = np.repeat(np.array(owners) - first, [len(h) for h in held])
            at = (owner * 2048)[:, None] + np.arange(8) * 256 + raw
            seen = np.bincount(at.ravel(), minlength=span * 2048).reshape(span, 8, 256)
            ones[first : first + span] += (seen @ _BITS).reshape(span, 64)
        held, owners, size = [], [], 0

    for k, text in enumerate(texts):
        if not text:
            continue
        for part in _hashes(text.encode("utf-8", "surrogatepass").lower().split(), shingle):
            held.append(part)
            owners.append(k)
            size += len(part)
            total[k] += len(part)
            if size >= CHUNK:
                flush()
    flush()
    bits = (ones * 2 > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a signed long; a column of that name is replaced."""
    common.small_batches(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts.tolist(), shingle).view(np.int64))

    return docs.withColumn(out, compute.asNondeterministic()(F.col(text_col).cast("string")))


class BKTree:
    """Fingerprints by Hamming distance. Removed ones stay as inner nodes; branches without others are not entered."""

    def __init__(self, points: list[int]):
        self.points = points
        self.children: list[dict[int, int]] = [{} for _ in points]
        self.parent = [-1] * len(points)
        self.alive = [True] * len(points)
        self.below = [1] * len(points)
        for k in range(1, len(points)):
            self._add(k)

    def _add(self, k: int) -> None:
        point, at = self.points[k], 0
        while True:
            self.below[at] += 1
            far = (self.points[at] ^ point).bit_count()
            child = self.children[at].get(far)
            if child is None:
                self.children[at][far] = k
                self.parent[k] = at
                return
            at = child

    def remove(self, k: int) -> None:
        self.alive[k] = False
        while k >= 0:
            self.below[k] -= 1
            k = self.parent[k]

    def near(self, point: int, radius: int) -> list[int]:
        """Those not removed within the radius."""
        found, stack = [], [0]
        while stack:
            at = stack.pop()
            if not self.below[at]:
                continue
            far = (self.points[at] ^ point).bit_count()
            if far <= radius and self.alive[at]:
                found.append(at)
            children = self.children[at]
            if len(children) <= 2 * radius + 1:
                stack += [child for edge, child in children.items() if -radius <= edge - far <= radius]
            else:
                stack += [children[edge] for edge in range(far - radius, far + radius + 1) if edge in children]
        return found


def spanning_links(points: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join all points connected by steps within the radius: each point is found once, by a neighbour."""
    if len(points) == 2:
        return [(points[0], points[1])] if (points[0] ^ points[1]).bit_count() <= radius else []
    tree, links = BKTree(points), []
    for k in range(len(points)):
        if not tree.alive[k]:
            continue
        tree.remove(k)
        queue = [k]
        while queue and tree.below[0]:
            here = points[queue.pop()]
            for other in tree.near(here, radius):
                tree.remove(other)
                queue.append(other)
                links.append((here, points[other]))
    return links


def _blocks(count: int, max_bits: int) -> int:
    """Blocks to cut the 64 bits into, so that a shard of ``count`` evenly spread fingerprints has a few dozen."""
    blocks = max_bits + 1
    while blocks < 16 and count > 32 << (64 * (blocks - max_bits) // blocks):
        blocks += 1
    return blocks


def _masks(blocks: int, agree: int) -> list[int]:
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    signed = [sum(c) for c in combinations(parts, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in signed]


def links(points: DataFrame, max_bits: int = MAX_BITS, slice_rows: int = SLICE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` of at most ``max_bits`` differing bits, enough of them to
    connect all that are connected."""
    blocks = _blocks(points.count(), max_bits)
    masks = _masks(blocks, blocks - max_bits)
    keys = points.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("choice", "part"),
    )
    large = keys.groupBy("choice", "part").agg(F.count("*").alias("n")).filter(F.col("n") > slice_rows)
    large = large.select("choice", "part", F.ceil(F.col("n") / slice_rows).cast("int").alias("slices"))
    cut = keys.join(large, ["choice", "part"], "left")
    own = F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("slices")).cast("int")
    # slice s meets every other slice t in the pair of both
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda t: t != own),
        lambda t: F.least(t, own) * F.col("slices") + F.greatest(t, own),
    )
    cut = cut.select("choice", "part", "fp", F.explode(F.when(F.col("slices").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("pair"))
    dealt = cut.repartition(F.xxhash64("choice", "part", "pair")).sortWithinPartitions("choice", "part", "pair")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, group, out = None, [], []
        for batch in batches:
            names = ["choice", "part", "pair"]
            cols = [batch[n].to_numpy() for n in names]
            fps = (batch["fp"].to_numpy(np.int64)).view(np.uint64).tolist()
            new = np.ones(len(fps), bool)
            if len(fps) > 1:
                new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
            edges = [*np.flatnonzero(new).tolist(), len(fps)]
            for a, b in zip(edges, edges[1:]):
                now = tuple(c[a] for c in cols)
                if now != key:
                    if len(group) > 1:
                        out += spanning_links(group, max_bits)
                    key, group = now, []
                group += fps[a:b]
            if len(out) >= CHUNK:
                yield _link_frame(out)
                out = []
        if len(group) > 1:
            out += spanning_links(group, max_bits)
        yield _link_frame(out)

    return dealt.mapInPandas(search, "a long, b long")


def _link_frame(found: list[tuple[int, int]]) -> pd.DataFrame:
    flat = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": flat[:, 0], "b": flat[:, 1]})


def groups(rows: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id") -> DataFrame:
    """For rows with ``fp`` and an id: one row (fp, root, component_id) for each distinct fingerprint; root names the
    component, component_id is its smallest id (null if none of its rows has one)."""
    points = common.staged(
        rows.filter("fp is not null").groupBy("fp").agg(F.min(id_col).alias("low")), "simhash-points"
    )
    found = common.components(links(points.select("fp"), max_bits), "simhash")
    rooted = points.join(found.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    rooted = common.staged(rooted, "simhash-rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return common.staged(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-groups")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row for each row: the id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable
    over fingerprints that differ in at most ``max_bits`` bits, its own included.

    Null, empty and blank texts share fingerprint 0 and link like any other. Rows without an id link too but name no
    component; a component without ids has a null component_id. Repeated rows come back repeated.
    """
    rows = with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "fp", shingle)
    rows = common.staged(rows.select("id", "fp"), "simhash-rows")
    named = rows.join(groups(rows, max_bits, "id"), "fp")
    return named.select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that with the smallest id, rows without an id last, the
    first read of several. Columns are kept."""
    columns = common.columns_of(docs)
    rows = with_fingerprint(docs, text_col, "__fp", shingle).withColumn("__row", F.monotonically_increasing_id())
    rows = common.staged(rows, "simhash-docs")
    small = rows.select(F.col("__fp").alias("fp"), F.col(id_col).alias("id"), "__row")
    named = small.join(groups(small, max_bits, "id").select("fp", "root"), "fp")
    kept = named.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__row")).alias("best")
    ).select(F.col("best.__row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*columns)


def op1_simhash(spark, sf_dir) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))
