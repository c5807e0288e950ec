"""Merkle manifest of a dataset: one root for all rows, a proof for each, and a check of rows against it.

Rows become leaves by a hash of their fields. The leaves of a group stand in the order of their key; every run of
``FANOUT`` consecutive nodes becomes their hash until one is left, the subroot, and the subroots of all groups make the
root in the same way. A tree is stored as blocks of ``FANOUT ** 2`` neighbours, each one row, so no task holds more
than that of a group, however large, and each tier of blocks is that much smaller than the one below.

A node's hash is taken over the texts of its children one after the other. ``Parent`` keeps a copy of the hash state
before each child. To see what a changed child makes of it, the state kept for that child goes on with the replacement
and the children to its right; those to its left are not hashed again. A block builds its parents once and folds each
of its leaves through them, and through the parents above the block, whose siblings arrive as one row a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

FANOUT = 16
BLOCK = FANOUT * FANOUT
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVEL = "struct<left:string,right:string>"


class Parent:
    """A node over ``children`` (digests as bytes of hex text): its digest, and the hash state before each child."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[bytes]):
        self.children = children
        self.states = []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def siblings(self, place: int) -> bytes:
        return b"".join(self.children[:place] + self.children[place + 1 :])

    def fold(self, place: int, child: bytes) -> bytes:
        """The digest with another child at ``place``."""
        state = self.states[place].copy()
        state.update(child)
        state.update(b"".join(self.children[place + 1 :]))
        return state.hexdigest().encode()


class Above:
    """A node on the way from a block to the root: the state kept before the block's side, and what stands right of it."""

    __slots__ = ("state", "right", "siblings")

    def __init__(self, left: str, right: str):
        self.state = hashlib.sha256(left.encode())
        self.right = right.encode()
        self.siblings = left.encode() + self.right

    def fold(self, child: bytes) -> bytes:
        state = self.state.copy()
        state.update(child)
        state.update(self.right)
        return state.hexdigest().encode()


def levels_of(nodes: int) -> int:
    """How many times a row of nodes is put together until one is left."""
    levels = 0
    while nodes > 1:
        nodes = -(-nodes // FANOUT)
        levels += 1
    return levels


def audit_block(digests: list[str], changed: list[str | None], lifts: int, path: list[tuple[str, str]]):
    """For each leaf of a block: the hash of its siblings on the way to the root, and the root that the changed leaf
    (the leaf itself if there is none) would give.

    ``lifts`` is the number of levels inside the block, 0 to 2; ``path`` the siblings above it.
    """
    leaves = [d.encode() for d in digests]
    runs = [Parent(leaves[k : k + FANOUT]) for k in range(0, len(leaves), FANOUT)] if lifts else []
    top = Parent([run.digest for run in runs]) if lifts > 1 else None
    above = [Above(left, right) for left, right in path]
    shared = b"".join(level.siblings for level in above)
    for k, leaf in enumerate(leaves):
        run, place = divmod(k, FANOUT)
        node = leaf if changed[k] is None else changed[k].encode()
        proof = hashlib.sha256()
        if runs:
            proof.update(runs[run].siblings(place))
            node = runs[run].fold(place, node)
        if top:
            proof.update(top.siblings(run))
            node = top.fold(run, node)
        proof.update(shared)
        for level in above:
            node = level.fold(node)
        yield proof.hexdigest(), node.decode()


# ---- leaves ------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """A field as it goes into a leaf: ``-`` for null, else its bytes in UTF-8, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """The group as a text that is never null and sorts null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def numbered(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """``rows`` (with a text column ``key``, never null) with ``idx``, their place from 0 within the key by ``order``, and
    ``n``, the rows of the key.

    Rows are cut into ranges of (key, order), so a key with a large share of all rows is spread. Each range counts its
    own rows, and the counts of a key's earlier ranges are added. Rows that are equal in ``order`` are told apart by
    the place they were written at.
    """
    spark = rows.sparkSession
    width = common.width(spark)
    written = common.staged(rows.withColumn("seq", F.monotonically_increasing_id()), f"{name}-rows")
    place = F.monotonically_increasing_id()
    ranged = (
        written.repartitionByRange(width, "key", *order, "seq")
        .sortWithinPartitions("key", *order, "seq")
        .withColumns({"part": F.shiftright(place, 33), "pos": place.bitwiseAND(F.lit((1 << 33) - 1))})
    )
    ranged = common.staged(ranged.drop("seq"), f"{name}-ranges")
    starts = ranged.groupBy("key", "part").agg(F.min("pos").alias("start"), F.count("*").alias("own"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("own").over(earlier), F.lit(0))
    starts = starts.select(
        "key", "part", (base - F.col("start")).alias("shift"), F.sum("own").over(Window.partitionBy("key")).alias("n")
    )
    placed = ranged.join(starts, ["key", "part"])
    return placed.withColumn("idx", F.col("pos") + F.col("shift")).drop("part", "pos", "shift")


# ---- trees -------------------------------------------------------------------------------


@dataclass
class Forest:
    """A tree for each key: its blocks tier by tier, ``(key, block, n, nodes)`` with ``n`` the nodes of the whole tree
    in that tier, and ``roots`` (key, digest)."""

    tiers: list[DataFrame]
    roots: DataFrame


def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """Neighbours put into one row; none has more than ``BLOCK``."""
    members = F.sort_array(F.collect_list(F.struct(F.col("idx").cast("long").alias("idx"), "digest", *carried)))
    block = F.floor(F.col("idx") / BLOCK).cast("long")
    return nodes.groupBy("key", block.alias("block"), "n").agg(members.alias("nodes"))


def _runs(nodes: Column) -> Column:
    """The digests of the parents of a block's nodes."""
    count = F.ceil(F.size(nodes) / FANOUT).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda r: F.sha2(F.array_join(F.slice(nodes, r * FANOUT + 1, F.lit(FANOUT)), "").cast("binary"), 256),
    )


def _joined(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, "").cast("binary"), 256)


def grow(nodes: DataFrame, name: str, *carried: str) -> Forest:
    """The trees over ``nodes`` (key, idx, n, digest). Columns ``carried`` stay with the nodes of the lowest tier.

    Each tier is written to the shared folder; only the largest number of nodes of a tree reaches the driver, and a
    tier is 256 times smaller than the one before.
    """
    tiers = [common.staged(_blocks(nodes, *carried), f"{name}-tier")]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        digests = F.col("nodes.digest")
        lone, one_run = F.col("n") == 1, F.col("n") <= FANOUT
        top = F.when(lone, digests[0]).when(one_run, _joined(digests)).otherwise(_joined(_runs(digests)))
        higher = tiers[-1].select(
            "key", F.col("block").alias("idx"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), top.alias("digest")
        )
        tiers.append(common.staged(_blocks(higher), f"{name}-tier"))
    return Forest(tiers, tiers[-1].select("key", F.col("nodes")[0]["digest"].alias("digest")))


def _around(nodes: Column, place: Column) -> Column:
    """What stands left and right of a place in its run."""
    run = F.floor(place / FANOUT).cast("int") * FANOUT
    left = F.slice(nodes, run + 1, place - run)
    right = F.slice(nodes, place + 2, F.greatest(run + FANOUT - place - 1, F.lit(0)))
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


def descend(forest: Forest, paths: DataFrame) -> DataFrame:
    """The way from each block of the lowest tier to the root of all: ``(key, block, path)``, from below, and what else
    ``paths`` has for the key. ``paths`` (key, path) has what is above each tree."""
    more = [c for c in paths.columns if c not in ("key", "path")]
    way = paths.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(forest.tiers[1:]):
        digests = F.col("nodes.digest")
        inside = tier.select("key", "block", "n", digests.alias("d"), F.when(F.col("n") > FANOUT, _runs(digests)).alias("p"))
        placed = inside.join(way, ["key", "block"]).select(
            "key", (F.col("block") * BLOCK).alias("first"), "n", "d", "p", "path", *more,
            F.explode(F.sequence(F.lit(0), F.size("d") - 1)).alias("i"),
        )
        empty = F.array().cast(f"array<{LEVEL}>")
        low = F.when(F.col("n") > 1, F.array(_around(F.col("d"), F.col("i")))).otherwise(empty)
        run = F.floor(F.col("i") / FANOUT).cast("int")
        high = F.when(F.col("n") > FANOUT, F.array(_around(F.col("p"), run))).otherwise(empty)
        way = placed.select("key", (F.col("first") + F.col("i")).alias("block"), F.concat(low, high, "path").alias("path"), *more)
    return way


# ---- the manifest ------------------------------------------------------------------------


@dataclass
class Manifest:
    """The trees of all groups, the tree over their subroots, and the root (None without rows)."""

    groups: Forest
    sources: DataFrame | None
    top: Forest | None
    root: str | None


def build(rows: DataFrame, *carried: str) -> Manifest:
    """The manifest of ``rows``: ``key`` (see ``group_key``), ``id`` (places leaves in a group, null first), ``digest``.

    Rows that are equal in key and id stand in the order of their digests. Columns ``carried`` stay with the leaves.
    """
    groups = grow(numbered(rows, "merkle-leaves", "id", "digest"), "merkle-groups", *carried)
    if not groups.tiers[0].take(1):
        return Manifest(groups, None, None, None)
    subroots = groups.roots.withColumnsRenamed({"key": "name"}).withColumn("key", F.lit(""))
    sources = common.staged(numbered(subroots, "merkle-sources", "name"), "merkle-subroots")
    top = grow(sources, "merkle-top", "name")
    return Manifest(groups, sources, top, top.roots.first()["digest"])


def audit(manifest: Manifest, changed: str, *carried: str) -> DataFrame:
    """Every leaf with its proof, and the root that its row folds to: ``key``, ``digest``, the ``carried`` columns,
    ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``changed`` names a carried column with the digest of the row as it is found now, null if it is as it was. A row
    is verified if its fold equals the root.
    """
    low = manifest.groups.tiers[0]
    kinds = {f.name: f.dataType for f in low.schema["nodes"].dataType.elementType.fields}
    tail = ", ".join(f"`{c}` {kinds[c].simpleString()}" for c in carried)
    out = f"key string, digest string, {tail + ', ' if tail else ''}subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return low.sparkSession.createDataFrame([], out)
    none = F.array().cast(f"array<{LEVEL}>")
    above = descend(manifest.top, manifest.top.roots.select("key", none.alias("path")))
    # a source is a node of the lowest tier of the tree of sources; the path of its block is not yet its own
    tops = manifest.top.tiers[0].join(above, ["key", "block"])
    leaves = tops.select("n", F.col("nodes.digest").alias("d"), "path", F.posexplode("nodes").alias("i", "node"))
    runs = _runs(F.col("d"))
    own = F.concat(
        F.when(F.col("n") > 1, F.array(_around(F.col("d"), F.col("i")))).otherwise(none),
        F.when(F.col("n") > FANOUT, F.array(_around(runs, F.floor(F.col("i") / FANOUT).cast("int")))).otherwise(none),
        "path",
    )
    sources = leaves.select(F.col("node.name").alias("key"), own.alias("path"), F.col("node.digest").alias("subroot"))
    sources = common.staged(sources, "merkle-sources-paths")
    placed = low.join(descend(manifest.groups, sources), ["key", "block"]).select("key", "nodes", "n", "path", "subroot")
    root = manifest.root
    fields = ["key", "digest", *carried]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                nodes = one.column(1).flatten()
                path = [(level["left"], level["right"]) for level in one.column(3)[0].as_py()]
                column = {kind.name: nodes.field(k) for k, kind in enumerate(nodes.type)}
                lifts = min(levels_of(one.column(2)[0].as_py()), 2)
                proofs, folded = zip(*audit_block(column["digest"].to_pylist(), column[changed].to_pylist(), lifts, path))
                size = len(proofs)
                same = {"key": pa.array([one.column(0)[0].as_py()] * size, pa.string())}
                yield pa.RecordBatch.from_arrays(
                    [same.get(c, column.get(c)) for c in fields]
                    + [pa.array([one.column(4)[0].as_py()] * size, pa.string()), pa.array([root] * size, pa.string())]
                    + [pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded])],
                    names=[*fields, "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return placed.mapInArrow(check, out)


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaves of documents: ``key``, ``id``, ``digest`` over doc_id, source, lang, n_chars and text, and ``found``, the
    digest with the text's A-Z lower-cased where ``tampered`` holds (null elsewhere). Other columns do not count."""
    facts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = leaf_hash(*facts, F.translate("text", UPPER, LOWER))
    found = F.when(tampered, lowered) if tampered is not None else F.lit(None).cast("string")
    return docs.select(
        group_key(F.col("source")).alias("key"), F.col("doc_id").alias("id"), leaf_hash(*facts, F.col("text")).alias("digest"),
        found.alias("found"),
    )


def op11_merkle(spark, sf_dir) -> DataFrame:
    """The manifest of all documents, each one's proof, and the check of a copy in which every fifth one or so (by the
    checksum of its id) has lost its capitals.

    Null fields count as ``-``. Documents without an id come first in their source and are never tampered with; equal
    rows are leaves of their own. An empty table has no root and no rows.
    """
    docs = common.table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = build(document_leaves(docs, tampered), "id", "found")
    return audit(manifest, "found", "id", "found").select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


OP11_SQL = r"""
WITH RECURSIVE plain AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
    || coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
      lambda crc, b: list_reduce([xor(crc, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(lowered)::VARCHAR || ':' || lowered, '-')) END AS found
  FROM plain
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS n FROM leaves
), tree AS (
  SELECT source, 0 AS level, place, leaf AS digest, n FROM placed
  UNION ALL
  SELECT source, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), any_value(n + 15) // 16
  FROM tree WHERE n > 1 GROUP BY source, level, place // 16
), subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM tree WHERE n = 1
), crown AS (
  SELECT 0 AS level, place, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), any_value(n + 15) // 16
  FROM crown WHERE n > 1 GROUP BY level, place // 16
), runs AS (
  SELECT source, level, place // 16 AS run, list(digest ORDER BY place) AS nodes FROM tree WHERE n > 1 GROUP BY ALL
), tops AS (
  SELECT level, place // 16 AS run, list(digest ORDER BY place) AS nodes FROM crown WHERE n > 1 GROUP BY ALL
), folds AS (
  SELECT doc_id, source, leaf, place AS first, 0 AS level, place, n, coalesce(found, leaf) AS digest, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, f.source, leaf, first, f.level + 1, place // 16, (n + 15) // 16,
    sha256(array_to_string(nodes[:place % 16], '') || digest || array_to_string(nodes[place % 16 + 2:], '')),
    proof || array_to_string(nodes[:place % 16], '') || array_to_string(nodes[place % 16 + 2:], '')
  FROM folds f JOIN runs r ON f.source IS NOT DISTINCT FROM r.source AND f.level = r.level AND f.place // 16 = r.run WHERE n > 1
), climbs AS (
  SELECT f.doc_id, f.source, leaf, first, s.digest AS subroot, 0 AS level, s.place, s.n, f.digest, proof
  FROM folds f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source WHERE f.n = 1
  UNION ALL
  SELECT doc_id, source, leaf, first, subroot, c.level + 1, place // 16, (n + 15) // 16,
    sha256(array_to_string(nodes[:place % 16], '') || digest || array_to_string(nodes[place % 16 + 2:], '')),
    proof || array_to_string(nodes[:place % 16], '') || array_to_string(nodes[place % 16 + 2:], '')
  FROM climbs c JOIN tops t ON c.level = t.level AND c.place // 16 = t.run WHERE n > 1
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM crown WHERE n = 1) AS root, sha256(proof) AS proof_sha256,
  digest AS folded_root, digest = (SELECT digest FROM crown WHERE n = 1) AS verified
FROM climbs WHERE n = 1
"""
