import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from editscope.llm import merkle

from . import odd


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes, place):
    """Siblings of a place level by level, each with the number that stand left, up to the single node."""
    out = []
    while len(nodes) > 1:
        run = place // 16 * 16
        mates = nodes[run : run + 16]
        out.append((mates[: place - run], mates[place - run + 1 :]))
        nodes = [h(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
        place //= 16
    return out, nodes[0]


def truth(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each document, recomputed from the start."""
    groups = defaultdict(list)
    for r in rows:
        head = field(r["doc_id"]) + field(r["source"]) + field(r["lang"]) + field(r["n_chars"])
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        leaf = h(head, field(r["text"]))
        groups[r["source"]].append((r["doc_id"], leaf, h(head, field(lowered(r["text"]))) if hit else leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for group in groups.values():
        group.sort(key=lambda g: (g[0] is not None, g[0] or 0, g[1]))
    subroots = [climb([g[1] for g in groups[s]], 0)[1] for s in names]
    out = []
    for s, name in enumerate(names):
        above, root = climb(subroots, s)
        for k, (doc_id, leaf, found) in enumerate(groups[name]):
            path = climb([g[1] for g in groups[name]], k)[0] + above
            node = found
            for left, right in path:
                node = h(*left, node, *right)
            proof = h(*[d for left, right in path for d in left + right])
            out.append((doc_id, leaf, subroots[s], root, proof, node, node == root))
    return sorted(map(repr, out))


def check(docs, got):
    assert sorted(repr(tuple(r)) for r in got.collect()) == truth([r.asDict() for r in docs.collect()])


def audit(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = merkle.build(merkle.document_leaves(docs, tampered), "id", "found")
    return merkle.audit(manifest, "found", "id", "found").select(
        "id", "digest", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_query_equals_brute_force(spark, sf_dir):
    docs = odd.plain(spark, sf_dir)
    rows = merkle.op11_merkle(spark, sf_dir)
    assert rows.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    check(docs, rows)
    changed = docs.filter("text != translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    changed = changed.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert rows.filter("not verified").count() == changed.count() > 0


@pytest.mark.parametrize("sizes", [[1], [1, 1], [17, 1, 16], [5000, 3, 257, 256, 272], [1] * 300, [4096 + 1], [15] * 17])
def test_sizes_around_runs_and_blocks(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(i, f"T{i}", None, f"s{s}" if s else None, 1) for i, s in enumerate(s for s, n in enumerate(sizes) for _ in range(n))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check(docs, audit(docs))


def test_odd_documents(spark):
    docs = odd.documents(spark)
    check(docs, audit(docs))
    assert audit(odd.empty(spark)).count() == 0


def test_repeated_rows_and_bytewise_order_of_sources(spark):
    rows = [(7, "same Text", "en", "é", 9)] * 40 + [(7, "other", "en", "é", 9)] * 3 + [
        (1, "x", None, "z", 1), (2, "x", None, "Z", 1), (3, "x", None, "\U0001f600", 1), (4, "x", None, "￮", 1), (5, "x", None, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check(docs, audit(docs))


def test_states_resume_where_they_were_kept():
    children = [hashlib.sha256(bytes([k])).hexdigest().encode() for k in range(16)]
    for size in (1, 2, 16):
        parent = merkle.Parent(children[:size])
        assert parent.digest.decode() == hashlib.sha256(b"".join(children[:size])).hexdigest()
        for place in range(size):
            assert parent.fold(place, children[place]) == parent.digest
            other = children[:place] + [b"x" * 64] + children[place + 1 : size]
            assert parent.fold(place, b"x" * 64).decode() == hashlib.sha256(b"".join(other)).hexdigest()
            assert parent.states[place].hexdigest() == hashlib.sha256(b"".join(children[:place])).hexdigest()


def test_one_large_group_is_spread(spark):
    rows = spark.range(40_000).select(
        F.lit("1hot").alias("key"), F.col("id"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    places = merkle.numbered(rows, "merkle-test", "id", "digest")
    assert places.filter("idx != id").count() == 0
    block = merkle._blocks(places)
    assert block.agg(F.max(F.size("nodes"))).first()[0] == merkle.BLOCK
    spread = places.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 40_000
