import numpy as np
import pytest

from editscope.llm import common, hnsw, neighbourhoods

from .test_hnsw import check, clustered, crowd


def pairs(seed, count, cosine, dim=64):
    a, b = neighbourhoods._pairs(dim, count, cosine, np.random.default_rng(seed))
    return hnsw.units(np.concatenate([a, b]))


def frame_of(spark, vectors):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")


def roots(vectors, count, threshold=0.95, ranges=7):
    """As the two steps of ``edges`` would find them, in one process."""
    blocks, root = {}, np.arange(len(vectors))
    for part in np.array_split(np.arange(len(vectors)), 3):
        for bucket, block in neighbourhoods._entries(count, threshold, ranges, vectors.shape[1], part, vectors[part].astype(np.float32)):
            blocks.setdefault(bucket, []).append(block)
    joins = [neighbourhoods._joins(x, neighbourhoods.plan(vectors.shape[1], count, threshold)) for x in blocks.values()]
    return neighbourhoods.merged(root, *(np.concatenate(x) for x in zip(*joins)))


@pytest.mark.parametrize("count", [100, 60_000, 15_000_000])
def test_pairs_at_the_threshold_are_joined_and_others_hardly(count):
    vectors = np.concatenate([pairs(1, 4000, 0.9501), hnsw.units(np.random.default_rng(2).normal(size=(4000, 64)))])
    root = roots(vectors, count)
    assert (root[:4000] == root[4000:8000]).sum() >= 3998
    assert (root[8000:] != np.arange(8000, 12_000)).sum() <= 40


@pytest.mark.parametrize("dim, threshold", [(1, 0.95), (2, 0.95), (3, 0.9), (16, 0.95), (200, 0.97)])
def test_other_lengths_and_thresholds(dim, threshold):
    vectors = pairs(3, 1500, threshold + 0.001, dim)
    root = roots(vectors, 200_000, threshold)
    assert (root[:1500] == root[1500:]).sum() >= 1499


@pytest.mark.parametrize("heavy, heads", [(4096, 64), (50, 3), (50, 64)])
def test_all_sketches_within_reach_are_joined(monkeypatch, heavy, heads):
    monkeypatch.setattr(neighbourhoods, "HEAVY", heavy)
    monkeypatch.setattr(neighbourhoods, "HEADS", heads)
    way = neighbourhoods.plan(24, 1000, 0.95)
    sketches = way.sketches(hnsw.units(np.concatenate([clustered(4, 700, 24, 30), crowd(300, 24, 100)])).astype(np.float32))
    root = neighbourhoods.joined(sketches, way.reach)
    apart = np.sqrt(((sketches[:, None].astype(float) - sketches[None]) ** 2).sum(-1))
    a, b = np.nonzero(apart <= way.reach - 0.01)
    assert (root[a] == root[b]).all() and (root <= np.arange(len(root))).all() and len(np.unique(root)) > 100
    monkeypatch.setattr(neighbourhoods, "WHOLE", 10)
    if heavy < len(sketches):
        assert not neighbourhoods.joined(sketches, way.reach).any()


def test_a_class_is_searched_in_the_shard_of_its_neighbourhood_only(spark):
    """Before, each was dealt to all shards, 12 at least, and the work grew with vectors times shards."""
    vectors = np.concatenate([pairs(5, 300, 0.97), hnsw.units(np.random.default_rng(6).normal(size=(900, 64)))])
    frame = frame_of(spark, vectors)
    classes = common.staged(frame.selectExpr("vec_id AS cls", "1L AS weight", "embedding AS vector"), "classes")
    every, shards = hnsw._by_neighbourhood(classes, len(vectors), 0.95)
    rows = every.select("cls", "shard", "away").collect()
    assert len(rows) == len({r.cls for r in rows}) and not any(r.away for r in rows)
    place = {r.cls: r.shard for r in rows}
    assert all(place[k] == place[k + 300] for k in range(300)) and len(place) <= 620
    assert len(set(place.values())) == shards == hnsw.SHARDS
    check(frame, hnsw.near_duplicates(frame))


def test_large_neighbourhoods_have_shards_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 40)
    vectors = np.concatenate([crowd(150, 64, 80), clustered(7, 300, 64, 2), pairs(8, 50, 0.96)])
    frame = frame_of(spark, vectors)
    classes = common.staged(frame.selectExpr("vec_id AS cls", "1L AS weight", "embedding AS vector"), "classes")
    every, shards = hnsw._by_neighbourhood(classes, len(vectors), 0.95)
    assert shards > hnsw.SHARDS and every.filter("away").count() > 0
    assert every.filter("not away").count() == every.select("cls").distinct().count()
    check(frame, hnsw.near_duplicates(frame))


@pytest.mark.parametrize("kind, broadcast", [("float", 10**6), ("double", 0)])
def test_more_than_one_cell_equals_brute_force(spark, monkeypatch, kind, broadcast):
    """Pairs, a crowd and loners over several cells, with and without a broadcast of their list."""
    monkeypatch.setattr(hnsw, "NEAR_ROWS", broadcast)
    rng = np.random.default_rng(9)
    vectors = np.concatenate([pairs(9, 200, 0.955), crowd(100, 64, 100), hnsw.units(rng.normal(size=(2600, 64)))])
    vectors[:20] = vectors[400:420]
    frame = frame_of(spark, vectors).selectExpr("vec_id", f"cast(embedding AS array<{kind}>) AS embedding")
    assert neighbourhoods.plan(64, 3180, 0.95).cells > 1
    got = sorted(tuple(r) for r in hnsw.near_duplicates(frame).collect())
    unit = hnsw.units(np.array([r.embedding for r in frame.sort("vec_id").collect()], np.float64))
    links = unit @ unit.T >= 0.95
    assert [r[1] for r in got] == (links.sum(axis=1) - 1).tolist()
    root = neighbourhoods.merged(np.arange(len(unit)), *np.nonzero(links))
    assert [r[2] for r in got] == root.tolist() and [r[3] for r in got] == (root == np.arange(len(root))).tolist()


def test_thresholds_too_low_for_tables_search_every_shard(spark):
    assert not neighbourhoods.worthwhile(0.3, 10**6) and neighbourhoods.worthwhile(0.95, 10**9)
    frame = frame_of(spark, clustered(10, 200))
    got = {r.vec_id: r.n_links for r in hnsw.near_duplicates(frame, threshold=0.3).collect()}
    unit = hnsw.units(clustered(10, 200))
    assert [got[k] for k in range(200)] == ((unit @ unit.T >= 0.3).sum(axis=1) - 1).tolist()


def test_a_full_beam_looks_at_all_heads_of_a_shard_that_is_not_large(monkeypatch):
    """A crowd too loose for one group: a wider beam took 36 of 39 seconds of such a shard."""
    monkeypatch.setattr(hnsw, "tight_groups", lambda vectors, tight: np.arange(len(vectors)))
    vectors = crowd(400, 64, 1200)
    shard, beams = hnsw.Shard(vectors), []
    plain = hnsw.Graph.search
    monkeypatch.setattr(hnsw.Graph, "search", lambda self, queries, beam, own=None: beams.append(beam) or plain(self, queries, beam, own))
    query, _ = shard.links(vectors[:400])
    assert len(query) == 400 * 400 and set(beams) == {shard.beam}
    monkeypatch.setattr(hnsw, "LOOK", 0)
    query, _ = shard.links(vectors[:400])
    assert len(query) == 400 * 400 and max(beams) > shard.beam


def test_a_search_enters_at_neighbours_that_nothing_points_to():
    """Of 59 million links 285 were missed while a search entered only at the top and at its own head."""
    assert hnsw._beside(np.array([5, 5, 7, 9, 9, 9]))[:, :4].tolist() == [
        [0, 1, -1, -1], [1, 0, -1, -1], [2, -1, -1, -1], [3, 4, 5, -1], [4, 5, 3, -1], [5, 3, 4, -1]]
    vectors = pairs(12, 1000, 0.96)
    vectors = np.stack((vectors[:1000], vectors[1000:]), axis=1).reshape(2000, -1)
    shard = hnsw.Shard(vectors)
    for layer in shard.graph.layers:  # no way to any other node
        layer[:] = -1
    own = hnsw._beside(np.repeat(np.arange(1000), 2))
    query, _, single, node = shard.found(vectors, 2, own)
    assert set(zip(single.tolist(), node.tolist())) == {(k, m) for k in range(2000) for m in (k, k ^ 1)}


def test_own_vectors_are_found_from_where_they_lie():
    """Pairs far from all others: a search that enters at the top alone missed a few of them."""
    vectors = pairs(11, 2000, 0.96)
    shard = hnsw.Shard(vectors)
    query, group, single, node = shard.found(vectors, 2, np.arange(len(vectors))[:, None])
    have = set(zip(single.tolist(), node.tolist())) | set(zip(query.tolist(), shard.heads[group].tolist()))
    assert {(k, (k + 2000) % 4000) for k in range(4000)} <= have
    layer = shard.graph.layers[0]
    nodes = shard.graph.vectors
    for k in range(0, 4000, 7):
        near = layer[k][layer[k] >= 0]
        near = near[np.argsort(-(nodes[near] @ nodes[k]))][: hnsw.CLOSE]
        assert (layer[near] == k).any()
