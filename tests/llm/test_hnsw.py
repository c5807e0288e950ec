import numpy as np
import pytest

from editscope.llm import hnsw

from . import odd


def truth(rows, threshold=0.95):
    """Brute force: links and component of each row."""
    usable = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = {k: hnsw.units(np.array([rows[k][1]], float))[0] for k in usable}
    for a in usable:
        for b in usable:
            if b < a and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    low = {}
    for k, (number, _) in enumerate(rows):
        if number is not None:
            low[find(k)] = min(low.get(find(k), number), number)
    return [(n, links[k], low.get(find(k)), n is not None and low.get(find(k)) == n) for k, (n, _) in enumerate(rows)]


def check(frame, got):
    rows = [(r[0], list(r[1]) if r[1] is not None else None) for r in frame.collect()]
    have = [(r[0], r.n_links, r.component_id, r.kept) for r in got.collect()]
    assert sorted(map(repr, have)) == sorted(map(repr, truth(rows)))


def test_query_equals_brute_force(spark, sf_dir):
    check(odd.plain(spark, sf_dir, "embeddings").select("vec_id", "embedding"), hnsw.op9_hnsw(spark, sf_dir))


def clustered(seed, count, dim=16, clusters=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    noise = rng.choice([0.05, 0.12, 1.0], size=(count, 1))
    return centres[rng.integers(0, clusters, count)] + noise * rng.normal(size=(count, dim))


def test_clusters_over_shards(spark):
    vectors = clustered(3, 500)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    check(frame, hnsw.near_duplicates(frame, shards=3))


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [1.0, None]), (7, []), (8, [1.0, 0.0, 0.0]), (9, [1e300, 1e300]), (10, [1e-320, 1e-320]), (11, [float("inf"), 1.0]), (None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cls string, weight int")
    check(frame.select("vec_id", "embedding"), hnsw.near_duplicates(frame))
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_recall_of_the_graph(seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(3000, 64))
    copies = base[rng.integers(0, 3000, 600)] + 0.1 * rng.normal(size=(600, 64))
    shard = hnsw.Shard(hnsw.units(base))
    queries = hnsw.units(copies)
    query, node = shard.links(queries)
    want = set(zip(*(x.tolist() for x in np.nonzero(queries @ shard.exact.T >= 0.95))))
    have = set(zip(query.tolist(), node.tolist()))
    assert have <= want and len(have) >= 0.98 * len(want) and len(want) >= 500


def crowd(count=1500, dim=32, others=2500):
    rng = np.random.default_rng(0)
    return hnsw.units(np.concatenate([1 + 0.02 * rng.normal(size=(count, dim)), rng.normal(size=(others, dim))]))


def test_crowded_groups_are_found_whole():
    vectors = crowd()
    shard = hnsw.Shard(vectors)
    assert len(shard.heads) < 3000 and shard.radius.max() <= shard.angle / 3 + 1e-9
    query, node = shard.links(vectors[:4])
    assert (np.bincount(query) == (vectors[:4] @ vectors.T >= 0.95).sum(axis=1)).all() and len(query) >= 4 * 1500


@pytest.mark.parametrize("noise", [0.005, 0.03, 0.08, 0.12])
def test_groups_across_the_threshold_are_checked_by_member(noise):
    rng = np.random.default_rng(6)
    centres = np.repeat(rng.normal(size=(12, 24)), 100, axis=0)
    vectors = hnsw.units(centres + noise * np.sqrt(24) * rng.normal(size=centres.shape) * rng.random((len(centres), 1)))
    shard = hnsw.Shard(vectors)
    query, node = shard.links(vectors)
    want = vectors @ vectors.T >= 0.95
    have = np.zeros_like(want)
    have[query, node] = True
    assert len(set(zip(query.tolist(), node.tolist()))) == len(query)
    assert not (have & ~want).any() and have.sum() >= 0.999 * want.sum()


def test_full_beams_widen(monkeypatch):
    monkeypatch.setattr(hnsw, "tight_groups", lambda vectors, tight: np.arange(len(vectors)))
    vectors = crowd(600, 32, 1200)
    shard = hnsw.Shard(vectors)
    assert len(shard.heads) == len(vectors)
    query, node = shard.links(vectors[:4])
    assert (np.bincount(query) == (vectors[:4] @ vectors.T >= 0.95).sum(axis=1)).all() and len(query) >= 4 * 600


def blind(shard, narrow):
    """A graph that finds nothing until the beam is wide."""
    plain = hnsw.Graph._beam

    def beam(self, k, queries, entry, beam, ready):
        if beam >= narrow or k:
            return plain(self, k, queries, entry, beam, ready)
        return np.full((len(queries), beam), -1), np.full((len(queries), beam), -2.0, np.float32)

    return beam


def test_the_beam_is_set_before_any_link(monkeypatch):
    monkeypatch.setattr(hnsw.Graph, "_beam", blind(None, 90))
    vectors = hnsw.units(np.random.default_rng(4).normal(size=(2000, 48)))
    shard = hnsw.Shard(vectors)
    assert shard.beam >= 90
    query, node = shard.links(vectors[:200])
    assert len(query) >= 196


def test_an_audit_widens_the_beam_and_waits_for_links():
    vectors = hnsw.units(np.random.default_rng(4).normal(size=(2000, 48)))
    shard = hnsw.Shard(vectors)
    far = hnsw.units(np.random.default_rng(5).normal(size=(512, 48)))
    shard.links(far, hnsw.AUDIT_EVERY)
    assert len(shard.waiting) > 0 and shard.beam == hnsw.BEAM
    for turn in range(2, 40):
        shard.links(far, turn * hnsw.AUDIT_EVERY)
    assert len(shard.waiting) <= 8 * hnsw.AUDITED  # bounded
    shard.graph.search = lambda queries, beam: (  # misses everything until the beam is wide
        hnsw.Graph.search(shard.graph, queries, beam) if beam >= 90 else (np.full((len(queries), beam), -1), np.full((len(queries), beam), -2.0, np.float32)))
    query, _ = shard.links(vectors[:200], 100 * hnsw.AUDIT_EVERY)
    assert shard.beam >= 90 and len(query) >= 196 and len(shard.waiting) == 0


def test_small_shards_use_the_graph():
    vectors = hnsw.units(np.random.default_rng(7).normal(size=(60, 16)))
    shard = hnsw.Shard(vectors)
    calls = []
    shard.graph.search = lambda queries, beam: calls.append(beam) or hnsw.Graph.search(shard.graph, queries, beam)
    query, node = shard.links(vectors)
    assert calls and set(range(60)) <= set(query[query == node].tolist())


def test_shards_of_more_than_a_thousand_equal_the_sql(spark, tmp_path):
    """Clusters of all tightnesses, copies and loners in two shards, against the registered SQL."""
    import duckdb

    vectors = np.concatenate([clustered(9, 2200, 24, 40), crowd(200, 24, 200)])
    vectors[:50] = vectors[50:100]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    frame.coalesce(1).write.parquet(f"{tmp_path}/e")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/e/*.parquet')")
    want = sorted(db.execute(hnsw.OP9_SQL).fetchall())
    got = sorted(tuple(r) for r in hnsw.near_duplicates(frame, shards=2).collect())
    assert got == want and max(r[1] for r in want) > 100
