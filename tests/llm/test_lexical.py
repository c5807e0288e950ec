import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from editscope.llm import lexical

from . import odd

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def truth(docs, items, top=10):
    """(item, rank, doc, score), each pair scored."""
    bags = [(doc, Counter(terms(text))) for doc, text in docs]
    bags = [(doc, bag, sum(bag.values())) for doc, bag in bags if bag]
    count, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scores = []
        for doc, bag, n in bags:
            m = 100 - 75 + (75 * n * count) // total
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return sorted(map(repr, out))


def check(docs, items, got, top=10):
    want = truth([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], top)
    assert sorted(repr((r.item_id, r["rank"], r.doc_id, r.score)) for r in got.collect()) == want


def test_query_equals_brute_force(spark, sf_dir):
    got = lexical.op13_lexical(spark, sf_dir)
    check(odd.plain(spark, sf_dir), odd.plain(spark, sf_dir, "benchmark"), got)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


ITEMS = [(1, "of THE, and of the and"), (2, "the same text twice over here"), (3, None), (4, ""), (5, "..."), (None, "x words"),
         (1, "of the"), (6, "lorem ipsum dolor sit amet lorem"), (6, "lorem ipsum dolor sit amet lorem"), (7, "ÀÉ 😀 ß"), (8, "nowhere")]


@pytest.mark.parametrize("block_terms", [1 << 20, 7])
def test_odd_documents(spark, block_terms):
    docs = odd.documents(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    check(docs, items, lexical.search(docs, items, block_terms=block_terms))
    for none in (lexical.search(odd.empty(spark), items), lexical.search(docs, items.limit(0))):
        assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0


def test_copies_and_ties_rank_by_id(spark):
    rows = [(k, "alpha beta gamma" if k % 3 else "alpha beta delta") for k in range(3000)] + [(5, "alpha beta gamma")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    items = spark.createDataFrame([(1, "alpha gamma gamma"), (2, "delta"), (3, "alpha")], "item_id long, text string")
    for seed_rows in (50, 20_000):
        check(docs, items, lexical.search(docs, items, seed_rows=seed_rows))
    check(docs, items, lexical.search(docs, items, top=3), 3)


def vectors_of(rng, count, wide, size):
    rows = []
    for _ in range(count):
        ids = np.array(sorted(rng.sample(range(wide), rng.randint(0, size))), np.int64)
        rows.append((ids, np.array([rng.randint(1, 50) for _ in ids], np.int64)))
    return rows


@pytest.mark.parametrize("seed", range(8))
def test_dual_trees_find_the_best_of_all_pairs(seed):
    rng = random.Random(seed)
    wide = 40
    items = lexical.Items({b"%d" % k: k for k in range(wide)}, vectors_of(rng, rng.choice([1, 7, 60]), wide, 6))
    weights = np.array([rng.randint(0, 900) for _ in range(wide)], np.int64)
    search = lexical.Search(items, weights, 5)
    docs, at = [], 0
    for size in (1, 300, 0, 77):
        rows = vectors_of(rng, size, wide, 12)
        search.run(lexical.rows_of(rows), np.arange(at, at + size)[::-1].copy())
        docs += [(at + size - 1 - k, row) for k, row in enumerate(rows)]
        at += size
    for k, (ids, repeats) in enumerate(items.rows):
        want = []
        for doc, (own, values) in docs:
            have = dict(zip(own.tolist(), values.tolist()))
            score = sum(int(weights[i]) * r * have.get(i, 0) for i, r in zip(ids.tolist(), repeats.tolist()))
            if score > 0:
                want.append((score, -doc))
        got = sorted(((score, doc) for score, doc in search.best[k]), reverse=True)
        assert got == sorted(want, reverse=True)[:5]


def test_nodes_hold_the_greatest_of_each_coordinate():
    rng = random.Random(2)
    rows = vectors_of(rng, 100, 30, 8)
    tree = lexical.Tree(lexical.rows_of(rows))
    assert [len(level) for level in tree.levels] == [100, 13, 2, 1]
    for level, nodes in enumerate(tree.levels):
        for node in range(len(nodes)):
            want = {}
            for ids, values in rows[node * 8**level : (node + 1) * 8**level]:
                for i, v in zip(ids.tolist(), values.tolist()):
                    want[i] = max(want.get(i, 0), v)
            at = slice(nodes.at[node], nodes.at[node + 1])
            assert dict(zip(nodes.ids[at].tolist(), nodes.values[at].tolist())) == want


def test_bounds_leave_out_whole_batches():
    """Documents of one topic are not scored against items of another, and known k-th scores save whole chunks."""
    rng = random.Random(4)
    topics = [[t * 50 + k for k in range(50)] for t in range(20)]

    def row(topic, size, value):
        ids = np.array(sorted(rng.sample(topics[topic], size)), np.int64)
        return ids, np.full(size, value, np.int64)

    items = lexical.Items({b"%d" % k: k for k in range(1000)}, [row(k % 20, 10, 1) for k in range(200)])
    weak = lexical.rows_of([row(k % 20, 20, 1) for k in range(2000)])
    strong = lexical.rows_of([row(k % 20, 40, 50) for k in range(400)])
    weights = np.full(1000, 5, np.int64)
    search = lexical.Search(items, weights, 10)
    search.run(weak, np.arange(2000))
    assert search.pairs < 0.3 * 200 * 2000
    search.run(strong, np.arange(2000, 2400))
    least = np.array([min(score for score, _ in best) for best in search.best])
    again = lexical.Search(items, weights, 10, least)
    again.run(weak, np.arange(2000))
    assert again.pairs < 50  # a few nodes below the two roots
    again.run(strong, np.arange(2000, 2400))
    assert [sorted(best) for best in again.best] == [sorted(best) for best in search.best]
