import os
import random
import struct
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from editscope.llm import packing

from . import odd

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


STRINGS = [
    "", "a<|endoftext|>b <|endoftext|>  <|endoftext|>", "  x \n\n y z　 a  ", "''s don't I'LL 's", "x" * 3000,
    "😀é\u0000‍\n \t ", "!'s ''' 12 34５６ ½²", "   a\r\n\r\nb   ", "a\x1cb \x85c\xa0d", "line.\nNext, line!\nEnd", "\n", " ", "a ", "ab½, ²!",
    "word.word,,word ,x", "\0a\0 b\n\0",
]


def test_ids_equal_the_tokenizer(tokenizer, spark, sf_dir):
    encoder = packing.Encoder()
    texts = STRINGS + odd.TEXTS[1:] + [r.text for r in odd.plain(spark, sf_dir).collect()]
    rng = random.Random(1)
    texts += ["".join(rng.choices(["a", "B", " ", "\n", "'s", "1", ",", "\t", "é", "　", "!"], k=20)) for _ in range(500)]
    for text in texts:
        if text is not None:
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:80]


def check(tokenizer, docs, got):
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        at, stop, piece = 0, len(ids) % 1024 or 1024, 0
        while at < len(ids):
            part = ids[at:stop]
            want.append((r.doc_id, piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
            at, stop, piece = stop, stop + 1024, piece + 1
    rows = got.collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), -(-sum(r.length for r in rows) // 1024)


def test_query_equals_the_tokenizer(tokenizer, spark, sf_dir):
    used, least = check(tokenizer, odd.plain(spark, sf_dir), packing.op7_packing(spark, sf_dir))
    assert used <= least * 1.02 + 1


def test_odd_documents(tokenizer, spark):
    docs = odd.documents(spark)
    check(tokenizer, docs, packing.pack_documents(docs))
    assert packing.pack_documents(odd.empty(spark)).count() == 0


def held_by(configs):
    held = Counter()
    for shape, times in configs:
        assert 0 < sum(shape) <= 1024 and times > 0
        for length in shape:
            held[length] += times
    return held


def best_fit(histogram):
    lengths = np.array(sorted(histogram))
    return sum(t for _, t in packing._best_fit(lengths, np.array([histogram[k] for k in lengths.tolist()]), 1024))


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece(seed):
    rng = random.Random(seed)
    shapes = [lambda: rng.randint(1, 1024), lambda: rng.choice([1024, 513, 512, 511, 1]), lambda: 600, lambda: rng.choice([342, 341, 340])]
    histogram = Counter(shapes[seed]() for _ in range(3000))
    plan = packing.plan(dict(histogram))
    assert held_by(plan.configs) == histogram
    assert plan.sequences <= best_fit(histogram)


SPREADS = {
    "one of each": lambda rng: {k: 1 for k in rng.sample(range(1, 1024), 900)},
    "all lengths": lambda rng: {k: rng.randint(1, 1999) for k in range(1, 1024)},
    "long": lambda rng: {k: rng.randint(1, 200_000) for k in range(300, 1024)},
    "short": lambda rng: {k: rng.randint(1, 2000) for k in range(60, 400, 3)},
    "documents": lambda rng: Counter(min(1023, max(1, int(rng.lognormvariate(5.5, 0.9)))) for _ in range(50_000)),
}


@pytest.mark.parametrize("name", SPREADS)
def test_the_program_covers_every_piece_and_is_no_worse_than_best_fit(name):
    histogram = dict(SPREADS[name](random.Random(3)))
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[k] for k in lengths.tolist()])
    solved = packing.program(lengths, counts, 1024)
    covered = np.zeros(len(lengths), np.int64)
    for config, times in solved:
        for k, n in config.items():
            covered[k] += n * times
    assert (covered == counts).all()
    used, other = sum(times for _, times in solved), best_fit(histogram)
    assert used <= other * 1.001 + 1
    plan = packing.plan(histogram)
    assert plan.sequences <= other and held_by(plan.configs) == Counter(histogram)
    assert plan.solved == (used <= other)


@pytest.mark.parametrize("name", ["all lengths", "short", "documents"])
def test_large_counts_are_packed_by_the_program(name):
    histogram = {k: n * 1000 for k, n in SPREADS[name](random.Random(3)).items()}
    assert packing.plan(histogram).solved


def test_plan_grows_with_lengths_not_pieces():
    histogram = {k: 10**9 for k in range(1, 1025, 7)}
    plan = packing.plan(histogram)
    assert len(plan.configs) < 3000
    assert plan.sequences <= sum(k * n for k, n in histogram.items()) / 1024 * 1.01


@pytest.mark.parametrize("seed", range(3))
def test_pricing_is_exact(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 20), 4, replace=False))
    weights = rng.random(4)
    for limits in (np.full(4, 99), rng.integers(0, 3, 4)):
        config = packing.price(weights, lengths, limits, 20)
        assert (config * lengths).sum() <= 20 and (config <= limits).all()
        choices = product(*[range(min(20 // n, m) + 1) for n, m in zip(lengths, limits)])
        best = max(np.dot(c, weights) for c in choices if np.dot(c, lengths) <= 20)
        assert np.dot(config, weights) == pytest.approx(best)


def test_no_pieces_and_wrong_lengths(spark):
    assert packing.plan({}).configs == []
    rows = spark.createDataFrame([(1, 0, 1025)], "id long, piece int, length long")
    with pytest.raises(ValueError):
        packing.pack(rows)
