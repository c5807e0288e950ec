import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from editscope.llm import quality
from editscope.llm.quality import Rule, Text

from . import odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def truth(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), counted plainly."""
    text = text or ""
    words = WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    windows = [tuple(words[k : k + 8]) for k in range(n - 7)]
    times = Counter(windows)
    hit = {p for k, w in enumerate(windows) if times[w] > 1 for p in range(k, k + 8)}
    failed = n < 20 or 100 * len(hit) > 30 * n
    lettered = sum(any(c.isascii() and c.isalpha() or c > "\x7f" for c in w) for w in words)
    upper, lower = (sum(a <= c <= z for c in text) for a, z in ("AZ", "az"))
    bad = 10 * symbols > n or 10 * dup > 3 * len(lines) or chars < 2 * n or chars > 15 * n or 10 * lettered < 7 * n
    return n, chars, symbols, dup, len(hit), failed, not (failed or bad or 10 * upper > 7 * (upper + lower))


def check(docs, got):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = sorted(repr((r["doc_id"], *truth(r["text"]))) for r in docs.collect())
    assert sorted(repr((r["doc_id"], *(r[c] for c in names))) for r in got.collect()) == want


def query(docs):
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = quality.judge(docs, quality.estimate(docs, sample_rows=10), complete=shown).select("doc_id", "quality.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("doc_id", *shown, failed.alias("base_failed"), "kept")


def test_query_equals_brute_force(spark, sf_dir):
    rows = quality.op12_quality(spark, sf_dir)
    check(odd.plain(spark, sf_dir), rows)
    assert 0 < rows.filter("kept").count() < rows.count()


def test_odd_documents(spark):
    docs = odd.documents(spark).drop("score", "id", "hits", "fp", "words", "pii", "length", "row", "spans")
    check(docs, query(docs))
    everything = odd.documents(spark)
    kept = quality.keep(everything)
    assert kept.columns == everything.columns
    assert kept.count() == sum(truth(r.text)[-1] for r in everything.collect())
    assert query(odd.empty(spark)).count() == quality.keep(odd.empty(spark)).count() == 0


def test_clashing_and_dotted_names(spark):
    text = "A plain sentence of some ordinary words, which nobody would call junk at all, is kept by every rule that we have here."
    docs = spark.createDataFrame([(1, text, 2, "q")], "doc_id long, text string, `a.b` int, quality string")
    assert quality.keep(docs).collect()[0].asDict() == {"doc_id": 1, "text": text, "a.b": 2, "quality": "q"}


@pytest.mark.parametrize("seed", range(20))
def test_repeated_words(seed):
    rng = random.Random(seed)
    words = rng.choices("ab" if seed % 2 else "abcdefgh", k=rng.randint(0, 60))
    if seed % 3 == 0:
        words += words[:9]
    assert quality.repeated_words([w.encode() for w in words]) == truth(" ".join(words))[4]


def test_long_texts():
    words = [b"w%d" % k for k in range(300_000)]
    assert quality.repeated_words(words) == 0
    assert quality.repeated_words(words + words) == 600_000
    assert quality.repeated_words([b"x"] * 500_000) == 500_000


def rule(name, measure):
    return Rule(name, (measure,), lambda value: value > 0)


def test_most_rejections_for_the_cost_come_first():
    rules = (rule("dear", "n_repeat_words"), rule("cheap", "n_symbols"), rule("never", "n_capitals"), rule("shadow", "n_small"))
    costs = {"n_words": 1.0, "n_repeat_words": 9.0, "n_symbols": 0.5, "n_capitals": 0.1, "n_small": 0.5}
    hits = np.zeros((100, 4), bool)
    hits[:60, 0] = True  # 60 for 10 seconds
    hits[50:70, 1] = True  # 20 for half a second
    hits[55:70, 3] = True  # 15 for half a second, but all of them gone after the second rule
    cascade = quality.order(rules, hits, costs)
    assert [r.name for r in cascade.rules] == ["cheap", "dear", "never", "shadow"]
    assert cascade.rejected == (20, 50, 0, 0) and cascade.seconds == (0.5, 10.0, 0.1, 0.5)
    # a measure that an earlier rule took costs nothing more
    shared = (rule("first", "n_words"), rule("second", "n_repeat_words"))
    assert quality.order(shared, np.ones((4, 2), bool), costs).seconds == (1.0, 9.0)


def test_rejected_texts_are_not_measured_further(spark):
    docs = spark.createDataFrame([(1, "$$$ &&& short"), (2, "plain " * 3)], "doc_id long, text string")
    cascade = quality.Cascade((rule("symbols", "n_symbols"), rule("repeats", "n_repeat_words")))
    got = {r.doc_id: r.quality for r in quality.judge(docs, cascade).collect()}
    assert (got[1].rejected_by, got[1].n_symbols, got[1].n_repeat_words) == ("symbols", 6, None)
    assert (got[2].rejected_by, got[2].n_repeat_words, got[2].kept) == (None, 0, True)


def test_order_does_not_decide_what_stays(spark, sf_dir):
    texts = [r.text for r in odd.plain(spark, sf_dir).collect()] + odd.TEXTS
    rng = random.Random(3)
    for _ in range(5):
        rules = list(quality.RULES)
        rng.shuffle(rules)
        cascade = quality.Cascade(tuple(rules))
        assert [cascade.ask(Text(t)) is None for t in texts] == [truth(t)[-1] for t in texts]


def test_sample_is_bounded_and_finds_the_selective_rules(spark):
    docs = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "$ & $ & words here").otherwise("plain text of words").alias("text"))
    rules = (rule("repeats", "n_repeat_words"), rule("symbols", "n_symbols"))
    cascade = quality.estimate(docs, rules, sample_rows=500)
    assert 300 < cascade.rows < 700
    assert cascade.rules[0].name == "symbols" and 0.3 < cascade.rejected[0] / cascade.rows < 0.7
    assert set(cascade.costs) == {"n_words", "n_repeat_words", "n_symbols"}
