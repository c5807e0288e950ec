import inspect
import math
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from editscope.llm import langid

from . import odd


def test_held_out_accuracy(spark, sf_dir):
    lang = {r.doc_id: r.lang for r in odd.plain(spark, sf_dir).collect()}
    got = langid.op4_language(spark, sf_dir).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id] is not None]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_hashing_equals_a_plain_version():
    texts = ["Ab c1d", "", "Été", "a\tb"]
    bucket, owner, letters = langid.ngrams(texts)

    def code(points):
        value = 0x9E3779B1 * len(points) & 0xFFFFFFFF
        for p in points:
            value = ((value ^ p) * 0x85EBCA6B) & 0xFFFFFFFF
            value ^= value >> 13
        return value >> 16

    want = []
    for k, text in enumerate(texts):
        folded = [0]
        for c in text.lower():
            p = ord(c) if c.isalpha() else 0
            if p or folded[-1]:
                folded.append(p)
        if folded[-1]:
            folded.append(0)
        for n in langid.ORDERS:
            for a in range(len(folded) - n + 1):
                if n > 1 or folded[a]:
                    want.append((k, code(folded[a : a + n])))
    assert sorted(zip(owner.tolist(), bucket.tolist())) == sorted(want)
    assert letters.tolist() == [4, 0, 3, 2]


def test_odd_documents(spark):
    docs = odd.documents(spark)
    model = langid.fit(docs)
    assert model.langs == ["en"] and np.isclose(np.exp(model.weights[0]).sum(), 1, atol=1e-3)
    got = langid.identify(docs, model, "text", "lang_pred", "score").collect()
    assert len(got) == docs.count()
    for r in got:
        known = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred, r.score) == (("en", 1.0) if known else ("und", 0.0))
        assert r.hits in (1, None)


def test_nothing_to_learn_from(spark):
    model = langid.fit(odd.empty(spark))
    got = langid.identify(odd.documents(spark), model).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert langid.identify(odd.empty(spark), model).count() == 0


def test_bounded_sample_still_learns(spark, sf_dir):
    docs = odd.plain(spark, sf_dir)
    model = langid.fit(docs, fit_rows=60)
    got = langid.identify(docs, model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(got)


def test_sample_keeps_rare_languages_and_thins_copies(spark):
    rare = [(k, f"редкий язык номер {'абвгд'[k]} и ещё слова", "ru") for k in range(5)]
    common = [(100 + k, f"some common words and number {'x' * (k % 50)} of them", "en") for k in range(2000)]
    hot = [(10_000 + k, "le texte chaud que tout le monde copie", "fr") for k in range(2000)]
    docs = spark.createDataFrame(rare + common + hot, "doc_id long, text string, lang string")
    model = langid.fit(docs, fit_rows=205)
    # all that is left of a language without rows is the smoothing, equal in all buckets
    assert model.langs == ["en", "fr", "ru"] and all(np.ptp(w) > 0 for w in model.weights)
    names, _ = model.predict([r[1] for r in rare] + [hot[0][1], common[0][1]])
    assert names == ["ru"] * 5 + ["fr", "en"]
    known = docs.select("text", "lang", F.xxhash64("text", "doc_id").alias("row"))
    kept = {r["lang"]: r["count"] for r in langid._sample(known, {"ru": 5, "en": 2000, "fr": 2000}, 205).groupBy("lang").count().collect()}
    assert kept["ru"] == 5 and 60 <= kept["en"] <= 140 and 60 <= kept["fr"] <= 140


def plain_bayes(rows, text):
    """Posterior of each language for a text, with dictionaries."""
    counts, priors = {}, {}
    for known, lang in rows:
        counts.setdefault(lang, Counter()).update(langid.ngrams([known])[0].tolist())
        priors[lang] = priors.get(lang, 0) + 1
    logs = {}
    found = langid.ngrams([text])[0].tolist()
    for lang, seen in counts.items():
        total = sum(seen.values()) + langid.SMOOTHING * 65536
        fit = sum(math.log((seen[b] + langid.SMOOTHING) / total) for b in found)
        logs[lang] = fit / len(langid.ORDERS) + math.log(priors[lang] / len(rows))
    top = max(logs.values())
    share = {lang: math.exp(v - top) for lang, v in logs.items()}
    return {lang: v / sum(share.values()) for lang, v in share.items()}


def test_query_equals_a_plain_naive_bayes(spark, sf_dir):
    docs = odd.plain(spark, sf_dir).collect()
    known = [(d.text, d.lang) for d in docs if d.text is not None and d.lang is not None and zlib.crc32(str(d.doc_id).encode()) % 5]
    got = {r.doc_id: r for r in langid.op4_language(spark, sf_dir).collect()}
    counted = {}
    for text, lang in known:
        counted.setdefault(lang, []).append((text, lang))
    for d in docs[:60]:
        if not any(c.isalpha() for c in d.text or ""):
            assert (got[d.doc_id].lang_pred, got[d.doc_id].score) == ("und", 0.0)
            continue
        share = plain_bayes(known, d.text)
        best = max(share, key=share.get)
        assert got[d.doc_id].lang_pred == best
        assert abs(got[d.doc_id].score - share[best]) < 1e-3


def test_texts_between_languages_have_the_plain_posterior(spark):
    rows = [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("the end", "en"), ("der hund", "de")]
    docs = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    texts = ["a", "le", "the le", "hund et dog", "xyz", "chat and"]
    names, scores = model.predict(texts)
    for text, name, score in zip(texts, names, scores):
        share = plain_bayes(rows, text)
        assert abs(share[name] - score) < 1e-4 and share[name] >= max(share.values()) - 1e-4


@pytest.mark.parametrize("labels", [0, 1, 600])
def test_any_number_of_labels(spark, labels):
    rng = random.Random(labels)
    word = {k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüéèñçабвгд", k=12)) for k in range(max(labels, 1))}
    rows = [(k * 3 + n, f"{word[k]} {word[k][::-1]} {word[k][2:9]}", f"l{k}" if labels else None) for k in range(max(labels, 1)) for n in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, floors=True)
    assert len(model.langs) == labels and sum(w.size for w in model.weights) <= langid.CELLS
    got = langid.identify(docs, model, fits_out="fits").collect()
    assert len(got) == len(rows) and all(r.fits for r in got)
    right = sum(r.lang_pred == (r.lang or "und") for r in got)
    assert right >= 0.98 * len(rows)
    assert langid.bits_for(1) == langid.bits_for(512) == 16 and langid.bits_for(600) == 15


def test_every_labelled_row_counts_however_many_there_are(spark):
    n = 200_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"), F.lit("en").alias("lang"))
    model = langid.fit(docs, floors=True)
    found = langid.ngrams(["ab"])[0]
    unseen = np.setdiff1d(np.arange(65536), found)[0]
    seen = np.exp(model.weights[0][found] - model.weights[0][unseen]) * langid.SMOOTHING - langid.SMOOTHING
    assert np.allclose(seen, n, rtol=1e-4)
    logs = np.log(n - 1) - np.log(n * len(found) + langid.SMOOTHING * 65536 - len(found))
    assert np.isclose(model.floors[0], logs - langid.FLOOR_MARGIN, atol=1e-5)


def test_the_query_and_the_stage_learn_from_all_labelled_rows(spark, tmp_path, monkeypatch):
    rows = [(k, text, lang) for k in range(40) for text, lang in [(f"the cat {k}", "en"), (f"le chat {k}", "fr")]]
    docs = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bounds = []
    fit = langid.fit
    monkeypatch.setattr(langid, "fit", lambda *a, **b: bounds.append(inspect.signature(fit).bind(*a, **b)) or fit(*a, **b))
    assert langid.op4_language(spark, str(tmp_path)).count() == corpus_pipeline.language(spark, docs, "").count() == len(rows)
    for bound in bounds:
        bound.apply_defaults()
    assert [bound.arguments["fit_rows"] for bound in bounds] == [None, None]


@pytest.mark.parametrize("share", [0.0, 0.05, 0.5, 0.93, 1.0])
def test_floors_are_exact_percentiles(spark, share):
    rng = random.Random(7)
    values = {0: [-3.0], 1: [-2.5, -9.25], 2: [-4.0] * 50 + [-7.0] * 3, 3: [rng.gauss(-8, 0.5) for _ in range(3001)],
              4: [-8 - rng.random() / 5000 for _ in range(500)], 5: [round(rng.gauss(-6, 1), 1) for _ in range(777)]}
    rows = spark.createDataFrame([(at, v) for at, all_ in values.items() for v in all_], "at long, fit double")
    got = langid._low(rows, share)
    assert got.keys() == values.keys()
    for at, all_ in values.items():
        assert np.isclose(got[at], np.percentile(all_, 100 * share), rtol=1e-12)
    assert langid._low(rows.limit(0), share) == {}


def test_texts_are_counted_and_judged_in_parts_of_bounded_size(spark, monkeypatch):
    texts = ["the cat", None, "", "le chat et le chien " * 9, "the dog and the cat", "der hund", "x" * 500, "les chats"] * 3
    rows = [(k, text, ["en", "fr"][k % 2]) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = langid.fit(docs, floors=True)
    want = whole.judge(texts)
    monkeypatch.setattr(langid, "PART_CHARS", 40)
    held = []
    ngrams = langid.ngrams
    monkeypatch.setattr(langid, "ngrams", lambda part: held.append([len(t or "") for t in part]) or ngrams(part))
    got = whole.judge(texts)
    assert got[0] == want[0] and np.array_equal(got[1], want[1]) and np.array_equal(got[2], want[2])
    assert all(sum(part) <= 40 or len(part) == 1 for part in held) and sum(map(len, held)) == len(texts)
    assert [texts[part] for part in langid._parts(texts)] != [texts] and list(langid._parts([])) == []


def test_counts_of_batches_in_parts_are_whole(spark):
    texts = [("ab cd " * 15_000, "en"), ("le chat " * 12_000, "fr"), ("the cat " * 11_000, "en"), ("x", "fr")]
    assert len(list(langid._parts([text for text, _ in texts]))) > 1
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(texts)], "doc_id long, text string, lang string").coalesce(1)
    model = langid.fit(docs)
    for lang, weights in zip(model.langs, model.weights):
        counts = np.bincount(langid.ngrams([text for text, known in texts if known == lang])[0], minlength=65536) + langid.SMOOTHING
        assert np.allclose(weights, np.log(counts / counts.sum()), atol=1e-5)
