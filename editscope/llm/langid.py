"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams in numpy, sums them per (language, bucket) in Spark and brings one matrix of languages by
buckets to the driver. The matrix has at most ``CELLS`` numbers: with more than 512 languages an n-gram is hashed to fewer
bits. Prediction
broadcasts the log-probabilities and scores a batch of texts at once: one gather and one sum per text.

The posterior only compares the languages with each other, and is near 1 for any text of some length. Whether a text fits
any of them is told by its mean log-probability per n-gram against a floor for each language (``Model.judge``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

ORDERS = (1, 2, 3)
SMOOTHING = 0.1
#: Numbers of the matrix, and labels that are learned: the most frequent ones, should there be more.
CELLS, MAX_LANGS = 1 << 25, 1 << 15
UNKNOWN = "und"
#: The floor of a language: so much (nats per n-gram) below what this share of its labelled rows stays under.
FLOOR_SHARE, FLOOR_MARGIN = 0.05, 2.0
#: Scores of labelled rows are counted in steps of this part of a nat; only those in the step of the floor are ordered.
STEPS = 1024
#: Standard errors of the mean that a text may be below the floor, so that short texts are not judged by a few n-grams.
ROOM = 3.0

#: Code points whose n-grams are held at once, unless a single text has more: some dozens of bytes each.
PART_CHARS = 1 << 18

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngrams(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a batch of texts: bucket of each n-gram, number of the text it is in, letters of each text.

    Texts are lower-cased; runs of other characters count as one blank, and each text is framed by blanks.
    """
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) if t else np.zeros(0, np.uint32)
              for t in texts]
    sizes = np.fromiter((len(p) + 2 for p in points), np.int64, len(points))
    flat = np.zeros(int(sizes.sum()), np.uint32)
    ends = np.cumsum(sizes)
    for p, end in zip(points, ends.tolist()):
        flat[end - 1 - len(p) : end - 1] = p
    letter = _letters()[flat]
    flat = np.where(letter, flat, 0)
    owner = np.repeat(np.arange(len(points), dtype=np.int32), sizes)
    n_letters = np.bincount(owner, weights=letter, minlength=len(points)).astype(np.int64)
    first = np.ones(len(flat), bool)
    first[1:] = (flat[1:] != 0) | (flat[:-1] != 0) | (owner[1:] != owner[:-1])
    flat, owner = flat[first], owner[first]
    buckets, owners = [], []
    for n in ORDERS:
        if len(flat) < n:
            continue
        size = len(flat) - n + 1
        code = np.full(size, 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            code = (code ^ flat[k : k + size]) * np.uint32(0x85EBCA6B)
            code ^= code >> np.uint32(13)
        inside = owner[:size] == owner[n - 1 :]
        if n == 1:
            inside &= flat != 0
        buckets.append((code[inside] >> np.uint32(16)).astype(np.int32))
        owners.append(owner[:size][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), n_letters
    return np.concatenate(buckets), np.concatenate(owners), n_letters


def _parts(texts: list) -> Iterator[slice]:
    """Runs of texts with at most ``PART_CHARS`` together, or one longer text; a worker's memory doesn't grow with a batch."""
    start = held = 0
    for k, text in enumerate(texts):
        size = len(text or "")
        if k > start and held + size > PART_CHARS:
            yield slice(start, k)
            start, held = k, 0
        held += size
    if len(texts) > start:
        yield slice(start, len(texts))


def bits_for(langs: int) -> int:
    """Bits of an n-gram's bucket: 16 up to 512 languages, one less each time their number doubles."""
    return min(16, (CELLS // max(langs, 1)).bit_length() - 1)


@dataclass
class Model:
    """``weights``: buckets by languages, float32 log-probabilities. ``priors``: log share of each language.

    ``floors``: lowest mean log-probability per n-gram of a long text that fits the language. ``spread``: standard
    deviation of one n-gram's log-probability in it. Both are None unless the model was fitted with floors.
    """

    langs: list[str]
    weights: np.ndarray
    priors: np.ndarray
    floors: np.ndarray | None = None
    spread: np.ndarray | None = None

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        return self.judge(texts)[:2]

    def judge(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, posterior, and whether the text fits any of the languages (has a letter, if there are no floors or no
        language was learned).

        The allowance for short texts shrinks with the root of their length. A language with few labelled rows has a
        low floor, since little can be told from them.
        """
        if not len(texts):
            return [], np.zeros(0), np.zeros(0, bool)
        names, scores, fits = zip(*(self._judge(texts[part]) for part in _parts(texts)))
        return [name for part in names for name in part], np.concatenate(scores), np.concatenate(fits)

    def _judge(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        bucket, owner, letters = ngrams(texts)
        if not self.langs:  # nothing is known that a text could fail to fit
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), letters > 0
        bucket = bucket >> (16 - bits_for(len(self.langs)))
        sums = np.empty((len(texts), len(self.langs)))
        for k in range(len(self.langs)):
            sums[:, k] = np.bincount(owner, weights=self.weights[k][bucket], minlength=len(texts))
        fits = letters > 0
        if self.floors is not None:
            n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)[:, None]
            fits &= (sums / n + ROOM * self.spread / np.sqrt(n / len(ORDERS)) >= self.floors).any(axis=1)
        # the orders overlap, so their evidence counts once
        sums = sums / len(ORDERS) + self.priors
        sums -= sums.max(axis=1, keepdims=True)
        share = np.exp(sums)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        names = [self.langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), letters.tolist())]
        return names, np.where(letters > 0, share[np.arange(len(texts)), best], 0.0), fits


def fit(
    rows: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_rows: int | None = None, floors: bool = False
) -> Model:
    """A model of all rows with a text and a language.

    Rows with a null text or language are left out; with none left, the model knows no language and predicts ``und``.
    Any number of labels will do: the ``MAX_LANGS`` most frequent are learned.

    With ``floors``, a second pass scores each of the rows used by the counts of the others, and the model can tell
    texts that fit no language.

    Only a caller that gives ``fit_rows`` gets a model of a sample; no query does. If there are more rows than that, the
    languages share the number evenly: those with fewer rows are used whole, of the others a share, chosen by a hash of
    all simple columns. So copies of a text under other ids are thinned like any rows; only rows equal in all of these
    columns stay together.
    """
    spark = rows.sparkSession
    common.small_batches(spark)
    simple = [f"`{c.name.replace('`', '``')}`" for c in rows.schema if isinstance(c.dataType, T.AtomicType)]
    known = rows.select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.col(text_col).cast("string"), *simple).alias("row"),
    ).dropna(subset=["text", "lang"])
    labels = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    counts = {r["lang"]: r["n"] for r in labels.collect()}
    if len(counts) == MAX_LANGS:
        known = known.join(F.broadcast(labels.select("lang")), "lang", "left_semi").select("text", "lang", "row")
    langs = sorted(counts)
    total = sum(counts.values())
    if fit_rows is not None and total > fit_rows:
        known = _sample(known, counts, fit_rows)
    known = known.select("text", "lang")
    place = {lang: k for k, lang in enumerate(langs)}

    size = 1 << bits_for(len(langs))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64)), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            at, place_ = np.unique(np.concatenate([held[0], *(w[0] for w in waiting)]), return_inverse=True)
            return at, np.bincount(place_, weights=np.concatenate([held[1], *(w[1] for w in waiting)]), minlength=len(at)).astype(np.int64)

        for batch in batches:
            texts, lang = batch["text"].tolist(), batch["lang"].map(place).to_numpy(np.int64)
            for part in _parts(texts):
                bucket, owner, _ = ngrams(texts[part])
                at = lang[part][owner] * size + (bucket >> (16 - bits_for(len(langs))))
                waiting.append(np.unique(at, return_counts=True))
            if sum(len(w[0]) for w in waiting) > max(len(held[0]), 1 << 20):
                held, waiting = merged(), []
        at, n = merged()
        yield pd.DataFrame({"at": at, "n": n})

    table = np.full(len(langs) * size, SMOOTHING)
    if langs:
        summed = known.mapInPandas(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        table[summed["at"].to_numpy(np.int64)] += summed["n"].to_numpy(np.float64)
    table = table.reshape(len(langs), size)
    weights = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32) if langs else table
    priors = np.log(np.array([counts[lang] for lang in langs], float) / total) if langs else np.zeros(0)
    model = Model(langs, weights, priors)
    if floors and langs:
        model.floors, model.spread = _floors(known, table, weights, place)
    return model


def _sample(known: DataFrame, counts: dict[str, int], fit_rows: int) -> DataFrame:
    """About ``fit_rows`` of the rows, shared evenly among the languages; what small ones leave goes to the others."""
    fine = 1_000_000_000
    below, left = {}, float(fit_rows)
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda item: item[1])):
        quota = left / (len(counts) - k)
        if n > quota:
            below[lang] = int(fine * quota / n)
        left -= min(n, quota)
    bound = F.create_map(*(F.lit(x) for item in below.items() for x in item))[F.col("lang")]
    return known.filter(F.pmod("row", F.lit(fine)) < F.coalesce(bound, F.lit(fine)))


def _floors(known: DataFrame, table: np.ndarray, weights: np.ndarray, place: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Floor and spread of each language; a language without a labelled letter has no floor that a text could reach."""
    sizes = table.sum(axis=1)
    shared = known.sparkSession.sparkContext.broadcast(table.astype(np.float32))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, fits = [], []
            for text, name in zip(batch["text"].tolist(), batch["lang"].tolist()):
                bucket, _, letters = ngrams([text])
                if not letters[0]:
                    continue
                at, own = np.unique(bucket >> (16 - bits_for(len(place))), return_counts=True)
                left = np.maximum(shared.value[place[name]][at] - own, SMOOTHING)
                lang.append(place[name])
                fits.append(float((own * np.log(left)).sum() / len(bucket) - np.log(sizes[place[name]] - len(bucket))))
            yield pd.DataFrame({"at": np.array(lang, np.int64), "fit": np.array(fits, np.float64)})

    floors = np.full(len(place), np.inf)
    for at, low in _low(known.mapInPandas(score, "at long, fit double"), FLOOR_SHARE).items():
        floors[at] = low - FLOOR_MARGIN
    share = table / sizes[:, None]
    logs = weights.astype(np.float64)
    mean = (share * logs).sum(axis=1)
    return floors, np.sqrt(np.maximum((share * logs**2).sum(axis=1) - mean**2, 0))


def _low(fits: DataFrame, share: float) -> dict[int, float]:
    """For each ``at``, the ``fit`` that this share of its rows stays under, as ``percentile`` has it: exact, and in between
    two values by the distance to their ranks.

    No task holds all values of a language. They are counted in steps of 1 / ``STEPS``, some ten thousand of them, since a
    mean log-probability has a few dozen nats; then the values in the one or two steps that hold the ranks are ordered.
    """
    fits = common.staged(fits, "langid-fits")
    values = fits.groupBy("at", "fit").agg(F.count("*").alias("n")).withColumn("step", F.floor(F.col("fit") * STEPS))
    before = Window.partitionBy("at").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = values.groupBy("at", "step").agg(F.sum("n").alias("n")).withColumns({
        "below": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "rank": (F.sum("n").over(Window.partitionBy("at")) - 1) * F.lit(share),
    })
    steps = steps.filter((F.col("below") <= F.ceil("rank")) & (F.col("below") + F.col("n") > F.floor("rank")))
    upto = Window.partitionBy("at", "step").orderBy("fit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = values.join(F.broadcast(steps.select("at", "step", "below", "rank")), ["at", "step"])
    near = near.withColumn("upto", F.col("below") + F.sum("n").over(upto))
    picked = near.groupBy("at").agg(
        F.first("rank").alias("rank"), F.min(F.when(F.col("upto") > F.floor("rank"), F.col("fit"))).alias("low"),
        F.min(F.when(F.col("upto") > F.ceil("rank"), F.col("fit"))).alias("high"),
    )
    out = {}
    for r in picked.collect():
        part = r["rank"] - math.floor(r["rank"])
        out[r["at"]] = r["low"] if r["low"] == r["high"] else (1 - part) * r["low"] + part * r["high"]
    return out


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score",
    fits_out: str | None = None,
) -> DataFrame:
    """``docs`` with the predicted language and its posterior probability, 0 to 1; in ``fits_out``, if given, whether the
    text fits any language of a model that has floors.

    A text that is null or has no letter is ``und`` with score 0. Equal scores go to the first language in name order.
    One row out for each row in; columns with the names of the results are replaced.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fits", T.BooleanType()),
    ])

    @F.pandas_udf(kind)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            names, scores, fits = shared.value.judge(batch.tolist())
            yield pd.DataFrame({"lang": names, "score": scores, "fits": fits})

    out = "__language"
    rows = docs.withColumn(out, predict.asNondeterministic()(F.col(text_col).cast("string")))
    results = {lang_out: F.col(f"{out}.lang"), score_out: F.col(f"{out}.score")}
    if fits_out:
        results[fits_out] = F.col(f"{out}.fits")
    return rows.withColumns(results).drop(out)


def fold(doc_id: str = "doc_id", parts: int = 5):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def op4_language(spark, sf_dir) -> DataFrame:
    """Language of every document, learned from the four fifths that are not held out."""
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs.filter(fold() != 0))
    rows = identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
