"""Language-model scores: the probability of a text over all its segmentations into subwords.

The subword inventory and its order come from a public sentencepiece model, which is read, never trained. Its scores are
merge ranks, so they serve as a prior (a rank's share falls as 1/rank); the counts of the pieces in the training texts
turn them into unigram probabilities. A text is its words, each after a word mark, and an end; pieces never span words,
so the sum over all segmentations of a text is the product of the sums of its words. The forward recursion runs once
for each distinct word of the corpus, in log space, and texts gather the results by a join.

Words so frequent that they would make hot join keys are looked up in a broadcast table instead. Its size is bounded by
``COMMON_WORDS`` and ``LONG_WORD``: a count threshold is taken from a histogram so that no more words pass it, and words
of more bytes stand there as their SHA-256. So it has at most 150,000 keys of 64 bytes, also where texts have no blanks.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

COMMON_WORDS = 150_000
LONG_WORD = 64
FLUSH = 200_000
FLUSH_BYTES = 64 << 20
PRIOR_WEIGHT = 1000.0
PRIOR_END = 1e-3
MARK = "▁"
LOG10 = math.log(10)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Vocabulary:
    """Pieces of a sentencepiece model with their prior shares; bytes stand in for characters that no piece covers."""

    def __init__(self, path: str):
        model = _processor(path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(k) for k in range(size)]
        self.bytes = {int(self.pieces[k][3:5], 16): k for k in range(size) if model.is_byte(k)}
        share = np.zeros(size)
        for k in range(size):
            if model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                continue
            rank = size if model.is_byte(k) else min(-model.get_score(k), size)
            share[k] = 1.0 / max(rank, 1.0)
        self.share = (1 - PRIOR_END) * share / share.sum()


class Lattice:
    """Forward recursion over the segmentations of a word. ``logs``: natural log-probability of each piece."""

    def __init__(self, vocabulary: Vocabulary, logs: np.ndarray):
        self.edges: dict[str, float | None] = {}
        bytes_of = {k for k in vocabulary.bytes.values()}
        for k, piece in enumerate(vocabulary.pieces):
            if vocabulary.share[k] <= 0 or k in bytes_of:
                continue
            for n in range(1, len(piece)):
                self.edges.setdefault(piece[:n], None)
            self.edges[piece] = float(logs[k])
        self.byte = [float(logs[vocabulary.bytes[b]]) for b in range(256)]

    def score(self, word: str) -> float:
        """Log-probability of the word mark and the word, summed over all segmentations."""
        text = MARK + word
        n = len(text)
        none = -math.inf
        forward = [none] * (n + 1)
        forward[0] = 0.0
        edges, exp, log1p = self.edges, math.exp, math.log1p
        for i in range(n):
            here = forward[i]
            if edges.get(text[i]) is None:  # no piece for this character alone: its bytes
                step = here + sum(self.byte[b] for b in text[i].encode("utf-8", "surrogatepass"))
                old = forward[i + 1]
                forward[i + 1] = step if old == none else max(step, old) + log1p(exp(-abs(step - old)))
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in edges:
                    break
                weight = edges[part]
                if weight is None:
                    continue
                step, old = here + weight, forward[j]
                if old == none:
                    forward[j] = step
                elif step > old:
                    forward[j] = step + log1p(exp(old - step))
                else:
                    forward[j] = old + log1p(exp(step - old))
        return forward[n]


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, c, total): occurrences in training texts and in all texts, of every distinct word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained, other, read = Counter(), Counter(), 0

        def frame():
            words = list(trained.keys() | other.keys())
            seen = [trained.get(w, 0) for w in words]
            return pa.RecordBatch.from_arrays([
                pa.array(words, pa.binary()), pa.array(seen, pa.int64()),
                pa.array([s + other.get(w, 0) for w, s in zip(words, seen)], pa.int64()),
            ], names=["word", "c", "total"])

        for batch in batches:
            for held, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = words_of(text.as_py())
                (other if held else trained).update(found)
                read += sum(map(len, found))
                full = len(trained) + len(other) > FLUSH
                if read > FLUSH_BYTES:  # most of it may be words that occurred before
                    read = sum(map(len, trained)) + sum(map(len, other))
                    full = full or 2 * read > FLUSH_BYTES
                if full:
                    yield frame()
                    trained.clear(), other.clear()
                    read = 0
        yield frame()

    parts = rows.select("held_out", "text").mapInArrow(count, "word binary, c long, total long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("total").alias("total"))


def _piece_logs(words: DataFrame, vocabulary: Vocabulary, path: str, ends: int) -> tuple[np.ndarray, float]:
    """Log-probabilities of the pieces and of the end: counts in the training words on top of the prior."""
    size = len(vocabulary.pieces)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _processor(path)
        seen = np.zeros(size)
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch["word"]]
            pieces = model.encode(texts, num_threads=1)
            weights = np.repeat(batch["c"].to_numpy(np.float64), [len(p) for p in pieces])
            flat = np.fromiter((k for p in pieces for k in p), np.int64, len(weights))
            seen += np.bincount(flat, weights=weights, minlength=size)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"piece": at, "n": seen[at].astype(np.int64)})

    summed = words.filter("c > 0").select("word", "c").mapInPandas(count, "piece long, n long")
    counts = np.zeros(size)
    for row in summed.groupBy("piece").agg(F.sum("n").alias("n")).collect():  # at most one row for each piece
        counts[row["piece"]] = row["n"]
    counts[vocabulary.share <= 0] = 0
    total = counts.sum() + ends + PRIOR_WEIGHT
    with np.errstate(divide="ignore"):
        logs = np.log((counts + PRIOR_WEIGHT * vocabulary.share) / total)
    return logs, math.log((ends + PRIOR_WEIGHT * PRIOR_END) / total)


def _short(word: bytes) -> bytes:
    """The word, or a blank, which no word has, and the SHA-256 of a long one."""
    return word if len(word) <= LONG_WORD else b" " + hashlib.sha256(word).digest()


def _common(words: DataFrame, most: int) -> tuple[list, int]:
    """The most frequent words (``_short``), at most ``most``, and the count from which on a word is among them."""
    level = F.floor(F.log2("total") * 8)
    histogram = words.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()  # at most 64 * 8 rows
    taken, least = 0, None
    for row in sorted(histogram, key=lambda r: -r["level"]):
        if taken + row["n"] > most:
            break
        taken, least = taken + row["n"], row["level"]
    if least is None:
        return [], 0
    digest = F.concat(F.lit(b" "), F.unhex(F.sha2("word", 256)))
    short = F.when(F.octet_length("word") <= LONG_WORD, F.col("word")).otherwise(digest)
    return words.filter(level >= least).select(short.alias("word"), "c", "logp").collect(), least


def score(
    docs: DataFrame,
    held_out,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_path: str | None = None,
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """One row for each row: the id, ``held_out``, ``n_tokens`` (words and an end), ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigram over words) and ``score`` (log10 of the summed probability of all segmentations).

    ``held_out`` is a boolean column; the model learns from the other rows, and from all words of their texts. A-Z
    count as a-z, words stand between ASCII white space. Null and empty texts are one end token. With no training
    texts the prior shares alone score. Repeated rows count and come back repeated.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    path = vocabulary_path or default_vocabulary()
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    counted = common.staged(_word_counts(rows), "lm-counts")
    ends = rows.filter("not held_out").count()
    totals = counted.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    train_tokens = (totals["n"] or 0) + ends
    kinds = totals["v"] + (1 if ends else 0)
    vocabulary = Vocabulary(path)
    logs, end_log = _piece_logs(counted, vocabulary, path, ends)
    lattice = spark.sparkContext.broadcast(Lattice(vocabulary, logs))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forward = lattice.value.score
        for batch in batches:
            batch["logp"] = [forward(w.decode("utf-8", "replace")) / LOG10 for w in batch["word"]]
            yield batch

    words = common.staged(counted.mapInPandas(weigh, "word binary, c long, total long, logp double"), "lm-words")
    frequent, _ = _common(words, common_words)
    base_of = math.log10(train_tokens + kinds + 1)
    shared = spark.sparkContext.broadcast((
        {r["word"] if isinstance(r["word"], bytes) else bytes(r["word"]): k for k, r in enumerate(frequent)},
        np.array([r["c"] > 0 for r in frequent], bool),
        np.array([math.log10(r["c"] + 1) - base_of for r in frequent], float),
        np.array([r["logp"] for r in frequent], float),
    ))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known, base, logp = shared.value
        rest_kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        for batch in batches:
            out = {"n_words": [], "known": [], "base": [], "score": [], "rest": []}
            for text in batch.column(2):
                found = words_of(text.as_py())
                ids = np.fromiter((place.get(w, -1) for w in found), np.int64, len(found))
                rare = Counter(found[k] for k in np.flatnonzero(ids < 0).tolist())
                listed = [w for w in rare if len(w) > LONG_WORD and _short(w) in place]
                long_ids = [k for w in listed for k in [place[_short(w)]] * rare.pop(w)]
                here = np.concatenate([ids[ids >= 0], np.array(long_ids, np.int64)])
                out["n_words"].append(len(found))
                out["known"].append(int(known[here].sum()))
                out["base"].append(float(base[here].sum()))
                out["score"].append(float(logp[here].sum()))
                out["rest"].append([{"word": w, "n": n} for w, n in rare.items()])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(out["n_words"], pa.int64()), pa.array(out["known"], pa.int64()),
                pa.array(out["base"], pa.float64()), pa.array(out["score"], pa.float64()), pa.array(out["rest"], rest_kind),
            ], names=["id", "held_out", *out])

    id_type = rows.schema["id"].dataType.simpleString()
    texts = rows.mapInArrow(
        gather,
        f"id {id_type}, held_out boolean, n_words long, known long, base double, score double, "
        "rest array<struct<word:binary,n:bigint>>",
    )
    texts = common.staged(texts.withColumn("row", F.monotonically_increasing_id()), "lm-texts")
    rare = texts.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n")
    joined = rare.join(words.select("word", "c", "logp"), "word")
    more = joined.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known2"),
        F.sum(F.col("n") * (F.log10(F.col("c") + 1) - base_of)).alias("base2"),
        F.sum(F.col("n") * F.col("logp")).alias("score2"),
    )
    end_base = math.log10(ends + 1) - base_of
    return texts.drop("rest").join(more, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("known2", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0)) + end_base).alias("base_score"),
        (F.col("score") + F.coalesce("score2", F.lit(0.0)) + end_log / LOG10).alias("score"),
    )


def op8_lattice(spark, sf_dir) -> DataFrame:
    """Scores of every document by a model of the six sevenths that are not held out."""
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
