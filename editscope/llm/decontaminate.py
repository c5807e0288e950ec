"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items go into a suffix automaton over words. Each training text is streamed through it: at every
word the automaton holds the longest match that ends there. Matches of at least a window's length mark their words;
marked spans can be cut from the text, and texts with too large a marked share can be dropped.

The automaton is broadcast. Its size is bounded by ``shard_words``: a larger benchmark is cut into several automata,
overlapping by a window less one word, and the texts pass through one after the other, so no item is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 10
SHARD_WORDS = 1_000_000

#: Lower-cases A-Z; every other ASCII byte that is no letter or digit becomes a blank. Bytes of other characters stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case. A null text has none."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences. ``pieces``: (item, words, whole): whole marks a full short item."""

    def __init__(self, pieces: list[tuple[str | None, list[bytes], bool]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words, whole in pieces:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            coded.append((item, ids, whole))
            last = 0
            for word in ids:
                last = self._extend(last, word)
        self.at_window: dict[int, set] = {}  # state that holds a whole window -> its items
        self.short: dict[int, list[tuple[int, object]]] = {}  # state -> (length, item) of short items that end there
        pairs: set[int] = set()
        self.least = window
        for item, ids, whole in coded:
            pairs.update(a << 32 | b for a, b in zip(ids, ids[1:]))
            state = 0
            for k, word in enumerate(ids, 1):
                state = self.next[state][word]
                if whole and k == len(ids):
                    entry = (k, item)
                    if entry not in self.short.setdefault(state, []):
                        self.short[state].append(entry)
                    self.least = min(self.least, k)
                elif not whole and k >= window:
                    self.at_window.setdefault(self._cut(state), set()).add(item)
        # the next state up the links, itself included, at which a short item ends
        self.shorter = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            up = self.shorter[self.link[state]] if self.link[state] >= 0 else -1
            self.shorter[state] = state if state in self.short else up
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def _new(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _extend(self, last: int, word: int) -> int:
        """The state of the sequence so far plus one word; the states of earlier sequences are shared."""
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][word]
            if self.length[target] != self.length[last] + 1:
                target = self._clone(last, word, target)
            self.link[new] = target
        return new

    def _clone(self, before: int, word: int, target: int) -> int:
        copy = self._new(self.length[before] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while before >= 0 and self.next[before].get(word) == target:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _cut(self, state: int) -> int:
        """The state that holds the last ``window`` words of a match at ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Marked spans of word positions (merged, end exclusive) and the items with a window in the text."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        if len(words) < self.least or not self.vocab:
            return spans, items
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        if self.least >= 2:
            # a window needs least - 1 neighbouring word pairs that some item has; other words cannot be marked
            keys = ids[:-1] << 32 | ids[1:]
            at = np.searchsorted(self.pairs, keys)
            at[at == len(self.pairs)] = 0
            good = (ids[:-1] >= 0) & (ids[1:] >= 0) & (self.pairs[at] == keys)
            edge = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
            runs = [(a, b + 1) for a, b in edge.reshape(-1, 2).tolist() if b - a >= self.least - 1]
        else:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
            runs = [(a, b) for a, b in edge.reshape(-1, 2).tolist()]
        for start, end in runs:
            state, size = 0, 0
            for k, word in enumerate(ids[start:end].tolist(), start):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    size = self.length[state]
                move = self.next[state].get(word)
                if move is None:
                    state, size = 0, 0
                    continue
                state, size = move, size + 1
                marked = 0
                if size >= self.window:
                    marked = size
                    found = self.at_window.get(self._cut(state))
                    if found:
                        items |= found
                    else:
                        marked = 0
                up = self.shorter[state]
                while up >= 0:
                    for length, item in self.short[up]:
                        if length <= size:
                            items.add(item)
                            marked = max(marked, length)
                    up = self.shorter[self.link[up]] if self.link[up] >= 0 else -1
                if marked:
                    first = k + 1 - marked
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, k + 1))
        return spans, items


def _pieces(benchmark: DataFrame, window: int, piece_words: int) -> DataFrame:
    """Items cut into overlapping pieces of bounded length: (item, words as one string, whole, n)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for item, text in zip(batch["item"], batch["text"]):
                words = words_of(text)
                if not words:
                    continue
                if len(words) < window:
                    out.append((item, b" ".join(words).decode("utf-8", "surrogatepass"), True, len(words)))
                    continue
                step = piece_words - window + 1
                for k in range(0, max(1, len(words) - window + 1), step):
                    part = words[k : k + piece_words]
                    out.append((item, b" ".join(part).decode("utf-8", "surrogatepass"), False, len(part)))
            yield pd.DataFrame(out, columns=["item", "words", "whole", "n"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return items.mapInPandas(cut, "item string, words string, whole boolean, n long").distinct()


def _automata(benchmark: DataFrame, window: int, shard_words: int) -> Iterator[Automaton]:
    """One automaton after the other, each of about ``shard_words`` words: that much reaches the driver at a time."""
    pieces = common.staged(_pieces(benchmark, window, max(2 * window, shard_words // 16)), "benchmark-pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    for k in range(shards):
        mine = pieces
        if shards > 1:
            mine = pieces.filter(F.pmod(F.xxhash64("item", "words"), F.lit(shards)) == k)
        rows = mine.collect()  # bounded by shard_words
        rows = sorted(((r["item"], r["words"], r["whole"]) for r in rows), key=repr)
        yield Automaton([(i, w.encode("utf-8", "surrogatepass").split(), s) for i, w, s in rows], window)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())
    ]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    out: str = "hits",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with a column ``out``: number of words, marked spans of word positions, sorted items found.

    One row out for each row in, all columns kept. Null and empty texts have no words. Items without words match
    nothing; rows of one ``item_id`` are one item; items without an id mark words but are not listed.
    A column named ``out`` is replaced.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    small = "__hits"
    kept = docs.drop(out)
    names = kept.columns
    # rows go through Python, which takes no column name with a dot
    marked = kept.toDF(*[f"c{k}" for k in range(len(names))])
    text_col = f"c{names.index(text_col)}"
    for turn, automaton in enumerate(_automata(benchmark, window, shard_words)):
        shared = spark.sparkContext.broadcast(automaton)
        marked = _scan(marked, shared, text_col, small, first=turn == 0)
    return marked.toDF(*names, out)


def _scan(docs: DataFrame, shared, text_col: str, out: str, first: bool) -> DataFrame:
    kept = docs if first else docs.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, HITS)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        kind = pa.struct([
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ])
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            old = None if first else batch.column(batch.schema.get_field_index(out)).to_pylist()
            rows = []
            for k, text in enumerate(texts):
                words = words_of(text.as_py())
                spans, items = automaton.scan(words)
                if old:
                    spans = _merge(spans + [(s["start"], s["stop"]) for s in old[k]["spans"]])
                    items = items | set(old[k]["items"])
                items.discard(None)
                rows.append({
                    "n_words": len(words),
                    "spans": [{"start": a, "stop": b} for a, b in spans],
                    "items": sorted(items),
                })
            names = [n for n in batch.schema.names if n != out]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], names=[*names, out])

    return docs.mapInArrow(scan, schema)


def marked_words(hits: str = "hits"):
    """Number of marked words, from the spans."""
    return F.aggregate(
        F.col(f"{hits}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]
    )


def _without(text: str, spans: list) -> str:
    """The text without the marked words and what stands between them. Positions are found on the folded bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    folded = raw.translate(_FOLD)
    places = np.frombuffer(folded, np.uint8) != 32
    # blanks of bytes.split besides 32 cannot occur: the table has mapped them to 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], places.view(np.int8), [0])))).reshape(-1, 2)
    out, at = [], 0
    for span in spans:
        out.append(raw[at : edge[span["start"]][0]])
        at = int(edge[span["stop"] - 1][1])
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


@F.pandas_udf(T.StringType())
def _cut_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([
        t if t is None or s is None or not len(s) else _without(t, list(s)) for t, s in zip(text, spans)
    ], dtype=object)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    text_col: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without benchmark passages: marked spans are cut from the text, and texts of which more than
    ``max_coverage`` of the words are marked go as a whole. Texts without a mark stay as they are. Columns are kept.
    """
    columns = common.columns_of(docs)
    hits = "__contamination"
    rows = mark(docs, benchmark, window, text_col, hits, **options)
    hit = marked_words(hits)
    rows = rows.filter(hit <= F.col(f"{hits}.n_words") * F.lit(float(max_coverage)))
    # texts without a mark do not travel through the cutting function
    cut = F.when(F.size(f"{hits}.spans") == 0, F.col(text_col)).otherwise(_cut_text(text_col, f"{hits}.spans"))
    return rows.withColumn(text_col, cut).select(*columns)


def op10_decontaminate(spark, sf_dir) -> DataFrame:
    """Words of each document that lie in a 10-word window of a benchmark item, and the items found."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = mark(docs, common.table(spark, sf_dir, "benchmark"))
    hit = marked_words()
    return rows.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, k, k + least(len(w), 10) - 1), ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(k) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS s FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(k)
), found AS (
  SELECT doc_id, k, n, item_id FROM places JOIN windows USING (n, s)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(k, k + n)) t(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
