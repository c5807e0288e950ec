"""Quality rules as a short-circuit cascade: the rule that rejects most for its cost is asked first.

A rule rejects a text by measures of it. Measures differ in cost, and a text that one rule rejects need not be measured
for the others. So every measure is timed and every rule tried on a sample of the rows, and the rules are put in order
greedily: next comes the rule with most rejections, among the sample rows that the rules before it let pass, for the
seconds of the measures that are still to be taken. The order decides what is spent, never which texts stay: a text is
kept if no rule rejects it.

The sample is used for the order only; its size is a parameter. Taking it reads the texts once more, but few of them
leave the JVM.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 8
SAMPLE_ROWS = 2000
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = b"abcdefghijklmnopqrstuvwxyz"
_WORD_WITH_LETTER = re.compile(rb"[A-Za-z\x80-\xff][^\x20\x09-\x0d]*")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` (a power of two) words found twice or more.

    Words become numbers, and neighbours are joined to numbers of pairs, fours and so on, so equal numbers mean equal
    runs. A step without equal numbers ends the search.
    """
    count = len(words) - window + 1
    if count < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    times = np.ones(0)
    step = 1
    while step < window:
        pairs = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        _, ids, times = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(times) == len(ids):
            return 0
        step *= 2
    starts = np.flatnonzero(times[ids] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((edge.cumsum() > 0).sum())


class Text:
    """A text and what has been measured of it. A null text has no words."""

    __slots__ = ("data", "words", "lines", "known")

    def __init__(self, text: str | None):
        self.data = (text or "").encode("utf-8", "surrogatepass")
        self.words: list[bytes] = []
        self.lines: list[bytes] = []
        self.known: dict[str, int] = {}

    def measure(self, name: str) -> int:
        """Values are taken once. A measure that needs another one takes that first."""
        if name not in self.known:
            self.known[name] = MEASURES[name][1](self)
        return self.known[name]


def _n_words(text: Text) -> int:
    text.words = text.data.split()  # blanks of bytes are 9 to 13 and 32
    return len(text.words)


def _word_chars(text: Text) -> int:
    text.measure("n_words")
    return len(b"".join(text.words).decode("utf-8", "surrogatepass"))


def _count(text: Text, marks: bytes) -> int:
    return len(text.data) - len(text.data.translate(None, marks))


def _n_lines(text: Text) -> int:
    text.lines = [line for line in text.data.split(b"\n") if line.strip()]
    return len(text.lines)


def _n_dup_lines(text: Text) -> int:
    return text.measure("n_lines") - len(set(text.lines))


def _n_repeat_words(text: Text) -> int:
    text.measure("n_words")
    return repeated_words(text.words)


#: Measures: what they need first, and how they are taken.
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[Text], int]]] = {
    "n_words": ((), _n_words),
    "word_chars": (("n_words",), _word_chars),
    "n_symbols": ((), lambda t: _count(t, SYMBOLS)),
    "n_lines": ((), _n_lines),
    "n_dup_lines": (("n_lines",), _n_dup_lines),
    "n_repeat_words": (("n_words",), _n_repeat_words),
    "n_letter_words": ((), lambda t: len(_WORD_WITH_LETTER.findall(t.data))),
    "n_capitals": ((), lambda t: _count(t, CAPITALS)),
    "n_small": ((), lambda t: _count(t, SMALL)),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text if ``rejects`` of its ``measures`` holds."""

    name: str
    measures: tuple[str, ...]
    rejects: Callable[..., bool]

    def holds(self, text: Text) -> bool:
        return self.rejects(*[text.measure(m) for m in self.measures])


#: A text must have 20 words and at most 30 % of them in repeated runs.
BASE = (
    Rule("few_words", ("n_words",), lambda n: n < 20),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
)
#: One symbol for ten words, three lines in ten seen before, words of less than two or more than fifteen characters on
#: average, three words in ten without a letter (of ASCII, or any character beyond it), seven capitals in ten letters.
RULES = BASE + (
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 10 * d > 3 * n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: c < 2 * n or c > 15 * n),
    Rule("no_letters", ("n_letter_words", "n_words"), lambda w, n: 10 * w < 7 * n),
    Rule("capitals", ("n_capitals", "n_small"), lambda c, s: 10 * c > 7 * (c + s)),
)


def _needed(measures) -> list[str]:
    """The measures and what they need, those needed first."""
    out: list[str] = []
    for name in measures:
        for one in (*_needed(MEASURES[name][0]), name):
            if one not in out:
                out.append(one)
    return out


@dataclass(frozen=True)
class Cascade:
    """Rules in the order they are asked, with the sample's rejections (among texts that reached the rule) and seconds
    a text for each."""

    rules: tuple[Rule, ...]
    rejected: tuple[int, ...] = ()
    seconds: tuple[float, ...] = ()
    rows: int = 0
    costs: dict[str, float] = field(default_factory=dict)

    def ask(self, text: Text) -> str | None:
        """The first rule that rejects the text, None if it is kept."""
        for rule in self.rules:
            if rule.holds(text):
                return rule.name
        return None


def order(rules: tuple[Rule, ...], outcomes: np.ndarray, costs: dict[str, float]) -> Cascade:
    """The cascade of ``rules`` by rejections per cost. ``outcomes`` says for each row and rule of the sample whether the
    rule rejects; ``costs`` are the seconds a text of each measure. Equal ones keep the order they came in."""
    alive = np.ones(len(outcomes), bool)
    left, taken, picked = list(range(len(rules))), set(), []
    while left:
        best = None
        for k in left:
            price = sum(costs.get(m, 0.0) for m in _needed(rules[k].measures) if m not in taken)
            hits = int(outcomes[alive, k].sum())
            rank = (hits / max(price, 1e-9), -price)
            if best is None or rank > best[0]:
                best = (rank, k, hits, price)
        _, k, hits, price = best
        picked.append((rules[k], hits, price))
        taken.update(_needed(rules[k].measures))
        alive &= ~outcomes[:, k]
        left.remove(k)
    names, rejected, seconds = zip(*picked) if picked else ((), (), ())
    return Cascade(tuple(names), tuple(rejected), tuple(seconds), len(outcomes), dict(costs))


def estimate(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 42
) -> Cascade:
    """The cascade for ``docs``: every measure timed and every rule tried on about ``sample_rows`` of the rows.

    The driver gets one row of outcomes and seconds for each row of the sample. An empty table, or a sample that no rule
    rejects anything of, gives the order of cost.
    """
    common.small_batches(docs.sparkSession)
    total = docs.count()
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    if total > sample_rows:
        texts = texts.sample(False, sample_rows / total, seed)
    measures = _needed(m for rule in rules for m in rule.measures)

    def trial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits, spent = [], []
            for one in batch["text"].tolist():
                text, clock = Text(one), []
                for name in measures:
                    start = time.perf_counter()
                    text.measure(name)
                    clock.append(time.perf_counter() - start)
                spent.append(clock)
                hits.append([rule.holds(text) for rule in rules])
            yield pd.DataFrame({"hits": hits, "spent": spent})

    rows = texts.mapInPandas(trial, "hits array<boolean>, spent array<double>").collect()  # bounded by sample_rows
    outcomes = np.array([r["hits"] for r in rows], bool).reshape(len(rows), len(rules))
    spent = np.array([r["spent"] for r in rows], float).reshape(len(rows), len(measures))
    return order(rules, outcomes, dict(zip(measures, spent.mean(axis=0).tolist() if len(rows) else [0.0] * len(measures))))


def judge(
    docs: DataFrame, cascade: Cascade, text_col: str = "text", out: str = "quality", complete: tuple[str, ...] = ()
) -> DataFrame:
    """``docs`` with a column ``out``: ``kept``, ``rejected_by`` (the first rule that did, in the cascade's order), and
    the measures as longs. Those that no rule had to ask for are null, unless named in ``complete``.

    One row out for each row in; a column named ``out`` is replaced. A null text has no words.
    """
    common.small_batches(docs.sparkSession)
    names = list(dict.fromkeys([*_needed(m for rule in cascade.rules for m in rule.measures), *_needed(complete)]))
    kind = T.StructType([
        T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in names],
    ])

    @F.pandas_udf(kind)
    def ask(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rejected, values = [], []
            for one in batch.tolist():
                text = Text(one)
                rejected.append(cascade.ask(text))
                for name in complete:
                    text.measure(name)
                values.append([text.known.get(name) for name in names])
            frame = pd.DataFrame({name: pd.array([v[k] for v in values], "Int64") for k, name in enumerate(names)})
            frame.insert(0, "rejected_by", pd.Series(rejected, dtype=object))
            frame.insert(0, "kept", [r is None for r in rejected])
            yield frame

    return docs.withColumn(out, ask.asNondeterministic()(F.col(text_col).cast("string")))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    columns = common.columns_of(docs)
    rows = judge(docs, estimate(docs, rules, text_col, sample_rows), text_col, "__quality")
    return rows.filter("__quality.kept").select(*columns)


def op12_quality(spark, sf_dir) -> DataFrame:
    """Measures of every document and whether the cascade keeps it.

    A null or empty text has no words and fails the base rules; so does any text under 20 words. Equal texts have equal
    rows.
    """
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = judge(docs, estimate(docs), complete=shown).select("doc_id", "quality.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("doc_id", *shown, failed.alias("base_failed"), "kept")


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER () AS row FROM d
), windows AS (
  SELECT row, k, array_to_string(list_slice(w, k, k + 7), ' ') AS s FROM numbered, unnest(range(1, greatest(len(w) - 7, 0) + 1)) t(k)
), found AS (
  SELECT row, k FROM windows QUALIFY count(*) OVER (PARTITION BY row, s) > 1
), repeats AS (
  SELECT row, count(DISTINCT p) AS n_repeat_words FROM found, unnest(range(k, k + 8)) t(p) GROUP BY row
), measures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS letter_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(text, '[^a-z]', '', 'g')) AS small
  FROM numbered LEFT JOIN repeats USING (row)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words
    OR word_chars > 15 * n_words OR 10 * letter_words < 7 * n_words OR 10 * capitals > 7 * (capitals + small)) AS kept
FROM judged
"""
