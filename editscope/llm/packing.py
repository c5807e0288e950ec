"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of piece lengths reaches the driver; it has at most ``CAPACITY`` rows whatever the input. The
covering program over configurations (which lengths share a sequence, and how often) is solved by multiplicative
weights until it covers every piece: each round prices configurations by knapsack dynamic programming within what is
left, uses those of nearly the best weight by a step that the scarcest length sets, rounded to whole sequences, and
lowers the weights of what they cover. Best fit in falling order of length, on counts, is kept as the measure: should it
need fewer sequences, it is taken. The plan is a table of runs (length,
ranks, sequence, offset), bounded by configurations and not by pieces. Each piece gets a rank among those of its length
and looks its place up.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CAPACITY = 1024
END_ID = 2
#: A step covers this part of the pieces of its scarcest length; weights fall at this rate; configurations down to this
#: part of a round's best weight are used in it; weights start as the shares of the capacity to this power.
STEP, RATE, NEAR, POWER = 0.1, 1.0, 0.97, 3.0
CACHE = 400_000
SPECIAL = "<|endoftext|>"


#: White space as the tokenizer's pattern has it, without blank and line feed.
_ODD_SPACE = "\t\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = f" \n{_ODD_SPACE}"


_CLOSING = frozenset(",.;:!?")


class _Pieces(dict):
    """Ids of pieces of text that came before; at most ``CACHE`` of them are kept."""

    def __init__(self, codec):
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        if piece[-1:] in _CLOSING and piece[-2:-1].isalnum():  # always a cut: a mark after a letter or digit
            return self[piece[:-1]] + self[piece[-1]]
        ids = self.codec.encode_ordinary(piece)
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < CACHE and len(piece) <= 64:  # frequent pieces come early
            self[piece] = ids
        return ids


class Encoder:
    """Token ids of the public byte-level vocabulary as little-endian 32-bit integers.

    The tokenizer's pattern never joins what stands on both sides of white space, except that a blank goes with what
    follows it. So texts are cut there, and the ids of each piece are looked up or encoded from the same vocabulary.
    Ids equal those of ``tokenizers`` on the whole text.
    """

    def __init__(self):
        import base64

        import public_tokenizers as public
        import tiktoken

        with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        codec = tiktoken.Encoding("pieces", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = struct.pack("<I", 50256)
        self.kept = _Pieces(codec)
        self.odd = re.compile(f"[{_ODD_SPACE}]").search
        self.cut = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]").findall

    def _plain(self, text: str) -> bytes:
        plain = not (
            "  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\0" in text
            or text[-1:] in (" ", "\n") or self.odd(text)
        )
        if plain:  # single blanks and line feeds only: a split does
            pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        else:
            pieces = self.cut(text)
        return b"".join(map(self.kept.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        if SPECIAL not in text:
            return self._plain(text)
        return self.special.join(self._plain(part) for part in text.split(SPECIAL))


@lru_cache(maxsize=1)
def _encoder() -> Encoder:
    """One for each Python worker, over all its tasks."""
    return Encoder()


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: id, piece, start, length, ids_crc32.

    Each document ends with token 2. A longer one is cut; its first piece is what is left over. A null text is empty.
    """
    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    end = struct.pack("<I", END_ID)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder()
        for batch in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                size = len(ids) // 4
                at, stop, n = 0, size % capacity or capacity, 0
                while at < size:
                    owner.append(k), piece.append(n), start.append(at), length.append(stop - at)
                    crc.append(zlib.crc32(ids[4 * at : 4 * stop]))
                    at, stop, n = stop, stop + capacity, n + 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ], names=["id", "piece", "start", "length", "ids_crc32"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {id_type}, piece int, start long, length long, ids_crc32 long")


class Knapsack:
    """The configurations of largest total weight for every capacity up to ``capacity``: each length up to its limit, by
    dynamic programming over the filled capacity. Copies of a length go in as groups of 1, 2, 4 and so on."""

    def __init__(self, weights: np.ndarray, lengths: np.ndarray, limits: np.ndarray, capacity: int):
        self.lengths = lengths
        self.groups: list[tuple[int, int]] = []  # length, copies
        for k in np.flatnonzero((limits > 0) & (lengths <= capacity))[::-1].tolist():
            left, size = min(capacity // int(lengths[k]), int(limits[k])), 1
            while left:
                self.groups.append((k, min(size, left)))
                left -= min(size, left)
                size *= 2
        self.value = np.zeros(capacity + 1)
        self.taken = np.zeros((capacity + 1, len(self.groups)), bool)
        for g, (k, copies) in enumerate(self.groups):
            room = int(lengths[k]) * copies
            if room > capacity:
                continue
            gains = self.value[: capacity + 1 - room] + weights[k] * copies
            better = gains > self.value[room:] * (1 + 1e-12)
            self.taken[room:, g] = better
            self.value[room:][better] = gains[better]

    def config(self, capacity: int) -> dict[int, int]:
        """How often each length (by its place) is in the best configuration for ``capacity``."""
        out: dict[int, int] = {}
        upto = len(self.groups)
        while True:
            used = np.flatnonzero(self.taken[capacity, :upto])
            if not len(used):
                return out
            upto = int(used[-1])
            k, copies = self.groups[upto]
            out[k] = out.get(k, 0) + copies
            capacity -= int(self.lengths[k]) * copies


def price(weights: np.ndarray, lengths: np.ndarray, limits: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of the largest total weight: how often each length, none above its limit."""
    out = np.zeros(len(lengths), np.int64)
    for k, copies in Knapsack(weights, lengths, limits, capacity).config(capacity).items():
        out[k] = copies
    return out


def program(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Configurations and how often to use each, so that together they hold every piece: the covering program over
    configurations by multiplicative weights.

    A length's weight starts as a power of its share of the capacity, since one long piece is harder to place than short
    ones of the same sum, and falls with the part of its pieces that is covered, so that next those count that are left.
    A round prices once and takes the best
    configuration around every open length, as long as its weight is near the best of the round. A configuration is
    used until ``STEP`` of the scarcest of its lengths is covered, but at least once: the amount is rounded to whole
    sequences there and then, and what is cut off stays in the program and is priced again. Limits are inside the
    pricing, so no length is covered beyond what there is, and the number of steps is in proportion to the lengths.
    """
    weights = (lengths / capacity) ** POWER
    left = counts.copy()
    used: dict[tuple, int] = {}

    def use(config: dict[int, int]) -> None:
        amount = max(1, int(STEP * min(counts[k] / n for k, n in config.items())))
        amount = min(amount, min(int(left[k]) // n for k, n in config.items()))
        for k, n in config.items():
            left[k] -= amount * n
            weights[k] *= np.exp(-RATE * amount * n / counts[k])
        shape = tuple(sorted(config.items()))
        used[shape] = used.get(shape, 0) + amount

    while left.any():
        knapsack = Knapsack(weights, lengths, left, capacity)
        enough = NEAR * knapsack.value[capacity]
        moved = False
        for seed in np.flatnonzero(left)[::-1].tolist():
            if not left[seed]:
                continue
            config = knapsack.config(capacity - int(lengths[seed]))
            config[seed] = config.get(seed, 0) + 1
            if any(n > left[k] for k, n in config.items()):
                continue
            if sum(weights[k] * n for k, n in config.items()) < enough:
                continue
            use(config)
            moved = True
        if not moved:
            use(knapsack.config(capacity))
    return [(dict(shape), amount) for shape, amount in used.items()]


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit decreasing on counts: equal sequences are filled together, so the work depends on lengths, not pieces."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}  # room -> shape -> sequences
    rooms: list[int] = []

    def put(room: int, shape: tuple[int, ...], times: int) -> None:
        if room not in open_:
            open_[room] = {}
            insort(rooms, room)
        open_[room][shape] = open_[room].get(shape, 0) + times

    for k in np.flatnonzero(left)[::-1].tolist():
        length, many = int(lengths[k]), int(left[k])
        while many:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = min(capacity // length, many)
                put(capacity - each * length, (length,) * each, many // each)
                many -= many // each * each
                continue
            room = rooms[at]
            shape, times = next(iter(open_[room].items()))
            each = min(room // length, many)
            moved = min(times, many // each)
            if moved == times:
                del open_[room][shape]
            else:
                open_[room][shape] = times - moved
            if not open_[room]:
                del open_[room]
                del rooms[at]
            put(room - each * length, shape + (length,) * each, moved)
            many -= moved * each
    return [(list(shape), times) for group in open_.values() for shape, times in group.items()]


@dataclass
class Plan:
    """Configurations (lengths in falling order) and how often each is used; together they hold every piece. ``solved`` says
    whether those of pieces shorter than the capacity come from the program; if not, best fit needs fewer."""

    configs: list[tuple[list[int], int]]
    solved: bool = True

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.configs)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The program's sequences, or those of best fit should they be fewer."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    whole = [([capacity], int(n)) for k, n in zip(lengths, counts) if k == capacity and n]
    short = (lengths < capacity) & (counts > 0)
    lengths, counts = lengths[short], counts[short]
    solved = [
        ([int(lengths[k]) for k in sorted(config, reverse=True) for _ in range(config[k])], times)
        for config, times in program(lengths, counts, capacity)
    ]
    ways = [Plan(whole + solved), Plan(whole + _best_fit(lengths, counts, capacity), False)]
    return min(ways, key=lambda way: way.sequences)


def _runs(configs: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Runs of ranks within a length: from ``key`` (length and first rank) on, to the sequences from ``first`` on."""
    next_rank: dict[int, int] = {}
    keys, firsts, offsets = [], [], []
    sequence = 0
    for shape, times in configs:
        offset = 0
        for length in shape:
            rank = next_rank.get(length, 0)
            keys.append(length << 48 | rank), firsts.append(sequence), offsets.append(offset)
            next_rank[length] = rank + times
            offset += length
        sequence += times
    order = np.argsort(np.array(keys, np.int64))
    return {
        "key": np.array(keys, np.int64)[order], "first": np.array(firsts, np.int64)[order],
        "offset": np.array(offsets, np.int64)[order],
    }


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. They need ``id``, ``piece`` and ``length`` (1 to ``capacity``).

    Every piece has a place of its own, also repeated rows; sequences are filled from 0 without gaps.
    """
    spark = pieces.sparkSession
    pieces = common.staged(pieces, "packing-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    if min(histogram) < 1 or max(histogram) > capacity:
        raise ValueError("a length is not between 1 and the capacity")
    shared = spark.sparkContext.broadcast(_runs(plan(histogram, capacity).configs))
    # ranks within a length, in slices, since one length can have most of the pieces
    slices = common.width(spark)
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("id", "piece"), F.lit(slices)).cast("int"))
    counts = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "slice").orderBy("id", "piece")
    ranked = sliced.withColumn("own", F.row_number().over(inside) - 1).join(starts, ["length", "slice"])

    place_type = "struct<sequence_id:bigint,offset:bigint>"

    @F.pandas_udf(place_type)
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        runs = shared.value
        key = length.to_numpy(np.int64) << 48 | rank.to_numpy(np.int64)
        at = np.searchsorted(runs["key"], key, side="right") - 1
        return pd.DataFrame({"sequence_id": runs["first"][at] + key - runs["key"][at], "offset": runs["offset"][at]})

    placed = ranked.withColumn("place", place(F.col("length"), F.col("base") + F.col("own")))
    return placed.select(*pieces.columns, "place.sequence_id", "place.offset")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Documents as packed pieces, one row a piece: the id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one end token. Rows without an id are packed too; repeated rows take places of their own.
    """
    return pack(tokenize(docs, id_col, text_col, capacity), capacity).withColumnRenamed("id", id_col)


def op7_packing(spark, sf_dir) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack_documents(common.table(spark, sf_dir, "documents"))
