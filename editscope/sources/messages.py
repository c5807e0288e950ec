"""A message log in files, as a streaming source with positions, limits and recovery: the edit topic without a broker.

A log is a folder with one folder for each partition. A partition holds segments, text files with one message a line,
read in the order of their names. Names ascend; only the last segment of a partition may still grow, and what follows its
last line end is not read yet. Names that begin with ``_`` or ``.`` are no segments. A segment may be removed once the
position is in a later one.

The position of a query is one (segment, byte) pair for each partition, so it grows with partitions, not with files. A
micro-batch takes at most ``max_bytes``, dealt to the partitions in equal parts, what some do not need going to the
others; only a message longer than that by itself exceeds it, and is a batch of its own. Tasks read pieces of
``split_bytes``, so a partition with most of the messages is spread over many tasks.
"""

from __future__ import annotations

import bisect
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .feed import MAX_BYTES_PER_TRIGGER

FORMAT = "message_log"
COLUMNS = "value string, partition string, segment string, offset long"
SPLIT_BYTES = 64 << 20
BATCH_ROWS = 4096
BLOCK = 1 << 16


def stream_messages(
    spark: SparkSession, path: str, cursor: str, max_bytes: int = MAX_BYTES_PER_TRIGGER, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """The messages of the log at ``path``: ``value`` (bytes that are no UTF-8 are replaced), and where it was read.

    ``cursor`` is a folder for this query alone, kept as long as its checkpoint: it holds what was handed out last, which
    Spark does not tell a source when a query starts again, and without which the first batch would have no bound.
    """
    spark.dataSource.register(MessageLog)
    options = {"path": path, "cursor": cursor, "maxBytes": str(max_bytes), "splitBytes": str(split_bytes)}
    return spark.readStream.format(FORMAT).options(**options).load()


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS

    def streamReader(self, schema) -> MessageReader:
        return MessageReader(
            self.options["path"], self.options["cursor"], int(self.options["maxBytes"]), int(self.options["splitBytes"])
        )


@dataclass
class Piece(InputPartition):
    """Messages of a segment that begin in [``low``, ``high``); ``first`` if a message begins at ``low`` for certain."""

    partition: str
    segment: str
    low: int
    high: int
    first: bool


class MessageReader(DataSourceStreamReader):
    def __init__(self, path: str, cursor: str, max_bytes: int, split_bytes: int):
        if max_bytes < 1 or split_bytes < 1:
            raise ValueError("maxBytes and splitBytes must be positive")
        self.path, self.cursor = path.rstrip("/"), cursor.rstrip("/")
        self.max_bytes, self.split_bytes = max_bytes, split_bytes

    # ---- positions, on the driver ------------------------------------------------------------

    def initialOffset(self) -> dict:
        """Asked for by new queries only. An older cursor would belong to another checkpoint."""
        self._keep("handed", {})
        self._keep("planned", {})
        return {}

    def latestOffset(self) -> dict:
        """One batch beyond what was handed out last. What was handed out but never planned, because the query stopped in
        between, is handed out again, so that two parts do not become one batch."""
        handed = self._kept("handed")
        if handed != self._kept("planned"):
            return handed
        ahead = self._ahead(handed)
        if ahead != handed:
            self._keep("handed", ahead)
        return ahead

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        """A batch that is repeated after a stop comes with its old bounds, so it has the same messages."""
        if end != self._kept("planned"):
            self._keep("handed", end)
            self._keep("planned", end)
        pieces = []
        for partition in sorted(end):
            segment, high = end[partition]
            old, low = start.get(partition, ("", 0))
            for name, size in self._segments(partition, old, start.get(partition)):
                if name > segment:
                    break
                a, b = low if name == old else 0, high if name == segment else size
                for cut in range(a, b, self.split_bytes):
                    pieces.append(Piece(partition, name, cut, min(b, cut + self.split_bytes), cut == a))
        return pieces

    def _ahead(self, position: dict) -> dict:
        system, root = files.FileSystem.from_uri(self.path)
        names = sorted(
            f.base_name for f in system.get_file_info(files.FileSelector(root, allow_not_found=True))
            if f.type == files.FileType.Directory and f.base_name[:1] not in "_."
        )
        waiting = {}
        for partition in names:
            old, low = position.get(partition, ("", 0))
            segments = self._segments(partition, old, position.get(partition))
            if segments:
                name, size = segments[-1]
                segments[-1] = name, self._line_end(partition, name, low if name == old else 0, size)
            left = [(name, low if name == old else 0, size) for name, size in segments]
            waiting[partition] = left, sum(b - a for _, a, b in left)
        waiting = {p: found for p, found in waiting.items() if found[1]}
        ahead, stuck = self._dealt(waiting, self.max_bytes)
        if stuck:  # the fullest of them goes first, so that its message does not wait for as long as others have some
            partition = max(stuck, key=lambda p: (waiting[p][1], p))
            name, low, high = next(part for part in waiting[partition][0] if part[2] > part[1])
            end = min(high, self._next_end(partition, name, low))
            others = {p: found for p, found in waiting.items() if p != partition}
            ahead, _ = self._dealt(others, self.max_bytes - (end - low))
            ahead[partition] = [name, end]
        return dict(sorted({**position, **ahead}.items()))

    def _dealt(self, waiting: dict, budget: int) -> tuple[dict, list]:
        """Positions after at most ``budget`` bytes, and the partitions whose part holds no message. Partitions with little
        left come first and leave the rest of their equal parts to the others."""
        ahead, stuck = {}, []
        order = sorted(waiting, key=lambda p: (waiting[p][1], p))
        for k, partition in enumerate(order):
            left, n = waiting[partition]
            at, taken = self._advanced(partition, left, min(n, max(0, budget) // (len(order) - k)))
            budget -= taken
            if taken:
                ahead[partition] = at
            else:
                stuck.append(partition)
        return ahead, stuck

    def _advanced(self, partition: str, left: list[tuple[str, int, int]], share: int) -> tuple[list | None, int]:
        """The last message end within ``share`` bytes, and the bytes up to there."""
        done, at = 0, None
        for name, low, high in left:
            if done + high - low > share:
                end = self._line_end(partition, name, low, low + share - done)
                return ([name, end], done + end - low) if end > low else (at, done)
            done, at = done + high - low, [name, high]
        return at, done

    def _segments(self, partition: str, since: str, known) -> list[tuple[str, int]]:
        """(name, size) of the segments from ``since`` on."""
        system, root = files.FileSystem.from_uri(f"{self.path}/{partition}")
        found = sorted(
            (f.base_name, f.size) for f in system.get_file_info(files.FileSelector(root))
            if f.type == files.FileType.File and f.base_name[:1] not in "_."
        )
        names = [name for name, _ in found]
        first = bisect.bisect_left(names, since)
        if known is not None and (first == len(names) or names[first] != since):
            raise FileNotFoundError(f"segment {since} of partition {partition} is gone before it was left behind")
        return found[first:]

    def _line_end(self, partition: str, segment: str, low: int, high: int) -> int:
        """The place after the last line end in [``low``, ``high``), or ``low``."""
        with _opened(f"{self.path}/{partition}/{segment}") as stream:
            while high > low:
                start = max(low, high - BLOCK)
                stream.seek(start)
                at = stream.read(high - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                high = start
        return low

    def _next_end(self, partition: str, segment: str, low: int) -> int:
        with _opened(f"{self.path}/{partition}/{segment}") as stream:
            stream.seek(low)
            while block := stream.read(BLOCK):
                at = block.find(b"\n")
                if at >= 0:
                    return low + at + 1
                low += len(block)
        return low

    def _kept(self, name: str) -> dict:
        system, root = files.FileSystem.from_uri(self.cursor)
        if system.get_file_info(f"{root}/{name}").type == files.FileType.NotFound:
            return {}
        with system.open_input_stream(f"{root}/{name}") as stream:
            return json.loads(stream.read())

    def _keep(self, name: str, position: dict) -> None:
        system, root = files.FileSystem.from_uri(self.cursor)
        system.create_dir(root)
        with system.open_output_stream(f"{root}/_{name}") as stream:
            stream.write(json.dumps(position).encode())
        system.move(f"{root}/_{name}", f"{root}/{name}")  # a reader finds the old position or the new one

    # ---- messages, in tasks ------------------------------------------------------------------

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        piece = partition
        with _opened(f"{self.path}/{piece.partition}/{piece.segment}") as stream:
            at = piece.low
            if piece.first:
                stream.seek(at)
            else:  # the message that runs into this piece belongs to the one before
                stream.seek(at - 1)
                at += len(stream.readline()) - 1
            values, places = [], []
            while at < piece.high:
                line = stream.readline()
                if not line:
                    break
                values.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                places.append(at)
                at += len(line)
                if len(values) == BATCH_ROWS:
                    yield _batch(piece, values, places)
                    values, places = [], []
            if values:
                yield _batch(piece, values, places)


def _opened(path: str) -> io.BufferedReader:
    system, place = files.FileSystem.from_uri(path)
    return io.BufferedReader(system.open_input_file(place), BLOCK)


def _batch(piece: Piece, values: list[str], places: list[int]) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, pa.string()), pa.array([piece.partition] * n), pa.array([piece.segment] * n), pa.array(places, pa.int64())],
        names=["value", "partition", "segment", "offset"],
    )
