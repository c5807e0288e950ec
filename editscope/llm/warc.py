"""Web archives: records written and read back in parallel, and a capture index by external merge.

An archive is a folder of gzip files of WARC records, written with Spark's text writer: a record is header lines, an empty
line and the payload, and the writer's line separator is the two line breaks that end a record. So files are committed
by Spark, and a lost executor leaves none half written. Each file is read back by its content lengths; payload digests
are taken again from the bytes read.

Equal payloads of at least ``SMALLEST`` bytes are stored once, the others as revisits of it.

The index: each archive file gives a run of captures sorted by URL key, time and page, kept in files; runs are cut into
ranges of that order by a shuffle, and a range merges its parts of all runs with a loser tree. Nothing is sorted twice:
parts arrive one after the other, and a new one begins where the order falls back.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SMALLEST = 1000
FILE_BYTES = 8 << 20
RANGE_ROWS = 50_000
#: Pages have no time of capture; theirs counts seconds from here by page_id, within the years 1 to 9999.
EPOCH = 1_704_067_200
FIRST_ID, LAST_ID = -62_135_596_800 - EPOCH, 253_402_300_799 - EPOCH
CRLF = "\r\n"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels from the last to the first, comma-joined, then ``)`` and path and query; lower case,
    without scheme, ``www.``, port, user and fragment. A null URL has the empty key."""
    plain = F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"^[a-z][a-z0-9+.-]*://", "")
    plain = F.regexp_replace(plain, r"#.*$", "")
    host = F.regexp_replace(F.regexp_extract(plain, r"^([^/?]*)", 1), r"^([^@]*@)?(www\.)?|:[0-9]*$", "")
    rest = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*(.*)$", 1), r"^$", "/")
    return F.when(plain == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    )


def _one_line(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1f\x7f]", "%20")


def records(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """One record (page_id, revisit, record) for each page: the record text without the two line breaks at its end.

    Of equal payloads of at least ``smallest`` bytes, the rows of the largest page_id are responses and the others
    revisits that name it; smaller payloads and rows without a page_id are responses. A null html is an empty payload.
    Ids whose time would lie before year 1 or after 9999 have the first or last second of those years.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"))
    named = pages.select("page_id", F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"))
    first = (
        named.filter((F.col("size") >= smallest) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.max("page_id").alias("kept"), F.min("page_id").alias("least"))
        .filter("kept != least").select("digest", "kept")
    )
    first = common.staged(first, "warc-first")
    marked = rows.join(first, "digest", "left")
    revisit = F.coalesce((F.col("size") >= smallest) & (F.col("page_id") != F.col("kept")), F.lit(False))
    near = F.least(F.greatest(F.coalesce("page_id", F.lit(0)).cast("long"), F.lit(FIRST_ID)), F.lit(LAST_ID))
    stamp = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + near), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    none = F.lit(None).cast("string")
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.when(F.col("page_id").isNotNull(), F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), _one_line(F.col("url")))),
        F.concat(F.lit("WARC-Date: "), stamp),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("kept").cast("string"), F.lit(">"))).otherwise(none),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")).otherwise(none),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
    )
    body = F.when(revisit, "").otherwise(F.col("html"))
    return marked.select("page_id", revisit.alias("revisit"), F.concat(head, F.lit(CRLF * 2), body).alias("record"))


def write_archives(pages: DataFrame, path: str, smallest: int = SMALLEST, file_bytes: int = FILE_BYTES) -> None:
    """Records of all pages as gzip files of about ``file_bytes`` bytes of records under ``path``."""
    total = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long") + 400)).first()[0] or 0
    files = max(1, -(-int(total) // file_bytes))
    out = records(pages, smallest).select(F.col("record").alias("value")).repartition(files)
    out.write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


_LINE = re.compile(rb"([^:\r\n]+):[ ]*([^\r\n]*)")


def _parse(data: bytes) -> Iterator[dict]:
    """Records of an unpacked archive: header fields, offset, payload."""
    at, end = 0, len(data)
    while at < end:
        stop = data.index(b"\r\n\r\n", at)
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        head = {a.strip().lower(): b for a, b in _LINE.findall(data[at:stop])}
        start = stop + 4
        size = int(head[b"content-length"])
        yield {"head": head, "offset": at, "payload": data[start : start + size]}
        if data[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        at = start + size + 4


CAPTURE = (
    "file string, offset long, page_id long, url string, captured string, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)


def read_archives(spark, path: str, payloads: bool = True) -> DataFrame:
    """Records of all files under ``path``, with the digest and length of the payload as read; for a revisit, those
    of its header. ``payloads=False`` leaves the payload column null."""
    common.small_batches(spark)

    def number(value: bytes | None) -> int | None:
        return int(value.rstrip(b">").rpartition(b":")[2]) if value else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([
            ("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("captured", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for record in _parse(zlib.decompress(content.as_buffer(), wbits=47)):
                    head, payload = record["head"], record["payload"]
                    revisit = head[b"warc-type"] == b"revisit"
                    digest = head[b"warc-payload-digest"].rpartition(b":")[2].decode()
                    size = int(head[b"x-payload-length"])
                    if not revisit:
                        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    url = head.get(b"warc-target-uri")
                    rows.append({
                        "file": name.rpartition("/")[2], "offset": record["offset"], "page_id": number(head.get(b"warc-record-id")),
                        "url": None if url is None else url.decode("utf-8", "replace"), "captured": head[b"warc-date"].decode(),
                        "record_type": "revisit" if revisit else "response", "refers_to": number(head.get(b"warc-refers-to")),
                        "payload_digest": digest, "payload_bytes": size, "payload": payload if payloads else None,
                    })
                    if len(rows) >= common.BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    # one file to a batch: a file is unpacked as a whole
    return files.mapInArrow(_single(read), CAPTURE)


def _single(read):
    def each(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield from read([batch.slice(k, 1)])

    return each


class LoserTree:
    """Merges sorted iterators: inner nodes hold the loser of their match, so a new item replays one path to the top."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        self.losers = [-1] * max(1, len(runs))
        self.top = -1
        for k in range(len(runs)):
            self._replay(k, building=True)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def _replay(self, k: int, building: bool = False) -> None:
        node = (k + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0 and building:
                self.losers[node] = k
                return
            if other >= 0 and self._less(other, k):
                self.losers[node], k = k, other
            node //= 2
        self.top = k

    def __iter__(self):
        while self.runs and self.heads[self.top] is not None:
            k = self.top
            yield self.heads[k]
            self.heads[k] = next(self.runs[k], None)
            self._replay(k)


KEY = ["url_key", "captured", "page_id", "file", "offset"]


def capture_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in the global order of URL key, time, page: ``captures`` with ``url_key``, ``part`` (of the order) and
    ``position`` (in the part).

    Runs, one for each ``file``, are sorted where they are and written. A range of the order then merges its parts of
    the runs, in whatever order these come in; rows of one part that came apart would be several parts and change nothing.
    Ranges follow the whole sort key, which no two captures share, so captures of one URL can lie in several.
    """
    spark = captures.sparkSession
    common.small_batches(spark)
    columns = [c for c in captures.columns if c not in ("url_key", "part", "position")]
    keyed = captures.select(
        url_key(F.col("url")).alias("url_key"), *[F.col(c) for c in columns]
    )
    # a task holds whole files, so its rows sorted by file and key are sorted runs
    runs = common.staged(keyed.sortWithinPartitions("file", *[F.col(k).asc_nulls_first() for k in KEY[:3]], "offset"), "warc-runs")
    ranges = max(common.width(spark), -(-runs.count() // range_rows))
    order = [F.col(k).asc_nulls_first() for k in KEY]
    dealt = runs.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # one range: about range_rows rows
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        columns = [rows.column(name).to_pylist() for name in KEY]
        columns[2] = [(p is not None, p or 0) for p in columns[2]]
        keys = list(zip(*columns, range(rows.num_rows)))
        edges = [0, *[k for k in range(1, len(keys)) if keys[k] < keys[k - 1]], len(keys)]
        merged = [key[-1] for key in LoserTree([iter(keys[a:b]) for a, b in zip(edges, edges[1:])])]
        out = rows.take(pa.array(merged, pa.int64()))
        out = out.append_column("position", pa.array(range(len(merged)), pa.int64()))
        yield from out.to_batches(max_chunksize=10_000)

    schema = T.StructType([*dealt.schema.fields, T.StructField("position", T.LongType())])
    return common.staged(dealt.mapInArrow(merge, schema), "warc-index")


def histories(index: DataFrame) -> DataFrame:
    """The index with ``capture_no``, from 1 in order of time for each URL key: positions less those of earlier
    captures. Counts of a key come from its parts, so a key of many captures is not gathered."""
    spots = index.groupBy("url_key", "part").agg(F.min("position").alias("low"), F.count("*").alias("n"))
    before = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spots = spots.select("url_key", "part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    spots = common.staged(spots, "warc-spots")
    return index.join(spots, ["url_key", "part"]).withColumn(
        "capture_no", F.col("earlier") + F.col("position") - F.col("low") + 1
    ).drop("low", "earlier")


def op5_warc(spark, sf_dir) -> DataFrame:
    """Every page written to an archive, read back, and put in its place in the capture histories."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = common.scratch_path(spark, "warc")
    write_archives(pages, path)
    captures = read_archives(spark, path, payloads=False).drop("payload")
    return histories(capture_index(captures)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "capture_no"
    )


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, lower(trim(coalesce(url, ''))) AS url FROM pages
), d AS (
  SELECT page_id, html, sha1(html) AS digest, CAST(strlen(html) AS BIGINT) AS size,
    regexp_replace(regexp_replace(url, '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '') AS plain FROM p
), k AS (
  SELECT *, max(CASE WHEN size >= 1000 THEN page_id END) OVER (PARTITION BY digest) AS kept,
    regexp_replace(regexp_extract(plain, '^([^/?]*)', 1), '^([^@]*@)?(www\.)?|:[0-9]*$', '', 'g') AS host,
    regexp_replace(regexp_extract(plain, '^[^/?]*(.*)$', 1), '^$', '/') AS rest FROM d
), u AS (
  SELECT *, CASE WHEN plain = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest END AS url_key,
    strftime(to_timestamp(1704067200 + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured FROM k
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN size >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND page_id <> kept THEN kept END AS refers_to, url_key, captured,
  row_number() OVER (PARTITION BY url_key ORDER BY captured, page_id) AS capture_no
FROM u
"""
