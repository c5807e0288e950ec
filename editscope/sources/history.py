"""Result histories as CSV: options that round-trip, readers, and the validity filter."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Quotes are doubled on both sides and blanks are kept. The bare texts NA and null are text; an
# unquoted empty field is null, a quoted one is the empty string (the reader needs a null mark
# that is not the empty string to tell them apart). Lines are records, so that large files stay
# splittable; line breaks inside a text are written as \n and \r (``pack_breaks``).
_COMMON = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_WRITE = {**_COMMON, "nullValue": "", "emptyValue": '""'}
CSV_READ = {**_COMMON, "nullValue": "\u0000", "emptyValue": "", "mode": "PERMISSIVE"}


def pack_breaks(value: Column) -> Column:
    """Text on one line: a break is a backslash and n or r. Backslashes right before a break or
    one of these letters are doubled, so that they are told apart."""
    doubled = F.regexp_replace(value, r"\\(?=\\*[nr\n\r])", r"\\\\")
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unpack_breaks(value: Column) -> Column:
    """What ``pack_breaks`` was given: an odd number of backslashes before the letter is a break."""
    lines = F.regexp_replace(value, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    lines = F.regexp_replace(lines, r"(?<!\\)((?:\\\\)*)\\r", "$1\r")
    return F.regexp_replace(lines, r"\\\\(?=(?:\\\\)*[nr\n\r])", r"\\")


def _each_text(rows: DataFrame, change) -> DataFrame:
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    return rows.withColumns({name: change(F.col(name)) for name in texts})


def packed(rows: DataFrame) -> DataFrame:
    """Rows whose texts fit CSV lines."""
    return _each_text(rows, pack_breaks)


def valid_times(rows: DataFrame, *bounds: str) -> DataFrame:
    """Parse the text bounds; rows where one of ``bounds`` is not a time are dropped."""
    parsed = rows
    for name in ("start_time", "end_time"):
        parsed = parsed.withColumn(name, F.try_to_timestamp(F.col(name)))
    for name in bounds or ("start_time",):
        parsed = parsed.filter(F.col(name).isNotNull())
    return parsed


def read_history(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    *bounds: str,
    escape: str = '"',
    skip_corrupt: bool = False,
) -> DataFrame:
    """All result files of folders or patterns as one table. A path that does not exist yet has
    no rows; the others are read all the same. A file that cannot be read is an error unless
    ``skip_corrupt``.
    ``batch_id`` comes from the files or, for the folders of a sink, from their names.

    ``bounds`` names the times a row must have: both for edit wars, the start otherwise. Files
    written with Spark's own CSV defaults quote with a backslash and need ``escape="\\"``; the
    line breaks that sinks pack are unpacked in files that double their quotes.
    """
    options = {**CSV_READ, "header": "true", "escape": escape, "ignoreCorruptFiles": str(skip_corrupt).lower()}
    parts = []
    for one in [path] if isinstance(path, str) else path:
        try:
            parts.append(spark.read.schema(schema).options(**options).csv(one))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    if not parts:
        return valid_times(spark.createDataFrame([], schema), *bounds)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return valid_times(_each_text(rows, unpack_breaks) if escape == '"' else rows, *bounds)


def to_csv_line(*columns: str) -> Column:
    """The columns as one CSV line."""
    return F.to_csv(F.struct(*columns), CSV_WRITE)


def parse_csv_lines(lines: DataFrame, schema: str, *bounds: str) -> DataFrame:
    """The history held in the text column ``value``, one CSV line per row, no header."""
    rows = lines.select(F.inline(F.array(F.from_csv("value", schema, CSV_READ))))
    return valid_times(rows, *bounds)
