"""IP literals as JVM expressions: validation and a sortable 128-bit form.

No Python worker is involved, so the checks stay inside code generation and can sit in a
filter over the whole edit table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _col

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_QUAD = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_GROUP = "[0-9a-fA-F]{1,4}"
_GROUPS = f"{_GROUP}(?::{_GROUP})*"


def is_ipv4(c: Column | str) -> Column:
    """Four decimal octets in range, no leading zeros. Null gives false."""
    return F.coalesce(_col(c).rlike(rf"^{_QUAD}\z"), F.lit(False))


def _v6_groups_text(c: Column) -> Column:
    """The address without its zone, a trailing dotted quad turned into two groups."""
    address = F.substring_index(c, "%", 1)
    quad = F.regexp_extract(address, rf":({_QUAD})\z", 1)
    octets = F.split(quad, r"\.")
    as_groups = F.format_string(
        "%02x%02x:%02x%02x", *[F.try_element_at(octets, F.lit(i)).try_cast("int") for i in (1, 2, 3, 4)]
    )
    head = F.substr(address, F.lit(1), F.length(address) - F.length(quad))
    return F.when(quad != "", F.concat(head, as_groups)).otherwise(address)


def _is_v6(text: Column, groups: Column) -> Column:
    zone_ok = ~text.contains("%") | text.rlike(r"^[^%/]*%[^%/]+\z")
    full = groups.rlike(rf"^{_GROUP}(?::{_GROUP}){{7}}\z")
    short = groups.rlike(rf"^(?:{_GROUPS})?::(?:{_GROUPS})?\z") & (
        F.size(F.filter(F.split(groups, ":"), lambda g: g != "")) <= 7
    )
    return F.coalesce(text.contains(":") & zone_ok & (full | short), F.lit(False))


def is_ipv6(c: Column | str) -> Column:
    """Eight groups, or fewer with one ``::``; an optional zone after ``%``. Null gives false.

    Everything behind the test for a colon is skipped for texts without one.
    """
    return _is_v6(_col(c), _v6_groups_text(_col(c)))


def is_ip(c: Column | str) -> Column:
    """True for a valid IPv4 or IPv6 literal."""
    return is_ipv4(c) | is_ipv6(c)


def looks_like_ip(c: Column | str) -> Column:
    """Cheap superset of ``is_ip``: digits and dots only, or any text with a colon."""
    return F.coalesce(_col(c).rlike(r"^[0-9.]+\z") | _col(c).contains(":"), F.lit(False))


def with_ip_number(rows: DataFrame, column: str) -> DataFrame:
    """Add ``family`` (4, 6, or null when the text is no address) and the address as two signed
    bigints: ``high``, its first 64 bits, and ``low``, the rest. An IPv4 address fills the top
    32 bits of ``high``. Done in steps, so that each part is computed once.
    """
    text = F.col(column)
    octets, groups = F.col("_octets"), F.col("_groups")
    v4 = F.lit(0).cast("bigint")
    for i in (1, 2, 3, 4):
        v4 = v4 * 256 + F.try_element_at(octets, F.lit(i)).try_cast("bigint")

    def filled(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda g: g != "")

    def half(start: int) -> Column:
        return F.conv(F.substring("_digits", start, 16), 16, -10).try_cast("bigint")

    gap = F.greatest(F.lit(8) - F.size("_left") - F.size("_right"), F.lit(0))
    padded = F.concat("_left", F.array_repeat(F.lit("0"), gap), "_right")
    zero = F.lit(0).cast("bigint")
    return (
        rows.withColumn("_groups", F.when(text.contains(":"), _v6_groups_text(text)))
        .withColumn("family", F.when(is_ipv4(text), 4).when(_is_v6(text, groups), 6))
        .withColumns(
            {
                "_octets": F.when(F.col("family") == 4, F.split(text, r"\.")),
                "_left": filled(F.substring_index(groups, "::", 1)),
                "_right": F.when(
                    groups.contains("::"), filled(F.substring_index(groups, "::", -1))
                ).otherwise(F.array().cast("array<string>")),
            }
        )
        .withColumn("_digits", F.array_join(F.transform(padded, lambda g: F.lpad(g, 4, "0")), ""))
        .withColumns(
            {
                "high": F.when(F.col("family") == 4, F.shiftleft(v4, 32)).when(F.col("family") == 6, half(1)),
                "low": F.when(F.col("family") == 4, zero).when(F.col("family") == 6, half(17)),
            }
        )
        .drop("_groups", "_octets", "_left", "_right", "_digits")
    )


def prefix_high(high: Column, prefix_len: Column) -> Column:
    """The network part of the first 64 bits."""
    ones = F.lit(-1).cast("bigint")
    mask = F.when(prefix_len <= 0, F.lit(0).cast("bigint")).when(
        prefix_len >= 64, ones
    ).otherwise(F.call_function("shiftleft", ones, F.lit(64) - prefix_len))
    return high.bitwiseAND(mask)


def prefix_low(low: Column, prefix_len: Column) -> Column:
    """The network part of the last 64 bits."""
    ones = F.lit(-1).cast("bigint")
    mask = F.when(prefix_len <= 64, F.lit(0).cast("bigint")).when(
        prefix_len >= 128, ones
    ).otherwise(F.call_function("shiftleft", ones, F.lit(128) - prefix_len))
    return low.bitwiseAND(mask)
