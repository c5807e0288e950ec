"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

Only DataFrame functions: each pattern marks its matches in the text with a character that no pattern can match, the
text is split at the marks, and positions follow from the lengths of the parts. Positions are code points. Running sums
are taken chunk by chunk, so the work is in proportion to the text, however many matches it has.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: The mark, and what stands in for it where a text has it. Neither is in any pattern; both are one code point.
_MARK, _STAND_IN = "", ""

# The patterns. Each is written so that a scan is linear in the text and needs no recursion: runs are
# possessive, and a run is entered only at its start or where the last match ended.
_EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
#: A run of digits with single blanks or hyphens between them, entered at its first digit, of 12 to 19 digits in all.
_CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``hint``: a character that every match has. ``score`` before the context counts."""

    name: str
    pattern: str
    hint: str
    score: float
    words: tuple[str, ...]


KINDS = (
    Kind("email", _EMAIL, "@", 0.9, ("mail", "contact", "@")),
    Kind("ip", _IP, ".", 0.7, ("ip", "host", "server", "address")),
    Kind("card", _CARD, "", 0.8, ("card", "visa", "credit", "pay")),
    Kind("phone", _PHONE, "+", 0.7, ("phone", "call", "tel", "mobile")),
    Kind("iban", _IBAN, "", 0.9, ("iban", "bank", "account")),
    Kind("ssn", _SSN, "-", 0.3, ("ssn", "social security", "insurance number")),
)
BASE = ("email", "ip", "card", "phone")
CONTEXT_CHARS, CONTEXT_GAIN, MIN_SCORE = 40, 0.2, 0.5


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once; inside a lambda a plain expression is worked out at every use."""
    return F.transform(F.array(value), then)[0]


#: Rows of a chunk of a running sum, and characters of a block of text.
CHUNK, BLOCK = 64, 4096


def _running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What ``merge`` (of longs, with 0 as its start) makes of the elements before each one, for an array with elements.

    Appending to an array copies it, so that is done within chunks only, and for the chunks' own sums in the same way.
    """
    none = F.array().cast("array<bigint>")
    zero = F.lit(0).cast("bigint")

    def plain(part: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), none.alias("out"))
        return F.aggregate(
            part, start,
            lambda acc, v: F.struct(merge(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )

    def chunked(part: Column, above: Callable[[Column], Column]) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(part) - 1) / CHUNK).cast("int"))
        cut = F.transform(numbers, lambda i: F.slice(part, i * CHUNK + 1, F.lit(CHUNK)))
        return _let(cut, lambda chunks: F.flatten(
            F.zip_with(chunks, above(F.transform(chunks, lambda c: F.aggregate(c, zero, merge))), plain)
        ))

    return _let(values, lambda v: chunked(v, lambda sums: _let(sums, lambda t: chunked(t, lambda top: plain(top, zero)))))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of ``text`` pass the Luhn checksum."""

    def total(digits: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

        def add(total, place):
            digit = F.substring(digits, place, F.lit(1)).cast("int")
            twice = digit * 2
            worth = F.when(place % 2 == 1, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))
            return total + F.coalesce(worth, F.lit(0))

        return F.aggregate(places, F.lit(0), add)

    return _let(F.reverse(_digits(text)), total) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number passes mod 97: first four characters to the end, letters as 10 to 35, remainder 1."""
    plain = F.replace(text, F.lit(" "), F.lit(""))

    def rest(turned: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1)))

        def add(rest, place):
            code = F.ascii(F.substring(turned, place, F.lit(1)))
            letter = code >= 65
            return (F.when(letter, rest * 100 + code - 55).otherwise(rest * 10 + code - 48)) % 97

        return F.aggregate(places, F.lit(0), add)

    return _let(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), rest) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.split(match, r"\.")
        return F.forall(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _score(kind: Kind, before: Column, after: Column) -> Column:
    """The score of a confirmed span: more if one of the kind's words stands shortly before or after it. Context does not
    reach beyond the next match of the kind."""
    near = F.lower(F.concat(F.right(before, F.lit(CONTEXT_CHARS)), F.lit("\n"), F.left(after, F.lit(CONTEXT_CHARS))))

    def gain(near: Column) -> Column:
        hit = F.lit(False)
        for word in kind.words:
            hit = hit | F.contains(near, F.lit(word))
        return F.when(hit, CONTEXT_GAIN).otherwise(0.0)

    return F.lit(kind.score) + _let(near, gain)


SPAN = "struct<kind:string,start:bigint,stop:bigint,score:double>"


def _spans(kind: Kind, text: Column) -> Column:
    """Confirmed spans of one kind: the parts between the marks are gap, match, gap, match, ..., gap."""
    marked = F.regexp_replace(
        F.translate(text, _MARK, _STAND_IN), f"(?:{kind.pattern})", f"{_MARK}$0{_MARK}"
    )

    def placed(parts: Column, sizes: Column, starts: Column) -> Column:
        def span(i: Column) -> Column:
            start = starts[i]
            return F.struct(
                F.lit(kind.name).alias("kind"), start.alias("start"), (start + sizes[i]).alias("stop"),
                _score(kind, parts[i - 1], parts[i + 1]).alias("score"),
            )

        valid = F.filter(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), lambda i: _valid(kind.name, parts[i]))
        found = F.transform(valid, span)
        return found if kind.name in BASE else F.filter(found, lambda s: s["score"] >= MIN_SCORE)

    found = _let(F.split(marked, _MARK, -1), lambda parts: _let(
        F.transform(parts, lambda p: F.length(p).cast("bigint")), lambda sizes: _let(
            _running(sizes, lambda a, b: a + b), lambda starts: placed(parts, sizes, starts)
        )
    ))
    none = F.array().cast(f"array<{SPAN}>")
    possible = F.contains(text, F.lit(kind.hint)) if kind.hint else F.lit(True)
    return F.when(possible & text.rlike(kind.pattern), found).otherwise(none)


def find(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a column ``out``: an array of (kind, start, stop, score) by start, then kind in the listed order.

    The kinds in ``BASE`` are reported whenever their checks hold; the others (account numbers, social security
    numbers) need a score of at least ``MIN_SCORE``. Within a kind, matches are the leftmost ones that do not overlap;
    a match that fails its check is dropped and not tried again. Null and empty texts have no spans. One row out for
    each row in; a column named ``out`` is replaced.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = F.array(*[F.lit(k.name) for k in KINDS])

    def ranked(spans: Column) -> Column:
        placed = F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"),
            s["stop"].alias("stop"), s["kind"].alias("kind"), s["score"].alias("score"),
        )))
        back = F.transform(
            placed,
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["score"].alias("score")),
        )
        return F.when(F.size(spans) > 0, back).otherwise(spans)

    # text and spans are named once: a filter on the result would be pushed down with a copy of them for every use
    every = _let(text, lambda t: F.concat(*[_spans(kind, t) for kind in KINDS]))
    return docs.withColumn(out, _let(every, ranked))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in angle brackets; overlapping spans become one,
    named after the first. Other texts stay as they are, nulls included. Columns are kept."""
    out = "__pii"
    columns = common.columns_of(docs)
    text = F.col(text_col)

    def cut(blocks: Column, first: Column, stop: Column) -> Column:
        """The text from one place to another, out of blocks: finding a place in a long text would scan it anew."""

        def part(q: Column) -> Column:
            start = F.greatest(first - q * BLOCK, F.lit(0)).cast("int")
            return F.substring(blocks[q], start + 1, F.least(stop - q * BLOCK, F.lit(BLOCK)).cast("int") - start)

        last = F.floor((stop - 1) / BLOCK).cast("int")
        inside = F.transform(F.sequence(F.floor(first / BLOCK).cast("int"), last), part)
        return F.when(stop > first, F.array_join(inside, "")).otherwise(F.lit(""))

    def pieces(blocks: Column, spans: Column, ends: Column) -> Column:
        def piece(i: Column) -> Column:
            s = spans[i]
            fresh = s["start"] >= ends[i]  # the first of those that overlap
            return F.when(fresh, F.concat(cut(blocks, ends[i], s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(F.lit(""))

        tail = cut(blocks, F.array_max(F.transform(spans, lambda s: s["stop"])), F.length(text).cast("bigint"))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans) - 1), piece), ""), tail)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def ends(spans: Column) -> Column:
        return _running(F.transform(spans, lambda s: s["stop"]), lambda a, b: F.greatest(a, b))

    new = _let(F.col(out), lambda spans: _let(blocks, lambda b: _let(ends(spans), lambda e: pieces(b, spans, e))))
    rows = find(docs, text_col, out)
    return rows.withColumn(text_col, F.when(F.size(out) > 0, new).otherwise(text)).select(*columns)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def op6_pii(spark, sf_dir) -> DataFrame:
    """Personal data in every document: counts of the base kinds, a digest of their spans, all spans."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = find(docs)
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
    )
