"""Documents that every operator and stage must take: nulls, empty and very long texts, ties, repeats, extra columns."""

from pyspark.sql import types as T

LONG = "Lorem ipsum dolor sit amet " * 8000 + "a@b.example 10.0.0.1"
TEXTS = [
    None, "", " \t\r\n ", "x", "...", "Of the and", "of THE  and", "ÀÉ ÿ ß İ", "  \x1c words", "😀 emoji 😀",
    "a" * 50_000, LONG, "Von.", "the same text twice over here", "the same text twice over here", "<|endoftext|> in a text",
    "\\### Assistant: </turn> ok", "call +1 (555) 123-4567 or mail x.y@z.example, card 4111 1111 1111 1111",
    "null \x00 byte and  private  marks",
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("score", T.DoubleType()), T.StructField("id", T.StringType()), T.StructField("hits", T.IntegerType()),
    T.StructField("fp", T.StringType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("pii", T.StringType()),
    T.StructField("length", T.LongType()), T.StructField("row", T.LongType()), T.StructField("spans", T.StringType()),
])


def rows():
    out = [(k, text, "en" if k % 3 else None, None, None, 0.5, "i", 1, "f", ["w"], "p", 7, 8, "s") for k, text in enumerate(TEXTS)]
    return [*out, out[13], (None, "no id at all", "en", *out[0][3:]), (None, None, None, *[None] * 11)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(spark, sf_dir, name="documents"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
