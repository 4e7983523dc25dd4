"""The value-frequency table: one row per column position and distinct value.

Nearly every measure of a column follows from its distinct values and their
counts, so the source is read and shuffled once, after a map-side count, and
expensive text parsing runs once per distinct value instead of once per row.
All columns travel in one shape: whole numbers and times as eight bytes, doubles
as eight bytes, short text as text. Of a longer text its head, which sorts as the
text does, a digest and its measures travel; the text itself stays where it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.functions.parsing import (
    INFINITY_SHAPE, INTEGER_SHAPE, NUMBER_SHAPE, bare_number, bare_to_number, is_placeholder_norm, strip, stripped_to_date,
)

CARRIERS = {
    "bigint": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "double": (T.FloatType, T.DoubleType),
    "timestamp": (T.DateType, T.TimestampType, T.TimestampNTZType),
}
#: Characters of a text that travel; of a longer one they are its head.
HEAD = 64
#: Measures of one text, made of its columns ``text``, ``trimmed`` and ``bare``.
LONG = "struct<digest:binary,placeholder:boolean,x:double,ts:timestamp,n_chars:int,octets:int,edge:boolean,shape:int,norm:string>"
MEASURES = ("placeholder", "x", "ts", "n_chars", "octets", "edge", "shape", "norm")


def carrier_of(data_type: T.DataType) -> str:
    for carrier, types in CARRIERS.items():
        if isinstance(data_type, types):
            return carrier
    return "string"


def column_at(df: DataFrame, i: int) -> Column:
    """Column by position, safe for any name."""
    return F.col("`" + df.columns[i].replace("`", "``") + "`")


def digest(text: Column) -> Column:
    """128 bits of a SHA-256 digest."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def measures(text: Column, trimmed: Column, bare: Column) -> list[Column]:
    """MEASURES of a text that is given trimmed too, and without the marks of numbers.

    ``shape`` is 2 for a whole number, 1 for another plain number, else 0. ``norm``
    is the text without case and edge space, or the digest of a long one.
    Placeholders are never parsed.
    """
    small = F.lower(trimmed)
    blank = is_placeholder_norm(small)
    shape = F.when(trimmed.rlike(INTEGER_SHAPE), 2).when(trimmed.rlike(NUMBER_SHAPE) | trimmed.rlike(INFINITY_SHAPE), 1).otherwise(0)
    norm = F.when(F.length(trimmed) > HEAD, F.sha2(small, 256)).otherwise(small)
    made = (blank, F.when(~blank, bare_to_number(bare)), F.when(~blank, stripped_to_date(trimmed)), F.length(text), F.octet_length(text),
            text != trimmed, shape, norm)
    return [c.alias(name) for c, name in zip(made, MEASURES)]


def _cells(df: DataFrame, first: int) -> DataFrame:
    """(position, whole, real, head, long) of every cell, in one pass over ``df``.

    Cells are lined up first and measured after, so that the measures are in the
    plan once and not once for each column.
    """
    carriers = [carrier_of(f.dataType) for f in df.schema.fields]
    own = [column_at(df, i).cast(c).alias(f"c{i}") for i, c in enumerate(carriers)]
    none = F.lit(None)
    cells: list[Column] = []
    for i, carrier in enumerate(carriers):
        c = F.col(f"c{i}")
        # One type for all columns, whatever the optimizer learns about nulls in one of them.
        whole = c if carrier == "bigint" else F.unix_micros(c) if carrier == "timestamp" else none
        cells += [F.lit(first + i), whole.cast("bigint"), (F.when(~F.isnan(c), c) if carrier == "double" else none).cast("double"),
                  (c if carrier == "string" else none).cast("string")]
    rows = df.select(*own).select(F.stack(F.lit(len(carriers)), *cells).alias("position", "whole", "real", "text"))
    text, long = F.col("text"), (F.octet_length("text") > HEAD) & (F.length("text") > HEAD)
    # Steps of their own, so that a text is trimmed once; short texts are taken apart after counting.
    rows = rows.withColumn("trimmed", F.when(long, strip(text))).withColumn("bare", bare_number(F.col("trimmed")))
    found = F.when(long, F.struct(digest(text).alias("digest"), *measures(text, F.col("trimmed"), F.col("bare")))).cast(LONG)
    return rows.select("position", "whole", "real", F.when(long, F.substring(text, 1, HEAD)).otherwise(text).alias("head"), found.alias("long"))


def value_frequencies(df: DataFrame, first: int = 0) -> DataFrame:
    """(position, value, digest, n) and the MEASURES of each distinct value; positions count from ``first``.

    A null value row holds the count of nulls. Where there is a ``digest``,
    ``value`` is the head of a longer text. Placeholders keep their text but are
    never parsed.
    """
    counted = _cells(df, first).groupBy("position", "whole", "real", "head", "long").agg(F.count("*").alias("n"))
    kinds: dict[str, list[int]] = {}
    for i, field in enumerate(df.schema.fields):
        kinds.setdefault(carrier_of(field.dataType), []).append(first + i)

    def at(carrier: str) -> Column:
        return F.col("position").isin(kinds.get(carrier, []))

    moment = F.when(at("timestamp"), F.timestamp_micros("whole"))
    value = F.coalesce("head", moment.cast("string"), F.col("whole").cast("string"), F.col("real").cast("string"))
    short = F.col("long").isNull()
    parted = counted.withColumns({"value": value, "moment": moment, "text": F.when(at("string") & short, F.col("head"))})
    parted = parted.withColumn("trimmed", strip(F.col("text"))).withColumn("bare", bare_number(F.col("trimmed")))
    own = parted.select("position", "value", "n", "whole", "real", "moment", "long", "text", *measures(F.col("text"), F.col("trimmed"), F.col("bare")))
    typed = {"x": F.when(at("bigint"), F.col("whole").cast("double")).otherwise(F.col("real")), "ts": F.col("moment"), "placeholder": F.lit(False),
             "n_chars": F.length("value"), "octets": F.octet_length("value"), "edge": F.lit(False), "shape": F.lit(0), "norm": F.lower("value")}
    return own.select("position", "value", F.col("long.digest").alias("digest"), "n", *[
        F.when(F.col("long").isNotNull(), F.col(f"long.{m}")).when(F.col("text").isNotNull(), F.col(m)).otherwise(typed[m]).alias(m) for m in MEASURES])


def whole_texts(df: DataFrame, wanted: DataFrame, first: int = 0) -> DataFrame:
    """(position, digest, whole) of the longer texts of ``df`` that ``wanted`` (position, digest) asks for, each once."""
    texts = [i for i, f in enumerate(df.schema.fields) if carrier_of(f.dataType) == "string"]
    cells = [x for i in texts for x in (F.lit(first + i), F.when(F.length(column_at(df, i).cast("string")) > HEAD, column_at(df, i).cast("string")))]
    long = df.select(F.stack(F.lit(len(texts)), *cells).alias("position", "whole")).filter("whole is not null")
    return (long.withColumn("digest", digest(F.col("whole"))).join(wanted, ["position", "digest"], "left_semi")
            .groupBy("position", "digest").agg(F.first("whole").alias("whole")))
