"""Delimited text files read once, all columns as text."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlens.functions.parsing import null_default_tokens

SEPARATORS = {".csv": ",", ".tsv": "\t", ".txt": "\t"}


def separator_for(path: str) -> str:
    """Comma for .csv, tab for .tsv and .txt, an error for anything else."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in SEPARATORS:
        raise ValueError(f"unsupported file type {suffix!r}: expected one of {', '.join(SEPARATORS)}")
    return SEPARATORS[suffix]


def repair_header(names: Sequence[str | None]) -> list[str]:
    """Unique column names: a blank becomes ``Unnamed: i``, a repeat gets the first number that no other column has.

    A name that the file itself gives to some column is never given away, so
    ``a, a, a.1`` becomes ``a, a.2, a.1``.
    """
    whole = [name if name else f"Unnamed: {i}" for i, name in enumerate(names)]
    reserved, repaired = set(whole), []
    for name in whole:
        final, number = name, 0
        while final in repaired or (number and final in reserved):
            number += 1
            final = f"{name}.{number}"
        repaired.append(final)
    return repaired


def duplicate_names(names: Sequence[str | None]) -> list[str]:
    """Header names that occur more than once, in order of first appearance."""
    named = [n for n in names if n]
    return [n for i, n in enumerate(named) if named.count(n) > 1 and named.index(n) == i]


def lines_with_open_quotes(spark: SparkSession, path: str) -> int:
    """Lines with an odd number of quotes: each breaks a field over lines, or holds a stray quote.

    A count other than zero says that ``multi_line`` is needed or that the file
    is broken. It is a pass of its own over the file, in splits.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(path).where(quotes % 2 == 1).count()


def header_of(spark: SparkSession, path: str, separator: str | None = None, multi_line: bool = False) -> list[str | None]:
    """The first record of the file as it stands."""
    first = (spark.read.option("sep", separator or separator_for(path)).option("escape", '"').option("multiLine", multi_line)
             .csv(path, header=False).first())
    return [] if first is None else list(first)


def read_delimited(spark: SparkSession, path: str, separator: str | None = None, multi_line: bool = False,
                   header: Sequence[str | None] | None = None) -> DataFrame:
    """Every column as text, with default null tokens nulled and the header repaired.

    Fields with line breaks need ``multi_line``, which reads each file in one
    task. ``header`` names the columns of files that have no header line. A record
    with more fields than the header ends the query that meets it; one with fewer
    is filled up with nulls.
    """
    separator = separator or separator_for(path)
    names = list(header) if header is not None else header_of(spark, path, separator, multi_line)
    if not names:
        raise ValueError(f"{path} holds no data")
    # Positional names while reading, so that names differing only by case cannot clash.
    positions = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(p, T.StringType()) for p in [*positions, "surplus"]])
    text = (spark.read.schema(schema).option("sep", separator).option("escape", '"')
            .option("multiLine", multi_line).option("enforceSchema", True).csv(path, header=header is None))
    if text.isEmpty():
        raise ValueError(f"{path} holds no rows")
    broken = F.raise_error(F.concat(F.lit(f"{path}: more than {len(names)} fields in the record that begins with "), F.coalesce("c0", F.lit(""))))
    whole = text.where(F.when(F.col("surplus").isNull(), True).otherwise(broken.cast("boolean")))
    nulled = whole.select(*[null_default_tokens(F.col(p)).alias(p) for p in positions])
    return nulled.toDF(*repair_header(names))
