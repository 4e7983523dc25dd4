"""Whole-table measures: shape, duplicate rows, identical columns, header problems."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.expressions import pct
from ledgerlens.functions.parsing import is_placeholder
from ledgerlens.operators.profile.frequency import carrier_of, column_at, digest
from ledgerlens.session import materialize


def positional(df: DataFrame) -> DataFrame:
    """The same rows under names c0, c1, ... so that any header is safe in expressions."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def digested(rows: DataFrame) -> DataFrame:
    """Adds a 128-bit digest of the whole row, nulls and their places included, as two numbers."""
    nulls = [F.col(c).isNull() for c in rows.columns]
    return rows.withColumn("digest_a", F.xxhash64(*rows.columns, *nulls)).withColumn(
        "digest_b", F.xxhash64(F.lit(20_011), *nulls, *rows.columns[::-1]))


def digest_counts(rows: DataFrame) -> DataFrame:
    return digested(rows).groupBy("digest_a", "digest_b").agg(F.count("*").alias("copies"))


def suspects(rows: DataFrame) -> DataFrame:
    """Digests that more than one row has, written, so that Spark knows their size before it joins them."""
    return materialize(digest_counts(rows).where("copies > 1").drop("copies"), "suspects")


def repeated_rows(df: DataFrame) -> DataFrame:
    """Every distinct row that occurs more than once, with its number of ``copies``.

    Digests are counted first, combined map-side. Full rows are joined only to
    digests that repeat, in a join whose hot keys Spark can split, and grouped by
    their cells, combined map-side again. So rows of one digest that differ are
    told apart.
    """
    rows = positional(df)
    exact = digested(rows).join(suspects(rows), ["digest_a", "digest_b"], "left_semi").groupBy(*rows.columns).agg(
        F.count("*").alias("copies")).where("copies > 1")
    return exact.toDF(*df.columns, "copies")


def spelled(rows: DataFrame) -> Column:
    """128 bits of a SHA-256 digest over the cells, marked off so that no two rows are spelled alike.

    Texts have their length in front. Values of a fixed size are spelled as their
    64-bit hash, which is another one for every value of one type and cheaper to
    make than their text.
    """
    cells = []
    for c, field in zip(rows.columns, rows.schema.fields):
        x, carrier = F.col(c), carrier_of(field.dataType)
        if carrier == "string":
            cells.append(F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.length(x.cast("string")), F.lit(":"), x.cast("string"))))
        else:
            bits = F.xxhash64(F.when(x == 0, 0.0).otherwise(x).cast("double") if carrier == "double" else x)
            cells.append(F.concat(F.when(x.isNull(), F.lit("-")).otherwise(bits.cast("string")), F.lit(";")))
    return digest(F.concat(*cells))


def surplus_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row. Only digests are counted, no row moves; a digest of another kind tells those apart that the first ones do not."""
    rows = positional(df)
    counts = digested(rows).withColumn("digest_c", spelled(rows)).groupBy("digest_a", "digest_b", "digest_c").agg(F.count("*").alias("copies"))
    return counts.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def identical_pairs(df: DataFrame) -> list[tuple[str, str]]:
    """Column pairs that agree in every row, nulls included; all-null pairs are left out.

    Each column gets the sum of its hashes bound to the row they sit in, from one
    pass without a shuffle; 24 bits of a hash, so that a long holds the sum of any
    table. Columns with equal sums are compared row by row with
    the first of their group, all groups in one pass; those that differ from it
    after all form a group of their own for another pass. What comes back is one
    row per pass.
    """
    carriers = [carrier_of(f.dataType) for f in df.schema.fields]
    rows = positional(df)
    rows = rows.select(*[F.col(c).cast(t).alias(c) for c, t in zip(rows.columns, carriers)])
    columns = rows.columns
    marks = rows.withColumn("row_mark", F.xxhash64(*columns)).agg(
        *[F.sum(F.when(F.col(c).isNotNull(), F.shiftright(F.xxhash64("row_mark", c), 40))).alias(c) for c in columns],
        *[F.count(c).alias(f"{c}_n") for c in columns]).first()
    groups: dict[tuple, list[int]] = {}
    for i, c in enumerate(columns):
        if marks[f"{c}_n"]:
            groups.setdefault((carriers[i], marks[c], marks[f"{c}_n"]), []).append(i)
    open_, pairs = [g for g in groups.values() if len(g) > 1], []
    while open_:
        agree = rows.agg(*[F.bool_and(F.col(f"c{g[0]}").eqNullSafe(F.col(f"c{j}"))).alias(f"p{g[0]}_{j}")
                           for g in open_ for j in g[1:]]).first()
        rest = []
        for g in open_:
            same = [g[0], *[j for j in g[1:] if agree[f"p{g[0]}_{j}"]]]
            pairs += combinations(same, 2)
            rest.append([j for j in g if j not in same])
        open_ = [g for g in rest if len(g) > 1]
    return [(df.columns[i], df.columns[j]) for i, j in sorted(pairs)]


def unnamed_columns(names: list[str]) -> list[str]:
    return [n for n in names if not n.strip() or n.lower().startswith("unnamed:")]


def cell_sums(df: DataFrame) -> DataFrame:
    """Rows, missing cells and bytes of text of a table, as its summary has them, from one pass in which no value moves."""
    missing, octets = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for i, field in enumerate(df.schema.fields):
        c, carrier = column_at(df, i), carrier_of(field.dataType)
        x = c.cast(carrier)
        x = F.when(~F.isnan(x), x) if carrier == "double" else x
        missing = missing + (is_placeholder(x) | x.isNull() if carrier == "string" else x.isNull()).cast("int")
        octets = octets + F.coalesce(F.octet_length(x.cast("string")), F.lit(0))
    return df.select(missing.alias("missing"), octets.alias("octets")).agg(
        F.count("*").alias("rows"), F.sum("missing").alias("missing_cells"), F.sum("octets").alias("raw_bytes"))


def dataset_profile(df: DataFrame, summary: DataFrame | None, source: str, repeated_names: list[str] | None = None) -> DataFrame:
    """One row describing the table; ``summary`` is the per-column summary of the same table, if there is one already."""
    def texts(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in identical_pairs(df)]).cast(
        "array<struct<a:string,b:string>>")
    cells = cell_sums(df) if summary is None else summary.agg(
        F.max("n_rows").alias("rows"), F.sum("null_count").alias("missing_cells"), F.sum("raw_bytes").alias("raw_bytes"))
    duplicates = surplus_rows(df).scalar()
    return cells.select(
        F.lit(source).alias("source"), "rows", F.lit(len(df.columns)).alias("columns"), "raw_bytes",
        duplicates.alias("duplicate_rows"),
        (F.col("rows") * len(df.columns)).alias("total_cells"), "missing_cells",
        pairs.alias("identical_pairs"), texts(unnamed_columns(df.columns)).alias("unnamed_columns"),
        texts(repeated_names or []).alias("duplicate_column_names"),
    ).withColumn("duplicate_row_pct", pct(F.col("duplicate_rows"), F.col("rows"), 2)).withColumn(
        "missing_pct", pct(F.col("missing_cells"), F.col("total_cells"), 2))
