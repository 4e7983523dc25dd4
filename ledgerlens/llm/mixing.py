"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a share of the tokens to train on and a schedule: how its weight
moves over training time. Integrating the schedule gives the source's cumulative
demand at any time; inverting that demand turns a document's token offset within
its source into a training position, and sorting by position deals the sources
out in the proportions that the schedules ask for. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.common import WORD, column, fresh, running
from ledgerlens.session import materialize

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Slope of each weight's schedule w(t) = 1 + slope * (2t - 1), t from 0 to 1: heavy sources come earlier.
SLOPES = (-0.5, 0.0, 0.5)
#: Words of the mix over words of the corpus, and the most passes over one source.
SHARE, MOST_PASSES = 1.5, 2


def position(u: Column, slope: Column) -> Column:
    """The time t at which a source has given the part ``u`` of its tokens: the inverse of t + slope * (t * t - t)."""
    b = F.lit(1.0) - slope
    root = F.sqrt(b * b + F.lit(4.0) * slope * u)
    return F.when(slope == 0, u).otherwise((root - b) / (F.lit(2.0) * slope))


def water_level(sources: DataFrame, budget: float) -> float:
    """The level L for which the sum of least(MOST_PASSES * source_size, L * weight) is ``budget``.

    Starts with no source capped, caps those above, shares their excess by weight
    and repeats; the level only rises, so every round but the last caps a source.
    """
    level = 0.0
    while True:
        most = F.col("source_size") * MOST_PASSES
        capped = most.cast("double") < F.lit(level) * F.col("weight")
        row = sources.agg(F.sum(F.when(capped, most)).alias("capped"),
                          F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not row["open"]:
            return level
        risen = (budget - (row["capped"] or 0)) / row["open"]
        if risen <= level:
            return level
        level = risen


def plan(sources: DataFrame, weights: Sequence[float] = WEIGHTS, slopes: Sequence[float] = SLOPES,
         share: float = SHARE) -> DataFrame:
    """(source, source_size) with weight, slope and target; sources in code point order, null last."""
    cycle = lambda values: F.element_at(
        F.array(*[F.lit(float(v)) for v in values]), (F.col("rank") % len(values) + 1).cast("int"))
    ranked = materialize(running(sources, [], [F.col("source").asc_nulls_last()], None, "rank")
                         .withColumn("weight", cycle(weights)).withColumn("slope", cycle(slopes)), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(ranked, share * total)
    return ranked.withColumn("target", F.least(
        (F.col("source_size") * MOST_PASSES).cast("double"), F.lit(level) * F.col("weight"))).drop("rank")


def mix(df: DataFrame, weights: Sequence[float] = WEIGHTS, slopes: Sequence[float] = SLOPES, share: float = SHARE,
        id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per row of ``df``: id, source, size, source_size, target, taken, position, again.

    Within a source documents follow a hash of their id. Whole passes over the
    source take every document in full; what is left of the target goes to the
    first documents, and the one at the border gives a part of its words, so the
    words taken are the target rounded to a word. ``position`` and ``again`` are
    the training times, from 0 to 1, of the first and the second time that a
    document is used, else null.

    Null and empty texts have size 0 and are never taken. A null source is a
    source like any other, and a null id hashes as an empty one. Repeated rows
    share the order key; which of them is at the border does not show in the
    result. An empty table gives no rows; further columns are not read.
    """
    base = materialize(df.select(
        column(id_column).alias("id"), column(source_column).alias("source"),
        F.coalesce(F.regexp_count(column(text_column), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.coalesce(column(id_column).cast("string"), F.lit(""))).alias("key")), "sizes")
    targets = plan(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, slopes, share)
    placed = running(base, ["source"], [F.col("key").asc(), F.col("id").asc_nulls_last(), F.col("size").asc()],
                     "size", "start")
    t = targets.withColumnRenamed("source", "of_source")
    wanted = F.round("target").cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("wanted") - F.col("passes") * F.col("source_size") - F.col("start")))
    at = lambda words: position(words.cast("double") / F.col("wanted"), F.col("slope"))
    return (placed.join(t, F.col("source").eqNullSafe(F.col("of_source")))
            .withColumn("wanted", wanted).withColumn("passes", passes)
            .withColumn("taken", (F.col("passes") * F.col("size") + rest).cast("bigint"))
            .select(F.col("id").alias(id_column), F.col("source").alias(source_column), "size", "source_size", "target",
                    "taken", F.when(F.col("taken") > 0, at(F.col("start"))).alias("position"),
                    F.when(F.col("taken") > F.col("size"), at(F.col("start") + F.col("source_size"))).alias("again")))


def ordered(mixed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Sorted by training position over the whole cluster; documents that are not used come last."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), column(id_column))


def training_stream(df: DataFrame, **options) -> DataFrame:
    """The documents themselves in training order: a row for each use, the last one cut to the words taken.

    Columns are those of ``df``. Rows that share id, source and size are not told
    apart: each of them gets all uses of any of them.
    """
    id_column, text_column, source_column = (options.get(k, v) for k, v in (
        ("id_column", "doc_id"), ("text_column", "text"), ("source_column", "source")))
    m = (mix(df, **options).filter("taken > 0")
         .select(column(id_column).alias("m_id"), column(source_column).alias("m_source"), F.col("size").alias("m_size"),
                 "taken", F.posexplode(F.array_compact(F.array("position", "again"))).alias("m_use", "at"))
         .groupBy("m_id", "m_source", "m_size", "m_use").agg(F.max("taken").alias("m_taken"), F.min("at").alias("m_at")))
    names = {c: fresh(df, c) for c in ("m_id", "m_source", "m_size", "m_taken", "m_use", "m_at")}
    for old, new in names.items():
        m = m.withColumnRenamed(old, new)
    c = {k: F.col(v) for k, v in names.items()}
    text = column(text_column)
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    left = c["m_taken"] - c["m_use"] * c["m_size"]
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)")), F.lit(1), left.cast("int")), "")
    return (df.join(m, column(id_column).eqNullSafe(c["m_id"]) & column(source_column).eqNullSafe(c["m_source"]) & (size == c["m_size"]))
            .withColumn(text_column, F.when(left < c["m_size"], cut).otherwise(text))
            .orderBy(c["m_at"], column(id_column)).select(*[column(x) for x in df.columns]))
