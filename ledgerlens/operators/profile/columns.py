"""Per-column measures taken from the value-frequency table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions import fixed
from ledgerlens.functions.expressions import half_up, pct
from ledgerlens.functions.parsing import is_placeholder, looks_boolean
from ledgerlens.operators.ordering import (
    merge_picks, quantile_columns, quantile_picks, running_weight,
)
from ledgerlens.operators.profile.frequency import HEAD, column_at
from ledgerlens.session import materialize

TEXT_TYPES = ("categorical", "text", "identifier", "boolean")
TEXT_STORAGE = ("str", "string")
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def held() -> Column:
    """True for a value that counts as data: neither null nor a placeholder."""
    return F.col("value").isNotNull() & ~F.col("placeholder")


def by_position(values: list) -> Column:
    """The entry of a driver-side list that belongs to the row's column position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("position") + 1)


def storage_label() -> Column:
    """How a type-inferring text reader would store the column."""
    filled = F.col("n_rows") - F.col("n_null")
    return (F.when(filled == 0, "float64")
            .when((F.col("n_bool_text") == filled) & (F.col("n_null") == 0), "bool")
            .when((F.col("n_int_text") == filled) & (F.col("n_null") == 0), "int64")
            .when(F.col("n_float_text") == filled, "float64").otherwise("str"))


def name_words(name: Column, pattern: str) -> Column:
    return F.split(F.lower(name), pattern)


def semantic_type() -> Column:
    """What the column means; the first rule that holds decides."""
    name_hints_id = F.arrays_overlap(
        name_words(F.col("name"), r"[\s_]+"), F.array(*[F.lit(h) for h in fixed.IDENTIFIER_HINTS]))
    uniqueness = F.col("n_distinct") / F.greatest(F.col("n_held"), F.lit(1))
    return (F.when(F.col("n_held") == 0, "empty")
            .when(F.col("n_distinct") == 1, "constant")
            .when(F.col("is_boolean_like"), "boolean")
            .when(F.col("date_share") >= fixed.PARSE_SHARE, "datetime")
            .when(F.col("number_share") >= fixed.PARSE_SHARE, "numeric")
            .when((uniqueness > fixed.UNIQUE_SHARE) & (name_hints_id | (F.col("n_distinct") > 50)), "identifier")
            .when((F.col("n_distinct") <= fixed.FEW_VALUES) | (uniqueness < fixed.RARE_SHARE), "categorical")
            .when(F.col("n_chars") / F.col("n_held") > fixed.LONG_TEXT, "text")
            .when(uniqueness < 0.5, "categorical").otherwise("text"))


def summarize(vf: DataFrame, names: list[str], stored: list[str] | None, as_of: str) -> DataFrame:
    """One row per column from algebraic aggregates only, so hot columns combine map-side."""
    value, n, x, ts = (F.col(c) for c in ("value", "n", "x", "ts"))
    count_of = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    pair = F.lit(None).cast("int")
    for i, words in enumerate(fixed.BOOLEAN_PAIRS):
        pair = F.when(F.col("ok") & F.col("norm").isin(*words), F.lit(i)).otherwise(pair)
    marked = vf.withColumn("ok", held()).withColumn("pair", pair)
    ok = F.col("ok")
    labels = [] if stored else [
        count_of(F.col("shape") == 2).alias("n_int_text"), count_of(F.col("shape") > 0).alias("n_float_text"),
        count_of(looks_boolean(value) & F.col("digest").isNull()).alias("n_bool_text")]
    sums = marked.groupBy("position").agg(
        F.sum("n").alias("n_rows"), count_of(value.isNull()).alias("n_null"),
        count_of(F.col("placeholder")).alias("disguised_null_count"),
        count_of(ok).alias("n_held"), F.count_if(ok).alias("n_distinct"),
        count_of(ok & x.isNotNull()).alias("n_number"), count_of(ok & ts.isNotNull()).alias("n_date"),
        count_of(ok & F.col("edge")).alias("n_edge_space"),
        F.sum(F.when(ok, F.col("n_chars") * n)).alias("n_chars"), F.max("n_chars").alias("longest"),
        F.coalesce(F.sum(F.col("octets") * n), F.lit(0)).alias("raw_bytes"),
        *labels, F.count("pair").alias("n_paired"), (F.min("pair") == F.max("pair")).alias("one_pair"),
        F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.sum(x * n).alias("sum_x"),
        count_of(x == 0).alias("zeros"), count_of(x < 0).alias("negatives"), F.count("x").alias("n_number_values"),
        F.min("ts").alias("min_date"), F.max("ts").alias("max_date"),
        count_of(ts > F.lit(as_of).cast("timestamp")).alias("future_count"),
    )
    # Kept apart: a set among the sums would take the whole aggregate out of generated code.
    tokens = vf.where("placeholder").groupBy("position").agg(
        F.array_sort(F.collect_set("norm")).alias("disguised_null_tokens"))
    sums = sums.join(tokens, "position", "left").withColumn(
        "disguised_null_tokens", F.coalesce("disguised_null_tokens", F.array().cast("array<string>")))
    share = F.try_divide(F.col("n_number"), F.col("n_held"))
    named = (sums.withColumn("name", by_position(names))
             .withColumn("stored_as", by_position(stored) if stored else storage_label())
             .withColumn("number_share", F.coalesce(share, F.lit(0.0)))
             .withColumn("date_share", F.when(F.col("number_share") >= fixed.PARSE_SHARE, 0.0).otherwise(
                 F.coalesce(F.try_divide(F.col("n_date"), F.col("n_held")), F.lit(0.0))))
             .withColumn("is_boolean_like", (F.col("n_held") > 0) & (F.col("n_distinct") <= 2)
                         & (F.col("n_paired") == F.col("n_distinct")) & F.col("one_pair")))
    typed = named.withColumn("inferred_type", semantic_type())
    text_like = F.col("inferred_type").isin(*TEXT_TYPES)
    mixed = (F.col("number_share") > 0.05) & (F.col("number_share") < 0.95)
    nulls = F.col("n_null") + F.col("disguised_null_count")
    return (typed
            .withColumn("null_count", nulls)
            .withColumn("null_pct", pct(nulls, F.col("n_rows"), 2))
            .withColumn("unique_pct", F.coalesce(pct(F.col("n_distinct"), F.col("n_held"), 2), F.lit(0.0)))
            .withColumn("whitespace_count", F.when(text_like, F.col("n_edge_space")).otherwise(F.lit(0)))
            .withColumn("mixed_type_count", F.when(text_like & mixed, F.least(
                F.col("n_number"), F.col("n_held") - F.col("n_number"))).otherwise(F.lit(0)))
            .withColumn("numeric_parseable_pct", half_up(F.col("number_share"), 4))
            .withColumn("date_parseable_pct", half_up(F.col("date_share"), 4))
            .withColumn("has_stats", (F.col("n_number") > 0) & (
                (F.col("inferred_type") == "numeric") | (F.col("number_share") >= fixed.PARSE_SHARE)))
            .drop("n_paired", "one_pair", "n_edge_space"))


def among(vf: DataFrame, summary: DataFrame, condition: Column | str, *carry: str) -> DataFrame:
    """Frequency rows of the columns that satisfy ``condition``, with summary fields attached.

    The broadcast side has one row per column of the reviewed table, so its size
    is bounded by the width of the schema.
    """
    return vf.join(F.broadcast(summary.where(condition).select("position", *carry)), "position")


def collapsed_distinct(vf: DataFrame, summary: DataFrame) -> DataFrame:
    """Distinct values left once case and edge space are ignored, for text-like columns.

    Only their number is wanted, so of long texts a digest is compared.
    """
    rows = among(vf, summary, F.col("inferred_type").isin(*TEXT_TYPES)).where(held())
    return rows.select("position", "norm").distinct().groupBy("position").agg(F.count("*").alias("case_collapsed_unique"))


def top_values(vf: DataFrame, summary: DataFrame, whole, k: int = fixed.TOP_VALUES) -> DataFrame:
    """The most frequent values of text-like columns; equal counts are ordered by value.

    Heads order long texts as far as they differ. Texts of equal rank, and those
    listed, are then fetched by ``whole``, which is given their digests. Spark
    keeps the first ranks of each task before it shuffles them.
    """
    rows = among(vf, summary, F.col("inferred_type").isin(*TEXT_TYPES)).where(held())
    order = Window.partitionBy("position").orderBy(F.desc("n"), F.asc("value"))
    ranked = rows.select("position", "value", "digest", "n", F.rank().over(order).alias("rank")).where(F.col("rank") <= k)
    if not summary.where((F.col("longest") > HEAD) & F.col("inferred_type").isin(*TEXT_TYPES)).isEmpty():
        ranked = materialize(ranked, "heads")
        texts = whole(ranked.where("digest is not null").select("position", "digest"))
        ranked = ranked.join(texts, ["position", "digest"], "left").withColumn("value", F.coalesce("whole", "value"))
    return ranked.select("position", "value", "n", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def listed(ranked: DataFrame) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct("rank", "value", "n")))
    return ranked.groupBy("position").agg(
        F.transform(entries, lambda e: F.struct(e["value"].alias("value"), e["n"].alias("n"))).alias("top_values"))


def ranked_numbers(vf: DataFrame, summary: DataFrame, rows: int) -> DataFrame:
    """Each distinct number of the numeric columns with the weight before it and its two neighbours.

    Numbers spelled apart are merged on the way. ``rows`` bounds their number.
    """
    numbers = among(vf, summary, "has_stats").where(held() & F.col("x").isNotNull()).select("position", "x", "n")
    return running_weight(numbers, ["position"], ["x"], rows, "n", neighbours="x")


def binned_numbers(ranked: DataFrame, summary: DataFrame, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Histogram counts, sums of squared and cubed deviations and quartile picks per column and bin.

    One pass gives all of them, at most ten rows per column. Deviations are
    taken from the mean already known, so large values lose no digits.
    """
    joined = among(ranked, summary, "has_stats", "sum_x", "n_number", "min_x", "max_x")
    d = F.col("x") - F.col("sum_x") / F.col("n_number")
    at = F.coalesce(F.try_divide(F.col("x") - F.col("min_x"), F.col("max_x") - F.col("min_x")), F.lit(0.0))
    placed = joined.withColumn("bin", F.least(F.floor(at * bins), F.lit(bins - 1)).cast("int")).withColumn("d", d)
    n = F.col("n")
    return placed.groupBy("position", "bin").agg(
        F.sum(n).alias("n"), F.sum(F.col("d") * F.col("d") * n).alias("m2"),
        F.sum(F.col("d") * F.col("d") * F.col("d") * n).alias("m3"),
        *quantile_picks("x", "n", F.col("n_number"), QUARTILES))


def histogram(binned: DataFrame, summary: DataFrame, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """All bins, empty ones too, of columns with at least five numbers and two distinct ones."""
    enough = F.col("has_stats") & (F.col("n_number") >= 5) & (F.col("min_x") < F.col("max_x"))
    frame = summary.where(enough).select(
        "position", "name", "min_x", "max_x", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("max_x") - F.col("min_x")) / bins
    return frame.join(binned.select("position", "bin", "n"), ["position", "bin"], "left").select(
        "name", "bin", (F.col("min_x") + width * F.col("bin")).alias("lo"),
        (F.col("min_x") + width * (F.col("bin") + 1)).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def number_stats(binned: DataFrame, summary: DataFrame) -> DataFrame:
    """Mean, sample deviation, bias-corrected skewness and quartiles."""
    sums = binned.groupBy("position").agg(F.sum("m2").alias("m2"), F.sum("m3").alias("m3"), *merge_picks(QUARTILES))
    n = F.col("n_number").cast("double")
    joined = sums.join(F.broadcast(summary.select("position", "n_number", "sum_x", "min_x", "max_x")), "position")
    spread = F.col("m2") / n
    raw_skew = F.try_divide(F.col("m3") / n, spread * F.sqrt(spread))
    varies = F.col("min_x") < F.col("max_x")
    return joined.select(
        "position", (F.col("sum_x") / n).alias("mean"),
        F.when(n > 1, F.sqrt(F.try_divide(F.col("m2"), n - 1))).otherwise(F.lit(0.0)).alias("std"),
        F.when((n > 2) & varies, raw_skew * F.sqrt(n * (n - 1)) / (n - 2)).otherwise(F.lit(0.0)).alias("skew"),
        *quantile_columns(QUARTILES))


def number_fields() -> Column:
    """The measures of a column's numbers in one field, of a summary joined with :func:`number_stats`; null without numbers."""
    fields = F.struct("mean", "std", F.col("min_x").alias("min"), "q1", "median", "q3", F.col("max_x").alias("max"), "zeros", "negatives", "skew")
    return F.when(F.col("has_stats"), fields)


def typical_gaps(ranked: DataFrame, rows: int) -> DataFrame:
    """Median step between neighbouring distinct numbers, for columns with at least three of them."""
    steps = ranked.where(F.col("next").isNotNull()).select(
        "position", (F.col("next") - F.col("x")).alias("step"), F.lit(1).cast("bigint").alias("n"))
    placed = running_weight(steps, ["position"], ["step"], rows, "n", total="n_steps")
    middle = {"typical_value_gap": 0.5}
    return placed.where("n_steps >= 2").groupBy("position").agg(
        *quantile_picks("step", "n", F.col("n_steps"), middle)).select("position", *quantile_columns(middle))


def repeated_numbers(ranked: DataFrame, numeric: DataFrame, summary: DataFrame, share: float,
                     repeats: int = fixed.FREQUENT_REPEATS) -> DataFrame:
    """All numbers seen at least ``repeats`` times and in ``share`` of the values, with the gap to the nearest other one.

    At most 1 / ``share`` numbers of a column can be that frequent, so no other limit is needed.
    """
    rows = ranked.join(F.broadcast(summary.select("position", "name", "n_held", "n_number_values")), "position")
    often = rows.where(F.col("n") >= F.greatest(F.lit(float(repeats)), F.lit(float(share)) * F.col("n_held")))
    gap = F.least(F.col("x") - F.col("previous"), F.col("next") - F.col("x"))
    return often.join(F.broadcast(numeric.select("position", "median")), "position").select(
        "position", "name", F.col("x").alias("value"), "n", F.when(F.col("n_number_values") >= 3, gap).alias("gap"), "median")


def frequent_numbers(repeated: DataFrame, kept: int = fixed.FREQUENT_KEPT) -> DataFrame:
    """The listing of repeated numbers: the ``kept`` ones furthest from the median of each column."""
    w = Window.partitionBy("position").orderBy(F.desc(F.abs(F.col("value") - F.col("median"))), F.asc("value"))
    return repeated.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= kept).drop("rank", "median")


def sample_values(df: DataFrame, summary: DataFrame | None = None, k: int = fixed.SAMPLE_VALUES, head: int = 100) -> DataFrame:
    """The first ``k`` held values of every column in file order.

    The first rows of the table nearly always hold them, and reading those stops
    after one or two partitions. Columns that are still short of values there are
    searched in full, all in one pass that keeps ``k`` rows per column and task;
    a ``summary``, where there is one, tells which of them have no more to find.
    """
    spark = df.sparkSession
    text = df.select(*[column_at(df, i).cast("string").alias(f"c{i}") for i in range(len(df.columns))])
    first = spark.createDataFrame(text.head(head), text.schema)
    available = {r["position"]: r["n_held"] for r in summary.select("position", "n_held").collect()} if summary else dict.fromkeys(range(len(df.columns)), k)
    w = Window.partitionBy("position").orderBy("row")

    def held_in(rows: DataFrame, positions: list[int]) -> DataFrame:
        numbered = rows.select(F.monotonically_increasing_id().alias("row"),
                               *[F.col(f"c{i}").alias(str(i)) for i in positions])
        long = numbered.unpivot(["row"], [str(i) for i in positions], "position", "value")
        return long.where(F.col("value").isNotNull() & ~is_placeholder(F.col("value")))

    def first_held(rows: DataFrame, positions: list[int]) -> dict[int, list[str]]:
        ranked = held_in(rows, positions).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        values = F.transform(F.array_sort(F.collect_list(F.struct("row", "value"))), lambda e: e["value"])
        return {int(r["position"]): r["values"] for r in ranked.groupBy("position").agg(values.alias("values")).collect()}

    lists = first_held(first, list(available))
    short = [i for i, n in available.items() if len(lists.get(i, [])) < min(k, n)]
    if short:
        lists.update(first_held(text, short))
    return spark.createDataFrame([(i, lists.get(i, [])) for i in available],
                                 "position int, sample_values array<string>")
