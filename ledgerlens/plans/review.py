"""Registered profiling, diagnosis, cleaning and evaluation queries with their reference SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.functions import fixed
from ledgerlens.functions.expressions import half_up
from ledgerlens.functions.parsing import null_default_tokens, parse_date, parse_number
from ledgerlens.operators import cleaning, diagnose, evaluate, planting
from ledgerlens.operators.profile import JointProfile, Profile, profile_file, columns as profile_columns, dataset as profile_dataset
from ledgerlens.plans import review_sql as sql
from ledgerlens.plans.views import table
from ledgerlens.session import materialize, work_path
from ledgerlens.sources import delimited, sinks

AS_OF = sql.AS_OF
TEXT_SETS = ("planted", "control", "rare", "coded")
TYPED_COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
}
TYPED_STORAGE = {
    "customer": ("bigint", "string", "int", "double", "string"),
    "orders": ("bigint", "bigint", "string", "double", "timestamp", "string"),
    "lineitem": ("bigint", "bigint", "bigint", "int", "double", "double", "double", "double", "string", "string", "timestamp"),
    "events": ("bigint", "timestamp", "bigint", "string", "double", "string"),
    "documents": ("bigint", "string", "string", "string", "bigint"),
}
RARE_COLUMNS = ("grade", "points", "reply", "referrer", "segment_code", "remark", "memo", "comment")

_profiles: dict[tuple, Profile] = {}


def dataset(spark: SparkSession, d: str, name: str) -> DataFrame:
    if name == "planted":
        return planting.plant_defects(table(spark, d, "orders"))
    if name == "control":
        return planting.clean_control(table(spark, d, "orders"))
    if name == "rare":
        return planting.plant_rare_defects(table(spark, d, "orders"))
    if name == "coded":
        return planting.plant_many_codes(table(spark, d, "orders"))
    df = table(spark, d, name)
    # Timestamps of the test tables carry no zone; the session zone is fixed, so reading them as instants is exact.
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def listing(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files below ``path``; their content is not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime", "length")
    return tuple(sorted(map(tuple, files.collect())))


def profile_of(spark: SparkSession, d: str, name: str) -> Profile:
    """One profile for each state of a table and session: its written parts serve every query over the table."""
    source = "orders" if name in TEXT_SETS else name
    key = (spark.sparkContext.applicationId, name, listing(spark, f"{d.rstrip('/')}/{source}.parquet"))
    if key not in _profiles:
        _profiles[key] = Profile(dataset(spark, d, name), name, AS_OF, text=name in TEXT_SETS)
    return _profiles[key]


def forget_profiles() -> None:
    _profiles.clear()


# --- reference SQL per data set -------------------------------------------------------------

def _source_sql(name: str) -> tuple[list[str], str, tuple[str, ...], dict[int, str] | None]:
    if name == "planted":
        return [sql.PLANTED], "planted", sql.PLANTED_COLUMNS, None
    if name == "control":
        return [sql.CONTROL], "control", sql.CONTROL_COLUMNS, None
    if name == "coded":
        return [sql.CODED], "coded", sql.CODED_COLUMNS, None
    if name == "rare":
        sparse = lambda m: f"CASE WHEN o_orderkey % {m} = 0 THEN 'note ' || CAST(o_orderkey % 40 AS VARCHAR) END"
        return [f"""rare AS (SELECT o_orderkey, 0 AS copy,
  CASE WHEN o_orderkey % 4 = 0 THEN 'A' || CAST(o_custkey % 5 AS VARCHAR) ELSE CAST(o_custkey % 90 AS VARCHAR) END AS grade,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 50 END AS VARCHAR) AS points,
  CASE WHEN o_orderkey % 10 >= 6 THEN CAST(o_custkey % 5 + 1 AS VARCHAR) END AS reply,
  CASE WHEN o_orderkey % 10 >= 3 THEN 'site ' || CAST(o_custkey % 9 AS VARCHAR) END AS referrer,
  'S' || CAST(o_custkey % 60 AS VARCHAR) AS segment_code,
  {sparse(19)} AS remark, {sparse(23)} AS memo, {sparse(31)} AS comment FROM orders)"""], "rare", RARE_COLUMNS, None
    return [], name, TYPED_COLUMNS[name], dict(enumerate(TYPED_STORAGE[name]))


def with_profile(name: str, select: str, *more: str) -> str:
    before, source, columns, stored = _source_sql(name)
    parts = [*before, sql.cells(source, columns), sql.profile(stored), sql.whole(source, columns, sql.identical(source, columns, stored)), *more]
    return "WITH " + ",\n".join(parts) + "\n" + select


def with_findings(name: str, select: str) -> str:
    return with_profile(name, select, sql.hits([fixed.SENTINEL_RATE]), sql.findings())


def from_source(name: str, select: str, *more: str) -> str:
    before, *_ = _source_sql(name)
    return ("WITH " + ",\n".join([*before, *more]) + "\n" if before or more else "") + select


# --- queries ------------------------------------------------------------------------------

def _columns(name: str, *fields: str | Column):
    """Fields of the column profile; only the scalars are worked out if they have them all."""
    def query(spark, d):
        p = profile_of(spark, d, name)
        return (p.scalars if set(fields) <= set(Profile.SCALARS) else p.columns).select(*fields)
    return query


def stat(field: str) -> Column:
    return half_up(F.col(f"stats.{field}"), 4).alias(field)


STAT_FIELDS = ("mean", "std", "min", "q1", "median", "q3", "max")
STAT_SQL = (f"{sql.up('mean', 4)} AS mean, {sql.up('std', 4)} AS std, {sql.up('min_x', 4)} AS min, {sql.up('q1', 4)} AS q1, "
            f"{sql.up('median', 4)} AS median, {sql.up('q3', 4)} AS q3, {sql.up('max_x', 4)} AS max")
SCALARS = ("name", "position", "stored_as", "inferred_type", "count", "null_count", "null_pct", "unique_count", "unique_pct",
           "disguised_null_count", "whitespace_count", "case_collapsed_unique", "numeric_parseable_pct", "date_parseable_pct",
           "is_boolean_like", "mixed_type_count")
SCALARS_SQL = """name, position, stored_as, inferred_type, n_held AS count, null_count, null_pct, n_distinct AS unique_count,
  unique_pct, disguised_null_count, whitespace_count, case_collapsed_unique, numeric_parseable_pct, date_parseable_pct,
  is_boolean_like, mixed_type_count"""


def whole_profile(name: str):
    """Every scalar of the column profile together with the numeric statistics."""
    def query(spark, d):
        return profile_of(spark, d, name).columns.select(
            *SCALARS, *[stat(f) for f in STAT_FIELDS], F.col("stats.zeros").alias("zeros"),
            F.col("stats.negatives").alias("negatives"), half_up(F.col("stats.skew"), 3).alias("skew"),
            half_up(F.col("typical_value_gap"), 4).alias("typical_value_gap"))
    guarded = ", ".join(f"CASE WHEN has_stats THEN {sql.up(x, 4)} END AS {f}" for f, x in zip(
        STAT_FIELDS, ("mean", "std", "min_x", "q1", "median", "q3", "max_x")))
    oracle = with_profile(name, f"""SELECT {SCALARS_SQL}, {guarded}, CASE WHEN has_stats THEN zeros END AS zeros,
  CASE WHEN has_stats THEN negatives END AS negatives, CASE WHEN has_stats THEN {sql.up('skew', 3)} END AS skew,
  {sql.up('typical_value_gap', 4)} AS typical_value_gap FROM full_prof""")
    return query, oracle


def g02_placeholder_tokens(spark, d):
    return profile_of(spark, d, "planted").scalars.select("name", F.explode("disguised_null_tokens").alias("token"))


def g05_parse_numbers(spark, d):
    df = dataset(spark, d, "planted")
    parsed = ("Amount", "Tax Share", "Crate Count", "Priority")
    return df.select(*[parse_number(cleaning.named(c)).alias(c) if c in parsed else cleaning.named(c) for c in df.columns])


def g07_parse_dates(spark, d):
    return dataset(spark, d, "planted").withColumn("Promised", parse_date(F.col("Promised")).cast("date"))


def g12_identifier_names(spark, d):
    hints = F.array(*[F.lit(h) for h in fixed.IDENTIFIER_HINTS])
    words = profile_columns.name_words(F.col("name"), r"[\s_]+")
    return profile_of(spark, d, "planted").columns.select("name", F.arrays_overlap(words, hints).alias("name_hints_id"))


def samples(name: str):
    def query(spark, d):
        p = Profile(dataset(spark, d, name), name, AS_OF, text=name in TEXT_SETS)
        return p.samples.select("name", F.posexplode("sample_values").alias("place", "value"))
    _, source, columns, _ = _source_sql(name)
    order = {"planted": "copy, o_orderkey", "customer": "c_custkey"}[name]
    branch = " UNION ALL ".join(
        f"""SELECT {sql.text(c)} AS name, CAST(row_number() OVER (ORDER BY {order}) - 1 AS INT) AS place, CAST("{c}" AS VARCHAR) AS value
FROM {source} WHERE "{c}" IS NOT NULL AND NOT {sql.placeholder(f'CAST("{c}" AS VARCHAR)')} QUALIFY place < 5""" for c in columns)
    return query, from_source(name, branch)


def g16_top_values(spark, d):
    return profile_of(spark, d, "planted").columns.select("name", F.posexplode("top_values")).select(
        "name", (F.col("pos") + 1).alias("rank"), F.col("col.value").alias("value"), F.col("col.n").alias("n"))


def g24_date_stats(spark, d):
    return profile_of(spark, d, "planted").columns.where("date_stats IS NOT NULL").select(
        "name", F.col("date_stats.min_date").cast("date").alias("min_date"),
        F.col("date_stats.max_date").cast("date").alias("max_date"), "date_stats.span_days", "date_stats.future_count")


def whole_table(name: str):
    def query(spark, d):
        return profile_of(spark, d, name).dataset.select(
            "rows", "columns", "raw_bytes", "duplicate_rows", "duplicate_row_pct", "total_cells", "missing_cells", "missing_pct",
            F.size("identical_pairs").alias("n_identical_pairs"), F.size("unnamed_columns").alias("n_unnamed_columns"))
    return query, with_profile(name, f"""SELECT rows, columns, raw_bytes, duplicate_rows, {sql.pct('duplicate_rows', 'rows')} AS duplicate_row_pct,
  total_cells, missing_cells, {sql.pct('missing_cells', 'total_cells')} AS missing_pct, n_identical_pairs, n_unnamed_columns FROM whole""")


def g28_identical_columns(spark, d):
    return profile_of(spark, d, "planted").dataset.select(F.inline("identical_pairs"))


def g28_identical_sql() -> str:
    columns = sql.PLANTED_COLUMNS
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    branch = " UNION ALL ".join(
        f"""SELECT {sql.text(a)} AS a, {sql.text(b)} AS b FROM planted
HAVING bool_and("{a}" IS NOT DISTINCT FROM "{b}") AND count("{a}") > 0""" for a, b in pairs)
    return from_source("planted", branch)


def g29_unnamed(spark, d):
    return profile_of(spark, d, "planted").dataset.select(F.explode("unnamed_columns").alias("name"))


def findings_of(name: str):
    def query(spark, d):
        return diagnose.diagnose(profile_of(spark, d, name)).select("severity", "kind", "rule_id", "column")
    return query, with_findings(name, 'SELECT severity, kind, rule_id, "column" FROM findings')


def found(spark, d, name="planted"):
    p = profile_of(spark, d, name)
    return p, diagnose.diagnose(p)


RANK = "CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END"


def h23_order(spark, d):
    return diagnose.findings_listing(found(spark, d)[1]).select("line", "severity", "tag", "rule_id", "column")


H23_SQL = f"""SELECT CAST(row_number() OVER (ORDER BY {RANK}, coalesce("column", ''), CAST(substr(rule_id, 2) AS INT)) AS INT) AS line,
  severity, CASE kind WHEN 'fix' THEN 'Fix' ELSE 'Decide' END AS tag, rule_id, "column" FROM findings"""


def h24_starting_points(spark, d):
    p, findings = found(spark, d)
    return diagnose.starting_points(p, findings).select("step", "rule")


H24_SQL = """, present AS (
  SELECT 1 AS k, 'placeholders' AS rule FROM findings WHERE severity = 'high' AND rule_id = 'H7'
  UNION SELECT 2, 'types' FROM findings WHERE severity = 'high' AND rule_id IN ('H8', 'H9')
  UNION SELECT 3, 'spellings' FROM findings WHERE severity = 'high' AND rule_id = 'H12'
  UNION SELECT 4, 'keys' FROM findings WHERE severity = 'high' AND rule_id = 'H15'
  UNION SELECT 5, 'duplicates' FROM whole WHERE duplicate_rows > 0
  UNION SELECT 6, 'analyse' FROM full_prof WHERE inferred_type IN ('numeric', 'datetime') AND null_pct < 20)
SELECT CAST(row_number() OVER (ORDER BY k) AS INT) AS step, rule FROM present"""


def h24_usable(spark, d):
    return diagnose.usable_columns(profile_of(spark, d, "planted").columns)


def h25_counts(spark, d):
    return diagnose.severity_counts(found(spark, d)[1])


def h26_rollup(spark, d):
    p, findings = found(spark, d)
    return diagnose.column_rollup(p.columns, findings)


def h27_ledger(spark, d):
    p, findings = found(spark, d)
    return diagnose.ledger(p.dataset, findings)


def h28_numeric(spark, d):
    return diagnose.numeric_summary(profile_of(spark, d, "planted").columns).select(
        "name", *[half_up(F.col(f), 4).alias(f) for f in STAT_FIELDS], "zeros", "negatives")


def h29_categories(spark, d):
    return diagnose.category_breakdown(profile_of(spark, d, "planted").columns)


TOP_SQL = """, tops AS (SELECT c.position, any_value(c.name) AS name, value, count(*) AS n FROM cells c JOIN full_prof p USING (position)
  WHERE held AND p.text_like GROUP BY c.position, value),
ranked_tops AS (SELECT *, CAST(row_number() OVER (PARTITION BY position ORDER BY n DESC, value) AS INT) AS rank FROM tops)
"""


def _clean(change: Callable[[DataFrame], DataFrame]):
    """A repair of the planted table; whole rows are returned, so that the rest is seen to survive."""
    return lambda spark, d: change(dataset(spark, d, "planted"))


def changed(**columns: str) -> str:
    """All planted columns in SQL, some of them replaced; underscores stand for the spaces of a name."""
    new = {k.replace("_", " "): v for k, v in columns.items()}
    return "SELECT " + ", ".join(f'{new[c]} AS "{c}"' if c in new else f'"{c}"' for c in sql.PLANTED_COLUMNS) + " FROM planted"


def _sql_cols(*names: str) -> str:
    return ", ".join(f'"{n}"' for n in names)


PLAIN = _sql_cols(*sql.PLANTED_COLUMNS)


def i01_list_repeated(spark, d):
    return cleaning.list_repeated_rows(dataset(spark, d, "planted"))


def i16_outliers(spark, d):
    df = dataset(spark, d, "planted")
    # A column's fence follows from the column alone.
    return cleaning.outlier_rows(df, "Crate Count", Profile(df.select("Crate Count"), "Crate Count", AS_OF).stats)


def truth_of(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(planting.TRUTH), "dataset string, column string, value double")


def swept(spark: SparkSession, d: str) -> JointProfile:
    """What can be numeric of the planted table and its control in one profile, kept like those of single tables."""
    names = ("planted", "control")
    key = (spark.sparkContext.applicationId, names, listing(spark, f"{d.rstrip('/')}/orders.parquet"))
    if key not in _profiles:
        _profiles[key] = JointProfile({n: evaluate.maybe_numeric(dataset(spark, d, n)) for n in names}, AS_OF)
    return _profiles[key]


def outcomes(spark, d):
    return evaluate.judged(evaluate.flagged(swept(spark, d)), truth_of(spark))


def i12_typed(spark, d):
    """Documents that no label covers, over the numbers and texts of both tables."""
    labelled = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    rounded = [half_up(F.col(c), 6).alias(c) for c in ("mean", "std", "q1", "median", "q3")]
    out = cleaning.describe_missing(labelled, "quality")
    return out.select(*[c for c in out.columns if c not in ("mean", "std", "q1", "median", "q3")], *rounded)


I12_TYPED_SQL = "WITH gone AS (SELECT doc_id, lang, source, n_chars, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL) " + " UNION ALL ".join(
    f"""SELECT (SELECT count(*) FROM gone) AS rows, '{c}' AS name, count({c}) AS count, count(DISTINCT {c}) AS "unique",
  (SELECT CAST({c} AS VARCHAR) FROM gone WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
  (SELECT count(*) FROM gone WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1) AS freq,
  CAST(min({x}) AS VARCHAR) AS min, CAST(max({x}) AS VARCHAR) AS max, {sql.up(f'avg({y})', 6)} AS mean, {sql.up(f'stddev_samp({y})', 6)} AS std,
  {', '.join(f"{sql.up(f'quantile_cont({y}, {q})', 6)} AS {name}" for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)))} FROM gone"""
    for c, x, y in (*[(c, f"CAST({c} AS DOUBLE)", f"CAST({c} AS DOUBLE)") for c in ("doc_id", "n_chars", "toxic")],
                    *[(c, c, "CAST(NULL AS DOUBLE)") for c in ("lang", "source")]))


def sweep_sql(select: str) -> str:
    """Both data sets through the same rule, then every rate against the planted truth."""
    hit_sets = []
    for name in ("planted", "control"):
        inner = with_profile(name, "SELECT rate, name, value, n FROM hits", sql.hits(fixed.SWEEP_RATES))
        hit_sets.append(f"SELECT '{name}' AS dataset, h.* FROM ({inner}) h")
    truth = ", ".join(f"('{a}', '{b}', CAST({v} AS DOUBLE))" for a, b, v in planting.TRUTH)
    rates = ", ".join(f"(CAST({r} AS DOUBLE))" for r in fixed.SWEEP_RATES)
    return f"""WITH rates(rate) AS (VALUES {rates}), truth(dataset, "column", value) AS (VALUES {truth}),
flags AS ({' UNION ALL '.join(hit_sets)}),
judged AS (SELECT coalesce(f.rate, t.rate) AS rate, coalesce(f.dataset, t.dataset) AS dataset,
  coalesce(f.name, t."column") AS "column", coalesce(f.value, t.value) AS value, f.n,
  CASE WHEN f.rate IS NOT NULL AND t.rate IS NOT NULL THEN 'found' WHEN f.rate IS NOT NULL THEN 'false alarm' ELSE 'missed' END AS outcome
  FROM flags f FULL JOIN (SELECT * FROM truth, rates) t
  ON f.rate = t.rate AND f.dataset = t.dataset AND f.name = t."column" AND f.value = t.value)
{select}"""


COUNTS_SQL = """count(*) FILTER (WHERE outcome = 'found') AS found,
  count(*) FILTER (WHERE outcome = 'false alarm') AS false_alarms, count(*) FILTER (WHERE outcome = 'missed') AS missed"""


def round_trip(name: str, suffix: str, columns: tuple[str, ...], multi_line: bool = False):
    """Writes a table as delimited text, reads it back through the library and returns every row."""
    def query(spark, d):
        path = fresh_path(spark, f"export-{name}") + suffix
        source = table(spark, d, name).select(*columns)
        source.write.option("escape", '"').option("sep", delimited.SEPARATORS[suffix]).csv(path, header=True)
        return delimited.read_delimited(spark, path, multi_line=multi_line)
    cast = ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in columns)
    return query, f"SELECT {cast} FROM {name}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that no other call writes to."""
    return work_path(spark, f"{name}-{uuid.uuid4().hex}")


#: Header of the export below: a repeat, a name that a repeat would get, and no name.
EXPORT_HEADER = ["nation", "name", "name", "name.1", None]


def bare_export(spark: SparkSession, d: str) -> str:
    """Suppliers as delimited text without a header line."""
    path = fresh_path(spark, "export-suppliers") + ".csv"
    table(spark, d, "supplier").select("s_nationkey", "s_name", "s_suppkey", "s_acctbal", "s_name").toDF(*"abcde").write.csv(path)
    return path


def a05_header_repair(spark, d):
    return delimited.read_delimited(spark, bare_export(spark, d), header=EXPORT_HEADER)


def g30_repeated_names(spark, d):
    return profile_file(spark, bare_export(spark, d), AS_OF, header=EXPORT_HEADER).dataset.select(
        F.explode("duplicate_column_names").alias("name"), "rows")


#: Layouts of dates, the day first only in those where the month has a name or the day is above 12.
LAYOUTS = ("MM/dd/yyyy HH:mm", "MM/dd/yyyy hh:mm a", "MM/dd/yy", "M/d/yy", "yyyy-MM-dd hh:mm a", "MMM d, yyyy HH:mm", "yyyy.MM.dd",
           "d-MMM-yy", "EEEE, MMMM d, yyyy", "EEE d MMM yyyy HH:mm:ss", "yyyyMMdd'T'HHmmss", "yyyy/MM/dd HH:mm", "yyyyMMdd", "MMMM d, yyyy")
DAY_FIRST = ("dd/MM/yyyy HH:mm", "dd/MM/yy", "dd.MM.yyyy HH:mm", "dd-MM-yyyy")


def g07_date_layouts(spark, d):
    """Every order's date in one layout of the list, read back."""
    day, key = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey")
    def pick(layouts):
        chain = F.date_format(day, layouts[0])
        for i, layout in enumerate(layouts[1:], 1):
            chain = F.when(key % len(layouts) == i, F.date_format(day, layout)).otherwise(chain)
        return chain
    text = F.when((F.dayofmonth(day) > 12) & (key % 3 == 0), pick(DAY_FIRST)).otherwise(pick(LAYOUTS))
    return table(spark, d, "orders").select("o_orderkey", parse_date(text).cast("date").alias("day"))


def a04_default_na(spark, d):
    df = dataset(spark, d, "planted")
    return df.select(*[null_default_tokens(cleaning.named(c)).alias(c) for c in df.columns])


def a12_review_sink(spark, d):
    """Publishes the review of the planted table and reads its three tables back: each finding beside its column and the data set."""
    p, findings = found(spark, d)
    folder = fresh_path(spark, "review")
    sinks.write_review({"column_profile": p.columns, "dataset_profile": p.dataset, "findings": findings}, "planted", folder)
    back = sinks.read_review(spark, folder, "planted")
    columns = back["column_profile"].select(F.col("name").alias("column"), "null_count", "unique_count")
    return (back["findings"].join(columns, "column", "left").crossJoin(F.broadcast(back["dataset_profile"].select("rows", "duplicate_rows")))
            .select("severity", "kind", "rule_id", "column", "null_count", "unique_count", "rows", "duplicate_rows"))


def a11_result_sink(spark, d):
    path = fresh_path(spark, "result")
    orders = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    sinks.write_result(orders, path)
    return spark.read.csv(path, header=True, schema="o_orderstatus string, n bigint")


def fixed_silence(spark, d):
    """Mechanical findings per rule before and after every mechanical repair of the planted table."""
    df = dataset(spark, d, "planted")
    df = cleaning.drop_unnamed_columns(cleaning.drop_identical_columns(cleaning.drop_uninformative_columns(df)))
    df = cleaning.placeholders_to_null(df, ["Priority", "Amount"])
    df = cleaning.normalise_category(cleaning.strip_whitespace(df, ["Packed By"]), ["Priority"])
    df = cleaning.text_to_number(df, ["Amount", "Tax Share", "Crate Count", "Age Days"])
    df = cleaning.text_to_boolean(cleaning.text_to_date(df, ["Promised"]), ["Fragile"])
    p = Profile(materialize(df, "cleaned"), "cleaned", AS_OF, text=False)
    count = lambda findings, name: findings.where("kind = 'fix'").groupBy("rule_id").agg(F.count("*").alias(name))
    before, after = count(found(spark, d)[1], "n_before"), count(diagnose.diagnose(p), "n_after")
    return before.join(after, "rule_id", "full_outer").select(
        "rule_id", F.coalesce("n_before", F.lit(0)).cast("bigint").alias("n_before"), F.coalesce("n_after", F.lit(0)).cast("bigint").alias("n_after"))


SPECS: dict[str, tuple] = {
    "a01_csv_text_scan": round_trip("customer", ".csv", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")),
    "a03_tsv_text_scan": round_trip("supplier", ".tsv", ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")),
    "a01_csv_multi_line_scan": round_trip("documents", ".csv", ("doc_id", "text", "lang", "source", "n_chars"), multi_line=True),
    "a04_default_na": (a04_default_na, from_source("planted", changed(
        **{c: f'CASE WHEN "{c}" NOT IN {sql.words(fixed.DEFAULT_NA)} THEN "{c}" END' for c in sql.PLANTED_COLUMNS}))),
    "a05_header_repair": (a05_header_repair, """SELECT CAST(s_nationkey AS VARCHAR) AS nation, s_name AS name, CAST(s_suppkey AS VARCHAR) AS "name.2",
  CAST(s_acctbal AS VARCHAR) AS "name.1", s_name AS "Unnamed: 4" FROM supplier"""),
    "g30_repeated_names": (g30_repeated_names, "SELECT 'name' AS name, count(*) AS rows FROM supplier HAVING count(*) > 0"),
    "g07_date_layouts": (g07_date_layouts, "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"),
    "a11_result_sink": (a11_result_sink, "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1"),
    "a12_review_sink": (a12_review_sink, with_findings(
        "planted", 'SELECT severity, kind, rule_id, "column", null_count, n_distinct AS unique_count, whole.rows AS rows, whole.duplicate_rows AS duplicate_rows '
        'FROM findings LEFT JOIN (SELECT name, null_count, n_distinct FROM full_prof) ON "column" = name, whole')),
    "g01_placeholder_count": (_columns("planted", "name", "disguised_null_count"),
                              with_profile("planted", "SELECT name, disguised_null_count FROM full_prof")),
    "g02_placeholder_tokens": (g02_placeholder_tokens,
                               with_profile("planted", "SELECT name, unnest(tokens) AS token FROM full_prof WHERE len(tokens) > 0")),
    "g03_null_counts": (_columns("planted", "name", "count", "null_count", "null_pct"),
                        with_profile("planted", "SELECT name, n_held AS count, null_count, null_pct FROM full_prof")),
    "g04_distinct_counts": (_columns("planted", "name", "unique_count", "unique_pct"),
                            with_profile("planted", "SELECT name, n_distinct AS unique_count, unique_pct FROM full_prof")),
    "g05_parse_numbers": (g05_parse_numbers, from_source("planted", changed(
        **{c: sql.to_number(f'"{c}"') for c in ("Amount", "Tax Share", "Crate Count", "Priority")}))),
    "g06_numeric_share": (_columns("rare", "name", "numeric_parseable_pct"),
                          with_profile("rare", "SELECT name, numeric_parseable_pct FROM full_prof")),
    "g07_parse_dates": (g07_parse_dates, from_source("planted", changed(Promised=f"""CAST({sql.to_date('"Promised"')} AS DATE)"""))),
    "g08_date_share": (_columns("planted", "name", "date_parseable_pct"),
                       with_profile("planted", "SELECT name, date_parseable_pct FROM full_prof")),
    "g09_storage_label": (_columns("planted", "name", "stored_as"),
                          with_profile("planted", "SELECT name, stored_as FROM full_prof")),
    "g10_boolean_like": (_columns("planted", "name", "is_boolean_like"),
                         with_profile("planted", "SELECT name, is_boolean_like FROM full_prof")),
    "g11_semantic_type": (_columns("planted", "name", "inferred_type"),
                          with_profile("planted", "SELECT name, inferred_type FROM full_prof")),
    "g12_identifier_names": (g12_identifier_names, with_profile(
        "planted", f"""SELECT name, len(list_intersect(string_split_regex(lower(name), '[\\s_]+'),
  [{', '.join(sql.text(h) for h in fixed.IDENTIFIER_HINTS)}])) > 0 AS name_hints_id FROM full_prof""")),
    "g13_sample_values": samples("planted"),
    "g13_sample_values_typed": samples("customer"),
    "g14_whitespace": (_columns("planted", "name", "whitespace_count"),
                       with_profile("planted", "SELECT name, whitespace_count FROM full_prof")),
    "g15_collapsed_distinct": (_columns("planted", "name", "case_collapsed_unique"),
                               with_profile("planted", "SELECT name, case_collapsed_unique FROM full_prof")),
    "g16_top_values": (g16_top_values, with_profile("planted", "SELECT name, rank, value, n FROM ranked_tops WHERE rank <= 8",
                                                    TOP_SQL.strip().removeprefix(","))),
    "g17_mixed_types": (_columns("rare", "name", "mixed_type_count"),
                        with_profile("rare", "SELECT name, mixed_type_count FROM full_prof")),
    "g18_numeric_stats": (
        lambda s, d: profile_of(s, d, "planted").columns.where("stats IS NOT NULL").select(
            "name", *[stat(f) for f in STAT_FIELDS], "stats.zeros", "stats.negatives"),
        with_profile("planted", f"SELECT name, {STAT_SQL}, zeros, negatives FROM full_prof WHERE has_stats")),
    "g19_skewness": (
        lambda s, d: profile_of(s, d, "planted").columns.where("stats IS NOT NULL").select(
            "name", half_up(F.col("stats.skew"), 4).alias("skew")),
        with_profile("planted", f"SELECT name, {sql.up('skew', 4)} AS skew FROM full_prof WHERE has_stats")),
    "g20_histogram": (
        lambda s, d: profile_of(s, d, "planted").histogram.select(
            "name", "bin", half_up(F.col("lo"), 4).alias("lo"), half_up(F.col("hi"), 4).alias("hi"), "n"),
        with_profile("planted", f"""SELECT name, bin, {sql.up('min_x + (max_x - min_x) / 10 * bin', 4)} AS lo,
  {sql.up('min_x + (max_x - min_x) / 10 * (bin + 1)', 4)} AS hi, coalesce(n, 0) AS n
FROM (SELECT position, name, min_x, max_x, CAST(unnest(range(10)) AS INT) AS bin FROM full_prof WHERE has_stats AND n_number >= 5 AND min_x < max_x)
LEFT JOIN (SELECT position, CAST(least(floor((x - min_x) / (max_x - min_x) * 10), 9) AS INT) AS bin, count(*) AS n
  FROM cells JOIN full_prof USING (position) WHERE x IS NOT NULL AND has_stats AND min_x < max_x GROUP BY 1, 2) USING (position, bin)""")),
    "g21_g23_frequent_values": (
        lambda s, d: profile_of(s, d, "planted").frequent_values.select(
            "name", half_up(F.col("value"), 4).alias("value"), "n", half_up(F.col("gap"), 4).alias("gap")),
        with_profile("planted", f"SELECT name, {sql.up('value', 4)} AS value, n, {sql.up('gap', 4)} AS gap FROM frequent")),
    "g22_typical_gap": (lambda s, d: profile_of(s, d, "planted").columns.select(
                            "name", half_up(F.col("typical_value_gap"), 4).alias("typical_value_gap")),
                        with_profile("planted", f"SELECT name, {sql.up('typical_value_gap', 4)} AS typical_value_gap FROM full_prof")),
    "g24_date_stats": (g24_date_stats, with_profile("planted", """SELECT name, CAST(min_date AS DATE) AS min_date,
  CAST(max_date AS DATE) AS max_date, CAST(date_diff('day', min_date, max_date) AS INT) AS span_days, future_count
FROM full_prof WHERE inferred_type = 'datetime'""")),
    "g25_g31_dataset_profile": whole_table("planted"),
    "g27_duplicates_typed": (
        lambda s, d: profile_dataset.surplus_rows(table(s, d, "lineitem").unionByName(table(s, d, "lineitem").where("l_orderkey % 10 = 3"))),
        "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) "
        "+ (SELECT count(*) FROM lineitem WHERE l_orderkey % 10 = 3) AS duplicate_rows"),
    "g28_identical_columns": (g28_identical_columns, g28_identical_sql()),
    "g29_unnamed_columns": (g29_unnamed, "SELECT 'Unnamed: 6' AS name FROM orders HAVING count(*) > 0"),
    "g_profile_customer": whole_profile("customer"),
    "g_profile_orders": whole_profile("orders"),
    "g_profile_lineitem": whole_profile("lineitem"),
    "g_profile_events": whole_profile("events"),
    "g_profile_documents": whole_profile("documents"),
    "g_profile_planted": whole_profile("planted"),
    "g_profile_rare_defects": whole_profile("rare"),
    "h01_h22_findings_planted": findings_of("planted"),
    "h01_h22_findings_rare_defects": findings_of("rare"),
    "h01_h22_findings_clean_control": findings_of("control"),
    "h01_h22_findings_customer": findings_of("customer"),
    "h01_h22_findings_orders": findings_of("orders"),
    "h01_h22_findings_lineitem": findings_of("lineitem"),
    "h01_h22_findings_events": findings_of("events"),
    "h17_many_codes": (
        lambda s, d: diagnose.sentinel_hits(profile_of(s, d, "coded").numeric, profile_of(s, d, "coded").repeated_values,
                                            [fixed.SENTINEL_RATE]).drop("position"),
        with_profile("coded", "SELECT rate, name, value, n FROM hits", sql.hits([fixed.SENTINEL_RATE]))),
    "h23_h30_findings_listing": (h23_order, with_findings("planted", H23_SQL)),
    "h24_starting_points": (h24_starting_points, with_findings("planted", "").rstrip() + H24_SQL),
    "h24_usable_columns": (h24_usable, with_profile("planted", """SELECT position, name FROM full_prof
WHERE inferred_type IN ('numeric', 'datetime') AND null_pct < 20 ORDER BY position LIMIT 6""")),
    "h25_severity_counts": (h25_counts, with_findings("planted", f"""SELECT severity, count(*) AS n_findings,
  {sql.pct('count(*)', '(SELECT count(*) FROM findings)', 1)} AS pct_of_findings FROM findings GROUP BY 1""")),
    "h26_column_rollup": (h26_rollup, with_findings("planted", f"""SELECT position, name, stored_as, inferred_type, null_pct,
  n_distinct AS unique_count, coalesce(k, 0) AS n_issues, CASE w WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END AS worst_severity
FROM full_prof LEFT JOIN (SELECT "column" AS c, count(*) AS k, min({RANK}) AS w FROM findings GROUP BY 1) ON c = name""")),
    "h27_ledger": (h27_ledger, with_findings("planted", f"""SELECT 'planted' AS source, rows, columns, raw_bytes, missing_cells, total_cells,
  {sql.pct('missing_cells', 'total_cells')} AS missing_pct, duplicate_rows, {sql.pct('duplicate_rows', 'rows')} AS duplicate_row_pct,
  (SELECT count(*) FROM findings WHERE severity = 'high') AS n_high, (SELECT count(*) FROM findings WHERE severity = 'medium') AS n_medium,
  (SELECT count(*) FROM findings WHERE severity = 'low') AS n_low FROM whole""")),
    "h28_numeric_summary": (h28_numeric, with_profile(
        "planted", f"SELECT name, {STAT_SQL}, zeros, negatives FROM full_prof WHERE has_stats")),
    "h29_g32_category_breakdown": (h29_categories, with_profile("planted", f"""SELECT t.name, t.rank, t.value, t.n,
  {sql.pct('t.n', 'p.n_held', 1)} AS pct_of_values, greatest(p.n_distinct - 6, 0) AS n_more
FROM ranked_tops t JOIN full_prof p USING (position) WHERE t.rank <= 6 AND p.inferred_type = 'categorical'""",
                                                                 TOP_SQL.strip().removeprefix(","))),
    "i01_repeated_rows": (i01_list_repeated, from_source("planted", f"""SELECT {PLAIN} FROM planted
QUALIFY count(*) OVER (PARTITION BY {PLAIN}) > 1""")),
    "i01_drop_repeated_rows": (_clean(cleaning.drop_repeated_rows), from_source("planted", f"SELECT DISTINCT {PLAIN} FROM planted")),
    "i02_drop_identical_columns": (_clean(cleaning.drop_identical_columns), from_source("planted", "SELECT " + _sql_cols(
        *[c for c in sql.PLANTED_COLUMNS if c != "Lot Status"]) + " FROM planted")),
    "i03_drop_unnamed_columns": (_clean(cleaning.drop_unnamed_columns), from_source(
        "planted", "SELECT " + _sql_cols(*[c for c in sql.PLANTED_COLUMNS if c != "Unnamed: 6"]) + " FROM planted")),
    "i04_drop_uninformative_columns": (_clean(cleaning.drop_uninformative_columns), from_source("planted", "SELECT " + _sql_cols(
        *[c for c in sql.PLANTED_COLUMNS if c not in ("Depot", "Inspection Note", "Unnamed: 6")]) + " FROM planted")),
    "i05_placeholders_to_null": (
        _clean(lambda df: cleaning.placeholders_to_null(df, ["Priority", "Amount"])),
        from_source("planted", changed(**{c: f"""CASE WHEN NOT {sql.placeholder(f'"{c}"')} THEN "{c}" END""" for c in ("Priority", "Amount")}))),
    "i06_text_to_number": (
        _clean(lambda df: cleaning.text_to_number(df, ["Amount", "Tax Share"])),
        from_source("planted", changed(Amount=sql.to_number('"Amount"'), Tax_Share=sql.to_number('"Tax Share"')))),
    "i07_text_to_date": (
        _clean(lambda df: cleaning.text_to_date(df, ["Promised"]).withColumn("Promised", F.to_date("Promised"))),
        from_source("planted", changed(Promised=f'CAST({sql.to_date(chr(34) + "Promised" + chr(34))} AS DATE)'))),
    "i08_text_to_boolean": (
        _clean(lambda df: cleaning.text_to_boolean(df, ["Fragile"])), from_source("planted", changed(Fragile="\"Fragile\" = 'Y'"))),
    "i09_unparseable_values": (
        lambda s, d: cleaning.unparseable_values(dataset(s, d, "rare"), "grade"), from_source("rare", f"""SELECT grade AS value, count(*) AS n
FROM rare WHERE grade IS NOT NULL AND {sql.to_number('grade')} IS NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 20""")),
    "i10_normalise_category": (
        _clean(lambda df: cleaning.normalise_category(df, ["Priority"])),
        from_source("planted", changed(Priority=f'lower({sql.strip(chr(34) + "Priority" + chr(34))})'))),
    "i11_strip_whitespace": (
        _clean(lambda df: cleaning.strip_whitespace(df, ["Packed By"])),
        from_source("planted", changed(Packed_By=sql.strip('"Packed By"')))),
    "i12_describe_missing": (
        lambda s, d: cleaning.describe_missing(dataset(s, d, "planted"), "Age Days"), from_source("planted", " UNION ALL ".join(
            f"""SELECT (SELECT count(*) FROM gone) AS rows, {sql.text(c)} AS name, count("{c}") AS count, count(DISTINCT "{c}") AS "unique",
  (SELECT "{c}" FROM gone WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
  (SELECT count(*) FROM gone WHERE "{c}" IS NOT NULL GROUP BY "{c}" ORDER BY 1 DESC LIMIT 1) AS freq,
  min("{c}") AS min, max("{c}") AS max, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
  CAST(NULL AS DOUBLE) AS q1, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS q3 FROM gone"""
            for c in sql.PLANTED_COLUMNS if c != "Age Days"), """gone AS (SELECT * FROM planted WHERE "Age Days" IS NULL)""")),
    "i12_describe_missing_typed": (i12_typed, I12_TYPED_SQL),
    "i13_repeated_identifiers": (
        lambda s, d: cleaning.repeated_identifiers(dataset(s, d, "planted"), "Lot Ref"), from_source("planted", """SELECT "Lot Ref" AS value,
  count(*) AS n FROM planted GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, value LIMIT 20""")),
    "i14_negative_rows": (
        lambda s, d: cleaning.negative_rows(table(s, d, "customer"), "c_acctbal", ["c_custkey"]).select("c_custkey", "c_acctbal"),
        "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 20"),
    "i15_value_counts": (
        lambda s, d: cleaning.value_counts(dataset(s, d, "planted"), "Crate Count"), from_source("planted", """SELECT "Crate Count" AS value,
  count(*) AS n FROM planted WHERE "Crate Count" IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 15""")),
    "i15_sentinels_to_null": (
        _clean(lambda df: cleaning.sentinels_to_null(df, "Crate Count", [-4, 5000])), from_source("planted", changed(
            Crate_Count="""CASE WHEN "Crate Count" NOT IN ('-4', '5000') THEN "Crate Count" END"""))),
    "i16_outlier_rows": (i16_outliers, with_profile("planted", f"""SELECT {PLAIN} FROM planted, full_prof p WHERE p.name = 'Crate Count'
  AND (CAST("Crate Count" AS DOUBLE) < q1 - 1.5 * (q3 - q1) OR CAST("Crate Count" AS DOUBLE) > q3 + 1.5 * (q3 - q1))""")),
    "i17_future_rows": (
        _clean(lambda df: cleaning.future_rows(df, "Promised", AS_OF)), from_source(
            "planted", f"""SELECT {PLAIN} FROM planted WHERE {sql.to_date('"Promised"')} > TIMESTAMP '{AS_OF}'""")),
    "i18_pool_rare_categories": (
        lambda s, d: cleaning.pool_rare_categories(dataset(s, d, "rare"), "segment_code", 10),
        from_source("rare", f"""SELECT {_sql_cols(*[c for c in RARE_COLUMNS if c != 'segment_code'])},
  CASE WHEN segment_code IN (SELECT v FROM top) OR segment_code IS NULL THEN segment_code ELSE 'Other' END AS segment_code FROM rare""",
                    """top AS (SELECT segment_code AS v, count(*) AS n FROM rare WHERE segment_code IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, v LIMIT 10)""")),
    "i_fix_then_silence": (fixed_silence, with_findings(
        "planted", "SELECT rule_id, count(*) AS n_before, CAST(0 AS BIGINT) AS n_after FROM findings WHERE kind = 'fix' GROUP BY 1")),
    "j01_rate_sweep_flags": (
        lambda s, d: evaluate.flagged(swept(s, d)),
        sweep_sql('SELECT rate, dataset, name AS "column", value, n FROM flags')),
    "j02_column_scores": (lambda s, d: evaluate.column_scores(outcomes(s, d)), sweep_sql(
        f'SELECT rate, dataset, "column", {COUNTS_SQL} FROM judged GROUP BY ALL')),
    "j03_precision_recall": (lambda s, d: evaluate.sensitivity(outcomes(s, d)), sweep_sql(f""", s AS (SELECT rates.rate, {COUNTS_SQL}
  FROM rates LEFT JOIN judged USING (rate) GROUP BY 1)
SELECT rate, found, false_alarms, missed, {sql.up('found / nullif(found + false_alarms, 0)', 4)} AS precision,
  {sql.up('found / nullif(found + missed, 0)', 4)} AS recall FROM s""")),
    "j04_flag_detail": (lambda s, d: evaluate.flag_detail(outcomes(s, d)), sweep_sql(""", t AS (SELECT rate, dataset || ':' || "column" || '=' ||
  CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) || ' (' || CASE outcome WHEN 'found' THEN 'ok' ELSE 'FALSE POSITIVE' END || ')' AS line
  FROM judged WHERE outcome <> 'missed')
SELECT rate, string_agg(line, '; ' ORDER BY line) AS flags FROM t GROUP BY 1""")),
    "k01_k08_planted_table": (lambda s, d: dataset(s, d, "planted"), from_source("planted", f"SELECT {PLAIN} FROM planted")),
    "k_rare_defects_table": (lambda s, d: dataset(s, d, "rare"), from_source("rare", f"SELECT {_sql_cols(*RARE_COLUMNS)} FROM rare")),
    "k09_clean_control": (lambda s, d: dataset(s, d, "control"), from_source(
        "control", f"SELECT {_sql_cols(*sql.CONTROL_COLUMNS)} FROM control")),
}
