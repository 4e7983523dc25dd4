"""Reference SQL for the review queries: the same measures written row-wise, without a frequency table."""

from __future__ import annotations

from ledgerlens.functions import fixed

AS_OF = "2026-08-09"


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def up(x: str, digits: int) -> str:
    x = f"CAST(({x}) AS DOUBLE)"
    return f"(CASE WHEN abs({x}) * 1e{digits} < 4e15 THEN sign({x}) * floor(abs({x}) * 1e{digits} + 0.5) / 1e{digits} + 0.0 ELSE {x} END)"


def pct(a: str, b: str, digits: int = 2) -> str:
    return up(f"CAST(100.0 AS DOUBLE) * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", digits)


WS = text(fixed.WHITESPACE)
NUMBER = "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"


def strip(v: str) -> str:
    return f"trim({v}, {WS})"


def placeholder(v: str) -> str:
    norm = f"lower({strip(v)})"
    return f"({v} IS NOT NULL AND ({norm} = '' OR {norm} IN {words(fixed.PLACEHOLDERS)}))"


def to_number(v: str) -> str:
    bare = f"translate({v}, {text(fixed.NUMBER_MARKS + fixed.WHITESPACE)}, '')"
    signed = (f"CASE WHEN {bare} LIKE '(%)' AND length({bare}) > 2 "
              f"THEN '-' || substr({bare}, 2, length({bare}) - 2) ELSE {bare} END")
    return f"CASE WHEN regexp_full_match({signed}, '{NUMBER}') THEN TRY_CAST({signed} AS DOUBLE) END"


def to_date(v: str) -> str:
    t = strip(v)
    dashed = f"translate({t}, '/.', '--')"
    return (f"CASE WHEN regexp_full_match({t}, '[0-9]{{8}}') THEN try_strptime({t}, '%Y%m%d') "
            f"WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([ T].*)?') THEN TRY_CAST({t} AS TIMESTAMP) "
            f"WHEN regexp_full_match({t}, '[0-9]{{1,2}}[-/.][0-9]{{1,2}}[-/.][0-9]{{4}}') "
            f"THEN coalesce(try_strptime({dashed}, '%m-%d-%Y'), try_strptime({dashed}, '%d-%m-%Y')) END")


# Planted and control tables over orders; "copy" and o_orderkey give the row order.
PLANTED_COLUMNS = ("Inspection Note", "Lot Ref", "Priority", "Status", "Promised", "Amount", "Unnamed: 6", "Tax Share", "Crate Count",
                   "Age Days", "Fragile", "Depot", "Lot Status", "Packed By", "Scan Url")
CONTROL_COLUMNS = ("lot_id", "route", "rate", "booked", "pallets", "sealed")

STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Part' END"
PLANTED = f"""planted_once AS (SELECT o_orderkey, CAST(NULL AS VARCHAR) AS "Inspection Note",
  'L' || CASE WHEN o_orderkey % 40 = 9 THEN o_orderkey - 2 ELSE o_orderkey END AS "Lot Ref",
  CASE WHEN o_orderkey % 31 = 4 THEN 'tbd' WHEN o_orderkey % 83 = 6 THEN '?' ELSE CASE (o_orderkey + o_custkey) % 8
    WHEN 0 THEN upper(o_orderpriority[3:]) WHEN 1 THEN lower(o_orderpriority[3:]) WHEN 2 THEN ' ' || o_orderpriority[3:]
    WHEN 3 THEN o_orderpriority[3:] || ' ' ELSE list_reduce(list_transform(string_split(lower(o_orderpriority[3:]), ' '),
      lambda w: upper(w[1:1]) || w[2:]), lambda a, w: a || ' ' || w) END END AS "Priority",
  {STATUS} AS "Status",
  CASE WHEN o_orderkey % 139 = 0 THEN '2044-12-31' WHEN o_orderkey % 19 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Promised",
  CASE WHEN o_orderkey % 43 = 0 THEN 'n/a' ELSE '€' || format('{{:,}}', CAST(floor(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT))
    || '.' || lpad(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS "Amount",
  '' AS "Unnamed: 6", (o_custkey * 11 % 270) // 10 || '.' || o_custkey * 11 % 270 % 10 || '%' AS "Tax Share",
  CAST(CASE WHEN o_orderkey % 97 = 0 THEN -4 WHEN o_orderkey % 67 = 2 THEN 5000 ELSE o_orderkey % 14 + 1 END AS VARCHAR) AS "Crate Count",
  CAST(CASE WHEN o_orderkey % 8 = 3 THEN NULL WHEN o_orderkey % 199 = 1 THEN 1 WHEN o_orderkey % 293 = 5 THEN 400
    ELSE o_custkey * 17 % 41 + 30 END AS VARCHAR) AS "Age Days",
  CASE WHEN o_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS "Fragile", 'D1' AS "Depot", {STATUS} AS "Lot Status",
  CASE WHEN o_custkey % 2 = 0 THEN 'team ' || o_custkey % 6 || ' ' ELSE ' team ' || o_custkey % 6 END AS "Packed By",
  'lots/' || o_orderkey AS "Scan Url" FROM orders),
planted AS (SELECT *, 0 AS copy FROM planted_once UNION ALL SELECT *, 1 AS copy FROM planted_once WHERE o_orderkey % 37 = 0)"""

CONTROL = """control AS (SELECT o_orderkey, 0 AS copy, 'C' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS lot_id,
  o_orderpriority[3:] AS route, o_custkey * 7 % 60 + 3 || '.' || lpad(CAST(o_orderkey * 29 % 100 AS VARCHAR), 2, '0') AS rate,
  strftime(o_orderdate, '%Y-%m-%d') AS booked, CAST(o_orderkey * 5 % 23 + 1 AS VARCHAR) AS pallets,
  CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS sealed FROM orders)"""

CODED_COLUMNS = ("row_key", "reading")
CODED = """coded AS (SELECT o_orderkey, 0 AS copy, CAST(o_orderkey AS VARCHAR) AS row_key, CAST(CASE WHEN o_orderkey % 4 = 1
  THEN CASE WHEN o_orderkey // 4 % 75 < 5 THEN -5000 - o_orderkey // 4 % 75 * 10 ELSE 9000 + o_orderkey // 4 % 75 * 10 END
  ELSE o_custkey % 200 + 100 END AS VARCHAR) AS reading FROM orders)"""


def cells(source: str, columns) -> str:
    """One row per cell with everything that is judged cell by cell."""
    long = " UNION ALL ".join(
        f"SELECT {i} AS position, {text(c)} AS name, CAST(\"{c}\" AS VARCHAR) AS value FROM {source}"
        for i, c in enumerate(columns))
    return f"""long_cells AS ({long}),
marked AS (SELECT *, {strip('value')} AS stripped, lower({strip('value')}) AS norm, {placeholder('value')} AS placeholder FROM long_cells),
held_cells AS (SELECT *, value IS NOT NULL AND NOT placeholder AS held FROM marked),
cells AS (SELECT *, CASE WHEN held THEN {to_number('value')} END AS x, CASE WHEN held THEN {to_date('value')} END AS ts FROM held_cells)"""


def profile(stored: dict[int, str] | None) -> str:
    """Per-column measures; ``stored`` names the storage types of a typed table."""
    if stored is None:
        label = f"""CASE WHEN n_rows = n_null THEN 'float64'
  WHEN n_bool = n_rows THEN 'bool' WHEN n_int = n_rows THEN 'int64' WHEN n_float = n_rows - n_null THEN 'float64' ELSE 'str' END"""
    else:
        label = "CASE position " + " ".join(f"WHEN {i} THEN {text(t)}" for i, t in stored.items()) + " END"
    pairs = ", ".join(f"count(DISTINCT value) FILTER (WHERE held AND norm IN {words(p)})" for p in fixed.BOOLEAN_PAIRS)
    hints = " OR ".join(f"list_contains(string_split_regex(lower(name), '[\\s_]+'), {text(h)})" for h in fixed.IDENTIFIER_HINTS)
    text_like = "inferred_type IN ('categorical', 'text', 'identifier', 'boolean')"
    return f"""sums AS (SELECT position, any_value(name) AS name, count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_null,
  count(*) FILTER (WHERE placeholder) AS disguised_null_count,
  list_sort(list(DISTINCT norm) FILTER (WHERE placeholder)) AS tokens,
  count(*) FILTER (WHERE held) AS n_held, count(DISTINCT value) FILTER (WHERE held) AS n_distinct, count(x) AS n_number,
  count(ts) AS n_date, count(*) FILTER (WHERE held AND value <> stripped) AS n_edge,
  count(DISTINCT norm) FILTER (WHERE held) AS n_norm, CAST(sum(length(value)) FILTER (WHERE held) AS DOUBLE) AS n_chars,
  CAST(coalesce(sum(strlen(value)), 0) AS BIGINT) AS raw_bytes, count(DISTINCT x) AS n_number_values,
  count(*) FILTER (WHERE regexp_full_match(stripped, '[+-]?[0-9]+')) AS n_int,
  count(*) FILTER (WHERE regexp_full_match(stripped, '{NUMBER}')) AS n_float,
  count(*) FILTER (WHERE value IN {words(fixed.BOOLEAN_TEXT)}) AS n_bool, greatest({pairs}) AS n_in_pair,
  avg(x) AS mean, coalesce(stddev_samp(x), 0) AS std, min(x) AS min_x, quantile_cont(x, 0.25) AS q1, median(x) AS median,
  quantile_cont(x, 0.75) AS q3, max(x) AS max_x, count(*) FILTER (WHERE x = 0) AS zeros, count(*) FILTER (WHERE x < 0) AS negatives,
  CASE WHEN count(x) > 2 AND min(x) < max(x) THEN skewness(x) ELSE 0 END AS skew,
  min(ts) AS min_date, max(ts) AS max_date, count(*) FILTER (WHERE ts > TIMESTAMP '{AS_OF}') AS future_count
  FROM cells GROUP BY position),
shares AS (SELECT *, {label} AS stored_as, coalesce(n_number / nullif(n_held, 0), 0) AS number_share,
  n_held > 0 AND n_distinct <= 2 AND n_in_pair = n_distinct AS is_boolean_like,
  n_distinct / greatest(n_held, 1) AS uniqueness FROM sums),
dated AS (SELECT *, CASE WHEN number_share >= {fixed.PARSE_SHARE} THEN 0 ELSE coalesce(n_date / nullif(n_held, 0), 0) END AS date_share FROM shares),
typed AS (SELECT *, CASE WHEN n_held = 0 THEN 'empty' WHEN n_distinct = 1 THEN 'constant' WHEN is_boolean_like THEN 'boolean'
  WHEN date_share >= {fixed.PARSE_SHARE} THEN 'datetime' WHEN number_share >= {fixed.PARSE_SHARE} THEN 'numeric'
  WHEN uniqueness > 0.95 AND ({hints} OR n_distinct > 50) THEN 'identifier'
  WHEN n_distinct <= 25 OR uniqueness < 0.05 THEN 'categorical' WHEN n_chars / n_held > 40 THEN 'text'
  WHEN uniqueness < 0.5 THEN 'categorical' ELSE 'text' END AS inferred_type FROM dated),
prof AS (SELECT *, n_null + disguised_null_count AS null_count, {pct('n_null + disguised_null_count', 'n_rows')} AS null_pct,
  coalesce({pct('n_distinct', 'n_held')}, 0) AS unique_pct, CASE WHEN {text_like} THEN n_edge ELSE 0 END AS whitespace_count,
  CASE WHEN {text_like} THEN n_norm END AS case_collapsed_unique,
  {up('number_share', 4)} AS numeric_parseable_pct, {up('date_share', 4)} AS date_parseable_pct,
  CASE WHEN {text_like} AND number_share > 0.05 AND number_share < 0.95 THEN least(n_number, n_held - n_number) ELSE 0 END AS mixed_type_count,
  n_number > 0 AND (inferred_type = 'numeric' OR number_share >= {fixed.PARSE_SHARE}) AS has_stats,
  {text_like} AS text_like FROM typed),
freq AS (SELECT c.position, any_value(c.name) AS name, x, count(*) AS n FROM cells c JOIN prof p USING (position)
  WHERE p.has_stats AND x IS NOT NULL GROUP BY c.position, x),
steps AS (SELECT *, x - lag(x) OVER w AS below, lead(x) OVER w - x AS above FROM freq WINDOW w AS (PARTITION BY position ORDER BY x)),
gaps AS (SELECT position, CASE WHEN count(*) >= 3 THEN median(above) ELSE 0 END AS typical_value_gap FROM steps GROUP BY position),
repeated AS (SELECT s.position, s.name, s.x AS value, s.n, CASE WHEN p.n_number_values >= 3 THEN least(below, above) END AS gap, p.median
  FROM steps s JOIN prof p USING (position) WHERE s.n >= 3),
frequent AS (SELECT * FROM repeated QUALIFY row_number() OVER (PARTITION BY position ORDER BY abs(value - median) DESC, value) <= 60),
full_prof AS (SELECT prof.*, coalesce(typical_value_gap, 0) AS typical_value_gap FROM prof LEFT JOIN gaps USING (position))"""


def hits(rates, frequent: str = "repeated", prof: str = "full_prof") -> str:
    rate_rows = ", ".join(f"({r})" for r in rates)
    return f"""hits AS (SELECT CAST(r.rate AS DOUBLE) AS rate, f.name, f.value, f.n FROM {frequent} f JOIN {prof} p USING (position),
  (VALUES {rate_rows}) r(rate)
  WHERE p.has_stats AND q3 > q1 AND f.n >= greatest(3, r.rate * p.n_held)
    AND (f.value < q1 - 1.5 * (q3 - q1) OR f.value > q3 + 1.5 * (q3 - q1)
      OR (p.n_distinct <= 30 AND coalesce(f.gap > 0 AND p.typical_value_gap > 0 AND f.gap > 1.5 * p.typical_value_gap, false))))"""


def identical(source: str, columns, stored: dict[int, str] | None) -> str:
    """How many pairs of columns of one type agree in every row, counted by comparing all of them."""
    pairs = [(a, b) for j, b in enumerate(columns) for i, a in enumerate(columns[:j]) if not stored or stored[i] == stored[j]]
    agree = " + ".join(f'CAST(bool_and("{a}" IS NOT DISTINCT FROM "{b}") AND count("{a}") > 0 AS INTEGER)' for a, b in pairs) or "0"
    return f"(SELECT {agree} FROM {source})"


def whole(source: str, columns, identical: str) -> str:
    """The one-row dataset profile; ``columns`` are quoted names of the source."""
    names = ", ".join(f'"{c}"' for c in columns)
    unnamed = sum(1 for c in columns if not c.strip() or c.lower().startswith("unnamed:"))
    return f"""whole AS (SELECT (SELECT count(*) FROM {source}) AS rows, {len(columns)} AS columns,
  (SELECT CAST(sum(raw_bytes) AS BIGINT) FROM prof) AS raw_bytes,
  (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM {source})) AS duplicate_rows,
  (SELECT count(*) FROM {source}) * {len(columns)} AS total_cells, (SELECT CAST(sum(null_count) AS BIGINT) FROM prof) AS missing_cells,
  {identical} AS n_identical_pairs, {unnamed} AS n_unnamed_columns)"""


def findings() -> str:
    """Rules over ``full_prof``, ``whole`` and ``hits`` as (severity, kind, rule_id, column)."""
    stored = "stored_as IN ('str', 'string')"
    name_has = lambda hints: "(" + " OR ".join(f"contains(lower(name), {text(h)})" for h in hints) + ")"
    key_name = "(" + " OR ".join(
        f"list_contains(string_split_regex(lower(name), '[\\s_\\-]+'), {text(h)})" for h in fixed.KEY_WORDS) + ")"
    iqr = "q3 - q1"
    rules = [
        ("H7", "'high'", "fix", "disguised_null_count > 0"),
        ("H8", "'high'", "fix", f"{stored} AND numeric_parseable_pct >= 0.85"),
        ("H9", "'high'", "fix", f"{stored} AND inferred_type = 'datetime'"),
        ("H10", "'low'", "fix", f"{stored} AND is_boolean_like"),
        ("H11", "'medium'", "question", "mixed_type_count > 0"),
        ("H12", "'high'", "fix", "case_collapsed_unique < n_distinct"),
        ("H13", "'medium'", "fix", "NOT coalesce(case_collapsed_unique < n_distinct, false) AND whitespace_count > 0"),
        ("H14", "CASE WHEN null_pct >= 50 THEN 'high' WHEN null_pct >= 20 THEN 'medium' ELSE 'low' END", "question", "null_pct >= 5"),
        ("H15", "'high'", "question", f"(inferred_type = 'identifier' OR {key_name}) AND n_held > 0 AND n_distinct < n_held"),
        ("H16", "'high'", "question", f"has_stats AND negatives > 0 AND {name_has(fixed.NON_NEGATIVE_HINTS)}"),
        ("H17", "'medium'", "question", "name IN (SELECT name FROM hits)"),
        ("H18", "'low'", "question", "has_stats AND zeros / n_held > 0.25"),
        ("H19", "'low'", "question", f"has_stats AND abs(skew) > 2 AND {iqr} > 0 AND abs(mean - median) > 0.1 * ({iqr})"),
        ("H20", "'low'", "question", f"has_stats AND {iqr} > 0 AND (max_x > q3 + 1.5 * ({iqr}) OR min_x < q1 - 1.5 * ({iqr}))"),
        ("H21", "'medium'", "question", "inferred_type = 'datetime' AND future_count > 0"),
        ("H22", "'low'", "question", "inferred_type = 'categorical' AND n_distinct > 50"),
    ]
    per_column = [f"SELECT {sev} AS severity, '{kind}' AS kind, '{rid}' AS rule_id, name AS \"column\" FROM full_prof "
                  f"WHERE inferred_type NOT IN ('empty', 'constant') AND {cond}" for rid, sev, kind, cond in rules]
    per_column += ["SELECT 'medium', 'fix', 'H5', name FROM full_prof WHERE inferred_type = 'empty'",
                   "SELECT 'low', 'fix', 'H6', name FROM full_prof WHERE inferred_type = 'constant'"]
    whole_table = [("high", "question", "H1", "duplicate_rows > 0"), ("medium", "fix", "H2", "n_identical_pairs > 0"),
                   ("low", "fix", "H3", "n_unnamed_columns > 0"),
                   ("medium", "question", "H4", f"{pct('missing_cells', 'total_cells')} > 25")]
    per_table = [f"SELECT '{s}', '{k}', '{r}', NULL FROM whole WHERE {c}" for s, k, r, c in whole_table]
    return "findings AS (" + " UNION ALL ".join(per_column + per_table) + ")"
