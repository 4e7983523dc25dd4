"""Word lists and constants whose content decides the results."""

# Cells a delimited-text reader turns into null (exact case, untrimmed).
DEFAULT_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Placeholder words, compared after trimming and lower-casing.
PLACEHOLDERS = (
    "n/a", "na", "n.a.", "none", "null", "nil", "-", "--", "?", "unknown",
    "not available", "not applicable", "missing", "tbd", "#n/a", "blank",
)

# Pairs of words that make a two-valued column a yes/no column.
BOOLEAN_PAIRS = (
    ("yes", "no"), ("y", "n"), ("true", "false"), ("t", "f"),
    ("1", "0"), ("male", "female"), ("active", "inactive"),
)

# A name containing one of these should hold no negative number.
NON_NEGATIVE_HINTS = (
    "age", "price", "cost", "amount", "revenue", "quantity", "qty", "count",
    "total", "salary", "income", "duration", "distance", "weight", "height",
    "stock", "balance", "score", "rating", "units",
)

# Whole words in a name that suggest an identifier (type guess).
IDENTIFIER_HINTS = ("id", "code", "key", "number", "no", "ref", "uuid", "guid")

# Whole words in a name that mark a key (uniqueness rule).
KEY_WORDS = ("id", "key", "code", "ref")

# Spellings read as boolean when a column holds nothing else.
BOOLEAN_TEXT = ("True", "TRUE", "true", "False", "FALSE", "false")

# Characters trimmed from the ends of text and dropped inside numbers.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Currency signs, thousands and percent marks ignored in numbers.
NUMBER_MARKS = "$£€₹¥,%"

# Thresholds of the review.
PARSE_SHARE = 0.85          # share of parseable values that decides a type
UNIQUE_SHARE = 0.95         # uniqueness above which a column may be an identifier
FEW_VALUES = 25             # at most this many distinct values: a category
RARE_SHARE = 0.05           # uniqueness below which a column is a category
LONG_TEXT = 40              # mean length above which a column is text
TOP_VALUES = 8
SAMPLE_VALUES = 5
HISTOGRAM_BINS = 10
FREQUENT_REPEATS = 3
FREQUENT_KEPT = 60
SENTINEL_RATE = 0.002
ISOLATION_DISTINCT = 30
FENCE = 1.5                 # interquartile ranges beyond the quartiles; also the gap factor
SWEEP_RATES = (0.001, 0.002, 0.003, 0.005, 0.008, 0.01, 0.015, 0.02, 0.03)

# Severity order and the ordinal of the score bands.
SEVERITIES = ("high", "medium", "low")
SEVERITY_BANDS = ("Min", "Mild", "Mod", "ModSev", "Sev")
SCORE_RANGES = {"todep": (0, 27), "tosc": (8, 48), "toas": (36, 180)}
