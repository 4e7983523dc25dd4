"""Reading meaning out of text: placeholders, tolerant numbers and dates, storage labels."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ledgerlens.functions import fixed

NUMBER_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_SHAPE = r"(?i)^[+-]?inf(inity)?$"
INTEGER_SHAPE = r"^[+-]?[0-9]+$"


def strip(v: Column) -> Column:
    """Trim every kind of whitespace; plain ``trim`` would keep tabs and wide spaces."""
    return F.btrim(v, F.lit(fixed.WHITESPACE))


def normal_form(v: Column) -> Column:
    return F.lower(strip(v))


def is_placeholder_norm(norm: Column) -> Column:
    """The placeholder test on text already in normal form; false for null."""
    return F.coalesce((norm == "") | norm.isin(*fixed.PLACEHOLDERS), F.lit(False))


def is_placeholder(v: Column) -> Column:
    """Non-null text that stands for a missing value, blanks included."""
    return is_placeholder_norm(normal_form(v))


def null_default_tokens(v: Column) -> Column:
    """What a delimited-text reader makes null: an exact match with the token list."""
    return F.when(~v.isin(*fixed.DEFAULT_NA), v)


def parse_number(v: Column) -> Column:
    """Text to double, ignoring currency signs, separators and percent marks.

    ``(x)`` reads as ``-x``; a percentage keeps its printed size. The shape test
    keeps out spellings such as ``1d`` that a plain cast would take.
    """
    return bare_to_number(bare_number(v))


def bare_number(v: Column) -> Column:
    """Text without the characters a number may carry along."""
    return F.translate(v, fixed.NUMBER_MARKS + fixed.WHITESPACE, "")


def bare_to_number(bare: Column) -> Column:
    bracketed = bare.startswith("(") & bare.endswith(")") & (F.length(bare) > 2)
    signed = F.when(bracketed, F.regexp_replace(bare, r"^\((.*)\)$", "-$1")).otherwise(bare)
    return F.when(signed.rlike(NUMBER_SHAPE) | signed.rlike(INFINITY_SHAPE), signed.try_cast("double"))


def parse_date(v: Column) -> Column:
    """Text to timestamp from a closed list of layouts, month first when ambiguous."""
    return stripped_to_date(strip(v))


WEEKDAY = r"(?:(?i:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?)\.?,? +)?"
_MONTH, _DAY, _YEAR = r"(?<name>[A-Za-z]{3})[a-z]*\.?", r"(?<d>[0-9]{1,2})(?:st|nd|rd|th)?", r"(?<y>[0-9]{4}|[0-9]{2})"
#: The layouts of a day. Fields: year, month, day, two numbers of which the first is the month if it can be, a month's name.
DAYS = (
    r"(?<y>[0-9]{4})(?<m>[0-9]{2})(?<d>[0-9]{2})(?:T(?<H>[0-9]{2})(?<M>[0-9]{2})(?<S>[0-9]{2})?)?",
    r"(?<y>[0-9]{4})[-/.](?<m>[0-9]{1,2})[-/.](?<d>[0-9]{1,2})",
    r"(?<y>[0-9]{4})(?:-(?<m>[0-9]{1,2}))?",
    rf"(?<a>[0-9]{{1,2}})[-/.](?<b>[0-9]{{1,2}})[-/.]{_YEAR}",
    rf"{_MONTH}[ -]{_DAY},?[ -]{_YEAR}",
    rf"{_DAY}[ -]{_MONTH},?[ -]{_YEAR}",
    rf"{_MONTH},?[ -](?<y>[0-9]{{4}})",
)
#: Hour, minute, second, fraction, half of the day, and distance from Greenwich.
CLOCK = (r"(?:,? +|T)(?<H>[0-9]{1,2}):(?<M>[0-9]{1,2})(?::(?<S>[0-9]{1,2})(?:\.(?<f>[0-9]{1,6})[0-9]*)?)? ?(?<half>[AaPp][Mm])?"
         r"(?: ?(?:Z|UTC|GMT|(?<sign>[+-])(?<zh>[0-9]{2}):?(?<zm>[0-9]{2})?))?")
FIELDS = ("y", "m", "d", "a", "b", "name", "H", "M", "S", "f", "half", "sign", "zh", "zm")
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def numbered(pattern: str) -> tuple[str, str]:
    """The pattern with plain groups, and the replacement that lines its fields up with bars between them.

    Alternatives have groups of the same name; the group that took no part gives nothing.
    """
    names = re.findall(r"\(\?<([A-Za-z]+)>", pattern)
    line = "|".join("".join(f"${i}" for i, n in enumerate(names, 1) if n == field) for field in FIELDS)
    return re.sub(r"\(\?<[A-Za-z]+>", "(", pattern), line


ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
DATE, DATE_FIELDS = numbered(f"^{WEEKDAY}(?:{'|'.join(DAYS)})(?:{CLOCK})?$")


def stripped_to_date(text: Column) -> Column:
    """The date layouts on text without edge whitespace: a day alone, with a clock time, or with a weekday in front.

    One pattern takes the text apart, and the timestamp is made of its numbers.
    Text of any length may be a date; most text fails at its first characters.
    The fields are bound once as the argument of a function: written out at every
    use they would make generated code too long to compile. Functions of this kind
    are interpreted, so the commonest layout is left to Spark's own reader.
    """
    fields = F.split(F.regexp_replace(text, DATE, DATE_FIELDS), r"\|")
    return F.when(text.rlike(ISO_DAY), text.try_cast("timestamp")).when(
        text.rlike(DATE), F.get(F.transform(F.array(fields), _fields_to_date), F.lit(0)))


def _fields_to_date(fields: Column) -> Column:
    """The timestamp of the fields that DATE found; all but the name and the signs are a few digits or empty.

    A failed ``try_cast`` raises and catches an error inside Spark, which costs
    more than all the rest. So a zero in front makes an empty field a number, and
    what no calendar has is left out before a timestamp is made of it.
    """
    part = lambda name: F.get(fields, F.lit(FIELDS.index(name)))
    number = lambda name: F.concat(F.lit("0"), part(name)).cast("int")
    given = lambda name: F.when(part(name) != "", number(name)).otherwise(F.lit(1))
    # A year without its century lies from 1969 to 2068.
    year = number("y") + F.when(F.length(part("y")) > 2, 0).when(number("y") >= 69, 1900).otherwise(2000)
    at = F.instr(F.lit(MONTHS), F.lower(part("name")))
    month = (F.when(part("name") != "", F.when(at % 3 == 1, ((at + 2) / 3).cast("int")))
             .when(part("a") != "", F.when(number("a") <= 12, number("a")).otherwise(number("b"))).otherwise(given("m")))
    day = F.when(part("a") != "", F.when(number("a") <= 12, number("b")).otherwise(number("a"))).otherwise(given("d"))
    half = F.lower(part("half"))
    hour = F.when(half == "pm", number("H") % 12 + 12).when(half == "am", number("H") % 12).otherwise(number("H"))
    # A sixtieth second would be taken for the next minute.
    second = F.when(number("S") < 60, F.concat(F.lit("0"), part("S"), F.lit("."), part("f"), F.lit("0")).cast("decimal(16,6)"))
    likely = month.between(1, 12) & day.between(1, 31) & (hour < 24) & (number("M") < 60)
    made = F.when(likely, F.try_make_timestamp(year, month, day, hour, number("M"), second))
    ahead = (number("zh") * 60 + number("zm")) * F.when(part("sign") == "-", -60).otherwise(60)
    return F.timestamp_micros(F.unix_micros(made) - ahead.cast("bigint") * 1_000_000)


def parse_boolean(v: Column) -> Column:
    norm = normal_form(v)
    return F.when(norm.isin("yes", "y", "true"), True).when(norm.isin("no", "n", "false"), False)


def looks_boolean(v: Column) -> Column:
    return v.isin(*fixed.BOOLEAN_TEXT)
