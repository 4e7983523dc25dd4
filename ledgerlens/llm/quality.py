"""A ledger of quality rules: every rule is tried once, its outcome is a bit, policies are masks over the bits.

Measures and failure bits are kept for all documents, the good ones too, so a
new policy or an ablation needs no second pass over the texts.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column, fresh

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
#: Bytes that are not the first of a UTF-8 character.
CONTINUATION = bytes(range(0x80, 0xC0))
#: Letters and all that is not ASCII become "a", white space stays, the rest becomes ".".
KINDS = bytes(b if b in SPACE else ord("a") if b > 127 or chr(b).isalpha() else ord(".") for b in range(256))
#: A word of more bytes than this is no word.
LONG = 40

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letterless", "n_long_words", "longest_word")

#: Name and condition of each rule over the measures m; the bit is the place in this list and never changes.
RULES = (
    ("few_words", "m.n_words < 50"),
    ("repeated_windows", "100 * m.n_repeat_words > 50 * m.n_words"),
    ("symbols", "10 * m.n_symbols > m.n_words"),
    ("repeated_lines", "m.n_lines >= 4 and 100 * m.n_dup_lines > 50 * m.n_lines"),
    ("short_words", "2 * m.word_chars < 5 * m.n_words"),
    ("long_words", "m.word_chars > 14 * m.n_words"),
    ("no_letters", "100 * m.n_letterless > 40 * m.n_words"),
    ("unbroken_text", "100 * m.n_long_words > 10 * m.n_words"),
)
#: Rules of each policy version. A version is never edited; a change of mind is a new one.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words", "no_letters", "unbroken_text"),
}
LATEST = "v2"


def mask(policy: str | tuple[str, ...], policies: Mapping[str, tuple[str, ...]] = POLICIES) -> int:
    names = [n for n, _ in RULES]
    return sum(1 << names.index(n) for n in (policies[policy] if isinstance(policy, str) else policy))


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measures of one text; a null or empty text has zeros only.

    The windows of a long text are compared through exact codes: three word
    numbers of that text packed into one integer.
    """
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    n, packed = len(words), text.translate(None, SPACE)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letterless = sum(1 for w in text.translate(KINDS).split() if b"a" not in w)
    sizes = list(map(len, words))
    return (n, len(packed.translate(None, CONTINUATION)), len(text) - len(text.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
            repeated_words(words), letterless, sum(map(LONG.__lt__, sizes)), max(sizes, default=0))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text has twice or more, its first place included."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) < 1 << 21:
        code = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
    else:
        pair = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)[1]
        code = pair * len(number) + ids[2:]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(len(words), bool)
    for starts in (order[1:][same], order[:-1][same]):
        for k in range(3):
            covered[starts + k] = True
    return int(covered.sum())


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measures(text: pa.Array) -> pa.Array:
    rows = [measure(t) for t in text.cast(pa.binary()).to_pylist()]
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))], list(MEASURES))


def failures(m: str = "m") -> Column:
    """The failure bits as one number, from the struct column ``m`` of the measures."""
    total = F.lit(0).cast("bigint")
    for i, (_, rule) in enumerate(RULES):
        total = total.bitwiseOR(F.when(F.expr(rule.replace("m.", f"`{m}`.")), F.lit(1 << i)).otherwise(0).cast("bigint"))
    return total


def ledger(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: id, the measures and ``failed``, the bits of all rules.

    Null and empty texts have no words and fail ``few_words`` only. Repeated rows
    give repeated rows, a null id stays null, an empty table gives no rows;
    further columns are not read.
    """
    bounded_batches(df.sparkSession)
    m = df.select(column(id_column).alias("id"), measures(column(text_column)).alias("m"))
    return m.select(F.col("id").alias(id_column), "m.*", failures().alias("failed"))


def passes(failed: Column, policy: str | tuple[str, ...] = LATEST) -> Column:
    return failed.bitwiseAND(F.lit(mask(policy))) == 0


def ablation(rows: DataFrame, policy: str = LATEST) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail nothing else, and that stay without it.

    One aggregation over the bits; texts are not read again.
    """
    full = mask(policy)
    hit = F.col("failed").bitwiseAND(F.lit(full))
    counts = [F.count("*").alias("n"), F.count_if(hit == 0).alias("kept")]
    for name in POLICIES[policy]:
        bit = mask((name,))
        counts += [F.count_if(hit.bitwiseAND(F.lit(bit)) != 0).alias(f"{name}_fails"), F.count_if(hit == bit).alias(f"{name}_only")]
    one = rows.agg(*counts)
    return one.select("n", "kept", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"{name}_fails").alias("fails"), F.col(f"{name}_only").alias("fails_only_this"))
        for name in POLICIES[policy]])).alias("r")).select("r.*", (F.col("kept") + F.col("r.fails_only_this")).alias("kept_without"), "kept", "n")


def keep(df: DataFrame, policy: str = LATEST, text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that pass a policy, with its columns as they were."""
    bounded_batches(df.sparkSession)
    m = fresh(df, "measured")
    # Not deterministic, so that the filter reads the column instead of measuring a second time.
    whole = df.withColumn(m, measures.asNondeterministic()(column(text_column)))
    return whole.filter(passes(failures(m), policy)).drop(m)
