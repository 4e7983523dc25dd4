from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import quality
from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.queries_sql import ORACLES
from tests.llm.helpers import ROWS, SF, no_rows, odd_rows
from tests.oracle_check import differences, duck


def plain_repeats(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)})


@pytest.mark.parametrize("text", ["", "a b c", "a b c a b c", "a a a a", "a b c d b c d e", "x y x y x y z", "one two three four"])
def test_repeated_words(text):
    assert quality.repeated_words(text.encode().split()) == plain_repeats(text.split())


def test_measures():
    m = dict(zip(quality.MEASURES, quality.measure("Äb #c|\n\nÄb #c|\n12 ☂ {}\r\n \x0b".encode())))
    assert m == {"n_words": 7, "word_chars": 15, "n_symbols": 4, "n_lines": 3, "n_dup_lines": 1, "n_repeat_words": 0,
                 "n_letterless": 2, "n_long_words": 0, "longest_word": 3}


def test_query_agrees_with_sql(spark):
    assert differences(QUERIES["op2_quality_rules"](spark, SF), duck(SF), ORACLES["op2_quality_rules"]) == []


def test_policies_and_ablation(spark):
    rows = quality.ledger(spark.read.parquet(f"{SF}/documents.parquet"))
    bits = [r.failed for r in rows.select("failed").collect()]
    full = quality.mask("v1")
    got = {r.rule: r for r in quality.ablation(rows, "v1").collect()}
    for name in quality.POLICIES["v1"]:
        one = quality.mask((name,))
        assert got[name].fails == sum(b & one != 0 for b in bits)
        assert got[name].kept_without == sum(b & full & ~one == 0 for b in bits)
    assert rows.filter(quality.passes(F.col("failed"), "v1")).count() == sum(b & full == 0 for b in bits)


def test_odd_rows(spark):
    out = quality.ledger(odd_rows(spark)).collect()
    assert len(out) == len(ROWS)
    assert {r.failed for r in out if r.doc_id in (4, 5, 6)} == {1}
    assert quality.ledger(no_rows(spark)).count() == 0
    kept = quality.keep(odd_rows(spark), "base")
    assert kept.columns == odd_rows(spark).columns
    assert kept.count() == 0  # all are short or repeat themselves
    assert quality.keep(odd_rows(spark), ("symbols",)).count() == len(ROWS)
