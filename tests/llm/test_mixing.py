from collections import defaultdict

import pytest

from ledgerlens.llm import mixing
from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.queries_sql import ORACLES
from tests.llm.helpers import LONG, ROWS, SF, no_rows, odd_rows
from tests.oracle_check import differences, duck


def targets(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE):
    """Capping and resharing as the rule says it, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, budget = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        left = budget - sum(capped.values())
        got = {s: left * w[s] / sum(w[x] for x in open_) for s in open_} if open_ else {}
        above = [s for s in open_ if got[s] > 2 * sizes[s]]
        if not above:
            return capped | got
        capped |= {s: 2.0 * sizes[s] for s in above}


def check(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size
    for s, t in targets(dict(sizes)).items():
        mine = next(r for r in rows if r.source == s)
        assert mine.source_size == sizes[s] and mine.target == pytest.approx(t) and abs(taken[s] - t) <= 1
    times = [t for r in rows for t in (r.position, r.again) if t is not None]
    assert all(0 <= t <= 1 for t in times)


def test_query_agrees_with_sql(spark):
    out = QUERIES["op4_mixing"](spark, SF)
    assert differences(out, duck(SF), ORACLES["op4_mixing"]) == []
    check(out.collect(), None)


def test_positions_follow_the_schedule(spark):
    """Up to time t a source has given t + slope * (t * t - t) of its words, to a document's size."""
    rows = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).filter("taken > 0").collect()
    slope = dict(zip(sorted({r.source for r in rows}), [mixing.SLOPES[i % 3] for i in range(99)]))
    for s in slope:
        own = sorted((r.position, r.size) for r in rows if r.source == s)
        given = 0
        for t, size in own:
            wanted = next(r.target for r in rows if r.source == s) * (t + slope[s] * (t * t - t))
            if given < sum(x for _, x in own):
                assert abs(wanted - given) <= 1.5
            given += size


def test_no_python_in_the_plan(spark):
    plan = mixing.training_stream(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_odd_rows(spark):
    out = mixing.mix(odd_rows(spark)).collect()
    assert len(out) == len(ROWS)
    check(out, None)
    assert {r.taken for r in out if r.doc_id in (4, 5, 6)} == {0}
    assert mixing.mix(no_rows(spark)).count() == 0
    stream = mixing.training_stream(odd_rows(spark))
    assert stream.columns == odd_rows(spark).columns
    rows = [r.text for r in stream.collect()]
    assert LONG in rows or any(LONG.startswith(t) for t in rows)


def test_stream_gives_the_words_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    given = defaultdict(int)
    for r in mixing.training_stream(docs).select("doc_id", "text").collect():
        given[r.doc_id] += len(r.text.encode().split())
    assert dict(given) == taken
