import math

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import vectors
from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.queries_sql import ORACLES
from tests.llm.helpers import SF
from tests.oracle_check import differences, duck


def plain(rows, asks, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(256 * x) for x in v]
    out = []
    for q in good:
        if asks(q):
            # Beyond 64 bits scores are the nearest 64-bit number, and so equal.
            scores = sorted((-max(-(1 << 63) + 1, min((1 << 63) - 1, sum(a * b for a, b in zip(good[q], good[i])))), i) for i in good if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, step, k):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "vec", "cell", "rank", "part")})
    return sorted(map(tuple, vectors.top_products(df, F.col("vec_id") % step == 0, k).collect()))


def test_query_agrees_with_sql(spark):
    assert differences(QUERIES["op8_top_k"](spark, SF), duck(SF), ORACLES["op8_top_k"]) == []


def test_clusters_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * 0.2 + 3 * np.eye(6)[i % 6] * (1 + i % 3)).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 0.5, 0.0, 0.0, 0.0]) for i in range(60)]  # one vector many times
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf"), 1.0]), (2004, []), (2005, [9.0]), (None, [1.0])]
    assert run(spark, rows, 5, 5) == plain(rows, lambda q: q % 5 == 0, 5)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, -1.0]), (50, [0.5, 2.0]), (51, [1e5, 1e5])]
    assert run(spark, rows, 50, 5) == plain(rows, lambda q: q % 50 == 0, 5)
    assert run(spark, [(0, [1.0])], 50, 5) == []
    assert run(spark, [(1, None)], 50, 5) == []


def test_large_components(spark):
    """Beyond 32 bits, beyond exact doubles, and beyond 64 bits in the product only."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3).round(3).tolist()) for i in range(60)]
    rows += [(100, [1e8, 1.0]), (150, [-1e8, 2.0, 1e8]), (151, [3e7, 1e5, -4e6]), (200, [5e12, 0.25]), (201, [0.0, 1.0, 7e14])]
    got = run(spark, rows, 50, 5)
    want = plain(rows, lambda q: q % 50 == 0, 5)
    assert got == want and any(i == 100 for _, _, i, _ in got)
