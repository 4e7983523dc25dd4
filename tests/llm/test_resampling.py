import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import resampling
from tests.llm.helpers import ROWS, SF, no_rows, odd_rows


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(rows, target, percent=5, seed=42):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in features(t)[1])

    s, t = counts([r[1] for r in rows]), counts(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000)))) for b in range(10_000)]
    out = []
    for name, text in rows:
        n, own = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in own)
        out.append([name, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_against_plain_version(spark):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    got = resampling.resample(docs, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sum(w[4] is not None for w in want) >= 5


def test_words_of_all_lengths_and_kinds():
    rnd = random.Random(2)
    texts = [" ".join("".join(rnd.choice("abzAZ09é漢 ") for _ in range(rnd.choice([1, 2, 7, 60, 300, 3000]))) + rnd.choice(["", "--", "\x7f{"])
                      for _ in range(rnd.randint(0, 30))) for _ in range(40)] + ["", None]
    shift = resampling.Shift()
    counts, runs = resampling.runs_of_words([t and t.encode() for t in texts], shift)
    want = [features(t) for t in texts]
    assert counts.tolist() == [n for n, _ in want]
    total = sum(np.bincount(r, minlength=resampling.BUCKETS + 1) for r in runs)[:-1]
    assert Counter({b: n for b, n in enumerate(total.tolist()) if n}) == Counter(zlib.crc32(f.encode()) % 10_000 for _, own in want for f in own)


def test_cut_with_ties_and_repeated_rows(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(7, text)] * 300 + [(None, text)] * 300 + [(i, f"{text} {i}") for i in range(100, 200)] + [(1, "short")] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    target = spark.createDataFrame([(text,)], "text string")
    for percent in (0, 1, 50, 100):
        got = sorted((tuple(r) for r in resampling.resample(df, target, percent=percent).collect()), key=str)
        want = plain(rows, [text], percent)
        assert [g[:4] for g in got] == [w[:4] for w in want]
        assert sorted((g[3], g[4]) for g in got if g[4]) == sorted((w[3], w[4]) for w in want if w[4])


def test_nth_smallest_over_the_whole_range(spark):
    values = [-(1 << 63), -5, -5, -5, 0, 3, 3, (1 << 63) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for n, v in enumerate(values, 1):
        assert resampling.nth_smallest(df, "v", n) == (v, sum(x < v for x in values), sum(x <= v for x in values))


def test_odd_rows(spark):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = sorted((tuple(r) for r in resampling.resample(odd_rows(spark), target, percent=50).collect()), key=str)
    want = plain([r[:2] for r in ROWS], [r.text for r in target.collect()], 50)
    assert [g[:4] for g in got] == [w[:4] for w in want] and sorted(g[4] or 0 for g in got) == sorted(w[4] or 0 for w in want)
    assert resampling.resample(no_rows(spark), target).count() == 0
    assert resampling.resample(odd_rows(spark), target.filter("false")).filter(F.col("weight") > 0).count() >= 0
