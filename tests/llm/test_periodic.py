import hashlib
import random
import zlib

import numpy as np

from ledgerlens.llm import periodic
from tests.llm.helpers import ROWS, SF, no_rows, odd_rows


def plain_runs(words):
    """Every period, from the least; a stretch that a smaller period explains is that period's."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(name, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(name).encode())
    g, n = h // 10, len(words)
    if name is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    best = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (name, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def strings():
    rnd = random.Random(5)
    for _ in range(600):
        letters = rnd.choice([b"a", b"ab", b"ab", b"abc", b"abcdefgh"])
        words = []
        while len(words) < rnd.choice([3, 14, 40, 120, 400]):
            piece = [bytes([rnd.choice(letters)]) for _ in range(rnd.randint(1, rnd.choice([3, 9, 40])))]
            words += piece * rnd.choice([1, 1, 2, 3, 7])
        yield words
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(9):  # Fibonacci strings are as full of runs as strings can be
        a, b = b, b + a
        yield b


def test_runs_against_every_period():
    texts = list(strings())
    transform = periodic.Transform()
    got = periodic.runs_of(texts, transform)
    for words, runs in zip(texts, got):
        assert runs == plain_runs(words), words
    alone = [periodic.runs_of([words], transform)[0] for words in texts[:100]]
    assert alone == got[:100]


def test_transform_is_exact():
    rnd, transform = np.random.default_rng(1), periodic.Transform()
    for size in (8, 64):
        a, b = (rnd.integers(0, periodic.PRIME, (3, size)).astype(np.uint64) for _ in range(2))
        got = transform.backward(transform.forward(a) * transform.forward(b) % periodic.P)
        for row in range(3):
            for k in range(size):
                assert int(got[row, k]) == sum(int(a[row, j]) * int(b[row, (k - j) % size]) for j in range(size)) % periodic.PRIME


def test_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in docs.select("doc_id", "text").collect() if len((r.text or "").split()) < 3000]
    got = {r.doc_id: tuple(r) for r in periodic.digests(periodic.periodic_runs(docs, planted=True)).collect()}
    assert len(got) == docs.count() and len(rows) > 150
    for r in rows:
        assert got[r.doc_id] == plain_row(r.doc_id, r.text)


def test_odd_rows(spark):
    out = periodic.periodic_runs(odd_rows(spark)).collect()
    assert len(out) == len(ROWS)
    by_id = {r.doc_id: r for r in out}
    assert [tuple(x) for x in by_id[7].runs] == [(0, 150_000, 5)] and by_id[7].collapsed == "lorem ipsum dolor sit amet"
    assert (by_id[7].start, by_id[7].length, by_id[7].period, by_id[7].exponent_milli) == (0, 150_000, 5, 30_000_000)
    assert by_id[4].n_runs == 0 and by_id[4].start is None and by_id[4].collapsed == "" and by_id[6].collapsed == ""
    planted = sorted((tuple(r) for r in periodic.digests(periodic.periodic_runs(odd_rows(spark).filter("length(text) < 9000 or text is null"), planted=True)).collect()), key=str)
    assert planted == sorted((plain_row(r[0], r[1]) for r in ROWS if len(r[1] or "") < 9000), key=str)
    assert periodic.periodic_runs(no_rows(spark)).count() == 0


def test_long_texts_of_few_words_take_little_time():
    rnd, transform = random.Random(3), periodic.Transform()
    for words in ([b"a"] * 300_000, [bytes([rnd.choice(b"ab")]) for _ in range(100_000)], [b"x", b"y", b"x", b"z"] * 60_000 + [b"q"] * 40_000):
        runs = periodic.runs_of([words], transform)[0]
        assert runs and max(n for _, n, _ in runs) >= (12 if len(words) == 100_000 else 240_000)
