"""Maximal periodic runs of words, found by exact convolution of blocks at dyadic scales.

A run of period q and length L holds a stretch of L - q words that come again q
places on. So a block of b words on a grid of step b lies in that stretch if it
has 2b - 1 words or more, and comes again at distance q. At scale b the periods
from 2b - 1 to 4b - 2 are looked for (at the least scale, 2, those from 1): the
sum of squared differences between block and window is zero at just those
distances. It is a sum of squares, by prefix sums, less twice a correlation, by
number-theoretic transform modulo a prime. The distances seed extensions, which
compare words, so a sum that is a multiple of the prime does no harm.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column

LEAST_LENGTH = 12
#: 3 * 2**30 + 1: products of two residues fit 64 unsigned bits, transforms may have 2**30 places. 5 generates its units.
PRIME, GENERATOR = 3221225473, 5
P = np.uint64(PRIME)
#: Numbers in one matrix of transforms.
AT_ONCE = 1 << 20
#: Texts are taken together up to this many bytes; a longer text comes alone.
TOGETHER = 2 << 20


class Transform:
    """Number-theoretic transform of the rows of a matrix, modulo ``PRIME``; powers of the roots are kept."""

    def __init__(self) -> None:
        self.roots: dict[tuple[int, bool], np.ndarray] = {}

    def powers(self, half: int, inverse: bool) -> np.ndarray:
        found = self.roots.get((half, inverse))
        if found is None:
            root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
            if inverse:
                root = pow(root, -1, PRIME)
            found = np.ones(half, np.uint64)
            have = 1
            while have < half:
                found[have:2 * have] = found[:have] * np.uint64(pow(root, have, PRIME)) % P
                have *= 2
            self.roots[half, inverse] = found
        return found

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """Results come in bit-reversed order, which products place by place do not mind."""
        m, n = rows.shape
        half = n // 2
        while half:
            pairs = rows.reshape(m, -1, 2, half)
            a, b = pairs[:, :, 0], pairs[:, :, 1]
            rows = np.empty_like(pairs)
            rows[:, :, 0] = (a + b) % P
            rows[:, :, 1] = (a + P - b) % P * self.powers(half, False) % P
            half //= 2
        return rows.reshape(m, n)

    def backward(self, rows: np.ndarray) -> np.ndarray:
        """Takes bit-reversed order, gives natural order."""
        m, n = rows.shape
        half = 1
        while half < n:
            pairs = rows.reshape(m, -1, 2, half)
            a, b = pairs[:, :, 0], pairs[:, :, 1] * self.powers(half, True) % P
            rows = np.empty_like(pairs)
            rows[:, :, 0] = (a + b) % P
            rows[:, :, 1] = (a + P - b) % P
            half *= 2
        return rows.reshape(m, n) * np.uint64(pow(n, -1, PRIME)) % P


def zero_distances(x: np.ndarray, blocks: np.ndarray, b: int, transform: Transform) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of the blocks of ``b`` numbers at ``blocks`` that come again at a distance of this scale.

    ``x`` goes on for 5b places behind the last block.
    """
    low = 1 if b == 2 else 2 * b - 1
    places, distances = [], []
    per = max(1, AT_ONCE // (4 * b))
    for at in range(0, len(blocks), per):
        own = blocks[at:at + per, None]
        window = x[own + low + np.arange(4 * b)]
        block = np.zeros((len(own), 4 * b), np.uint64)
        block[:, :b] = x[own + np.arange(b)][:, ::-1]
        products = transform.backward(transform.forward(window) * transform.forward(block) % P)[:, b - 1:5 * b - 2 - low]
        sums = np.zeros((len(own), 4 * b + 1), np.uint64)
        np.cumsum(window * window % P, axis=1, out=sums[:, 1:])
        there = sums[:, b:][:, :products.shape[1]] - sums[:, :products.shape[1]]
        here = (block * block % P).sum(axis=1, keepdims=True)
        i, d = np.nonzero((here + there) % P == 2 * products % P)
        places.append(own[i, 0])
        distances.append(d + low)
    return np.concatenate(places), np.concatenate(distances)


def first_difference(x: np.ndarray, i: int, d: int, step: int) -> int:
    """How many places from ``i`` on, in direction ``step``, agree with the places ``d`` further on. Both ends of ``x`` agree with nothing."""
    n, size = 0, 16
    while True:
        if step > 0:
            a, b = x[i + n:i + n + size], x[i + d + n:i + d + n + size]
            a = a[:len(b)]
        else:
            top = i - n + 1
            a, b = x[max(0, top - size):top][::-1], x[max(0, top - size) + d:top + d][::-1]
        unlike = np.flatnonzero(a != b)
        if len(unlike):
            return n + int(unlike[0])
        if len(a) < size:
            return n + len(a)
        n += size
        size *= 2


def find_runs(x: np.ndarray, ends: np.ndarray, transform: Transform) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of the texts laid end to end in ``x``, by start, then period.

    ``ends`` are the texts' ends; a number that comes nowhere else stands at each,
    so no run reaches over it. ``x`` starts at 1, so that zeros behind it are like nothing.
    """
    n = len(x)
    order = np.argsort(x, kind="stable")
    again = np.full(n, np.iinfo(np.int64).max)
    same = x[order[1:]] == x[order[:-1]]
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]
    longest = int(np.diff(ends, prepend=0).max(initial=0))
    runs: dict[tuple[int, int], int] = {}
    # For each place the end and period of the run found first, so the one of the least period.
    run_end, run_period = np.zeros(n, np.int64), np.ones(n, np.int64)
    b = 2
    while 2 * (1 if b == 2 else 2 * b - 1) <= longest:
        high = 4 * b - 2
        padded = np.concatenate([x.astype(np.uint64), np.zeros(6 * b, np.uint64)])
        # A block goes on only if each of its words comes again within the window. It need not if one run holds block and window
        # and has a period of at most b: another run there would share d + b words with it, and so its period.
        near = again[:n // b * b].reshape(-1, b).max(axis=1) <= high
        blocks = np.flatnonzero(near) * b
        blocks = blocks[(run_end[blocks] < blocks + high + b) | (run_period[blocks] > b)]
        if len(blocks):
            places, distances = zero_distances(padded, blocks, b, transform)
            stretch = (0, 0)  # distance and end of the stretch compared last
            for k in np.lexsort((places, distances)):
                i, d = int(places[k]), int(distances[k])
                if (run_end[i] >= i + d + b and d % run_period[i] == 0) or (stretch[0] == d and i < stretch[1]):
                    continue
                right = first_difference(x, i, d, 1)
                stretch = d, i + right
                if right < b:
                    continue
                left = first_difference(x, i - 1, d, -1) if i else 0
                start, end = i - left, i + right + d
                if end - start >= max(LEAST_LENGTH, 2 * d) and (start, end) not in runs:
                    runs[start, end] = d
                    own = slice(start, end)
                    longer = run_end[own] == 0
                    run_period[own][longer] = d
                    run_end[own][longer] = end
        b *= 2
    return sorted((s, e, q) for (s, e), q in runs.items())


def number_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 1 for the words of all texts end to end, each text followed by a number of its own, and the places of these."""
    number: dict[bytes, int] = {}
    for words in texts:
        for w in words:
            number.setdefault(w, len(number) + 1)
    ends = np.cumsum([len(words) + 1 for words in texts]) - 1
    x = np.zeros(int(ends[-1]) + 1, np.int64)
    x[ends] = len(number) + 1 + np.arange(len(texts))
    for words, end in zip(texts, ends):
        x[end - len(words):end] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return x, ends


def runs_of(texts: list[list[bytes]], transform: Transform) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    x, ends = number_words(texts)
    for start, end, period in find_runs(x, ends, transform):
        t = int(np.searchsorted(ends, start))
        first = int(ends[t - 1]) + 1 if t else 0
        out[t].append((start - first, end - start, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stay when of each run only its first period does, joined by a space."""
    kept, done = [], 0
    for a, b in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[done:a]
        done = max(done, b)
    return b" ".join(kept + words[done:])


def repeat_tail(words: list[bytes], name: int | None) -> list[bytes]:
    """Of one text in ten, told by its id, the words from some place on repeat their first few ones: runs to be found."""
    h = zlib.crc32(str(name).encode()) if name is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def to_runs(planted: bool):
    """A function for mapInArrow: id, number and text become the id, the runs and the collapsed text."""
    one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transform = Transform()
        for batch in batches:
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            names = batch.column("name").to_pylist()
            runs: list[list[tuple[int, int, int]]] = []
            texts: list[bytes] = []
            at = 0
            while at < len(raw):
                own, held = [], 0
                while at < len(raw) and (not own or held + len(raw[at] or b"") <= TOGETHER):
                    words = (raw[at] or b"").split()
                    own.append(repeat_tail(words, names[at]) if planted else words)
                    held += len(raw[at] or b"")
                    at += 1
                found = runs_of(own, transform)
                runs += found
                texts += map(collapsed, own, found)
            arrays = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(one))
            yield pa.RecordBatch.from_arrays([batch.column("id"), arrays, pa.array(texts, pa.binary()).cast(pa.string())], names=["id", "runs", "collapsed"])

    return rows


def periodic_runs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", planted: bool = False) -> DataFrame:
    """One row per row of ``df``: id, n_runs, the longest run's start, length, period and exponent_milli, all ``runs``, ``collapsed``.

    A run has a least period q, max(12, 2q) words or more, and no neighbouring word
    that keeps the period; places are numbers of words from 0. Of runs of equal
    length the first, then that of the least period is the longest. ``runs`` come
    by start and period. ``collapsed`` is the text's words without those behind
    the first period of any run, joined by one space. Null and empty texts and
    texts of fewer than 12 words have no runs and nulls. ``planted`` first writes
    runs into one text of ten, told by whole-number ids; a null id tells none.
    Repeated rows give repeated rows, an empty table gives none, further columns
    are not read. Texts are read whole.
    """
    bounded_batches(df.sparkSession)
    ids = column(id_column)
    given = df.select(ids.alias("id"), (ids.cast("bigint") if planted else F.lit(None).cast("bigint")).alias("name"), column(text_column).alias("text"))
    runs = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
    found = given.mapInArrow(to_runs(planted), T.StructType([given.schema["id"], T.StructField("runs", runs), T.StructField("collapsed", T.StringType())]))
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS back, -r.period AS least)))")
    return found.withColumn("best", best).select(
        F.col("id").alias(id_column), F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.least")).alias("period"),
        F.expr("1000 * best.length div -best.least").alias("exponent_milli"), "runs", "collapsed")


def digests(rows: DataFrame) -> DataFrame:
    """``runs`` and ``collapsed`` become SHA-256 digests: of one line ``start,length,period`` for each run, and of the text."""
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return rows.withColumn("runs_sha256", F.sha2(lines, 256)).withColumn("collapsed_sha256", F.sha2("collapsed", 256)).drop("runs", "collapsed")
