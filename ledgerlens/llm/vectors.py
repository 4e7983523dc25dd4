"""Exact top-k inner products with a pivot-distance index.

Inner products become distances: with M the largest norm, x' = (x, sqrt(M*M - x*x))
and q' = (q, 0) have the squared distance q*q + M*M - 2 * q*x, so the highest
product is the least distance. Every vector is keyed by its nearest pivot and its
distance to it; sorted by this key the table is cut into blocks, each of them an
annulus around one pivot. A query first meets the annuli around its own key, which
gives a bound on its k-th distance. Then it meets those annuli whose distances to
their pivot differ from the query's by no more than the bound: by the triangle
inequality no other one can hold a better vector.

Queries go in blocks as well, and a task multiplies one block with the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, bounded_sample, column, shuffle_partitions
from ledgerlens.session import materialize

SCALE = 256.0
#: Pivots are the centres of a sample of so many rows; the index holds all rows.
SAMPLE, PIVOTS, ROUNDS = 1024, 48, 5
BLOCK = 1024
#: Part of a distance that rounding may take.
MARGIN = 1e-6

QUANTISED = T.StructType([T.StructField("id", T.LongType()), T.StructField("vec", T.BinaryType()),
                          T.StructField("square", T.DoubleType()), T.StructField("size", T.IntegerType())])
KEYED = T.StructType([T.StructField("id", T.LongType()), T.StructField("vec", T.BinaryType()),
                      T.StructField("cell", T.IntegerType()), T.StructField("dist", T.DoubleType())])
BLOCKS = T.StructType([T.StructField("block", T.StringType()), T.StructField("cell", T.IntegerType()), T.StructField("near", T.DoubleType()),
                       T.StructField("far", T.DoubleType()), T.StructField("ids", T.BinaryType()), T.StructField("vecs", T.BinaryType())])
FOUND = T.StructType([T.StructField("query", T.LongType()), T.StructField("id", T.LongType()), T.StructField("score", T.LongType())])


def packed(x: np.ndarray) -> bytes:
    """Whole numbers given as doubles: one byte for the kind, then 32-bit integers, or doubles if one is too large for these."""
    small = not len(x) or np.abs(x).max() < 2.0 ** 31
    return b"i" + x.astype("<i4").tobytes() if small else b"d" + x.astype("<f8").tobytes()


def unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(body, "<i4" if body[:1] == b"i" else "<f8", offset=1).astype(np.float64)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers; one beyond 64 bits becomes the nearest 64-bit number."""
    norm = max((x * x).sum(1).max(initial=0.0) for x in (a, b))
    if norm < 2.0 ** 52:  # products of doubles are exact up to there, and no partial sum is larger
        return (a @ b.T).astype(np.int64)
    if norm < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, NO_SCORE + 1, (1 << 63) - 1).astype(np.int64)


def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components as whole numbers without trailing zeros, so that equal vectors have equal bytes."""
    for batch in batches:
        ids, vecs, squares, sizes = [], [], [], []
        for i, v in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist()):
            if i is None or v is None or any(x is None for x in v):
                continue
            x = np.floor(SCALE * np.asarray(v, np.float64))
            if not np.isfinite(x @ x):
                continue
            used = np.flatnonzero(x)
            x = x[:used[-1] + 1] if len(used) else x[:0]
            ids.append(i)
            vecs.append(packed(x))
            squares.append(float(x @ x))
            sizes.append(len(x))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(squares, pa.float64()), pa.array(sizes, pa.int32())],
                                         names=QUANTISED.names)


def rows_of(vecs: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(vecs), dim))
    for r, v in enumerate(vecs):
        x = unpacked(v)
        out[r, :len(x)] = x
    return out


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """x' of each row; ``most`` is the largest squared norm."""
    return np.column_stack([x, np.sqrt(np.maximum(0.0, most - (x * x).sum(1)))])


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2.0 * (x @ pivots.T)
    return np.sqrt(np.maximum(0.0, square))


def centres(x: np.ndarray) -> np.ndarray:
    """A few rounds of k-means over the sample, from rows that lie evenly in it."""
    pivots = x[np.linspace(0, len(x) - 1, min(PIVOTS, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        own = distances(x, pivots).argmin(1)
        for k in range(len(pivots)):
            if (own == k).any():
                pivots[k] = x[own == k].mean(0)
    return pivots


def keyed(rows: DataFrame, pivots: np.ndarray, dim: int, most: float, lift: bool) -> DataFrame:
    """Adds the nearest pivot and the distance to it; queries are not lifted."""
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = rows_of(batch.column("vec").to_pylist(), dim)
                d = distances(lifted(x, most) if lift else np.column_stack([x, np.zeros(len(x))]), pivots)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(cell.astype(np.int32)),
                                                  pa.array(d[np.arange(len(d)), cell])], names=KEYED.names)

    return rows.select("id", "vec").mapInArrow(key, KEYED)


def blocks(rows: DataFrame, dim: int, per_cell: bool, label: str) -> DataFrame:
    """Rows sorted by (cell, distance) over the cluster and cut into blocks; inside a block they follow the id."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int, float]] = []
        number = 0

        def closed(part: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            near, far = min(h[3] for h in held), max(h[3] for h in held)
            held.sort(key=lambda h: h[0])
            row = {"block": [f"{part}-{number}"], "cell": [held[0][2]], "near": [near], "far": [far],
                   "ids": [np.array([h[0] for h in held], "<i8").tobytes()], "vecs": [packed(rows_of([h[1] for h in held], dim).ravel())]}
            held.clear()
            return pa.RecordBatch.from_pydict(row, pa.schema([("block", pa.string()), ("cell", pa.int32()), ("near", pa.float64()),
                                                              ("far", pa.float64()), ("ids", pa.binary()), ("vecs", pa.binary())]))

        part = 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "vec", "cell", "dist"))):
                if held and (len(held) >= BLOCK or per_cell and held[0][2] != row[2]):
                    yield closed(part)
                held.append(row)
        if held:
            yield closed(part)

    n = shuffle_partitions(rows.sparkSession)
    return materialize(rows.repartitionByRange(n, "cell", "dist", "id").sortWithinPartitions("cell", "dist", "id")
                       .select(F.spark_partition_id().alias("part"), "*").mapInArrow(cut, BLOCKS), label)


def products(pairs: DataFrame, index: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """(query, id, score) of the k best of each query in each pair of blocks, none below the query's ``least`` score."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q_vecs, q_least, ids, vecs in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "q_vecs", "q_least", "ids", "vecs"))):
                names, own = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                scores = exact_products(unpacked(q_vecs).reshape(len(names), dim), unpacked(vecs).reshape(len(own), dim))
                best = np.argsort(~scores, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(scores, best, 1)
                good = value >= np.frombuffer(q_least, "<i8")[:, None]
                row = np.nonzero(good)[0]
                yield pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(own[best[good]]), pa.array(value[good])], names=FOUND.names)

    side = queries.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"), F.col("least").alias("q_least"))
    return (pairs.join(index.select("block", "ids", "vecs"), "block").join(side, "q_block")
            .select("q_ids", "q_vecs", "q_least", "ids", "vecs").mapInArrow(multiply, FOUND))


REACH = T.StructType([T.StructField("q_block", T.StringType()), T.StructField("cell", T.IntegerType()),
                      T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())])


def reach(queries: DataFrame, pivots: np.ndarray, dim: int, most: float, own_only: bool) -> DataFrame:
    """For each block of queries and pivot, the distances to the pivot between which better vectors may lie.

    With ``own_only`` it is the queries' own distances to their nearest pivots.
    """
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, vecs, least in zip(*(batch.column(c).to_pylist() for c in ("block", "vecs", "least"))):
                x = unpacked(vecs).reshape(-1, dim)
                d = distances(np.column_stack([x, np.zeros(len(x))]), pivots)
                floor = np.frombuffer(least, "<i8").astype(np.float64)
                if own_only:
                    nearest = d.argmin(1)
                    cells = np.unique(nearest)
                    low, high = (np.array([f(d[nearest == c, c]) for c in cells]) for f in (np.min, np.max))
                else:
                    r = np.sqrt(np.maximum(0.0, (x * x).sum(1) + most - 2.0 * floor))
                    r = np.where(floor <= NO_SCORE, np.inf, r)[:, None]
                    slack = MARGIN * (d + np.sqrt(most) + 1.0)
                    cells, low, high = np.arange(len(pivots)), (d - r - slack).min(0), (d + r + slack).max(0)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells)), pa.array(cells.astype(np.int32)), pa.array(low), pa.array(high)], names=REACH.names)

    return queries.select("block", "vecs", "least").mapInArrow(spans, REACH)


NO_SCORE = -(1 << 63)


def with_least(queries: DataFrame, found: DataFrame | None, k: int) -> DataFrame:
    """Adds ``least``: for each query of a block the score it has to reach, so far the k-th best found."""
    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            columns["least"] = []
            for ids, known in zip(columns["ids"], columns.pop("known")):
                own = {e["query"]: e["floor"] for e in known or ()}
                columns["least"].append(np.array([own.get(i, NO_SCORE) for i in np.frombuffer(ids, "<i8").tolist()], "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in BLOCKS.names), pa.array(columns["least"], pa.binary())], names=[*BLOCKS.names, "least"])

    schema = T.StructType([*BLOCKS.fields, T.StructField("least", T.BinaryType())])
    if found is None:
        known = queries.withColumn("known", F.lit(None).cast("array<struct<query:bigint,floor:bigint>>"))
    else:
        # At most BLOCK entries to a block, one for each of its queries.
        floors = found.groupBy("q_block").agg(F.collect_list(F.struct("query", "floor")).alias("known"))
        known = queries.join(floors, F.col("block") == F.col("q_block"), "left").drop("q_block")
    return known.mapInArrow(lowest, schema)


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(df: DataFrame, queries: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest integer inner product with each query, but itself.

    ``queries`` says which rows are queries. Components become floor(256 * x).
    Equal scores go to the smaller id. Shorter vectors count as filled up with
    zeros. Vectors that are null, hold a null or a component that is not finite, or
    have a square beyond a double (components of 1e150) take no part, nor do rows
    without an id. A score beyond 64 bits is given as the nearest 64-bit number.
    Components beyond 32 bits make the bounds wide and the arithmetic slow, but
    exact. Rows that repeat an id
    and vector count once, and no row is a partner of its own id. An empty table
    gives no rows; further columns are not read.

    Of equal vectors only the k + 1 smallest ids can be among a query's k, so the
    index holds no more of each, and equal query vectors are searched for once.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    source = df.select(column(id_column).cast("bigint").alias("id"), column(vector_column).alias("vector"), queries.alias("asks"))
    rows = materialize(source.select("id", "vector").mapInArrow(quantise, QUANTISED).distinct(), "vectors")
    asking = rows.join(source.filter("asks").select("id").distinct(), "id", "left_semi").select("id", "vec")
    facts = rows.agg(F.max("square").alias("most"), F.max("size").alias("size")).first()
    if facts["most"] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    most, dim = facts["most"], max(1, facts["size"])
    sample = bounded_sample(rows, "id", SAMPLE).select("vec").collect()
    pivots = centres(lifted(rows_of([bytes(r["vec"]) for r in sample], dim), most))

    place = Window.partitionBy("vec").orderBy("id")
    leading = rows.withColumn("n", F.row_number().over(place)).filter(F.col("n") <= k + 1)
    index = blocks(keyed(leading, pivots, dim, most, True), dim, True, "index")
    classes = materialize(asking.groupBy("vec").agg(F.min("id").alias("id")), "asked")
    asked = blocks(keyed(classes, pivots, dim, most, False), dim, False, "queries")

    annuli = index.select("block", F.col("cell").alias("of_cell"), "near", "far")

    def pairs(spans: DataFrame) -> DataFrame:
        return spans.join(annuli, (F.col("cell") == F.col("of_cell")) & (F.col("far") >= F.col("low")) & (F.col("near") <= F.col("high"))).select("q_block", "block").distinct()

    start = with_least(asked, None, k)
    first = materialize(pairs(reach(start, pivots, dim, most, True)), "first")
    found = materialize(best(products(first, index, start, dim, k + 1), k + 1), "found")
    member = asked.select(F.col("block").alias("q_block"), F.col("ids"))
    floors = found.filter(F.col("rank") == k + 1).select("query", F.col("score").alias("floor"))
    named = exploded(member).join(floors, "query")
    bounded = materialize(with_least(asked, named, k), "bounded")
    rest = pairs(reach(bounded, pivots, dim, most, False)).join(first, ["q_block", "block"], "left_anti")
    every = best(found.drop("rank").unionByName(products(rest, index, bounded, dim, k + 1)), k + 1)
    lists = every.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))  # k + 1 entries at most
    answers = asking.join(classes.withColumnRenamed("id", "query"), "vec").select(F.col("id").alias("query_id"), "query").join(lists, "query")
    return (answers.select("query_id", F.posexplode(F.slice(F.filter("best", lambda b: b.getField("id") != F.col("query_id")), 1, k)).alias("p", "b"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").alias("score")))


def exploded(member: DataFrame) -> DataFrame:
    """(q_block, query) from the packed ids of the blocks."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, ids in zip(batch.column("q_block").to_pylist(), batch.column("ids").to_pylist()):
                own = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(own)), pa.array(own)], names=["q_block", "query"])

    return member.mapInArrow(unpack, "q_block string, query bigint")
