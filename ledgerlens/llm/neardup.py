"""MinHash near-duplicates with tensored banding, every link confirmed on the full shingle sets.

A table's key joins one key from each of two small collections, so HALVES keys
of two minhashes on either side give HALVES * HALVES tables of four minhashes
from 4 * HALVES instead of 4 * HALVES * HALVES hash functions. Two texts of
similarity s miss each other with probability of about 2 * (1 - s * s) ** HALVES:
7e-5 at 0.85.

Members of a bucket are not paired with each other. Each is compared with two
members that stand for the bucket, and the links found are joined to components.
Documents of buckets that still hold several components then meet one document
more in each of a few rounds: one of the largest component that shares the longest
key with them. What is left is settled by an exact search, a prefix filter over
the shingles that occur in more than one component: two linked sets of different
components share one of the rarest of these near their front, whatever the
bucket's size. Of the pairs it finds, a few of each document are confirmed first,
and the others only if they still lie in different components. So no bucket is
cut, and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column, fresh
from ledgerlens.llm.components import connected
from ledgerlens.session import materialize

HALVES = 8
HASHES = 4 * HALVES
#: Ways in which the ids are ordered to choose the members that stand for a bucket.
ORDERS = 2
#: Further rounds at most, and the lengths of the keys by which each of them looks for a partner.
ROUNDS, LENGTHS = 4, (3, 4, 5, 6, 8, 10, 12, 14, 16)
#: Partners of a document that the exact search confirms before all others.
FIRST = 8
#: Words that a Python worker remembers the hash of, and shingles that are hashed at once.
CACHED, AT_ONCE = 1 << 20, 1 << 14
#: The map that thins out the texts to be read again has so many numbers of 64 bits, whatever the input.
MAP_WORDS = 1 << 18

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_draw = np.random.default_rng(20240229)
MULTIPLY = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


WORDS = WordHash()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * M3
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a text of fewer words is one shingle, one without words none."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    w = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    n = len(w) - width + 1
    h = w[:n].copy()
    for k in range(1, width):
        h = (h ^ (h >> np.uint64(31))) * M1 + w[k:k + n]
    return np.unique(mixed(h * M2))


def minhashes(sets: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, ~np.uint64(0))
    for k in range(0, len(sets), AT_ONCE):
        part = sets[k:k + AT_ONCE] * MULTIPLY[:, None]
        part += ADD[:, None]
        np.minimum(least, part.min(1), out=least)
    return least


HALF_NAMES = [f"{side}{i}" for side in "ab" for i in range(HALVES)]
LONGS = ["n", "lo", "hi", *HALF_NAMES]
SKETCH = T.StructType([T.StructField(c, T.LongType()) for c in ("row", "doc")] + [T.StructField(c, T.LongType()) for c in LONGS])


def digest(sets: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128(sets.tobytes()).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def sketcher(width: int):
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((batch.num_rows, len(LONGS)), np.int64)
            for r, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                s = shingles(text, width)
                if not len(s):
                    continue
                m = minhashes(s)
                rows[r, 0] = len(s)
                rows[r, 1:3] = digest(s)
                rows[r, 3:] = mixed(m[0::2] * M1 + m[1::2]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc"), *(pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(LONGS)))],
                                             names=SKETCH.names)

    return sketches


SETS = T.StructType([T.StructField(c, T.LongType()) for c in ("id", "n")] + [T.StructField("shingles", T.ArrayType(T.LongType()))])


def set_reader(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(offsets).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=SETS.names)

    return read


def thinned(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` (row, text) whose key is in ``ids`` (id).

    A bit map of fixed size goes to all tasks first and keeps most other texts out
    of the shuffle; the join settles what it lets through.
    """
    def marked(df: DataFrame, name: str) -> DataFrame:
        h = F.xxhash64(F.lit(7), F.col(name))
        return df.withColumn("slot", F.pmod(h, F.lit(MAP_WORDS))).withColumn("place", F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int"))

    bit = F.expr("shiftleft(1L, place)")
    bits = marked(ids, "id").groupBy("slot").agg(F.bit_or(bit).alias("bits"))
    kept = marked(docs, "row").join(F.broadcast(bits), "slot").filter(F.col("bits").bitwiseAND(bit) != 0).select("row", "text")
    return kept.join(ids, F.col("row") == F.col("id"), "left_semi")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(f"{side}_id"), F.col("n").alias(f"{side}_n"), F.col("shingles").alias(f"{side}_set")),
                           F.col(side) == F.col(f"{side}_id"))
    both = pairs.withColumn("both", F.size(F.array_intersect("a_set", "b_set")))
    return both.filter(100 * F.col("both") >= percent * (F.col("a_n") + F.col("b_n") - F.col("both"))).select("a", "b").distinct()


def pivoted(reps: DataFrame) -> DataFrame:
    """(bucket, id, first, second): members of buckets of two or more, with the two that stand for the bucket.

    They are the first and the last member in an order of the ids that a mask
    gives, one of ORDERS masks by the low bits of the bucket's key. So a group that
    fills many buckets is compared with few of its members, but not with one only.
    """
    keys = F.array(*[F.xxhash64(F.lit(i * HALVES + j), F.col(f"a{i}"), F.col(f"b{j}"))
                     for i in range(HALVES) for j in range(HALVES)])
    tables = reps.select(F.col("rep").alias("id"), F.explode(keys).alias("bucket"))
    masked = F.xxhash64(F.lit(3), F.col("bucket").bitwiseAND(F.lit(ORDERS - 1)))
    ends = tables.groupBy("bucket").agg(F.min(F.col("id").bitwiseXOR(masked)).alias("first"), F.max(F.col("id").bitwiseXOR(masked)).alias("second"))
    several = ends.filter("first <> second").select(
        "bucket", F.col("first").bitwiseXOR(masked).alias("first"), F.col("second").bitwiseXOR(masked).alias("second"))
    return tables.join(several, "bucket")


def unsettled(members: DataFrame, components: DataFrame) -> DataFrame:
    """(id, component) of all members of buckets that hold more than one component."""
    own = members.select("bucket", "id").join(components, "id")
    open_ = own.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return own.join(open_.select("bucket"), "bucket", "left_semi").select("id", "component").distinct()


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` (id, component) after more links (a, b) between ids of it. Only components are joined to each other, so it is a small graph."""
    if links.isEmpty():
        return components
    ends = links
    for side in "ab":
        ends = ends.join(components.select(F.col("id").alias(f"{side}_of"), F.col("component").alias(f"{side}_component")), F.col(side) == F.col(f"{side}_of"))
    moved = connected(ends.select(F.col("a_component").alias("a"), F.col("b_component").alias("b")).filter("a <> b").distinct())
    moved = moved.select(F.col("id").alias("old"), F.col("component").alias("new"))
    return materialize(components.join(moved, F.col("component") == F.col("old"), "left").select("id", F.coalesce("new", "component").alias("component")), "components")


def partners(rest: DataFrame, keys: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b): each of ``rest`` (id, component) with a member of the largest component among those that share its longest key.

    A key is the first few of all half keys, in an order that the round's
    ``number`` gives: the longer it is, the more alike are those that share it.
    """
    order = np.random.default_rng(number).permutation(HALF_NAMES).tolist()
    sizes = rest.groupBy("component").agg(F.count("*").alias("size"))
    sized = rest.join(sizes, "component").join(keys, "id")
    long = sized.select("id", "component", "size", F.posexplode(F.array(*[F.xxhash64(F.lit(k), *order[:k]) for k in LENGTHS])).alias("length", "key"))
    stands = F.min(F.struct((-F.col("size")).alias("size"), F.xxhash64(F.lit(number), "id").alias("h"), F.col("id").alias("p"), F.col("component").alias("of")))
    found = long.join(long.groupBy("key").agg(stands.alias("m"), F.count("*").alias("c")).filter("c > 1"), "key").filter("m.of <> component")
    return (found.groupBy("id").agg(F.max_by("m.p", "length").alias("p"))
            .select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct())


def across(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may be linked, an exact prefix filter: seeker, its component, other, its component, shared shingles.

    Shingles are ordered by how many of the sets have them, those of a single
    component before all others. A set of n shingles and a linked one share a
    shingle among the first n - ceil(n * percent / 100) + 1, and the first one
    they share leaves enough places behind it for the overlap they need. Within a
    shingle's list only members outside its commonest component seek partners.
    """
    rows = sets.join(groups, "id").select("id", "n", "component", F.explode("shingles").alias("shingle"))
    counts = (rows.groupBy("shingle").agg(F.count("*").alias("c"), F.min("component").alias("low"), F.max("component").alias("high"))
              .filter("low <> high").select("shingle", "c"))
    behind = F.dense_rank().over(Window.partitionBy("id").orderBy(F.desc("c"), F.desc("shingle")))
    prefix = materialize(
        rows.join(counts, "shingle").withColumn("place", F.col("n") - behind + 1)
        .filter(F.expr(f"place <= n - ceil(n * {percent} / 100.0) + 1")).select("shingle", "id", "component", "n", "place").distinct(), "prefixes")
    common = (prefix.groupBy("shingle", "component").agg(F.count("*").alias("c"))
              .groupBy("shingle").agg(F.max_by("component", "c").alias("common"), F.count("*").alias("kinds")).filter("kinds > 1"))
    seekers = prefix.join(common, "shingle").filter("component <> common").select(
        "shingle", *[F.col(c).alias(f"x_{c}") for c in ("id", "component", "n", "place")])
    fits = F.expr(f"""component <> x_component and 100 * least(n, x_n) >= {percent} * greatest(n, x_n)
        and (100 + {percent}) * (1 + least(n - place, x_n - x_place)) >= {percent} * (n + x_n)""")
    return seekers.join(prefix, "shingle").filter(fits).groupBy("x_id", "x_component", "id", "component").agg(F.count("*").alias("shared"))


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x_id", "id").alias("a"), F.greatest("x_id", "id").alias("b")).distinct()


def settled(found: DataFrame, components: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``components`` joined by all links among the pairs ``found`` by the exact search.

    First each seeker's best pair and some drawn by hash are confirmed. That joins
    most of what belongs together, and only pairs of what is still apart go on.
    """
    if found.isEmpty():
        return components
    choices = [F.max_by("id", "shared"), *[F.min_by("id", F.xxhash64(F.lit(k), "id", "x_id")) for k in range(1, FIRST)]]
    first = found.groupBy("x_id").agg(F.array_distinct(F.array(*choices)).alias("ids")).select("x_id", F.explode("ids").alias("id"))
    joined = merged(components, materialize(confirmed(ordered_pairs(first), sets, percent), "links"))
    moved = components.withColumnRenamed("component", "old").join(joined, "id").filter("old <> component").select("old", F.col("component").alias("new")).distinct()
    apart = found
    for side in ("x_component", "component"):
        apart = apart.join(moved.select(F.col("old").alias(f"{side}_old"), F.col("new").alias(f"{side}_new")), F.col(side) == F.col(f"{side}_old"), "left")
    apart = apart.filter(F.coalesce("x_component_new", "x_component") != F.coalesce("component_new", "component"))
    return merged(joined, materialize(confirmed(ordered_pairs(apart), sets, percent), "links"))


def components_of(reps: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, component) of every class of ``reps`` that shares a bucket with another; an id is the key of the row that stands for the class."""
    members = materialize(pivoted(reps), "members")
    ids = members.select("id").distinct()
    pairs = (members.select("id", F.explode(F.array("first", "second")).alias("p")).filter("id <> p")
             .select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct())
    sets = materialize(thinned(docs, ids).mapInArrow(set_reader(shingle), SETS), "sets")
    components = merged(ids.withColumn("component", F.col("id")), materialize(confirmed(pairs, sets, percent), "links"))
    rest = materialize(unsettled(members, components), "unsettled")
    keys = materialize(reps.join(rest, F.col("rep") == F.col("id"), "left_semi").select(F.col("rep").alias("id"), *HALF_NAMES), "keys")
    for number in range(ROUNDS):
        links = materialize(confirmed(partners(rest, keys, number), sets, percent), "links")
        if links.isEmpty():
            break
        components = merged(components, links)
        rest = components.join(keys, "id", "left_semi")
    found = materialize(across(sets, unsettled(members, components), percent), "found")
    return settled(found, components, sets, percent)


def placed_rows(keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """row, doc, n, component_id and the component's first row, for each row of ``keyed`` (row, doc, text), a written table with keys of its own.

    The first row has the least id, null last, and of these the least key. Rows
    without words are components of their own.
    """
    sketch = materialize(keyed.mapInArrow(sketcher(shingle), SKETCH), "sketches")
    # Of two ids the lesser comes first, an id before none, and of equal ids the lesser key.
    rank = F.struct(F.col("doc").isNull().alias("none"), F.col("doc").alias("doc"), F.col("row").alias("row"))
    reps = materialize(sketch.filter("n > 0").groupBy("lo", "hi").agg(
        F.min(rank).alias("first"), *[F.first(c).alias(c) for c in HALF_NAMES]).withColumn("rep", F.col("first.row")), "classes")
    components = components_of(reps, keyed.select("row", "text"), shingle, percent)
    known = materialize(reps.select("lo", "hi", "first", "rep").join(components, F.col("rep") == F.col("id"), "left")
                        .select("lo", "hi", "first", F.coalesce("component", "rep").alias("component")), "known")
    firsts = known.groupBy("component").agg(F.min("first").alias("least"))
    node = known.select(F.col("lo").alias("of_lo"), F.col("hi").alias("of_hi"), "component").join(firsts, "component")
    placed = sketch.select("row", "doc", "n", "lo", "hi").join(node, (F.col("lo") == F.col("of_lo")) & (F.col("hi") == F.col("of_hi")) & (F.col("n") > 0), "left")
    return placed.select("row", "doc", "n", F.when(F.col("n") > 0, F.col("least.doc")).otherwise(F.col("doc")).alias("component_id"),
                         F.when(F.col("n") > 0, F.col("least.row")).otherwise(F.col("row")).alias("first_row"))


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_shingles, component_id, kept, stays.

    Rows are linked if 100 * intersection >= percent * union of their shingle
    sets; the component is the least id that links lead to, itself included, and
    ``kept`` tells the rows that have that id. Null and empty texts, and those
    without words, have no shingles, are linked with nothing and stay. Equal sets
    are one node from the start, so any number of copies costs one. Rows without
    an id are linked like others; a component of such rows only has a null id.
    Repeated rows of one id have one component and are all ``kept``. ``stays`` is
    true for exactly one row of each component: one of the least id, or any one
    where no row has an id. Rows of one id with different texts are linked only
    if their texts are. An empty table gives no rows; further columns are not read.
    """
    bounded_batches(df.sparkSession)
    keyed = materialize(df.select(F.monotonically_increasing_id().alias("row"), column(id_column).cast("bigint").alias("doc"), column(text_column).alias("text")), "keyed")
    return placed_rows(keyed, shingle, percent).select(
        F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"), (F.col("row") == F.col("first_row")).alias("stays"))


def one_of_each(df: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one of each component, with its columns as they were."""
    bounded_batches(df.sparkSession)
    key, gone = fresh(df, "row_key"), fresh(df, "row_gone")
    keyed = materialize(df.withColumn(key, F.monotonically_increasing_id()), "keyed")
    rows = placed_rows(keyed.select(column(key).alias("row"), column(id_column).cast("bigint").alias("doc"), column(text_column).alias("text")), shingle, percent)
    others = rows.filter("row <> first_row").select(F.col("row").alias(gone))
    return keyed.join(others, F.col(key) == F.col(gone), "left_anti").drop(key)
