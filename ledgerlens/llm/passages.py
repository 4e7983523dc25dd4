"""Substring dedup by hashed lines: a passage that came earlier is removed, its offsets are kept.

A unit is a line, cut further where a sentence ends and behind words that a hash
of their own picks, so that a passage pasted into the middle of other text, with
or without sentence marks, still has units of its own. Units are compared after
lower-casing and reducing white space and outer punctuation. Units that came
earlier are removed where they adjoin each other to a passage of some length; a
short sentence that recurs by chance stays.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column, fresh
from ledgerlens.session import materialize

#: Adjoining repeated units are a repeated passage from so many words on.
LEAST_WORDS = 15
#: A word, or a character of a script that is written without spaces.
TOKEN = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\uff66-\uff9f]|[^\\s\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\uff66-\uff9f]+")
#: One word in so many ends a unit.
CUT_EVERY = 32
#: A unit ends at a line break, or behind a mark that ends a sentence; marks of Latin script count if white space follows.
UNIT = re.compile(r"[^\n]+?(?:[.!?…]+[\"'”’)\]]*(?=\s)|[。！？]+[\"'”’」』）)\]]*|(?=\n)|\Z)|[^\n]+")
EDGES = " \t\r\x0b\x0c.,;:!?…。，！？；：\"'“”‘’()[]「」『』（）"

UNITS = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
                      *[T.StructField(c, T.IntegerType()) for c in ("start", "stop", "place", "words")], T.StructField("again", T.BooleanType())])


def units(text: str) -> Iterator[tuple[int, int, str, int]]:
    """Start, end, normal form and words of each unit that has a word, in code points, without the white space around it."""
    for m in UNIT.finditer(text):
        start, last, words = m.start(), -1, 0
        for t in TOKEN.finditer(m[0]):
            if last < 0:
                start = m.start() + t.start()
            last, words = m.start() + t.end(), words + 1
            if zlib.crc32(t[0].lower().encode("utf-8", "replace")) % CUT_EVERY == 0:
                yield start, last, normal(text[start:last]), words
                last, words = -1, 0
        if last >= 0:
            yield start, last, normal(text[start:last]), words


def normal(unit: str) -> str:
    return " ".join(unit.lower().strip(EDGES).split())


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row of the table one row with its id, and one for each unit; ``again`` marks a unit that the same text had before."""
    for batch in batches:
        rows, names, heads = [], [], []
        columns: list[list] = [[] for _ in range(7)]
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for i, (row, name, raw) in enumerate(zip(batch.column("row").to_pylist(), batch.column("doc").to_pylist(), texts)):
            seen: set[bytes] = set()
            found = [(None, None, None, None, None, None, False)]
            for place, (start, stop, own, words) in enumerate(units(raw.decode("utf-8", "replace")) if raw else ()):
                d = xxhash.xxh3_128_digest(own.encode())
                found.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), start, stop, place, words, d in seen))
                seen.add(d)
            rows += [row] * len(found)
            names += [name] * len(found)
            heads += [i] + [None] * (len(found) - 1)
            for values, own in zip(columns, zip(*found)):
                values += own
        types = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(names, pa.int64()), *map(pa.array, columns, types), batch.column("id").take(pa.array(heads, pa.int64()))],
            names=[*UNITS.names, "id"])


def written_units(df: DataFrame, id_column: str, text_column: str, row: Column) -> DataFrame:
    """What ``digests`` gives, written, so that each row keeps its key ``row``."""
    bounded_batches(df.sparkSession)
    ids = column(id_column)
    docs = df.select(row.alias("row"), ids.cast("bigint").alias("doc"), ids.alias("id"), column(text_column).alias("text"))
    return materialize(docs.mapInArrow(digests, T.StructType([*UNITS, T.StructField("id", docs.schema["id"].dataType)])), "units")


def repeated_units(written: DataFrame) -> DataFrame:
    """(row, start, stop, place, words): every occurrence of a unit but its earliest.

    Occurrences are ranked by document id, null last, then by place; rows without
    an id are documents of their own, ranked by row key. The first document of
    each digest is found with a combined count; only digests that two documents
    share take part in the join back to the units.
    """
    found = written.filter("start is not null")
    new = found.filter("not again")
    shared = new.groupBy("lo", "hi").agg(
        F.min("doc").alias("first"), F.min(F.expr("case when doc is null then row end")).alias("first_row"), F.count("*").alias("n")).filter("n > 1")
    later = new.join(shared, ["lo", "hi"]).filter("case when first is null then row <> first_row else doc is null or doc <> first end")
    kept = ("row", "start", "stop", "place", "words")
    return later.select(*kept).unionByName(found.filter("again").select(*kept))


def passages(repeated: DataFrame, least_words: int) -> DataFrame:
    """Those of the ``repeated`` units that adjoin each other to ``least_words`` words or more; a window holds the units of one row."""
    order = Window.partitionBy("row").orderBy("place")
    runs = repeated.withColumn("run", F.col("place") - F.row_number().over(order))
    return runs.withColumn("all", F.sum("words").over(Window.partitionBy("row", "run"))).filter(F.col("all") >= least_words)


def removals(written: DataFrame, least_words: int) -> DataFrame:
    """(row, n_removed, removed_chars, removed) of each row that loses a unit."""
    spans = passages(repeated_units(written), least_words).groupBy("row").agg(
        F.count("*").alias("n_removed"), F.sum(F.col("stop") - F.col("start")).alias("removed_chars"),
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    return spans.select("row", "n_removed", "removed_chars", F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s.getField("start"), s.getField("stop"))), ",").alias("removed"))


def dedup_units(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per row of ``df``: id, n_removed, removed_chars, and the removed spans as start:end, comma-joined.

    Removed are units that an earlier document, or the same one, has before, where
    such units adjoin each other to ``least_words`` words or more; with 1 every
    repeated unit goes. Spans are in code points of the row's own text, end
    exclusive, in order. Null and empty texts have none. Rows of one id are one document: none of them is
    removed for another. Rows without an id are documents of their own and come
    last in the ranking; one copy of each unit always stays. An empty table gives
    no rows; further columns are not read.
    """
    written = written_units(df, id_column, text_column, F.monotonically_increasing_id())
    ids = written.filter("start is null").select("row", "id")
    return ids.join(removals(written, least_words), "row", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("removed_chars", F.lit(0)).cast("bigint").alias("removed_chars"), F.coalesce("removed", F.lit("")).alias("removed"))


@F.arrow_udf(T.StringType())
def without(text: pa.Array, removed: pa.Array) -> pa.Array:
    out = []
    for t, spans in zip(text.to_pylist(), removed.to_pylist()):
        if t and spans:
            done, parts = 0, []
            for a, b in (map(int, s.split(":")) for s in spans.split(",")):
                parts.append(t[done:a])
                done = max(done, b)
            t = "".join(parts) + t[done:]
        out.append(t)
    return pa.array(out, pa.string())


def remove_units(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """``df`` with the repeated units cut out of its texts; rows and other columns stay."""
    name, key, row = fresh(df, "removed"), fresh(df, "removed_of"), fresh(df, "row_key")
    keyed = materialize(df.withColumn(row, F.monotonically_increasing_id()), "keyed")
    spans = removals(written_units(keyed, id_column, text_column, column(row)), least_words).select(F.col("row").alias(key), F.col("removed").alias(name))
    joined = keyed.join(spans, F.col(row) == F.col(key), "left")
    return joined.withColumn(text_column, without(column(text_column), F.col(name))).drop(name, key, row)
