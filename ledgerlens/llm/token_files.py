"""Token ids in files: one array of ids for many documents, their borders in Elias-Fano code.

A file is a Parquet data set with one row for each segment. Parquet is only the
envelope, so that Spark commits the rows of a task as a whole and any store that
Spark writes to will do. The segment's body is binary::

    header   "IDEG", width of an id in bytes, sizes of what follows, first document id
    ids      all ids one after the other, little-endian
    low      the low bits of each document's end, packed
    high     the rest of the ends in unary: bit (end >> low bits) + i is set for document i
    samples  the place in ``high`` of every SAMPLED-th set bit, 4 bytes each
    names    low, high and samples once more, of the document ids less the first one; documents without an id come last and have none

So a border takes about 2 bits and its low bits, and one is found by a jump to a
sample and a short scan. Nothing has a table of 64-bit numbers.
"""

from __future__ import annotations

import gc
import os
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column, shuffle_partitions
from ledgerlens.session import work_path

HEADER = struct.Struct("<4sBBBxIIIIQq")
MAGIC = b"IDEG"
SAMPLED = 256
#: A segment ends with the document that brings it to so many ids or documents.
SEGMENT_IDS, SEGMENT_DOCS = 1 << 21, 1 << 16
#: Documents that a reader decodes at once.
AT_ONCE = 1024
#: Words whose ids a Python worker remembers, and the longest that it remembers.
CACHED_WORDS, CACHED_BYTES = 1 << 20, 64
#: New words encoded as one text.
TOGETHER = 256


class Borders:
    """Ends of documents within a segment, non-decreasing, in Elias-Fano code."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def encode(cls, ends: np.ndarray) -> Borders:
        n, last = len(ends), int(ends[-1]) if len(ends) else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        ends = ends.astype(np.uint64)
        places = (ends >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        unary[places] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        bits = ((ends[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(n, low_bits, np.packbits(bits, bitorder="little"), np.packbits(unary, bitorder="little"),
                   places[::SAMPLED].astype("<u4"))

    def select(self, i: int) -> int:
        """The place of set bit number i in the high part."""
        place = int(self.samples[i // SAMPLED])
        left = i % SAMPLED
        byte = place >> 3
        ones = np.flatnonzero(np.unpackbits(self.high[byte:byte + 1], bitorder="little"))
        ones = ones[ones >= (place & 7)]
        while left >= len(ones):
            left -= len(ones)
            byte += 1
            ones = np.flatnonzero(np.unpackbits(self.high[byte:byte + 1], bitorder="little"))
        return byte * 8 + int(ones[left])

    def between(self, a: int, b: int) -> np.ndarray:
        """The values of documents ``a`` up to ``b``: from the sample before the first to that behind the last, without reading the others."""
        if a >= b:
            return np.zeros(0, np.uint64)
        sample, behind = a // SAMPLED, -(-b // SAMPLED)
        place = int(self.samples[sample])
        stop = (int(self.samples[behind]) >> 3) + 1 if behind < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[place >> 3:stop], bitorder="little"))
        ones = ones[np.searchsorted(ones, place & 7) + a - sample * SAMPLED:][:b - a] + (place >> 3) * 8
        values = (ones - np.arange(a, b)).astype(np.uint64)
        if not self.low_bits:
            return values
        first, last = a * self.low_bits, b * self.low_bits
        bits = np.unpackbits(self.low[first >> 3:(last + 7) >> 3], bitorder="little")[first & 7:][:last - first].reshape(b - a, self.low_bits)
        return (values << np.uint64(self.low_bits)) | (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def end(self, i: int) -> int:
        """One value; in front of the first it is 0."""
        return int(self.between(i, i + 1)[0]) if i >= 0 else 0

    def ends(self) -> np.ndarray:
        return self.between(0, self.count).astype(np.int64)

    def parts(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.low, self.high, self.samples))

    @classmethod
    def read(cls, body: bytes, at: int, count: int, low_bits: int, high_bytes: int) -> tuple[Borders, int]:
        low = np.frombuffer(body, np.uint8, (count * low_bits + 7) // 8, at)
        high = np.frombuffer(body, np.uint8, high_bytes, at + len(low))
        samples = np.frombuffer(body, "<u4", -(-count // SAMPLED), at + len(low) + high_bytes)
        return cls(count, low_bits, low, high, samples), at + len(low) + high_bytes + 4 * len(samples)


def pack(ids: bytes, width: int, sizes: list[int], names: list[int | None] = ()) -> bytes:
    """A segment's body; ``names`` are the document ids in ascending order, null ones last."""
    borders = Borders.encode(np.cumsum(np.asarray(sizes, np.int64)))
    named = np.array([n for n in names if n is not None], np.int64)
    first = int(named[0]) if len(named) else 0
    # Differences of 64-bit numbers, exact in unsigned arithmetic however far they are apart.
    known = Borders.encode(named.view(np.uint64) - np.array([first], np.int64).view(np.uint64))
    return b"".join((HEADER.pack(MAGIC, width, borders.low_bits, known.low_bits, borders.count, known.count, len(borders.high), len(known.high),
                                 len(ids) // width, first), ids, borders.parts(), known.parts()))


class Segment:
    """A segment's body, of which only what is asked for is decoded."""

    def __init__(self, body: bytes):
        magic, width, low_bits, name_bits, count, named, high_bytes, name_bytes, total, self.first = HEADER.unpack_from(body)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        self.count, self.named = count, named
        self.ids = np.frombuffer(body, f"<u{width}", total, HEADER.size)
        self.borders, at = Borders.read(body, HEADER.size + total * width, count, low_bits, high_bytes)
        self.known, _ = Borders.read(body, at, named, name_bits, name_bytes)

    def names(self, a: int, b: int) -> list[int | None]:
        own = self.known.between(min(a, self.named), min(b, self.named)) + np.array([self.first], np.int64).view(np.uint64)
        return own.view(np.int64).tolist() + [None] * (b - a - len(own))

    def find(self, name: int) -> tuple[int, int]:
        """The places of the documents of one id, from and to, by halving."""
        return bisect_left(range(self.named), name, key=lambda i: self.names(i, i + 1)[0]), bisect_right(
            range(self.named), name, key=lambda i: self.names(i, i + 1)[0])

    def document(self, i: int) -> np.ndarray:
        """The ids of one document: what lies between two borders."""
        return self.ids[self.borders.end(i - 1):self.borders.end(i)]


class Encoder:
    """Ids of texts by a tokenizer that drops white space and joins nothing across it.

    The text is cut at ASCII white space and each piece is encoded by the library
    once; as no rule of such a tokenizer looks across white space, the ids are
    those of the whole text. One encoder lives as long as its Python worker.
    """

    _own: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.cache: dict[bytes, bytes] = {}
        self.check()

    @classmethod
    def of(cls, path: str) -> Encoder:
        os.environ |= {"TOKENIZERS_PARALLELISM": "false", "RAYON_NUM_THREADS": "1"}  # a task has one core
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def check(self) -> None:
        """Raises an error for a tokenizer that joins something across white space, told by words of its vocabulary."""
        words = [w for w in sorted(self.tokenizer.get_vocab())[::97] if w.strip() and not w.startswith("<") and len(w.split()) == 1]
        alone = [i for w in words for i in self.tokenizer.encode(w, add_special_tokens=False).ids]
        for mark in (" ", "\n"):
            if self.tokenizer.encode(mark.join(words), add_special_tokens=False).ids != alone:
                raise ValueError("the tokenizer's ids depend on white space")

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text. Python's search for cycles stands still meanwhile: there are none, and it would walk all words again and again."""
        collects = gc.isenabled()
        gc.disable()
        try:
            split = [t.split() if t else [] for t in texts]
            forget = self.learn(list(set().union(*split).difference(self.cache)))
            out = [b"".join(map(self.cache.__getitem__, words)) for words in split]
            for w in forget:
                del self.cache[w]
        finally:
            if collects:
                gc.enable()
        return out

    def learn(self, words: list[bytes]) -> list[bytes]:
        """Encodes new words, many in one text; returns those that are not to be remembered.

        These are long ones, and all new ones once the cache is full: frequent words come early.
        """
        full = len(self.cache) >= CACHED_WORDS
        kind = f"<u{self.width}"
        for k in range(0, len(words), TOGETHER):
            part = words[k:k + TOGETHER]
            texts = [w.decode("utf-8", "replace") for w in part]
            encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            raw = np.array(encoded.ids, kind).tobytes()
            # An id belongs to the word at or behind whose start it starts.
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            ends = (np.searchsorted(np.array([o[0] for o in encoded.offsets], np.int64), starts[1:]) * self.width).tolist()
            at = 0
            for w, end in zip(part, ends):
                self.cache[w] = raw[at:end]
                at = end
        return words if full else [w for w in words if len(w) > CACHED_BYTES]


SEGMENT = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()),
                        *[T.StructField(c, T.LongType()) for c in ("before", "n_ids", "first_id", "last_id")], T.StructField("body", T.BinaryType())])


def write(df: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encodes ``df`` and writes its ids in ascending order of the document id, null ids last.

    Texts are dealt out by range, and a task encodes and packs those of a range in
    order. (Ranges are found by a pass over the rows, so what is dealt out must be
    cheap to make, and ids are not.) ``before`` counts the ids of the same range in
    earlier segments. Null and empty texts have the end id only. Repeated rows are
    written as often as they come. Rows of one id come in the order of the lengths
    of their texts, then of a hash; many of them, equal ones too, are spread over
    several ranges.
    """
    spark = df.sparkSession
    bounded_batches(spark)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        width, end = encoder.width, end_id.to_bytes(encoder.width, "little")
        part, number, before, held = 0, 0, 0, 0
        names: list[int | None] = []
        sizes: list[int] = []
        bodies: list[bytes] = []

        def closed() -> pa.RecordBatch:
            nonlocal number, before, held
            known = [n for n in names if n is not None]
            row = {"part": [part], "segment": [number], "before": [before], "n_ids": [held], "first_id": known[:1] or [None], "last_id": known[-1:] or [None],
                   "body": [pack(b"".join(bodies), width, sizes, names)]}
            number, before, held = number + 1, before + held, 0
            names.clear(), sizes.clear(), bodies.clear()
            return pa.RecordBatch.from_pydict(row, pa.schema([
                ("part", pa.int32()), ("segment", pa.int32()), *[(c, pa.int64()) for c in ("before", "n_ids", "first_id", "last_id")], ("body", pa.binary())]))

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for name, ids in zip(batch.column("id").to_pylist(), encoder.encode(texts)):
                names.append(name)
                bodies.append(ids + end)
                sizes.append(len(bodies[-1]) // width)
                held += sizes[-1]
                if held >= SEGMENT_IDS or len(names) >= SEGMENT_DOCS:
                    yield closed()
        if names:
            yield closed()

    text = column(text_column)
    given = df.select(column(id_column).cast("bigint").alias("id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).alias("size"),
                      F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("id").asc_nulls_last(), *[F.col(c).asc() for c in ("size", "hash", "row")]]
    placed = (given.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
              .select(F.spark_partition_id().alias("part"), "id", "text"))
    placed.mapInArrow(segments, SEGMENT).write.parquet(path)


def with_bases(segments: DataFrame) -> DataFrame:
    """Adds ``base``, the ids of all earlier segments; the window has one row for each range."""
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("part_ids").over(earlier), F.lit(0)).alias("offset"))
    return segments.join(offsets, "part").withColumn("base", F.col("offset") + F.col("before"))


READ = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                     T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                     T.StructField("ids", T.ArrayType(T.IntegerType()))])


def read(spark, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 and, if wanted, the ids themselves.

    ``start`` counts the ids of all documents before this one; the checksum is
    over the ids as little-endian 32-bit numbers. Empty files give no rows.
    """
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, body in zip(*(batch.column(c).to_pylist() for c in ("base", "body"))):
                segment = Segment(body)
                for a in range(0, segment.count, AT_ONCE):
                    b = min(a + AT_ONCE, segment.count)
                    before = segment.borders.end(a - 1)
                    ends = segment.borders.between(a, b).astype(np.int64)
                    starts = np.concatenate(([before], ends[:-1]))
                    wide = segment.ids[before:int(ends[-1])].astype("<u4")
                    columns = [pa.array(segment.names(a, b), pa.int64()), pa.array(starts + base), pa.array(ends - starts),
                               pa.array([zlib.crc32(wide[x:y]) for x, y in zip(starts - before, ends - before)], pa.int64())]
                    if with_ids:
                        offsets = np.concatenate(([0], ends - before)).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(wide.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names=READ.names[:len(columns)])

    bounded_batches(spark)
    segments = spark.read.schema(SEGMENT).parquet(path)
    schema = READ if with_ids else T.StructType(READ.fields[:-1])
    return with_bases(segments).select("base", "body").mapInArrow(documents, schema)


def chosen(spark, path: str, names: Sequence[int]) -> DataFrame:
    """(doc_id, ids) of the documents of a few ids: of the segments that may hold one, only their borders are decoded.

    An id that the files do not have gives no row, one that comes several times as many rows.
    """
    names = sorted(set(names))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, list[int]]] = []
            for first, last, body in zip(*(batch.column(c).to_pylist() for c in ("first_id", "last_id", "body"))):
                segment = Segment(body)
                for name in names[bisect_left(names, first):bisect_right(names, last)]:
                    found += [(name, segment.document(i).tolist()) for i in range(*segment.find(name))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([i for _, i in found], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    bounded_batches(spark)
    near = [F.col("first_id").isNotNull() & (F.col("first_id") <= names[-1]) & (F.col("last_id") >= names[0])] if names else [F.lit(False)]
    return (spark.read.schema(SEGMENT).parquet(path).filter(near[0]).select("first_id", "last_id", "body")
            .mapInArrow(documents, "doc_id bigint, ids array<int>"))


def round_trip(df: DataFrame, tokenizer: str, end_id: int, with_ids: bool = False, **columns: str) -> DataFrame:
    """Writes the files of ``df`` in the shared folder and reads them back."""
    path = work_path(df.sparkSession, f"token-files-{uuid.uuid4().hex}")
    write(df, path, tokenizer, end_id, **columns)
    return read(df.sparkSession, path, with_ids)
