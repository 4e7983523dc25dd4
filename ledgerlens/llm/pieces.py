"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over the text and keeps, for each position, the last piece of
the path that ends there. A piece is at most ``longest`` characters, so only the
last ``longest`` positions can still be extended. As soon as the paths of all of
them run through one common border, the ids before it are final: they are
handed out and forgotten, and memory follows the window and not the text.

Two kinds of model are read. In a unigram model a path's score is the sum of its
pieces' scores. In a merge (BPE) model a path is a run of pieces in which every
neighbouring pair is stable: merging the characters of both by rank gives the
pair again. Such a path is the merge result of its text, and there is one for
every position, so the search needs no scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column

SPACE = "▁"
UNIGRAM, MERGES = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: Chunks and pairs that a Python worker remembers, and the longest chunk that it remembers.
CACHED, CACHED_CHARS = 1 << 20, 48
#: Uncommitted positions after which a common border is looked for, as a multiple of the window.
LOOK_AFTER = 8
#: Score of a character without a piece below the least score of a piece, as the public library has it.
UNKNOWN_PENALTY = 10.0


class Model:
    _own: dict[str, Model] = {}

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        if m.trainer_spec.model_type not in (UNIGRAM, MERGES):
            raise ValueError("only unigram and merge models are read")
        if m.normalizer_spec.precompiled_charsmap or m.normalizer_spec.remove_extra_whitespaces or not m.normalizer_spec.add_dummy_prefix:
            raise ValueError("only models that keep characters as they are and put a space in front are read")
        self.merges = m.trainer_spec.model_type == MERGES
        self.pieces = [p.piece for p in m.pieces]
        self.scores = [p.score for p in m.pieces]
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.longest = max(map(len, self.id))
        #: The pieces read backwards: a dict for each next character, the piece's number under 0.
        self.trie: dict = {}
        for p, number in self.id.items():
            node = self.trie
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[0] = number
        self.least = min(self.scores[i] for i in self.id.values()) - UNKNOWN_PENALTY
        #: No piece has a space after another character: every run of spaces begins a chunk that stands alone.
        self.leading_spaces = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        #: Neighbours within some piece; between two other characters every path has a border.
        self.inside = {p[k:k + 2] for p in self.id for k in range(len(p) - 1)}
        self.chunks: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.text = ["" if p.type not in (NORMAL, UNKNOWN) else p.piece.replace(SPACE, " ") if p.type == NORMAL else " ⁇ " for p in m.pieces]

    @classmethod
    def of(cls, path: str) -> Model:
        """The model of this Python worker, read once."""
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def merged(self, text: str) -> list[str]:
        """The characters of a short text after all merges, best score first and leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.id.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def piece(self, number: int) -> str:
        """The piece of a number in a path; numbers below START are characters without a piece."""
        return self.pieces[number] if number >= 0 else "" if number == START else chr(START - 1 - number)

    def stable(self, left: int, right: int) -> bool:
        """Whether two pieces stay as they are next to each other; ``left`` may be START."""
        if len(self.pairs) > CACHED:
            self.pairs.clear()
        parts = [p for p in (self.piece(left), self.piece(right)) if p]
        known = self.pairs[left, right] = self.merged("".join(parts)) == parts
        return known


#: In place of a piece's number: the beginning of the text, and a position that no path reaches.
START, NOWHERE = -1, -(1 << 62)


def search(model: Model, text: Iterable[str]) -> Iterator[int]:
    """The pieces of a normalised text as numbers, given out as soon as they are final; see :meth:`Model.piece`.

    ``text`` may be a stream of characters.
    """
    merges, pairs, longest = model.merges, model.pairs, model.longest
    held = ""  # characters that are not committed
    # For each position from the last committed one: the last piece of its path, where it begins, the path's score.
    last, begin, score = [START], [0], [0.0]
    look = LOOK_AFTER * longest

    def path(end: int, stop: int) -> list[int]:
        out = []
        while end > stop:
            out.append(last[end])
            end = begin[end]
        return out[::-1]

    for c in text:
        held += c
        i = len(held)
        ending: list[tuple[int, int]] = []  # pieces that end here, shortest first, with their start
        node = model.trie
        for start in range(i - 1, max(0, i - longest) - 1, -1):
            node = node.get(held[start])
            number = node.get(0) if node else None
            if number is None and start == i - 1:
                number = START - 1 - ord(c)
            if number is not None and last[start] != NOWHERE:
                ending.append((number, start))
            if node is None:
                break
        best, best_start, best_score = NOWHERE, i - 1, 0.0
        for number, start in reversed(ending):
            if merges:
                known = pairs.get((last[start], number))
                if model.stable(last[start], number) if known is None else known:
                    best, best_start = number, start
                    break
            else:
                total = score[start] + (model.scores[number] if number >= 0 else model.least)
                if best == NOWHERE or total > best_score:
                    best, best_start, best_score = number, start, total
        last.append(best)
        begin.append(best_start)
        score.append(best_score)
        if i >= look:
            alive = [k for k in range(i - longest + 1, i + 1) if last[k] != NOWHERE]
            common = max(alive)
            for k in alive:  # walk back whichever of the two is later until they meet
                while common != k:
                    if common > k:
                        common = begin[common]
                    else:
                        k = begin[k]
            if common > 0:
                yield from path(common, 0)
                held = held[common:]
                last, score = last[common:], score[common:]
                begin = [max(0, b - common) for b in begin[common:]]
            look = max(LOOK_AFTER * longest, 2 * len(held))
    yield from path(len(held), 0)


def piece_ids(model: Model, path: Iterable[int]) -> list[int]:
    """Ids of a path; a character without a piece becomes its bytes, or the unknown id if the model has no bytes."""
    out: list[int] = []
    for number in path:
        if number >= 0:
            out.append(number)
        elif model.bytes:
            out += [model.bytes[b] for b in model.piece(number).encode("utf-8")]
        else:
            out.append(model.unknown)
    return out


def remembered(model: Model, text: str, ids: bytes) -> bytes:
    if len(text) <= CACHED_CHARS:
        if len(model.chunks) > CACHED:
            model.chunks.clear()
        model.chunks[text] = ids
    return ids


def chunk_ids(model: Model, chunk: str) -> bytes:
    """Ids of a chunk; it is cut where no piece can reach across, and the parts are searched one by one."""
    found = model.chunks.get(chunk)
    if found is not None:
        return found
    inside, out, begin = model.inside, [], 0
    cuts = [k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in inside]
    for cut in [*cuts, len(chunk)]:
        span = chunk[begin:cut]
        ids = model.chunks.get(span)
        out.append(remembered(model, span, np.array(piece_ids(model, search(model, span)), "<i4").tobytes()) if ids is None else ids)
        begin = cut
    return remembered(model, chunk, b"".join(out)) if cuts else out[0]


CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")


def encode(model: Model, text: str | None) -> bytes:
    """Ids of a text as little-endian 32-bit numbers; nothing for a null or empty text."""
    if not text:
        return b""
    if not model.leading_spaces:
        return chunk_ids(model, SPACE + text.replace(" ", SPACE))
    words = text.split(" ")
    known = model.chunks
    if "" in words or SPACE in text:
        return b"".join([known.get(c) or chunk_ids(model, c) for c in CHUNK.findall(SPACE + text.replace(" ", SPACE))])
    return b"".join([known.get(c) or chunk_ids(model, c) for c in [SPACE + w for w in words]])


def decode(model: Model, ids: np.ndarray) -> str:
    """The text of ids: byte pieces are joined and read as UTF-8, the space in front goes."""
    if len(ids) == 0:
        return ""
    text = model.text
    first_normal = model.byte_of
    if first_normal and not (ids <= max(first_normal)).any():
        out = "".join([text[i] for i in ids.tolist()])
    else:
        parts: list[str] = []
        run = bytearray()
        for i in ids.tolist():
            b = first_normal.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run.clear()
            parts.append(text[i])
        parts.append(run.decode("utf-8", "replace"))
        out = "".join(parts)
    return out[1:] if out.startswith(" ") else out


FIELDS = T.StructType([T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                       T.StructField("same_text", T.BooleanType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def encoder(path: str):
    """A column function: ids of a text, their number and checksum, and whether decoding them gives the text back."""
    def encoded(text: pa.Array) -> pa.Array:
        model = Model.of(path)
        rows, same = [], []
        for raw in text.cast(pa.binary()).to_pylist():
            t = None if raw is None else raw.decode("utf-8", "replace")
            ids = encode(model, t)
            rows.append(ids)
            same.append(None if t is None else decode(model, np.frombuffer(ids, "<i4")) == t.replace(SPACE, " "))
        sizes = np.array([len(r) // 4 for r in rows], np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))
        crc = pa.array([zlib.crc32(r) for r in rows], pa.int64())
        return pa.StructArray.from_arrays([pa.array(sizes), crc, pa.array(same, pa.bool_()), lists], FIELDS.names)

    encoded.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(encoded, FIELDS)


def encode_pieces(df: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_ids, ids_crc32, same_text, ids.

    Null and empty texts have no ids; ``same_text`` is null for a null text. The
    space sign of the model, U+2581, is read as a space. Repeated rows give
    repeated rows, a null id stays null, an empty table gives no rows; further
    columns are not read.
    """
    bounded_batches(df.sparkSession)
    e = df.select(column(id_column).alias("id"), encoder(model)(column(text_column)).alias("e"))
    return e.select(F.col("id").alias(id_column), "e.*")


def decode_pieces(df: DataFrame, model: str, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """``df`` with the texts of its ids; null ids give a null text."""
    def decoded(ids: pa.Array) -> pa.Array:
        m = Model.of(model)
        return pa.array([None if i is None else decode(m, np.asarray(i, np.int64)) for i in ids.to_pylist()], pa.string())

    decoded.__annotations__ = {"ids": pa.Array, "return": pa.Array}
    return df.withColumn(text_column, F.arrow_udf(decoded, T.StringType())(column(ids_column)))
