import random
import zlib

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from ledgerlens.llm import pieces
from ledgerlens.llm.queries import PIECE_MODEL, QUERIES
from tests.llm.helpers import LONG, ROWS, SF, no_rows, odd_rows

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
TEXTS = ["", " ", "   a", "a  b ", "a" + " " * 50 + "b", "é́日本\U0001F600\x00z", "<s> </s>", "\n\n\t", "0123456789" * 20, "日本語テキスト" * 30,
         "▁x ▁▁y", "    if (x==y) {\n        return;\n    }", "ab" * 300, "aaaaaaaaaaaaaaaaaaaaaaaab"]


def ids(model, text):
    return np.frombuffer(pieces.encode(model, text), "<i4").tolist()


def test_same_ids_as_the_library():
    model = pieces.Model(PIECE_MODEL)
    rng = random.Random(4)
    made = ["".join(rng.choice(rng.choice(["etaoin shrdlu", "abcdefghijklmnop", " 0,.-", "éàü", "的一是"])) for _ in range(rng.randint(1, 90))) for _ in range(300)]
    for text in TEXTS + made:
        assert ids(model, text) == LIBRARY.encode(text), text
        assert pieces.decode(model, np.array(ids(model, text))) == LIBRARY.decode(LIBRARY.encode(text))


def test_unigram_model_against_the_library(tmp_path):
    """The same pieces read as a unigram model: the path has the library's score."""
    m = proto.ModelProto()
    m.ParseFromString(open(PIECE_MODEL, "rb").read())
    m.trainer_spec.model_type = pieces.UNIGRAM
    kept = [p for p in m.pieces if p.score > -1e8]
    del m.pieces[:]
    m.pieces.extend(kept)
    for p in m.pieces:
        p.score /= 1000
    (tmp_path / "u.model").write_bytes(m.SerializeToString())
    model, library = pieces.Model(str(tmp_path / "u.model")), sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "u.model"))
    for text in ("the quick brown fox", "internationalisation of words", "a  b", "schneller Fuchs über den Zaun" * 8, "x1y2z3" * 40):
        got, want = ids(model, text), library.encode(text)
        assert sum(map(library.get_score, got)) == pytest.approx(sum(map(library.get_score, want)), rel=1e-5)
        assert library.decode(got) == library.decode(want)


def test_pieces_are_committed_while_the_text_streams():
    """A long text without any space: pieces come out before its end, and few characters are held."""
    model, read = pieces.Model(PIECE_MODEL), 0

    def stream():
        nonlocal read
        for c in text:
            read += 1
            yield c

    text = "".join(random.Random(1).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    given, behind = "", 0
    for p in pieces.search(model, stream()):
        behind = max(behind, read - len(given))
        given += model.piece(p)
    assert given == text and behind <= 4 * pieces.LOOK_AFTER * model.longest
    assert pieces.piece_ids(model, pieces.search(model, "▁" + text)) == LIBRARY.encode(text)


def test_query(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    out = QUERIES["op10_sentencepiece"](spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        want = LIBRARY.encode(texts[r.doc_id])
        assert r.ids == want and r.n_ids == len(want) and r.same_text and r.ids_crc32 == zlib.crc32(np.array(want, "<i4").tobytes())


def test_odd_rows(spark):
    out = pieces.encode_pieces(odd_rows(spark), PIECE_MODEL)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(ROWS) and rows[4].n_ids == 0 and rows[4].same_text is None and rows[5].ids == [] and rows[5].same_text
    assert rows[7].n_ids == len(LIBRARY.encode(LONG))
    assert pieces.encode_pieces(no_rows(spark), PIECE_MODEL).count() == 0
    back = pieces.decode_pieces(out, PIECE_MODEL).filter("doc_id is not null").dropDuplicates(["doc_id"]).collect()
    want = {r[0]: r[1] for r in ROWS}
    assert all(r.text == (want[r.doc_id] or "") for r in back)
