import tempfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import token_files
from ledgerlens.llm.queries import END_ID, QUERIES, WORD_TOKENIZER
from tests.llm.helpers import ROWS, SF, no_rows, odd_rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=700))
def test_borders(sizes):
    ends = np.cumsum(np.array(sizes, np.int64))
    ids = np.arange(int(ends[-1]) if sizes else 0) % 65536
    rng = np.random.default_rng(len(sizes))
    names = np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, len(sizes)) // (1 << 40 * (len(sizes) % 2))).tolist()
    names[len(names) - len(names) // 9:] = [None] * (len(names) // 9)
    segment = token_files.Segment(token_files.pack(ids.astype("<u2").tobytes(), 2, sizes, names))
    borders = segment.borders
    assert segment.ids.tolist() == ids.tolist() and borders.ends().tolist() == ends.tolist() and segment.names(0, len(sizes)) == names
    assert [borders.end(i) for i in range(0, len(sizes), 7)] == ends[::7].tolist()
    for i in range(0, len(sizes), 13):
        assert segment.document(i).tolist() == ids[ends[i] - sizes[i]:ends[i]].tolist() and segment.names(i, i + 3)[:1] == names[i:i + 1]
        assert borders.between(i, len(sizes)).tolist() == ends[i:].tolist()
        if names[i] is not None:
            assert names[slice(*segment.find(names[i]))] == [names[i]] * names.count(names[i])
    assert segment.find(1 << 62) == (sum(n is not None and n < 1 << 62 for n in names),) * 2 or 1 << 62 in names
    if len(sizes) > 100 and ends[-1]:
        bits = 8 * (len(borders.low) + len(borders.high)) / len(sizes)
        assert bits <= 3 + max(0, np.log2(ends[-1] / len(sizes))) + 0.2


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(WORD_TOKENIZER), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def in_order(rows):
    return sorted((tuple(r)[:4] for r in rows), key=lambda r: r[1])


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert in_order(QUERIES["op7_token_files"](spark, SF).collect()) == expected(docs)


def test_odd_rows_and_many_segments(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="token-files-")
    token_files.write(odd_rows(spark), f"{folder}/odd", WORD_TOKENIZER, END_ID)
    out = token_files.read(spark, f"{folder}/odd").collect()
    assert in_order(out) == expected([r[:2] for r in ROWS])
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == END_ID for r in out)
    one = {r.doc_id: list(r.ids) for r in out if r.doc_id in (1, 10)}
    picked = token_files.chosen(spark, f"{folder}/odd", [10, 1, 3, 77]).collect()
    assert {r.doc_id: list(r.ids) for r in picked if r.doc_id != 3} == one and sum(r.doc_id == 3 for r in picked) == 2
    assert token_files.chosen(spark, f"{folder}/odd", []).count() == 0
    token_files.write(no_rows(spark), f"{folder}/none", WORD_TOKENIZER, END_ID)
    assert token_files.read(spark, f"{folder}/none").count() == 0


def test_rows_without_an_id_spread_over_ranges(spark):
    folder = tempfile.mkdtemp(prefix="token-files-")
    df = spark.range(400).selectExpr("case when id % 2 = 0 then id end as doc_id", "case when id % 4 = 1 then 'same words' else concat('word ', id) end as text")
    token_files.write(df, f"{folder}/half", WORD_TOKENIZER, END_ID)
    sizes = [r.n for r in spark.read.parquet(f"{folder}/half").selectExpr("part", "n_ids as n").collect()]
    assert len(sizes) >= 6 and max(sizes) < 0.4 * sum(sizes)
    rows = token_files.read(spark, f"{folder}/half").collect()
    assert [r.start for r in sorted(rows, key=lambda r: r.start)] == np.cumsum([0] + [r.n_tokens for r in sorted(rows, key=lambda r: r.start)])[:-1].tolist()
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [*range(0, 400, 2)] + [None] * 200


def test_a_tokenizer_that_looks_across_white_space_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="white space"):
        token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("text", ["don't  we'll", "Ünḯ ſK", "a b\x1cc\x85d", "<|endoftext|> x", "日本 語", "é ́e", "x" * 300])
def test_pieces_between_white_space_give_the_ids_of_the_whole(text):
    got = token_files.Encoder(WORD_TOKENIZER).encode([t and t.encode() for t in (text, None, "", " \n", text + " \t" + text)])
    own = np.frombuffer(got[0], "<u2").tolist()
    assert got[1:4] == [b""] * 3 and got[4] == got[0] * 2
    assert own == Tokenizer.from_file(WORD_TOKENIZER).encode(text, add_special_tokens=False).ids
